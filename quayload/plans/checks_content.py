"""Queries that compare, complete or locate the contents of tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.operators.compare import diff_versions, reconcile
from quayload.operators.segments import SegmentColumns, geocode_ranges
from quayload.operators.similar import geocode_similar
from quayload.plans.refresh import DIVERT, publish_staged
from quayload.plans.replay import reject_fields, replay_rejects
from quayload.plans.run import Run
from quayload.sidecar import write_sidecar
from quayload.sinks.changes import load_changes, load_chunked
from quayload.sinks.publish import write_version
from quayload.sources.infer import infer_record_schema
from quayload.sources.paged import PageForm, extract_records_paged, land_paged, number_rows
from quayload.sources.records import extract_records, land_records
from quayload.sources.relational import plan_split
from quayload.spec import TableSpec
from quayload.staging import TIMESTAMP_NTZ_PATTERN, read_staged, stage_table


def _changed_orders(orders: DataFrame) -> DataFrame:
    """Orders of which some are gone, some have another price, and some are there twice."""
    key = F.col("o_orderkey")
    price = F.when(key % 613 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copies = F.when(key % 613 == 7, 0).when(key % 613 == 11, 2).otherwise(1)
    return orders.withColumn("o_totalprice", price).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).where(F.col("copy") <= copies).drop("copy")


CHANGED_SQL = """
WITH changed AS (
    SELECT * REPLACE (CASE WHEN o_orderkey % 613 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
    FROM orders WHERE o_orderkey % 613 <> 7
    UNION ALL
    SELECT * FROM orders WHERE o_orderkey % 613 = 11
), gone AS (
    SELECT * FROM orders EXCEPT ALL SELECT * FROM changed
), come AS (
    SELECT * FROM changed EXCEPT ALL SELECT * FROM orders
)
"""


def q_reconcile_table(run: Run) -> DataFrame:
    """A source table and what was staged of it, where the staged rows are not all the source's."""
    spec = TableSpec("sales", "orders")
    stage_table(_changed_orders(run.table("orders")), spec, run.root)
    found = reconcile(run.table("orders"), read_staged(run.spark, spec, run.root), "o_orderkey")
    return found.differences.withColumn("rows", F.lit(found.left_rows - found.right_rows).cast("bigint"))


def q_diff_versions(run: Run) -> DataFrame:
    spec = TableSpec("sales", "orders", keys=("o_orderkey",))
    old = write_version(run.table("orders"), spec, run.area)
    new = write_version(_changed_orders(run.table("orders")), spec, run.area)
    return diff_versions(run.spark.table(old.name), run.spark.table(new.name), spec.keys)


def _paged_turns(run: Run, form: PageForm, page_rows: int, overlap: int) -> tuple[T.StructType, str]:
    """Turns on pages of a list that moved: each page begins with the last records of the one before."""
    turns = run.table("conversations").select("conv_id", "turn", "role", "text")
    placed = number_rows(turns, ["conv_id", "turn"], "place", f"{run.root}/numbered")
    pages = f"{run.root}/pages"
    land_paged(placed, pages, "place", page_rows, overlap, form, stamp="seen_on")
    return T.StructType([*turns.schema.fields, T.StructField("seen_on", T.LongType())]), pages


def q_extract_records_paged(run: Run) -> DataFrame:
    """Each turn once, as the last page that has it shows it."""
    record, pages = _paged_turns(run, PageForm(), 20, 7)
    return extract_records_paged(run.spark, pages, record, ["conv_id", "turn"])


def q_infer_record_schema(run: Run) -> DataFrame:
    """Orders on pages that write the price as whole numbers, as decimals or as words; read by the schema found."""
    orders = run.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    prices = {"O": F.floor("o_totalprice").cast("bigint"), "F": F.col("o_totalprice").cast("decimal(12,2)"), "P": F.lit("n/a")}
    for status, price in prices.items():
        land_records(orders.where(F.col("o_orderstatus") == status).withColumn("o_totalprice", price), f"{run.root}/pages/{status}")
    last = T.StructType.fromDDL("o_orderkey string, o_gone bigint")
    schema, drift = infer_record_schema(run.spark, f"{run.root}/pages/*", last)
    rows = extract_records(run.spark, f"{run.root}/pages/*", schema)
    changes = ",".join(f"{change.path}:{change.kind}" for change in drift)
    return rows.select(
        "o_orderkey", "o_gone", "o_orderstatus", F.col("o_totalprice").try_cast("double").alias("o_totalprice"), F.lit(changes).alias("drift")
    )


def _misspelt(name: Column, by: Column) -> Column:
    """A name without one of its letters, or with two of them changed, or as it is."""
    at = 1 + by % F.length(name)
    without = F.concat(F.substring(name, F.lit(1), at - 1), F.substring(name, at + 1, F.length(name)))
    return F.when(by % 3 == 0, without).when(by % 3 == 1, F.translate(name, "AI", "EY")).otherwise(name)


def q_geocode_similar(run: Run) -> DataFrame:
    """Customers whose street names are misspelt, located by the most similar address of a supplier."""
    nation = run.table("nation").select("n_nationkey", "n_name")
    house = F.floor(F.col("c_acctbal") / 1000).cast("string")
    street = F.concat(house, F.lit(" "), _misspelt(F.col("n_name"), F.col("c_custkey")), F.lit(" st."))
    rows = run.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", street).alias("street_address"))
    return geocode_similar(rows, run.lookup(), ("street_address",), ("lat", "lon", "matched_address", "similarity"))


def _grams(key: str) -> str:
    return f"list_distinct(list_transform(range(1, len({key}) + 1), lambda i: substr(' ' || {key} || ' ', i, 3)))"


SIMILAR_SQL = f"""
WITH reference AS (
    SELECT trim(regexp_replace(upper(concat_ws(' ', cast(cast(floor(s_acctbal / 1000) AS BIGINT) AS VARCHAR), n_name || ' ST')),
        '[^A-Z0-9]+', ' ', 'g')) AS k, s_suppkey AS id, s_acctbal / 1000 AS lat, -s_acctbal / 2000 AS lon
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
), known AS (
    SELECT k, arg_min(lat, id) AS lat, arg_min(lon, id) AS lon FROM reference GROUP BY k
), spelt AS (
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN
        cast(cast(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) || ' ' || CASE c_custkey % 3
            WHEN 0 THEN substr(n_name, 1, cast(c_custkey % len(n_name) AS INTEGER)) || substr(n_name, cast(c_custkey % len(n_name) AS INTEGER) + 2)
            WHEN 1 THEN translate(n_name, 'AI', 'EY') ELSE n_name END || ' st.' END AS street_address
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), keyed AS (
    SELECT *, nullif(trim(regexp_replace(upper(street_address), '[^A-Z0-9]+', ' ', 'g')), '') AS a FROM spelt
), asked AS (
    SELECT DISTINCT a FROM keyed WHERE a IS NOT NULL
), pairs AS (
    SELECT a, k, len(list_intersect({_grams('a')}, {_grams('k')})) AS n, len({_grams('a')}) + len({_grams('k')}) AS summed
    FROM asked, known
), best AS (
    SELECT a, k, CASE WHEN a = k THEN 1.0::DOUBLE ELSE n / (summed - n)::DOUBLE END AS similarity
    FROM pairs WHERE a = k OR n * 100 >= (summed - n) * 60 AND a NOT IN (SELECT k FROM known)
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY n / (summed - n)::DOUBLE DESC, k) = 1
)
SELECT c_custkey, street_address, lat, lon, best.k AS matched_address, similarity
FROM keyed LEFT JOIN best USING (a) LEFT JOIN known ON known.k = best.k
"""


def q_geocode_ranges(run: Run) -> DataFrame:
    """Customers on segments made of suppliers: a house number inside, on the right side, with its place."""
    nation = run.table("nation").select("n_nationkey", "n_name")
    balance = F.floor("s_acctbal").cast("bigint")
    segments = (
        run.table("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat("n_name", F.lit(" st")).alias("street"),
            balance.alias("low"),
            (balance + F.col("s_suppkey") % 4 * 900).alias("high"),
            F.get(F.array(F.lit("odd"), F.lit("even"), F.lit(None)), (F.col("s_suppkey") % 3).cast("int")).alias("parity"),
            *[(F.col("s_acctbal") / d).alias(c) for c, d in (("low_lat", 1000), ("low_lon", -500), ("high_lat", 900), ("high_lon", -400))],
            F.col("s_suppkey").alias("segment_id"),
        )
    )
    number = F.floor(F.col("c_acctbal")).cast("string")
    houses = run.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.concat(number, F.lit("B"))).alias("house"), F.concat(F.lower("n_name"), F.lit("  St.")).alias("road")
    )
    found = geocode_ranges(houses, segments, "house", ("road",), names=SegmentColumns())
    return found.withColumns({c: F.round(c, 6) for c in ("lat", "lon")})


RANGES_SQL = """
WITH segments AS (
    SELECT n_name AS street, cast(floor(s_acctbal) AS BIGINT) AS low,
        cast(floor(s_acctbal) AS BIGINT) + s_suppkey % 4 * 900 AS high, s_suppkey % 3 AS side, s_suppkey AS segment,
        s_acctbal / 1000 AS low_lat, s_acctbal / -500 AS low_lon, s_acctbal / 900 AS high_lat, s_acctbal / -400 AS high_lon
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE floor(s_acctbal) >= 0
), houses AS (
    SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN cast(cast(floor(c_acctbal) AS BIGINT) AS VARCHAR) || 'B' END AS house,
        lower(n_name) || '  St.' AS road, n_name AS street,
        CASE WHEN c_custkey % 5 > 0 AND floor(c_acctbal) >= 0 THEN cast(floor(c_acctbal) AS BIGINT) END AS number
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), met AS (
    SELECT c_custkey, segment, CASE WHEN high > low THEN (number - low) / (high - low)::DOUBLE ELSE 0 END AS share,
        low_lat, low_lon, high_lat, high_lon
    FROM houses JOIN segments ON houses.street = segments.street AND number BETWEEN low AND high
        AND (side = 2 OR side = 1 - number % 2)
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY segment) = 1
)
SELECT c_custkey, house, road, round(low_lat + (high_lat - low_lat) * share, 6) AS lat,
    round(low_lon + (high_lon - low_lon) * share, 6) AS lon, segment
FROM houses LEFT JOIN met USING (c_custkey)
"""

def q_load_changes(run: Run) -> DataFrame:
    """Orders in chunks, then some of them changed, some gone and some new."""
    spec, orders, key = TableSpec("sales", "orders", keys=("o_orderkey",)), run.table("orders"), F.col("o_orderkey")
    load_chunked(orders, spec, run.area, 64)
    changed = orders.where(key % 613 == 5).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = orders.where(key % 613 == 11).withColumn("o_orderkey", -1 - key)
    gone = orders.where(key % 613 == 7).select("o_orderkey")
    return run.spark.table(load_changes(run.spark, spec, run.area, changed.unionByName(new), gone))


def q_plan_split(run: Run) -> DataFrame:
    """Lines read part by part, by a key that a third of them share; with the number of the part a row came with."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_partkey"))
    lines = run.table("lineitem").withColumn("k", hot.cast("bigint"))
    parts = [F.when(F.expr(p), 1).otherwise(0) for p in plan_split(lines, ["k", "l_orderkey"], 12).predicates]
    held = parts[0]
    for part in parts[1:]:
        held = held + part
    return lines.select("l_orderkey", "l_linenumber", "k", held.alias("parts"))


def q_replay_rejects(run: Run) -> DataFrame:
    """Orders of which those without a price were diverted; the prices come later, and make the table whole."""
    orders, spec = run.table("orders"), TableSpec("sales", "orders", keys=("o_orderkey",))
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.date_format("o_orderdate", TIMESTAMP_NTZ_PATTERN)
    landed = orders.withColumns({"o_totalprice": price, "o_orderdate": day, "o_orderkey": F.col("o_orderkey").cast("string"), "o_custkey": F.col("o_custkey").cast("string")})
    staged = stage_table(landed, spec, run.root)
    write_sidecar(run.spark, orders.schema, spec, run.root)
    first = publish_staged(run.spark, staged, run.root, run.area, DIVERT)
    late = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("string").alias("late"))
    rejects = reject_fields(run.spark, spec, run.root).where(F.array_contains("causes", "o_totalprice"))
    mended = rejects.join(late, "o_orderkey").withColumn("o_totalprice", F.col("late"))
    done = replay_rejects(run.spark, spec, run.root, run.area, mended)
    counts = [F.lit(n).cast("bigint").alias(c) for c, n in (("diverted", first.rejects), ("added", done.added), ("left_over", done.left))]
    return run.spark.table(done.name).select("*", *counts)


CHECKS: dict[str, tuple[Callable[[Run], DataFrame], str]] = {
    "reconcile_table": (
        q_reconcile_table,
        CHANGED_SQL
        + """, sizes AS (SELECT (SELECT count(*) FROM orders) - (SELECT count(*) FROM changed) AS n)
           SELECT *, 'left' AS side, count(*) AS times, (SELECT n FROM sizes) AS rows FROM gone GROUP BY ALL
           UNION ALL
           SELECT *, 'right', count(*), (SELECT n FROM sizes) FROM come GROUP BY ALL""",
    ),
    "diff_versions": (
        q_diff_versions,
        CHANGED_SQL
        + """SELECT *, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM come) THEN 'changed_from' ELSE 'removed' END AS change,
               count(*) AS times FROM gone GROUP BY ALL
           UNION ALL
           SELECT *, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM gone) THEN 'changed_to' ELSE 'added' END,
               count(*) FROM come GROUP BY ALL""",
    ),
    "extract_records_paged": (
        q_extract_records_paged,
        """SELECT conv_id, turn, role, text, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 13 AS seen_on
           FROM conversations""",
    ),
    "infer_record_schema": (
        q_infer_record_schema,
        """SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, NULL::BIGINT AS o_gone, o_orderstatus,
               CASE o_orderstatus WHEN 'O' THEN floor(o_totalprice) WHEN 'F' THEN o_totalprice END AS o_totalprice,
               'o_orderkey:kept,o_gone:missing,o_orderstatus:added,o_totalprice:added' AS drift
           FROM orders""",
    ),
    "replay_rejects": (
        q_replay_rejects,
        """WITH p AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P')
           SELECT orders.*, n AS diverted, n AS added, 0::BIGINT AS left_over FROM orders, p""",
    ),
    "load_changes": (
        q_load_changes,
        """SELECT * REPLACE (CASE WHEN o_orderkey % 613 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
           FROM orders WHERE o_orderkey % 613 <> 7
           UNION ALL
           SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM orders WHERE o_orderkey % 613 = 11""",
    ),
    "plan_split": (
        q_plan_split,
        """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END AS k, 1 AS parts
           FROM lineitem""",
    ),
    "geocode_similar": (q_geocode_similar, SIMILAR_SQL),
    "geocode_ranges": (q_geocode_ranges, RANGES_SQL),
}
