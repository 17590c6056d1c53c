"""One runnable query per operator over the given tables, with its SQL equivalent.

The queries write to new folders in the shared workspace and return a lazy
read of what they wrote. They run over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.text import compose_query_key, spell_digits
from quayload.operators.enrich import attach_location, geocode_enrich, remove_fields, select_location_fields
from quayload.plans import checks_content, checks_keyed
from quayload.plans.refresh import (
    DIVERT,
    load_staged,
    publish_environments,
    publish_staged,
    refresh_geocoded,
    refresh_records,
    refresh_table,
)
from quayload.plans.run import READERS, Run
from quayload.sidecar import write_sidecar
from quayload.sinks.publish import ServingArea, lookup, publish_table
from quayload.sources.records import extract_records, land_records
from quayload.sources.relational import CatalogSource, extract_table
from quayload.spec import PRODUCTION, TEST, TableSpec, quote
from quayload.staging import (
    PLAIN_CSV,
    TIMESTAMP_NTZ_PATTERN,
    StagedTable,
    TypedLoad,
    stage_table,
    typed_load,
)

LOCATED_SQL = """
WITH reference AS (
    SELECT
        trim(regexp_replace(upper(concat_ws(' ',
            cast(cast(floor(s_acctbal / 1000) AS BIGINT) AS VARCHAR), n_name || ' ST'
        )), '[^A-Z0-9]+', ' ', 'g')) AS k,
        s_suppkey AS address_id,
        s_acctbal / 1000 AS lat,
        -s_acctbal / 2000 AS lon
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
), located AS (
    SELECT k, arg_min(lat, address_id) AS lat, arg_min(lon, address_id) AS lon
    FROM reference GROUP BY k
), addressed AS (
    SELECT customer.*, CASE WHEN c_mktsegment <> 'MACHINERY' THEN
        '  ' || cast(cast(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR)
        || ',  ' || lower(n_name) || ' -- st. ' END AS street_address
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), enriched AS (
    SELECT addressed.*, lat, lon, 'POINT (' || cast(cast(lon AS DECIMAL(9,6)) AS VARCHAR)
        || ' ' || cast(cast(lat AS DECIMAL(9,6)) AS VARCHAR) || ')' AS shape
    FROM addressed LEFT JOIN located ON k = nullif(trim(regexp_replace(
        upper(street_address), '[^A-Z0-9]+', ' ', 'g')), '')
)
"""
QUERY_FIELDS = ("street_address",)


def q_extract_table(run: Run) -> DataFrame:
    return extract_table(run.spark, run.mount("sales", "orders"), CatalogSource())


def _land_conversations(run: Run) -> DataFrame:
    turns = run.table("conversations").select("conv_id", "turn", "role", "text")
    land_records(turns, f"{run.root}/pages")
    return turns


def q_extract_records(run: Run) -> DataFrame:
    turns = _land_conversations(run)
    return extract_records(run.spark, f"{run.root}/pages", turns.schema)


def q_stage_roundtrip(run: Run) -> DataFrame:
    return run.round_trip("documents")


def q_stage_roundtrip_events(run: Run) -> DataFrame:
    return run.round_trip("events")


def q_stage_roundtrip_pages(run: Run) -> DataFrame:
    return run.round_trip("pages")


def q_stage_nested(run: Run) -> DataFrame:
    vectors = run.round_trip("embeddings")
    return vectors.select("vec_id", "label", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", "label", "pos", F.col("value").cast("double").alias("value")
    )


def _load_orders(run: Run) -> TypedLoad:
    """Orders as text where pending ones have no price yet, loaded with typed columns."""
    orders = run.table("orders")
    spec = TableSpec("sales", "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    texts = {
        "o_totalprice": price,
        "o_orderdate": F.date_format("o_orderdate", TIMESTAMP_NTZ_PATTERN),
    }
    landed = orders.select(
        *[texts.get(name, F.col(name).cast("string")).alias(name) for name in orders.columns]
    )
    stage_table(landed, spec, run.root)
    return typed_load(run.spark, spec, run.root, orders.schema)


def q_typed_load(run: Run) -> DataFrame:
    return _load_orders(run).rows


def q_typed_load_rejects(run: Run) -> DataFrame:
    return _load_orders(run).rejects.select("raw_record")


def q_typed_load_decimals(run: Run) -> DataFrame:
    """Prices as wide decimals, those of one order status with more digits than fit."""
    price = F.col("o_totalprice").cast("decimal(20,2)").cast("string")
    digits = F.when(F.col("o_orderstatus") == "P", F.lit("00000000015")).otherwise(F.lit("00"))
    key = F.col("o_orderkey").cast("string")
    landed = run.table("orders").select(
        key.alias("k"),
        F.concat(price, digits).alias("price"),
        F.concat(key, F.when(F.col("o_orderstatus") == "O", F.lit(".5")).otherwise(F.lit(".0"))).alias("whole"),
    )
    spec = TableSpec("sales", "prices")
    stage_table(landed, spec, run.root)
    schema = T.StructType.fromDDL("k bigint, price decimal(38,10), whole decimal(38,0)")
    load = typed_load(run.spark, spec, run.root, schema)
    fit = load.rows.select(
        "k", F.col("price").cast("double").alias("price"), F.col("whole").cast("bigint").alias("whole"), F.lit(None).cast("string").alias("raw_record")
    )
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("k", "bigint"), ("price", "double"), ("whole", "bigint"))]
    return fit.unionByName(load.rejects.select(*nothing, "raw_record"))


def q_typed_load_floats(run: Run) -> DataFrame:
    """Prices as doubles and keys as whole numbers, with blanks, zeros at the end, and more digits than there are."""
    price, key = F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.col("o_orderkey").cast("string")
    more = F.when(F.col("o_orderstatus") == "P", F.lit("0000000000000001")).when(F.col("o_orderstatus") == "O", F.lit("0000000000000000 ")).otherwise("")
    landed = run.table("orders").select(F.concat(F.lit(" "), key).alias("k"), F.concat(price, more).alias("price"))
    spec = TableSpec("sales", "floats")
    stage_table(landed, spec, run.root)
    load = typed_load(run.spark, spec, run.root, T.StructType.fromDDL("k bigint, price double"))
    nothing = F.lit(None).cast("string").alias("raw_record")
    bad = load.rejects.select(F.lit(None).cast("bigint").alias("k"), F.lit(None).cast("double").alias("price"), "raw_record")
    return load.rows.select("k", "price", nothing).unionByName(bad)


def q_foreign_files(run: Run) -> DataFrame:
    """Documents as CSV with quoted line breaks, the way other tools stage them, published."""
    docs = run.table("documents")
    spec = TableSpec("texts", "documents", keys=("doc_id",))
    path = f"{run.root}/{spec.staging_path}"
    docs.write.options(header=True, quoteAll=True, escape='"', emptyValue="").csv(path)
    done = publish_staged(run.spark, StagedTable(spec, path), run.root, run.area, fmt=PLAIN_CSV, schema=docs.schema)
    return run.spark.table(done.name)


def q_compose_query_key(run: Run) -> DataFrame:
    return run.table("part").select("p_partkey", compose_query_key(["p_name", "p_brand"]).alias("query_key"))


def q_geocode_enrich(run: Run) -> DataFrame:
    return geocode_enrich(run.addresses(), run.lookup(), QUERY_FIELDS, ("lat", "lon", "shape"))


def q_geocode_enrich_shuffled(run: Run) -> DataFrame:
    """The same result by the join for references too large to broadcast."""
    return geocode_enrich(
        run.addresses(), run.lookup(), QUERY_FIELDS, ("lat", "lon", "shape"),
        broadcast_bytes=0, heavy_rows=2,
    )


def q_refresh_geocoded_shuffled(run: Run) -> DataFrame:
    """A whole run whose reference is beyond the broadcast bound; nothing else is asked for."""
    done = refresh_geocoded(
        run.spark, TableSpec("people", "customer"), TableSpec("people", "located"), run.addresses(),
        run.lookup(), QUERY_FIELDS, ("lat", "lon", "shape"), run.root, run.area, broadcast_bytes=0,
    )
    return run.spark.table(done.name)


def q_select_location_fields(run: Run) -> DataFrame:
    rows = run.addresses()
    found = attach_location(rows, run.lookup(), QUERY_FIELDS, ("lat", "lon", "shape"))
    return select_location_fields(found, ["c_custkey", "street_address"], ["shape", "lat"])


def q_remove_fields(run: Run) -> DataFrame:
    located = geocode_enrich(run.addresses(), run.lookup(), QUERY_FIELDS, ("lat", "lon"))
    return remove_fields(located, ["street_address", "c_acctbal"])


def q_spell_digits(run: Run) -> DataFrame:
    name = F.col("c_custkey").cast("string")
    return run.table("customer").select("c_custkey", spell_digits(name).alias("spelled"))


def q_load_table(run: Run) -> DataFrame:
    digits = "".join(d for d in str(uuid.uuid4().int) if d != "0")[:12]
    spec = TableSpec(digits, "supplier")
    run.spark.sql(
        f"CREATE DATABASE {quote(spec.warehouse_schema)} LOCATION '{run.root}/warehouse'"
    )
    staged = stage_table(run.table("supplier"), spec, run.root)
    return run.spark.table(load_staged(run.spark, staged, run.root))


def q_publish_table(run: Run) -> DataFrame:
    """Two refreshes; the second has another schema and replaces the first."""
    spec = TableSpec("sales", "orders", readers=READERS)
    orders = run.table("orders")
    publish_table(orders, spec, run.area)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("total_cents")
    return run.spark.table(
        publish_table(orders.select("o_orderkey", "o_orderstatus", cents), spec, run.area)
    )


def _publish_lineitem(run: Run) -> str:
    keyed = TableSpec("sales", "lineitem", readers=READERS, keys=("l_partkey", "l_orderkey"))
    return publish_table(run.table("lineitem"), keyed, run.area)


def q_publish_keyed(run: Run) -> DataFrame:
    return run.spark.table(_publish_lineitem(run))


def q_publish_keyed_lookup(run: Run) -> DataFrame:
    name = _publish_lineitem(run)
    by_part = lookup(run.spark, name, {"l_partkey": 77}).withColumn("looked_up", F.lit("l_partkey"))
    by_order = lookup(run.spark, name, {"l_orderkey": 77}).withColumn("looked_up", F.lit("l_orderkey"))
    return by_part.unionByName(by_order)


def _upper(name: str) -> Column:
    return F.col(name).alias(name.upper())


def q_publish_keyed_upper(run: Run) -> DataFrame:
    """A source that names its columns in upper case, keys as the configs spell them."""
    orders = run.table("orders").select(*map(_upper, ("o_custkey", "o_orderkey", "o_totalprice")))
    spec = TableSpec("sales", "orders", readers=READERS, keys=("o_custkey", "o_orderkey"))
    staged = stage_table(orders, spec, run.root)
    name = publish_staged(run.spark, staged, run.root, run.area).name
    return lookup(run.spark, name, {"o_custkey": 77}).unionByName(lookup(run.spark, name, {"O_ORDERKEY": 77}))


def q_publish_keyed_lookup_double(run: Run) -> DataFrame:
    """Lines by discount, where no discount is written as minus zero."""
    discount = F.when(F.col("l_discount") == 0, F.lit(-0.0)).otherwise(F.col("l_discount"))
    lines = run.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", discount.alias("l_discount"))
    name = publish_table(lines, TableSpec("sales", "discounts", keys=("l_partkey", "l_discount")), run.area)
    found = lookup(run.spark, name, {"l_discount": 0.0}).unionByName(lookup(run.spark, name, {"l_discount": 0.05}))
    return found.withColumn("l_discount", F.col("l_discount") + 0.0)


def q_publish_environments(run: Run) -> DataFrame:
    """Parts from a test source without prices and from the production source."""
    part = run.table("part")
    sources = [
        (TableSpec("store", "part", environment=TEST), part.withColumn("p_retailprice", F.lit(None).cast("double"))),
        (TableSpec("store", "part", environment=PRODUCTION), part),
    ]
    areas = {env: ServingArea(f"{run.root}/served-{env}", f"{run.mark}_{env}_") for env in (TEST, PRODUCTION)}
    served = publish_environments(run.spark, sources, run.root, areas)
    test, production = (
        run.spark.table(served[env].name).withColumn("environment", F.lit(env))
        for env in (TEST, PRODUCTION)
    )
    return test.unionByName(production)


def q_refresh_table(run: Run) -> DataFrame:
    mounted = run.mount("sales", "orders")
    spec = TableSpec(mounted.schema, "orders", readers=READERS, keys=("o_custkey", "o_orderkey"))
    return run.spark.table(
        refresh_table(run.spark, spec, CatalogSource(), run.root, run.area).name
    )


def q_refresh_table_diverted(run: Run) -> DataFrame:
    """A run with misfits, then a clean one: the table, and what the reject folder has after each."""
    spec, orders = TableSpec("sales", "orders", keys=("o_orderkey",)), run.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    texts = orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")))
    staged = stage_table(texts, spec, run.root)
    write_sidecar(run.spark, orders.schema, spec, run.root)
    bad = publish_staged(run.spark, staged, run.root, run.area, DIVERT)
    clean = publish_staged(run.spark, stage_table(orders.where("o_orderstatus <> 'P'"), spec, run.root), run.root, run.area, DIVERT)
    counts = F.lit(bad.rejects).cast("bigint").alias("first_rejects"), F.lit(clean.rejects).cast("bigint").alias("later_rejects")
    return run.spark.table(clean.name).select("*", *counts)


def q_refresh_records(run: Run) -> DataFrame:
    turns = _land_conversations(run)
    spec = TableSpec("talks", "turns", readers=READERS, environment=TEST, object_id=1)
    pages = f"{run.root}/pages"
    return run.spark.table(
        refresh_records(run.spark, spec, pages, run.root, run.area, turns.schema).name
    )


def q_refresh_geocoded(run: Run) -> DataFrame:
    """Pages to records, staged, located, staged again, published."""
    addresses = run.addresses()
    land_records(addresses, f"{run.root}/pages", values_in="fields")
    rows = extract_records(run.spark, f"{run.root}/pages", addresses.schema, "fields")
    refreshed = refresh_geocoded(
        run.spark,
        TableSpec("people", "customer"),
        TableSpec("people", "located_customer", readers=READERS),
        rows,
        run.lookup(),
        QUERY_FIELDS,
        ("lat", "lon", "shape"),
        run.root,
        run.area,
        removed=("c_acctbal",),
    )
    return run.spark.table(refreshed.name)


KEY_SQL = "nullif(trim(regexp_replace(upper(concat_ws(' ', p_name, p_brand)), '[^A-Z0-9]+', ' ', 'g')), '')"

# Each query with the SQL that must give the same rows.
CHECKS: dict[str, tuple[Callable[[Run], DataFrame], str]] = {
    "extract_table": (q_extract_table, "SELECT * FROM orders"),
    "extract_records": (q_extract_records, "SELECT conv_id, turn, role, text FROM conversations"),
    "stage_roundtrip": (q_stage_roundtrip, "SELECT * FROM documents"),
    "stage_roundtrip_events": (q_stage_roundtrip_events, "SELECT * FROM events"),
    "stage_roundtrip_pages": (q_stage_roundtrip_pages, "SELECT * FROM pages"),
    "stage_nested": (
        q_stage_nested,
        """SELECT vec_id, label, cast(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
               cast(unnest(embedding) AS DOUBLE) AS value FROM embeddings""",
    ),
    "typed_load": (q_typed_load, "SELECT * FROM orders WHERE o_orderstatus <> 'P'"),
    "typed_load_rejects": (
        q_typed_load_rejects,
        """SELECT o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',n/a,'
               || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || ',' || o_orderpriority AS raw_record
           FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "typed_load_decimals": (
        q_typed_load_decimals,
        """WITH p AS (SELECT *, cast(o_totalprice AS DECIMAL(20,2)) AS price FROM orders)
           SELECT o_orderkey AS k, cast(price AS DOUBLE) AS price, o_orderkey AS whole, NULL::VARCHAR AS raw_record
           FROM p WHERE o_orderstatus = 'F'
           UNION ALL
           SELECT NULL, NULL, NULL, o_orderkey || ',' || price
               || CASE WHEN o_orderstatus = 'P' THEN '00000000015' ELSE '00' END || ',' || o_orderkey
               || CASE WHEN o_orderstatus = 'O' THEN '.5' ELSE '.0' END
           FROM p WHERE o_orderstatus <> 'F'""",
    ),
    "typed_load_floats": (
        q_typed_load_floats,
        """SELECT o_orderkey AS k, o_totalprice AS price, NULL::VARCHAR AS raw_record FROM orders WHERE o_orderstatus <> 'P'
           UNION ALL
           SELECT NULL, NULL, ' ' || o_orderkey || ',' || cast(o_totalprice AS DECIMAL(12,2)) || '0000000000000001'
           FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "foreign_files": (q_foreign_files, "SELECT * FROM documents"),
    "compose_query_key": (q_compose_query_key, f"SELECT p_partkey, {KEY_SQL} AS query_key FROM part"),
    "geocode_enrich": (q_geocode_enrich, LOCATED_SQL + "SELECT * FROM enriched"),
    "geocode_enrich_shuffled": (q_geocode_enrich_shuffled, LOCATED_SQL + "SELECT * FROM enriched"),
    "select_location_fields": (
        q_select_location_fields,
        LOCATED_SQL + "SELECT c_custkey, street_address, shape, lat FROM enriched",
    ),
    "remove_fields": (
        q_remove_fields,
        LOCATED_SQL + "SELECT * EXCLUDE (street_address, c_acctbal, shape) FROM enriched",
    ),
    "spell_digits": (
        q_spell_digits,
        """WITH named AS (SELECT c_custkey, cast(c_custkey AS VARCHAR) AS k FROM customer)
           SELECT c_custkey, CASE
               WHEN regexp_full_match(k, '[1-9]+') THEN array_to_string(list_transform(
                   string_split(k, ''), lambda c: list_extract(['one', 'two', 'three', 'four', 'five',
                   'six', 'seven', 'eight', 'nine'], cast(c AS INTEGER))), '')
               WHEN regexp_full_match(k, '[0-9]+') THEN NULL ELSE k END AS spelled
           FROM named""",
    ),
    "load_table": (q_load_table, "SELECT * FROM supplier"),
    "publish_table": (
        q_publish_table,
        """SELECT o_orderkey, o_orderstatus, cast(round(o_totalprice * 100) AS BIGINT) AS total_cents
           FROM orders""",
    ),
    "publish_keyed": (q_publish_keyed, "SELECT * FROM lineitem"),
    "publish_keyed_lookup": (
        q_publish_keyed_lookup,
        """SELECT *, 'l_partkey' AS looked_up FROM lineitem WHERE l_partkey = 77
           UNION ALL
           SELECT *, 'l_orderkey' AS looked_up FROM lineitem WHERE l_orderkey = 77""",
    ),
    "publish_keyed_upper": (
        q_publish_keyed_upper,
        """SELECT o_custkey AS "O_CUSTKEY", o_orderkey AS "O_ORDERKEY", o_totalprice AS "O_TOTALPRICE" FROM orders WHERE o_custkey = 77
           UNION ALL
           SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 77""",
    ),
    "publish_keyed_lookup_double": (
        q_publish_keyed_lookup_double,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem
           WHERE l_discount = 0 OR l_discount = 0.05::DOUBLE""",
    ),
    "publish_environments": (
        q_publish_environments,
        """SELECT * REPLACE (NULL::DOUBLE AS p_retailprice), 'test' AS environment FROM part
           UNION ALL
           SELECT *, 'production' AS environment FROM part""",
    ),
    "refresh_table": (q_refresh_table, "SELECT * FROM orders"),
    "refresh_table_diverted": (
        q_refresh_table_diverted,
        """SELECT o_orderkey, o_orderstatus, o_totalprice,
               (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS first_rejects, 0::BIGINT AS later_rejects
           FROM orders WHERE o_orderstatus <> 'P'""",
    ),
    "refresh_geocoded_shuffled": (q_refresh_geocoded_shuffled, LOCATED_SQL + "SELECT * FROM enriched"),
    "refresh_records": (q_refresh_records, "SELECT conv_id, turn, role, text FROM conversations"),
    "refresh_geocoded": (
        q_refresh_geocoded,
        LOCATED_SQL + "SELECT * EXCLUDE (c_acctbal) FROM enriched",
    ),
    **checks_keyed.CHECKS,
    **checks_content.CHECKS,
}


def run_check(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return CHECKS[key][0](Run.start(spark, sf_dir.rstrip("/"), key))
