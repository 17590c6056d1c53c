from __future__ import annotations

import collections
import re

import pytest
from pyspark.sql import functions as F

from quayload.operators.enrich import (
    FOUND,
    HASH,
    JOIN_KEY,
    KEY,
    SALT,
    SALTS,
    attach_location,
    geocode_enrich,
    heavy_keys,
    prepare_lookup,
    remove_fields,
    select_location_fields,
    spread_keys,
)
from quayload.functions.text import compose_query_key
from quayload.workspace import new_area

FIELDS = ("lat", "lon", "shape")


@pytest.fixture
def reference(spark):
    rows = [
        ("1 Main St", 7, 1.0, -1.0, "late"),
        ("1 MAIN ST.", 3, 2.0, -2.0, "first"),
        ("1  main  st", None, 3.0, -3.0, "no id"),
        ("2 Oak", 5, None, -4.0, None),
        ("only unranked", None, 9.0, -9.0, "kept"),
        ("--", 1, 5.0, -5.0, "no key"),
        (None, 2, 6.0, -6.0, "no key"),
    ]
    return spark.createDataFrame(rows, "address string, id bigint, lat double, lon double, shape string")


@pytest.fixture
def prepared(spark, reference):
    return prepare_lookup(reference, ["address"], FIELDS, "id", new_area(spark, "lookup"))


def normal(text):
    return re.sub("[^A-Z0-9]+", " ", (text or "").upper()).strip() or None


def join_options(spark, shuffled):
    if not shuffled:
        return {}
    return {"broadcast_bytes": 0, "heavy_rows": 2}


def test_lookup_is_unique_and_measured(prepared):
    rows = {row[KEY]: tuple(row)[1:] for row in prepared.table.collect()}
    assert rows == {
        "1 MAIN ST": (2.0, -2.0, "first"),
        "2 OAK": (None, -4.0, None),
        "ONLY UNRANKED": (9.0, -9.0, "kept"),
    }
    assert prepared.rows == 3 and 100 < prepared.bytes < 1000


@pytest.mark.parametrize("shuffled", [False, True])
def test_every_row_once(spark, prepared, shuffled):
    streets = ["1 main st", "1-MAIN-st ", "2 oak", "3 elm", "", "  ", None, "only unranked"]
    df = spark.createDataFrame(list(enumerate(streets)), "id bigint, street string")
    located = geocode_enrich(df, prepared, ["street"], ["shape", "lat"], **join_options(spark, shuffled))
    assert located.columns == ["id", "street", "shape", "lat"]
    assert {row.id: (row.shape, row.lat) for row in located.collect()} == {
        0: ("first", 2.0), 1: ("first", 2.0), 2: (None, None), 3: (None, None),
        4: (None, None), 5: (None, None), 6: (None, None), 7: ("kept", 9.0),
    }
    assert located.count() == len(streets)


@pytest.mark.parametrize("shuffled", [False, True])
def test_empty_sides(spark, reference, prepared, shuffled):
    df = spark.createDataFrame([(1, "1 main st")], "id bigint, street string")
    nothing = prepare_lookup(reference.limit(0), ["address"], FIELDS, "id", new_area(spark, "lookup"))
    assert (nothing.rows, nothing.bytes) == (0, 0)
    options = join_options(spark, shuffled)
    if shuffled:
        options["broadcast_bytes"] = -1
    assert geocode_enrich(df, nothing, ["street"], FIELDS, **options).collect()[0].lat is None
    options = join_options(spark, shuffled)
    assert geocode_enrich(df.limit(0), prepared, ["street"], FIELDS, **options).count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_skewed_input_against_brute_force(spark, shuffled):
    """A third of the rows share one address, a third have none."""
    ids = spark.range(6000, numPartitions=12)
    street = (
        F.when(F.col("id") < 2000, F.lit("1 Hot St"))
        .when(F.col("id") < 4000, F.lit(None))
        .otherwise(F.concat(F.col("id").cast("string"), F.lit(" Cold st")))
    )
    df = ids.orderBy(F.rand(1)).withColumn("street", street)
    reference = spark.range(3000, 9000).select(
        F.when(F.col("id") < 5000, F.lit("1 HOT ST")).otherwise(
            F.concat(F.col("id").cast("string"), F.lit(" COLD ST"))
        ).alias("address"),
        "id",
        (F.col("id") / 7).alias("lat"),
    )
    lookup = prepare_lookup(reference, ["address"], ["lat"], "id", new_area(spark, "lookup"))
    first = {}
    for row in reference.orderBy("id").collect():
        first.setdefault(normal(row.address), row.lat)
    expected = {row.id: first.get(normal(row.street)) for row in df.collect()}
    located = geocode_enrich(df, lookup, ["street"], ["lat"], **join_options(spark, shuffled))
    assert {row.id: row.lat for row in located.collect()} == expected
    assert located.count() == 6000


def test_hot_and_missing_keys_are_spread(spark):
    keys = F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    keyed = spark.range(9000, numPartitions=30).withColumn(KEY, keys)
    heavy = heavy_keys(keyed, new_area(spark, "heavy"), rows=300)
    expected = spark.sql("SELECT xxhash64('HOT') AS h").first().h
    assert [(row[HASH], row[SALTS]) for row in heavy.collect()] == [(expected, 10)]
    assert heavy_keys(keyed, new_area(spark, "heavy"), rows=4000).count() == 0
    # By default a task's share of the rows: 6000 rows with a key, 4 tasks.
    assert [row[SALTS] for row in heavy_keys(keyed, new_area(spark, "heavy")).collect()] == [2]
    spread = spread_keys(keyed, heavy)
    sizes = [row["count"] for row in spread.groupBy(JOIN_KEY, SALT).count().collect()]
    assert sum(sizes) == 9000
    # Three of the 30 input partitions, of 100 hot rows each, share a salt.
    assert max(sizes) == 300


def test_nothing_is_shuffled_by_a_raw_heavy_or_missing_key(spark, prepared, capsys):
    path = new_area(spark, "input")
    spark.range(10).withColumn("street", F.lit("1 main st")).write.parquet(path)
    df = spark.read.parquet(path)
    attach_location(df, prepared, ["street"], FIELDS, broadcast_bytes=0).explain()
    plan = capsys.readouterr().out
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 2 and all(f"{JOIN_KEY}#" in line and f"{SALT}#" in line for line in exchanges)


def test_heavy_keys_with_large_locations(spark):
    df = spark.range(100, numPartitions=4).withColumn("street", F.concat(F.col("id") % 3, F.lit(" st")))
    reference = spark.range(2).select("id", F.concat("id", F.lit(" ST")).alias("a"), F.repeat(F.lit("x"), 999).alias("shape"))
    lookup = prepare_lookup(reference, ["a"], ["shape"], "id", new_area(spark, "lookup"))
    expected = geocode_enrich(df, lookup, ["street"], ["shape"])
    located = geocode_enrich(df, lookup, ["street"], ["shape"], **join_options(spark, True))
    assert located.count() == 100
    assert not located.exceptAll(expected).take(1) and not expected.exceptAll(located).take(1)


def test_plans_shuffle_only_past_the_bound(spark, prepared, capsys):
    path = new_area(spark, "input")
    spark.range(10).withColumn("street", F.lit("1 main st")).write.parquet(path)
    df = spark.read.parquet(path)
    attach_location(df, prepared, ["street"], FIELDS).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    attach_location(df, prepared, ["street"], FIELDS, **join_options(spark, True)).explain()
    assert "SortMergeJoin" in capsys.readouterr().out


def test_unknown_and_clashing_names(spark, reference, prepared):
    df = spark.createDataFrame([(1, "x", 1.0)], "id bigint, street string, lat double")
    for call in (
        lambda: geocode_enrich(df, prepared, ["nope"], ["lon"]),
        lambda: geocode_enrich(df, prepared, ["street"], ["nope"]),
        lambda: geocode_enrich(df, prepared, ["street"], ["lon"], ["nope"]),
        lambda: geocode_enrich(df, prepared, ["street"], ["lat"]),
        lambda: prepare_lookup(reference, ["nope"], FIELDS, "id", "unused"),
        lambda: remove_fields(df, ["id", "nope"]),
    ):
        with pytest.raises(ValueError):
            call()
    assert remove_fields(df, None) is df
    assert remove_fields(df, ["lat"]).columns == ["id", "street"]
    found = attach_location(df, prepared, ["street"], FIELDS)
    assert found.columns == ["id", "street", "lat", FOUND]
    assert select_location_fields(found, ["id"], ["shape", "lon"]).columns == ["id", "shape", "lon"]


def test_keys_agree_with_plain_python(spark):
    texts = ["a", "1 Main St., Apt #5", "\tTabs\n", "ß", "é 1", "日本", None, "..."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] for row in df.select(compose_query_key(["t"])).collect()]
    assert collections.Counter(got) == collections.Counter(map(normal, texts))
