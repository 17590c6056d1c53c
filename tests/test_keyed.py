"""Lookups by every key: the curve layout, the index of files, times, ranges."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.quantiles import quantile_bounds, rank_steps, reaches
from quayload.sinks import file_index
from quayload.sinks.curve import bits_for, interleaved
from quayload.sinks.file_index import files_named, index_version, lookup_indexed
from quayload.sinks.publish import (
    CURVE,
    Range,
    ServingArea,
    activate,
    discard,
    lookup,
    old_versions,
    publish_table,
    write_version,
)
from quayload.spec import TableSpec

LINEITEM = "/root/testdata/sf0.1/lineitem.parquet"


@pytest.fixture
def area(tmp_path):
    return ServingArea(str(tmp_path / "served"), f"t{uuid.uuid4().hex[:8]}_")


def same(found, expected):
    return not found.exceptAll(expected).take(1) and not expected.exceptAll(found).take(1)


def plain_path(uri):
    return uri.replace("file://", "file:")


def rows_scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_bounds_are_equi_depth(spark):
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") * F.col("id")).alias("skewed"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("hot"),
        F.concat(F.lit("http://www.example.org/"), F.hex(F.xxhash64("id"))).alias("url"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("half"),
        F.date_add(F.lit(date(2000, 1, 1)), (F.col("id") % 1000).cast("int")).alias("day"),
        F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") < 15_000, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("nan"),
    )
    parts = 16
    bounds = quantile_bounds(df, {name: parts for name in df.columns})
    assert bounds["nothing"] == [] and len(bounds["skewed"]) == len(bounds["url"]) == parts - 1
    names = {name: f"rank_{i}" for i, name in enumerate(df.columns)}
    ranked = rank_steps(df, bounds, names).cache()
    for name in ("skewed", "url", "day", "half"):
        sizes = [r["count"] for r in ranked.where(F.col(name).isNotNull()).groupBy(names[name]).count().collect()]
        # a part of text can get half of its neighbour's
        most, fewest = (2, parts - 2) if name in ("url", "half") else (1.3, parts)
        assert fewest <= len(sizes) <= parts and max(sizes) < most * sum(sizes) / parts, name
    # ranks follow the order, and nulls come first
    for name, rank in names.items():
        pairs = [tuple(r) for r in ranked.select(name, rank).distinct().orderBy(F.col(name).asc_nulls_first()).collect()]
        assert [r for _, r in pairs] == sorted(r for _, r in pairs)
        assert pairs[0][0] is not None or pairs[0][1] == 0
    hot = ranked.groupBy(names["hot"]).count().collect()
    assert max(r["count"] for r in hot) < n / 3 + 2 * n / parts


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        (T.LongType(), [-(1 << 63), -5, 0, 7, (1 << 53) + 1, (1 << 63) - 1]),
        (T.IntegerType(), [-(1 << 31), 0, (1 << 31) - 1]),
        (T.ByteType(), [-128, 127]),
        (T.DoubleType(), [-1e300, -0.5, 0.0, 3.25, 1e300]),
        (T.DecimalType(12, 4), [Decimal("-99999999.9999"), Decimal("0.0001"), Decimal("12345678.9")]),
        (T.DateType(), [date(1, 1, 1), date(1969, 12, 31), date(9999, 12, 31)]),
        (T.TimestampNTZType(), [datetime(1582, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2040, 5, 6, 7, 8, 9, 1)]),
        (T.TimestampType(), [datetime(1970, 1, 1, tzinfo=timezone.utc), datetime(2040, 5, 6, 7, 8, 9, 1, tzinfo=timezone.utc)]),
        (T.StringType(), ["", "a", "é", "日本語", "\U0010ffff", "zz" * 9]),
        (T.BinaryType(), [b"", b"\xff\xff"]),
    ],
)
def test_bounds_reach_all_values(spark, kind, values):
    """A bound turned into a value of the column's type never leaves out a row of its side."""
    from quayload.functions.quantiles import scale

    field = T.StructField("v", kind)
    df = spark.createDataFrame([(v,) for v in values], T.StructType([field]))
    scaled = [bytes(r[0]) if isinstance(r[0], (bytes, bytearray)) else r[0] for r in df.select(scale(field)).collect()]
    plain = [v.encode() if isinstance(v, str) else v for v in values]
    for bound in [*scaled, *([b[:1] for b in scaled if b] if isinstance(scaled[0], bytes) else [])]:
        low, high = reaches(field, bound), reaches(field, bound, above=True)
        low, high = (x.encode() if isinstance(x, str) else x for x in (low, high))
        for value, at in zip(plain, scaled):
            assert low is None or at < bound or value >= low
            assert high is None or at >= bound or value <= high


def test_codes_interleave(spark):
    (row,) = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("code")).collect()
    assert row.code == 0b100111
    assert bits_for(0, 2) == 1 and bits_for(10**13, 2) == 12 and bits_for(10**30, 9) == 7


def test_ranges_of_every_key_skip_most_of_a_table_along_the_curve(spark, area):
    lines = spark.read.parquet(LINEITEM)
    total = lines.count()
    spec = TableSpec("s", "curve", keys=("l_partkey", "l_orderkey"))
    name = publish_table(lines, spec, area, layout=CURVE)
    assert spark.table(name).columns == lines.columns and spark.table(name).count() == total
    asked = [
        {"l_orderkey": Range(70_000, 70_200)},
        {"l_orderkey": 70_000},
        {"l_partkey": Range(70, 77)},
        {"l_orderkey": Range(70_000, 80_000), "l_partkey": Range(0, 1000)},
    ]
    for values in asked:
        found = lookup(spark, name, values)
        plain = lines
        for key, value in values.items():
            low, high = (value.low, value.high) if isinstance(value, Range) else (value, value)
            plain = plain.where(F.col(key).between(low, high))
        assert same(found, plain)
        assert rows_scanned(found) <= total / 8, values


def test_the_curve_takes_any_keys(spark, area):
    rows = [
        (None, "é", datetime(2020, 1, 1), Decimal("1.5"), True),
        (1.0, None, None, None, None),
        (float("nan"), "", datetime(1, 1, 1), Decimal("-9.9"), False),
        (-0.0, "a" * 100, datetime(9999, 1, 1), Decimal("0.0"), True),
    ]
    schema = "f double, s string, t timestamp_ntz, d decimal(5,1), b boolean"
    df = spark.createDataFrame([row for row in rows for _ in range(50)], schema)
    name = publish_table(df, TableSpec("s", "odd", keys=("f", "s", "t", "d", "b")), area, layout=CURVE)
    assert same(spark.table(name), df)
    for values in ({"f": None}, {"s": ""}, {"t": Range(high=datetime(2020, 1, 1))}, {"d": Decimal("0")}, {"b": True}):
        assert lookup(spark, name, values).count() in (50, 100)
    empty = publish_table(df.limit(0), TableSpec("s", "none", keys=("f", "s")), area, layout=CURVE)
    assert spark.table(empty).count() == 0
    with pytest.raises(ValueError, match="layout"):
        publish_table(df, TableSpec("s", "x", keys=("f",)), area, layout="heap")


def test_one_hot_code_is_cut_up(spark):
    from quayload.sinks.curve import curve_bounds, layout_by_curve

    df = spark.range(30_000, numPartitions=64).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("a"))
    df = df.withColumn("b", F.col("a"))
    laid = layout_by_curve(df, ["a", "b"], curve_bounds(df, ["a", "b"], 30_000), 30_000, 16)
    sizes = [row["count"] for row in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2.5 * 30_000 / 16


def test_times_are_compared_as_written(spark, area):
    """The tests' session and process are in different zones; one more session is in a third."""
    noon = datetime(2020, 6, 1, 12, 0, 0, 5)
    moment = noon.replace(tzinfo=timezone.utc)
    df = spark.createDataFrame([(noon, moment, noon.date()), (noon + timedelta(hours=4), moment + timedelta(hours=4), noon.date())], "n timestamp_ntz, m timestamp, d date")
    name = publish_table(df, TableSpec("s", "times", keys=("n", "m", "d")), area)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    eastern = timezone(timedelta(hours=-5))
    for session in (spark, other):
        assert lookup(session, name, {"n": noon}).count() == 1
        assert lookup(session, name, {"n": Range(noon, noon + timedelta(hours=3))}).count() == 1
        assert lookup(session, name, {"m": moment}).count() == 1
        assert lookup(session, name, {"m": moment.astimezone(eastern), "d": noon.date()}).count() == 1
        assert lookup(session, name, {"m": Range(low=moment + timedelta(microseconds=1))}).count() == 1
        for wrong in ({"n": moment}, {"m": noon}, {"d": noon}, {"n": Range(high=moment)}):
            with pytest.raises(TypeError):
                lookup(session, name, wrong)
    with pytest.raises(ValueError, match="bound"):
        Range()


def test_ranges_of_floats(spark, area):
    df = spark.createDataFrame([(0.1,), (0.5,), (-0.0,), (float("nan"),), (None,)], "f float")
    name = publish_table(df, TableSpec("s", "floats", keys=("f",)), area)
    # 0.1 as a float is a little above 0.1 as a double
    assert lookup(spark, name, {"f": Range(0.1, 0.5)}).count() == 2
    assert lookup(spark, name, {"f": Range(high=0.1)}).count() == 1
    assert lookup(spark, name, {"f": Range(0.0, 0.0)}).count() == 1


def test_lookups_open_only_files_that_the_index_names(spark, area):
    lines = spark.read.parquet(LINEITEM)
    spec = TableSpec("s", "indexed", keys=("l_partkey", "l_orderkey", "l_discount", "l_returnflag"))
    version = index_version(spark, write_version(lines, spec, area, partitions=40))
    name = activate(spark, version)
    files = set(map(plain_path, spark.table(version.name).inputFiles()))
    assert len(files) == 40
    for values in (
        {"l_orderkey": 77},
        {"l_orderkey": 77, "l_partkey": Range(high=10_000)},
        {"l_partkey": Range(70, 77)},
        {"l_partkey": 77},
        {"l_discount": 0.05, "l_partkey": 78},
        {"l_returnflag": "R"},
        {"l_orderkey": -3},
        {"l_returnflag": None},
    ):
        plain = lines
        for key, value in values.items():
            if isinstance(value, Range):
                plain = plain.where(F.col(key).between(-1 if value.low is None else value.low, value.high))
            else:
                plain = plain.where(F.col(key).eqNullSafe(F.lit(value)))
        found = lookup_indexed(spark, name, values)
        named = {plain_path(row.path) for row in files_named(spark, name, values).collect()}
        opened = set(map(plain_path, found.inputFiles())) if named else set()
        assert same(found, plain) and opened == named <= files
        holding = plain.count() and {
            plain_path(row[0]) for row in lookup(spark, name, values).select(F.input_file_name()).distinct().collect()
        }
        assert not holding or holding <= named
        if list(values) == ["l_orderkey"]:
            assert len(named) <= 12  # four lines of one order, and few files that share its slot
        if list(values) == ["l_partkey"]:
            assert len(named) <= 3


def test_indexed_lookups_of_odd_tables(spark, area):
    rows = [(None, "x", -0.0), (1, None, float("nan")), (2, "y", 0.0), (2, "é z%20", None)]
    df = spark.createDataFrame(rows, "`odd id` long, s string, f double").repartition(4)
    name = activate(spark, index_version(spark, write_version(df, TableSpec("s", "odd", keys=("odd id", "s", "f")), area)))
    for values, count in (({"odd id": 2}, 2), ({"s": None}, 1), ({"f": 0.0}, 2), ({"s": "é z%20", "ODD ID": 2}, 1), ({"f": None}, 1), ({"f": float("nan")}, 1)):
        assert lookup_indexed(spark, name, values).count() == count, values
    nothing = activate(spark, index_version(spark, write_version(df.limit(0), TableSpec("s", "none", keys=("s",)), area)))
    assert lookup_indexed(spark, nothing, {"s": "x"}).count() == 0
    nulls = activate(spark, index_version(spark, write_version(df.where("s IS NULL"), TableSpec("s", "nulls", keys=("s",)), area)))
    assert lookup_indexed(spark, nulls, {"s": "x"}).count() == 0 and lookup_indexed(spark, nulls, {"s": None}).count() == 1
    plain = publish_table(df, TableSpec("s", "plain", keys=("s",)), area)
    assert files_named(spark, plain, {"s": "y"}) is None
    assert lookup_indexed(spark, plain, {"s": "y"}).count() == 1
    with pytest.raises(ValueError, match="unknown key"):
        lookup_indexed(spark, name, {"nope": 1})


def test_an_index_has_a_row_for_each_slot_of_a_file(spark, area):
    """No row of the index grows with the number of files, and none is there twice."""
    df = spark.range(4000).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 2 == 0, "x y%20").alias("s"))
    version = index_version(spark, write_version(df, TableSpec("s", "rows", keys=("id", "k", "s")), area, partitions=8))
    slots, files = (spark.table(version.part(part)) for part in (file_index.SLOTS, file_index.FILES))
    assert slots.columns == ["key", "slot", "file", "slots"] and files.count() == 8
    assert slots.count() == slots.select("key", "slot", "file").distinct().count()
    assert slots.join(files, "file", "left_anti").count() == 0
    sizes = {r.key: r["count"] for r in slots.groupBy("key").count().collect()}
    assert 2000 < sizes[0] <= 4000 and sizes[1] in (16, 24) and sizes[2] == 8
    name = activate(spark, version)
    assert files_named(spark, name, {"k": 1}).count() == 8 and lookup_indexed(spark, name, {"s": "x y%20", "id": 8}).count() == 1


def test_an_index_of_an_earlier_release_is_read(spark, area):
    version = index_version(spark, write_version(spark.range(300), TableSpec("s", "earlier", keys=("id",)), area, partitions=4))
    slots = spark.table(version.part(file_index.SLOTS))
    merged = slots.groupBy("key", "slot", "slots").agg(F.array_sort(F.collect_list("file")).alias("files"))
    earlier = spark.createDataFrame(merged.collect(), merged.schema)
    spark.sql(f"DROP TABLE {version.part(file_index.SLOTS)}")
    earlier.write.format("parquet").saveAsTable(version.part(file_index.SLOTS))
    name = activate(spark, version)
    assert [lookup_indexed(spark, name, {"id": i}).count() for i in (7, 299, 300)] == [1, 1, 0]


def test_an_answer_from_too_many_files_reads_the_table(spark, area):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("k"))
    name = activate(spark, index_version(spark, write_version(df, TableSpec("s", "many", keys=("id", "k")), area, partitions=8)))
    assert lookup_indexed(spark, name, {"k": 1}, most_files=2).count() == 500


def test_an_index_goes_with_its_version(spark, area):
    spec = TableSpec("s", "t", keys=("id",))
    first = index_version(spark, write_version(spark.range(10), spec, area))
    activate(spark, first)
    name = activate(spark, index_version(spark, write_version(spark.range(20), spec, area)))
    (old,) = old_versions(spark, spec, area)
    assert old.label == first.label
    discard(spark, old)
    assert not [suffix for suffix in ("", *file_index.INDEX_PARTS) if spark.catalog.tableExists(first.part(suffix))]
    assert lookup_indexed(spark, name, {"id": 15}).count() == 1
    # a version without an index is looked up without one
    publish_table(spark.range(30), spec, area)
    assert lookup_indexed(spark, name, {"id": 25}).count() == 1
