"""Changes loaded into a table in chunks, and splits planned from quantiles."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import quayload.sinks.changes as changes
from quayload.sinks.changes import ChangesLost, drop_unused_chunks, load_changes, load_chunked, lookup_chunk, shown_version
from quayload.sinks.publish import Range, ServingArea
from quayload.sources.relational import CatalogSource, PredicateSplit, plan_split
from quayload.spec import TableSpec

LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"


@pytest.fixture
def area(tmp_path):
    return ServingArea(str(tmp_path / "served"), f"t{uuid.uuid4().hex[:8]}_")


def same(found, expected):
    return not found.exceptAll(expected).take(1) and not expected.exceptAll(found).take(1)


def files(spark, name):
    return {"/".join(path.split("/")[-2:]) for path in spark.table(name).inputFiles()}


def test_only_files_with_changed_keys_are_rewritten(spark, area):
    spec = TableSpec("s", "t", readers=("r",), keys=("id",))
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.lit("a").alias("w"))
    name = load_chunked(rows, spec, area, 20)
    assert spark.table(name).columns == ["id", "v", "w"] and same(spark.table(name), rows)
    before = files(spark, name)
    old = spark.table(name)
    changed = spark.createDataFrame([("b", 77, 1), ("b", 9001, 2)], "W string, id long, v long")
    gone = spark.createDataFrame([(78,), (99_999,)], "id long")
    assert load_changes(spark, spec, area, changed, gone) == name
    expected = rows.where("id NOT IN (77, 78)").unionByName(changed.select("id", "v", F.col("W").alias("w")))
    assert same(spark.table(name), expected)
    after = files(spark, name)
    assert len(before & after) >= len(before) - 4 and before - after and after - before
    # the rest kept their names, and a reader of the old version still has it
    assert same(old, rows)
    properties = dict(spark.sql(f"SHOW TBLPROPERTIES {name}").collect())
    assert properties["readers"] == "r" and properties["keys"] == "id"


def test_changes_equal_a_full_load(spark, area):
    spec = TableSpec("s", "t", keys=("a", "b"))
    rows = [(i % 9 if i % 10 else None, str(i % 4) if i % 3 else None, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, x double")
    name = load_chunked(df, spec, area, 6)
    table = {}
    for a, b, x in rows:
        table.setdefault((a, b), []).append(x)
    for turn in range(3):
        new = [(turn, str(turn), 1000.0), (turn, str(turn), 1000.0), (None, None, 2000.0 + turn), (50 + turn, "new", float("nan"))]
        lost = [(turn + 3, None), (turn, "3")]
        load_changes(spark, spec, area, spark.createDataFrame(new, df.schema), spark.createDataFrame(lost, "a int, b string"))
        for key in lost + [row[:2] for row in new]:
            table.pop(key, None)
        for a, b, x in new:
            table.setdefault((a, b), []).append(x)
        flat = [(*key, x) for key, values in table.items() for x in values]
        assert same(spark.table(name), spark.createDataFrame(flat, df.schema))
    label = shown_version(spark, spec, area).label
    load_changes(spark, spec, area, df.limit(0))
    assert shown_version(spark, spec, area).label == label
    for key in ({"a": None, "b": None}, {"a": 50, "B": "new"}, {"a": 1, "b": "1"}):
        a, b = key.get("a"), key.get("b", key.get("B"))
        assert lookup_chunk(spark, name, key).count() == len(table.get((a, b), []))
    assert lookup_chunk(spark, name, {"a": Range(50, 60)}).count() == 3


def test_a_lookup_by_all_keys_opens_one_chunk(spark, area):
    spec = TableSpec("s", "t", keys=("id",))
    name = load_chunked(spark.range(2000), spec, area, 10)
    found = lookup_chunk(spark, name, {"id": 5})
    assert found.collect()[0].id == 5 and found.columns == ["id"]
    scanned = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
    assert scanned.apply("numFiles").value() <= 4 and scanned.apply("numPartitions").value() == 1


def test_a_run_cut_short_changes_nothing(spark, area, monkeypatch):
    spec = TableSpec("s", "t", keys=("id",))
    name = load_chunked(spark.range(100), spec, area, 4)
    before = files(spark, name)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        load_changes(spark, spec, area, broken)

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(changes, "activate", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            load_changes(spark, spec, area, spark.range(200, 210))
    assert files(spark, name) == before and spark.table(name).count() == 100
    load_changes(spark, spec, area, spark.range(200, 210))
    assert spark.table(name).count() == 110


def test_lost_changes_are_noticed(spark, area, monkeypatch):
    spec = TableSpec("s", "t", keys=("id",))
    name = load_chunked(spark.range(100), spec, area, 4)
    monkeypatch.setattr(changes, "_write_chunks", lambda rows, folder: {0: 4})
    with pytest.raises(ChangesLost):
        load_changes(spark, spec, area, spark.range(3))
    monkeypatch.undo()
    assert spark.table(name).count() == 100


def test_unused_chunks_go(spark, area):
    import os

    spec = TableSpec("s", "t", keys=("id",))
    name = load_chunked(spark.range(1000), spec, area, 5)
    load_changes(spark, spec, area, spark.range(1))
    load_changes(spark, spec, area, spark.range(1))
    unused = drop_unused_chunks(spark, spec, area)
    assert len(unused) == 2 and not any(os.path.exists(path.removeprefix("file:")) for path in unused)
    assert spark.table(name).count() == 1000
    assert drop_unused_chunks(spark, spec, area) == []
    load_changes(spark, spec, area, spark.range(1000, 1001))
    assert spark.table(name).count() == 1001


def test_a_hot_key_and_an_empty_table(spark, area):
    spec = TableSpec("s", "t", keys=("k",))
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    name = load_chunked(df, spec, area, 8)
    load_changes(spark, spec, area, spark.createDataFrame([(1, -1)], "k long, id long"))
    # the thousand rows of the hot key, and the row that had it as its id, are one now
    assert spark.table(name).where("k = 1").count() == 1 and spark.table(name).count() == 2000
    empty = TableSpec("s", "none", keys=("k",))
    name = load_chunked(df.limit(0), empty, area, 3)
    assert spark.table(name).count() == 0
    load_changes(spark, empty, area, df)
    assert spark.table(name).count() == 3000
    load_changes(spark, empty, area, df.limit(0), df.select("k"))
    assert spark.table(name).count() == 0
    with pytest.raises(ValueError, match="keys"):
        load_chunked(df, TableSpec("s", "x"), area, 3)


def sizes(df, split):
    counts = [df.where(F.expr(p)).count() for p in split.predicates]
    assert sum(counts) == df.count()
    # exactly one predicate holds for each row
    held = sum(F.when(F.expr(p), 1).otherwise(0) for p in split.predicates)
    assert df.where(held != 1).count() == 0
    return counts


def test_splits_of_skewed_keys_are_even(spark):
    lines = spark.read.parquet(LINEITEM)
    skewed = lines.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_partkey") * F.col("l_partkey")))
    parts = 16
    counts = sizes(skewed, plan_split(skewed, ["k", "l_orderkey"], parts))
    assert max(counts) <= 2 * skewed.count() / parts and len(counts) <= 2 * parts
    # by one column only, the hot value stays whole and the others are even
    alone = sorted(sizes(skewed, plan_split(skewed, ["k"], parts)))
    assert alone[-1] > skewed.count() / 3.1 and alone[-2] <= 2 * skewed.count() / parts
    by_time = sizes(lines, plan_split(lines, ["l_shipdate"], parts))
    assert max(by_time) <= 2 * lines.count() / parts and len(by_time) == parts


def test_splits_of_odd_columns(spark):
    rows = [(None, None, None, None), (1, Decimal("1.5"), date(2020, 1, 1), datetime(2020, 1, 1, 2, 3, 4, 5)), (-5, Decimal("-2"), date(1, 1, 1), datetime(1900, 1, 1))]
    df = spark.createDataFrame(rows * 20, "i int, d decimal(9,2), day date, t timestamp_ntz")
    for name in df.columns:
        sizes(df, plan_split(df, [name], 6))
    sizes(df, plan_split(df, ["i", "d", "day", "t"], 6))
    for empty in (df.limit(0), df.where("i IS NULL")):
        assert plan_split(empty, ["i", "t"], 6) == PredicateSplit(("1 = 1",))
    assert plan_split(df, ["i"], 1) == PredicateSplit(("1 = 1",))
    text = df.withColumn("s", F.lit("x"))
    for columns, parts in ((["s"], 2), ([], 2), (["i"], 0), (["nope"], 2)):
        with pytest.raises(ValueError):
            plan_split(text, columns, parts)
    with pytest.raises(ValueError, match="catalog"):
        CatalogSource().read(spark, TableSpec("a", "b"), plan_split(df, ["i"], 3))
