from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from quayload.sinks import warehouse
from quayload.sinks.publish import (
    ServingArea,
    activate,
    discard,
    layout_by_keys,
    lookup,
    old_versions,
    publish_table,
    write_version,
)
from quayload.sinks.warehouse import IncompleteLoad, jdbc_catalog_conf, load_table
from quayload.spec import TableSpec, quote

LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"


@pytest.fixture
def area(tmp_path):
    return ServingArea(str(tmp_path / "served"), f"t{uuid.uuid4().hex[:8]}_")


def rows_scanned(df):
    """Rows the file scan of a collected query emitted."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_publish_replaces_rows_and_schema(spark, area):
    spec = TableSpec("311", "cases", readers=("it's", "tiles"), keys=("id",))
    name = publish_table(spark.range(10), spec, area)
    assert spark.table(name).count() == 10
    again = spark.range(3).withColumn("x", F.lit("new"))
    assert publish_table(again, spec, area) == name
    assert sorted(map(tuple, spark.table(name).collect())) == [(0, "new"), (1, "new"), (2, "new")]
    properties = dict(spark.sql(f"SHOW TBLPROPERTIES {name}").collect())
    assert properties["readers"] == "it's,tiles" and properties["keys"] == "id"


def test_a_failed_publish_keeps_the_old_version(spark, area):
    spec = TableSpec("s", "t")
    name = publish_table(spark.range(10), spec, area)
    broken = spark.range(10).where(
        F.when(F.col("id") == 9, F.raise_error(F.lit("broken")).cast("boolean")).otherwise(True)
    )
    for keys in ((), ("id",)):
        with pytest.raises(Exception, match="broken"):
            publish_table(broken, TableSpec("s", "t", keys=keys), area)
        assert spark.table(name).count() == 10
    with pytest.raises(ValueError, match="unknown key: nope"):
        publish_table(spark.range(3), TableSpec("s", "t", keys=("nope",)), area)
    assert spark.table(name).count() == 10
    publish_table(spark.range(4), spec, area)
    assert spark.table(name).count() == 4


def test_a_running_reader_keeps_its_version(spark, area):
    spec = TableSpec("s", "t")
    name = publish_table(spark.range(10), spec, area)
    running = spark.table(name)
    publish_table(spark.range(5), spec, area)
    assert running.count() == 10 and spark.table(name).count() == 5


def test_a_version_is_invisible_until_activated(spark, area):
    spec = TableSpec("s", "t")
    name = publish_table(spark.range(10), spec, area)
    waiting = write_version(spark.range(7), spec, area)
    assert waiting.rows == 7
    assert spark.table(name).count() == 10
    activate(spark, waiting)
    assert spark.table(name).count() == 7
    dropped = write_version(spark.range(1), spec, area)
    discard(spark, dropped)
    assert not spark.catalog.tableExists(dropped.name)
    assert spark.table(name).count() == 7
    (old,) = old_versions(spark, spec, area)
    assert spark.table(old.name).count() == 10
    discard(spark, old)
    assert old_versions(spark, spec, area) == []
    assert spark.table(name).count() == 7


def test_looking_up_a_null_and_an_odd_name(spark, area):
    df = spark.createDataFrame([(1, None), (2, "x")], "name int, `odd name` string")
    name = publish_table(df, TableSpec("s", "t", keys=("name", "odd name")), area)
    assert [row.name for row in lookup(spark, name, {"odd name": None}).collect()] == [1]
    assert [row.name for row in lookup(spark, name, {"odd name": "x", "name": 2}).collect()] == [2]
    assert lookup(spark, name, {"odd name": "x", "name": 1}).count() == 0


def test_lookups_by_zero(spark, area):
    """0.0 equals -0.0, whatever the files' filters and dictionaries say."""
    df = spark.range(20_000).select("id", F.when(F.col("id") == 7, F.lit(-0.0)).otherwise(F.col("id") % 5 + 1.0).alias("b"))
    df = df.withColumn("f", F.col("b").cast("float"))
    name = publish_table(df, TableSpec("s", "zero", keys=("id", "b", "f")), area)
    for key in ("b", "f"):
        for zero in (0.0, -0.0, 0):
            assert [row.id for row in lookup(spark, name, {key: zero}).collect()] == [7]
        assert lookup(spark, name, {key: 2}).count() == df.where("b = 2").count()
    assert lookup(spark, name, {"f": 0.1}).count() == 0


def test_only_keys_can_be_looked_up_by_their_own_types(spark, area):
    from decimal import Decimal

    df = spark.createDataFrame([("0077", 77, Decimal("1.50"), 1.0, "x")], "acct string, N int, d decimal(5,2), f double, other string")
    name = publish_table(df, TableSpec("s", "typed", keys=("acct", "n", "d", "f")), area)
    for values in ({}, {"other": "x"}, {"nope": 1}):
        with pytest.raises(ValueError):
            lookup(spark, name, values)
    for values in ({"acct": 77}, {"n": "77"}, {"n": 77.0}, {"n": 1 << 40}, {"n": True}, {"d": 1.5}, {"d": Decimal("1.505")}, {"f": "1"}):
        with pytest.raises(TypeError):
            lookup(spark, name, values)
    for values in ({"acct": "0077"}, {"ACCT": "0077", "n": 77}, {"d": Decimal("1.5")}, {"f": 1}):
        assert lookup(spark, name, values).count() == 1


def test_versions_on_their_way_are_not_old(spark, area):
    spec = TableSpec("s", "t")
    publish_table(spark.range(1), spec, area)
    publish_table(spark.range(2), spec, area)
    waiting = write_version(spark.range(3), spec, area)
    for old in old_versions(spark, spec, area):
        discard(spark, old)
    assert spark.table(activate(spark, waiting)).count() == 3


def test_partitions_come_from_the_input(spark, area, tmp_path, monkeypatch):
    from quayload.sinks import publish

    spark.range(200_000).write.parquet(str(tmp_path / "input"))
    df = spark.read.parquet(str(tmp_path / "input"))
    assert publish.input_bytes(df) > 100_000
    monkeypatch.setattr(publish, "PARTITION_BYTES", 100_000)
    monkeypatch.setattr(publish.partitions_for, "__defaults__", (100_000,))
    name = publish_table(df, TableSpec("s", "sized", keys=("id",)), area)
    files = spark.table(name).select(F.input_file_name()).distinct().count()
    assert files > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_publishing_an_empty_table(spark, area):
    for keys in ((), ("id",)):
        name = publish_table(spark.range(0), TableSpec("s", "t", keys=keys), area)
        assert spark.table(name).count() == 0
        assert spark.table(name).columns == ["id"]


def test_timestamp_keys_have_statistics(spark, area):
    import pyarrow.parquet as pq
    import glob

    stamps = spark.range(100).select(F.timestamp_seconds("id").alias("opened"))
    publish_table(stamps, TableSpec("s", "t", keys=("opened",)), area)
    # set once and left, so that publishes at the same time cannot undo it for each other
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "TIMESTAMP_MICROS"
    (folder,) = glob.glob(f"{area.root}/*/t__*")
    for file in glob.glob(f"{folder}/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0).column(0)
        assert group.physical_type == "INT64" and group.is_stats_set


def test_lookups_skip_most_of_a_keyed_table(spark, area):
    lineitem = spark.read.parquet(LINEITEM)
    total = lineitem.count()
    plain = publish_table(lineitem.repartition(8), TableSpec("s", "plain"), area)
    keyed_spec = TableSpec("s", "keyed", keys=("l_partkey", "l_orderkey"))
    keyed = publish_table(lineitem, keyed_spec, area, partitions=8)
    for key, value in (("l_partkey", 77), ("l_orderkey", 77)):
        expected = lineitem.where(F.col(key) == value)
        found = lookup(spark, keyed, {key: value})
        assert not found.exceptAll(expected).take(1) and found.count() == expected.count()
    assert rows_scanned(spark.table(plain).where("l_partkey = 77")) > total / 2
    assert rows_scanned(lookup(spark, keyed, {"l_partkey": 77})) < total / 4
    assert rows_scanned(spark.table(keyed).where("l_partkey between 70 and 77")) < total / 4
    # Order 77 lies scattered over the files; bloom filters rule out those without it.
    files = spark.table(keyed).where("l_orderkey = 77").select(F.input_file_name()).distinct().count()
    assert files < 8
    assert rows_scanned(lookup(spark, keyed, {"l_orderkey": 77})) <= total * files / 8 * 1.5
    absent = lineitem.agg(F.max("l_orderkey")).first()[0] + 1
    assert rows_scanned(lookup(spark, keyed, {"l_orderkey": absent})) == 0


def test_hot_keys_and_copies_are_cut_up(spark):
    """A third of the rows share the first key, a third are equal in every column."""
    df = spark.range(30_000, numPartitions=64).select(
        F.when(F.col("id") % 3 < 2, F.lit(5)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("v"),
    )
    laid = layout_by_keys(df, ["k"], 16)
    sizes = [row["count"] for row in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000
    assert max(sizes) < 2.5 * 30_000 / 16
    assert laid.columns == ["k", "v"]


def test_unkeyed_publication_does_not_shuffle(spark, capsys):
    layout_by_keys(spark.range(10), ["id"]).explain()
    assert capsys.readouterr().out.count("Exchange rangepartitioning") == 1


@pytest.fixture
def schema(spark, tmp_path):
    digits = str(uuid.uuid4().int).replace("0", "")[:10]
    spec = TableSpec(digits, "supplier")
    spark.sql(f"CREATE DATABASE {quote(spec.warehouse_schema)} LOCATION '{tmp_path}/warehouse'")
    return spec


def tables(spark, spec):
    return sorted(table.name for table in spark.catalog.listTables(spec.warehouse_schema))


def test_load_replaces_the_table(spark, schema):
    assert load_table(spark.range(10), schema) == f"`{schema.warehouse_schema}`.`supplier`"
    name = load_table(spark.range(4).withColumn("x", F.lit(1)), schema)
    assert spark.table(name).count() == 4 and spark.table(name).columns == ["id", "x"]
    assert tables(spark, schema) == ["supplier"]
    assert spark.table(load_table(spark.range(0), schema)).count() == 0


def test_a_failed_load_keeps_the_old_table(spark, schema):
    name = load_table(spark.range(10), schema)
    broken = spark.range(10).select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        load_table(broken, schema)
    assert spark.table(name).count() == 10


def test_a_wrong_row_count_is_not_swapped_in(spark, schema, monkeypatch):
    name = load_table(spark.range(10), schema)

    class Miscounted:
        get = {"rows": 11}

    observe = type(spark.range(1)).observe
    monkeypatch.setattr(warehouse, "Observation", Miscounted)
    monkeypatch.setattr(type(spark.range(1)), "observe", lambda self, *_: self)
    with pytest.raises(IncompleteLoad):
        load_table(spark.range(10), schema)
    monkeypatch.setattr(type(spark.range(1)), "observe", observe)
    assert spark.table(name).count() == 10


def test_a_swap_cut_short_is_completed(spark, schema, monkeypatch):
    name = load_table(spark.range(10), schema)
    inner = quote(schema.warehouse_schema)
    for neighbour in ("supplier__loading_dock", "supplier__previous", "supplier__loading_0123abcd"):
        spark.range(1).writeTo(f"{inner}.{quote(neighbour)}").create()
    spark.range(1).writeTo(f"{inner}.`supplier__loading_deadbeef`").tableProperty(warehouse.MARK, "supplier").create()
    spark.sql(f"ALTER TABLE {name} RENAME TO {inner}.`supplier__previous_0123abcd`")
    broken = spark.range(10).select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        load_table(broken, schema)
    assert spark.table(name).count() == 10
    assert spark.table(load_table(spark.range(2), schema)).count() == 2
    # a load touches nothing but its own; leftovers go when asked for, and only those with the mark
    assert warehouse.drop_leftovers(spark, schema) == ["supplier__loading_deadbeef"]
    others = ["supplier__loading_0123abcd", "supplier__loading_dock", "supplier__previous"]
    assert tables(spark, schema) == ["supplier", *others]
    for working in ("supplier__previous_0123abcd", "supplier__loading_0123abcd"):
        with pytest.raises(ValueError, match="side table"):
            TableSpec("s", working)


def test_jdbc_catalog_settings():
    conf = jdbc_catalog_conf("wh", "jdbc:postgresql://host/db", "org.postgresql.Driver", {"user": "u", "password": "p"})
    assert conf == {
        "spark.sql.catalog.wh": "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        "spark.sql.catalog.wh.url": "jdbc:postgresql://host/db",
        "spark.sql.catalog.wh.driver": "org.postgresql.Driver",
        "spark.sql.catalog.wh.user": "u",
        "spark.sql.catalog.wh.password": "p",
    }


def test_spark_accepts_the_jdbc_catalog(spark, schema):
    """As far as a session without any database driver gets."""
    for key, value in jdbc_catalog_conf("nowhere", "jdbc:none:here", "java.lang.Object", {}).items():
        spark.conf.set(key, value)
    with pytest.raises(Exception, match="(?i)driver"):
        load_table(spark.range(1), schema, "nowhere")
