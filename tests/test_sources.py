from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.sources.records import (
    IncompletePages,
    count_incomplete,
    extract_records,
    land_records,
)
from quayload.sources.relational import (
    CatalogSource,
    ColumnSplit,
    JdbcSource,
    PredicateSplit,
    bucket_split,
    extract_table,
    range_split,
)
from quayload.spec import TableSpec

SPEC = TableSpec("schema", "table")
URL = "jdbc:oracle:thin:@//host:1521/db"


class Reader:
    """Records what would be asked of Spark's JDBC reader."""

    def __init__(self):
        self.read, self.calls, self.asked = self, {}, []

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def load(self):
        return self.calls

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


def test_whole_table_over_jdbc():
    source = JdbcSource(URL, {"user": "login", "password": "secret"}, one_task=True)
    assert extract_table(Reader(), SPEC, source) == {
        "format": "jdbc",
        "url": URL,
        "dbtable": "gis_schema.table",
        "user": "login",
        "password": "secret",
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
    }
    assert "secret" not in repr(source)


def test_partitioned_over_jdbc():
    source = JdbcSource(URL, custom_schema="id DECIMAL(38,0)")
    asked = extract_table(Reader(), SPEC, source, ColumnSplit("id", "1", "100", 4))
    assert asked["partitionColumn"] == "id" and asked["numPartitions"] == "4"
    assert (asked["lowerBound"], asked["upperBound"]) == ("1", "100")
    assert asked["customSchema"] == "id DECIMAL(38,0)"
    asked = extract_table(Reader(), SPEC, source, bucket_split("ORA_HASH(ROWID, {last})", 3))
    assert asked["predicates"] == [
        "ORA_HASH(ROWID, 2) = 0 OR ORA_HASH(ROWID, 2) IS NULL",
        "ORA_HASH(ROWID, 2) = 1",
        "ORA_HASH(ROWID, 2) = 2",
    ]
    assert asked["dbtable"] == "gis_schema.table" and asked["fetchsize"] == "10000"


@pytest.mark.parametrize("split", [None, ColumnSplit("id", "1", "9", 2), bucket_split("k", 2)])
def test_spark_accepts_the_jdbc_options(spark, split):
    """As far as a session without any database driver gets."""
    with pytest.raises(Exception, match="No suitable driver"):
        extract_table(spark, SPEC, JdbcSource("jdbc:none:here", one_task=split is None), split)
    with pytest.raises(Exception, match="No suitable driver"):
        JdbcSource("jdbc:none:here").count(spark, SPEC)


def test_reads_that_could_lose_rows_or_swamp_a_task_are_refused():
    for make in (
        lambda: bucket_split("k", 0),
        lambda: PredicateSplit(()),
        lambda: PredicateSplit(("k = 1", " ")),
        lambda: ColumnSplit("k", "1", "9", 0),
        lambda: extract_table(Reader(), SPEC, JdbcSource(URL)),
    ):
        with pytest.raises(ValueError):
            make()


def test_projection_and_snapshot_over_jdbc():
    source = JdbcSource(URL, projection={"id": "id", "shape": "TO_WKT(shape)"}, snapshot="AS OF SCN 7")
    assert source.relation(SPEC) == "(SELECT id, TO_WKT(shape) AS shape FROM gis_schema.table AS OF SCN 7) src"
    assert JdbcSource(URL, snapshot="AS OF SCN 7").relation(SPEC) == (
        "(SELECT * FROM gis_schema.table AS OF SCN 7) src"
    )


@pytest.mark.parametrize("bounds", [[], ["3"], ["-1", "3", "3", "8"]])
def test_range_split_takes_every_row_once(spark, bounds):
    values = [None, -5, -1, 0, 3, 3, 7, 8, 100]
    df = spark.createDataFrame([(v,) for v in values], "k int")
    predicates = range_split("k", bounds).predicates
    hits = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    assert [row[0] for row in df.select(sum(hits, F.lit(0))).collect()] == [1] * len(values)


def test_bucket_split_takes_every_row_once(spark):
    df = spark.range(1000).withColumn("k", F.lit("hot"))
    predicates = bucket_split("nullif(pmod(xxhash64(id), {last} + 1), if(id < 0, 1, 2))", 7).predicates
    counts = [df.where(p).count() for p in predicates]
    assert sum(counts) == 1000 and counts[2] == 0
    predicates = bucket_split("pmod(xxhash64(id), {last} + 1)", 7).predicates
    counts = [df.where(p).count() for p in predicates]
    assert sum(counts) == 1000 and min(counts) > 50


def test_extract_from_a_mounted_catalog(spark, tmp_path):
    spec = TableSpec(f"s{uuid.uuid4().hex[:8]}", "t")
    spark.sql(f"CREATE DATABASE {spec.source_schema} LOCATION '{tmp_path}'")
    spark.range(10).withColumn("v", F.lit("x")).write.saveAsTable(f"{spec.source_schema}.t")
    assert extract_table(spark, spec, CatalogSource()).count() == 10
    assert extract_table(spark, spec, CatalogSource("spark_catalog"), ColumnSplit("id", "0", "9", 2)).count() == 10
    with pytest.raises(ValueError):
        extract_table(spark, spec, CatalogSource(), range_split("id", ["1"]))


def test_extraction_prunes_and_pushes_down(spark, tmp_path, capsys):
    spec = TableSpec(f"s{uuid.uuid4().hex[:8]}", "t")
    spark.sql(f"CREATE DATABASE {spec.source_schema} LOCATION '{tmp_path}'")
    spark.range(10).withColumn("v", F.lit("x")).write.saveAsTable(f"{spec.source_schema}.t")
    extract_table(spark, spec, CatalogSource()).where("id = 3").select("id").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(id,3)" in plan and "ReadSchema: struct<id:bigint>" in plan


def write_pages(folder, *pages):
    folder.mkdir(exist_ok=True)
    (folder / "pages.json").write_text("\n".join(p if isinstance(p, str) else json.dumps(p) for p in pages))
    return str(folder)


RAW = T.StructType().add("a", "integer").add("b", "string")
RECORD = T.StructType().add("id", "string").add("n", "long").add("tags", T.ArrayType(T.StringType())).add("raw", RAW)


def test_flat_and_nested_records(spark, tmp_path):
    pages = write_pages(
        tmp_path / "pages",
        {"records": [{"id": "a", "n": 1, "tags": ["x", None], "raw": {"a": 1, "b": "q"}}, {"id": "b"}]},
        {"records": [], "total": 3},
        {"records": [{"id": "c", "n": 3, "unknown": True}]},
    )
    rows = extract_records(spark, pages, RECORD)
    assert rows.schema == RECORD
    assert {row.id: (row.n, row.tags, row.raw and tuple(row.raw)) for row in rows.collect()} == {
        "a": (1, ["x", None], (1, "q")), "b": (None, None, None), "c": (3, None, None),
    }
    flat = extract_records(spark, pages, RECORD, nested_as_json=True)
    assert [f.dataType.simpleString() for f in flat.schema] == ["string", "bigint", "string", "string"]
    first = flat.where("id = 'a'").first()
    assert first.tags == '["x",null]' and first.raw == '{"a":1,"b":"q"}'


def test_wrapped_values_and_inferred_schema(spark, tmp_path):
    pages = write_pages(
        tmp_path / "pages",
        {"records": [{"id": "r1", "createdTime": "t", "fields": {"street address": "1 Main", "n": 2}}]},
        {"records": [{"id": "r2", "fields": {"n": 3, "late": 1.5}}]},
    )
    rows = extract_records(spark, pages, values_in="fields")
    assert sorted(rows.columns) == ["late", "n", "street address"]
    assert sorted(row.n for row in rows.collect()) == [2, 3]
    record = T.StructType([T.StructField("street address", T.StringType())])
    assert extract_records(spark, pages, record, "fields").count() == 2


def test_ids_beside_wrapped_values(spark, tmp_path):
    pages = write_pages(tmp_path / "pages", {"records": [{"id": "r1", "createdTime": "t1", "fields": {"n": 2}}, {"id": "r2", "fields": {}}]})
    beside = T.StructType().add("id", "string").add("createdTime", "string")
    rows = extract_records(spark, pages, T.StructType().add("n", "long"), "fields", beside=beside)
    assert sorted(map(tuple, rows.collect())) == [("r1", "t1", 2), ("r2", None, None)]


@pytest.mark.parametrize("page", [{"error": "rate limit"}, {"records": None}, {"Records": [{"id": "x"}]}])
def test_a_page_without_records_is_not_passed_over(spark, tmp_path, page):
    pages = write_pages(tmp_path / "pages", {"records": [{"id": "a"}]}, page)
    with pytest.raises(Exception, match="no list of records"):
        extract_records(spark, pages, RECORD).collect()
    with pytest.raises(Exception, match="no list of records"):
        extract_records(spark, pages, RECORD).count()
    assert extract_records(spark, pages, RECORD, skip_incomplete=True).count() == 1
    assert count_incomplete(spark, pages) == 1


def test_pages_without_any_records(spark, tmp_path):
    with pytest.raises(IncompletePages):
        extract_records(spark, write_pages(tmp_path / "pages", {"error": "x"}))


def test_one_page_per_file(spark, tmp_path):
    for page, ids in enumerate((["a", "b"], ["c"])):
        (tmp_path / f"{page}.json").write_text(json.dumps({"records": [{"id": i} for i in ids]}, indent=2))
    rows = extract_records(spark, str(tmp_path), RECORD, page_per_file=True)
    assert sorted(row.id for row in rows.collect()) == ["a", "b", "c"]


def test_a_broken_page_fails_instead_of_vanishing(spark, tmp_path):
    pages = write_pages(tmp_path / "pages", {"records": [{"id": "a"}]}, '{"records": [{"id": "b"')
    with pytest.raises(Exception, match="(?i)malformed"):
        extract_records(spark, pages, RECORD).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        extract_records(spark, pages, RECORD).select("n").count()


def test_landed_pages_are_bounded(spark, tmp_path):
    df = spark.range(1234, numPartitions=3).withColumn("hot", F.lit(None).cast("string"))
    land_records(df, str(tmp_path / "pages"), page_rows=100)
    sizes = [
        len(json.loads(line[0])["records"]) for line in spark.read.text(str(tmp_path / "pages")).collect()
    ]
    assert sum(sizes) == 1234 and max(sizes) <= 100
    back = extract_records(spark, str(tmp_path / "pages"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
