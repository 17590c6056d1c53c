from __future__ import annotations

import datetime as dt
import math
import os
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.sidecar import read_sidecar, write_sidecar
from quayload.spec import TableSpec
from quayload.staging import PLAIN_CSV, read_staged, stage_table, typed_load

SPEC = TableSpec("schema", "table")

TEXTS = [
    None,
    "",
    "\\N",
    "\\n",
    "\\sn",
    'a"b,c\nd',
    "cr\rlf\r\nend",
    "back\\slash",
    '\\"',
    "  padded  ",
    "__NULL__",
    '"',
    '""',
    "\u0000nul\u0000",
    "\ufeffbom",
    "\u2028line\u0085sep",
    "#comment",
    "   ",
    "\t",
    "naïve 漢字 🎈",
]


def round_trip(spark, df, root):
    staged = stage_table(df, SPEC, str(root))
    back = read_staged(spark, SPEC, str(root))
    assert staged.rows == df.count()
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    return back


def same(left, right):
    return not left.exceptAll(right).take(1) and not right.exceptAll(left).take(1)


def test_text_edges_survive(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, v string")
    back = round_trip(spark, df, tmp_path)
    assert dict(back.collect()) == dict(enumerate(TEXTS))


def test_single_text_column_keeps_blank_rows(spark, tmp_path):
    df = spark.createDataFrame([(text,) for text in TEXTS], "v string")
    back = round_trip(spark, df, tmp_path)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(), st.one_of(st.none(), st.text())), min_size=1, max_size=200))
def test_any_text_survives(spark, tmp_path_factory, rows):
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(rows)], "k int, a string, b string"
    )
    back = round_trip(spark, df, tmp_path_factory.mktemp("text"))
    assert {k: (a, b) for k, a, b in back.collect()} == dict(enumerate(rows))


def test_type_edges_survive(spark, tmp_path):
    schema = (
        "k int, d decimal(10,3), day date, b boolean, x double, f float, n bigint,"
        " ts timestamp, ntz timestamp_ntz, raw binary, s smallint"
    )
    utc = dt.timezone.utc
    ntz = dt.datetime(2024, 3, 10, 2, 30, 0, 1)
    rows = [
        (1, Decimal("1.500"), dt.date(2024, 2, 29), True, 0.1, 0.5, 2**63 - 1,
         dt.datetime(2024, 11, 3, 5, 30, 0, 123456, utc), ntz, b"\x00\xff,\n", -1),
        (2, Decimal("-9999999.999"), dt.date(1, 1, 1), False, math.inf, -math.inf, -(2**63),
         dt.datetime(2024, 11, 3, 6, 30, 0, 123456, utc), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), b"", 0),
        (3, Decimal("0.001"), dt.date(9999, 12, 31), None, 1e308, 1.1, 0,
         dt.datetime(1969, 12, 31, 23, 59, 59, 999999, utc), dt.datetime(1, 1, 1), None, None),
        (4, None, None, None, math.nan, math.nan, None, None, None, None, None),
        (5, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    assert same(df, round_trip(spark, df, tmp_path))


def test_nested_edges_survive(spark, tmp_path):
    schema = (
        "k int, a array<float>, m map<string,string>,"
        " s struct<x:int, t:timestamp, inner:array<struct<q:string>>>"
    )
    stamp = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [
        (1, [0.1, None, math.nan], {"a": None, 'q"': "x\ny\\"}, (1, stamp, [("a,b",), (None,)])),
        (2, [], {}, (None, None, None)),
        (3, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    back = round_trip(spark, df, tmp_path)
    # Map columns cannot be compared as a set of rows, so their entries are.
    flat = lambda d: d.withColumn("m", F.array_sort(F.map_entries("m")))
    assert same(flat(df), flat(back))


def test_odd_column_names_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], T.StructType([
        T.StructField("a.b", T.IntegerType()), T.StructField('odd, "name" `x`', T.StringType())]))
    assert same(df, round_trip(spark, df, tmp_path))


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "k int, v string, a array<int>")
    assert round_trip(spark, df, tmp_path).count() == 0
    narrowed = spark.range(10).where("id < 0")
    assert round_trip(spark, narrowed, tmp_path).count() == 0


def test_wide_table(spark, tmp_path):
    df = spark.range(20).select(*[F.concat(F.lit("a\n"), F.col("id"), F.lit(f"{i}")).alias(f"c{i}") for i in range(400)])
    assert same(df, round_trip(spark, df, tmp_path))


def test_large_cells(spark, tmp_path):
    df = spark.range(2).select("id", F.repeat(F.lit("ab\n\\"), 500_000).alias("text"))
    assert same(df, round_trip(spark, df, tmp_path))


def test_far_dates(spark, tmp_path):
    df = spark.sql(
        "SELECT make_date(10000, 1, 2) AS late, date'-0044-03-15' AS early,"
        " timestamp_ntz'12345-01-02 03:04:05.6' AS stamp"
    )
    assert same(df, round_trip(spark, df, tmp_path))


def test_compressed_staging(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.lit("a\nb"))
    staged = stage_table(df, SPEC, str(tmp_path), compression="gzip")
    assert any(name.endswith(".csv.gz") for name in os.listdir(staged.path))
    assert same(df, read_staged(spark, SPEC, str(tmp_path)))


def test_restaging_replaces(spark, tmp_path):
    round_trip(spark, spark.range(10), tmp_path)
    back = round_trip(spark, spark.range(3).withColumn("x", F.lit("new")), tmp_path)
    assert back.count() == 3


def test_large_staged_file_is_split(spark, tmp_path):
    text = F.concat(F.lit("line\n"), F.repeat(F.lit("x"), 200))
    df = spark.range(20_000, numPartitions=1).withColumn("text", text)
    staged = stage_table(df, SPEC, str(tmp_path))
    size = sum(entry.stat().st_size for entry in os.scandir(staged.path) if entry.name.endswith("csv"))
    assert size > 4_000_000
    assert 0.9 * size < staged.bytes < 1.1 * size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        back = read_staged(spark, SPEC, str(tmp_path))
        assert back.select(F.spark_partition_id()).distinct().count() > 3
        assert same(df, back)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("ddl", ["i interval day", "m map<int,string>", "a array<interval month>", "_quayload_x int"])
def test_types_without_a_staged_form_are_refused(spark, tmp_path, ddl):
    with pytest.raises(TypeError):
        stage_table(spark.createDataFrame([], ddl), SPEC, str(tmp_path))


def land(spark, root, schema, *lines):
    folder = os.path.join(root, SPEC.staging_path)
    os.makedirs(folder)
    with open(os.path.join(folder, "part.csv"), "w", encoding="utf-8", newline="") as out:
        out.write("\n".join(lines) + "\n")
    write_sidecar(spark, T.StructType.fromDDL(schema), SPEC, str(root))


def test_bad_rows_are_split_off(spark, tmp_path):
    good = ['1,good,2.5,[1],1.50,2024-01-31', "6,\\N,\\N,\\N,\\N,\\N"]
    bad = [
        "x,bad number,3,[1],1,2024-01-31",
        "3,too,few",
        "4,too,many,[1],1,2024-01-31,9",
        '5,"q""x,",n/a,"[1]",1,2024-01-31',
        '7,b,1.0,[z],1.00,2024-01-31',
        "8,digits,1.0,[1],1.005,2024-01-31",
        "9,digits,1.0,[1],12345.00,2024-01-31",
        "10,no day,1.0,[1],1.00,2024",
    ]
    land(
        spark, tmp_path, "k int, v string, x double, a array<int>, d decimal(4,2), day date",
        "k,v,x,a,d,day", good[0], *bad, good[1],
    )
    load = typed_load(spark, SPEC, str(tmp_path))
    assert sorted(map(tuple, load.rows.collect())) == [
        (1, "good", 2.5, [1], Decimal("1.50"), dt.date(2024, 1, 31)),
        (6, None, None, None, None, None),
    ]
    rejects = load.rejects.collect()
    # A record with a field count of its own is given as it came, others with as few quotes as they need.
    rendered = [line.replace('"[1]"', "[1]") for line in bad]
    assert sorted(row.raw_record for row in rejects) == sorted(rendered)
    assert all(row.source_file.endswith("part.csv") for row in rejects)
    # The split does not depend on which columns are asked for.
    assert load.rows.count() == 2 and load.rejects.count() == len(bad)
    for name in load.names:
        assert load.rows.select(name).count() == 2
        assert len(load.rows.select(name).collect()) == 2
    assert load.rejects.select("raw_record").count() == len(bad)
    assert load.rows.unionByName(load.rejects, allowMissingColumns=True).count() == len(bad) + 2
    with pytest.raises(Exception, match="row does not fit"):
        read_staged(spark, SPEC, str(tmp_path)).select("v").collect()
    with pytest.raises(Exception, match="row does not fit"):
        read_staged(spark, SPEC, str(tmp_path)).count()


def test_reordered_header_fails(spark, tmp_path):
    land(spark, tmp_path, "k string, v string", "v,k", "a,1")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_staged(spark, SPEC, str(tmp_path)).collect()


def test_files_of_other_tools(spark, tmp_path):
    land(spark, tmp_path, "k int, v string", "k,v", '1,"two\nlines"', '2,""', "3,", "4,C:\\new")
    rows = read_staged(spark, SPEC, str(tmp_path), fmt=PLAIN_CSV).collect()
    assert {row.k: row.v for row in rows} == {1: "two\nlines", 2: None, 3: None, 4: "C:\\new"}


def test_sidecar_keeps_the_schema(spark, tmp_path):
    schema = T.StructType.fromDDL("k int not null, m map<string,array<decimal(9,2)>>")
    write_sidecar(spark, schema, SPEC, str(tmp_path))
    assert read_sidecar(spark, SPEC, str(tmp_path)) == schema


def load_texts(spark, tmp_path, kind, texts):
    """What becomes of each text in a column of the given type; ``misfit`` if it is refused."""
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, v string")
    stage_table(rows, SPEC, str(tmp_path))
    write_sidecar(spark, T.StructType.fromDDL(f"k int, v {kind}"), SPEC, str(tmp_path))
    load = typed_load(spark, SPEC, str(tmp_path))
    found = {row.k: row.v for row in load.rows.collect()}
    return [found.get(i, "misfit") for i in range(len(texts))]


def test_decimals_are_exact_or_refused(spark, tmp_path):
    wide = ["1.12345678915", "1.1234567891", "1.12345678910000", "12e-1", "100e-12", "1e3", "0e-99", ".5", "5.", "x", None]
    got = load_texts(spark, tmp_path, "decimal(38,10)", wide)
    assert got == ["misfit", Decimal("1.1234567891"), Decimal("1.1234567891"), Decimal("1.2"), Decimal("1e-10"),
                   Decimal(1000), Decimal(0), Decimal("0.5"), Decimal(5), "misfit", None]
    assert load_texts(spark, tmp_path, "decimal(38,1)", ["1.55", "1.50", "-0.1"]) == ["misfit", Decimal("1.5"), Decimal("-0.1")]
    big = "9" * 38
    assert load_texts(spark, tmp_path, "decimal(38,0)", [big, big + "0", "1.5", "1.0"]) == [Decimal(big), "misfit", "misfit", Decimal(1)]


def test_floating_text_is_a_number_or_refused(spark, tmp_path):
    texts = ["1.5", "1.5d", "1f", "0x1p3", "1e5", "-.5", "1e999", "Infinity", "-Infinity", "one", "", " 2.0 ", None]
    got = load_texts(spark, tmp_path, "double", texts)
    assert got == [1.5, "misfit", "misfit", "misfit", 1e5, -0.5, "misfit", float("inf"), float("-inf"), "misfit", "misfit", 2.0, None]
    (nan,) = load_texts(spark, tmp_path, "float", ["NaN"])
    assert nan != nan


def test_nested_text_is_one_value(spark, tmp_path):
    texts = ["[1]", '[1],"v":[2]', "[1],[2]", "[1] junk", '[1]} {"v":[2]', "[1]], [[2]", "[]", "null", None, '["x"]']
    assert load_texts(spark, tmp_path, "array<int>", texts) == [[1], *["misfit"] * 5, [], None, None, "misfit"]


def test_a_staging_cut_short_leaves_no_sidecar(spark, tmp_path):
    stage_table(spark.range(3), SPEC, str(tmp_path))
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("string").alias("v"))
    with pytest.raises(Exception, match="broken"):
        stage_table(broken, SPEC, str(tmp_path))
    with pytest.raises(Exception):
        read_staged(spark, SPEC, str(tmp_path))


def test_the_sidecar_is_one_file(spark, tmp_path):
    stage_table(spark.range(3), SPEC, str(tmp_path))
    assert (tmp_path / SPEC.sidecar_path).is_file()
