"""Rejects taken apart, mended, and added to the table."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.plans.refresh import DIVERT, publish_staged
from quayload.plans.replay import reject_fields, replay_rejects
from quayload.sidecar import write_sidecar
from quayload.sinks.publish import ServingArea
from quayload.spec import TableSpec
from quayload.staging import stage_table

KINDS = {
    "id": T.LongType(), "price": T.DecimalType(9, 2), "day": T.DateType(), "ok": T.BooleanType(),
    "f": T.FloatType(), "note": T.StringType(), "tags": T.ArrayType(T.IntegerType()),
}
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in KINDS.items()])
TEXTS = ", ".join(f"{name} string" for name in KINDS)
ROWS = [
    ("1", "1.50", "2020-01-01", "true", "1.5", "a,\"b\"\nc", "[1]"),
    ("x", "1.505", "2020-13-01", "maybe", "0.12345678901234", "two\nlines", "[1"),
    ("3", None, None, None, None, None, None),
    ("4", "n/a", "2020-01-01", "false", "2", "\\N", "[]"),
    ("4", "n/a", "2020-01-01", "false", "2", "\\N", "[]"),
]


@pytest.fixture
def diverted(spark, tmp_path):
    spec, root = TableSpec("s", "t", keys=("id",)), str(tmp_path / "root")
    area = ServingArea(str(tmp_path / "served"), f"t{uuid.uuid4().hex[:8]}_")
    staged = stage_table(spark.createDataFrame(ROWS, TEXTS), spec, root)
    write_sidecar(spark, SCHEMA, spec, root)
    done = publish_staged(spark, staged, root, area, DIVERT)
    assert (done.rows, done.rejects) == (2, 3)
    return spec, root, area, done.name


def test_causes_of_rejects(spark, diverted):
    spec, root, _, _ = diverted
    rows = {r.id: r for r in reject_fields(spark, spec, root).collect()}
    assert set(rows["x"].causes) == {"id", "price", "day", "ok", "f", "tags"}
    assert rows["4"].causes == ["price"]
    assert tuple(rows["x"])[2:] == ROWS[1] and tuple(rows["4"])[2:] == ROWS[3]


def test_mended_rejects_are_added(spark, diverted):
    spec, root, area, name = diverted
    fields = reject_fields(spark, spec, root)
    mended = fields.where("id = '4'").withColumn("price", F.lit("4.00")).withColumn("extra", F.lit(1))
    done = replay_rejects(spark, spec, root, area, mended)
    assert (done.name, done.added, done.left) == (name, 2, 1)
    assert spark.table(name).where("id = 4 AND price = 4 AND note = '\\\\N'").count() == 2 and spark.table(name).count() == 4
    # half mended: what still does not fit takes the old one's place
    again = reject_fields(spark, spec, root).withColumn("id", F.lit("2"))
    assert (replay_rejects(spark, spec, root, area, again).added, spark.table(name).count()) == (0, 4)
    (row,) = reject_fields(spark, spec, root).collect()
    assert row.id == "2" and "id" not in row.causes and "price" in row.causes
    last = reject_fields(spark, spec, root).select(
        "raw_record", "id", F.lit("2.5").alias("price"), F.lit(None).cast("string").alias("day"), F.lit("true").alias("OK"), F.lit("0.5").alias("f"), "note", F.lit("[2]").alias("tags")
    )
    done = replay_rejects(spark, spec, root, area, last)
    assert (done.added, done.left) == (1, 0)
    assert spark.table(name).where("id = 2").first().note == "two\nlines"
    assert replay_rejects(spark, spec, root, area, last.limit(0)).added == 0


def test_a_record_with_too_few_fields(spark, diverted):
    spec, root, area, name = diverted
    spark.createDataFrame([("7,1.0", "f")], "raw_record string, source_file string").write.mode("append").parquet(f"{root}/{spec.rejects_path}")
    (row,) = reject_fields(spark, spec, root).where("id = '7'").collect()
    assert "record" in row.causes
    with pytest.raises(ValueError, match="unknown field"):
        replay_rejects(spark, spec, root, area, reject_fields(spark, spec, root).drop("note"))
    assert spark.table(name).count() == 2
