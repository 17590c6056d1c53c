"""Tasks that fail after producing their rows and run again must not change a result."""

from __future__ import annotations

import uuid

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from quayload.operators.enrich import geocode_enrich, prepare_lookup
from quayload.sinks.publish import ServingArea, write_version
from quayload.sinks.warehouse import load_table
from quayload.spec import TableSpec, quote
from quayload.staging import read_staged, stage_table
from quayload.workspace import new_area


def fails_once(df):
    """The same rows, but every odd task loses its first attempt at the very end."""

    def attempt(batches):
        yield from batches
        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() % 2:
            raise RuntimeError("lost executor")

    return df.mapInArrow(attempt, df.schema)


@pytest.fixture
def flaky(spark):
    street = F.when(F.col("id") % 3 > 0, F.concat(F.col("id") % 3, F.lit(" st")))
    return fails_once(spark.range(1000, numPartitions=8).withColumn("street", street))


def test_staging(spark, tmp_path, flaky):
    spec = TableSpec("s", "t")
    assert stage_table(flaky, spec, str(tmp_path)).rows == 1000
    back = read_staged(spark, spec, str(tmp_path))
    assert back.count() == 1000 and back.select("id").distinct().count() == 1000


@pytest.mark.parametrize("keys", [(), ("street", "id")])
def test_publishing(spark, tmp_path, flaky, keys):
    area = ServingArea(str(tmp_path), f"f{uuid.uuid4().hex[:8]}_")
    version = write_version(flaky, TableSpec("s", "t", keys=keys), area, 4)
    assert version.rows == 1000
    assert spark.table(version.name).select("id").distinct().count() == 1000
    assert spark.table(version.name).count() == 1000


def test_shuffled_join(spark, flaky):
    reference = spark.createDataFrame([(1, "1 ST", 1.0), (2, "2 ST", 2.0)], "aid int, a string, lat double")
    lookup = prepare_lookup(fails_once(reference.repartition(4)), ["a"], ["lat"], "aid", new_area(spark, "l"))
    assert lookup.rows == 2
    located = geocode_enrich(
        flaky, lookup, ["street"], ["lat"],
        broadcast_bytes=0, heavy_rows=334,
    )
    counts = {row.lat: row["count"] for row in located.groupBy("lat").count().collect()}
    assert counts == {None: 334, 1.0: 333, 2.0: 333}


def test_warehouse_load(spark, tmp_path, flaky):
    spec = TableSpec(f"w{uuid.uuid4().hex[:8]}", "t")
    spark.sql(f"CREATE DATABASE {quote(spec.warehouse_schema)} LOCATION '{tmp_path}'")
    assert spark.table(load_table(flaky, spec)).count() == 1000
