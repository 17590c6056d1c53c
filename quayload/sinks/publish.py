"""Publish a full refresh so that readers see the old table or the new, never a mix.

Every refresh is written to a version table of its own. The name readers use is
a view, and replacing a view is one catalog change: a query that already
resolved the old version goes on reading the old files, the next one gets the
new files and the new schema, and no reader's cached metadata can go stale,
because a version never changes. Old versions are plain tables; drop them when
their readers are done.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, combine, resolve
from quayload.functions.quantiles import WHOLE
from quayload.sinks.curve import PAGE_ROWS, curve_bounds, layout_by_curve
from quayload.spec import TableSpec, quote

SLOT = "_quayload_slot"
LABEL = re.compile(r"\d{8}t\d{12}_[0-9a-f]{8}")
PARQUET_TIMESTAMPS = "spark.sql.parquet.outputTimestampType"
# Small row groups let a bloom filter rule out most of a file for a key whose
# values lie scattered; tables without such keys keep the format's default.
KEYED_ROW_GROUP_BYTES = 16 * 1024 * 1024
BLOOM_MAX_BYTES = 1024 * 1024
# Input per publishing task, and the least worth a task of its own.
PARTITION_BYTES = 512 * 1024 * 1024
SMALLEST_PARTITION_BYTES = 4 * 1024 * 1024
# A published file is closed after this many rows and another begun.
FILE_ROWS = 10_000_000
# Sizes Spark gives to inputs it knows nothing about.
UNKNOWN_BYTES = 1 << 60
# Names of the tables that make up the index of a version, after the version's own.
INDEX_PARTS = ("__files", "__slots")
# How a table with keys is laid out: sorted, which serves the first key best, or
# along a curve, which serves ranges of every key.
SORTED, CURVE = "sorted", "curve"


@dataclass(frozen=True)
class ServingArea:
    """Where published tables live: a folder, and a prefix for database names."""

    root: str
    prefix: str = ""

    def database(self, spec: TableSpec) -> str:
        return self.prefix + spec.target_schema

    def name(self, spec: TableSpec) -> str:
        return f"{quote(self.database(spec))}.{quote(spec.table)}"


@dataclass(frozen=True)
class Version:
    """One written, not necessarily activated, refresh of a table.

    ``rows`` is known to the run that wrote it. ``indexed`` says that the
    version has an index of its files.
    """

    spec: TableSpec
    area: ServingArea
    label: str
    rows: int | None = None
    indexed: bool = False

    @property
    def name(self) -> str:
        return self.part("")

    def part(self, suffix: str) -> str:
        """The name of the version's table, or of another that belongs to it."""
        return f"{quote(self.area.database(self.spec))}.{quote(f'{self.spec.table}__{self.label}{suffix}')}"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def new_label() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dt%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def _timestamps_with_statistics(spark: SparkSession) -> None:
    """Write timestamps as integers: the default form has no min and max to skip by.

    Spark has this as a session setting only. It is set once and stays, so that
    publishes at the same time in one session do not undo it for each other.
    """
    if spark.conf.get(PARQUET_TIMESTAMPS) == "INT96":
        spark.conf.set(PARQUET_TIMESTAMPS, "TIMESTAMP_MICROS")


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files and tables that ``df`` reads; ``None`` if one is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(size > UNKNOWN_BYTES for size in sizes) else sum(sizes)


def partitions_for(size: int, cores: int, bytes_each: int = PARTITION_BYTES) -> int:
    """Publishing tasks for an input: by its size, but no fewer than can usefully run at once."""
    return max(1, math.ceil(size / bytes_each), min(math.ceil(size / SMALLEST_PARTITION_BYTES), cores))


def layout_by_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the keys.

    The number of the input partition is the last range column, so one key, or
    one group of identical rows, that holds a third of the table is cut into as
    many ranges as it needs. Unlike a random salt it is the same when a lost
    task runs again.
    """
    order = [column(name) for name in resolve(df, keys, "key")]
    ranged = df.withColumn(SLOT, F.spark_partition_id())
    count = () if partitions is None else (partitions,)
    return ranged.repartitionByRange(*count, *order, SLOT).sortWithinPartitions(*order).drop(SLOT)


def _key_options(schema: T.StructType, keys: Sequence[str], layout: str = SORTED) -> dict[str, str]:
    """The first key is served by the sort; every further key gets a bloom filter.

    Floating point does not: a filter tells 0.0 from -0.0, which are equal. The
    pages of a table along a curve are small instead: their minima and maxima
    are narrow in every key.
    """
    if layout == CURVE:
        return {"parquet.page.row.count.limit": str(PAGE_ROWS)}
    if len(keys) < 2:
        return {}
    floating = (T.FloatType, T.DoubleType)
    options = {
        "parquet.block.size": str(KEYED_ROW_GROUP_BYTES),
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(BLOOM_MAX_BYTES),
    }
    for name in keys[1:]:
        if isinstance(schema[name].dataType, floating):
            continue
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
    return options


def make_database(spark: SparkSession, area: ServingArea, spec: TableSpec) -> None:
    database = area.database(spec)
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {quote(database)} LOCATION {text_literal(f'{area.root}/{database}')}"
    )


def write_version(
    df: DataFrame, spec: TableSpec, area: ServingArea, partitions: int | None = None, layout: str = SORTED
) -> Version:
    """Write a new version of the table without showing it to readers yet.

    A table without keys is written as it comes, with no shuffle. One with keys
    is dealt to ``partitions`` tasks, by default as many as the size of what
    ``df`` reads asks for; only if that is unknown the session decides.
    ``layout`` is SORTED or CURVE; the latter reads the key columns twice more,
    to count the rows and to find the keys' bounds.
    """
    if layout not in (SORTED, CURVE):
        raise ValueError(f"unknown layout: {layout!r}")
    spark = df.sparkSession
    if spec.keys:
        spec = replace(spec, keys=tuple(resolve(df, spec.keys, "key")))
        size = None if partitions else input_bytes(df)
        if size is not None:
            partitions = partitions_for(size, spark.sparkContext.defaultParallelism)
    _timestamps_with_statistics(spark)
    make_database(spark, area, spec)
    counted = Observation()
    if spec.keys and layout == CURVE:
        rows = df.count()
        df = layout_by_curve(df, spec.keys, curve_bounds(df, spec.keys, rows), rows, partitions)
    elif spec.keys:
        df = layout_by_keys(df, spec.keys, partitions)
    options = {"maxRecordsPerFile": str(FILE_ROWS), **_key_options(df.schema, spec.keys, layout)}
    df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    version = Version(spec, area, new_label())
    df.write.format("parquet").options(**options).mode("errorifexists").saveAsTable(version.name)
    return replace(version, rows=counted.get["rows"])


def activate(spark: SparkSession, version: Version, hidden: Sequence[str] = ()) -> str:
    """Point the readers' name at ``version``; returns that name. Readers do not see the columns ``hidden``."""
    spec, name = version.spec, version.area.name(version.spec)
    properties = {
        "readers": ",".join(spec.readers),
        "keys": ",".join(spec.keys),
        "version": version.label,
        "source": version.name,
        "indexed": version.name if version.indexed else "",
    }
    listed = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
    shown = "*"
    if hidden:
        shown = ", ".join(quote(c) for c in spark.table(version.name).columns if c not in hidden)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT {shown} FROM {version.name}")
    return name


def old_versions(spark: SparkSession, spec: TableSpec, area: ServingArea) -> list[Version]:
    """Versions of a table older than the one readers are shown, the oldest first.

    Newer ones may still be on their way to the readers.
    """
    shown = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {area.name(spec)}").collect()}
    prefix = f"{spec.table}__"
    tables = spark.catalog.listTables(quote(area.database(spec)))
    labels = sorted(t.name.removeprefix(prefix) for t in tables if t.name.startswith(prefix))
    written = [label for label in labels if LABEL.fullmatch(label)]
    return [Version(spec, area, label) for label in written if label < shown["version"]]


def discard(spark: SparkSession, version: Version) -> None:
    """Drop a version that is not shown to readers any more, with its files and its index."""
    for suffix in (*INDEX_PARTS, ""):
        spark.sql(f"DROP TABLE IF EXISTS {version.part(suffix)}")


def publish_table(
    df: DataFrame, spec: TableSpec, area: ServingArea, partitions: int | None = None, layout: str = SORTED
) -> str:
    """Write a full refresh and switch readers to it once it is complete."""
    return activate(df.sparkSession, write_version(df, spec, area, partitions, layout))


PLAIN = {
    T.StringType: str,
    T.BooleanType: bool,
    T.BinaryType: (bytes, bytearray),
    T.TimestampType: datetime,
    T.TimestampNTZType: datetime,
}


def _fits(kind: T.DataType, value: object) -> bool:
    """Whether a value is one of the column's type, so that nothing has to be converted."""
    whole = isinstance(value, int) and not isinstance(value, bool)
    if type(kind) in WHOLE:
        return whole and -(1 << (WHOLE[type(kind)] - 1)) <= value < 1 << (WHOLE[type(kind)] - 1)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return whole or isinstance(value, float)
    if isinstance(kind, T.DecimalType):
        if not (whole or isinstance(value, Decimal) and value.is_finite()):
            return False
        digits = Decimal(value).normalize().as_tuple()
        after = max(0, -digits.exponent)
        before = max(0, len(digits.digits) + digits.exponent)
        return after <= kind.scale and before <= kind.precision - kind.scale
    if isinstance(kind, T.DateType):
        return isinstance(value, date) and not isinstance(value, datetime)
    return isinstance(value, PLAIN.get(type(kind), ()))


@dataclass(frozen=True)
class Range:
    """Values from ``low`` to ``high``, both included; ``None`` leaves a side open. Nulls are in no range."""

    low: object = None
    high: object = None

    def __post_init__(self) -> None:
        if self.low is None and self.high is None:
            raise ValueError("a range needs a bound")


def literal(field: T.StructField, value: object) -> Column:
    """A value of a key column's own type, the same in every session and process time zone.

    A time without a zone is written as text, for Spark would otherwise take it
    for a moment in the zone of the process. A column of moments is only
    compared with values that name their zone.
    """
    kind = field.dataType
    if not _fits(kind, value):
        raise TypeError(f"{field.name} is {kind.simpleString()}, not {value!r}")
    if isinstance(kind, T.TimestampNTZType):
        if value.tzinfo is not None:
            raise TypeError(f"{field.name} has times without a zone: {value!r} has one")
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    if isinstance(kind, T.TimestampType):
        if value.tzinfo is None:
            raise TypeError(f"{field.name} has moments: {value!r} needs a time zone")
        return F.lit(value.astimezone(timezone.utc).isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def _exact_float(kind: T.DataType, value: object, wanted: Column) -> Column | None:
    """For a float column, whether the value is one of its numbers: one between two floats equals none."""
    if isinstance(kind, T.FloatType) and math.isfinite(value):
        return wanted.cast("double") == F.lit(float(value))
    return None


def condition(field: T.StructField, value: object) -> Column:
    """A condition on a key that can be pushed down to the files."""
    key = column(field.name)
    if value is None:
        return key.isNull()
    if isinstance(value, Range):
        if isinstance(field.dataType, T.FloatType):
            # rounding a bound could move it across a value
            key = key.cast("double")
            field = T.StructField(field.name, T.DoubleType())
        sides = []
        if value.low is not None:
            sides.append(key >= literal(field, value.low))
        if value.high is not None:
            sides.append(key <= literal(field, value.high))
        return combine(Column.__and__, sides)
    wanted = literal(field, value)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        # as a range, for statistics and dictionaries tell 0.0 from -0.0
        same = (key >= wanted) & (key <= wanted)
        exact = _exact_float(field.dataType, value, wanted)
        return same if exact is None else same & exact
    return key == wanted


def properties_of(spark: SparkSession, name: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def asked_keys(spark: SparkSession, name: str, values: Mapping[str, object]) -> dict[str, object]:
    """The values by the table's own spelling of its keys; anything but a key is an error."""
    keys = [key for key in properties_of(spark, name).get("keys", "").split(",") if key]
    asked = resolve(spark.table(name), list(values), "key")
    others = [key for key in asked if key not in keys]
    if others or not asked:
        raise ValueError(f"the keys of {name} are {', '.join(keys) or 'none'}; asked for: {', '.join(others) or 'none'}")
    return dict(zip(asked, values.values()))


def lookup(spark: SparkSession, name: str, values: Mapping[str, object]) -> DataFrame:
    """Rows of a published table whose key columns have the given values, or are in a :class:`Range`.

    Only keys can be asked for, with values of their own types: any other
    condition would read the whole table. Names follow the session's rule for
    letter case. Times are compared as they are written, whatever zone the
    session is in.
    """
    rows = spark.table(name)
    for key, value in asked_keys(spark, name, values).items():
        rows = rows.where(condition(rows.schema[key], value))
    return rows
