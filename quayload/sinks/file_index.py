"""An index of a version's files, asked before any file is opened.

A lookup by a key that the layout doesn't serve would otherwise open the footer
of every file. The index is two small tables beside the version:

- ``files``: each file's name, rows, and least and greatest value of each key;
- ``slots``: for each key, the merged membership filter of all files. A value's
  hash gives its slot, and a slot has a row for each file that holds any value of
  it. There are about as many slots as different values, and the table is sorted
  by slot, so that one value reads few pages of it.

The filter names all files with the value, and few others; the rows of the files
it names are then filtered as usual, so the answer is exact. Files of a version
never change, and neither does its index.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, combine
from quayload.sinks.publish import (
    INDEX_PARTS,
    Range,
    Version,
    asked_keys,
    condition,
    literal,
    partitions_for,
    properties_of,
)
from quayload.spec import quote

FILES, SLOTS = INDEX_PARTS
FLOATING = (T.FloatType, T.DoubleType)
#: Bytes of an entry of the filter: key, slot, file.
ENTRY_BYTES = 16
#: Beyond so many files the whole table is read with the same conditions.
MOST_FILES = 10_000


def _slot(value: Column, slots: Column | int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(slots) if isinstance(slots, int) else slots)


def _file() -> Column:
    """The number of a row's file: the hash of its name. Files that share one are always named together."""
    return F.xxhash64(F.col("_metadata.file_name"))


def _hashed_keys(schema: T.StructType, keys: tuple[str, ...]) -> list[tuple[int, str]]:
    """Keys that have slots, with their place; floating point is found by its range, as 0.0 equals -0.0."""
    return [(i, key) for i, key in enumerate(keys) if not isinstance(schema[key].dataType, FLOATING)]


def index_version(spark: SparkSession, version: Version) -> Version:
    """Write the index of a version; three passes over its key columns, shuffling only counts and file numbers.

    A version without keys, or without rows, has an index that names no file or
    all. Show the returned version to readers with ``activate``.
    """
    table = spark.table(version.name)
    keys = version.spec.keys
    path = F.col("_metadata.file_path")
    rows = table.select(path.alias("path"), _file().alias("file"), *[column(key).alias(f"k{i}") for i, key in enumerate(keys)])
    sides = [
        side
        for i in range(len(keys))
        for side in (
            F.min(f"k{i}").alias(f"low{i}"),
            F.max(f"k{i}").alias(f"high{i}"),
            F.count_if(F.col(f"k{i}").isNull()).alias(f"nulls{i}"),
        )
    ]
    files = rows.groupBy("file", "path").agg(F.count(F.lit(1)).alias("rows"), *sides)
    files.write.format("parquet").mode("errorifexists").saveAsTable(version.part(FILES))
    hashed = _hashed_keys(table.schema, keys)
    if not hashed:
        return replace(version, indexed=True)
    different = rows.agg(*[F.approx_count_distinct(f"k{i}").alias(f"n{i}") for i, _ in hashed]).first()
    # one entry for each slot a file has, so a value that fills a third of a file costs no more than any other
    entries = [_entries(rows, i, _slots_for(n)) for (i, _), n in zip(hashed, different)]
    own = reduce(DataFrame.union, entries)
    held = spark.table(version.part(FILES)).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first()
    most = sum(min(n * held["files"], held["rows"] or 0) for n in different)
    parts = partitions_for(most * ENTRY_BYTES, spark.sparkContext.defaultParallelism)
    # a task has a range of one key's slots, or of few keys'; one number alone is sorted by its bits, without comparisons
    laid = own.repartitionByRange(parts, "key", "slot", "file").sortWithinPartitions("slot")
    listed = F.lit(",".join(str(_slots_for(n)) for n in different))
    laid.withColumn("slots", listed).write.format("parquet").mode("errorifexists").saveAsTable(version.part(SLOTS))
    return replace(version, indexed=True)


def _entries(rows: DataFrame, i: int, slots: int) -> DataFrame:
    """The different key, slot and file of the rows' key ``i``, from that column alone."""
    own = rows.where(F.col(f"k{i}").isNotNull()).select(_slot(F.col(f"k{i}"), slots).alias("slot"), "file").distinct()
    return own.select(F.lit(i).alias("key"), "slot", "file")


def _slots_for(different: int) -> int:
    return 1 << max(4, int(different).bit_length())


def files_named(spark: SparkSession, name: str, values: Mapping[str, object]) -> DataFrame | None:
    """Paths and rows of the files that may hold rows with the asked values; ``None`` if the table has no index."""
    shown = properties_of(spark, name)
    version = shown.get("indexed")
    if not version:
        return None
    keys = tuple(shown["keys"].split(","))
    table = spark.table(version)
    files = spark.table(_part(version, FILES))
    hashed = _hashed_keys(table.schema, keys)
    sizes: list[int] = []
    for key, value in asked_keys(spark, name, values).items():
        i, field = keys.index(key), table.schema[key]
        if value is None:
            files = files.where(F.col(f"nulls{i}") > 0)
            continue
        whole = value if isinstance(value, Range) else Range(value, value)
        low, high = (T.StructField(f"{side}{i}", field.dataType) for side in ("low", "high"))
        sides = []
        if whole.high is not None:
            sides.append(condition(low, Range(high=whole.high)))
        if whole.low is not None:
            sides.append(condition(high, Range(low=whole.low)))
        files = files.where(combine(Column.__and__, sides))
        if isinstance(value, Range) or key not in [k for _, k in hashed]:
            continue
        slots = spark.table(_part(version, SLOTS))
        if not sizes:
            first = slots.select("slots").first()  # none if all keys are null everywhere
            sizes = [int(n) for n in first[0].split(",")] if first else []
        if not sizes:
            return files.where(F.lit(False)).select("path", "rows")
        size = sizes[[k for _, k in hashed].index(key)]
        found = slots.where((F.col("key") == i) & (F.col("slot") == _slot(literal(field, value), size)))
        # an index of an earlier release has a slot's files in one row
        files = files.join(found.select(F.explode("files").alias("file") if "files" in found.columns else "file"), "file", "left_semi")
    return files.select("path", "rows")


def _part(version: str, suffix: str) -> str:
    return f"{version[:-1]}{suffix}`"


def lookup_indexed(spark: SparkSession, name: str, values: Mapping[str, object], most_files: int = MOST_FILES) -> DataFrame:
    """As ``lookup``, but only the files that the index names are opened.

    A version without an index, and an answer from more than ``most_files``
    files, is read from the whole table with the same conditions.
    """
    asked = asked_keys(spark, name, values)
    named = files_named(spark, name, values)
    table = spark.table(properties_of(spark, name)["indexed"]) if named is not None else spark.table(name)
    paths = [row.path for row in named.limit(most_files + 1).collect()] if named is not None else None
    rows = table
    if paths is not None and len(paths) <= most_files:
        rows = spark.read.schema(table.schema).parquet(*map(_plain, paths)) if paths else table.where(F.lit(False))
    for key, value in asked.items():
        rows = rows.where(condition(table.schema[key], value))
    return rows


def _plain(path: str) -> str:
    """A path as readers take it, from the encoded one the scan reports."""
    parts = urlsplit(path)
    return f"{parts.scheme}:{unquote(path[len(parts.scheme) + 1 :])}" if parts.scheme else unquote(path)
