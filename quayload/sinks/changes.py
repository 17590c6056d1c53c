"""Load changes into a served table: only files that hold changed keys are rewritten.

The table is kept in chunks, dealt by the hash of its keys. A chunk is a folder
of files that is written once and never changed. A version of the table is a
catalog table with one partition per chunk, each pointing at the chunk's folder;
so versions share the chunks that are the same. Loading changes reads and
rewrites the chunks their keys fall into, makes a new version of those and of
all others as they are, and switches the readers' view to it, which is one
catalog change. A run cut short before that has changed nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, combine, resolve
from quayload.sinks.publish import (
    FILE_ROWS,
    LABEL,
    ServingArea,
    Version,
    activate,
    asked_keys,
    condition,
    literal,
    make_database,
    new_label,
    properties_of,
    text_literal,
)
from quayload.spec import TableSpec, quote
from quayload.workspace import delete_path, write_small_file

CHUNK = "_quayload_chunk"
#: Bytes of a chunk at the first load, about; later ones keep the number of chunks.
CHUNK_BYTES = 512 * 1024 * 1024
MARK = "quayload.chunks"
#: Chunks that one statement adds to a version.
STATEMENT_CHUNKS = 500


class ChangesLost(RuntimeError):
    """The rewritten chunks do not have the rows they should have."""


def chunk_of(keys: Sequence[Column], chunks: int) -> Column:
    """The chunk of a row, by its keys; null is a value like others."""
    return F.pmod(F.xxhash64(*[F.struct(key.isNull(), key) for key in keys]), F.lit(chunks)).cast("int")


def _folder(area: ServingArea, spec: TableSpec, label: str) -> str:
    return f"{area.root}/{area.database(spec)}/{spec.table}__chunks/{label}"


def _manifest(version: Version) -> str:
    return f"{_folder(version.area, version.spec, version.label)}/manifest.json"


def _chunk_path(folder: str, chunk: int) -> str:
    return f"{folder}/{CHUNK}={chunk}"


def _write_chunks(rows: DataFrame, folder: str) -> dict[int, int]:
    """Write rows, which have their chunk, into a folder per chunk; returns the rows that each folder has.

    Rebalanced by chunk: a chunk that is too large for one task, because one
    key has a third of the rows, is written by several.
    """
    writer = rows.hint("rebalance", CHUNK).write.option("maxRecordsPerFile", FILE_ROWS)
    writer.partitionBy(CHUNK).mode("errorifexists").parquet(folder)
    written = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    return dict(written.groupBy(CHUNK).count().collect())


def _register(spark: SparkSession, version: Version, schema: T.StructType, chunks: int, paths: Mapping[int, str]) -> Version:
    """Make the version's catalog table, with a partition for each chunk that has rows."""
    make_database(spark, version.area, version.spec)
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = f"{_folder(version.area, version.spec, version.label)}/_table"
    keys = ",".join(version.spec.keys)
    spark.sql(
        f"CREATE TABLE {version.name} ({columns}, {CHUNK} int) USING parquet PARTITIONED BY ({CHUNK})"
        f" LOCATION {text_literal(place)} TBLPROPERTIES ('{MARK}' = '{chunks}', 'keys' = {text_literal(keys)})"
    )
    ordered = sorted(paths)
    for i in range(0, len(ordered), STATEMENT_CHUNKS):
        added = " ".join(
            f"PARTITION ({CHUNK} = {chunk}) LOCATION {text_literal(paths[chunk])}" for chunk in ordered[i : i + STATEMENT_CHUNKS]
        )
        spark.sql(f"ALTER TABLE {version.name} ADD {added}")
    write_small_file(spark, _manifest(version), json.dumps(paths))
    return version


def chunk_paths(spark: SparkSession, version: Version) -> dict[int, str]:
    """Where each chunk of a version is, by its manifest."""
    text = spark.read.text(_manifest(version), wholetext=True).first()[0]
    return {int(chunk): path for chunk, path in json.loads(text).items()}


def load_chunked(df: DataFrame, spec: TableSpec, area: ServingArea, chunks: int) -> str:
    """Load a whole table in chunks and show it to readers; returns the readers' name.

    The table must have keys. ``chunks`` is what the table's size asks for, see
    CHUNK_BYTES; it stays when changes are loaded.
    """
    if not spec.keys or chunks < 1:
        raise ValueError("a table in chunks needs keys, and one chunk at least")
    spark = df.sparkSession
    spec = replace(spec, keys=tuple(resolve(df, spec.keys, "key")))
    label = new_label()
    folder = _folder(area, spec, label)
    chunked = df.withColumn(CHUNK, chunk_of([column(key) for key in spec.keys], chunks))
    written = _write_chunks(chunked, folder)
    version = Version(spec, area, label, sum(written.values()))
    _register(spark, version, df.schema, chunks, {chunk: _chunk_path(folder, chunk) for chunk in written})
    return activate(spark, version, hidden=[CHUNK])


def shown_version(spark: SparkSession, spec: TableSpec, area: ServingArea) -> Version:
    shown = properties_of(spark, area.name(spec))
    return Version(replace(spec, keys=tuple(shown["keys"].split(","))), area, shown["version"])


def load_changes(
    spark: SparkSession, spec: TableSpec, area: ServingArea, changed: DataFrame, gone: DataFrame | None = None
) -> str:
    """Take rows with their keys' new state into a table in chunks; returns the readers' name.

    All rows of a key in ``changed`` replace all rows of that key in the table;
    new keys are added. Keys in ``gone`` (a table of the keys) are removed first, so a key
    in both is there with its rows of ``changed``. Null is a key like others.
    Only the changed keys and the rows of their chunks are read and shuffled.
    Without changes there is no new version. The new version has the columns of
    the table, which ``changed`` must have too, in any order.
    """
    old = shown_version(spark, spec, area)
    keys = old.spec.keys
    table = spark.table(old.name)
    names = [name for name in table.columns if name != CHUNK]
    chunks = int(properties_of(spark, old.name)[MARK])
    changed = changed.select(*[column(name) for name in resolve(changed, names, "column")]).toDF(*names)
    by_key = [column(key) for key in keys]
    touched = changed.select(*by_key)
    if gone is not None:
        touched = touched.unionByName(gone.select(*[column(name) for name in resolve(gone, keys, "key")]).toDF(*keys))
    # a key that changes very often is one row here
    touched = touched.distinct().withColumn(CHUNK, chunk_of(by_key, chunks))
    hit = sorted(row[0] for row in touched.select(CHUNK).distinct().collect())  # at most ``chunks``
    if not hit:
        return area.name(spec)
    near = table.where(column(CHUNK).isin(hit))
    same = combine(Column.__and__, [F.col(f"t.{quote(key)}").eqNullSafe(F.col(f"c.{quote(key)}")) for key in keys])
    kept = near.alias("t").join(touched.drop(CHUNK).alias("c"), same, "left_anti")
    label = new_label()
    folder = _folder(area, old.spec, label)
    written = _write_chunks(kept.unionByName(changed.withColumn(CHUNK, chunk_of(by_key, chunks))), folder)
    rows, expected = sum(written.values()), kept.count() + changed.count()  # counted by their keys alone
    if rows != expected:
        delete_path(spark, folder)
        raise ChangesLost(f"{area.name(spec)}: {rows} rows written, {expected} expected")
    paths = {chunk: path for chunk, path in chunk_paths(spark, old).items() if chunk not in hit}
    paths |= {chunk: _chunk_path(folder, chunk) for chunk in written}
    schema = T.StructType([f for f in table.schema.fields if f.name != CHUNK])
    version = _register(spark, replace(old, label=label, rows=None), schema, chunks, paths)
    return activate(spark, version, hidden=[CHUNK])


def lookup_chunk(spark: SparkSession, name: str, values: Mapping[str, object]) -> DataFrame:
    """As ``lookup``, and if all keys are asked for by a value, only their chunk is opened."""
    shown = properties_of(spark, name)
    keys = shown["keys"].split(",")
    asked = asked_keys(spark, name, values)
    version = shown["source"]
    rows = spark.table(version)
    for key, value in asked.items():
        rows = rows.where(condition(rows.schema[key], value))
    plain = [value for value in asked.values() if isinstance(value, (int, str, bytes)) or value is None]
    if set(asked) == set(keys) and len(plain) == len(keys):
        wanted = [F.lit(None).cast(rows.schema[k].dataType) if asked[k] is None else literal(rows.schema[k], asked[k]) for k in keys]
        chunk = chunk_of(wanted, int(properties_of(spark, version)[MARK]))
        rows = rows.where(column(CHUNK) == chunk)
    return rows.drop(CHUNK)


def drop_unused_chunks(spark: SparkSession, spec: TableSpec, area: ServingArea) -> list[str]:
    """Drop versions older than the one shown, and all folders of chunks that no version left uses; returns these.

    Call it when no reader is on an old version and no load of this table runs.
    """
    old = shown_version(spark, spec, area)
    prefix = f"{spec.table}__"
    database = quote(area.database(spec))
    listed = [t.name.removeprefix(prefix) for t in spark.catalog.listTables(database) if t.name.startswith(prefix)]
    labels = sorted(label for label in listed if LABEL.fullmatch(label))
    used: set[str] = set()
    folders: set[str] = set()
    for label in labels:
        version = replace(old, label=label)
        paths = set(chunk_paths(spark, version).values())
        folders |= paths
        if label >= old.label:
            used |= paths
        else:
            spark.sql(f"DROP TABLE {version.name}")
    unused = sorted(folders - used)
    for path in unused:
        delete_path(spark, path)
    return unused
