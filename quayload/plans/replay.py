"""Mend rows that a load diverted, and add them to the table without loading the others again.

A reject is kept as its text. :func:`reject_fields` takes it apart and names the
fields that do not fit; the caller mends the texts; :func:`replay_rejects` loads
only these and writes the next version as the rows shown now and the mended ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, resolve
from quayload.functions.text import unescape_lines
from quayload.plans.refresh import RowsLost
from quayload.sidecar import read_sidecar
from quayload.sinks.publish import ServingArea, activate, discard, write_version
from quayload.spec import TableSpec, quote
from quayload.staging import (
    CORRUPT,
    FILE_OPTIONS,
    LINES,
    StagingFormat,
    convert_field,
    read_type,
    stage_table,
    typed_load,
)
from quayload.workspace import delete_path, new_area, path_exists

RAW, CAUSES = "raw_record", "causes"
WHOLE_RECORD = "record"


@dataclass(frozen=True)
class Replay:
    """What a replay did: the readers' name, rows added, and rejects that are left."""

    name: str
    added: int
    left: int


def _rejects(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The reject table; a run without rejects leaves none."""
    schema, path = f"{RAW} string, source_file string", f"{root}/{spec.rejects_path}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def reject_fields(spark: SparkSession, spec: TableSpec, root: str, fmt: StagingFormat = LINES) -> DataFrame:
    """The table's rejects: ``raw_record``, ``causes``, and each field as text.

    ``causes`` names the fields whose text does not fit their type; a record
    with too few or too many fields has ``record``, and what fields could be
    made out. Only rejects are read.
    """
    schema = read_sidecar(spark, spec, root)
    names = schema.fieldNames()
    if {RAW, CAUSES} & set(names):
        raise ValueError(f"columns named {RAW} or {CAUSES} cannot be told from those of a reject")
    options = {k: v for k, v in fmt.options().items() if k not in FILE_OPTIONS}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    corrupt = T.StructField(CORRUPT, T.StringType())
    as_text = T.StructType([*(T.StructField(name, T.StringType()) for name in names), corrupt])
    as_read = T.StructType([*(T.StructField(f.name, read_type(f.dataType)) for f in schema.fields), corrupt])
    rows = _rejects(spark, spec, root).select(
        RAW,
        F.from_csv(RAW, _ddl(as_text), options).alias("text"),
        F.from_csv(RAW, _ddl(as_read), options).alias("read"),
    )
    # fields with the names of the table's columns, as the conversions take them
    plain = rows.select(RAW, "text", *[F.col(f"read.{quote(name)}").alias(name) for name in names])
    bad = []
    for field in schema.fields:
        _, flag = convert_field(field, fmt)
        if flag is None:  # the reader itself has made it null
            flag = F.col(f"text.{quote(field.name)}").isNotNull() & column(field.name).isNull()
        bad.append(F.when(flag, F.lit(field.name)))
    whole = F.when(F.col(f"text.{quote(CORRUPT)}").isNotNull(), F.lit(WHOLE_RECORD))
    told = plain.select(RAW, F.array_compact(F.array(whole, *bad)).alias(CAUSES), *[F.col(f"text.{quote(n)}").alias(n) for n in names])
    return told.select(RAW, CAUSES, *[(unescape_lines(n) if fmt.escaped else column(n)).alias(n) for n in names])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def replay_rejects(spark: SparkSession, spec: TableSpec, root: str, area: ServingArea, mended: DataFrame) -> Replay:
    """Add mended rejects to the table that readers are shown.

    ``mended`` has the ``raw_record`` of the rejects it mends, and each field as text, as
    :func:`reject_fields` gives them; other columns are ignored. A reject that
    was there several times is mended as often as ``mended`` has it. Rows that now fit are loaded
    by the sidecar and written, with the rows shown now, as the next version;
    those that still do not fit take the place of what they were meant to mend,
    and rejects that are not mended stay. Nothing is added if nothing fits. The
    staged files of the table are not read.
    """
    schema = read_sidecar(spark, spec, root)
    names = resolve(mended, schema.fieldNames(), "field")
    work = new_area(spark, "replay")
    # mended once, whatever it is made from: the rejects are replaced below
    mended.select(RAW, *[column(n).cast("string").alias(f.name) for n, f in zip(names, schema.fields)]).write.parquet(f"{work}/mended")
    texts = spark.read.parquet(f"{work}/mended")
    given = texts.select(RAW).distinct()
    staged = stage_table(texts.drop(RAW), spec, work)
    load = typed_load(spark, spec, work, schema)
    still = load.rejects.select(RAW, "source_file")
    load.rows.write.parquet(f"{work}/rows")
    rows = spark.read.schema(schema).parquet(f"{work}/rows")
    left = _rejects(spark, spec, root).join(given, RAW, "left_anti").unionByName(still)
    left.write.parquet(f"{work}/left")
    kept = spark.read.schema(left.schema).parquet(f"{work}/left")
    added, name = rows.count(), area.name(spec)
    if added + still.count() != staged.rows:
        raise RowsLost(f"{spec.rejects_path}: {staged.rows} mended, {added} + {still.count()} read")
    if added:
        shown = spark.table(name)  # the version it shows now, whatever is shown later
        version = write_version(shown.unionByName(rows), spec, area)
        if version.rows != shown.count() + added:
            discard(spark, version)
            raise RowsLost(f"{name}: {version.rows} rows, {shown.count()} + {added} expected")
        activate(spark, version)
    # last: a run cut short before can be repeated only after a look at the table
    delete_path(spark, f"{root}/{spec.rejects_path}")
    if kept.take(1):
        kept.write.parquet(f"{root}/{spec.rejects_path}")
    return Replay(name, added, kept.count())
