"""The three full-refresh runs: relational table, record pages, geocoded table.

Each stages its input, reads the staged text back by its sidecar, and publishes
what fits. Staging is a real materialisation: the source is read once, and a
lost executor repeats only its share of reading staged files. Where the staged
rows are needed more than once, they are parsed into typed files first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayload.functions.columns import column, resolve
from quayload.operators.enrich import AddressLookup, geocode_enrich
from quayload.sidecar import read_sidecar
from quayload.sinks.publish import (
    PARTITION_BYTES,
    ServingArea,
    activate,
    discard,
    partitions_for,
    write_version,
)
from quayload.sinks.warehouse import load_table
from quayload.sources.records import extract_records
from quayload.sources.relational import (
    CatalogSource,
    ColumnSplit,
    JdbcSource,
    PredicateSplit,
    extract_table,
)
from quayload.spec import TableSpec
from quayload.staging import (
    LINES,
    MISFIT,
    RAW_RECORD,
    SOURCE,
    StagedTable,
    StagingFormat,
    read_staged,
    stage_table,
    typed_load,
)
from quayload.workspace import delete_path

FAIL = "fail"
DIVERT = "divert"


class RowsLost(RuntimeError):
    """Published and rejected rows do not add up to the staged rows."""


@dataclass(frozen=True)
class Refresh:
    """What a run did. ``name`` is the readers' name, if the table is published."""

    staged: StagedTable
    name: str | None = None
    rows: int = 0
    rejects: int = 0


def publish_staged(
    spark: SparkSession,
    staged: StagedTable,
    root: str,
    area: ServingArea,
    on_misfit: str = FAIL,
    fmt: StagingFormat = LINES,
    schema: T.StructType | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> Refresh:
    """Load a staged table by its sidecar and publish it.

    ``fail`` stops at the first row that does not fit, and readers keep the old
    version. ``divert`` publishes the rows that fit and writes the others to
    the table's reject folder; either way the folder has nothing of earlier
    runs. ``fmt`` is the form of files that another tool staged, and ``schema``
    their columns if it left no sidecar. The text is parsed once: a table with
    keys, whose rows are read twice to lay them out, and one whose misfits are
    diverted, go through typed files. ``partition_bytes`` is the staged text
    per publishing task; files are also bounded by their rows.
    """
    if on_misfit not in (FAIL, DIVERT):
        raise ValueError(f"unknown way to treat misfits: {on_misfit!r}")
    spec = staged.spec
    names = schema or read_sidecar(spark, spec, root)
    resolve(spark.createDataFrame([], names), spec.keys, "key")
    rejects_path = f"{root}/{spec.rejects_path}"
    delete_path(spark, rejects_path)
    partitions = None
    if staged.bytes is not None:
        partitions = partitions_for(staged.bytes, spark.sparkContext.defaultParallelism, partition_bytes)
    typed, rejects = None, 0
    if on_misfit == FAIL and not spec.keys:
        rows = read_staged(spark, spec, root, schema, fmt)
    else:
        typed = f"{root}/typed/{spec.target_schema}/{spec.table}-{uuid.uuid4().hex}"
        if on_misfit == FAIL:
            read_staged(spark, spec, root, schema, fmt).write.parquet(typed)
            rows = spark.read.schema(names).parquet(typed)
        else:
            load = typed_load(spark, spec, root, schema, fmt)
            load.parsed.write.parquet(typed)
            parsed = spark.read.schema(load.parsed.schema).parquet(typed)
            bad = parsed.where(column(MISFIT))
            rejects = bad.count()
            if rejects:
                bad = bad.select(column(RAW_RECORD).alias("raw_record"), column(SOURCE).alias("source_file"))
                bad.write.parquet(rejects_path)
            rows = parsed.where(~column(MISFIT)).select(*map(column, load.names))
    try:
        version = write_version(rows, spec, area, partitions)
    finally:
        if typed:
            delete_path(spark, typed)
    if staged.rows is not None and version.rows + rejects != staged.rows:
        discard(spark, version)
        raise RowsLost(f"{spec.staging_path}: {staged.rows} staged, {version.rows} + {rejects} read")
    return Refresh(staged, activate(spark, version), version.rows, rejects)


def load_staged(
    spark: SparkSession,
    staged: StagedTable,
    root: str,
    catalog: str | None = None,
    fmt: StagingFormat = LINES,
    schema: T.StructType | None = None,
) -> str:
    """Load a staged table into the warehouse mounted as ``catalog``; every row must fit.

    ``fmt`` and ``schema`` are as in :func:`publish_staged`.
    """
    return load_table(read_staged(spark, staged.spec, root, schema, fmt), staged.spec, catalog)


def _finish(
    spark: SparkSession, staged: StagedTable, root: str, area: ServingArea, on_misfit: str
) -> Refresh:
    if not staged.spec.publish:
        return Refresh(staged)
    return publish_staged(spark, staged, root, area, on_misfit)


def _checked(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Names that publishing will need are looked up before anything is staged."""
    if spec.publish:
        resolve(rows, spec.keys, "key")
    return rows


def refresh_table(
    spark: SparkSession,
    spec: TableSpec,
    source: JdbcSource | CatalogSource,
    root: str,
    area: ServingArea,
    split: ColumnSplit | PredicateSplit | None = None,
    on_misfit: str = FAIL,
    count_source: bool = True,
) -> Refresh:
    """Extract a relational table, stage it and, if its spec says so, publish it.

    The staged rows are compared with the source's own count, so that a split
    which loses rows or reads them twice is found out. Turn ``count_source``
    off for a table that changes while it is read, if the source has no
    snapshot to read from.
    """
    rows = _checked(extract_table(spark, spec, source, split), spec)
    staged = stage_table(rows, spec, root)
    if count_source:
        expected = source.count(spark, spec)
        if staged.rows != expected:
            raise RowsLost(f"{spec.staging_path}: {staged.rows} staged, {expected} in the source")
    return _finish(spark, staged, root, area, on_misfit)


def refresh_records(
    spark: SparkSession,
    spec: TableSpec,
    pages: str,
    root: str,
    area: ServingArea,
    record: T.StructType | None = None,
    values_in: str | None = None,
    on_misfit: str = FAIL,
    beside: T.StructType | None = None,
) -> Refresh:
    """Extract landed record pages, stage them and publish them for their environment."""
    rows = _checked(extract_records(spark, pages, record, values_in, beside=beside), spec)
    return _finish(spark, stage_table(rows, spec, root), root, area, on_misfit)


def refresh_geocoded(
    spark: SparkSession,
    spec: TableSpec,
    output: TableSpec,
    rows: DataFrame,
    lookup: AddressLookup,
    query_fields: Sequence[str],
    location_fields: Sequence[str],
    root: str,
    area: ServingArea,
    removed: Sequence[str] | None = None,
    on_misfit: str = FAIL,
    **join: object,
) -> Refresh:
    """Stage ``rows``, add location fields, stage the result under ``output``, publish it.

    Each row comes out once; a lookup with a key twice would be found out.
    """
    if spec.staging_path == output.staging_path:
        raise ValueError("the geocoded table needs another name than its input")
    resolve(rows, query_fields, "query field")
    staged = stage_table(rows, spec, root)
    plain = read_staged(spark, spec, root)
    located = geocode_enrich(plain, lookup, query_fields, location_fields, removed, **join)
    found = stage_table(_checked(located, output), output, root)
    if found.rows != staged.rows:
        raise RowsLost(f"{output.staging_path}: {found.rows} rows located of {staged.rows}")
    return _finish(spark, found, root, area, on_misfit)


def publish_environments(
    spark: SparkSession,
    tables: Sequence[tuple[TableSpec, DataFrame]],
    root: str,
    areas: ServingArea | Mapping[str, ServingArea],
) -> dict[str, Refresh]:
    """Refresh one table in several environments, each from its own source.

    ``areas`` is the serving area of each environment, or one for all.
    """
    served = dict(areas) if isinstance(areas, Mapping) else {spec.environment: areas for spec, _ in tables}
    environments = [spec.environment for spec, _ in tables]
    for environment in environments:
        if environments.count(environment) > 1:
            raise ValueError(f"two sources for the {environment} environment")
        if environment not in served:
            raise ValueError(f"no serving area for the {environment} environment")
    refreshed = {}
    for spec, rows in tables:
        staged = stage_table(_checked(rows, spec), spec, root)
        refreshed[spec.environment] = publish_staged(spark, staged, root, served[spec.environment])
    return refreshed


def refresh_all(
    specs: Iterable[TableSpec], run: Callable[[TableSpec], Refresh]
) -> dict[TableSpec, Refresh | Exception]:
    """Refresh each table of a folder of configs; one that fails does not stop the others.

    ``run`` refreshes one table, from the source and to the target that go with
    its spec. Returns what came of each: its refresh or the error.
    """
    outcomes: dict[TableSpec, Refresh | Exception] = {}
    for spec in specs:
        try:
            outcomes[spec] = run(spec)
        except Exception as error:
            outcomes[spec] = error
    return outcomes
