"""Tables from an application's record pages, landed as JSON files.

A page is one JSON object whose ``records`` field is a list of record objects.
Each line of a landed file is one page, or each file is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column
from quayload.spec import quote
from quayload.staging import JSON_WRITE, TIME_OPTIONS

RECORDS = "records"


class IncompletePages(RuntimeError):
    """Landed pages do not have what a page must have."""


def _page_schema(
    record: T.StructType, values_in: str | None, beside: T.StructType | None
) -> T.StructType:
    if values_in:
        record = T.StructType([*(beside.fields if beside else ()), T.StructField(values_in, record)])
    return T.StructType([T.StructField(RECORDS, T.ArrayType(record))])


def _faulty(listed: Column) -> Column:
    return listed.isNull() | F.exists(listed, lambda r: r.isNull())


def extract_records(
    spark: SparkSession,
    pages: str,
    record: T.StructType | None = None,
    values_in: str | None = None,
    nested_as_json: bool = False,
    page_per_file: bool = False,
    beside: T.StructType | None = None,
    skip_incomplete: bool = False,
) -> DataFrame:
    """One row per record of all landed pages.

    ``record`` is the schema of a record's values; without it Spark infers one
    from all pages. ``values_in`` names the field of a record that holds its
    values, for applications that wrap them (``{"id": …, "fields": {…}}``).
    Nested values are kept, or become JSON text with ``nested_as_json``.
    ``beside`` are the columns such records have next to their values, such as
    their id and the time they were made; they come first.
    ``page_per_file`` reads pages that are spread over several lines.
    A page that is not valid JSON, has no list of records (an error page), or
    has a record that is null, fails the read instead of losing records; with
    ``skip_incomplete`` pages without a list and null records are left out, and
    :func:`count_incomplete` tells how many pages have such a fault.
    """
    reader = spark.read.options(mode="FAILFAST", multiLine=page_per_file, **TIME_OPTIONS)
    if record is not None:
        reader = reader.schema(_page_schema(record, values_in, beside))
    read = reader.json(pages)
    if RECORDS not in read.columns:
        raise IncompletePages(f"{pages}: no page has a list of {RECORDS}")
    listed = column(RECORDS)
    if not skip_incomplete:
        failure = F.raise_error(F.lit(f"{pages}: a page has no list of {RECORDS}, or one that is null"))
        listed = F.when(_faulty(listed), failure.cast(read.schema[RECORDS].dataType)).otherwise(listed)
    else:
        listed = F.filter(listed, lambda r: r.isNotNull())
    rows = read.select(F.inline(listed))
    if values_in:
        own = [column(f.name) for f in beside.fields] if beside else []
        rows = rows.select(*own, f"{quote(values_in)}.*")
    if not nested_as_json:
        return rows
    return rows.select(
        *[
            F.to_json(column(f.name), JSON_WRITE).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
            else column(f.name)
            for f in rows.schema.fields
        ]
    )


def count_incomplete(spark: SparkSession, pages: str, page_per_file: bool = False) -> int:
    """How many landed pages have no list of records, or a record that is null."""
    schema = T.StructType([T.StructField(RECORDS, T.ArrayType(T.StringType()))])
    read = spark.read.options(mode="FAILFAST", multiLine=page_per_file).schema(schema).json(pages)
    return read.where(_faulty(column(RECORDS))).count()


def land_records(df: DataFrame, pages: str, page_rows: int = 500, values_in: str | None = None) -> None:
    """Write ``df`` the way a page client lands it, at most ``page_rows`` records a page.

    Pages are cut by position within an input partition, so a page is bounded
    whatever the values are.
    """
    value = F.struct(*[column(name) for name in df.columns])
    record = F.struct(value.alias(values_in)) if values_in else value
    page = F.floor(F.monotonically_increasing_id() / page_rows)
    (
        df.select(page.alias("page"), record.alias("record"))
        .groupBy("page")
        .agg(F.to_json(F.struct(F.collect_list("record").alias(RECORDS)), JSON_WRITE).alias("value"))
        .select("value")
        .write.mode("errorifexists")
        .text(pages)
    )
