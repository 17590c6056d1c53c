"""Staged tables: CSV text plus a schema sidecar, with every value preserved.

A staged table is a folder of CSV part files. Text columns are written with
line breaks escaped, so each record is one physical line: the files can be cut
at any line into even input splits, however large they are and however wide
their rows. Reading never infers a type, and whether a row fits its sidecar
does not depend on which columns a query happens to use.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, combine
from quayload.functions.text import escape_lines, unescape_lines
from quayload.sidecar import NESTED_TYPES, check_schema, read_sidecar, remove_sidecar, write_sidecar
from quayload.spec import TableSpec, quote

TIMESTAMP_NTZ_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIMESTAMP_PATTERN = TIMESTAMP_NTZ_PATTERN + "XXX"
TIME_OPTIONS = {
    "timestampFormat": TIMESTAMP_PATTERN,
    "timestampNTZFormat": TIMESTAMP_NTZ_PATTERN,
    "timeZone": "UTC",
}
JSON_WRITE = {**TIME_OPTIONS, "ignoreNullFields": "false"}
JSON_BAD = "_bad"
JSON_READ = {**TIME_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": JSON_BAD}

MISFIT = "_quayload_misfit"
SOURCE = "_quayload_source"
RAW_RECORD = "_quayload_raw"
CORRUPT = "_quayload_corrupt"
# About what a timestamp, and what a number or date takes in text.
TIME_BYTES = 26
NUMBER_BYTES = 8
# A staged file is closed after this many rows and another begun.
FILE_ROWS = 10_000_000
# Numbers in text: for decimals the digits before and after the point and the
# exponent; for floating point also the names the writer uses. Blanks around a
# number of any type do not matter.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?\s*$"
FLOAT_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_NAMES = ("NaN", "Infinity", "-Infinity", "Inf", "-Inf")
# So many digits tell any value of a type from all others; text with more is no value of it.
FLOAT_DIGITS, DOUBLE_DIGITS = 9, 17
# Options about files, which rendering a single record has no use for.
FILE_OPTIONS = ("header", "encoding", "multiLine", "lineSep")


@dataclass(frozen=True)
class StagingFormat:
    """How staged text is written. The default is lossless and splittable.

    ``PLAIN_CSV`` reads files other tools wrote: quoted line breaks, no
    escapes, an empty field (quoted or not) for null, any ISO time form. Such files cannot be
    split, so they should come as many files of moderate size.
    """

    null_marker: str = "\\N"
    escaped: bool = True

    def options(self) -> dict[str, str]:
        options = {
            "header": "true",
            "encoding": "UTF-8",
            "sep": ",",
            "quote": '"',
            "escape": '"',
            "nullValue": self.null_marker,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }
        if self.escaped:
            options.update(TIME_OPTIONS, dateFormat="yyyy-MM-dd", lineSep="\n")
        else:
            options["multiLine"] = "true"
        return options


LINES = StagingFormat()
PLAIN_CSV = StagingFormat(null_marker="", escaped=False)


@dataclass(frozen=True)
class StagedTable:
    """A staged table, with its rows and about how many bytes of text they are.

    Both are ``None`` when another tool staged it.
    """

    spec: TableSpec
    path: str
    rows: int | None = None
    bytes: int | None = None


@dataclass(frozen=True)
class TypedLoad:
    """Staged rows that fit the sidecar, and those that do not.

    Both are lazy views of one parse; ``parsed`` has all rows with the misfit
    flag, for callers that need both in a single pass.
    """

    parsed: DataFrame
    names: tuple[str, ...]

    @property
    def rows(self) -> DataFrame:
        return self.parsed.where(~column(MISFIT)).select(*map(column, self.names))

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.where(column(MISFIT)).select(
            column(RAW_RECORD).alias("raw_record"), column(SOURCE).alias("source_file")
        )


def _to_text(df: DataFrame) -> DataFrame:
    """Columns as they are staged: nested ones as JSON, and text on one line."""
    as_json = {
        f.name: F.to_json(column(f.name), JSON_WRITE)
        for f in df.schema.fields
        if isinstance(f.dataType, NESTED_TYPES)
    }
    if as_json:
        df = df.select(*[as_json.get(name, column(name)).alias(name) for name in df.columns])

    def text(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.StringType):
            return escape_lines(field.name).alias(field.name)
        if isinstance(field.dataType, T.BinaryType):
            return F.base64(column(field.name)).alias(field.name)
        return column(field.name)

    return df.select(*[text(field) for field in df.schema.fields])


def _text_bytes(text: DataFrame) -> Column:
    """About how many bytes of text a row is; exact for text columns."""
    known, widths = len(text.columns), []
    for field in text.schema.fields:
        if isinstance(field.dataType, T.StringType):
            widths.append(F.expr(f"bigint(coalesce(octet_length({quote(field.name)}), 2))"))
        else:
            times = (T.TimestampType, T.TimestampNTZType)
            known += TIME_BYTES if isinstance(field.dataType, times) else NUMBER_BYTES
    return combine(Column.__add__, [F.lit(known).cast("bigint"), *widths])


def stage_table(
    df: DataFrame, spec: TableSpec, root: str, compression: str | None = None
) -> StagedTable:
    """Write ``df`` to its staging place, replacing what is there, with its sidecar.

    No shuffle: each task writes its own partition. Rows and bytes are counted
    by the writing job itself. ``df`` must not read the place it is staged to.
    A ``compression`` saves space, but compressed files are read whole by one
    task each, so it suits inputs that are already in moderate partitions.
    """
    check_schema(df.schema)
    counted = Observation()
    path = f"{root}/{spec.staging_path}"
    text = _to_text(df)
    text = text.observe(
        counted,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_text_bytes(text)), F.lit(0)).alias("bytes"),
    )
    writer = text.write.mode("overwrite").options(**LINES.options(), maxRecordsPerFile=FILE_ROWS)
    if compression:
        writer = writer.option("compression", compression)
    remove_sidecar(df.sparkSession, spec, root)
    # A lone blank field would be a blank line, which CSV readers skip.
    writer.option("quoteAll", len(text.columns) == 1).csv(path)
    write_sidecar(df.sparkSession, df.schema, spec, root)
    return StagedTable(spec, path, **counted.get)


def read_type(data_type: T.DataType) -> T.DataType:
    """The type the CSV reader itself converts to; the rest is converted from text."""
    numbers = (*WHOLE_TYPES, T.DecimalType, T.FloatType, T.DoubleType)
    as_text = (*NESTED_TYPES, *numbers, T.StringType, T.BinaryType)
    return T.StringType() if isinstance(data_type, as_text) else data_type


def convert_field(field: T.StructField, fmt: StagingFormat) -> tuple[Column, Column | None]:
    """The typed value of a column as it was read, and whether its text does not fit.

    Where the reader itself has found that out, there is no second answer.
    """
    value = column(field.name)
    if isinstance(field.dataType, T.StringType):
        return (unescape_lines(field.name) if fmt.escaped else value), None
    if isinstance(field.dataType, NESTED_TYPES):
        wrapper = T.StructType(
            [T.StructField("v", field.dataType), T.StructField(JSON_BAD, T.StringType())]
        )
        text = unescape_lines(field.name) if fmt.escaped else value
        parsed = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), wrapper, JSON_READ)
        # Text that closes the wrapper's brace to go on cannot also be the one element of a list.
        one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
        single = text.isNull() | F.coalesce(one, F.lit(False))
        return parsed["v"], F.coalesce(parsed[JSON_BAD].isNotNull(), F.lit(False)) | ~single
    if isinstance(field.dataType, T.BinaryType):
        typed = F.try_to_binary(value, F.lit("base64"))
        return typed, value.isNotNull() & typed.isNull()
    if isinstance(field.dataType, WHOLE_TYPES):
        typed = value.try_cast(field.dataType)
        return typed, value.isNotNull() & typed.isNull()
    if isinstance(field.dataType, T.DecimalType):
        typed = value.try_cast(field.dataType)
        exact = typed.isNotNull() & (_fraction_digits(value) <= field.dataType.scale)
        return typed, value.isNotNull() & ~F.coalesce(exact, F.lit(False))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        typed = value.try_cast(field.dataType)
        most = FLOAT_DIGITS if isinstance(field.dataType, T.FloatType) else DOUBLE_DIGITS
        number = value.rlike(FLOAT_TEXT) & typed.isNotNull() & (F.abs(typed) < float("inf"))
        number = number & (_significant_digits(value) <= most)
        return typed, value.isNotNull() & ~(F.coalesce(number, F.lit(False)) | value.isin(*FLOAT_NAMES))
    return value, None


def _significant_digits(text: Column) -> Column:
    """Digits of a number's text without zeros at either end."""
    digits = F.regexp_replace(F.regexp_extract(text, "^[^eE]*", 0), "[^0-9]", "")
    return F.length(F.trim(digits, F.lit("0")))


def _fraction_digits(text: Column) -> Column:
    """Digits after the point that a decimal's text needs: without trailing zeros, moved by the exponent."""
    whole, fraction, exponent = (F.regexp_extract(text, DECIMAL_TEXT, i) for i in (1, 2, 3))
    digits = F.concat(whole, fraction)
    needed = F.rtrim(digits, F.lit("0"))
    shift = F.when(exponent == "", 0).otherwise(exponent.try_cast("int"))
    places = F.length(fraction) - shift - (F.length(digits) - F.length(needed))
    return F.when(~text.rlike(DECIMAL_TEXT), F.lit(None)).when(needed == "", 0).otherwise(places)


def typed_load(
    spark: SparkSession,
    spec: TableSpec,
    root: str,
    schema: T.StructType | None = None,
    fmt: StagingFormat = LINES,
) -> TypedLoad:
    """Apply the sidecar to staged text and tell fitting rows from the rest.

    A row is a misfit when it has too few or too many fields, or when a field
    cannot be converted to its type exactly. Floating point is the nearest
    value, and a text with more digits than its type can tell apart (9 for a
    float, 17 for a double) is a misfit. Blanks around a number are ignored,
    whatever its type. Files whose header does not match the sidecar fail the read.
    """
    schema = schema or read_sidecar(spark, spec, root)
    check_schema(schema)
    fields, names = schema.fields, tuple(schema.fieldNames())
    read_schema = T.StructType(
        [T.StructField(f.name, read_type(f.dataType)) for f in fields]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    staged = (
        spark.read.schema(read_schema)
        .options(**fmt.options())
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(f"{root}/{spec.staging_path}")
    )
    converted = [convert_field(field, fmt) for field in fields]
    flags = [flag for _, flag in converted if flag is not None]
    misfit = combine(Column.__or__, [column(CORRUPT).isNotNull(), *flags])
    as_read = F.struct(*[column(name) for name in names])
    rendered = F.to_csv(as_read, {k: v for k, v in fmt.options().items() if k not in FILE_OPTIONS})
    parsed = staged.select(
        *[value.alias(name) for (value, _), name in zip(converted, names)],
        misfit.alias(MISFIT),
        F.when(misfit, F.coalesce(column(CORRUPT), rendered)).alias(RAW_RECORD),
        F.when(misfit, F.input_file_name()).alias(SOURCE),
    )
    # The reader checks only the columns a query uses, so a query for one column
    # would take rows whose other columns are bad. Counting over all columns
    # keeps every one of them in the parse, whatever is selected later. It also
    # keeps filters above the conversions, which are then made once per row.
    blank = F.expr(" AND ".join(f"{quote(name)} IS NULL" for name in names))
    parsed = parsed.observe(
        f"typed_load_{uuid.uuid4().hex}",
        F.count_if(column(MISFIT)).alias("misfits"),
        F.count_if(blank).alias("blank"),
    )
    return TypedLoad(parsed, names)


def read_staged(
    spark: SparkSession,
    spec: TableSpec,
    root: str,
    schema: T.StructType | None = None,
    fmt: StagingFormat = LINES,
) -> DataFrame:
    """Read a staged table back; the first row that does not fit fails the job."""
    load = typed_load(spark, spec, root, schema, fmt)
    message = F.concat(F.lit(f"{spec.staging_path}: row does not fit: "), column(RAW_RECORD))
    fits = F.when(column(MISFIT), F.raise_error(message).cast("boolean")).otherwise(True)
    return load.parsed.where(fits).select(*map(column, load.names))
