"""The schema of record pages, found as an aggregate over all of them, and how it differs from the last one.

Types form a lattice: whole numbers below decimals below text, lists and objects by
their parts, and text above all. Every page's types are merged on the map side, so one
row per task is brought together. The merged schema is then joined with that of
the last run's sidecar: fields may come and types may widen, but a field that now
looks narrower keeps its type, and an object that became a plain value, or the
reverse, is refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.sources.records import RECORDS, IncompletePages

ADDED, MISSING, WIDENED, KEPT, BROKEN = "added", "missing", "widened", "kept", "broken"
MOST_DIGITS = 38


class SchemaBroken(TypeError):
    """A field became an object or a list and was not, or the reverse."""


@dataclass(frozen=True)
class Drift:
    """A field, by its path, whose type is not that of the last run.

    ``kept`` fields look narrower now, and keep their type; ``missing`` ones
    are in no record now, and stay, too.
    """

    path: str
    kind: str
    before: T.DataType | None
    now: T.DataType | None


def _plain(kind: T.DataType) -> T.DataType:
    """A type as records are read: text for what has no type of its own or several."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        fields = [T.StructField(f.name, join_types(f.dataType, other.pop(f.name, T.NullType()))) for f in a.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if f.name in other])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    if _number(a) and _number(b):
        if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType):
            return T.DoubleType()
        one, two = _decimal(a), _decimal(b)
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else T.DoubleType()
    return T.StringType()


def _number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.LongType, T.DecimalType, T.DoubleType))


def _decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(19, 0)


def schema_drift(last: T.StructType, now: T.StructType, path: str = "") -> list[Drift]:
    """Fields whose type changed, those of the last schema first."""
    new = {f.name: f.dataType for f in now.fields}
    found: list[Drift] = []
    for field in last.fields:
        name, before, after = f"{path}{field.name}", field.dataType, new.pop(field.name, None)
        if after is None:
            found.append(Drift(name, MISSING, before, None))
        elif isinstance(before, T.StructType) and isinstance(after, T.StructType):
            found += schema_drift(before, after, f"{name}.")
        elif _shape(before) != _shape(after) and not isinstance(after, T.NullType):
            found.append(Drift(name, BROKEN, before, after))
        elif join_types(before, after) != before:
            found.append(Drift(name, WIDENED, before, after))
        elif after != before:
            found.append(Drift(name, KEPT, before, after))
    return found + [Drift(f"{path}{f.name}", ADDED, None, f.dataType) for f in now.fields if f.name in new]


def _shape(kind: T.DataType) -> str:
    return "object" if isinstance(kind, T.StructType) else "list" if isinstance(kind, T.ArrayType) else "plain"


def infer_record_schema(
    spark: SparkSession,
    pages: str,
    last: T.StructType | None = None,
    values_in: str | None = None,
    page_per_file: bool = False,
) -> tuple[T.StructType, list[Drift]]:
    """The schema of all records of landed pages, and how it differs from ``last``.

    Whole numbers are ``bigint``, others decimals with as many digits as any
    value needs (``double`` beyond 38), values of several types and values that are always
    null are text. The schema is never narrower than ``last``, whose
    fields come first, in their order; :class:`SchemaBroken` names the fields that
    cannot be both. A page without a list of records fails. ``values_in`` and
    ``page_per_file`` are as in ``extract_records``.
    """
    text = spark.read.text(pages, wholetext=True) if page_per_file else spark.read.text(pages).where("trim(value) <> ''")
    listed = F.try_variant_get(F.parse_json("value"), f"$.{RECORDS}", "array<variant>")
    failure = F.raise_error(F.lit(f"{pages}: a page has no list of {RECORDS}")).cast("array<variant>")
    records = text.select(F.explode(F.coalesce(listed, failure)).alias("record"))
    value = F.try_variant_get("record", f"$.{values_in}", "variant") if values_in else F.col("record")
    told = records.select(F.schema_of_variant_agg(value).alias("kind")).first().kind
    kind = T.DataType.fromDDL(told.replace("OBJECT<", "STRUCT<")) if told else T.NullType()
    if not isinstance(kind, T.StructType):
        if not isinstance(kind, T.NullType) or last is None:
            raise IncompletePages(f"{pages}: the records are not objects, or there are none")
        kind = T.StructType([])
    now = kind
    if last is None:
        return _plain(now), []
    drift = schema_drift(last, now)
    broken = [change.path for change in drift if change.kind == BROKEN]
    if broken:
        raise SchemaBroken(f"{pages}: no longer what they were: {', '.join(broken)}")
    return _plain(join_types(last, now)), drift


def drift_rows(spark: SparkSession, drift: list[Drift]) -> DataFrame:
    """The changes as a table: path, kind, before, now."""
    rows = [(d.path, d.kind, *(t.simpleString() if t else None for t in (d.before, d.now))) for d in drift]
    return spark.createDataFrame(rows, "path string, kind string, before string, now string")
