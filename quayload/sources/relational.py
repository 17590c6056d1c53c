"""Whole-table extraction from relational sources.

:class:`JdbcSource` reads one table over parallel JDBC connections.
:class:`CatalogSource` reads from any mounted Spark catalog; a database mounted
with Spark's JDBC catalog and a lake catalog look the same to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, resolve
from quayload.functions.quantiles import WHOLE, quantiles
from quayload.spec import TableSpec, quote


@dataclass(frozen=True)
class ColumnSplit:
    """Split the read by ranges of an evenly spread numeric, date or timestamp column.

    Rows outside the bounds and rows with a null are still read, by the first
    and the last partition.
    """

    column: str
    lower: str
    upper: str
    partitions: int

    def __post_init__(self) -> None:
        if self.partitions < 1:
            raise ValueError("a split needs at least one partition")


@dataclass(frozen=True)
class PredicateSplit:
    """Split the read by predicates of which exactly one holds for each row."""

    predicates: tuple[str, ...]

    def __post_init__(self) -> None:
        if not self.predicates or not all(p.strip() for p in self.predicates):
            raise ValueError("a split needs predicates, of which one holds for each row")


def range_split(column: str, bounds: Sequence[str]) -> PredicateSplit:
    """Ranges between sorted SQL literals, for keys whose values are not evenly spread.

    The lowest range also takes the rows with a null.
    """
    if not bounds:
        return PredicateSplit(("1 = 1",))
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(bounds, bounds[1:])]
    lowest = f"{column} < {bounds[0]} OR {column} IS NULL"
    return PredicateSplit((lowest, *inner, f"{column} >= {bounds[-1]}"))


def bucket_split(bucket: str, partitions: int) -> PredicateSplit:
    """One predicate per value of ``bucket``, an SQL expression over ``{last}``.

    ``bucket`` must yield the numbers 0 to ``{last}``, such as
    ``ORA_HASH(ROWID, {last})``; the first partition also takes the rows for
    which it is null. A hash of the row address spreads the rows
    evenly whatever their key values are, so no hot key can fill one partition.
    """
    if partitions < 1:
        raise ValueError("a split needs at least one partition")
    expression = bucket.format(last=partitions - 1)
    first = f"{expression} = 0 OR {expression} IS NULL"
    return PredicateSplit((first, *(f"{expression} = {i}" for i in range(1, partitions))))


#: Columns a split can be planned by; their values are written the same in all SQL dialects.
SPLIT_TYPES = (*WHOLE, T.DecimalType, T.DateType, T.TimestampNTZType)


def sql_literal(kind: T.DataType, value: object) -> str:
    """A number, date or time as SQL has it."""
    if isinstance(kind, T.DateType):
        return f"DATE '{value.isoformat()}'"
    if isinstance(kind, T.TimestampNTZType):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return str(value)


def plan_split(df: DataFrame, columns: Sequence[str], parts: int) -> PredicateSplit:
    """A split of a table into about ``parts`` even reads, from the rows of ``df``.

    ``df`` is the table, or its last staged copy: only the named columns are
    read, and summarised where they are. The first column is cut at its
    quantiles, whatever its values are. A value that holds more than a part's
    share gets reads of its own; they are cut by the second column, as many
    times as its share asks for, and so on. A value that has no further column
    stays one read. Rows with a null are in the lowest read of their column. The
    predicates are right for any state of the table; only their evenness comes
    from ``df``. Columns must be whole numbers, decimals, dates or times.
    """
    names = resolve(df, columns, "column to split by")
    wrong = [name for name in names if not isinstance(df.schema[name].dataType, SPLIT_TYPES)]
    if parts < 1 or not names or wrong:
        raise ValueError(f"a split needs one part and one column at least, and no text: {', '.join(wrong)}")
    return PredicateSplit(tuple(_planned(df, names, {"": (F.lit(True), parts)})))


def _both(given: str, more: str) -> str:
    return f"{given} AND {more}" if given else more


def _planned(df: DataFrame, names: Sequence[str], wanted: Mapping[str, tuple[Column, int]]) -> list[str]:
    """Predicates for each wanted one (as SQL, and as a condition on ``df``), cut into so many parts by the columns left."""
    done = [given or "1 = 1" for given, (_, parts) in wanted.items() if parts < 2 or not names]
    open_ = {given: how for given, how in wanted.items() if how[1] > 1 and names}
    if not open_:
        return done
    name, kind = names[0], df.schema[names[0]].dataType
    which = F.coalesce(*[F.when(rows, F.lit(i)) for i, (rows, _) in enumerate(open_.values())])
    most = max(parts for _, parts in open_.values())
    values = df.select(which.alias("of"), column(name).alias("value")).where("of IS NOT NULL AND value IS NOT NULL")
    # one short list for each part that is still to be cut
    found = dict(values.groupBy("of").agg(quantiles(F.col("value"), most).alias("cut")).collect())
    deeper: dict[str, tuple[Column, int]] = {}
    for i, (given, (rows, parts)) in enumerate(open_.items()):
        ends = found.get(i, [])
        taken = [ends[(j + 1) * most // parts - 1] for j in range(parts - 1)] if ends else []
        low = ""
        for value in sorted(set(taken)):
            text = sql_literal(kind, value)
            done.append(_both(given, f"{low} AND {name} < {text}" if low else f"({name} < {text} OR {name} IS NULL)"))
            low = f"{name} >= {text}"
            if taken.count(value) > 1:
                deeper[_both(given, f"{name} = {text}")] = (rows & (column(name) == F.lit(str(value)).cast(kind)), taken.count(value))
                low = f"{name} > {text}"
        done.append(_both(given, low) or "1 = 1")
    return done + (_planned(df, names[1:], deeper) if deeper else [])


@dataclass(frozen=True)
class JdbcSource:
    """A relational source. Credentials stay in ``properties`` and out of any repr.

    ``projection`` maps column names to SQL expressions, for types JDBC cannot
    carry (a geometry as text). ``snapshot`` is appended to the table name, so
    that all partitions read one state of a changing table (such as
    ``AS OF SCN 1234``). ``custom_schema`` sets exact types, such as an
    unscaled number's precision. Without a split a table is read by one task
    over one connection; that must be asked for with ``one_task``.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    fetch_size: int = 10_000
    custom_schema: str | None = None
    projection: Mapping[str, str] | None = None
    snapshot: str | None = None
    one_task: bool = False

    def relation(self, spec: TableSpec) -> str:
        table = f"{spec.source_schema}.{spec.table}"
        if not self.projection and not self.snapshot:
            return table
        projection = self.projection or {"*": "*"}
        columns = ", ".join(
            expression if expression == name else f"{expression} AS {name}"
            for name, expression in projection.items()
        )
        return f"(SELECT {columns} FROM {table} {self.snapshot or ''}".rstrip() + ") src"

    def options(self) -> dict[str, str]:
        options = {
            **self.properties,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        if self.custom_schema:
            options["customSchema"] = self.custom_schema
        return options

    def read(
        self,
        spark: SparkSession,
        spec: TableSpec,
        split: ColumnSplit | PredicateSplit | None = None,
    ) -> DataFrame:
        relation, options = self.relation(spec), self.options()
        if split is None and not self.one_task:
            raise ValueError(f"{spec.table}: give a split, or ask for a read by one task")
        if isinstance(split, PredicateSplit):
            return spark.read.jdbc(
                self.url, relation, predicates=list(split.predicates), properties=options
            )
        reader = spark.read.format("jdbc").options(**options, url=self.url, dbtable=relation)
        if split:
            reader = reader.options(
                partitionColumn=split.column,
                lowerBound=split.lower,
                upperBound=split.upper,
                numPartitions=str(split.partitions),
            )
        return reader.load()


    def count(self, spark: SparkSession, spec: TableSpec) -> int:
        """Rows of the table, counted by the database."""
        query = f"(SELECT COUNT(*) AS n FROM {self.relation(spec)}) counted"
        reader = spark.read.format("jdbc").options(**self.options(), url=self.url, dbtable=query)
        return int(reader.load().first()[0])


@dataclass(frozen=True)
class CatalogSource:
    """A source mounted as a Spark catalog; ``None`` means the session catalog."""

    catalog: str | None = None

    def read(
        self,
        spark: SparkSession,
        spec: TableSpec,
        split: ColumnSplit | PredicateSplit | None = None,
    ) -> DataFrame:
        if isinstance(split, PredicateSplit):
            raise ValueError("a catalog source can only be split by a column")
        parts = [part for part in (self.catalog, spec.source_schema, spec.table) if part]
        reader = spark.read
        if split:
            reader = reader.options(
                partitionColumn=split.column,
                lowerBound=split.lower,
                upperBound=split.upper,
                numPartitions=str(split.partitions),
            )
        return reader.table(".".join(map(quote, parts)))

    def count(self, spark: SparkSession, spec: TableSpec) -> int:
        return self.read(spark, spec).count()


def extract_table(
    spark: SparkSession,
    spec: TableSpec,
    source: JdbcSource | CatalogSource,
    split: ColumnSplit | PredicateSplit | None = None,
) -> DataFrame:
    """One whole source table as a lazy DataFrame; filters and columns push down."""
    return source.read(spark, spec, split)
