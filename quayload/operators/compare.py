"""Compare two tables by content: fingerprints first, rows only where these differ.

The fingerprint of a set of rows is their number and sums of pieces of their
64-bit hashes. It doesn't depend on the order of the rows, counts each row as
often as it is there, and adds up: that of a range is the sum of its parts'. So
one aggregate over each table, combined on the map side, gives a tree of
fingerprints, and only rows under leaves that differ are read again and
shuffled. Two tables that differ by chance have equal fingerprints about once in
2**64.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, combine, resolve
from quayload.functions.quantiles import Bounds, quantile_bounds, rank_steps, reaches
from quayload.sinks.publish import Range, condition
from quayload.spec import quote

LEAF = "_quayload_leaf"
TIMES = "_quayload_times"
#: Children of a node, and leaves of a tree.
FAN_OUT, LEAVES = 16, 4096
#: Ranges that are asked for one by one; beyond, one range around all.
MOST_RANGES = 32
#: Bits of a hash that are summed on their own, so that no sum of 2**41 rows overflows.
PIECES = ((0, 21), (21, 21), (42, 22))

Fingerprint = tuple[int, ...]


class DifferentColumns(ValueError):
    """Two tables that are to be compared do not have the same columns."""


def comparable(df: DataFrame) -> DataFrame:
    """The table with maps, which have no order and no hash, as sorted lists of their entries."""
    if not any(_has_map(f.dataType) for f in df.schema.fields):
        return df
    return df.select(*[_without_maps(column(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def _without_maps(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(e["key"].alias("key"), _without_maps(e["value"], kind.valueType).alias("value")),
        )
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType) and _has_map(kind):
        return F.transform(value, lambda element: _without_maps(element, kind.elementType))
    if isinstance(kind, T.StructType) and _has_map(kind):
        fields = [_without_maps(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def row_hash(names: Sequence[str]) -> Column:
    """A 64-bit hash of a row's values; a null counts, wherever it is."""
    return F.xxhash64(*[F.struct(column(name).isNull(), column(name)) for name in names])


def fingerprints(df: DataFrame, part: str) -> DataFrame:
    """For each value of the column ``part``: its rows and the sums over their other columns."""
    names = [name for name in df.columns if name != part]
    hashed = df.select(column(part), row_hash(names).alias("hash"))
    sums = [
        F.sum(F.shiftrightunsigned("hash", low).bitwiseAND((1 << width) - 1)).alias(f"sum{i}")
        for i, (low, width) in enumerate(PIECES)
    ]
    return hashed.groupBy(column(part)).agg(F.count(F.lit(1)).alias("rows"), *sums)


class Tree:
    """Fingerprints of leaves, and of all nodes above them."""

    def __init__(self, leaves: Mapping[int, Fingerprint], size: int):
        self.levels: list[dict[int, Fingerprint]] = [dict(leaves)]
        while size > 1:
            above: dict[int, Fingerprint] = {}
            for node, mark in self.levels[-1].items():
                old = above.get(node // FAN_OUT, (0,) * len(mark))
                above[node // FAN_OUT] = tuple(a + b for a, b in zip(old, mark))
            self.levels.append(above)
            size = -(-size // FAN_OUT)

    @classmethod
    def of(cls, df: DataFrame, leaf: str, size: int) -> Tree:
        """Of a table whose column ``leaf`` has numbers below ``size``; as many rows come to the driver."""
        return cls({row[0]: tuple(row[1:]) for row in fingerprints(df, leaf).collect()}, size)

    @property
    def rows(self) -> int:
        return sum(mark[0] for mark in self.levels[-1].values())

    def leaf_rows(self, leaf: int) -> int:
        return self.levels[0].get(leaf, (0,))[0]

    def differing(self, other: Tree) -> list[int]:
        """Leaves that differ, found from the root down; equal nodes are not entered."""
        nodes = [0]
        for depth in range(len(self.levels) - 1, -1, -1):
            mine, theirs = self.levels[depth], other.levels[depth]
            nodes = [node for node in nodes if mine.get(node) != theirs.get(node)]
            if depth:
                nodes = [child for node in nodes for child in range(node * FAN_OUT, (node + 1) * FAN_OUT)]
        return nodes


@dataclass(frozen=True)
class DifferingRange:
    """Keys from ``low`` to below ``high`` (``None``: open), and the rows that each side has there.

    Bounds are as :mod:`quayload.functions.quantiles` has them; nulls are in the
    range that is open below.
    """

    low: float | bytes | None
    high: float | bytes | None
    left_rows: int
    right_rows: int


@dataclass(frozen=True)
class Reconciliation:
    """What comparing two tables came to.

    ``differences`` has the rows that one side has more often than the other,
    with ``side`` (``left`` or ``right``) and ``times``.
    """

    left_rows: int
    right_rows: int
    ranges: tuple[DifferingRange, ...]
    differences: DataFrame

    @property
    def equal(self) -> bool:
        return not self.ranges


def _same_columns(left: DataFrame, right: DataFrame) -> None:
    mine, theirs = ({f.name: f.dataType for f in df.schema.fields} for df in (left, right))
    names = sorted(name for name in mine.keys() | theirs.keys() if mine.get(name) != theirs.get(name))
    if names:
        raise DifferentColumns(f"different names or types: {', '.join(names)}")
    if len(mine) != len(left.columns) or len(theirs) != len(right.columns):
        raise DifferentColumns("a name occurs twice")


def surplus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one of two tables with the same columns has more often, with ``side`` and ``times``.

    Rows are brought together by all their columns and added up, with +1 for
    each on the left and -1 for each on the right. Equal rows are combined
    before the shuffle, however many there are.
    """
    names = left.columns
    signed = left.withColumn(TIMES, F.lit(1)).unionByName(right.withColumn(TIMES, F.lit(-1)))
    summed = signed.groupBy(*map(column, names)).agg(F.sum(TIMES).alias(TIMES)).where(column(TIMES) != 0)
    return summed.select(
        *map(column, names),
        F.when(column(TIMES) > 0, "left").otherwise("right").alias("side"),
        F.abs(column(TIMES)).alias("times"),
    )


def _within(field: T.StructField, bounds: Bounds, leaves: Sequence[int]) -> Column:
    """A condition that sources can use and that all rows of the leaves fulfil."""
    runs: list[list[int]] = []
    for leaf in leaves:
        if runs and runs[-1][1] == leaf - 1:
            runs[-1][1] = leaf
        else:
            runs.append([leaf, leaf])
    if len(runs) > MOST_RANGES:
        runs = [[runs[0][0], runs[-1][1]]]
    conditions = []
    for first, last in runs:
        low = reaches(field, bounds[first - 1]) if first else None
        high = reaches(field, bounds[last], above=True) if last < len(bounds) else None
        if low is None and high is None:
            return F.lit(True)
        inside = condition(field, Range(low, high))
        conditions.append(inside if first else inside | column(field.name).isNull())
    return combine(Column.__or__, conditions) if conditions else F.lit(False)


def _with_leaves(df: DataFrame, key: str, bounds: Bounds) -> DataFrame:
    return comparable(rank_steps(df, {key: bounds}, {key: LEAF}))


def reconcile(left: DataFrame, right: DataFrame, key: str, bounds: Bounds | None = None, leaves: int = LEAVES) -> Reconciliation:
    """Whether two tables with the same columns have the same rows, each as often; and which rows differ.

    Each side is read once, for fingerprints of ranges of ``key``; then, if
    some differ, the rows of those ranges are read again, by a condition that
    goes down to the source, and compared. ``bounds`` cut the ranges: those the
    extract was split by, say. Without them the key column of ``right`` is read
    once more to find bounds that make even ranges. Nulls are a value like
    others. A key with a third of the rows is one range, whose rows are
    compared by all their columns, not in one task. Empty tables are equal.
    """
    _same_columns(left, right)
    [key] = resolve(left, [key], "key")
    if bounds is None:
        bounds = quantile_bounds(right, {key: leaves})[key]
    trees = [Tree.of(_with_leaves(df, key, bounds), LEAF, len(bounds) + 1) for df in (left, right)]
    found = trees[0].differing(trees[1])
    ranges = tuple(
        DifferingRange(
            bounds[leaf - 1] if leaf else None,
            bounds[leaf] if leaf < len(bounds) else None,
            *(tree.leaf_rows(leaf) for tree in trees),
        )
        for leaf in found
    )
    near = _within(left.schema[key], bounds, found)
    inside = column(LEAF).isin(found) if found else F.lit(False)
    again = [_with_leaves(df.where(near), key, bounds).where(inside).drop(LEAF) for df in (left, right)]
    return Reconciliation(trees[0].rows, trees[1].rows, ranges, surplus(*again))


BUCKETS = 1 << 14


def diff_versions(old: DataFrame, new: DataFrame, keys: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """What became of a table from one version to the next, row by row, each as often as it is there.

    All columns, ``change`` and ``times``. Without keys a row is ``removed`` or
    ``added``. With keys, rows whose key has both kinds are ``changed_from`` and
    ``changed_to`` instead. Rows go to buckets by the hash of their keys, of the
    whole row if there are none; only those of buckets whose fingerprints
    differ are compared. Equal rows cancel out before the shuffle, so what is
    brought together are different rows of changed buckets. Versions must have
    the same columns; nulls and NaN equal themselves. Empty versions are as any.
    """
    _same_columns(old, new)
    keys = resolve(old, keys, "key")
    parts = []
    for df in (old, new.select(*map(column, old.columns))):
        plain = comparable(df)
        by = keys or plain.columns
        parts.append(plain.withColumn(LEAF, F.pmod(row_hash(by), F.lit(buckets)).cast("int")))
    trees = [Tree.of(part, LEAF, buckets) for part in parts]
    found = trees[0].differing(trees[1])
    if not found:
        differing = [part.where(F.lit(False)).drop(LEAF) for part in parts]
    elif 2 * len(found) > buckets:
        differing = [part.drop(LEAF) for part in parts]
    else:
        differing = [part.where(column(LEAF).isin(found)).drop(LEAF) for part in parts]
    rows = surplus(*differing)
    change = F.when(F.col("side") == "left", "removed").otherwise("added")
    if keys:
        # rows of one key that changed; a key with very many of them is combined before the shuffle
        sides = rows.groupBy(*map(column, keys)).agg(F.count_distinct("side").alias("sides"))
        same_key = combine(Column.__and__, [F.col(f"r.{quote(k)}").eqNullSafe(F.col(f"s.{quote(k)}")) for k in keys])
        both = sides.where(F.col("sides") == 2).drop("sides")
        rows = rows.alias("r").join(both.withColumn("both", F.lit(True)).alias("s"), same_key, "left").select("r.*", "both")
        changed = F.when(F.col("side") == "left", "changed_from").otherwise("changed_to")
        change = F.when(F.col("both"), changed).otherwise(change)
    return rows.select(*map(column, old.columns), change.alias("change"), "times")
