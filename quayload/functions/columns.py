"""Helpers to name and combine columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayload.spec import quote


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(quote(name))


def resolve(df: DataFrame, names: Sequence[str], what: str) -> list[str]:
    """The table's own spelling of ``names``, by the session's rule for letter case.

    An exact match goes first; a name that is unknown, or fits several columns,
    is an error.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    found, unknown = [], []
    for name in names:
        same = [c for c in df.columns if c == name]
        if not same and not exact:
            same = [c for c in df.columns if c.lower() == name.lower()]
        if len(same) == 1:
            found += same
        else:
            unknown.append(name)
    if unknown:
        raise ValueError(f"unknown {what}: {', '.join(unknown)}")
    return found


def combine(operation: Callable[[Column, Column], Column], columns: Sequence[Column]) -> Column:
    """Combine with an associative operation, as a balanced tree.

    A chain as deep as a table is wide would take the analyser one round for
    every column, and fails on wide tables.
    """
    while len(columns) > 1:
        pairs = zip(columns[::2], columns[1::2])
        last = columns[-1:] if len(columns) % 2 else []
        columns = [operation(left, right) for left, right in pairs] + list(last)
    return columns[0]
