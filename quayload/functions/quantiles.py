"""Bounds that cut a table into parts of about equal size, by any column that has an order.

Columns are brought onto one scale each that keeps their order: numbers, dates
and times as a double, text and binary as bytes. Bounds of the first kind come
from Spark's mergeable quantile summary, for all columns in one pass. Text is
cut by its first six bytes, a number like any other; where one such prefix
holds several bounds, the next six bytes of its rows are cut in a further pass.
Each summary is of bounded size, whatever the table's.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column

#: Ranks of a bound are off by at most one in so many times the number of parts.
FINER = 20
#: Bytes of text that make one number, which a double holds exactly, and how many such steps are looked at.
STEP, MOST_STEPS = 6, 12

TEXT = (T.StringType, T.BinaryType)
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)

WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}

#: What a column is cut at: numbers on its scale, or beginnings of its text.
Bounds = Sequence[float] | Sequence[bytes]


def scale(field: T.StructField) -> Column:
    """The column on its scale: equal values stay equal, others keep their order or become equal; null stays null."""
    value, kind = column(field.name), field.dataType
    if isinstance(kind, TEXT):
        return value.cast("binary")
    if isinstance(kind, NUMBERS):
        # NaN comes after all numbers
        return F.nanvl(value.cast("double"), F.lit(float("inf")))
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(value.cast("date")).cast("double") * 86400
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.extract(F.lit("SECOND"), value).cast("double")
        return (days + clock) * 1_000_000
    raise TypeError(f"{field.name}: {kind.simpleString()} has no order to cut by")


def quantiles(value: Column, parts: int) -> Column:
    """An aggregate: the values at 1, 2, ... of ``parts`` equal shares of the rows, in order; of at least two parts."""
    return F.percentile_approx(value, [i / parts for i in range(1, parts)] or [0.5], FINER * parts)


def quantile_bounds(df: DataFrame, parts: Mapping[str, int]) -> dict[str, Bounds]:
    """For each named column, sorted bounds that cut its non-null rows into at most so many parts of about equal size.

    A value that holds more than a part's share is one bound, so there can be
    fewer. No rows, or only nulls, give no bounds.
    """
    fields = [df.schema[name] for name in parts]
    numbers = {f.name: scale(f) for f in fields if not isinstance(f.dataType, TEXT)}
    found: dict[str, Bounds] = {}
    if numbers:
        wanted = [quantiles(value, parts[name]) for name, value in numbers.items()]
        row = df.agg(*[value.alias(f"q{i}") for i, value in enumerate(wanted)]).first()
        for name, cut in zip(numbers, row):
            found[name] = sorted(set(cut or ())) if parts[name] > 1 else []
    for field in fields:
        if isinstance(field.dataType, TEXT):
            found[field.name] = _text_bounds(df.select(scale(field).alias("key")).where("key IS NOT NULL"), parts[field.name])
    return found


def _text_bounds(keys: DataFrame, parts: int) -> list[bytes]:
    """As :func:`quantile_bounds`, for one column of bytes."""
    spark, found = keys.sparkSession, set()
    wanted = {b"": parts - 1}  # beginnings, and how many bounds are wanted among the texts that have them
    for step in range(MOST_STEPS):
        wanted = {begin: n for begin, n in wanted.items() if n > 0}
        if not wanted:
            break
        chunk = F.conv(F.hex(F.rpad(F.substring("key", step * STEP + 1, STEP), STEP, F.lit(b"\0"))), 16, 10).cast("long")
        rows = keys.select(F.substring("key", 1, step * STEP).alias("begin"), chunk.alias("chunk"))
        if step:
            begins = spark.createDataFrame([(bytearray(b),) for b in wanted], "begin binary")
            rows = rows.join(F.broadcast(begins), "begin")
        cut = rows.groupBy("begin").agg(quantiles(F.col("chunk"), parts).alias("cut"))
        deeper: dict[bytes, int] = {}
        for begin, chunks in cut.collect():  # one for each beginning, of which there are fewer than parts
            n = wanted[bytes(begin)]
            taken = [chunks[(i + 1) * parts // (n + 1) - 1] for i in range(n)]
            for value in set(taken):
                bound = bytes(begin) + int(value).to_bytes(STEP, "big")
                if taken.count(value) > 1 and not bound.endswith(b"\0") and step + 1 < MOST_STEPS:
                    deeper[bound] = taken.count(value)
                else:
                    found.add(bound.rstrip(b"\0"))
        wanted = deeper
    return sorted(found - {b""})


def _listed(bounds: Bounds) -> Column:
    """The bounds as one constant; thousands of single ones would burden the analyser."""
    if bounds and isinstance(bounds[0], bytes):
        return F.from_json(F.lit(json.dumps([base64.b64encode(b).decode() for b in bounds])), "array<binary>")
    return F.split(F.lit(",".join(map(repr, map(float, bounds)))), ",").cast("array<double>")


def rank_steps(df: DataFrame, bounds: Mapping[str, Bounds], names: Mapping[str, str]) -> DataFrame:
    """Add, under the name in ``names``, how many of a column's bounds are not above its value; null counts as 0.

    A binary search inside one expression. (Steps as columns of their own would
    be put into each other by the optimiser, and double with every step.)
    """
    return df.withColumns({names[key]: _rank(scale(df.schema[key]), cut) for key, cut in bounds.items()})


def _rank(value: Column, bounds: Bounds) -> Column:
    if not bounds:
        return F.lit(0)
    listed = _listed(bounds)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def search(scaled: Column) -> Column:
        # beyond the end there is null, which is not reached
        return F.aggregate(
            steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) <= scaled, at + step).otherwise(at)
        )

    return F.get(F.transform(F.array(value), search), F.lit(0))  # the value is worked out once


def reaches(field: T.StructField, bound: float | bytes, above: bool = False) -> object:
    """A value of the column's own type below (or equal to) all values that are not below ``bound``.

    With ``above``, one above (or equal to) all values that are below it. It is
    for conditions that sources and files can use, which let a few more rows
    through. ``None`` if there is no such value.
    """
    kind, side = field.dataType, 1 if above else -1
    if isinstance(kind, T.BinaryType):
        return bound
    if isinstance(kind, T.StringType):
        text = bound.decode("utf-8", "ignore")
        cut = bound[len(text.encode()) :]  # the first bytes of a character
        if above and cut:
            return None if cut[0] == 0xF4 else text + "\U0010ffff"
        return text or None
    if isinstance(kind, T.BooleanType) or math.isinf(bound):
        return None
    number = math.nextafter(bound, side * math.inf) if abs(bound) > 1 << 52 else bound
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(number)
    whole = math.ceil if above else math.floor
    if isinstance(kind, T.DecimalType):
        most = Decimal(10**kind.precision - 1).scaleb(-kind.scale)
        return min(max(Decimal(whole(number + side * abs(number) * 1e-15)), -most), most)
    if isinstance(kind, T.DateType):
        return date(1970, 1, 1) + timedelta(days=whole(number))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zone = timezone.utc if isinstance(kind, T.TimestampType) else None
        return datetime(1970, 1, 1, tzinfo=zone) + timedelta(microseconds=whole(number) + side)
    return min(max(whole(number), -(1 << WHOLE[type(kind)] - 1)), (1 << WHOLE[type(kind)] - 1) - 1)
