"""Layout by a space-filling curve, so that ranges of every key skip most of a table.

Sorting serves the first key only. Here each key becomes its rank among
equi-depth bounds, so that the curve is as even as the rows are, whatever the
values; the bits of the ranks are interleaved (Morton order), and the table is
dealt and sorted by the resulting code. Rows that are near in all keys then lie
together, and the minima and maxima of a page are close in every key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayload.functions.columns import column, resolve
from quayload.functions.quantiles import Bounds, quantile_bounds, rank_steps

#: Rows of a Parquet page: what a scan can skip. Smaller than the format's default, for a
#: range of one of k keys still meets about pages ** (1 - 1/k) of them.
PAGE_ROWS = 2048
#: A key is cut into at most 2 ** MOST_BITS parts, and all codes fit 63 bits.
MOST_BITS, CODE_BITS = 12, 63
CODE, SLOT = "_quayload_code", "_quayload_slot"


def bits_for(rows: int, keys: int) -> int:
    """Bits of each key's rank: a code for every page, and one bit to spare."""
    pages = max(1, math.ceil(rows / PAGE_ROWS))
    return max(1, min(MOST_BITS, CODE_BITS // keys, math.ceil(math.log2(pages) / keys) + 1))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The ranks' bits in turn, from the highest down, those of the first rank first."""
    code = F.lit(0).cast("long")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            at = bit * len(ranks) + len(ranks) - 1 - i
            code = code.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1).cast("long"), at))
    return code


def curve_bounds(df: DataFrame, keys: Sequence[str], rows: int) -> dict[str, Bounds]:
    """Bounds of each key for a table of ``rows`` rows; one pass over the key columns, more for long text."""
    return quantile_bounds(df, {key: 1 << bits_for(rows, len(keys)) for key in keys})


def layout_by_curve(
    df: DataFrame, keys: Sequence[str], bounds: Mapping[str, Bounds], rows: int, partitions: int | None = None
) -> DataFrame:
    """Range-partition and sort by the curve's code.

    Nulls come first in their key. As in the layout by keys, the number of the
    input partition is the last range column: one code, or one group of equal
    rows, that holds a third of the table is cut into as many ranges as it needs.
    """
    keys = resolve(df, keys, "key")
    names = {key: f"_quayload_rank{i}" for i, key in enumerate(keys)}
    ranked = rank_steps(df, {key: bounds[key] for key in keys}, names)
    code = interleaved([column(names[key]) for key in keys], bits_for(rows, len(keys)))
    coded = ranked.withColumns({CODE: code, SLOT: F.spark_partition_id()}).drop(*names.values())
    count = () if partitions is None else (partitions,)
    dealt = coded.repartitionByRange(*count, CODE, SLOT)
    return dealt.sortWithinPartitions(CODE, *map(column, keys)).drop(CODE, SLOT)
