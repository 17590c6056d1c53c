"""Locations for house numbers on street segments, by an interval join.

A segment has a street, the numbers at its two ends, which side's numbers it
has, and the places of its ends. A house is put where its number falls between
them. Segments are entered under bins of house numbers as wide as themselves,
rounded up to a power of two, so that each is under two bins at most. In its
bins a segment is cut into nodes: stretches of a power of two of numbers that
begin at a multiple of it, two of a size at most. Of the segments of a node one
is before all others, and only it is kept. A house asks for the one node of
every size that its number is in, so the join is by street, side and node, and
meets each house with one row of a size, however many segments overlap. A street
that half of all rows are on is cut into its nodes, and each different address
is looked up once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayload.functions.columns import column, resolve
from quayload.functions.text import compose_query_key
from quayload.operators.enrich import KEY, geocode_enrich, write_lookup
from quayload.workspace import new_area

ODD, EVEN = "odd", "even"
#: The narrowest bin, in house numbers, as a power of two.
LEAST_WIDTH = 5
#: Segments, by their bins, that a task cuts into nodes.
TASK_SEGMENTS = 20_000
#: What a house is looked up by, and what comes first of several segments.
NODE = ("street", "side", "level", "node")
ORDER = ("last", "segment", "low", "high")
PLACES = ("low_lat", "low_lon", "high_lat", "high_lon")
LARGEST = (1 << 63) - 1
FIELDS = ("lat", "lon", "segment")
HOUSE = "_quayload_house"


@dataclass(frozen=True)
class SegmentColumns:
    """What a table of segments calls its columns.

    ``parity`` has ``odd`` or ``even`` for segments with the numbers of one side
    of the street; any other value, or null, stands for both.
    """

    street: tuple[str, ...] = ("street",)
    low: str = "low"
    high: str = "high"
    parity: str = "parity"
    low_lat: str = "low_lat"
    low_lon: str = "low_lon"
    high_lat: str = "high_lat"
    high_lon: str = "high_lon"
    segment: str = "segment_id"


def house_number(text: Column) -> Column:
    """The number an address's house begins with (``12`` of ``12-16`` and ``12A``), null if there is none."""
    return F.regexp_extract(F.trim(text.cast("string")), "^([0-9]{1,18})(?![0-9])", 1).try_cast("long")


def _width_of(low: Column, high: Column) -> Column:
    """The power of two of the narrowest bin as wide as the numbers ``low`` to ``high``."""
    return F.greatest(F.lit(LEAST_WIDTH), F.length(F.bin(high - low)))


def _bin(number: Column, width: Column) -> Column:
    return F.call_function("shiftright", number, width)


def _ones(width: Column) -> Column:
    """The number of ``width`` one bits, up to 63 of them."""
    return F.call_function("shiftright", F.lit(LARGEST), F.lit(63) - width)


def _nodes(start: Column, end: Column, width: Column) -> Column:
    """The nodes, by level, that the numbers ``start`` to ``end`` of one bin are made of.

    A node of level k has ``1 << k`` numbers. At each level the first whole node
    is taken if it is the second half of one a level up, and the last if it is
    the first half; the others are in nodes above.
    """

    def taken(level: Column) -> Column:
        first, last = -_bin(-start, level), _bin(end - _ones(level), level)
        left, right = F.when(first % 2 == 1, first), F.when(last % 2 == 0, last)
        nodes = F.when(first <= last, F.array(left, right)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.array_compact(nodes), lambda node: F.struct(level.alias("level"), node.alias("node")))

    return F.flatten(F.transform(F.sequence(F.lit(0), width), taken))


def prepare_segments(segments: DataFrame, names: SegmentColumns, path: str) -> DataFrame:
    """Write the segments with their street's normalised name, a row for each bin they are under.

    Ends can be in any order. A segment without a street, an end or a place of
    an end can locate nothing and is left out.
    """
    plain = {part: resolve(segments, [getattr(names, part)], "segment column")[0] for part in SegmentColumns.__dataclass_fields__ if part != "street"}
    street = compose_query_key(resolve(segments, names.street, "segment column")).alias("street")
    rows = segments.select(
        street,
        F.lower(column(plain["parity"]).cast("string")).alias("parity"),
        *[column(plain[end]).cast("long").alias(end) for end in ("low", "high")],
        *[column(plain[place]).cast("double").alias(place) for place in PLACES],
        column(plain["segment"]).alias("segment"),
    )
    whole = rows.dropna(subset=["street", "low", "high", *PLACES])
    whole = whole.where("low >= 0 AND high >= 0")
    turned = F.col("low") > F.col("high")
    pairs = (("low", "high"), ("low_lat", "high_lat"), ("low_lon", "high_lon"))
    ends = {}
    for a, b in pairs:
        ends[a], ends[b] = F.when(turned, F.col(b)).otherwise(F.col(a)), F.when(turned, F.col(a)).otherwise(F.col(b))
    ordered = whole.withColumns(ends).withColumn("width", _width_of(F.col("low"), F.col("high")))
    bins = F.sequence(_bin(F.col("low"), F.col("width")), _bin(F.col("high"), F.col("width")))
    entered = ordered.withColumn("bin", F.explode(bins))
    entered.write.mode("errorifexists").parquet(path)
    return segments.sparkSession.read.schema(entered.schema).parquet(path)


def first_by_node(entered: DataFrame, tasks: int) -> DataFrame:
    """NODE and, as ``first``, the segment that goes before all others there: ORDER and its places.

    Segments that differ in their places alone are kept as one with all of them,
    for which of them goes first is another for each number. Those of both sides
    are entered under each.
    """
    odd, even = F.array(F.lit(1)), F.array(F.lit(0))
    sides = F.when(F.col("parity") == ODD, odd).when(F.col("parity") == EVEN, even).otherwise(F.array(F.lit(0), F.lit(1)))
    sided = entered.withColumns({"side": F.explode(sides), "last": F.col("segment").isNull()})
    same = ["street", "side", "width", "bin", *ORDER]
    whole = sided.repartition(tasks, *same).groupBy(*same).agg(F.collect_set(F.struct(*PLACES)).alias("places"))
    begin = F.call_function("shiftleft", F.col("bin"), F.col("width"))
    start, end = F.greatest(F.col("low"), begin), F.least(F.col("high"), begin + _ones(F.col("width")))
    cut = whole.select("street", "side", F.struct(*ORDER, "places").alias("first"), F.inline(_nodes(start, end, F.col("width"))))
    return cut.groupBy(*NODE).agg(F.min("first").alias("first"))


def locate_houses(houses: DataFrame, entered: DataFrame) -> DataFrame:
    """``houses`` (KEY, street, number; unique) that are on a segment: KEY and FIELDS.

    Of several segments the one with the smallest id is taken, null last, then
    the one with the lower, then the nearer end. The place is between the ends
    as the number is; on a segment with one number only, at its first end.
    """
    rows, width = entered.agg(F.count(F.lit(1)), F.max("width")).first()
    levels = F.sequence(F.lit(0), F.lit(LEAST_WIDTH if width is None else width))
    nodes = first_by_node(entered, max(1, math.ceil(rows / TASK_SEGMENTS)))
    probes = houses.withColumns({"side": (F.col("number") % 2).cast("int"), "level": F.explode(levels)})
    probes = probes.withColumn("node", _bin(F.col("number"), F.col("level")))
    best = probes.join(nodes, list(NODE)).groupBy(KEY, "number").agg(F.min("first").alias("first"))
    best = best.select(KEY, "number", "first.*")
    share = F.when(F.col("high") > F.col("low"), (F.col("number") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)

    def place(ends: Column) -> Column:
        return F.struct(*[(ends[f"low_{c}"] + (ends[f"high_{c}"] - ends[f"low_{c}"]) * share).alias(c) for c in ("lat", "lon")])

    placed = best.withColumn("place", F.array_min(F.transform("places", place)))
    return placed.select(KEY, "place.*", "segment")


def geocode_ranges(
    df: DataFrame,
    segments: DataFrame,
    number_field: str,
    street_fields: Sequence[str],
    location_fields: Sequence[str] = FIELDS,
    names: SegmentColumns = SegmentColumns(),
    removed: Sequence[str] | None = None,
    **join: object,
) -> DataFrame:
    """Add lat, lon and segment to every row whose house is on a segment of its street; others get nulls.

    Streets match when their normalised names are equal. A house's number is
    what ``number_field`` begins with. A row without one, or without a street,
    keeps null locations. Empty tables give empty results or nulls. The rows
    themselves are joined once, by their address, as in :func:`geocode_enrich`,
    which also takes the options ``join``.
    """
    path = new_area(df.sparkSession, "segments")
    [number_field] = resolve(df, [number_field], "query field")
    street_fields = resolve(df, street_fields, "query field")
    entered = prepare_segments(segments, names, f"{path}/entered")
    number, street = house_number(column(number_field)), compose_query_key(street_fields)
    # the number has no space, so different houses have different addresses
    housed = df.withColumn(HOUSE, F.concat(number.cast("string"), F.lit(" "), street))
    houses = housed.select(F.col(HOUSE).alias(KEY), street.alias("street"), number.alias("number")).dropna().distinct()
    lookup = write_lookup(locate_houses(houses, entered), f"{path}/lookup")
    return geocode_enrich(housed, lookup, [HOUSE], location_fields, [HOUSE, *(removed or ())], **join)
