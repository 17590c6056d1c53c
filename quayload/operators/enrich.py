"""Add location fields to rows by joining their address to a reference table.

The reference is prepared once: one row per normalised address, written to the
shared folder together with its measured size. That size decides the join. A
reference that fits is broadcast, and the input is not shuffled at all. Beyond
the bound the input is shuffled by key; keys with more rows than a task's share
are dealt to as many tasks as they need, and rows without a key are spread, so
that no task receives more than its share however the keys are distributed.
Both joins take the same arguments and give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayload.functions.columns import column, combine, resolve
from quayload.functions.text import compose_query_key
from quayload.workspace import new_area

KEY = "_quayload_key"
FOUND = "_quayload_location"
JOIN_KEY = "_quayload_join_key"
SALT = "_quayload_salt"
SALTS = "_quayload_salts"
HASH = "_quayload_hash"

# An index of this size fits beside the tasks of any executor worth using.
BROADCAST_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class AddressLookup:
    """A prepared address reference: unique keys, their fields, and its size."""

    table: DataFrame
    fields: tuple[str, ...]
    rows: int
    bytes: int


def _require(names: Sequence[str], known: Sequence[str], what: str) -> None:
    unknown = [name for name in names if name not in known]
    if unknown:
        raise ValueError(f"unknown {what}: {', '.join(unknown)}")


def _width(names: Sequence[str]) -> Column:
    """Bytes a row of these columns takes in memory: words plus text."""
    texts = [F.coalesce(F.octet_length(column(name).cast("string")), F.lit(0)) for name in names]
    return combine(Column.__add__, texts).cast("bigint") + F.lit(16 * (len(names) + 1))


def prepare_lookup(
    reference: DataFrame,
    query_fields: Sequence[str],
    location_fields: Sequence[str],
    id_column: str,
    path: str,
) -> AddressLookup:
    """Reduce ``reference`` to one row per normalised address and write it to ``path``.

    Among rows with the same key the one with the smallest ``id_column`` wins
    (a null id ranks last). ``min`` combines on the map side, so a key that a
    third of the reference shares costs no more than any other.
    """
    query_fields = resolve(reference, query_fields, "reference field")
    id_column, *location_fields = resolve(reference, [id_column, *location_fields], "reference field")
    if KEY in location_fields:
        raise ValueError(f"{KEY} is reserved")
    ranked = F.struct(
        column(id_column).isNull().alias("unranked"),
        column(id_column).alias("id"),
        F.struct(*[column(name) for name in location_fields]).alias("location"),
    )
    unique = (
        reference.select(compose_query_key(query_fields).alias(KEY), ranked.alias("ranked"))
        .where(column(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.min("ranked").alias("ranked"))
        .select(KEY, "ranked.location.*")
    )
    return write_lookup(unique, path)


def write_lookup(unique: DataFrame, path: str) -> AddressLookup:
    """Write a table of unique keys and their fields, and measure it meanwhile."""
    fields = tuple(name for name in unique.columns if name != KEY)
    measured = Observation()
    size = F.coalesce(F.sum(_width([KEY, *fields])), F.lit(0))
    unique.observe(
        measured, F.count(F.lit(1)).alias("rows"), size.alias("bytes")
    ).write.mode("errorifexists").parquet(path)
    seen = measured.get
    table = unique.sparkSession.read.schema(unique.schema).parquet(path)
    return AddressLookup(table, fields, seen["rows"], seen["bytes"])


def _found(names: Sequence[str]) -> Column:
    return F.struct(*[column(name) for name in names]).alias(FOUND)


def _join_broadcast(keyed: DataFrame, lookup: AddressLookup, names: Sequence[str]) -> DataFrame:
    small = lookup.table.select(KEY, _found(names))
    return keyed.join(F.broadcast(small), KEY, "left")


def heavy_keys(keyed: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    """Hashes of the keys with more than ``rows`` rows, and how many tasks each needs.

    By default ``rows`` is a shuffle task's share of all rows; then there are
    fewer heavy keys than tasks, and together they need fewer than twice as
    many, so the result, two numbers for each key, can be broadcast whatever
    the keys are. Counted over all rows, with map-side combining.
    """
    spark = keyed.sparkSession
    counts = keyed.where(column(KEY).isNotNull()).groupBy(F.xxhash64(KEY).alias(HASH)).count()
    if rows is None:
        counts.write.mode("errorifexists").parquet(f"{path}/counts")
        counts = spark.read.parquet(f"{path}/counts")
        total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        rows = max(1, total // int(spark.conf.get("spark.sql.shuffle.partitions")))
    heavy = counts.where(F.col("count") > rows)
    heavy = heavy.select(HASH, F.ceil(F.col("count") / rows).cast("int").alias(SALTS))
    heavy.write.mode("errorifexists").parquet(f"{path}/heavy")
    return spark.read.schema(f"{HASH} long, {SALTS} int").parquet(f"{path}/heavy")


def spread_keys(keyed: DataFrame, heavy: DataFrame) -> DataFrame:
    """Give each row what it is shuffled by: a key and a salt.

    The salt of a heavy key's rows follows from the number of their input
    partition, which is the same when a lost task runs again. Rows without a
    key use that number as key, with a mark that no key holds, for keys hold
    only ``A-Z0-9`` and spaces. Nothing is shuffled here.
    """
    partition = F.spark_partition_id()
    marked = keyed.withColumn(HASH, F.xxhash64(KEY)).join(F.broadcast(heavy), HASH, "left")
    return marked.withColumns(
        {
            JOIN_KEY: F.coalesce(column(KEY), F.concat(F.lit("#"), partition.cast("string"))),
            SALT: F.coalesce(F.pmod(partition, column(SALTS)), F.lit(0)),
        }
    ).drop(HASH, SALTS)


def _join_shuffled(
    keyed: DataFrame, lookup: AddressLookup, names: Sequence[str], heavy: DataFrame
) -> DataFrame:
    """Shuffle join that neither a hot key nor rows without a key can skew.

    A heavy key's location is repeated for each of its salts.
    """
    right = lookup.table.select(column(KEY).alias(JOIN_KEY), F.xxhash64(KEY).alias(HASH), _found(names))
    right = right.join(F.broadcast(heavy), HASH, "left")
    salts = F.sequence(F.lit(0), F.coalesce(column(SALTS), F.lit(1)) - 1)
    right = right.select(JOIN_KEY, FOUND, F.explode(salts).alias(SALT))
    joined = spread_keys(keyed, heavy).join(right.hint("merge"), [JOIN_KEY, SALT], "left")
    return joined.drop(JOIN_KEY, SALT)


def select_location_fields(df: DataFrame, inputs: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The input columns, then the asked-for location fields in the asked-for order."""
    known = df.schema[FOUND].dataType.fieldNames()
    _require(fields, known, "location field")
    clash = [name for name in fields if name in inputs]
    if clash:
        raise ValueError(f"input already has: {', '.join(clash)}")
    location = column(FOUND)
    return df.select(
        *[column(name) for name in inputs],
        *[location.getField(name).alias(name) for name in fields],
    )


def remove_fields(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Drop the listed columns; a name that does not exist is an error."""
    if not names:
        return df
    names = resolve(df, names, "field to remove")
    return df.select(*[column(name) for name in df.columns if name not in names])


def attach_location(
    df: DataFrame,
    lookup: AddressLookup,
    query_fields: Sequence[str],
    location_fields: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    heavy_rows: int | None = None,
) -> DataFrame:
    """Left join: every input row once, with a location struct that is null if not found.

    A lookup larger than ``broadcast_bytes`` is joined by a shuffle, with keys
    of more than ``heavy_rows`` rows spread.
    """
    query_fields = resolve(df, query_fields, "query field")
    _require(location_fields, lookup.fields, "location field")
    keyed = df.withColumn(KEY, compose_query_key(query_fields))
    if lookup.bytes <= broadcast_bytes:
        joined = _join_broadcast(keyed, lookup, location_fields)
    else:
        heavy = heavy_keys(keyed, new_area(df.sparkSession, "heavy-keys"), heavy_rows)
        joined = _join_shuffled(keyed, lookup, location_fields, heavy)
    return joined.select(*[column(name) for name in df.columns], FOUND)


def geocode_enrich(
    df: DataFrame,
    lookup: AddressLookup,
    query_fields: Sequence[str],
    location_fields: Sequence[str],
    removed: Sequence[str] | None = None,
    **join: object,
) -> DataFrame:
    """Add ``location_fields`` to every row of ``df``, then drop ``removed``.

    Addresses match when their normalised texts are equal; see
    :func:`compose_query_key`. Rows that match nothing keep null locations.
    ``join`` are the join options of :func:`attach_location`.
    """
    found = attach_location(df, lookup, query_fields, location_fields, **join)
    return remove_fields(select_location_fields(found, df.columns, location_fields), removed)
