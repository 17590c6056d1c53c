"""Locations for addresses that match nothing exactly, by a set-similarity join.

An address is the set of its runs of three characters. Two sets as similar as
asked for must share one of their rarest few members: those are joined (prefix
filter), with bounds on the sets' sizes and on what can still be shared after
the place of the member met. A pair is judged where it first meets, on its whole
sets, so candidates are never stored or made unique, and only the best match of
each address goes on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayload.functions.columns import column, resolve
from quayload.functions.text import compose_query_key
from quayload.operators.enrich import KEY, AddressLookup, geocode_enrich, write_lookup
from quayload.workspace import new_area

#: Percent of the runs of two addresses together that both must have.
LEAST_PERCENT = 60
RUN = 3
#: Fields that the extended lookup has besides: the address matched, and how similar it is.
MATCHED, SIMILARITY = "matched_address", "similarity"


def runs_of(key: Column) -> Column:
    """The different runs of RUN characters of a normalised address, with a space at both ends.

    Normalised addresses have 37 characters, so there are at most 37**3 runs.
    """
    padded = F.concat(F.lit(" "), key, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - (RUN - 1)), lambda i: F.substring(padded, i, RUN)))


def run_counts(keys: DataFrame) -> DataFrame:
    """How many addresses have each run; a row for each of at most 37**3 runs."""
    return keys.select(F.explode(runs_of(column(KEY))).alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("n"))


def prefixes(keys: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Each address with its rarest runs, a row for each: key, size, run, place, and all of them as ``first``.

    Sets of n members that share p percent of their union share at least p
    percent of n, so one of the n - ceil(p n / 100) + 1 rarest is shared.
    """
    runs = keys.select(KEY, F.explode(runs_of(column(KEY))).alias("run"))
    # bounded by 37**3 rows
    ranked = runs.join(F.broadcast(counts), "run", "left")
    entry = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")
    ordered = ranked.groupBy(KEY).agg(F.array_sort(F.collect_list(entry)).alias("all"))
    size = F.size("all")
    length = size - F.ceil(size * percent / 100).cast("int") + 1
    first = ordered.select(KEY, size.alias("size"), F.slice(F.col("all.run"), 1, length).alias("first"))
    return first.select(KEY, "size", "first", F.posexplode("first").alias("place", "run"))


def similar_pairs(asked: DataFrame, known: DataFrame, percent: int = LEAST_PERCENT) -> DataFrame:
    """For each address of ``asked`` the most similar one of ``known`` (both: KEY, unique), if similar enough.

    KEY, ``matched_address`` and ``similarity``; of equally similar ones the
    smallest text.
    """
    if not 0 < percent <= 100:
        raise ValueError("the similarity must be above 0 and at most 100 percent")
    counts = run_counts(known)
    a = prefixes(asked, counts, percent).select(
        F.col(KEY).alias("a"), F.col("size").alias("na"), F.col("first").alias("fa"), F.col("place").alias("pa"), "run"
    )
    b = prefixes(known, counts, percent).select(
        F.col(KEY).alias("b"), F.col("size").alias("nb"), F.col("first").alias("fb"), F.col("place").alias("pb"), "run"
    )
    both = F.size(F.array_intersect(runs_of(F.col("a")), runs_of(F.col("b"))))
    sizes = (F.col("nb") * 100 >= F.col("na") * percent) & (F.col("na") * 100 >= F.col("nb") * percent)
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))  # can be shared from here on
    enough = left * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    first_met = F.get(F.array_intersect("fa", "fb"), F.lit(0)) == F.col("run")
    met = a.join(b, "run").where(sizes & enough).where(first_met).withColumn("both", both)
    union = F.col("na") + F.col("nb") - F.col("both")
    found = met.where(F.col("both") * 100 >= union * percent)
    best = F.min(F.struct((-(F.col("both") / union)).alias("unlike"), F.col("b")))
    return (
        found.groupBy("a").agg(best.alias("best"))
        .select(F.col("a").alias(KEY), F.col("best.b").alias(MATCHED), (-F.col("best.unlike")).alias(SIMILARITY))
    )


def extend_lookup(
    df: DataFrame, lookup: AddressLookup, query_fields: Sequence[str], percent: int = LEAST_PERCENT
) -> AddressLookup:
    """The lookup with the addresses of ``df`` that it lacks but has a similar one of.

    It has two more fields: the address matched, and the similarity, 1.0 for
    addresses of the lookup itself.
    """
    spark = df.sparkSession
    taken = [name for name in (MATCHED, SIMILARITY) if name in lookup.fields]
    if taken:
        raise ValueError(f"the lookup already has: {', '.join(taken)}")
    path = new_area(spark, "similar")
    keys = df.select(compose_query_key(resolve(df, query_fields, "query field")).alias(KEY)).where(column(KEY).isNotNull()).distinct()
    known = lookup.table.select(KEY)
    # a copy: the same table is on both sides of joins below
    keys.join(known, KEY, "left_anti").write.parquet(f"{path}/asked")
    asked = spark.read.schema(f"{KEY} string").parquet(f"{path}/asked")
    pairs = similar_pairs(asked, known, percent)
    located = lookup.table.withColumnRenamed(KEY, MATCHED)
    added = pairs.join(located, MATCHED).select(KEY, *map(column, lookup.fields), MATCHED, SIMILARITY)
    own = lookup.table.select(KEY, *map(column, lookup.fields), F.col(KEY).alias(MATCHED), F.lit(1.0).alias(SIMILARITY))
    return write_lookup(own.unionByName(added), f"{path}/lookup")


def geocode_similar(
    df: DataFrame,
    lookup: AddressLookup,
    query_fields: Sequence[str],
    location_fields: Sequence[str],
    percent: int = LEAST_PERCENT,
    removed: Sequence[str] | None = None,
    **join: object,
) -> DataFrame:
    """As :func:`geocode_enrich`, and addresses that match nothing get the location of the most similar one.

    Two addresses are as similar as the share of their runs of three characters
    that both have; ``percent`` is the least. Ties go to the smallest text. Rows
    without an address, or with none that is similar enough, keep null
    locations. Each different address is looked for once, however many rows
    have it. ``matched_address`` and ``similarity`` can be asked for as fields.
    """
    extended = extend_lookup(df, lookup, query_fields, percent)
    return geocode_enrich(df, extended, query_fields, location_fields, removed, **join)
