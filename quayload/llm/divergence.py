"""Source divergence audit: how unlike the sources of a language are, and in which terms.

Terms that enough documents of a language have are numbered inside slices of
bounded size. A group (language, source) has a sorted array of (term id, count)
for each slice. Sources come in blocks; a pair task co-groups the arrays of two
blocks for one slice and merges each unordered pair of groups: a galloping
intersection finds the terms both have, which are priced with both counts,
those of one side with the other's price of an absent term, and what neither
has is only counted. The price is the same both ways, so one merge serves both.

Prices are shares of a billion, rounded down, in whole numbers throughout.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.common import Files, documents, give_back_memory, only, partition_bytes

LEAST_DOCUMENTS, TOP_TERMS = 10, 10
UNIT = 1_000_000_000
#: Terms of a language in one slice, and sources in one block.
SLICE_TERMS, BLOCK_SOURCES = 1 << 13, 16
#: Different terms of all groups a task counts before it hands them on, and texts it splits at once.
HELD_TERMS, STEP_BYTES = 200_000, 1 << 20
#: A to Z become small, all else below 0x80 but a to z becomes a space.
RULE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Values of the shorter array that are looked up in one go.
STRIDE = 512

COUNTS = "lang string, source string, term string, n_docs long, n long"
PAIRS = "lang string, a string, b string, price long, met long, absent long"


class TermCounts:
    """Occurrences and documents of each term, by group."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, group: tuple[str, str], terms: list[bytes]) -> None:
        if group not in self.groups:
            self.groups[group] = Counter(), Counter()
        occurrences, with_term = self.groups[group]
        before = len(occurrences)
        occurrences.update(terms)
        with_term.update(set(terms))
        self.held += len(occurrences) - before

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, with_term) in self.groups.items():
            terms = list(occurrences)
            yield pa.record_batch(
                {
                    "lang": pa.repeat(lang, len(terms)),
                    "source": pa.repeat(source, len(terms)),
                    "term": pa.array(terms, pa.binary()).cast(pa.string()),
                    "n_docs": pa.array(map(with_term.__getitem__, terms), pa.int64()),
                    "n": pa.array(occurrences.values(), pa.int64()),
                }
            )


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: added up over all batches of a task, handed on when too much is held."""
    held = TermCounts()
    for batch in batches:
        step = max(1, int(batch.num_rows * STEP_BYTES / max(batch.nbytes, 1)))
        for begin in range(0, batch.num_rows, step):
            part = batch.slice(begin, step)
            texts = pc.cast(part["text"], pa.binary()).to_pylist()
            for group, text in zip(zip(part["lang"].to_pylist(), part["source"].to_pylist()), texts):
                held.add(group, text.translate(RULE).split())
                if held.held >= HELD_TERMS:
                    yield from held.rows()
                    held = TermCounts()
    yield from held.rows()
    del held
    give_back_memory()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * terms)), by long division with three digits a step; null for no terms.

    Whole numbers of 64 bits do for totals up to 9e15.
    """
    over = total + 2 * terms
    whole, rest = F.call_function("div", count + 2, over), (count + 2) % over
    for _ in range(3):
        whole, rest = whole * 1000 + F.call_function("div", rest * 1000, over), rest * 1000 % over
    return whole + 1


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``share`` of many counts."""
    over = total + 2 * terms
    whole, rest = np.divmod(counts + 2, over)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, over)
        whole = whole * 1000 + digit
    return whole + 1


def unlike(p: Column | np.ndarray, q: Column | np.ndarray):
    """floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so the square fits."""
    if isinstance(p, Column):
        return F.call_function("div", (p - q) * (p - q), p + q)
    return (p - q) ** 2 // (p + q)


def galloped(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Places of the values of ``few`` in ``many``, -1 for those not there; both sorted, without repeats.

    The search goes on from where the last one ended, with steps that double.
    """
    places, low = np.full(len(few), -1), 0

    def reach(value: int, begin: int) -> int:
        step = 1
        while begin + step < len(many) and many[begin + step] < value:
            begin, step = begin + step, step * 2
        return min(begin + step, len(many))

    for begin in range(0, len(few), STRIDE):
        part = few[begin : begin + STRIDE]
        first = reach(int(part[0]), low)
        low += int(np.searchsorted(many[low:first], part[0]))
        high = min(reach(int(part[-1]), low) + 1, len(many))
        at = low + np.searchsorted(many[low:high], part)
        same = at < len(many)
        same[same] = many[at[same]] == part[same]
        places[begin : begin + STRIDE] = np.where(same, at, -1)
        low = min(int(at[-1]), len(many) - 1) if len(many) else 0
    return places


class Group:
    """One group's terms in a slice."""

    def __init__(self, row: dict):
        self.source, self.number = row["source"], row["number"]
        self.ids = np.array(row["ids"] or (), np.int64)
        self.total, self.terms = row["total"], row["terms"]
        if self.terms:
            self.prices = shares(np.array(row["counts"] or (), np.int64), self.total, self.terms)
            self.absent = int(shares(np.zeros(1, np.int64), self.total, self.terms)[0])


def merge(a: Group, b: Group) -> tuple[int, int, int]:
    """The price of what a or b has, how many terms that is, and the price of a term that neither has."""
    if not a.terms:  # then b has none either: terms are kept for a whole language
        return 0, 0, 0
    few, many = (a, b) if len(a.ids) <= len(b.ids) else (b, a)
    at = galloped(few.ids, many.ids)
    both = at >= 0
    alone = np.ones(len(many.ids), bool)
    alone[at[both]] = False
    price = unlike(few.prices[both], many.prices[at[both]]).sum()
    price += unlike(few.prices[~both], np.int64(many.absent)).sum() + unlike(many.prices[alone], np.int64(few.absent)).sum()
    return int(price), len(many.ids) + int((~both).sum()), int(unlike(np.int64(a.absent), np.int64(b.absent)))


def merge_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    """A pair task: each unordered pair of a group of one block and one of the other, in one slice."""
    out: dict[str, list] = {c: [] for c in ("lang", "a", "b", "price", "met", "absent")}
    others = [Group(row) for row in right.to_pylist()]
    lang = left["lang"][0].as_py() if left.num_rows else None
    for a in map(Group, left.to_pylist()):
        for b in others:
            if a.number < b.number:
                values = (lang, a.source, b.source, *merge(a, b))
                for column, value in zip(out.values(), values):
                    column.append(value)
    kinds = [pa.string()] * 3 + [pa.int64()] * 3
    return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(out.items(), kinds)})


def kept_counts(docs: DataFrame, least: int) -> DataFrame:
    """A row per language, term and source of the terms that ``least`` documents of the language have.

    lang, term, source, n, lang_n (occurrences in the language) and ``first``,
    true for one row of each language and term. One shuffle serves all: the
    rows of a term are summed by source, then over the sources.
    """
    counted = docs.mapInArrow(count_terms, COUNTS).repartition("lang", "term")
    by_source = counted.groupBy("lang", "term", "source").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    term = Window.partitionBy("lang", "term")
    summed = by_source.select(
        "*",
        F.sum("n_docs").over(term).alias("lang_docs"),
        F.sum("n").over(term).alias("lang_n"),
        (F.min("source").over(term) == F.col("source")).alias("first"),
    )
    return summed.where(F.col("lang_docs") >= least).drop("n_docs", "lang_docs")


def sides(kept: DataFrame, groups: DataFrame, slices: int) -> DataFrame:
    """Each group's sorted ids and their counts, a row for every slice, also where it has none."""
    number = F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")).cast("long")
    sliced = kept.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int"))
    ids = sliced.where("first").select("lang", "term", "slice", number.alias("id"))
    numbered = sliced.join(ids.drop("slice"), ["lang", "term"])
    entries = F.array_sort(F.collect_list(F.struct("id", "n")))
    arrays = numbered.groupBy("lang", "source", "slice").agg(entries.alias("entries"))
    grid = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return grid.join(arrays, ["lang", "source", "slice"], "left").select(
        *grid.columns, F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts")
    )


def pair_values(sides: DataFrame) -> DataFrame:
    """lang, a, b and value of each unordered pair of groups of a language."""
    left = sides.select("*", F.explode(F.sequence("block", "last_block")).alias("other"))
    again = sides.select(*[F.col(c).alias(c) for c in sides.columns])  # columns of their own, for the join of a table to itself
    right = again.select("*", F.explode(F.sequence(F.lit(0), "block")).alias("other"))
    tasks = left.groupBy("lang", "slice", "block", "other").cogroup(right.groupBy("lang", "slice", "other", "block"))
    merged = tasks.applyInArrow(merge_blocks, PAIRS).groupBy("lang", "a", "b")
    return merged.agg(F.sum("price").alias("price"), F.sum("met").alias("met"), F.max("absent").alias("absent"))


def divergence(docs: DataFrame, files: Files, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """How unlike the sources of each language of ``docs`` (text, lang, source) are.

    Terms are runs of letters a to z (after A to Z are made small) and of all
    characters beyond ASCII; a language keeps those that at least ``least`` of
    its documents have. With n occurrences, N of all kept terms and V kept terms
    of the language, a group's share of a term is
    p = 1 + floor(1e9 * (n + 2) / (N + 2 V)), and the price of two shares is
    floor((p - q)^2 / (p + q)). Returns lang, source, part, item, value and
    rank (by falling value, then item): in part ``pair`` each other source of
    the language with the sum of prices over all kept terms, in part ``term``
    the ``top`` kept terms that the group has and whose share is above the
    whole language's, with their price.

    Nulls in the three columns count as empty texts, and the empty text is a
    language or source like others. Groups without terms take part; a language
    without kept terms has pairs of value 0; one with one source has no pairs.
    Repeated rows count as often as they are there. An empty table gives an
    empty result. Other columns are ignored. All pairs of a language's sources
    are the result, so there must not be too many sources; what a task holds
    doesn't depend on their number, nor on that of terms.
    """
    named = only(docs, "text", "lang", "source").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    )
    kept = files.write(kept_counts(named, least), "kept")
    languages = kept.where("first").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_order = Window.partitionBy("lang").orderBy("source")
    numbered = named.select("lang", "source").distinct().select("*", (F.row_number().over(in_order) - 1).alias("number"))
    numbered = numbered.join(languages, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0)
    block = F.call_function("div", F.col("number"), F.lit(BLOCK_SOURCES)).cast("int")
    last = F.max("block").over(Window.partitionBy("lang")).alias("last_block")
    groups = files.write(numbered.withColumn("block", block).select("*", last), "groups")
    most = groups.agg(F.coalesce(F.max("terms"), F.lit(0))).first()[0]
    pairs = pair_values(files.write(sides(kept, groups.drop("lang_total"), most // SLICE_TERMS + 1), "sides"))
    value = F.col("price") + (F.col("terms") - F.col("met")) * F.col("absent")
    whole = pairs.join(languages.select("lang", "terms"), "lang", "left").fillna(0).select("lang", "a", "b", value.alias("value"))
    turned = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")]
    by_pair = whole.select("lang", F.explode(F.array(*turned)).alias("way"), "value").select("lang", "way.*", "value")
    in_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = by_pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(in_group).alias("rank"))
    priced = kept.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    terms = priced.where("p > q").select("lang", "source", "item", unlike(F.col("p"), F.col("q")).alias("value"))
    ranked = terms.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= top)
    return found.unionByName(ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir), Files(spark, "divergence"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT lang, source FROM d
), t AS (
  SELECT r, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), k AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), c AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), gn AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(gn.total, 0) + 2 * k.v) AS HUGEINT) AS p,
    CAST(1 + (1000000000::HUGEINT * (kept.n + 2)) // (k.total + 2 * k.v) AS HUGEINT) AS q
  FROM g JOIN kept USING (lang) JOIN k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
  LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source
), pair AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y USING (lang, term)
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), best AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM best) WHERE rank <= 10
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
