"""Benchmark decontamination by a prefix-filtered set join of word windows.

An item's windows are sets of shingles (runs of up to SHINGLE words) that a
document must hold whole. So one shingle is a sufficient prefix: each window is
joined by its rarest one in the documents, and a window with a shingle that
never occurs is done. What is met has to leave room for the window on both
sides (positional and length bounds), and its words are compared one by one.

Documents are read twice: to count the shingles that windows have, and to look
for the chosen ones. Which shingles may matter is told by a bitmap of bounded
size; it lets some through that don't, never the other way round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.common import Files, documents, in_batches, only
from quayload.llm.substring_dedup import MULTIPLIERS, mixed, rolled

WINDOW, SHINGLE = 10, 4
BATCH_BYTES = 2 << 20
#: Bits of the filter: so many for each shingle, and at most 64 MiB altogether.
BITS_EACH, LEAST_BITS, MOST_BITS = 256, 1 << 16, 1 << 29
#: Different words a task remembers the hashes of.
MEMORY = 300_000
#: A to Z become small, all else below 0x80 but digits and a to z becomes a space.
RULE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

POST = "struct<shingle: bigint, pos: bigint, low: bigint, around: string>"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(column: pa.ChunkedArray) -> list[list[bytes]]:
    return [(text or b"").translate(RULE).split() for text in column.cast(pa.binary()).to_pylist()]


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Of each run of ``width`` words; different widths have different hashes of the same words."""
    return mixed(rolled(words, width, MULTIPLIERS[0]) + np.uint64(width))


class Shingles:
    """The shingles of a batch of texts laid end to end."""

    def __init__(self, texts: list[list[bytes]], memory: WordHashes):
        self.ends = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
        flat = (word for words in texts for word in words)
        self.words = np.fromiter(map(memory.__getitem__, flat), np.uint64, int(self.ends[-1]))
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.ends))
        self.left = self.ends[1:][self.row] - np.arange(len(self.words))

    def inside(self, width: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where shingles begin that pass the filter, and their hashes."""
        hashes = shingle_hashes(self.words, width)
        at = np.flatnonzero(passes(bits, hashes) & (self.left[: len(hashes)] >= width))
        return at, hashes[at].view(np.int64)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bit_filter(shingles: DataFrame) -> Broadcast:
    """A bitmap of the column ``shingle``, of at most MOST_BITS, sent to all tasks."""
    wanted = shingles.count() * BITS_EACH
    size = min(max(1 << wanted.bit_length(), LEAST_BITS), MOST_BITS)
    place = F.col("shingle").bitwiseAND(size - 1)
    word, bit = F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, CAST((shingle & {size - 1}) & 63 AS int))")
    set_bits = shingles.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[np.array(set_bits["word"], np.int64)] = np.array(set_bits["bits"], np.int64).view(np.uint64)
    return shingles.sparkSession.sparkContext.broadcast(bits)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, seq (the window's words, joined by a space) and size, a row per window of each item."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        out: list[tuple[str, bytes, int]] = []
        for item, words in zip(table["item_id"].to_pylist(), words_of(table["text"])):
            size = min(window, len(words))
            starts = range(len(words) - size + 1) if size else ()
            out += [(item, b" ".join(words[i : i + size]), size) for i in starts]
        ids, seqs, sizes = zip(*out) if out else ((), (), ())
        yield pa.table(
            {
                "item_id": pa.array(ids, pa.string()),
                "seq": pa.array(seqs, pa.binary()).cast(pa.string()),
                "size": pa.array(sizes, pa.int32()),
            }
        )

    named = only(items, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")
    )
    return named.mapInArrow(in_batches(make, BATCH_BYTES), "item_id string, seq string, size int").distinct()


def window_shingles(windows: DataFrame, width: int) -> DataFrame:
    """A row per shingle of each different window: seq, size, width, place in the window, shingle."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        texts = [seq.split() for seq in table["seq"].cast(pa.binary()).to_pylist()]
        memory, parts = WordHashes(), []
        for row, words in enumerate(texts):
            one = min(width, len(words))
            hashes = shingle_hashes(np.array([memory[w] for w in words], np.uint64), one)
            parts += [(row, one, place, value) for place, value in enumerate(hashes.view(np.int64).tolist())]
        rows, widths, places, values = (np.array(x, np.int64) for x in zip(*parts))
        taken = table.select(["seq", "size"]).take(pa.array(rows))
        more = {"width": pa.array(widths, pa.int32()), "place": pa.array(places), "shingle": pa.array(values)}
        yield pa.table({c: taken[c] for c in taken.column_names} | more)

    schema = "seq string, size int, width int, place long, shingle long"
    return windows.select("seq", "size").distinct().mapInArrow(in_batches(make, BATCH_BYTES), schema)


def shingle_counts(docs: DataFrame, bits: Broadcast, widths: list[int]) -> DataFrame:
    """How often the shingles that pass the filter occur in ``docs``; added up in each batch first."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        shingles = Shingles(words_of(table["text"]), WordHashes())
        met = np.concatenate([shingles.inside(width, bits.value)[1] for width in widths])
        values, counts = np.unique(met, return_counts=True)
        yield pa.table({"shingle": pa.array(values), "n": pa.array(counts.astype(np.int64))})

    met = docs.select("text").mapInArrow(in_batches(make, BATCH_BYTES), "shingle long, n long")
    return met.groupBy("shingle").agg(F.sum("n").alias("n"))


def rarest(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window that may occur, with its rarest shingle and that one's place."""
    order = F.min(F.struct("n", "shingle", "place")).alias("first")
    met = shingles.join(counts, "shingle").groupBy("seq", "size", "width").agg(order, F.count("*").alias("met"))
    return met.where("met = size - width + 1").select("seq", "size", "width", "first.shingle", "first.place")


def scan(docs: DataFrame, bits: Broadcast | None, widths: list[int], window: int) -> DataFrame:
    """A row per document: its words' number and the chosen shingles in it, each with the words around it."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        texts = words_of(table["text"])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        ends = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
        if bits is not None:
            shingles = Shingles(texts, WordHashes())
            found = [shingles.inside(width, bits.value) for width in widths]
        at = np.concatenate([np.zeros(0, np.int64), *[a for a, _ in found]])
        value = np.concatenate([np.zeros(0, np.int64), *[v for _, v in found]])
        order = np.argsort(at, kind="stable")
        at, value = at[order], value[order]
        row = np.searchsorted(ends, at, "right") - 1
        pos = at - ends[row]
        low = np.maximum(pos - window + 1, 0)
        around = [b" ".join(texts[r][a : p + window]) for r, a, p in zip(row.tolist(), low.tolist(), pos.tolist())]
        posts = pa.StructArray.from_arrays(
            [pa.array(value), pa.array(pos), pa.array(low), pa.array(around, pa.binary()).cast(pa.string())],
            ["shingle", "pos", "low", "around"],
        )
        offsets = np.searchsorted(row, np.arange(len(texts) + 1), "left").astype(np.int32)
        yield pa.table(
            {
                "doc_id": table["doc_id"],
                "n_words": pa.array(np.diff(ends)),
                "posts": pa.ListArray.from_arrays(offsets, posts),
            }
        )

    return docs.mapInArrow(in_batches(make, BATCH_BYTES), f"doc_id long, n_words long, posts array<{POST}>")


def merged(hits: DataFrame) -> DataFrame:
    """Each document's spans (start, end), put together where they touch or overlap: ``spans``, by start."""
    in_order = Window.partitionBy("rid").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    marked = hits.select("rid", "start", "end").withColumn("gap", F.when(reached >= F.col("start"), 0).otherwise(1))
    island = F.sum("gap").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    islands = marked.withColumn("island", island).groupBy("rid", "island")
    whole = islands.agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def contaminated_spans(docs: DataFrame, items: DataFrame, files: Files, window: int = WINDOW, width: int = SHINGLE) -> DataFrame:
    """Where windows of ``items`` (item_id, text) occur in the texts of ``docs`` (doc_id, text).

    Words are runs of digits, letters a to z (after A to Z are made small) and
    all characters beyond ASCII. A window is ``window`` consecutive words of an
    item; an item of fewer words is one window, one without words has none. A
    row per row of ``docs``: doc_id, n_words, ``spans`` (start, end of stretches
    of words that occurrences cover, merged, by start) and ``items`` (ids of the
    items with occurring windows, as text, sorted). Null texts have no words. A
    null item_id counts as the empty text; rows with one item_id are one item.
    Repeated rows and null doc_ids of ``docs`` are each answered. An empty table
    on either side gives no spans. Other columns are ignored.
    """
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = files.write(item_windows(items, window), "windows")
    shingles = files.write(window_shingles(windows, width), "shingles")
    widths = [row[0] for row in shingles.select("width").distinct().collect()]  # 1 to ``width``
    bits = None
    if widths:
        counts = files.write(shingle_counts(docs, bit_filter(shingles.select("shingle").distinct()), widths), "counts")
        chosen = files.write(rarest(shingles, counts), "chosen")
        widths = [row[0] for row in chosen.select("width").distinct().collect()]
        bits = bit_filter(chosen.select("shingle").distinct()) if widths else None
    scanned = scan(docs, bits, widths, window).withColumn("rid", F.monotonically_increasing_id())
    scanned = files.write(scanned, "scanned")
    no_spans, no_items = F.array().cast("array<struct<start: bigint, end: bigint>>"), F.array().cast("array<string>")
    if bits is None:
        return scanned.select("doc_id", "n_words", no_spans.alias("spans"), no_items.alias("items"))
    posts = scanned.select("rid", "n_words", F.explode("posts").alias("post")).select("rid", "n_words", "post.*")
    start = F.col("pos") - F.col("place")
    same = F.array_join(F.slice(F.split("around", " "), (start - F.col("low") + 1).cast("int"), F.col("size")), " ") == F.col("seq")
    # a window must begin in the document, and end in it
    fits = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    met = posts.join(chosen, "shingle").where(fits).where(same)
    hits = files.write(met.select("rid", "seq", start.alias("start"), (start + F.col("size")).alias("end")), "hits")
    named = hits.select("rid", "seq").distinct().join(windows.select("seq", "item_id"), "seq")
    lists = named.groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = scanned.select("rid", "doc_id", "n_words").join(merged(hits), "rid", "left").join(lists, "rid", "left")
    return found.select("doc_id", "n_words", F.coalesce("spans", no_spans).alias("spans"), F.coalesce("items", no_items).alias("items"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated_spans(documents(spark, sf_dir), items, Files(spark, "decontamination"))
    hit = F.expr("aggregate(spans, 0L, (n, span) -> n + span.end - span.start)")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""
WITH pages AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), asked AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS size FROM asked WHERE len(w) > 0
), wanted AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS seq
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
), places AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS seq
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM pages JOIN (SELECT DISTINCT size FROM wanted) ON len(w) >= size)
), hits AS (
  SELECT r, i, places.size, seq, item_id FROM places JOIN wanted USING (seq)
), covered AS (
  SELECT r, count(DISTINCT hit) AS n FROM (SELECT r, unnest(range(i, i + size)) AS hit FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  covered.n IS NOT NULL AS contaminated
FROM pages LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
