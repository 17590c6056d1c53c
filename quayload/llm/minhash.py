"""MinHash near-dedup by a multi-index Hamming join.

A document's signature is 80 symbols of 14 bits, each the least hash of its
shingles under one of 80 functions. The distance of two signatures is the number
of symbols that differ. The first 40 symbols are cut into 10 chunks of 4. By the
pigeonhole principle two signatures that differ in 19 of the 40 or fewer have a
chunk with at most one error, so a document is indexed by each chunk with each
of its symbols left out: all pairs within that distance meet, and most of those
beyond. At a similarity of 0.8 a pair fails to meet once in 27 million, and one
in about 100,000 is beyond the distance of 32 of 80 that is compared at all, or of
135 of 480 in the longer signature of documents that meet others.

Documents with equal sets are one class. Meeting classes are first compared, on
whole sets, with two leaders of their index entry: the one that most others meet
in all entries together, which in a group of copies is the text they come from,
and one chosen by a hash. Only what this leaves in different components is
compared pair by pair, each pair in the first entry it meets in, and not if the
distances to a common leader rule it out (1 - similarity is a metric).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quayload.llm.common import Files, documents, in_batches, look_up, only, text_of
from quayload.llm.graph import components
from quayload.llm.substring_dedup import MULTIPLIERS, WordHashes, mixed, rolled

SHINGLE, SIMILARITY = 4, (80, 100)
CHUNKS, CHUNK = 10, 4
#: A number holds the symbols of one chunk, in lanes with a bit to spare.
SYMBOLS, BITS, LANES = 80, 14, CHUNK
#: Symbols of the longer signature of those that meet others.
LONG = 480
#: Pairs of a greater distance aren't compared: in the signature, and in the longer one.
MOST_DISTANCE, MOST_LONG = 32, 135
BATCH_BYTES = 1 << 20
SEED = 31

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, LONG, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, LONG, np.uint64)
#: One in each lane's highest bit; all others.
HIGH = sum(1 << ((BITS + 1) * lane + BITS) for lane in range(LANES))
LOW = sum(((1 << BITS) - 1) << ((BITS + 1) * lane) for lane in range(LANES))


def shingle_hashes(text: str, width: int, memory: WordHashes) -> np.ndarray:
    """Different shingles of a text, sorted; ASCII capitals are lower-cased and words split at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    return np.unique(mixed(rolled(values, size, MULTIPLIERS[0]) + np.uint64(size)))


def signature(hashes: np.ndarray, size: int = SYMBOLS) -> np.ndarray:
    """The first ``size`` symbols of a non-empty set."""
    least = np.array([(hashes * a + b).min() for a, b in zip(FACTORS[:size], SHIFTS[:size], strict=True)])
    return (mixed(least) >> np.uint64(64 - BITS)).astype(np.int64)


def packed(symbols: np.ndarray) -> np.ndarray:
    """Four symbols to a number, each in a lane whose highest bit is 0."""
    return sum(symbols[:, lane::LANES] << ((BITS + 1) * lane) for lane in range(LANES))


def unpacked(numbers: np.ndarray) -> np.ndarray:
    lanes = [(numbers >> ((BITS + 1) * lane)) & ((1 << BITS) - 1) for lane in range(LANES)]
    return np.stack(lanes, axis=2).reshape(len(numbers), -1)


def _errors(a: str, b: str) -> str:
    """How many symbols of each chunk differ: adding LOW carries into a lane's highest bit unless the lane is 0."""
    return f"zip_with({a}, {b}, (x, y) -> bit_count(((x ^ y) + {LOW}L) & {HIGH}L))"


def distance(a: str, b: str) -> Column:
    return F.expr(f"aggregate({_errors(a, b)}, 0, (s, n) -> s + n)")


def first_meeting(key: str, a: str, b: str) -> Column:
    """Whether ``key`` is the first of the keys that two signatures share.

    They share a chunk's keys if it has no error, and one of them if it has one.
    """
    chunk = f"(shiftrightunsigned({key}, {BITS * (CHUNK - 1)}) div {CHUNK})"
    out = f"(shiftrightunsigned({key}, {BITS * (CHUNK - 1)}) % {CHUNK})"
    first = f"array_position(transform(slice({_errors(a, b)}, 1, {CHUNKS}), n -> n <= 1), true)"
    whole = f"element_at({a}, int({chunk}) + 1) = element_at({b}, int({chunk}) + 1)"
    return F.expr(f"{first} = {chunk} + 1 AND ({out} = 0 OR NOT {whole})")


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """Index keys of signatures: each chunk with each symbol left out."""
    keys = np.empty((len(symbols), CHUNKS, CHUNK), np.uint64)
    for chunk in range(CHUNKS):
        part = symbols[:, chunk * CHUNK : (chunk + 1) * CHUNK].astype(np.uint64)
        for out in range(CHUNK):
            key = np.full(len(symbols), chunk * CHUNK + out, np.uint64)
            for place in range(CHUNK):
                if place != out:
                    key = (key << np.uint64(BITS)) | part[:, place]
            keys[:, chunk, out] = key
    return keys.reshape(len(symbols), -1).view(np.int64)


def with_signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null for empty sets), signature and text_sha256 of each row."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.StringType()),
            T.StructField("signature", T.ArrayType(T.LongType())),
            T.StructField("text_sha256", T.StringType()),
        ]
    )

    def make(table: pa.Table) -> Iterator[pa.Table]:
        memory = WordHashes()
        counts, keys, symbols, shas = [], [], [], []
        for text in pc.fill_null(table["text"].cast(pa.large_string()), "").to_pylist():
            hashes = shingle_hashes(text, width, memory)
            shas.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            counts.append(len(hashes))
            keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest() if len(hashes) else None)
            symbols.append(signature(hashes) if len(hashes) else np.zeros(SYMBOLS, np.int64))
        numbers = packed(np.array(symbols, np.int64).reshape(-1, SYMBOLS))
        ends = np.arange(len(counts) + 1, dtype=np.int32) * numbers.shape[1]
        yield pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n_shingles": pa.array(counts, pa.int64()),
                "set_key": pa.array(keys, pa.string()),
                "signature": pa.ListArray.from_arrays(ends, numbers.ravel()),
                "text_sha256": pa.array(shas, pa.string()),
            }
        )

    return only(docs, "doc_id", "text").mapInArrow(in_batches(make, BATCH_BYTES), schema)


def _index(classes: DataFrame) -> DataFrame:
    """A row per class and key: key, rid, and which order its leader is chosen by."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        rid = np.array(table["rid"])
        numbers = np.array(table["signature"].combine_chunks().flatten()).reshape(len(rid), -1)
        keys = index_keys(unpacked(numbers))
        yield pa.table({"key": pa.array(keys.ravel()), "rid": pa.array(np.repeat(rid, keys.shape[1]))})

    return classes.select("rid", "signature").mapInArrow(in_batches(make, BATCH_BYTES), "key long, rid long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """rid, set (hashes, sorted, 8 bytes each) and longer signature of the classes in ``wanted`` (rid, first_id, set_key).

    A class's set comes from a row with its smallest doc_id.
    """
    rows = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["first_id"])).select("rid", "set_key", "text")

    def make(table: pa.Table) -> Iterator[pa.Table]:
        memory = WordHashes()
        rids, sets, longer = [], [], []
        texts = pc.fill_null(table["text"].cast(pa.large_string()), "").to_pylist()
        for rid, key, text in zip(table["rid"].to_pylist(), table["set_key"].to_pylist(), texts, strict=True):
            hashes = shingle_hashes(text, width, memory)
            data = hashes.tobytes()
            # rows that share a doc_id may have other sets
            if hashlib.blake2b(data, digest_size=16).hexdigest() == key:
                rids.append(rid)
                sets.append(data)
                longer.append(packed(signature(hashes, LONG)[None])[0])
        ends = np.arange(len(rids) + 1, dtype=np.int32) * (LONG // LANES)
        values = np.concatenate(longer) if longer else np.zeros(0, np.int64)
        yield pa.table(
            {
                "rid": pa.array(rids, pa.int64()),
                "shingles": pa.array(sets, pa.binary()),
                "longer": pa.ListArray.from_arrays(ends, values),
            }
        )

    made = found.mapInArrow(in_batches(make, BATCH_BYTES), "rid long, shingles binary, longer array<long>")
    return made.dropDuplicates(["rid"])


def _compared(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) with the similarity of their whole sets, and whether they are linked."""
    part, whole = similarity

    def make(table: pa.Table) -> Iterator[pa.Table]:
        found, linked = [], []
        for one, two in zip(table["one"].to_pylist(), table["two"].to_pylist(), strict=True):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            found.append(both / (len(x) + len(y) - both))
            linked.append(whole * both >= part * (len(x) + len(y) - both))
        yield table.select(["a", "b"]).append_column("similarity", pa.array(found, pa.float64())).append_column(
            "linked", pa.array(linked, pa.bool_())
        )

    plain = sets.select("rid", "shingles")
    one, two = plain.toDF("a", "one"), plain.toDF("b", "two")
    loaded = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return loaded.mapInArrow(in_batches(make, BATCH_BYTES), "a long, b long, similarity double, linked boolean")


def _close(similarity: tuple[int, int]) -> Column:
    """Whether sizes and signatures of a pair (n1, n2, s1, s2) allow the similarity."""
    return _similar_size(similarity) & (distance("s1", "s2") <= MOST_DISTANCE)


def _similar_size(similarity: tuple[int, int]) -> Column:
    part, whole = similarity
    return F.least("n1", "n2") * whole >= F.greatest("n1", "n2") * part


def near_documents(
    docs: DataFrame, files: Files, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, text_sha256.

    Documents are linked if ``whole * intersection >= part * union`` for
    their sets of ``shingle``-word shingles and ``similarity`` (part, whole),
    0.8 or more. A text with fewer words has one shingle of all of them; a
    null text, or one without words, has none and is linked with nothing.
    ``component_id`` is the smallest doc_id that links lead to; a null doc_id
    comes after all others and names a component only if all its ids are null.
    Repeated rows are linked, so both have the same component. An empty table
    gives an empty result. Other columns are ignored. Shingles are compared by
    64-bit hashes.
    """
    rows = files.write(with_signatures(docs, shingle), "signatures")
    grouped = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"),
        F.count("*").alias("copies"),
        F.first("n_shingles").alias("n"),
        F.first("signature").alias("signature"),
    )
    classes = files.write(grouped.withColumn("rid", F.monotonically_increasing_id()), "classes")
    facts = classes.select("rid", "n", "signature")

    index = _index(classes)
    live = files.write(index.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "live")
    total = live.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    members = files.write(look_up(index, live, "key", "m", max(total, 1)).where("m IS NOT NULL"), "members")
    met = files.write(members.groupBy("rid").agg(F.sum("m").alias("meets")), "met")
    sets = files.write(_sets(docs, met.join(classes.select("rid", "first_id", "set_key"), "rid"), shingle), "sets")

    central, other = F.max(F.struct("meets", "rid")), F.min(F.struct(F.xxhash64("rid"), "rid"))
    chosen = members.join(met, "rid").groupBy("key").agg(F.count("*").alias("m"), central.alias("c"), other.alias("o"))
    chosen = chosen.select("key", "m", F.array("c.rid", "o.rid").alias("leaders"))
    stars = look_up(members.drop("m"), chosen, "key", "m", max(total, 1))
    stars = stars.select(F.col("rid").alias("a"), F.explode("leaders").alias("b")).where("a <> b").distinct()
    stars = stars.join(facts.toDF("a", "n1", "s1"), "a").join(facts.toDF("b", "n2", "s2"), "b").where(_close(similarity))
    compared = files.write(_compared(files.write(stars.select("a", "b"), "stars"), sets, similarity), "compared")
    label = components(compared.where("linked").select("a", "b"), Files(files.spark, "minhash_stars")).toDF("rid", "root")

    # what meets and is still in different components
    placed = members.drop("m").join(label, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    shares = placed.groupBy("key", "root").agg(F.count("*").alias("c"))
    mixed_keys = shares.groupBy("key").agg(
        F.count("*").alias("roots"), F.sum("c").alias("m"), F.max(F.struct("c", "root")).alias("top")
    )
    mixed_keys = files.write(mixed_keys.where("roots > 1").select("key", "m", F.col("top.root").alias("top")), "mixed")
    # the leader that most others meet, of those a class was compared with, and how far it is
    pivots = compared.join(met.toDF("b", "meets"), "b").select("a", "b", "meets", (1 - F.col("similarity")).alias("far"))
    itself = compared.select("b").distinct().join(met.toDF("b", "meets"), "b").select(F.col("b").alias("a"), "b", "meets", F.lit(0.0).alias("far"))
    nearest = pivots.unionByName(itself).groupBy("a").agg(F.max(F.struct("meets", "b", "far")).alias("p"))
    longer = facts.select("rid", "n").join(sets.select("rid", F.col("longer").alias("signature")), "rid")
    known = longer.join(nearest.select(F.col("a").alias("rid"), F.col("p.b").alias("pivot"), F.col("p.far").alias("far")), "rid", "left")
    left = look_up(placed, mixed_keys, "key", "m", max(total, 1)).where("m IS NOT NULL").join(known, "rid")
    left = files.write(left.select("key", "rid", "root", "top", "n", "signature", "pivot", "far"), "left")
    minor = left.where("root <> top").toDF("key", "a", "r1", "top", "n1", "s1", "p1", "f1")
    every = left.drop("top").toDF("key", "b", "r2", "n2", "s2", "p2", "f2")
    once = (F.col("r1") != F.col("r2")) & ((F.col("r2") == F.col("top")) | (F.col("a") < F.col("b")))
    reach = 1 - similarity[0] / similarity[1] + 1e-9
    apart = F.coalesce((F.col("p1") == F.col("p2")) & (F.abs(F.col("f1") - F.col("f2")) > reach), F.lit(False))
    rest = minor.join(every, "key").where(
        once & ~apart & _similar_size(similarity) & first_meeting("key", "s1", "s2") & (distance("s1", "s2") <= MOST_LONG)
    )
    more = files.write(_compared(files.write(rest.select("a", "b"), "rest"), sets, similarity), "rest_compared")
    more = more.where("linked").select("a", "b")

    # the second time among components: each end of a link stands for its component
    ends = label.select("rid", "root")
    joined = more.join(ends.toDF("a", "ra"), "a", "left").join(ends.toDF("b", "rb"), "b", "left")
    joined = joined.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    merged = components(joined, Files(files.spark, "minhash_all")).toDF("old", "new")
    named = classes.select("rid", "set_key", "copies", "first_id").join(label, "rid", "left")
    named = named.withColumn("old", F.coalesce("root", "rid")).drop("root")
    n_classes = max(classes.count(), 1)
    sizes = named.groupBy("old").agg(F.count("*").alias("size")).join(merged, "old")
    named = look_up(named, sizes, "old", "size", n_classes)
    named = files.write(named.select("rid", "set_key", "copies", "first_id", F.coalesce("new", "old").alias("root")), "named")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("in_component"))
    answers = look_up(named, ids, "root", "in_component", n_classes)
    answers = files.write(answers.select("set_key", "copies", "component_id"), "answers")

    files.drop("sets", "members", "left", "live", "mixed")
    columns = ["doc_id", "n_shingles", "component_id", "text_sha256"]
    some = rows.where("set_key IS NOT NULL").drop("signature")
    found = look_up(some, answers, "set_key", "copies", max(rows.count(), 1)).select(*columns)
    none = rows.where("set_key IS NULL").withColumn("component_id", F.col("doc_id")).select(*columns)
    return found.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, files: Files, **settings) -> DataFrame:
    """One row of each component of ``docs``, that with the smallest doc_id, with all its columns.

    Rows without a doc_id stay unless they are linked to one that has it; of
    repeated rows one stays.
    """
    gone = near_documents(docs, files, **settings).where("NOT kept").select("doc_id", "text_sha256").distinct()
    gone = files.write(gone.toDF("_gone_id", "_gone_sha"), "gone")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.sha2(text_of(), 256).alias("_sha"),
    )
    same = rows["_id"].eqNullSafe(gone["_gone_id"]) & (rows["_sha"] == gone["_gone_sha"])
    again = Window.partitionBy("_id", "_sha").orderBy(F.lit(0))
    left = rows.join(gone, same, "left_anti").withColumn("_nth", F.row_number().over(again))
    return left.where("_nth = 1 OR _id IS NULL").select("row.*")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_documents(documents(spark, sf_dir), Files(spark, "minhash"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
