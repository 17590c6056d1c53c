"""Substring dedup of word windows by difference-cover anchors.

The residues 0, 1, 3, 9 modulo 13 are a difference cover: for any two positions
there is a shift below 13 that takes both to cover positions. So two equal
windows of 20 words have equal anchors, the 8 words at a cover position, at the
same place inside. Anchors are hashed and only those that occur twice survive;
around them windows are extended, hashed whole in 128 bits, and each window
learns whether it begins earlier elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.common import Files, documents, partition_bytes
from quayload.llm.repeats import (
    BLOBS,
    NO_BYTES,
    OPEN,
    answer_rows,
    blobs,
    buckets_for,
    distinct_texts,
    in_groups,
    joined,
    lists,
    map_texts,
    marked_texts,
    marks,
    same_as_before,
    settle,
    settled,
)

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Different words a task remembers the hashes of.
MEMORY = 500_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def rolled(values: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values."""
    done, have = None, 0
    power, span, left = values, 1, width
    while True:
        if left & 1:
            if done is None:
                done, have = power, span
            else:
                n = max(0, len(values) - have - span + 1)
                factor = np.uint64(pow(multiplier, span, 1 << 64))
                done, have = done[:n] * factor + power[have : have + n], have + span
        left >>= 1
        if not left:
            return done
        n = max(0, len(power) - span)
        power, span = power[:n] * np.uint64(pow(multiplier, span, 1 << 64)) + power[span : span + n], span * 2


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def word_hashes(texts: list[str], memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's words end (with a leading 0), and the hashes of all words.

    ``bytes.split`` splits at exactly the bytes 0x20 and 0x09 to 0x0D.
    """
    words = [text.encode("utf-8", "surrogatepass").split() for text in texts]
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    flat = (word for found in words for word in found)
    return ends, np.fromiter(map(memory.__getitem__, flat), np.uint64, int(ends[-1]))


def _places(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its text's number, its place there, and how many words follow from it on."""
    sizes = np.diff(ends)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(int(ends[-1])) - ends[:-1][row]
    return row, place, sizes[row] - place


def anchors(texts: DataFrame, buckets: int, window: int) -> DataFrame:
    width = window - PERIOD + 1

    def make(table: pa.Table) -> Iterator[pa.Table]:
        ends, words = word_hashes(table["text"].to_pylist(), WordHashes())
        row, place, left = _places(ends)
        hashes = mixed(rolled(words, width, MULTIPLIERS[0]))
        at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (left >= width) & (left + place >= window))
        rid, key = np.array(table["rid"])[row[at]], hashes[at]
        order = np.argsort(key, kind="stable")
        key, rid, pos = key[order], rid[order], place[at][order].astype(np.int32)
        same = same_as_before(key)
        twice = in_groups(same)
        if twice.any():
            yield settled(buckets, rid[twice], pos[twice])
        yield blobs(OPEN, buckets, key[~same], key=key[~same], rid=rid[~same], pos=pos[~same])

    return map_texts(texts.select("rid", "text"), make, BLOBS)


def compare_anchors(table: pa.Table) -> pa.Table:
    key, rid, pos = joined(table, "key", np.uint64), joined(table, "rid", np.int64), joined(table, "pos", np.int32)
    order = np.argsort(key, kind="stable")
    twice = order[in_groups(same_as_before(key[order]))]
    return marks(rid[twice], pos[twice])


def windows(marked: DataFrame, buckets: int, window: int) -> DataFrame:
    """Windows that hold a surviving anchor, with their hashes."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        ends, words = word_hashes(table["text"].to_pylist(), WordHashes())
        row, place, left = _places(ends)
        mark_ends, places = lists(table["pos"])
        at = ends[:-1].repeat(np.diff(mark_ends)) + places
        near = np.zeros(len(words) + 1, np.int32)
        np.add.at(near, at + 1, -1)
        np.add.at(near, np.maximum(at - PERIOD + 1, ends[:-1].repeat(np.diff(mark_ends))), 1)
        start = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (left >= window))
        if not len(start):
            return
        key = mixed(rolled(words, window, MULTIPLIERS[0]))[start]
        key2 = mixed(rolled(words, window, MULTIPLIERS[1]))[start]
        ord_ = np.array(table["ord"])[row[start]]
        rid, pos = np.array(table["rid"])[row[start]], place[start].astype(np.int32)
        order = np.lexsort((pos, rid, ord_, key2, key))
        key, key2, ord_, rid, pos = (x[order] for x in (key, key2, ord_, rid, pos))
        same = same_as_before(key, key2)
        if same.any():
            yield settled(buckets, rid[same], pos[same])
        own = ~same
        yield blobs(OPEN, buckets, key[own], key=key[own], key2=key2[own], ord=ord_[own], rid=rid[own], pos=pos[own])

    return map_texts(marked.select("rid", "ord", "text", "pos"), make, BLOBS)


def compare_windows(table: pa.Table) -> pa.Table:
    key, key2, ord_ = joined(table, "key", np.uint64), joined(table, "key2", np.uint64), joined(table, "ord", np.int64)
    rid, pos = joined(table, "rid", np.int64), joined(table, "pos", np.int32)
    order = np.lexsort((pos, rid, ord_, key2, key))
    later = order[same_as_before(key[order], key2[order])]
    return marks(rid[later], pos[later])


def covered(starts: np.ndarray, window: int, size: int) -> np.ndarray:
    """Which of ``size`` places are covered by a window that begins at one of ``starts``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0


def kept_texts(marked: DataFrame, window: int, with_text: bool) -> DataFrame:
    schema = "sha string, ord long, copies long, n_words long, n_removed long, kept_sha256 string, whole_sha256 string"

    def make(table: pa.Table) -> Iterator[pa.Table]:
        mark_ends, places = lists(table["pos"])
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "whole_sha256", "kept_text")}
        for i, text in enumerate(table["text"].to_pylist()):
            words = text.encode("utf-8", "surrogatepass").split()
            starts = places[mark_ends[i] : mark_ends[i + 1]]
            whole = kept = b" ".join(words)
            gone = 0
            if len(starts):
                drop = covered(starts, window, len(words))
                gone = int(drop.sum())
                kept = b" ".join(word for word, d in zip(words, drop.tolist(), strict=True) if not d)
            out["n_words"].append(len(words))
            out["n_removed"].append(gone)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["whole_sha256"].append(hashlib.sha256(whole).hexdigest())
            out["kept_text"].append(kept.decode("utf-8", "surrogatepass") if with_text else None)
        if not with_text:
            del out["kept_text"]
        yield pa.table({c: table[c] for c in ("sha", "ord", "copies")} | {c: pa.array(v) for c, v in out.items()})

    more = ", kept_text string" if with_text else ""
    return map_texts(marked.select("sha", "ord", "copies", "text", "pos"), make, schema + more)


def substring_dedup(docs: DataFrame, files: Files, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Remove from ``docs`` (doc_id, text) every word covered by a window that begins earlier elsewhere.

    A row per row: doc_id, n_words, n_removed, kept_sha256 and, if asked for,
    kept_text (kept words joined by a space). Earlier is a smaller doc_id, or
    the same document and an earlier word; a null doc_id comes last. Rows that
    share doc_id and text are one document and get one result each; texts that
    share only the doc_id are compared in a fixed order. Null texts have no
    words; texts shorter than the window lose nothing. An empty table gives an
    empty result. Other columns are ignored. ``window`` must be at least 14.
    """
    if window <= PERIOD:
        raise ValueError(f"the window must have more than {PERIOD} words")
    entries, texts = distinct_texts(docs, files)
    buckets = buckets_for(texts, partition_bytes(docs.sparkSession), 1.0)
    survivors = files.write(settle(anchors(texts, buckets, window), compare_anchors), "survivors")
    near = marked_texts(texts, survivors).where("pos IS NOT NULL")
    removed = files.write(settle(windows(near, buckets, window), compare_windows), "removed")
    kept = files.write(kept_texts(marked_texts(texts, removed), window, with_text), "kept")
    files.drop("texts", "survivors", "removed")
    long_enough = F.col("n_words") >= window
    pairs = {
        "n_words": ("n_words", F.col("n_words")),
        "n_removed": ("n_removed", F.when(long_enough, F.col("n_words")).otherwise(0)),
        "kept_sha256": ("kept_sha256", F.when(long_enough, F.lit(NO_BYTES)).otherwise(F.col("whole_sha256"))),
    }
    if with_text:
        pairs["kept_text"] = ("kept_text", F.when(long_enough, F.lit("")).otherwise(F.col("kept_text")))
    answers = kept.select(
        "sha", "ord", "copies", *[F.struct(F.col(own).alias("own"), copy.alias("copy")).alias(c) for c, (own, copy) in pairs.items()]
    )
    return answer_rows(entries, answers, list(pairs))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), Files(spark, "substring_dedup"), with_text=False)
