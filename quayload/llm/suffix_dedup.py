"""Suffix-array dedup by a depth-limited radix sort.

Suffixes are ordered through their first 50 bytes only, by passes over digits
from the most significant on; a group of suffixes that agree in all digits is a
repeated window, and a group that only one document is left in is not sorted
further.

The first digit is not the window's beginning but its anchor: the 16-byte gram
of least hash among the 35 inside. Equal windows have equal anchors at equal
places, so this is an order of digits like another one, but one anchor serves
all windows around it: one suffix in about 18 is written instead of all. The
first pass finds the anchors that occur in two documents. For those the bytes
around are sent to the anchor's bucket, where the other passes take the gram's
16 bytes and then the window's other 34 bytes, for each place of the anchor in
the window. Anchors with very many occurrences, as at the edges of a passage
that very many documents share, are not put in one bucket: their windows are
dealt by a hash of all 50 bytes and compared by two hashes, 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.common import Files, documents, partition_bytes
from quayload.llm.repeats import (
    BLOBS,
    NO_BYTES,
    OPEN,
    WINDOWS,
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
from quayload.llm.substring_dedup import MULTIPLIERS, mixed, rolled

WINDOW, GRAM = 50, 16
#: Places of the anchor in the window: 0 to BEFORE.
BEFORE = WINDOW - GRAM
BATCH_BYTES = 1 << 20
#: Longer texts are searched for anchors in overlapping slices.
SLICE = 1 << 20
#: Anchors whose bytes are held at once; a text of one repeated word has one at every few bytes.
MOST_CONTEXTS = 1 << 16
#: An anchor with more occurrences than this part of a bucket is dealt by windows.
HOT_PART = 10
#: rid of the rows that name such anchors.
HOT_RID = -1
CONTEXT = BEFORE + WINDOW


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each run of ``width`` values."""
    have = 1
    while have * 2 <= width:
        values = pick(values[:-have], values[have:]) if len(values) > have else values[:0]
        have *= 2
    rest = width - have
    return pick(values[:-rest], values[rest:]) if rest and len(values) > rest else values if not rest else values[:0]


def anchor_places(data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows that end inside their text, and their hashes.

    ``left``: how many bytes of the text begin at each place. Grams that tie
    are all anchors.
    """
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = mixed(rolled(data.astype(np.uint64) + np.uint64(1), GRAM, MULTIPLIERS[0])) | np.uint64(1)
    least = sliding(grams, BEFORE + 1, np.minimum)
    least[left[: len(least)] < WINDOW] = 0
    padded = np.concatenate([np.zeros(BEFORE, np.uint64), least, np.zeros(BEFORE, np.uint64)])
    at = np.flatnonzero(grams == sliding(padded, BEFORE + 1, np.maximum)[: len(grams)])
    return at, grams[at]


def _slices(rids: np.ndarray, texts: list[str]) -> Iterator[tuple[int, int, bytes]]:
    for rid, text in zip(rids.tolist(), texts, strict=True):
        data = text.encode("utf-8", "surrogatepass")
        for base in range(0, max(1, len(data) - WINDOW + 1), SLICE):
            yield rid, base, data[base : base + SLICE + WINDOW - 1]


def anchors(texts: DataFrame, buckets: int) -> DataFrame:
    def make(table: pa.Table) -> Iterator[pa.Table]:
        parts = [x for x in _slices(np.array(table["rid"]), table["text"].to_pylist()) if len(x[2]) >= WINDOW]
        sizes = np.array([len(x[2]) for x in parts], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        data = np.frombuffer(b"".join(x[2] for x in parts), np.uint8)
        left = (np.repeat(ends[1:], sizes) - np.arange(len(data))).astype(np.int32)
        at, key = anchor_places(data, left)
        row = np.searchsorted(ends, at, "right") - 1
        rid = np.array([x[0] for x in parts], np.int64)[row]
        pos = (at - ends[row] + np.array([x[1] for x in parts], np.int64)[row]).astype(np.int32)
        # an anchor's hash is the least of many, so buckets go by the hash mixed once more, which is even
        spread = mixed(key)
        order = np.argsort(spread, kind="stable")
        key, spread, rid, pos = key[order], spread[order], rid[order], pos[order]
        again = same_as_before(key, rid, pos)
        key, spread, rid, pos = key[~again], spread[~again], rid[~again], pos[~again]
        same = same_as_before(key)
        first = np.flatnonzero(~same)
        sure = several(rid, first)
        if sure.any():
            yield settled(buckets, rid[sure], pos[sure])
        own = ~sure | ~same
        yield blobs(OPEN, buckets, spread[own], key=key[own], rid=rid[own], pos=pos[own])

    return map_texts(texts.select("rid", "text"), make, BLOBS, BATCH_BYTES)


def several(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For entries in groups that begin at ``first``: whether the group holds different values."""
    if not len(values):
        return np.zeros(0, bool)
    differ = np.minimum.reduceat(values, first) != np.maximum.reduceat(values, first)
    return np.repeat(differ, np.diff([*first, len(values)]))


def compare_anchors(limit: int):
    def compare(table: pa.Table) -> pa.Table:
        key, rid, pos = joined(table, "key", np.uint64), joined(table, "rid", np.int64), joined(table, "pos", np.int32)
        order = np.argsort(key)
        key, rid, pos = key[order], rid[order], pos[order]
        first = np.flatnonzero(~same_as_before(key))
        keep = several(rid, first)
        hot = key[first[np.diff([*first, len(key)]) > limit]]
        found = marks(rid[keep], pos[keep])
        named = marks(np.full(len(hot), HOT_RID, np.int64), np.zeros(len(hot), np.int32), hot.view(np.int64))
        return pa.concat_tables([found, named])

    return compare


def contexts(marked: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """The bytes around each surviving anchor, or the windows around a hot one."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        raw = [text.encode("utf-8", "surrogatepass") for text in table["text"].to_pylist()]
        sizes = np.array([len(x) for x in raw], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        data = np.frombuffer(b"\0" * BEFORE + b"".join(raw) + b"\0" * WINDOW, np.uint8)
        mark_ends, places = lists(table["pos"])
        row = np.repeat(np.arange(len(raw)), np.diff(mark_ends))
        pos = places.astype(np.int64)
        at = starts[row] + pos + BEFORE
        grams = mixed(rolled(data.astype(np.uint64) + np.uint64(1), GRAM, MULTIPLIERS[0])) | np.uint64(1)
        key = grams[at]
        before, after = _reach(grams, at, key, pos, sizes[row])
        rid, ord_ = np.array(table["rid"])[row], np.array(table["ord"])[row]
        hot_here = np.isin(key, hot)
        for first in range(0, len(at), MOST_CONTEXTS):
            own = slice(first, first + MOST_CONTEXTS)
            bytes_ = _around(data, at[own], before[own], after[own])
            near, given = hot_here[own], (rid[own], ord_[own], pos[own], bytes_, before[own], after[own])
            yield from _open_contexts(buckets, mixed(key[own][~near]), *(x[~near] for x in given))
            if near.any():
                yield from _open_windows(buckets, *(x[near] for x in given))

    return map_texts(marked.select("rid", "ord", "text", "pos"), make, BLOBS, BATCH_BYTES)


def _around(data, at, before, after) -> np.ndarray:
    """The bytes that belong to each anchor, a row each; others are 0."""
    columns = np.arange(-BEFORE, WINDOW, dtype=np.int32)
    out = np.zeros((len(at), CONTEXT), np.uint8)
    for part in range(0, len(at), 8192):
        own = slice(part, part + 8192)
        inside = (columns[None] >= -before[own, None].astype(np.int32)) & (columns[None] < after[own, None].astype(np.int32))
        out[own] = data[at[own, None] + columns] * inside
    return out


def _reach(grams, at, key, pos, sizes) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and from each anchor on belong to windows whose least gram it is.

    A smaller gram on either side ends them, as does the text.
    """
    before, after = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for part in range(0, len(at), 8192):
        own = slice(part, part + 8192)
        around = grams[np.minimum(at[own, None] + np.arange(-BEFORE, BEFORE + 1), len(grams) - 1)] < key[own, None]
        left = np.where(around[:, :BEFORE].any(axis=1), around[:, :BEFORE][:, ::-1].argmax(axis=1), BEFORE)
        right = np.where(around[:, BEFORE + 1 :].any(axis=1), around[:, BEFORE + 1 :].argmax(axis=1), BEFORE)
        before[own] = np.minimum(pos[own], left)
        after[own] = np.minimum(sizes[own] - pos[own], right + GRAM)
    return before.astype(np.uint8), after.astype(np.uint8)


def _valid(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For each anchor and place d: whether the window that begins d bytes before it is inside the text."""
    d = np.arange(BEFORE + 1)[None]
    return (before[:, None] >= d) & (after[:, None] >= WINDOW - d)


def _bits(valid: np.ndarray) -> np.ndarray:
    return valid.astype(np.int64) @ (np.int64(1) << np.arange(BEFORE + 1, dtype=np.int64))


def _open_contexts(buckets, key, rid, ord_, pos, bytes_, before, after) -> Iterator[pa.Table]:
    data = np.ascontiguousarray(np.column_stack([bytes_, before, after]))
    whole = data.view(f"V{CONTEXT + 2}").ravel()
    hashed = mixed(rolled_rows(data))
    order = np.lexsort((pos, rid, ord_, hashed, key))
    key, rid, ord_, pos, data, whole = (x[order] for x in (key, rid, ord_, pos, data, whole))
    same = same_as_before(key, hashed[order]) & same_bytes(whole)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(key)))) if len(key) else np.zeros(0, int)
    later = ord_ > ord_[first]
    if later.any():
        yield settled(buckets, rid[later], pos[later].astype(np.int32), _bits(_valid(data[later, -2], data[later, -1])))
    own = ~later
    yield blobs(OPEN, buckets, key[own], rid=rid[own], ord=ord_[own], pos=pos[own].astype(np.int32), data=data[own])


def same_bytes(values: np.ndarray) -> np.ndarray:
    same = np.zeros(len(values), bool)
    same[1:] = values[1:] == values[:-1]
    return same


def rolled_rows(data: np.ndarray, multiplier: int = MULTIPLIERS[1]) -> np.ndarray:
    key = np.zeros(len(data), np.uint64)
    for j in range(data.shape[1]):
        key = key * np.uint64(multiplier) + data[:, j].astype(np.uint64) + np.uint64(1)
    return key


def _open_windows(buckets, rid, ord_, pos, bytes_, before, after) -> Iterator[pa.Table]:
    valid = _valid(before, after)
    at, d = np.nonzero(valid)
    one = np.empty(len(at), np.uint64)
    two = np.empty(len(at), np.uint64)
    for place in range(BEFORE + 1):
        own = d == place
        part = bytes_[at[own], BEFORE - place : BEFORE - place + WINDOW]
        one[own], two[own] = mixed(rolled_rows(part, MULTIPLIERS[0])), mixed(rolled_rows(part))
    rid, ord_, pos = rid[at], ord_[at], pos[at].astype(np.int32)
    bit = np.int64(1) << d.astype(np.int64)
    order = np.lexsort((pos, rid, ord_, two, one))
    one, two, rid, ord_, pos, bit = (x[order] for x in (one, two, rid, ord_, pos, bit))
    same = same_as_before(one, two)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(one))))
    later = ord_ > ord_[first]
    if later.any():
        yield settled(buckets, rid[later], pos[later], bit[later])
    own = ~later
    yield blobs(WINDOWS, buckets, one[own], key=one[own], key2=two[own], rid=rid[own], ord=ord_[own], pos=pos[own], data=bit[own])


def radix_pass(group: np.ndarray, digit: np.ndarray, ord_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Refine groups by one more digit: which entries go on, and their new groups.

    Entries with equal group and digit are brought together by a mixed 64-bit
    value of both. Those whose new group holds a single document are finished.
    """
    order = np.argsort(mixed(mixed(digit) + group.astype(np.uint64)))
    g, d, o = group[order], digit[order], ord_[order]
    first = np.flatnonzero(~same_as_before(g, d))
    on = several(o, first)
    return order[on], np.repeat(np.arange(len(first)), np.diff([*first, len(o)]))[on] if len(o) else g


def digits(window: np.ndarray) -> Iterator[np.ndarray]:
    """Eight bytes of each row at a time, from the left, as big-endian numbers."""
    for start in range(0, window.shape[1], 8):
        part = window[:, start : start + 8]
        wide = np.zeros((len(part), 8), np.uint8)
        wide[:, : part.shape[1]] = part
        yield wide.view(">u8").ravel().astype(np.uint64)


def compare_contexts(table: pa.Table) -> pa.Table:
    """Radix sort of the windows around the bucket's anchors, through their 50 bytes."""
    open_ = table.filter(pc.equal(table["kind"], OPEN))
    rid, ord_, pos = joined(open_, "rid", np.int64), joined(open_, "ord", np.int64), joined(open_, "pos", np.int32)
    data = joined(open_, "data", np.uint8).reshape(-1, CONTEXT + 2)
    before, after = data[:, -2], data[:, -1]
    entry, group = np.arange(len(rid)), np.zeros(len(rid), np.int64)
    for digit in digits(data[:, BEFORE : BEFORE + GRAM]):
        on, group = radix_pass(group, digit[entry], ord_[entry])
        entry = entry[on]
    mask = np.zeros(len(rid), np.int64)
    for d in range(BEFORE + 1):
        inside = (before[entry] >= d) & (after[entry] >= WINDOW - d)
        some, own = entry[inside], group[inside]
        ends = np.arange(BEFORE - d, BEFORE - d + WINDOW)
        other = ends[(ends < BEFORE) | (ends >= BEFORE + GRAM)]
        for start in range(0, len(other), 8):
            digit = next(digits(data[some][:, other[start : start + 8]])) if len(some) else np.zeros(0, np.uint64)
            on, own = radix_pass(own, digit, ord_[some])
            some = some[on]
        if len(some):
            first = np.flatnonzero(~same_as_before(own))
            least = np.minimum.reduceat(ord_[some], first)
            later = some[ord_[some] > np.repeat(least, np.diff([*first, len(some)]))]
            mask[later] |= np.int64(1) << np.int64(d)
    hit = mask != 0
    found = marks(rid[hit], pos[hit], mask[hit])

    wide = table.filter(pc.equal(table["kind"], WINDOWS))
    if not wide.num_rows:
        return found
    key, key2, ord_ = joined(wide, "key", np.uint64), joined(wide, "key2", np.uint64), joined(wide, "ord", np.int64)
    rid, pos, bit = joined(wide, "rid", np.int64), joined(wide, "pos", np.int32), joined(wide, "data", np.int64)
    order = np.lexsort((ord_, key2, key))
    same = same_as_before(key[order], key2[order])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    later = order[ord_[order] > ord_[order][first]]
    return pa.concat_tables([found, marks(rid[later], pos[later], bit[later])])


def removed_starts(pos: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Where the removed windows of a document begin."""
    parts = [pos[(mask >> np.int64(d)) & 1 == 1] - d for d in range(BEFORE + 1)]
    return np.unique(np.concatenate(parts))


def kept_bytes(marked: DataFrame, with_text: bool) -> DataFrame:
    schema = "sha string, ord long, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def make(table: pa.Table) -> Iterator[pa.Table]:
        mark_ends, places = lists(table["pos"])
        _, masks = lists(table["mask"])
        out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
        for i, text in enumerate(table["text"].to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            own = slice(mark_ends[i], mark_ends[i + 1])
            gone = spans = 0
            kept = data
            if own.stop > own.start:
                change = np.zeros(len(data) + 1, np.int32)
                starts = removed_starts(places[own].astype(np.int64), masks[own])
                np.add.at(change, starts, 1)
                np.add.at(change, starts + WINDOW, -1)
                drop = np.cumsum(change[:-1]) > 0
                gone = int(drop.sum())
                spans = int((drop & ~np.concatenate([[False], drop[:-1]])).sum())
                kept = np.frombuffer(data, np.uint8)[~drop].tobytes()
            out["n_bytes"].append(len(data))
            out["n_removed"].append(gone)
            out["n_spans"].append(spans)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept_text"].append(kept if with_text else None)
        if not with_text:
            del out["kept_text"]
        kinds = {"kept_text": pa.binary(), "kept_sha256": pa.string()}
        yield pa.table({c: table[c] for c in ("sha", "ord", "copies")} | {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    more = ", kept_text binary" if with_text else ""
    return map_texts(marked.select("sha", "ord", "copies", "text", "pos", "mask"), make, schema + more)


def suffix_dedup(docs: DataFrame, files: Files, with_text: bool = True, hot_limit: int | None = None) -> DataFrame:
    """Remove from ``docs`` (doc_id, text) every byte covered by a 50-byte string that a smaller doc_id has too.

    A row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if
    asked for, kept_text (the bytes left, which may cut a character). A null
    doc_id comes after all others. Rows that share doc_id and text are one
    document and get one result each; texts that share only the doc_id take
    nothing from each other. Null texts have no bytes; texts under 50 bytes
    lose nothing. An empty table gives an empty result. Other columns are
    ignored. ``hot_limit``: occurrences from which on an anchor's windows are
    dealt one by one; the result does not depend on it.
    """
    entries, texts = distinct_texts(docs, files)
    bytes_each = partition_bytes(docs.sparkSession)
    buckets = buckets_for(texts, bytes_each, 4.0)
    limit = hot_limit or max(100, bytes_each // (CONTEXT + 2) // HOT_PART)
    found = files.write(settle(anchors(texts, buckets), compare_anchors(limit)), "survivors")
    # Occurrences beyond ``limit`` fill a tenth of a bucket, so there are at most some ten keys per bucket.
    named = found.where(F.col("rid") == HOT_RID).select(F.col("mask").alias("key")).distinct().collect()
    hot = np.array([r["key"] for r in named], np.int64).view(np.uint64)
    near = marked_texts(texts, found.where(F.col("rid") != HOT_RID)).where("pos IS NOT NULL")
    removed = files.write(settle(contexts(near, buckets, hot), compare_contexts), "removed")
    kept = files.write(kept_bytes(marked_texts(texts, removed), with_text), "kept")
    files.drop("texts", "survivors", "removed")
    long_enough = F.col("n_bytes") >= WINDOW
    copies = {
        "n_bytes": F.col("n_bytes"),
        "n_removed": F.when(long_enough, F.col("n_bytes")).otherwise(0),
        "n_spans": F.when(long_enough, 1).otherwise(0).cast("long"),
        "kept_sha256": F.when(long_enough, F.lit(NO_BYTES)).otherwise(F.col("sha")),
    }
    if with_text:
        copies["kept_text"] = F.when(long_enough, F.lit(b"")).otherwise(F.col("kept_text"))
    answers = kept.select(
        "sha", "ord", "copies", *[F.struct(F.col(c).alias("own"), copy.alias("copy")).alias(c) for c, copy in copies.items()]
    )
    return answer_rows(entries, answers, list(copies))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), Files(spark, "suffix_dedup"), with_text=False)
