"""Parts of the two operators that find repeated passages.

Occurrences travel in blobs: a row holds all occurrences of one batch that fall
into one bucket of the key space, as binary columns. What repeats inside a batch
is settled there, and each key is sent on once per batch; so a passage that a
third of all documents share costs its bucket one entry per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayload.llm.common import Files, in_batches, look_up, only, text_of

#: Text a task handles at once.
BATCH_BYTES = 3 << 20
#: Stands for a missing doc_id, which comes after all others.
LAST = np.iinfo(np.int64).max
NO_BYTES = hashlib.sha256(b"").hexdigest()

BLOBS = "bucket int, kind int, key binary, key2 binary, rid binary, ord binary, pos binary, data binary"
#: A place in a text, with a number that says more about it.
MARKS = "rid long, pos int, mask long"
#: Kinds of blob rows: to be compared with other batches (two forms), and settled ones.
OPEN, WINDOWS, SETTLED = 0, 1, 2


def distinct_texts(docs: DataFrame, files: Files) -> tuple[DataFrame, DataFrame]:
    """``entries`` (doc_id, sha) with a row per row, ``texts`` (rid, sha, ord, copies, text) with one per text.

    ``ord`` is the text's smallest doc_id. Copies of a text are put together
    before and after the shuffle.
    """
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("sha", F.sha2("text", 256))
    entries = files.write(rows.select("doc_id", "sha"), "entries")
    first = F.coalesce(F.min("doc_id"), F.lit(int(LAST)))
    texts = rows.groupBy("sha").agg(first.alias("ord"), F.count("*").alias("copies"), F.first("text").alias("text"))
    return entries, files.write(texts.withColumn("rid", F.monotonically_increasing_id()), "texts")


def buckets_for(texts: DataFrame, bytes_each: int, bytes_per_byte: float) -> int:
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, int(total * bytes_per_byte / bytes_each) + 1)


def blobs(kind: int, buckets: int, bucket_key: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """One row per bucket that has entries; ``bucket_key`` must be sorted and gives the bucket by range."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(bucket_key, edges, "left"), [len(bucket_key)]]).astype(np.int64)
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    ends = np.concatenate([cuts[full], [len(bucket_key)]]) if len(full) else np.zeros(1, np.int64)
    out = {"bucket": pa.array(full.astype(np.int32)), "kind": pa.array(np.full(len(full), kind, np.int32))}
    for name in ("key", "key2", "rid", "ord", "pos", "data"):
        if name in columns:
            values = np.ascontiguousarray(columns[name])
            width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
            offsets = (ends * width).astype(np.int32)
            out[name] = pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
        else:
            out[name] = pa.nulls(len(full), pa.binary())
    return pa.table(out)


def settled(buckets: int, rid: np.ndarray, pos: np.ndarray, data: np.ndarray | None = None) -> pa.Table:
    """Entries that need no comparison, spread over the buckets by document."""
    spread = rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(spread, kind="stable")
    more = {} if data is None else {"data": data[order]}
    return blobs(SETTLED, buckets, spread[order], rid=rid[order], pos=pos[order], **more)


def joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table[name].to_pylist() if x), kind)


def marks(rid: np.ndarray, pos: np.ndarray, mask: np.ndarray | None = None) -> pa.Table:
    """A row per place, as MARKS has them."""
    return pa.table(
        {
            "rid": pa.array(rid.astype(np.int64)),
            "pos": pa.array(pos.astype(np.int32)),
            "mask": pa.array(np.zeros(len(rid), np.int64) if mask is None else mask.astype(np.int64)),
        }
    )


def same_as_before(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys: whether an entry's keys all equal those of the one before."""
    same = np.ones(len(keys[0]), bool)
    same[:1] = False
    for key in keys:
        same[1:] &= key[1:] == key[:-1]
    return same


def in_groups(same: np.ndarray) -> np.ndarray:
    """Whether an entry has a neighbour in its run of equal keys."""
    return same | np.concatenate([same[1:], [False]])


def marked_texts(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Left join of ``texts`` to the lists ``pos`` and ``mask`` of all marks in them."""
    gathered = found.groupBy("rid").agg(F.collect_list(F.struct("pos", "mask")).alias("marks"))
    return texts.join(gathered.select("rid", "marks.pos", "marks.mask"), "rid", "left")


def settle(rows: DataFrame, compare: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Compare the blobs of each bucket; settled ones pass."""

    def run(table: pa.Table) -> pa.Table:
        done = table.filter(pc.equal(table["kind"], SETTLED))
        parts = [compare(table.filter(pc.not_equal(table["kind"], SETTLED)))]
        if done.num_rows:
            data = joined(done, "data", np.int64)
            parts.append(marks(joined(done, "rid", np.int64), joined(done, "pos", np.int32), data if len(data) else None))
        return pa.concat_tables(parts)

    return rows.groupBy("bucket").applyInArrow(run, MARKS)


def map_texts(
    texts: DataFrame, make: Callable[[pa.Table], Iterator[pa.Table]], schema: str, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    return texts.mapInArrow(in_batches(make, batch_bytes), schema)


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of each row's list (null: empty) and all values."""
    array = column.combine_chunks()
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    sizes = np.array(pc.fill_null(pc.list_value_length(array), 0), np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), np.array(array.flatten())


def answer_rows(entries: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Each row's result: that of its text, or for a copy with a larger doc_id the ``copy`` one.

    ``answers``: sha, ord, copies, and each column as a struct of ``own`` and
    ``copy``.
    """
    total = entries.count()
    found = look_up(entries, answers, "sha", "copies", total)
    first = F.coalesce("doc_id", F.lit(int(LAST))) == F.col("ord")
    return found.select("doc_id", *[F.when(first, F.col(f"{c}.own")).otherwise(F.col(f"{c}.copy")).alias(c) for c in columns])
