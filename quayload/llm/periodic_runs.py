"""Runs of repeated word groups, by Baier's grouping of suffixes.

The first phase of Baier's suffix sorter takes the groups of suffixes from the
highest to the lowest and moves the suffixes before them up; what it leaves is
the longest Lyndon word at each place, no suffix array needed. It runs under the
order of the words and under its reverse: by the runs theorem each run has a
root that is the longest Lyndon word at its place under one of the two. Roots
are then extended to both sides by longest common extensions.

Most words of a text cannot be in a run of the wanted exponent, because the next
equal word is too far away. Stretches that may hold a run are found first, and
only these are grouped; none that holds one is left out (``stretches``).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.common import documents, in_batches, only

LEAST_WORDS, EXPONENT = 6, 4
BATCH_BYTES = 2 << 20
NEVER = np.iinfo(np.int64).max
RUN = "struct<start: bigint, length: bigint, period: bigint>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>"

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place; ``symbols`` are 0, 1, ... without gaps.

    A group is an interval of ranks, named by its first one, with the Lyndon
    word its suffixes begin with. For each suffix of the highest group left, the
    nearest suffix before it in a lower group has that group's word behind its
    own, as often as it was met; it goes to a new group right above its old one,
    those met most often highest. The end of the text comes before all symbols.
    """
    size = len(symbols)
    starts = np.concatenate([[0], np.cumsum(np.bincount(symbols))]) if size else np.zeros(1, np.int64)
    first = starts.tolist()
    group = [first[s] for s in symbols]
    members: list[list[int] | None] = [None] * size
    end, word = [0] * size, [1] * size
    for low, high in zip(first, first[1:]):
        members[low], end[low] = [], high
    for place, name in enumerate(group):
        members[name].append(place)
    before, found = [-1] * size, [0] * size
    for name in range(size - 1, -1, -1):
        if members[name] is None:
            continue
        length, moves = word[name], {}
        last, times = -1, 0
        for place in members[name]:
            if group[place] != name:  # has moved up since
                continue
            found[place] = length
            back = place - 1
            while back >= 0 and group[back] >= name:
                back = before[back]
            before[place] = back
            # the places go up, and so do those before them
            if back == last:
                times += 1
                continue
            if last >= 0:
                moves.setdefault((times, group[last]), []).append(last)
            last, times = back, 1
        if last >= 0:
            moves.setdefault((times, group[last]), []).append(last)
        members[name] = None
        for times, old in sorted(moves, reverse=True):
            part = moves[times, old]
            high = end[old]
            new = high - len(part)
            end[old] = new
            members[new], end[new], word[new] = part, high, word[old] + times * length
            if new != old:
                for place in part:
                    group[place] = new
    return found


def common_after(x: np.ndarray, left: int, right: int) -> int:
    """How many values from ``left`` and from ``right`` (the larger) on are equal."""
    same, step = 0, 16
    while right + same < len(x):
        a, b = x[left + same : left + same + step], x[right + same : right + same + step]
        differ = a[: len(b)] != b
        if differ.any():
            return same + int(differ.argmax())
        same, step = same + len(b), step * 2
    return same


def common_before(x: np.ndarray, left: int, right: int) -> int:
    """How many values before ``left`` (the smaller) and before ``right`` are equal."""
    same, step = 0, 16
    while left - same > 0:
        take = min(step, left - same)
        differ = x[left - same - take : left - same] != x[right - same - take : right - same]
        if differ.any():
            return same + int(differ[::-1].argmax())
        same, step = same + take, step * 2
    return same


def stretches(ids: np.ndarray, ends: np.ndarray, least: int, exponent: int) -> Iterator[tuple[int, int]]:
    """Disjoint stretches (from, to) of texts laid end to end; each run is inside one.

    In a run of period q, each word but those of the last period meets an equal
    one at most q further on. So for the periods from 2**k to below 2**(k+1),
    a run shows as many neighbouring words whose next equal word is nearer than
    2**(k+1), (exponent - 1) * 2**k at least. ``ends`` has a leading 0.
    """
    sizes = np.diff(ends)
    if not len(ids):
        return
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((ids, row))
    gap = np.full(len(ids), NEVER)
    same = (ids[order[1:]] == ids[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    change = np.zeros(len(ids) + 1, np.int64)
    step = 1
    while exponent * step <= sizes.max():
        near = np.concatenate([[False], gap < 2 * step, [False]])
        edges = np.flatnonzero(near[1:] != near[:-1])
        low, high = edges[::2], edges[1::2]
        long = high - low >= max((exponent - 1) * step, least - 2 * step + 1)
        low, high = low[long], high[long]
        np.add.at(change, low, 1)
        np.add.at(change, np.minimum(high + 2 * step - 1, ends[1:][row[low]]), -1)
        step *= 2
    inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    # neighbouring texts may touch: cut between them
    cut = np.flatnonzero(inside[1:] != inside[:-1])
    for low, high in zip(cut[::2].tolist(), cut[1::2].tolist()):
        inner = ends[np.searchsorted(ends, low, "right") : np.searchsorted(ends, high, "left")].tolist()
        yield from zip([low, *inner], [*inner, high])


def runs_in(x: np.ndarray, low: int, high: int, least: int, exponent: int) -> set[Run]:
    """Runs (start, length, period) of the text ``x`` that have their roots in ``low`` to ``high``.

    A run of three periods or more has the same Lyndon word twice in a row.
    """
    values, symbols = np.unique(x[low:high], return_inverse=True)
    found: set[Run] = set()
    for order in (symbols, len(values) - 1 - symbols):
        roots = np.array(lyndon_lengths(order.tolist()), np.int64)
        after = np.arange(len(roots)) + roots
        twice = after < len(roots)
        twice[twice] = roots[after[twice]] == roots[twice]
        twice[twice] = symbols[after[twice]] == symbols[twice]
        covered: dict[int, int] = {}
        for place in np.flatnonzero(twice).tolist():
            period, at = int(roots[place]), place + low
            if at + period <= covered.get(period, 0):
                continue
            start = at - common_before(x, at, at + period)
            end = at + period + common_after(x, at, at + period)
            if end - start >= 2 * period:
                covered[period] = end
                if end - start >= max(least, exponent * period):
                    found.add((start, end - start, period))
    return found


def find_runs(texts: list[list[bytes]], least: int, exponent: int) -> list[list[Run]]:
    """Runs of each text's words, by start and period."""
    numbers: dict[bytes, int] = {}
    ends = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
    flat = (numbers.setdefault(word, len(numbers)) for words in texts for word in words)
    ids = np.fromiter(flat, np.int64, int(ends[-1]))
    found: list[set[Run]] = [set() for _ in texts]
    for low, high in stretches(ids, ends, least, exponent):
        row = int(np.searchsorted(ends, low, "right")) - 1
        begin = int(ends[row])
        found[row] |= runs_in(ids[begin : ends[row + 1]], low - begin, high - begin, least, exponent)
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run has after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = (np.cumsum(drop[:-1]) == 0).tolist()
    return b" ".join(word for word, k in zip(words, keep) if k)


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    exponent: int = EXPONENT,
    with_text: bool = True,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """All runs of at least ``exponent`` periods and ``least`` words in the texts of ``docs`` (doc_id, text).

    A row per row: doc_id, n_words, ``runs`` (start, length, period in words, by
    start and period) and, if asked for, ``collapsed``: the words of the text,
    joined by a space, without those that a run repeats after its first period.
    Words are what is between white space. ``rewrite`` may change a document's
    words before. Null and empty texts have no words and no runs; rows that
    repeat are each answered; a null doc_id stays null; an empty table gives an
    empty result. Other columns are ignored. Nothing is shuffled. ``exponent``
    must be at least 3: below, a run need not show its root twice.
    """
    if exponent < 3 or least < 1:
        raise ValueError("runs must have 3 periods and 1 word at least")

    def make(table: pa.Table) -> Iterator[pa.Table]:
        ids = table["doc_id"].to_pylist()
        texts = [(text or b"").split() for text in table["text"].cast(pa.binary()).to_pylist()]
        if rewrite is not None:
            texts = [rewrite(doc_id, words) for doc_id, words in zip(ids, texts)]
        found = find_runs(texts, least, exponent)
        flat = np.array([run for runs in found for run in runs], np.int64).reshape(-1, 3)
        offsets = np.concatenate([[0], np.cumsum([len(runs) for runs in found])]).astype(np.int32)
        fields = [pa.array(flat[:, i]) for i in range(3)]
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
        out = {"doc_id": table["doc_id"], "n_words": pa.array([len(w) for w in texts], pa.int64()), "runs": runs}
        if with_text:
            kept = [collapse(words, runs) for words, runs in zip(texts, found)]
            out["collapsed"] = pa.array(kept, pa.binary()).cast(pa.string())
        yield pa.table(out)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(in_batches(make, BATCH_BYTES), SCHEMA + (", collapsed string" if with_text else ""))


def repeat_some(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Make the words of one document in ten periodic from some place on; its id says where and how. Null ids: unchanged."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir), rewrite=repeat_some)
    # the greatest length / period: fractions are compared by their cross products
    best = F.expr(
        """aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (best, run) ->
             CASE WHEN best IS NULL OR run.length * best.period > best.length * run.period THEN run ELSE best END)"""
    )
    lines = F.expr("array_join(transform(runs, run -> concat(run.start, ',', run.length, ',', run.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
