"""What the operators must give, by plain and slow means."""

from __future__ import annotations

import collections
import hashlib

LAST = 1 << 63


def place(doc_id):
    return LAST if doc_id is None else doc_id


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def exact(rows):
    """A list of (doc_id, keep_id, group_size, kept, text_sha256)."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), place(m[0])))[0]
        out += [(d, keep, len(members), d == keep, sha(norm.encode())) for d, _ in members]
    return out


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near(rows, width=4):
    """A list of (doc_id, n_shingles, component_id, kept)."""
    sets = [shingles(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = collections.defaultdict(lambda: LAST)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], place(doc_id))
    names = [None if least[find(i)] == LAST else least[find(i)] for i in range(len(rows))]
    return [(d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, names, strict=True)]


def spans_removed(units, starts, window):
    drop = [False] * len(units)
    for i in starts:
        drop[i : i + window] = [True] * window
    return drop


def byte_windows(rows, window=50):
    """A list of (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - window + 1):
            w = data[i : i + window]
            first[w] = min(first.get(w, LAST), place(doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        starts = [i for i in range(len(data) - window + 1) if first[data[i : i + window]] < place(doc_id)]
        drop = spans_removed(data, starts, window)
        spans = sum(d and not (i and drop[i - 1]) for i, d in enumerate(drop))
        kept = bytes(b for b, d in zip(data, drop, strict=True) if not d)
        out.append((doc_id, len(data), sum(drop), spans, sha(kept)))
    return out


def word_windows(rows, window=20):
    """A list of (doc_id, n_words, n_removed, kept_sha256); repeated rows are one document."""
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, (LAST + 1, 0)), (place(doc_id), i))
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        starts = [i for i in range(len(words) - window + 1) if first[tuple(words[i : i + window])] < (place(doc_id), i)]
        drop = spans_removed(words, starts, window)
        kept = b" ".join(w for w, d in zip(words, drop, strict=True) if not d)
        out.append((doc_id, len(words), sum(drop), sha(kept)))
    return out
