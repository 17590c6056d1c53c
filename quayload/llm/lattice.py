"""Embedding near-dedup by lattice hashing.

A table projects unit vectors to 16 dimensions and decodes both halves to the
nearest point of the E8 lattice; the two points and the label name a cell. Each
vector is stored in its own cell and probes the cells of the lattice neighbours
it is nearest to. Vectors that meet are compared by cosine in double precision.

Equal vectors are one class with a multiplicity. Cells with many members are
compared in blocks. What a block finds leaves it as numbers: how many vectors
each is linked with, and a spanning forest; a pair that several tables find is
counted in the first of them.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.llm.common import Files, in_batches, look_up, only
from quayload.llm.graph import components

COSINE = 0.98
TABLES, HALVES, DIMENSION = 8, 2, 8
#: Lattice units of a unit vector, for 64 dimensions.
SCALE = 4.0
SEED = 23
#: Members of a cell that are compared at once, and entries of a bucket of cells, blocks dealt out.
BLOCK, BUCKET_ENTRIES = 2000, 20_000
BATCH_BYTES = 1 << 20


@functools.cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [(i, j, s, t) for i in range(8) for j in range(i + 1, 8) for s in (1, -1) for t in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, s, t) in enumerate(pairs):
        whole[row, i], whole[row, j] = s, t
    signs = np.array(np.meshgrid(*[(0.5, -0.5)] * 8, indexing="ij")).reshape(8, -1).T
    return np.concatenate([whole, signs[(signs < 0).sum(axis=1) % 2 == 0]])


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Integers with an even sum: round, and if the sum is odd, round the worst coordinate the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    worst = np.abs(x - r)[odd].argmax(axis=1)
    r[odd, worst] += np.where((x - r)[odd, worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@functools.cache
def projections(size: int) -> np.ndarray:
    """TABLES matrices of size x 16: blocks of random rotations, so that tables see different directions."""
    random = np.random.default_rng([SEED, size])
    width = HALVES * DIMENSION
    columns = []
    while len(columns) < TABLES:
        turn = np.linalg.qr(random.normal(size=(size, size)))[0]
        columns += [turn[:, at : at + width] for at in range(0, size - width + 1, width)]
        if size < width:
            columns.append(random.normal(size=(size, width)) / np.sqrt(width))
    return np.stack(columns[:TABLES]) * SCALE * np.sqrt(size / 64 if size >= width else 1.0)


def _hashed(*columns: np.ndarray) -> np.ndarray:
    """64-bit hash of rows of numbers."""
    key = np.full(len(columns[0]), 0x9E3779B97F4A7C15, np.uint64)
    for column in columns:
        for part in column.reshape(len(column), -1).T:
            key = (key ^ part.astype(np.int64).view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(29)
    return key.view(np.int64)


def cell_keys(units: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home cell (n x TABLES) and probed cells (n x TABLES x 3) of unit vectors of one size."""
    n = len(units)
    home, probe = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, 3), np.int64)
    for t, matrix in enumerate(projections(units.shape[1])):
        x = units @ matrix
        own, other = [], []
        for h in range(HALVES):
            part = x[:, h * DIMENSION : (h + 1) * DIMENSION]
            point = nearest_e8(part)
            step = neighbours()[((part - point) @ neighbours().T).argmax(axis=1)]
            own.append((2 * point).astype(np.int64))
            other.append((2 * (point + step)).astype(np.int64))
        table = np.full(n, t)
        home[:, t] = _hashed(table, labels, own[0], own[1])
        for k, (a, b) in enumerate(((other[0], own[1]), (own[0], other[1]), (other[0], other[1]))):
            probe[:, t, k] = _hashed(table, labels, a, b)
    return home, probe


def _unit(raw: list[bytes]) -> list[np.ndarray]:
    vectors = [np.frombuffer(x, np.float64) for x in raw]
    return [v / np.sqrt(v @ v) for v in vectors]


def _keys_of(raw: list[bytes], labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    units = _unit(raw)
    sizes = np.array([len(u) for u in units], int)
    home, probe = np.empty((len(raw), TABLES), np.int64), np.empty((len(raw), TABLES, 3), np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        home[rows], probe[rows] = cell_keys(np.stack([units[i] for i in rows]), labels[rows])
    return units, home, probe


def with_class(vectors: DataFrame) -> DataFrame:
    """vec_id, ``class`` (null for vectors that link with nothing), label_key and the vector in doubles."""
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("class", T.StringType()),
            T.StructField("label_key", T.LongType()),
            T.StructField("vector", T.BinaryType()),
        ]
    )

    def make(table: pa.Table) -> Iterator[pa.Table]:
        classes, keys, raw = [], [], []
        for label, values in zip(table["label"].to_pylist(), table["embedding"].to_pylist(), strict=True):
            vector = None
            if label is not None and values and None not in values:
                vector = np.array(values, np.float64) + 0.0
                with np.errstate(over="ignore", invalid="ignore"):
                    if not np.isfinite(vector).all() or not vector.any():
                        vector = None
                    else:
                        vector = vector / np.abs(vector).max()
            if vector is None:
                classes.append(None), keys.append(None), raw.append(None)
                continue
            name = hashlib.sha256(label.encode()).digest()
            raw.append(vector.tobytes())
            classes.append(hashlib.sha256(name + raw[-1]).hexdigest())
            keys.append(int.from_bytes(name[:8], "little", signed=True))
        yield pa.table(
            {
                "vec_id": table["vec_id"].cast(pa.int64()),
                "class": pa.array(classes, pa.string()),
                "label_key": pa.array(keys, pa.int64()),
                "vector": pa.array(raw, pa.binary()),
            }
        )

    plain = only(vectors, "vec_id", "embedding", "label").withColumn("label", F.col("label").cast("string"))
    return plain.mapInArrow(in_batches(make, BATCH_BYTES), schema)


def _entries(classes: DataFrame) -> DataFrame:
    """A row per class and cell it is stored in (role 0) or probes (role 1)."""

    def make(table: pa.Table) -> Iterator[pa.Table]:
        rid = np.array(table["rid"])
        _, home, probe = _keys_of(table["vector"].to_pylist(), np.array(table["label_key"]))
        keys = np.concatenate([home.ravel(), probe.ravel()])
        tables = np.concatenate([np.tile(np.arange(TABLES), len(rid)), np.tile(np.repeat(np.arange(TABLES), 3), len(rid))])
        rids = np.concatenate([np.repeat(rid, TABLES), np.repeat(rid, 3 * TABLES)])
        role = np.repeat([0, 1], [home.size, probe.size])
        yield pa.table(
            {
                "key": pa.array(keys),
                "place": pa.array(tables.astype(np.int32)),
                "rid": pa.array(rids),
                "role": pa.array(role.astype(np.int32)),
            }
        )

    return classes.select("rid", "label_key", "vector").mapInArrow(
        in_batches(make, BATCH_BYTES), "key long, place int, rid long, role int"
    )


def _met(home: np.ndarray, probe: np.ndarray, t: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a and b meet in table t at all."""
    one = (probe[a, t] == home[b, t][:, None]).any(axis=1)
    two = (probe[b, t] == home[a, t][:, None]).any(axis=1)
    return (home[a, t] == home[b, t]) | one | two


def _linked(table: int, role, block, cross: bool, units: np.ndarray, home, probe, rid, at, cosine: float):
    """Index pairs of a cell's entries that are linked and counted here."""
    stored, probing = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    found_a, found_b = [], []
    for left in (stored, probing):
        if not len(left) or not len(stored):
            continue
        close = units[at[left]] @ units[at[stored]].T >= cosine
        i, j = np.nonzero(close)
        a, b = left[i], stored[j]
        keep = rid[at[a]] != rid[at[b]]
        if cross:
            keep &= block[a] != block[b]
        if left is stored:
            keep &= rid[at[a]] < rid[at[b]]
        else:
            # the other one may probe this one's cell as well: then the smaller rid's probe counts
            back = (probe[at[b], table] == home[at[a], table][:, None]).any(axis=1)
            keep &= ~back | (rid[at[a]] < rid[at[b]])
        found_a.append(at[a[keep]])
        found_b.append(at[b[keep]])
    if not found_a:
        return np.zeros(0, int), np.zeros(0, int)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    for earlier in range(table):
        new = ~_met(home, probe, earlier, a, b)
        a, b = a[new], b[new]
    return a, b


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member each of n things is connected to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def _compare(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        raw, place = np.unique(np.array(table["rid"]), return_index=True)
        taken = table.take(pa.array(place))
        units, home, probe = _keys_of(taken["vector"].to_pylist(), np.array(taken["label_key"]))
        many, labels = np.array(taken["copies"]), np.array(taken["label_key"])
        at_all = np.searchsorted(raw, np.array(table["rid"]))
        group, cross = np.array(table["cell"]), np.array(table["crossing"])
        role, block, table_no = np.array(table["role"]), np.array(table["block"]), np.array(table["place"])
        order = np.argsort(group, kind="stable")
        bounds = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1], [True]]))
        links, pairs_a, pairs_b = np.zeros(len(raw), np.int64), [], []
        sizes = np.array([len(u) for u in units], int)
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            rows = order[first:last]
            # a hash may bring together cells of other labels or sizes
            for kind in set(zip(labels[at_all[rows]].tolist(), sizes[at_all[rows]].tolist(), strict=True)):
                own = rows[(labels[at_all[rows]] == kind[0]) & (sizes[at_all[rows]] == kind[1])]
                if len(own) < 2:
                    continue
                members, at = np.unique(at_all[own], return_inverse=True)
                stack = np.stack([units[m] for m in members])
                a, b = _linked(
                    int(table_no[own[0]]), role[own], block[own], bool(cross[own[0]]), stack, home[members], probe[members], raw[members], at, cosine
                )
                np.add.at(links, members[a], many[members[b]])
                np.add.at(links, members[b], many[members[a]])
                pairs_a.append(members[a])
                pairs_b.append(members[b])
        a = np.concatenate(pairs_a) if pairs_a else np.zeros(0, int)
        b = np.concatenate(pairs_b) if pairs_b else np.zeros(0, int)
        root = _forest(len(raw), a, b)
        some = np.flatnonzero(links)
        return pa.table({"rid": pa.array(raw[some]), "links": pa.array(links[some]), "root": pa.array(raw[root[some]])})

    return run


def near_vectors(vectors: DataFrame, files: Files, cosine: float = COSINE) -> DataFrame:
    """A row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors of equal, non-null labels with a cosine of at least ``cosine`` are
    linked. Vectors that are null, empty, zero, or hold null or non-finite
    values, and vectors of different sizes, link with nothing. ``n_links`` counts the other rows
    linked directly, equal ones too; ``component_id`` is the smallest vec_id
    that links lead to. Repeated rows are rows of their own, linked with each
    other. A null vec_id links like others and never names a component, unless
    it has none but null ids. An empty table gives an empty result.
    Other columns are ignored.
    """
    rows = files.write(with_class(vectors), "vectors")
    grouped = rows.where("class IS NOT NULL").groupBy("class", "label_key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    classes = files.write(grouped.withColumn("rid", F.monotonically_increasing_id()), "classes")
    entries = files.write(_entries(classes), "entries")
    cells = entries.groupBy("key").agg(F.count("*").alias("n"), F.sum(1 - F.col("role")).alias("stored"))
    live = files.write(cells.where("n > 1 AND stored > 0"), "cells")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    # A cell's entries go to each of its blocks, so so many rows are dealt.
    total, dealt_rows = live.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * blocks), F.lit(0))).first()
    met = look_up(entries, live, "key", "n", max(total, 1)).where("n IS NOT NULL")
    own = F.pmod(F.xxhash64("rid", F.lit(3)), blocks).cast("int")
    met = met.withColumns({"blocks": blocks, "block": own})
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = met.withColumn("other", other).withColumns(
        {
            "cell": F.when(F.col("blocks") == 1, F.col("key")).otherwise(
                F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
            ),
            "crossing": F.col("block") != F.col("other"),
        }
    )
    buckets = int(dealt_rows // BUCKET_ENTRIES) + 1
    loaded = dealt.select("cell", "crossing", "block", "place", "rid", "role").join(
        classes.select("rid", "label_key", "copies", "vector"), "rid"
    )
    found = (
        loaded.withColumn("bucket", F.when(F.col("cell").isNotNull(), F.pmod("cell", F.lit(buckets))))
        .groupBy("bucket")
        .applyInArrow(_compare(cosine), "rid long, links long, root long")
    )
    found = files.write(found, "found")
    counts = found.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")), files)
    # Each class with its component, then the component's smallest id.
    placed = classes.select("rid", "class", "copies", "first_id").join(counts, "rid", "left")
    placed = placed.join(roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    placed = files.write(placed, "placed")
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    answers = look_up(placed.drop("component_id"), named, "root", "members", max(classes.count(), 1)).select(
        "class", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    answers = files.write(answers, "answers")
    linked = rows.where("class IS NOT NULL").select("vec_id", "class")
    answered = look_up(linked, answers, "class", "copies", max(linked.count(), 1))
    alone = rows.where("class IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        answered.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Files(spark, "lattice"))
