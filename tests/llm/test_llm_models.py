"""Language ID, quality, tokens and embeddings: held-out accuracy, round trips and brute force."""

from __future__ import annotations

import base64
import math
import tempfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quayload.llm import byte_bpe, language_id, lattice, quality
from quayload.llm.common import Files

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def joined(spark, df, name):
    return df.join(spark.read.parquet(f"{SF}/{name}.parquet"), "doc_id").collect()


# language


def test_language_query(spark):
    found = language_id.op3_language_id(spark, SF)
    rows = joined(spark, found, "documents")
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert sum(held) >= 0.98 * len(held)
    assert sum(r.rejected for r in rows) < 0.05 * len(rows)


def test_language_edges(table, edge_rows):
    docs = table(edge_rows)
    model = language_id.train_language_model(docs)
    assert model.languages == ("de", "en", "fr")
    found = language_id.identify(docs, model).collect()
    assert len(found) == len(edge_rows)
    by_id = {r.doc_id: r for r in found}
    for doc_id in (1, 2, 3, 15):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score, by_id[doc_id].rejected) == ("und", 0.0, True)
    assert all(r.lang_pred in model.languages for r in found if r.doc_id not in (1, 2, 3, 15))


def test_language_batches_do_not_matter(table, edge_rows):
    model = language_id.train_language_model(table(edge_rows))
    texts = [row[1] or "" for row in edge_rows]
    together = model.predict(texts)
    for i, text in enumerate(texts):
        name, score, rejected = model.predict([text])
        assert name[0] == together[0][i] and rejected[0] == together[2][i]
        assert math.isclose(score[0], together[1][i], rel_tol=1e-9, abs_tol=1e-12)


def test_no_languages(table):
    empty = table([])
    model = language_id.train_language_model(empty)
    assert language_id.identify(empty, model).collect() == []
    assert language_id.identify(table([(1, "words")]), model).first().lang_pred == "und"
    one = language_id.train_language_model(table([(1, "nur eins", "de")]))
    assert language_id.identify(table([(2, "etwas")]), one).first().lang_pred == "de"


def test_calibration_lowers_overconfident_scores():
    random = np.random.default_rng(1)
    truth = random.integers(0, 2, 4000)
    logits = np.zeros((4000, 2))
    wrong = random.random(4000) < 0.2
    logits[np.arange(4000), np.where(wrong, 1 - truth, truth)] = 12.0
    temperature, limit = language_id.calibrate(logits, truth)
    assert 0.75 < language_id._softmax(logits / temperature).max(axis=1).mean() < 0.85
    assert 0.5 <= limit <= 1


# quality


def test_quality_query(spark):
    found = quality.op8_quality(spark, SF)
    assert found.count() == 1000
    rows = joined(spark, found, "labels")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r.predicted == r.quality for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def test_quality_edges(spark, table, edge_rows):
    docs = table(edge_rows)
    marks = "doc_id long, quality int, toxic int"
    some = spark.createDataFrame([(4, 1, 0), (7, 1, 0), (9, 1, 0), (10, 1, 0), (13, 0, 0), (15, 0, 0), (13, None, 0), (None, 1, 0), (11, 5, 0)], marks)
    found = quality.score_documents(docs, some, Files(spark, "tests")).collect()
    assert len(found) == len(edge_rows)
    assert all(0 <= r.score <= 1 for r in found)
    repeated = {r.score for r in found if r.doc_id == 5}
    assert len(repeated) == 1
    for labels, score in (([], 0.5), ([(4, 1, 0)], 1.0), ([(4, 0, 0)], 0.0)):
        rows = quality.score_documents(docs, spark.createDataFrame(labels, marks), Files(spark, "tests")).collect()
        assert {r.score for r in rows} == {score}
    assert quality.score_documents(table([]), some, Files(spark, "tests")).collect() == []
    left = quality.drop_rejected(docs, some, Files(spark, "tests"))
    assert left.schema == docs.schema
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in found if r.predicted)


def test_statistics_are_finite():
    for text in ("", "\n\n", " ", "a", "\U0001f642" * 9, "A! " * 5000):
        values = quality.statistics(text)
        assert len(values) == len(quality.NAMES) and np.isfinite(values).all()


# tokens


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    return byte_bpe.ByteBpe(byte_bpe.tokenizer_json(ranks), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_the_library_s(codec, library, text):
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text)
    assert codec.decode_bytes(ids) == text.encode() and codec.decode(ids) == text
    for (start, end), i in zip(codec.offsets(text), ids, strict=True):
        part = codec.bytes_of[i]
        assert part in text[start:end].encode()


def test_split_characters_decode_whole(codec):
    ids = codec.encode("\U0001f642")
    assert len(ids) > 1 and codec.decode(ids) == "\U0001f642"
    assert codec.decode(ids[:1]) == "�"
    assert codec.offsets("\U0001f642") == [(0, 1)] * len(ids)


def test_encode_and_decode_tables(spark, table, edge_rows, library):
    docs = table(edge_rows)
    model = byte_bpe.production_model(spark)
    encoded = byte_bpe.encode_documents(docs, model)
    rows = encoded.collect()
    expected = Counter((d, tuple(library.encode_ordinary(t or ""))) for d, t, *_ in edge_rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == expected
    assert all(r.n_tokens == len(r.ids) for r in rows)
    back = Counter((r.doc_id, r.text) for r in byte_bpe.decode_documents(encoded, model).collect())
    assert back == Counter((d, t or "") for d, t, *_ in edge_rows)
    assert byte_bpe.encode_documents(table([]), model).collect() == []


def test_token_query(spark, library):
    import hashlib

    for r in joined(spark, byte_bpe.op9_byte_bpe(spark, SF), "documents"):
        ids = np.array(library.encode_ordinary(r.text), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


# embeddings

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("rid", T.StringType()),
        T.StructField("class", T.StringType()),
    ]
)


def test_documents_have_offsets(spark):
    """In columns, split characters too."""
    texts = ["plain words", "été 漢字 \U0001f642\U0001f9ff ꙮ", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = byte_bpe.production_model(spark)
    codec, split = byte_bpe.ByteBpe(model.json, model.pattern), 0
    for row in byte_bpe.encode_documents(docs, model, with_offsets=True).collect():
        text, expected, at = texts[row.doc_id] or "", [], 0
        of_byte = [i for i, c in enumerate(text) for _ in c.encode()]
        for n in (len(codec.bytes_of[i]) for i in row.ids):
            expected.append((of_byte[at], of_byte[at + n - 1] + 1))
            at += n
        assert list(zip(row.starts, row.ends, strict=True)) == expected
        split += any(a[1] > b[0] for a, b in zip(expected, expected[1:]))
    assert split


def brute_vectors(rows, cosine=0.98):
    units = []
    for _, values, label, *_ in rows:
        good = label is not None and values and None not in values and np.isfinite(values).all() and any(values)
        units.append(np.array(values, float) / np.abs(values).max() if good else None)
    units = [None if u is None else u / np.sqrt(u @ u) for u in units]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if find(k) == find(i) and r[0] is not None]
        component = min(ids) if ids else None
        out.append((row[0], links[i], component, row[0] == component))
    return Counter(out)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], VECTORS)


def found_vectors(spark, rows, **settings):
    found = lattice.near_vectors(vectors(spark, rows), Files(spark, "tests"), **settings)
    return Counter(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect()))


def test_vector_edges(spark):
    random = np.random.default_rng(4)
    base = random.normal(size=64)
    near = (base + random.normal(size=64) * 0.05).tolist()
    far = random.normal(size=64).tolist()
    base = base.tolist()
    rows = [
        (1, base, 1), (2, near, 1), (3, far, 1), (4, base, 2), (5, base, None), (6, None, 1), (7, [0.0] * 64, 1),
        (8, [*base[:-1], None], 1), (9, [*base[:-1], float("nan")], 1), (10, [*base[:-1], float("inf")], 1),
        (11, base, 1), (11, base, 1), (None, base, 1), (12, [], 1), (13, [2 * x for x in base], 1),
        (14, [1e300 * x for x in base], 1), (15, base[:32], 1), (16, base[:32], 1), (17, [1.0, 2.0], 1), (18, [1.0, 2.01], 1),
        (19, [-x for x in base], 1), (20, [-0.0] * 64, 1),
    ]
    assert found_vectors(spark, rows) == brute_vectors(rows)
    assert found_vectors(spark, []) == Counter()


@pytest.mark.parametrize("block", [2000, 40])
def test_vector_groups(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    random = np.random.default_rng(5)
    centre = random.normal(size=64)
    rows = [(i, (centre + random.normal(size=64) * 0.09).tolist(), 1) for i in range(150)]
    rows += [(1000 + i, random.normal(size=64).tolist(), i % 3) for i in range(200)]
    found, true = found_vectors(spark, rows), brute_vectors(rows)
    links = lambda bag: sum(row[1] * n for row, n in bag.items())
    assert links(found) <= links(true)
    assert links(found) >= 0.995 * links(true)
    assert sum((found - true).values()) < 0.2 * len(rows)


def test_vector_buckets_hold_what_they_may(spark, monkeypatch, tmp_path):
    """Many close vectors under one label: blocks repeat entries, and groups stay small."""
    monkeypatch.setattr(lattice, "BLOCK", 20)
    monkeypatch.setattr(lattice, "BUCKET_ENTRIES", 400)
    compare, folder = lattice._compare, str(tmp_path)

    def noting(cosine):
        run = compare(cosine)

        def noted(table):
            with tempfile.NamedTemporaryFile("w", dir=folder, delete=False) as file:
                file.write(str(table.num_rows))
            return run(table)

        return noted

    monkeypatch.setattr(lattice, "_compare", noting)
    random = np.random.default_rng(8)
    centre = random.normal(size=64)
    rows = [(i, (centre + random.normal(size=64) * 0.01).tolist(), 1) for i in range(300)]
    assert found_vectors(spark, rows) == brute_vectors(rows)
    held = [int(path.read_text()) for path in tmp_path.iterdir()]
    assert sum(held) > 5 * 8 * 300 and max(held) <= 2 * 400


def test_lattice_points_are_nearest():
    random = np.random.default_rng(6)
    x = random.normal(size=(2000, 8)) * 2
    points = lattice.nearest_e8(x)
    distance = ((x - points) ** 2).sum(axis=1)
    assert len(lattice.neighbours()) == 240 and np.allclose((lattice.neighbours() ** 2).sum(axis=1), 2)
    assert (distance <= 1 + 1e-9).all()  # the covering radius
    for step in lattice.neighbours():
        assert (distance <= ((x - points - step) ** 2).sum(axis=1) + 1e-9).all()
