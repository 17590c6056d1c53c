"""Mixing, resharding, the SQL of the queries, and the pipeline."""

from __future__ import annotations

import collections
import itertools
import random
import zlib
from collections import Counter

import brute
import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from quayload.llm import registry, resharding
from quayload.llm.common import Files
from quayload.llm.mixing import Mix, leaf_budgets, mix_sources, take_mix
from quayload.llm.resharding import minimum_cost_flow, op6_reshard, reshard, rewrite_shards, transfers

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "embeddings")


@pytest.mark.parametrize("key", registry.SQL)
def test_query_agrees_with_sql(spark, key):
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    expected = duck.execute(registry.SQL[key])
    columns = [item[0] for item in expected.description]
    rows = Counter(map(tuple, expected.fetchall()))
    df = registry.QUERIES[key](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == rows


# mixing


def budgets(spark, leaves, mix):
    paths = [(dict(zip(mix.levels, path, strict=True)), tokens) for path, tokens in leaves]
    kind = ", ".join(f"{c}: string" for c in mix.levels)
    df = spark.createDataFrame(paths, f"leaf struct<{kind}>, tokens long")
    return {tuple(r.leaf): r.share for r in leaf_budgets(df, mix).collect()}


def test_shortage_goes_to_siblings_first(spark):
    mix = Mix(("d", "l", "s"), {"d": {"a": 1, "b": 1}}, budget_parts=500)
    leaves = [(("a", "x", "1"), 10), (("a", "x", "2"), 500), (("a", "y", "3"), 490), (("b", "x", "4"), 400), (("b", None, "5"), 600)]
    share = budgets(spark, leaves, mix)
    # each domain 500; in a: x and y 250 each; what leaf 1 lacks leaf 2 takes over
    assert share == {("a", "x", "1"): 10, ("a", "x", "2"): 240, ("a", "y", "3"): 250, ("b", "x", "4"): 250, ("b", None, "5"): 250}


def test_shortage_of_a_whole_branch_goes_up(spark):
    mix = Mix(("d", "s"), {"d": {"a": 3, "b": 1, "no": 0}}, budget_parts=1000)
    leaves = [(("a", "1"), 100), (("a", "2"), 100), (("b", "3"), 500), (("b", "4"), 50), (("no", "5"), 250)]
    assert budgets(spark, leaves, mix) == {("a", "1"): 100, ("a", "2"): 100, ("b", "3"): 500, ("b", "4"): 50}


def test_epochs_and_prefixes(spark, table, files):
    rows = [(i, "w " * (i % 9), "en", "src1") for i in range(300)] + [(1000 + i, "w w", "de", "src2") for i in range(20)]
    mix = Mix(("lang", "source"), {"lang": {"en": 1, "de": 1}}, budget_parts=160, epochs=4)
    docs = table(rows)
    found = mix_sources(docs, mix, files).collect()
    total = sum(len(r[1].split()) for r in rows)
    budget = total * 160 // 1000
    by_leaf = collections.defaultdict(list)
    for r in found:
        by_leaf[r.lang].append(r)
    for members in by_leaf.values():
        share = members[0].leaf_budget
        assert members[0].leaf_tokens == sum(m.n_tokens for m in members)
        taken = sum(m.n_tokens * m.taken for m in members)
        assert share <= taken < share + max(m.n_tokens for m in members)
        assert max(m.taken for m in members) - min(m.taken for m in members if m.n_tokens) <= 1
    assert sum(m[0].leaf_budget for m in by_leaf.values()) in (budget, budget - 1)
    again = take_mix(docs, mix, Files(spark, "tests"))
    assert again.schema == docs.schema
    assert Counter(r.doc_id for r in again.collect()) == Counter({r.doc_id: r.taken for r in found if r.taken})


def test_mix_edges(table, edge_rows, files):
    mix = Mix(("lang", "source"), budget_parts=1000, epochs=1)
    found = mix_sources(table(edge_rows), mix, files).collect()
    assert len(found) == len(edge_rows)
    # everything fits: each row with words once
    assert all(r.taken == 1 for r in found if r.n_tokens)
    assert mix_sources(table([]), mix, Files(files.spark, "tests")).collect() == []


# resharding


def cheapest(supply, room, cost):
    """All ways to send the units, one unit at a time, for tiny cases."""
    best = None
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    places = [j for j, n in enumerate(room) for _ in range(n)]
    for order in set(itertools.permutations(places)):
        price = sum(cost[i][j] for i, j in zip(units, order, strict=True))
        best = price if best is None else min(best, price)
    return best or 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_flow_is_cheapest(seed):
    rand = random.Random(seed)
    n, m, total = rand.randint(1, 3), rand.randint(1, 3), rand.randint(0, 6)
    supply, room = [0] * n, [0] * m
    for _ in range(total):
        supply[rand.randrange(n)] += 1
        room[rand.randrange(m)] += 1
    cost = [[rand.randint(0, 9) for _ in range(m)] for _ in range(n)]
    flow = minimum_cost_flow(supply, room, cost)
    assert [sum(row) for row in flow] == supply and [sum(col) for col in zip(*flow, strict=True)] == room
    assert sum(f * c for fs, cs in zip(flow, cost, strict=True) for f, c in zip(fs, cs, strict=True)) == cheapest(supply, room, cost)


def test_flow_needs_equal_sums():
    with pytest.raises(ValueError):
        minimum_cost_flow([1], [2], [[0]])


def test_blocks_move_only_the_excess():
    blocks = transfers([70, 10, 40], [30, 30, 30, 30], [700, 100, 4000])
    assert sum(b.rows for b in blocks if b.old != b.new) == 50
    assert sum(b.rows for b in blocks) == 120


def check_placed(rows, placed, shards):
    assert Counter(r.doc_id for r in placed) == Counter(d for d, *_ in rows)
    sizes = Counter(r.shard for r in placed)
    counts = [sizes[s] for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(counts[s]))


def test_reshard_edges(table, edge_rows, files):
    placed, blocks = reshard(table(edge_rows), F.lit(1), 3, 4, files)
    rows = placed.collect()
    check_placed(edge_rows, rows, 4)
    # the largest rows stay where they are
    stay = [r.size for r in rows if not r.moved]
    assert min(stay) >= sorted(r.size for r in rows)[-len(stay)] * 0.9
    assert {b.old for b in blocks} == {1}
    text = {d: t for d, t, *_ in edge_rows}
    for r in rows:
        if r.doc_id is not None:
            data = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    empty, none = reshard(table([]), F.lit(0), 2, 3, Files(files.spark, "tests"))
    assert empty.collect() == [] and none == []
    with pytest.raises(ValueError):
        reshard(table(edge_rows), F.lit(9), 3, 4, Files(files.spark, "tests"))


def test_reshard_query(spark):
    given_rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op6_reshard(spark, SF).collect()
    check_placed(given_rows, rows, 40)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert all(r.old_shard == zlib.crc32(str(r.doc_id).encode()) % 32 for r in rows)
    old = Counter(r.old_shard for r in rows)
    room = [5] * 40
    fewest = sum(max(0, old[s] - room[s]) for s in range(32))
    assert sum(r.moved for r in rows) == fewest


def test_reshard_query_rewrites_changed_shards(spark, monkeypatch, tmp_path):
    """The query's rows of changed shards are those of the files it has written, columns and all."""
    made = []

    class Noted(Files):
        def __init__(self, spark, label):
            super().__init__(spark, label)
            made.append(self.root)

    monkeypatch.setattr(resharding, "Files", Noted)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = op6_reshard(spark, SF).collect()
    written = spark.read.parquet(f"{made[0]}/shards").collect()
    changed = {n for r in rows if r.moved for n in (r.old_shard, r.shard)}
    assert {r.shard for r in written} == changed
    places = {(r.doc_id, r.shard, r.slot) for r in rows if r.shard in changed}
    assert len(written) == len(places) and {(r.doc_id, r.shard, r.slot) for r in written} == places
    given_rows = {r.doc_id: r for r in docs.collect()}
    assert all(getattr(r, c) == given_rows[r.doc_id][c] for r in written for c in docs.columns)


def test_fewest_bytes_move(spark):
    """The rows that leave a shard are its smallest, to the byte."""
    rand = random.Random(3)
    rows = [(i, "x" * rand.choice([rand.randint(900, 1100), rand.randint(0, 5000)]), i % 3) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    placed = reshard(docs, F.col("n"), 4, 5, Files(spark, "tests"))[0].collect()
    check_placed(rows, placed, 5)
    sizes = {s: sorted(r.size for r in placed if r.old_shard == s) for s in range(3)}
    assert sum(r.size for r in placed if r.moved) == sum(sum(own[: len(own) - 120]) for own in sizes.values())


def test_only_changed_shards_are_rewritten(spark, tmp_path, table):
    rows = [(i, f"text {i}") for i in range(30)]
    docs = table(rows)
    old = F.when(F.col("doc_id") < 10, 0).when(F.col("doc_id") < 24, 1).otherwise(2)
    placed, blocks = reshard(docs, old, 3, 3, Files(spark, "tests"))
    target = str(tmp_path / "shards")
    docs.withColumn("shard", old).write.partitionBy("shard").parquet(target)
    before = {p.name for p in (tmp_path / "shards" / "shard=0").iterdir()}
    assert rewrite_shards(docs, placed, blocks, target) == [1, 2]
    assert {p.name for p in (tmp_path / "shards" / "shard=0").iterdir()} == before
    now = {r.doc_id: r.shard for r in spark.read.parquet(target).collect()}
    assert now == {r.doc_id: r.shard for r in placed.collect()}


def test_rewritten_shards_hold_each_row_once(spark, tmp_path):
    """From 40 to 32 shards, with null and repeated doc_ids."""
    rows = [(None if i % 3 == 0 else i // 4, f"text {i % 5}", i) for i in range(400)]
    given_rows = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    old = F.pmod(F.col("n"), F.lit(40))
    target = str(tmp_path / "shards")
    given_rows.withColumn("shard", old).write.partitionBy("shard").parquet(target)
    docs = spark.read.parquet(target)
    placed, blocks = reshard(docs, F.col("shard"), 40, 32, Files(spark, "tests"))
    assert set(range(32, 40)) <= set(rewrite_shards(docs, placed, blocks, target))
    assert {p.name for p in (tmp_path / "shards").glob("shard=*")} == {f"shard={n}" for n in range(32)}
    now = spark.read.parquet(target).collect()
    assert Counter((r.doc_id, r.text, r.n) for r in now) == Counter(rows)
    assert {r.n: r.shard for r in now} == {r.row.n: r.shard for r in placed.collect()}


# pipeline


def test_pipeline_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given_rows = {r.doc_id: r for r in docs.collect()}
    files = Files(spark, "tests")
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = files.write(stage(spark, docs, SF), f"stage{number}")
        kept[name] = docs.collect()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r == given_rows[r.doc_id] for r in kept[name])
    good, exact, near, mixed, tokens = kept.values()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(r.doc_id in {g.doc_id for g in good}) == labels[r.doc_id] for r in given_rows.values() if r.doc_id in labels]
    assert sum(judged) >= 0.97 * len(judged)
    expected = {d for d, _, _, k, _ in brute.exact([(r.doc_id, r.text) for r in good]) if k}
    assert Counter(r.doc_id for r in exact) == Counter(expected)
    expected = {d for d, _, _, k in brute.near([(r.doc_id, r.text) for r in exact], 5) if k}
    assert Counter(r.doc_id for r in near) == Counter(expected)
    words = sum(len(r.text.split()) for r in near)
    assert 0.93 * words <= sum(len(r.text.split()) for r in mixed) <= words
    assert {r.doc_id for r in tokens} == {r.doc_id for r in mixed}
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(r.ids_sha256 for r in whole.collect()) == Counter(r.ids_sha256 for r in tokens)
