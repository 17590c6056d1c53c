"""Contents compared, completed and located: fingerprints, moving pages, similar and interpolated addresses."""

from __future__ import annotations

import collections
import json
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayload.operators.compare import DifferentColumns, Tree, diff_versions, fingerprints, reconcile, surplus
from quayload.operators.enrich import KEY, prepare_lookup
from quayload.operators.segments import geocode_ranges, house_number
from quayload.operators.similar import geocode_similar, prefixes, run_counts, similar_pairs
from quayload.sources.paged import PageForm, extract_records_paged, land_paged, missing_stretches, number_rows
from quayload.sources.records import IncompletePages
from quayload.workspace import new_area

ORDERS = "/root/testdata/sf0.01/orders.parquet"


def bag(rows):
    return collections.Counter(map(repr, rows))


def test_fingerprints_do_not_depend_on_order_and_count_copies(spark):
    df = spark.range(500).select((F.col("id") % 4).alias("part"), "id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"))
    whole = sorted(map(tuple, fingerprints(df, "part").collect()))
    assert whole == sorted(map(tuple, fingerprints(df.repartition(7).orderBy(F.desc("s")), "part").collect()))
    assert whole != sorted(map(tuple, fingerprints(df.unionByName(df.limit(2)), "part").collect()))
    # a null is told from a null in the next column
    a = spark.createDataFrame([(0, None, "x"), (0, "y", None)], "part long, s string, t string")
    b = spark.createDataFrame([(0, "x", None), (0, None, "y")], "part long, s string, t string")
    assert fingerprints(a, "part").collect() != fingerprints(b, "part").collect()


def test_only_differing_nodes_are_entered():
    leaves = {i: (1, i * 7) for i in range(4097)}
    other = {**leaves, 5: (1, 36), 4096: (2, 0)}
    del other[77]
    mine, theirs = Tree(leaves, 4097), Tree(other, 4097)
    assert len(mine.levels) == 5
    assert mine.differing(theirs) == [5, 77, 4096] and mine.differing(Tree(leaves, 4097)) == []
    assert mine.rows == 4097 and theirs.rows == 4097 and theirs.leaf_rows(4096) == 2
    assert Tree({}, 1).differing(Tree({}, 1)) == []


def test_one_changed_value_is_found_with_its_range(spark):
    orders = spark.read.parquet(ORDERS)
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 7077, 1.0).otherwise(F.col("o_totalprice")))
    assert reconcile(orders, orders.repartition(5), "o_orderkey").equal
    found = reconcile(orders, changed, "o_orderkey", leaves=256)
    assert not found.equal and found.left_rows == found.right_rows == 15_000
    (piece,) = found.ranges
    assert piece.low <= 7077 < piece.high and piece.left_rows == piece.right_rows < 3 * 15_000 / 256
    rows = found.differences.collect()
    assert {(row.o_orderkey, row.side, row.times) for row in rows} == {(7077, "left", 1), (7077, "right", 1)}
    # the second read of each side is of that range only
    plan = found.differences._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(o_orderkey") >= 2
    scans = [m for m in re.findall(r"PushedFilters: \[([^\]]*)", plan)]
    assert len(scans) >= 2 and all("LessThanOrEqual(o_orderkey" in scan for scan in scans)


ODD = "k string, n decimal(10,2), t timestamp_ntz, d date, m map<string,int>, a array<struct<x:int,y:map<string,int>>>, f double"


def test_reconciling_odd_rows(spark):
    rows = [
        (None, None, None, None, None, None, None),
        ("", Decimal("1.50"), datetime(2020, 1, 1), date(2020, 1, 1), {"b": 1, "a": 2}, [(1, {"z": 1})], 0.0),
        ("é" * 50, Decimal("-1"), datetime(1, 1, 1), None, {}, [], float("nan")),
        ("x", None, None, None, {"a": None}, [None], None),
    ]
    left = spark.createDataFrame(rows * 30, ODD)
    right = spark.createDataFrame(rows * 30 + [rows[3], rows[0]], ODD)
    for key in ("k", "n", "t", "d", "f"):
        assert reconcile(left, left.orderBy(F.rand(3)), key).equal
        found = reconcile(left, right, key)
        assert found.right_rows - found.left_rows == 2
        assert sorted((r.k is None, r.side, r.times) for r in found.differences.collect()) == [(False, "right", 1), (True, "right", 1)]
    empty = left.limit(0)
    assert reconcile(empty, empty, "k").equal
    assert sum(r.times for r in reconcile(empty, right, "k").differences.collect()) == 122
    assert sum(r.times for r in reconcile(right, empty, "k").differences.collect()) == 122
    with pytest.raises(DifferentColumns, match="f"):
        reconcile(left, left.withColumn("f", F.col("f").cast("float")), "k")
    with pytest.raises(ValueError, match="unknown key"):
        reconcile(left, left, "nope")


def test_reconciling_with_given_bounds_and_a_hot_key(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(4)).otherwise(F.col("id")).alias("k"), "id")
    right = left.where("id <> 300").unionByName(spark.createDataFrame([(4, -1)], "k long, id long"))
    found = reconcile(left, right, "k", bounds=[100.0, 5000.0])
    assert [(r.low, r.high) for r in found.ranges] == [(None, 100.0)]
    assert {(r.id, r.side) for r in found.differences.collect()} == {(300, "left"), (-1, "right")}


def test_differences_of_versions(spark):
    old = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (4, "same"), (4, "same"), (5, None)]
    new = [(1, "a"), (1, "x"), (3, "d"), (3, "d"), (None, "f"), (4, "same"), (4, "same"), (6, "g"), (5, None)]
    a, b = (spark.createDataFrame(rows, "k int, v string") for rows in (old, new))
    plain = {(r.k, r.v, r.change, r.times) for r in diff_versions(a, b).collect()}
    gone, come = collections.Counter(old) - collections.Counter(new), collections.Counter(new) - collections.Counter(old)
    assert plain == {(*row, "removed", n) for row, n in gone.items()} | {(*row, "added", n) for row, n in come.items()}
    keyed = {(r.k, r.v, r.change, r.times) for r in diff_versions(a, b, ["K"]).collect()}
    assert keyed == {
        (1, "a", "changed_from", 1), (1, "b", "changed_from", 1), (1, "x", "changed_to", 1), (2, "c", "removed", 1),
        (3, "d", "added", 1), (None, "e", "changed_from", 1), (None, "f", "changed_to", 1), (6, "g", "added", 1),
    }
    assert diff_versions(a, a, ["k"]).collect() == [] and diff_versions(a.limit(0), a.limit(0)).collect() == []
    assert sum(r.times for r in diff_versions(a.limit(0), b).collect()) == len(new)


def test_equal_buckets_are_not_compared(spark, tmp_path):
    spark.range(20_000).withColumn("v", F.lit(1)).write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    new = old.withColumn("v", F.when(F.col("id") == 77, 2).otherwise(F.col("v")))
    found = diff_versions(old, new, ["id"], buckets=512)
    assert {(r.id, r.v, r.change) for r in found.collect()} == {(77, 1, "changed_from"), (77, 2, "changed_to")}
    filters = found._jdf.queryExecution().optimizedPlan().toString()
    assert filters.count("pmod(xxhash64") >= 2


def page(first, records, total, second, **more):
    stamp = datetime(2020, 1, 1) + timedelta(seconds=second)
    return {"offset": first, "total_records": total, "fetched_at": stamp.isoformat() + ".000000Z", "records": records, **more}


def land(folder, pages):
    folder.mkdir()
    for i, text in enumerate(pages):
        (folder / f"{i}.json").write_text(json.dumps(text))
    return str(folder)


RECORD = "id long, part string, v string"


def turns(*ids, v="a"):
    return [{"id": i, "part": "p", "v": v} for i in ids]


def read(spark, folder, form=PageForm()):
    schema = spark.createDataFrame([], RECORD).schema
    rows = extract_records_paged(spark, folder, schema, ["ID", "part"], form)
    assert rows.columns == ["id", "part", "v"]
    return sorted(((r.id, r.v) for r in rows.collect()), key=lambda row: (row[0] is None, row))


def test_the_newest_copy_of_a_moved_record(spark, tmp_path):
    # a record was put in front after the first page: 3 moved to the second page and changed
    pages = [page(0, turns(1, 2, 3), 5, 0), page(3, turns(3, v="b") + turns(4, 5), 6, 1), page(0, turns(0, 1, 2, v="c"), 6, 2)]
    assert read(spark, land(tmp_path / "a", pages)) == [(0, "c"), (1, "c"), (2, "c"), (3, "b"), (4, "a"), (5, "a")]
    # the same time: the larger place
    pages = [page(0, turns(1, 2), 3, 0), page(1, turns(2, v="z") + turns(3), 3, 0)]
    assert read(spark, land(tmp_path / "b", pages)) == [(1, "a"), (2, "z"), (3, "a")]
    # a page that landed twice, a last empty page, records without an id, one twice on a page
    odd = [{"id": None, "part": None, "v": "q"}, {"id": 7, "part": "p", "v": "old"}, {"id": 7, "part": "p", "v": "new"}]
    pages = [page(0, odd, 3, 0), page(0, odd, 3, 0), page(3, [], 2, 4)]
    assert read(spark, land(tmp_path / "c", pages)) == [(7, "new"), (None, "q")]
    assert read(spark, land(tmp_path / "d", [page(0, [], 0, 0)])) == []


def test_missing_pages_fail(spark, tmp_path):
    whole = [page(i * 2, turns(2 * i, 2 * i + 1), 12, i) for i in range(6)]
    assert len(read(spark, land(tmp_path / "whole", whole))) == 12
    for at, told in ((0, "0 to 1"), (2, "4 to 5"), (5, "10 to 11")):
        with pytest.raises(IncompletePages, match=f"{told} of 12"):
            read(spark, land(tmp_path / f"without{at}", whole[:at] + whole[at + 1 :]))
    # a record moved to a page that was fetched before: all places are there, but not all records
    moved = [page(0, turns(1, 2), 4, 0), page(2, turns(2, 3), 4, 1)]
    with pytest.raises(IncompletePages, match="3 different records of 4"):
        read(spark, land(tmp_path / "moved", moved))
    for i, wrong in enumerate(({"offset": None}, {"total_records": None}, {"fetched_at": None}, {"records": None}, {"records": [None]}, {"offset": -1})):
        with pytest.raises(Exception, match="a page lacks"):
            read(spark, land(tmp_path / f"wrong{i}", [{**whole[0], **wrong}, *whole[1:]]))
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="(?i)no pages|no such|unable"):
        read(spark, str(tmp_path / "empty"))


def test_numbered_pages(spark, tmp_path):
    form = PageForm(first="current_page", total="n", fetched="at", page_rows=3)
    pages = [{"current_page": i + 1, "n": 8, "at": f"2020-01-01T00:00:0{i}.000000Z", "records": turns(*range(3 * i, min(3 * i + 3, 8)))} for i in range(3)]
    assert [i for i, _ in read(spark, land(tmp_path / "a", pages), form)] == list(range(8))
    with pytest.raises(IncompletePages, match="3 to 5 of 8"):
        read(spark, land(tmp_path / "b", [pages[0], pages[2]]), form)


def test_gaps_across_slices(spark):
    cases = [
        ([(0, 10), (10, 25), (24, 40)], 40, []),
        ([(0, 40)], 40, []),
        ([(0, 3), (12, 40)], 40, [(3, 12)]),
        ([], 12, [(0, 12)]),
        ([(0, 5), (5, 5), (5, 9)], 12, [(9, 12)]),
        ([(2, 50)], 12, [(0, 2)]),
        ([(0, 30), (3, 4), (31, 40)], 41, [(30, 31), (40, 41)]),
        ([], 0, []),
    ]
    for stretches, total, expected in cases:
        df = spark.createDataFrame(stretches, "low long, high long")
        for size in (1, 7, 10, 1000):
            gaps = missing_stretches(df, total, size).collect()
            assert {p for g in gaps for p in range(g.low, g.high)} == {p for low, high in expected for p in range(low, high)}
            assert sum(g.high - g.low for g in gaps) == sum(high - low for low, high in expected)


def test_rows_are_numbered_in_order(spark, tmp_path):
    df = spark.range(1000, numPartitions=9).select((F.col("id") * 7919 % 1009).alias("v"))
    rows = number_rows(df, ["v"], "place", str(tmp_path / "n")).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(1000)) and [r.v for r in rows] == sorted(r.v for r in rows)


def test_landed_pages_overlap(spark, tmp_path):
    df = spark.range(100).select("id", F.col("id").alias("place"))
    for form, overlap in ((PageForm(), 4), (PageForm(page_rows=10), 0)):
        folder = str(tmp_path / f"p{overlap}")
        land_paged(df, folder, "place", 10, overlap, form)
        schema = df.select("id").schema
        assert sorted(r.id for r in extract_records_paged(spark, folder, schema, ["id"], form).collect()) == list(range(100))


def normal(text):
    return re.sub("[^A-Z0-9]+", " ", (text or "").upper()).strip() or None


def grams(key):
    padded = f" {key} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


def likeness(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


NAMES = ["MAIN", "MARKET", "MAPLE", "MAGNOLIA", "MONTGOMERY", "N 5TH", "S 5TH", "5TH", "A", "AA", "AAAA", "FRANKFORD"]


def test_similar_addresses_equal_all_pairs(spark):
    known = [f"{n} {name} {kind}" for n in (1, 12, 120) for name in NAMES for kind in ("ST", "AVE")]
    typos = [lambda s: s[:3] + s[4:], lambda s: s.replace("A", "E"), lambda s: s + "REET", lambda s: s[::-1], lambda s: s[:-2]]
    asked = sorted({t(k).strip() for i, k in enumerate(known) for t in typos[i % 2 :: 2]} - set(known)) + ["X"]
    a, b = (spark.createDataFrame([(normal(k),) for k in keys], f"{KEY} string").distinct() for keys in (asked, known))
    for percent in (30, 60, 85, 100):
        found = {r[0]: (r[1], r[2]) for r in similar_pairs(a, b, percent).collect()}
        expected = {}
        for key in map(normal, asked):
            best = min(((-likeness(key, k), k) for k in known), default=None)
            if -best[0] * 100 >= percent:
                expected[key] = (best[1], -best[0])
        assert found == expected
    plan = similar_pairs(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError, match="percent"):
        similar_pairs(a, b, 0)


def test_prefixes_are_rarest_first(spark):
    keys = spark.createDataFrame([("AB",), ("ABC",), ("ZAB",)], f"{KEY} string")
    rows = prefixes(keys, run_counts(keys), 60).collect()
    by_key = {r[KEY]: r.first for r in rows}
    assert by_key["ABC"] == ["ABC", "BC "] and by_key["AB"] == [" AB"]  # as rare as "AB "


@pytest.mark.parametrize("shuffled", [False, True])
def test_similar_addresses_are_located(spark, shuffled):
    reference = spark.createDataFrame([("1 Main St", 1, 1.0), ("1 Main Street", 2, 2.0), ("77 Long Lane", 3, None)], "address string, id long, lat double")
    lookup = prepare_lookup(reference, ["address"], ["lat"], "id", new_area(spark, "lookup"))
    asked = ["1 main st.", "1 Maine St", "1 Main Streeet", "77 Long Lne", "nowhere at all", None, "--"] * 3
    df = spark.createDataFrame(list(enumerate(asked)), "k long, `my address` string")
    options = {"broadcast_bytes": 0, "heavy_rows": 2} if shuffled else {}
    found = geocode_similar(df, lookup, ["my address"], ["lat", "matched_address", "similarity"], removed=["my address"], **options)
    assert found.columns == ["k", "lat", "matched_address", "similarity"]
    rows = {r.k: tuple(r)[1:] for r in found.collect()}
    assert len(rows) == len(asked)
    for i, text in enumerate(asked):
        key = normal(text)
        scores = {k: likeness(key, k) for k in ("1 MAIN ST", "1 MAIN STREET", "77 LONG LANE")} if key else {}
        best = min(scores, key=lambda k: (-scores[k], k), default=None)
        if best is None or scores[best] < 0.6:
            assert rows[i] == (None, None, None)
        else:
            assert rows[i] == ({"1 MAIN ST": 1.0, "1 MAIN STREET": 2.0}.get(best), best, scores[best])
    empty = geocode_similar(df.limit(0), lookup, ["my address"], ["lat"])
    assert empty.collect() == []
    nothing = prepare_lookup(reference.limit(0), ["address"], ["lat"], "id", new_area(spark, "lookup"))
    assert geocode_similar(df, nothing, ["my address"], ["lat"]).where("lat IS NOT NULL").count() == 0


def test_house_numbers(spark):
    texts = ["12", " 12A", "12-16", "0012", "A12", "", None, "9" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(house_number(F.col("t"))).collect()] == [12, 12, 12, 12, None, None, None, None]


SEGMENTS = (
    "street string, low long, high long, parity string, low_lat double, low_lon double, high_lat double, high_lon double, segment_id long"
)


def plain_place(segments, street, number):
    best = None
    for s, low, high, parity, *ends, segment in segments:
        if None in (s, low, high, *ends) or normal(s) != normal(street) or number is None or min(low, high) < 0:
            continue
        if low > high:
            low, high, ends = high, low, [*ends[2:], *ends[:2]]
        if not low <= number <= high or (parity == "odd" and number % 2 == 0) or (parity == "even" and number % 2):
            continue
        share = (number - low) / (high - low) if high > low else 0.0
        place = (segment is None, segment or 0, low, high, ends[0] + (ends[2] - ends[0]) * share, ends[1] + (ends[3] - ends[1]) * share)
        best = place if best is None else min(best, place)
    return (best[4], best[5], None if best[0] else best[1]) if best else (None, None, None)


@pytest.mark.parametrize("shuffled", [False, True])
def test_houses_are_put_on_their_segments(spark, shuffled):
    segments = [("Main St", i * 100, i * 100 + 98, ["even", "odd", None, "?"][i % 4], i, -i, i + 1.0, -i - 1.0, i) for i in range(30)]
    segments += [
        ("main  st.", 0, 10**12, "odd", 0.0, 0.0, 1.0, 1.0, 90),
        ("Main St", 555, 545, "odd", 5.0, 5.0, 6.0, 6.0, 2),
        ("Oak", 7, 7, None, 1.0, 2.0, 3.0, 4.0, None),
        ("Oak", 0, 20, "even", 1.0, 2.0, 3.0, 4.0, 5),
        (None, 0, 9, None, 1.0, 2.0, 3.0, 4.0, 6),
        ("Elm", 0, None, None, 1.0, 2.0, 3.0, 4.0, 7),
        ("Elm", -5, 5, None, 1.0, 2.0, 3.0, 4.0, 8),
    ]
    houses = [(str(n), "Main St") for n in [*range(0, 3100, 37), 551, 999_999_999_999]] + [("551B", "main st"), ("7", "Oak"), ("8-10", "OAK")]
    houses += [(None, "Oak"), ("8", None), ("x", "Oak"), ("3", "Elm"), ("3", "Nowhere")] + [("150", "MAIN ST")] * 200
    df = spark.createDataFrame([(i, *h) for i, h in enumerate(houses)], "k long, house string, `the road` string").repartition(5)
    table = spark.createDataFrame([(*s[:4], *map(float, s[4:8]), s[8]) for s in segments], SEGMENTS)
    options = {"broadcast_bytes": 0, "heavy_rows": 2} if shuffled else {}
    found = geocode_ranges(df, table, "house", ["the road"], removed=["house"], **options)
    assert found.columns == ["k", "the road", "lat", "lon", "segment"]
    rows = {r.k: (r.lat, r.lon, r.segment) for r in found.collect()}
    assert len(rows) == len(houses)
    for i, (house, road) in enumerate(houses):
        number = int(re.match(r"\d+", house).group()) if house and house[0].isdigit() else None
        expected = plain_place(segments, road, number)
        assert rows[i][2] == expected[2] and rows[i][:2] == pytest.approx(expected[:2]), (house, road)
    assert geocode_ranges(df, table.limit(0), "house", ["the road"]).where("lat IS NULL").count() == len(houses)
    assert geocode_ranges(df.limit(0), table, "house", ["the road"]).collect() == []


def test_a_hot_street_is_split_and_no_segment_under_many_bins(spark, tmp_path):
    from quayload.operators.segments import SegmentColumns, prepare_segments

    rows = [("Hot", i, i + 10 ** (i % 8), None, 0.0, 0.0, 1.0, 1.0, i) for i in range(2000)]
    entered = prepare_segments(spark.createDataFrame(rows, SEGMENTS), SegmentColumns(), str(tmp_path / "e"))
    assert entered.groupBy("segment").count().agg(F.max("count")).first()[0] <= 2
    assert entered.where("width = 5").groupBy("bin").count().count() > 60


def test_overlapping_segments_are_met_once_a_level(spark, tmp_path):
    """However many segments overlap, a node has one, so a house meets no more rows than there are levels."""
    from quayload.operators.segments import NODE, SegmentColumns, first_by_node, prepare_segments

    rows = [("Hot", i % 50, 1000 + i % 70, [None, "odd", "even"][i % 3], 0.0, 0.0, 1.0, 1.0, i) for i in range(3000)]
    entered = prepare_segments(spark.createDataFrame(rows, SEGMENTS), SegmentColumns(), str(tmp_path / "e"))
    nodes = first_by_node(entered, 3)
    assert nodes.count() == nodes.select(*NODE).distinct().count() <= 2 * sum(1100 >> level for level in range(11))
    whole = nodes.select("side", "level", "node", "first.*").collect()
    for row in whole:  # a node is inside its segment
        assert row.low <= row.node << row.level and ((row.node + 1) << row.level) - 1 <= row.high
    for number in (0, 1, 49, 50, 512, 999, 1000, 1035, 1069, 1070):
        met = [r.segment for r in whole if r.side == number % 2 and r.node == number >> r.level]
        on = [r[8] for r in rows if r[1] <= number <= r[2] and r[3] != ["odd", "even"][number % 2 == 1]]
        assert min(met, default=None) == min(on, default=None) and len(met) <= 12


def test_segments_alike_but_for_their_places(spark):
    """Ids that are null or come again: of places for the same numbers the least is taken, for each house anew."""
    segments = [("A", 0, 100, None, 1.0, 0.0, 9.0, 0.0, None), ("A", 0, 100, "even", 5.0, 0.0, 2.0, 0.0, None), ("A", 0, 100, "even", 5.0, -1.0, 2.0, 0.0, None)]
    segments += [("B", 7, 2**63 - 1, "odd", 1.0, 1.0, 2.0, 2.0, 3), ("B", 7, 2**63 - 1, "odd", 1.0, 0.5, 2.0, 2.0, 3), ("B", 2**63 - 1, 0, None, 1.0, 1.0, 0.0, 0.0, 4)]
    houses = [(str(n), s) for s in "AB" for n in (0, 1, 6, 7, 8, 50, 51, 99, 100, 101, 10**18 - 1)]
    found = geocode_ranges(spark.createDataFrame(houses, "house string, road string"), spark.createDataFrame(segments, SEGMENTS), "house", ["road"])
    rows = {(r.house, r.road): (r.lat, r.lon, r.segment) for r in found.collect()}
    for house, road in houses:
        expected = plain_place(segments, road, int(house))
        assert rows[house, road][2] == expected[2] and rows[house, road][:2] == pytest.approx(expected[:2]), (house, road)


def test_surplus_counts_each_row(spark):
    a = spark.createDataFrame([(1,)] * 5 + [(None,)] * 2, "v int")
    b = spark.createDataFrame([(1,)] * 2 + [(None,)] * 3, "v int")
    assert {(r.v, r.side, r.times) for r in surplus(a, b).collect()} == {(1, "left", 3), (None, "right", 1)}
