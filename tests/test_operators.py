"""Boundary cases of operators on tiny tables."""

import math
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisloom.functions import geo, scalars
from seisloom.operators import aggregates as agg
from seisloom.operators import arrays, filters, jobs, joins, location, timejoin, windows

S = 1_000_000


@pytest.fixture(autouse=True)
def _checkpoints(spark, tmp_path):
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + str(tmp_path / "checkpoints"))


def events(spark, rows, more=""):
    return spark.createDataFrame(rows, "event_id string, t_us long" + more)


def ids(df, column="event_id"):
    return sorted(r[column] for r in df.collect())


def test_same_origin_edges(spark):
    c = events(spark, [("a", 0), ("b", 10 * S), ("c", 20 * S + 1), ("d", None)])
    assert [(r.a, r.b) for r in joins.same_origin_pairs(c).collect()] == [("a", "b")]


def test_corroboration_edges(spark):
    schema = "pick_id long, network string, station string, phase string, t_us long"
    primary = spark.createDataFrame([(0, "N", "A", "P", 100 * S)], schema)
    rows = [(1, "N", "A", "P", 100 * S), (2, "N", "A", "P", 101 * S), (3, "N", "A", "P", 99 * S), (4, "N", "A", "P", 101 * S + 10_000),
            (5, "M", "A", "P", 100 * S), (6, "N", "B", "P", 100 * S), (7, "N", "A", "S", 100 * S)]
    assert ids(joins.corroborated(spark.createDataFrame(rows, schema), primary), "pick_id") == [1, 2, 3]


def test_separation_edges(spark):
    primary = events(spark, [("p", 0)])
    s = events(spark, [("a", 10 * S), ("b", -10 * S), ("c", 10_100_000), ("d", -10_100_000)])
    assert ids(joins.separated(s, primary)) == ["c", "d"]


def test_regional_lags(spark):
    r = spark.createDataFrame([("r1", 0, 3.0, 200.0), ("r2", 60 * S, 3.5, 210.0)], "id string, t_us long, mag double, distance_km double")
    c = events(spark, [("a", 4_900_000), ("b", 5 * S), ("c", 90 * S), ("d", 150_100_000), ("e", -10 * S), ("f", 70 * S)])
    out = {x.event_id: x.regional_id for x in joins.asof_regional(c, r).collect()}
    assert out == {"a": None, "b": "r1", "c": "r2", "d": None, "e": None, "f": "r2"}
    span = spark.createDataFrame([(0, 100 * S)], "start_us long, end_us long")
    out = {x.event_id: x.regional_id for x in joins.asof_regional(c, r, span).collect()}
    assert out["c"] == "r2" and out["b"] is None


def test_carry_over(spark):
    fresh = events(spark, [("ep1", 6 * S), ("ep2", S), ("po3", 0), ("ep4", 100 * S), ("ep5", 200_500_000)])
    old = events(spark, [("epX", 0), ("epY", 110 * S), ("epZ", 190 * S)])
    assert {(r.event_id, r.old_id) for r in joins.carry_over_ids(fresh, old).collect()} == {("ep2", "epX"), ("ep4", "epY")}


def test_one_to_one_is_the_greedy_pass(spark):
    draw = np.random.default_rng(1)
    pairs = [(int(a), int(b), int(g)) for a, b, g in zip(draw.integers(0, 40, 300), draw.integers(0, 40, 300), draw.integers(0, 9, 300), strict=True)]
    best = {}
    for a, b, g in pairs:
        best[a, b] = min(best.get((a, b), g), g)
    want, used_a, used_b = set(), set(), set()
    for g, a, b in sorted((g, a, b) for (a, b), g in best.items()):
        if a not in used_a and b not in used_b:
            want.add((a, b))
            used_a.add(a)
            used_b.add(b)
    df = spark.createDataFrame([(a, b, g) for (a, b), g in best.items()], "l long, r long, gap long")
    assert {(x.l, x.r) for x in timejoin.match_one_to_one(df, "l", "r", ["gap"]).collect()} == want


def test_one_to_one_in_blocks(spark, monkeypatch):
    """Random pairs over many blocks, and a chain of 2,000 links whose gaps grow, so that the last link decides all, in a few rounds."""
    draw = np.random.default_rng(6)
    times = {("l", i): int(t) for i, t in enumerate(draw.integers(0, 40_000, 300))} | {("r", i): int(t) for i, t in enumerate(draw.integers(0, 40_000, 300))}
    pairs = [(i, j, abs(times["l", i] - times["r", j]), times["l", i]) for i in range(300) for j in range(300) if abs(times["l", i] - times["r", j]) <= 400]
    pairs = [(a, b, g // 50, t) for a, b, g, t in pairs]  # ties
    at, links = 100_000, []
    for k in range(2000):  # left, right, left ...: each link a little wider than the one before, the widest last
        links.append(at)
        at += 3_000 - k
    n = 1000
    pairs += [(n + k // 2 + k % 2, n + k // 2, links[k + 1] - links[k], links[k + k % 2]) for k in range(1999)]
    want, used = set(), set()
    for g, a, b in sorted((g, a, b) for a, b, g, _ in pairs):
        if ("l", a) not in used and ("r", b) not in used:
            want.add((a, b))
            used |= {("l", a), ("r", b)}
    rounds, decide = [], timejoin._match_block
    monkeypatch.setattr(timejoin, "_match_block", lambda *x: rounds.append(1) or decide(*x))
    df = spark.createDataFrame(pairs, "l long, r long, gap long, t long").repartition(3)
    assert {(x.l, x.r) for x in timejoin.match_one_to_one(df, "l", "r", ["gap"], "t", 3_000).collect()} == want
    assert len(rounds) < 10 and len(want) > 1100


def test_components(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(20, 40)] + [(1, 2)], "a long, b long")
    assert {(r.node, r.root) for r in timejoin.components(df, "a", "b").collect()} == {(i, 20) for i in range(20, 41)} | {(1, 1), (2, 1)}


def test_restore_reviewed(spark):
    more = ", review_status string, magnitude double"
    cat = events(spark, [("ep1", 0, None, 1.0), ("ep9", 1000 * S, None, 2.0), ("ep3", 5000 * S, None, 3.0), ("ep4", 9000 * S, "rejected", 3.0)], more)
    snap = events(spark, [("ep1", 2 * S, "confirmed", 1.5), ("ep2", 1003 * S, "confirmed", 2.5), ("ep3", 7000 * S, "confirmed", 9.0), ("ep7", 9001 * S, "confirmed", 4.0)], more)
    picks = "event_id string, station string"
    asg = spark.createDataFrame([("ep1", "old"), ("ep9", "old"), ("ep3", "own")], picks)
    kept = spark.createDataFrame([("ep1", "new"), ("ep2", "new"), ("ep3", "moved")], picks)
    rows, out = joins.restore_reviewed(cat, asg, snap, kept)
    assert {(r.event_id, r.magnitude) for r in rows.collect()} == {("ep1", 1.5), ("ep2", 2.5), ("ep3", 3.0), ("ep3-2", 9.0), ("ep4", 3.0), ("ep7", 4.0)}
    assert {(r.event_id, r.station) for r in out.collect()} == {("ep1", "new"), ("ep2", "new"), ("ep3", "own"), ("ep3-2", "moved")}


def test_mint_ids(spark):
    rows = spark.createDataFrame([(datetime(2025, 11, 28, 18, 58, 4, u),) for u in (646000, 700000)], "time timestamp").withColumn("t_us", F.unix_micros("time"))
    assert ids(windows.mint_ids(rows, "ep", ["t_us"])) == ["ep20251128T185804", "ep20251128T185804-2"]
    taken = spark.createDataFrame([("ep20251128T185804",), ("ep20251128T185804-3",)], "event_id string")
    assert ids(windows.mint_ids(rows, "ep", ["t_us"], taken)) == ["ep20251128T185804-2", "ep20251128T185804-4"]


def test_free_numbers(spark):
    draw = np.random.default_rng(4)
    used = [(f"k{draw.integers(4)}", int(n)) for n in draw.integers(1, 30, 60)] + [("k9", 1)]
    rows = [(f"k{draw.integers(5)}", i) for i in range(80)]
    want, taken = {}, set(used)
    for key, i in rows:
        n = 1
        while (key, n) in taken:
            n += 1
        taken.add((key, n))
        want[i] = n
    df = windows.free_numbers(spark.createDataFrame(rows, "key string, i long"), "key", ["i"], spark.createDataFrame(used, "key string, n long"), "n")
    assert {r.i: r.n for r in df.collect()} == want


def test_restored_ids_are_free_and_unlike(spark):
    """Two positional orphans of a day, and an id whose first suffix is taken."""
    more = ", review_status string"
    cat = events(spark, [("ep20260608-0001", 0, None), ("ep20260608-0004", 100 * S, None), ("ep1", 200 * S, None), ("ep1-2", 300 * S, None), ("ep1-4", 400 * S, None)], more)
    snap = events(spark, [("ep20260608-0001", 5000 * S, "confirmed"), ("ep20260608-0004", 6000 * S, "confirmed"), ("ep1", 7000 * S, "confirmed")], more)
    none = spark.createDataFrame([], "event_id string, station string")
    rows, _ = joins.restore_reviewed(cat, none, snap, none)
    assert {r.event_id for r in rows.where("review_status is not null").collect()} == {"ep20260608-0005", "ep20260608-0006", "ep1-3"}
    assert rows.count() == 8


def test_null_keys_are_thinned_alike(spark):
    rows = [(k, t, 1.0) for k in (None, "A") for t in (625, 635, 644)]
    df = spark.createDataFrame([*rows, ("A", None, 1.0)], "station string, t long, v double")
    out = windows.greedy_apart(df, ["station"], "t", [-F.col("v"), F.col("t")], 10)
    assert sorted((r.station or "", r.t) for r in out.collect()) == [("", 625), ("", 644), ("A", 625), ("A", 644)]
    # a chain that takes several rounds: blocks of 640, each row a better one than the last
    rise = [(k, 9 * i, float(i)) for k in (None, "A") for i in range(300)]
    out = windows.greedy_apart(spark.createDataFrame(rise, "station string, t long, v double"), ["station"], "t", [-F.col("v")], 10).collect()
    want = sorted(9 * i for i in range(299, -1, -2))
    assert sorted(r.t for r in out if r.station is None) == want == sorted(r.t for r in out if r.station == "A")


def test_order_statistics(spark):
    from seisloom.operators.aggregates import order_statistic

    draw = np.random.default_rng(2)
    some = [*draw.lognormal(0, 30, 500).tolist(), *[3.25] * 200, *(-draw.lognormal(0, 30, 300)).tolist(), 0.0, -0.0, 5e-324, -1.7e308, 1.7e308, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in some], "x double").repartition(4)
    want = sorted(v for v in some if v is not None and v == v)
    for rank in (0, 1, 2, 300, 301, 302, 400, len(want) // 2, len(want) - 2, len(want) - 1):
        assert order_statistic(df, "x", rank) == want[rank]
    assert math.isnan(order_statistic(df, "x", len(want))) and order_statistic(df, "x", len(want) + 1) is None and order_statistic(df.where("false"), "x", 0) is None
    many = spark.range(300_000).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).cast("double").alias("x")).checkpoint()
    values = sorted(r.x for r in many.collect())
    assert order_statistic(many, "x", 150_000) == values[150_000]


def test_peaks_and_thinning(spark):
    v = [0, 5, 0, 3, 3, 1, float("nan"), 9, 1, 2]
    df = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate(v)], "k string, i long, v double")
    assert ids(windows.local_peaks(df, "k", "i", "v", 1), "i") == [1, 3]
    p = spark.createDataFrame([("a", 0, 1.0), ("a", 100, 2.0), ("a", 250, 1.0), ("a", 340, 3.0), ("a", 430, 2.0), ("b", 50, 1.0)], "k string, i long, v double")
    assert [(r.k, r.i) for r in windows.thin_peaks(p, ["k"], "i", "v", 100).orderBy("k", "i").collect()] == [("a", 100), ("a", 340), ("b", 50)]


def test_guard_runs_and_anchors(spark):
    df = spark.createDataFrame([("a", i, not 20 <= i < 25, 0.0 if 20 <= i < 25 or 30 <= i < 32 else 1.0) for i in range(50)], "k string, i long, ok boolean, v double")
    assert ids(windows.gap_guard(df, "k", "i", "ok", 3).where("not guarded"), "i") == list(range(17, 28))
    assert [(r["first"], r["last"]) for r in windows.zero_runs(df, "k", "i", "v", 3).collect()] == [(20, 24)]
    t = spark.createDataFrame([(i, x) for i, x in enumerate([0, 4, 8, 12, 30, 86_399_999_998, 86_400_000_001, 86_400_000_004])], "id long, t long")
    out = {r.t: r.anchor for r in windows.anchored_clusters(t, "t", 5).collect()}
    assert out == {0: 0, 4: 0, 8: 8, 12: 8, 30: 30, 86_399_999_998: 86_399_999_998, 86_400_000_001: 86_399_999_998, 86_400_000_004: 86_400_000_004}


def test_magnitudes(spark):
    df = spark.createDataFrame([(1e-6, 50.0), (0.0, 50.0), (1e-6, 9.0), (float("nan"), 50.0), (None, 50.0)], "a double, r double")
    out = [r.m for r in df.select(geo.ml_station(F.col("a"), F.col("r")).alias("m")).collect()]
    want = math.log10(1e-6 * 2800e3 / (2 * math.pi * 5)) + 1.110 * math.log10(0.5) + 0.00189 * -50 + 3
    assert abs(out[0] - want) < 1e-9 and out[1:] == [None] * 4


def test_coverage_and_chunks(spark):
    got = spark.createDataFrame([("s", "EHZ", 360_000), ("s", "EHN", 400_000), ("t", "EHZ", 180_000)], "station string, channel string, n long")
    due = spark.createDataFrame([(s, c, 360_000.0) for s in "st" for c in ("EHZ", "EHN")], "station string, channel string, want double")
    assert {r.station: r.coverage for r in agg.chunk_coverage(got, due, ["station"]).collect()} == {"s": 1.0, "t": 0.25}
    rows = [(None, None, True, True), ("failed", None, True, True), ("success", 1.0, True, False), ("success", 0.5, True, True), ("success", 0.5, False, False), ("success", None, True, False), ("no_data", 0.0, True, True)]
    df = spark.createDataFrame([r[:3] for r in rows], "s string, c double, w boolean")
    out = df.select(scalars.needs_fetch(F.col("s"), F.col("c"), F.col("w"), F.lit(False)).alias("x")).collect()
    assert [r.x for r in out] == [r[3] for r in rows]
    df = spark.createDataFrame([("success", 0.3, 0.3005, False), ("success", 0.3, 0.9, True), (None, None, 0.0, True), ("success", None, 1.0, False)], "s string, o double, c double, want boolean")
    assert all(r.x == r.want for r in df.select("want", scalars.improved(F.col("s"), F.col("o"), F.col("c")).alias("x")).collect())


def test_triage_rules(spark):
    rows = [(2.5, 4, 4, 4, "auto_reject"), (1.3, 4, 4, 4, "flag"), (1.3, 5, 5, 4, "ok"), (1.0, 6, 5, 0, "ok"), (1.0, 6, 4, 1, "auto_reject"), (None, 5, 5, 2, "ok")]
    df = spark.createDataFrame(rows, "m double, p long, s long, c long, want string")
    label, why = scalars.triage(F.col("m"), F.col("p"), F.col("s"), F.col("c"), F.lit(None).cast("string"))
    out = df.select("want", label.alias("label"), why.alias("why")).collect()
    assert all(r.want == r.label for r in out) and out[0].why == "M2.5 from 4 picks"


def test_browse_nulls_and_pages(spark):
    c = events(spark, [("a", 1), ("b", None), ("c", 3)])
    assert [r.event_id for r in filters.browse(c, "t_us", "asc").collect()] == ["a", "c", "b"]
    out = filters.browse(c, "t_us", "desc", 1, 2).collect()
    assert [r.event_id for r in out] == ["b", "c"] and out[0].total == 3 and out[0].total_pages == 2
    assert filters.browse(c, "t_us", "desc", 1, 0).count() == 3


def test_second_detector(spark):
    pick = "event_id string, network string, station string, phase string, t_us long"
    mine = spark.createDataFrame([("po1", "N", s, "P", 100 * S) for s in "ABC"] + [("po2", "N", s, "P", 500 * S) for s in "AB"], pick)
    theirs = spark.createDataFrame([("ep1", "N", s, "P", 100 * S + 500_000) for s in "ABC"] + [("ep2", "N", s, "P", 500 * S) for s in "AB"], pick)
    kept, picks = jobs.select_additions(events(spark, [("po1", 90 * S), ("po2", 490 * S)]), mine, events(spark, [("ep1", 0)]), theirs)
    assert ids(kept) == ["po1"] and picks.count() == 3


def test_signal_operators(spark):
    t = np.arange(2000) / 100
    x = np.sin(2 * np.pi * 1 * t) + np.sin(2 * np.pi * 10 * t)
    y = arrays.band_filter(x, 100, 5, 20)
    assert abs(np.std(y[300:-300]) - 1 / np.sqrt(2)) < 0.05
    df = spark.createDataFrame([("k", 0, 100.0, x.tolist())], "key string, start_us long, rate double, samples array<double>")
    out = arrays.decimate(df, ["key"], 50.0).first()
    assert len(out.samples) == 1000 and out.rate == 50.0
    seg = spark.createDataFrame([("k", 0, 1.0, [1.0, 2.0, 9.0, 3.0, 4.0])], df.schema)
    parts = [(r.start_us, r.samples) for r in arrays.mask_impossible(seg, 8).orderBy("start_us").collect()]
    assert parts == [(0, [1.0, 2.0]), (3 * S, [3.0, 4.0])]
    day = 86_400 * S
    seg = spark.createDataFrame([("k", day - 2 * S, 1.0, [1.0, 2.0, 3.0])], df.schema)
    assert [(r.start_us, r.samples) for r in arrays.split_by_day(seg).orderBy("start_us").collect()] == [(day - 2 * S, [1.0, 2.0]), (day, [3.0])]
    tem = spark.createDataFrame([("t1", "Z", 0, x[500:560].tolist())], "template_id string, channel string, offset int, samples array<double>")
    noise = np.random.default_rng(0).normal(size=1000) * 0.1
    noise[700:760] += x[500:560]
    cont = spark.createDataFrame([("c", "Z", noise.tolist())], "chunk string, channel string, samples array<double>")
    best = arrays.match_templates(cont, tem, 4.0).orderBy(F.desc("cc")).first()
    assert best.idx == 700 and best.cc > 0.95


def test_travel_times_and_location(spark):
    half = ((0.0, 6.0, 3.5),)
    depths = spark.createDataFrame([(float(z),) for z in np.arange(0, 20.5, 2)], "depth_km double")
    dist = spark.createDataFrame([(float(x),) for x in np.arange(0, 81, 2)], "distance_km double")
    tt = location.build_tt(depths, dist, layers=half).checkpoint()
    for r in tt.where("t is not null and depth_km > 0 and distance_km < 60").collect():
        v = 6.0 if r.phase == "P" else 3.5
        assert abs(r.t - math.hypot(r.depth_km, r.distance_km) / v) < 0.05
    stations = [("A", 10.0, 12.0), ("B", -14.0, 6.0), ("C", 3.0, -16.0), ("D", -8.0, -9.0), ("E", 15.0, -5.0)]
    src = (2.0, -4.0, 6.0, 100.0)
    rows = []
    for name, x, y in stations:
        d = math.sqrt((x - src[0]) ** 2 + (y - src[1]) ** 2 + src[2] ** 2)
        rows += [("e", name, p, x, y, src[3] + d / v, 0.1) for p, v in (("P", 6.0), ("S", 3.5))]
    picks = spark.createDataFrame(rows, "event_id string, station string, phase string, sx double, sy double, t_s double, sigma double")
    best = location.locate(picks, tt, 2.0, 2.0, 24.0).first()
    assert math.hypot(best.x - src[0], best.y - src[1]) <= 1.0 and abs(best.z - src[2]) <= 1.5 and abs(best.t0 - src[3]) < 0.2


def test_days_and_times(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), datetime(2024, 1, 3))], "a timestamp, b timestamp")
    assert [r.day for r in filters.days_between(df, "a", "b").collect()] == [date(2024, 1, 1), date(2024, 1, 2)]
    t = spark.createDataFrame([("2024-01-01T00:00:00",), ("2024-01-01T00:00:00Z",), ("2024-01-01T01:00:00+01:00",), ("bad",)], "t string")
    out = [r.u for r in t.select(scalars.micros(scalars.parse_utc(F.col("t"))).alias("u")).collect()]
    assert out == [1704067200 * S] * 3 + [None]


def greedy_by_hand(rows, least):
    """Highest first, then earliest; none within ``least`` of a taken one."""
    kept = []
    for at, height in sorted(set(rows), key=lambda r: (-r[1], r[0])):
        if all(abs(at - x) > least for x, _ in kept):
            kept.append((at, height))
    return sorted(kept)


def test_peaks_of_chains_longer_than_blocks(spark):
    import random

    draw = random.Random(2)
    series = {
        "random": [(draw.randrange(6000), float(draw.randrange(50))) for _ in range(1500)],
        "falling": [(i * 3, float(5000 - i)) for i in range(1500)],  # every decision waits for the one before
        "rising": [(i * 3, float(i)) for i in range(1500)],
        "equal": [(i, 1.0) for i in range(0, 3000, 2)],
        "copies": [(5, 1.0)] * 40,
    }
    df = spark.createDataFrame([(k, a, h) for k, rows in series.items() for a, h in rows], "k string, i long, v double")
    out = windows.thin_peaks(df, ["k"], "i", "v", 5).collect()
    for k, rows in series.items():
        assert sorted((r.i, r.v) for r in out if r.k == k) == greedy_by_hand(rows, 5), k


def test_anchors_of_sessions_longer_than_blocks(spark):
    import random

    draw = random.Random(6)
    times = sorted({draw.randrange(40_000) for _ in range(9000)} | {90_000 + 7 * i for i in range(400)} | {200_000, 200_005, 200_006})
    want, anchor = {}, None
    for t in times:
        if anchor is None or t - anchor > 10:
            anchor = t
        want[t] = anchor
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times + times[::3])], "t long, id int")
    for span in (3, 256):
        out = windows.anchored_clusters(df, "t", 10, span)
        assert out.columns == ["t", "id", "anchor"] and out.count() == df.count()
        assert {r.t: r.anchor for r in out.collect()} == want


def test_windows_skipped_by_start_and_end(spark):
    import random

    draw = random.Random(4)
    rows = [("k", i, a, a + 1000 + draw.randrange(0, 120)) for i, a in enumerate(draw.randrange(30_000) for _ in range(600))]
    df = spark.createDataFrame(rows, "key string, file int, start_us long, end_us long")
    kept = []
    for r in rows:
        if all(abs(r[2] - x[2]) >= 50 or abs(r[3] - x[3]) >= 50 for x in kept):
            kept.append(r)
    assert sorted(map(tuple, windows.skip_dup_windows(df, ["key"], "file", 50).select(*df.columns).collect())) == sorted(kept)


def test_times_are_utc_in_any_session(spark):
    from seisloom.functions import scalars

    texts = ["2024-01-02T03:04:05", "2024-01-02T03:04:05Z", "2024-01-01 20:04:05-07:00", "2024-01-02", "2024-01-02T03:04:05.250", "never", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Denver"):
            spark.conf.set("spark.sql.session.timeZone", z)
            out = df.select("i", F.unix_micros(scalars.parse_utc(F.col("t"))).alias("us"), scalars.event_id_base(scalars.parse_utc(F.col("t")), F.lit("ep")).alias("id")).orderBy("i").collect()
            assert [r.us for r in out] == [1704164645000000, 1704164645000000, 1704164645000000, 1704153600000000, 1704164645250000, None, None]
            assert out[0].id == "ep20240102T030405"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_closest_one_to_one_makes_no_pairs(spark, monkeypatch):
    """Copies of the same times, and dense ones, matched as by the pass over all pairs."""
    import numpy as np

    draw = np.random.default_rng(2)
    times = [sorted(int(t) for t in draw.integers(0, 40_000, 60)) for _ in range(2)]
    left = [(f"a{c}{i:03d}", times[0][i], "x") for c in range(4) for i in range(60)] + [("y1", 5, "y"), ("y2", None, "x")]
    right = [(f"b{c}{i:03d}", times[1][i], "x") for c in range(4) for i in range(60)] + [("z1", 900, "y")]
    pairs = sorted((abs(t - u), a, b) for a, t, k in left for b, u, m in right if k == m and t is not None and abs(t - u) <= 3000)
    want, used = set(), set()
    for gap, a, b in pairs:
        if a not in used and b not in used:
            want.add((a, b, gap))
            used |= {a, b}
    monkeypatch.setattr(timejoin, "SPAN", 4)
    monkeypatch.setattr(timejoin, "range_join", None)
    a, b = (spark.createDataFrame(rows, f"{n} string, {n}_us long, k string") for n, rows in (("l", left), ("r", right)))
    got = timejoin.closest_one_to_one(a, b, "l", "r", "l_us", "r_us", 3000, ["k"]).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 150


def test_regional_events_are_found_without_pairs(spark, monkeypatch):
    """The latest one in reach, of equal times the greatest id; no pair is made that is dropped."""
    monkeypatch.setattr(joins, "range_join", None)
    r = spark.createDataFrame([(f"r{i}", (i // 2) * S, 3.0, 200.0) for i in range(200)] + [("none", None, 3.0, 1.0)], "id string, t_us long, mag double, distance_km double")
    c = events(spark, [(f"e{i}", i * S // 2) for i in range(-4, 400)])
    out = {x.event_id: x.regional_id for x in joins.asof_regional(c, r).collect()}
    assert out == {f"e{i}": None if i < 10 or i > 378 else f"r{max(x for x in range(200) if x // 2 == min((i - 10) // 2, 99)):d}" for i in range(-4, 400)}
