"""Bounded searches against exhaustive ones."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seisloom.operators import location, search


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + str(tmp_path / "checkpoints"))


@pytest.fixture(scope="module")
def tt(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tt"))
    depths, distances = (spark.range(0, n, 2).select(F.col("id").cast("double").alias(c)) for n, c in ((21, "depth_km"), (121, "distance_km")))
    location.build_tt(depths, distances).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


STATIONS = {"A": (10.0, 12.0), "B": (-14.0, 6.0), "C": (3.0, -16.0), "D": (-8.0, -9.0), "E": (15.0, -5.0), "F": (60.0, 40.0)}


def test_packed_times_are_the_joins(spark, tt):
    draw = np.random.default_rng(0)
    rows = [("PS"[int(draw.integers(2))], float(z), float(d)) for z, d in zip(draw.uniform(-3, 25, 400), draw.uniform(0, 130, 400), strict=True)] + [("P", 20.0, 120.0), ("P", 0.0, 0.0), ("X", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "phase string, depth_km double, distance_km double").withColumn("n", F.monotonically_increasing_id())
    want = {r.n: r.t for r in location.tt_lookup(df, tt, 2, 2).collect()}
    got = {r.n: r.t for r in search.with_times(df, search.PackedTimes.of(tt, 2, 2)).collect()}
    assert all((got[k] is None) == (t is None) and (t is None or abs(got[k] - t) < 1e-9) for k, t in want.items()) and len(got) == len(want) and None in want.values()


def test_a_table_beyond_the_bound_is_an_error(tt, monkeypatch):
    monkeypatch.setattr(search, "MOST_TIMES", 10)
    with pytest.raises(ValueError, match="more than 10"):
        search.PackedTimes.of(tt, 2, 2)


def _events(spark, tt, count):
    draw = np.random.default_rng(3)
    packed, rows = search.PackedTimes.of(tt, 2, 2), []
    for e in range(count):
        x, y, z = draw.uniform(-12, 12), draw.uniform(-12, 12), draw.uniform(1, 18)
        for s, (sx, sy) in STATIONS.items():
            for p in "PS":
                t = packed(packed.number([p]), np.array([z]), np.array([math.hypot(x - sx, y - sy)]))[0]
                noise = draw.normal(0, 0.05) if e % 3 else draw.uniform(-20, 20)  # a third fit nothing
                if t == t and (draw.random() < 0.8 or e == 0):
                    rows.append((e, s, p, sx, sy, float(50 + t + noise), 0.1 if p == "P" else 0.2))
    rows += [(count, "A", "P", *STATIONS["A"], 1.0, 0.1)] * 3  # too few
    return spark.createDataFrame(rows, "event_id long, station string, phase string, sx double, sy double, t_s double, sigma double").repartition(3)


def test_location_is_the_exhaustive_one(spark, tt):
    picks, passes = _events(spark, tt, 9), ((8.0, 4.0), (2.0, 2.0), (1.0, 1.0))
    centre, half = picks.groupBy("event_id").agg(F.avg("sx").alias("cx"), F.avg("sy").alias("cy")), 24.0
    for step, dz in passes:
        scored = location.score_nodes(picks, location.grid_nodes(centre, half, step, 0.0, 20.0, dz), tt, 2, 2)
        best = scored.groupBy("event_id").agg(F.min_by(F.struct("x", "y", "z", "t0", "chi2", "n"), F.struct("chi2", "z", "x", "y")).alias("b")).select("event_id", "b.*").checkpoint()
        centre, half = best.select("event_id", F.col("x").alias("cx"), F.col("y").alias("cy")), 2 * step
    want = {r.event_id: r for r in best.collect()}
    around = location.grid_nodes(best.select("event_id", F.col("x").alias("cx"), F.col("y").alias("cy")), 2.0, 0.5, 0.0, 20.0, 2)
    spread = {r.event_id: r for r in location.uncertainty(location.score_nodes(picks, around, tt, 2, 2)).collect()}
    got = {r.event_id: r for r in location.locate(picks, tt, 2, 2, 24.0, passes, spread=True).collect()}
    assert set(got) == set(want) == set(range(9))
    for e, r in got.items():
        assert all(abs(r[c] - want[e][c]) < 1e-6 * max(1, abs(want[e][c])) for c in ("x", "y", "z", "t0", "chi2", "n")), (r, want[e])
        assert all(abs(r[c] - spread[e][c]) < 1e-5 * max(1, abs(spread[e][c])) for c in ("sigma_z", "h_major", "h_minor", "h_azimuth"))


def test_scored_nodes_are_those_of_arrays(spark, tt):
    """Picks without a time count for no node, those beyond the table for none that is too far, and each event has its own nodes."""
    picks = _events(spark, tt, 3)
    none = picks.where("event_id = 0").limit(1).withColumn("t_s", F.lit(None).cast("double"))
    centre = spark.createDataFrame([(0, 2.0, 3.0), (1, 60.0, -50.0), (2, -4.0, 0.0), (9, 0.0, 0.0)], "event_id long, cx double, cy double")
    got = {(r.event_id, r.x, r.y, r.z): r for r in location.score_nodes(picks.unionByName(none), location.grid_nodes(centre, 40.0, 20.0, 0.0, 20.0, 10.0), tt, 2, 2).collect()}
    packed, want = search.PackedTimes.of(tt, 2, 2), 0
    for event, cx, cy in centre.where("event_id < 3").collect():
        rows = picks.where(f"event_id = {event}").toPandas()
        p = search.Picks(packed.number(rows["phase"]), *(rows[c].to_numpy(float) for c in ("sx", "sy", "t_s", "sigma")))
        nodes = search.grid(cx, cy, 40.0, 20.0, 20.0, 10.0)
        for node, t0, chi2, n in zip(nodes.tolist(), *search.scores(packed, p, nodes), strict=True):
            r = got.get((event, *node))
            assert (r is not None) == (n >= 4) and (r is None or (r.n == n and abs(r.t0 - t0) < 1e-9 and abs(r.chi2 - chi2) < 1e-6 * max(1, chi2)))
            want += n >= 4
    assert len(got) == want


def test_bounds_skip_nodes_and_change_nothing(spark, tt):
    packed = search.PackedTimes.of(tt, 2, 2)
    draw = np.random.default_rng(8)
    sx, sy = (np.array([STATIONS[s][k] for s in "ABCDE" for _ in "PS"]) for k in (0, 1))
    phase = packed.number(list("PS") * 5)
    fewer = 0
    for _ in range(5):
        x, y, z = draw.uniform(-9, 9), draw.uniform(-9, 9), draw.uniform(2, 15)
        t = packed(phase, np.full(10, z), np.hypot(x - sx, y - sy)) + draw.normal(0, 0.03, 10)
        p = search.Picks(phase, sx, sy, 7 + t, np.where(phase == 0, 0.1, 0.2))
        best, looked = search.best_node(packed, p, 0.0, 0.0, 24.0, 1.0, 20.0, 1.0, 4)
        nodes = search.grid(0.0, 0.0, 24.0, 1.0, 20.0, 1.0)
        _, chi2, n = search.scores(packed, p, nodes)
        chi2[n < 4] = np.inf
        assert best[4] == chi2.min() and tuple(best[:3]) in {tuple(n) for n in nodes[chi2 == chi2.min()]}
        fewer += looked < len(nodes) / 3
    assert fewer == 5


def test_least_node_of_a_table_with_gaps():
    """Picks of any times, a table with a hole and an end: the node is that of an exhaustive search."""
    draw = np.random.default_rng(1)
    d, z = np.arange(61) * 5.0, np.arange(5) * 5.0
    t = np.stack([np.hypot(d[None, :], z[:, None] + 0.5) / v + 0.01 * np.sin(d)[None, :] for v in (6.0, 3.4)])
    t[:, :, 57:] = np.nan
    t[1, 3, 20] = np.nan
    packed = search.PackedTimes(t, 5.0, 5.0, 0, 0)
    scored = 0
    for k in range(20):
        n = 50 if k % 4 else 12
        sx, sy, phase = draw.integers(-2, 3, n) * 20.0, draw.integers(-2, 3, n) * 20.0, draw.integers(0, 2, n) - (k % 5 == 1) * (np.arange(n) == 3)
        p = search.Picks(np.maximum(phase, -1), sx, sy, draw.uniform(0, 600, n), np.where(phase == 0, 0.05, 0.1))
        best, looked = search.best_node(packed, p, 3.0, 43.0, 16.0, 2.0, 20.0, 2.0, 4)
        nodes = search.grid(3.0, 43.0, 16.0, 2.0, 20.0, 2.0)
        t0, chi2, count = search.scores(packed, p, nodes)
        chi2[count < 4] = np.inf
        at = np.lexsort((nodes[:, 1], nodes[:, 0], nodes[:, 2], chi2))[0]
        assert best.tolist() == [*nodes[at], t0[at], chi2[at], count[at]]
        scored += looked
    assert scored < 20 * len(nodes) / 100


def test_events_together_are_those_one_by_one(monkeypatch):
    """Events of equally many picks share their sums, which skip the picks' own passes; those with picks that lack a time go one by one, and all are as alone."""
    draw = np.random.default_rng(4)
    d, z = np.arange(61) * 5.0, np.arange(5) * 5.0
    t = np.stack([np.hypot(d[None, :], z[:, None] + 0.5) / v + 0.01 * np.sin(d)[None, :] for v in (6.0, 3.4)])
    t[:, :, 57:] = np.nan
    t[:, 0, 1:] = np.nan  # at the surface there is a ray straight up only
    packed, n, many = search.PackedTimes(t, 5.0, 5.0, 0, 0), 12, 40
    sx, sy, phase = draw.integers(-2, 3, (many, n)) * 20.0, draw.integers(-2, 3, (many, n)) * 20.0, draw.integers(0, 2, (many, n))
    t_s = np.where(np.arange(many)[:, None] % 3, draw.uniform(0, 600, (many, n)), 40 + np.hypot(sx - 4, sy + 3) / 5)
    phase[5, 3], sx[7, 2], sx[8, 1] = -1, 290.0, 400.0
    p = search.Picks(phase, sx, sy, t_s, np.where(phase == 0, 0.05, 0.1))
    passes, alone, columns = ((8.0, 4.0), (2.0, 2.0), (0.5, 0.5)), [0], search.column_sums

    def sums(*a):
        alone[0] += 1
        return columns(*a)

    monkeypatch.setattr(search, "column_sums", sums)
    got = search.best_nodes(packed, p, 24.0, passes, 20.0, 4, True)
    assert 0 < alone[0] <= 4 * 4
    for k, r in enumerate(got):
        one, half = search.Picks(*(getattr(p, c)[k] for c in ("phase", "sx", "sy", "t_s", "sigma"))), 24.0
        x, y = one.sx.mean(), one.sy.mean()
        for step, dz in passes:
            best, _ = search.best_node(packed, one, x, y, half, step, 20.0, dz, 4)
            x, y, half = best[0], best[1], 2 * step
        spread = search.posterior(packed, one, x, y, 0.25, 20.0, 5.0, 4)
        assert r[:6] == best.tolist() and np.allclose(r[6:9], spread[:3], atol=1e-4, rtol=1e-5), k
    assert search.best_nodes(packed, p, 24.0, passes, 20.0, 13, True) == [None] * many


def _greedy_by_hand(picks, nodes, packed, rule):
    """Events one after another from all nodes and bins, counted anew each time."""
    times = [(i, s, p, t, packed(np.full(len(nodes), packed.number([p])[0]), nodes[:, 2], np.hypot(nodes[:, 0] - sx, nodes[:, 1] - sy))) for i, s, p, sx, sy, t in picks]
    free, out = {i for i, *_ in times}, {}
    place = {tuple(n): k for k, n in enumerate(sorted(map(tuple, nodes)))}
    while True:
        best = None
        votes = {}
        for i, s, p, t, table in times:
            if i in free:
                for k, d in enumerate(table):
                    if d == d:
                        for half in (0.0, 0.5):
                            votes.setdefault((k, half, math.floor((t - d) / rule.window + half)), []).append((i, s, p, t - d))
        for (k, _, _), members in votes.items():
            n_p = sum(p == "P" for _, _, p, _ in members)
            if len({s for _, s, _, _ in members}) >= rule.stations and n_p >= rule.p and len(members) - n_p >= rule.s:
                o = np.array([x for *_, x in members])
                rank = (-len(members), round(float(o.std()), 6), round(float(o.mean()), 6), place[tuple(nodes[k])])
                if best is None or rank < best[0]:
                    best = rank, members
        if best is None:
            return out
        ids = [i for i, *_ in best[1]]
        out.update(dict.fromkeys(ids, min(ids)))
        free -= set(ids)


@pytest.mark.parametrize(("blocks", "seed"), [(1, 0), (1, 1), (2, 2), (16, 3)])
def test_association_is_the_greedy_pass(spark, tt, blocks, seed):
    draw = np.random.default_rng(seed)
    packed, rule = search.PackedTimes.of(tt, 2, 2), search.Rule(1.5, 3, 2, 1)
    side = [-16.0, -8.0, 0.0, 8.0, 16.0]
    nodes = np.array([(x, y, z) for x in side for y in side for z in (2.0, 10.0)])
    picks = []
    for e in range(22):  # dense enough that events share picks, in a chain over many blocks
        x, y, z = draw.uniform(-16, 16), draw.uniform(-16, 16), draw.uniform(2, 10)
        for s, (sx, sy) in STATIONS.items():
            for p in "PS":
                if draw.random() < 0.8:
                    t = packed(packed.number([p]), np.array([z]), np.array([math.hypot(x - sx, y - sy)]))[0]
                    if t != t:
                        continue
                    picks.append((len(picks), s, p, sx, sy, round(float(100 + 4 * e + t + draw.normal(0, 0.2)), 3)))
    df = spark.createDataFrame([*picks, (10_000, "A", "P", 0.0, 0.0, None)], "pick_id long, station string, phase string, sx double, sy double, t_s double").repartition(3)
    out = search.associate(df, spark.createDataFrame(nodes.tolist(), "x double, y double, z double"), packed, rule, blocks).collect()
    want = _greedy_by_hand(picks, nodes, packed, rule)
    assert len(set(want.values())) > 8
    assert {r.pick_id: r.event for r in out} == want


def test_cells_without_votes_are_left_out(spark, tt):
    packed, rule = search.PackedTimes.of(tt, 2, 2), search.Rule(1.0, 3, 3, 1)
    nodes = search.grid(0.0, 0.0, 40.0, 2.0, 20.0, 4.0)
    cells = search.Cells(nodes, packed)
    keys = [(int(packed.number([p])[0]), *STATIONS[s]) for s in "ABCDE" for p in "PS"]
    t = np.array([packed(np.array([k]), np.array([8.0]), np.array([math.hypot(4 - x, 4 - y)]))[0] for k, x, y in keys])
    *_, looked = search.qualified_votes(cells, keys, np.repeat(np.arange(5), 2), np.tile([True, False], 5), t, rule)
    assert 0 < looked < len(nodes) / 2
    assert search.qualified_votes(cells, keys[:4], np.repeat(np.arange(2), 2), np.tile([True, False], 2), t[:4], rule)[-1] == 0


def test_settling_counts_only_what_lost_picks(monkeypatch):
    """A block of many events: what is counted in all is a few times the votes, not the votes times the events."""
    d, z = np.arange(61) * 5.0, np.arange(5) * 5.0
    packed = search.PackedTimes(np.stack([np.hypot(d[None, :], z[:, None] + 0.5) / v for v in (6.0, 3.4)]), 5.0, 5.0, 0, 0)
    cells = search.Cells(np.array([(x, y, 5.0) for x in (-20.0, 0.0, 20.0) for y in (-20.0, 0.0, 20.0)]), packed)
    draw, counted, count = np.random.default_rng(1), [0], np.bincount
    n = 300
    st = draw.integers(0, 9, n)
    picks = pd.DataFrame({"pick_id": np.arange(n), "station": [f"S{k}" for k in st], "phase": draw.choice(["P", "S"], n), "sx": (st % 3 - 1) * 19.0, "sy": (st // 3 - 1) * 22.0, "t_s": np.sort(draw.uniform(0, 900, n))})

    def bincount(x, *a, **b):
        counted[0] += len(x)
        return count(x, *a, **b)

    monkeypatch.setattr(np, "bincount", bincount)
    events, undecided = search.settle(cells, picks, -1e9, 1e9, search.Rule(30.0, 3, 2, 1))
    assert len(events) > 20 and not undecided
    assert counted[0] < 20 * n * 9 * 2
