"""Signals in chunks against the same signals whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisloom.operators import arrays, continuous

S = 1_000_000


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + str(tmp_path / "checkpoints"))


def cut(x, sizes, start, rate):
    at, out = 0, []
    for n in sizes:
        out.append((start + round(at * 1e6 / rate), rate, x[at : at + n].tolist()))
        at += n
    return out


SEG = "key string, start_us long, rate double, samples array<double>"


@pytest.mark.parametrize(("low", "high", "both"), [(0.5, None, False), (2.0, 20.0, True), (None, 10.0, True)])
def test_filter_by_chunks_is_that_of_the_whole(spark, low, high, both):
    draw = np.random.default_rng(0)
    long, other, slow = draw.normal(5, 1, 3000), draw.normal(-3, 2, 700), draw.normal(0, 1, 400)
    rows = [("a", *r) for r in cut(long, [1, 2, 700, 297, 1000, 1, 999], 7 * S, 100.0)]
    rows += [("a", *r) for r in cut(other, [300, 400], 100 * S, 100.0)]  # after a gap: a stretch of its own
    rows += [(None, *r) for r in cut(slow, [150, 250], 0, 50.0)]
    out = continuous.filter_continuous(spark.createDataFrame(rows, SEG).repartition(4), ["key"], low, high, both).collect()
    got = {}
    for r in sorted(out, key=lambda r: r.start_us):
        got.setdefault((r.key, r.start_us >= 100 * S), []).extend(r.samples)
    for key, x, rate in ((("a", False), long, 100.0), (("a", True), other, 100.0), ((None, False), slow, 50.0)):
        want = arrays.band_filter(x, rate, low, high, zero_phase=both)
        assert np.abs(np.array(got[key]) - want).max() < 1e-9
    assert len(out) == len(rows)


def test_state_after_a_chunk():
    draw = np.random.default_rng(1)
    sections = arrays.butterworth(4, 3.0, 100.0, "high")
    x = draw.normal(size=500)
    whole, end = continuous.run_from(sections, x, np.zeros(4))
    for n in (1, 2, 250, 499):
        head, state = continuous.run_from(sections, x[:n], np.zeros(4))
        tail, last = continuous.run_from(sections, x[n:], state)
        assert np.allclose(np.concatenate([head, tail]), whole, atol=1e-12) and np.allclose(last, end, atol=1e-12)
        quiet, _ = continuous.run_from(sections, x[n:], np.zeros(4))
        assert np.allclose(np.linalg.matrix_power(continuous.system(sections), 500 - n) @ state + continuous.run_from(sections, x[n:], np.zeros(4))[1], end, atol=1e-9)


def test_padded_chunks_and_back(spark):
    rate, x = 10.0, np.arange(1.0, 401.0)
    rows = [("k", *r) for r in cut(x[:150], [70, 80], 0, rate)] + [("k", 20 * S, rate, x[200:].tolist()), ("q", 0, rate, [1.0, None, float("nan"), 2.0])]
    chunks = spark.createDataFrame([(c * 10 * S, (c + 1) * 10 * S) for c in range(4)], "start_us long, end_us long")
    padded = continuous.padded_chunks(spark.createDataFrame(rows, SEG), chunks, ["key"], rate, 3 * S).checkpoint()
    got = {(r.key, r.start_us // S): r for r in padded.collect()}
    assert set(got) == {("k", 0), ("k", 10), ("k", 20), ("k", 30), ("q", 0)}
    whole = np.concatenate([np.zeros(30), x[:150], np.zeros(50), x[200:], np.zeros(30)])
    for c in range(4):
        r = got["k", 10 * c]
        assert r.first_us == (10 * c - 3) * S and np.array_equal(r.samples, whole[100 * c : 100 * c + 160])
        assert [bool(v) for v in r.valid] == (whole[100 * c : 100 * c + 160] != 0).tolist()
    q = got["q", 0]
    assert q.samples[30:34] == [1.0, 0.0, 0.0, 2.0] and q.valid[30:34] == [True, False, False, True] and len(q.samples) == 160
    back = {(r.key, r.start_us // S): r.samples for r in continuous.trimmed(padded, rate).collect()}
    assert np.array_equal(np.concatenate([back["k", 10 * c] for c in range(4)]), whole[30:430])


def _by_hand(x, templates, threshold):
    """Detections of whole-day channels, window after window."""
    out = {}
    n = max(map(len, x.values()))
    for name, rows in templates.items():
        total, count = np.zeros(n), np.zeros(n, int)
        for channel, offset, w in rows:
            v, m = x.get(channel, np.zeros(0)), len(w)
            for i in range(len(v) - m + 1):
                if 0 <= i - offset < n:
                    a = v[i : i + m]
                    total[i - offset] += ((a - a.mean()) * (w - w.mean())).sum() / (m * w.std() * max(a.std(), 1e-12))
                    count[i - offset] += 1
        mad = float(np.median(np.abs(total[count > 0])))
        for i in np.flatnonzero((count > 0) & (total >= threshold * mad)):
            out[name, int(i)] = (round(float(total[i]), 6), int(count[i]), round(mad, 9))
    return out


@pytest.mark.parametrize("sizes", [[1200], [400, 400, 400], [37, 500, 263, 400]])
def test_matching_does_not_depend_on_chunks(spark, sizes):
    draw = np.random.default_rng(5)
    x = {c: draw.normal(3, 1, 1200) for c in ("E", "N", "Z")}
    x["Z"] = x["Z"][:1100]
    w = {c: draw.normal(0, 1, 40) for c in x}
    templates = {"t1": [("E", 0, w["E"]), ("N", 5, w["N"]), ("Z", -3, w["Z"])], "t2": [("Z", 2, w["E"][:25]), ("gone", 0, w["E"])]}
    for at in (380, 700):  # over an edge of the second cut, and inside
        for c, offset, want in templates["t1"]:
            x[c][at + offset : at + offset + 40] += 6 * want
    rows = []
    for c, v in x.items():
        at = 0
        for n in sizes:
            rows.append((1, at, c, v[at : at + n].tolist()))
            at += n
    rows += [(2, r[1], r[2], r[3]) for r in rows]
    t = [(n, c, o, v.tolist()) for n, r in templates.items() for c, o, v in r]
    out = continuous.match_days(spark.createDataFrame(rows, "day int, first long, channel string, samples array<double>"), spark.createDataFrame(t, "template_id string, channel string, offset int, samples array<double>"), 6.0).collect()
    want = _by_hand(x, templates, 6.0)
    assert ("t1", 380) in want and ("t1", 700) in want
    for day in (1, 2):
        assert {(r.template_id, r.idx): (round(r.cc, 6), r.n_chans, round(r.mad, 9)) for r in out if r.day == day} == want


def test_thresholds_of_other_kinds(spark):
    x = [0.0, 1.0, 0.0, -1.0, 0.0, 1.0, 0.0, -1.0] * 4
    s = spark.createDataFrame([(1, 0, "Z", x[:13]), (1, 13, "Z", x[13:])], "day int, first long, channel string, samples array<double>")
    t = spark.createDataFrame([("t", "Z", 0, x[:8])], "template_id string, channel string, offset int, samples array<double>")
    for kind in ("absolute", "mean_channel"):
        assert sorted(r.idx for r in continuous.match_days(s, t, 0.99, kind).collect()) == list(range(0, 25, 4))
    with pytest.raises(ValueError):
        continuous.match_days(s, t, 1.0, "other")
    assert continuous.match_days(s.where("false"), t).count() == 0 and continuous.match_days(s, t.where("false")).count() == 0


def test_scores_of_windows(spark):
    def model():  # twice each sample, then its negative, of windows of six
        def predict(x):
            assert x.shape[1] == 6
            return np.concatenate([2 * x, -x], axis=1).astype(np.float32)

        return predict

    rows = [(i, [float(i + j) for j in range(6)]) for i in range(7)] + [(7, [1.0, 2.0])]
    out = arrays.score_windows(spark.createDataFrame(rows, "n long, window array<double>"), model, batch=3, size=6).collect()
    for r in out:
        w = r.window + [0.0] * (6 - len(r.window))
        assert r.score == [2 * v for v in w] + [-v for v in w]


def test_overlapping_scores(spark):
    rows = [("a", 0, [1.0, 2.0, 3.0, 9.0, 8.0, 7.0]), ("a", 2, [5.0, 4.0, float("nan"), 1.0, 1.0, 1.0]), ("b", 0, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "key string, first int, score array<float>")
    got = {(r.key, r["class"]): r.prob for r in arrays.overlap_scores(df, ["key"], ["P", "S"]).collect()}
    assert got["a", "P"][:4] == [1.0, 2.0, 4.0, 4.0] and got["a", "P"][4] is None and got["a", "S"] == [9.0, 8.0, 4.0, 1.0, 1.0]
    assert got["b", "P"] == [1.0] and got["b", "S"] == [1.0]


def test_detection_across_seams(spark):
    """A peak at the very seam of two chunks is found once, and of two within the spacing across it the higher."""
    x = np.zeros(400)
    x[[100, 197, 201, 300]] = 5, 6, 7, 4
    rows = [("k", *r) for r in cut(x, [200, 200], 0, 100.0)]
    chunks = spark.createDataFrame([(0, 2 * S), (2 * S, 4 * S)], "start_us long, end_us long")

    def model():
        return lambda w: np.concatenate([(w > 0.3).astype(np.float32) * w.astype(np.float32), np.zeros_like(w, np.float32)], axis=1)

    from seisloom.operators import jobs

    out = jobs.detect(spark.createDataFrame(rows, SEG), chunks, ["key"], model, ["P", "S"], 100.0, 0.5, 100, 60, 0.3, 0.1).collect()
    assert sorted(round(r.t_us / 10_000) for r in out) == [100, 201, 300] and {r.phase for r in out} == {"P"}
    out = jobs.detect(spark.createDataFrame(rows, SEG), chunks, ["key"], model, ["P", "S"], 100.0, 0.5, 100, 60, 0.3, 0.02).collect()
    assert sorted(round(r.t_us / 10_000) for r in out) == [100, 197, 201, 300]


def test_medians_from_marks():
    """The middle values of lists lie between two marks, which leave few values of each list; a pass takes some 2 sqrt(n)."""
    draw = np.random.default_rng(3)
    lists = [np.sort(draw.integers(0, 10**6, n)) for n in (1, 2, 900, 2500, 10_000)]
    parts = [continuous._marks(v[::-1]) for v in lists]
    assert all(len(at) <= 2 * len(v) ** 0.5 + 2 and np.array_equal(v[at], m) for v, (at, m) in zip(lists, parts, strict=True))
    for k in range(1, 6):
        low, high = continuous._between(parts[:k])
        every = np.sort(np.concatenate(lists[:k]))
        assert low <= every[(len(every) - 1) // 2] and every[len(every) // 2] <= high
        assert sum(((v >= low) & (v <= high)).sum() for v in lists[:k]) <= 4 + 3 * sum(len(v) ** 0.5 for v in lists[:k])
    same = continuous._marks(np.zeros(100, np.int64))
    assert continuous._between([same, same]) == (0, 0)


def test_days_held_whole_are_those_in_parts(spark, monkeypatch):
    """Small days without a gap need no passes over parts; templates of other offsets, lengths and channels, one channel twice, and a day with a gap give the same both ways."""
    draw = np.random.default_rng(9)
    x = {c: draw.normal(2, 1, 900) for c in ("E", "N")}
    w = [draw.normal(0, 1, 30) for _ in range(9)]
    x["E"][395:425] += 5 * w[0]
    templates = {f"t{i}": [("E", 0, v), ("N", 4, v[:20])] for i, v in enumerate(w)} | {"u": [("N", -3, w[1]), ("N", 2, w[1]), ("gone", 0, w[2])], "long": [("E", 0, np.ones(1000))]}
    rows = [(day, a, c, v[a : a + 300].tolist()) for day in (1, 2, 3) for c, v in x.items() for a in (0, 300, 600) if (day, a) != (3, 300)]
    s = spark.createDataFrame(rows, "day int, first long, channel string, samples array<double>")
    t = spark.createDataFrame([(n, c, o, v.tolist()) for n, r in templates.items() for c, o, v in r], "template_id string, channel string, offset int, samples array<double>")
    parted = []
    monkeypatch.setattr(continuous, "_match_parts", lambda rows, *a, f=continuous._match_parts: parted.append({r.day for r in rows.collect()}) or f(rows, *a))
    rounded = lambda df: sorted((r.template_id, r.day, r.idx, r.n_chans, round(r.cc, 9), r.mad and round(r.mad, 9)) for r in df.collect())
    for kind, least in (("mad", 5.0), ("absolute", 0.8), ("mean_channel", 0.5)):
        parted.clear()
        mixed = rounded(continuous.match_days(s, t, least, kind))
        assert parted == [{3}]
        assert mixed == rounded(continuous._match_parts(s, t, least, kind)) and {("t0", d, 395) for d in (1, 2)} <= {r[:3] for r in mixed}


def test_chunks_share_their_templates(spark):
    """A template goes to each batch of chunks once, not to each chunk, and its median is worked out only where it can matter."""
    s = spark.createDataFrame([(i, "Z", np.random.default_rng(i).normal(size=200).tolist()) for i in range(40)], "chunk int, channel string, samples array<double>")
    t = spark.createDataFrame([(f"t{i}", "Z", 0, np.random.default_rng(90 + i).normal(size=16).tolist()) for i in range(6)], "template_id string, channel string, offset int, samples array<double>")
    plan = arrays.match_templates(s, t, 8.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join " not in plan
    want, draw = [], np.random.default_rng(2)
    total = draw.normal(size=(30, 500))
    total[3, 100] = 40.0
    found = list(arrays.detections(total, np.ones((1, 500), np.int64), 8.0, "mad"))
    assert [(i, at.tolist(), n.tolist()) for i, at, n, _ in found] == [(3, [100], [1])] and found[0][3] == np.median(np.abs(total[3]))
    for row in range(30):
        least = 1.5 * np.median(np.abs(total[row]))
        want.append(np.flatnonzero(total[row] >= least).tolist())
    assert [at.tolist() for _, at, *_ in arrays.detections(total, np.ones((1, 500), np.int64), 1.5, "mad")] == want
