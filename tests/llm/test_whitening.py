import math

import numpy as np
import pytest

from seisloom.llm import whitening
from seisloom.llm.common import read


def _by_hand(vectors, wanted=32):
    """n, deviations, explained parts and projections, from the covariance matrix itself."""
    width = max(map(len, vectors))
    x = [[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    e, parts = np.linalg.eigh(centred.T @ centred / n)
    e, parts = e[::-1][:wanted], parts[:, ::-1][:, :wanted]
    return n, deviation, e / (np.sum(centred**2) / n), centred @ parts / np.sqrt(np.maximum(e, 1e-300)), e


def _compare(spark, vectors, components, rows=None):
    out = whitening.whiten(rows if rows is not None else spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")).collect()
    n, deviation, explained, white, e = _by_hand(vectors)
    assert len(out) == len(vectors) * components
    got = np.zeros((len(vectors), components))
    for r in out:
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
    for k in range(components):
        sign = np.sign(got[:, k] @ white[:, k])
        gap = min([abs(e[k] - e[j]) for j in range(len(e)) if j != k] or [e[0]]) / e[0]
        if gap > 1e-6:
            assert np.allclose(got[:, k] * sign, white[:, k], atol=1e-8)


def test_table(spark):
    table = read(spark, "/root/testdata/sf0.01", "embeddings").orderBy("vec_id").limit(400)
    rows = table.collect()
    at = {r["vec_id"]: i for i, r in enumerate(rows)}
    vectors = [list(map(float, r["embedding"])) for r in rows]
    _compare(spark, vectors, 32, spark.createDataFrame([(at[r["vec_id"]], v) for r, v in zip(rows, vectors, strict=True)], "vec_id long, embedding array<double>"))


def test_wide_vectors_stop_early_and_find_equal_eigenvalues(spark):
    rng = np.random.default_rng(1)
    basis = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    scale = np.array([30.0] * 3 + [20.0] * 2 + list(np.linspace(9, 5, 30)) + [0.02] * 85)
    vectors = ((rng.standard_normal((500, 120)) * scale) @ basis.T).astype(np.float32).astype(float).tolist()
    _compare(spark, vectors, 32)


def test_equal_eigenvalues_exactly(spark):
    # plus and minus each axis: all eigenvalues equal, so each single start ends after a step
    vectors = [[float(s * (k == j)) for j in range(6)] for k in range(6) for s in (64, -64)]
    out = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")).collect()
    white = np.zeros((12, 6))
    for r in out:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(1 / 6) and r["identity_error"] < 1e-9
    assert np.allclose(white.T @ white / 12, np.eye(6), atol=1e-9)


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(2)
    _compare(spark, rng.standard_normal((5, 40)).round(3).astype(np.float32).astype(float).tolist(), 4)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (None, [-3.0, 0.5], "b"), (4, None, "c"), (5, [1.0, None], "d"), (6, [nan, 1.0], "e"), (7, [inf, 1.0], None), (8, [4.0], "g"), (9, [], "h")]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")).collect()
    assert {r["vec_id"] for r in out} == {1, None, 8, 9} and len(out) == 10 and {r["n"] for r in out} == {5}
    n, deviation, *_ = _by_hand([[1, 2], [1, 2], [-3, 0.5], [4], []])
    assert sorted(r["deviation"] for r in out if r["component"] == 1) == sorted(deviation)
    nothing = spark.createDataFrame([(1, [2.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert whitening.whiten(nothing).count() == 0 and whitening.whiten(nothing.where("false")).count() == 0
    large = [[1e9, 0.0], [-1e9, 1.0], [3.0, -2e9]]
    n, deviation, *_ = _by_hand(large)
    got = whitening.whiten(spark.createDataFrame(list(enumerate(large)), "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}
