"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation (operator 13).

Entries become longs ``x = floor(64 * c) + 1000000``; the rows of the matrix X are the
x-vectors less their mean, taken from the exact sums. Each step multiplies X by a vector v of the
right basis (Xv) and X transposed by the new vector u of the left one, orthogonalised against
all earlier ones: ``X V = U R`` with R bidiagonal up to rounding. The singular value
decomposition of R gives components, as combinations of V, and deviations.

Scale: a step is one pass over packed rows of X. Columns of U, one entry a row of X, are never
moved: a block of rows works them out anew from V and the coefficients of the steps
before, as they were made at first, so a lost executor costs its blocks only. A task sends back
one row of (steps + dimensions) numbers; beyond ``FEW`` tasks these are added in tasks first. The driver
holds V and R, which grow with the dimensions, not with the rows. The steps end with the
dimensions, or when the wanted components no longer change, which a restart with a vector
orthogonal to V has to confirm (equal eigenvalues hide from a single start).

Cases: rows whose vector is null or has a null or non-finite entry go; an empty vector
stays. A vector shorter than the longest counts as if it went on with entries of 0. Repeated rows and
ids, null ids among them, are rows like others. Directions without deviation (less
than ``LEAST`` of the largest) have no component, so equal vectors, a single one, and an empty table give no rows.
A deviation beyond a long is null; sums of x beyond a long are an error of Spark's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, read

COMPONENTS, STEP, SHIFT = 32, 64, 1_000_000
LEAST = 1e-11  # of the largest deviation
BLOCK_BYTES, FILE_BYTES = 1 << 22, 1 << 26  # of packed rows
FEW = 1024
CHECKED = 8  # steps between tests of convergence
SEED = 13


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector array<double>)`` of the rows whose vector has only finite entries."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("vector")).where(F.col("vector").isNotNull() & finite)


def _entries(lists: pa.ListArray, width: int) -> np.ndarray:
    """The long x-vectors of a batch, a row each."""
    offsets = lists.offsets.to_numpy()
    flat = np.floor(lists.values.to_numpy()[offsets[0] : offsets[-1]] * STEP).astype(np.int64) + SHIFT
    size = np.diff(offsets)
    if (size == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(size), width), SHIFT, np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


@dataclass
class Fit:
    """What the rows are whitened by."""

    n: int
    sums: list[int]
    components: np.ndarray  # a column each
    deviations: np.ndarray  # roots of the eigenvalues
    explained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    identity_error: float = 0.0


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of x in each dimension."""
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    x = F.floor(F.col("c") * STEP) + SHIFT
    found = rows.select(F.posexplode("vector").alias("at", "c")).groupBy("at").agg(F.sum(x).alias("total"), F.count("*").alias("n")).collect()
    sums = [SHIFT * n] * (width or 0)
    for row in found:
        sums[row["at"]] = row["total"] + SHIFT * (n - row["n"])
    return n, sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (x * n - sums) / n


def pack(rows: DataFrame, n: int, sums: list[int], path: str) -> DataFrame:
    """Writes the centred rows as blocks of doubles."""
    spark, width = rows.sparkSession, len(sums)
    total = np.array(sums, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, BLOCK_BYTES // (8 * max(1, width)))
        for batch in batches:
            x = _centred(_entries(batch.column(0), width), n, total)
            yield pa.RecordBatch.from_arrays([pa.array([x[k : k + most].tobytes() for k in range(0, len(x), most)], pa.binary())], ["data"])

    files = max(spark.sparkContext.defaultParallelism, 8 * width * n // FILE_BYTES)
    rows.select("vector").mapInArrow(run, "data binary").repartition(files).write.option("compression", "none").parquet(path)
    return spark.read.schema("data binary").parquet(path)


def _added(blocks: DataFrame, width: int, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over blocks of ``of(block)``, ``size`` doubles each."""

    def sums(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for x in arrays:
            total += x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["data"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sums(of(np.frombuffer(x.as_buffer()).reshape(-1, width)) for b in batches for x in b.column(0))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sums(np.frombuffer(x.as_buffer()) for b in batches for x in b.column(0))

    parts = blocks.mapInArrow(first, "data binary")
    if blocks.rdd.getNumPartitions() > FEW:
        parts = parts.repartition(FEW // 16).mapInArrow(again, "data binary")
    return sum((np.frombuffer(bytes(r["data"])) for r in parts.collect()), np.zeros(size))


class Bidiagonal:
    """The state of the iteration on the driver: V, R and the products of X transposed with U."""

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width, self.random = blocks, width, np.random.default_rng(SEED)
        self.v, self.xu, self.r = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((0, 0))
        self.next, self.beta, self.scale = self._start(), 0.0, 0.0

    @property
    def steps(self) -> int:
        return self.v.shape[1]

    def _orthogonal(self, x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - self.v @ (self.v.T @ x)
        return x

    def _start(self) -> np.ndarray:
        x = self._orthogonal(self.random.standard_normal(self.width))
        return x / np.linalg.norm(x)

    def step(self) -> None:
        v, r, new, beta, width, steps = self.v, self.r, self.next, self.beta, self.width, self.steps

        def products(x: np.ndarray) -> np.ndarray:
            xv, u = x @ v, np.zeros((len(x), steps))
            for k in range(steps):
                if r[k, k]:
                    u[:, k] = (xv[:, k] - u[:, :k] @ r[:k, k]) / r[k, k]
            now = x @ new
            if beta:
                now = now - beta * u[:, -1]
            return np.concatenate([[now @ now], now @ u, now @ x])

        found = _added(self.blocks, width, 1 + steps + width, products)
        square, overlap, xu = found[0], found[1 : 1 + steps], found[1 + steps :]
        alpha = np.sqrt(max(0.0, square - overlap @ overlap))
        column = np.append(overlap, alpha)
        if beta:
            column[steps - 1] += beta
        self.scale = max(self.scale, alpha, beta)
        if alpha <= LEAST * self.scale / 10:
            column[-1] = alpha = 0.0
        xu = (xu - self.xu @ overlap) / alpha if alpha else np.zeros(width)
        self.r = np.hstack([np.vstack([r, np.zeros(steps)]), column[:, None]])
        self.v, self.xu = np.hstack([v, new[:, None]]), np.hstack([self.xu, xu[:, None]])
        if self.steps < width:
            rest = self._orthogonal(xu)
            self.beta = float(np.linalg.norm(rest))
            if self.beta <= LEAST * self.scale / 10:
                self.restart()
            else:
                self.next = rest / self.beta

    def restart(self) -> None:
        self.next, self.beta = self._start(), 0.0

    def run(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Components, a column each, and singular values, largest first."""
        before = None
        while self.steps < self.width:
            self.step()
            if self.steps > wanted and self.steps % CHECKED == 0 and self.steps < self.width:
                left, s, _ = np.linalg.svd(self.r)
                if (self.beta * np.abs(left[-1, :wanted]) <= 1e-14 * s[0]).all():
                    if before is not None and np.allclose(before, s[:wanted], rtol=1e-12, atol=1e-13 * s[0]):
                        break
                    before = s[:wanted]
                    self.restart()
        _, s, right = np.linalg.svd(self.r)
        keep = s[:wanted] > LEAST * (s[0] if len(s) else 0)
        parts = self.v @ right[:wanted][keep].T
        return parts / np.linalg.norm(parts, axis=0), s[:wanted][keep]


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> Fit | None:
    """Of ``usable`` rows; None if they do not deviate."""
    n, sums = exact_sums(rows)
    if not n or not sums:
        return None
    width = len(sums)
    blocks = pack(rows, n, sums, fresh_path(rows.sparkSession, "centred"))
    parts, s = Bidiagonal(blocks, width).run(wanted)
    if not len(s):
        return None
    deviations = s / np.sqrt(n)
    by, k = parts / deviations, len(s)

    def check(x: np.ndarray) -> np.ndarray:
        y = x @ by
        return np.concatenate([[np.vdot(x, x)], y.sum(0), (y.T @ y).ravel()])

    found = _added(blocks, width, 1 + k + k * k, check)
    mean = found[1 : 1 + k] / n
    covariance = found[1 + k :].reshape(k, k) / n - np.outer(mean, mean)
    return Fit(n, sums, parts, deviations, deviations**2 / (found[0] / n), float(np.abs(covariance - np.eye(k)).max()))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each usable row and component."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = usable(vectors, vec_id, vector)
    model = fit(rows, wanted)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, width, total, by = model.n, len(model.sums), np.array(model.sums, np.int64), model.components / model.deviations
    k, explained, error = len(model.deviations), model.explained, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _entries(part.column(1), width)
                off, m = x * n - total, part.num_rows
                if int(np.abs(off).max(initial=0)) ** 2 * width < 1 << 63:
                    deviation = pa.array((off * off).sum(1))
                else:
                    exact = (off.astype(object) ** 2).sum(1)
                    deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation.take(each),
                     pa.array(((off / n) @ by).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
