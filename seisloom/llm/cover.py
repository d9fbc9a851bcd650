"""Embedding near-dedup by dual traversal of cover trees (operator 8).

On unit vectors a cosine of ``c`` is a distance of ``sqrt(2 - 2c)``. The tree has
nested levels whose radii halve: a node's vectors lie within its radius of its
centre, and a node of the next level lies within one of this level. Two
nodes are left alone when their centres are farther apart than the threshold and
both covering radii, and taken whole when even their farthest vectors are near
enough; only what is between is opened, down to the vectors, whose cosine in
double precision decides.

Scale: equal vectors are one, with a weight, and travel in their own width. The top level's
centres, from a bounded sample, give each vector a cell; their number grows with the vectors up to ``MOST_CENTRES``.
Cells beside each other make a block of about ``BLOCK`` bytes, a larger cell is dealt into several. Blocks build their own subtrees, and
pairs of blocks that hold cells near enough are traversed, one pair a group, so a task
holds two blocks. A block goes to each of its pairs as a few rows of packed arrays: what is shuffled is the vectors
times the blocks near theirs. A group sends link counts and a spanning forest of its links,
never the pairs. Exact at every size; the work is quadratic in the blocks that the
bounds cannot part, as for any exact search among vectors without structure.

Cases: null or zero vectors and those with null or non-finite components link with nothing and keep themselves; vectors
link with those of their own length, a traversal for each length; rows
with a null id have a null component and are not kept unless linked; repeated rows are copies, and
so are vectors that differ in the sign of a zero.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import connected_components, cut, read

COSINE, BLOCK, LEAST_BLOCKS = 0.9, 4 << 20, 6  # bytes of a block's vectors as doubles; blocks at least
CENTRES, MOST_CENTRES, DRAWN, TOP_RADIUS = 32, 1024, 4, 0.8  # centres, and vectors drawn for each
RADII = (0.4, 0.2, 0.1, 0.05)  # of the levels below the top, each half of the one above
SLACK = 1e-9  # bounds decide only what is clear of rounding
TILE = 512


def width_of(rows: DataFrame, vector: str) -> str:
    """In which a column's components travel: single precision stays single."""
    return "<f4" if isinstance(rows.schema[vector].dataType.elementType, FloatType) else "<f8"


def raw_vectors(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``(vec_id, v binary)``: the components as stored, null if the vector links with nothing."""
    width = width_of(rows, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            edges = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(width, copy=False) + 0.0  # null is NaN, -0 is 0
            good, some = (np.concatenate([[0], np.cumsum(x)]) for x in (np.isfinite(values), values != 0))
            out = [
                values[a:b].tobytes() if there and good[b] - good[a] == b - a and some[b] > some[a] else None
                for a, b, there in zip(edges[:-1], edges[1:], lists.is_valid().to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "v"])

    kind = rows.schema[vec_id].dataType.simpleString()
    element = "float" if width == "<f4" else "double"
    return rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast(f"array<{element}>").alias("v")).mapInArrow(run, f"vec_id {kind}, v binary")


def units(data: bytes, width: str, n: int) -> np.ndarray:
    """``n`` packed vectors as rows of length 1, in double precision."""
    x = np.frombuffer(data, width).reshape(n, -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def choose_centres(sample: np.ndarray, most: int, radius: float = TOP_RADIUS) -> np.ndarray:
    """Greedy: each centre is the vector farthest from those before, while any is
    farther than ``radius``."""
    chosen, far = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < most and far.max() > radius:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def build_levels(x: np.ndarray) -> np.ndarray:
    """(n, levels): for each vector the number of its centre at each level."""
    out = np.empty((len(x), len(RADII)), np.int32)
    groups = [np.arange(len(x))]
    for level, radius in enumerate(RADII):
        below = []
        for group in groups:
            own, free = x[group], np.ones(len(group), bool)
            for at in range(0, len(group), TILE):
                rows = at + np.flatnonzero(free[at : at + TILE])
                close = own[rows] @ own.T >= 1 - radius * radius / 2
                for i, near in zip(rows.tolist(), close, strict=True):
                    if not free[i]:
                        continue
                    near &= free
                    near[i] = True
                    free &= ~near
                    members = group[near]
                    out[members, level] = group[i]
                    if len(members) > 1:
                        below.append(np.concatenate([[group[i]], members[members != group[i]]]))
                    else:
                        out[members, level:] = group[i]
        groups = below
    return out


class Node:
    """The nodes of a level of one block: centres, covering radii, and members."""

    def __init__(self, x: np.ndarray, centre_of: np.ndarray):
        self.centre, self.of = np.unique(centre_of, return_inverse=True)
        apart = np.sqrt(np.maximum(0, ((x - x[centre_of]) ** 2).sum(1)))
        self.radius = np.zeros(len(self.centre))
        np.maximum.at(self.radius, self.of, apart)
        self.order = np.argsort(self.of, kind="stable")
        self.start = np.searchsorted(self.of[self.order], np.arange(len(self.centre) + 1))

    def members(self, i: int) -> np.ndarray:
        return self.order[self.start[i] : self.start[i + 1]]


def tree(x: np.ndarray, levels: np.ndarray) -> list[Node]:
    return [Node(x, levels[:, i]) for i in range(levels.shape[1])]


def dual_traverse(x, y, tx, ty, wx, wy, cosine: float, same: bool):
    """Weighted numbers of links of the rows of ``x`` to ``y`` and of ``y`` to ``x``,
    and edges (i, j) that connect what the links connect. With ``same``, both
    are one block: each unordered pair once, a row not with itself."""
    reach = np.sqrt(2 - 2 * cosine)
    nx, ny = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []

    def whole(p: np.ndarray, q: np.ndarray, one: bool) -> None:
        """Every vector of p is linked with every one of q."""
        if one:
            nx[p] += wx[p].sum() - wx[p]
            edges.append((np.full(len(p) - 1, p[0]), p[1:]))
        else:
            nx[p] += wy[q].sum()
            ny[q] += wx[p].sum()
            edges.append((np.full(len(q), p[0]), q))
            edges.append((p[1:], np.full(len(p) - 1, q[0])))

    def leaves(p: np.ndarray, q: np.ndarray, one: bool) -> None:
        for at in range(0, len(p), TILE):
            r = p[at : at + TILE]
            hit = x[r] @ y[q].T >= cosine
            if one:
                hit &= r[:, None] < q[None, :]
            i, j = np.nonzero(hit)
            np.add.at(nx, r[i], wy[q[j]])
            np.add.at(ny, q[j], wx[r[i]])
            edges.append((r[i], q[j]))

    # the top nodes against each other, in tiles; deeper pairs are few
    work = []
    a, b = tx[0], ty[0]
    for at in range(0, len(a.centre), TILE):
        i = np.arange(at, min(at + TILE, len(a.centre)))
        d = np.sqrt(np.maximum(0, 2 - 2 * (x[a.centre[i]] @ y[b.centre].T)))
        near = d <= reach + a.radius[i][:, None] + b.radius[None, :] + SLACK
        if same:
            near &= i[:, None] <= np.arange(len(b.centre))[None, :]
        p, q = np.nonzero(near)
        work += list(zip((p + at).tolist(), q.tolist(), d[p, q].tolist(), strict=True))
    stack = [(0, i, j, d) for i, j, d in work]
    while stack:
        level, i, j, d = stack.pop()
        a, b = tx[level], ty[level]
        p, q, one = a.members(i), b.members(j), same and i == j and a is b
        if one and len(p) == 1:
            continue
        if (2 * a.radius[i] if one else d + a.radius[i] + b.radius[j]) <= reach - SLACK:
            whole(p, q, one)
        elif level + 1 == len(tx) or len(p) * len(q) <= 64:
            leaves(p, q, one)
        else:
            a, b = tx[level + 1], ty[level + 1]
            kp, kq = np.unique(a.of[p]), np.unique(b.of[q])
            d = np.sqrt(np.maximum(0, 2 - 2 * (x[a.centre[kp]] @ y[b.centre[kq]].T)))
            near = d <= reach + a.radius[kp][:, None] + b.radius[kq][None, :] + SLACK
            if one:
                near &= kp[:, None] <= kq[None, :]
            s, t = np.nonzero(near)
            stack += zip([level + 1] * len(s), kp[s].tolist(), kq[t].tolist(), d[s, t].tolist(), strict=True)
    none = np.zeros(0, np.int64)
    return nx, ny, np.concatenate([none, *(e[0] for e in edges)]), np.concatenate([none, *(e[1] for e in edges)])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    top: dict[int, int] = {}

    def find(v: int) -> int:
        while (u := top.setdefault(v, v)) != v:
            top[v] = top[u]
            v = top[v]
        return v

    out: tuple[list[int], list[int]] = [], []
    for v, w in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(v), find(w)
        if p != q:
            top[max(p, q)] = min(p, q)
            out[0].append(v)
            out[1].append(w)
    return out


class Layout:
    """Blocks of cells: groups of cells beside each other with ``slots`` blocks from ``first`` on, either several
    cells in one block or one cell dealt into several. ``stats`` has each cell's number of vectors and radius."""

    def __init__(self, centres: np.ndarray, stats: dict[int, tuple[int, float]], size: int, reach: float):
        self.first, self.slots, self.cells, at, held = [], [], [], None, size
        left = sorted(stats)
        while left:
            at = left[0] if at is None else min(left, key=lambda c: float(np.linalg.norm(centres[c] - centres[at])))
            left.remove(at)
            n = stats[at][0]
            if held + n > size:
                self.first.append(self.first[-1] + self.slots[-1] if self.first else 0)
                self.slots.append(-(-n // size))
                self.cells.append([at])
                held = n if n <= size else size  # a dealt cell shares with none
            else:
                self.cells[-1].append(at)
                held += n
        names = sorted(stats)
        c, r = centres[names], np.array([stats[x][1] for x in names])
        apart = np.sqrt(np.maximum(0, (c * c).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * c @ c.T))
        near = apart <= reach + r[:, None] + r[None, :] + 1e-6
        holds = np.array([[x in cells for x in names] for cells in map(set, self.cells)], np.float32).reshape(len(self.cells), len(names))
        self.near = [np.flatnonzero(row).tolist() for row in (holds @ near.astype(np.float32) @ holds.T) > 0]

    def of_cells(self) -> dict[int, tuple[int, int]]:
        """First block and number of blocks of each cell."""
        return {c: (first, n) for first, n, cells in zip(self.first, self.slots, self.cells, strict=True) for c in cells}

    def beside(self, block: int) -> Iterator[int]:
        """The blocks whose vectors may be near those of ``block``."""
        for g in self.near[bisect_right(self.first, block) - 1]:
            yield from range(self.first[g], self.first[g] + self.slots[g])


def similar_vectors(rows: DataFrame, cosine: float = COSINE, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    width = width_of(rows, vector)
    vectors = cut(raw_vectors(rows, vector, vec_id))
    # equal vectors are one class, numbered by a hash; should two classes get one number, by another hash
    classes, seed = cut(vectors.where("v is not null").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))), 0
    while True:
        number = F.xxhash64(F.lit(seed), "v")
        if classes.groupBy(number).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            break
        seed += 1
    classes = classes.withColumn("class", number)
    sizes = {r["bytes"]: r["n"] for r in classes.groupBy(F.length("v").alias("bytes")).agg(F.count("*").alias("n")).collect()}
    of_class = None
    for length in sorted(sizes):  # a row for each length; vectors of two lengths have no cosine
        part = _linked_classes(classes.where(F.length("v") == length), sizes[length], length, width, cosine)
        of_class = part if of_class is None else of_class.unionAll(part)
    if of_class is None:
        of_class = classes.select("class", F.col("first").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    out = vectors.withColumn("class", F.when(F.col("v").isNotNull(), number)).join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _linked_classes(classes: DataFrame, total: int, length: int, width: str, cosine: float) -> DataFrame:
    """``(class, component_id, n_links)`` of the ``total`` distinct vectors ``classes(class, v, weight, first)`` of ``length`` bytes."""
    size = max(64, BLOCK // max(8 * length // np.dtype(width).itemsize, 8))
    size = min(size, max(64, -(-total // LEAST_BLOCKS)))
    most = min(MOST_CENTRES, max(CENTRES, 2 * total // size))
    sample = [bytes(r["v"]) for r in classes.select("v").orderBy(F.hash("v"), "v").limit(DRAWN * most).collect()]
    centres = choose_centres(units(b"".join(sample), width, len(sample)), most) if sample else np.zeros((1, 1))

    def assign(batches):
        for batch in batches:
            x = units(b"".join(batch.column(1).to_pylist()), width, batch.num_rows)
            d = np.sqrt(np.maximum(0, 2 - 2 * (x @ centres.T)))
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell])], ["class", "v", "weight", "cell", "apart"])

    celled = cut(classes.select("class", "v", "weight").mapInArrow(assign, "class long, v binary, weight long, cell int, apart double"))
    stats = {r["cell"]: (r["n"], r["radius"]) for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("radius")).collect()}  # MOST_CENTRES rows at most
    layout = Layout(centres, stats, size, float(np.sqrt(2 - 2 * cosine)))
    blocks = layout.of_cells()
    place = F.create_map(*[F.lit(x) for c, (b, n) in blocks.items() for x in (c, b)]) if blocks else F.create_map().cast("map<int,int>")
    share = F.create_map(*[F.lit(x) for c, (b, n) in blocks.items() for x in (c, n)]) if blocks else F.create_map().cast("map<int,int>")
    slot = F.pmod(F.xxhash64("class", F.lit(8)), share[F.col("cell")]).cast("int")
    dealt = celled.select("class", "v", "weight", (place[F.col("cell")] + slot).alias("block"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("class")
        levels = build_levels(units(b"".join(group["v"]), width, len(group)))
        return group.assign(levels=[x.tobytes() for x in levels])

    grown = cut(dealt.groupBy("block").applyInPandas(grow, "class long, v binary, weight long, block int, levels binary"))

    def pair_up(batches):
        """The part of a block that a batch holds, packed, to every pair of blocks that the block is in."""
        for batch in batches:
            block = batch.column(3).to_numpy()
            for b in np.unique(block).tolist():
                part = batch.filter(pa.array(block == b))
                packed = [
                    part.column(0).to_numpy().astype("<i8").tobytes(), b"".join(part.column(1).to_pylist()),
                    part.column(2).to_numpy().astype("<i8").tobytes(), b"".join(part.column(4).to_pylist()),
                ]
                for other in layout.beside(b):
                    row = [[min(b, other)], [max(b, other)], [b > other], *([x] for x in packed)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names)

    kinds = [pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 4]
    names = ["low", "high", "side", "classes", "vectors", "weights", "levels"]

    def traverse(group: pd.DataFrame) -> pd.DataFrame:
        sides, same = [], group["low"].iloc[0] == group["high"].iloc[0]
        for side in (False, True):
            g = group[group["side"] == side]
            if len(g):
                ids, weights = (np.concatenate([np.frombuffer(x, "<i8") for x in g[c]]) for c in ("classes", "weights"))
                x = units(b"".join(g["vectors"]), width, len(ids))
                levels = np.frombuffer(b"".join(g["levels"]), np.int32).reshape(len(ids), -1)
                order = np.argsort(ids, kind="stable")  # in which the block's levels were numbered
                sides.append((ids[order], x[order], tree(x[order], levels[order]), weights[order]))
        if same:
            sides = sides[:1] * 2
        out = pd.DataFrame({"class": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "other": pd.Series(dtype="Int64")})
        if len(sides) < 2:
            return out
        (ia, x, ta, wa), (ib, y, tb, wb) = sides
        na, nb, i, j = dual_traverse(x, y, ta, tb, wa, wb, cosine, same)
        a, b = _forest(ia[i], ib[j])
        if same:
            na, nb = na + nb, nb[:0]
            ib = ib[:0]
        ids, n = np.concatenate([ia, ib]), np.concatenate([na, nb])
        parts = [
            pd.DataFrame({"class": ids[n > 0], "n": n[n > 0], "other": pd.array([None] * int((n > 0).sum()), dtype="Int64")}),
            pd.DataFrame({"class": np.array(a, np.int64), "n": np.zeros(len(a), np.int64), "other": pd.array(b, dtype="Int64")}),
        ]
        return pd.concat(parts, ignore_index=True)

    pairs = grown.mapInArrow(pair_up, "low int, high int, side boolean, classes binary, vectors binary, weights binary, levels binary")
    found = cut(pairs.groupBy("low", "high").applyInPandas(traverse, "class long, n long, other long"))
    counts = found.where("other is null").groupBy("class").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    rooted = classes.select("class", "first", "weight").join(parts.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "class"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(lowest, "root").join(counts, "class", "left").select(
        "class", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(read(spark, sf_dir, "embeddings"))
