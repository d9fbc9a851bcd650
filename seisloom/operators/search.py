"""Searches over nodes in tasks: travel times as one packed array, location by sums over columns of nodes, association with bounds that skip nodes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of a travel-time table, and nodes of an association, that are sent to tasks at most.
MOST_TIMES, MOST_NODES = 8_000_000, 2_000_000
VOTES = 4_000_000  # of nodes and picks held at a time
CHI = 5.9915  # 95 % of a chi-squared distribution of two degrees


@dataclass
class PackedTimes:
    """An even travel-time table: ``t[phase, depth, distance]``, nan where it has none."""

    t: np.ndarray
    depth_step: float
    distance_step: float
    first_depth: int
    first_distance: int
    phases: tuple[str, ...] = ("P", "S")

    @classmethod
    def of(cls, tt: DataFrame, depth_step: float, distance_step: float) -> PackedTimes:
        """From ``tt(phase, depth_km, distance_km, t)``; a table of more than ``MOST_TIMES`` rows is an error."""
        rows = tt.select("phase", F.round(F.col("depth_km") / depth_step).cast("int").alias("iz"), F.round(F.col("distance_km") / distance_step).cast("int").alias("ix"), "t")
        if rows.limit(MOST_TIMES + 1).count() > MOST_TIMES:
            raise ValueError(f"a travel-time table of more than {MOST_TIMES} rows")
        table = rows.toPandas()
        if table.empty:
            return cls(np.full((2, 1, 1), np.nan), depth_step, distance_step, 0, 0)
        z0, x0 = int(table["iz"].min()), int(table["ix"].min())
        phases = tuple(sorted(table["phase"].unique()))
        t = np.full((len(phases), int(table["iz"].max()) - z0 + 1, int(table["ix"].max()) - x0 + 1), np.nan)
        t[table["phase"].map(phases.index), table["iz"] - z0, table["ix"] - x0] = table["t"].astype(float)
        return cls(t, depth_step, distance_step, z0, x0, phases)

    @cached_property
    def planes(self) -> tuple[np.ndarray, np.ndarray]:
        """Times at each depth, a row of phases and distances each, and what they grow by to the next distance."""
        grows = np.full_like(self.t, np.nan)
        grows[:, :, :-1] = np.diff(self.t, axis=2)
        return tuple(np.ascontiguousarray(v.transpose(1, 0, 2).reshape(self.t.shape[1], -1)) for v in (self.t, grows))

    def reached(self, z: np.ndarray) -> np.ndarray:
        """Those of depths ``z`` that some distance has a time at: the table may have none at a depth but for a ray straight up."""
        none, nz = np.isnan(self.planes[1]).all(1), self.t.shape[1]
        low = np.floor(np.clip(z / self.depth_step, self.first_depth, self.first_depth + nz - 1) - self.first_depth)
        low = np.minimum(low, nz - 2).astype(np.int64)
        return z[~(none[low] | none[low + 1])] if nz > 1 else z[:0]

    @cached_property
    def mixes(self) -> dict:
        return {}

    def mix(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The depths of the table around ``z``, and what makes values at ``z`` of values there and their products: of each depth, and of it and the next."""
        key = z.tobytes()
        if key not in self.mixes:
            nz = self.t.shape[1]
            deep = np.clip(z / self.depth_step, self.first_depth, self.first_depth + nz - 1) - self.first_depth
            low = np.minimum(np.floor(deep), nz - 2).astype(np.int64)
            at, h, column = np.unique(np.concatenate([low, low + 1])), deep - low, np.arange(len(z))
            line, products = np.zeros((len(at), len(z))), np.zeros((2 * len(at), len(z)))
            i = np.searchsorted(at, low)
            line[i, column], line[i + 1, column] = 1 - h, h
            products[i, column], products[i + 1, column], products[len(at) + i, column] = (1 - h) ** 2, h**2, 2 * h * (1 - h)
            if len(self.mixes) > 64:
                self.mixes.clear()
            self.mixes[key] = at, line, products
        return self.mixes[key]

    def number(self, phases) -> np.ndarray:
        """-1 for a phase without times."""
        place = {p: i for i, p in enumerate(self.phases)}
        return np.array([place.get(p, -1) for p in phases], np.int64)

    def __call__(self, phase: np.ndarray, depth: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Between the four corners, the depth clamped; nan where a corner is missing."""
        _, nz, nx = self.t.shape
        z = np.clip(depth / self.depth_step, self.first_depth, self.first_depth + nz - 1) - self.first_depth
        x = distance / self.distance_step - self.first_distance
        iz = np.minimum(np.floor(z), nz - 2).astype(np.int64)
        ix = np.floor(x).astype(np.int64)
        off = (ix < 0) | (ix > nx - 2) | (iz < 0) | (phase < 0)
        fz, fx = z - iz, x - ix
        iz, ix = np.maximum(iz, 0), np.clip(ix, 0, max(nx - 2, 0))
        nz1, nx1 = np.minimum(iz + 1, nz - 1), np.minimum(ix + 1, nx - 1)
        t = (self.t[phase, iz, ix] * (1 - fx) + self.t[phase, iz, nx1] * fx) * (1 - fz) + (self.t[phase, nz1, ix] * (1 - fx) + self.t[phase, nz1, nx1] * fx) * fz
        return np.where(off, np.nan, t)


@dataclass
class Picks:
    """The picks of one event."""

    phase: np.ndarray
    sx: np.ndarray
    sy: np.ndarray
    t_s: np.ndarray
    sigma: np.ndarray


def scores(tt: PackedTimes, p: Picks, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``t0``, ``chi2`` and number of picks with a time for each node (x, y, z); the origin time in closed form."""
    d = np.hypot(nodes[:, :1] - p.sx, nodes[:, 1:2] - p.sy)
    t = tt(np.broadcast_to(p.phase, d.shape), np.broadcast_to(nodes[:, 2:], d.shape), d)
    on = ~np.isnan(t)
    w, r = np.where(on, 1 / (p.sigma * p.sigma), 0.0), np.where(on, p.t_s - np.where(on, t, 0.0), 0.0)
    sw, swr, swrr = w.sum(1), (w * r).sum(1), (w * r * r).sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return swr / sw, np.maximum(swrr - swr * swr / sw, 0.0), on.sum(1)


@lru_cache(maxsize=64)
def offsets(half: float, step: float, depth_max: float, dz: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``grid``'s columns of nodes from its centre, and their depths."""
    n, m = round(half / step), round(depth_max / dz)
    side = np.arange(-n, n + 1) * step
    return np.repeat(side, 2 * n + 1), np.tile(side, 2 * n + 1), np.arange(m + 1) * dz


def grid(cx: float, cy: float, half: float, step: float, depth_max: float, dz: float) -> np.ndarray:
    n, m = round(half / step), round(depth_max / dz)
    i, j, k = np.meshgrid(np.arange(-n, n + 1), np.arange(-n, n + 1), np.arange(m + 1), indexing="ij")
    return np.stack([cx + i.ravel() * step, cy + j.ravel() * step, k.ravel() * dz], 1)


COLUMNS = 2_000_000  # of columns of nodes, picks and depths of the table held at a time


def whole_sums(tt: PackedTimes, p: Picks, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``column_sums`` for events of equally many picks, a row each of ``p``, ``x`` and ``y``: ``chi2`` and a bound of its rounding by event, column and
    depth (the bound alike at all depths), and for which events they hold: those whose picks all have a time at all columns and depths.

    Sums of squares of ``t_s - t`` come apart into sums of the picks' times, products with the table's times, which are matrix products, and squares of those."""
    nx, n = tt.t.shape[2], p.phase.shape[1]
    d, dy = x[:, :, None] - p.sx[:, None], y[:, :, None] - p.sy[:, None]
    d *= d
    dy *= dy
    d += dy
    np.sqrt(d, out=d)
    d /= tt.distance_step
    d -= tt.first_distance
    ok = (d.min((1, 2)) >= 0) & (d.max((1, 2)) <= nx - 1 - 1e-6) & (p.phase.min(1) >= 0)
    if not ok.all():
        d = np.where(ok[:, None, None], d, 0.0)
    place = d.astype(np.int64)
    d -= place
    place += np.maximum(p.phase, 0)[:, None] * nx
    (base, grows), (at, line, products) = tt.planes, tt.mix(z)
    w = 1 / (p.sigma * p.sigma)
    sw, root = w.sum(1, keepdims=True), np.sqrt(w)[:, None]
    t_s = p.t_s - (w * p.t_s).sum(1, keepdims=True) / sw  # the sums are the same for picks that are all moved
    wtt, weights = (w * t_s * t_s).sum(1), np.stack([w, w * t_s], 1)
    linear, square = np.empty((len(x), 2, len(at), x.shape[1])), np.zeros((len(x), 2 * len(at), x.shape[1]))
    part, t, before = dy, None, None
    for i, k in enumerate(at.tolist()):
        last, t = t, base[k].take(place)
        grows[k].take(place, out=part, mode="clip")
        part *= d
        t += part
        np.matmul(weights, t.transpose(0, 2, 1), out=linear[:, :, i])
        t *= root
        np.einsum("eij,eij->ei", t, t, out=square[:, i])
        if before == k - 1:
            np.einsum("eij,eij->ei", last, t, out=square[:, len(at) + i - 1])
        before = k
    r = linear[:, 0].transpose(0, 2, 1) @ line  # up to the sum of the picks' times, which is 0
    ok &= ~np.isnan(r.sum((1, 2)))
    chi2 = square.transpose(0, 2, 1) @ products
    linear[:, 1] *= -2
    chi2 += linear[:, 1].transpose(0, 2, 1) @ line
    chi2 += wtt[:, None, None]
    r *= r
    r /= sw[:, :, None]
    chi2 -= r
    bound = wtt[:, None] + square[:, : len(at)].max(1)
    return np.maximum(chi2, 0.0, out=chi2), bound[:, :, None] * (64 * (n + 8) * np.finfo(float).eps), ok


def column_sums(tt: PackedTimes, p: Picks, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``chi2``, a bound of its rounding and number of picks of the nodes (x, y) by z, as arrays of columns and depths.

    Between two depths of the table a time is a line in depth, so the sums over the picks are polynomials in
    depth: they are taken at the depths of the table, not at those of the nodes."""
    _, nz, nx = tt.t.shape
    chi2, bound, count = np.full((len(x), len(z)), np.nan), np.zeros((len(x), len(z))), np.zeros((len(x), len(z)), np.int64)
    known = p.phase >= 0
    phase, sx, sy, t_s, w = p.phase[known], p.sx[known], p.sy[known], p.t_s[known], 1 / (p.sigma[known] * p.sigma[known])
    deep = np.clip(z / tt.depth_step, tt.first_depth, tt.first_depth + nz - 1) - tt.first_depth
    low = np.minimum(np.floor(deep), nz - 2).astype(np.int64)
    if nz < 2 or not len(phase):
        return chi2, bound, count
    d = np.hypot(x[:, None] - sx, y[:, None] - sy) / tt.distance_step - tt.first_distance
    ix = np.floor(d).astype(np.int64)
    off, f = (ix < 0) | (ix > nx - 2), d - ix
    ix = np.clip(ix, 0, max(nx - 2, 0))
    right = np.minimum(ix + 1, nx - 1)
    flat, place = tt.t.transpose(1, 0, 2).reshape(nz, -1), phase * nx + ix
    place_right, gaps = phase * nx + right, off.any()
    at, weighed = {}, {}
    for k in np.unique(np.concatenate([low, low + 1])).tolist():
        at[k] = t_s - (flat[k].take(place) * (1 - f) + flat[k].take(place_right) * f)
        if gaps:
            at[k][off] = np.nan
        weighed[k] = at[k] * w
    for k in np.unique(low).tolist():
        a, b, wa, wb, here = at[k], at[k + 1], weighed[k], weighed[k + 1], np.flatnonzero(low == k)
        sa, sb, sw, n = wa.sum(1)[:, None], wb.sum(1)[:, None], w.sum(), len(w)
        if np.isnan(sa).any() or np.isnan(sb).any():  # picks without a time
            on = ~(np.isnan(a) | np.isnan(b))
            a, b, wa, wb = (np.where(on, v, 0.0) for v in (a, b, wa, wb))
            sa, sb, sw, n = wa.sum(1)[:, None], wb.sum(1)[:, None], np.where(on, w, 0.0).sum(1)[:, None], on.sum(1)[:, None]
        aa, ab, bb = (np.einsum("ij,ij->i", u, v)[:, None] for u, v in ((wa, a), (wa, b), (wb, b)))
        h = deep[here] - k
        wr, wrr = sa * (1 - h) + sb * h, aa * (1 - h) ** 2 + 2 * ab * h * (1 - h) + bb * h**2
        with np.errstate(divide="ignore", invalid="ignore"):
            chi2[:, here] = np.maximum(wrr - wr * wr / sw, 0.0)
        bound[:, here] = np.maximum(aa, bb)
        count[:, here] = n
    return chi2, bound * (64 * (len(t_s) + 8) * np.finfo(float).eps), count


def _columns(tt: PackedTimes, p: Picks, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = max(1, COLUMNS // max(1, len(p.phase) * (tt.t.shape[1] + 6)))
    parts = [column_sums(tt, p, x[i : i + size], y[i : i + size], z) for i in range(0, len(x), size)]
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def best_node(tt: PackedTimes, p: Picks, cx: float, cy: float, half: float, step: float, depth_max: float, dz: float, least: int) -> tuple[np.ndarray | None, int]:
    """The node (x, y, z, t0, chi2, n) of least ``chi2``, then z, x, y, and how many nodes were scored one by one.

    ``column_sums`` gives ``chi2`` of all of them up to rounding; those that rounding leaves beside the least are scored pick by pick."""
    dx, dy, z = offsets(half, step, depth_max, dz)
    x, y = cx + dx, cy + dy
    chi2, bound, count = (v.ravel() for v in _columns(tt, p, x, y, z))
    ok = count >= max(least, 1)
    if not ok.any():
        return None, 0
    at = np.flatnonzero(ok & (chi2 - bound <= (chi2 + bound)[ok].min()))
    column, deep = np.divmod(at, len(z))
    nodes = np.stack([x[column], y[column], z[deep]], 1)
    t0, exact, n = scores(tt, p, nodes)
    best = np.lexsort((nodes[:, 1], nodes[:, 0], nodes[:, 2], exact))[0]
    return np.array([*nodes[best], t0[best], exact[best], n[best]]), len(at)


def spreads(chi2: np.ndarray, on: np.ndarray, dx: np.ndarray, dy: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``sigma_z, h_major, h_minor, h_azimuth`` of each event from ``chi2`` by event, column and depth, of the nodes that are ``on``."""
    chi2 = np.where(on, chi2, np.inf)
    w = np.exp(-(chi2 - chi2.min((1, 2), keepdims=True)) / 2)
    column, deep = w.sum(2), w.sum(1)
    total = column.sum(1, keepdims=True)
    dx, dy, z = (v - (u * v).sum(1, keepdims=True) / total for u, v in ((column, dx), (column, dy), (deep, z)))
    xx, yy, xy, zz = ((u * v).sum(1) / total[:, 0] for u, v in ((column, dx * dx), (column, dy * dy), (column, dx * dy), (deep, z * z)))
    half, diff = (xx + yy) / 2, (xx - yy) / 2
    root = np.sqrt(diff * diff + xy * xy)
    azimuth = (90 - np.degrees(0.5 * np.arctan2(2 * xy, xx - yy))) % 180
    return np.stack([np.sqrt(zz), np.sqrt(np.maximum(half + root, 0.0) * CHI), np.sqrt(np.maximum(half - root, 0.0) * CHI), azimuth], 1)


def posterior(tt: PackedTimes, p: Picks, x: float, y: float, step: float, depth_max: float, dz: float, least: int) -> list[float | None]:
    """``sigma_z, h_major, h_minor, h_azimuth`` from the nodes around."""
    dx, dy, z = offsets(4 * step, step, depth_max, dz)
    chi2, _, n = _columns(tt, p, x + dx, y + dy, z)
    on = n >= max(least, 1)
    return spreads(chi2[None], on[None], dx, dy, z)[0].tolist() if on.any() else [None] * 4


TOGETHER = 30_000  # of columns and picks of events that are summed together


def best_nodes(tt: PackedTimes, p: Picks, half: float, passes: tuple, depth_max: float, least: int, spread: bool) -> list[list | None]:
    """For events of equally many picks, a row each of ``p``: x, y, z, t0, chi2 and n of ``best_node`` pass after pass, from the mean of the stations, with
    ``spread`` also ``posterior``'s; none where no node has picks enough. Events with picks that lack a time somewhere go through these one by one."""
    n, of = p.phase.shape[1], lambda rows: Picks(*(getattr(p, c)[rows] for c in ("phase", "sx", "sy", "t_s", "sigma")))
    if n < max(least, 1):
        return [None] * len(p.phase)
    ok, cx, cy, first = np.ones(len(p.phase), bool), p.sx.mean(1), p.sy.mean(1), half
    best = np.zeros((len(ok), 6))
    for number, (step, dz) in enumerate(passes, 1):
        dx, dy, z = offsets(half, step, depth_max, dz)
        z = tt.reached(z)
        ok &= len(z) > 0
        size = max(1, TOGETHER // (n * len(dx)))
        event, nodes = [], []
        rows = np.flatnonzero(ok)
        for k in range(0, len(rows), size):
            some = rows[k : k + size]
            x, y = cx[some, None] + dx, cy[some, None] + dy
            chi2, bound, good = whole_sums(tt, of(some), x, y, z)
            ok[some[~good]] = False
            i, column, deep = np.nonzero(chi2 - bound <= (chi2 + bound).min((1, 2), keepdims=True))
            event.append(some[i])
            nodes.append(np.stack([x[i, column], y[i, column], z[deep]], 1))
        if not ok.any():
            break
        event, nodes = np.concatenate(event), np.concatenate(nodes)
        on = ok[event]
        event, nodes = event[on], nodes[on]
        exact, t0, count = np.zeros(len(event)), np.zeros(len(event)), np.full(len(event), n)
        # a node alone beside the least needs no score but in the end
        score = np.flatnonzero(np.bincount(event)[event] > 1) if number < len(passes) else np.arange(len(event))
        for k in range(0, len(score), 1_000):
            k = score[k : k + 1_000]
            t0[k], exact[k], count[k] = scores(tt, of(event[k]), nodes[k])
        order = np.lexsort((nodes[:, 1], nodes[:, 0], nodes[:, 2], exact, event))
        order = order[np.flatnonzero(np.diff(event[order], prepend=-1))]
        best[event[order]] = np.column_stack([nodes[order], t0[order], exact[order], count[order]])
        cx, cy, half = best[:, 0], best[:, 1], 2 * step
    more, step = np.zeros((len(ok), 4 if spread else 0)), passes[-1][0] / 2
    rows, (dx, dy, z) = np.flatnonzero(ok), offsets(4 * step, step, depth_max, tt.depth_step)
    z = tt.reached(z)
    ok &= len(z) > 0 or not spread
    size = max(1, TOGETHER // (n * len(dx)))
    for k in range(0, len(rows) if spread and len(z) else 0, size):
        some = rows[k : k + size]
        chi2, _, good = whole_sums(tt, of(some), cx[some, None] + dx, cy[some, None] + dy, z)
        ok[some[~good]] = False
        if good.any():
            more[some[good]] = spreads(chi2[good], np.ones_like(chi2[good], bool), dx, dy, z)
    out = [[*b[:5], n, *m] for b, m in zip(best.tolist(), more.tolist(), strict=True)]
    for k in np.flatnonzero(~ok).tolist():
        one, half = of(k), first
        x, y = one.sx.mean(), one.sy.mean()
        for step, dz in passes:
            found, _ = best_node(tt, one, x, y, half, step, depth_max, dz, least)
            if found is None:
                break
            x, y, half = found[0], found[1], 2 * step
        out[k] = None if found is None else [*found[:5].tolist(), int(found[5]), *(posterior(tt, one, x, y, passes[-1][0] / 2, depth_max, tt.depth_step, least) if spread else [])]
    return out


def by_event(task: Callable[[dict[str, np.ndarray]], list[list | None]], names: list[str], types: list[pa.DataType]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs ``task`` over rows sorted by ``event_id``, with the columns of events of equally many rows, a row for each event, and gives what it
    returns for each, none for none. One event at most waits for the end of its batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def done(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
            begin = np.flatnonzero(np.diff(pd.factorize(rows["event_id"], use_na_sentinel=False)[0], prepend=-1))
            size, columns, out = np.diff(begin, append=len(rows)), {c: rows[c].to_numpy() for c in rows.columns}, []
            for n in np.unique(size).tolist():
                at = begin[size == n, None] + np.arange(n)
                found = task({c: v[at] for c, v in columns.items() if c != "event_id"})
                out += [(event, *r) for event, r in zip(columns["event_id"][at[:, 0]].tolist(), found, strict=True) if r is not None]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for batch in batches:
            rows = batch.to_pandas()
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if rows.empty:
                continue
            last = rows["event_id"].isna() if pd.isna(rows["event_id"].iloc[-1]) else rows["event_id"] == rows["event_id"].iloc[-1]
            held, whole = rows[last], rows[~last]
            if len(whole):
                yield from done(whole)
        if held is not None and len(held):
            yield from done(held)

    return run


def locate(picks: DataFrame, tt: PackedTimes, half_km: float, passes: tuple, depth_max: float, least: int = 4, spread: bool = False) -> DataFrame:
    """``(event_id, x, y, z, t0, chi2, n)``, coarse to fine around the best node of the pass before, from the mean of the stations;
    with ``spread`` also ``sigma_z, h_major, h_minor, h_azimuth``. ``picks(event_id, phase, sx, sy, t_s, sigma)``; those without a time go.

    An event's picks meet in one task, with the packed table; what is held is a pass's nodes times the picks of one event, or of a few small ones."""
    def task(rows: dict[str, np.ndarray]) -> list[list | None]:
        phase = tt.number(rows["phase"].ravel()).reshape(rows["phase"].shape)
        return best_nodes(tt, Picks(phase, *(rows[c].astype(float) for c in ("sx", "sy", "t_s", "sigma"))), half_km, passes, depth_max, least, spread)

    wanted = picks.select("event_id", "phase", "sx", "sy", "t_s", "sigma").where("t_s is not null and not isnan(t_s)")
    names = ["event_id", "x", "y", "z", "t0", "chi2", "n"] + (["sigma_z", "h_major", "h_minor", "h_azimuth"] if spread else [])
    kind = picks.schema["event_id"].dataType.simpleString()
    types = [pa.int64() if kind == "bigint" else pa.string(), *[pa.float64()] * 5, pa.int64(), *[pa.float64()] * (4 if spread else 0)]
    if kind not in ("bigint", "string"):
        raise ValueError(f"event ids are longs or strings, not {kind}")
    schema = ", ".join(f"{n} {'bigint' if n == 'n' else kind if n == 'event_id' else 'double'}" for n in names)
    # a number, so that few bytes are not put together into few tasks: an event's search costs more than its bytes tell
    many = int(picks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(many, "event_id").sortWithinPartitions("event_id", "t_s", "sx", "sy", "phase").mapInArrow(by_event(task, names, types), schema)


def score_nodes(picks: DataFrame, nodes: DataFrame, tt: PackedTimes, least: int) -> DataFrame:
    """``(event_id, x, y, z, t0, chi2, n)``, see ``location.score_nodes``."""
    # a number, as in ``locate``: an event's nodes cost more than its bytes tell
    many = int(picks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = picks.where("t_s is not null and sigma is not null").repartition(many, "event_id").groupBy("event_id").agg(F.collect_list(F.struct("phase", "sx", "sy", "t_s", "sigma")).alias("picks"))
    where = nodes.repartition(many, "event_id").groupBy("event_id").agg(F.collect_list(F.struct("x", "y", "z")).alias("nodes"))
    of = nodes.schema["event_id"]
    schema = f"event_id {of.dataType.simpleString()}, x double, y double, z double, t0 double, chi2 double, n long"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, at = batch.column("picks"), batch.column("nodes")
            phase = tt.number(p.flatten().field("phase").to_pylist())
            sx, sy, t_s, sigma = (p.flatten().field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("sx", "sy", "t_s", "sigma"))
            xyz = np.stack([at.flatten().field(c).to_numpy(zero_copy_only=False).astype(float) for c in "xyz"], 1)
            begin, first = (x.offsets.to_numpy() - x.offsets[0].as_py() for x in (p, at))
            t0, chi2, n = np.full(len(xyz), np.nan), np.full(len(xyz), np.nan), np.zeros(len(xyz), np.int64)
            for a, b, c, d in zip(begin[:-1].tolist(), begin[1:].tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                step = max(1, COLUMNS // max(1, b - a))
                for k in range(c, d, step):
                    k = slice(k, min(k + step, d))
                    t0[k], chi2[k], n[k] = scores(tt, Picks(phase[a:b], sx[a:b], sy[a:b], t_s[a:b], sigma[a:b]), xyz[k])
            on = np.flatnonzero(n >= least)
            event = batch.column("event_id").take(pa.array(np.repeat(np.arange(len(p)), np.diff(first))[on]))
            yield pa.RecordBatch.from_arrays([event, *(pa.array(v[on]) for v in (*xyz.T, t0, chi2, n))], ["event_id", "x", "y", "z", "t0", "chi2", "n"])

    return where.join(wanted, "event_id").select("event_id", "picks", "nodes").mapInArrow(task, schema)


def with_times(rows: DataFrame, tt: PackedTimes) -> DataFrame:
    """``rows(phase, depth_km, distance_km, ...)`` with ``t`` (null where the table has none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phase = tt.number(batch.column("phase").to_pylist())
            depth, distance = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("depth_km", "distance_km"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tt(phase, depth, distance), from_pandas=True)], [*batch.schema.names, "t"])

    return rows.drop("t").mapInArrow(run, rows.drop("t").schema.add("t", "double"))


# --- association: greedy over nodes and origin times, block after block of time ---


class Cells:
    """Nodes in a tree of halved cells (by the widest side), with the least and greatest time of each station and phase in each."""

    LEAF = 16

    def __init__(self, nodes: np.ndarray, tt: PackedTimes):
        self.tt, self.order, self.cells = tt, np.arange(len(nodes)), []  # a cell: begin, end, children
        self._split(nodes, 0, len(nodes))
        self.nodes = nodes[self.order]
        self.times: dict[tuple, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _split(self, nodes: np.ndarray, a: int, b: int) -> int:
        number = len(self.cells)
        self.cells.append([a, b, ()])
        if b - a > self.LEAF:
            part = nodes[self.order[a:b]]
            axis = int(np.argmax(np.ptp(part, axis=0)))
            self.order[a:b] = self.order[a:b][np.argsort(part[:, axis], kind="stable")]
            mid = (a + b) // 2
            self.cells[number][2] = (self._split(nodes, a, mid), self._split(nodes, mid, b))
        return number

    def of(self, station: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Times of a station ``(phase, sx, sy)`` at all nodes, and the ends of its times in each cell (infinite where there are none)."""
        if station not in self.times:
            phase, sx, sy = station
            d = np.hypot(self.nodes[:, 0] - sx, self.nodes[:, 1] - sy)
            t = self.tt(np.full(len(d), phase), self.nodes[:, 2], d)
            low, high = np.where(np.isnan(t), np.inf, t), np.where(np.isnan(t), -np.inf, t)
            ends = np.array([(low[a:b].min(initial=np.inf), high[a:b].max(initial=-np.inf)) for a, b, _ in self.cells])
            self.times[station] = (t, ends[:, 0], ends[:, 1])
        return self.times[station]


@dataclass(frozen=True)
class Rule:
    window: float
    stations: int
    p: int
    s: int


def qualified_votes(cells: Cells, station_of: list[tuple], station: np.ndarray, is_p: np.ndarray, t_s: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Votes (node, double bin, pick, origin time) of the nodes and bins that may qualify, and how many nodes were looked at.

    From the root down, a cell is left when no bin of it can have picks enough, each pick counting for all
    bins that its origin times in the cell touch."""
    keys = [cells.of(x) for x in station_of]
    low, high = (np.stack([k[e] for k in keys]) if keys else np.zeros((0, len(cells.cells))) for e in (1, 2))
    stack, leaves = [0], []
    while stack:
        number = stack.pop()
        a, b, children = cells.cells[number]
        on = np.flatnonzero(low[:, number] <= high[:, number])
        first = np.concatenate([np.floor((t_s[on] - high[on, number]) / rule.window + h).astype(np.int64) for h in (0.0, 0.5)]) if len(on) else np.zeros(0, np.int64)
        last = np.concatenate([np.floor((t_s[on] - low[on, number]) / rule.window + h).astype(np.int64) for h in (0.0, 0.5)]) if len(on) else first
        if not len(first):
            continue
        base, half = first.min(), np.repeat([0, 1], len(on))
        size = int(last.max() - base + 2)
        counts = np.zeros((2, 2, size), np.int64)  # half, P or S, bin
        for at, sign in ((first - base, 1), (last - base + 1, -1)):
            np.add.at(counts, (half, np.tile(np.where(is_p[on], 0, 1), 2), at), sign)
        counts = counts.cumsum(2)
        if ((counts[:, 0] >= rule.p) & (counts[:, 1] >= rule.s) & (counts.sum(1) >= rule.stations)).any():
            if children:
                stack.extend(children)
            else:
                leaves.append(np.arange(a, b))
    out, none = [], np.zeros(0, np.int64)
    step = max(1, VOTES // max(1, len(keys) * Cells.LEAF))
    for k in range(0, len(leaves), step):
        looked = np.concatenate(leaves[k : k + step])
        origin = t_s[None, :] - np.stack([x[0][looked] for x in keys], 1)
        node, pick = np.nonzero(~np.isnan(origin))
        origin = origin[node, pick]
        node, pick, origin = np.tile(looked[node], 2), np.tile(pick, 2), np.tile(origin, 2)
        half = np.repeat([0, 1], len(origin) // 2)
        bins = np.floor(origin / rule.window + half / 2).astype(np.int64) * 2 + half
        order = np.lexsort((pick, station[pick], bins, node))
        node, bins, pick, origin = node[order], bins[order], pick[order], origin[order]
        cand = np.cumsum(np.append(0, (np.diff(node) != 0) | (np.diff(bins) != 0))) if len(node) else none
        p = np.bincount(cand, weights=is_p[pick]) if len(node) else none
        enough = (p >= rule.p) & (np.bincount(cand) - p >= rule.s) & (np.bincount(cand) >= rule.stations) if len(node) else none.astype(bool)
        on = enough[cand]
        out.append((node[on], bins[on], pick[on], origin[on]))
    if not out:
        return none, none, none, np.zeros(0), 0
    return *(np.concatenate(x) for x in zip(*out, strict=True)), sum(map(len, leaves))


def settle(cells: Cells, picks: pd.DataFrame, start: float, stop: float, rule: Rule) -> tuple[list[tuple], bool]:
    """Events ``(t0, node, picks)`` of one block of origin times, best first, and whether it has some that are not decided.

    A candidate whose origin time is outside the block is another block's to decide; until then its picks are contested, and so
    are those of each candidate that has a contested pick. Every candidate that has only free picks and comes first is an event."""
    phase = cells.tt.number(picks["phase"])
    stations, station = np.unique(picks["station"].to_numpy(str), return_inverse=True)
    keys = list(zip(phase.tolist(), picks["sx"].tolist(), picks["sy"].tolist(), strict=True))
    t_s, is_p = picks["t_s"].to_numpy(float), picks["phase"].to_numpy(str) == "P"
    node, bins, pick, origin, _ = qualified_votes(cells, keys, station, is_p, t_s, rule)
    if not len(node):
        return [], False
    order = np.lexsort((pick, station[pick], bins, node))
    node, bins, pick, origin = node[order], bins[order], pick[order], origin[order]
    cand = np.cumsum(np.append(0, (np.diff(node) != 0) | (np.diff(bins) != 0)))
    of_node = node[np.flatnonzero(np.append(True, np.diff(cand) != 0))]
    place = np.empty(len(cells.nodes), np.int64)
    place[np.lexsort((cells.nodes[:, 2], cells.nodes[:, 1], cells.nodes[:, 0]))] = np.arange(len(cells.nodes))
    free, contested, events = np.ones(len(picks), bool), np.zeros(len(picks), bool), []
    size = int(cand[-1]) + 1
    begin = np.searchsorted(cand, np.arange(size + 1))
    by_pick = np.argsort(pick, kind="stable")
    of_pick = np.searchsorted(pick[by_pick], np.arange(len(picks) + 1))
    waiting, version, means = np.ones(size, bool), np.zeros(size, np.int64), np.zeros(size)

    def ranked(these: np.ndarray) -> list[tuple]:
        """The candidates of ``these`` that still qualify, counted anew from their free picks, in order of rank."""
        n = begin[these + 1] - begin[these]
        at = np.arange(n.sum()) + np.repeat(begin[these] - np.append(0, np.cumsum(n)[:-1]), n)
        c = np.repeat(np.arange(len(these)), n)
        on = free[pick[at]]
        c, at = c[on], at[on]
        st, o, k = station[pick[at]], origin[at], len(these)
        count = np.bincount(c, minlength=k)
        p = np.bincount(c, weights=is_p[pick[at]], minlength=k).astype(np.int64)
        new = np.append(True, (np.diff(c) != 0) | (np.diff(st) != 0)) if len(c) else np.zeros(0, bool)
        distinct = np.bincount(c[new], minlength=k)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.bincount(c, weights=o, minlength=k) / count
            spread = np.sqrt(np.bincount(c, weights=(o - mean[c]) ** 2, minlength=k) / count)
        version[these] += 1
        means[these] = mean
        waiting[these] = ok = (distinct >= rule.stations) & (p >= rule.p) & (count - p >= rule.s)
        these, mean, spread, count = these[ok], np.round(mean[ok], 6), np.round(spread[ok], 6), count[ok]
        where = place[of_node[these]]
        rank = np.lexsort((where, mean, spread, -count))
        return list(zip(*(x[rank].tolist() for x in (-count, spread, mean, where, these, version[these])), strict=True))

    undecided, queue = False, ranked(np.arange(size))
    while queue:
        *_, best, told = heappop(queue)
        if not waiting[best] or told != version[best]:
            continue
        waiting[best] = False
        members = pick[begin[best] : begin[best + 1]]
        members = np.unique(members[free[members]])
        own = start <= means[best] < stop
        if contested[members].any() or not own:
            contested[members] = True
            undecided |= own
            continue
        events.append((float(means[best]), int(of_node[best]), members))
        free[members] = False
        # only candidates that lost a pick are counted and ranked again
        touched = np.unique(cand[np.concatenate([by_pick[of_pick[m] : of_pick[m + 1]] for m in members.tolist()])])
        for again in ranked(touched[waiting[touched]]):
            heappush(queue, again)
    return events, undecided


def associate(picks: DataFrame, nodes: DataFrame, tt: PackedTimes, rule: Rule, blocks: int = 16) -> DataFrame:
    """``(event, t0, x, y, z, pick_id)``, see ``location.associate``."""
    spark = picks.sparkSession
    if nodes.limit(MOST_NODES + 1).count() > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    places = np.array([[r["x"], r["y"], r["z"]] for r in nodes.select("x", "y", "z").collect()], float).reshape(-1, 3)
    kind = picks.schema["pick_id"].dataType.simpleString()
    schema = f"block long, event {kind}, t0 double, x double, y double, z double, pick_id {kind}"
    longest = float(np.nanmax(tt.t)) if np.isfinite(tt.t).any() else 0.0
    alike = longest + 2 * rule.window  # origin times of candidates that share a pick are closer
    length = blocks * alike
    held: dict[int, Cells] = {}

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        if 0 not in held:
            held[0] = Cells(places, tt)
        cells, block = held[0], int(rows["block"].iloc[0])
        rows = rows.sort_values(["t_s", "pick_id"], kind="stable").reset_index(drop=True)
        events, undecided = settle(cells, rows, block * length, (block + 1) * length, rule)
        out = []
        for t0, node, members in events:
            ids = rows["pick_id"].iloc[members].tolist()
            out += [(block, min(ids), t0, *cells.nodes[node], i) for i in ids]
        if undecided:
            out.append((block, None, None, None, None, None, None))
        return pd.DataFrame(out, columns=["block", "event", "t0", "x", "y", "z", "pick_id"])

    low, high = F.floor((F.col("t_s") - 2 * longest - 3 * rule.window) / length), F.floor((F.col("t_s") + longest + 3 * rule.window) / length)
    rest = picks.select("pick_id", "station", "phase", "sx", "sy", F.col("t_s").cast("double").alias("t_s")).where("t_s is not null").withColumn("block", F.explode(F.sequence(low, high)))
    found = spark.createDataFrame([], schema)
    while True:
        done = rest.groupBy("block").applyInPandas(task, schema).checkpoint()
        now = done.where("pick_id is not null")
        found = found.unionAll(now)
        again = done.where("pick_id is null").select("block")
        if again.isEmpty():
            return found.drop("block")
        rest = rest.join(again, "block", "left_semi").join(now.select("pick_id"), "pick_id", "left_anti").checkpoint()
