"""Travel times, grid-search location and association as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import LAYERS
from . import search

SLOWNESSES, SAFETY = 800, 0.9999
#: Rows of a travel-time table up to which it is broadcast.
TABLE_ROWS = 500_000
#: Horizontal and depth step in km of each pass of the search.
PASSES = ((8.0, 4.0), (2.0, 2.0), (0.5, 0.5))


def build_tt(depths: DataFrame, distances: DataFrame, receiver_km: float = 0.0, layers=LAYERS, samples: int = SLOWNESSES) -> DataFrame:
    """``(phase, depth_km, distance_km, t)``: direct rays through flat layers.

    For each depth, rays of ``samples`` slownesses from 0 to that of the fastest layer crossed give distance and time; a
    distance takes the time on the line between its neighbours, none (null) beyond the reach.
    """
    spark = depths.sparkSession
    table = []
    for i, (top, vp, vs) in enumerate(layers):
        bottom = layers[i + 1][0] if i + 1 < len(layers) else 1e9
        table += [("P", -1e9 if i == 0 else top, bottom, vp), ("S", -1e9 if i == 0 else top, bottom, vs)]
    model = F.broadcast(spark.createDataFrame(table, "phase string, top double, bottom double, v double"))
    lo, hi = F.least("depth_km", F.lit(receiver_km)), F.greatest("depth_km", F.lit(receiver_km))
    thick = F.least("bottom", hi) - F.greatest("top", lo)
    flat = (F.col("depth_km") == receiver_km) & (F.col("top") <= F.col("depth_km")) & (F.col("depth_km") < F.col("bottom"))
    parts = depths.select("depth_km").distinct().join(model, ((F.col("top") < hi) & (F.col("bottom") > lo)) | flat)
    parts = parts.withColumn("dz", F.greatest(thick, F.lit(0.0)))
    fastest = parts.groupBy("phase", "depth_km").agg((F.lit(SAFETY) / F.max("v")).alias("p_max"))
    u = F.col("i") / float(samples - 1)
    rays = fastest.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))).withColumn("p", F.col("p_max") * F.pow(u, F.lit(1.5)))
    pv = F.col("p") * F.col("v")
    cos = F.sqrt(1 - pv * pv)
    rays = rays.join(parts, ["phase", "depth_km"]).groupBy("phase", "depth_km", "i").agg(F.sum(F.col("dz") * pv / cos).alias("x"), F.sum(F.col("dz") / (F.col("v") * cos)).alias("t"))
    w = Window.partitionBy("phase", "depth_km").orderBy("i")
    rays = rays.withColumns({"x2": F.lead("x").over(w), "t2": F.lead("t").over(w)})
    want = distances.select("distance_km").distinct()
    grid = fastest.select("phase", "depth_km").join(want)
    hit = grid.join(rays.where("x2 is not null"), ["phase", "depth_km"]).where("distance_km >= x and (distance_km < x2 or distance_km = x2)")
    line = F.col("t") + (F.col("t2") - F.col("t")) * F.when(F.col("x2") > F.col("x"), (F.col("distance_km") - F.col("x")) / (F.col("x2") - F.col("x"))).otherwise(0.0)
    found = hit.groupBy("phase", "depth_km", "distance_km").agg(F.min(line).alias("t"))
    return grid.join(found, ["phase", "depth_km", "distance_km"], "left")


def tt_lookup(df: DataFrame, tt: DataFrame, depth_step: float, distance_step: float) -> DataFrame:
    """``df(phase, depth_km, distance_km)`` with ``t`` between the four corners of an even table; the depth is
    clamped to the table, a missing corner or a distance beyond it gives null."""
    table = tt.select("phase", F.round(F.col("depth_km") / depth_step).cast("int").alias("iz"), F.round(F.col("distance_km") / distance_step).cast("int").alias("ix"), "t")
    ends = F.broadcast(table.agg(F.min("iz").alias("z0"), F.max("iz").alias("z1")))
    z = F.greatest(F.least(F.col("depth_km") / depth_step, F.col("z1").cast("double")), F.col("z0").cast("double"))
    rows = df.join(ends).withColumns({"z_": z, "x_": F.col("distance_km") / distance_step})
    rows = rows.withColumns({"iz_": F.least(F.floor("z_"), F.col("z1") - 1).cast("int"), "ix_": F.floor("x_").cast("int")})
    hinted = F.broadcast if table.limit(TABLE_ROWS + 1).count() <= TABLE_ROWS else lambda df: df
    for a in (0, 1):
        for b in (0, 1):
            corner = hinted(table.select(F.col("phase").alias("ph_"), F.col("iz").alias("cz_"), F.col("ix").alias("cx_"), F.col("t").alias(f"t{a}{b}")))
            on = (F.col("phase") == F.col("ph_")) & (F.col("iz_") + a == F.col("cz_")) & (F.col("ix_") + b == F.col("cx_"))
            rows = rows.join(corner, on, "left").drop("ph_", "cz_", "cx_")
    fz, fx = F.col("z_") - F.col("iz_"), F.col("x_") - F.col("ix_")
    t = (F.col("t00") * (1 - fx) + F.col("t01") * fx) * (1 - fz) + (F.col("t10") * (1 - fx) + F.col("t11") * fx) * fz
    return rows.withColumn("t", t).drop("z0", "z1", "z_", "x_", "iz_", "ix_", "t00", "t01", "t10", "t11")


def grid_nodes(events: DataFrame, half_km: float, step_km: float, depth_min: float, depth_max: float, depth_step: float) -> DataFrame:
    """Nodes around each event's centre ``(event_id, cx, cy, cz)``; ``cz`` null spans all depths."""
    n, m = round(half_km / step_km), round((depth_max - depth_min) / depth_step)
    side = F.sequence(F.lit(-n), F.lit(n))
    rows = events.withColumn("i", F.explode(side)).withColumn("j", F.explode(side)).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(m))))
    return rows.select("event_id", (F.col("cx") + F.col("i") * step_km).alias("x"), (F.col("cy") + F.col("j") * step_km).alias("y"), (F.lit(depth_min) + F.col("k") * depth_step).alias("z"))


def score_nodes(picks: DataFrame, nodes: DataFrame, tt: DataFrame, depth_step: float, distance_step: float, min_picks: int = 4) -> DataFrame:
    """``(event_id, x, y, z, t0, chi2, n)`` of every node with enough picks: the origin time is solved in closed
    form, so one pass of sums scores a node. ``picks(event_id, phase, sx, sy, t_s, sigma)``; those without a time go.

    Pairs of nodes and picks are never rows: an event's nodes and picks are a row each, which meet, and the table goes to the tasks as one array."""
    return search.score_nodes(picks, nodes, search.PackedTimes.of(tt, depth_step, distance_step), max(min_picks, 4))


def locate(picks: DataFrame, tt: DataFrame, depth_step: float, distance_step: float, half_km: float = 40.0, passes=PASSES, depth_max: float = 20.0, spread: bool = False) -> DataFrame:
    """Coarse to fine: each pass searches around the best node of the one before, from the mean
    of the picking stations. Returns ``(event_id, x, y, z, t0, chi2, n)``, the best node of each event, with ``spread`` also its
    ``sigma_z, h_major, h_minor, h_azimuth``.

    The nodes are never rows: the table goes to the tasks as one array, an event's picks meet in a task, and what a node's picks sum up to comes from sums at the depths of the table."""
    return search.locate(picks, search.PackedTimes.of(tt, depth_step, distance_step), half_km, passes, depth_max, 4, spread)


def residuals(picks: DataFrame, located: DataFrame, tt: DataFrame, depth_step: float, distance_step: float) -> DataFrame:
    rows = picks.join(located.select("event_id", "x", "y", "z", "t0"), "event_id")
    d = F.hypot(F.col("x") - F.col("sx"), F.col("y") - F.col("sy"))
    rows = rows.withColumns({"distance_km": d, "depth_km": F.col("z")})
    rows = search.with_times(rows, search.PackedTimes.of(tt, depth_step, distance_step)).where("t is not null")
    return rows.withColumn("residual_s", F.col("t_s") - F.col("t0") - F.col("t")).drop("depth_km", "distance_km", "t")


def uncertainty(scored: DataFrame) -> DataFrame:
    """Posterior covariance, depth sigma and the 95 % horizontal ellipse of each event from its scored nodes."""
    best = F.min("chi2").over(Window.partitionBy("event_id"))
    rows = scored.select("event_id", "x", "y", "z", "chi2").withColumn("w", F.exp(-(F.col("chi2") - best) / 2))
    m = {c: (F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"m{c}") for c in "xyz"}
    two = {a + b: (F.sum(F.col("w") * F.col(a) * F.col(b)) / F.sum("w")).alias(f"m{a}{b}") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")}
    s = rows.groupBy("event_id").agg(*m.values(), *two.values())
    cov = {ab: F.col(f"m{ab}") - F.col(f"m{ab[0]}") * F.col(f"m{ab[1]}") for ab in two}
    half, diff = (cov["xx"] + cov["yy"]) / 2, (cov["xx"] - cov["yy"]) / 2
    root = F.sqrt(diff * diff + cov["xy"] * cov["xy"])
    chi = 5.9915
    azimuth = F.pmod(90 - F.degrees(0.5 * F.atan2(2 * cov["xy"], cov["xx"] - cov["yy"])), F.lit(180.0))
    return s.select(
        "event_id", *[v.alias(f"cov_{k}") for k, v in cov.items()], F.sqrt(F.greatest(cov["zz"], F.lit(0.0))).alias("sigma_z"),
        F.sqrt(F.greatest(half + root, F.lit(0.0)) * chi).alias("h_major"), F.sqrt(F.greatest(half - root, F.lit(0.0)) * chi).alias("h_minor"), azimuth.alias("h_azimuth"),
    )


def compare_locations(a: DataFrame, b: DataFrame) -> DataFrame:
    """Horizontal and depth offsets of events located twice."""
    rows = a.select("event_id", *[F.col(c).alias(f"{c}_a") for c in ("latitude", "longitude", "depth_km")]).join(
        b.select("event_id", *[F.col(c).alias(f"{c}_b") for c in ("latitude", "longitude", "depth_km")]), "event_id"
    )
    dy = (F.col("latitude_b") - F.col("latitude_a")) * 111.32
    dx = (F.col("longitude_b") - F.col("longitude_a")) * 111.32 * F.cos(F.radians((F.col("latitude_a") + F.col("latitude_b")) / 2))
    return rows.select("event_id", F.hypot(dx, dy).alias("offset_km"), (F.col("depth_km_b") - F.col("depth_km_a")).alias("depth_offset_km"))


def associate(picks: DataFrame, nodes: DataFrame, tt: DataFrame, depth_step: float, distance_step: float, window_s: float = 1.5, least_stations: int = 3, least_p: int = 3, least_s: int = 1) -> DataFrame:
    """``(event, t0, x, y, z, pick_id)``: back-projection votes in place of a mixture model; ``event`` is its least pick id.

    Every pick votes at every node (``x, y, z``) for the origin time ``t_s - t``, in two half-shifted bins. The node and bin with
    most picks (then the least spread, the earliest time, the first node) is an event and takes its picks, the rest vote again, until no
    node and bin has votes enough. Picks without a time go.

    Time is cut into blocks, which see the picks beyond their edges that could matter, and a block decides all of its events that no
    undecided one of another block could take a pick from; what is left goes into a further round. Within a block nodes are
    halved into cells, and a cell where no bin can have enough votes is left out whole."""
    return search.associate(picks, nodes, search.PackedTimes.of(tt, depth_step, distance_step), search.Rule(window_s, least_stations, least_p, least_s))
