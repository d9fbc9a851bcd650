"""Sequence operators: ids, keepers, peaks, gaps, islands, decimation.

Series are keyed, so windows are partitioned; greedy steps run inside islands,
which are cut where neighbours are too far apart to matter to each other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import event_id_base


def free_numbers(rows: DataFrame, key: str, order: Sequence[str], used: DataFrame, number: str) -> DataFrame:
    """``rows`` with ``number``: in ``order``, each row of a ``key`` takes the first positive number that neither ``used(key, number)``
    nor a row before it has.

    The k-th free number is k plus the used numbers that have fewer than k free ones below them, so a running count over
    used numbers and rows together gives all, and nothing of a key is gathered in a row."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(number))
    below = used.select(key, number).where(F.col(number) >= 1).distinct().select(key, (F.col(number) - place).alias("k_"), F.lit(1).alias("used_"))
    fresh = rows.withColumns({"k_": F.row_number().over(Window.partitionBy(key).orderBy(*order)), "used_": F.lit(0)})
    before = Window.partitionBy(key).orderBy("k_", "used_").rowsBetween(Window.unboundedPreceding, 0)
    every = fresh.unionByName(below, allowMissingColumns=True).withColumn(number, F.col("k_") + F.sum("used_").over(before))
    return every.where("used_ = 0").drop("k_", "used_")


def mint_ids(df: DataFrame, prefix: str | Column, order: Sequence[str], taken: DataFrame | None = None) -> DataFrame:
    """``event_id`` from the time's second; ``-2``, ``-3``... where a row before it or ``taken(event_id)`` has the ones before."""
    rows = df.withColumn("base_", event_id_base(F.col("time"), prefix if isinstance(prefix, Column) else F.lit(prefix)))
    if taken is None:
        rows = rows.withColumn("n_", F.row_number().over(Window.partitionBy("base_").orderBy(*order)))
    else:
        base, n = (F.regexp_extract("event_id", r"^(.+?)(?:-(\d{1,9}))?$", i) for i in (1, 2))
        used = taken.select(base.alias("base_"), F.when(n == "", 1).otherwise(n.try_cast("int")).alias("n_"))
        rows = free_numbers(rows, "base_", order, used, "n_")
    return rows.withColumn("event_id", F.when(F.col("n_") == 1, F.col("base_")).otherwise(F.concat("base_", F.lit("-"), F.col("n_").cast("string")))).drop("base_", "n_")


def same_ids(df: DataFrame, column: str = "event_id") -> DataFrame:
    """Ids that occur more than once, with ``n``."""
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def unique_ids(df: DataFrame, what: str, column: str = "event_id") -> DataFrame:
    """``df``; an id that occurs twice is an error."""
    if twice := same_ids(df, column).first():
        raise ValueError(f"event id {twice[column]} occurs {twice['n']} times in {what}")
    return df


def keepers(groups: DataFrame) -> DataFrame:
    """The event of each ``root`` to keep: confirmed, then reviewed, then most picks, then the least id."""
    status = F.coalesce("review_status", F.lit(""))
    picks = F.col("num_picks").cast("double")
    rank = F.struct(status != "confirmed", status == "", picks.isNull(), -picks, "event_id")
    best = groups.groupBy("root").agg(F.min_by("event_id", rank).alias("keeper"))  # no group meets in one place
    return groups.join(best, "root")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key (the upsert of a log)."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("last_"))
    return best.select(*keys, "last_.*")


def local_peaks(df: DataFrame, key: str, idx: str, value: str, height: float | None = None, edge: str | None = "rising", valley: bool = False, threshold: float = 0.0) -> DataFrame:
    """Samples that are maxima of ``height`` at least, never the first or last sample, never beside a missing one.

    Of a plateau the ``rising`` or the ``falling`` edge counts, ``both``, or none (None). With ``valley`` minima of ``height`` at most. Both
    neighbours lie ``threshold`` lower at least."""
    w = Window.partitionBy(key).orderBy(idx)
    v = F.when(~F.isnan(value), -F.col(value) if valley else F.col(value))
    rows = df.withColumns({"v_": v, "before_": F.lag(v).over(w), "after_": F.lead(v).over(w)})
    v, before, after = F.col("v_"), F.col("before_"), F.col("after_")
    rising, falling = (v > before) & (v >= after), (v >= before) & (v > after)
    peak = {"rising": rising, "falling": falling, "both": rising | falling, None: rising & falling}[edge]
    if height is not None:
        peak &= v >= (-height if valley else height)
    if threshold > 0:
        peak &= F.least(v - before, v - after) >= threshold
    return rows.where(peak).drop("v_", "before_", "after_")


#: Blocks of a series are this many times as wide as the reach of their rows.
SPAN = 64
NONE = np.iinfo(np.int64).min


def _decide(block: int, size: float, least: float):
    """Decides the undecided rows of one block: kept if no row within ``least`` that is kept or may be comes before it."""

    def run(group: pd.DataFrame, ranks: list[str], also: str | None) -> pd.DataFrame:
        group = group.sort_values("at_", kind="stable")
        at, state = group["at_"].to_numpy(), group["state_"].to_numpy().copy()
        other = group[also].to_numpy() if also else None
        place = np.empty(len(group), np.int64)
        place[group.reset_index(drop=True).sort_values(ranks, kind="stable").index.to_numpy()] = np.arange(len(group))
        own = np.floor(at / size) == block
        low, high = np.searchsorted(at, at - least, "left"), np.searchsorted(at, at + least, "right")
        for i in np.argsort(place):
            if state[i] or not own[i]:
                continue
            near = np.arange(low[i], high[i])
            if other is not None:
                near = near[np.abs(other[near] - other[i]) <= least]
            if (state[near] == 1).any():
                state[i] = 2
            elif not ((state[near] == 0) & (place[near] < place[i])).any():
                state[i] = 1
        return group.assign(state_=state)[own]

    return run


def greedy_apart(df: DataFrame, keys: Sequence[str], at: str, rank: Sequence[Column], least: float, also: str | None = None) -> DataFrame:
    """The rows of each key taken in order of ``rank``, without those whose ``at`` (and ``also``) is within ``least`` of a taken row's.

    Rows without ``at`` go; null is a key like others. A key is cut into blocks ``SPAN`` times as wide as ``least``, which see the rows just beyond their edges, and a block decides all
    of its rows that no undecided row outside comes before; what is left goes into a further round. So no
    key and no chain of close rows meets in one group, and a round takes a chain on by a block at least.
    """
    size = float(max(least, 1) * SPAN)
    every = df.withColumn("row_", F.struct(*df.columns)).select(*keys, F.col(at).alias("at_"), *([F.col(also)] if also else []), *[r.alias(f"r{i}_") for i, r in enumerate(rank)], "row_")
    every = every.withColumns({"tie_": F.xxhash64("row_"), "id_": F.monotonically_increasing_id()}).checkpoint()
    ranks = [*[f"r{i}_" for i in range(len(rank))], "tie_", "id_"]
    work = every.drop("row_").withColumn("state_", F.lit(0)).where("at_ is not null")
    block = F.floor(F.col("at_") / size)
    around = F.array_distinct(F.array(F.floor((F.col("at_") - least) / size), block, F.floor((F.col("at_") + least) / size)))
    # rows without a neighbour stay, and are settled without Python
    order = Window.partitionBy(*[F.col(k) for k in keys], "block_").orderBy("at_")
    near = F.coalesce(F.col("at_") - F.lag("at_").over(order) <= least, F.lit(False)) | F.coalesce(F.lead("at_").over(order) - F.col("at_") <= least, F.lit(False))
    met = work.withColumn("block_", F.explode(around)).withColumn("near_", near).where(F.col("block_") == block).drop("block_").checkpoint()
    kept, work = met.where("not near_").select("id_"), met.where("near_").drop("near_")
    while True:
        rows = work.withColumn("block_", F.explode(around))

        def decide(group: pd.DataFrame) -> pd.DataFrame:
            return _decide(int(group["block_"].iloc[0]), size, least)(group, ranks, also)

        done = rows.groupBy(*[F.col(k) for k in keys], "block_").applyInPandas(decide, rows.schema).drop("block_").checkpoint()
        new = done.where("state_ = 1")
        kept = kept.unionAll(new.select("id_"))
        left = done.where("state_ = 0")
        if left.isEmpty():
            break
        # kept rows matter to the rest only where they are within reach of it
        edge = left.select(*keys, F.explode(around).alias("block_")).distinct()
        beside = new.withColumn("block_", F.explode(around)).alias("n_").join(edge.alias("e_"), [F.col(f"n_.{k}").eqNullSafe(F.col(f"e_.{k}")) for k in (*keys, "block_")], "left_semi")
        beside = beside.drop("block_").distinct()
        work = left.unionByName(beside).checkpoint()
    return every.join(kept.distinct(), "id_", "left_semi").select("row_.*")


def thin_peaks(peaks: DataFrame, keys: Sequence[str], at: str, height: str, least: float) -> DataFrame:
    """Of peaks at most ``least`` apart the higher (then the earlier) stays."""
    return greedy_apart(peaks, keys, at, [-F.col(height), F.col(at)], least)


def pick_amplitude(picks: DataFrame, samples: DataFrame, key: str, window: int) -> DataFrame:
    """Largest absolute sample from each pick to the end of its window or the next pick."""
    nxt = F.lead("idx").over(Window.partitionBy(key).orderBy("idx"))
    stop = F.least(F.col("idx") + window, F.coalesce(nxt, F.col("idx") + window))
    p = picks.withColumn("stop_", stop).select(key, F.col("idx").alias("pick_idx"), "stop_")
    p = p.withColumn("at_", F.explode(F.sequence(F.floor(F.col("pick_idx") / window), F.floor(F.col("stop_") / window))))
    s = samples.withColumn("at_", F.floor(F.col("idx") / window))
    inside = (F.col("idx") >= F.col("pick_idx")) & (F.col("idx") < F.col("stop_"))
    return p.join(s, [key, "at_"]).where(inside).groupBy(key, "pick_idx").agg(F.max(F.abs("value")).alias("amplitude"))


def gap_guard(df: DataFrame, key: str, idx: str, valid: str, guard: int) -> DataFrame:
    near = Window.partitionBy(key).orderBy(idx).rowsBetween(-guard, guard)
    return df.withColumn("guarded", F.min(F.col(valid).cast("int")).over(near) == 1)


def islands(df: DataFrame, key: str, idx: str, inside: Column) -> DataFrame:
    """``(key, first, last, n)`` of each run of rows for which ``inside`` holds."""
    w = Window.partitionBy(key).orderBy(idx)
    rows = df.select(key, idx, F.row_number().over(w).alias("all_"), inside.alias("in_")).where("in_")
    rows = rows.withColumn("run_", F.col("all_") - F.row_number().over(w))
    return rows.groupBy(key, "run_").agg(F.min(idx).alias("first"), F.max(idx).alias("last"), F.count("*").alias("n")).drop("run_")


def zero_runs(df: DataFrame, key: str, idx: str, value: str, least: int) -> DataFrame:
    return islands(df, key, idx, F.col(value) == 0).where(F.col("n") >= least)


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap: int) -> DataFrame:
    """``session``: rows of a key whose gaps are at most ``gap`` belong together; numbered by their first time."""
    w = Window.partitionBy(*keys).orderBy(time)
    first = F.when(F.coalesce(F.col(time) - F.lag(time).over(w) > gap, F.lit(True)), F.col(time))
    return df.withColumn("session", F.last(first, ignorenulls=True).over(w))


def anchored_clusters(df: DataFrame, time: str, width: int, span: int = 4 * SPAN) -> DataFrame:
    """``anchor``: a cluster begins at its first row and holds all within ``width`` of that row.

    The row after a cluster begins the next one, so each time has a link to the time that would follow it. Blocks of
    ``span`` widths follow the links to their edge; from the starts that gaps prove, the blocks' entries are found by
    joins that double their reach, and each block then walks from its entries. No session meets in one group.
    """
    size = span * width
    block = F.floor(F.col("t") / size)
    times = df.select(F.col(time).alias("t")).where("t is not null").distinct().checkpoint()
    beside = F.array(block, F.when(F.col("t") - block * size < 2 * width, block - 1), F.when((block + 1) * size - F.col("t") <= width, block + 1))

    def follow(t: np.ndarray) -> np.ndarray:
        """Place of the time that begins the next cluster, as many as there are if none is close enough to be of the session."""
        after = np.searchsorted(t, t + width, "right")
        far = np.append(t, np.iinfo(np.int64).max)[after] > t + 2 * width
        return np.where(far, len(t), after)

    def link(group: pd.DataFrame) -> pd.DataFrame:
        number, t = int(group["block"].iloc[0]), np.sort(group["t"].to_numpy())
        own, after = t // size == number, follow(t)
        jump = np.full(len(t), NONE)
        for i in range(len(t) - 1, -1, -1):
            n = after[i]
            if n < len(t):
                jump[i] = jump[n] if own[n] else t[n]
        start = np.concatenate([[True], np.diff(t) > width])
        return pd.DataFrame({"t": t, "jump": pd.array(jump, dtype="Int64"), "start": start}).replace({"jump": {NONE: pd.NA}})[own]

    links = times.withColumn("block", F.explode(F.filter(beside, lambda x: x.isNotNull()))).groupBy("block").applyInPandas(link, "t long, jump long, start boolean").checkpoint()
    reached = links.where("start").select("t")
    hop = links.where("jump is not null").select("t", "jump")
    while True:
        new = reached.join(hop, "t").select(F.col("jump").alias("t")).distinct().join(reached, "t", "left_anti").checkpoint()
        if new.isEmpty():
            break
        reached = reached.unionAll(new).checkpoint()
        hop = hop.join(hop.select(F.col("t").alias("jump"), F.col("jump").alias("far")), "jump").select("t", F.col("far").alias("jump")).checkpoint()
    entries = reached.withColumn("entry", F.lit(True))

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("t")
        t, after, seen = group["t"].to_numpy(), follow(group["t"].to_numpy()), set()
        for i in np.flatnonzero(group["entry"].to_numpy()).tolist():
            while i < len(t) and i not in seen:
                seen.add(i)
                i = int(after[i])
        return pd.DataFrame({"anchor": t[sorted(seen)]})

    anchors = times.join(entries, "t", "left").select("t", F.coalesce("entry", F.lit(False)).alias("entry"), block.alias("block")).groupBy("block").applyInPandas(walk, "anchor long")
    first = F.floor(F.col("anchor") / size)
    spread = anchors.withColumn("block_", F.explode(F.array_distinct(F.array(first, F.floor((F.col("anchor") + width) / size)))))
    rows = df.withColumn("block_", F.floor(F.col(time) / size)).withColumn("anchor", F.lit(None).cast("long"))
    marks = spread.select(F.col("anchor").alias(time), "block_", "anchor").withColumn("mark_", F.lit(True))
    both = rows.withColumn("mark_", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy("block_").orderBy(time, F.desc("mark_"))
    return both.withColumn("anchor", F.last("anchor", ignorenulls=True).over(order)).where("not mark_").drop("block_", "mark_")


def minmax_bins(df: DataFrame, key: str, idx: str, value: str, per_bin: int) -> DataFrame:
    b = F.floor(F.col(idx) / per_bin).cast("long").alias("bin")
    return df.groupBy(key, b).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def merge_intervals(segments: DataFrame, key: str, start: str, end: str, slack: int = 0) -> DataFrame:
    """Overlapping or adjoining intervals of a key as one."""
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = segments.withColumn("new_", F.coalesce((F.col(start) > reach + slack).cast("int"), F.lit(1)))
    rows = rows.withColumn("run_", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "run_").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("run_")


def overlap_mean(windows: DataFrame, key: str, start: str, samples: str) -> DataFrame:
    """Mean of each absolute sample over the windows that hold it; NaN is missing."""
    rows = windows.select(key, F.col(start).alias("s_"), F.posexplode(samples).alias("p_", "v_"))
    value = F.when(~F.isnan("v_"), F.col("v_"))
    return rows.groupBy(key, (F.col("s_") + F.col("p_")).alias("idx")).agg(F.avg(value).alias("value"))


def detrend(df: DataFrame, key: str, idx: str, value: str, kind: str = "linear") -> DataFrame:
    w = Window.partitionBy(key)
    if kind == "mean":
        return df.withColumn("detrended", F.col(value) - F.avg(value).over(w))
    line = F.regr_slope(value, idx).over(w) * F.col(idx) + F.regr_intercept(value, idx).over(w)
    return df.withColumn("detrended", F.col(value) - line)


def taper(df: DataFrame, key: str, idx: str, value: str, share: float = 0.05) -> DataFrame:
    """Half Hann windows over ``share`` of the samples at both ends."""
    n = F.count("*").over(Window.partitionBy(key))
    width = F.greatest(F.floor(n * share), F.lit(1))
    edge = F.least(F.col(idx), n - 1 - F.col(idx))
    ramp = F.when(edge < width, 0.5 * (1 - F.cos(F.pi() * edge / width))).otherwise(1.0)
    return df.withColumn("tapered", F.col(value) * ramp)


def refresh_rows(cached: DataFrame, fetched: DataFrame, spans: DataFrame, key: str = "id") -> DataFrame:
    """Cached rows inside the fetched ``spans(start_us, end_us)`` give way to the fetched; of an id the fetched row counts."""
    kept = inside_spans(cached, spans, "left_anti")
    both = kept.withColumn("age_", F.lit(0)).unionByName(fetched.withColumn("age_", F.lit(1)))
    return latest(both, [key], ["age_", "t_us"]).drop("age_")


def inside_spans(rows: DataFrame, spans: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``t_us`` a span ``(start_us, end_us)`` holds, ends included, by an equi-join on days."""
    day = lambda c: F.floor(F.col(c) / 86_400_000_000)
    days = spans.select("start_us", "end_us").where("start_us <= end_us").withColumn("span_day_", F.explode(F.sequence(day("start_us"), day("end_us"))))
    on = (F.col("day_") == F.col("span_day_")) & F.col("t_us").between(F.col("start_us"), F.col("end_us"))
    return rows.withColumn("day_", day("t_us")).join(days, on, how).drop("day_")


def fold_picks(assignments: DataFrame, groups: DataFrame) -> DataFrame:
    """Picks of a group's events as the keeper's: the first of each station and phase, the keeper's own before others."""
    rows = assignments.join(groups.select("event_id", "keeper"), "event_id", "left")
    target = F.coalesce("keeper", "event_id")
    rows = rows.withColumn("target_", target)
    order = Window.partitionBy("target_", "network", "station", "phase").orderBy((F.col("event_id") == F.col("target_")).desc(), "t_us", "event_id")
    rows = rows.withColumn("rn_", F.row_number().over(order)).where("rn_ = 1")
    return rows.withColumn("event_id", F.col("target_")).drop("target_", "rn_", "keeper")


def dedup_seams(picks: DataFrame, gap_us: int = 1_000_000) -> DataFrame:
    """Of picks of a station and phase at most ``gap_us`` apart the more probable stays, then the earlier; in time order."""
    return thin_peaks(picks, ["station", "phase"], "t_us", "probability", gap_us).orderBy("t_us", "station", "phase")


def detrigger(detections: DataFrame, gap_us: int) -> DataFrame:
    """Of a template's detections at most ``gap_us`` apart the best correlated stays."""
    return thin_peaks(detections, ["template_id"], "t_us", "correlation", gap_us)


def skip_dup_windows(segments: DataFrame, keys: Sequence[str], order: str, tolerance_us: int = 1_000_000) -> DataFrame:
    """Segments in ``order``, without those whose start and end are both less than ``tolerance_us`` from those of a
    kept one of the same keys.

    Exact copies of a window share its fate but for the first, so only distinct windows are compared (whole microseconds);
    samples take no part. Rows with a null key, start or end
    are compared with nothing and dropped.
    """
    names = [*keys, "start_us", "end_us"]
    first = segments.dropna(subset=names).groupBy(*names).agg(F.min(order).alias(order))
    kept = greedy_apart(first, keys, "start_us", [F.col(order), F.col("start_us"), F.col("end_us")], tolerance_us - 1, "end_us")
    return segments.join(kept, [*names, order], "left_semi").dropDuplicates([*names, order])


def sliding_normalise(df: DataFrame, key: str, channel: str, idx: str, value: str, window: int = 3000) -> DataFrame:
    """``normalised``: each sample less a sliding mean, over a sliding deviation.

    Mean and deviation are taken at knots every half window over the window around them (the end reflected, the
    first and last knot those of their neighbours) and lie on lines between knots; a deviation of zero counts as one. A key with
    ``n`` of three channels alive is raised by ``3 / n``. A channel of half a window or less stays as it is.
    """
    if window % 2:
        raise ValueError("an even window is needed")
    shift = window // 2
    rows = df.withColumn("n_", F.max(idx).over(Window.partitionBy(key, channel)) + 1)
    rows = rows.withColumn("last_", F.ceil(F.col("n_") / shift) - 1)
    mirrored = 2 * (F.col("n_") - 1) - F.col(idx)
    at = F.array_distinct(F.array(F.col(idx), F.when(mirrored < (F.col("last_") + 1) * shift, mirrored).otherwise(F.col(idx))))
    parts = rows.select(key, channel, "last_", F.col(value).alias("v_"), F.explode(at).alias("p_"))
    parts = parts.withColumn("knot_", F.explode(F.array(F.floor(F.col("p_") / shift), F.floor(F.col("p_") / shift) + 1))).where("knot_ between 1 and last_")
    knots = parts.groupBy(key, channel, "knot_").agg(F.avg("v_").alias("mean_"), F.stddev_pop("v_").alias("std_"))
    alive = knots.where("std_ > 0").groupBy(key).agg(F.countDistinct(channel).alias("alive_"))
    span = lambda x: F.least(F.greatest(x, F.lit(1)), F.col("last_"))
    b = F.floor(F.col(idx) / shift)
    rows = rows.withColumns({"b_": b, "lo_": span(b), "hi_": span(b + 1)})
    for side in ("lo", "hi"):
        rows = rows.join(knots.select(key, channel, F.col("knot_").alias(f"{side}_"), F.col("mean_").alias(f"{side}_mean_"), F.col("std_").alias(f"{side}_std_")), [key, channel, f"{side}_"], "left")
    f = (F.col(idx) - F.col("b_") * shift) / (F.least((F.col("b_") + 1) * shift, "n_") - F.col("b_") * shift)
    mean, std = (F.coalesce(F.col(f"lo_{c}_") + (F.col(f"hi_{c}_") - F.col(f"lo_{c}_")) * f, F.lit(0.0)) for c in ("mean", "std"))
    gain = F.when(F.col("alive_").between(1, 2), 3.0 / F.col("alive_")).otherwise(1.0)
    out = (F.col(value) - mean) / F.when(std > 0, std).otherwise(1.0) * gain
    return rows.join(alive, key, "left").select(*df.columns, out.alias("normalised"))


def pick_windows(picks: DataFrame, segments: DataFrame, keys: Sequence[str], before_us: int, after_us: int, longest_us: int) -> DataFrame:
    """``samples`` of ``[t_us - before_us, t_us + after_us)`` for each of ``picks(pick_id, keys, t_us)``, zero where no segment has
    one; ``full`` tells that none is. A later segment wins. A pick without a segment has no row; ``longest_us`` bounds a segment."""
    from .timejoin import range_join

    rows = range_join(picks.select("pick_id", *keys, "t_us"), segments.select(*keys, "start_us", "rate", F.col("samples").cast("array<float>").alias("samples")), "t_us", "start_us", -before_us - longest_us, after_us, keys)
    n = F.round(F.lit(before_us + after_us) * F.col("rate") / 1e6).cast("int")
    first = F.round((F.col("t_us") - before_us - F.col("start_us")) * F.col("rate") / 1e6).cast("int")
    rows = rows.withColumns({"first_": first, "n_": n}).where((F.col("first_") < F.size("samples")) & (F.col("first_") + F.col("n_") > 0))
    cut = F.transform(F.sequence(F.lit(0), F.col("n_") - 1), lambda i: F.get("samples", F.when(i + F.col("first_") >= 0, i + F.col("first_"))))
    parts = rows.groupBy("pick_id", *keys, "t_us").agg(F.sort_array(F.collect_list(F.struct(-F.col("start_us"), cut.alias("cut")))).alias("parts_"))
    blank = F.transform(F.col("parts_")[0]["cut"], lambda x: F.lit(None).cast("float"))
    whole = F.aggregate("parts_", blank, lambda done, p: F.zip_with(done, p["cut"], lambda a, b: F.coalesce(a, b)))
    parts = parts.withColumn("whole_", whole)
    return parts.select("pick_id", *keys, "t_us", F.transform("whole_", lambda x: F.coalesce(x, F.lit(0).cast("float"))).alias("samples"), F.forall("whole_", lambda x: x.isNotNull()).alias("full"))


def usable_templates(traces: DataFrame, length: int, least: int = 4) -> DataFrame:
    """Traces of full length, of the templates that have ``least`` of them."""
    kept = traces.where(F.size("samples") == length)
    n = kept.groupBy("template_id").agg(F.count("*").alias("n_")).where(F.col("n_") >= least)
    return kept.join(n, "template_id", "left_semi")
