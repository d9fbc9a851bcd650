"""Operators on sample arrays: Column expressions where they do, grouped numpy for recursions and FFTs.

Segments have ``key, start_us, rate, samples``; a group is one channel's chunk with its
context, never a whole network or archive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import thin_peaks

LIMIT = 1 << 23


def runs_of(samples: Column, good: Callable[[Column], Column]) -> Column:
    """``array<struct(first, n)>`` of the runs of samples for which ``good`` holds."""
    at = F.filter(F.sequence(F.lit(0), F.size(samples) - 1), lambda i: good(samples[i]))
    starts = F.filter(at, lambda i: (i == 0) | ~good(F.get(samples, i - 1)))
    ends = F.filter(at, lambda i: (i == F.size(samples) - 1) | ~good(F.get(samples, i + 1)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("n")))


def mask_impossible(segments: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Samples beyond ``limit`` (which itself stays) go and split their segment; ``masked`` counts them."""
    runs = runs_of(F.col("samples"), lambda x: F.abs(x) <= limit)
    rows = segments.withColumn("masked", F.size(F.filter("samples", lambda x: F.abs(x) > limit)))
    rows = rows.withColumn("run_", F.explode(F.when(F.size("samples") > 0, runs)))
    start = F.col("start_us") + F.round(F.col("run_.first") * 1e6 / F.col("rate")).cast("long")
    return rows.withColumns({"start_us": start, "samples": F.slice("samples", F.col("run_.first") + 1, F.col("run_.n"))}).drop("run_")


def interpolate_gaps(df: DataFrame, key: str, idx: str, value: str) -> DataFrame:
    """Missing values of an even grid on the line between their neighbours."""
    w = Window.partitionBy(key).orderBy(idx)
    at = F.when(F.col(value).isNotNull(), F.col(idx))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    a, b = F.last(value, ignorenulls=True).over(back), F.first(value, ignorenulls=True).over(ahead)
    i, j = F.last(at, ignorenulls=True).over(back), F.first(at, ignorenulls=True).over(ahead)
    line = a + (b - a) * (F.col(idx) - i) / (j - i)
    return df.withColumn("filled", F.coalesce(F.col(value), line))


def split_by_day(segments: DataFrame) -> DataFrame:
    day = 86_400_000_000
    step = F.lit(1e6) / F.col("rate")
    last = F.col("start_us") + F.floor((F.size("samples") - 1) * step)
    rows = segments.withColumn("day_", F.explode(F.sequence(F.floor(F.col("start_us") / day), F.floor(last / day))))
    first = F.greatest(F.ceil((F.col("day_") * day - F.col("start_us")) / step), F.lit(0)).cast("int")
    stop = F.least(F.ceil(((F.col("day_") + 1) * day - F.col("start_us")) / step), F.size("samples").cast("long")).cast("int")
    rows = rows.withColumns({"first_": first, "stop_": stop}).where("stop_ > first_")
    start = F.col("start_us") + F.round(F.col("first_") * step).cast("long")
    return rows.withColumns({"start_us": start, "samples": F.slice("samples", F.col("first_") + 1, F.col("stop_") - F.col("first_"))}).drop("day_", "first_", "stop_")


def align_span(segments: DataFrame, start_us: int, end_us: int, fill: float = 0.0) -> DataFrame:
    """Every segment on the samples of ``[start_us, end_us)``, filled where it has none."""
    n = F.ceil(F.lit(end_us - start_us) * F.col("rate") / 1e6).cast("int")
    shift = F.ceil((F.lit(start_us) - F.col("start_us")) * F.col("rate") / 1e6).cast("int")
    samples = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.get("samples", F.when(i + shift >= 0, i + shift)), F.lit(fill).cast("float")))
    return segments.withColumn("samples", samples).withColumn("start_us", F.lit(start_us))


def merge_segments(segments: DataFrame, keys: Sequence[str], bridge: bool = False) -> DataFrame:
    """Segments of equal ``keys`` (which hold a channel and its day, so that a group is bounded) and rate as one grid: on
    overlap the later start wins; gaps split the result, or with ``bridge`` are filled on the line between their neighbours."""
    out = segments.select(*keys, "start_us", "rate", F.col("samples").cast("array<double>").alias("samples"))
    names = out.columns

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start_us")
        rate, origin = group["rate"].iloc[0], group["start_us"].iloc[0]
        at = [round((s - origin) * rate / 1e6) for s in group["start_us"]]
        grid = np.full(max((a + len(x) for a, x in zip(at, group["samples"], strict=True)), default=0), np.nan)
        for a, x in zip(at, group["samples"], strict=True):
            grid[a : a + len(x)] = x
        have = np.flatnonzero(~np.isnan(grid))
        if bridge and len(have):
            grid = np.interp(np.arange(have[-1] + 1), have, grid[have])
            have = np.arange(len(grid))
        runs = [r for r in np.split(have, np.flatnonzero(np.diff(have) > 1) + 1) if len(r)]
        rows = {k: [group[k].iloc[0]] * len(runs) for k in keys}
        rows |= {"start_us": [int(origin + round(r[0] * 1e6 / rate)) for r in runs], "rate": [rate] * len(runs), "samples": [grid[r[0] : r[-1] + 1].tolist() for r in runs]}
        return pd.DataFrame(rows, columns=names)

    return out.where("samples is not null").groupBy(*keys, "rate").applyInPandas(merge, out.schema)


def drop_short(segments: DataFrame, least: int = 10) -> DataFrame:
    return segments.where(F.size("samples") >= least)


def to_velocity(segments: DataFrame, sensitivity: DataFrame, key: str) -> DataFrame:
    rows = segments.join(sensitivity.select(key, "sensitivity"), key)
    return rows.withColumn("samples", F.transform("samples", lambda x: x / F.col("sensitivity")))


def assemble_components(segments: DataFrame, keys: Sequence[str], order: Sequence[str] = ("E", "N", "Z")) -> DataFrame:
    """One array per station in component order; a missing horizontal is the vertical, ``valid`` where all are present."""
    rows = segments.groupBy(*keys).pivot("component", list(order)).agg(F.first("samples"))
    z = F.col(order[-1])
    parts = [F.coalesce(F.col(c), z, *[F.col(o) for o in order]).alias(c) for c in order]
    n = F.least(*[F.size(p) for p in parts]) if len(parts) > 1 else F.size(parts[0])
    valid = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_compact(F.array(*[F.when(~F.isnan(F.get(p, i)), 1) for p in parts])))
    return rows.select(*keys, F.array(*parts).alias("components"), F.transform(valid, lambda x: F.size(x) == len(order)).alias("valid"))


def usable_chunks(stations: DataFrame, chunk: str, share: float = 0.5, least: int = 2) -> DataFrame:
    """Stations with enough valid samples, in chunks with enough stations."""
    good = F.aggregate("valid", F.lit(0), lambda n, x: n + x.cast("int")) / F.size("valid")
    kept = stations.where(good >= share)
    n = kept.groupBy(chunk).agg(F.count("*").alias("n_")).where(F.col("n_") >= least)
    return kept.join(n.select(chunk), chunk, "left_semi")


def chunk_grid(days: DataFrame, hours: int = 1, pad_s: int = 40) -> DataFrame:
    """``days(day)`` to chunks with padding that stays inside the day."""
    day = F.unix_micros(F.col("day").cast("timestamp"))
    hour = F.explode(F.sequence(F.lit(0), F.lit(23), F.lit(hours)))
    rows = days.select("day", day.alias("d_"), hour.alias("hour"))
    a, b = F.col("d_") + F.col("hour") * 3_600_000_000, F.col("d_") + F.least(F.col("hour") + hours, F.lit(24)) * 3_600_000_000
    return rows.select("day", "hour", a.alias("start_us"), b.alias("end_us"), F.greatest(a - pad_s * 1_000_000, "d_").alias("padded_start_us"),
                       F.least(b + pad_s * 1_000_000, F.col("d_") + 86_400_000_000).alias("padded_end_us"))


def cut_windows(segments: DataFrame, size: int = 3000, step: int = 2000) -> DataFrame:
    """Windows every ``step`` samples, the last one aligned to the end, each divided by ten of its standard deviations about its mean."""
    n = F.size("samples")
    starts = F.when(n > size, F.array_distinct(F.concat(F.sequence(F.lit(0), n - size, F.lit(step)), F.array(n - size)))).otherwise(F.array(F.lit(0)))
    rows = segments.withColumn("first", F.explode(starts)).withColumn("window", F.slice("samples", F.col("first") + 1, size))
    mean = F.aggregate("window", F.lit(0.0), lambda s, x: s + x) / F.size("window")
    rows = rows.withColumn("mean_", mean)
    std = F.sqrt(F.aggregate("window", F.lit(0.0), lambda s, x: s + (x - F.col("mean_")) * (x - F.col("mean_"))) / F.size("window"))
    rows = rows.withColumn("std_", F.when(std > 0, std).otherwise(1.0))
    return rows.withColumn("window", F.transform("window", lambda x: (x - F.col("mean_")) / F.col("std_") / 10)).drop("mean_", "std_", "samples")


def resample_linear(segments: DataFrame, hz: float = 100.0) -> DataFrame:
    """Samples on a grid of ``hz`` on the lines between neighbours."""
    n = F.floor((F.size("samples") - 1) * hz / F.col("rate")).cast("int")

    def at(i: Column) -> Column:
        x = i * F.col("rate") / hz
        k = F.floor(x).cast("int")
        a, b = F.get("samples", k), F.coalesce(F.get("samples", k + 1), F.get("samples", k))
        return (a + (b - a) * (x - k)).cast("float")

    same = F.col("rate") == hz
    new = F.when(same, F.col("samples")).otherwise(F.transform(F.sequence(F.lit(0), n), at))
    # in two steps: within one, ``rate`` in the lambda would be the new one
    return segments.withColumn("samples", new).withColumn("rate", F.lit(hz))


def thin(segments: DataFrame, most: int) -> DataFrame:
    step = F.greatest(F.floor(F.size("samples") / most), F.lit(1))
    return segments.withColumn("samples", F.filter("samples", lambda x, i: i % step == 0))


def sanitise(segments: DataFrame) -> DataFrame:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return segments.withColumn("samples", F.transform("samples", lambda x: F.when(bad(x), F.lit(0.0)).otherwise(x).cast("float")))


def sample_time(start_us: Column, rate: Column, i: Column) -> Column:
    return start_us + F.round(i * 1e6 / rate).cast("long")


# --- filters: second-order sections of a Butterworth design by the bilinear transform ---
def butterworth(order: int, hz: float, rate: float, kind: str) -> np.ndarray:
    """Sections ``(b0, b1, b2, a1, a2)`` of a low or high pass of even ``order``."""
    k = np.tan(np.pi * hz / rate)
    out = []
    for i in range(order // 2):
        q = 2 * np.sin(np.pi * (2 * i + 1) / (2 * order))
        norm = 1 + k * q + k * k
        b = np.array([k * k, 2 * k * k, k * k]) if kind == "low" else np.array([1.0, -2.0, 1.0])
        out.append([*(b / norm), 2 * (k * k - 1) / norm, (1 - k * q + k * k) / norm])
    return np.array(out)


def run_sections(sections: np.ndarray, x: np.ndarray, block: int = 256) -> np.ndarray:
    """The recursion of each section, a block at a time: within a block its response is a product with a matrix, and only
    the two state values pass from block to block."""
    y = np.asarray(x, np.float64)
    n = len(y)
    block = max(1, min(block, n))
    for b0, b1, b2, a1, a2 in sections.tolist():
        step, drive = np.array([[-a1, 1.0], [-a2, 0.0]]), np.array([b1 - a1 * b0, b2 - a2 * b0])
        powers = [np.eye(2)]
        for _ in range(block):
            powers.append(step @ powers[-1])
        free = np.array([p[0] for p in powers[:block]])  # output after a state, without input
        response = np.concatenate([[b0], free[: block - 1] @ drive])
        lag = np.arange(block)[:, None] - np.arange(block)[None, :]
        within = np.where(lag >= 0, response[np.maximum(lag, 0)], 0.0)
        into = np.array([powers[block - 1 - j] @ drive for j in range(block)])  # state left by each input
        rows = np.concatenate([y, np.zeros(-n % block)]).reshape(-1, block)
        left, states = (rows @ into).tolist(), np.empty((len(rows), 2))
        (p, q), (r, t) = powers[block].tolist()
        u = v = 0.0
        for i, (du, dv) in enumerate(left):
            states[i] = u, v
            u, v = p * u + q * v + du, r * u + t * v + dv
        y = (rows @ within.T + states @ free.T).ravel()[:n]
    return y


def band_filter(x: np.ndarray, rate: float, low: float | None, high: float | None, zero_phase: bool = True, order: int = 4) -> np.ndarray:
    x = np.asarray(x, np.float64) - (np.mean(x) if zero_phase and len(x) else 0.0)
    sections = [butterworth(order, low, rate, "high")] if low else []
    sections += [butterworth(order, high, rate, "low")] if high else []
    for s in sections:
        x = run_sections(s, x)
        if zero_phase:
            x = run_sections(s, x[::-1])[::-1]
    return x


def grouped_signal(df: DataFrame, keys: Sequence[str], fn: Callable[[np.ndarray, float], np.ndarray], schema: str | None = None) -> DataFrame:
    """``fn(samples, rate)`` on every segment: any numpy filter as a Spark job."""

    def run(batches):
        for batch in batches:
            batch["samples"] = [np.asarray(fn(np.asarray(x, np.float64), r)).tolist() for x, r in zip(batch["samples"], batch["rate"], strict=True)]
            yield batch

    return df.select(*keys, "start_us", "rate", "samples").mapInPandas(run, schema or df.select(*keys, "start_us", "rate", F.col("samples").cast("array<double>").alias("samples")).schema)


def highpass(df: DataFrame, keys: Sequence[str], hz: float = 0.5) -> DataFrame:
    """Causal, four poles, one pass."""
    return grouped_signal(df, keys, lambda x, rate: band_filter(x, rate, hz, None, zero_phase=False))


def bandpass(df: DataFrame, keys: Sequence[str], low: float | None, high: float | None) -> DataFrame:
    return grouped_signal(df, keys, lambda x, rate: band_filter(x, rate, low, high))


def decimate(df: DataFrame, keys: Sequence[str], target: float) -> DataFrame:
    """By a whole factor after a low pass at 0.4 of the new rate; other factors are an error."""

    def fn(x, rate):
        factor = rate / target
        if abs(factor - round(factor)) > 1e-6:
            raise ValueError(f"{rate} Hz is no multiple of {target} Hz")
        factor = round(factor)
        return band_filter(x - x.mean(), rate, None, 0.4 * target)[::factor] + x.mean() if factor > 1 else x

    return grouped_signal(df, keys, fn).withColumn("rate", F.lit(float(target)))


def spectrogram(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of power over time and frequency: ``(keys, frame, hz, power)``, clipped to its 5th and 99th percentiles and scaled to 0..1."""

    def run(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                x = np.asarray(row["samples"], np.float64)
                size = min(128, max(len(x) // 4, 2))
                step = max(size // 4, 1)
                frames = np.lib.stride_tricks.sliding_window_view(x, size)[::step] * np.hanning(size)
                power = 10 * np.log10(np.abs(np.fft.rfft(frames, axis=1)) ** 2 + 1e-20)
                lo, hi = np.percentile(power, [5, 99])
                power = np.clip((power - lo) / max(hi - lo, 1e-12), 0, 1)
                hz = np.fft.rfftfreq(size, 1 / row["rate"])
                t, f = np.meshgrid(np.arange(len(power)), hz, indexing="ij")
                yield pd.DataFrame({**{k: row[k] for k in keys}, "frame": t.ravel(), "hz": f.ravel(), "power": power.ravel()})

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, "rate", "samples").mapInPandas(run, f"{kinds}, frame long, hz double, power double")


#: Template channels that meet chunks in one group, and samples of chunks that do, or one chunk.
TEMPLATE_ROWS, BATCH = 4_000, 250_000
KINDS = ("mad", "absolute", "mean_channel")
HELD = 1 << 18  # values of transforms, windows and short stacks held at a time
#: Samples of a template up to which, and templates from which on, windows are multiplied with templates; else transforms are.
DIRECT, ENOUGH = 256, 4


def correlate(v: np.ndarray, wants: np.ndarray, kept: dict | None = None, space: np.ndarray | None = None) -> np.ndarray:
    """Normalised correlations with each row of ``wants``, a row of places each, in ``space`` if given. ``kept``, of one ``v`` and length, holds what rows share from call to call."""
    whole, m = kept is not None, wants.shape[1]
    kept = kept if whole else {}
    if "level" not in kept:
        level = v - v.mean()
        s, q = (np.concatenate([[0.0], np.cumsum(w)]) for w in (level, level * level))
        kept["level"] = level, np.sqrt(np.maximum((q[m:] - q[:-m]) / m - ((s[m:] - s[:-m]) / m) ** 2, 1e-24))
    level, std = kept["level"]
    scale = wants.std(axis=1, keepdims=True) * m
    w = (wants - wants.mean(axis=1, keepdims=True)) / np.where(scale == 0, 1.0, scale)
    shape = len(w), len(v) - m + 1
    out = np.empty(shape) if space is None else space[: shape[0] * shape[1]].reshape(shape)
    if m <= DIRECT and len(w) >= ENOUGH:
        some, here = max(1, HELD // m), np.lib.stride_tricks.sliding_window_view(level, m)
        for a in range(0, out.shape[1], some):
            windows = kept.get(a)
            if windows is None:
                windows = np.ascontiguousarray(here[a : a + some].T) / std[a : a + some]
                if whole:
                    kept[a] = windows
            np.matmul(w, windows, out=out[:, a : a + some])
        return out
    size = 1 << (len(v) + m - 2).bit_length()
    if "spectrum" not in kept:
        kept["spectrum"] = np.fft.rfft(level, size)
    spectrum, step = kept["spectrum"], max(1, HELD // size)
    for a in range(0, len(w), step):
        out[a : a + step] = np.fft.irfft(spectrum * np.fft.rfft(w[a : a + step, ::-1], size), size)[:, m - 1 : len(v)]
    return np.divide(out, std, out=out)


def stacks(channels: dict, templates: list, n: int, held: int = HELD) -> Iterator[tuple]:
    """``(names, stacks, channels counted)`` over ``n`` places, some templates ``(name, [(channel, offset, samples)])`` at a time, a row each, from
    ``channels[name]`` (its first place, samples) of the chunk and what follows and precedes it. Templates of the same channels, offsets and lengths share
    one row of counts. The arrays are written again with the next ones."""
    step, kept, room = min(64, max(1, held // max(n, 1))), {}, 16 * HELD
    usable = [[(c, o, w) for c, o, w in rows if c in channels and 0 < len(w) <= len(channels[c][1])] for _, rows in templates]
    space, sums = np.empty(step * max((len(v) for _, v in channels.values()), default=0)), np.empty((step, n))
    for k in range(0, len(templates), step):
        some = usable[k : k + step]
        one = all([x[:2] + (len(x[2]),) for x in rows] == [x[:2] + (len(x[2]),) for x in some[0]] for rows in some)
        total, count = sums[: len(some)], np.zeros((1 if one else len(some), n), np.int64)
        total[:] = 0
        alike: dict[tuple, list] = {}
        for i, rows in enumerate(some):
            for channel, offset, want in rows:
                alike.setdefault((channel, len(want)), []).append((i, offset, want))
        for key, rows in alike.items():
            first, v = channels[key[0]]
            if key not in kept:  # windows or transforms, as far as there is room
                need = len(v) * (4 + key[1] if key[1] <= DIRECT else 8)
                kept[key], room = ({}, room - need) if need <= room else (None, room)
            begin = [0, *(j for j in range(1, len(rows)) if rows[j][:2] != (rows[j - 1][0] + 1, rows[j - 1][1])), len(rows)]
            for g in range(0, len(rows), step):  # a template may have a channel more than once
                found = correlate(v, np.stack([w for *_, w in rows[g : g + step]]), kept[key], space)
                for x, y in zip(begin[:-1], begin[1:], strict=True):  # rows that follow each other, of one offset
                    x, y = max(x, g), min(y, g + step)
                    i, offset = rows[x][:2] if x < y else (0, 0)
                    # found[j] is the correlation at place first + j, and counts for place first + j - offset
                    a, b = max(0, first - offset), min(n, first - offset + found.shape[1])
                    if x < y and a < b:
                        total[i : i + y - x, a:b] += found[x - g : y - g, a - first + offset : b - first + offset]
                        if not one:
                            count[i : i + y - x, a:b] += 1
                        elif i == 0:
                            count[0, a:b] += 1
        yield [name for name, _ in templates[k : k + step]], total, count


def detections(total: np.ndarray, count: np.ndarray, threshold: float, kind: str) -> Iterator[tuple]:
    """``(row, places, channels counted there, mad)`` of each stack that reaches its threshold somewhere; ``mad`` is the exact median of its absolute values.

    A median is worked out only where it can be low enough: if more than half of the values exceed the greatest one over the threshold, nothing is detected."""
    on, likely = count > 0, np.arange(len(total))
    if len(count) == 1 and kind == "mad" and threshold > 0:
        at = np.flatnonzero(on[0])
        if not len(at):
            return
        rows = total[:, at[0] : at[-1] + 1] if len(at) == at[-1] + 1 - at[0] else total[:, at]
        most = rows.max(1) / threshold * (1 + 1e-9)
        few = [np.count_nonzero(np.abs(row) <= top) for row, top in zip(rows, most, strict=True)]
        likely = np.flatnonzero(np.array(few) > (len(at) - 1) // 2)
    for i in likely.tolist():
        here, n = (on[0], count[0]) if len(count) == 1 else (on[i], count[i])
        if not here.any():
            continue
        mad = float(np.median(np.abs(total[i, here])))
        at = np.flatnonzero(here & (total[i] >= (threshold * mad if kind == "mad" else threshold if kind == "absolute" else threshold * n)))
        if len(at):
            yield i, at, n[at], mad


def match_whole(segments: DataFrame, templates: DataFrame, threshold: float, kind: str, values: int, own_ends: bool = False) -> DataFrame:
    """``(template_id, chunk, idx, cc, n_chans, mad)`` of chunks that come whole: ``segments(chunk, channel, first, samples)``, the pieces of a channel
    without a gap between them, of ``values`` samples in all. With ``own_ends`` a stack ends with the longest of the template's channels.

    A batch of chunks (``BATCH``) meets a part of the templates (``TEMPLATE_ROWS``) in one group, so a template goes once to each batch; only detections leave it."""
    parts, batches = max(1, -(-templates.count() // TEMPLATE_ROWS)), max(1, -(-values // BATCH))
    # a number, so that few bytes are not put together into few tasks: a group costs the product of its sides
    many = max(int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(parts * batches, 2_000))
    place = [F.col("batch"), F.col("part")]
    part = F.pmod(F.xxhash64("template_id"), F.lit(parts)).cast("int").alias("part")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch")
    t = templates.select("template_id", "channel", F.col("offset").cast("int").alias("offset"), F.col("samples").cast("array<double>").alias("samples"), part).select("*", numbers)
    batch = F.pmod(F.xxhash64("chunk"), F.lit(batches)).cast("int").alias("batch")
    # aliases, since both sides may come from one table
    s = segments.select("chunk", F.col("channel").alias("channel"), F.col("first").cast("long").alias("first"), F.col("samples").cast("array<double>").alias("samples"), batch)
    s = s.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    names = ("template_id", "chunk", "idx", "cc", "n_chans", "mad")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ready = [(name, [(c, int(o), np.asarray(w, np.float64)) for c, o, w in zip(g["channel"], g["offset"], g["samples"], strict=True)]) for name, g in right.groupby("template_id")]
        out = []
        for chunk, here in left.groupby("chunk") if ready else ():
            channels = {}
            for channel, g in here.groupby("channel"):
                g = g.sort_values("first", kind="stable")
                channels[channel] = int(g["first"].iloc[0]), np.concatenate([np.asarray(x, np.float64) for x in g["samples"]])
            n = max((first + len(v) for first, v in channels.values()), default=0)
            at = 0
            for ids, total, count in stacks(channels, ready, n, 4 * HELD):
                if own_ends:
                    ends = [max((len(channels[c][1]) for c, *_ in rows if c in channels), default=0) for _, rows in ready[at : at + len(ids)]]
                    if min(ends) < n:
                        count = np.where(np.arange(n) < np.array(ends)[:, None], count, 0)
                at += len(ids)
                out += [(ids[i], chunk, idx, total[i, idx], channels_, mad) for i, idx, channels_, mad in detections(total, count, threshold, kind)]
        return pd.DataFrame(out, columns=names)

    schema = f"template_id string, chunk {segments.schema['chunk'].dataType.simpleString()}, idx array<long>, cc array<double>, n_chans array<long>, mad double"
    met = s.repartition(many, *place).groupBy("batch", "part").cogroup(t.repartition(many, *place).groupBy("batch", "part")).applyInPandas(run, schema)
    return met.select("template_id", "chunk", F.explode(F.arrays_zip("idx", "cc", "n_chans")).alias("x"), "mad").select("template_id", "chunk", "x.idx", "x.cc", "x.n_chans", "mad")


def match_templates(segments: DataFrame, templates: DataFrame, threshold: float = 8.0, kind: str = "mad") -> DataFrame:
    """Matched filter: each template channel's normalised correlation with the continuous channel, shifted by its offset and
    stacked over channels, as ``(template_id, chunk, idx, cc, n_chans, mad)`` where the stack reaches the threshold: ``mad`` median absolute
    deviations of the template's stack in the chunk, an ``absolute`` value, or a mean correlation of its channels (``mean_channel``).

    ``segments(chunk, channel, samples)``, ``templates(template_id, channel, offset, samples)``. A batch of chunks meets a part of the
    templates in one group, which stacks in numpy; only detections leave it. A chunk (an hour, say) bounds what a task holds.
    """
    if kind not in KINDS:
        raise ValueError(f"no threshold of kind {kind}")
    values = segments.agg(F.sum(F.size("samples"))).first()[0] or 0
    return match_whole(segments.withColumn("first", F.lit(0)), templates, threshold, kind, int(values), own_ends=True)


def score_windows(windows: DataFrame, predict_fn, column: str = "window", batch: int = 64, size: int = 3000) -> DataFrame:
    """Any model over windows of ``size`` samples, shorter ones filled up with 0: ``predict_fn()`` returns a function of a batch array, once for each Python worker."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    score = predict_batch_udf(predict_fn, return_type=ArrayType(FloatType()), batch_size=batch, input_tensor_shapes=[[size]])
    missing = F.greatest(F.lit(size) - F.size(column), F.lit(0))
    return windows.withColumn("score", score(F.concat(F.col(column), F.array_repeat(F.lit(0.0), missing))))


def overlap_scores(scored: DataFrame, keys: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """Windows ``(keys, first, score)`` as traces ``(keys, class, prob)``: the mean of each sample over the windows that hold it, null where no score is a number.

    A ``score`` has the samples of each of ``classes`` one after another; the windows of a trace meet in a row."""
    names, kinds = list(keys), {f.name: f.dataType.simpleString() for f in scored.schema.fields}
    rows = scored.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("first", "score"))).alias("parts_"))

    def run(batches):
        for batch in batches:
            out = []
            for parts in batch["parts_"]:
                each = [(int(p["first"]), np.asarray(p["score"], np.float64).reshape(len(classes), -1)) for p in parts]
                n = max(a + y.shape[1] for a, y in each)
                total, count = np.zeros((len(classes), n)), np.zeros((len(classes), n))
                for a, y in each:
                    good = ~np.isnan(y)
                    total[:, a : a + y.shape[1]] += np.where(good, y, 0.0)
                    count[:, a : a + y.shape[1]] += good
                with np.errstate(invalid="ignore", divide="ignore"):
                    out.append((total / count).tolist())
            for k, name in enumerate(classes):
                yield batch[names].assign(**{"class": name, "prob": [x[k] for x in out]})

    return rows.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", class string, prob array<double>")


def peaks_of(scores: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Maxima ``(keys, t_us, probability)`` of ``threshold`` at least in probability traces ``(keys, start_us, rate, prob)``."""
    p = F.col("prob")
    at = F.filter(F.sequence(F.lit(1), F.size(p) - 2), lambda i: (p[i] >= threshold) & (p[i] > p[i - 1]) & (p[i] >= p[i + 1]))
    rows = scores.where(F.size(p) > 2).select(*keys, "start_us", "rate", "prob", F.explode(at).alias("idx"))
    return rows.select(*keys, sample_time(F.col("start_us"), F.col("rate"), F.col("idx")).alias("t_us"), p[F.col("idx")].alias("probability"))


def extract_picks(scores: DataFrame, keys: Sequence[str], threshold: float, least_us: int) -> DataFrame:
    """Picks of probability traces ``(keys, start_us, rate, prob)``: maxima of ``threshold`` at least, the higher of those at most ``least_us`` apart."""
    return thin_peaks(peaks_of(scores, keys, threshold), list(keys), "t_us", "probability", least_us)
