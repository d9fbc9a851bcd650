"""Signals that go on from chunk to chunk: filters, padded chunks and the matched filter, with the same result however they are cut."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import BATCH, KINDS, TEMPLATE_ROWS, butterworth, match_whole, run_sections, stacks
from .timejoin import stored


# --- recursive filters: the state at the end of a chunk is linear in the state at its beginning ---
def system(sections: np.ndarray) -> np.ndarray:
    """The matrix that takes the states of all sections, two each, over a sample of zeros."""
    n = len(sections)
    a, out = np.zeros((2 * n, 2 * n)), np.zeros(2 * n)  # out: what the sections so far give for states
    for i, (b0, b1, b2, a1, a2) in enumerate(sections.tolist()):
        into = out.copy()
        y = b0 * into
        y[2 * i] += 1
        a[2 * i] = b1 * into - a1 * y
        a[2 * i, 2 * i + 1] += 1
        a[2 * i + 1] = b2 * into - a2 * y
        out = y
    return a


def run_from(sections: np.ndarray, x: np.ndarray, state: np.ndarray, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """As ``run_sections`` from a given state; also the state after the last sample."""
    y, end = np.asarray(x, np.float64), np.zeros(2 * len(sections))
    n = len(y)
    for i, (b0, b1, b2, a1, a2) in enumerate(sections.tolist()):
        before, (u, v) = y, state[2 * i : 2 * i + 2]
        y = run_sections(sections[i : i + 1], before, block)
        if u or v:  # the answer to the state alone, until it has died away
            k = 0
            y = y.copy()
            while k < n and (abs(u) > 1e-300 or abs(v) > 1e-300):
                y[k] += u
                u, v = v - a1 * u, -a2 * u
                k += 1
        w, z = 0.0, 0.0
        if n >= 2:
            z = b2 * before[n - 1] - a2 * y[n - 1]
            w = b1 * before[n - 1] - a1 * y[n - 1] + b2 * before[n - 2] - a2 * y[n - 2]
        elif n == 1:
            w, z = b1 * before[0] - a1 * y[0] + state[2 * i + 1], b2 * before[0] - a2 * y[0]
        else:
            w, z = state[2 * i : 2 * i + 2]
        end[2 * i : 2 * i + 2] = w, z
    return y, end


def _scan(keys: list[str], sections: np.ndarray, backward: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The state at the beginning of each chunk of a key, from those that the chunks before leave by themselves."""
    step = system(sections)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start_us", ascending=not backward, kind="stable")
        state, before, out, power = np.zeros(len(step)), None, [], {}
        for stretch, n, left in zip(rows["run_"], rows["n_"], rows["left_"], strict=True):
            if stretch != before:
                state, before = np.zeros(len(step)), stretch
            out.append(state.tolist())
            if n not in power:
                power[n] = np.linalg.matrix_power(step, n)
            state = power[n] @ state + np.asarray(left, float)
        return rows[[*keys, "start_us"]].assign(state_=out)

    return run


def filter_continuous(segments: DataFrame, keys: Sequence[str], low: float | None = None, high: float | None = None, zero_phase: bool = True, order: int = 4) -> DataFrame:
    """Segments ``(keys, start_us, rate, samples)`` filtered as the whole of each stretch of adjoining segments would be.

    A stretch ends where the next segment does not begin a sample after the last (within half a sample) or has another rate. With
    ``zero_phase`` the stretch's mean is taken off first and the filter runs both ways. A chunk's filter starts in the state that the chunk
    before left; this is linear in the state before it, so a pass over the samples gives what each chunk leaves by itself,
    a scan over these few numbers the states, and the next pass filters. Samples never leave their chunk. All segments of a call have the rates that its keys say;
    rows of a null key are a key of their own, overlapping segments are an error of the caller's."""
    keys = list(keys)
    rates = [r["rate"] for r in segments.select("rate").distinct().limit(17).collect()]
    if len(rates) > 16:
        raise ValueError("more than 16 sampling rates")
    order_ = Window.partitionBy(*keys).orderBy("start_us")
    gap = F.abs(F.col("start_us") - F.lag("next_").over(order_)) * F.col("rate") <= 500_000
    same = gap & (F.col("rate") == F.lag("rate").over(order_))
    rows = segments.select(*keys, "start_us", F.col("rate").cast("double").alias("rate"), F.col("samples").cast("array<double>").alias("samples"))
    spans = rows.select(*keys, "start_us", "rate", F.size("samples").alias("n_"), F.aggregate("samples", F.lit(0.0), lambda a, x: a + x).alias("sum_"))
    spans = spans.withColumn("next_", F.col("start_us") + F.round(F.col("n_") * 1e6 / F.col("rate")).cast("long"))
    spans = spans.withColumn("run_", F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(order_)).checkpoint()
    stretch = spans.groupBy(*keys, "run_").agg((F.sum("sum_") / F.sum("n_")).alias("mean_"))
    on = lambda other: [F.col(f"l_.{k}").eqNullSafe(F.col(f"r_.{k}")) for k in other]
    spans = spans.alias("l_").join(stretch.alias("r_"), on([*keys, "run_"])).select(*[f"l_.{c}" for c in (*keys, "start_us", "n_", "run_")], "r_.mean_").checkpoint()

    kinds = [k for k, hz in (("high", low), ("low", high)) if hz]
    designs = {k: {r: butterworth(order, low if k == "high" else high, r, k) for r in rates} for k in kinds}
    steps = [(k, back) for k in kinds for back in ((False, True) if zero_phase else (False,))]
    kind_of = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    key_schema = ", ".join(f"`{k}` {kind_of[k]}" for k in keys)
    shape = f"{key_schema}, start_us long, rate double, samples array<double>, left_ array<double>"

    def take_pass(batches: Iterator[pd.DataFrame], now: tuple | None, then: tuple | None) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, left = [], []
            for x, rate, state, mean in zip(batch["samples"], batch["rate"], batch["state_"], batch["mean_"], strict=True):
                x = np.asarray(x, np.float64) - (mean if mean is not None and mean == mean else 0.0)
                if now:
                    kind, back = now
                    y, _ = run_from(designs[kind][rate], x[::-1] if back else x, np.asarray(state, float))
                    x = y[::-1] if back else y
                end = np.zeros(0)
                if then:
                    kind, back = then
                    end = run_from(designs[kind][rate], x[::-1] if back else x, np.zeros(2 * len(designs[kind][rate])))[1]
                out.append(x.tolist())
                left.append(end.tolist())
            yield batch[[*keys, "start_us", "rate"]].assign(samples=out, left_=left)

    state = spans.select(*keys, "start_us", F.col("mean_") if zero_phase else F.lit(None).cast("double").alias("mean_"), F.array().cast("array<double>").alias("state_"))
    now = None
    for then in [*steps, None]:
        joined = rows.alias("l_").join(state.alias("r_"), on([*keys, "start_us"])).select(*[f"l_.{c}" for c in (*keys, "start_us", "rate", "samples")], "r_.state_", "r_.mean_")
        rows = joined.mapInPandas(lambda b, now=now, then=then: take_pass(b, now, then), shape).checkpoint()
        if then is None:
            return rows.drop("left_")
        left = rows.select(*keys, "start_us", "rate", "left_").alias("l_").join(spans.alias("r_"), on([*keys, "start_us"])).select(*[f"l_.{c}" for c in (*keys, "start_us", "rate", "left_")], "r_.n_", "r_.run_")
        found = None
        for rate in rates:
            part = left.where(F.col("rate") == rate).groupBy(*keys).applyInPandas(_scan(keys, designs[then[0]][rate], then[1]), f"{key_schema}, start_us long, state_ array<double>")
            found = part if found is None else found.unionAll(part)
        state, now = found.withColumn("mean_", F.lit(None).cast("double")).checkpoint(), then


# --- chunks with context ---
def padded_chunks(segments: DataFrame, chunks: DataFrame, keys: Sequence[str], rate: float, pad_us: int) -> DataFrame:
    """``chunks(start_us, end_us)`` of every key with ``pad_us`` of context on both sides: ``(keys, start_us, end_us, first_us, samples, valid)``,
    ``samples`` from ``first_us`` at ``rate``, 0 and not ``valid`` where no segment has any. Of overlapping segments the later one counts.

    Segments meet chunks in an equi-join over buckets of a chunk's length; what comes together is a chunk and its context."""
    keys = list(keys)
    length = chunks.agg(F.max(F.col("end_us") - F.col("start_us"))).first()[0] or 1
    wide = int(length + 2 * pad_us)
    span = F.col("start_us") + F.round((F.size("samples") - 1) * 1e6 / F.col("rate")).cast("long")
    rows = segments.select(*keys, F.col("start_us").alias("seg_us"), span.alias("seg_end"), F.col("samples").cast("array<double>").alias("samples")).where(F.size("samples") > 0)
    rows = rows.withColumn("bucket_", F.explode(F.sequence(F.floor(F.col("seg_us") / wide), F.floor(F.col("seg_end") / wide))))
    want = chunks.select("start_us", "end_us", (F.col("start_us") - pad_us).alias("first_us"), (F.col("end_us") + pad_us).alias("last_us"))
    want = want.withColumn("bucket_", F.explode(F.sequence(F.floor(F.col("first_us") / wide), F.floor((F.col("last_us") - 1) / wide))))
    met = rows.join(want, "bucket_").where((F.col("seg_us") < F.col("last_us")) & (F.col("seg_end") >= F.col("first_us")))
    # only what lies inside goes on, so that a long segment is not sent whole to each chunk
    a = F.greatest(F.ceil((F.col("first_us") - F.col("seg_us")) * rate / 1e6 - 0.5), F.lit(0)).cast("int")
    part = F.slice("samples", a + 1, F.round((F.col("last_us") - F.col("first_us")) * rate / 1e6).cast("int") + 1)
    cut = met.select(*keys, "start_us", "end_us", "first_us", "last_us", "seg_us", F.round((F.col("seg_us") - F.col("first_us")) * rate / 1e6).cast("long").alias("at_"), a.cast("long").alias("skip_"), part.alias("part_"))
    cut = cut.dropDuplicates([*keys, "start_us", "end_us", "seg_us"])
    grouped = cut.groupBy(*keys, "start_us", "end_us", "first_us", "last_us").agg(F.array_sort(F.collect_list(F.struct("seg_us", "at_", "skip_", "part_"))).alias("parts_"))
    names = [*keys, "start_us", "end_us", "first_us"]
    types = {f.name: f.dataType.simpleString() for f in grouped.schema.fields}

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            samples, valid = [], []
            for first, last, parts in zip(*(batch.column(c).to_pylist() for c in ("first_us", "last_us", "parts_")), strict=True):
                n = round((last - first) * rate / 1e6)
                x, on = np.zeros(n), np.zeros(n, bool)
                for p in parts:
                    at = p["at_"] + p["skip_"]
                    y = np.array([np.nan if v is None else v for v in p["part_"]])[max(0, -at) :]
                    at = max(0, at)
                    y = y[: max(0, n - at)]
                    good = np.isfinite(y)
                    x[at : at + len(y)], on[at : at + len(y)] = np.where(good, y, 0.0), good
                samples.append(x)
                valid.append(on)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(samples, pa.list_(pa.float64())), pa.array(valid, pa.list_(pa.bool_()))], [*names, "samples", "valid"])

    return grouped.mapInArrow(assemble, ", ".join(f"`{c}` {types[c]}" for c in names) + ", samples array<double>, valid array<boolean>")


def trimmed(padded: DataFrame, rate: float, column: str = "samples") -> DataFrame:
    """``column`` of padded chunks without the context; ``first_us`` is then the chunk's start."""
    at = F.round((F.col("start_us") - F.col("first_us")) * rate / 1e6).cast("int")
    n = F.round((F.col("end_us") - F.col("start_us")) * rate / 1e6).cast("int")
    return padded.withColumn(column, F.slice(column, at + 1, n)).withColumn("first_us", F.col("start_us"))


# --- matched filter over days ---
BITS = np.int64(32)  # of a double that the marks of the first pass leave out


def _marks(leading: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted values, the first and the last included and some ``2 sqrt(n)`` in all, and the values there."""
    at = np.unique(np.linspace(0, len(leading) - 1, int(2 * len(leading) ** 0.5) + 2).astype(np.int64))
    return at, np.sort(leading)[at]


def _between(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, int]:
    """Two values that the middle ones of all lists together lie between, from ``_marks`` of each list."""
    n = sum(int(at[-1]) + 1 for at, _ in parts)
    values = np.concatenate([v for _, v in parts])
    order = np.argsort(values, kind="stable")
    # up to a mark there are surely as many values as its place tells, and as many from a mark on
    upto = np.cumsum(np.concatenate([np.diff(at, prepend=-1) for at, _ in parts])[order])
    on = np.cumsum(np.concatenate([np.diff(at, append=at[-1] + 1) for at, _ in parts])[order][::-1])
    low = values[order][::-1][np.searchsorted(on, n - (n - 1) // 2)]
    return int(low), int(values[order][np.searchsorted(upto, n // 2 + 1)])


def match_days(segments: DataFrame, templates: DataFrame, threshold: float = 8.0, kind: str = "mad") -> DataFrame:
    """As ``arrays.match_templates`` over continuous days: ``(template_id, day, idx, cc, n_chans, mad)``, ``idx`` counted in samples of the day,
    whatever chunks it comes in. ``segments(day, first, channel, samples)``, ``first`` the place of the chunk's first sample.

    Each chunk is lent what its templates reach beyond it by the chunks around, so that a template over the edge is found
    once, by the chunk where it begins. ``mad`` is the exact median over the day of the absolute stack: a first pass takes evenly spaced values of a
    chunk's sorted stack, which tell two values that the median lies between; a second takes what is between them (some ``2 sqrt(n)`` values
    of ``n`` in each pass), and the last finds what reaches the threshold. A task holds a few chunks with their halo (``BATCH``) and a part of the
    templates, which so go to each batch once; a channel's chunks do not overlap. Days of ``BATCH`` samples at most without a gap need
    neither halo nor passes: a task holds them whole (``arrays.match_whole``)."""
    if kind not in KINDS:
        raise ValueError(f"no threshold of kind {kind}")
    size, end = F.size("samples"), F.col("first") + F.size("samples")
    spans = segments.where(size > 0).groupBy("day", "channel").agg(F.sum(size).alias("n_"), (F.max(end) - F.min("first") - F.sum(size)).alias("gap_"), F.min("first").alias("a_"), F.max(end).alias("b_"))
    days = spans.groupBy("day").agg(F.sum("n_").alias("n_"), ((F.sum("n_") <= BATCH) & (F.max(F.abs("gap_")) == 0) & (F.max("b_") - F.min("a_") == F.max("n_")) & (F.min("a_") == 0)).alias("whole_"))
    days = days.checkpoint()
    values, others = days.agg(F.sum(F.when(F.col("whole_"), F.col("n_"))), F.count_if(~F.col("whole_"))).first()
    whole = match_whole(segments.where(size > 0).join(days.where("whole_").select("day"), "day", "left_semi").withColumnRenamed("day", "chunk"), templates, threshold, kind, int(values or 0))
    whole = whole.select("template_id", F.col("chunk").alias("day"), "idx", "cc", "n_chans", F.col("mad") if kind == "mad" else F.lit(None).cast("double").alias("mad"))
    if not others:
        return whole
    parted = _match_parts(segments.join(days.where("not whole_").select("day"), "day", "left_semi"), templates, threshold, kind)
    return whole.unionByName(parted) if values else parted


def _match_parts(segments: DataFrame, templates: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``match_days`` of days that no task holds whole."""
    reach = templates.agg(F.max(F.greatest(F.size("samples") + F.col("offset"), F.lit(0))), F.min(F.least("offset", F.lit(0)))).first()
    after, before = max(int(reach[0] or 1) - 1, 0), -int(reach[1] or 0)
    parts = max(1, -(-templates.count() // TEMPLATE_ROWS))
    part = F.pmod(F.xxhash64("template_id"), F.lit(parts)).cast("int").alias("p_")
    t = templates.select("template_id", part, "channel", F.col("offset").cast("int").alias("offset"), F.col("samples").cast("array<double>").alias("samples"))
    day = segments.schema["day"].dataType.simpleString()
    s = segments.select("day", "channel", F.col("first").cast("long").alias("first"), F.col("samples").cast("array<double>").alias("samples")).where(F.size("samples") > 0)
    chunks = s.groupBy("day", "first").agg(F.max(F.size("samples")).cast("long").alias("n"), F.sum(F.size("samples")).alias("all"))
    # what a chunk sees: every part of a segment from `before` ahead of it to `after` behind its end
    longest, values = chunks.agg(F.max("n"), F.sum("all")).first()
    width = int((longest or 1) + before + after)
    bucket = lambda a, b: F.explode(F.sequence(F.floor(a / width), F.floor(b / width)))
    low, high = F.col("chunk") - before, F.col("chunk") + F.col("n") + after
    want = chunks.select("day", F.col("first").alias("chunk"), "n").withColumn("b_", bucket(low, high - 1))
    have = s.withColumn("b_", bucket(F.col("first"), F.col("first") + F.size("samples") - 1))
    a = F.greatest(low - F.col("first"), F.lit(0))
    n = F.least(high - F.col("first"), F.size("samples").cast("long")) - a
    lent = want.join(have, ["day", "b_"]).select("day", "chunk", "n", "channel", (F.col("first") + a).alias("at"), F.slice("samples", (a + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int")).alias("samples"))
    batch = F.pmod(F.xxhash64("day", "chunk"), F.lit(max(1, -(-int(values or 0) // BATCH)))).alias("batch")
    lent = stored(lent.where(F.size("samples") > 0).dropDuplicates(["day", "chunk", "channel", "at"]).select("*", batch))
    met = lent.select(F.col("batch").alias("b_"), F.col("day").alias("d_")).distinct()
    no_bounds = [F.lit(None).cast(k).alias(c) for c, k in (("d_", day), ("low_", "double"), ("high_", "double"))]
    dealt = t.crossJoin(F.broadcast(met.select("b_").distinct())).select("b_", "p_", "template_id", "channel", "offset", "samples", *no_bounds)
    lent = lent.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def each_stack(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[tuple]:
        told = right[right["samples"].isna()]
        bounds = {(name, day_): x for name, day_, *x in zip(told["template_id"], told["d_"], told["low_"], told["high_"], strict=True)}
        rows = right[right["samples"].notna()]
        templates_ = [(name, [(c, int(o), np.asarray(w, np.float64)) for c, o, w in zip(g["channel"], g["offset"], g["samples"], strict=True)]) for name, g in rows.groupby("template_id")]
        for (day_, chunk), here in left.groupby(["day", "chunk"]):
            channels = {}
            for channel, g in here.groupby("channel"):
                g = g.sort_values("at")
                pieces, at = [], int(g["at"].iloc[0])
                first = at
                for start, x in zip(g["at"], g["samples"], strict=True):
                    pieces += [np.zeros(max(0, int(start) - at)), np.asarray(x, np.float64)]  # gaps are zeros, as in a merged day
                    at = int(start) + len(x)
                channels[channel] = first - int(chunk), np.concatenate(pieces)
            for names, total, count in stacks(channels, templates_, int(here["n"].iloc[0])):
                for i, name in enumerate(names):
                    yield name, day_, int(chunk), total[i], count[i % len(count)], bounds.get((name, day_))

    def each(fn: Callable, schema: str, bounds: DataFrame | None = None) -> DataFrame:
        """``fn`` of each stack; ``bounds(template_id, day, low_, high_)`` go to the batches that have the day."""
        names = [c.split()[0] for c in schema.split(", ")]

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found = [x for x in (fn(*x) for x in each_stack(left, right)) if x] if len(left) and len(right) else []
            return pd.DataFrame(dict(zip(names, zip(*found, strict=True), strict=True)) if found else {c: pd.Series(dtype=object) for c in names})

        right = dealt
        if bounds is not None:
            told = bounds.join(met, F.col("day") == F.col("d_")).select("b_", part, "template_id", "d_", F.col("low_").cast("double").alias("low_"), F.col("high_").cast("double").alias("high_"))
            right = dealt.unionByName(told, allowMissingColumns=True)
        return lent.groupBy("batch", "part").cogroup(right.groupBy("b_", "p_")).applyInPandas(run, schema)

    def marked(name, day_, chunk, total, count, bounds):
        some = np.abs(total[count > 0]).view(np.int64) >> BITS
        return (name, day_, *(x.astype(np.int32) for x in _marks(some))) if len(some) else None

    def inside(name, day_, chunk, total, count, bounds):
        v = np.abs(total[count > 0])
        if bounds is None or not len(v):
            return None
        bits = v.view(np.int64) >> BITS
        values_, n_ = np.unique(v[(bits >= bounds[0]) & (bits <= bounds[1])], return_counts=True)
        return name, day_, len(v), int((bits < bounds[0]).sum()), values_, n_.astype(np.int32)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_between([(np.array(x["at"]), np.array(x["v"])) for x in xs]) for xs in b.column("x").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("template_id"), b.column("day"), *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))], ["template_id", "day", "low_", "high_"])

    def median(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mads = []
            for xs in b.column("x").to_pylist():
                values_, n_ = (np.concatenate([x[c] for x in xs]) for c in ("values", "n"))
                order = np.argsort(values_, kind="stable")
                upto, n = sum(x["below"] for x in xs) + np.cumsum(n_[order]), sum(x["all"] for x in xs)
                mids = [values_[order][np.searchsorted(upto, r, "right")] for r in ((n - 1) // 2, n // 2)]
                mads.append(float((mids[0] + mids[1]) / 2))
            yield pa.RecordBatch.from_arrays([b.column("template_id"), b.column("day"), pa.array(mads, pa.float64())], ["template_id", "day", "mad"])

    mads = None
    if kind == "mad":
        of_day = lambda rows, *c: rows.groupBy("template_id", "day").agg(F.collect_list(F.struct(*c)).alias("x"))
        marks = each(marked, f"template_id string, day {day}, at array<int>, v array<int>")
        place = stored(of_day(marks, "at", "v").mapInArrow(between, f"template_id string, day {day}, low_ long, high_ long"))
        held = each(inside, f"template_id string, day {day}, all long, below long, values array<double>, n array<int>", place)
        found = of_day(held, "all", "below", "values", "n").mapInArrow(median, f"template_id string, day {day}, mad double")
        mads = stored(found).select("template_id", "day", F.col("mad").alias("low_"), F.lit(None).alias("high_"))

    def detected(name, day_, chunk, total, count, bounds):
        if kind == "mad" and bounds is None:
            return None
        mad = bounds[0] if kind == "mad" else None
        least = threshold * mad if kind == "mad" else threshold if kind == "absolute" else threshold * count
        at = np.flatnonzero((count > 0) & (total >= least))
        return (name, day_, at + chunk, total[at], count[at], mad) if len(at) else None

    out = each(detected, f"template_id string, day {day}, idx array<long>, cc array<double>, n_chans array<long>, mad double", mads)
    return out.select("template_id", "day", F.explode(F.arrays_zip("idx", "cc", "n_chans")).alias("x"), "mad").select("template_id", "day", "x.idx", "x.cc", "x.n_chans", "mad")
