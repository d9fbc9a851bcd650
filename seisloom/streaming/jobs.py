"""Structured Streaming jobs: rates, windows, sessions, days, late chunks, corroboration, alerts, seam dedup."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators import joins


def _text(values: list) -> pd.Series:
    return pd.Series(values, dtype=object)


def pick_rate(picks: DataFrame, width: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Picks of each station in tumbling windows; data later than ``late`` is given up."""
    return picks.withWatermark("time", late).groupBy(F.window("time", width), "station").agg(F.count("*").alias("n")).select("station", F.col("window.start").alias("start"), "n")


def sliding_counts(picks: DataFrame, width: str = "30 seconds", step: str = "20 seconds", late: str = "1 hour") -> DataFrame:
    """Picks and stations with picks of overlapping windows; a window's state holds each station once."""
    counts = picks.withWatermark("time", late).groupBy(F.window("time", width, step)).agg(F.count("*").alias("n"), F.collect_set("station").alias("stations"))
    return counts.select(F.col("window.start").alias("start"), "n", F.size("stations").cast("long").alias("stations"))


def pick_sessions(picks: DataFrame, gap: str = "60 seconds", least: int = 3, late: str = "1 hour") -> DataFrame:
    s = picks.withWatermark("time", late).groupBy("network", F.session_window("time", gap).alias("w")).agg(F.count("*").alias("n"), F.collect_set("station").alias("stations"))
    return s.where(F.col("n") >= least).select("network", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", F.size("stations").alias("stations"))


def _beside(primary: DataFrame, keys: dict[str, str], tolerance: str, late: str) -> tuple[Callable[[Column], Column], DataFrame, Column]:
    """The bucket of a time, as wide as ``tolerance``; of each bucket of ``primary`` a row for itself and the two beside it, with its first and last time; and
    whether one of its rows is within ``tolerance`` of a row's ``time`` there.

    Any row of the same bucket is, and of a bucket beside it the last or the first decides: however dense the primary rows are, the state has two times of them a bucket."""
    width = int(primary.sparkSession.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {tolerance})").first()[0])
    bucket = lambda c: F.floor(F.unix_micros(c) / width)
    rows = primary.select(*[F.col(k).alias(x) for k, x in keys.items()], F.col("time").alias("b_time")).withWatermark("b_time", late)
    ends = rows.groupBy(F.window("b_time", tolerance), *keys.values()).agg(F.min("b_time").alias("lo_"), F.max("b_time").alias("hi_"))
    ends = ends.select(*keys.values(), F.window_time("window").alias("b_at"), bucket(F.col("window.start")).alias("b_bucket_"), "lo_", "hi_")
    ends = ends.withColumn("near_", F.explode(F.array(*[F.col("b_bucket_") + i for i in (-1, 0, 1)])))
    reach = f"b_at BETWEEN time - INTERVAL {3 * width} MICROSECONDS AND time + INTERVAL {3 * width} MICROSECONDS"  # tells when state can go
    near = f"(near_ = b_bucket_ OR time BETWEEN lo_ - INTERVAL {tolerance} AND hi_ + INTERVAL {tolerance})"
    return bucket, ends, F.expr(" AND ".join(["bucket_ = near_", *[f"{k} = {x}" for k, x in keys.items()], reach, near]))


def corroborate(secondary: DataFrame, primary: DataFrame, tolerance: str = "1 second", late: str = "10 minutes") -> DataFrame:
    """Stream to stream: picks of the second detector with a primary pick of the same station and phase near in time, each once.
    State is given up with the watermark. Time is cut into buckets of the tolerance, so a pick is compared with three buckets' first and last
    primary pick, not with all of its station and phase that the state holds; it comes out when the watermark has passed such a bucket."""
    bucket, ends, near = _beside(primary, {"station": "b_station", "phase": "b_phase"}, tolerance, late)
    a = secondary.withWatermark("time", late).withColumn("bucket_", bucket(F.col("time")))
    return a.join(ends, near, "left_semi").drop("bucket_").dropDuplicatesWithinWatermark(["pick_id"])


def separate(secondary: DataFrame, primary: DataFrame, seconds: int = 10, late: str = "10 minutes") -> DataFrame:
    """Stream to stream: events of the second detector without a primary origin within ``seconds``, edges included; each comes
    out when the watermark tells that none can come any more. It is compared with three buckets' first and last origin."""
    bucket, ends, near = _beside(primary, {}, f"{seconds} SECONDS", late)
    a = secondary.withWatermark("time", late).withColumn("bucket_", bucket(F.col("time")))
    return a.join(ends, near, "left_outer").where("b_at is null").select(*secondary.columns)


def regional_tagger(regional: Callable[[], DataFrame], covered: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], lag_min: float = 5, lag_max: float = 90):
    """A ``foreachBatch`` function that tags each batch of events with the latest regional event before it, from the cache as
    it is at that time, and hands it to ``write(tagged, batch number)``. Events outside the cache's span get no tag; triage of a later run has them."""

    def tag(batch: DataFrame, number: int) -> None:
        write(joins.asof_regional(batch, regional(), covered(), lag_min, lag_max), number)

    return tag


def significant_events(events: DataFrame, magnitude: float = 4.0, within: str = "24 hours") -> DataFrame:
    """An alert for each event of ``magnitude`` at least that comes no later than ``within``, once."""
    strong = events.where(F.col("magnitude") >= magnitude).withWatermark("time", within)
    return strong.dropDuplicatesWithinWatermark(["event_id"])


def upsert_chunks(path: str, keys: list[str], order: str):
    """A ``foreachBatch`` function that keeps the latest row of each key in versions of days (``sinks.read_versions``): only the files of days
    that the batch touches are read, and these days are written again under the batch's number, so a repeated batch changes nothing."""
    from ..operators.windows import latest
    from ..sources import sinks

    def merge(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, batch.checkpoint()
        days = [r["day"] for r in rows.select(F.col("day").cast("string").alias("day")).distinct().collect()]
        old = sinks.read_versions(spark, path, rows.schema, days)
        sinks.write_versions(latest(old.unionByName(rows), keys, [order]), path, number, days)

    return merge


def day_batches(path: str, now: Callable[[], datetime] | None = None, age_hours: int = 26) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of ``process_days``.

    Rows are staged by day and batch. A day that is old enough is its version so far with all that is staged of it, written as the version of the
    batch's number; then its staged rows go. So a batch lists and reads the days that wait and its own, however many there have been."""
    from ..sources import sinks

    def batch(df: DataFrame, number: int) -> None:
        spark, staged = df.sparkSession, f"{path}/staged"
        df.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(staged)
        at = (now() if now else datetime.now(UTC)).astimezone(UTC)
        waiting = [d.removeprefix("day=") for d in sinks._list(spark, staged) if d.startswith("day=")]
        ready = [d for d in waiting if datetime.fromisoformat(d).replace(tzinfo=UTC) + timedelta(hours=age_hours) <= at]
        if not ready:
            return
        done = {d for d, v in sinks.day_versions(spark, path).items() if v >= number}  # by this batch, before a crash
        new = [d for d in ready if d not in done]
        if new:
            shape = StructType([*(f for f in df.schema.fields if f.name != "day"), StructField("day", StringType()), StructField("batch", LongType())])
            fresh = spark.read.schema(shape).option("basePath", staged).parquet(*[f"{staged}/day={d}" for d in new])
            fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields])
            sinks.write_versions(sinks.read_versions(spark, path, df.schema, new).unionByName(fresh), path, number, new)
        for d in ready:
            sinks._remove(spark, f"{staged}/day={d}")

    return batch


def process_days(stream: DataFrame, path: str, checkpoint: str, now: Callable[[], datetime] | None = None, age_hours: int = 26):
    """Each UTC ``day`` once it is ``age_hours`` old, whole: rows wait until then, and a day that is old enough is written and in sight
    at once (``sinks.read_versions``). Rows that come later have their day written again, whole. A repeated batch changes nothing;
    the checkpoint is the resume point."""
    return stream.writeStream.foreachBatch(day_batches(path, now, age_hours)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _wait_until(handle: StatefulProcessorHandle, due_us: list[int]) -> None:
    """One timer, for the first of the times."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    if due_us:
        handle.registerTimer(min(due_us) // 1000 + 1)


class SilenceAlert(StatefulProcessor):
    """``silent`` once when a key has had nothing for ``gap_us`` after its last data, ``back`` once when it has data again. With
    ``by_day`` data counts for its whole day, so the gap is of days without any. A key of the initial state is expected from its time on.

    Rows wait until the watermark has passed them, so that rows in any order within it give the same alerts; of a
    day (``by_day``) only the first and the last are held."""

    def __init__(self, gap_us: int, by_day: bool):
        self.gap_us, self.by_day = gap_us, by_day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "last_us long, silent boolean")
        self.waiting = handle.getListState("waiting", "t_us long")

    def _due(self, last_us: int) -> int:
        start = (last_us // DAY_US + 1) * DAY_US if self.by_day else last_us
        return start + self.gap_us

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        last = int(initialState["last_us"].iloc[0])
        self.state.update((last, False))
        _wait_until(self.handle, [self._due(last)])

    def _settle(self, key, times: list[int], now_us: int) -> pd.DataFrame:
        """Alerts of what the watermark has passed; the rest waits."""
        last, silent = self.state.get() if self.state.exists() else (None, False)
        out, times = [], sorted(times)
        for t in times:
            if t >= now_us:
                break
            if last is not None and (silent or t >= self._due(last)):
                out += [] if silent else [("silent", self._due(last))]
                out.append(("back", t))
                silent = False
            last = t if last is None else max(last, t)
        rest = [t for t in times if t >= now_us]
        if self.by_day:
            rest = sorted({f([t for t in rest if t // DAY_US == day]) for day in {t // DAY_US for t in rest} for f in (min, max)})
        if last is not None and not silent and self._due(last) < now_us:
            silent = True
            out.append(("silent", self._due(last)))
        if last is not None:
            self.state.update((last, silent))
        if rest:
            self.waiting.put([(t,) for t in rest])
        else:
            self.waiting.clear()
        _wait_until(self.handle, rest[:1] + ([] if silent or last is None else [self._due(last)]))
        return self._frame(key, out)

    def _held(self) -> list[int]:
        return [r[0] for r in self.waiting.get()] if self.waiting.exists() else []

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = self._held() + [t for part in rows for t in part["t_us"].tolist()]
        yield self._settle(key, times, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settle(key, self._held(), timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(key, rows) -> pd.DataFrame:
        return pd.DataFrame({"key": _text([str(key[0])] * len(rows)), "alert": _text([r[0] for r in rows]), "at_us": [int(r[1]) for r in rows]})


DAY_US = 86_400_000_000
ALERTS = "key string, alert string, at_us long"


def dark_stations(data: DataFrame, days: int = 3, expected: DataFrame | None = None, late: str = "1 day") -> DataFrame:
    """``(key, alert, at_us)`` of stations ``data(station, time, t_us)``: dark once after ``days`` whole days without data, back
    once on return. Stations ``expected(station, last_us)`` that never send are dark from there on."""
    keyed = data.select("station", "time", "t_us").withWatermark("time", late).groupBy("station")
    first = expected.select("station", "last_us").groupBy("station") if expected is not None else None
    return keyed.transformWithStateInPandas(
        statefulProcessor=SilenceAlert(days * DAY_US, True), outputStructType=ALERTS, outputMode="Append", timeMode="EventTime", initialState=first
    )


def quiet_network(events: DataFrame, hours: int = 48, late: str = "1 hour") -> DataFrame:
    """Alerts of a network ``events(network, time, t_us)`` that has had no event for ``hours``, and of its first one after."""
    keyed = events.select("network", "time", "t_us").withWatermark("time", late).groupBy("network")
    return keyed.transformWithStateInPandas(
        statefulProcessor=SilenceAlert(hours * 3_600_000_000, False), outputStructType=ALERTS, outputMode="Append", timeMode="EventTime"
    )


class ChunkFollowUp(StatefulProcessor):
    """``again`` for each answer that leaves a chunk short, ``complete`` for the one that fills it, ``accepted`` when a
    short one is ``days`` old; one whose last attempt failed goes on being asked for (``again``).

    A complete or accepted chunk is settled: answers that come later, of attempts before or after, change nothing. Its state
    goes when the watermark passes ``days``."""

    def __init__(self, days: int, least: float):
        self.window_us, self.least = days * DAY_US, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "end_us long, at_us long, status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        answers, out = pd.concat(list(rows)).sort_values("t_us"), []
        end, last, state = self.state.get() if self.state.exists() else (None, None, None)
        for end_us, at, status, coverage in zip(*(answers[c].tolist() for c in ("end_us", "t_us", "status", "coverage")), strict=True):
            end = int(end_us)
            if state in ("complete", "accepted"):
                continue
            if status == "success" and (coverage != coverage or coverage is None or coverage >= self.least):
                state = "complete"
            elif last is not None and at < last:
                out.append("again")  # an attempt of before: the last one decides how it goes on
                continue
            else:
                state = status if status == "failed" or at <= end + self.window_us else "accepted"
            last = int(at)
            out.append(state if state in ("complete", "accepted") else "again")
        self.state.update((end, last, state))
        _wait_until(self.handle, [end + self.window_us] if state != "failed" else [])
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.state.get()[2]
        self.state.clear()
        yield self._frame(key, [] if state in ("complete", "accepted") else ["accepted"])

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(key, actions) -> pd.DataFrame:
        return pd.DataFrame({"station": _text([key[0]] * len(actions)), "start_us": [int(key[1])] * len(actions), "action": _text(actions)})


def follow_chunks(answers: DataFrame, days: int = 7, least: float = 0.99, late: str = "1 hour") -> DataFrame:
    """``(station, start_us, action)`` for each of ``answers(station, start_us, end_us, time, t_us, status, coverage)``, ``time`` that of
    the attempt: late data is asked for again for ``days`` after a chunk's end, then what there is is accepted."""
    keyed = answers.withWatermark("time", late).groupBy("station", "start_us")
    return keyed.transformWithStateInPandas(
        statefulProcessor=ChunkFollowUp(days, least), outputStructType="station string, start_us long, action string", outputMode="Append", timeMode="EventTime"
    )


class SeamDedup(StatefulProcessor):
    """Of picks of one station and phase at most ``gap_us`` apart the more probable (then the earlier) stays: a pick that no taken
    one is so close to is taken, the most probable first.

    A pick is decided once the watermark has passed it by ``gap_us``, since then all its neighbours are there, and no better
    neighbour is undecided. So the picks may come in any order within the watermark. The state has the undecided
    picks and those taken that a pick to come could still be close to; picks behind the watermark are given up."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "t_us long, probability double, taken boolean")

    def _held(self) -> list[tuple[int, float, bool]]:
        return [(int(t), float(p), bool(k)) for t, p, k in self.held.get()] if self.held.exists() else []

    def _settle(self, key, picks: list[tuple[int, float, bool]], now_us: int) -> pd.DataFrame:
        picks = sorted(picks)
        times = [t for t, _, _ in picks]
        # undecided None, taken True, dropped False
        state = [True if k else None for _, _, k in picks]
        near = [range(bisect_left(times, t - self.gap_us), bisect_right(times, t + self.gap_us)) for t in times]
        out = []
        for i in sorted(range(len(picks)), key=lambda i: (-picks[i][1], picks[i][0], i)):
            if state[i] is not None:
                continue
            if any(state[j] for j in near[i]):
                state[i] = False
            # better neighbours were looked at before it; one that is still open keeps it open
            elif times[i] + self.gap_us < now_us and not any(state[j] is None and (-picks[j][1], picks[j][0], j) < (-picks[i][1], picks[i][0], i) for j in near[i]):
                state[i] = True
                out.append(picks[i][:2])
        opened = [times[i] for i, k in enumerate(state) if k is None]
        reach = min([now_us, *opened]) - self.gap_us  # a taken pick before it is close to nothing any more
        kept = [(t, p, bool(k)) for (t, p, _), k in zip(picks, state, strict=True) if k is None or (k and t >= reach)]
        if kept:
            self.held.put(kept)
        else:
            self.held.clear()
        waits = [t + self.gap_us for t in opened if t + self.gap_us >= now_us] or [t + self.gap_us for t, _, k in kept if k]
        _wait_until(self.handle, waits)
        return self._frame(key, out)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        new = [(int(t), float(p), False) for part in rows for t, p in zip(part["t_us"].tolist(), part["probability"].tolist(), strict=True) if t >= now_us]
        yield self._settle(key, self._held() + new, now_us)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settle(key, self._held(), timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(key, rows) -> pd.DataFrame:
        return pd.DataFrame({"station": _text([key[0]] * len(rows)), "phase": _text([key[1]] * len(rows)), "t_us": [int(r[0]) for r in rows], "probability": [float(r[1]) for r in rows]})


def seam_dedup(picks: DataFrame, gap_us: int = 1_000_000, late: str = "1 minute") -> DataFrame:
    keyed = picks.withWatermark("time", late).groupBy("station", "phase")
    return keyed.transformWithStateInPandas(
        statefulProcessor=SeamDedup(gap_us), outputStructType="station string, phase string, t_us long, probability double", outputMode="Append", timeMode="EventTime"
    )
