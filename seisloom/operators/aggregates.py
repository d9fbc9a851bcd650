"""Counts, statistics and reports on picks, catalogs, archives and runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, scalars
from ..functions.scalars import SECOND
from .joins import PLACE, missing_station_days, with_corroborated, with_station


def qc_stations(events: DataFrame, assignments: DataFrame, least: int = 3) -> DataFrame:
    rows = assignments.where("network is not null and station is not null").select("event_id", "network", "station").repartition("event_id")
    good = rows.distinct().groupBy("event_id").agg(F.count("*").alias("n_")).where(F.col("n_") >= least)
    return events.join(good.select("event_id"), "event_id", "left_semi")


def qc_phases(events: DataFrame, assignments: DataFrame, least_p: int = 3, least_s: int = 1) -> DataFrame:
    if not least_p and not least_s:
        return events
    n = assignments.groupBy("event_id").agg(F.count_if(F.col("phase") == "P").alias("p_"), F.count_if(F.col("phase") == "S").alias("s_"))
    return events.join(n.where((F.col("p_") >= least_p) & (F.col("s_") >= least_s)).select("event_id"), "event_id", "left_semi")


def network_ml(assignments: DataFrame, events: DataFrame, stations: DataFrame) -> DataFrame:
    """``(event_id, ml, ml_err, num_ml_sta)``: median, sample deviation and number of station magnitudes."""
    place = events.select("event_id", F.col("latitude").alias("e_lat"), F.col("longitude").alias("e_lon"), "depth_km")
    rows = with_station(assignments, stations).join(place, "event_id")
    # a column for each step, and nulls left to the aggregates: inlined into a filter, distances would be worked out some twenty times a pick
    rows = rows.where("amplitude > 0").withColumn("d_", geo.haversine_km(F.col("e_lat"), F.col("e_lon"), F.col("latitude"), F.col("longitude")))
    rows = rows.withColumn("r_", geo.hypo_km(F.col("d_"), F.col("depth_km"))).select("event_id", geo.ml_station(F.col("amplitude"), F.col("r_")).alias("ml_"))
    out = rows.groupBy("event_id").agg(F.median("ml_").alias("ml"), F.stddev_samp("ml_").alias("ml_err"), F.count("ml_").alias("num_ml_sta"))
    return out.where("num_ml_sta > 0")


def chunk_coverage(got: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Mean over expected channels of the share received, each at most 1; without expectation the
    channels that came count as full ones. ``got(keys, channel, n)``, ``expected(keys, channel, want)``."""
    received = got.groupBy(*keys, "channel").agg(F.sum("n").alias("n"))
    due = expected.join(received, [*keys, "channel"], "left")
    share = F.when(F.col("want") > 0, F.least(F.coalesce("n", F.lit(0)) / F.col("want"), F.lit(1.0))).otherwise(0.0)
    return due.groupBy(*keys).agg(F.round(F.avg(share), 4).alias("coverage"))


def run_outcome(chunks: DataFrame, unreachable: int, stations: int) -> DataFrame:
    """One row: counters and ok, partial or total_failure."""
    n = chunks.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "no_data", "failed", "skipped", "short")])
    problems = (F.col("failed") > 0) | F.lit(unreachable > 0) | (F.col("short") > 0)
    nothing = (F.col("success") + F.col("no_data") + F.col("skipped") == 0) | F.lit(unreachable >= stations)
    return n.withColumn("outcome", F.when(~problems, "ok").when(nothing, "total_failure").otherwise("partial"))


def corroboration_counts(assignments: DataFrame, primary_picks: DataFrame, seconds: float = 1.0) -> DataFrame:
    rows = with_corroborated(assignments.select("event_id", *PLACE, "t_us"), primary_picks, seconds)
    return rows.groupBy("event_id").agg(F.count_if("corroborated").alias("corroborating_picks"))


def triage_features(events: DataFrame, assignments: DataFrame, core: list[str]) -> DataFrame:
    # one shuffle serves the stations of an event and the event; distinct counts in one step would shuffle each row three times
    each = assignments.select("event_id", "station").repartition("event_id").groupBy("event_id", "station").agg(F.count("*").alias("n_"))
    n = each.groupBy("event_id").agg(F.sum("n_").alias("n_picks"), F.count("station").alias("n_stations"), F.count_if(F.col("station").isin(core)).alias("n_core"))
    rows = events.join(n, "event_id", "left")
    return rows.fillna(0, ["n_picks", "n_stations", "n_core"])


def catalog_stats(catalog: DataFrame, picks: DataFrame, stations: DataFrame) -> DataFrame:
    c = catalog.agg(
        F.count("*").alias("n_events"), F.min("magnitude").alias("min_mag"), F.max("magnitude").alias("max_mag"),
        F.max_by("event_id", F.struct("t_us", "event_id")).alias("latest"), F.count("review_status").alias("n_reviewed"), F.countDistinct("day").alias("event_days"),
    )
    p = picks.agg(F.count("*").alias("n_picks"), F.countDistinct("day").alias("pick_days"))
    return c.join(F.broadcast(p)).join(F.broadcast(stations.agg(F.count("*").alias("n_stations"))))


def station_contributions(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("event_id", "station").agg(F.count_if(F.col("phase") == "P").alias("p"), F.count_if(F.col("phase") == "S").alias("s"))


def event_rate(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("day").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """``(bin, low, centre, n)``, empty bins included, the last bin closed."""
    v = F.col(value)
    lo = F.floor(F.min(v) / width).alias("lo")
    span = F.greatest(F.ceil(F.max(v) / width) - F.floor(F.min(v) / width), F.lit(1)).alias("bins")
    ends = df.agg(lo, span).where("lo is not null")
    bins = ends.select("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1)).alias("bin"), "bins")
    at = df.where(v.isNotNull()).join(F.broadcast(ends)).select(F.least(F.floor(v / width) - F.col("lo"), F.col("bins") - 1).alias("bin"))
    n = at.groupBy("bin").agg(F.count("*").alias("n"))
    low = (F.col("lo") + F.col("bin")) * width
    return bins.join(n, "bin", "left").select("bin", low.alias("low"), (low + width / 2).alias("centre"), F.coalesce("n", F.lit(0)).alias("n"))


def magnitude_frequency(catalog: DataFrame, width: float = 0.1) -> DataFrame:
    """Bins with counts and reverse cumulative counts, and on each the fit: Mc (the first fullest bin) and
    a, b and R² by least squares of log10 N on the bins from Mc on."""
    bins = histogram(catalog, "magnitude", width)
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)  # a row for each bin
    bins = bins.withColumn("cumulative", F.sum("n").over(down))
    mc = bins.agg(F.min_by("centre", F.struct(-F.col("n"), F.col("bin"))).alias("mc"))
    rows = bins.join(F.broadcast(mc))
    y, x = F.log10("cumulative"), F.col("centre")
    above = rows.where((F.col("centre") >= F.col("mc")) & (F.col("cumulative") > 0))
    fit = above.agg((-F.regr_slope(y, x)).alias("b_value"), F.regr_intercept(y, x).alias("a_value"), F.regr_r2(y, x).alias("r_squared"))
    return rows.join(F.broadcast(fit))


#: Ranges counted in a pass of a selection.
RANGES = 4096


def order_statistic(df: DataFrame, column: str, rank: int) -> float | None:
    """The value of ``rank`` (from 0) among the sorted values of ``column``, nulls left out, nan last; None beyond them.

    Exact, and without a sort: a pass counts equal ranges between the least and the greatest value, and the next one goes on between the
    least and the greatest value in the range of the rank, until these are equal. A pass ends in some ``RANGES`` rows, summed before they are
    shuffled, and makes the span as many times narrower (of the logarithms at first), so doubles take eight or so, however many there are."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    low, high, n, nans = rows.agg(F.min(F.when(~F.isnan("x"), F.col("x"))), F.max(F.when(~F.isnan("x"), F.col("x"))), F.count_if(~F.isnan("x")), F.count_if(F.isnan("x"))).first()
    if rank < 0 or rank >= n + nans:
        return None
    if rank >= n:
        return float("nan")
    rows = rows.where(~F.isnan("x"))
    infinite = [v for v in (low, high) if abs(v) == float("inf")]
    if infinite:  # ranges need finite ends
        below, above = rows.where("x = double('-infinity')").count(), rows.where("x = double('infinity')").count()
        if rank < below or rank >= n - above:
            return float("-inf") if rank < below else float("inf")
        rank, rows = rank - below, rows.where("abs(x) < double('infinity')")
        low, high = rows.agg(F.min("x"), F.max("x")).first()
    while low < high:
        x = F.col("x")
        if low <= 0 <= high:
            at = F.signum(x)
        else:
            # even ranges of the logarithm until the ends are within a factor of two, then of the value; both never fall with x
            side, scale = (1 if low > 0 else -1), max(abs(low), abs(high)) > 2 * min(abs(low), abs(high))
            y, ends = (side * F.log(F.abs(x)), sorted(side * math.log(abs(v)) for v in (low, high))) if scale else (x, [low, high])
            at = F.floor((y - ends[0]) * (RANGES / (ends[1] - ends[0]))) if ends[1] - ends[0] > 1e-300 else (x > low).cast("int")
        counts = rows.where(F.col("x").between(low, high)).groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for r in sorted(counts.collect()):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low


def depth_distribution(catalog: DataFrame, width: float = 1.0) -> DataFrame:
    """Depth bins with the mean and the upper median (element n // 2 of the sorted depths)."""
    depths = catalog.where("depth_km is not null")
    total, mean = depths.agg(F.count("*"), F.avg("depth_km")).first()
    median = order_statistic(depths, "depth_km", total // 2)
    return histogram(depths, "depth_km", width).withColumns({"median_depth": F.lit(median).cast("double"), "mean_depth": F.lit(mean).cast("double")})


def pick_quality(picks: DataFrame) -> DataFrame:
    """Ten probability bins (the last closed) with P and S counts."""
    b = F.least(F.floor(F.col("probability") * 10 + 1e-9), F.lit(9)).cast("long")
    return picks.groupBy(b.alias("bin")).agg(F.count_if(F.col("phase") == "P").alias("p"), F.count_if(F.col("phase") == "S").alias("s"))


def station_days(rows: DataFrame, stations: DataFrame, first: str, last: str) -> DataFrame:
    """Counts of ``rows(station, day)`` for every station and day of a span."""
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    grid = stations.select("station", days.alias("day"))
    n = rows.groupBy("station", "day").agg(F.count("*").alias("n_"))
    return grid.join(n, ["station", "day"], "left").select("station", "day", F.coalesce("n_", F.lit(0)).alias("n"))


def completeness(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """The richer of two archives for each station and day."""
    n = [x.groupBy("station", "day").agg(F.count("*").alias("n")) for x in (raw, processed)]
    return n[0].unionByName(n[1]).groupBy("station", "day").agg(F.max("n").alias("n"))


def station_health(files: DataFrame, stations: DataFrame, days: int = 3, least_files: int = 3) -> DataFrame:
    """ok, warning, error, retired or unknown by the latest populated days."""
    latest = files.groupBy("day").agg(F.count("*").alias("n")).where(F.col("n") >= least_files).orderBy(F.desc("day")).limit(days).select("day")
    number = latest.agg(F.count("*").alias("days"))
    found = files.join(F.broadcast(latest), "day").groupBy("station").agg(F.countDistinct("day").alias("found"))
    rows = stations.join(found, "station", "left").join(F.broadcast(number)).withColumn("found", F.coalesce("found", F.lit(0)))
    status = (
        F.when(F.col("days") == 0, "unknown").when(F.col("end_date").isNotNull(), "retired").when(F.col("found") == F.col("days"), "ok")
        .when(F.col("found") > 0, "warning").otherwise("error")
    )
    recent = F.when(status.isin("retired", "unknown"), 0).otherwise(F.col("found"))
    return rows.select("station", status.alias("status"), recent.alias("files_recent"))


def throughput(day_times: DataFrame, steps: DataFrame, remaining_days: int) -> DataFrame:
    """Mean and last day, estimated rest, and the mean of each step. ``day_times(day, total)``, ``steps(day, step, seconds)``."""
    total = day_times.where("total > 0").agg(F.avg("total").alias("avg_day_sec"), F.max_by("total", "day").alias("last_day_sec"), F.count("*").alias("sample_size"))
    total = total.withColumn("eta_sec", F.lit(remaining_days) * F.col("avg_day_sec"))
    return steps.groupBy("step").agg(F.avg("seconds").alias("step_avg_sec")).join(F.broadcast(total))


def progress(stages: DataFrame, eligible_days: int) -> DataFrame:
    """``stages(stage, day)``: distinct days, last day and share of the eligible days."""
    days = stages.groupBy("stage").agg(F.countDistinct("day").alias("days"), F.max("day").alias("last_day"))
    done = F.least("days", F.lit(eligible_days))
    return days.withColumn("percent", 100.0 * done / F.lit(max(eligible_days, 1)))


def dark_stations(stations: DataFrame, present: DataFrame, first: str, last: str) -> DataFrame:
    """Stations due on every day of a span and absent on all."""
    days = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date")) + 1
    gone = missing_station_days(stations, present, first, last).groupBy("station").agg(F.count("*").alias("n"))
    return gone.where(F.col("n") == days).select("station")


def dark_transitions(before: DataFrame, now: DataFrame) -> DataFrame:
    dark = now.join(before, "station", "left_anti").withColumn("change", F.lit("dark"))
    back = before.join(now, "station", "left_anti").withColumn("change", F.lit("recovered"))
    return dark.unionByName(back)


def quiet_check(catalog: DataFrame, now_us: Column | int, hours: float = 48) -> DataFrame:
    age = (F.lit(now_us) - F.max("t_us")) / (3600.0 * SECOND)
    return catalog.agg(age.alias("hours_since")).withColumn("quiet", F.col("hours_since") > hours)


def significant(catalog: DataFrame, now_us: int, magnitude: float = 4.0, hours: float = 24) -> DataFrame:
    return catalog.where((F.col("magnitude") >= magnitude) & F.col("t_us").between(now_us - int(hours * 3600 * SECOND), now_us))


def scan_gaps(stations: DataFrame, present: DataFrame, done: DataFrame, first: str, last: str) -> DataFrame:
    """Days with stations missing, and days with data but no events output."""
    missing = missing_station_days(stations, present, first, last).groupBy("day").agg(F.array_join(F.array_sort(F.collect_set("station")), ",").alias("missing"))
    without = present.select("day").distinct().join(done, "day", "left_anti").withColumn("no_events", F.lit(True))
    out = missing.join(without, "day", "full")
    return out.select("day", F.coalesce("missing", F.lit("")).alias("missing"), F.coalesce("no_events", F.lit(False)).alias("no_events"))


def next_day(processed: DataFrame, done: DataFrame, start: str) -> DataFrame:
    """The day after the last one that has both processed data and its marker."""
    both = processed.select("day").distinct().join(done.select("day").distinct(), "day", "left_semi")
    return both.agg(F.coalesce(F.date_add(F.max("day"), 1), F.lit(start).cast("date")).alias("day"))


def storage_by_stage(inventory: DataFrame) -> DataFrame:
    """Bytes and files of each stage, and of all (null stage)."""
    return inventory.rollup("stage").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def issues(logs: DataFrame, steps: DataFrame, n: int = 50) -> DataFrame:
    """The newest of log issues and failed steps."""
    return logs.unionByName(steps, allowMissingColumns=True).orderBy(F.desc("t_us"), "message").limit(n)


def days_present(*tables: DataFrame) -> DataFrame:
    """Days that any of the tables has."""
    out = tables[0].select("day")
    for other in tables[1:]:
        out = out.unionAll(other.select("day"))
    return out.distinct()


def day_span(segments: DataFrame) -> DataFrame:
    return segments.groupBy("day").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"))


def import_summary(segments: DataFrame, keys: list[str]) -> DataFrame:
    first_of = Window.partitionBy(*keys, "channel", "start_us", "end_us")
    rows = segments.withColumn("copy_", F.row_number().over(first_of.orderBy("file")))
    return rows.groupBy(*keys).agg(
        F.countDistinct("file").alias("files"), F.count_if(F.col("copy_") == 1).alias("pieces"), F.count_if(F.col("copy_") > 1).alias("duplicates"),
        F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("channels"), F.min("start_us").alias("first_us"), F.max("end_us").alias("last_us"),
    )


def triage_audit(catalog: DataFrame) -> DataFrame:
    """Label by review status, with totals (null)."""
    return catalog.withColumn("review_status", F.coalesce("review_status", F.lit(""))).cube("triage", "review_status").agg(F.count("*").alias("n"))


def picker_metrics(picks: DataFrame, truth: DataFrame, seconds: float) -> DataFrame:
    """Precision, recall, F1 and residuals for each phase, over all pairs within tolerance."""
    from .timejoin import range_join

    w = int(seconds * SECOND)
    pairs = range_join(picks, truth.select("station", "phase", F.col("t_us").alias("true_us")), "t_us", "true_us", -w, w, ("station", "phase"))
    gap = (F.col("t_us") - F.col("true_us")) / SECOND
    tp = pairs.groupBy("phase").agg(F.count("*").alias("tp"), F.avg(gap).alias("mean_s"), F.stddev_pop(gap).alias("std_s"))
    n, m = picks.groupBy("phase").agg(F.count("*").alias("n_picks")), truth.groupBy("phase").agg(F.count("*").alias("n_true"))
    rows = n.join(m, "phase", "full").join(tp, "phase", "left").fillna(0, ["tp", "n_picks", "n_true"])
    p, r = F.col("tp") / F.greatest("n_picks", F.lit(1)), F.col("tp") / F.greatest("n_true", F.lit(1))
    return rows.withColumns({"precision": p, "recall": r}).withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def network_centre(stations: DataFrame) -> DataFrame:
    return stations.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def earliest_origin(catalog: DataFrame, days: DataFrame) -> DataFrame:
    day = days.select(F.unix_micros(F.col("day").cast("timestamp")).alias("t_us"))
    return catalog.select("t_us").unionByName(day).agg(F.min("t_us").alias("t_us"))


def station_detail(stations: DataFrame, files: DataFrame, segments: DataFrame, now: str, days: int = 14) -> DataFrame:
    """State of health of every station: files of each of the last ``days`` days (raw ones, else processed ones), days covered,
    and where the data of the newest covered day end. ``files(station, stage, day)``, ``segments(station, day, end_us)``."""
    today = F.lit(now).cast("timestamp")
    first = F.date_sub(F.to_date(today), days - 1)
    due = stations.select("station", F.explode(F.sequence(first, F.to_date(today), F.expr("INTERVAL 1 DAY"))).alias("day"))
    n = files.where(F.col("day") >= first).groupBy("station", "day").agg(F.count_if(F.col("stage") == "raw").alias("raw_"), F.count_if(F.col("stage") == "processed").alias("done_"))
    rows = due.join(n, ["station", "day"], "left").withColumn("files", F.coalesce(F.when(F.col("raw_") > 0, F.col("raw_")), "done_", F.lit(0)))
    ends = segments.where(F.col("day") >= first).groupBy("station", "day").agg(F.max("end_us").alias("end_"))
    rows = rows.join(ends, ["station", "day"], "left")
    out = rows.groupBy("station").agg(
        F.array_sort(F.collect_list(F.struct("day", "files"))).alias("days"), F.count_if(F.col("files") > 0).alias("days_covered"),
        F.max_by("end_", F.when(F.col("files") > 0, F.col("day"))).alias("last_data_us"),
    )
    return out.withColumn("latency_hours", F.round((F.unix_micros(today) - F.col("last_data_us")) / 3.6e9, 1))


def template_manifest(traces: DataFrame) -> DataFrame:
    """Traces, stations and channels of each template."""
    return traces.groupBy("template_id").agg(
        F.count("*").alias("n_traces"), F.array_sort(F.collect_set("station")).alias("stations"),
        F.array_sort(F.collect_set(F.concat_ws(".", "station", "channel"))).alias("channels"),
    )
