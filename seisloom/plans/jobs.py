"""Queries for jobs, arrays and location on the seismic views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import arrays, continuous, filters, jobs, joins, location, windows
from ..sources import sinks
from .catalog import CORE, rounded
from . import sql
from .views import Views, oracle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql:
            ORACLES[fn.__name__] = oracle(sql)
        return fn

    return add


def segments(v):
    return v.traces().select(F.col("vec_id").alias("key"), "station", "start_us", F.lit(100.0).alias("rate"), "samples")


@query("SELECT event_id, corroborating_picks FROM (SELECT a.event_id, count(*) FILTER (EXISTS (SELECT 1 FROM v_picks q WHERE q.pick_id % 2 = 0 AND q.station = a.station AND q.phase = a.phase AND abs(q.t_us - a.t_us) <= 60000000)) AS corroborating_picks FROM v_assignments a GROUP BY 1) WHERE corroborating_picks >= 2 AND event_id IN (SELECT event_id FROM v_secondary s WHERE NOT EXISTS (SELECT 1 FROM v_primary p WHERE abs(p.t_us - s.t_us) <= 60000000))".replace("count(*) FILTER (EXISTS (SELECT 1 FROM v_picks q WHERE q.pick_id % 2 = 0 AND q.station = a.station AND q.phase = a.phase AND abs(q.t_us - a.t_us) <= 60000000)) AS corroborating_picks FROM v_assignments a GROUP BY 1", "count(*) AS corroborating_picks FROM v_assignments a WHERE EXISTS (SELECT 1 FROM v_picks q WHERE q.pick_id % 2 = 0 AND q.station = a.station AND q.phase = a.phase AND abs(q.t_us - a.t_us) <= 60000000) GROUP BY 1"))
def job09_additions(v):
    p = v.picks()
    kept, _ = jobs.select_additions(v.secondary(), v.assignments(), v.primary(), p.where("pick_id % 2 = 0"), 60, 60, 2)
    return kept.select("event_id", "corroborating_picks")


@query(sql.JOB10)
def job10_dedup(v):
    kept, _, audit = jobs.dedup_catalog(v.catalog(), v.assignments(), 3600, 50)
    return kept.select("event_id", F.lit("kept").alias("what")).unionAll(audit.where("merged").select("event_id", F.lit("dropped").alias("what")))


@query(sql.JOB11)
def job11_candidates(v):
    return jobs.filter_candidates(v.detections(), v.catalog(), 0.5, 2, 0.65, 60, 60)


@query(sql.JOB12)
def job12_promote(v):
    c = jobs.filter_candidates(v.detections(), v.catalog(), 0.5, 2, 0.65, 60, 60)
    return jobs.promote(c, v.catalog(), 5).select("event_id", "t_us", "n_templates", "best_template")


@query(sql.JOB06)
def job06_merge(v):
    c = v.catalog().withColumns({"source": F.when(F.col("n") % 2 == 0, "ep").otherwise("po"), "event_index": F.col("n")}).checkpoint()
    have, place = c.where("day < '2024-01-15'"), ["source", "day", "event_index"]
    source = F.when(F.col("n") % 2 == 0, "ep").otherwise("po")
    new_picks = v.assignments("n", "day").withColumns({"source": source, "event_index": F.col("n")}).drop("event_id", "n")
    ledger = have.select("source", "day").distinct()
    merged = jobs.merge_catalog(have.drop(*place), joins.picks_of(v.assignments(), have), c.drop("event_id"), new_picks, ledger, CORE)
    n = merged.assignments.groupBy("event_id").agg(F.count("*").alias("picks"))
    return merged.catalog.join(n, "event_id", "left").select("event_id", "t_us", F.coalesce("picks", F.lit(0)).alias("picks"))


@query(sql.JOB06_REBUILD)
def job06_rebuild(v):
    """A rebuild with colliding seconds: all origins of an hour fall into one; earlier ids are carried over, reviewed events restored."""
    hour, n, k = F.floor(F.col("t_us") / 3_600_000_000) * 3_600_000_000, F.col("n"), F.col("k")
    c = v.catalog().withColumns({"source": F.when(n % 2 == 0, "ep").otherwise("po"), "event_index": n, "hour_us": hour, "review_status": F.lit(None).cast("string")}).checkpoint()
    place = ["source", "day", "event_index"]
    picks = v.assignments("n", "day").withColumns({"source": F.when(n % 2 == 0, "ep").otherwise("po"), "event_index": n}).drop("event_id", "n")
    fresh = c.drop("event_id").withColumn("t_us", F.col("hour_us") + n % 997 * 1000).withColumn("time", F.timestamp_micros("t_us"))
    old = c.where(k % 2 == 0).drop("event_id").withColumn("time", F.timestamp_micros("hour_us"))
    previous = windows.mint_ids(old, F.col("source"), ["n"]).withColumn("t_us", F.col("hour_us") + n * 7919 % 9973 * 1000).checkpoint()
    reviewed = previous.where(k % 4 == 0).withColumns({
        "event_id": F.when(k % 12 == 4, F.concat(F.lit("rv"), n.cast("string"))).otherwise(F.col("event_id")),
        "t_us": F.col("t_us") + F.when(k % 12 == 0, 1_200_000_000).otherwise(0), "review_status": F.lit("confirmed"),
    }).drop(*place)
    theirs = reviewed.select("event_id", F.lit("AM").alias("network"), F.lit("S00").alias("station"), F.lit("P").alias("phase"), "t_us")
    nothing = fresh.drop(*place).withColumn("event_id", F.lit("")).where("false")
    ledger = fresh.select("source", "day").where("false")
    merged = jobs.merge_catalog(nothing, theirs.where("false"), fresh, picks, ledger, CORE, previous, (reviewed, theirs))
    count = merged.assignments.groupBy("event_id").agg(F.count("*").alias("picks"))
    return merged.catalog.join(count, "event_id", "left").select("event_id", "t_us", F.col("review_status").isNotNull().alias("reviewed"), F.coalesce("picks", F.lit(0)).alias("picks"))


@query("SELECT pick_id, session_us AS session, n FROM (SELECT pick_id, session_us, count(*) OVER (PARTITION BY day, session_us) AS n FROM (SELECT pick_id, day, max(s) OVER (PARTITION BY day ORDER BY t_us ROWS UNBOUNDED PRECEDING) AS session_us FROM (SELECT *, CASE WHEN coalesce(t_us - lag(t_us) OVER (PARTITION BY day ORDER BY t_us) > 60000000, true) THEN t_us END AS s FROM v_picks))) WHERE n >= 3")
def job03_preclusters(v):
    return jobs.precluster(v.picks()).select("pick_id", "session", "n")


@query("SELECT event_id, CASE WHEN k % 2 = 0 THEN 'confirmed' ELSE review_status END AS review_status, CASE WHEN k % 2 = 0 THEN 'explosion' ELSE event_type END AS event_type FROM v_catalog")
def job20_reviews(v):
    d = v.catalog().where("k % 2 = 0").select("event_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("timestamp"))
    d = d.withColumns({"review_status": F.when(F.col("timestamp") == 2, "confirmed").otherwise("rejected"), "event_type": F.lit("explosion")})
    return jobs.apply_reviews(v.catalog(), d).select("event_id", "review_status", "event_type")


@query("""SELECT event_id, round(sqrt((k % 7 * 0.01e0 * 111.32e0 * cos(radians(latitude - k % 5 * 0.01e0))) ** 2 + (k % 5 * 0.02e0 * 111.32e0) ** 2), 5) AS offset_km, (k % 4 - 1)::DOUBLE AS depth_offset_km
FROM v_catalog WHERE k % 9 <> 0""")
def job19_compare(v):
    """Shifts that differ from event to event; events that only one list has are left out."""
    c, k = v.catalog(), F.col("k")
    moved = c.where(k % 9 != 0).withColumns({"longitude": F.col("longitude") + k % 7 * 0.01, "latitude": F.col("latitude") - k % 5 * 0.02, "depth_km": F.col("depth_km") + k % 4 - 1})
    return rounded(location.compare_locations(c, moved), "offset_km", digits=5)


@query("SELECT event_id FROM v_catalog WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND coalesce(review_status, '') <> 'rejected'")
def snk05_export(v):
    return sinks.export_catalog(v.catalog(), "2024-01-05", "2024-01-20").select("event_id")


@query("SELECT event_id, CASE event_type WHEN 'quarry_blast' THEN 'quarry blast' WHEN 'earthquake' THEN 'earthquake' ELSE 'not reported' END AS type, depth_km * 1000 AS depth_m, coalesce(m, 0) AS n FROM v_catalog LEFT JOIN (SELECT event_id, count(*) AS m FROM v_assignments GROUP BY 1) USING (event_id)")
def snk06_nested(v):
    out = sinks.export_events_nested(v.catalog(), v.assignments())
    return out.select("event_id", "type", F.col("origin.depth_m").alias("depth_m"), F.coalesce(F.when(F.col("picks").isNotNull(), F.size("picks")), F.lit(0)).cast("long").alias("n"))


@query("SELECT key, start_us + CAST(round(first * 1e6 / 100.0e0) AS BIGINT) AS start_us, count(*) AS n FROM (SELECT key, start_us, i, min(i) OVER (PARTITION BY key, g) AS first FROM (SELECT *, i - row_number() OVER (PARTITION BY key ORDER BY i) AS g FROM (SELECT vec_id AS key, start_us, i - 1 AS i, samples[i] AS v FROM (SELECT *, unnest(generate_series(1, len(samples))) AS i FROM v_traces)) WHERE abs(v) <= 0.2)) GROUP BY key, start_us, first")
def arr01_mask(v):
    return arrays.mask_impossible(segments(v), 0.2).select("key", "start_us", F.size("samples").cast("long").alias("n"))


@query("SELECT series AS key, idx, round(CASE WHEN idx % 5 IN (2, 3) THEN a + (b - a) * (idx % 5 - 1) / 3.0e0 ELSE value END, 4) AS filled FROM (SELECT *, max(value) FILTER (idx % 5 = 1) OVER (PARTITION BY series, idx // 5) AS a, max(value) FILTER (idx % 5 = 4) OVER (PARTITION BY series, idx // 5) AS b FROM v_series)")
def arr02_interpolate(v):
    s = v.series().withColumn("value", F.when(~(F.col("idx") % 5).isin(2, 3), F.col("value")))
    out = arrays.interpolate_gaps(s, "series", "idx", "value")
    return out.select(F.col("series").alias("key"), "idx", F.round("filled", 4).alias("filled"))


@query(sql.ARR03)
def arr03_split_days(v):
    return arrays.split_by_day(segments(v).withColumn("start_us", F.col("start_us") * 100 + 0)).select("key", "start_us", F.size("samples").cast("long").alias("n"))


@query("SELECT vec_id AS key, len(list_filter(range(len(samples)), lambda i: i % greatest(len(samples) // 10, 1) = 0))::BIGINT AS n FROM v_traces")
def arr15_thin(v):
    return arrays.thin(segments(v), 10).select("key", F.size("samples").cast("long").alias("n"))


@query(sql.ARR10)
def arr10_windows(v):
    return arrays.cut_windows(segments(v), 30, 20).select("key", "first", F.round(F.array_max("window"), 6).alias("peak"))


@query(sql.ARR12)
def arr12_bandpass(v):
    return arrays.bandpass(segments(v), ["key"], 2.0, 20.0).select("key", F.round(F.array_max("samples"), 6).alias("peak"))


@query(sql.ARR16)
def arr16_spectrogram(v):
    return arrays.spectrogram(segments(v), ["key"]).groupBy("key").agg(F.count("*").alias("n"), F.round(F.avg("power"), 6).alias("mean"))


@query(sql.ARR17)
def arr17_match(v):
    s = v.traces().select(F.floor(F.col("vec_id") / 50).alias("chunk"), F.lit("EHZ").alias("channel"), "vec_id", "samples")
    s = s.groupBy("chunk", "channel").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("vec_id", "samples"))), lambda x: x["samples"])).alias("samples"))
    t = v.traces().where("vec_id % 50 = 0").select(F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("template_id"), F.lit("EHZ").alias("channel"), F.lit(0).alias("offset"), "samples")
    return arrays.match_templates(s, t, 8.0).select("template_id", "chunk", "idx", F.round("cc", 4).alias("cc"))


def ways(samples: str) -> list:
    """Three channels made of a trace."""
    x = F.col(samples)
    return [F.struct(F.lit(c).alias("channel"), F.lit(o).alias("offset"), y.cast("array<double>").alias("samples")) for c, o, y in (
        ("E", 0, x), ("N", 3, F.reverse(x)), ("Z", -2, F.transform(x, lambda v: v.cast("double") * v.cast("double"))),
    )]


@query(sql.ARR17_DAYS)
def arr17_days(v):
    """Three channels with offsets over days of five chunks, templates over their edges included."""
    each = v.traces().select("vec_id", F.explode(F.array(*ways("samples"))).alias("x")).select("vec_id", "x.*")
    rows = each.groupBy(F.floor(F.col("vec_id") / 250).alias("day"), F.floor(F.col("vec_id") % 250 / 50).alias("c"), "channel")
    rows = rows.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("vec_id", "samples"))), lambda x: x["samples"])).alias("samples"))
    rows = rows.select("day", (F.col("c") * 3200).cast("long").alias("first"), "channel", "samples")
    t = each.where("vec_id % 50 = 0").select(F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("template_id"), "channel", "offset", "samples")
    return continuous.match_days(rows, t, 7.0).select("template_id", "day", "idx", "n_chans", F.round("cc", 4).alias("cc"), F.round("mad", 5).alias("mad"))


@query(sql.ARR12_CHUNKS)
def arr12_chunks(v):
    """Each trace filtered as a part of the ten that adjoin."""
    s = v.traces().select(F.floor(F.col("vec_id") / 10).alias("key"), F.col("vec_id"), (F.lit(1704067200000000) + F.col("vec_id") * 640000).alias("start_us"), F.lit(100.0).alias("rate"), "samples")
    out = continuous.filter_continuous(s, ["key"], 2.0, 20.0)
    return out.select(((F.col("start_us") - 1704067200000000) / 640000).cast("long").alias("key"), F.round(F.array_max("samples"), 6).alias("peak"))


@query(sql.ARR09_PADDED)
def arr09_padded(v):
    s = v.traces().select(F.floor(F.col("vec_id") / 100).alias("key"), "start_us", F.lit(100.0).alias("rate"), "samples")
    first = F.floor((F.col("start_us") - 1704067200000000) / 3_200_000)
    chunks = s.select(F.explode(F.array(first, F.floor((F.col("start_us") + 630_000 - 1704067200000000) / 3_200_000))).alias("c")).distinct()
    chunks = chunks.select((F.lit(1704067200000000) + F.col("c") * 3_200_000).alias("start_us")).withColumn("end_us", F.col("start_us") + 3_200_000)
    padded = continuous.padded_chunks(s, chunks, ["key"], 100.0, 500_000)
    own = continuous.trimmed(padded, 100.0, "valid").select("key", "start_us", F.size(F.filter("valid", lambda x: x)).cast("long").alias("own"))
    total = F.round(F.aggregate("samples", F.lit(0.0), lambda a, x: a + x), 5)
    return padded.select("key", "start_us", F.size(F.filter("valid", lambda x: x)).cast("long").alias("valid"), total.alias("total")).join(own, ["key", "start_us"])


def fixed_model():
    """Stands for a trained one: a score of each sample of a window for two phases, in steps of 1/64."""
    import numpy as np

    def predict(x):
        steps = lambda y: np.floor(np.clip(y, 0, 1) * 64) / 64
        return np.concatenate([steps(np.abs(x) * 3), steps(-x * 4)], axis=1).astype(np.float32)

    return predict


@query(sql.UDF01)
def udf01_detect(v):
    s = v.traces().select(F.floor(F.col("vec_id") / 100).alias("key"), "start_us", F.lit(100.0).alias("rate"), "samples")
    first = F.floor((F.col("start_us") - 1704067200000000) / 3_200_000)
    chunks = s.select(F.explode(F.array(first, F.floor((F.col("start_us") + 630_000 - 1704067200000000) / 3_200_000))).alias("c")).distinct()
    chunks = chunks.select((F.lit(1704067200000000) + F.col("c") * 3_200_000).alias("start_us")).withColumn("end_us", F.col("start_us") + 3_200_000)
    out = jobs.detect(s, chunks, ["key"], fixed_model, ["P", "S"], 100.0, 0.5, 120, 80, 0.7, 0.05)
    return out.select("key", "phase", "t_us", F.round("probability", 6).alias("probability"))


@query(sql.JOB13)
def job13_travel_times(v):
    depths = v.catalog().select("depth_km").distinct()
    distances = v.catalog().select(F.round(F.col("k").cast("double")).alias("distance_km")).distinct()
    return location.build_tt(depths, distances).withColumn("t", F.round("t", 5))
