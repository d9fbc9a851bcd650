"""Queries on station state, campaign imports, duplicates, templates and location."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import arrays, jobs, joins, location, windows
from ..sources import sinks
from .jobs import segments
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


@query("""SELECT *, CASE WHEN failed = 0 AND short = 0 THEN 'ok' WHEN success + no_data + skipped = 0 THEN 'total_failure' ELSE 'partial' END AS outcome FROM (
SELECT count(*) FILTER (k % 5 = 2) AS success, count(*) FILTER (k % 5 = 1) AS no_data, count(*) FILTER (k % 5 = 0) AS failed, count(*) FILTER (k % 5 = 3) AS skipped, count(*) FILTER (k % 5 = 4) AS short FROM v_picks)""")
def ag05_run_outcome(v):
    names = F.array(*[F.lit(x) for x in ("failed", "no_data", "success", "skipped", "short")])
    return agg.run_outcome(v.picks().select(names[(F.col("k") % 5).cast("int")].alias("status")), 0, 25)


@query(""", f AS (SELECT station, day, count(*) FILTER (k % 2 = 0) AS raw, count(*) FILTER (k % 2 <> 0) AS done, max(t_us) AS last_us FROM v_picks WHERE day BETWEEN DATE '2024-01-18' AND DATE '2024-01-31' GROUP BY 1, 2)
SELECT s.station, count(f.day) AS days_covered, coalesce(sum(CASE WHEN raw > 0 THEN raw ELSE done END), 0)::BIGINT AS files, max(last_us) AS last_data_us, round((1706680800000000 - max(last_us)) / 3.6e9, 1) AS latency_hours
FROM v_stations s LEFT JOIN f ON f.station = s.station GROUP BY 1""")
def ag17_station_detail(v):
    p = v.picks()
    files = p.select("station", "day", F.when(F.col("k") % 2 == 0, "raw").otherwise("processed").alias("stage"))
    out = agg.station_detail(v.stations(), files, p.select("station", "day", F.col("t_us").alias("end_us")), "2024-01-31 06:00:00")
    return out.select("station", "days_covered", F.aggregate("days", F.lit(0).cast("long"), lambda n, x: n + x["files"]).alias("files"), "last_data_us", "latency_hours")


@query(""", d AS (SELECT 'detect' AS stage, day FROM v_picks UNION ALL SELECT 'catalog', day FROM v_catalog)
SELECT stage, count(DISTINCT day) AS days, strftime(max(day), '%Y-%m-%d') AS last_day, round(100.0e0 * least(count(DISTINCT day), 28) / 28, 6) AS percent FROM d GROUP BY 1""")
def ag18_progress(v):
    days = v.picks().select(F.lit("detect").alias("stage"), "day").unionAll(v.catalog().select(F.lit("catalog"), "day"))
    out = agg.progress(days, 28)
    return out.select("stage", "days", F.col("last_day").cast("string").alias("last_day"), F.round("percent", 6).alias("percent"))


@query(""", d AS (SELECT day, sum(k)::DOUBLE AS total FROM v_catalog GROUP BY 1), s AS (SELECT day, event_type AS step, sum(k)::DOUBLE AS seconds FROM v_catalog GROUP BY 1, 2),
t AS (SELECT avg(total) AS a, max_by(total, day) AS l, count(*) AS n FROM d WHERE total > 0)
SELECT step, round(avg(seconds), 4) AS step_avg_sec, round(any_value(a), 4) AS avg_day_sec, any_value(l) AS last_day_sec, any_value(n) AS sample_size, round(any_value(7 * a), 4) AS eta_sec FROM s, t GROUP BY 1""")
def ag19_throughput(v):
    days = v.catalog().groupBy("day").agg(F.sum("k").cast("double").alias("total"))
    steps = v.catalog().groupBy("day", F.col("event_type").alias("step")).agg(F.sum("k").cast("double").alias("seconds"))
    out = agg.throughput(days, steps, 7)
    return out.withColumns({c: F.round(c, 4) for c in ("step_avg_sec", "avg_day_sec", "eta_sec")})


@query("SELECT strftime(day, '%Y-%m-%d') AS day, min(t_us) AS start_us, max(t_us + k * 1000000) AS end_us FROM v_picks GROUP BY 1")
def ag26_day_span(v):
    rows = v.picks().select("day", F.col("t_us").alias("start_us"), (F.col("t_us") + F.col("k") * 1_000_000).alias("end_us"))
    return agg.day_span(rows).withColumn("day", F.col("day").cast("string"))


@query("""SELECT station, count(DISTINCT k % 7) AS files, count(DISTINCT (phase, t_us // 600000000)) AS pieces, count(*) - count(DISTINCT (phase, t_us // 600000000)) AS duplicates,
string_agg(DISTINCT phase, ',' ORDER BY phase) AS channels, min(t_us // 600000000) AS first_us, max(t_us // 600000000) + 1 AS last_us FROM v_picks GROUP BY 1""")
def ag27_import_summary(v):
    start = F.floor(F.col("t_us") / 600_000_000)
    rows = v.picks().select("station", (F.col("k") % 7).alias("file"), F.col("phase").alias("channel"), start.alias("start_us"), (start + 1).alias("end_us"))
    return agg.import_summary(rows, ["station"])


@query(sql.AG28)
def ag28_candidate_funnel(v):
    out = jobs.candidate_funnel(v.detections(), v.catalog(), 0.5, 2, 0.65, 60, 60)
    return out.select("step", "n", F.col("parameters")["least"].alias("least"), F.col("parameters")["width_s"].alias("width_s"))


@query("""SELECT template_id, count(*) AS n_traces, string_agg(DISTINCT 'S' || (det_id % 25), ',' ORDER BY 'S' || (det_id % 25)) AS stations,
string_agg(DISTINCT 'S' || (det_id % 25) || '.EHZ', ',' ORDER BY 'S' || (det_id % 25) || '.EHZ') AS channels FROM v_detections GROUP BY 1""")
def ag29_template_manifest(v):
    rows = v.detections().select("template_id", F.concat(F.lit("S"), (F.col("det_id") % 25).cast("string")).alias("station"), F.lit("EHZ").alias("channel"))
    out = agg.template_manifest(rows)
    return out.withColumns({c: F.array_join(c, ",") for c in ("stations", "channels")})


@query("SELECT least((SELECT min(t_us) FROM v_catalog WHERE n % 2 = 0), (SELECT epoch_us(min(day)::TIMESTAMP) FROM v_picks)) AS t_us")
def ag33_earliest(v):
    return agg.earliest_origin(v.primary(), v.picks().select("day").distinct())


@query("SELECT station, c AS channel FROM v_stations, unnest(['EHZ', 'EHN', 'HHZ', 'ENZ']) u(c) WHERE c LIKE CASE nk % 2 WHEN 0 THEN 'EH_' ELSE 'E_Z' END AND nk % 7 <> 0")
def jn22_expected_channels(v):
    codes = F.explode(F.array(*[F.lit(c) for c in ("EHZ", "EHN", "HHZ", "ENZ")]))
    s = v.stations().withColumns({"location": F.lit(""), "channels": F.when(F.col("nk") % 2 == 0, "EH?").otherwise("E?Z")})
    inventory = s.select("network", "station", "location", codes.alias("channel"), F.when(F.col("nk") % 7 != 0, 100.0).otherwise(0.0).alias("sample_rate"))
    return joins.expected_channels(s, inventory).select("station", "channel")


@query(sql.JN21)
def jn21_template_names(v):
    t = v.catalog().where("event_type = 'quarry_blast'").select(F.concat(F.lit("ep_t"), F.col("n").cast("string")).alias("template_id"), (F.col("t_us") + 4_000_000).alias("t_us"))
    return joins.plan_template_names(t, v.catalog()).select("template_id", "event_id", "name")


@query("""SELECT event_id, strftime(day + CAST(CASE WHEN k % 5 = 0 THEN 1 WHEN k % 5 = 1 THEN -1 ELSE 0 END AS INTEGER), '%Y-%m-%d') AS day FROM v_catalog WHERE k % 5 <> 4""")
def jn23_event_day(v):
    c = v.catalog().withColumn("event_index", F.col("n"))
    shift = F.when(F.col("k") % 5 == 0, 1).when(F.col("k") % 5 == 1, -1).otherwise(0)
    held = c.select(F.date_add("day", shift).alias("day"), "event_index", F.when(F.col("k") % 5 == 4, F.col("t_us") + 11_000_000).otherwise(F.col("t_us") + 9_000_000).alias("t_us"))
    return joins.event_day(c, held).select("event_id", F.col("day").cast("string").alias("day"))


@query("""SELECT a.event_id, b.event_id AS other_id FROM v_catalog a JOIN v_catalog b ON a.event_id <> b.event_id AND b.t_us BETWEEN a.t_us - 7200000000 AND a.t_us + 7200000000
WHERE a.review_status = 'confirmed' AND sqrt(((b.longitude - a.longitude) * 111.19e0 * cos(radians((a.latitude + b.latitude) / 2))) ** 2 + ((b.latitude - a.latitude) * 111.19e0) ** 2) <= 50.0e0""")
def jn26_near_duplicates(v):
    return joins.near_duplicates(v.catalog().where("review_status = 'confirmed'"), v.catalog(), 7200, 50)


@query(sql.JN25)
def jn25_restore(v):
    """Reviewed events under their id, under an unknown id beside their event, and an hour away under a known id."""
    c, third = v.catalog(), F.col("n") % 3
    snapshot = c.where("review_status is not null").withColumns({
        "event_id": F.when(third == 1, F.concat(F.lit("rv"), F.col("n").cast("string"))).otherwise(F.col("event_id")),
        "t_us": F.col("t_us") + F.when(third == 2, 3_600_000_000).otherwise(1_000_000),
    })
    out, _ = joins.restore_reviewed(c.withColumn("review_status", F.lit(None).cast("string")), v.assignments(), snapshot, joins.picks_of(v.assignments(), snapshot))
    return out.select("event_id", "t_us", "review_status")


@query(sql.WN07)
def wn07_seams(v):
    return windows.dedup_seams(v.picks().select("pick_id", "station", "phase", "t_us", "probability"), 3_600_000_000)


@query(sql.WN10)
def wn10_normalise(v):
    s = v.series().withColumn("channel", F.lit("EHZ"))
    return windows.sliding_normalise(s, "series", "channel", "idx", "value", 40).select("series", "idx", F.round("normalised", 6).alias("normalised"))


@query(sql.WN16)
def wn16_detrigger(v):
    return windows.detrigger(v.detections().select("det_id", "template_id", "t_us", "correlation"), 3_600_000_000)


@query(sql.WN19)
def wn19_skip_duplicates(v):
    start = F.floor(F.col("t_us") / 600_000_000) * 600_000_000 + F.col("k") * 10_000
    rows = v.picks().select("station", "phase", F.col("pick_id").alias("file"), start.alias("start_us"), (start + 600_000_000).alias("end_us"))
    return windows.skip_dup_windows(rows, ["station", "phase"], "file")


@query(""", s AS (SELECT vec_id // 50 AS chunk, vec_id * 64 + i AS g, samples[i + 1]::DOUBLE AS v FROM (SELECT *, unnest(range(64)) AS i FROM v_traces)), p AS (SELECT vec_id, vec_id // 50 AS chunk, vec_id * 64 + 10 AS g FROM v_traces)
SELECT p.vec_id AS pick_id, count(*) = 60 AS "full", round(CASE WHEN count(*) = 60 THEN max(v) ELSE greatest(max(v), 0.0e0) END, 6) AS peak FROM p JOIN s ON s.chunk = p.chunk AND s.g BETWEEN p.g AND p.g + 59 GROUP BY 1""")
def wn22_pick_windows(v):
    t = segments(v).withColumn("chunk", F.floor(F.col("key") / 50))
    p = t.select(F.col("key").alias("pick_id"), "chunk", (F.col("start_us") + 300_000).alias("t_us"))
    out = windows.pick_windows(p, t, ["chunk"], 200_000, 400_000, 640_000)
    return out.select("pick_id", "full", F.round(F.array_max("samples").cast("double"), 6).alias("peak"))


@query("SELECT vec_id // 7 AS template_id, vec_id FROM v_traces WHERE vec_id % 7 <> 3 AND vec_id // 7 IN (SELECT vec_id // 7 FROM v_traces WHERE vec_id % 7 <> 3 GROUP BY 1 HAVING count(*) >= 4)")
def wn23_usable_templates(v):
    t = v.traces().select(F.floor(F.col("vec_id") / 7).alias("template_id"), "vec_id", F.when(F.col("vec_id") % 7 == 3, F.slice("samples", 1, 60)).otherwise(F.col("samples")).alias("samples"))
    return windows.usable_templates(t, 64).select("template_id", "vec_id")


@query("SELECT vec_id // 10 AS chunk, min(start_us) + CASE WHEN vec_id % 10 > 4 THEN 320000 ELSE 0 END AS start_us, count(*) * 64 AS n FROM v_traces GROUP BY vec_id // 10, vec_id % 10 > 4")
def wn14_merge_segments(v):
    gap = F.when(F.col("key") % 10 > 4, 320_000).otherwise(0)
    rows = segments(v).withColumns({"chunk": F.floor(F.col("key") / 10), "start_us": F.col("start_us") + gap})
    return arrays.merge_segments(rows, ["chunk"]).select("chunk", "start_us", F.size("samples").cast("long").alias("n"))


@query("SELECT vec_id AS key, round(list_max(samples)::DOUBLE / (1 + vec_id % 9), 6) AS peak FROM v_traces")
def arr06_velocity(v):
    s = segments(v)
    sensitivity = s.select("key", (1.0 + F.col("key") % 9).alias("sensitivity"))
    return arrays.to_velocity(s, sensitivity, "key").select("key", F.round(F.array_max("samples").cast("double"), 6).alias("peak"))


@query("SELECT strftime(d.day, '%Y-%m-%d') AS day, h.hour, epoch_us(d.day::TIMESTAMP) + h.hour * 3600000000 AS start_us, greatest(epoch_us(d.day::TIMESTAMP) + h.hour * 3600000000 - 40000000, epoch_us(d.day::TIMESTAMP)) AS padded_start_us FROM (SELECT DISTINCT day FROM v_picks) d, (SELECT unnest(range(24)) AS hour) h")
def arr09_chunk_grid(v):
    out = arrays.chunk_grid(v.picks().select("day").distinct())
    return out.select(F.col("day").cast("string").alias("day"), F.col("hour").cast("long").alias("hour"), "start_us", "padded_start_us")


@query("SELECT vec_id AS key, 100 AS n, round(coalesce(list_sum(list_transform(samples[greatest(1 - vec_id * 64 + 32, 1):greatest(132 - vec_id * 64, 0)], lambda x: x::DOUBLE)), 0), 4) AS total FROM v_traces")
def arr04_align_span(v):
    a = 1704067200320000
    out = arrays.align_span(segments(v), a, a + 1_000_000)
    return out.select("key", F.size("samples").alias("n"), F.round(F.aggregate("samples", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query(sql.ARR13)
def arr13_decimate(v):
    return arrays.decimate(segments(v), ["key"], 50.0).select("key", "rate", F.size("samples").alias("n"), F.round(F.array_max("samples"), 6).alias("peak"))


@query("SELECT vec_id AS key, 126 + 1 AS n, round(((samples[1]::DOUBLE + samples[2]::DOUBLE) / 2)::FLOAT::DOUBLE, 5) AS second FROM v_traces")
def arr14_resample(v):
    s = segments(v).withColumn("samples", F.col("samples").cast("array<double>"))
    return arrays.resample_linear(s, 200.0).select("key", F.size("samples").alias("n"), F.round(F.col("samples")[1].cast("double"), 5).alias("second"))


@query("SELECT vec_id AS key, round(list_sum(list_transform(samples, lambda x: CASE WHEN x > 0.1 THEN 0.0e0 ELSE x::DOUBLE END)), 4) AS total FROM v_traces")
def arr18_sanitise(v):
    s = segments(v).withColumn("samples", F.transform("samples", lambda x: F.when(x > F.lit(0.1).cast("double"), F.lit(float("nan"))).otherwise(x)))
    return arrays.sanitise(s).select("key", F.round(F.aggregate("samples", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query(sql.ARR20)
def arr20_extract_picks(v):
    s = segments(v).select("key", "start_us", "rate", F.col("samples").alias("prob"))
    return arrays.extract_picks(s, ["key"], 0.1, 50_000).select("key", "t_us", F.round(F.col("probability").cast("double"), 6).alias("probability"))


@query(sql.JOB02)
def job02_condition(v):
    s = segments(v).withColumn("day", F.to_date(F.timestamp_micros("start_us")))
    epochs = s.select("key", (F.col("start_us") + F.when(F.col("key") % 3 == 0, 100_000).otherwise(-1)).alias("epoch_us"), F.lit(None).cast("long").alias("end_us"))
    out = jobs.condition(s, epochs, s.select("key", F.lit(2.0).alias("sensitivity")), limit=0.3)
    return out.select("key", "start_us", F.size("samples").alias("n"), F.round(F.array_max("samples").cast("double"), 5).alias("peak"))


def placed(v):
    """Stations on the km plane."""
    from ..functions import geo

    x, y = geo.stere_forward(F.col("latitude"), F.col("longitude"))
    return v.stations().select("network", "station", x.alias("sx"), y.alias("sy"))


def table(v, depth_step: int = 5, distance_step: int = 5):
    """Travel times to 20 km depth and 300 km away."""
    depths = v.spark.range(0, 21, depth_step).select(F.col("id").cast("double").alias("depth_km"))
    distances = v.spark.range(0, 301, distance_step).select(F.col("id").cast("double").alias("distance_km"))
    return location.build_tt(depths, distances).checkpoint()


@query()
def job04_associate(v):
    picks = v.picks().join(placed(v), ["network", "station"]).select("pick_id", "station", "phase", "sx", "sy", (F.col("t_us") / 1e6).alias("t_s"))
    side = F.explode(F.sequence(F.lit(-40), F.lit(40), F.lit(10)))
    nodes = v.spark.range(1).withColumn("x", side).withColumn("y", side).withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(20), F.lit(10))))
    nodes = nodes.select(*[F.col(c).cast("double") for c in "xyz"])
    return location.associate(picks, nodes, table(v), 5, 5, 30.0, 3, 2, 1).select("event", "pick_id", F.round("t0", 3).alias("t0"))


@query()
def job18_relocate(v):
    out, _ = jobs.relocate(v.assignments(), v.stations(), table(v), 5, 5)
    return out.select("event_id", "latitude", "longitude", "depth_km", "magnitude", "num_picks", "num_ml_sta")


@query()
def job17_residuals(v):
    _, left = jobs.relocate(v.assignments(), v.stations(), table(v), 5, 5)
    return left.select("event_id", "station", "phase", F.round("residual_s", 4).alias("residual_s"))


@query("""SELECT old, 'ep' || second || CASE WHEN r > 1 THEN '-' || r ELSE '' END AS new FROM (SELECT *, row_number() OVER (PARTITION BY second ORDER BY old) AS r FROM (
SELECT 'ep' || strftime(day, '%Y%m%d') || '-' || lpad((row_number() OVER (PARTITION BY day ORDER BY t_us))::VARCHAR, 4, '0') AS old, strftime(date_trunc('hour', make_timestamp(t_us)), '%Y%m%dT%H%M%S') AS second FROM v_catalog))""")
def job21_plan_ids(v):
    """Times cut to the hour, so that ids collide and get their suffixes; positions are cut to four digits, so those of days of more than 9,999 events repeat."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("day").orderBy("t_us"))
    old = F.concat(F.lit("ep"), F.date_format("time", "yyyyMMdd"), F.lit("-"), F.lpad(n.cast("string"), 4, "0"))
    return jobs.plan_event_ids(v.catalog().select(old.alias("event_id"), F.date_trunc("hour", "time").alias("time")), repeats=True)


@query("SELECT 'S' || (vec_id // 100) AS key, '2024-01-01' AS day, 1704067200000000 + min(vec_id) * 6400000 AS start_us, count(*) * 64 AS n FROM v_traces GROUP BY vec_id // 100")
def job22_import(v):
    """Ten samples a second here, since windows of less than a second would pass for copies of their neighbours."""
    start = F.lit(1704067200000000) + F.col("key") * 6_400_000
    s = segments(v).select(F.concat(F.lit("S"), F.floor(F.col("key") / 100).cast("string")).alias("key"), F.lit("a").alias("file"), start.alias("start_us"), F.lit(10.004).alias("rate"), "samples")
    out = jobs.import_segments(s.unionAll(s.withColumn("file", F.lit("b"))), ["key"])
    return out.select("key", F.col("day").cast("string").alias("day"), "start_us", F.size("samples").cast("long").alias("n"))


@query("""SELECT 'm' || n AS mine_id FROM v_catalog WHERE k % 2 = 0 UNION ALL SELECT 'o' || n FROM v_catalog o WHERE k % 2 = 1 AND NOT EXISTS (
SELECT 1 FROM v_catalog m WHERE m.k % 2 = 0 AND abs(m.latitude - o.latitude - 0.001e0) < 0.025e0 AND abs(m.longitude - o.longitude) < 0.025e0)""")
def job24_quarries(v):
    c = v.catalog().where("k % 2 = 0").select(F.concat(F.lit("m"), F.col("n").cast("string")).alias("mine_id"), "latitude", "longitude")
    o = v.catalog().where("k % 2 = 1").select(F.concat(F.lit("o"), F.col("n").cast("string")).alias("mine_id"), (F.col("latitude") + 0.001).alias("latitude"), "longitude")
    return jobs.build_quarries(c, o, 0.025).select("mine_id")


@query("""SELECT event_id, 'old' || n AS legacy_id, coalesce(picks, '') AS picks, coalesce(stations, '') AS stations FROM v_catalog
LEFT JOIN (SELECT event_id, string_agg(t_us || ' ' || station || ' ' || phase, ',' ORDER BY t_us, station, phase) AS picks FROM v_assignments GROUP BY 1) USING (event_id)
LEFT JOIN (SELECT event_id, string_agg(station || ' ' || p || ' ' || s, ',' ORDER BY station) AS stations FROM (SELECT event_id, station, count(*) FILTER (phase = 'P') AS p, count(*) FILTER (phase = 'S') AS s
  FROM v_assignments GROUP BY ALL) GROUP BY 1) USING (event_id)""")
def job25_detail(v):
    """Each event by its old id, with its picks in time order and the counts of its stations."""
    c = v.catalog()
    aliases = c.select("event_id", F.concat(F.lit("old"), F.col("n").cast("string")).alias("legacy_id"))
    out = jobs.event_detail(aliases.select(F.col("legacy_id").alias("event_id")), c, v.assignments(), aliases)
    text = lambda x, *names: F.coalesce(F.array_join(F.transform(x, lambda p: F.concat_ws(" ", *[p[n].cast("string") for n in names])), ","), F.lit("")).alias(x)
    return out.select("event_id", "legacy_id", text("picks", "t_us", "station", "phase"), text("contributions", "station", "p", "s").alias("stations"))


@query("""SELECT c.event_id, round(c.latitude, 5) AS latitude, round(c.depth_km, 2) AS depth_km, num_picks, coalesce(picks, '') AS picks, coalesce(traces, '') AS traces FROM v_catalog c
LEFT JOIN (SELECT event_id, string_agg(station || ' ' || round((a.t_us - c.t_us) / 1e6, 3)::DECIMAL(18, 3) || ' ' || phase, ',' ORDER BY station, a.t_us, phase) AS picks FROM v_assignments a JOIN v_catalog c USING (event_id) GROUP BY 1) USING (event_id)
LEFT JOIN (SELECT event_id, string_agg(km::DECIMAL(18, 1) || ' ' || station, ',' ORDER BY km, station) AS traces FROM (SELECT DISTINCT event_id, station, round(2 * 6371 * atan2(sqrt(h), sqrt(1 - h)), 1) AS km FROM (
  SELECT a.event_id, a.station, sin(radians(s.latitude - c.latitude) / 2) ** 2 + cos(radians(c.latitude)) * cos(radians(s.latitude)) * sin(radians(s.longitude - c.longitude) / 2) ** 2 AS h
  FROM v_assignments a JOIN v_catalog c USING (event_id) JOIN v_stations s ON s.station = a.station)) GROUP BY 1) USING (event_id) WHERE review_status = 'confirmed'""")
def snk07_public(v):
    """Picks as offsets, and the picked stations' traces, nearest first, from day segments of a sample in ten seconds."""
    days = v.spark.range(31).select((F.lit(1704067200000000) + F.col("id") * 86_400_000_000).alias("start_us"))
    day = v.stations().select("station").join(days).withColumns({"rate": F.lit(0.1), "samples": F.transform(F.sequence(F.lit(0), F.lit(8639)), lambda i: (i % 7).cast("double"))})
    out = sinks.export_public(v.catalog(), v.assignments(), v.stations(), day, 20)
    text = lambda x, *parts: F.coalesce(F.array_join(F.transform(x, lambda p: F.concat_ws(" ", *[p[n].cast(t) for n, t in parts])), ","), F.lit("")).alias(x)
    picks, traces = text("picks", ("station", "string"), ("t", "decimal(18,3)"), ("phase", "string")), text("traces", ("distance_km", "decimal(18,1)"), ("station", "string"))
    return out.select("event_id", "latitude", "depth_km", "num_picks", picks, traces)


@query("""SELECT station, hour, round(least(n / 2.0e0, 1.0e0), 4) AS coverage, CASE WHEN n IS NULL OR n < 2 THEN true ELSE false END AS short
FROM (SELECT s.station, h.hour, coalesce(p.n, 0) AS n FROM v_stations s CROSS JOIN (SELECT DISTINCT t_us // 3600000000 AS hour FROM v_picks) h
LEFT JOIN (SELECT station, t_us // 3600000000 AS hour, count(*) AS n FROM v_picks GROUP BY 1, 2) p ON p.station = s.station AND p.hour = h.hour)""")
def job01_coverage(v):
    hour = F.floor(F.col("t_us") / 3_600_000_000)
    got = v.picks().groupBy("station", hour.alias("chunk")).agg(F.count("*").alias("n")).withColumn("channel", F.lit("EHZ"))
    hours = got.select("chunk").distinct()
    due = v.stations().select("station").crossJoin(hours).withColumns({"channel": F.lit("EHZ"), "want": F.lit(2.0)})
    tracker = got.where("n >= 2").select("station", "chunk", F.lit("success").alias("status"), F.lit(1.0).alias("coverage"), F.lit(True).alias("in_window"))
    out = jobs.coverage_report(due, got, tracker)
    return out.select("station", F.col("chunk").alias("hour"), "coverage", "short")


@query("SELECT strftime(day, '%Y-%m-%d') AS day FROM v_catalog WHERE day >= DATE '2024-01-23' GROUP BY day HAVING sum(k) % 2 = 0")
def job23_retry(v):
    days = v.catalog().groupBy("day").agg((F.sum("k") % 2).alias("odd"))
    out = jobs.retry_plan(days, days.select("day", (1 - F.col("odd")).alias("improved")), F.lit("2024-01-30").cast("date"))
    return out.select(F.col("day").cast("string").alias("day"))


@query("""SELECT vec_id AS key, start_us + CASE vec_id % 3 WHEN 1 THEN 100000 ELSE 0 END AS start_us, 64 - CASE vec_id % 3 WHEN 1 THEN 10 ELSE 0 END AS n FROM v_traces WHERE vec_id % 3 <> 2""")
def jn18_trim_to_epoch(v):
    s = segments(v)
    shift = F.when(F.col("key") % 3 == 0, -1_000_000).when(F.col("key") % 3 == 1, 100_000).otherwise(90_000_000_000)
    epochs = s.select("key", (F.col("start_us") + shift).alias("epoch_us"), F.lit(None).cast("long").alias("end_us"))
    return joins.trim_to_epoch(s, epochs).select("key", "start_us", F.size("samples").alias("n"))


@query("SELECT DISTINCT strftime(day, '%Y-%m-%d') AS day FROM (SELECT day FROM v_picks UNION ALL SELECT day FROM v_catalog)")
def set02_days(v):
    return agg.days_present(v.picks(), v.catalog()).select(F.col("day").cast("string").alias("day"))


@query("SELECT event_id, 'ep' AS source FROM v_primary UNION ALL SELECT event_id, 'po' FROM v_secondary")
def set07_sources(v):
    return jobs.catalog_feed(ep=v.primary(), po=v.secondary()).select("event_id", "source")


@query("""SELECT vec_id // 3 AS chunk, round(coalesce(max(CASE WHEN vec_id % 3 = 0 AND vec_id % 12 <> 3 THEN samples[1] END), max(CASE vec_id % 3 WHEN 2 THEN samples[1] END), max(CASE vec_id % 3 WHEN 1 THEN samples[1] END))::DOUBLE, 6) AS east,
round(coalesce(max(CASE vec_id % 3 WHEN 2 THEN samples[1] END), max(CASE WHEN vec_id % 3 = 0 AND vec_id % 12 <> 3 THEN samples[1] END), max(CASE vec_id % 3 WHEN 1 THEN samples[1] END))::DOUBLE, 6) AS up, 64 AS valid FROM v_traces GROUP BY 1""")
def arr07_components(v):
    """One station in four has a pressure channel in place of its east component."""
    names = F.array(*[F.lit(c) for c in "ENZ"])
    component = F.when(F.col("key") % 12 == 3, "H").otherwise(names[(F.col("key") % 3).cast("int")])
    s = segments(v).select(F.floor(F.col("key") / 3).alias("chunk"), component.alias("component"), "samples")
    out = arrays.assemble_components(s, ["chunk"])
    at = lambda i: F.round(F.col("components")[i][0].cast("double"), 6)
    return out.select("chunk", at(0).alias("east"), at(2).alias("up"), F.size(F.filter("valid", lambda x: x)).alias("valid"))


@query(sql.ARR11)
def arr11_highpass(v):
    return arrays.highpass(segments(v), ["key"], 2.0).select("key", F.round(F.array_max("samples"), 6).alias("peak"))
