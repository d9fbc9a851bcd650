"""Queries on picks, catalogs and time joins, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, scalars
from ..operators import aggregates as agg
from ..operators import filters, joins, windows
from . import sql
from .views import Views, oracle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SPAN = ("2024-01-01", "2024-01-30")
HOUR = 3_600_000_000


def query(sql: str | None = None):
    """Registers ``fn(views)`` under its name."""

    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql:
            ORACLES[fn.__name__] = oracle(sql)
        return fn

    return add


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("SELECT event_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT event_id, unnest(generate_series(CAST(t AS DATE)::TIMESTAMP, CAST(CAST(t + INTERVAL 36 HOUR - INTERVAL 1 MICROSECOND AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM (SELECT event_id, make_timestamp(t_us) AS t FROM v_catalog))")
def flt01_days(v):
    rows = v.catalog().select("event_id", F.col("time").alias("a"), (F.col("time") + F.expr("INTERVAL 36 HOURS")).alias("b"))
    return filters.days_between(rows, "a", "b").select("event_id", F.col("day").cast("string").alias("day"))


@query("SELECT pick_id, station, phase, t_us, probability FROM v_picks WHERE probability >= 0.5")
def flt03_picks(v):
    return filters.filter_picks(v.picks()).select("pick_id", "station", "phase", "t_us", "probability")


@query("SELECT event_id, t_us FROM v_catalog WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
def flt04_dates(v):
    return filters.filter_by_date(v.catalog(), "2024-01-05", "2024-01-12").select("event_id", "t_us")


@query("SELECT event_id, magnitude, depth_km, num_picks FROM v_catalog WHERE magnitude >= 0.5 AND depth_km <= 20 AND num_picks >= 4")
def flt05_thresholds(v):
    return filters.filter_catalog(v.catalog(), 0.5, 20, 4).select("event_id", "magnitude", "depth_km", "num_picks")


@query("WITH a AS (SELECT event_id, 'EP-' || n AS legacy_id FROM v_catalog WHERE n % 3 = 0) SELECT c.event_id, a.legacy_id FROM v_catalog c LEFT JOIN a USING (event_id) WHERE contains(c.event_id, 'p-1') OR contains(strftime(make_timestamp(c.t_us), '%Y-%m-%dt%H:%M:%S'), 'p-1') OR contains(lower(a.legacy_id), 'p-1')".replace("WITH a AS (", "SELECT * FROM (SELECT c.event_id, a.legacy_id FROM v_catalog c LEFT JOIN (", 1).replace(") SELECT c.event_id, a.legacy_id FROM v_catalog c LEFT JOIN a USING (event_id) WHERE", ") a USING (event_id) WHERE", 1) + ")")
def flt06_search(v):
    c = v.catalog()
    aliases = c.where("n % 3 = 0").select("event_id", F.concat(F.lit("EP-"), F.col("n").cast("string")).alias("legacy_id"))
    return filters.search(c, aliases, "P-1").select("event_id", "legacy_id")


@query("SELECT event_id, 'queue' AS mode FROM v_catalog WHERE review_status IS NULL AND num_picks > 4 UNION ALL SELECT event_id, 'auto_rejected' FROM v_catalog WHERE review_status IS NULL AND num_picks <= 4 UNION ALL SELECT event_id, 'confirmed' FROM v_catalog WHERE review_status = 'confirmed'")
def flt07_review(v):
    c = v.catalog().withColumn("triage", F.when(F.col("num_picks") <= 4, "auto_reject").otherwise("ok"))
    parts = [filters.filter_review(c, m).select("event_id", F.lit(m).alias("mode")) for m in ("queue", "auto_rejected", "confirmed")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("SELECT event_id, abs(latitude - 31.778e0) <= 0.6e0 AND abs(longitude - -106.408e0) <= 0.6e0 AS inside FROM v_catalog")
def flt08_area(v):
    return v.catalog().select("event_id", geo.inside_area(F.col("latitude"), F.col("longitude"), 0.4).alias("inside"))


@query("SELECT network, station, 'warning' AS severity, 'elevation' AS rule FROM v_stations WHERE elevation_m > 1200 UNION ALL SELECT network, station, 'error', 'area' FROM v_stations WHERE NOT (abs(latitude + 0.9e0 - 31.778e0) <= 1 AND abs(longitude - -106.408e0) <= 1) UNION ALL SELECT network, station, 'error', 'start_date' FROM v_stations WHERE nk % 7 = 0 UNION ALL SELECT network, station, 'error', 'end_date' FROM v_stations WHERE nk % 7 <> 0 AND end_date < start_date + 10")
def flt09_validate(v):
    s = v.stations()
    s = s.withColumns({
        "latitude": F.col("latitude") + 0.9, "elevation_m": F.when(F.col("elevation_m") > 1200, 9999.0).otherwise(F.col("elevation_m")),
        "start_date": F.when(F.col("nk") % 7 != 0, F.date_add("start_date", 10)),
    })
    return filters.validate_stations(s)


@query("SELECT station, strftime(d, '%Y-%m-%d') AS day FROM v_stations, (VALUES (DATE '2024-01-05'), (DATE '2024-01-25')) t(d) WHERE start_date <= d AND coalesce(end_date >= d, true)")
def flt10_active(v):
    s = v.stations().withColumn("day", F.explode(F.array(F.lit("2024-01-05").cast("date"), F.lit("2024-01-25").cast("date"))))
    return s.where(scalars.active_on(F.col("start_date"), F.col("end_date"), F.col("day"))).select("station", F.col("day").cast("string").alias("day"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey = 0 THEN NULL WHEN c_custkey % 5 IN (0, 1) THEN 'geophone' WHEN c_custkey % 5 = 2 THEN 'node' END AS kind, CASE WHEN c_custkey % 5 IN (0, 1, 2) AND c_custkey > 0 THEN c_custkey::DOUBLE END AS sensitivity, CASE c_custkey % 4 WHEN 0 THEN 'HH' WHEN 1 THEN 'EH' WHEN 2 THEN 'GP' ELSE 'EH' END AS band, CASE c_custkey % 4 WHEN 0 THEN 'E,N,Z' WHEN 1 THEN 'E,N,Z' WHEN 2 THEN '1,2,Z' ELSE 'Z' END AS components FROM customer")
def flt11_sensors(v):
    k = F.col("c_custkey")
    spec = lambda name, s: F.create_map(F.lit(name), F.struct(s.cast("double").alias("sensitivity")))
    inst = (
        F.when(k % 5 == 0, F.map_concat(spec("node", k * 2), spec("geophone", k))).when(k % 5 == 1, spec("geophone", k))
        .when(k % 5 == 2, spec("node", k)).when(k % 5 == 3, spec("accelerometer", k)).otherwise(spec("node", F.lit(0)))
    )
    chans = F.element_at(F.array(*map(F.lit, ("HH?", "EH?", "GP?", "E??"))), (k % 4 + 1).cast("int"))
    rows = v.table("customer").select(k.alias("id"), scalars.velocity_sensor(inst).alias("s"), scalars.channel_layout(chans, F.lit(None).cast("string")).alias("l"))
    return rows.select("id", "s.kind", "s.sensitivity", "l.band", F.array_join("l.components", ",").alias("components"))


@query("SELECT s_suppkey AS id, 'N' || s_nationkey AS network, 'S' || s_suppkey AS station, '' AS location, 'EHZ' AS channel FROM supplier WHERE s_suppkey % 3 <> 0")
def flt14_stream_id(v):
    n, s = F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")
    name = F.concat(F.lit("N"), n, F.lit(".S"), s, F.when(F.col("s_suppkey") % 3 == 0, ".EHZ").otherwise("..EHZ"))
    rows = v.table("supplier").select(F.col("s_suppkey").alias("id"), name.alias("name"))
    return filters.parse_stream_id(rows, "name").drop("name")


@query("SELECT pick_id, amplitude, 'EHZ' AS channel FROM v_picks")
def flt15_normalise(v):
    p = v.picks().select("pick_id", F.coalesce("amplitude", F.when(F.col("k") % 2 == 0, 0.0).otherwise(float("nan"))).alias("amplitude"), "probability", F.lit("EH").alias("band"))
    return filters.normalise_picks(p).select("pick_id", "amplitude", "channel")


@query("SELECT event_id, n % 2 = 0 AS legacy FROM v_catalog")
def flt16_legacy(v):
    text = F.when(F.col("n") % 2 == 0, F.concat(F.lit("ep20240101-"), F.lpad((F.col("n") % 10000).cast("string"), 4, "0"))).otherwise(F.col("event_id"))
    return v.catalog().select("event_id", scalars.is_legacy_id(text).alias("legacy"))


@query("SELECT 'XX' AS station, 'unknown' AS state UNION ALL SELECT station, 'retired' FROM v_stations WHERE station IN ('S01', 'S24') AND end_date < DATE '2024-01-25'")
def flt17_core(v):
    return filters.check_core(["S01", "S24", "XX"], v.stations(), F.lit("2024-01-25").cast("date"))


@query("SELECT event_id FROM v_catalog WHERE review_status = 'confirmed' AND event_type = 'quarry_blast'")
def flt18_confirmed(v):
    return filters.confirmed_of_type(v.catalog(), "quarry_blast").select("event_id")


# joins
@query("SELECT pick_id, station, latitude, longitude, elevation_m FROM v_picks JOIN v_stations USING (network, station)")
def jn01_station(v):
    return joins.with_station(v.picks(), v.stations()).select("pick_id", "station", "latitude", "longitude", "elevation_m")


@query("SELECT a.event_id AS owner, a.station, c.event_id FROM v_assignments a JOIN v_catalog x USING (event_id) LEFT JOIN (SELECT event_id, day, k FROM v_catalog WHERE n % 5 <> 0 AND n % 2 = 0) c ON c.day = x.day AND c.event_id = a.event_id")
def jn02_attach(v):
    c = v.catalog().select(F.lit("ep").alias("source"), "day", F.col("n").alias("event_index"), "event_id")
    a = v.assignments("day", "n").select(F.col("event_id").alias("owner"), "station", F.lit("ep").alias("source"), "day", F.col("n").alias("event_index"))
    return joins.attach_event_id(a, c.where("event_index % 5 <> 0 and event_index % 2 = 0")).select("owner", "station", "event_id")


@query("SELECT a.event_id AS a, b.event_id AS b, abs(a.t_us - b.t_us) AS gap_us FROM v_catalog a JOIN v_catalog b ON a.event_id < b.event_id AND abs(a.t_us - b.t_us) <= 10000000")
def jn03_same_origin(v):
    return joins.same_origin_pairs(v.catalog())


@query("SELECT a.event_id AS a, b.event_id AS b, abs(a.t_us - b.t_us) AS gap_us FROM v_catalog a JOIN v_catalog b ON a.event_id < b.event_id AND abs(a.t_us - b.t_us) <= 600000000")
def jn03_same_origin_600(v):
    return joins.same_origin_pairs(v.catalog(), 600)


@query("SELECT pick_id, station, phase, t_us FROM v_picks p WHERE pick_id % 2 = 1 AND EXISTS (SELECT 1 FROM v_picks q WHERE q.pick_id % 2 = 0 AND q.station = p.station AND q.phase = p.phase AND abs(q.t_us - p.t_us) <= 600000000)")
def jn04_corroborated_600(v):
    p = v.picks()
    return joins.corroborated(p.where("pick_id % 2 = 1"), p.where("pick_id % 2 = 0"), 600).select("pick_id", "station", "phase", "t_us")


@query("SELECT event_id, t_us FROM v_secondary s WHERE NOT EXISTS (SELECT 1 FROM v_primary p WHERE abs(p.t_us - s.t_us) <= 10000000)")
def jn05_separated(v):
    return joins.separated(v.secondary(), v.primary()).select("event_id", "t_us")


@query("SELECT event_id, t_us FROM v_secondary s WHERE NOT EXISTS (SELECT 1 FROM v_primary p WHERE abs(p.t_us - s.t_us) <= 600000000)")
def jn05_separated_600(v):
    return joins.separated(v.secondary(), v.primary(), 600).select("event_id", "t_us")


@query("SELECT event_id, id AS regional_id, mag AS regional_mag, distance_km AS regional_km, r_us AS regional_us FROM v_catalog c LEFT JOIN (SELECT event_id, id, mag, distance_km, r_us FROM (SELECT c.event_id, r.id, r.mag, r.distance_km, r.t_us AS r_us, row_number() OVER (PARTITION BY c.event_id ORDER BY r.t_us DESC, r.id DESC) AS rn FROM v_catalog c JOIN v_regional r ON c.t_us - r.t_us BETWEEN 5000000 AND 900000000 WHERE c.t_us >= 1704153600000000 + 900000000 AND c.t_us <= 1706400000000000) WHERE rn = 1) USING (event_id)")
def jn06_asof_900(v):
    span = v.spark.createDataFrame([(1704153600000000, 1706400000000000)], "start_us long, end_us long")
    out = joins.asof_regional(v.catalog(), v.regional(), span, 5, 900)
    return out.select("event_id", "regional_id", "regional_mag", "regional_km", "regional_us")


@query(sql.JN07)
def jn07_carry_over_600(v):
    return joins.carry_over_ids(v.primary(), v.secondary(), 600)


@query("SELECT a, b, gap_us, round(km, 6) AS km FROM (SELECT a.event_id AS a, b.event_id AS b, abs(a.t_us - b.t_us) AS gap_us, sqrt(((b.longitude - a.longitude) * 111.19e0 * cos(radians((a.latitude + b.latitude) / 2))) ** 2 + ((b.latitude - a.latitude) * 111.19e0) ** 2) AS km FROM v_catalog a JOIN v_catalog b ON a.event_id < b.event_id AND abs(a.t_us - b.t_us) <= 3600000000) WHERE km <= 50")
def jn08_duplicates_3600(v):
    return rounded(joins.dup_pairs(v.catalog(), 3600, 50), "km")


@query("SELECT event_id, strftime(day, '%Y-%m-%d') AS day FROM v_catalog WHERE NOT ((n % 2 = 0 AND day < DATE '2024-01-11') OR (n % 2 = 1 AND day < DATE '2024-01-21'))")
def jn10_new_days(v):
    c = v.catalog().withColumn("source", F.when(F.col("n") % 2 == 0, "ep").otherwise("po"))
    ledger = c.where((F.col("day") < "2024-01-11") & (F.col("source") == "ep") | (F.col("day") < "2024-01-21") & (F.col("source") == "po")).select("source", "day").distinct()
    return joins.new_days(c, ledger).select("event_id", F.col("day").cast("string").alias("day"))


@query("SELECT station, phase, CASE WHEN substr(event_id, 3)::BIGINT % 4 = 0 THEN 'new' || event_id ELSE event_id END AS event_id FROM v_assignments")
def jn11_resolve(v):
    aliases = v.catalog().where("n % 4 = 0").select(F.col("event_id").alias("legacy_id"), F.concat(F.lit("new"), "event_id").alias("event_id"))
    return joins.resolve_ids(v.assignments(), aliases).select("station", "phase", "event_id")


@query("SELECT det_id, t_us FROM v_detections d WHERE NOT EXISTS (SELECT 1 FROM v_catalog c WHERE c.review_status = 'confirmed' AND abs(c.t_us - d.t_us) <= 600000000)")
def jn12_exclude_known_600(v):
    return joins.exclude_known(v.detections(), v.catalog(), 600).select("det_id", "t_us")


@query("SELECT d.det_id, b.event_id AS blocked_by FROM v_detections d LEFT JOIN (SELECT det_id, event_id FROM (SELECT d.det_id, c.event_id, row_number() OVER (PARTITION BY d.det_id ORDER BY abs(c.t_us - d.t_us), c.event_id) AS rn FROM v_detections d JOIN v_catalog c ON abs(c.t_us - d.t_us) <= 60000000) WHERE rn = 1) b USING (det_id)")
def jn13_blocking_60(v):
    return joins.blocking_event(v.detections(), v.catalog(), "det_id", 60).select("det_id", "blocked_by")


@query("SELECT station, strftime(d, '%Y-%m-%d') AS day FROM v_stations, (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS d) WHERE start_date <= d AND coalesce(end_date >= d, true) AND NOT EXISTS (SELECT 1 FROM v_picks p WHERE p.station = v_stations.station AND p.day = d AND p.k < 20)")
def jn15_missing_days(v):
    out = joins.missing_station_days(v.stations(), v.picks().where("k < 20"), *SPAN)
    return out.select("station", F.col("day").cast("string").alias("day"))


@query("SELECT i, j, round(sqrt((xi - xj) ** 2 + (yi - yj) ** 2), 6) AS km FROM (SELECT a.station AS i, a.x AS xi, a.y AS yi, b.station AS j, b.x AS xj, b.y AS yj FROM s a, s b) WHERE sqrt((xi - xj) ** 2 + (yi - yj) ** 2) <= 50".replace("FROM s a, s b", "FROM (SELECT station, q * cos(p) * sin(d) AS x, q * (cos(radians(31.778e0)) * sin(p) - sin(radians(31.778e0)) * cos(p) * cos(d)) AS y FROM (SELECT station, radians(latitude) AS p, radians(longitude + 106.408e0) AS d, 2 * 6371.0e0 / (1 + sin(radians(31.778e0)) * sin(radians(latitude)) + cos(radians(31.778e0)) * cos(radians(latitude)) * cos(radians(longitude + 106.408e0))) AS q FROM v_stations)) a, (SELECT station, q * cos(p) * sin(d) AS x, q * (cos(radians(31.778e0)) * sin(p) - sin(radians(31.778e0)) * cos(p) * cos(d)) AS y FROM (SELECT station, radians(latitude) AS p, radians(longitude + 106.408e0) AS d, 2 * 6371.0e0 / (1 + sin(radians(31.778e0)) * sin(radians(latitude)) + cos(radians(31.778e0)) * cos(radians(latitude)) * cos(radians(longitude + 106.408e0))) AS q FROM v_stations)) b"))
def jn16_edges_50(v):
    return rounded(joins.station_edges(v.stations(), 50), "km")


@query("SELECT event_id FROM v_secondary s WHERE k % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM v_primary p WHERE p.k % 3 = 0 AND abs(p.latitude - s.latitude) < 0.035e0 AND abs(p.longitude - s.longitude) < 0.035e0)")
def jn17_geo_dedup(v):
    return joins.geo_dedup(v.primary().where("k % 3 = 0"), v.secondary().where("k % 3 <> 0"), 0.035).select("event_id")


@query("SELECT c.event_id, t.vec_id, t.start_us, CASE WHEN t.vec_id IS NULL THEN 'no data' ELSE 'ok' END AS status, greatest(t.start_us, c.t_us - 1000000) AS from_us, least(t.start_us + 630000, c.t_us + 5000000) AS to_us FROM v_catalog c LEFT JOIN v_traces t ON t.start_us <= c.t_us + 5000000 AND t.start_us + 630000 >= c.t_us - 1000000".replace("greatest(t.start_us, c.t_us - 1000000)", "CASE WHEN t.vec_id IS NOT NULL THEN greatest(t.start_us, c.t_us - 1000000) ELSE c.t_us - 1000000 END").replace("least(t.start_us + 630000, c.t_us + 5000000)", "CASE WHEN t.vec_id IS NOT NULL THEN least(t.start_us + 630000, c.t_us + 5000000) ELSE c.t_us + 5000000 END"))
def jn19_event_windows(v):
    segments = v.traces().select("vec_id", "start_us", (F.col("start_us") + 630000).alias("end_us"))
    out = joins.event_windows(v.catalog().select("event_id", "t_us"), segments, 1_000_000, 5_000_000, 630_000)
    return out.select("event_id", "vec_id", "start_us", "status", "from_us", "to_us")


@query("SELECT event_id, station, phase FROM v_assignments WHERE event_id IN (SELECT event_id FROM v_catalog WHERE review_status = 'confirmed')")
def jn20_picks_of(v):
    return joins.picks_of(v.assignments(), v.catalog().where("review_status = 'confirmed'")).select("event_id", "station", "phase")


@query("SELECT station, count(*) AS n, min(t_us) AS first_us, max(t_us) AS last_us FROM v_picks WHERE t_us BETWEEN 1704672000000000 AND 1704844800000000 GROUP BY station")
def jn24_window(v):
    return joins.picks_in_window(v.picks(), 1704672000000000, 1704844800000000)


# aggregates
@query("SELECT event_id, t_us FROM v_catalog JOIN (SELECT event_id FROM v_assignments GROUP BY event_id HAVING count(DISTINCT station) >= 3 AND count(*) FILTER (phase = 'P') >= 2 AND count(*) FILTER (phase = 'S') >= 1) USING (event_id)")
def ag01_quality(v):
    a = v.assignments()
    return agg.qc_phases(agg.qc_stations(v.catalog(), a), a, 2, 1).select("event_id", "t_us")


ML_SQL = """SELECT event_id, log10(amplitude * (2800.0e0 * 1000.0e0) / (2 * pi() * 5.0e0)) + 1.110e0 * log10(r / 100.0e0) + 0.00189e0 * (r - 100.0e0) + 3.0e0 AS ml FROM (
  SELECT a.event_id, a.amplitude, sqrt(dk * dk + depth_km * depth_km) AS r FROM (SELECT a.*, c.depth_km, 2 * 6371.0e0 * atan2(sqrt(h), sqrt(1 - h)) AS dk FROM (
    SELECT a.*, c.depth_km, sin(radians(s.latitude - c.latitude) / 2) ** 2 + cos(radians(c.latitude)) * cos(radians(s.latitude)) * sin(radians(s.longitude - c.longitude) / 2) ** 2 AS h
    FROM v_assignments a JOIN v_catalog c USING (event_id) JOIN v_stations s ON s.station = a.station) a JOIN v_catalog c USING (event_id)) a) WHERE amplitude > 0 AND r >= 10"""


@query(f"SELECT event_id, round(median(ml), 6) AS ml, round(stddev_samp(ml), 6) AS ml_err, count(*) AS num_ml_sta FROM ({ML_SQL.replace('SELECT a.*, c.depth_km, 2 * 6371', 'SELECT a.*, 2 * 6371')}) GROUP BY event_id")
def ag03_network_ml(v):
    return rounded(agg.network_ml(v.assignments(), v.catalog(), v.stations()), "ml", "ml_err")


@query("SELECT station, t_hour, round(least(n / 2.0e0, 1), 4) AS coverage FROM (SELECT s.station, h.t_hour, count(p.pick_id) AS n FROM v_stations s CROSS JOIN (SELECT DISTINCT t_us // 3600000000 AS t_hour FROM v_picks) h LEFT JOIN v_picks p ON p.station = s.station AND p.t_us // 3600000000 = h.t_hour GROUP BY ALL)")
def ag04_coverage(v):
    p = v.picks().withColumn("t_hour", F.floor(F.col("t_us") / HOUR))
    got = p.groupBy("station", "t_hour").agg(F.count("*").alias("n")).withColumn("channel", F.lit("EHZ"))
    due = v.stations().select("station").join(F.broadcast(p.select("t_hour").distinct())).withColumns({"channel": F.lit("EHZ"), "want": F.lit(2.0)})
    return agg.chunk_coverage(got, due, ["station", "t_hour"])


@query("SELECT event_id, count(*) FILTER (hit) AS corroborating_picks FROM (SELECT a.event_id, EXISTS (SELECT 1 FROM v_picks q WHERE q.pick_id % 2 = 0 AND q.station = a.station AND q.phase = a.phase AND abs(q.t_us - a.t_us) <= 60000000) AS hit FROM v_assignments a) GROUP BY event_id")
def ag06_corroboration(v):
    return agg.corroboration_counts(v.assignments(), v.picks().where("pick_id % 2 = 0"), 60)


TRIAGE_SQL = """SELECT c.event_id, c.magnitude, coalesce(n_picks, 0) AS n_picks, coalesce(n_stations, 0) AS n_stations, coalesce(n_core, 0) AS n_core FROM v_catalog c LEFT JOIN (
 SELECT event_id, count(*) AS n_picks, count(DISTINCT station) AS n_stations, count(DISTINCT station) FILTER (station IN ('S00', 'S01', 'S02', 'S03', 'S04', 'S05')) AS n_core FROM v_assignments GROUP BY event_id) USING (event_id)"""
CORE = [f"S0{i}" for i in range(6)]


@query(f"SELECT event_id, CASE WHEN (n_core < 2 AND n_stations < 5) OR coalesce(magnitude >= 2.2e0 AND n_picks <= 4, false) THEN 'auto_reject' WHEN n_picks <= 4 THEN 'flag' ELSE 'ok' END AS triage, n_picks, n_stations, n_core FROM ({TRIAGE_SQL})")
def ag07_triage(v):
    f = agg.triage_features(v.catalog(), v.assignments(), CORE)
    label, _ = scalars.triage(F.col("magnitude"), F.col("n_picks"), F.col("n_stations"), F.col("n_core"), F.lit(None).cast("string"))
    return f.select("event_id", label.alias("triage"), "n_picks", "n_stations", "n_core")


@query("SELECT n_events, min_mag, max_mag, latest, n_reviewed, event_days, n_picks, pick_days, n_stations FROM (SELECT count(*) AS n_events, min(magnitude) AS min_mag, max(magnitude) AS max_mag, arg_max(event_id, t_us) AS latest, count(review_status) AS n_reviewed, count(DISTINCT day) AS event_days FROM v_catalog), (SELECT count(*) AS n_picks, count(DISTINCT day) AS pick_days FROM v_picks), (SELECT count(*) AS n_stations FROM v_stations)")
def ag08_stats(v):
    return agg.catalog_stats(v.catalog(), v.picks(), v.stations())


@query("SELECT event_id, station, count(*) FILTER (phase = 'P') AS p, count(*) FILTER (phase = 'S') AS s FROM v_assignments GROUP BY ALL")
def ag09_contributions(v):
    return agg.station_contributions(v.assignments())


@query("SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n FROM v_catalog GROUP BY day")
def ag10_rate(v):
    return agg.event_rate(v.catalog()).select(F.col("day").cast("string").alias("day"), "n")


BINS_SQL = """bins AS (SELECT lo, nb, unnest(generate_series(0, nb - 1)) AS bin FROM (SELECT floor(min(x) / {w})::BIGINT AS lo, greatest(ceil(max(x) / {w})::BIGINT - floor(min(x) / {w})::BIGINT, 1) AS nb FROM vals)),
cnt AS (SELECT least(floor(x / {w})::BIGINT - lo, nb - 1) AS bin, count(*) AS n FROM vals, (SELECT any_value(lo) AS lo, any_value(nb) AS nb FROM bins) GROUP BY 1),
hist AS (SELECT bin, (lo + bin) * {w} AS low, (lo + bin) * {w} + {w} / 2 AS centre, coalesce(n, 0) AS n FROM bins LEFT JOIN cnt USING (bin))"""


@query("SELECT * FROM (WITH vals AS (SELECT magnitude AS x FROM v_catalog WHERE magnitude IS NOT NULL), " + BINS_SQL.format(w="0.1e0") + """,
cum AS (SELECT *, sum(n) OVER (ORDER BY bin DESC ROWS UNBOUNDED PRECEDING) AS cumulative FROM hist), m AS (SELECT arg_min(centre, (-n, bin)) AS mc FROM cum),
fit AS (SELECT -regr_slope(log10(cumulative), centre) AS b_value, regr_intercept(log10(cumulative), centre) AS a_value, regr_r2(log10(cumulative), centre) AS r_squared FROM cum, m WHERE centre >= mc AND cumulative > 0)
SELECT bin, round(low, 6) AS low, round(centre, 6) AS centre, n, cumulative::BIGINT AS cumulative, round(mc, 6) AS mc, round(b_value, 5) AS b_value, round(a_value, 5) AS a_value, round(r_squared, 5) AS r_squared FROM cum, m, fit)""".replace("arg_min(centre, (-n, bin))", "arg_min(centre, -n * 1000000 + bin)"))
def ag11_magnitude_frequency(v):
    return rounded(rounded(agg.magnitude_frequency(v.catalog()), "low", "centre", "mc"), "b_value", "a_value", "r_squared", digits=5)


@query("SELECT * FROM (WITH vals AS (SELECT depth_km AS x FROM v_catalog), " + BINS_SQL.format(w="1.0e0") + " SELECT bin, low, centre, n, round(mean_depth, 6) AS mean_depth, median_depth FROM hist, (SELECT avg(x) AS mean_depth, list_sort(list(x))[count(*) // 2 + 1] AS median_depth FROM vals))")
def ag12_depths(v):
    return rounded(agg.depth_distribution(v.catalog()), "mean_depth")


@query("SELECT least(k // 10, 9) AS bin, count(*) FILTER (phase = 'P') AS p, count(*) FILTER (phase = 'S') AS s FROM v_picks GROUP BY 1")
def ag13_pick_quality(v):
    return agg.pick_quality(v.picks())


@query("SELECT station, strftime(d, '%Y-%m-%d') AS day, count(pick_id) AS n FROM v_stations CROSS JOIN (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS d) LEFT JOIN v_picks p USING (station) WHERE p.day IS NULL OR true GROUP BY 1, 2".replace("LEFT JOIN v_picks p USING (station) WHERE p.day IS NULL OR true", "x LEFT JOIN v_picks p ON p.station = v_stations.station AND p.day = x.d").replace("SELECT station,", "SELECT v_stations.station,"))
def ag14_station_days(v):
    return agg.station_days(v.picks(), v.stations(), *SPAN).withColumn("day", F.col("day").cast("string"))


@query("SELECT station, strftime(day, '%Y-%m-%d') AS day, max(n) AS n FROM (SELECT station, day, count(*) AS n FROM v_picks WHERE k % 2 = 0 GROUP BY ALL UNION ALL SELECT station, day, count(*) FROM v_picks WHERE k % 3 = 0 GROUP BY ALL) GROUP BY station, day")
def ag15_completeness(v):
    p = v.picks()
    return agg.completeness(p.where("k % 2 = 0"), p.where("k % 3 = 0")).withColumn("day", F.col("day").cast("string"))


@query("WITH f AS (SELECT station, day FROM v_picks WHERE k < 8) SELECT 1".replace("WITH f AS (SELECT station, day FROM v_picks WHERE k < 8) SELECT 1", "SELECT station, CASE WHEN end_date IS NOT NULL THEN 'retired' WHEN coalesce(found, 0) = 3 THEN 'ok' WHEN found > 0 THEN 'warning' ELSE 'error' END AS status, CASE WHEN end_date IS NOT NULL THEN 0 ELSE coalesce(found, 0) END AS files_recent FROM v_stations LEFT JOIN (SELECT station, count(DISTINCT day) AS found FROM v_picks WHERE k < 8 AND day IN (SELECT day FROM v_picks WHERE k < 8 GROUP BY day HAVING count(*) >= 3 ORDER BY day DESC LIMIT 3) GROUP BY station) USING (station)"))
def ag16_health(v):
    return agg.station_health(v.picks().where("k < 8"), v.stations())


@query("SELECT station FROM (SELECT station, count(*) AS n FROM v_stations, (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-01-12', INTERVAL 1 DAY))::DATE AS d) WHERE start_date <= d AND coalesce(end_date >= d, true) AND NOT EXISTS (SELECT 1 FROM v_picks p WHERE p.station = v_stations.station AND p.day = d AND p.station NOT IN ('S03', 'S07', 'S24')) GROUP BY station) WHERE n = 3")
def ag20_dark(v):
    return agg.dark_stations(v.stations(), v.picks().where("station not in ('S03', 'S07', 'S24')"), "2024-01-10", "2024-01-12")


@query("SELECT round((1706745600000000 - max(t_us)) / 3600000000.0e0, 6) AS hours_since, (1706745600000000 - max(t_us)) / 3600000000.0e0 > 48 AS quiet FROM v_catalog")
def ag21_quiet(v):
    return rounded(agg.quiet_check(v.catalog(), 1706745600000000), "hours_since")


@query("SELECT strftime(coalesce(m.day, n.day), '%Y-%m-%d') AS day, coalesce(missing, '') AS missing, n.day IS NOT NULL AS no_events FROM (SELECT d AS day, string_agg(station, ',' ORDER BY station) AS missing FROM v_stations, (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS d) WHERE start_date <= d AND coalesce(end_date >= d, true) AND NOT EXISTS (SELECT 1 FROM v_picks p WHERE p.station = v_stations.station AND p.day = d AND p.k < 20) GROUP BY d) m FULL JOIN (SELECT DISTINCT day FROM v_picks WHERE k < 20 AND day NOT IN (SELECT day FROM v_catalog WHERE n % 60 = 1)) n ON m.day = n.day")
def ag22_gaps(v):
    done = v.catalog().where("n % 60 = 1").select("day").distinct()
    return agg.scan_gaps(v.stations(), v.picks().where("k < 20"), done, *SPAN).withColumn("day", F.col("day").cast("string"))


@query("SELECT strftime(max(day) + 1, '%Y-%m-%d') AS day FROM v_picks WHERE k < 20 AND day IN (SELECT day FROM v_catalog WHERE n % 60 = 1)")
def ag23_next_day(v):
    done = v.catalog().where("n % 60 = 1").select("day")
    return agg.next_day(v.picks().where("k < 20"), done, SPAN[0]).select(F.col("day").cast("string").alias("day"))


@query("SELECT l_returnflag AS stage, sum(l_quantity::BIGINT)::BIGINT AS bytes, count(*) AS files FROM lineitem GROUP BY ROLLUP (l_returnflag)")
def ag24_storage(v):
    return agg.storage_by_stage(v.table("lineitem").select(F.col("l_returnflag").alias("stage"), F.col("l_quantity").cast("long").alias("length")))


@query("SELECT t_us, message FROM (SELECT t_us, 'log ' || pick_id AS message FROM v_picks WHERE k < 3 UNION ALL SELECT t_us, 'step ' || n FROM v_catalog WHERE k < 3) ORDER BY t_us DESC, message LIMIT 20")
def ag25_issues(v):
    logs = v.picks().where("k < 3").select("t_us", F.concat(F.lit("log "), F.col("pick_id").cast("string")).alias("message"))
    steps = v.catalog().where("k < 3").select("t_us", F.concat(F.lit("step "), F.col("n").cast("string")).alias("message"))
    return agg.issues(logs, steps, 20)


@query(f"SELECT triage, review_status, count(*) AS n FROM (SELECT CASE WHEN num_picks <= 4 THEN 'flag' ELSE 'ok' END AS triage, coalesce(review_status, '') AS review_status FROM v_catalog) GROUP BY CUBE (triage, review_status)")
def ag30_audit(v):
    return agg.triage_audit(v.catalog().withColumn("triage", F.when(F.col("num_picks") <= 4, "flag").otherwise("ok")))


@query("SELECT phase, n_picks, n_true, coalesce(tp, 0) AS tp, round(mean_s, 6) AS mean_s, round(std_s, 6) AS std_s, round(coalesce(tp, 0) / n_picks, 6) AS precision, round(coalesce(tp, 0) / n_true, 6) AS recall FROM (SELECT phase, count(*) AS n_picks FROM v_picks WHERE pick_id % 2 = 1 GROUP BY 1) JOIN (SELECT phase, count(*) AS n_true FROM v_picks WHERE pick_id % 2 = 0 GROUP BY 1) USING (phase) LEFT JOIN (SELECT a.phase, count(*) AS tp, avg((a.t_us - b.t_us) / 1000000) AS mean_s, stddev_pop((a.t_us - b.t_us) / 1000000) AS std_s FROM v_picks a JOIN v_picks b ON a.station = b.station AND a.phase = b.phase AND a.pick_id % 2 = 1 AND b.pick_id % 2 = 0 AND abs(a.t_us - b.t_us) <= 600000000 GROUP BY 1) USING (phase)")
def ag31_picker_metrics(v):
    p = v.picks()
    out = agg.picker_metrics(p.where("pick_id % 2 = 1"), p.where("pick_id % 2 = 0"), 600).drop("f1")
    return rounded(out, "mean_s", "std_s", "precision", "recall")


@query("SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude FROM v_stations")
def ag32_centre(v):
    return rounded(agg.network_centre(v.stations()), "latitude", "longitude")


# windows, sorts, sets
@query("SELECT n, CASE WHEN rn = 1 THEN base ELSE base || '-' || rn END AS event_id FROM (SELECT n, base, row_number() OVER (PARTITION BY base ORDER BY t_us, n) AS rn FROM (SELECT n, t_us, 'ep' || strftime(make_timestamp(t_us // 3600000000 * 3600000000), '%Y%m%dT%H%M%S') AS base FROM v_catalog))")
def wn01_mint(v):
    rows = v.catalog().withColumn("time", F.date_trunc("hour", "time")).drop("event_id")
    return windows.mint_ids(rows, "ep", ["t_us", "n"]).select("n", "event_id")


@query("SELECT event_id, first_value(event_id) OVER (PARTITION BY day ORDER BY (coalesce(review_status, '') = 'confirmed') DESC, (review_status IS NOT NULL) DESC, num_picks DESC, event_id) AS keeper FROM v_catalog")
def wn02_keepers(v):
    return windows.keepers(v.catalog().withColumn("root", F.col("day"))).select("event_id", "keeper")


@query("SELECT user_id, arg_max(event_id, t_us) AS event_id, max(t_us) AS t_us FROM v_events GROUP BY user_id")
def wn03_latest(v):
    return windows.latest(v.events().select("user_id", "event_id", "t_us"), ["user_id"], ["t_us", "event_id"])


PEAK_SQL = "SELECT series, idx, value FROM (SELECT *, lag(value) OVER w AS b, lead(value) OVER w AS a FROM v_series WINDOW w AS (PARTITION BY series ORDER BY idx)) WHERE value > b AND value >= a AND value >= 30000"


@query(PEAK_SQL)
def wn04_peaks(v):
    return windows.local_peaks(v.series(), "series", "idx", "value", 30000)


@query(sql.WN05)
def wn05_thin_peaks(v):
    peaks = windows.local_peaks(v.series(), "series", "idx", "value", 30000)
    return windows.thin_peaks(peaks, ["series"], "idx", "value", 5)


@query("SELECT series, pick_idx, max(abs(value)) AS amplitude FROM (SELECT p.series, p.idx AS pick_idx, least(p.idx + 20, coalesce(lead(p.idx) OVER (PARTITION BY p.series ORDER BY p.idx), p.idx + 20)) AS stop FROM v_series p WHERE p.idx % 15 = 3 OR p.idx % 40 = 0) p JOIN v_series s USING (series) WHERE s.idx >= pick_idx AND s.idx < stop GROUP BY 1, 2")
def wn06_amplitude(v):
    s = v.series()
    return windows.pick_amplitude(s.where("idx % 15 = 3 or idx % 40 = 0").select("series", "idx"), s, "series", 20)


@query("SELECT series, idx, min(CASE WHEN value >= 2000 THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 1 AS guarded FROM v_series")
def wn08_guard(v):
    rows = v.series().withColumn("valid", F.col("value") >= 2000)
    return windows.gap_guard(rows, "series", "idx", "valid", 3).select("series", "idx", "guarded")


@query("SELECT series, min(idx) AS first, max(idx) AS last, count(*) AS n FROM (SELECT series, idx, idx - row_number() OVER (PARTITION BY series ORDER BY idx) AS g FROM v_series WHERE value < 30000) GROUP BY series, g HAVING count(*) >= 4")
def wn09_runs(v):
    rows = v.series().withColumn("value", F.when(F.col("value") < 30000, 0.0).otherwise(F.col("value")))
    return windows.zero_runs(rows, "series", "idx", "value", 4)


@query(sql.WN11)
def wn11_anchored(v):
    out = windows.anchored_clusters(v.detections().select("det_id", "t_us"), "t_us", 600_000_000)
    return out.groupBy("anchor").agg(F.count("*").alias("n"), F.max("t_us").alias("last_us"))


@query("SELECT series, idx // 50 AS bin, min(value) AS low, max(value) AS high FROM v_series GROUP BY ALL")
def wn13_minmax(v):
    return windows.minmax_bins(v.series(), "series", "idx", "value", 50)


@query("SELECT series, idx, round(value - avg(value) OVER (PARTITION BY series), 4) AS detrended FROM v_series")
def wn17_demean(v):
    out = windows.detrend(v.series(), "series", "idx", "value", "mean")
    return out.select("series", "idx", F.round("detrended", 4).alias("detrended"))


@query("SELECT series, idx, round(value * CASE WHEN e < w THEN 0.5e0 * (1 - cos(pi() * e / w)) ELSE 1 END, 4) AS tapered FROM (SELECT *, least(idx, n - 1 - idx) AS e, greatest(floor(n * 0.05e0), 1) AS w FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM v_series))")
def wn18_taper(v):
    return windows.taper(v.series(), "series", "idx", "value").select("series", "idx", F.round("tapered", 4).alias("tapered"))


@query("SELECT day_us, start_us, end_us, n FROM (SELECT t_us // 86400000000 AS day_us, min(t_us) AS start_us, max(t_us + 600000000) AS end_us, count(*) AS n FROM (SELECT *, sum(nw) OVER (PARTITION BY t_us // 86400000000 ORDER BY t_us ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT t_us, CASE WHEN t_us > max(t_us + 600000000) OVER (PARTITION BY t_us // 86400000000 ORDER BY t_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS nw FROM v_catalog)) GROUP BY t_us // 86400000000, g)")
def wn14_merge(v):
    rows = v.catalog().select(F.floor(F.col("t_us") / 86_400_000_000).alias("day_us"), F.col("t_us").alias("start_us"), (F.col("t_us") + 600_000_000).alias("end_us"))
    return windows.merge_intervals(rows, "day_us", "start_us", "end_us")


@query("SELECT idx, round(avg(v), 5) + 0.0e0 AS value FROM (SELECT vec_id * 32 + i - 1 AS idx, samples[i] AS v FROM (SELECT vec_id, samples, unnest(generate_series(1, len(samples))) AS i FROM v_traces)) GROUP BY idx")
def wn15_overlap_mean(v):
    rows = v.traces().select(F.lit(1).alias("key"), (F.col("vec_id") * 32).alias("s"), F.transform("samples", lambda x: x.cast("double")).alias("samples"))
    return windows.overlap_mean(rows, "key", "s", "samples").select("idx", (F.round("value", 5) + 0.0).alias("value"))


@query("SELECT coalesce(keeper, a.event_id) AS event_id, station, phase, min(a.t_us) AS t_us FROM v_assignments a JOIN (SELECT event_id, first_value(event_id) OVER (PARTITION BY day ORDER BY event_id) AS keeper FROM v_catalog) g ON g.event_id = a.event_id GROUP BY ALL".replace("min(a.t_us) AS t_us", "arg_min(a.t_us, CASE WHEN a.event_id = keeper THEN a.t_us ELSE a.t_us + 10000000000000000 END) AS t_us"))
def wn21_fold(v):
    groups = v.catalog().groupBy("day").agg(F.min("event_id").alias("keeper")).join(v.catalog().select("day", "event_id"), "day")
    return windows.fold_picks(v.assignments(), groups.select("event_id", "keeper")).select("event_id", "station", "phase", "t_us")


@query("SELECT id, t_us, mag FROM (SELECT id, t_us, mag FROM v_regional WHERE NOT t_us BETWEEN 1705276800000000 AND 1705881600000000 UNION ALL SELECT id, t_us, mag + 1 FROM v_regional WHERE t_us BETWEEN 1705276800000000 AND 1705881600000000)")
def wn20_refresh(v):
    r = v.regional().select("id", "t_us", "mag")
    spans = v.spark.createDataFrame([(1705276800000000, 1705881600000000)], "start_us long, end_us long")
    fetched = r.where("t_us between 1705276800000000 and 1705881600000000").withColumn("mag", F.col("mag") + 1)
    return windows.refresh_rows(r, fetched, spans)


@query("SELECT event_id, magnitude, total, total_pages FROM (SELECT event_id, magnitude FROM v_catalog ORDER BY magnitude DESC NULLS FIRST, event_id LIMIT 25 OFFSET 25), (SELECT count(*) AS total, greatest(ceil(count(*) / 25.0), 1)::BIGINT AS total_pages FROM v_catalog)")
def srt01_browse(v):
    return filters.browse(v.catalog(), "magnitude", "desc", 2, 25).select("event_id", "magnitude", "total", "total_pages")


@query("SELECT event_id, source, num_picks FROM (SELECT event_id, 'ep' AS source, num_picks FROM v_primary UNION ALL SELECT event_id, 'po', NULL FROM v_secondary)")
def set01_append(v):
    a = v.primary().select("event_id", F.lit("ep").alias("source"), "num_picks")
    return filters.append_rows(a, v.secondary().select("event_id", F.lit("po").alias("source")))


# scalars
@query("SELECT event_id, round(2 * 6371.0e0 * atan2(sqrt(h), sqrt(1 - h)), 6) AS haversine, round(2 * 6371.0e0 * asin(sqrt(h)), 6) AS circle FROM (SELECT event_id, sin(radians(latitude - 31.778e0) / 2) ** 2 + cos(radians(31.778e0)) * cos(radians(latitude)) * sin(radians(longitude + 106.408e0) / 2) ** 2 AS h FROM v_catalog)")
def sc01_distances(v):
    here = (F.lit(geo.CENTRE_LAT), F.lit(geo.CENTRE_LON), F.col("latitude"), F.col("longitude"))
    return v.catalog().select("event_id", F.round(geo.haversine_km(*here), 6).alias("haversine"), F.round(geo.great_circle_km(*here), 6).alias("circle"))


@query("SELECT pick_id, CASE WHEN k % 4 = 0 THEN true WHEN k % 4 = 1 AND probability >= 0.5 THEN false ELSE k % 2 = 0 END AS needed, CASE WHEN k % 4 <> 1 THEN true ELSE probability > 0.3e0 + 0.001e0 END AS improved FROM v_picks")
def sc13_chunks(v):
    status = F.when(F.col("k") % 4 == 0, "failed").when(F.col("k") % 4 == 1, "success").otherwise("no_data")
    need = scalars.needs_fetch(status, F.col("probability"), F.col("k") % 2 == 0, F.lit(False), 0.5)
    return v.picks().select("pick_id", need.alias("needed"), scalars.improved(status, F.lit(0.3), F.col("probability")).alias("improved"))


@query("SELECT event_id, CASE WHEN depth_km >= 20 THEN 6.60 WHEN depth_km >= 10 THEN 6.20 WHEN depth_km >= 3 THEN 5.50 WHEN depth_km >= 1 THEN 4.85 ELSE 3.30 END::DOUBLE AS vp FROM v_catalog")
def sc15_velocity(v):
    return v.catalog().select("event_id", geo.layer_velocity(F.col("depth_km"), "P").alias("vp"))


@query(f"SELECT event_id, magnitude, t_us, triage, ml FROM (SELECT event_id, CASE WHEN (n_core < 2 AND n_stations < 5) OR coalesce(magnitude >= 2.2e0 AND n_picks <= 4, false) THEN 'auto_reject' WHEN n_picks <= 4 THEN 'flag' ELSE 'ok' END AS triage FROM ({TRIAGE_SQL})) JOIN v_catalog USING (event_id) LEFT JOIN (SELECT event_id, round(median(ml), 6) AS ml FROM ({ML_SQL.replace('SELECT a.*, c.depth_km, 2 * 6371', 'SELECT a.*, 2 * 6371')}) GROUP BY event_id) USING (event_id) WHERE review_status = 'confirmed' AND event_id IN (SELECT event_id FROM v_assignments GROUP BY event_id HAVING count(DISTINCT station) >= 3) ORDER BY t_us DESC LIMIT 50")
def slice_catalog(v):
    """Confirmed events with enough stations, their network magnitude and triage label: the newest page."""
    a, c = v.assignments(), v.catalog()
    good = agg.qc_stations(c.where("review_status = 'confirmed'"), a)
    f = agg.triage_features(good, a, CORE)
    label, _ = scalars.triage(F.col("magnitude"), F.col("n_picks"), F.col("n_stations"), F.col("n_core"), F.lit(None).cast("string"))
    ml = agg.network_ml(a, c, v.stations()).select("event_id", F.round("ml", 6).alias("ml"))
    rows = f.withColumn("triage", label).join(ml, "event_id", "left").select("event_id", "magnitude", "t_us", "triage", "ml")
    return rows.orderBy(F.desc("t_us")).limit(50)
