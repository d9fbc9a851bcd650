"""Queries that write the views in their stored forms, read them back with the library's readers and compare them with SQL on the views."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, windows
from ..sources import readers, sinks
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


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the one that driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{shared.rstrip('/')}/stored-{name}-{uuid.uuid4().hex}"


def put_files(files: DataFrame, path: str) -> str:
    """``files(name, body)``: each row as a file of that name under ``path``, written by the tasks."""

    def put(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where = f"{root}/{name}"
                system.create_dir(where.rpartition("/")[0], recursive=True)
                with system.open_output_stream(where) as out:
                    out.write(body.encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    files.select("name", "body").mapInArrow(put, "name string").agg(F.count("*")).collect()
    return path


def text(*columns: Column | str) -> Column:
    """Cells with commas between, nulls as empty cells."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in columns])


def day_files(rows: DataFrame, line, header: str, suffix: str, group=("day",)) -> DataFrame:
    """A CSV file for each day, named ``{year}.{jday}.suffix`` in the year's folder; a file holds a day's rows."""
    name = F.concat(F.date_format("day", "yyyy/yyyy."), F.date_format("day", "DDD"), F.lit(f".{suffix}"))
    body = F.array_join(F.concat(F.array(F.lit(header)), F.sort_array(F.collect_list("line"))), "\n")
    return rows.withColumn("line", line).groupBy(*group).agg(body.alias("body")).withColumn("name", name)


def iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


@query("SELECT strftime(day, '%Y-%m-%d') AS day, station, phase, t_us, probability, CASE WHEN k % 3 = 0 THEN '' ELSE '00' END AS location FROM v_picks WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def src01_picks(v):
    p = v.picks().withColumn("location", F.when(F.col("k") % 3 != 0, "00"))
    line = text("network", "station", "location", F.lit("EHZ"), "phase", iso("time"), "probability", F.lit("net"), "amplitude", F.lit("EHZ"))
    header = "network,station,location,channel,phase,time,probability,model,amplitude,amplitude_channel"
    path = put_files(day_files(p, line, header, "picks.csv"), folder(v.spark, "picks"))
    out = readers.read_picks(v.spark, path, "2024-01-05", "2024-01-20")
    return out.select(F.col("day").cast("string").alias("day"), "station", "phase", F.unix_micros("time").alias("t_us"), "probability", "location")


@query("SELECT strftime(day, '%Y-%m-%d') AS day, n AS event_index, t_us, magnitude, coalesce(m, 0) AS picks FROM v_catalog LEFT JOIN (SELECT event_id, count(*) AS m FROM v_assignments GROUP BY 1) USING (event_id)")
def src02_day_events(v):
    """Events and assignments of a source tree; a file that is named otherwise is left out."""
    c = v.catalog()
    header = "event_index,time,magnitude,magnitude_type,ml_err,latitude,longitude,depth_km,sigma_time,sigma_amp,num_picks,num_ml_sta"
    none = F.lit("")
    line = text("n", iso("time"), "magnitude", none, none, "latitude", "longitude", "depth_km", none, none, "num_picks", none)
    a = v.assignments("n", "day").withColumn("time", F.timestamp_micros("t_us"))
    a_line = text("n", "network", "station", none, F.lit("EHZ"), "phase", iso("time"), "probability", "amplitude", F.lit("EHZ"))
    a_header = "event_index,network,station,location,channel,phase,time,probability,amplitude,amplitude_channel"
    odd = v.spark.createDataFrame([("notes.events.csv", header + "\n1,2024-01-01T00:00:00,1,,,,,,,,,")], "name string, body string")
    files = day_files(c, line, header, "events.csv").select("name", "body").unionAll(day_files(a, a_line, a_header, "assignments.csv").select("name", "body")).unionAll(odd)
    path = put_files(files, folder(v.spark, "days"))
    events, picks = readers.read_day_tree(v.spark, path, "ep")
    n = picks.groupBy("source", "day", "event_index").agg(F.count("*").alias("picks"))
    out = events.join(n, ["source", "day", "event_index"], "left")
    return out.select(F.col("day").cast("string").alias("day"), F.col("event_index").cast("long").alias("event_index"), F.unix_micros("time").alias("t_us"), "magnitude", F.coalesce("picks", F.lit(0)).alias("picks"))


@query("SELECT station, latitude, longitude, elevation_m, strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, 3.0e8 + nk AS sensitivity FROM v_stations")
def src03_stations(v):
    sensor = F.create_map(F.lit("geophone"), F.struct(F.lit("EHZ").alias("channels"), (3.0e8 + F.col("nk")).alias("sensitivity")))
    rows = v.stations().withColumns({"instrument": sensor, "channels": F.lit("EHZ")}).drop("nk")
    body = F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*rows.columns))), ",\n"), F.lit("]"))
    path = put_files(rows.agg(body.alias("body")).withColumn("name", F.lit("stations.json")), folder(v.spark, "stations"))
    out = readers.read_stations(v.spark, path)
    return out.select("station", "latitude", "longitude", "elevation_m", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"), F.col("instrument")["geophone"]["sensitivity"].alias("sensitivity"))


@query("SELECT event_id, t_us, magnitude, latitude, num_picks, CASE WHEN k % 5 = 0 THEN 'undetermined' ELSE event_type END AS event_type, review_status FROM v_catalog")
def src04_catalog(v):
    """Counts as ``3.0``, missing values empty, some rows without a type."""
    kind = F.when(F.col("k") % 5 != 0, F.col("event_type"))
    rows = v.catalog().select("event_id", iso("time").alias("time"), *[F.col(c).cast("string") for c in ("magnitude", "latitude", "longitude", "depth_km")], F.concat(F.col("num_picks").cast("string"), F.lit(".0")).alias("num_picks"), kind.alias("event_type"), "review_status")
    path = folder(v.spark, "catalog")
    rows.write.option("header", "true").option("nullValue", "").option("emptyValue", "").csv(path)
    out = readers.read_catalog(v.spark, path)
    return out.select("event_id", F.unix_micros("time").alias("t_us"), "magnitude", "latitude", F.col("num_picks").cast("long").alias("num_picks"), "event_type", "review_status")


@query("SELECT event_id, station, '' AS location, phase, t_us, probability FROM v_assignments")
def src05_assignments(v):
    rows = v.assignments().select("event_id", "network", "station", F.lit("").alias("location"), F.lit("EHZ").alias("channel"), "phase", iso_of("t_us").alias("time"), "probability", "amplitude", F.lit("EHZ").alias("amplitude_channel"))
    path = folder(v.spark, "assignments")
    rows.write.option("header", "true").csv(path)
    return readers.read_assignments(v.spark, path).select("event_id", "station", "location", "phase", F.unix_micros("time").alias("t_us"), "probability")


def iso_of(t_us: str) -> Column:
    return F.date_format(F.timestamp_micros(t_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


@query("SELECT c.event_id, c.review_status, coalesce(m, 0) AS picks FROM v_catalog c LEFT JOIN (SELECT event_id, count(*) AS m FROM v_assignments GROUP BY 1) USING (event_id) WHERE review_status IS NOT NULL")
def src06_reviews(v):
    """Two appended batches of records and a broken line; the latest record of an event counts."""
    path, c = folder(v.spark, "reviews"), v.catalog().where("review_status is not null")
    a = v.assignments().withColumn("time", F.timestamp_micros("t_us"))
    wrong = c.select("event_id", "time", "magnitude", F.lit("old").alias("review_status"), "event_type")
    sinks.append_reviews(wrong, a.where("false"), "test", path)
    sinks.append_reviews(c.select("event_id", "time", "magnitude", "review_status", "event_type"), a, "test", path)
    put_files(v.spark.createDataFrame([("broken.json", '{"timestamp": "2024')], "name string, body string"), path)
    out = windows.latest(readers.read_reviews(v.spark, path).where("event_id is not null"), ["event_id"], ["timestamp"])
    return out.select("event_id", F.col("event.review_status").alias("review_status"), F.size("picks").cast("long").alias("picks"))


@query("SELECT id, mag, round(2 * 6371 * asin(sqrt(sin(radians(lat - 31.778e0) / 2) ** 2 + cos(radians(31.778e0)) * cos(radians(lat)) * sin(radians(lon + 106.408e0) / 2) ** 2)), 6) AS distance_km FROM (SELECT *, 28.0e0 + k / 20.0e0 AS lat, -110.0e0 + k / 10.0e0 AS lon FROM (SELECT 'r' || event_id AS id, value / 100 AS mag, k FROM v_events WHERE event_type = 'error' AND value >= 100)) WHERE id NOT LIKE '%7'")
def src07_regional(v):
    rows = v.events().where("event_type = 'error' and value >= 100").select(
        "time", (28.0 + F.col("k") / 20).alias("latitude"), (-110.0 + F.col("k") / 10).alias("longitude"),
        F.when(F.col("event_id") % 10 != 7, F.col("value") / 100).alias("mag"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("id"), F.lit(None).cast("string").alias("place"),
    )
    out = readers.parse_regional(rows, most=10_000_000)
    return out.select("id", "mag", F.round("distance_km", 6).alias("distance_km"))


@query("SELECT station, c AS channel, 100.0::DOUBLE AS sample_rate, 3.0e8 + nk AS sensitivity FROM v_stations, unnest(['EHZ', 'EHN']) u(c)")
def src08_inventory(v):
    cha = lambda c: F.concat(F.lit(f'<Channel code="{c}" locationCode="" startDate="2024-01-01T00:00:00"><SampleRate>100.0</SampleRate><Response><InstrumentSensitivity><Value>'), (3.0e8 + F.col("nk")).cast("string"), F.lit("</Value></InstrumentSensitivity></Response></Channel>"))
    sta = F.concat(F.lit('<Station code="'), "station", F.lit('">'), cha("EHZ"), cha("EHN"), F.lit("</Station>"))
    rows = v.stations().withColumn("x", sta).groupBy("network").agg(F.array_join(F.sort_array(F.collect_list("x")), "\n").alias("x"))
    body = F.concat(F.lit('<FDSNStationXML><Network code="'), "network", F.lit('">'), "x", F.lit("</Network></FDSNStationXML>"))
    path = put_files(rows.select(F.concat("network", F.lit(".xml")).alias("name"), body.alias("body")), folder(v.spark, "inventory"))
    return readers.read_inventory(v.spark, path).select("station", "channel", "sample_rate", "sensitivity")


@query("SELECT vec_id, station, len(samples) AS n, round(list_sum(list_transform(samples, lambda x: x::DOUBLE)), 5) AS total FROM v_traces WHERE station IN ('S01', 'S03')")
def src09_segments(v):
    path, wanted = folder(v.spark, "segments"), ["S01", "S03"]
    rows = v.traces().withColumn("day", F.to_date(F.timestamp_micros("start_us")))
    rows.write.partitionBy("day").parquet(path)
    out = readers.read_segments(v.spark, path, "2024-01-01", wanted)
    total = F.aggregate("samples", F.lit(0.0), lambda a, x: a + x)
    return out.select("vec_id", "station", F.size("samples").cast("long").alias("n"), F.round(total, 5).alias("total"))


@query("SELECT 'M' || n AS mine_id, latitude, longitude, CASE WHEN k % 4 = 0 THEN 'Unknown' ELSE 'Stone' END AS commodity FROM v_catalog WHERE k % 3 <> 0 AND k % 7 <> 0 AND latitude BETWEEN 30.5e0 AND 32.5e0 AND longitude BETWEEN -107.0e0 AND -104.0e0")
def src10_mines(v):
    k = F.col("k")
    rows = v.catalog().select(
        F.concat(F.lit("M"), F.col("n").cast("string")).alias("MINE_ID"), F.lit("Cantera Niño").alias("CURRENT_MINE_NAME"), F.lit("x").alias("CURRENT_OPERATOR_NAME"), F.lit("Surface").alias("CURRENT_MINE_TYPE"),
        F.when(k % 3 == 0, "Abandoned").otherwise("Active").alias("CURRENT_MINE_STATUS"), F.when(k % 4 != 0, "Stone").alias("PRIMARY_CANVASS"), F.lit("TX").alias("STATE"), F.lit("El Paso").alias("FIPS_CNTY_NM"),
        F.when(k % 7 == 0, "C").otherwise("M").alias("COAL_METAL_IND"), F.col("latitude").cast("string").alias("LATITUDE"), F.col("longitude").cast("string").alias("LONGITUDE"),
    )
    path = folder(v.spark, "mines")
    rows.write.options(header="true", sep="|", encoding="ISO-8859-1").csv(path)
    return readers.read_mines(v.spark, path).where("name = 'Cantera Niño'").select("mine_id", "latitude", "longitude", "commodity")


@query("SELECT 'osm' || CASE WHEN k % 2 = 0 THEN 'n' ELSE 'w' END || n AS mine_id, latitude, longitude, CASE k % 4 WHEN 0 THEN 'Stone' WHEN 1 THEN 'SandAndGravel' WHEN 2 THEN 'Mine' ELSE 'Gypsum' END AS commodity FROM v_catalog WHERE k % 5 <> 0")
def src11_osm(v):
    k, node = F.col("k"), F.col("k") % 2 == 0
    placed = k % 5 != 0
    tags = (
        F.when(k % 4 == 0, F.create_map(F.lit("landuse"), F.lit("quarry"))).when(k % 4 == 1, F.create_map(F.lit("resource"), F.lit("fine sand")))
        .when(k % 4 == 2, F.create_map(F.lit("industrial"), F.lit("mine"))).otherwise(F.create_map(F.lit("mineral"), F.lit("GYPSUM")))
    )
    centre = F.when(~node & placed, F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")))
    element = F.struct(F.when(node, "node").otherwise("way").alias("type"), F.col("n").alias("id"), F.when(node & placed, F.col("latitude")).alias("lat"), F.when(node & placed, F.col("longitude")).alias("lon"), centre.alias("center"), tags.alias("tags"))
    body = F.concat(F.lit('{"elements": ['), F.array_join(F.collect_list(F.to_json(element)), ",\n"), F.lit("]}"))
    files = v.catalog().groupBy(F.col("day")).agg(body.alias("body")).withColumn("name", F.concat(F.col("day").cast("string"), F.lit(".json")))
    return readers.read_osm(v.spark, put_files(files, folder(v.spark, "osm"))).select("mine_id", "latitude", "longitude", "commodity")


@query("SELECT CASE WHEN k % 2 = 0 THEN 'detect' ELSE 'ingest' END AS step, strftime(make_timestamp(t_us), '%Y-%m-%d %H:%M:%S') AS time, CASE k % 4 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'ERROR' ELSE 'CRITICAL' END AS level, 'event ' || event_id AS message FROM v_catalog WHERE k % 4 <> 3")
def src12_logs(v):
    k = F.col("k")
    level = F.when(k % 4 == 0, "WARNING").when(k % 4 == 1, "\x1b[31mERROR\x1b[0m").when(k % 4 == 2, "CRITICAL").otherwise("INFO")
    line = F.concat(F.date_format("time", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), level, F.lit(" event "), "event_id")
    step = F.when(k % 2 == 0, "detect.log").otherwise("ingest.log")
    files = v.catalog().groupBy("day", step.alias("step")).agg(F.concat(F.array_join(F.collect_list(line), "\n"), F.lit("\nTraceback: no log line")).alias("body"))
    path = put_files(files.withColumn("name", F.concat(F.col("day").cast("string"), F.lit("/"), "step")), folder(v.spark, "logs"))
    return readers.read_log_issues(v.spark, f"{path}/*").select("step", "time", "level", "message")


@query("SELECT t_us, event_type AS step, k AS seconds FROM v_catalog")
def src13_metrics(v):
    rows = v.catalog().select(F.to_json(F.struct(F.concat(iso("time"), F.lit("Z")).alias("timestamp"), F.col("event_type").alias("step"), F.col("k").alias("seconds"))).alias("value"))
    path = folder(v.spark, "metrics")
    rows.unionAll(v.spark.createDataFrame([("not json",)], "value string")).write.text(path)
    out = readers.read_metrics(v.spark, path).where("step is not null")
    return out.select(F.unix_micros("timestamp").alias("t_us"), "step", F.col("fields")["seconds"].cast("long").alias("seconds"))


@query("SELECT station, 'GP' AS band, latitude, elevation_m, nk + 2.0e0 AS sensitivity FROM v_stations")
def src14_campaign(v):
    n = F.col("nk")
    rows = v.stations().select(
        F.concat_ws(".", "network", "station", F.lit(""), F.lit("GP")).alias("station"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("elevation_m").alias("elv(m)"),
        F.lit("m/s").alias("unit"), F.lit("1, 2,Z").alias("componet"), F.concat_ws(", ", (n + 9.0).cast("string"), (n + 1.0).cast("string"), (n + 2.0).cast("string")).alias("response"),
    )
    path = folder(v.spark, "campaign")
    rows.write.option("header", "true").csv(path)
    return readers.read_campaign_stations(v.spark, path).where("size(components) = 3").select("station", "band", "latitude", "elevation_m", "sensitivity")


@query("SELECT CASE WHEN k % 2 = 0 THEN 'raw' ELSE 'processed' END AS stage, strftime(day, '%Y-%m-%d') AS day, station, count(*) AS files, sum(m)::BIGINT AS bytes FROM (SELECT day, station, k % 2 AS k, min(pick_id) AS m FROM v_picks WHERE k < 20 GROUP BY ALL) GROUP BY ALL".replace("sum(m)::BIGINT AS bytes", "sum(1 + m % 5)::BIGINT AS bytes"))
def src15_inventory(v):
    rows = v.picks().where("k < 20").groupBy("day", "station", (F.col("k") % 2).alias("k")).agg(F.min("pick_id").alias("m"))
    name = F.concat(F.when(F.col("k") == 0, "raw").otherwise("processed"), F.date_format("day", "/yyyy/"), F.date_format("day", "DDD"), F.lit("/AM."), "station", F.lit("..EHZ."), F.date_format("day", "yyyy."), F.date_format("day", "DDD"), F.lit(".mseed"))
    path = put_files(rows.select(name.alias("name"), F.repeat(F.lit("x"), (1 + F.col("m") % 5).cast("int")).alias("body")), folder(v.spark, "archive"))
    out = readers.read_archive_inventory(v.spark, path)
    return out.groupBy("stage", F.col("day").cast("string").alias("day"), "station").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("SELECT strftime(day, '%Y-%m-%d') AS day, any_value(total) AS total, step, sum(k)::DOUBLE AS seconds FROM (SELECT *, sum(k) OVER (PARTITION BY day)::DOUBLE AS total, event_type AS step FROM v_catalog) GROUP BY day, step")
def src16_day_times(v):
    steps = v.catalog().groupBy("day", "event_type").agg(F.sum("k").cast("double").alias("s"))
    rows = steps.groupBy("day").agg(F.sum("s").alias("total"), F.map_from_entries(F.collect_list(F.struct("event_type", "s"))).alias("steps"))
    told = F.to_json(F.struct(F.col("day").cast("string").alias("day"), "total", "steps"))
    body = F.concat(F.lit('{"day_times": ['), F.array_join(F.collect_list(told), ","), F.lit("]}"))
    path = put_files(rows.agg(body.alias("body")).withColumn("name", F.lit("status.json")), folder(v.spark, "status"))
    return readers.read_day_times(v.spark, path)


@query("SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (k % 2 = 1) AS n, true AS done FROM v_picks GROUP BY 1")
def snk01_days(v):
    """Every day written twice, the second time with half of its rows; a quiet day gets its marker as well."""
    path, p = folder(v.spark, "table"), v.picks().select("pick_id", "station", "k", "day")
    days = p.select("day").distinct()
    sinks.write_day(p, path, days)
    sinks.write_day(p.where("k % 2 = 1"), path, days)
    n = v.spark.read.parquet(f"{path}/data").groupBy("day").agg(F.count("*").alias("n"))
    done = sinks.done_days(v.spark, path).withColumn("done", F.lit(True))
    return done.join(n, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).alias("n"), "done")


@query("SELECT event_id, magnitude FROM v_catalog WHERE k % 2 = 0")
def snk02_publish(v):
    root, c = folder(v.spark, "versions"), v.catalog().select("event_id", "magnitude", "k")
    sinks.publish(c, root, "catalog")
    sinks.publish(c.where("k % 2 = 0"), root, "catalog")
    return sinks.published(v.spark, root, "catalog").select("event_id", "magnitude")


@query("SELECT event_id, review_status, magnitude, coalesce(m, 0) AS picks FROM v_catalog LEFT JOIN (SELECT event_id, count(*) AS m FROM v_assignments GROUP BY 1) USING (event_id) WHERE review_status = 'confirmed'")
def snk03_append(v):
    """NaN magnitudes become null."""
    c = v.catalog().where("review_status = 'confirmed'").withColumn("magnitude", F.coalesce("magnitude", F.lit(float("nan"))))
    path = folder(v.spark, "log")
    sinks.append_reviews(c.select("event_id", F.col("time").cast("string").alias("time"), "magnitude", "review_status", "event_type"), v.assignments().withColumn("time", F.timestamp_micros("t_us")), "test", path)
    out = readers.read_reviews(v.spark, path)
    return out.select("event_id", "event.review_status", "event.magnitude", F.size("picks").cast("long").alias("picks"))


@query("SELECT event_id FROM v_catalog WHERE review_status IS NOT NULL AND k % 3 <> 0")
def snk04_changed(v):
    c, columns = v.catalog(), ["review_status", "event_type", "magnitude"]
    status = F.when(F.col("k") % 3 == 1, "other").otherwise(F.col("review_status"))
    was = c.where("k % 3 <> 2").select("event_id", F.struct(status.alias("review_status"), "event_type", "magnitude").alias("event"))
    return sinks.changed_reviews(c, was, columns).select("event_id")


@query("SELECT event_id, 'retired' AS what FROM v_catalog WHERE k % 2 = 1 UNION ALL SELECT event_id, 'alias' FROM v_catalog WHERE k % 2 = 0 AND n % 3 = 0")
def snk08_retire(v):
    c = v.catalog()
    gone, aliases = sinks.retire(c.select("event_id"), c.where("k % 2 = 0"), c.where("n % 3 = 0").select("event_id", F.col("n").alias("legacy_id")))
    return gone.select("event_id", F.lit("retired").alias("what")).unionAll(aliases.select("event_id", F.lit("alias").alias("what")))


@query("SELECT CASE WHEN k % 2 = 0 THEN 'new' || n ELSE event_id END AS event_id, k % 2 = 0 AS renamed, t_us FROM v_assignments a JOIN v_catalog c USING (event_id)".replace("t_us FROM", "a.t_us FROM"))
def snk09_rename(v):
    c = v.catalog()
    mapping = c.where("k % 2 = 0").select(F.col("event_id").alias("old"), F.concat(F.lit("new"), F.col("n").cast("string")).alias("new"))
    return joins.fold_ids(v.assignments(), mapping, "event_id").select("event_id", "renamed", "t_us")


@query("SELECT event_id, longitude, latitude, event_type AS commodity FROM v_catalog")
def snk10_geojson(v):
    rows = sinks.to_geojson(v.catalog().select("event_id", "longitude", "latitude", F.col("event_type").alias("commodity")), "longitude", "latitude")
    back = F.from_json("feature", "type string, geometry struct<type:string,coordinates:array<double>>, properties struct<event_id:string,commodity:string>")
    out = rows.select(back.alias("f")).where("f.type = 'Feature' and f.geometry.type = 'Point'")
    return out.select("f.properties.event_id", F.col("f.geometry.coordinates")[0].alias("longitude"), F.col("f.geometry.coordinates")[1].alias("latitude"), "f.properties.commodity")
