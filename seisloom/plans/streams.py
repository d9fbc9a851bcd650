"""Streaming jobs run to the end over the views, stored as files; their SQL is that of the batch result.

A last row far in the future carries the watermark past all others, so that every window, session and timer comes out.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import sinks
from ..streaming import jobs
from .sql import struct, walk
from .stored import folder
from .views import Views, oracle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
FAR = 4_000_000_000_000_000  # in 2096
FIRST, DAY_US, BATCHES = 1_704_067_200_000_000, 86_400_000_000, 3  # the views begin on 2024-01-01 and span 30 days
HALF_HOUR = 1_800_000_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def query(text: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if text:
            ORACLES[fn.__name__] = oracle(text)
        return fn

    return add


def stream(v, rows: DataFrame, last: dict | None = None, late_us: int = 0) -> DataFrame:
    """``rows(t_us, ...)`` as a stream with ``time``; ``last`` are the fields of the row that closes it.

    With ``late_us`` the rows come shuffled in ``BATCHES`` batches, each up to so late: a batch has rows from before the latest of the ones before."""
    path = folder(v.spark, "stream")
    end = v.spark.range(1).select(*[F.lit((last or {}).get(c, FAR if c == "t_us" else None)).cast(t).alias(c) for c, t in rows.dtypes])
    if late_us:
        held = F.pmod(F.xxhash64(*rows.columns), F.lit(late_us))
        batch = F.least(F.greatest(F.floor((F.col("t_us") + held - FIRST) / (30 * DAY_US // BATCHES)), F.lit(0)), F.lit(BATCHES - 1))
        dealt = rows.withColumn("batch_", batch).withColumn("shuffled_", F.xxhash64(F.lit(1), *rows.columns)).checkpoint()
        for k in range(BATCHES):
            part = dealt.where(F.col("batch_") == k).repartition(1).sortWithinPartitions("shuffled_").select(*rows.columns)
            part.write.parquet(f"{path}/batch-{k}")
        if last is not None:
            end.coalesce(1).write.parquet(f"{path}/batch-{BATCHES}")
        source = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    else:
        (rows.unionByName(end) if last is not None else rows).write.parquet(path)
        source = v.spark.readStream.schema(rows.schema)
    return source.parquet(path).withColumn("time", F.timestamp_micros("t_us"))


def finished(v, out: DataFrame) -> DataFrame:
    """All that a stream appends, as a table."""
    v.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    path = folder(v.spark, "streamed")
    q = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", folder(v.spark, "progress")).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return v.spark.read.schema(out.schema).parquet(path)


@query("SELECT station, t_us // 3600000000 * 3600000000 AS start_us, count(*) AS n FROM v_picks GROUP BY ALL")
def str04_rates(v):
    picks = stream(v, v.picks().select("station", "t_us"), {"station": "end"}, DAY_US)
    return finished(v, jobs.pick_rate(picks)).where("station <> 'end'").select("station", F.unix_micros("start").alias("start_us"), "n")


@query("SELECT start_us, count(*) AS n, count(DISTINCT station) AS stations FROM (SELECT station, t_us // 3600000000 * 3600000000 - h * 3600000000 AS start_us FROM v_picks, range(2) r(h)) GROUP BY 1")
def str05_sliding(v):
    """Windows of two hours every hour."""
    picks = stream(v, v.picks().select("station", "t_us"), {"station": "end"}, HALF_HOUR)
    out = finished(v, jobs.sliding_counts(picks, "2 hours", "1 hour")).select(F.unix_micros("start").alias("start_us"), "n", "stations")
    return out.where(F.col("start_us") < FAR // 2)


@query("SELECT min(t_us) AS start_us, count(*) AS n, count(DISTINCT station) AS stations FROM (SELECT *, sum(b) OVER (ORDER BY t_us) AS s FROM (SELECT *, coalesce((t_us - lag(t_us) OVER (ORDER BY t_us) > 600000000)::INT, 1) AS b FROM v_picks)) GROUP BY s HAVING count(*) >= 2")
def str06_sessions(v):
    picks = stream(v, v.picks().select("network", "station", "t_us"), {"network": "end", "station": "end"}, HALF_HOUR)
    out = finished(v, jobs.pick_sessions(picks, "10 minutes", 2)).where("network <> 'end'")
    return out.select(F.unix_micros("start").alias("start_us"), "n", F.col("stations").cast("long").alias("stations"))


@query("""SELECT pick_id AS id, 'pick' AS what FROM v_picks a WHERE pick_id % 2 = 1 AND EXISTS (SELECT 1 FROM v_picks b WHERE b.pick_id % 2 = 0 AND b.station = a.station AND b.phase = a.phase AND abs(b.t_us - a.t_us) <= 1800000000)
UNION ALL SELECT n, 'event' FROM v_secondary s WHERE NOT EXISTS (SELECT 1 FROM v_primary p WHERE abs(p.t_us - s.t_us) <= 600000000)""")
def str07_second_detector(v):
    """Corroborated picks within half an hour, and separate events by ten minutes."""
    p = v.picks().select("pick_id", "station", "phase", "t_us")
    a, b = (stream(v, p.where(f"pick_id % 2 = {i}"), {"station": "end", "phase": "P", "pick_id": -1}, HALF_HOUR) for i in (1, 0))
    picks = finished(v, jobs.corroborate(a, b, "30 minutes", "1 hour")).where("pick_id >= 0")
    c, d = (stream(v, df.select("n", "t_us"), {"n": -1}, HALF_HOUR) for df in (v.secondary(), v.primary()))
    events = finished(v, jobs.separate(c, d, 600, "1 hour")).where("n >= 0")
    return picks.select(F.col("pick_id").alias("id"), F.lit("pick").alias("what")).unionAll(events.select("n", F.lit("event")))


@query("SELECT c.event_id, first(id ORDER BY r.t_us DESC, id DESC) AS regional_id FROM v_catalog c LEFT JOIN v_regional r ON r.t_us BETWEEN c.t_us - 900000000 AND c.t_us - 5000000 GROUP BY 1")
def str08_regional(v):
    """A longer reach than 90 s, so that some are met."""
    path, regional = folder(v.spark, "tagged"), v.regional()
    write = lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")
    tagger = jobs.regional_tagger(lambda: regional, lambda: None, write, 5, 900)
    source = stream(v, v.catalog().select("event_id", "t_us"))
    source.writeStream.foreachBatch(tagger).option("checkpointLocation", folder(v.spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return v.spark.read.parquet(path).select("event_id", "regional_id")


@query(""", d AS (SELECT station AS key, t_us, lead(t_us) OVER (PARTITION BY station ORDER BY t_us) AS next_us FROM v_picks WHERE k % 10 = 0),
g AS (SELECT *, (t_us // 86400000000 + 2) * 86400000000 AS due FROM d)
SELECT key, 'silent' AS alert, due AS at_us FROM g WHERE next_us IS NULL OR next_us >= due UNION ALL SELECT key, 'back', next_us FROM g WHERE next_us >= due""")
def str09_dark(v):
    """Stations by a tenth of their picks, dark after a day."""
    data = stream(v, v.picks().where("k % 10 = 0").select("station", "t_us"), {"station": "end"}, DAY_US // 2)
    return finished(v, jobs.dark_stations(data, 1)).where("key <> 'end'")


@query(""", e AS (SELECT t_us, lead(t_us) OVER (ORDER BY t_us) AS next_us FROM v_catalog WHERE k % 5 = 0)
SELECT event_id AS what, t_us AS at_us FROM v_catalog WHERE magnitude >= 4 UNION ALL SELECT 'silent', t_us + 21600000000 FROM e WHERE next_us IS NULL OR next_us >= t_us + 21600000000
UNION ALL SELECT 'back', next_us FROM e WHERE next_us >= t_us + 21600000000""")
def str10_alerts(v):
    """Strong events once though they come twice, and silences of six hours of a fifth of the events."""
    c = v.catalog().select("event_id", "magnitude", "t_us")
    strong = finished(v, jobs.significant_events(stream(v, c.unionAll(c), None, DAY_US // 2), 4.0)).select(F.col("event_id").alias("what"), F.col("t_us").alias("at_us"))
    quiet = stream(v, v.catalog().where("k % 5 = 0").select(F.lit("AM").alias("network"), "t_us"), {"network": "end"}, HALF_HOUR)
    return strong.unionAll(finished(v, jobs.quiet_network(quiet, 6)).where("key <> 'end'").select("alert", "at_us"))


@query(f"SELECT station, phase, k.t_us AS t_us, k.probability AS probability FROM (SELECT station, phase, unnest({walk(struct('t_us', 'probability'), 'probability DESC, t_us', 'abs(y.t_us - x[1].t_us) <= 3600000000')}) AS k FROM v_picks GROUP BY station, phase)")
def str11_seams(v):
    """Spacing of an hour, up to half an hour out of order."""
    picks = stream(v, v.picks().select("station", "phase", "t_us", "probability"), {"station": "end", "phase": "P", "probability": 0.0}, HALF_HOUR)
    return finished(v, jobs.seam_dedup(picks, 3_600_000_000, "1 hour")).where("station <> 'end'")


@query("SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n, true AS done FROM v_picks WHERE day <= DATE '2024-01-20' GROUP BY 1")
def str01_days(v):
    """Days that are 26 h old on the 22nd at 3 o'clock, each whole though it comes in several batches."""
    path, rows = folder(v.spark, "days"), v.picks().select("pick_id", "day", "t_us")
    source = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2)
    stored = folder(v.spark, "stream")
    rows.repartition(4).write.parquet(stored)
    jobs.process_days(source.parquet(stored), path, folder(v.spark, "progress"), lambda: datetime(2024, 1, 22, 3, tzinfo=UTC)).awaitTermination()
    n = sinks.read_versions(v.spark, path, rows.schema).groupBy("day").agg(F.count("*").alias("n"))
    done = v.spark.createDataFrame([(d, True) for d in sinks.day_versions(v.spark, path)], "day string, done boolean")
    return n.select(F.col("day").cast("string").alias("day"), "n").join(done, "day", "left").where("day <= '2024-01-20'").select("day", "n", F.coalesce("done", F.lit(False)).alias("done"))


CHUNKS = "SELECT station, t_us // 3600000000 * 3600000000 AS start_us, count(*) AS n FROM v_picks GROUP BY ALL"


@query(f"SELECT station, start_us, unnest(CASE WHEN n >= 2 THEN ['complete'] ELSE ['again', 'accepted'] END) AS action FROM ({CHUNKS})")
def str02_late_chunks(v):
    """An answer for each hour of a station: two picks make it complete, else it is asked for again and at last accepted."""
    start = F.floor(F.col("t_us") / 3_600_000_000) * 3_600_000_000
    rows = v.picks().groupBy("station", start.alias("start_us")).agg(F.count("*").alias("n"))
    rows = rows.select("station", "start_us", (F.col("start_us") + 3_600_000_000).alias("end_us"), (F.col("start_us") + 3_700_000_000).alias("t_us"), F.lit("success").alias("status"), F.least(F.col("n") / 2, F.lit(1.0)).alias("coverage"))
    last = {"station": "end", "start_us": FAR, "end_us": FAR, "status": "success", "coverage": 1.0}
    return finished(v, jobs.follow_chunks(stream(v, rows, last, HALF_HOUR))).where("station <> 'end'")


@query("SELECT strftime(day, '%Y-%m-%d') AS day, station, max(t_us) AS at_us, arg_max(pick_id, t_us) AS pick_id FROM v_picks GROUP BY ALL")
def str03_upserts(v):
    """The latest pick of each station's day, from batches in any order."""
    path = folder(v.spark, "upserts")
    rows = v.picks().select(F.col("day").cast("string").alias("day"), "station", "pick_id", F.col("t_us").alias("at_us"))
    stored = folder(v.spark, "stream")
    rows.repartition(4).write.parquet(stored)
    source = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(stored)
    merge = jobs.upsert_chunks(path, ["day", "station"], "at_us")
    source.writeStream.foreachBatch(merge).option("checkpointLocation", folder(v.spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return sinks.read_versions(v.spark, path, rows.schema).select("day", "station", "at_us", "pick_id")
