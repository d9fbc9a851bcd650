"""Writers: day tables with markers, published versions, review logs, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_day(df: DataFrame, path: str, days: DataFrame) -> None:
    """Replaces the days of ``df``; then, last, marks ``days(day)`` as done, quiet ones included."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/data")
    days.select("day").write.mode("append").parquet(f"{path}/days_done")


def done_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("day date").parquet(f"{path}/days_done").distinct()


# --- days in versions: a pointer file tells which version of each day counts ---
def _list(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(where) if x.isDirectory()) if fs.exists(where) else []


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def day_versions(spark: SparkSession, path: str) -> dict[str, int]:
    """The version of each day that readers see."""
    for name in reversed(_list(spark, f"{path}/pointers")):
        if exists(spark, f"{path}/pointers/{name}/_SUCCESS"):  # an unfinished one does not count
            return {r["day"]: r["version"] for r in spark.read.schema("day string, version long").parquet(f"{path}/pointers/{name}").collect()}
    return {}


def write_versions(df: DataFrame, path: str, version: int, days: list[str], kept: int = 2) -> None:
    """The ``days`` of ``df(day, ...)``, also those without rows, as ``version``; then, last, a new pointer file, so that a crash leaves the
    versions before in sight. ``version`` only grows; a day that has it already is left alone. Of a day and of the pointers, ``kept`` versions stay."""
    spark, now = df.sparkSession, day_versions(df.sparkSession, path)
    days = [d for d in days if now.get(d, -1) < version]
    if not days:
        return
    rows = df.where(F.col("day").cast("string").isin(days)).withColumn("version", F.lit(version).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "version").parquet(f"{path}/data")
    after = now | dict.fromkeys(days, version)
    pointers = spark.createDataFrame(sorted(after.items()), "day string, version long").coalesce(1)
    pointers.write.mode("overwrite").parquet(f"{path}/pointers/{version:020d}")
    for name in _list(spark, f"{path}/pointers")[:-kept]:
        _remove(spark, f"{path}/pointers/{name}")
    for d in days:
        for name in sorted(_list(spark, f"{path}/data/day={d}"), key=lambda x: int(x.split("=")[1]))[:-kept]:
            _remove(spark, f"{path}/data/day={d}/{name}")


def read_versions(spark: SparkSession, path: str, schema: StructType, days: list[str] | None = None) -> DataFrame:
    """The days, or those of ``days``, each in the version that counts. Only their own files are listed and read."""
    now = day_versions(spark, path)
    folders = [f"{path}/data/day={d}/version={v}" for d, v in now.items() if days is None or d in days]
    folders = [f for f in folders if exists(spark, f)]  # a day may be without rows
    if not folders:
        return spark.createDataFrame([], schema)
    shape = StructType([*(f for f in schema.fields if f.name not in ("day", "version")), StructField("day", StringType()), StructField("version", LongType())])
    rows = spark.read.schema(shape).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def publish(df: DataFrame, root: str, name: str) -> str:
    """A new version of a whole table; readers follow a numbered pointer that is written last. One writer at a time."""
    spark = df.sparkSession
    version, pointers = f"{root}/{name}/v-{uuid.uuid4().hex}", f"{root}/{name}/_pointers"
    df.write.parquet(version)
    last = spark.read.parquet(pointers).agg(F.max("n")).first()[0] if exists(spark, pointers) else 0
    spark.range(1).select(F.lit(version).alias("version"), F.lit(last + 1).cast("long").alias("n")).write.mode("append").parquet(pointers)
    return version


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    row = spark.read.parquet(f"{root}/{name}/_pointers").agg(F.max_by("version", "n").alias("v")).first()
    return spark.read.parquet(row["v"])


def review_records(events: DataFrame, picks: DataFrame, source: str) -> DataFrame:
    """A record for each event with its picks; NaN is null."""
    clean = events.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, k in events.dtypes if k in ("double", "float")})
    p = picks.groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct("network", "station", "phase", F.col("time").cast("string").alias("time")))).alias("picks"))
    rows = clean.join(p, "event_id", "left")
    return rows.select(F.current_timestamp().alias("timestamp"), F.lit(source).alias("source"), "event_id", F.struct(*clean.columns).alias("event"), F.coalesce("picks", F.array()).alias("picks"))


def append_reviews(events: DataFrame, picks: DataFrame, source: str, path: str) -> None:
    review_records(events, picks, source).write.mode("append").json(path)


def changed_reviews(catalog: DataFrame, latest: DataFrame, columns: list[str]) -> DataFrame:
    """Reviewed rows that differ, as text, from their latest record, or have none."""
    now = F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]))
    was = F.to_json(F.struct(*[F.coalesce(F.col(f"event.{c}").cast("string"), F.lit("")).alias(c) for c in columns]))
    rows = catalog.where("review_status is not null").withColumn("now_", now)
    rows = rows.join(latest.select("event_id", was.alias("was_")), "event_id", "left")
    return rows.where(~F.col("now_").eqNullSafe(F.col("was_"))).drop("now_", "was_")


EXPORT = ("event_id", "time", "latitude", "longitude", "depth_km", "magnitude", "magnitude_type", "ml_err", "num_picks", "num_ml_sta", "event_type", "review_status", "reviewed", "triage", "detector")


def export_catalog(catalog: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    from ..operators.filters import filter_by_date

    rows = filter_by_date(catalog, start, end).where(F.lower(F.coalesce("review_status", F.lit(""))) != "rejected")
    return rows.select(*[F.col(c) if c in catalog.columns else F.lit(None).cast("string").alias(c) for c in EXPORT])


#: Event types in the exchange format's words.
EVENT_TYPES = {"quarry_blast": "quarry blast", "earthquake": "earthquake", "explosion": "explosion"}


def export_events_nested(catalog: DataFrame, assignments: DataFrame) -> DataFrame:
    """Origin (depth in m), magnitude and picks in time order, nested."""
    picks = assignments.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("t_us", "network", "station", "phase"))).alias("picks"))
    kinds = F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair])
    return catalog.join(picks, "event_id", "left").select(
        "event_id", F.coalesce(kinds[F.col("event_type")], F.lit("not reported")).alias("type"),
        F.struct("t_us", "latitude", "longitude", (F.col("depth_km") * 1000).alias("depth_m")).alias("origin"),
        F.when(F.col("magnitude").isNotNull(), F.struct(F.col("magnitude").alias("mag"), F.lit("ML").alias("type"))).alias("magnitude"), "picks",
    )


def retire(existing: DataFrame, exported: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids whose documents go, and the aliases that still lead somewhere."""
    ids = exported.select("event_id")
    return existing.join(ids, "event_id", "left_anti"), aliases.join(ids, "event_id", "left_semi")


def to_geojson(features: DataFrame, longitude: str, latitude: str) -> DataFrame:
    rest = [c for c in features.columns if c not in (longitude, latitude)]
    point = F.struct(F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates"))
    return features.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*rest).alias("properties"))).alias("feature"))


def envelope(samples, bins: int):
    """``[min, max]`` of each of ``bins`` stretches, over the largest absolute sample, to 4 decimals; zeros where a stretch is empty."""
    n = F.size(samples)
    peak = F.greatest(F.abs(F.array_max(samples)), F.abs(F.array_min(samples)))
    peak = F.when(peak > 0, peak).otherwise(1.0)
    edge = lambda i: F.floor(i * n / bins).cast("int")

    def pair(i):
        part = F.slice(samples, edge(i) + 1, edge(i + 1) - edge(i))
        return F.when(F.size(part) > 0, F.array(F.round(F.array_min(part) / peak, 4), F.round(F.array_max(part) / peak, 4))).otherwise(F.array(F.lit(0.0), F.lit(0.0)))

    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), pair)


def export_public(catalog: DataFrame, assignments: DataFrame, stations: DataFrame, segments: DataFrame, bins: int = 700, before_s: float = 2.0, longest_us: int = 86_400_000_000) -> DataFrame:
    """A row for each confirmed event, newest first: picks as offsets from the origin, and envelopes of the picked stations' vertical segments
    ``(station, start_us, rate, samples)``, nearest station first. A later segment of a window wins whole."""
    from ..functions import geo, scalars
    from ..operators.joins import picks_of, with_station
    from ..operators.timejoin import range_join

    events = catalog.where("review_status = 'confirmed'")
    place = events.select("event_id", F.col("t_us").alias("origin_us"), F.col("latitude").alias("e_lat"), F.col("longitude").alias("e_lon"))
    rows = with_station(picks_of(assignments, events), stations).join(place, "event_id").withColumn("km_", geo.haversine_km(F.col("e_lat"), F.col("e_lon"), F.col("latitude"), F.col("longitude")))
    offset = F.round((F.col("t_us") - F.col("origin_us")) / scalars.SECOND, 3)
    picks = rows.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("station", offset.alias("t"), "phase"))).alias("picks"))
    want = rows.select("event_id", "network", "station", "origin_us", "km_", scalars.post_window(F.col("km_")).alias("post_")).distinct()
    w = int(before_s * scalars.SECOND)
    cut = range_join(want, segments.select("station", "start_us", "rate", "samples"), "origin_us", "start_us", -w - longest_us, 45 * scalars.SECOND, ("station",))
    first = F.greatest(F.ceil((F.col("origin_us") - w - F.col("start_us")) * F.col("rate") / 1e6), F.lit(0)).cast("int")
    stop = F.least(F.floor((F.col("origin_us") + F.col("post_") * scalars.SECOND - F.col("start_us")) * F.col("rate") / 1e6) + 1, F.size("samples").cast("long")).cast("int")
    cut = cut.withColumns({"first_": first, "stop_": stop}).where("stop_ > first_")
    cut = cut.withColumn("samples", F.slice("samples", F.col("first_") + 1, F.col("stop_") - F.col("first_")))
    cut = cut.groupBy("event_id", "network", "station", "km_", "post_").agg(F.max_by("samples", "start_us").alias("samples"))
    trace = F.struct(
        F.round("km_", 1).alias("distance_km"), "station", "network", F.lit(-before_s).alias("t0"), F.round((F.col("post_") + before_s) / bins, 5).alias("dt"), envelope(F.col("samples"), bins).alias("minmax"),
    )
    traces = cut.groupBy("event_id").agg(F.array_sort(F.collect_list(trace)).alias("traces"))
    out = events.join(picks, "event_id", "left").join(traces, "event_id", "left")
    return out.select(
        "event_id", "t_us", F.round("latitude", 5).alias("latitude"), F.round("longitude", 5).alias("longitude"), F.round("depth_km", 2).alias("depth_km"), F.round("magnitude", 2).alias("magnitude"),
        "event_type", F.coalesce(F.col("num_picks").cast("long"), F.size("picks").cast("long")).alias("num_picks"), "picks", "traces",
    ).orderBy(F.desc("t_us"), "event_id")


def public_summary(exported: DataFrame, stations: DataFrame) -> DataFrame:
    counts = exported.agg(F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "quarry_blast").alias("n_quarry_blasts"), F.count_if(F.col("event_type") == "earthquake").alias("n_earthquakes"))
    return counts.crossJoin(stations.agg(F.count("*").alias("n_stations")))
