"""Readers of the stored forms, with explicit schemas; codes are text and empty stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo, scalars

_CSV = {"header": "true", "emptyValue": "", "nullValue": "\x00", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV).option("recursiveFileLookup", "true").option("enforceSchema", "false").csv(path)


def _codes(df: DataFrame) -> DataFrame:
    """The CSV reader gives null for an empty field; in codes it means the empty code."""
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("network", "station", "location", "channel") if c in df.columns})


def _day_of_file(df: DataFrame) -> DataFrame:
    """``day`` from file names ``{year}.{jday}.*``; other files are left out."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4})\.(\d{3})\.", 0)
    year, jday = F.substring(name, 1, 4).cast("int"), F.substring(name, 6, 3).cast("int")
    return df.where(name != "").withColumn("day", scalars.jday_to_date(year, jday))


def read_picks(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    df = _codes(_day_of_file(_csv(spark, root, schemas.PICKS)))
    if start:
        df = df.where(F.col("day") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("day") <= F.lit(end).cast("date"))
    return df


def read_day_events(spark: SparkSession, root: str, source: str) -> DataFrame:
    df = spark.read.schema(schemas.DAY_EVENTS).options(**_CSV, pathGlobFilter="*.events.csv", recursiveFileLookup="true", ignoreCorruptFiles="true").csv(root)
    return _day_of_file(df).withColumn("source", F.lit(source))


def read_day_tree(spark: SparkSession, root: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Events and assignments ``(source, day, event_index, ...)`` of a source's tree. Files that are named otherwise or cannot be
    read are left out; ``odd_files`` names the former."""
    picks = spark.read.schema(schemas.ASSIGNMENTS).options(**_CSV, pathGlobFilter="*.assignments.csv", recursiveFileLookup="true", ignoreCorruptFiles="true").csv(root)
    return read_day_events(spark, root, source), _codes(_day_of_file(picks)).withColumn("source", F.lit(source))


def odd_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path)`` of CSV files of a tree that are named for no day, to be warned of."""
    files = spark.read.format("binaryFile").options(pathGlobFilter="*.csv", recursiveFileLookup="true").load(root).select("path")
    return files.where(~F.element_at(F.split("path", "/"), -1).rlike(r"^\d{4}\.\d{3}\."))


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    return _codes(_csv(spark, path, schemas.ASSIGNMENTS.replace("event_index int", "event_id string")))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STATIONS).option("multiLine", "true").json(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows: empty is null, ``"1.0"`` is 1, an event type is always there."""
    raw = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    text = {c: F.when(F.col(c) != "", F.col(c)) for c in raw.columns}
    rows = raw.withColumns(text)
    kinds = {"magnitude": "double", "latitude": "double", "longitude": "double", "depth_km": "double", "ml_err": "double"}
    out = {c: F.expr(f"try_cast({c} AS {k})") for c, k in kinds.items() if c in raw.columns}
    out |= {c: F.expr(f"cast(try_cast({c} AS double) AS int)") for c in ("event_index", "num_picks", "num_ml_sta", "corroborating_picks") if c in raw.columns}
    out["event_type"] = F.coalesce("event_type", F.lit("undetermined")) if "event_type" in raw.columns else F.lit("undetermined")
    if "time" in raw.columns:
        out["time"] = scalars.parse_utc(F.col("time"))
    return rows.withColumns(out)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REVIEWS).option("mode", "DROPMALFORMED").json(path)


def parse_regional(df: DataFrame, lat: float = geo.CENTRE_LAT, lon: float = geo.CENTRE_LON, most: int = 20_000) -> DataFrame:
    """Cache rows with their distance; an answer of ``most`` rows or more was cut off and is an error."""
    if df.limit(most).count() >= most:
        raise ValueError(f"{most} rows or more in one answer")
    rows = df.dropna(subset=["time", "latitude", "longitude", "mag"])
    d = geo.great_circle_km(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    return rows.select("id", "time", "latitude", "longitude", "mag", F.coalesce("place", F.lit("")).alias("place"), d.alias("distance_km"))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Channels of StationXML files."""
    schema = (
        "_code string, Station array<struct<_code:string,Channel:array<struct<_code:string,_locationCode:string,_startDate:string,"
        "SampleRate:double,Response:struct<InstrumentSensitivity:struct<Value:double>>>>>>"
    )
    net = spark.read.format("xml").option("rowTag", "Network").schema(schema).load(path)
    sta = net.select(F.col("_code").alias("network"), F.explode("Station").alias("s"))
    cha = sta.select("network", F.col("s._code").alias("station"), F.explode("s.Channel").alias("c"))
    return cha.select(
        "network", "station", F.coalesce("c._locationCode", F.lit("")).alias("location"), F.col("c._code").alias("channel"), F.col("c.SampleRate").alias("sample_rate"),
        scalars.parse_utc(F.col("c._startDate")).alias("epoch_start"), F.col("c.Response.InstrumentSensitivity.Value").alias("sensitivity"),
    )


def read_segments(spark: SparkSession, path: str, day: str | None = None, stations: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if day:
        df = df.where(F.col("day") == F.lit(day).cast("date"))
    return df.where(F.col("station").isin(stations)) if stations else df


def read_log_issues(spark: SparkSession, path: str) -> DataFrame:
    line = scalars.strip_ansi(F.col("value"))
    parts = r"^(\S+ \S+) (WARNING|ERROR|CRITICAL) (.*)$"
    step = F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]*)", 1)
    rows = spark.read.text(path).select(step.alias("step"), *[F.regexp_extract(line, parts, i).alias(c) for i, c in ((1, "time"), (2, "level"), (3, "message"))])
    return rows.where("level <> ''")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Fixed fields, and the open ones in a map."""
    rows = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m")).where("m is not null")
    return rows.select(scalars.parse_utc(F.col("m")["timestamp"]).alias("timestamp"), F.col("m")["step"].alias("step"), F.map_filter("m", lambda k, _: ~k.isin("timestamp", "step")).alias("fields"))


def read_archive_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files by stage, day and channel from their paths; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    parts = F.split(F.element_at(F.split("path", "/"), -1), r"\.")
    rows = files.withColumn("p_", parts).where(F.size("p_") == 7)
    stage = F.element_at(F.split("path", "/"), -4)
    day = scalars.jday_to_date(F.col("p_")[4].cast("int"), F.col("p_")[5].cast("int"))
    return rows.select("path", "length", "modificationTime", stage.alias("stage"), day.alias("day"), *[F.col("p_")[i].alias(c) for i, c in enumerate(("network", "station", "location", "channel"))])


def read_day_times(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("multiLine", "true").schema("day_times array<struct<day:string,total:double,steps:map<string,double>>>").json(path)
    return rows.select(F.explode("day_times").alias("d")).select("d.day", "d.total", F.explode_outer("d.steps").alias("step", "seconds"))


#: The registry's statuses of mines that may blast, and the study box (latitude, longitude).
ACTIVE_STATUSES = ("Active", "Intermittent", "NonProducing Active")
MINE_BOX = (30.5, 32.5, -107.0, -104.0)
MEXICO_SOUTH_OF = 31.78


def read_mines(spark: SparkSession, path: str, box: tuple[float, float, float, float] = MINE_BOX) -> DataFrame:
    """Active mines other than coal inside ``box`` from the pipe-delimited registry; rows without coordinates are left out."""
    raw = spark.read.options(header="true", sep="|", encoding="ISO-8859-1", inferSchema="false").csv(path)
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    number = {"latitude": F.expr("try_cast(LATITUDE AS double)"), "longitude": F.expr("try_cast(LONGITUDE AS double)")}
    fields = {
        "mine_id": text("MINE_ID"), "name": F.trim(F.coalesce("CURRENT_MINE_NAME", F.lit("Unknown"))), "operator": text("CURRENT_OPERATOR_NAME"), "type": text("CURRENT_MINE_TYPE"),
        "status": text("CURRENT_MINE_STATUS"), "commodity": F.when(text("PRIMARY_CANVASS") != "", text("PRIMARY_CANVASS")).otherwise("Unknown"),
        "state": text("STATE"), "county": text("FIPS_CNTY_NM"), "source": F.lit("MSHA"),
    }
    rows = raw.where(text("COAL_METAL_IND") != "C").select(*[c.alias(n) for n, c in (number | fields).items()])
    return rows.where(F.col("latitude").between(*box[:2]) & F.col("longitude").between(*box[2:]) & F.col("status").isin(*ACTIVE_STATUSES))


def read_osm(spark: SparkSession, path: str) -> DataFrame:
    """Quarries and mines of map elements: a node's place or the centre of a way, with the commodity its tags name."""
    schema = "elements array<struct<type:string,id:long,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("elements").alias("e")).select("e.*")
    node = F.col("type") == "node"
    tag = lambda k: F.when(F.col("tags")[k] != "", F.col("tags")[k])
    resource = F.coalesce(tag("resource"), tag("mineral"), tag("rock"), F.lit(""))
    named = F.concat(F.upper(F.substring(resource, 1, 1)), F.lower(F.substring(resource, 2, 1 << 20)))
    commodity = (
        F.when(F.lower(resource).contains("stone") | (F.coalesce(tag("landuse"), F.lit("")) == "quarry"), "Stone")
        .when(F.lower(resource).contains("sand") | F.lower(resource).contains("gravel"), "SandAndGravel")
        .when(tag("industrial") == "mine", "Mine").when(resource != "", named).otherwise("Unknown")
    )
    latitude, longitude = F.when(node, F.col("lat")).otherwise(F.col("center.lat")), F.when(node, F.col("lon")).otherwise(F.col("center.lon"))
    out = rows.select(
        latitude.alias("latitude"), longitude.alias("longitude"), F.concat(F.lit("osm"), F.substring("type", 1, 1), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("mine_id"),
        F.coalesce(tag("name"), tag("operator"), F.lit("Unnamed (OSM)")).alias("name"), F.coalesce(tag("operator"), F.lit("")).alias("operator"),
        F.coalesce(tag("landuse"), tag("industrial"), F.lit("")).alias("type"), F.lit("OSM-tagged").alias("status"), commodity.alias("commodity"),
        F.when(latitude < MEXICO_SOUTH_OF, "Chihuahua").otherwise("").alias("state"), F.coalesce(tag("addr:state"), F.lit("")).alias("county"), F.lit("OSM").alias("source"),
    )
    return out.where("latitude is not null and longitude is not null")


def read_campaign_stations(spark: SparkSession, path: str) -> DataFrame:
    """Stations ``NET.STA.LOC.BAND`` with component lists; the sensitivity is the median of the listed responses."""
    raw = spark.read.options(header="true", inferSchema="false").csv(path)
    code = F.split("station", r"\.")
    response = F.array_sort(F.transform(F.split("response", ","), lambda x: F.trim(x).cast("double")))
    n = F.size("response_")
    median = (F.get("response_", F.floor((n - 1) / 2).cast("int")) + F.get("response_", F.floor(n / 2).cast("int"))) / 2
    return raw.withColumn("response_", response).select(
        *[code[i].alias(c) for i, c in enumerate(("network", "station", "location", "band"))], F.col("lat").cast("double").alias("latitude"), F.col("lon").cast("double").alias("longitude"),
        F.col("`elv(m)`").cast("double").alias("elevation_m"), F.trim("unit").alias("unit"), F.transform(F.split("componet", ","), lambda x: F.trim(x)).alias("components"), median.alias("sensitivity"),
    )
