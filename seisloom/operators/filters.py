"""Projections, predicates, sorts and set operations on catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, scalars


def days_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each day of ``[start, end)``; an end at midnight belongs to the day before."""
    last = F.to_date(F.col(end) - F.expr("INTERVAL 1 MICROSECOND"))
    return df.withColumn("day", F.explode(F.sequence(F.to_date(F.col(start)), last)))


def filter_picks(picks: DataFrame, least: float = 0.5) -> DataFrame:
    return picks.where(F.col("probability") >= least)


def filter_by_date(df: DataFrame, start: str | None, end: str | None, time: str = "time") -> DataFrame:
    """Days ``start`` to ``end`` inclusive; rows without a time go once there is a bound."""
    day = F.to_date(time)
    if start:
        df = df.where(day >= F.lit(start).cast("date"))
    if end:
        df = df.where(day <= F.lit(end).cast("date"))
    return df


def filter_catalog(catalog: DataFrame, min_magnitude=None, max_depth=None, min_picks=None) -> DataFrame:
    if min_magnitude is not None:
        catalog = catalog.where(F.col("magnitude") >= min_magnitude)
    if max_depth is not None:
        catalog = catalog.where(F.col("depth_km") <= max_depth)
    if min_picks is not None:
        catalog = catalog.where(F.col("num_picks") >= min_picks)
    return catalog


def search(catalog: DataFrame, aliases: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring of the id, the time text or the legacy id."""
    rows = catalog.join(aliases.select("event_id", "legacy_id"), "event_id", "left")
    time = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss")
    hit = [F.instr(F.lower(F.coalesce(c, F.lit(""))), text.lower()) > 0 for c in (F.col("event_id"), time, F.col("legacy_id"))]
    return rows.where(hit[0] | hit[1] | hit[2])


def filter_review(catalog: DataFrame, mode: str) -> DataFrame:
    status = F.lower(F.coalesce("review_status", F.lit("")))
    auto = F.coalesce("triage", F.lit("")) == "auto_reject"
    rule = {
        "unreviewed": status == "", "confirmed": status == "confirmed", "rejected": status == "rejected",
        "queue": (status == "") & ~auto, "auto_rejected": (status == "") & auto,
    }
    return catalog.where(rule[mode])


def confirmed_of_type(catalog: DataFrame, event_type: str) -> DataFrame:
    return catalog.where((F.col("review_status") == "confirmed") & (F.col("event_type") == event_type))


def validate_stations(stations: DataFrame) -> DataFrame:
    """``(network, station, severity, rule)``: a row for each rule that a station breaks."""

    def broken(when: Column, severity: str, rule: str) -> Column:
        return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule")))

    lat, lon, elevation = F.col("latitude"), F.col("longitude"), F.col("elevation_m")
    missing = F.col("network").isNull() | F.col("station").isNull() | lat.isNull() | lon.isNull() | elevation.isNull()
    rules = [
        broken(missing, "error", "required"),
        broken(~lat.between(-90, 90), "error", "latitude"),
        broken(~lon.between(-180, 180), "error", "longitude"),
        broken((elevation < -500) | (elevation > 9000), "warning", "elevation"),
        broken(~geo.inside_area(lat, lon), "error", "area"),
        broken(F.col("start_date").isNull(), "error", "start_date"),
        broken(F.col("end_date") < F.col("start_date"), "error", "end_date"),
    ]
    if "channels" in stations.columns:
        rules.append(broken((F.col("channels") != "") & ~F.col("channels").isin(*scalars.CHANNEL_PATTERNS), "warning", "channels"))
        if "model" in stations.columns:
            rules.append(broken(scalars.channel_layout(F.col("channels"), F.col("model")).isNull(), "error", "layout"))
    if "instrument" in stations.columns:
        rules.append(broken(scalars.velocity_sensor(F.col("instrument")).isNull(), "error", "sensor"))
    found = stations.select("network", "station", F.explode(F.array_compact(F.array(*rules))).alias("r"))
    return found.select("network", "station", "r.severity", "r.rule")


def check_core(core: list[str], stations: DataFrame, today: Column) -> DataFrame:
    """Listed stations that are unknown or retired."""
    listed = stations.sparkSession.createDataFrame([(c,) for c in core], "station string")
    known = stations.select("station", "start_date", "end_date", F.lit(True).alias("known"))
    rows = listed.join(known, "station", "left")
    state = F.when(F.col("known").isNull(), "unknown").when(~scalars.active_on(F.col("start_date"), F.col("end_date"), today), "retired")
    return rows.withColumn("state", state).where("state is not null").select("station", "state")


def parse_stream_id(df: DataFrame, name: str) -> DataFrame:
    """``NET.STA.LOC.CHA`` in its parts; other shapes go."""
    parts = F.split(name, r"\.", -1)
    out = df.where(F.size(parts) == 4)
    return out.withColumns({c: parts[i] for i, c in enumerate(("network", "station", "location", "channel"))})


def normalise_picks(raw: DataFrame) -> DataFrame:
    """Detector output as picks: 4-decimal probability, no zero amplitudes, the vertical channel."""
    amplitude = F.when((F.col("amplitude") != 0) & ~F.isnan("amplitude"), F.col("amplitude"))
    return raw.withColumns(
        {"probability": F.round("probability", 4), "amplitude": amplitude, "channel": F.concat("band", F.lit("Z"))}
    ).drop("band")


def resolve_channel(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """For each wanted (station, channel) the exact code, else the orientation in any
    band, else the orientation by its other name (N as 1, E as 2)."""
    other = F.translate("wanted", "NE12", "12NE")
    pairs = wanted.withColumnRenamed("channel", "wanted").join(available, "station")
    rank = (
        F.when(F.col("channel") == F.col("wanted"), 0)
        .when(F.substring("channel", -1, 1) == F.substring("wanted", -1, 1), 1)
        .when(F.substring("channel", -1, 1) == F.substring(other, -1, 1), 2)
    )
    best = F.min_by("channel", F.struct(F.col("rank"), F.col("channel"))).alias("channel")
    return pairs.withColumn("rank", rank).where("rank is not null").groupBy("station", "wanted").agg(best)


def browse(catalog: DataFrame, sort_by: str = "time", order: str = "desc", page: int = 1, per_page: int = 50) -> DataFrame:
    """A page with ``total`` and ``total_pages``; ascending ends with nulls, descending begins with them."""
    key = F.col(sort_by)
    key = key.desc_nulls_first() if order == "desc" else key.asc_nulls_last()
    total = catalog.agg(F.count("*").alias("total"))
    pages = F.greatest(F.ceil(F.col("total") / per_page), F.lit(1)) if per_page else F.lit(1)
    rows = catalog.orderBy(key, "event_id")
    if per_page:
        rows = rows.offset((page - 1) * per_page).limit(per_page)
    return rows.join(F.broadcast(total)).withColumn("total_pages", pages.cast("long"))


def append_rows(catalog: DataFrame, new: DataFrame) -> DataFrame:
    return catalog.unionByName(new, allowMissingColumns=True)


def chronological(df: DataFrame) -> DataFrame:
    return df.orderBy("time", "event_id")
