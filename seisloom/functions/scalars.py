"""Time, text and rule functions on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000  # in the integer microseconds that times are compared in


def micros(time: Column) -> Column:
    return F.unix_micros(time)


def jday_to_date(year: Column, jday: Column) -> Column:
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), jday - 1)


def parse_utc(text: Column) -> Column:
    """ISO text with ``Z`` or an offset, or naive and then UTC, whatever the session's zone; bad text is null."""
    day, zoned = text.rlike(r"^\s*\d{4}-\d{2}-\d{2}\s*$"), text.rlike(r"(?:[zZ]|[+-]\d{2}(?::?\d{2})?)\s*$")
    trimmed = F.trim(text)
    return F.try_to_timestamp(F.when(day, F.concat(trimmed, F.lit("T00:00:00Z"))).when(zoned, trimmed).otherwise(F.concat(trimmed, F.lit("Z"))))


def utc(time: Column) -> Column:
    """A time whose fields in the session's zone are those of UTC."""
    return F.to_utc_timestamp(time, F.current_timezone())


def utc_hour(t_us: Column) -> Column:
    return F.floor(F.pmod(t_us, F.lit(86_400 * SECOND)) / (3600 * SECOND)).cast("int")


def event_id_base(time: Column, prefix: Column) -> Column:
    return F.concat(prefix, F.date_format(utc(time), "yyyyMMdd'T'HHmmss"))


def day_of_id(event_id: Column) -> Column:
    return F.substring(event_id, 3, 8)


def is_legacy_id(event_id: Column) -> Column:
    return event_id.rlike(r"^[a-z]{2}\d{8}-\d{4}$")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, "\x1b\\[[0-9;]*m", "")


def snap_rate(rate: Column, tolerance: float = 0.01) -> Column:
    return F.when(F.abs(rate - F.rint(rate)) <= tolerance, F.rint(rate)).otherwise(rate)


def post_window(distance_km: Column) -> Column:
    return F.least(F.lit(45.0), distance_km / 2 + 15)


def per_channel(correlation: Column, n_chans: Column) -> Column:
    return F.abs(correlation) / n_chans


def needs_fetch(status: Column, coverage: Column, in_window: Column, force: Column, least: float = 0.99) -> Column:
    """Whether a chunk is to be asked for (again)."""
    full = (status == "success") & (coverage.isNull() | (coverage >= least))
    return F.when(status.isNull() | (status == "failed"), True).when(full, False).otherwise(force | in_window)


def improved(old_status: Column, old_coverage: Column, coverage: Column) -> Column:
    """Whether a fetch stored more than there was; an old success of unknown coverage is complete."""
    first = old_status.isNull() | (old_status != "success")
    return F.when(first, True).when(old_coverage.isNull(), False).otherwise(coverage > old_coverage + 0.001)


#: Sensors of ground velocity in order of preference, and known channel patterns.
VELOCITY_SENSORS = ("geophone", "seismometer", "broadband", "node")
CHANNEL_PATTERNS = ("EHZ", "EH?", "E??", "HH?", "HHZ", "EN?", "SHZ", "BHZ", "BH?", "GP?", "DP?")


def velocity_sensor(instrument: Column) -> Column:
    """``struct(kind, sensitivity)`` of the first velocity sensor; null if there is none or it is not above 0."""
    kind = F.coalesce(*[F.when(F.map_contains_key(instrument, F.lit(k)), F.lit(k)) for k in VELOCITY_SENSORS])
    sensitivity = instrument[kind]["sensitivity"]
    return F.when(sensitivity > 0, F.struct(kind.alias("kind"), sensitivity.alias("sensitivity")))


def channel_layout(channels: Column, model: Column) -> Column:
    """``struct(band, components)`` of what detection reads; null where it cannot be told."""
    chans = F.when(F.coalesce(channels, F.lit("")) == "", "EHZ").otherwise(channels)
    kind = F.upper(F.coalesce(model, F.lit("")))

    def layout(band: Column | str, parts: str) -> Column:
        band = F.lit(band) if isinstance(band, str) else band
        return F.struct(band.alias("band"), F.array(*map(F.lit, parts)).alias("components"))

    return (
        F.when(chans.isin("GP?", "DP?"), layout(F.substring(chans, 1, 2), "12Z"))
        .when(chans == "HH?", layout("HH", "ENZ"))
        .when(chans == "EH?", layout("EH", "ENZ"))
        .when((chans == "EHZ") | (kind == "RS1D") | (chans == "E??") | (kind == "RS4D"), layout("EH", "Z"))
        .when(chans.startswith("EH"), layout("EH", "ENZ"))
    )


def active_between(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Whether a station's days (ends included, null open) meet a span of days."""
    return F.coalesce(start <= last, F.lit(True)) & F.coalesce(end >= first, F.lit(True))


def active_on(start: Column, end: Column, day: Column) -> Column:
    return active_between(start, end, day, day)


TRIAGE = {"min_core": 2, "wide": 5, "inflated_mag": 2.2, "inflated_picks": 4, "unconstrained": 4}


def triage(magnitude: Column, n_picks: Column, n_stations: Column, n_core: Column, regional: Column, cfg: dict = TRIAGE) -> tuple[Column, Column]:
    """Label and joined reasons; ``regional`` is the reason text of a regional match or null."""
    few = (n_core < cfg["min_core"]) & (F.lit(cfg["wide"] <= 0) | (n_stations < cfg["wide"]))
    inflated = F.coalesce((magnitude >= cfg["inflated_mag"]) & (n_picks <= cfg["inflated_picks"]), F.lit(False))
    reject = few | inflated | regional.isNotNull()
    flag = ~reject & (n_picks <= cfg["unconstrained"])
    reasons = F.concat_ws(
        "; ",
        F.when(few, F.concat(n_core.cast("string"), F.lit(f" core station(s) < {cfg['min_core']}"))),
        F.when(inflated, F.concat(F.format_string("M%.1f from ", magnitude), n_picks.cast("string"), F.lit(" picks"))),
        regional,
        F.when(flag, F.concat(n_picks.cast("string"), F.lit(" picks (unconstrained)"))),
    )
    return F.when(reject, "auto_reject").when(flag, "flag").otherwise("ok"), reasons


def regional_reason(lag_s: Column, mag: Column, place: Column, distance_km: Column, id_: Column) -> Column:
    return F.format_string("%.0f s after regional M%.1f, %s (%.0f km, %s)", lag_s, mag, place, distance_km, id_)
