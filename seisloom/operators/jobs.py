"""Jobs that answer a network operator's question, composed of the operators."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, scalars
from . import aggregates as agg
from . import arrays, continuous, joins, location, windows
from .timejoin import stored


def apply_triage(
    catalog: DataFrame, assignments: DataFrame, core: list[str], regional: DataFrame | None = None, covered: DataFrame | None = None, enabled: bool = True
) -> DataFrame:
    """Every row labelled; review_status is left alone. Where triage is not ``enabled`` labels stay as they are, empty where there are none."""
    if not enabled:
        return catalog.withColumns({c: F.lit("") for c in ("triage", "triage_reason") if c not in catalog.columns})
    bare = catalog.drop("triage", "triage_reason")
    rows = agg.triage_features(bare, assignments, core)
    reason: Column = F.lit(None).cast("string")
    if regional is not None:
        rows = joins.asof_regional(rows, regional, covered)
        lag = (F.col("t_us") - F.col("regional_us")) / scalars.SECOND
        place = F.coalesce("regional_place", F.lit(""))
        reason = F.when(F.col("regional_id").isNotNull(), scalars.regional_reason(lag, F.col("regional_mag"), place, F.col("regional_km"), F.col("regional_id")))
    label, why = scalars.triage(F.col("magnitude"), F.col("n_picks"), F.col("n_stations"), F.col("n_core"), reason)
    return rows.withColumns({"triage": label, "triage_reason": why})


def spans_to_fetch(covered: tuple[int, int] | None, want_start_us: int, now_us: int, refresh_days: int = 7) -> list[tuple[int, int]]:
    """What of a regional catalog to ask for: what is not covered, and the last days of what is, since it is revised."""
    if covered is None:
        return [(want_start_us, now_us)]
    start, end = covered
    again = (max(min(end, now_us) - refresh_days * 86_400 * scalars.SECOND, want_start_us), now_us)
    return ([(want_start_us, start)] if want_start_us < start else []) + [again]


def merge_regional(
    cached: DataFrame, fetched: DataFrame, spans: list[tuple[int, int]], covered: tuple[int, int] | None
) -> tuple[DataFrame, tuple[int, int]]:
    """The cache with the answers for ``spans`` in place of what it had there, the last row of an id counting, and the span that it now covers."""
    span_rows = cached.sparkSession.createDataFrame(spans, "start_us long, end_us long")
    ends = [*spans, *([covered] if covered else [])]
    return windows.refresh_rows(cached, fetched, span_rows), (min(a for a, _ in ends), max(b for _, b in spans))


def select_additions(secondary: DataFrame, secondary_picks: DataFrame, primary: DataFrame, primary_picks: DataFrame, separation: float = 10.0, tolerance: float = 1.0, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Second-detector events far enough from every primary origin with enough corroborated picks, and their picks."""
    n = agg.corroboration_counts(secondary_picks, primary_picks, tolerance)
    kept = joins.separated(secondary, primary, separation).join(n, "event_id").where(F.col("corroborating_picks") >= least)
    return kept, joins.picks_of(secondary_picks, kept)


def dedup_catalog(catalog: DataFrame, assignments: DataFrame, seconds: float = 2.0, km: float = 5.0, include_mixed: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Duplicates in time and place folded into their keeper: the catalog, the picks, and an audit row for each event other than
    its group's keeper. Groups of ids of several detectors are only reported (``merged`` false) unless ``include_mixed``."""
    groups = joins.dup_groups(catalog, seconds, km)
    kinds = groups.groupBy("root").agg(F.countDistinct(F.substring("event_id", 1, 2)).alias("kinds_"))
    merged = F.lit(True) if include_mixed else F.col("kinds_") == 1
    kept = windows.keepers(catalog.join(groups, "event_id")).select("event_id", "keeper", "root").join(kinds, "root").select("event_id", "keeper", merged.alias("merged")).checkpoint()
    audit = kept.where("event_id <> keeper")
    return catalog.join(audit.where("merged"), "event_id", "left_anti"), windows.fold_picks(assignments, kept.where("merged")), audit


def _clusters(detections: DataFrame, least: float, templates: int, single: float, width_s: float) -> tuple[DataFrame, DataFrame]:
    """Strong detections, and their anchored clusters that two templates or one very strong detection carry."""
    strong = detections.withColumn("per_chan", scalars.per_channel(F.col("correlation"), F.col("n_chans"))).where(F.col("per_chan") >= least)
    c = windows.anchored_clusters(strong.select("det_id", "t_us", "template_id", "per_chan"), "t_us", int(width_s * scalars.SECOND))
    out = c.groupBy("anchor").agg(
        F.countDistinct("template_id").alias("n_templates"), F.max("per_chan").alias("best_per_chan"),
        F.max_by("template_id", F.struct(F.col("per_chan"), -F.col("t_us"), -F.col("det_id"))).alias("best_template"),
    ).withColumnRenamed("anchor", "t_us")
    return strong, out.where((F.col("n_templates") >= templates) | (F.col("best_per_chan") >= single))


def filter_candidates(detections: DataFrame, catalog: DataFrame, least: float = 0.5, templates: int = 2, single: float = 0.65, width_s: float = 5.0, exclude_s: float = 15.0) -> DataFrame:
    """Strong detections in anchored clusters: two templates or one very strong, none near a confirmed event."""
    out = _clusters(detections, least, templates, single, width_s)[1]
    return joins.exclude_known(out, catalog, exclude_s).withColumn("hr_utc", scalars.utc_hour(F.col("t_us")))


def candidate_funnel(detections: DataFrame, catalog: DataFrame, least: float = 0.5, templates: int = 2, single: float = 0.65, width_s: float = 5.0, exclude_s: float = 15.0) -> DataFrame:
    """``(step, n, parameters)`` of every step from detections to candidates."""
    strong, clusters = _clusters(detections, least, templates, single, width_s)
    clusters = clusters.checkpoint()
    steps = {"raw": detections, "strong": strong, "clustered": clusters, "kept": joins.exclude_known(clusters, catalog, exclude_s)}
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("step"), "n") for name, df in steps.items()]
    limits = {"least": least, "templates": templates, "single": single, "width_s": width_s, "exclude_s": exclude_s}
    parameters = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))])
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3]).withColumn("parameters", parameters)


def promote(candidates: DataFrame, catalog: DataFrame, seconds: float = 5.0) -> DataFrame:
    """Candidates not close to a catalog event as unreviewed ``tm`` events, placed by their best template's event."""
    free = joins.blocking_event(candidates.withColumn("key_", F.col("t_us")), catalog, "key_", seconds).where("blocked_by is null")
    named = windows.mint_ids(free.withColumn("time", F.timestamp_micros("t_us")), "tm", ["t_us"], catalog.select("event_id"))
    place = catalog.select(F.col("event_id").alias("best_template"), "latitude", "longitude", "depth_km")
    return named.join(place, "best_template", "left").drop("key_", "blocked_by")


class MergedCatalog(NamedTuple):
    catalog: DataFrame
    assignments: DataFrame
    warnings: DataFrame
    ledger: DataFrame


def merge_catalog(
    catalog: DataFrame, assignments: DataFrame, new_events: DataFrame, new_assignments: DataFrame, ledger: DataFrame, core: list[str],
    previous: DataFrame | None = None, snapshot: tuple[DataFrame, DataFrame] | None = None,
    regional: DataFrame | None = None, covered: DataFrame | None = None, triage: bool = True,
) -> MergedCatalog:
    """The days of ``new_events(source, day, event_index, time, t_us, ...)`` that the ledger does not have, added to the catalog.

    New events get ids of their source's prefix and hand them to their assignments ``(source, day, event_index, ...)``.
    On a rebuild the catalog is empty: ids of ``previous(event_id, t_us)`` are carried over, and the reviewed events
    and picks of a ``snapshot`` are laid over the result. New ids are none that catalog, ``previous`` or ``snapshot`` has, so that
    no id names two events; one that does, given or made, is an error. Then near duplicates are told, every row is labelled, and the
    ledger has the days. Catalog and assignments are in time order.
    """
    fresh = joins.new_days(new_events, ledger).checkpoint()
    taken = catalog.select("event_id")
    for more in (previous, snapshot and snapshot[0]):
        taken = taken.unionAll(more.select("event_id")) if more is not None else taken
    minted = windows.mint_ids(fresh, F.col("source"), ["t_us", "event_index"], taken).checkpoint()
    picks = joins.attach_event_id(joins.new_days(new_assignments, ledger), minted).where("event_id is not null")
    if previous is not None:
        kept = joins.carry_over_ids(minted, previous).select(F.col("event_id").alias("old"), F.col("old_id").alias("new")).checkpoint()
        minted, picks = (joins.fold_ids(df, kept, "event_id").drop("renamed") for df in (minted, picks))
        minted = windows.unique_ids(minted.checkpoint(), "the events with carried ids")
    place = ["source", "day", "event_index"]
    events = catalog.unionByName(minted.drop(*place), allowMissingColumns=True)
    every = assignments.unionByName(picks.drop(*place), allowMissingColumns=True)
    if snapshot is not None:
        events, every = joins.restore_reviewed(events, every, *snapshot)
    events, every = windows.unique_ids(events.checkpoint(), "the merged catalog"), stored(every)
    labelled = apply_triage(events, every, core, regional, covered, triage)
    days = ledger.select("source", "day").unionAll(fresh.select("source", "day")).distinct()
    return MergedCatalog(labelled.orderBy("t_us", "event_id"), every.orderBy("t_us", "event_id"), joins.near_duplicates(events, events).where("event_id < other_id"), days)


def publish_merge(merged: MergedCatalog, root: str) -> None:
    """Catalog, then assignments, then the ledger: a crash between them has days read again rather than lost."""
    from ..sources import sinks

    sinks.publish(merged.catalog, root, "catalog")
    sinks.publish(merged.assignments, root, "assignments")
    sinks.publish(merged.ledger, root, "ledger")


def coverage_report(stations: DataFrame, got: DataFrame, tracker: DataFrame, least: float = 0.99) -> DataFrame:
    """Chunk grid with coverage and whether to ask again. ``got(station, chunk, channel, n)``,
    ``tracker(station, chunk, status, coverage, in_window)``, ``stations(station, channel, want, chunk)`` expected."""
    cover = agg.chunk_coverage(got, stations, ["station", "chunk"])
    known = tracker.select("station", "chunk", F.col("status").alias("old_status"), F.col("coverage").alias("old_coverage"), "in_window")
    rows = cover.join(known, ["station", "chunk"], "left")
    need = scalars.needs_fetch(F.col("old_status"), F.col("old_coverage"), F.coalesce("in_window", F.lit(True)), F.lit(False), least)
    return rows.withColumns({"needed": need, "improved": scalars.improved(F.col("old_status"), F.col("old_coverage"), F.col("coverage")), "short": F.col("coverage") < least})


def precluster(picks: DataFrame, eps_s: float = 60.0, least: int = 3) -> DataFrame:
    """Picks of the network's day in sessions of gaps of ``eps_s`` at most, those of too few picks dropped."""
    s = windows.sessions(picks, ["day"], "t_us", int(eps_s * scalars.SECOND))
    n = s.groupBy("day", "session").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return s.join(n, ["day", "session"])


def apply_reviews(catalog: DataFrame, decisions: DataFrame) -> DataFrame:
    """The latest decision of each event laid over its row."""
    last = windows.latest(decisions, ["event_id"], ["timestamp"])
    new = last.select("event_id", F.col("review_status").alias("s_"), F.col("event_type").alias("t_"))
    return catalog.join(new, "event_id", "left").withColumns({"review_status": F.coalesce("s_", "review_status"), "event_type": F.coalesce("t_", "event_type")}).drop("s_", "t_")


class Review(NamedTuple):
    catalog: DataFrame
    assignments: DataFrame
    records: DataFrame
    warnings: DataFrame


#: What a saved review may change beside status and type.
REVISED = ("t_us", "latitude", "longitude", "depth_km", "sigma_time", "magnitude", "magnitude_type", "ml_err", "num_picks", "num_ml_sta")


def save_reviews(catalog: DataFrame, assignments: DataFrame, decisions: DataFrame, picks: DataFrame, source: str = "review") -> Review:
    """The latest of ``decisions(event_id, timestamp, review_status, event_type, saved, ...)`` of each event: its row takes what the
    decision has of ``REVISED``; where it is ``saved``, the event's picks give way to those of ``picks(event_id, timestamp, ...)`` with the
    same time stamp. Decided events come as records with their picks, and with the other events near them as warnings."""
    last = windows.latest(decisions, ["event_id"], ["timestamp"]).join(catalog.select("event_id"), "event_id", "left_semi").checkpoint()
    fields = [c for c in REVISED if c in last.columns and c in catalog.columns]
    new = last.select("event_id", *[F.col(c).alias(f"{c}_new_") for c in ("review_status", "event_type", *fields)])
    rows = catalog.join(new, "event_id", "left").withColumns({c: F.coalesce(f"{c}_new_", c) for c in ("review_status", "event_type", *fields)})
    rows = rows.select(*catalog.columns).checkpoint()
    saved = last.where("saved").select("event_id", "timestamp")
    theirs = picks.join(saved, ["event_id", "timestamp"], "left_semi").select(*[c for c in assignments.columns if c in picks.columns])
    every = stored(assignments.join(saved, "event_id", "left_anti").unionByName(theirs, allowMissingColumns=True))
    decided = rows.join(last.select("event_id"), "event_id", "left_semi")
    from ..sources import sinks

    mine = joins.picks_of(every, decided).withColumn("time", F.timestamp_micros("t_us"))
    return Review(rows, every, sinks.review_records(decided, mine, source), joins.near_duplicates(decided, rows))


def retry_plan(partial: DataFrame, summary: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """Partial days young enough whose last fetch stored more."""
    rows = partial.where(F.datediff(today, "day") <= days)
    return rows.join(summary.where("improved > 0").select("day"), "day", "left_semi")


def condition(segments: DataFrame, epochs: DataFrame, sensitivity: DataFrame, limit: float = arrays.LIMIT, share: float = 0.05, least: int = 10) -> DataFrame:
    """Segments ``(key, day, start_us, rate, samples)`` in velocity: impossible samples masked, gaps of a day bridged, short ones dropped, trend
    removed, ends tapered, trimmed to metadata epochs, divided by ``sensitivity(key, sensitivity)``."""
    clean = arrays.merge_segments(arrays.mask_impossible(segments, limit), ["key", "day"], bridge=True)

    def flat(x: np.ndarray, rate: float) -> np.ndarray:
        i = np.arange(len(x))
        x = x - np.polyval(np.polyfit(i, x, 1), i) if len(x) > 1 else x - x
        n = int(len(x) * share)
        ramp = 0.5 - 0.5 * np.cos(np.pi * np.arange(n) / max(n, 1))
        x[:n] *= ramp
        x[len(x) - n :] *= ramp[::-1]
        return x

    flat_rows = arrays.grouped_signal(arrays.drop_short(clean, least), ["key"], flat)
    out = arrays.to_velocity(joins.trim_to_epoch(flat_rows, epochs, least), sensitivity, "key")
    return out.withColumn("samples", F.col("samples").cast("array<float>"))


def detect(
    segments: DataFrame, chunks: DataFrame, keys: list[str], predict_fn, phases: list[str], rate: float = 100.0, pad_s: float = 40.0, size: int = 3000, step: int = 2000,
    threshold: float = 0.3, least_s: float = 1.0, batch: int = 64,
) -> DataFrame:
    """Picks ``(keys, phase, t_us, probability)`` of any model over ``segments(keys, start_us, rate, samples)``, chunk by chunk of ``chunks(start_us, end_us)``.

    Chunks are cut with context, their overlapping windows scored where they are (``predict_fn()`` makes the function of a batch of windows,
    once for each Python worker; its result has the samples of each phase one after another), scores of a sample averaged, and the
    maxima inside the chunk itself are picks; of those of a phase at most ``least_s`` apart, across the seams of chunks too, the most probable stays."""
    padded = continuous.padded_chunks(segments, chunks, keys, rate, int(pad_s * scalars.SECOND))
    place = [*keys, "start_us", "end_us", "first_us"]
    cut = arrays.cut_windows(padded.select(*place, "samples"), size, step)
    traces = arrays.overlap_scores(arrays.score_windows(cut, predict_fn, "window", batch, size), place, phases).withColumnRenamed("class", "phase")
    traces = traces.withColumns({"lo_": F.col("start_us"), "hi_": F.col("end_us"), "start_us": F.col("first_us"), "rate": F.lit(float(rate))})
    picks = arrays.peaks_of(traces, [*keys, "phase", "lo_", "hi_"], threshold).where((F.col("t_us") >= F.col("lo_")) & (F.col("t_us") < F.col("hi_")))
    return windows.thin_peaks(picks.drop("lo_", "hi_"), [*keys, "phase"], "t_us", "probability", int(least_s * scalars.SECOND))


def import_segments(raw: DataFrame, keys: list[str], target: float | None = None) -> DataFrame:
    """Campaign segments ``(keys, file, start_us, rate, samples)`` as day segments: windows that an earlier file brought are
    skipped, near-nominal rates snapped, decimated to ``target`` Hz, cut at midnight, merged by channel and day."""
    rows = raw.withColumn("rate", scalars.snap_rate(F.col("rate")))
    rows = rows.withColumn("end_us", F.col("start_us") + F.round((F.size("samples") - 1) * 1e6 / F.col("rate")).cast("long"))
    rows = windows.skip_dup_windows(rows, keys, "file").select(*keys, "start_us", "rate", "samples")
    if target:
        rows = arrays.decimate(rows, keys, target)
    days = arrays.split_by_day(rows).withColumn("day", F.to_date(F.timestamp_micros("start_us")))
    return arrays.merge_segments(days, [*keys, "day"])


def format_events(located: DataFrame, assignments: DataFrame, stations: DataFrame) -> DataFrame:
    """``located(event_id, t_us, x, y, z, sigma_time)`` as catalog rows: coordinates, magnitude and counts, rounded as stored."""
    lat, lon = geo.stere_inverse(F.col("x"), F.col("y"))
    rows = located.withColumns({"latitude": lat, "longitude": lon, "depth_km": F.col("z")})
    ml = agg.network_ml(assignments, rows, stations)
    n = assignments.groupBy("event_id").agg(F.count("*").alias("num_picks"))
    rows = rows.join(ml, "event_id", "left").join(n, "event_id", "left")
    return rows.select(
        "event_id", "t_us", F.timestamp_micros("t_us").alias("time"), F.round("ml", 2).alias("magnitude"), F.when(F.col("ml").isNotNull(), "ML").alias("magnitude_type"),
        F.round("ml_err", 2).alias("ml_err"), F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), F.round("depth_km", 2).alias("depth_km"),
        F.round("sigma_time", 4).alias("sigma_time"), F.coalesce("num_picks", F.lit(0)).alias("num_picks"), F.coalesce("num_ml_sta", F.lit(0)).alias("num_ml_sta"),
    )


#: Standard deviation of a pick's time in s.
SIGMA_P, SIGMA_S = 0.10, 0.20


def relocate(picks: DataFrame, stations: DataFrame, tt: DataFrame, depth_step: float, distance_step: float, least: int = 4, **grid) -> tuple[DataFrame, DataFrame]:
    """Events of ``picks(event_id, network, station, phase, t_us, amplitude)`` located again, as catalog rows with depth sigma and
    ellipse, and a residual for each pick. Events of fewer than ``least`` picks at known stations are left out."""
    rows = joins.with_station(picks, stations)
    sx, sy = geo.stere_forward(F.col("latitude"), F.col("longitude"))
    event = Window.partitionBy("event_id")
    rows = rows.where("event_id is not null").withColumns({"first_us": F.min("t_us").over(event), "n_": F.count("*").over(event)}).where(F.col("n_") >= least).select(
        "event_id", "network", "station", "phase", "t_us", "amplitude", "first_us", sx.alias("sx"), sy.alias("sy"),
        ((F.col("t_us") - F.col("first_us")) / scalars.SECOND).alias("t_s"), F.when(F.col("phase") == "S", SIGMA_S).otherwise(SIGMA_P).alias("sigma"),
    )
    rows = stored(rows)
    first = rows.groupBy("event_id").agg(F.min("first_us").alias("first_us"))
    # a checkpoint would search twice: once to count, once to write
    best = stored(location.locate(rows.select("event_id", "phase", "sx", "sy", "t_s", "sigma"), tt, depth_step, distance_step, spread=True, **grid))
    left = location.residuals(rows, best, tt, depth_step, distance_step).select("event_id", "station", "phase", (F.col("t_s") - F.col("t0")).alias("observed_s"), "residual_s")
    rms = left.groupBy("event_id").agg(F.sqrt(F.avg(F.col("residual_s") * F.col("residual_s"))).alias("sigma_time"))
    origin = F.col("first_us") + F.round(F.col("t0") * scalars.SECOND).cast("long")
    located = best.join(first, "event_id").join(rms, "event_id").select("event_id", origin.alias("t_us"), "x", "y", "z", "sigma_time")
    return format_events(located, rows, stations).join(best.select("event_id", "sigma_z", "h_major", "h_minor", "h_azimuth"), "event_id", "left"), left


def plan_event_ids(catalog: DataFrame, repeats: bool = False) -> DataFrame:
    """``(old, new)`` for every positional id, in time order; ids that occur twice are an error, or with ``repeats`` get a row and a new id for each event."""
    if not repeats:
        windows.unique_ids(catalog, "the catalog")
    legacy = scalars.is_legacy_id(F.col("event_id"))
    old = catalog.where(legacy).select(F.col("event_id").alias("old"), "time")
    return windows.mint_ids(old, F.substring("old", 1, 2), ["time", "old"], catalog.where(~legacy).select("event_id")).select("old", F.col("event_id").alias("new"))


def build_quarries(mines: DataFrame, osm: DataFrame, degrees: float = 0.005) -> DataFrame:
    """Registered mines, and map features that no mine is beside."""
    return mines.unionByName(joins.geo_dedup(mines, osm, degrees))


def catalog_feed(**sources: DataFrame) -> DataFrame:
    """The events of several detectors as one feed, each with its ``source``; columns that one lacks are null."""
    out = None
    for name, events in sources.items():
        part = events.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def event_detail(wanted: DataFrame, catalog: DataFrame, assignments: DataFrame, aliases: DataFrame) -> DataFrame:
    """Each of ``wanted(event_id)``, old ids resolved, with its picks, counts by station and phase, and old id."""
    ids = joins.resolve_ids(wanted, aliases).select(F.col("event_id").alias("event_id")).distinct()
    events = catalog.join(ids, "event_id", "left_semi")
    mine = assignments.join(ids, "event_id", "left_semi")
    picks = mine.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("t_us", "network", "station", "phase", "probability", "amplitude"))).alias("picks"))
    # counted in the event's own list, so that assignments are made and shuffled once
    n = lambda s, phase: F.size(F.filter("picks", lambda x: x["station"].eqNullSafe(s) & (x["phase"] == phase))).cast("long")
    each = F.transform(F.array_distinct(F.transform("picks", lambda x: x["station"])), lambda s: F.struct(s.alias("station"), n(s, "P").alias("p"), n(s, "S").alias("s")))
    picks = picks.withColumn("contributions", F.array_sort(each))
    legacy = aliases.groupBy(F.col("event_id")).agg(F.min("legacy_id").alias("legacy_id"))
    return events.join(picks, "event_id", "left").join(legacy, "event_id", "left")
