"""Jobs, readers and writers on small cases and against plain numpy."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisloom.operators import arrays, jobs, joins, location, windows
from seisloom.sources import readers, sinks

S = 1_000_000
DAY = 86_400 * S
SEG = "key string, start_us long, rate double, samples array<double>"


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + str(tmp_path / "checkpoints"))


def test_sliding_normalise(spark):
    draw = np.random.default_rng(3)
    n, window = 97, 20
    x = np.cumsum(draw.normal(size=(n, 2)), 0)
    rows = [("a", str(c), i, float(x[i, c])) for c in range(2) for i in range(n)] + [("b", "0", i, float(i)) for i in range(5)]
    out = windows.sliding_normalise(spark.createDataFrame(rows, "key string, ch string, idx long, v double"), "key", "ch", "idx", "v", window)
    half = window // 2
    knots = np.append(np.arange(0, n, half), n)
    padded = np.pad(x, ((half, half), (0, 0)), mode="reflect")
    parts = [padded[k : k + window] for k in knots[1:-1]]
    mean, std = (np.array([f(p, axis=0) for p in [parts[0], *parts, parts[-1]]]) for f in (np.mean, np.std))
    want = {("a", str(c), i): (x[i, c] - np.interp(i, knots, mean[:, c])) / np.interp(i, knots, std[:, c]) * 1.5 for c in range(2) for i in range(n)}
    want |= {("b", "0", i): float(i) for i in range(5)}
    got = {(r.key, r.ch, r.idx): r.normalised for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_duplicate_windows(spark):
    rows = [("a", 1, 0, 60 * S), ("a", 2, 0, 60 * S), ("a", 3, 900_000, 60 * S), ("a", 4, 1_800_000, 60 * S), ("a", 5, 900_000, 61 * S), ("b", 1, 0, 60 * S), (None, 1, 0, S)]
    df = spark.createDataFrame(rows, "key string, file long, start_us long, end_us long")
    out = windows.skip_dup_windows(df, ["key"], "file")
    assert sorted((r.key, r.file) for r in out.collect()) == [("a", 1), ("a", 4), ("a", 5), ("b", 1)]
    assert windows.skip_dup_windows(df.where("false"), ["key"], "file").isEmpty()


def test_thin_peaks_is_the_greedy_pass(spark):
    draw = np.random.default_rng(5)
    rows = [(str(k), int(t), float(h)) for k in range(5) for t, h in zip(np.sort(draw.choice(300, 60, replace=False)), draw.integers(1, 9, 60), strict=True)]
    out = windows.thin_peaks(spark.createDataFrame(rows, "key string, at long, h double"), ["key"], "at", "h", 3)
    want = set()
    for k in {r[0] for r in rows}:
        kept = []
        for _, t, h in sorted((r for r in rows if r[0] == k), key=lambda r: (-r[2], r[1])):
            if all(abs(t - x) > 3 for x in kept):
                kept.append(t)
        want |= {(k, t) for t in kept}
    assert {(r.key, r["at"]) for r in out.collect()} == want


def test_seams(spark):
    picks = spark.createDataFrame([("A", "P", 0, 0.5), ("A", "P", S // 2, 0.9), ("B", "P", 0, 0.4)], "station string, phase string, t_us long, probability double")
    assert [(r.station, r.probability) for r in windows.dedup_seams(picks).collect()] == [("B", 0.4), ("A", 0.9)]


def test_pick_windows(spark):
    segments = spark.createDataFrame([("k", 0, 10.0, [1.0, 2.0, 3.0]), ("k", 300_000, 10.0, [4.0, 5.0])], SEG)
    picks = spark.createDataFrame([(1, "k", 200_000), (2, "k", 0), (3, "k", 9 * S)], "pick_id long, key string, t_us long")
    out = {r.pick_id: (list(r.samples), r.full) for r in windows.pick_windows(picks, segments, ["key"], 100_000, 300_000, S).collect()}
    assert out == {1: ([2.0, 3.0, 4.0, 5.0], True), 2: ([0.0, 1.0, 2.0, 3.0], False)}


def test_merge_and_import(spark):
    segments = spark.createDataFrame([("k", 0, 1.0, [1.0, 2.0, 3.0]), ("k", 2 * S, 1.0, [9.0, 9.0]), ("k", 6 * S, 1.0, [5.0])], SEG)
    split = sorted((r.start_us, list(r.samples)) for r in arrays.merge_segments(segments, ["key"]).collect())
    assert split == [(0, [1.0, 2.0, 9.0, 9.0]), (6 * S, [5.0])]
    assert [list(r.samples) for r in arrays.merge_segments(segments, ["key"], bridge=True).collect()] == [[1.0, 2.0, 9.0, 9.0, 9.0 - 4 / 3, 9.0 - 8 / 3, 5.0]]
    rows = [("k", f, DAY - 5 * S, 1.001, [float(i) for i in range(10)]) for f in ("x", "y")] + [("k", "x", DAY + 5 * S, 1.0, [10.0, 11.0])]
    out = jobs.import_segments(spark.createDataFrame(rows, "key string, file string, start_us long, rate double, samples array<double>"), ["key"])
    got = sorted((str(r.day), r.start_us, list(r.samples)) for r in out.collect())
    assert got == [("1970-01-01", DAY - 5 * S, [0.0, 1.0, 2.0, 3.0, 4.0]), ("1970-01-02", DAY, [5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0])]


def test_condition(spark):
    x = [float(i) for i in range(100)]
    x[40] = 1e9
    seg = spark.createDataFrame([("k", 0, 10.0, x)], SEG).withColumn("day", F.lit("1970-01-01"))
    epochs = spark.createDataFrame([("k", 1 * S, None)], "key string, epoch_us long, end_us long")
    out = jobs.condition(seg, epochs, spark.createDataFrame([("k", 2.0)], "key string, sensitivity double")).collect()
    assert len(out) == 1 and out[0].start_us == S and len(out[0].samples) == 90 and max(abs(v) for v in out[0].samples) < 1e-4


def test_relocate(spark):
    """Six stations about a known source: found within a km, with small residuals; an event of three picks is left out."""
    from seisloom.functions import geo

    depths = spark.range(0, 21, 2).select(F.col("id").cast("double").alias("depth_km"))
    tt = location.build_tt(depths, spark.range(0, 101, 2).select(F.col("id").cast("double").alias("distance_km"))).checkpoint()
    places = [("A", 31.95, -106.55), ("B", 31.95, -106.25), ("C", 31.75, -106.55), ("D", 31.75, -106.25), ("E", 31.86, -106.60), ("F", 31.70, -106.40)]
    stations = spark.createDataFrame([("N", s, a, b, 0.0) for s, a, b in places], "network string, station string, latitude double, longitude double, elevation_m double")
    x, y = geo.stere_forward(F.col("latitude"), F.col("longitude"))
    x0, y0 = geo.stere_forward(F.lit(31.86), F.lit(-106.38))
    d = F.hypot(x - x0, y - y0)
    rows = stations.select("network", "station", d.alias("distance_km"), F.lit(6.0).alias("depth_km"), F.explode(F.array(F.lit("P"), F.lit("S"))).alias("phase"))
    rows = location.tt_lookup(rows, tt, 2, 2)
    picks = rows.select(F.lit("e").alias("event_id"), "network", "station", "phase", F.round((F.col("t") + 100) * S).cast("long").alias("t_us"), F.lit(1e-6).alias("amplitude")).checkpoint()
    picks = picks.unionAll(picks.where("phase = 'P' and station < 'D'").withColumn("event_id", F.lit("few")))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    out, left = jobs.relocate(picks.mapInPandas(counted, picks.schema), stations, tt, 2, 2)
    assert read.value == 15  # the picks are made once
    row = out.collect()
    assert [r.event_id for r in row] == ["e"]
    r = row[0]
    assert abs(r.latitude - 31.86) < 0.01 and abs(r.longitude + 106.38) < 0.01 and abs(r.depth_km - 6) <= 1 and abs(r.t_us - 100 * S) < 0.1 * S
    assert r.num_picks == 12 and r.num_ml_sta > 0 and r.magnitude is not None
    assert max(abs(x.residual_s) for x in left.collect()) < 0.1


def test_plan_ids(spark):
    rows = [("ep20260101-0002", "2026-01-01 00:00:00"), ("ep20260101-0001", "2026-01-01 00:00:00.5"), ("po20260101-0001", "2026-01-01 00:00:00"), ("ep20260101T000000", "2026-01-01 00:00:00")]
    c = spark.createDataFrame(rows, "event_id string, time string").withColumn("time", F.col("time").cast("timestamp"))
    assert {r.old: r.new for r in jobs.plan_event_ids(c).collect()} == {
        "ep20260101-0002": "ep20260101T000000-2", "ep20260101-0001": "ep20260101T000000-3", "po20260101-0001": "po20260101T000000"}
    with pytest.raises(ValueError):
        jobs.plan_event_ids(c.unionAll(c))


def test_near_duplicates(spark):
    c = spark.createDataFrame([("a", 0, 31.8, -106.4), ("b", 2 * S, 31.84, -106.4), ("c", 2 * S + 1, 31.8, -106.4), ("d", 0, 31.85, -106.4)], "event_id string, t_us long, latitude double, longitude double")
    assert [r.other_id for r in joins.near_duplicates(c.where("event_id = 'a'"), c).collect()] == ["b"]


def test_quarries(spark, tmp_path):
    head = "MINE_ID|CURRENT_MINE_NAME|COAL_METAL_IND|CURRENT_MINE_TYPE|CURRENT_MINE_STATUS|CURRENT_OPERATOR_NAME|STATE|FIPS_CNTY_NM|PRIMARY_CANVASS|LATITUDE|LONGITUDE"
    lines = ["1|Cañon|M|Surface|Active|Op|TX|El Paso|Stone|31.8|-106.4", "2|X|C|Surface|Active|||||31.8|-106.4", "3|X|M|Surface|Abandoned|||||31.8|-106.4", "4|X|M|Surface|Active|||||bad|-106.4", "5|X|M|Surface|Active|||||40|-106.4"]
    (tmp_path / "Mines.txt").write_text("\n".join([head, *lines]), encoding="latin-1")
    mines = readers.read_mines(spark, str(tmp_path / "Mines.txt"))
    assert [(r.mine_id, r.name, r.commodity) for r in mines.collect()] == [("1", "Cañon", "Stone")]
    near, far = {"type": "node", "id": 7, "lat": 31.8049, "lon": -106.4049, "tags": {}}, {"type": "way", "id": 8, "center": {"lat": 31.7, "lon": -106.4}, "tags": {"resource": "GRAVEL", "name": "Pit"}}
    more = [{"type": "way", "id": 9, "tags": {}}, {"type": "node", "id": 10, "lat": 32.0, "lon": -106.0, "tags": {"landuse": "quarry"}}, {"type": "node", "id": 11, "lat": 32.1, "lon": -106.0, "tags": {"mineral": "coPPer"}}]
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [near, far, *more]}))
    osm = readers.read_osm(spark, str(tmp_path / "osm.json"))
    assert {(r.mine_id, r.commodity, r.state) for r in osm.collect()} == {("osmn7", "Unknown", ""), ("osmw8", "SandAndGravel", "Chihuahua"), ("osmn10", "Stone", ""), ("osmn11", "Copper", "")}
    assert sorted(r.mine_id for r in jobs.build_quarries(mines, osm).collect()) == ["1", "osmn10", "osmn11", "osmw8"]
    features = [json.loads(r.feature) for r in sinks.to_geojson(mines, "longitude", "latitude").collect()]
    assert features[0]["geometry"]["coordinates"] == [-106.4, 31.8] and features[0]["properties"]["source"] == "MSHA"


def test_campaign_stations(spark, tmp_path):
    (tmp_path / "s.csv").write_text('station,lat,lon,elv(m),unit,componet,response\nXX.N01.00.DP,31.5,-106.1,1200,m/s,"Z, N,E","80,90,85,70"\n')
    r = readers.read_campaign_stations(spark, str(tmp_path / "s.csv")).collect()[0]
    assert (r.network, r.station, r.location, r.band, r.components, r.sensitivity, r.elevation_m) == ("XX", "N01", "00", "DP", ["Z", "N", "E"], 82.5, 1200.0)


def test_readers(spark, tmp_path):
    root = tmp_path / "picks" / "2026" / "160"
    root.mkdir(parents=True)
    head = "network,station,location,channel,phase,time,probability,model,amplitude,amplitude_channel\n"
    (root / "2026.160.picks.csv").write_text(head + "AM,R0F2D,,EHZ,P,2026-06-09T00:00:01,0.9,m,1e-7,EHZ\n")
    picks = readers.read_picks(spark, str(tmp_path / "picks"), "2026-06-09", "2026-06-09").collect()
    assert [(p.station, p.location, str(p.day)) for p in picks] == [("R0F2D", "", "2026-06-09")]
    assert readers.read_picks(spark, str(tmp_path / "picks"), "2026-06-10").isEmpty()
    (tmp_path / "catalog.csv").write_text("event_id,time,magnitude,num_picks,event_type\nep1,2026-06-08T00:00:00Z,,5.0,\n")
    c = readers.read_catalog(spark, str(tmp_path / "catalog.csv")).collect()[0]
    assert (c.magnitude, c.num_picks, c.event_type) == (None, 5, "undetermined")
    (tmp_path / "reviews.jsonl").write_text('{"timestamp":"2026-06-08T00:00:00Z","source":"s","event_id":"e","event":{"event_id":"e"},"picks":[]}\n{broken\n')
    assert [r.event_id for r in readers.read_reviews(spark, str(tmp_path / "reviews.jsonl")).collect()] == ["e"]
    (tmp_path / "detect.log").write_text("2026-06-08 10:00:00 \x1b[31mERROR\x1b[0m it broke\n2026-06-08 10:00:01 INFO fine\n")
    assert [(r.step, r.level, r.message) for r in readers.read_log_issues(spark, str(tmp_path / "detect.log")).collect()] == [("detect", "ERROR", "it broke")]
    (tmp_path / "metrics.jsonl").write_text('{"timestamp":"2026-06-08T00:00:00Z","step":"detect","n":3}\n')
    assert [(r.step, r.fields) for r in readers.read_metrics(spark, str(tmp_path / "metrics.jsonl")).collect()] == [("detect", {"n": "3"})]
    (tmp_path / "status.json").write_text(json.dumps({"day_times": [{"day": "2026-06-08", "total": 5.0, "steps": {"a": 2.0, "b": 3.0}}]}))
    assert sorted((r.step, r.seconds) for r in readers.read_day_times(spark, str(tmp_path / "status.json")).collect()) == [("a", 2.0), ("b", 3.0)]
    (tmp_path / "raw" / "2026" / "159").mkdir(parents=True)
    (tmp_path / "raw" / "2026" / "159" / "AM.R0F2D.00.EHZ.2026.159.mseed").write_bytes(b"123")
    f = readers.read_archive_inventory(spark, str(tmp_path / "raw")).collect()[0]
    assert (f.stage, str(f.day), f.station, f.channel, f.length) == ("raw", "2026-06-08", "R0F2D", "EHZ", 3)
    xml = '<FDSNStationXML><Network code="AM"><Station code="R0F2D"><Channel code="EHZ" locationCode="00" startDate="2026-01-01T00:00:00"><SampleRate>100.0</SampleRate><Response><InstrumentSensitivity><Value>3.6e8</Value></InstrumentSensitivity></Response></Channel></Station></Network></FDSNStationXML>'
    (tmp_path / "inv.xml").write_text(xml)
    i = readers.read_inventory(spark, str(tmp_path / "inv.xml")).select("network", "station", "channel", "sample_rate", "sensitivity").collect()
    assert [tuple(r) for r in i] == [("AM", "R0F2D", "EHZ", 100.0, 3.6e8)]


def test_writers(spark, tmp_path):
    day = lambda d, n: spark.createDataFrame([(d, n)], "day string, n int").withColumn("day", F.col("day").cast("date"))
    path = str(tmp_path / "t")
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "day string").select(F.col("day").cast("date"))
    sinks.write_day(day("2026-06-08", 1), path, days("2026-06-08", "2026-06-09"))
    sinks.write_day(day("2026-06-10", 2), path, days("2026-06-10"))
    sinks.write_day(day("2026-06-08", 3), path, days("2026-06-08"))
    assert sorted((str(r.day), r.n) for r in spark.read.parquet(f"{path}/data").collect()) == [("2026-06-08", 3), ("2026-06-10", 2)]
    assert sinks.done_days(spark, path).count() == 3
    sinks.publish(day("2026-06-08", 1), str(tmp_path), "catalog")
    sinks.publish(day("2026-06-08", 2), str(tmp_path), "catalog")
    assert [r.n for r in sinks.published(spark, str(tmp_path), "catalog").collect()] == [2]


def test_public_export(spark):
    c = spark.createDataFrame([("a", 100 * S, 31.85, -106.4, 5.0, 1.234, "earthquake", 2, "confirmed"), ("b", 0, 31.85, -106.4, 5.0, None, "quarry_blast", 2, "rejected"), ("c", 900 * S, 31.85, -106.4, None, None, "quarry_blast", None, "confirmed")],
                              "event_id string, t_us long, latitude double, longitude double, depth_km double, magnitude double, event_type string, num_picks int, review_status string")
    asg = spark.createDataFrame([("a", "N", "FAR", "P", 103 * S, 1e-7), ("a", "N", "NEAR", "P", 101 * S, 1e-7), ("a", "N", "LOST", "P", 101 * S, 1e-7)], "event_id string, network string, station string, phase string, t_us long, amplitude double")
    st = spark.createDataFrame([("N", "FAR", 32.1, -106.4, 0.0), ("N", "NEAR", 31.86, -106.4, 0.0)], "network string, station string, latitude double, longitude double, elevation_m double")
    seg = spark.createDataFrame([("FAR", 98 * S, 1.0, [0.0, 1.0, -4.0, 2.0]), ("NEAR", 90 * S, 1.0, [9.0] * 8 + [1.0, -2.0])], "station string, start_us long, rate double, samples array<double>")
    out = sinks.export_public(c, asg, st, seg, bins=2)
    rows = out.collect()
    assert [r.event_id for r in rows] == ["c", "a"] and rows[0].picks is None
    a = rows[1]
    assert a.magnitude == 1.23 and [(p.station, p.t) for p in a.picks] == [("FAR", 3.0), ("NEAR", 1.0)]
    assert [t.station for t in a.traces] == ["NEAR", "FAR"] and [list(p) for p in a.traces[0].minmax] == [[0.5, 0.5], [-1.0, -1.0]]
    assert [list(p) for p in a.traces[1].minmax] == [[0.0, 0.25], [-1.0, 0.5]]
    s = sinks.public_summary(out, st).collect()[0]
    assert (s.n_events, s.n_quarry_blasts, s.n_earthquakes, s.n_stations) == (2, 1, 1, 2)


def test_grids(spark):
    seg = spark.createDataFrame([("k", 2 * S, 1.0, [1.0, 3.0, 7.0])], SEG).withColumn("samples", F.col("samples").cast("array<float>"))
    assert [(r.start_us, list(r.samples)) for r in arrays.align_span(seg, S, 4 * S).collect()] == [(S, [0.0, 1.0, 3.0])]
    assert [(r.rate, list(r.samples)) for r in arrays.resample_linear(seg, 2.0).collect()] == [(2.0, [1.0, 2.0, 3.0, 5.0, 7.0])]
    assert [list(r.samples) for r in arrays.sanitise(spark.createDataFrame([("k", 0, 1.0, [1.0, float("nan"), float("inf"), None])], SEG)).collect()] == [[1.0, 0.0, 0.0, 0.0]]


def test_extract_picks(spark):
    rows = spark.createDataFrame([("k", 0, 10.0, [0.0, 0.6, 0.2, 0.9, 0.9, 0.1, 0.0, 0.0, 0.7, 0.3])], "key string, start_us long, rate double, prob array<double>")
    out = arrays.extract_picks(rows, ["key"], 0.5, 300_000)
    assert sorted((r.t_us, r.probability) for r in out.collect()) == [(300_000, 0.9), (800_000, 0.7)]


def test_associate_runs_until_no_votes_qualify(spark):
    """Nine events 3 s apart at one node: one a round is found in a stretch of 30 s, and none is dropped."""
    tt = location.build_tt(spark.range(0, 21, 5).select(F.col("id").cast("double").alias("depth_km")), spark.range(0, 101, 5).select(F.col("id").cast("double").alias("distance_km"))).checkpoint()
    rows = [(f"{e}{s}{p}", s, p, x, y, 300.0 + 3 * e) for e in range(9) for s, x, y in (("A", 10.0, 0.0), ("B", 0.0, 10.0), ("C", -10.0, 0.0), ("D", 0.0, -10.0)) for p in "PS"]
    picks = spark.createDataFrame(rows, "pick_id string, station string, phase string, sx double, sy double, o double")
    picks = location.tt_lookup(picks.withColumns({"distance_km": F.lit(10.0), "depth_km": F.lit(5.0)}), tt, 5, 5).withColumn("t_s", F.col("o") + F.col("t")).drop("o", "t", "distance_km", "depth_km")
    nodes = spark.createDataFrame([(0.0, 0.0, 5.0)], "x double, y double, z double")
    out = location.associate(picks, nodes, tt, 5, 5).collect()
    assert len({r.event for r in out}) == 9 and len(out) == 72
    assert all(abs(r.t0 - 300 - 3 * int(r.pick_id[0])) < 0.01 for r in out)


def test_relocation_and_templates_are_registered_whole(spark, monkeypatch):
    """The production passes, and every id divisible by 50 as a template."""
    from seisloom.plans import registry

    calls = {}

    def relocate(*args, **grid):
        calls["grid"] = grid
        raise InterruptedError

    def match(segments, templates, *args):
        calls["templates"] = templates
        raise InterruptedError

    monkeypatch.setattr(jobs, "relocate", relocate)
    monkeypatch.setattr("seisloom.operators.arrays.match_templates", match)
    for name in ("job18_relocate", "job17_residuals", "arr17_match"):
        with pytest.raises(InterruptedError):
            registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert calls.get("grid") == {}
    ids = {r.vec_id for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id").collect()}
    assert {r.template_id for r in calls["templates"].collect()} == {f"t{i}" for i in ids if i % 50 == 0}


def test_mixed_groups_are_only_reported(spark):
    rows = [("ep1", 0, 31.8, -106.4, None, 5), ("ep2", S, 31.8, -106.4, None, 7), ("ep3", 100 * S, 31.8, -106.4, None, 5), ("tm3", 101 * S, 31.8, -106.4, "confirmed", 3), ("ep9", 900 * S, 31.8, -106.4, None, 1)]
    c = spark.createDataFrame(rows, "event_id string, t_us long, latitude double, longitude double, review_status string, num_picks int")
    a = spark.createDataFrame([(e, "AM", "S1", "P", i * S) for i, e in enumerate(("ep1", "ep2", "ep3", "tm3"))], "event_id string, network string, station string, phase string, t_us long")
    kept, picks, audit = jobs.dedup_catalog(c, a)
    assert sorted(r.event_id for r in kept.collect()) == ["ep2", "ep3", "ep9", "tm3"]
    assert sorted((r.event_id, r.keeper, r.merged) for r in audit.collect()) == [("ep1", "ep2", True), ("ep3", "tm3", False)]
    assert sorted((r.event_id, r.t_us) for r in picks.collect()) == [("ep2", S), ("ep3", 2 * S), ("tm3", 3 * S)]
    kept, _, audit = jobs.dedup_catalog(c, a, include_mixed=True)
    assert sorted(r.event_id for r in kept.collect()) == ["ep2", "ep9", "tm3"] and all(r.merged for r in audit.collect())


def test_blocked_recursion_is_the_recursion():
    draw = np.random.default_rng(1)
    for n in (0, 1, 5, 255, 256, 257, 1000):
        x = draw.normal(size=n)
        for hz, kind in ((0.5, "high"), (20.0, "low")):
            sections = arrays.butterworth(4, hz, 100.0, kind)
            want = x.tolist()
            for b0, b1, b2, a1, a2 in sections.tolist():
                z1 = z2 = 0.0
                for i, v in enumerate(want):
                    out = b0 * v + z1
                    z1, z2 = b1 * v - a1 * out + z2, b2 * v - a2 * out
                    want[i] = out
            for block in (3, 256):
                assert np.allclose(arrays.run_sections(sections, x, block), want, rtol=0, atol=1e-10)


def test_matched_filter_stacks_channels(spark):
    draw = np.random.default_rng(7)
    x = {(c, ch): draw.normal(size=n) for c, n in ((0, 400), (1, 300)) for ch in ("EHZ", "EHN")}
    t = {("t1", "EHZ"): (0, draw.normal(size=30)), ("t1", "EHN"): (12, draw.normal(size=30)), ("t2", "EHZ"): (-5, draw.normal(size=20)), ("t2", "XXX"): (0, draw.normal(size=20)), ("long", "EHZ"): (0, draw.normal(size=900))}
    x[0, "EHZ"][100:130] += 4 * t["t1", "EHZ"][1]
    x[0, "EHN"][112:142] += 4 * t["t1", "EHN"][1]
    segments = spark.createDataFrame([(c, ch, v.tolist()) for (c, ch), v in x.items()], "chunk int, channel string, samples array<double>")
    templates = spark.createDataFrame([(n, ch, o, v.tolist()) for (n, ch), (o, v) in t.items()], "template_id string, channel string, offset int, samples array<double>")
    stacks = {}
    for (name, ch), (offset, w) in t.items():
        for c in (0, 1):
            v = x.get((c, ch), np.zeros(0))
            for i in range(len(v) - len(w) + 1):
                part = v[i : i + len(w)]
                cc = ((part - part.mean()) * (w - w.mean())).mean() / part.std() / w.std()
                if i - offset >= 0:
                    s = stacks.setdefault((name, c), {}).setdefault(i - offset, [0.0, 0])
                    s[0] += cc
                    s[1] += 1
    mad = {k: float(np.median([abs(v) for v, _ in s.values()])) for k, s in stacks.items()}
    for kind, least in (("mad", 6.0), ("absolute", 0.7), ("mean_channel", 0.5)):
        want = {}
        for k, s in stacks.items():
            for i, (v, n) in s.items():
                if v >= (least * mad[k] if kind == "mad" else least if kind == "absolute" else least * n):
                    want[(*k, i)] = (round(v, 8), n)
        out = arrays.match_templates(segments, templates, least, kind).collect()
        assert {(r.template_id, r.chunk, r.idx): (round(r.cc, 8), r.n_chans) for r in out} == want and ("t1", 0, 100) in want
        assert all(abs(r.mad - mad[r.template_id, r.chunk]) < 1e-12 for r in out)


def test_merge_with_rebuild(spark):
    """An id is carried over, a reviewed event is laid over its row, two near events are told, days of the ledger are left out."""
    T = 1_780_000_000 * S
    day = "2026-05-28"
    events = [("ep", day, i, T + d * S, 31.8, -106.4, 1.0) for i, d in enumerate((0, 100, 101, 500))] + [("ep", "2026-05-01", 0, T - 9 * DAY, 31.8, -106.4, 1.0)]
    new = spark.createDataFrame(events, "source string, day string, event_index int, t_us long, latitude double, longitude double, magnitude double").withColumn("time", F.timestamp_micros("t_us"))
    picks = spark.createDataFrame([("ep", day, i, "AM", f"S0{s}", "P", T + s * S) for i in range(4) for s in range(3)], "source string, day string, event_index int, network string, station string, phase string, t_us long")
    nothing = new.drop("source", "day", "event_index").withColumns({"event_id": F.lit(""), "review_status": F.lit("")}).where("false")
    ledger = spark.createDataFrame([("ep", "2026-05-01")], "source string, day string")
    previous = spark.createDataFrame([("ep20260528-0001", T + 3 * S)], "event_id string, t_us long")
    base = new.where("event_index = 3").select(F.lit("ep20260528T203500").alias("x"), "t_us").first()
    named = jobs.windows.mint_ids(new.where(f"t_us = {base.t_us}"), "ep", ["t_us"]).first().event_id
    snapshot = nothing.unionByName(spark.createDataFrame([(named, base.t_us + S, 31.9, -106.4, 2.0, "confirmed")], "event_id string, t_us long, latitude double, longitude double, magnitude double, review_status string"), allowMissingColumns=True)
    theirs = spark.createDataFrame([(named, "AM", "S05", "S", base.t_us)], "event_id string, network string, station string, phase string, t_us long")
    none = theirs.where("false")
    merged = jobs.merge_catalog(nothing, none, new, picks, ledger, ["S00", "S01", "S02"], previous, (snapshot, theirs))
    rows = {r.event_id: r for r in merged.catalog.collect()}
    assert len(rows) == 4 and rows["ep20260528-0001"].t_us == T and rows[named].review_status == "confirmed" and rows[named].magnitude == 2.0
    assert {r.event_id: r.triage for r in merged.catalog.collect()}["ep20260528-0001"] == "flag"
    assert sorted(r.station for r in merged.assignments.where(F.col("event_id") == named).collect()) == ["S05"]
    assert merged.assignments.where("event_id = 'ep20260528-0001'").count() == 3
    assert merged.warnings.count() == 1 and sorted(r.day for r in merged.ledger.collect()) == ["2026-05-01", day]


def test_reviews_are_saved_whole(spark):
    c = spark.createDataFrame([("ep1", 0, 31.8, -106.4, 5.0, None, "undetermined"), ("ep2", S, 31.8, -106.4, 6.0, None, "undetermined")], "event_id string, t_us long, latitude double, longitude double, depth_km double, review_status string, event_type string")
    a = spark.createDataFrame([("ep1", "AM", "S1", "P", 1), ("ep2", "AM", "S1", "P", 2)], "event_id string, network string, station string, phase string, t_us long")
    d = spark.createDataFrame([("ep1", 1, "rejected", None, False, 9.0), ("ep1", 2, "confirmed", "earthquake", True, 7.0), ("gone", 2, "confirmed", None, True, 1.0)], "event_id string, timestamp int, review_status string, event_type string, saved boolean, depth_km double")
    p = spark.createDataFrame([("ep1", 2, "AM", "S9", "S", 5), ("ep1", 1, "AM", "S8", "S", 5)], "event_id string, timestamp int, network string, station string, phase string, t_us long")
    out = jobs.save_reviews(c, a, d, p)
    assert sorted((r.event_id, r.review_status, r.event_type, r.depth_km) for r in out.catalog.collect()) == [("ep1", "confirmed", "earthquake", 7.0), ("ep2", None, "undetermined", 6.0)]
    assert sorted((r.event_id, r.station) for r in out.assignments.collect()) == [("ep1", "S9"), ("ep2", "S1")]
    assert [(r.event_id, len(r.picks)) for r in out.records.collect()] == [("ep1", 1)]
    assert [(r.event_id, r.other_id) for r in out.warnings.collect()] == [("ep1", "ep2")]


def test_regional_spans_and_reasons(spark):
    day = 86_400 * S
    assert jobs.spans_to_fetch(None, 5, 50 * day) == [(5, 50 * day)]
    assert jobs.spans_to_fetch((20 * day, 40 * day), 5 * day, 50 * day) == [(5 * day, 20 * day), (33 * day, 50 * day)]
    c = spark.createDataFrame([("ep1", 100 * S, 1.0), ("ep2", 1000 * S, 1.0)], "event_id string, t_us long, magnitude double")
    a = spark.createDataFrame([(e, f"S0{s}", "P") for e in ("ep1", "ep2") for s in range(6)], "event_id string, station string, phase string")
    regional = spark.createDataFrame([("us1", 4.52, 232.4, "31 km S of Whites City", 58 * S), ("us2", 4.0, 200.0, "x", 960 * S)], "id string, mag double, distance_km double, place string, t_us long")
    covered = spark.createDataFrame([(0, 500 * S)], "start_us long, end_us long")
    rows = {r.event_id: (r.triage, r.triage_reason) for r in jobs.apply_triage(c, a, [f"S0{s}" for s in range(6)], regional, covered).collect()}
    assert rows == {"ep1": ("auto_reject", "42 s after regional M4.5, 31 km S of Whites City (232 km, us1)"), "ep2": ("ok", "")}
    off = jobs.apply_triage(c, a, ["S00"], enabled=False).collect()
    assert {(r.triage, r.triage_reason) for r in off} == {("", "")}
    kept = jobs.apply_triage(c.withColumns({"triage": F.lit("flag"), "triage_reason": F.lit("why")}), a, ["S00"], enabled=False).collect()
    assert {(r.triage, r.triage_reason) for r in kept} == {("flag", "why")}


def test_odd_files_are_told(spark, tmp_path):
    (tmp_path / "2024.001.events.csv").write_text("event_index,time\n")
    (tmp_path / "notes.csv").write_text("x\n")
    assert [r.path.rsplit("/", 1)[-1] for r in readers.odd_files(spark, str(tmp_path)).collect()] == ["notes.csv"]


def test_rebuild_gives_no_id_twice(spark):
    """An earlier event a second on has the id that two new origins would take; ids given twice are an error."""
    T = 1_704_067_200 * S
    new = spark.createDataFrame([("ep", "2024-01-01", i, T + us) for i, us in enumerate((10_900_000, 11_500_000))], "source string, day string, event_index int, t_us long").withColumn("time", F.timestamp_micros("t_us"))
    for c in ("latitude", "longitude", "magnitude"):
        new = new.withColumn(c, F.lit(1.0))
    picks = new.select("source", "day", "event_index", F.lit("AM").alias("network"), F.lit("S00").alias("station"), F.lit("P").alias("phase"), "t_us")
    nothing = new.drop("source", "day", "event_index").withColumn("event_id", F.lit("")).where("false")
    none, ledger = picks.drop("source", "day", "event_index").withColumn("event_id", F.lit("")).where("false"), new.select("source", "day").where("false")
    previous = spark.createDataFrame([("ep20240101T000011", T + 11 * S)], "event_id string, t_us long")
    merged = jobs.merge_catalog(nothing, none, new, picks, ledger, ["S00"], previous)
    assert {r.event_id: r.t_us - T for r in merged.catalog.collect()} == {"ep20240101T000011": 10_900_000, "ep20240101T000011-2": 11_500_000}
    assert sorted(r.event_id for r in merged.assignments.collect()) == ["ep20240101T000011", "ep20240101T000011-2"]
    twice = nothing.unionByName(spark.createDataFrame([("ep1", T), ("ep1", T + S)], "event_id string, t_us long"), allowMissingColumns=True)
    with pytest.raises(ValueError, match="ep1 occurs 2 times"):
        jobs.merge_catalog(twice, none, new, picks, ledger, ["S00"])


def test_event_detail_makes_assignments_once(spark):
    """Counts by station come from the event's list of picks: null stations and phases count as in a grouping."""
    c = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "event_id string, n long")
    rows = [("a", 5, "AM", "S2", "P", 0.5, 1.0), ("a", 6, "AM", "S2", "S", 0.5, None), ("a", 4, "AM", "S1", "P", 0.5, 1.0), ("a", 7, "AM", None, "P", 0.5, 1.0), ("b", 8, "AM", "S3", None, 0.5, 1.0)]
    a = spark.createDataFrame(rows, "event_id string, t_us long, network string, station string, phase string, probability double, amplitude double").where("probability > 0.123")
    aliases = c.select(F.concat(F.lit("old"), "n").alias("legacy_id"), "event_id")
    out = jobs.event_detail(aliases.select(F.col("legacy_id").alias("event_id")), c, a, aliases)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("0.123") == 1
    got = {r.event_id: r for r in out.collect()}
    assert {(x.station, x.p, x.s) for x in got["a"].contributions} == {(None, 1, 0), ("S1", 1, 0), ("S2", 1, 1)}
    assert [tuple(x) for x in got["b"].contributions] == [("S3", 0, 0)] and got["c"].contributions is None
    assert [x.t_us for x in got["a"].picks] == [4, 5, 6, 7] and got["b"].legacy_id == "old2"
