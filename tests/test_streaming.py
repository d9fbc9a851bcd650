"""Streams against the batch result on the same input."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from seisloom.sources import sinks
from seisloom.streaming import jobs

DATA = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + str(tmp_path / "checkpoints"))


@pytest.fixture(scope="module")
def picks(spark, tmp_path_factory):
    if not os.path.exists(DATA):
        pytest.skip("needs the synthetic tables")
    from seisloom.plans.views import Views

    path = str(tmp_path_factory.mktemp("picks"))
    Views(spark, DATA).picks().write.mode("overwrite").parquet(path)
    return path


def run(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def stream(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def test_hourly_rates(spark, picks):
    out = run(spark, jobs.pick_rate(stream(spark, picks)), "rates", "complete")
    want = spark.read.parquet(picks).groupBy("station", F.date_trunc("hour", "time").alias("start")).agg(F.count("*").alias("n"))
    assert sorted(map(tuple, out.select("station", "start", "n").collect())) == sorted(map(tuple, want.collect()))


def feed(spark, folder, batches, schema):
    """Files read one a batch, in order."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.parquet(f"{folder}/part-{i:03d}")
        time.sleep(0.02)  # files are taken by age
    kind = spark.createDataFrame([], schema).schema
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def timed(df):
    return df.withColumn("time", F.timestamp_micros("t_us"))


HOUR, DAY = 3_600_000_000, 86_400_000_000
FAR = 10_000 * DAY  # a last row that carries the watermark past all others


def test_sessions(spark, picks, tmp_path):
    every = spark.read.parquet(picks).select("network", "station", "t_us", "time")
    last = spark.createDataFrame([("ZZ", "end", FAR)], "network string, station string, t_us long")
    every.unionByName(timed(last)).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = run(spark, jobs.pick_sessions(stream(spark, str(tmp_path / "in")), "30 minutes", 2), "sessions", "append")
    rows = sorted((r.t_us, r.station) for r in every.collect())
    groups, before = [], None
    for t, s in rows:
        if before is None or t - before > 1_800_000_000:
            groups.append([])
        groups[-1].append((t, s))
        before = t
    want = sorted((g[0][0], len(g), len({s for _, s in g})) for g in groups if len(g) >= 2)
    got = out.where("network = 'AM'").select(F.unix_micros("start"), "n", "stations").collect()
    assert sorted(map(tuple, got)) == want and want


def test_sliding_counts(spark, picks):
    out = run(spark, jobs.sliding_counts(stream(spark, picks), "2 hours", "1 hour"), "sliding", "complete")
    want = {}
    for r in spark.read.parquet(picks).collect():
        for start in (r.t_us // HOUR * HOUR, r.t_us // HOUR * HOUR - HOUR):
            want.setdefault(start, []).append(r.station)
    got = {r.s: (r.n, r.stations) for r in out.select(F.unix_micros("start").alias("s"), "n", "stations").collect()}
    assert got == {k: (len(v), len(set(v))) for k, v in want.items()}


def test_corroboration_and_separation(spark, tmp_path):
    S = 1_000_000
    second = [[(1, "S1", "P", 100 * S), (2, "S1", "P", 300 * S)], [(3, "S2", "S", 400 * S), (3, "S2", "S", 400 * S), (4, "S2", "P", 500 * S)], [(9, "end", "P", FAR)]]
    first = [[(0, "S1", "P", 101 * S), (0, "S1", "P", 99 * S), (0, "S1", "S", 300 * S)], [(0, "S2", "S", 400 * S), (0, "S2", "P", 501 * S + 1)], [(0, "end", "P", FAR)]]
    schema = "pick_id long, station string, phase string, t_us long"
    a, b = (timed(feed(spark, tmp_path / n, x, schema)) for n, x in (("a", second), ("b", first)))
    out = run(spark, jobs.corroborate(a, b), "corroborated")
    assert sorted(r.pick_id for r in out.where("station <> 'end'").collect()) == [1, 3]
    events, origins = ([[(i, t * S) for i, t in x] for x in y] for y in ([[(1, 100), (2, 200)], [(3, 300), (4, 400)]], [[(0, 110), (0, 189)], [(0, 310.000001)]]))
    events.append([(9, FAR)])
    origins.append([(0, FAR)])
    c, d = (timed(feed(spark, tmp_path / n, [[(i, int(t)) for i, t in y] for y in x], "event_id long, t_us long")) for n, x in (("c", events), ("d", origins)))
    out = run(spark, jobs.separate(c, d), "separated")
    assert sorted(r.event_id for r in out.collect() if r.event_id != 9) == [2, 3, 4]


def test_corroboration_compares_picks_near_in_time(spark, tmp_path):
    """The state is looked up by station, phase and bucket of time, and a pick's search ends with the first that fits."""
    S = 1_000_000
    schema = "pick_id long, station string, phase string, t_us long"
    second = [[(1, "S1", "P", 100 * S), (1, "S1", "P", 100 * S), (2, "S1", "P", 1000 * S), (4, "S1", "P", 2000 * S - 1)], [(9, "end", "P", FAR)]]
    first = [[(0, "S1", "P", 99 * S), (0, "S1", "P", 101 * S), (0, "S1", "P", 100 * S), (0, "S1", "P", 1002 * S), (0, "S1", "P", 2000 * S)], [(0, "end", "P", FAR)]]
    a, b = (timed(feed(spark, tmp_path / n, x, schema)) for n, x in (("a", second), ("b", first)))
    out = jobs.corroborate(a, b)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "LeftSemi" in plan and "bucket_" in plan and "near_" in plan
    out = run(spark, out, "corroborated_near")
    assert sorted(r.pick_id for r in out.where("station <> 'end'").collect()) == [1, 4]


def test_dense_primary_rows_are_two_times_a_bucket(spark, tmp_path):
    """Many primary rows a bucket of time, in late batches: the join sees three rows a bucket, and what comes out is what all pairs tell."""
    dice, S = random.Random(6), 1_000_000
    picks = lambda first, n, span: [(first + i, dice.choice(["S1", "S2"]), dice.choice(["P", "S"]), dice.choice([dice.randrange(1000 * S, (1000 + span) * S), (1000 + dice.randrange(span)) * S])) for i in range(n)]
    mine, other = picks(0, 120, 120), picks(1000, 90, 60)
    schema, end = "pick_id long, station string, phase string, t_us long", [(-1, "end", "P", FAR)]
    feeds = lambda *tables: [timed(feed(spark, tmp_path / n, [x[::2], x[1::2], [e]], sch)) for n, x, e, sch in tables]
    a, b = feeds(("a", mine, end[0], schema), ("b", other, end[0], schema))
    out = run(spark, jobs.corroborate(a, b), "corroborated_dense")
    want = {x[0] for x in mine for y in other if x[1:3] == y[1:3] and abs(x[3] - y[3]) <= S}
    assert sorted(r.pick_id for r in out.where("pick_id >= 0").collect()) == sorted(want) and 10 < len(want) < 110
    events, origins = [(i, t) for i, _, _, t in mine], [(i, t) for i, _, _, t in other[:12]]
    c, d = feeds(("c", events, (-1, FAR), "event_id long, t_us long"), ("d", origins, (-1, FAR), "event_id long, t_us long"))
    out = run(spark, jobs.separate(c, d, 2), "separated_dense")
    want = {i for i, t in events if all(abs(t - u) > 2 * S for _, u in origins)}
    assert sorted(r.event_id for r in out.where("event_id >= 0").collect()) == sorted(want) and 10 < len(want) < 110
    for df in (jobs.corroborate(a, b), jobs.separate(c, d, 2)):  # what meets the second detector's rows is counted by buckets
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "Aggregate" in plan[plan.index("Join") :] and "min(b_time" in plan


def test_state_lasts_until_the_buckets_around_have_come_out(spark, tmp_path):
    """Batches in order of time, with watermarks inside buckets: a row waits for the bucket after its own, and the last ones come out at the end."""
    dice, S = random.Random(8), 1_000_000
    rows = lambda first, n: sorted((first + i, "S1", "P", dice.randrange(1000 * S, 1600 * S)) for i in range(n))
    mine, other = (sorted(x, key=lambda r: r[3]) for x in (rows(0, 90), rows(1000, 60)))
    cut = lambda x: [[r for r in x if 1000 + 75 * k <= r[3] / S < 1075 + 75 * k] for k in range(8)] + [[(-1, "end", "P", FAR)]]
    a, b = (timed(feed(spark, tmp_path / n, cut(x), "pick_id long, station string, phase string, t_us long")) for n, x in (("a", mine), ("b", other)))
    near = {x[0] for x in mine if any(abs(x[3] - y[3]) <= 10 * S for y in other)}
    assert 10 < len(near) < 90
    out = run(spark, jobs.corroborate(a, b, "10 seconds", "5 seconds"), "corroborated_in_order")
    assert sorted(r.pick_id for r in out.where("pick_id >= 0").collect()) == sorted(near)
    out = run(spark, jobs.separate(a.drop("station", "phase"), b, 10, "5 seconds"), "separated_in_order")
    assert sorted(r.pick_id for r in out.where("pick_id >= 0").collect()) == sorted({x[0] for x in mine} - near)


def test_days_are_written_whole(spark, tmp_path):
    from datetime import UTC, datetime

    schema = "day date, station string, n int"
    d = lambda n: datetime(2024, 1, n).date()
    batches = [[(d(1), "a", 1), (d(2), "a", 2)], [(d(1), "b", 3)], [(d(2), "b", 4), (d(3), "a", 5)]]
    out = str(tmp_path / "out")
    shape = spark.createDataFrame([], schema).schema
    rows = lambda: sorted(tuple(r) for r in sinks.read_versions(spark, out, shape).collect())

    def go(at, checkpoint="c"):
        q = jobs.process_days(source, out, str(tmp_path / checkpoint), lambda: at)
        q.awaitTermination()

    source = feed(spark, tmp_path / "in", batches, schema)
    go(datetime(2024, 1, 3, 2, 0, tzinfo=UTC))  # the first two days are 26 h old
    assert rows() == [(d(1), "a", 1), (d(1), "b", 3), (d(2), "a", 2), (d(2), "b", 4)]
    spark.createDataFrame([(d(1), "late", 6)], schema).write.parquet(str(tmp_path / "in" / "part-100"))
    go(datetime(2024, 1, 4, 2, 0, tzinfo=UTC))
    assert rows() == [(d(1), "a", 1), (d(1), "b", 3), (d(1), "late", 6), (d(2), "a", 2), (d(2), "b", 4), (d(3), "a", 5)]
    assert sorted(sinks.day_versions(spark, out)) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_batches_of_days_stay_small(spark, tmp_path, monkeypatch):
    """Files that a batch reads do not grow with the batches before; a repeated batch and a crash before the pointer change nothing."""
    from datetime import UTC, datetime, timedelta

    schema = "day string, n long"
    out, first = str(tmp_path / "out"), datetime(2024, 1, 1, tzinfo=UTC)
    clock, read, shape = [first], [], spark.createDataFrame([], schema).schema
    batch = jobs.day_batches(out, lambda: clock[0])
    union = sinks.write_versions

    def counted(df, *args, **more):
        read.append(len(df.inputFiles()))
        return union(df, *args, **more)

    monkeypatch.setattr(sinks, "write_versions", counted)
    want = []
    for k in range(24):  # four batches a day, a late row now and then
        day = first + timedelta(days=k // 4)
        clock[0] = day + timedelta(hours=6 * (k % 4) + 5)
        rows = [(f"{day:%Y-%m-%d}", k)] + ([(f"{first + timedelta(days=k // 4 - 3):%Y-%m-%d}", 100 + k)] if k % 5 == 4 and k > 12 else [])
        want += rows
        batch(spark.createDataFrame(rows, schema).coalesce(1), k)
        if k in (9, 14):
            batch(spark.createDataFrame(rows, schema).coalesce(1), k)
    ready = [r for r in want if datetime.fromisoformat(r[0]).replace(tzinfo=UTC) + timedelta(hours=26) <= clock[0]]
    see = lambda: sorted(tuple(r) for r in sinks.read_versions(spark, out, shape).collect())
    assert see() == sorted(ready) and len(ready) > 16
    assert max(read) <= 6 and len(sinks._list(spark, f"{out}/staged")) <= 2 and len(sinks._list(spark, f"{out}/pointers")) <= 2
    assert all(len(sinks._list(spark, f"{out}/data/day={d}")) <= 2 for d in sinks.day_versions(spark, out))
    # data of a next version without its pointer is not in sight
    spark.createDataFrame([("2024-01-01", 999, 50)], "day string, n long, version long").write.mode("append").partitionBy("day", "version").parquet(f"{out}/data")
    assert see() == sorted(ready)


def test_chunks_are_upserted_by_day(spark, tmp_path):
    path, schema = str(tmp_path / "chunks"), "day string, station string, start_us long, status string, at long"
    merge = jobs.upsert_chunks(path, ["day", "station", "start_us"], "at")
    first = [("1", "a", 0, "failed", 1), ("1", "b", 0, "short", 1), ("2", "a", 9, "success", 1)]
    second = [("1", "a", 0, "success", 2), ("1", "b", 0, "older", 0), ("3", "c", 5, "success", 2)]
    for n, rows in enumerate((first, second, second)):  # a repeated batch changes nothing
        merge(spark.createDataFrame(rows, schema), n)
    shape = spark.createDataFrame([], schema).schema
    got = sorted(tuple(r) for r in sinks.read_versions(spark, path, shape).select("day", "station", "status").collect())
    assert len(sinks.read_versions(spark, path, shape, ["2"]).inputFiles()) == 1
    assert got == [("1", "a", "success"), ("1", "b", "short"), ("2", "a", "success"), ("3", "c", "success")]


def test_dark_stations(spark, tmp_path):
    data = {"a": [0, 1, 2, 7, 8], "b": list(range(12)), "c": [3]}
    batches = [[(s, day * DAY + 5 * HOUR) for s, days in data.items() if day in days] or [("b", day * DAY)] for day in range(12)]
    source = timed(feed(spark, tmp_path / "in", [*batches, [("b", 12 * DAY)]], "station string, t_us long"))
    expected = spark.createDataFrame([("never", 0), ("c", 0)], "station string, last_us long")
    out = run(spark, jobs.dark_stations(source, 3, expected, "1 hour"), "dark")
    got = sorted((r.key, r.alert, r.at_us / DAY) for r in out.collect())
    assert got == [("a", "back", 7 + 5 / 24), ("a", "silent", 6.0), ("c", "silent", 7.0), ("never", "silent", 4.0)]


def test_quiet_network(spark, tmp_path):
    hours = [0, 20, 60, 120, 121, 400]
    source = timed(feed(spark, tmp_path / "in", [[("AM", h * HOUR)] for h in (*hours, 402)], "network string, t_us long"))  # alerts wait for the watermark
    got = sorted((r.at_us / HOUR, r.alert) for r in run(spark, jobs.quiet_network(source), "quiet").collect())
    want = []
    for x, y in zip(hours, hours[1:], strict=False):
        want += [(x + 48, "silent"), (y, "back")] if y - x >= 48 else []
    assert got == want


def test_significant_events_once(spark, tmp_path):
    rows = [[("e1", 4.0, DAY), ("e2", 3.9, DAY)], [("e1", 4.1, DAY), ("e3", 5.0, DAY + HOUR)], [("e4", 4.0, 9 * DAY)], [("e6", 4.0, 9 * DAY)], [("e5", 6.0, DAY)]]
    source = timed(feed(spark, tmp_path / "in", rows, "event_id string, magnitude double, t_us long"))
    got = sorted(r.event_id for r in run(spark, jobs.significant_events(source), "strong").collect())
    assert got == ["e1", "e3", "e4", "e6"]  # e5 is too old by then


def test_regional_tags_by_batch(spark, tmp_path):
    S = 1_000_000
    source = feed(spark, tmp_path / "in", [[("ep1", 100 * S), ("ep2", 1000 * S)], [("ep3", 2000 * S)]], "event_id string, t_us long")
    regional = spark.createDataFrame([("r1", 4.5, 232.0, "Mexico", 60 * S), ("r2", 5.0, 300.0, "", 1990 * S)], "id string, mag double, distance_km double, place string, t_us long")
    tagged = []
    write = lambda df, _: tagged.extend(df.collect())
    source.writeStream.foreachBatch(jobs.regional_tagger(lambda: regional, lambda: None, write)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.event_id, r.regional_id) for r in tagged) == [("ep1", "r1"), ("ep2", None), ("ep3", "r2")]


def test_late_chunks_are_followed(spark, tmp_path):
    end = HOUR
    rows = [
        [("a", 0, end, end, "success", 0.5), ("b", 0, end, end, "no_data", None), ("c", 0, end, end, "failed", None), ("d", 0, end, end, "success", 1.0)],
        [("a", 0, end, end + DAY, "success", 1.0), ("c", 0, end, end + DAY, "failed", None)],
        [("c", 0, end, end + 9 * DAY, "failed", None), ("e", 0, end, end + 9 * DAY, "success", 0.2)],
        [("z", FAR, FAR, FAR, "success", 1.0)],
    ]
    source = timed(feed(spark, tmp_path / "in", rows, "station string, start_us long, end_us long, t_us long, status string, coverage double"))
    got = sorted((r.station, r.action) for r in run(spark, jobs.follow_chunks(source), "chunks").collect())
    assert got == [
        ("a", "again"), ("a", "complete"), ("b", "accepted"), ("b", "again"), ("c", "again"), ("c", "again"), ("c", "again"), ("d", "complete"), ("e", "accepted"), ("z", "complete"),
    ]


def test_seam_dedup(spark, tmp_path):
    """As the batch operator: of picks within a second of a station and phase the most probable stays."""
    from seisloom.operators.windows import dedup_seams

    S = 1_000_000
    rows = [[("a", "P", 0, 0.5), ("a", "P", 700_000, 0.9), ("a", "S", 100_000, 0.4), ("b", "P", 5 * S, 0.7)], [("a", "P", 1_500_000, 0.6), ("a", "P", 9 * S, 0.3), ("b", "P", 5_500_000, 0.6)], [("z", "P", FAR, 0.1)]]
    source = timed(feed(spark, tmp_path / "in", rows, "station string, phase string, t_us long, probability double"))
    out = run(spark, jobs.seam_dedup(source, S), "seams")
    every = spark.createDataFrame([r for b in rows for r in b], "station string, phase string, t_us long, probability double")
    want = dedup_seams(every, S).where("station <> 'z'").collect()
    assert sorted(map(tuple, out.where("station <> 'z'").collect())) == sorted((r.station, r.phase, r.t_us, r.probability) for r in want)


def shuffled(rows, late, batches, seed):
    """Rows ``(..., t_us, ...)`` with the time first, in batches, in any order, none later than ``late`` behind the latest before."""
    import random

    draw = random.Random(seed)
    first, width = min(r[0] for r in rows), (max(r[0] for r in rows) - min(r[0] for r in rows)) // batches + 1
    out = [[] for _ in range(batches)]
    for r in rows:
        out[min((r[0] + draw.randrange(late) - first) // width, batches - 1)].append(r)
    for part in out:
        draw.shuffle(part)
    return [part for part in out if part]


@pytest.mark.parametrize("seed", [1, 2])
def test_seams_in_any_order(spark, tmp_path, seed):
    """Chains, ties and repeats that arrive up to the watermark's minute out of order give what the batch operator gives."""
    import random

    from seisloom.operators.windows import dedup_seams

    S, draw = 1_000_000, random.Random(seed)
    rows = [(draw.randrange(0, 600 * S, S // 10), draw.choice("ab"), draw.choice("PS"), draw.randrange(5) / 4) for _ in range(900)]
    rows += [(700 * S, "a", "P", 0.7), (700 * S + 800_000, "a", "P", 0.8), (701 * S + 600_000, "a", "P", 0.9)] + rows[:5]
    schema = "t_us long, station string, phase string, probability double"
    source = timed(feed(spark, tmp_path / "in", [*shuffled(rows, 55 * S, 4, seed), [(FAR, "z", "P", 0.1)]], schema))
    out = run(spark, jobs.seam_dedup(source, S, "1 minute"), f"seams{seed}").where("station <> 'z'")
    want = dedup_seams(spark.createDataFrame(rows, schema), S).collect()
    assert sorted((r.station, r.phase, r.t_us, r.probability) for r in out.collect()) == sorted((r.station, r.phase, r.t_us, r.probability) for r in want)
    assert {(700 * S, 0.7), (701 * S + 600_000, 0.9)} <= {(r.t_us, r.probability) for r in want}


def test_seam_behind_the_held_pick(spark, tmp_path):
    S = 1_000_000
    rows = [[(100 * S, "a", "P", 0.9)], [(70 * S, "a", "P", 0.6)], [(FAR, "z", "P", 0.1)]]
    source = timed(feed(spark, tmp_path / "in", rows, "t_us long, station string, phase string, probability double"))
    out = run(spark, jobs.seam_dedup(source, S), "behind").where("station <> 'z'")
    assert sorted((r.t_us // S, r.probability) for r in out.collect()) == [(70, 0.6), (100, 0.9)]


def test_settled_chunks_stay_so(spark, tmp_path):
    """An older answer after the complete one, and answers after a short one was accepted."""
    end = HOUR
    rows = [
        [("a", 0, end, end + HOUR, "success", 1.0), ("b", 0, end, end + HOUR, "success", 0.5)],
        [("a", 0, end, end + HOUR // 2, "success", 0.5), ("b", 0, end, end + HOUR // 2, "failed", None)],
        [("y", 9 * DAY, 9 * DAY, 9 * DAY, "success", 1.0)],
        [("z", FAR, FAR, FAR, "success", 1.0)],
    ]
    source = timed(feed(spark, tmp_path / "in", rows, "station string, start_us long, end_us long, t_us long, status string, coverage double"))
    got = sorted((r.station, r.action) for r in run(spark, jobs.follow_chunks(source), "settled").collect())
    assert got == [("a", "complete"), ("b", "accepted"), ("b", "again"), ("b", "again"), ("y", "complete"), ("z", "complete")]


def test_silence_in_any_order(spark, tmp_path):
    """A row within the watermark that comes after a later one ends no silence twice and begins none."""
    batches = [[0], [100], [99, 60], [30], [101], [500]]
    source = timed(feed(spark, tmp_path / "in", [[("AM", h * HOUR) for h in b] for b in batches], "network string, t_us long"))
    got = sorted((r.at_us / HOUR, r.alert) for r in run(spark, jobs.quiet_network(source, 48, "90 hours"), "disorder").collect())
    assert got == [(149, "silent")]
