"""Joins and groups on tables where many rows share a stretch of time: the same results as from all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from seisloom.operators import aggregates as agg
from seisloom.operators import joins, timejoin

S = 1_000_000


@pytest.fixture(autouse=True)
def _checkpoints(spark, tmp_path):
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + str(tmp_path / "checkpoints"))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_within_is_the_first_of_all_pairs(spark):
    dice = random.Random(3)
    left = [(i, dice.choice([dice.randrange(-5 * S, 90 * S), 40 * S])) for i in range(60)] + [(60, None)]
    right = [(i, dice.choice("AB"), dice.choice([None, "P"]), dice.choice([dice.randrange(0, 700 * S), 40 * S, 50 * S, dice.randrange(0, 50 * S)])) for i in range(120)] + [(200, "A", "P", None)]
    reach = 9 * S
    out = timejoin.first_within(spark.createDataFrame(left, "id long, at long"), spark.createDataFrame(right, "pick long, station string, phase string, t long"), "at", "t", reach, ("station", "phase"), "pick")
    best = {}
    for i, at in left:
        for pick, station, phase, t in right:
            if at is not None and t is not None and 0 <= t - at <= reach:
                key = (i, station, phase)
                best[key] = min(best.get(key, (t, pick)), (t, pick))
    assert out.columns == ["id", "at", "pick", "station", "phase", "t"]
    assert sorted((r["id"], r["station"], str(r["phase"]), r["pick"]) for r in out.collect()) == sorted((i, s, str(p), pick) for (i, s, p), (_, pick) in best.items())


@pytest.mark.parametrize("span", [4, 64])
def test_earliest_matches_are_those_of_the_pairs(spark, monkeypatch, span):
    """Reviewed events take the earliest origins as the greedy pass over all pairs does, over the edges of small blocks too."""
    monkeypatch.setattr(timejoin, "SPAN", span)
    dice = random.Random(7)
    left = [(f"e{i:03d}", dice.choice([dice.randrange(0, 90 * S), dice.randrange(9) * 10 * S])) for i in range(70)] + [("n", None)]
    right = [(f"e{i:03d}", dice.choice([dice.randrange(0, 90 * S), dice.randrange(9) * 10 * S])) for i in range(0, 130, 2)]
    a, b = spark.createDataFrame(left, "a string, a_us long"), spark.createDataFrame(right, "b string, b_us long")
    pairs = sorted((u, x, y) for x, t in left for y, u in right if t is not None and abs(t - u) <= 3 * S and x != y)
    used, want = set(), []
    for _, x, y in pairs:
        if used.isdisjoint({(0, x), (1, y)}):
            used |= {(0, x), (1, y)}
            want.append((x, y))
    assert rows_of(timejoin.earliest_one_to_one(a, b, "a", "b", "a_us", "b_us", 3 * S)) == sorted(want) and len(want) > 30


def test_corroborated_by_dense_picks(spark):
    dice = random.Random(4)
    make = lambda n, first: [(first + i, "N", dice.choice("AB"), "P", dice.choice([dice.randrange(-20 * S, 60 * S), dice.randrange(10) * S])) for i in range(n)]
    mine, other = [*make(80, 0), (99, "N", "A", "P", None)], make(12, 100)
    schema = "event_id long, network string, station string, phase string, t_us long"
    a, b = spark.createDataFrame(mine, schema), spark.createDataFrame(other, schema)
    near = {x[0] for x in mine for y in other if x[4] is not None and x[1:4] == y[1:4] and abs(x[4] - y[4]) <= S}
    assert {r.event_id for r in joins.corroborated(a, b).collect()} == near
    assert rows_of(agg.corroboration_counts(a, b)) == sorted((x[0], int(x[0] in near)) for x in mine)


def test_duplicate_groups_are_those_of_the_pairs(spark):
    dice = random.Random(5)
    rows = [(f"e{i:03d}", dice.randrange(0, 120 * S), 31 + dice.randrange(6) * 0.03, -106 + dice.randrange(6) * 0.03) for i in range(150)]
    rows += [("n1", None, 31.0, -106.0), ("n2", 5 * S, None, -106.0), ("n3", 5 * S, None, -106.0)]
    c = spark.createDataFrame(rows, "event_id string, t_us long, latitude double, longitude double")
    want = timejoin.components(joins.dup_pairs(c, 2, 4), "a", "b")
    assert rows_of(joins.dup_groups(c, 2, 4)) == rows_of(want) != []


def test_stations_counted_once_without_a_row_for_each_count(spark):
    events = spark.createDataFrame([("a",), ("b",)], "event_id string")
    picks = spark.createDataFrame([("a", "N", "X", "P"), ("a", "N", "X", "S"), ("a", "N", "Y", "P"), ("a", "N", None, "P")], "event_id string, network string, station string, phase string")
    out = agg.triage_features(events, picks, ["X"])
    assert rows_of(out) == [("a", 4, 2, 1), ("b", 0, 0, 0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_dup_pairs_are_judged_in_the_join(spark):
    c = spark.createDataFrame([("a", 0, 31.0, -106.0), ("b", S, 31.01, -106.0), ("c", S, 35.0, -106.0)], "event_id string, t_us long, latitude double, longitude double")
    out = joins.dup_pairs(c)
    assert [(r.a, r.b, r.gap_us) for r in out.collect()] == [("a", "b", S)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_stored_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([("a", 1), (None, None)], "x string, y long").withColumn("z", F.lit(1.5))
    out = timejoin.stored(df)
    assert out.schema.simpleString() == df.schema.simpleString() and set(map(tuple, out.collect())) == {("a", 1, 1.5), (None, None, 1.5)}


def made_events(spark, path, rows):
    """A folder of tables with an ``events`` table of ``(event_id, seconds, k)`` purchases."""
    time = F.timestamp_micros((1_704_067_200_000_000 + F.col("s") * 1_000_000).cast("long"))
    rows = spark.createDataFrame(rows, "event_id long, s double, k long").select(
        "event_id", time.cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("purchase").alias("event_type"), F.lit(100.0).alias("value"),
        F.concat(F.lit('{"k": '), F.col("k").cast("string"), F.lit("}")).alias("props"),
    )
    rows.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_candidates_that_share_a_second_are_left_out(spark, tmp_path):
    from seisloom.plans import registry

    path = made_events(spark, tmp_path, [(1, 100.0, 3), (2, 100.5, 6), (3, 300.25, 9)])
    assert [r.event_id for r in registry.QUERIES["jn14_seed"](spark, path).collect()] == ["tm20240101T010500"]


def test_positions_beyond_four_digits_are_planned(spark, tmp_path):
    from seisloom.plans import registry

    path = made_events(spark, tmp_path, [(i, i * 4.0, 1) for i in range(1, 10_021)])
    out = registry.QUERIES["job21_plan_ids"](spark, path)
    assert out.count() == 10_020 and out.select("new").distinct().count() == 10_020
