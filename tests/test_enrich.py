import random

import pytest
from gaugeline.operators import enrich, skew
from helpers import minutes, series, table
from pyspark.sql import functions as F


@pytest.mark.parametrize("per_task", [1_000_000, 3])
def test_as_of_equals_brute_force(spark, per_task):
    rng = random.Random(7)
    # Most readings in one cell and hour, so that bucket is split.
    reads = [(i, 1, 60 + rng.random() * 50) for i in range(60)]
    reads += [(100 + i, rng.choice([1, 2, 3]), rng.random() * 4000) for i in range(60)]
    reads.append((500, 2, 240.0))
    facts = {(c, float(m)): rng.random() for c, m in [(1, 70), (1, 75), (1, 109), (1, 900), (2, 240), (2, 3000)]}
    readings = series(spark, reads, "id int,cell int,at ts")
    context = series(spark, [(c, m, v) for (c, m), v in facts.items()], "cell int,ts ts,temp double")
    out = enrich.as_of(readings, context, "cell", "at", "ts", ["temp"], ["id"], rows_per_task=per_task)
    assert out.columns == ["id", "cell", "at", "ts_matched", "temp"]
    got = {r["id"]: (minutes(r["ts_matched"]), r["temp"]) for r in out.collect()}
    assert len(got) == len(reads)
    for i, cell, m in reads:
        before = [fm for (fc, fm) in facts if fc == cell and fm <= m + 1e-9]
        expected = (max(before), facts[(cell, max(before))]) if before else (None, None)
        assert got[i] == expected


def test_hot_groups_are_sized(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 251)], "k string, n bigint")
    assert table(skew.hot_groups(sizes, ["k"], rows_per_task=100), "k") == [("a", 10), ("c", 3)]


def test_salt_is_stable_and_in_range(spark):
    df = spark.range(200).withColumn("s", skew.salt_of(["id"], F.lit(7)))
    assert {r["s"] for r in df.collect()} == set(range(7))
    assert df.collect() == df.collect()


@pytest.mark.parametrize("before, after", [(720, 720), (720, 0), (0, 30), (7, 13)])
def test_around_events_equals_brute_force(spark, before, after):
    rng = random.Random(before + after)
    points = [(i, rng.choice([1, 2]), rng.randint(0, 5000)) for i in range(150)]
    events = [(rng.choice([1, 2]), rng.randint(0, 5000)) for _ in range(15)] + [(1, points[0][2])]
    out = enrich.around_events(
        series(spark, points, "id int,unit int,at ts"), series(spark, events, "unit int,event ts"),
        "at", "event", before * 60, after * 60, ["unit"],
    )
    got = sorted((r["id"], minutes(r["event"])) for r in out.collect())
    expected = sorted((i, float(e)) for i, u, m in points for v, e in events if u == v and e - before <= m <= e + after)
    assert got == expected


def test_interval_must_have_length(spark):
    with pytest.raises(ValueError):
        enrich.around_events(spark.range(1), spark.range(1), "id", "id", 0, 0)


def test_hour_labels_stay_null_without_match(spark):
    features = series(spark, [(0, 1.0), (60, 2.0)], "timestamp_hour ts,x double")
    labels = series(spark, [(0, 1)], "timestamp_hour ts,failure int")
    assert table(enrich.join_hour_labels(features, labels).select("x", "failure"), "x") == [(1.0, 1), (2.0, None)]


def test_pairs_join_by_key_and_report_the_rest(spark):
    truth = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "key bigint, y_true double")
    preds = spark.createDataFrame([("m", 2, 5.0), ("m", 3, 6.0), ("m", 9, 7.0), ("n", 1, 0.0)], "model string, key bigint, y_pred double")
    pairs, rest = enrich.pair_predictions(truth, preds)
    assert table(pairs, "model", "key") == [("m", 2, 2.0, 5.0), ("m", 3, 3.0, 6.0), ("n", 1, 1.0, 0.0)]
    assert table(rest, "model") == [("m", 1, 1), ("n", 0, 2)]


def test_a_hot_bucket_without_key_is_split(spark):
    rng = random.Random(3)
    points = [(i, rng.randint(0, 59)) for i in range(600)] + [(600 + i, rng.randint(0, 5000)) for i in range(600)]
    events = [30, 45, 2000, 2000]
    at, event = series(spark, points, "id int,at ts"), series(spark, [(m,) for m in events], "event ts")
    out = enrich.around_events(at, event, "at", "event", 1800, 1800, rows_per_task=50)
    got = sorted((r["id"], minutes(r["event"])) for r in out.collect())
    assert got == sorted((i, float(e)) for i, m in points for e in events if e - 30 <= m <= e + 30)
    # No part of a bucket holds more than one and a half times what a task is to have.
    placed = at.withColumn("_bucket", F.floor(F.unix_timestamp("at") / 3600))
    visits = event.withColumn("_bucket", F.floor(F.unix_timestamp("event") / 3600))
    hot = enrich._visited_hot(placed, visits, ["_bucket"], 50)
    assert hot.count() == 1
    parts = placed.join(hot, "_bucket").withColumn("p", skew.salt_of(["id", "at"], F.col("splits"))).groupBy("p").count()
    assert parts.agg(F.max("count")).first()[0] <= 75


@pytest.mark.parametrize("radius, cell", [(300.0, 1.0), (300.0, 300.0), (40.0, 7.0)])
def test_nearest_place_equals_brute_force(spark, radius, cell):
    import math

    rng = random.Random(11)
    near = lambda lat, lon: (lat + rng.random(), lon + rng.random())
    centres = [(0.0, 179.5), (88.9, 10.0), (-89.9, -120.0), (41.0, -8.0)]
    spots = [near(*c) for c in centres for _ in range(12)] + [(0.2, -179.9), (89.8, -170.0), (10.0, 10.0)]
    spots = [(min(a, 90.0), b - 360 if b > 180 else b) for a, b in spots]
    stations = [(i, *near(*rng.choice(centres))) for i in range(40)]
    stations += [(90, stations[0][1], stations[0][2]), (91, None, 1.0), (92, float("nan"), 1.0), stations[0]]
    points = [(i, *s, "x") for i, s in enumerate(spots)] + [(900, None, 1.0, "x"), (901, float("nan"), 2.0, "x"), (902, *spots[0], "x")]
    out = enrich.nearest_place(
        spark.createDataFrame(points, "id int, lat double, lon double, station string"),
        spark.createDataFrame(stations, "station_id int, lat double, lon double"), "station_id", "lat", "lon", "lat", "lon", radius, cell)
    assert out.columns == ["id", "lat", "lon", "station", "station_id", "distance_km"]

    def apart(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))

    rows = {r["id"]: (r["station_id"], r["distance_km"]) for r in out.collect()}
    assert len(rows) == len(points) and rows[900] == rows[901] == (None, None) and rows[902] == rows[0]
    good = [s for s in stations if s[1] is not None and s[1] == s[1]]
    for i, (lat, lon) in enumerate(spots):
        d, k = min((round(apart(lat, lon, a, b), 7), k) for k, a, b in good)
        if d > radius:
            assert rows[i] == (None, None)
        else:
            assert rows[i][0] == k and abs(rows[i][1] - d) < 1e-5
    assert rows[len(spots) - 1] == (None, None)
