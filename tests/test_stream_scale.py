"""What lets stream scoring grow: rows instead of frames per unit, narrow state, bins on disk, even train parts."""

from gaugeline.operators import models
from gaugeline.session import new_path
from gaugeline.streaming import keyed, live
from helpers import series
from pyspark.sql import Row


class Kept:
    def __init__(self):
        self.rows = []

    def get(self):
        return iter(list(self.rows))

    def put(self, rows):
        self.rows = list(rows)


def processor(rows_back):
    made = keyed.NewestBins(["unit_id"], rows_back, None)
    state = Kept()
    made.init(type("Handle", (), {"getListState": lambda self, *a: state})())
    return made, state


def answer(made, pairs):
    fresh = (Row(unit_id=7, second=s, payload=p) for s, p in pairs)
    return [tuple(r) for r in made.handleInputRows((7,), fresh, None)]


def test_newest_bins_are_those_of_a_full_sort_however_many_rows_come(monkeypatch):
    monkeypatch.setattr(keyed, "HELD", 5)
    pairs = [((i * 37) % 101, f"p{i}") for i in range(400)]  # every second several times: of equals the later are newer
    made, state = processor(4)
    assert answer(made, pairs) == [(7, s, p, True) for s, p in pairs]
    want = sorted(pairs, key=lambda x: x[0])[-4:]
    assert state.rows == want
    assert answer(made, [(50, "late")]) == [(7, s, p, False) for s, p in want] + [(7, 50, "late", True)]
    assert state.rows == want


def test_fewer_bins_than_wanted_are_all_kept():
    made, state = processor(3)
    answer(made, [(2, "b"), (1, "a")])
    assert state.rows == [(1, "a"), (2, "b")]


def test_only_columns_the_features_need_enter_the_state(spark, monkeypatch):
    seen, real = [], keyed.with_newest
    monkeypatch.setattr(keyed, "with_newest", lambda stream, *a: seen.append(stream.columns) or real(stream, *a))
    source, out = new_path(spark, "test-narrow-in"), new_path(spark, "test-narrow-out")
    bins = series(spark, [(1, m, 0, float(m), 2.0 * m, "x") for m in range(0, 20, 2)],
                  "unit_id bigint,timestamp_bin ts,failure int,Motor_current_avg double,load double,note string")
    bins.coalesce(1).write.parquet(source)
    names = ["load", "Motor_current_avg_lag1"]
    train = bins.selectExpr("load", "Motor_current_avg - 2 as Motor_current_avg_lag1", "Motor_current_avg as RUL_minutes")
    model = models.fit(train, names, models.forest(numTrees=2, maxDepth=3))
    live.score_bins(live.read_stream(spark, bins, source), model, names, out, new_path(spark, "test-narrow-progress"), {})
    assert seen == [["unit_id", "timestamp_bin", "Motor_current_avg", "load"]]
    got = {(r["load"], r["Motor_current_avg_lag1"]) for r in spark.read.parquet(out).collect()}
    assert got == {(2.0 * m, float(max(m - 2, 0))) for m in range(0, 20, 2)}


def test_open_bins_wait_on_disk(spark):
    before = spark.conf.get(keyed.STORE)
    first = series(spark, [(0, 1, 1, 0, 0, 1.0)], "timestamp ts,unit_id bigint,COMP int,MPG int,LPS int,Motor_current double")
    source = new_path(spark, "test-store")
    first.write.parquet(source)
    spark.conf.unset(keyed.STORE)
    try:
        live.live_bins(live.read_stream(spark, first, source))
        assert spark.conf.get(keyed.STORE) == keyed.ROCKS
    finally:
        spark.conf.set(keyed.STORE, before)


def test_uneven_train_parts_become_even_and_one_part_stays(spark):
    path = new_path(spark, "test-uneven")
    for n, rows in enumerate([5000, 10, 10]):
        spark.range(rows).selectExpr("id * 3 + 1 as id").coalesce(1).write.parquet(f"{path}/k={n}")
    sizes = lambda df: df.rdd.glom().map(len).collect()
    uneven = spark.read.parquet(path).drop("k").repartitionByRange(3, "id")
    cores = spark.sparkContext.defaultParallelism
    even = sizes(models.evenly(uneven))
    assert sum(even) == 5020 and len(even) == cores and max(even) - min(even) <= cores
    one = uneven.coalesce(1)
    assert models.evenly(one) is one


def test_remembered_node_ids_change_no_tree(spark):
    rows = spark.range(300).selectExpr("cast((id * 37) % 101 as double) as a", "cast((id * 53) % 17 as double) as b",
                                       "cast((id * 29) % 97 as double) as RUL_minutes").coalesce(1)
    plain, remembered = (models.fit(rows, ["a", "b"], models.forest(numTrees=5, maxDepth=6, cacheNodeIds=c)) for c in (False, True))
    assert plain.stages[-1].toDebugString.split("\n")[1:] == remembered.stages[-1].toDebugString.split("\n")[1:]
