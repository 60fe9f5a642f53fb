import glob
import os
import random

import pytest
from gaugeline.plans import incremental
from gaugeline.plans.etl import rul_features
from gaugeline.session import new_path
from helpers import same, series
from pyspark.sql import functions as F

DAY = 1440
SCHEMA = "timestamp ts,unit_id bigint,COMP int,MPG int,LPS int,Motor_current double,gpsLat double,gpsLong double"


def log(spark, rows):
    return series(spark, [(m, u, 0 if f else 1, 0, 0, v, 41.0, -8.0) for m, u, f, v in rows], SCHEMA)


def made(days=range(12), seed=5):
    """Two units and one without a number; unit 2 fails once, the last one never, some days are nearly empty."""
    rng = random.Random(seed)
    rows = []
    for d in days:
        for u, n in ((1, 40), (2, 3 if d % 3 else 25), (None, 2)):
            for _ in range(n):
                rows.append((d * DAY + rng.randrange(DAY), u, int(u == 1 and rng.random() < 0.01 or u == 2 and d == 6 and rng.random() < 0.2), rng.random()))
    return rows


def files(target, table="features"):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{target.removeprefix('file:')}/{table}/*/*.parquet")}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), str(r[1])))


@pytest.mark.parametrize("parts", [["unit_id"], []])
def test_a_late_day_gives_the_full_runs_result(spark, parts):
    rows = made()
    late = 5
    early = [r for r in rows if not (r[0] // DAY == late and r[0] % DAY > 600)]
    early += [(late * DAY + 5, 1, 1, 1.0)]  # a failure that the complete day does not hold
    target = new_path(spark, "store")
    incremental.update_features(log(spark, early), target, 60, 240, parts)
    assert rows_of(incremental.read_store(spark, target)) == rows_of(rul_features(log(spark, early), 60, 240, parts))
    before = files(target)
    changed = incremental.update_features(log(spark, [r for r in rows if r[0] // DAY == late]), target, 60, 240, parts)
    full = rul_features(log(spark, rows), 60, 240, parts)
    got = incremental.read_store(spark, target)
    assert got.columns == full.columns
    same(rows_of(got), rows_of(full))
    # Folders of days that did not change are the very files of before.
    after, named = files(target), {f"bin_date={d}" for d in changed}
    kept = {f for f in before if os.path.basename(os.path.dirname(f)) not in named}
    assert kept and all(after.get(f) == before[f] for f in kept) and len(named) < 12
    # The same day again changes nothing but itself and what its bins reach.
    again = incremental.update_features(log(spark, [r for r in rows if r[0] // DAY == late]), target, 60, 240, parts)
    same(rows_of(incremental.read_store(spark, target)), rows_of(full))
    assert set(again) <= set(changed)


def test_days_one_by_one_in_any_order(spark):
    rows = made(range(5), seed=8)
    target = new_path(spark, "store")
    for d in (3, 0, 4, 2, 1):
        incremental.update_features(log(spark, [r for r in rows if r[0] // DAY == d]), target, 60, 240, ["unit_id"])
    same(rows_of(incremental.read_store(spark, target)), rows_of(rul_features(log(spark, rows), 60, 240, ["unit_id"])))
    assert incremental.update_features(log(spark, rows).filter(F.lit(False)), target, 60, 240, ["unit_id"]) == []


def test_a_broken_run_is_repeated(spark, monkeypatch):
    rows = made(range(6), seed=9)
    target = new_path(spark, "store")
    incremental.update_features(log(spark, [r for r in rows if r[0] // DAY != 2]), target, 60, 240, ["unit_id"])
    write, day = incremental._replace_days, log(spark, [r for r in rows if r[0] // DAY == 2])

    def broken(df, path):
        if path.endswith("/days"):
            raise RuntimeError("lost")
        write(df, path)

    monkeypatch.setattr(incremental, "_replace_days", broken)
    with pytest.raises(RuntimeError):
        incremental.update_features(day, target, 60, 240, ["unit_id"])
    monkeypatch.setattr(incremental, "_replace_days", write)
    incremental.update_features(day, target, 60, 240, ["unit_id"])
    same(rows_of(incremental.read_store(spark, target)), rows_of(rul_features(log(spark, rows), 60, 240, ["unit_id"])))
