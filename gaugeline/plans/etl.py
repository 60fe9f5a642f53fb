"""Raw log to feature table.

    python -m gaugeline.plans.etl --input log.csv --output features
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.bins import bin_readings
from ..operators.clean import prepare_readings
from ..operators.features import frame_rows, rolling_features
from ..operators.ordered import BLOCK_ROWS
from ..operators.rul import add_failure_times, add_rul
from ..session import build_session, stage
from ..sources import read_sensor_csv, read_table, write_features

FAILURE_COLUMNS = [
    "next_failure_time", "last_failure_time", "RUL_minutes", "minutes_since_last_failure",
]


def binned_log(
    readings: DataFrame, bin_minutes: int = 2, parts: Sequence[str] = (), require_gps: bool = True,
) -> DataFrame:
    """Cleaned and binned readings, written once: the only pass over the raw log."""
    return stage(bin_readings(prepare_readings(readings, require_gps), bin_minutes, parts), "bins")


def labelled_bins(
    readings: DataFrame, bin_minutes: int = 2, parts: Sequence[str] = (), require_gps: bool = True,
    rul_cap: float | None = None,
) -> DataFrame:
    """Bins with failure times and remaining life; no rolling features."""
    bins = binned_log(readings, bin_minutes, parts, require_gps)
    return add_rul(add_failure_times(bins, parts, position=None), cap_minutes=rul_cap)


def rul_features(
    readings: DataFrame,
    bin_minutes: int = 2,
    roll_minutes: int = 30,
    parts: Sequence[str] = (),
    require_gps: bool = True,
    rows_back: int | None = None,
    rul_cap: float | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The whole feature table: bin statistics, rolling, lag and delta features, remaining life.

    `parts` makes one series per unit (or any other key); empty, all readings
    form one. `rows_back` overrides the frame derived from the two spans. Series of
    every length are cut into the same chunks.
    """
    bins = binned_log(readings, bin_minutes, parts, require_gps)
    back = frame_rows(roll_minutes, bin_minutes) if rows_back is None else rows_back
    timed = add_failure_times(bins, parts)
    rolled = rolling_features(timed, back, roll_minutes, parts, block_rows=block_rows)
    full = add_rul(rolled, cap_minutes=rul_cap)
    lead = [c for c in full.columns if c not in FAILURE_COLUMNS and c != "pos"]
    return full.select(*lead, *FAILURE_COLUMNS)


def run_etl(
    spark: SparkSession, input_path: str, output_path: str, bin_minutes: int = 2,
    roll_minutes: int = 30, parts: Sequence[str] = (), infer: bool = False,
) -> DataFrame:
    """Read a CSV (or parquet) log, write the feature table by day, return what was written."""
    if input_path.lower().endswith((".parquet", ".pq")):
        readings = read_table(spark, input_path)
    else:
        readings = read_sensor_csv(spark, input_path, infer=infer)
    write_features(rul_features(readings, bin_minutes, roll_minutes, parts), output_path)
    return spark.read.parquet(output_path).drop("bin_date")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Sensor log to feature table")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--bin-minutes", type=int, default=2)
    parser.add_argument("--roll-minutes", type=int, default=30)
    parser.add_argument("--unit-column", default=None, help="one series per value of this column")
    args = parser.parse_args(argv)
    parts = [args.unit_column] if args.unit_column else []
    out = run_etl(build_session(), args.input, args.output, args.bin_minutes, args.roll_minutes, parts)
    out.printSchema()
    print(f"{out.count()} rows, {len(out.columns)} columns in {args.output}")


if __name__ == "__main__":
    main()
