"""Rolling, lag and delta features, and sequence windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions.numeric import zero_if_missing
from ..schema import KEY_SIGNALS
from .ordered import BLOCK_ROWS, with_halo, with_time_halo


def frame_rows(roll_minutes: int = 30, bin_minutes: int = 2) -> int:
    """Whole bins in the rolling span without the current one; a frame has one row at least."""
    bins_in_span = roll_minutes // bin_minutes if bin_minutes > 1 else int(roll_minutes)
    return bins_in_span - 1 if bins_in_span > 2 else 1


def rolling_features(
    bins: DataFrame,
    rows_back: int = 14,
    roll_minutes: int = 30,
    parts: Sequence[str] = (),
    position: str = "pos",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rolling mean and std over the preceding rows, lag 1, and change since the lag.

    Missing results are 0, also where a NULL inside the series causes them.
    """
    build = rolling_columns(bins, rows_back, roll_minutes)
    return with_halo(bins, position, rows_back, build, parts, block_rows)


def rolling_columns(
    bins: DataFrame, rows_back: int, roll_minutes: int,
) -> Callable[[WindowSpec], list[Column]]:
    """The expressions of `rolling_features` for a given ordered window."""
    bases = [c for c in KEY_SIGNALS if c in bins.columns]

    def build(window: WindowSpec) -> list[Column]:
        frame = window.rowsBetween(-rows_back, -1)
        out = []
        for base in bases:
            value = F.col(base)
            previous = F.lag(value, 1).over(window)
            out += [
                zero_if_missing(F.avg(value).over(frame)).alias(f"{base}_roll_mean_{roll_minutes}m"),
                zero_if_missing(F.stddev(value).over(frame)).alias(f"{base}_roll_std_{roll_minutes}m"),
                zero_if_missing(previous).alias(f"{base}_lag1"),
                zero_if_missing(value - previous).alias(f"{base}_delta"),
            ]
        return out

    return build


def time_range_rolling(
    bins: DataFrame,
    columns: Sequence[str],
    span_minutes: int = 30,
    parts: Sequence[str] = (),
    ts: str = "timestamp_bin",
) -> DataFrame:
    """Mean, std, variance and RMS over the preceding wall-clock span, current row excluded.

    Unlike row frames, a gap in the series shortens the frame instead of stretching it.
    """
    span = span_minutes * 60

    def build(window: WindowSpec) -> list[Column]:
        frame = window.rangeBetween(-span, -1)
        out = []
        for c in columns:
            value = F.col(c)
            out += [
                F.avg(value).over(frame).alias(f"{c}_range_mean"),
                F.stddev(value).over(frame).alias(f"{c}_range_std"),
                F.var_samp(value).over(frame).alias(f"{c}_range_var"),
                F.sqrt(F.avg(value * value).over(frame)).alias(f"{c}_range_rms"),
            ]
        return out

    return with_time_halo(bins, F.unix_timestamp(ts), span, build, parts)


def sequence_windows(
    rows: DataFrame,
    features: Sequence[str],
    length: int = 30,
    position: str = "pos",
    parts: Sequence[str] = (),
    out: str = "sequence",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`out`: the `length` feature rows before each target row, oldest first.

    The target row is not part of its own window; the first `length` rows have
    no full window and are left out.
    """
    step = F.array(*[F.col(c).cast("double") for c in features])

    def build(window: WindowSpec) -> list[Column]:
        return [F.collect_list(step).over(window.rowsBetween(-length, -1)).alias(out)]

    windowed = with_halo(rows, position, length, build, parts, block_rows)
    return windowed.filter(F.col(position) >= length)
