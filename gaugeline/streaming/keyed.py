"""State kept per unit on streams: the last failure, the newest bins.

State lives in the store of the stream's checkpoint, is committed with each batch and read only for units
with fresh rows, so a batch costs what is new in it, and a restart goes on from the committed state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.timebins import at_second
from ..session import importable

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLICE = 10_000
HELD = 1_000  # bins kept beyond those wanted before the older ones are dropped


def prepare(spark: SparkSession) -> None:
    """State of arbitrary processors needs the store with column families; a running stream keeps the one it began with."""
    spark.conf.set(STORE, ROCKS)
    importable(spark)


class SinceFailure(StatefulProcessor):
    """Seconds of a unit's new bins against its last failure at or before them.

    State is the second of the last failure and never falls: a late failure older than it changes nothing
    for later batches, and a late bin is measured only against failures at or before it. Rows of a
    batch come in any order. Their failures (one number each) must be known before the first row can be
    answered; the rows themselves wait in the state store, so that two frames at most are in memory.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "second bigint")
        self.waiting = handle.getListState("waiting", "second bigint, failure int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.get()
        marks = [np.array([] if known is None else [known[0]], dtype="int64")]
        held, spilled = None, False
        for frame in rows:
            frame = frame[["second", "failure"]]
            marks.append(frame.loc[frame["failure"] == 1, "second"].to_numpy("int64"))
            if held is not None:
                self.waiting.appendList(list(zip(held["second"].tolist(), held["failure"].tolist())))
                spilled = True
            held = frame
        failures = np.unique(np.concatenate(marks))
        if spilled:
            stored = self.waiting.get()
            while part := list(islice(stored, SLICE)):
                yield self._measured(key, pd.DataFrame(part, columns=["second", "failure"]), failures)
            self.waiting.clear()
        if held is not None:
            yield self._measured(key, held, failures)
        if len(failures):
            self.last.update((int(failures[-1]),))

    @staticmethod
    def _measured(key: tuple, frame: pd.DataFrame, failures: np.ndarray) -> pd.DataFrame:
        second = frame["second"].to_numpy("int64")
        place = np.searchsorted(failures, second, side="right") - 1
        since = np.full(len(second), np.nan)
        found = place >= 0
        since[found] = (second[found] - failures[place[found]]) / 60.0
        return pd.DataFrame({
            "unit": key[0], "second": second, "failure": frame["failure"].to_numpy("int32"),
            "minutes_since_last_failure": since,
        })

    def close(self) -> None:
        pass


class NewestBins(StatefulProcessor):
    """A unit's fresh bins, preceded by the newest `rows_back` bins of earlier batches (`fresh` false).

    Works on rows, not frames: a unit has few bins in a batch, and a frame costs more than all of them. What a unit
    gives out in one batch is in memory at once: bins, so bounded by the span of the log, not by its readings.
    Of bins of one time the later come last.
    """

    def __init__(self, parts: Sequence[str], rows_back: int, idle_ms: int | None) -> None:
        self.parts, self.rows_back, self.idle_ms = list(parts), rows_back, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState("newest", "second bigint, payload string", self.idle_ms)
        self.out = Row(*self.parts, "second", "payload", "fresh")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = list(self.newest.get())
        for second, payload in kept:
            yield self.out(*key, second, payload, False)
        for row in rows:
            yield self.out(*key, row["second"], row["payload"], True)
            kept.append((row["second"], row["payload"]))
            if len(kept) > self.rows_back + HELD:
                kept = self._latest(kept)
        self.newest.put(self._latest(kept))

    def _latest(self, kept: list[tuple]) -> list[tuple]:
        return sorted(kept, key=itemgetter(0))[max(len(kept) - self.rows_back, 0):]

    def close(self) -> None:
        pass


def since_failure(bins: DataFrame, ts: str, unit: str) -> DataFrame:
    """(unit, ts, failure, minutes_since_last_failure) of a stream of finished bins; NULL before a unit's first failure.

    Bins without a time are left out; a NULL failure flag counts as none.
    """
    prepare(bins.sparkSession)
    narrow = bins.filter(F.col(ts).isNotNull()).select(
        F.col(unit).alias("unit"), F.unix_timestamp(ts).alias("second"),
        F.coalesce("failure", F.lit(0)).cast("int").alias("failure"))
    shape = T.StructType([
        T.StructField("unit", narrow.schema["unit"].dataType), T.StructField("second", T.LongType()),
        T.StructField("failure", T.IntegerType()), T.StructField("minutes_since_last_failure", T.DoubleType()),
    ])
    out = narrow.groupBy("unit").transformWithStateInPandas(SinceFailure(), shape, "append", "None")
    return out.select(F.col("unit").alias(unit), at_second(F.col("second")).alias(ts), "failure", "minutes_since_last_failure")


def with_newest(stream: DataFrame, parts: Sequence[str], ts: str, rows_back: int, idle_ms: int | None = None) -> DataFrame:
    """The stream's rows with `_fresh` true, and before them the newest earlier rows of the units that have any.

    Rows travel as JSON beside their keys and time, so columns of every type keep NULL and NaN apart. With
    `idle_ms` a unit's rows are dropped after that many milliseconds without a fresh one.
    """
    prepare(stream.sparkSession)
    carried = T.StructType([f for f in stream.schema.fields if f.name not in (*parts, ts)])
    exact = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    narrow = stream.filter(F.col(ts).isNotNull()).select(
        *parts, F.unix_timestamp(ts).alias("second"),
        F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in carried.fields]), exact).alias("payload"))
    shape = T.StructType([
        *[T.StructField(p, stream.schema[p].dataType) for p in parts], T.StructField("second", T.LongType()),
        T.StructField("payload", T.StringType()), T.StructField("fresh", T.BooleanType()),
    ])
    mode = "None" if idle_ms is None else "ProcessingTime"
    out = narrow.groupBy(*parts).transformWithState(NewestBins(parts, rows_back, idle_ms), shape, "append", mode)
    back = out.withColumn("_row", F.from_json("payload", carried, exact)).withColumn(ts, at_second(F.col("second")))
    return back.select(*[F.col(f"_row.`{n}`").alias(n) if n in carried.names else F.col(n) for n in stream.columns],
                       F.col("fresh").alias("_fresh"))
