"""Arrow batches in and out of the Python operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import importable


def by_batch(df: DataFrame, make: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply `make` to the columns of each Arrow batch as Python lists; bounded by the batch size."""
    importable(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                made = make(batch.slice(at, 500).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)
    return df.mapInArrow(run, schema)


def kept_rows(df: DataFrame, test: Callable[[list], list[bool]], column: str) -> DataFrame:
    """Rows whose value of `column` passes `test`, given as a list per batch; all columns stay as they are."""
    importable(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                yield part.filter(pa.array(test(part.column(at).to_pylist()), pa.bool_()))
    plain = df.toDF(*[f"c{n}" for n in range(len(df.columns))])  # names with dots cannot be passed on
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)
