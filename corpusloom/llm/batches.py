"""Arrow batches through a plain function, for the operators that need Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Columns = list[list]
SLICE_BYTES = 4e6


def slices(batch: pa.RecordBatch | pa.Array) -> Iterator[pa.RecordBatch | pa.Array]:
    """Parts of a batch of bounded bytes: long texts make large batches."""
    rows = len(batch)
    step = max(1, min(rows, int(rows * SLICE_BYTES / max(batch.nbytes, 1))))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def text_function(work: Callable[[list], Columns], schema: str) -> Callable[[str], Column]:
    """A struct column of ``schema`` from a text column; the other columns of the row stay in Spark.

    ``work`` gets the texts of a slice as a list and returns the fields as lists. The function is marked
    as not deterministic, so that it is not evaluated a second time in a filter on its result.
    """
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(texts: pa.Array) -> pa.Array:
        parts = [work(part.to_pylist()) for part in slices(texts)]
        fields = [pa.array([v for part in parts for v in part[i]], f.type) for i, f in enumerate(arrow)]
        return pa.StructArray.from_arrays(fields, fields=list(arrow))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind).asNondeterministic()


def map_batches(df: DataFrame, schema: str, setup: Callable[[], Callable[..., Columns]]) -> DataFrame:
    """Rows of ``df`` through ``setup()``, which runs once in every task.

    The function it returns gets the columns of a batch as Python lists and returns the columns of
    ``schema`` as lists. Nothing is kept between batches, so a task needs the memory of one.
    """
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup()
        for batch in batches:
            for part in slices(batch):
                columns = work(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, f.type) for values, f in zip(columns, arrow)], schema=arrow
                )

    return df.mapInArrow(run, kind)
