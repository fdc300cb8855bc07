"""Numbering and running sums over a whole table without putting it through one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.session import materialize

PARTITION = "_range_part"
HASH_BUCKET = 65_536


def top_ranked(counts: DataFrame, k: int, count: str, key: str, out: str = "id") -> DataFrame:
    """The ``k`` keys of greatest count, numbered from 0; ties go by key.

    A histogram of the counts gives the lowest count that can still be among the first ``k``.
    Only rows reaching it are sorted, so the final sort sees about ``k`` rows however many keys
    there are. The counts are written once, or both passes would count the corpus.
    """
    counts = materialize(counts, "counts")
    histogram = counts.groupBy(F.col(count).alias("_c")).agg(F.count("*").alias("_n"))
    running = Window.orderBy(F.col("_c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    floor = (
        histogram.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .filter(F.col("_before") < k)
        .agg(F.min("_c"))
    )
    first = (
        counts.filter(F.col(count) >= floor.scalar())
        .orderBy(F.col(count).desc(), F.col(key))
        .limit(k)
    )
    order = Window.orderBy(F.col(count).desc(), F.col(key))
    return first.withColumn(out, (F.row_number().over(order) - 1).cast("bigint"))


def with_prefix(df: DataFrame, order: list[Column], running: dict[str, tuple[str, str]]) -> DataFrame:
    """Add running totals along a total order, each row seeing the rows before it only.

    ``running`` maps an output name to ``("sum", column)`` or ``("max", column)``; before the
    first row a sum is 0 and a maximum NULL. Rows are range-partitioned and sorted, each
    partition runs up its own totals as a stream, and the partition totals - one row per
    partition - complete them. The sorted rows are written once in between, since the range
    bounds must be the same for both readers.
    """
    def kind(column: str) -> T.DataType:
        return T.DoubleType() if isinstance(df.schema[column].dataType, T.DoubleType) else T.LongType()

    schema = T.StructType(
        df.schema.fields
        + [T.StructField(PARTITION, T.LongType())]
        + [T.StructField(name, kind(column)) for name, (_, column) in running.items()]
    )
    jobs = [(op, column, to_arrow_type(kind(column))) for op, column in running.values()]

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        carry = [pa.scalar(0 if op == "sum" else None, dtype) for op, _, dtype in jobs]
        for batch in batches:
            out = list(batch.columns) + [pa.array([part] * batch.num_rows, pa.int64())]
            for i, (op, name, dtype) in enumerate(jobs):
                values = batch.column(batch.schema.get_field_index(name)).cast(dtype)
                start = pa.array([carry[i].as_py()], dtype)
                chain = pa.concat_arrays([start, values])
                if op == "sum":
                    totals = pc.cumulative_sum(chain)
                else:
                    totals = pc.cumulative_max(chain, skip_nulls=True)
                out.append(totals.slice(0, batch.num_rows))
                carry[i] = totals[batch.num_rows]
                if not carry[i].is_valid:
                    carry[i] = pa.scalar(None, dtype)
            yield pa.RecordBatch.from_arrays(out, names=batch.schema.names + [PARTITION] + list(running))

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(ranged.mapInArrow(accumulate, schema), "prefix")
    whole = {"sum": F.sum, "max": F.max}
    totals = local.groupBy(PARTITION).agg(
        *[whole[op](column).alias(f"_t_{name}") for name, (op, column) in running.items()]
    )
    before = Window.orderBy(PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        PARTITION,
        *[whole[op](f"_t_{name}").over(before).alias(f"_s_{name}") for name, (op, _) in running.items()],
    )

    def complete(name: str, op: str, column: str) -> Column:
        if op == "max":
            return F.greatest(name, f"_s_{name}").alias(name)
        return (F.col(name) + F.coalesce(F.col(f"_s_{name}"), F.lit(0))).cast(kind(column)).alias(name)

    shifted = local.join(F.broadcast(shifts), PARTITION)
    return shifted.select(*df.columns, *[complete(n, op, c) for n, (op, c) in running.items()])


def with_prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Running sums (exclusive) along a total order; ``sums`` maps output names to columns."""
    return with_prefix(df, order, {name: ("sum", column) for name, column in sums.items()})


def with_row_number(df: DataFrame, order: list[Column], out: str = "row_no") -> DataFrame:
    """Add a zero-based number along a total order of the whole table."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return with_prefix_sums(counted, order, {out: "_one"}).drop("_one")


def with_hash_order(
    df: DataFrame, digest: Column, out: str = "row_no", within: list[str] | None = None, width: int | None = None
) -> DataFrame:
    """Number rows from 0 in the order of a unique hexadecimal digest, apart per ``within``.

    Digests are uniform, so their first ``width`` digits cut the order into 16^width even
    buckets, by default so many that a bucket holds about ``HASH_BUCKET`` rows. Buckets are numbered
    apart and shifted by the counts of the buckets before them.
    """
    group = within or []
    if width is None:
        rows, width = df.count(), 1
        while rows >> (4 * width) > HASH_BUCKET:
            width += 1
    marked = df.withColumn("_digest", digest).withColumn(
        "_bucket", F.substring("_digest", 1, width)
    )
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        marked.groupBy(*group, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy("_digest")
    return (
        marked.withColumn("_pos", F.row_number().over(inside) - 1)
        .join(shifts, [*group, "_bucket"])
        .withColumn(out, (F.col("_pos") + F.col("_shift")).cast("bigint"))
        .drop("_digest", "_bucket", "_pos", "_shift")
    )


def average_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``rank_<column>``: ranks from 1, tied values sharing the mean of their places."""
    out = df
    for column in columns:
        groups = df.groupBy(column).agg(F.count("*").alias("_n"))
        placed = with_prefix_sums(groups, [F.col(column)], {"_before": "_n"}).select(
            F.col(column).alias("_value"),
            (F.col("_before") + (F.col("_n") + 1) / 2).alias(f"rank_{column}"),
        )
        out = out.join(placed, out[column].eqNullSafe(placed["_value"])).drop("_value")
    return out
