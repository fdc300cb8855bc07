"""Replace every element of an array column by its value in a keyed table.

This is the equi join behind encoding, scoring and re-tokenizing. Two physical forms exist, chosen
by a check of the table's size:

* a table of at most ``max_rows`` rows is shipped to the workers and rows are rewritten in place,
  an Arrow batch at a time and once per distinct element, so the corpus is never shuffled;
* a larger table meets blocks of rows (``map_blocks``): rows are dealt into blocks, a block asks for each distinct
  element once, and is worked on with what it found. A frequent element moves once per block, never with its rows.

``lookup_rows`` joins a long table whose rows stay rows; frequent keys are joined by broadcast there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20
HOT_KEYS = 10_000
BLOCK_ELEMENTS = 1 << 20
ROW_ELEMENTS = 8  # what a row weighs besides its elements
ELEMENTS_AT_ONCE = 1 << 19


def in_parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about ``ELEMENTS_AT_ONCE`` list elements of a column: a batch bounds rows, not what they hold."""
    for batch in batches:
        ends = np.cumsum(np.diff(np.asarray(batch.column(column).offsets).astype(np.int64)) + ROW_ELEMENTS)
        cuts = [0, *(np.flatnonzero(np.diff(ends // ELEMENTS_AT_ONCE)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def small_table(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> pa.Table | None:
    """The rows of ``df`` if there are at most ``max_rows`` of modest size, else None.

    Rows are counted before any is fetched; ``df`` should be cheap to read twice.
    """
    if df.limit(max_rows + 1).count() > max_rows:
        return None
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > MAX_BROADCAST_BYTES:
        return None
    return rows


def rewrite_lists(
    lists: pa.ListArray, fn: Callable[[Any], Any], value_type: pa.DataType, nested: bool
) -> pa.ListArray:
    """Apply ``fn`` to each element, once per distinct one, NULL being one of them.

    None drops the element. With ``nested``, ``fn`` gives a list that takes the element's place. A NULL
    list counts as empty.
    """
    offsets = np.asarray(lists.offsets)
    flat = lists.flatten().dictionary_encode(null_encoding="encode")
    indices = np.asarray(flat.indices)
    offsets = offsets - offsets[0]
    mapped = [fn(word) for word in flat.dictionary.to_pylist()]
    if nested:
        sizes = np.array([len(m) if m else 0 for m in mapped], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[indices])]) if len(indices) else np.zeros(1, int)
        pieces = pa.array(mapped, pa.list_(value_type)).take(pa.array(indices)).flatten()
        return pa.ListArray.from_arrays(pa.array(ends[offsets], pa.int32()), pieces)
    values = pa.array(mapped, value_type).take(pa.array(indices))
    kept = np.concatenate([[0], np.cumsum(np.asarray(values.is_valid()))]) if len(indices) else np.zeros(1, int)
    return pa.ListArray.from_arrays(pa.array(kept[offsets], pa.int32()), values.drop_null())


def map_elements(
    df: DataFrame,
    column: str,
    out: str,
    element: T.DataType,
    make_fn: Callable[[], Callable[[Any], Any]],
    nested: bool = False,
) -> DataFrame:
    """Add ``out``: the array ``column`` rewritten by the function that ``make_fn`` builds.

    ``make_fn`` runs once per task; the frame's other columns pass through untouched.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(element))])
    value_type, at = to_arrow_type(element), df.columns.index(column)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make_fn()
        for batch in in_parts(batches, at):
            lists = batch.column(at)
            done = rewrite_lists(lists, fn, value_type, nested)
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [done], names=batch.schema.names + [out]
            )

    return df.mapInArrow(rewrite, schema)


def _mapping(words: list, values: list) -> dict:
    """The least value of each key; NULL is neither."""
    mapping: dict = {}
    for word, found in zip(words, values):
        if found is not None and (word not in mapping or found < mapping[word]):
            mapping[word] = found
    mapping.pop(None, None)
    return mapping


def _shipped(spark: SparkSession, rows: pa.Table, key: str, value: str, default: Any):
    shared = spark.sparkContext.broadcast(rows.select([key, value]))

    def make() -> Callable[[Any], Any]:
        mapping = _mapping(*[c.to_pylist() for c in shared.value.columns])
        return lambda word: mapping.get(word, default)

    return make


def lookup_array(
    df: DataFrame,
    column: str,
    out: str,
    table: DataFrame,
    key: str,
    value: str,
    row_key: list[str],
    default: Any = None,
    weight: str | None = None,
    nested: bool = False,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out``: the elements of ``column`` looked up in ``table``.

    Elements without an entry, NULL elements and entries of value NULL become ``default``; with None they
    drop out and positions close up. Of several entries for a key the least value counts. A NULL
    array gives an empty one. ``row_key`` names columns that tell the rows of ``df`` apart; in the second form rows that share
    a key, or lack one, are joined by it (``_joined``). ``weight`` is the table's column telling how often a key occurs.
    Rows that carry ``_block`` (``in_blocks``) are taken as stored. Both forms give the same columns in the same order.
    """
    rows = small_table(table.select(key, value), max_rows)
    element = table.schema[value].dataType
    inner = element.elementType if nested else element
    if rows is not None:
        make = _shipped(df.sparkSession, rows, key, value, default)
        return map_elements(df, column, out, inner, make, nested)

    single = table.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(
        F.min(value).alias(value), *([F.max(weight).alias(weight)] if weight and weight not in (key, value) else [])
    )
    value_type = to_arrow_type(inner)

    def fill(lists: pa.ListArray, found: pa.Table) -> list[pa.Array]:
        mapping = dict(zip(*[c.to_pylist() for c in found.columns]))
        return [rewrite_lists(lists, lambda word: mapping.get(word, default), value_type, nested)]

    names = [c for c in df.columns if c != "_block"]
    blocked = df if "_block" in df.columns else materialize(in_blocks(df, F.size(column)), "blocks")
    unclear = F.col("_n") > 1
    for k in row_key:
        unclear = unclear | F.col(k).isNull()
    keys = materialize(blocked.groupBy(*row_key).agg(F.count("*").alias("_n")).filter(unclear).select(*row_key), "repeated")
    fields = [T.StructField(out, T.ArrayType(inner))]
    if keys.isEmpty():
        return map_blocks(blocked, column, single, key, value, fill, fields, added=False)
    left, right = blocked.alias("l"), keys.alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in row_key]
    alone = map_blocks(left.join(right, same, "left_anti"), column, single, key, value, fill, fields, added=False)
    shared = left.join(right, same, "left_semi").select(*names)
    return alone.unionByName(_joined(shared, column, out, single, key, value, row_key, default, weight, nested, element))


def _joined(
    df: DataFrame, column: str, out: str, single: DataFrame, key: str, value: str, row_key: list[str], default: Any,
    weight: str | None, nested: bool, element: T.DataType,
) -> DataFrame:
    """The form for rows that share a key: each has the elements of all of them, place by place; without a key it has none."""
    long = unnest(df, column, *row_key, value="_key", pos="_pos")
    found = lookup_rows(long, "_key", single, key, value, weight)
    if default is None:
        found = found.filter(F.col(value).isNotNull())
        filled = F.col(value)
    else:
        missing = F.array(*[F.lit(d) for d in default]) if nested else F.lit(default)
        filled = F.coalesce(F.col(value), missing)
    ordered = F.sort_array(F.collect_list(F.struct("_pos", filled.alias("_v"))))
    arrays = found.groupBy(*row_key).agg(F.transform(ordered, lambda e: e["_v"]).alias(out))
    joined = df.join(arrays, row_key, "left")
    empty = F.array().cast(T.ArrayType(element))
    whole = joined.withColumn(out, F.coalesce(out, empty))
    return (whole.withColumn(out, F.flatten(out)) if nested else whole).select(*df.columns, out)


def in_blocks(df: DataFrame, size: Column, elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """The rows with ``_block``, which neighbouring rows of about so many ``elements`` share; ``size`` tells a row's number of them.

    Blocks hang on the order of the rows: what reads them twice has to read them from a written table.
    """
    schema = T.StructType(df.schema.fields + [T.StructField("_block", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, before = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            sizes = batch.column(batch.num_columns - 1).to_numpy()
            ends = before + np.cumsum(sizes + ROW_ELEMENTS)
            blocks = first + np.concatenate([[before], ends[:-1]])[: len(ends)].astype(np.int64) // elements
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(blocks)], names=[*batch.schema.names[:-1], "_block"])

    known = F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("bigint")
    return df.withColumn("_size", known).mapInArrow(number, schema)


def _in_blocks(df: DataFrame, column: str, elements: int) -> DataFrame:
    return in_blocks(df, F.size(column), elements)


def map_blocks(
    df: DataFrame, column: str, table: DataFrame, key: str, value: str,
    fill: Callable[[pa.Array, pa.Table], list[pa.Array]], fields: list[T.StructField], elements: int | None = None,
    added: bool = True, size: Column | None = None, keys: Callable[[pa.Array], pa.Array] | None = None,
) -> DataFrame:
    """Add ``fields``: what ``fill`` makes of ``column`` and of the rows ``key, value`` of ``table`` that it asks for.

    Rows are dealt into blocks of about ``elements`` list elements. A block asks for each distinct element once, and only
    what it finds and the rows themselves move. A column without lists tells its ``size`` and the distinct ``keys`` of a
    stretch of it. Unless values are ``added`` up, a row of the table may come to a block twice.
    """
    carried = [c for c in df.columns if c != "_block"]
    blocked = df
    if "_block" not in df.columns:
        blocked = materialize(in_blocks(df, F.size(column) if size is None else size, elements or BLOCK_ELEMENTS), "blocks")
    asked = _distinct_elements(blocked, column, table.schema[key].dataType, keys or _elements)
    if added:  # several tasks may read a block; each tells what it sees there
        asked = asked.distinct()
    found = asked.join(table.select(F.col(key).alias("_key"), F.col(value).alias("_value")), "_key")
    names = [*carried, *[f.name for f in fields]]

    def work(rows: pa.Table, entries: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lists = rows.column(column).combine_chunks()
        return pa.table([*rows.select(carried).columns, *fill(lists, entries.select(["_key", "_value"]))], names=names)

    schema = T.StructType([blocked.schema[c] for c in carried] + fields)  # read tables allow NULLs everywhere
    return blocked.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(work, schema)


def _elements(lists: pa.ListArray) -> pa.Array:
    return pc.unique(lists.flatten())


def _distinct_elements(
    blocked: DataFrame, column: str, kind: T.DataType, keys: Callable[[pa.Array], pa.Array] = _elements
) -> DataFrame:
    """``_block, _key``: the elements of each block; a block that several tasks read may repeat some."""
    names = ["_block", "_key"]

    def rows(block: int, seen: list[pa.Array]) -> pa.RecordBatch:
        found = pc.unique(pa.chunked_array(seen)).drop_null()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), found], names=names)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, []
        for batch in batches:
            blocks, lists = batch.column(0).to_numpy(), batch.column(1)
            cuts = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(blocks)]):
                if blocks[a] != last and seen:
                    yield rows(last, seen)
                    seen = []
                last = blocks[a]
                seen.append(keys(lists.slice(a, b - a)))
        if seen:
            yield rows(last, seen)

    schema = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_key", kind)])
    return blocked.select("_block", F.col(column).alias("_list")).mapInArrow(collect, schema)


def lookup_rows(
    long: DataFrame,
    column: str,
    table: DataFrame,
    key: str,
    value: str,
    weight: str | None = None,
) -> DataFrame:
    """Left join of a long table with unbounded keys, safe against hot keys.

    The ``HOT_KEYS`` keys of greatest weight meet their rows by broadcast, the rest by shuffle. Without
    a ``weight`` in the table the keys of ``long`` are counted for it.
    """
    pairs = table.select(F.col(key).alias("_k"), F.col(value).alias(value))
    if weight is None:
        seen = long.groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("_w"))
        weighted = pairs.join(seen, "_k").select("_k", value, "_w")
    else:
        weighted = table.select(F.col(key).alias("_k"), F.col(value).alias(value), F.col(weight).alias("_w"))
    hot = weighted.orderBy(F.col("_w").desc(), "_k").limit(HOT_KEYS).drop("_w")
    hot = hot.withColumnRenamed(value, "_hot").withColumn("_is_hot", F.lit(True))
    first = long.join(F.broadcast(hot), F.col(column) == F.col("_k"), "left").drop("_k")
    # A null join key never meets the shuffled side, so rows already answered are spread by row.
    cold_key = F.when(F.col("_is_hot").isNull(), F.col(column))
    return (
        first.withColumn("_cold", cold_key)
        .join(pairs, F.col("_cold") == F.col("_k"), "left")
        .withColumn(value, F.coalesce("_hot", value))
        .drop("_k", "_cold", "_hot", "_is_hot")
    )
