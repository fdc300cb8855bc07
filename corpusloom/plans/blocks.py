"""Best matches by dot product between two vector tables, block by block.

The scores of a block of queries against a block of candidates are one matrix product. A task keeps one
running list of the best ``k`` per query, so it gives tasks x queries x k rows at most and the full
score matrix is never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.plans.lookup import small_table

MAX_SHIPPED = 20_000
BLOCK_ROWS = 50_000
SCORE_DIGITS = 9


Matches = tuple[np.ndarray, np.ndarray, np.ndarray]  # number of the query, candidate id, score


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a list column as they lie in its buffer."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.to_numpy(zero_copy_only=False)


def _first_k(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> Matches:
    """The ``k`` best rows of every query; ties go to the smaller candidate id."""
    order = np.lexsort((np.argsort(np.argsort(ids, kind="stable"), kind="stable"), -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    new = np.concatenate(([True], query[1:] != query[:-1])) if len(query) else np.empty(0, bool)
    place = np.arange(len(query)) - np.maximum.accumulate(np.where(new, np.arange(len(query)), 0))
    return query[place < k], ids[place < k], scores[place < k]


def _best(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Matches:
    """The ``k`` best of one block of candidates for every query, by the query's number."""
    if not len(ids) or not len(queries):
        return np.empty(0, np.int64), ids[:0], np.empty(0)
    parts = []
    step = max(1, 20_000_000 // len(ids))
    for at in range(0, len(queries), step):
        scores = np.round(queries[at : at + step] @ vectors.T, SCORE_DIGITS)
        if len(ids) > 4 * k:
            # Everything at least as good as the k-th best score, so ties are not lost.
            kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
            rows, cols = np.nonzero(scores >= kth)
        else:
            rows, cols = np.nonzero(np.ones_like(scores, dtype=bool))
        parts.append(_first_k(rows + at, ids[cols], scores[rows, cols], k))
    return tuple(np.concatenate(p) for p in zip(*parts))


def best_matches(queries: DataFrame, candidates: DataFrame, k: int, max_shipped: int = MAX_SHIPPED) -> DataFrame:
    """``(query_id, candidate_id, score, rank)`` with ranks 1 to ``k`` by descending dot product.

    ``queries`` has ``query_id, vec`` and ``candidates`` has ``candidate_id, vec``. A side of up to
    ``max_shipped`` rows is shipped to the other, which then does not move; candidates first, as each
    query is then settled where it lies. Beyond that both are cut into blocks, and each block meets
    each candidate block in a task of its own. All forms give the same rows.
    """
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("candidate_id", candidates.schema["candidate_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    queries, candidates = queries.select("query_id", "vec"), candidates.select("candidate_id", "vec")
    if (table := small_table(candidates, max_shipped)) is not None:
        partial = _candidates_shipped(queries, table, k, schema)
    elif (table := small_table(queries, max_shipped)) is not None:
        partial = _queries_shipped(candidates, table, k, schema)
    else:
        partial = _against_blocks(queries, candidates, k, schema)
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "candidate_id")
    return partial.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def _batch(schema: T.StructType, queries: np.ndarray, found: Matches) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    values = (queries[found[0]], found[1], found[2])
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)


def _candidates_shipped(queries: DataFrame, table: pa.Table, k: int, schema: T.StructType) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = _ids(shared.value.column(0)), _matrix(shared.value.column(1))
        for batch in batches:
            yield _batch(schema, _ids(batch.column(0)), _best(_matrix(batch.column(1)), ids, vectors, k))

    return queries.mapInArrow(score, schema)


def _queries_shipped(candidates: DataFrame, table: pa.Table, k: int, schema: T.StructType) -> DataFrame:
    shared = candidates.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, vectors = _ids(shared.value.column(0)), _matrix(shared.value.column(1))
        best = None
        for batch in batches:
            found = _best(vectors, _ids(batch.column(0)), _matrix(batch.column(1)), k)
            best = found if best is None else _first_k(*[np.concatenate(p) for p in zip(best, found)], k)
        if best is not None:
            yield _batch(schema, asked, best)

    return candidates.mapInArrow(score, schema)


def _against_blocks(queries: DataFrame, candidates: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    query_blocks = math.ceil(queries.count() / BLOCK_ROWS)
    candidate_blocks = math.ceil(candidates.count() / BLOCK_ROWS) or 1

    def block(column: str, count: int):
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = queries.select(
        "query_id", "vec", block("query_id", query_blocks).alias("qb"), every(candidate_blocks).alias("cb")
    )
    right = candidates.select(
        "candidate_id", "vec", block("candidate_id", candidate_blocks).alias("cb"), every(query_blocks).alias("qb")
    )

    def score(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return to_arrow_schema(schema).empty_table()
        found = _best(_matrix(q.column("vec")), _ids(c.column("candidate_id")), _matrix(c.column("vec")), k)
        return pa.Table.from_batches([_batch(schema, _ids(q.column("query_id")), found)])

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(score, schema)
