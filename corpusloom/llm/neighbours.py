"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a bounded sample, halved again and again at the median, so that lists are even. A
vector goes to its nearest centroid and, near a boundary, to further ones whose distance is within a
ratio of the nearest. A query reads the lists whose distance is within another ratio, which is
calibrated on the sample for a wanted recall. Both find their centroids by a best-first walk over an
in-memory graph of them. Centroids and graph are bounded by ``MOST_LISTS`` and shipped whole.

Equal vectors are one posting that carries its least ids, so a vector that fills a third of the table
costs one row. Long lists are dealt into blocks; a query visits every block of its lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import dot, norm
from corpusloom.session import materialize

SAMPLE = 16_384
MOST_LISTS = 1024
LIST_ROWS = 400
REPLICAS = 6
BOUNDARY_RATIO = 1.12
WANTED_RECALL = 0.98
DEGREE = 16
BLOCK_ROWS = 4096
SEED = 7
ROUNDING = 1e-12
PAIRS = 65_536


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of an Arrow list column in double precision; shorter ones are filled with zeros."""
    offsets = np.asarray(column.offsets) if hasattr(column, "offsets") else None
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets) if offsets is not None else np.full(len(column), dim)
    if len(sizes) and (sizes == dim).all():
        rows = flat.reshape(-1, dim)
    else:
        rows = np.zeros((len(sizes), dim))
        rows[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    # Scaling by the largest component first keeps the squares of huge and tiny vectors finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    """Centroids, their neighbour graph and the ratio that prunes the lists of a query."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    query_ratio: float

    def distances(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Euclidean distances of each row to the centroids ``ids`` of that row."""
        inner = np.einsum("qd,qkd->qk", rows, self.centroids[ids])
        squares = np.einsum("cd,cd->c", self.centroids, self.centroids)[ids]
        return np.sqrt(np.maximum(1.0 + squares - 2.0 * inner, 1e-12))

    def walk(self, rows: np.ndarray, ratio: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids in order of distance, ``(ids, distances)``, unreached ones at infinity.

        Best first: the nearest centroid not yet expanded gives its neighbours. A row is done when its
        nearest unexpanded centroid lies outside ``ratio`` of the nearest found and beyond its ``least``
        nearest ones.
        """
        many, size = len(rows), len(self.centroids)
        found = np.full((many, size), np.inf)
        opened = np.zeros((many, size), bool)
        every = np.arange(many)
        start = np.tile(self.entries, (many, 1))
        found[every[:, None], start] = self.distances(rows, start)
        active = every
        while len(active):
            here = np.where(opened[active], np.inf, found[active])
            # Several nodes are opened in a step, nearest first.
            width = min(8, size)
            nodes = np.argpartition(here, width - 1, axis=1)[:, :width] if size > width else np.tile(np.arange(size), (len(active), 1))
            value = np.take_along_axis(here, nodes, axis=1)
            seen = found[active]
            enough = min(least, size) - 1
            bound = np.maximum(seen.min(axis=1) * ratio, np.partition(seen, enough, axis=1)[:, enough])
            useful = (value <= bound[:, None]) & np.isfinite(value)
            going = useful.any(axis=1)
            active, nodes, useful = active[going], nodes[going], useful[going]
            if not len(active):
                break
            row, column = np.nonzero(useful)
            query, node = active[row], nodes[row, column]
            opened[query, node] = True
            near = self.graph[node]
            fresh = ~np.isfinite(found[query[:, None], near])
            which, place = np.nonzero(fresh)
            if len(which):
                q, c = query[which], near[which, place]
                found[q, c] = self.distances(rows[q], c[:, None])[:, 0]
        order = np.argsort(found, axis=1, kind="stable")
        return order, np.take_along_axis(found, order, axis=1)

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, list)``: the nearest list and those within the boundary ratio, ``REPLICAS`` at most."""
        ids, distance = self.walk(rows, BOUNDARY_RATIO, REPLICAS)
        ids, distance = ids[:, :REPLICAS], distance[:, :REPLICAS]
        row, place = np.nonzero(distance <= distance[:, :1] * BOUNDARY_RATIO)
        return row, ids[row, place]

    def probe(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, list)``: the lists that a query reads."""
        ids, distance = self.walk(rows, self.query_ratio, 1)
        row, place = np.nonzero(distance <= distance[:, :1] * self.query_ratio)
        return row, ids[row, place]


def balanced_centroids(rows: np.ndarray, lists: int) -> np.ndarray:
    """Means of even parts: each part is cut at the median between its two centres."""
    rng = np.random.default_rng(SEED)
    parts = [rows]
    while len(parts) < lists and max(map(len, parts)) > 1:
        parts.sort(key=len, reverse=True)
        part = parts.pop(0)
        centres = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            side = part @ (centres[1] - centres[0])
            upper = side > np.median(side)
            if not upper.any() or upper.all():
                break
            centres = np.stack([part[~upper].mean(axis=0), part[upper].mean(axis=0)])
        order = np.argsort(part @ (centres[1] - centres[0]), kind="stable")
        half = len(part) // 2
        parts += [part[order[:half]], part[order[half:]]]
    means = np.stack([p.mean(axis=0) for p in parts])
    return means


def centroid_graph(centroids: np.ndarray) -> np.ndarray:
    """Nearest centroids of each centroid, and one ring through all so that every one is reached."""
    size = len(centroids)
    squares = (centroids ** 2).sum(axis=1)
    distance = squares[:, None] + squares[None, :] - 2.0 * centroids @ centroids.T
    near = np.argsort(distance, axis=1, kind="stable")[:, :min(DEGREE, size)]
    ring = np.roll(np.arange(size), -1)[:, None]
    return np.concatenate([near, ring], axis=1)


def build_index(rows: np.ndarray, count: int, k: int) -> Index:
    """An index for ``count`` vectors from a sample of unit ``rows``, calibrated on that sample."""
    lists = max(1, min(MOST_LISTS, len(rows) // 4, round(count / LIST_ROWS)))
    centroids = balanced_centroids(rows, lists)
    spread = np.unique(np.linspace(0, len(centroids) - 1, min(8, len(centroids))).astype(int))
    index = Index(centroids, centroid_graph(centroids), spread, 1.0)
    if len(centroids) == 1:
        return index
    held = np.zeros((len(rows), len(centroids)), bool)
    for start in range(0, len(rows), 2048):
        row, place = index.assign(rows[start:start + 2048])
        held[start + row, place] = True
    queries = np.random.default_rng(SEED).choice(len(rows), min(256, len(rows)), replace=False)
    inner = rows[queries] @ rows.T
    inner[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-inner, axis=1)[:, :k]
    distance = index.distances(rows[queries], np.tile(np.arange(len(centroids)), (len(queries), 1)))
    ratio = distance / distance.min(axis=1, keepdims=True)
    needed = [np.where(held[b], ratio[i], np.inf).min(axis=1) for i, b in enumerate(best)]
    return Index(centroids, index.graph, spread, float(np.quantile(np.concatenate(needed), WANTED_RECALL)) + 1e-9)


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, vec, vkey``: distinct rows with an id and a finite vector other than zero."""
    narrow = df.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    kept = narrow.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(good)
    return kept.withColumn("vkey", F.md5(F.array_join(F.col("vec").cast("array<string>"), ","))).dropDuplicates(["vec_id", "vkey"])


def _map(df: DataFrame, schema: str, index, dim: int, method: str) -> DataFrame:
    """``lst`` and the columns of ``df`` (``vkey, vec, least``) for every list that ``method`` names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = index.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                row, lists = getattr(book, method)(unit_rows(part.column(1), dim))
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *taken.columns], names=["lst", "vkey", "vec", "least"])

    return df.select("vkey", "vec", "least").mapInArrow(run, schema)


def plain_rows(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as they are; shorter ones are filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(sizes), dim))
    rows[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return rows


def nearest(
    query_units: np.ndarray, queries: np.ndarray, units: np.ndarray, rows: np.ndarray, least: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, candidate, cosine`` of the ``keep`` first candidates of every query, by cosine and then least id.

    All candidates within rounding of the last place are scored anew, with sums in the order of the
    components as everywhere else, so that no tie is cut before it is known to be one.
    """
    inner = query_units @ units.T
    some = min(keep, inner.shape[1])
    floor = np.partition(inner, inner.shape[1] - some, axis=1)[:, inner.shape[1] - some]
    query, candidate = np.nonzero(inner >= floor[:, None] - ROUNDING)
    sums = lambda a, b: np.cumsum(a * b, axis=1)[:, -1]  # noqa: E731  one after the other
    lengths = np.sqrt(sums(queries, queries)), np.sqrt(sums(rows, rows))
    exact = np.concatenate([
        sums(queries[query[at:at + PAIRS]], rows[candidate[at:at + PAIRS]]) for at in range(0, len(query), PAIRS)
    ]) / (lengths[0][query] * lengths[1][candidate])
    order = np.lexsort((least[candidate], -exact, query))
    query, candidate, exact = query[order], candidate[order], exact[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    first = place < keep
    return query[first], candidate[first], exact[first]


def search(
    df: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row that ``is_query`` picks.

    ``is_query`` maps the id column to a condition. The score is the cosine in double precision; ties go
    to the smaller id, and a query's own id is never its neighbour. Rows without an id, and vectors that
    are NULL, zero or hold a NULL, NaN or infinite component take no part; shorter vectors are filled
    with zeros. Repeated rows count once. With fewer than ``k`` candidates all are returned;
    an empty table gives an empty table.
    """
    spark = df.sparkSession
    rows = materialize(usable(df, id_column, vector_column), "vectors")
    first = Window.partitionBy("vkey").orderBy("vec_id")
    least = (
        rows.select("vkey", "vec_id").withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
        .groupBy("vkey").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    distinct = rows.groupBy("vkey").agg(F.first("vec").alias("vec"))
    classes = distinct.join(least, "vkey").withColumn("least", F.get("members", F.lit(0)).cast("bigint"))
    classes = materialize(classes, "classes")
    queries = rows.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), F.col("vkey").alias("qkey"))
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    facts = classes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    if not facts["n"]:
        return empty
    dim = facts["dim"]
    sample = classes.select("vec", "vkey").orderBy(F.xxhash64("vkey"), "vkey").limit(SAMPLE).select("vec").toArrow()
    sampled = np.concatenate([unit_rows(c, dim) for c in sample.column(0).chunks if len(c)])
    index = spark.sparkContext.broadcast(build_index(sampled, facts["n"], k))
    schema = "lst int, vkey string, vec array<double>, least bigint"
    postings = materialize(_map(classes, schema, index, dim, "assign"), "postings")
    asked = classes.join(queries.select(F.col("qkey").alias("vkey")).distinct(), "vkey", "left_semi")
    probes = _map(asked, schema, index, dim, "probe")
    # One row per list, MOST_LISTS at most.
    blocks = postings.groupBy("lst").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    sides = (
        postings.join(F.broadcast(blocks), "lst")
        .select("lst", F.pmod(F.xxhash64("vkey"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("side"), "vkey", "vec", "least")
    ).unionByName(
        probes.join(F.broadcast(blocks), "lst").select(
            "lst", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "vkey", "vec", "least"
        )
    )
    placed = sides.repartition("lst", "block").sortWithinPartitions("lst", "block", "side")
    # Classes in order of their score and least id: the first k + 1 hold the k + 1 first ids.
    keep = k + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, keys, held = None, [], []
        for batch in batches:
            lists, block, side = (batch.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((np.diff(lists) != 0) | (np.diff(block) != 0) | (np.diff(side) != 0)) + 1
            for start, end in zip([0, *change], [*change, batch.num_rows]):
                if start == end:
                    continue
                if cell != (lists[start], block[start]):
                    cell, keys, held = (lists[start], block[start]), [], []
                part = batch.slice(start, end - start)
                rows = (unit_rows(part.column(4), dim), plain_rows(part.column(4), dim), part.column(5).to_numpy())
                if side[start] == 0:
                    keys += part.column(3).to_pylist()
                    held.append(rows)
                elif held:
                    held = [tuple(np.concatenate(c) for c in zip(*held))] if len(held) > 1 else held
                    names = np.array(keys, object)
                    asking = np.array(part.column(3).to_pylist(), object)
                    for low in range(0, len(asking), 256):
                        query, candidate, exact = nearest(rows[0][low:low + 256], rows[1][low:low + 256], *held[0], keep)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(asking[low + query], pa.string()), pa.array(names[candidate], pa.string()),
                                pa.array(exact, pa.float64()), pa.array(held[0][2][candidate], pa.int64()),
                            ],
                            names=["qkey", "vkey", "near", "least"],
                        )

    scored = placed.mapInArrow(score, "qkey string, vkey string, near double, least bigint")
    once = scored.groupBy("qkey", "vkey").agg(F.max("near").alias("near"), F.min("least").alias("least"))
    by_near = Window.partitionBy("qkey").orderBy(F.desc("near"), "least")
    best = once.withColumn("place", F.row_number().over(by_near)).filter(F.col("place") <= keep).select("qkey", "vkey")
    vectors = classes.select(F.col("vkey").alias("qkey"), F.col("vec").alias("qvec"))
    exact = best.join(classes, "vkey").join(vectors, "qkey").select(
        "qkey", F.explode("members").alias("vec_id"),
        (dot(F.col("qvec"), F.col("vec")) / (norm(F.col("qvec")) * norm(F.col("vec")))).alias("score"),
    )
    by_score = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    heads = exact.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= k + 1).drop("place")
    found = queries.join(heads, "qkey").filter("vec_id <> query_id")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
