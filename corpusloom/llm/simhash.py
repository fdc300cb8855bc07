"""SimHash near-duplicates: sharded BK-trees over 64-bit fingerprints.

Two fingerprints that differ in at most ``radius`` bits agree on at least ``blocks - radius`` of
``blocks`` bit blocks. Every choice of that many blocks is a table, its bits a shard key, so each link
lies whole inside some shard. A shard's distinct fingerprints form a BK-tree: the children of a node
are keyed by their integer Hamming distance to it, and a search at distance d from a node follows only
the edges from d - radius to d + radius. All trees in a task are built and searched level by level in
numpy. A shard above ``SHARD`` fingerprints is dealt into blocks; the tree of each block goes to
the tasks that hold the queries of every later block, so a tree sent out never outgrows one block.

Equal fingerprints are one node from the start, and a shard only returns a spanning star of each
of its groups. A group of n copies therefore costs n rows and not n * n pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches
from corpusloom.llm.components import connected_components
from corpusloom.session import materialize

BITS = 64
SEED = 42
SHARD = 1024
_FRONTIER = 1 << 20


# ---- fingerprints


def shingle_hashes(text: str | None, width: int = 4) -> np.ndarray:
    """A hash for each run of ``width`` words of ``text`` in lower case; one of all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - width + 1)
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[:count].tolist(), last.tolist())
    return np.fromiter((digest(line[a:b], SEED) for a, b in cuts), np.uint64, count)


def majority_bits(hashes: np.ndarray) -> int:
    """The SimHash of ``hashes`` as a signed 64-bit number; 0 where there are none."""
    count = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):
        octets = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > count, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(text: str | None, width: int = 4) -> int:
    """The SimHash of ``text`` as a signed 64-bit number; 0 where there is no word."""
    return majority_bits(shingle_hashes(text, width))


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4) -> DataFrame:
    """``id, fp`` for every row. NULL text has no words and gets 0; other columns are ignored."""
    kind = df.schema[id_column].dataType.simpleString()

    def setup():
        return lambda keys, texts: [keys, [fingerprint(t, width) for t in texts]]

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(narrow, f"id {kind}, fp bigint", setup).withColumnRenamed("id", id_column)


# ---- BK-trees


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One BK-tree for each run of equal ``cells``; values must be distinct within a cell."""

    def __init__(self, values: np.ndarray, cells: np.ndarray) -> None:
        self.values = values
        self.roots = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))) if len(cells) else np.empty(0, np.int64)
        self.cells = cells[self.roots]
        at = np.repeat(self.roots, np.diff(np.append(self.roots, len(cells))))
        waiting = np.setdiff1d(np.arange(len(values)), self.roots, assume_unique=True)
        edges, children = [], []
        while len(waiting):
            above = at[waiting]
            edge = above * (BITS + 1) + _apart(values[waiting], values[above])
            order = np.argsort(edge, kind="stable")
            waiting, edge = waiting[order], edge[order]
            first = np.concatenate(([True], edge[1:] != edge[:-1]))
            edges.append(edge[first])
            children.append(waiting[first])
            at[waiting] = np.repeat(waiting[first], np.diff(np.append(np.flatnonzero(first), len(edge))))
            waiting = waiting[~first]
        edge = np.concatenate(edges) if edges else np.empty(0, np.int64)
        order = np.argsort(edge)
        self.edges = edge[order]
        self.children = (np.concatenate(children) if children else np.empty(0, np.int64))[order]

    def search(self, queries: np.ndarray, cells: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays ``(query, node)`` of all pairs within ``radius``, in pieces of bounded size."""
        tree = np.searchsorted(self.cells, cells)
        stack = []
        for start in range(0, len(queries), 4096):
            some = np.arange(start, min(start + 4096, len(queries)))
            stack.append((some, self.roots[tree[some]]))
        while stack:
            query, node = stack.pop()
            if len(query) > _FRONTIER:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            distance = _apart(queries[query], self.values[node])
            hit = distance <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(self.edges, node * (BITS + 1) + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * (BITS + 1) + np.minimum(distance + radius, BITS), "right")
            count = high - low
            if count.any():
                which = np.repeat(np.arange(len(query)), count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                stack.append((query[which], self.children[low[which] + step]))


def _settle(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least label within each group after joining ``a`` with ``b``; labels point at roots."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return labels
        low, high = np.minimum(x, y)[differ], np.maximum(x, y)[differ]
        np.minimum.at(labels, high, low)
        while not np.array_equal(labels, up := labels[labels]):
            labels = up


def shard_stars(cell: np.ndarray, fp: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each fingerprint to the first of its group, for whole cells sorted by cell.

    ``block`` is 0 for what the tree holds and 1 for what only searches it. A cell of one block searches
    its tree with the tree's own fingerprints.
    """
    values = fp.view(np.uint64)
    in_tree = np.flatnonzero(block == 0)
    only_query = np.flatnonzero(block == 1)
    has_query = np.unique(cell[only_query])
    # A cell of two blocks does not search itself: its tree is searched by itself in its own cell.
    searching = np.concatenate((in_tree[~np.isin(cell[in_tree], has_query)], only_query))
    tree_cells = np.unique(cell[in_tree])
    searching = searching[np.isin(cell[searching], tree_cells)]
    forest = Forest(values[in_tree], cell[in_tree])
    labels = np.arange(len(fp))
    for query, node in forest.search(values[searching], cell[searching], radius):
        labels = _settle(labels, searching[query], in_tree[node])
    moved = labels != np.arange(len(fp))
    return fp[moved], fp[labels[moved]]


# ---- shards


def shard_plan(count: int, radius: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """Blocks ``(shift, width)`` and the choices of them that make a table.

    The more fingerprints, the more blocks must agree, so that a shard stays small: results do not
    depend on this, any plan finds every link.
    """
    agree = 2
    while agree < 4 and count >> (BITS * agree // (radius + agree) + 3):
        agree += 1
    blocks = radius + agree
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])], list(combinations(range(blocks), agree))


def _shard_keys(fp: Column, count: int, radius: int) -> Column:
    blocks, tables = shard_plan(count, radius)

    def key(number: int, table: tuple[int, ...]) -> Column:
        bits = F.lit(number).cast("bigint")
        for i in table:
            shift, width = blocks[i]
            bits = F.shiftleft(bits, width).bitwiseOR(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1)))
        return bits

    return F.array(*[key(number, table) for number, table in enumerate(tables)])


def links(distinct: DataFrame, radius: int = 4, shard: int = SHARD) -> DataFrame:
    """``a, b``: edges between distinct fingerprints whose groups are those of all links.

    ``distinct`` has one column ``fp`` without repeats, and should be a written table.
    """
    keys = _shard_keys(F.col("fp"), distinct.count(), radius)
    return shard_links(distinct.select("fp", F.explode(keys).alias("shard")), radius, shard)


def shard_links(keyed: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """``a, b`` as ``links`` gives them, for the links inside the shards of ``keyed``.

    ``keyed`` has the columns ``fp, shard``, without repeats.
    """
    sizes = keyed.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = keyed.join(sizes, "shard").withColumn("blocks", F.ceil(F.col("n") / shard).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # Cell (i, j) holds the tree of block i and, for j > i, the queries of block j.
    cells = dealt.withColumn("own", own).select(
        "fp", "shard",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda j: F.struct(
                    F.least("own", j).alias("i"), F.greatest("own", j).alias("j"),
                    F.when(F.col("own") <= j, 0).otherwise(1).alias("role"),
                ),
            )
        ).alias("c"),
    ).select("shard", "c.i", "c.j", "c.role", "fp")
    placed = cells.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j", "role")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(columns: list[np.ndarray]) -> pa.RecordBatch:
            new = np.zeros(len(columns[0]), bool)
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            a, b = shard_stars(np.cumsum(new), columns[4], columns[3], radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            # The last cell may go on in the next batch.
            last = np.ones(len(columns[0]), bool)
            for c in columns[:3]:
                last &= c == c[-1]
            cut = int(np.argmax(last))
            held = [c[cut:] for c in columns]
            if cut:
                yield edges([c[:cut] for c in columns])
        if held is not None:
            yield edges(held)

    return placed.mapInArrow(search, "a bigint, b bigint").distinct()


def groups(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """``fp, root`` for all distinct fingerprints of a written table; ``root`` names the group."""
    parts = connected_components(links(distinct, radius))
    return distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """``id, fp, component_id`` for every row of ``df``.

    ``component_id`` is the least id among the rows that links reach. Rows without a word have
    fingerprint 0 and link like any other. Repeated rows stay, rows with a NULL id get a component
    like any other row but never name one; it is NULL if no row of it has an id. An empty table gives an
    empty table. Other columns are ignored.
    """
    rows = materialize(fingerprints(df, id_column, text_column, width), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min(id_column).alias("least")), "nodes")
    grouped = materialize(groups(nodes.select("fp"), radius).join(nodes, "fp"), "groups")
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    every = grouped.join(names, "root").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(every, rows["fp"] == every["_fp"]).drop("_fp")


def keep_one(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """One row of every group of ``df``, with all its columns: the one of least id.

    Rows without an id come after those with one; among equal ids, repeated rows included, one
    is kept. The rows are numbered and written first, so the choice holds if a task runs again.
    """
    names = df.columns
    numbered = materialize(df.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id()), "rows")
    key, text = (f"c{names.index(c)}" for c in (id_column, text_column))
    marks = materialize(fingerprints(numbered, "row", text, width), "fingerprints")
    placed = numbered.select("row", F.col(key).alias("id")).join(marks, "row")
    order = F.struct(F.col("id").isNull().alias("without"), "id", "row")
    nodes = materialize(placed.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    kept = groups(nodes.select("fp"), radius).join(nodes, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return numbered.join(kept.select(F.col("first.row").alias("row")), "row", "left_semi").drop("row").toDF(*names)


def as_hex(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
