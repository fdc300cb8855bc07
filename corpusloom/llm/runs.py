"""Periodic runs of words, found by uniting suffix classes along descending common prefixes.

A run is a stretch of words with a smallest period q that is repeated often enough and that no neighbouring
word extends. The suffixes of a text are ranked by prefix doubling, so that neighbours in their order and the
lengths of their common prefixes (LCP) are known. Neighbours are then united by decreasing LCP, as in
Kruskal's algorithm: union-find over suffixes, each class with its text positions in order, the smaller class
poured into the larger. When two classes meet at length l, all positions across them share exactly l words.
Two positions that become adjacent in the united class at a distance d of at most l are a repetition of
period d over d + l words; no shorter period fits, or a position of it would already stand between them.
It is a run if the word before it does not continue the period. Every run is met this way at its start.

Documents stay rows: nothing is shuffled, and a task holds one slice of texts. The suffixes of all texts of a
slice are ranked together as numbers; only those that share the least length a run can have are ever united.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm.batches import slices

LEAST_LENGTH = 6
LEAST_REPEATS = 4
CHUNK = 1024
RESULT = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Positions:
    """Text positions in order, in chunks of bounded length, so that an insertion moves little."""

    __slots__ = ("chunks", "heads", "size")

    def __init__(self, position: int) -> None:
        self.chunks, self.heads, self.size = [[position]], [position], 1

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk

    def add(self, position: int) -> tuple[int, int]:
        """Insert a position; the ones before and after it, -1 where there is none."""
        at = max(bisect_left(self.heads, position) - 1, 0) if len(self.heads) > 1 else 0
        chunk = self.chunks[at]
        place = bisect_left(chunk, position)
        if place:
            before = chunk[place - 1]
        else:
            before = self.chunks[at - 1][-1] if at else -1
        if place < len(chunk):
            after = chunk[place]
        else:
            after = self.heads[at + 1] if at + 1 < len(self.heads) else -1
        insort(chunk, position)
        if not place:
            self.heads[at] = position
        if len(chunk) > CHUNK:
            half = len(chunk) // 2
            self.chunks[at:at + 1] = [chunk[:half], chunk[half:]]
            self.heads.insert(at + 1, chunk[half])
        self.size += 1
        return before, after


def rank_levels(codes: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, and the end of each position's text.

    ``codes`` are the words of several texts in a row, text ``k`` at ``starts[k]:starts[k + 1]``; only suffixes of
    one text ever share a rank. Rounds go on until all ranks differ and sort only what is still shared.
    """
    count = len(codes)
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(starts[1:], sizes)
    key = text * (int(codes.max()) + 1) + codes
    rank = np.empty(count, np.int64)
    shared = _rank(key, np.arange(count), np.zeros(count, np.int64), rank)
    kind = np.int32 if count < 1 << 31 else np.int64
    levels, width = [rank.astype(kind)], 1
    while len(shared):
        following = shared + width
        inside = following < end[shared]
        second = np.where(inside, rank[np.minimum(following, count - 1)] + 1, 0)
        base = rank[shared]
        shared = _rank(base * (count + 1) + second, shared, base, rank)
        levels.append(rank.astype(kind))
        width *= 2
    return levels, end


def _rank(key: np.ndarray, positions: np.ndarray, base: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Write the ranks of ``positions`` by ``key``, counted on from ``base``; the positions that still share one."""
    order = np.argsort(key, kind="stable")
    key, positions, base = key[order], positions[order], base[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
    # Within a group of equal base the first row has the base itself as its rank.
    group = np.ones(len(key), bool)
    group[1:] = base[1:] != base[:-1]
    start = np.maximum.accumulate(np.where(group, np.arange(len(key)), 0))
    rank[positions] = base + first - start
    last = np.ones(len(key), bool)
    last[:-1] = fresh[1:]
    return positions[~(fresh & last)]


def neighbours(levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, second, lcp`` of neighbours in suffix order that share ``least`` words or more."""
    order = np.empty(len(levels[-1]), np.int64)
    order[levels[-1]] = np.arange(len(order))
    first, second = order[:-1], order[1:]
    coarse = min(len(levels), least.bit_length()) - 1
    alike = levels[coarse][first] == levels[coarse][second]
    first, second = first[alike], second[alike]
    lcp = np.zeros(len(first), np.int64)
    for step in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[step], -1)
        same = rank[first + lcp] == rank[second + lcp]
        lcp[same] += 1 << step
    long = lcp >= least
    return first[long], second[long], lcp[long]


def _kruskal(edges, codes: list[int], start: int, repeats: int, least: int) -> list[tuple[int, int, int]]:
    """Runs of one text from its edges ``(lcp, first, second)``; ``start`` is where the text begins."""
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}  # of classes with more than one position
    runs = []

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[above]
        return node

    for shared, one, other in edges:
        big, small = root(one), root(other)
        into, moved = classes.get(big), classes.get(small)
        if moved is not None and (into is None or into.size < moved.size):
            big, small, into, moved = small, big, moved, into
        parent[small] = big
        if into is None:
            into = classes[big] = Positions(big)
        classes.pop(small, None)
        came = list(moved) if moved is not None else [small]
        for position, coming in zip(came, [*came[1:], None]):
            before, after = into.add(position)
            # Seeds are the pairs across the two classes that are adjacent once all positions have come.
            if before >= 0 and (position == came[0] or before != earlier):
                runs.append((before, position - before, shared))
            if after >= 0 and (coming is None or coming > after):
                runs.append((position, after - position, shared))
            earlier = position
    found = [
        (left - start, period + shared, period) for left, period, shared in runs
        if period <= shared and period + shared >= max(least, repeats * period)
        and (left == start or codes[left - 1] != codes[left - 1 + period])
    ]
    return sorted(found)


def runs_of_texts(
    codes: np.ndarray, starts: np.ndarray, repeats: int = LEAST_REPEATS, least: int = LEAST_LENGTH
) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, ``(start, length, period)`` by start and period.

    A run of period q has ``max(least, repeats * q)`` words or more, so its first two occurrences share
    ``shared`` words or more: texts without such a repetition are left out, and shorter LCPs are never united.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(starts) - 1)]
    if not len(codes):
        return out
    shared = max(least - least // repeats, repeats - 1)
    levels, end = rank_levels(codes, starts)
    first, second, lcp = neighbours(levels, shared)
    del levels
    if not len(first):
        return out
    text = np.searchsorted(starts, first, side="right") - 1
    order = np.lexsort((-lcp, text))
    first, second, lcp, text = first[order], second[order], lcp[order], text[order]
    bounds = np.flatnonzero(np.append(True, text[1:] != text[:-1])).tolist() + [len(text)]
    for a, b in zip(bounds, bounds[1:]):
        k = int(text[a])
        begin = int(starts[k])
        edges = zip(lcp[a:b].tolist(), first[a:b].tolist(), second[a:b].tolist())
        out[k] = _kruskal(edges, codes, begin, repeats, least)
    return out


def kept_words(sizes: np.ndarray, starts: np.ndarray, runs: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """False for every word that a run holds after its first period."""
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    for begin, found in zip(starts.tolist(), runs):
        for start, length, period in found:
            change[begin + start + period] += 1
            change[begin + start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def words(text: Column) -> Column:
    """Runs of other than white space (U+0020, U+0009 to U+000D); none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+"), F.lit(0))


def run_columns(tokens: Column, repeats: int = LEAST_REPEATS, least: int = LEAST_LENGTH) -> Column:
    """``runs, collapsed`` as a struct from an array of words.

    ``collapsed`` is the text without the repetitions: the words no run holds after its first period, joined by
    a space. NULL counts as an empty array: no runs, and an empty text. A NULL word is a word like any other and
    is left out of ``collapsed``.
    """
    kind = T.StructType.fromDDL(RESULT)
    fields = list(to_arrow_schema(kind))

    def part(arrays: pa.ListArray) -> pa.StructArray:
        sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = pc.list_flatten(arrays)
        codes = pc.dictionary_encode(flat, null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found = runs_of_texts(codes, starts, repeats, least)
        kept = kept_words(sizes, starts, found) & flat.is_valid().to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(kept)])[starts]
        left = pa.ListArray.from_arrays(pa.array(before, pa.int32()), flat.filter(pa.array(kept)))
        runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], fields[0].type)
        return pa.StructArray.from_arrays([runs, pc.binary_join(left, " ")], fields=fields)

    def run(arrays: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(p) for p in slices(arrays)] or [pa.array([], pa.struct(fields))])

    run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind).asNondeterministic()(tokens)


def find_runs(
    df: DataFrame, id_column: str = "doc_id", words_column: str = "words",
    repeats: int = LEAST_REPEATS, least: int = LEAST_LENGTH,
) -> DataFrame:
    """``id, runs, collapsed`` for every row of ``df``, repeated rows and NULL ids included.

    ``words_column`` is an array of words (see ``words``). ``runs`` has one ``start, length, period`` per run of at
    least ``repeats`` periods and ``least`` words, by start and period. Without words, or for NULL, there are no
    runs and the text is empty. Texts of any length are handled whole, in O(n log^2 n) steps and memory for one
    slice of texts or one longer text. An empty table gives an empty table; other columns are ignored.
    """
    narrow = df.select(F.col(id_column).alias("id"), run_columns(F.col(words_column), repeats, least).alias("found"))
    return narrow.select(F.col("id").alias(id_column), "found.runs", "found.collapsed")


def longest(runs: Column) -> Column:
    """The run of greatest length, ties by least start and period; NULL if there is none."""
    best = F.array_sort(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    return F.get(best, F.lit(0))


def report(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, the longest run and digests of the rows of ``find_runs``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = found.withColumn("_top", longest(F.col("runs")))
    length = -F.col("_top.l")
    return top.select(
        id_column, F.size("runs").cast("bigint").alias("n_runs"), F.col("_top.s").alias("start"), length.alias("length"),
        F.col("_top.p").alias("period"), F.expr("(-_top.l * 1000L) div _top.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
