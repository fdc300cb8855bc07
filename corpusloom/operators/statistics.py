"""Co-occurrence, association and weighting of terms."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import scale
from corpusloom.functions.hashing import draw
from corpusloom.plans.lookup import MAX_BROADCAST_ROWS, in_blocks, in_parts, lookup_array
from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize

# Weights are summed as integers where a common denominator of this size does it: the sums are
# then exact and independent of the order in which partitions are added.
MAX_DENOMINATOR = 400_000
PAIRS_AT_ONCE = 1 << 22
ROWS_AT_ONCE = 1 << 16
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS


def _summed_runs(cells: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted ``cells`` and the sums of their values."""
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[first], np.add.reduceat(values, first) if len(first) else values[:0]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in four bytes each if they fit, others in eight."""
    if values.dtype.kind == "i" and int(values.max()) < 1 << 32 and int(values.min()) >= 0:
        return values.astype(np.uint32).tobytes()
    return values.tobytes()


def _unpacked(packed: pa.Scalar, size: int, kind: str) -> np.ndarray:
    buffer = packed.as_buffer()
    return np.frombuffer(buffer, np.uint32 if buffer.size == 4 * size else kind).astype(kind)


def _cell_sums(weights: list, own):
    """Arrow batches of ``ids`` to ``bucket, n, hi, lo, w``: the pair weights of about ``PAIRS_AT_ONCE`` pairs, added up per cell.

    ``weights`` is by distance from one on; every id adds ``own`` to its diagonal cell. A row holds the ``n`` cells of one
    bucket, whose greater ids are those of one remainder.
    """
    steps = np.array([own or 0, *weights])
    width = int(len(weights)).bit_length()

    def pairs(ids: np.ndarray, owner: np.ndarray, left: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for d in range(0 if own else 1, len(weights) + 1):
            n = max(min(left, len(ids) - d), 0)
            a, b = ids[:n], ids[d:d + n]
            both = (owner[:n] == owner[d:d + n]) & (a >= 0) & (b >= 0)
            a, b = a[both], b[both]
            yield np.maximum(a, b), np.minimum(a, b), d

    def summed(ids: np.ndarray, owner: np.ndarray, left: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``hi, lo, w`` in order of their buckets, of the pairs whose first id is one of the ``left`` first."""
        bits = max(int(ids.max(initial=0)).bit_length(), BUCKET_BITS)
        found, mask = pairs(ids, owner, left), (1 << bits) - 1
        if 2 * bits + width > 63:  # too wide for one number: only the buckets add these up
            for hi, lo, d in found:
                order = np.argsort(hi % BUCKETS, kind="stable")
                yield hi[order], lo[order], np.full(len(hi), steps[d])
            return
        rest = bits - BUCKET_BITS
        codes = np.concatenate([
            (((((hi & (BUCKETS - 1)) << rest) | (hi >> BUCKET_BITS)) << bits | lo) << width) | d for hi, lo, d in found
        ])
        codes.sort()
        cells, sums = _summed_runs(codes >> width, steps[codes & ((1 << width) - 1)])
        turned = cells >> bits
        yield (turned & ((1 << rest) - 1)) << BUCKET_BITS | turned >> rest, cells & mask, sums

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, owners, waiting, rows = [], [], 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            ids, owner = np.concatenate(some), np.concatenate(owners)
            size = -(-PAIRS_AT_ONCE // len(steps))
            for low in range(0, len(ids), size):
                reach = slice(low, low + size + len(weights))
                for hi, lo, w in summed(ids[reach], owner[reach], size):
                    buckets = hi % BUCKETS
                    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
                    parts = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(hi)])]
                    columns = [pa.array([_packed(c[p]) for p in parts], pa.binary()) for c in (hi, lo, w)]
                    sizes = [p.stop - p.start for p in parts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(buckets[starts].astype(np.int32)), pa.array(sizes, pa.int32()), *columns], names=["bucket", "n", "hi", "lo", "w"]
                    )

        for batch in batches:
            lists = batch.column(0)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            some.append(lists.flatten().cast(pa.int64()).fill_null(-1).to_numpy())
            owners.append(np.repeat(np.arange(rows, rows + len(sizes)), sizes))
            waiting, rows = waiting + len(some[-1]), rows + len(sizes)
            if waiting * len(steps) >= PAIRS_AT_ONCE:
                yield from done()
                some, owners, waiting = [], [], 0
        if waiting:
            yield from done()

    return add_up


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """``hi, lo, w`` of several such, added up per cell."""
    hi, lo, w = (np.concatenate(c) for c in zip(*parts))
    bits = int(lo.max(initial=0)).bit_length()
    if bits + int(hi.max(initial=0)).bit_length() <= 63:
        cells = hi << bits | lo
        order = np.argsort(cells, kind="stable")
        cells, w = _summed_runs(cells[order], w[order])
        return cells >> bits, cells & ((1 << bits) - 1), w
    order = np.lexsort((lo, hi))
    hi, lo, w = hi[order], lo[order], w[order]
    first = np.flatnonzero((np.diff(hi, prepend=-1) != 0) | (np.diff(lo, prepend=-1) != 0))
    return hi[first], lo[first], np.add.reduceat(w, first)


def _merged(kind: str, denominator: int):
    """Arrow batches of ``bucket, n, hi, lo, w``, buckets together, to ``row_id, col_id, value``: both halves of the symmetric matrix.

    A bucket's parts are added up whenever they are as many cells as its sums or some million; a diagonal cell counts twice.
    """
    def mirrored(parts: list) -> Iterator[pa.RecordBatch]:
        hi, lo, w = _added(parts)
        for at in range(0, len(hi), ROWS_AT_ONCE):
            a, b, value = (c[at:at + ROWS_AT_ONCE] for c in (hi, lo, w))
            value, other = value / denominator, a != b
            value = np.where(other, value, value * 2)
            columns = (a, b[other]), (b, a[other]), (value, value[other])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["row_id", "col_id", "value"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, held, waiting = None, [], 0, 0
        for batch in batches:
            for bucket, size, *packed in zip(*(batch.column(i) for i in range(5))):
                if bucket.as_py() != here:
                    if parts:
                        yield from mirrored(parts)
                    here, parts, held, waiting = bucket.as_py(), [], 0, 0
                n = size.as_py()
                parts.append(tuple(_unpacked(c, n, k) for c, k in zip(packed, ("i8", "i8", kind))))
                waiting += n
                if waiting > max(held, PAIRS_AT_ONCE):
                    parts = [_added(parts)]
                    held, waiting = len(parts[0][0]), 0
        if parts:
            yield from mirrored(parts)

    return merge


def _weighted_cells(rows: DataFrame, weights: list, denominator: int, own=None) -> DataFrame:
    """``row_id, col_id, value``: the pair weights of id arrays summed per cell of a symmetric matrix.

    Every position looks ahead inside its own row, so nothing is shuffled before the partial
    sums, and a frequent pair reaches the shuffle once per some million pairs. What moves are packed
    buckets of cells, by the remainder of the greater id, which has no more cells than there are ids up to it; a task adds up one
    bucket at a time. A negative id is a gap: it takes up a place and forms no pair.
    """
    kind = "i8" if isinstance(weights[0], int) else "f8"
    partial = rows.select("ids").mapInArrow(_cell_sums(weights, own), "bucket int, n int, hi binary, lo binary, w binary")
    dealt = partial.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_merged(kind, denominator), "row_id bigint, col_id bigint, value double")


def _harmonic(window: int) -> tuple[list, int]:
    common = math.lcm(*range(1, window + 1))
    if common > MAX_DENOMINATOR:
        return [1.0 / d for d in range(1, window + 1)], 1
    return [common // d for d in range(1, window + 1)], common


def cooccurrence_harmonic(rows: DataFrame, window: int = 10) -> DataFrame:
    """``row_id, col_id, value`` from rows of ``ids``: weight 1/distance within the window.

    Symmetric; each occurrence adds 1 to the diagonal, and a pair of equal words twice its
    weight.
    """
    weights, denominator = _harmonic(window)
    # Halves of the common denominator are whole numbers of twice as many parts.
    return _weighted_cells(rows, [w * 2 for w in weights], denominator * 2, own=denominator)


def cooccurrence_linear(rows: DataFrame, window: int = 3) -> DataFrame:
    """As above with weights 1, (w-1)/w, ..., 1/w and no term for the word itself.

    Words outside the vocabulary are gaps here: they still count as distance.
    """
    return _weighted_cells(rows, list(range(window, 0, -1)), window)


def cooccurrence_glove(rows: DataFrame, window: int = 15) -> DataFrame:
    """As the harmonic form without a term for the word itself."""
    return _weighted_cells(rows, *_harmonic(window))


def _exact_decimal(column: str) -> Column:
    """The sum of doubles in twelve decimals, as a decimal, from three sums of whole numbers, which cost no decimal per row.

    Values that are no finite numbers do not count.
    """
    size = F.abs(F.col(column))
    value = F.when(size < 1e16, F.col(column).cast("double"))
    value = value.when(size < math.inf, F.raise_error(F.lit("a value has too many digits for an exact sum")).cast("double"))
    whole = F.floor(value)
    part = F.floor((value - whole) * 1e12 + 0.5)
    high, low = F.sum(F.shiftright(part, 20)), F.sum(part.bitwiseAND(F.lit((1 << 20) - 1)))
    parts = (high.cast("decimal(25,0)") * F.lit(1 << 20) + low.cast("decimal(25,0)")).cast("decimal(26,0)") * F.lit(Decimal("1E-12"))
    return (F.sum(whole).cast("decimal(38,12)") + parts.cast("decimal(38,12)")).cast("decimal(38,12)")


def exact_sum(column: str) -> Column:
    """A sum of doubles in twelve decimals, the same for any order of the rows."""
    return _exact_decimal(column).cast("double")


def marginals(cells: DataFrame) -> DataFrame:
    """``row_id, row_sum``."""
    return cells.groupBy("row_id").agg(exact_sum("value").alias("row_sum"))


def shuffle_pairs(cells: DataFrame, seed: object) -> DataFrame:
    """The cells in a random but repeatable order.

    A number of 60 bits moves with a cell, not the spelt digest; equal numbers go by the cell.
    """
    order = draw(seed, F.col("row_id"), F.col("col_id"))
    return cells.withColumn("_draw", order).orderBy("_draw", "row_id", "col_id").drop("_draw")


def _with_margins(cells: DataFrame, symmetric: bool) -> tuple[DataFrame, Column]:
    """Cells with both margins, and the grand total.

    The matrix is written once, or each margin would count the corpus again. Margins hold one row per
    vocabulary id; as long as they are few enough to ship, the cells are not shuffled to meet them. Those of a
    symmetric matrix are added up once.
    """
    cells = materialize(cells, "cells")

    def sums(key: str) -> DataFrame:
        return materialize(cells.groupBy(key).agg(_exact_decimal("value").alias("_sum")), "margins")

    rows = sums("row_id")
    columns = rows.withColumnRenamed("row_id", "col_id") if symmetric else sums("col_id")
    total = rows.agg(F.sum("_sum").cast("double")).scalar()
    out = cells
    for key, name, side in (("row_id", "row_sum", rows), ("col_id", "col_sum", columns)):
        margin = side.select(key, F.col("_sum").cast("double").alias(name))
        small = side.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
        out = out.join(F.broadcast(margin) if small else margin, key)
    return out, total


def pmi(cells: DataFrame, min_pmi: float = math.log(5), symmetric: bool = False) -> DataFrame:
    """``row_id, col_id, pmi``: log of observed over expected share, low values dropped."""
    margins, total = _with_margins(cells, symmetric)
    ratio = F.col("value") * total / (F.col("row_sum") * F.col("col_sum"))
    return margins.select("row_id", "col_id", F.log(ratio).alias("pmi")).filter(
        F.col("pmi") >= min_pmi
    )


def pmi_targets(
    cells: DataFrame, base: float = 0.0, scale_by: float = 1.0, exponent: float = 0.5, symmetric: bool = False
) -> DataFrame:
    """``row_id, col_id, target, weight`` of the pair model, for the cells that are not zero.

    The target is ln(count) - ln(row + 1) - ln(column + 1) + ln(total + 1); the weight grows
    with the count. Cells that are zero are the complement and carry no rows.
    """
    margins, total = _with_margins(cells, symmetric)
    target = (
        F.log("value") - F.log1p("row_sum") - F.log1p("col_sum") + F.log(total + 1)
    )
    weight = F.lit(base) + F.lit(scale_by) * F.pow("value", F.lit(exponent))
    return margins.select("row_id", "col_id", target.alias("target"), weight.alias("weight"))


def _best_of_chunks(n: int):
    """Arrow batches of ``row, column, value`` and more, less what ``n`` others of a row go before among some million rows.

    Rows that lack one of the three, or whose value is no number, stay.
    """
    def chosen(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        row, column = (table.column(i).cast(pa.int64()) for i in (0, 1))
        value = table.column(2).cast(pa.float64())
        whole = np.ones(len(table), bool)
        for c in (row, column, value):
            if c.null_count:
                whole &= c.is_valid().to_numpy()
        row, column = (c.fill_null(0).to_numpy() for c in (row, column))
        value = value.fill_null(0.0).to_numpy()
        whole &= ~np.isnan(value)
        at = np.flatnonzero(whole)
        order = at[np.lexsort((column[at], -value[at], row[at]))]
        starts = np.flatnonzero(np.concatenate(([True], row[order][1:] != row[order][:-1]))) if len(order) else order
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        keep = ~whole
        keep[order[place < n]] = True
        yield from table.filter(pa.array(keep)).combine_chunks().to_batches(max_chunksize=ROWS_AT_ONCE)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, rows = [], 0
        for batch in batches:
            some.append(batch)
            rows += batch.num_rows
            if rows >= PAIRS_AT_ONCE:
                yield from chosen(some)
                some, rows = [], 0
        if some:
            yield from chosen(some)

    return best


def top_collocates(scores: DataFrame, n: int, value: str = "pmi") -> DataFrame:
    """The ``n`` best columns of every row, ties by column id.

    Some million scores at a time lose those that cannot be among the best; only the others are sorted and shuffled.
    """
    first = ["row_id", "col_id", value]
    some = scores.select(*first, *[c for c in scores.columns if c not in first])
    some = some.mapInArrow(_best_of_chunks(n), some.schema).select(*scores.columns)
    order = Window.partitionBy("row_id").orderBy(F.col(value).desc(), "col_id")
    return some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def term_filter(tokens: Column, stop: list[str] | None = None, pattern: str | None = None) -> Column:
    """Keep terms that match a pattern (such as a part-of-speech ending) and are not stop words."""
    kept = F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens
    return F.filter(kept, lambda t: t.rlike(pattern)) if pattern else kept


def _term_counts(lists: pa.ListArray) -> tuple[pa.ListArray, pa.ListArray]:
    """The distinct elements of every list and how often each is there."""
    sizes = np.diff(np.asarray(lists.offsets))
    flat = lists.flatten().dictionary_encode(null_encoding="encode")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    width = max(len(flat.dictionary), 1)
    cells, times = np.unique(owner * width + np.asarray(flat.indices).astype(np.int64), return_counts=True)
    ends = pa.array(np.searchsorted(cells, np.arange(len(sizes) + 1) * width).astype(np.int32))
    words = flat.dictionary.take(pa.array(cells % width))
    return pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(times))


def count_terms(df: DataFrame, keep: list[str], column: str) -> DataFrame:
    """``keep, terms, tf``: the distinct terms of each row's array and their counts, row by row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, len(keep)):
            terms, times = _term_counts(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], terms, times], names=[*keep, "terms", "tf"])

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, column).mapInArrow(count, f"{kinds}, terms array<string>, tf array<bigint>")


def term_frequencies(df: DataFrame, doc: str, column: str) -> tuple[DataFrame, DataFrame]:
    """``doc, terms, tf`` in blocks, and ``term, df`` of the corpus: lower-cased terms counted in place, as written tables."""
    lowered = df.select(doc, F.transform(column, lambda t: F.lower(t)).alias("_terms"))
    counted = materialize(in_blocks(count_terms(lowered, [doc], "_terms"), F.size("terms")), "terms")
    frequency = materialize(
        unnest(counted, "terms", value="term").groupBy("term").agg(F.count("*").alias("df")), "frequencies"
    )
    return counted, frequency


def tfidf_vectors(df: DataFrame, doc: str = "doc_id", column: str = "tokens") -> DataFrame:
    """``doc, terms, tf, df, tfidf`` as arrays, with idf ln((1 + n) / (1 + df)) + 1 and rows of length one.

    A document stays one row: its terms are counted in place and written, and its weights scaled in
    place. Only the document frequencies are added up over the corpus, and come back by a look-up.
    """
    counted, frequency = term_frequencies(df, doc, column)
    total = counted.count()
    # Most terms of a corpus occur in one document; they are the ones that the table need not hold.
    found = lookup_array(counted, "terms", "_df", frequency.filter("df > 1"), "term", "df", [doc], 1, "df")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times, documents = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            sizes = np.diff(np.asarray(batch.column(1).offsets))
            raw = times * (np.log((1 + total) / (documents + 1)) + 1)
            owners = np.repeat(np.arange(len(sizes)), sizes)
            lengths = np.sqrt(np.bincount(owners, raw * raw, len(sizes)))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            weights = pa.ListArray.from_arrays(ends, pa.array(raw / lengths[owners]))
            yield pa.RecordBatch.from_arrays([*batch.columns, weights], names=[doc, "terms", "tf", "df", "tfidf"])

    kind = counted.schema[doc].dataType.simpleString()
    return found.select(doc, "terms", "tf", "_df").mapInArrow(
        weigh, f"{doc} {kind}, terms array<string>, tf array<bigint>, df array<bigint>, tfidf array<double>"
    )


def tfidf(df: DataFrame, doc: str = "doc_id", column: str = "tokens") -> DataFrame:
    """``doc, term, tf, tfidf``: a row for each entry of ``tfidf_vectors``."""
    return unnest(tfidf_vectors(df, doc, column), F.arrays_zip("terms", "tf", "tfidf"), doc, value="_e").select(
        doc, F.col("_e.terms").alias("term"), F.col("_e.tf").alias("tf"), F.col("_e.tfidf").alias("tfidf")
    )


def sif_weights(counts: DataFrame, vectors: DataFrame, a: float = 1e-4) -> DataFrame:
    """``key, weight, vec``: vectors scaled by a / (p + a), a word never seen having p = 0."""
    total = counts.agg(F.sum("freq")).scalar()
    share = F.coalesce(F.col("freq") / total, F.lit(0.0))
    joined = vectors.join(counts.withColumnRenamed("token", "key"), "key", "left")
    weighted = joined.withColumn("weight", F.lit(a) / (share + a))
    return weighted.select("key", "weight", scale(F.col("vec"), F.col("weight")).alias("vec"))


def distinct_bow(tokens: Column) -> Column:
    """The distinct tokens of a document in order."""
    return F.sort_array(F.array_distinct(tokens))
