"""Trained subword pieces: byte-pair merges over the distinct words, hundreds to thousands per round.

The words stay in the tasks as arrays of symbol numbers. A round asks them for the pairs that may be merged next,
in order, and for the *chains* these make: the longest stretches of a word in which every two neighbours are such
a pair, with their summed frequency. Whatever the corpus holds, chains of a few hundred pairs are few, so they
are counted on the cluster, brought to the driver, and merged there one pair after the other, exactly as all
words would be: a pair that is not asked for comes later in the order than all that are, and so does every
pair that grows out of it. When the next pair would come after the last one asked for, the round ends and the
tasks replace each chain by what it became. The number of pairs asked for is doubled or cut as the number of
chains allows, so the driver's share stays bounded.

A pair that spells a piece already made is never merged, so each piece is made in one way only; pairs are taken by
frequency, then the shorter and the lesser spelling first.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import discard, materialize

SPACE_MARK = "▁"
TRAINER_PIECES = ("<unk>", "<s>", "</s>")
SHIFT = 24
MASK = (1 << SHIFT) - 1
FIRST_PAIRS, MOST_PAIRS, MOST_CHAINS = 64, 8192, 60_000


def character_counts(word_counts: DataFrame) -> list[tuple[str, int]]:
    """``char, n`` by falling frequency, of words led by the space mark; at most one row per Unicode character."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for token, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for char in SPACE_MARK + token:
                    found[char] += freq
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["char", "n"])

    uses = word_counts.select("token", F.col("freq").cast("bigint")).mapInArrow(run, "char string, n bigint")
    rows = uses.groupBy("char").agg(F.sum("n").alias("n")).collect()
    return sorted(((r.char, r.n) for r in rows), key=lambda r: (-r[1], r[0]))


def covered_characters(counted: list[tuple[str, int]], coverage: float) -> list[str]:
    """The commonest characters that together reach ``coverage`` of all uses."""
    total, seen, kept = sum(n for _, n in counted), 0, []
    for char, n in counted:
        if seen >= coverage * total:
            break
        kept.append(char)
        seen += n
    return kept


class Symbols:
    """Spelling of every symbol by its number, and which pairs may not be merged."""

    def __init__(self, characters: list[str], max_length: int) -> None:
        self.spelling = list(characters)
        self.max_length = max_length
        self.banned: set[int] = set()

    def order(self, pair: int, n: int) -> tuple[int, int, str, int]:
        piece = self.spelling[pair >> SHIFT] + self.spelling[pair & MASK]
        return -n, len(piece), piece, pair

    def allowed(self, pair: int) -> bool:
        return (
            pair not in self.banned
            and len(self.spelling[pair >> SHIFT]) + len(self.spelling[pair & MASK]) <= self.max_length
        )


def symbol_numbers(word_counts: DataFrame, characters: list[str]) -> DataFrame:
    """``ids, freq``: the numbers of each word's characters; a character that is not listed ends a stretch."""
    number = {c: i for i, c in enumerate(characters)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, freqs = [], []
            for token, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now: list[int] = []
                for char in SPACE_MARK + token:
                    at = number.get(char)
                    if at is not None:
                        now.append(at)
                    elif now:
                        ids.append(now)
                        freqs.append(freq)
                        now = []
                if now:
                    ids.append(now)
                    freqs.append(freq)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(freqs, pa.int64())], names=["ids", "freq"])

    return word_counts.select("token", F.col("freq").cast("bigint")).mapInArrow(run, "ids array<int>, freq bigint")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words in a row, the pair that starts at each (-1 at the end of a word), and the word sizes."""
    arrays = batch.column(0)
    sizes = arrays.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = np.full(len(flat), -1, np.int64)
    pairs[:-1] = flat[:-1] << SHIFT | flat[1:]
    pairs[np.cumsum(sizes) - 1] = -1
    return flat, pairs, sizes


def _within(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _chains(pairs: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chains of two symbols and more start and end (exclusive), given the sorted linked pairs."""
    on = np.concatenate([[False], _within(pairs, linked), [False]])
    change = np.flatnonzero(on[1:] != on[:-1])
    return change[0::2], change[1::2] + 1


def pair_order(words: DataFrame, symbols: Symbols, limit: int) -> list[tuple[int, int]]:
    """``pair, n`` of the first ``limit`` pairs that may be merged, in merging order."""
    spark = words.sparkSession
    book = spark.sparkContext.broadcast((np.array([len(s) for s in symbols.spelling], np.int64), np.array(sorted(symbols.banned), np.int64), symbols.max_length))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, banned, longest = book.value
        for batch in batches:
            _, pairs, sizes = _flat(batch)
            weight = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
            use = pairs >= 0
            pairs, weight = pairs[use], weight[use]
            distinct, place = np.unique(pairs, return_inverse=True)
            n = np.zeros(len(distinct), np.int64)
            np.add.at(n, place, weight)
            use = (length[distinct >> SHIFT] + length[distinct & MASK] <= longest) & ~_within(distinct, banned)
            yield pa.RecordBatch.from_arrays([pa.array(distinct[use]), pa.array(n[use])], names=["pair", "n"])

    counted = words.mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    spelling = spark.sparkContext.broadcast(symbols.spelling)

    def spell(pair: pa.Array) -> pa.Array:
        names = spelling.value
        return pa.array([names[p >> SHIFT] + names[p & MASK] for p in pair.to_pylist()], pa.string())

    spell.__annotations__ = {"pair": pa.Array, "return": pa.Array}
    spelt = counted.withColumn("piece", F.arrow_udf(spell, "string")("pair"))
    first = spelt.orderBy(F.col("n").desc(), F.length("piece"), F.col("piece").cast("binary"), "pair").limit(limit)
    return [(r.pair, r.n) for r in first.select("pair", "n").collect()]


def chain_counts(words: DataFrame, asked: np.ndarray, linked: np.ndarray, most: int) -> list[tuple[bytes, int]] | None:
    """The chains of ``linked`` pairs that hold one ``asked`` for, and their frequencies; None if more than ``most``."""
    book = words.sparkSession.sparkContext.broadcast((asked, linked))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, pairs, sizes = _flat(batch)
            weight = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
            symbols = flat.astype("<i4")
            starts, ends = _chains(pairs, book.value[1])
            before = np.concatenate([[0], np.cumsum(_within(pairs, book.value[0]))])
            use = before[ends - 1] > before[starts]
            starts, ends = starts[use], ends[use]
            found: Counter[bytes] = Counter()
            for start, end, n in zip(starts.tolist(), ends.tolist(), weight[starts].tolist()):
                found[symbols[start:end].tobytes()] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["chain", "n"])

    counted = words.mapInArrow(count, "chain binary, n bigint").groupBy("chain").agg(F.sum("n").alias("n"))
    rows = counted.limit(most + 1).collect()
    return None if len(rows) > most else [(bytes(r.chain), r.n) for r in rows]


def replace_chains(words: DataFrame, linked: np.ndarray, became: dict[bytes, np.ndarray]) -> DataFrame:
    """``words`` with every chain that changed in its new form."""
    book = words.sparkSession.sparkContext.broadcast((linked, became))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, changes = book.value
        for batch in batches:
            flat, pairs, sizes = _flat(batch)
            symbols = flat.astype("<i4")
            starts, ends = _chains(pairs, table)
            kept = np.ones(len(flat), bool)
            for start, end in zip(starts.tolist(), ends.tolist()):
                new = changes.get(symbols[start:end].tobytes())
                if new is not None:
                    symbols[start:start + len(new)] = new
                    kept[start + len(new):end] = False
            word = np.repeat(np.arange(len(sizes)), sizes)
            sizes = np.bincount(word[kept], minlength=len(sizes))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            ids = pa.ListArray.from_arrays(offsets, pa.array(symbols[kept], pa.int32()))
            single = sizes > 1  # a word of one symbol has no pair any more
            yield pa.RecordBatch.from_arrays([ids, batch.column(1)], names=["ids", "freq"]).filter(pa.array(single))

    return words.mapInArrow(run, "ids array<int>, freq bigint")


def merge_chains(
    chains: list[tuple[bytes, int]], symbols: Symbols, last: tuple | None, merges: int
) -> tuple[int, dict[bytes, np.ndarray]]:
    """Merge pairs in order until one would come after ``last``; how many were merged, and what chains became.

    New symbols are added to ``symbols``, pairs that spell a known piece are banned there. Chains are looked up by
    the pairs they hold, so a merge touches only those.
    """
    known = set(symbols.spelling)
    held = [np.frombuffer(chain, "<i4").tolist() for chain, _ in chains]
    weights = [n for _, n in chains]
    counts: Counter[int] = Counter()
    where: dict[int, set[int]] = defaultdict(set)
    for at, (chain, n) in enumerate(zip(held, weights)):
        for a, b in zip(chain, chain[1:]):
            pair = a << SHIFT | b
            counts[pair] += n
            where[pair].add(at)
    heap = [symbols.order(p, n) for p, n in counts.items() if symbols.allowed(p)]
    heapq.heapify(heap)
    made, touched = 0, set()
    while heap and made < merges:
        top = heap[0]
        pair = top[3]
        if counts[pair] != -top[0] or pair in symbols.banned:
            heapq.heappop(heap)
            continue
        if last is not None and top > last:
            break
        heapq.heappop(heap)
        if top[2] in known:
            symbols.banned.add(pair)
            continue
        left, right, new = pair >> SHIFT, pair & MASK, len(symbols.spelling)
        symbols.spelling.append(top[2])
        known.add(top[2])
        made += 1
        changed: Counter[int] = Counter()
        for at in where.pop(pair):
            old, n, out, i = held[at], weights[at], [], 0
            while i < len(old):
                if i + 1 < len(old) and old[i] == left and old[i + 1] == right:
                    out.append(new)
                    i += 2
                else:
                    out.append(old[i])
                    i += 1
            for a, b in zip(old, old[1:]):
                changed[a << SHIFT | b] -= n
            for a, b in zip(out, out[1:]):
                changed[a << SHIFT | b] += n
                where[a << SHIFT | b].add(at)
            held[at] = out
            touched.add(at)
        del counts[pair]
        changed.pop(pair, None)
        for other, n in changed.items():
            if n:
                counts[other] += n
                if counts[other] > 0 and symbols.allowed(other):
                    heapq.heappush(heap, symbols.order(other, counts[other]))
    return made, {chains[at][0]: np.array(held[at], "<i4") for at in touched}


def learn_bpe(
    word_counts: DataFrame, vocab_size: int = 32_000, coverage: float = 0.9995, max_length: int = 16,
    most_chains: int = MOST_CHAINS,
) -> DataFrame:
    """``piece, rank``: the trainer's own pieces, the merged pieces in the order they were made, and the characters.

    ``word_counts`` has ``token, freq``. There are ``vocab_size`` pieces, or fewer when no pair is left; a piece has
    at most ``max_length`` characters. The rarest characters beyond ``coverage`` of all uses are no pieces and part
    the words that hold them. The words are written once a round; the driver holds the pieces, the pairs asked for
    and at most ``most_chains`` chains.
    """
    spark = word_counts.sparkSession
    word_counts = word_counts.filter(F.col("token").isNotNull())
    characters = covered_characters(character_counts(word_counts), coverage)
    symbols = Symbols(characters, max_length)
    words = materialize(symbol_numbers(word_counts, characters).filter(F.size("ids") > 1), "pieces")
    left = vocab_size - len(TRAINER_PIECES) - len(characters)
    asked = FIRST_PAIRS
    while left > 0:
        order = pair_order(words, symbols, asked)
        if not order:
            break
        complete, use = len(order) < asked, len(order)
        while True:
            pairs = np.array(sorted(p for p, _ in order[:use]), np.int64)
            linked = np.union1d(pairs, np.array(list(symbols.banned), np.int64))
            chains = chain_counts(words, pairs, linked, most_chains if use > 1 else 1 << 30)
            if chains is not None:
                break
            use = max(1, use // 4)
        last = None if complete and use == len(order) else symbols.order(*order[use - 1])
        before = len(symbols.banned)
        made, became = merge_chains(chains, symbols, last, left)
        left -= made
        if not made and len(symbols.banned) == before:
            break
        if became:
            old, words = words, materialize(replace_chains(words, linked, became), "pieces")
            discard(old)
        room = most_chains // max(len(chains), 1)
        asked = max(FIRST_PAIRS, min(MOST_PAIRS, 2 * use if room >= 4 else use))
    discard(words)
    made = symbols.spelling[len(characters):]
    pieces = [*TRAINER_PIECES, *made, *characters]
    return spark.createDataFrame(list(zip(pieces, range(len(pieces)))), "piece string, rank bigint")
