"""Fixed-length training examples from encoded sentences.

Every random choice is a hash of the seed and the example's key. Documents stay one row each, so
packing, masking and padding run inside rows; only the choice of a foreign second sentence joins
documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import fill, let, pad_left, pad_right
from corpusloom.functions.hashing import DRAWS, digest, draw, draw_of, pick, uniform
from corpusloom.plans.ranking import with_hash_order, with_row_number
from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize

# Ids of the special tokens in a word-piece vocabulary that opens with
# [PAD] [UNK] [CLS] [SEP] [MASK], and in the left-padded layout.
PAD, UNK, CLS, SEP, MASK = 0, 1, 2, 3, 4
LEFT_CLS, LEFT_SEP = 3, 4
SEGMENT_A, SEGMENT_CLS, SEGMENT_PAD = 0, 2, 4


def lits(*values: int) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def zeros(count: Column) -> Column:
    return fill(0, count).cast("array<bigint>")


def ones(count: Column) -> Column:
    return fill(1, count).cast("array<bigint>")


def _counting(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


# ------------------------------------------------------------------ classifier inputs


def features_right_pad(ids: Column, length: int = 128, cls: int = CLS, sep: int = SEP) -> Column:
    """``input_ids, input_mask, segment_ids`` between marks, padded with zeros on the right."""
    body = F.concat(lits(cls), F.slice(ids, 1, length - 2), lits(sep))

    def struct(seq: Column) -> Column:
        return F.struct(
            pad_right(seq, length, PAD).alias("input_ids"),
            pad_right(ones(F.size(seq)), length, 0).alias("input_mask"),
            zeros(F.lit(length)).alias("segment_ids"),
        )

    return let(body, struct)


def features_left_pad(ids: Column, length: int = 64) -> Column:
    """As above with separator and class mark at the end and the padding on the left.

    The mask is 1 where there is padding.
    """
    def struct(kept: Column) -> Column:
        n = F.size(kept)
        return F.struct(
            pad_left(F.concat(kept, lits(LEFT_SEP, LEFT_CLS)), length, PAD).alias("input_ids"),
            pad_left(zeros(n + 2), length, 1).alias("input_mask"),
            pad_left(F.concat(zeros(n + 1), lits(SEGMENT_CLS)), length, SEGMENT_PAD).alias("segment_ids"),
        )

    return let(F.slice(ids, 1, length - 2), struct)


def features_batch_pad(df: DataFrame, pad_id: int, batch: list[str], column: str = "ids") -> DataFrame:
    """Pad each row to the longest of its batch; ``length`` is the padded length.

    ``true_length`` tells the number of ids before padding.
    """
    longest = df.groupBy(*batch).agg(F.max(F.size(column)).alias("_longest"))
    return df.join(longest, batch).select(
        *[c for c in df.columns if c != column],
        pad_right(F.col(column), F.col("_longest"), pad_id).alias(column),
        F.col("_longest").cast("bigint").alias("length"),
        F.size(column).cast("bigint").alias("true_length"),
    )


def epoch_batches(
    df: DataFrame, batch_size: int, epochs: int, seed: object, key: str, remainder: str = "drop_one"
) -> DataFrame:
    """Add ``epoch, batch_no, place``: each epoch shuffles anew and is cut into batches.

    ``drop_one`` keeps int((n - 1) / size) batches, so a full last batch is lost when the size
    divides n; ``drop`` keeps all full batches; ``keep`` also the last short one.
    """
    copies = df.withColumn("epoch", F.explode(_counting(epochs)))
    order = digest(seed, F.col("epoch"), F.col(key))
    numbered = with_hash_order(copies, order, "_no", ["epoch"])
    n = df.agg(F.count("*")).scalar()
    full = {"drop_one": F.floor((n - 1) / batch_size), "drop": F.floor(n / batch_size)}
    if remainder != "keep":
        numbered = numbered.filter(F.col("_no") < full[remainder] * batch_size)
    return numbered.withColumn("batch_no", F.floor(F.col("_no") / batch_size).cast("bigint")).withColumn(
        "place", F.col("_no") % batch_size
    ).drop("_no")


# ------------------------------------------------------------------ sentence pairs


def duplicate_corpus(df: DataFrame, copies: int) -> DataFrame:
    """``copies`` rows for each row, told apart by ``copy``."""
    return df.withColumn("copy", F.explode(_counting(copies)))


def short_target(max_tokens: int, prob: float, seed: object, *keys: Column) -> Column:
    """The wanted length: mostly ``max_tokens``, with ``prob`` a length from 2 up to it."""
    short = 2 + pick(max_tokens - 1, f"{seed}/length", *keys)
    return F.when(uniform(f"{seed}/short", *keys) < prob, short).otherwise(F.lit(max_tokens).cast("bigint"))


def walk_segments(sizes: list[int], target: int, seed: object, *keys: object) -> Iterator[tuple[int, int, int, int]]:
    """``(start, cut, end, is_random)`` of the chunks of one document.

    Sentences gather until ``target`` tokens are reached. The first ``cut - start`` of them are
    part A. With a random second part the rest goes back and starts the next chunk.
    """
    start = 0
    while start < len(sizes):
        end, total = start, 0
        while end < len(sizes):
            total += sizes[end]
            end += 1
            if total >= target:
                break
        n = end - start
        cut = start + 1 if n < 2 else start + 1 + draw_of(f"{seed}/cut", *keys, start) % (n - 1)
        is_random = n == 1 or draw_of(f"{seed}/next", *keys, start) < DRAWS // 2
        yield start, cut, end, int(is_random)
        start = cut if is_random else end


CHUNK_FIELDS = ("start", "cut", "end", "is_random", "a_from", "a_to", "b_to")


def _with_chunks(docs: DataFrame, max_tokens: int, short_prob: float, seed: object, key: str) -> DataFrame:
    """Add ``target`` and ``_chunks``, the chunks of each document in sentences and in tokens."""
    aimed = docs.withColumn("target", short_target(max_tokens, short_prob, seed, F.col("copy"), F.col(key)))

    @F.pandas_udf("array<struct<" + ",".join(f"{name}:bigint" for name in CHUNK_FIELDS) + ">>")
    def walk(sizes: pd.Series, target: pd.Series, copy: pd.Series, doc: pd.Series) -> pd.Series:
        rows = []
        for s, t, c, d in zip(sizes, target, copy, doc):
            edge = [0, *np.cumsum(s).tolist()]
            chunks = walk_segments(list(s), t, seed, c, d)
            rows.append([dict(zip(CHUNK_FIELDS, (*k, edge[k[0]], edge[k[1]], edge[k[2]]))) for k in chunks])
        return pd.Series(rows)

    return aimed.withColumn("_chunks", walk("sizes", "target", "copy", key))


def pack_segments(
    docs: DataFrame, max_tokens: int, short_prob: float = 0.1, seed: object = 7, key: str = "doc_id"
) -> DataFrame:
    """The chunks of each document: ``start, cut, end`` in sentences, ``is_random``, ``target``.

    ``docs`` has ``sizes`` (tokens per sentence) and ``copy`` beside the key. Where a chunk
    starts depends on the one before, so a document is walked in order, but within its own row:
    only the sentence sizes go to Python and nothing is grouped.
    """
    walked = _with_chunks(docs, max_tokens, short_prob, seed, key)
    chunks = unnest(walked, "_chunks", key, "copy", "target", value="_c", pos="chunk_no")
    return chunks.select(key, "copy", "target", "chunk_no", *[f"_c.{name}" for name in CHUNK_FIELDS[:4]])


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def truncated_lengths(a: Column, b: Column, max_total: Column | int) -> tuple[Column, Column]:
    """Lengths after dropping one token at a time from the longer side, from B if equal."""
    limit = F.lit(max_total) if isinstance(max_total, int) else max_total
    half_up, half = F.ceil(limit / 2), F.floor(limit / 2)
    fits = a + b <= limit
    # The shorter side is spared up to half of the room; equal sides share it, A first.
    new_a = F.when(fits, a).when(b <= half, limit - b).when(a <= half, a).otherwise(half_up)
    new_b = F.when(fits, b).when(b <= half, b).when(a <= half, limit - a).otherwise(half)
    return new_a.cast("bigint"), new_b.cast("bigint")


def front_drops(dropped: Column, seed: object, *keys: Column) -> Column:
    """How many of ``dropped`` tokens fall off the front: a fair coin for each of them."""
    def heads(word: Column) -> Column:
        bits = F.least(F.lit(32), dropped - (word * 32))
        mask = (F.pow(F.lit(2.0), bits) - 1).cast("bigint")
        return F.bit_count(draw(seed, *keys, word).bitwiseAND(mask))

    words = F.when(
        dropped > 0, F.sequence(F.lit(0).cast("bigint"), F.floor((dropped - 1) / 32))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(F.transform(words, heads), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def truncate_pair(df: DataFrame, max_tokens: int, seed: object, keys: list[str]) -> DataFrame:
    """Cut ``tokens_a`` and ``tokens_b`` to ``max_tokens`` together, at random front or back."""
    a, b = F.size("tokens_a"), F.size("tokens_b")
    new_a, new_b = truncated_lengths(a, b, max_tokens)
    key = [F.col(k) for k in keys]
    planned = df.withColumn("_na", new_a).withColumn("_nb", new_b)
    planned = planned.withColumn("_fa", front_drops(a - F.col("_na"), f"{seed}/front_a", *key)).withColumn(
        "_fb", front_drops(b - F.col("_nb"), f"{seed}/front_b", *key)
    )
    return planned.withColumn(
        "tokens_a", F.slice("tokens_a", (F.col("_fa") + 1).cast("int"), F.col("_na").cast("int"))
    ).withColumn(
        "tokens_b", F.slice("tokens_b", (F.col("_fb") + 1).cast("int"), F.col("_nb").cast("int"))
    ).drop("_na", "_nb", "_fa", "_fb")


def next_sentence_pairs(
    docs: DataFrame, max_tokens: int, short_prob: float = 0.1, copies: int = 1, seed: object = 7, key: str = "doc_id"
) -> DataFrame:
    """``key, copy, chunk_no, is_random, tokens_a, tokens_b`` before truncation.

    ``docs`` has ``ids`` (all tokens of a document) and ``sizes`` (tokens per sentence, none
    empty). A random second part comes from another document: up to ten draws of a document
    number avoid the chunk's own. Only such chunks meet that document, by its number, which is drawn
    evenly, and take their slice of it as the rows are joined. The encoded documents are written once.
    """
    filled = materialize(docs.filter(F.size("sizes") > 0).select(key, "ids", "sizes"), "coded")
    numbers = with_row_number(filled.select(key), [F.col(key)], "doc_no")
    numbered = filled.join(numbers, key)
    n_docs = numbers.agg(F.count("*")).scalar()
    walked = _with_chunks(duplicate_corpus(numbered, copies), max_tokens, short_prob, seed, key)

    def part(first: Column, last: Column) -> Column:
        return F.slice("ids", (first + 1).cast("int"), (last - first).cast("int"))

    # The tokens are cut inside the document's row, so a chunk's row carries its own only.
    pieces = F.transform(
        "_chunks",
        lambda c: F.struct(
            c["is_random"].alias("is_random"), part(c["a_from"], c["a_to"]).alias("tokens_a"),
            F.when(c["is_random"] == 0, part(c["a_to"], c["b_to"])).alias("_next"),
        ),
    )
    chunks = unnest(walked, pieces, key, "copy", "target", "doc_no", value="_c", pos="chunk_no").select(
        key, "copy", "target", "doc_no", "chunk_no", "_c.*"
    )
    keys = [F.col("copy"), F.col(key), F.col("chunk_no")]
    tries = [pick(n_docs, f"{seed}/document/{i}", *keys) for i in range(10)]
    other = F.coalesce(*[F.when(t != F.col("doc_no"), t) for t in tries], tries[-1])
    random = F.col("is_random") == 1
    # A chunk that keeps its own second part meets nothing: its number is no document's, and spreads it.
    cut = chunks.select(
        key, "copy", "chunk_no", "target", "is_random", "tokens_a", "_next",
        F.when(random, other).otherwise(-1 - F.col("doc_no")).alias("_other"),
    )
    foreign = numbered.select(F.col("doc_no").alias("_other"), F.col("ids").alias("_ids"), F.col("sizes").alias("_sizes"))
    met = cut.join(foreign, "_other", "left").withColumn(
        "_begin", F.when(random, pick(F.size("_sizes"), f"{seed}/start", *keys))
    ).withColumn("_wanted", F.col("target") - F.size("tokens_a"))
    # At least one sentence, then more until the wanted length is reached.
    taken = F.aggregate(
        F.slice("_sizes", (F.col("_begin") + 1).cast("int"), F.size("_sizes")),
        F.lit(0).cast("bigint"),
        lambda acc, x: F.when((acc > 0) & (acc >= F.col("_wanted")), acc).otherwise(acc + x),
    )
    offset = _total(F.slice("_sizes", F.lit(1), F.col("_begin").cast("int")))
    drawn = F.slice("_ids", (offset + 1).cast("int"), taken.cast("int"))
    return met.select(
        key, "copy", "chunk_no", "is_random", "tokens_a", F.when(random, drawn).otherwise(F.col("_next")).alias("tokens_b")
    )


def assemble_pair(a: Column, b: Column, cls: int = CLS, sep: int = SEP) -> Column:
    """``ids`` of both parts between marks, and ``segments``: 0 up to the first separator, then 1."""
    return F.struct(
        F.concat(lits(cls), a, lits(sep), b, lits(sep)).alias("ids"),
        F.concat(zeros(F.size(a) + 2), ones(F.size(b) + 1)).alias("segments"),
    )


def mask_tokens(
    df: DataFrame, vocab_size: int, keys: list[str], prob: float = 0.15, max_predictions: int = 20,
    seed: object = 7, column: str = "ids", specials: tuple[int, ...] = (CLS, SEP),
) -> DataFrame:
    """Add ``masked`` (the ids with masks), ``positions`` (sorted) and ``labels``.

    min(max, max(1, round(n * prob))) places are chosen among those that hold no special mark.
    Of them 80 % become the mask, 10 % stay, 10 % become a random word.
    """
    key = [F.col(k) for k in keys]
    wanted = F.least(F.lit(max_predictions), F.greatest(F.lit(1), F.bround(F.size(column) * F.lit(prob)).cast("int")))
    places = F.filter(
        F.transform(column, lambda x, i: F.when(~x.isin(*specials), i)), lambda i: i.isNotNull()
    )
    shuffled = F.sort_array(
        F.transform(places, lambda i: F.struct(digest(f"{seed}/place", *key, i).alias("h"), i.alias("i")))
    )
    chosen = F.sort_array(F.transform(F.slice(shuffled, F.lit(1), F.col("_wanted")), lambda s: s["i"]))
    picked = df.withColumn("_wanted", wanted).withColumn("positions", chosen).drop("_wanted")

    def replaced(x: Column, i: Column) -> Column:
        return (
            F.when(uniform(f"{seed}/mask", *key, i) < 0.8, F.lit(MASK).cast("bigint"))
            .when(uniform(f"{seed}/keep", *key, i) < 0.5, x)
            .otherwise(pick(vocab_size, f"{seed}/word", *key, i))
        )

    masked = F.transform(
        column, lambda x, i: F.when(F.array_contains("positions", i), replaced(x, i)).otherwise(x)
    )
    return picked.withColumn("masked", masked).withColumn(
        "labels", F.transform("positions", lambda p: F.get(column, p))
    )


def pad_masked_example(df: DataFrame, length: int, max_predictions: int = 20) -> DataFrame:
    """The fixed-length example out of ``masked, segments, positions, labels, is_random``."""
    n, m = F.size("masked"), F.size("positions")
    rest = [c for c in df.columns if c not in ("ids", "masked", "segments", "positions", "labels", "is_random", "tokens_a", "tokens_b")]
    return df.select(
        *rest,
        pad_right(F.col("masked"), length, PAD).alias("input_ids"),
        pad_right(ones(n), length, 0).alias("input_mask"),
        pad_right(F.col("segments"), length, 0).alias("segment_ids"),
        pad_right(F.col("positions"), max_predictions, 0).alias("masked_lm_positions"),
        pad_right(F.col("labels"), max_predictions, PAD).alias("masked_lm_ids"),
        F.concat(fill(1.0, m), fill(0.0, max_predictions - m)).alias("masked_lm_weights"),
        F.col("is_random").alias("next_sentence_label"),
    )


def masked_pair_examples(
    docs: DataFrame, vocab_size: int, length: int = 128, max_predictions: int = 20, prob: float = 0.15,
    short_prob: float = 0.1, copies: int = 5, seed: object = 7, key: str = "doc_id",
) -> DataFrame:
    """All steps from documents to padded examples."""
    keys = [key, "copy", "chunk_no"]
    pairs = next_sentence_pairs(docs, length - 3, short_prob, copies, seed, key)
    cut = truncate_pair(pairs, length - 3, seed, keys)
    whole = cut.withColumn("_p", assemble_pair(F.col("tokens_a"), F.col("tokens_b"))).select(
        *keys, "is_random", "_p.ids", "_p.segments"
    )
    return pad_masked_example(mask_tokens(whole, vocab_size, keys, prob, max_predictions, seed), length, max_predictions)
