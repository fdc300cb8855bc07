"""Vocabularies from token counts, and encoding of tokens as ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import pad_right
from corpusloom.plans.lookup import lookup_array, lookup_rows
from corpusloom.plans.ranking import top_ranked, with_row_number
from corpusloom.plans.unnest import unnest
from corpusloom.sources.writers import vocab_with_specials

# Marks that open a language-model vocabulary, and its character codes.
LM_MARKS = ["</S>", "<S>", "<UNK>"]
BOS_CHAR, EOS_CHAR, BOW_CHAR, EOW_CHAR, PAD_CHAR = 256, 257, 258, 259, 260


def token_counts(df: DataFrame, column: str = "tokens") -> DataFrame:
    """``token, freq``; counts are added up before the shuffle, so a frequent token is cheap."""
    return unnest(df, column, value="token").groupBy("token").agg(F.count("*").alias("freq"))


def token_total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("freq").cast("bigint").alias("total"))


def vocab_top_k(counts: DataFrame, k: int = 100_000, specials: list[str] | None = None) -> DataFrame:
    """``id, token``: special tokens, then the ``k`` commonest; ties by token."""
    ranked = top_ranked(counts, k, "freq", "token").select("id", "token")
    return vocab_with_specials(ranked, LM_MARKS if specials is None else specials)


def vocab_ranked(counts: DataFrame) -> DataFrame:
    """``id, token, freq``: every token by descending count, ties by token.

    For vocabularies without a size limit; the order is made by range partitions.
    """
    return with_row_number(counts, [F.col("freq").desc(), F.col("token")], "id").select("id", "token", "freq")


def vocab_sharded(
    counts: DataFrame, max_size: int = 102_400, min_count: int = 5, shard: int = 4096
) -> DataFrame:
    """``id, token, freq``: the commonest tokens, without rare ones, a multiple of ``shard`` long."""
    ranked = top_ranked(counts, max_size, "freq", "token").filter(F.col("freq") >= min_count)
    size = ranked.agg(F.count("*") - F.count("*") % shard).scalar()
    return ranked.filter(F.col("id") < size).select("id", "token", "freq")


def vocab_min_count(counts: DataFrame, min_count: int = 5) -> DataFrame:
    return counts.filter(F.col("freq") >= min_count)


def vocab_for_training(counts: DataFrame, k: int = 50_000) -> DataFrame:
    """``id, token``: the ``k`` commonest training tokens, then rows for unknown and padding."""
    ranked = top_ranked(counts, k, "freq", "token").select("id", "token")
    size = ranked.agg(F.count("*")).scalar()
    spark = counts.sparkSession
    extra = spark.createDataFrame([(0, "<UNK>"), (1, "<PAD>")], "at bigint, token string")
    return ranked.unionByName(extra.select((size + F.col("at")).alias("id"), "token"))


def in_vocab(
    df: DataFrame, vocab: DataFrame, row_key: list[str], column: str = "tokens", out: str = "ids",
    weight: str | None = None,
) -> DataFrame:
    """Ids of the tokens that the vocabulary holds; the others go and positions close up."""
    return lookup_array(df, column, out, vocab, "token", "id", row_key, None, weight)


def encode_with_unknown(
    df: DataFrame, vocab: DataFrame, row_key: list[str], unknown: int, column: str = "tokens",
    out: str = "ids", weight: str | None = None,
) -> DataFrame:
    """Ids of all tokens, ``unknown`` for those the vocabulary lacks."""
    return lookup_array(df, column, out, vocab, "token", "id", row_key, unknown, weight)


def encode_strict(
    df: DataFrame, vocab: DataFrame, row_key: list[str], column: str = "tokens", out: str = "ids"
) -> DataFrame:
    """Ids of all tokens; a token the vocabulary lacks makes the query fail."""
    missing = -1
    coded = encode_with_unknown(df, vocab, row_key, missing, column, out)
    at = F.array_position(out, missing).cast("int")
    message = F.concat(F.lit("token not in the vocabulary: "), F.element_at(column, at))
    checked = F.when(F.array_contains(out, missing), F.raise_error(message).cast("array<bigint>"))
    return coded.withColumn(out, checked.otherwise(F.col(out)))


def wrap_sentence(ids: Column, bos: int, eos: int, reverse: bool = False) -> Column:
    """Ids between sentence marks; a reversed sentence swaps order and marks."""
    if reverse:
        return F.concat(F.array(F.lit(eos)), F.reverse(ids), F.array(F.lit(bos)))
    return F.concat(F.array(F.lit(bos)), ids, F.array(F.lit(eos)))


def decode_ids(
    df: DataFrame, vocab: DataFrame, row_key: list[str], column: str = "ids", out: str = "text"
) -> DataFrame:
    """Tokens of the ids, joined by one space."""
    named = lookup_array(df, column, "_tokens", vocab, "id", "token", row_key)
    return named.withColumn(out, F.array_join("_tokens", " ")).drop("_tokens")


def decode_rows(long: DataFrame, vocab: DataFrame, column: str = "id") -> DataFrame:
    """Long form of ``decode_ids``: one row per id, with its token."""
    return lookup_rows(long, column, vocab, "id", "token")


def char_ids(token: Column, max_length: int) -> Column:
    """Byte codes of a token between word marks, padded; all moved up by one, 0 being the mask."""
    size = max_length - 2
    digits = F.substring(F.hex(F.encode(token, "UTF-8")), 1, 2 * size)
    pairs = F.regexp_extract_all(digits, F.lit(".."), F.lit(0))
    codes = F.transform(pairs, lambda h: F.conv(h, 16, 10).cast("int") + 1)
    framed = F.concat(F.array(F.lit(BOW_CHAR + 1)), codes, F.array(F.lit(EOW_CHAR + 1)))
    return pad_right(framed, max_length, PAD_CHAR + 1)


def mark_char_ids(mark: int, max_length: int) -> Column:
    """The row of a sentence mark."""
    framed = F.array(F.lit(BOW_CHAR + 1), F.lit(mark + 1), F.lit(EOW_CHAR + 1))
    return pad_right(framed, max_length, PAD_CHAR + 1)


def encode_chars(tokens: Column, max_length: int = 30) -> Column:
    """One row of character codes per token, between the rows of the sentence marks."""
    rows = F.transform(tokens, lambda t: char_ids(t, max_length))
    return F.concat(
        F.array(mark_char_ids(BOS_CHAR, max_length)), rows, F.array(mark_char_ids(EOS_CHAR, max_length))
    )


def shift_mask_ids(ids: Column, length: Column | int) -> Column:
    """Ids moved up by one and padded with the mask 0."""
    return pad_right(F.transform(ids, lambda i: i + 1), length, 0)
