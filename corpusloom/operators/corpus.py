"""Rows of a corpus: sentences, lines, tokens, and the filters applied to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.arrays import norm
from corpusloom.functions.hashing import digest
from corpusloom.plans.unnest import unnest


def drop_empty(df: DataFrame, column: str = "text") -> DataFrame:
    """Strip the text and drop rows with nothing left."""
    return df.withColumn(column, tx.strip(F.col(column))).filter(F.length(column) > 0)


def drop_malformed(df: DataFrame, fields: int, column: str = "text") -> DataFrame:
    """Keep lines that have exactly ``fields`` record-separated fields."""
    return df.filter(F.size(tx.split_record(F.col(column))) == fields)


def binarize_label(label: Column, threshold: float = 0.5) -> Column:
    return F.when(label > threshold, 1).otherwise(0)


def tag_document(tag: Column, prefix: str = "MOVIE_") -> Column:
    return F.concat(F.lit(prefix), tag.cast("string"))


def explode_lines(df: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    """``keep``, ``line_no``, ``text``: the lines of each document."""
    return unnest(df, F.split(column, "\n"), *keep, value="text", pos="line_no")


def explode_sentences(df: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    """``keep``, ``sent_no``, ``text``: the sentences of each document."""
    return unnest(df, tx.split_sentences(F.col(column)), *keep, value="text", pos="sent_no")


def explode_tokens(df: DataFrame, column: str = "tokens", *keep: str) -> DataFrame:
    """``keep``, ``pos``, ``token``: the long form of token arrays."""
    return unnest(df, column, *keep, value="token", pos="pos")


def sample_rows(df: DataFrame, n: int, seed: object, *keys: str) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run."""
    order = digest(seed, *[F.col(k) for k in keys])
    return df.withColumn("_draw", order).orderBy("_draw", *keys).limit(n).drop("_draw")


def eval_word_set(lines: DataFrame, column: str = "text") -> DataFrame:
    """Distinct words of an evaluation file; comment lines do not count."""
    kept = lines.filter(~F.col(column).startswith("#"))
    words = F.array_remove(F.split(tx.strip(F.col(column)), " "), "")
    return unnest(kept, words, value="word").distinct()


def drop_zero_vectors(df: DataFrame, column: str = "vec") -> DataFrame:
    return df.filter(norm(F.col(column)) > 0)


def oov_tokens(tokens: DataFrame, vectors: DataFrame, token: str = "token", key: str = "key") -> DataFrame:
    """Tokens without a vector and how often they were looked up.

    Occurrences are added up before the join, so a frequent token is one row.
    """
    counts = tokens.groupBy(F.col(token).alias("token")).agg(F.count("*").alias("missed"))
    known = vectors.select(F.col(key).alias("token"))
    return counts.join(known, "token", "left_anti")
