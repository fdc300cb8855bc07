"""Tables, shared steps and SQL fragments of the query catalog."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITESPACE, whitespace_tokens
from corpusloom.operators.corpus import explode_lines
from corpusloom.operators.vocabulary import token_counts
from corpusloom.plans.ranking import top_ranked
from corpusloom.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

WS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


class Catalog:
    """Queries by name, each with the SQL that gives the same rows where there is one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows out when the scan gives fewer splits than there are cores.

    A table of many files is left as it is; one that is a single row group would otherwise be
    cleaned and tokenized by a single task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, line_no, text``."""
    return explode_lines(documents(spark, sf), "text", "doc_id")


def token_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, line_no, tokens`` of the lines that hold any."""
    # The test for any token at all is made on the text: on the tokens it would split them twice.
    full = lines(spark, sf).filter(F.col("text").rlike(f"[^{WHITESPACE}]"))
    return full.select("doc_id", "line_no", whitespace_tokens(F.col("text")).alias("tokens"))


def token_docs(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", whitespace_tokens(F.col("text")).alias("tokens"))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(token_docs(spark, sf))


def stored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counts as a written table, for queries that read them more than once."""
    return materialize(counts(spark, sf), "counts")


def joined(col: Column | str) -> Column:
    """An array as space-separated text, the same in every engine."""
    return F.array_join(F.col(col) if isinstance(col, str) else col, " ")


LINE_KEY = ["doc_id", "line_no"]

# ---- SQL fragments; each is a common table expression

SQL_LINES = """
lines AS (
  SELECT doc_id, i - 1 AS line_no, line AS text FROM (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))"""

SQL_TOKEN_LINES = (
    SQL_LINES
    + f""",
token_lines AS (
  SELECT * FROM (
    SELECT doc_id, line_no,
           list_filter(string_split_regex(text, '{WS}+'), lambda t: t <> '') AS tokens
    FROM lines) WHERE len(tokens) > 0)"""
)

SQL_TOKENS = (
    SQL_TOKEN_LINES
    + """,
tokens AS (
  SELECT doc_id, line_no, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos
  FROM token_lines)"""
)

SQL_COUNTS = (
    SQL_TOKENS + """,
counts AS (SELECT token, count(*) AS freq FROM tokens GROUP BY token)"""
)


# The vocabulary of the co-occurrence and encoding queries: words counted at least LEAST times, at most WORDS.
WORDS, LEAST = 102_400, 5


def common_words(spark: SparkSession, sf: str) -> DataFrame:
    """``id, token, freq`` of that vocabulary."""
    return top_ranked(counts(spark, sf).filter(F.col("freq") >= LEAST), WORDS, "freq", "token")


def sql_ranked(k: int, name: str = "ranked", least: int = 0) -> str:
    return f"""
{name} AS (
  SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) - 1 AS id FROM counts WHERE freq >= {least}
  QUALIFY id < {k})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)
