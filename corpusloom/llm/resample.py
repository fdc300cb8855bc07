"""Resampling a corpus towards a target set, by importance weights of hashed features and Gumbel noise.

Every run of one to ``longest`` words is a feature, and a hash deals features into a fixed number of buckets.
The logarithm of how much more frequent a bucket is in the target than in the corpus is its gain; a document's
weight is the mean gain of its features, looked up in one array that goes to every task with the plan. Adding
Gumbel noise, drawn from a hash of the document's id, and taking the highest scores draws documents without
replacement in proportion to the exponential of their weights.

The cutoff of the draw is found without sorting the corpus. A quantile sketch brackets it between two scores,
exact counts of what lies above the bracket and inside it say whether the cutoff is there, and the bracket is
widened until it is. Only the rows inside the bracket are sorted. What is drawn is then numbered in the order of
its scores by range partitions.

Columns only, but for the running count of the numbering. The driver sees the totals of the buckets, whose
number is a parameter, and a few counts.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.ranking import with_row_number
from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
ACCURACY = 10_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Letters and digits in a row, A-Z in lower case, all that is not ASCII counted as letters; none for NULL."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def features(tokens: Column, longest: int = LONGEST) -> Column:
    """All runs of 1 to ``longest`` consecutive words, joined by one space, with repeats."""
    def of_width(width: int) -> Column:
        last = F.size(tokens) - width
        runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(tokens, i + 1, width), " "))
        return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))

    return F.concat(tokens, *[of_width(w) for w in range(2, longest + 1)]) if longest > 1 else tokens


def buckets(found: Column, count: int = BUCKETS) -> Column:
    """The bucket of each feature: its CRC-32 modulo ``count``."""
    return F.transform(found, lambda f: F.pmod(F.crc32(f.cast("binary")), F.lit(count)).cast("int"))


def _bucketed(df: DataFrame, text_column: str, longest: int, count: int) -> Column:
    return buckets(features(words(F.col(text_column)), longest), count)


def bucket_counts(df: DataFrame, text_column: str = "text", longest: int = LONGEST, count: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over the features of all texts; a task sends one row per bucket at most."""
    rows = df.select(_bucketed(df, text_column, longest, count).alias("buckets"))
    return unnest(rows, "buckets", value="bucket").groupBy("bucket").agg(F.count("*").alias("n"))


def bucket_gains(
    corpus: DataFrame, target: DataFrame, text_column: str = "text", target_column: str = "text",
    longest: int = LONGEST, count: int = BUCKETS,
) -> list[int]:
    """One thousand times the logarithm of target over corpus frequency per bucket, one added to each count."""
    mine = bucket_counts(corpus, text_column, longest, count).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, target_column, longest, count).withColumnRenamed("n", "t")
    every = corpus.sparkSession.range(count).select(F.col("id").cast("int").alias("bucket"))
    both = materialize(every.join(mine, "bucket", "left").join(theirs, "bucket", "left").fillna(0, ["s", "t"]), "gains")
    totals = both.agg(F.sum("s").cast("double").alias("ss"), F.sum("t").cast("double").alias("tt")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * F.lit(totals.ss + count) / ((s + 1) * F.lit(totals.tt + count))
    gains = both.select("bucket", F.floor(F.log(ratio) * 1000).cast("bigint").alias("gain"))
    return [r.gain for r in gains.orderBy("bucket").collect()]


def mean_gain(found: Column, gains: list[int]) -> Column:
    """The mean of the gains of an array of buckets, rounded down; 0 for an empty one."""
    array = F.expr(f"CAST(split('{','.join(map(str, gains))}', ',') AS ARRAY<BIGINT>)")
    total = F.aggregate(found, F.lit(0).cast("bigint"), lambda a, b: a + F.get(array, b))
    size = F.size(found).cast("bigint")
    below = F.call_function("div", total - F.pmod(total, size), size)
    return F.when(size > 0, below).otherwise(F.lit(0)).cast("bigint")


def gumbel(row_id: Column, seed: str = SEED) -> Column:
    """One thousand times a standard Gumbel draw, rounded down, from the first 32 bits of a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / F.lit(4294967296.0))) * -1000).cast("bigint")


@dataclass
class Bracket:
    """Scores from ``low`` to ``high`` and the exact number of rows above and inside; None is no bound."""

    low: int | None
    high: int | None
    above: int = 0
    inside: int = 0

    def rows(self, df: DataFrame, score: str) -> DataFrame:
        if self.low is not None:
            df = df.filter(F.col(score) >= self.low)
        return df if self.high is None else df.filter(F.col(score) <= self.high)


def bracket_cutoff(df: DataFrame, draw: int, total: int, score: str = "score", accuracy: int = ACCURACY) -> Bracket:
    """Scores between which the ``draw``-th highest of ``total`` rows lies, 1 <= draw <= total.

    The sketch's two quantiles lie two of its errors to either side of the cutoff. If the exact counts say that
    the cutoff is outside, the distance is multiplied by eight; a side that reaches the end has no bound.
    """
    distance, at = 2.0 / accuracy, 1 - draw / total
    while True:
        low, high = at - distance, at + distance
        asked = [q for q in (low, high) if 0 < q < 1]
        found = list(df.agg(F.percentile_approx(score, asked, accuracy).alias("q")).first().q) if asked else []
        bracket = Bracket(found.pop(0) if low > 0 else None, found.pop(0) if high < 1 else None)
        above = F.lit(0) if bracket.high is None else F.count_if(F.col(score) > bracket.high)
        reach = F.count("*") if bracket.low is None else F.count_if(F.col(score) >= bracket.low)
        seen = df.agg(above.alias("above"), reach.alias("reach")).first()
        if seen.above < draw <= seen.reach:
            bracket.above, bracket.inside = seen.above, seen.reach - seen.above
            return bracket
        distance *= 8


def draw_highest(df: DataFrame, draw: int, total: int, id_column: str, score: str = "score", accuracy: int = ACCURACY) -> DataFrame:
    """``df`` with ``rank`` from 1 for the ``draw`` highest scores, ties to the smaller id, NULL for all others.

    ``df`` is a written table of which the rows with a true ``eligible`` (``total`` of them) take part.
    """
    none = F.lit(None).cast("bigint")
    if not draw:
        return df.withColumn("rank", none)
    order = [F.col(score).desc(), F.col(id_column).asc_nulls_first()]
    able = df.filter("eligible")
    bracket = bracket_cutoff(able, draw, total, score, accuracy)
    inside = with_row_number(bracket.rows(able, score).select(score, id_column), order, "_place")
    last = inside.filter(F.col("_place") == draw - bracket.above - 1).first()
    kind = df.schema[id_column].dataType
    tied = F.col(id_column).isNull() | F.coalesce(F.col(id_column) <= F.lit(last[id_column]).cast(kind), F.lit(False))
    reaches = F.col("eligible") & ((F.col(score) > last[score]) | ((F.col(score) == last[score]) & tied))
    drawn = with_row_number(df.filter(reaches), order, "_place")
    # Rows that share the last id are all numbered; only as many as are drawn keep their number.
    ranked = drawn.withColumn("rank", F.when(F.col("_place") < draw, F.col("_place") + 1)).drop("_place")
    return ranked.unionByName(df.filter(~reaches).withColumn("rank", none))


def resample(
    corpus: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
    longest: int = LONGEST, count: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
    seed: str = SEED, accuracy: int = ACCURACY,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` for every row of ``corpus``.

    The highest ``percent`` of a hundred of the scores among rows with ``least_words`` words or more (their number
    rounded down) are drawn and ranked from 1; ``rank`` is NULL for all others. NULL and empty texts have no
    features and the weight 0. Rows that share an id share their noise, and among equal scores the smaller id goes
    first, NULL before all; of rows equal in both any one is drawn. An empty corpus gives an empty table, an
    empty target makes rare buckets gain. Other columns are ignored; texts of any length are counted whole.
    """
    gains = bucket_gains(corpus, target, text_column, target_column, longest, count)
    tokens = corpus.select(F.col(id_column).alias("id"), words(F.col(text_column)).alias("tokens"))
    hashed = tokens.select("id", F.size("tokens").alias("n_words"), buckets(features(F.col("tokens"), longest), count).alias("found"))
    scored = hashed.select(
        "id", F.size("found").cast("bigint").alias("n_features"), mean_gain(F.col("found"), gains).alias("weight"),
        (F.col("n_words") >= least_words).alias("eligible"),
    ).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = materialize(scored, "scored")
    total = scored.filter("eligible").count()
    ranked = draw_highest(scored, percent * total // 100, total, "id", "score", accuracy)
    return ranked.select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")
