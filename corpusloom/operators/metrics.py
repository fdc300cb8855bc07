"""Model metrics from tables of predictions and losses."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.ranking import with_prefix


def masked_lm_metrics(df: DataFrame) -> DataFrame:
    """``accuracy, loss`` weighted by ``weight`` over ``label, predicted, loss``."""
    weight = F.sum("weight")
    hit = F.when(F.col("label") == F.col("predicted"), F.col("weight")).otherwise(F.lit(0.0))
    return df.agg(
        F.coalesce(F.try_divide(F.sum(hit), weight), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.try_divide(F.sum(F.col("weight") * F.col("loss")), weight), F.lit(0.0)).alias("loss"),
    )


def next_sentence_metrics(df: DataFrame) -> DataFrame:
    hit = (F.col("label") == F.col("predicted")).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"), F.avg("loss").alias("loss"))


def perplexity(df: DataFrame) -> DataFrame:
    return df.agg(F.exp(F.avg("loss")).alias("perplexity"))


def running_perplexity(df: DataFrame, step: str = "step") -> DataFrame:
    """``step, batch_perplexity, perplexity``: exp of the mean loss up to each step."""
    counted = df.select(step, F.col("loss").cast("double").alias("loss"), F.lit(1).cast("bigint").alias("_one"))
    so_far = with_prefix(counted, [F.col(step)], {"_sum": ("sum", "loss"), "_n": ("sum", "_one")})
    mean = (F.col("_sum") + F.col("loss")) / (F.col("_n") + 1)
    return so_far.select(step, F.exp("loss").alias("batch_perplexity"), F.exp(mean).alias("perplexity"))


def interval_losses(df: DataFrame, every: int, step: str = "step") -> DataFrame:
    """``interval, loss``: the mean loss of each run of ``every`` steps, steps counting from 1."""
    interval = F.floor((F.col(step) - 1) / every).cast("bigint")
    return df.groupBy(interval.alias("interval")).agg(F.avg("loss").alias("loss"))


def bits_per_char(df: DataFrame, every: int, step: str = "step") -> DataFrame:
    """``interval, bits, perplexity`` of each logging interval."""
    means = interval_losses(df, every, step)
    return means.select(
        "interval", (F.col("loss") / math.log(2)).alias("bits"), F.exp("loss").alias("perplexity")
    )


def best_checkpoints(df: DataFrame, step: str = "step", score: str = "score") -> DataFrame:
    """The steps whose score beats every earlier one; the score to beat at the start is 0."""
    rows = df.select(step, F.col(score).cast("double").alias(score))
    so_far = with_prefix(rows, [F.col(step)], {"_best": ("max", score)})
    return so_far.filter(F.col(score) > F.greatest(F.coalesce("_best", F.lit(0.0)), F.lit(0.0))).drop("_best")


def argmax_prediction(logits: Column) -> Column:
    """Class of the greatest logit, the first one if tied."""
    return F.array_position(logits, F.array_max(logits)) - 1
