"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue of its documents in a shuffled order, which may be served up to ``passes`` times.
A document's virtual finish time is the words its source has served up to and including it, divided by
the source's target. The queues are merged by a global sort on that time and cut where the words
taken reach the total budget.

Both running sums are made in two steps: totals of buckets - the first digits of the shuffle, or
ranges of the finish time - and sums inside each bucket. No source and no budget meets in one task.
Along its queue a source is taken up to some document, so the outcome is one row per source: whole
passes and the last place of the broken one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

WEIGHTS = (5, 2, 1)
PASSES = 3
BUCKET_ROWS = 32_768
TIME_RANGES = 4096
SHIPPED_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Runs of other than white space (U+0020, U+0009 to U+000D); 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def shuffle_place(row_id: Column, seed: str) -> Column:
    """A document's place in its queue: 16 hex digits, the same at every run."""
    key = F.coalesce(row_id.cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat(F.lit(seed + "|"), key)), 1, 16)


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``source, source_size, place, target`` from ``source, source_size``, one row per source.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share all words. A share above
    ``passes`` times the source is cut to that, and what is cut goes to the others by weight until no
    share is above: in the order of size over weight, a source is cut as long as its share
    of what the ones before it left is too large.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.col("place"), F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn.cast("int"))
    most = (F.col("source_size") * passes).cast("double")
    ratio = [most / F.col("weight"), F.col("place")]
    before = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ranked = (
        totals.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("budget", F.sum("source_size").over(every))
        .withColumn("left_words", F.col("budget") - F.coalesce(F.sum(F.col("source_size") * passes).over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    cut = most * F.col("left_weight") <= F.col("weight") * F.col("left_words").cast("double")
    marked = ranked.withColumn("cut", cut)
    # The first source that is not cut sees what all cut ones left.
    uncut = [F.max(F.when(~F.col("cut"), F.col(c))).over(every) for c in ("left_words", "left_weight")]
    share = F.col("weight") * uncut[0].cast("double") / uncut[1]
    return marked.withColumn("target", F.when(F.col("cut"), most).otherwise(share)).select(
        "source", "source_size", "place", "target", "budget"
    )


def _running(df: DataFrame, within: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` up to each row in ``within``, by buckets that follow the order."""
    totals = df.groupBy(*within, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*within, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*within, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = df.join(offsets, [*within, bucket])
    return joined.withColumn(out, F.col("_before") + F.sum(value).over(inside)).drop("_before")


def cutoffs(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``source, source_size, target, full, last`` per source: passes taken whole, and the place up to which
    the next pass goes.

    ``sized`` has ``source, size, shuffle`` and should be a written table. Rows of a source that
    share a place (repeated ids) are served together.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = materialize(targets(totals, weights, passes), "shares")
    digits = 1
    rows = sized.count()
    while rows >> (4 * digits) > BUCKET_ROWS:
        digits += 1
    served = sized.filter("size > 0").groupBy("source", "shuffle").agg(F.sum("size").alias("size"))
    # A NULL source is a source of its own; its place stands for it in every join on.
    names = shares.filter("target > 0").select(F.col("source").alias("_s"), "source_size", "place", "target", "budget")
    queued = served.join(names, served["source"].eqNullSafe(F.col("_s"))).drop("_s", "source")
    queued = queued.withColumn("bucket", F.substring("shuffle", 1, digits))
    queued = _running(queued, ["place"], "bucket", ["shuffle"], "size", "served")
    turns = queued.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    turns = turns.withColumn("reach", F.col("turn") * F.col("source_size") + F.col("served"))
    turns = turns.filter(F.col("reach") - F.col("size") < F.col("target")).select(
        "place", "shuffle", "turn", "size", "budget", (F.col("reach") / F.col("target")).alias("finish")
    )
    turns = turns.withColumn("range", F.floor(F.least("finish", F.lit(2.0)) * TIME_RANGES))
    # Only one row per range goes through the window that has no partition.
    merged = _running(turns, [], "range", ["finish", "place", "turn", "shuffle"], "size", "total")
    taken = merged.filter(F.col("total") <= F.col("budget"))
    ends = taken.groupBy("place").agg(F.max(F.struct("turn", "shuffle")).alias("end"))
    return shares.join(ends, "place", "left").select(
        "source", "source_size", "target",
        F.coalesce("end.turn", F.lit(0)).cast("bigint").alias("full"), F.col("end.shuffle").alias("last"),
    )


def _with_cutoffs(df: DataFrame, source_column: str, ends: DataFrame) -> DataFrame:
    """``df`` with its source's row, whose columns start with an underscore."""
    ends = ends.select(*[F.col(c).alias(f"_mix_{c}") for c in ends.columns])
    if ends.limit(SHIPPED_SOURCES + 1).count() <= SHIPPED_SOURCES:
        ends = F.broadcast(ends)
    return df.join(ends, df[source_column].eqNullSafe(F.col("_mix_source")), "left")


def _times(shuffle: Column) -> Column:
    return F.col("_mix_full") + F.when(shuffle <= F.col("_mix_last"), 1).otherwise(0)


def _sized(df: DataFrame, id_column: str, text_column: str, source_column: str, seed: str) -> DataFrame:
    return df.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        word_count(F.col(text_column)).alias("size"), shuffle_place(F.col(id_column), seed).alias("shuffle"),
    )


def plan_mix(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: str = "mix",
) -> DataFrame:
    """``id, size, source_size, target, taken`` for every row of ``df``.

    ``taken`` is the number of words the mix takes of the row, a multiple of its size up to ``passes``.
    NULL text has no words; a NULL source is a source; rows that share an id and a source, NULL ids
    among them, are taken together. An empty table gives an empty table. Other columns are ignored.
    """
    sized = materialize(_sized(df, id_column, text_column, source_column, seed), "sized")
    ends = materialize(cutoffs(sized, weights, passes), "cutoffs")
    return _with_cutoffs(sized, "source", ends).select(
        F.col("id").alias(id_column), "size", F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("size") * _times(F.col("shuffle"))).alias("taken"),
    )


def mix(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: str = "mix",
) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, with all their columns.

    Texts are not shuffled: a row needs only its source's cutoff. Rows without a word are not taken.
    """
    sized = materialize(_sized(df, id_column, text_column, source_column, seed), "sized")
    ends = materialize(cutoffs(sized, weights, passes), "cutoffs")
    times = F.when(word_count(F.col(text_column)) > 0, _times(shuffle_place(F.col(id_column), seed)))
    counted = _with_cutoffs(df, source_column, ends).select(*df.columns, times.cast("int").alias("_mix_times"))
    repeated = counted.filter("_mix_times > 0").withColumn(
        "_mix_turn", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))
    )
    return repeated.select(*df.columns)
