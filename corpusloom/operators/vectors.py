"""Vectors of sentences, similarity, analogy and nearest-label queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.arrays import add, dot, let, norm, scale, subtract, unit
from corpusloom.operators.corpus import sample_rows
from corpusloom.plans.blocks import best_matches
from corpusloom.plans.lookup import in_parts, map_blocks, small_table
from corpusloom.plans.ranking import average_ranks
from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize

MAX_VECTOR_WORDS = 200_000
PAIR_BLOCK = 1000
TOKENS_AT_ONCE = 100_000
BLOCK_ELEMENTS = 1 << 21


def l2_normalize(df: DataFrame, column: str = "vec") -> DataFrame:
    return df.withColumn(column, unit(F.col(column)))


def sum_word_vectors(
    df: DataFrame, vectors: DataFrame, row_key: list[str], column: str = "tokens",
    weight: str | None = None, max_words: int = MAX_VECTOR_WORDS,
) -> DataFrame:
    """Add ``vec`` (sum of the known words' vectors), ``known`` and ``total`` (token counts).

    ``vectors`` has ``key, vec``. A table of modest size is shipped and rows are summed in
    place; of a larger one each block of rows gets the vectors of its distinct words. ``row_key`` and ``weight``
    describe the rows and the table to the caller only. There, the vectors of a repeated key add up.
    """
    rows = small_table(vectors.select("key", "vec"), max_words)
    if rows is not None and rows.num_rows:
        return _sum_in_place(df, rows, column)
    dim = vectors.agg(F.max(F.size("vec"))).first()[0] or 0  # no vector has no width

    def fill(lists: pa.ListArray, entries: pa.Table) -> list[pa.Array]:
        keys = entries.column(0).combine_chunks().dictionary_encode()
        codes, found = np.asarray(keys.indices), _matrix(entries, dim)
        matrix, times = np.zeros((len(keys.dictionary), dim)), np.bincount(codes, minlength=len(keys.dictionary))
        np.add.at(matrix, codes, found)
        return _add_up(lists, {key: i for i, key in enumerate(keys.dictionary.to_pylist())}, matrix, times)

    known = vectors.filter("key IS NOT NULL AND vec IS NOT NULL")
    return map_blocks(df, column, known, "key", "vec", fill, SUMS, BLOCK_ELEMENTS)


SUMS = [
    T.StructField("vec", T.ArrayType(T.DoubleType())),
    T.StructField("known", T.LongType()),
    T.StructField("total", T.LongType()),
]


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    """The values of the list column ``vec`` as they lie in the buffer, one row per word."""
    return table.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)


def _add_up(lists: pa.ListArray, places: dict, matrix: np.ndarray, times: np.ndarray) -> list[pa.Array]:
    """Of every list the sum of its words' rows of ``matrix``, how many vectors these hold, and the number of words."""
    dim = matrix.shape[1]
    sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    words = lists.flatten().dictionary_encode(null_encoding="encode")
    place = np.array([places.get(w, -1) for w in words.dictionary.to_pylist()], dtype=np.int64)
    place = place[np.asarray(words.indices)] if len(words) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    hit = place >= 0
    place, owner = place[hit], owner[hit]
    sums = np.zeros((len(sizes), dim))
    for at in range(0, len(place), TOKENS_AT_ONCE):
        rows_of = owner[at : at + TOKENS_AT_ONCE]
        starts = np.flatnonzero(np.diff(rows_of, prepend=-1))
        part = np.add.reduceat(matrix[place[at : at + TOKENS_AT_ONCE]], starts, axis=0)
        sums[rows_of[starts]] += part
    known = np.bincount(owner, times[place], len(sizes)).astype(np.int64)
    ends = np.arange(len(sizes) + 1, dtype=np.int32) * dim
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel())), pa.array(known), pa.array(sizes)]


def _sum_in_place(df: DataFrame, rows: pa.Table, column: str) -> DataFrame:
    schema = T.StructType(df.schema.fields + SUMS)
    names, at = schema.names, df.columns.index(column)
    shared = df.sparkSession.sparkContext.broadcast(rows)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        places = {key: i for i, key in enumerate(table.column(0).to_pylist()) if key is not None}
        matrix = _matrix(table, len(table.column(1)[0]))
        times = np.ones(table.num_rows)
        for batch in in_parts(batches, at):
            out = _add_up(batch.column(at), places, matrix, times)
            yield pa.RecordBatch.from_arrays(list(batch.columns) + out, names=names)

    return df.mapInArrow(add_up, schema)


def sentence_mean(
    df: DataFrame, vectors: DataFrame, row_key: list[str], column: str = "tokens", weight: str | None = None
) -> DataFrame:
    """Mean of the words' unit vectors; a word without a vector counts as zero."""
    summed = sum_word_vectors(df, l2_normalize(vectors), row_key, column, weight)
    share = F.when(F.col("total") > 0, 1.0 / F.col("total")).otherwise(F.lit(0.0))
    return summed.withColumn("vec", scale(F.col("vec"), share)).drop("known", "total")


def sentence_bow_vector(
    df: DataFrame, vectors: DataFrame, row_key: list[str], column: str = "tokens",
    average: bool = False, weight: str | None = None,
) -> DataFrame:
    """Sum of the known vectors, brought to length one; nothing known gives the zero vector.

    Unless ``average``, the sum is first divided by the number of tokens, which the final
    scaling hides.
    """
    summed = sum_word_vectors(df, vectors, row_key, column, weight)
    vec = F.col("vec")
    if not average:
        vec = F.when(F.col("total") > 0, scale(vec, 1.0 / F.col("total"))).otherwise(vec)
    return summed.withColumn("vec", unit(vec)).drop("known", "total")


def most_similar(
    vectors: DataFrame, query: list[float], n: int = 10, key: str = "key", drop_first: bool = True
) -> DataFrame:
    """``key, score, rank`` by cosine with one query vector.

    The best match is taken to be the query itself and left out unless told otherwise. One scan
    and a top-k: every task keeps its best rows only.
    """
    target = unit(F.lit([float(x) for x in query]))
    score = F.round(dot(unit(F.col("vec")), target), 9)
    skip = 1 if drop_first else 0
    best = vectors.select(F.col(key).alias("key"), score.alias("score")).orderBy(
        F.col("score").desc(), "key"
    ).limit(n + skip)
    order = Window.orderBy(F.col("score").desc(), "key")
    ranked = best.withColumn("rank", (F.row_number().over(order) - skip).cast("bigint"))
    return ranked.filter(F.col("rank") > 0)


def vector_of(vectors: DataFrame, key: object, name: str = "key") -> list[float]:
    """The vector stored under one key."""
    row = vectors.filter(F.col(name) == key).select("vec").head()
    if row is None:
        raise KeyError(key)
    return row["vec"]


def query_vector(spark: SparkSession, words: list[str], vectors: DataFrame) -> list[float]:
    """Mean of the words' unit vectors; a word without a vector counts as zero."""
    query = spark.createDataFrame([(0, words)], "query_id int, tokens array<string>")
    found = vectors.filter(F.col("key").isin(words))
    means = sentence_mean(query, found, ["query_id"])
    return means.head()["vec"]


def most_similar_docs(vectors: DataFrame, doc_id: int, n: int = 10, key: str = "doc_id") -> DataFrame:
    return most_similar(vectors, vector_of(vectors, doc_id, key), n, key)


def most_similar_tags(vectors: DataFrame, tag: str, n: int = 10, key: str = "tag") -> DataFrame:
    """As above among the other tags: the query is left out by its name."""
    others = vectors.filter(F.col(key) != tag)
    return most_similar(others, vector_of(vectors, tag, key), n, key, drop_first=False)


def analogy_queries(analogies: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """The analogies with ``vec`` = b + c - a of unit vectors; an unknown or missing word is zero."""
    units = l2_normalize(vectors).select("key", "vec")
    zero = F.array_repeat(F.lit(0.0), dim)
    out = analogies
    for name in "abc":
        side = units.select(F.col("key").alias(f"_k{name}"), F.col("vec").alias(f"_v{name}"))
        out = out.join(side, F.col(name) == F.col(f"_k{name}"), "left").withColumn(
            f"_v{name}", F.coalesce(f"_v{name}", zero)
        )
    combined = subtract(add(F.col("_vb"), F.col("_vc")), F.col("_va"))
    return out.select(*analogies.columns, combined.alias("vec"))


def _distinct_lines(analogies: DataFrame) -> DataFrame:
    """``a, b, c, d, query_id, times``: a line that is there several times is asked once and counted so."""
    words = [F.coalesce(F.col(c), F.lit("")) for c in "abcd"]
    return analogies.groupBy(*"abcd").agg(F.count("*").alias("times")).withColumn("query_id", F.concat_ws("\t", *words))


def analogy_accuracy(analogies: DataFrame, vectors: DataFrame, dim: int, n: int = 30) -> DataFrame:
    """``correct, total``: the answer must be among the ranks 2 to n + 1 of the table.

    Every line counts, those without three words too: they ask with a zero vector.
    """
    lines = _distinct_lines(analogies)
    queries = analogy_queries(lines, vectors, dim).withColumn("vec", unit(F.col("vec")))
    units = l2_normalize(vectors).select(F.col("key").alias("candidate_id"), "vec")
    best = best_matches(queries.select("query_id", "vec"), units, n + 1).filter(F.col("rank") > 1)
    hits = lines.join(
        best, (lines["query_id"] == best["query_id"]) & (F.col("candidate_id") == F.col("d")), "left_semi"
    )
    return analogies.agg(F.count("*").alias("total")).select(
        hits.agg(F.coalesce(F.sum("times"), F.lit(0))).scalar().alias("correct"), "total"
    )


def analogy_accuracy_3cosadd(
    analogies: DataFrame, vocab: DataFrame, max_vocab: int = 20_000
) -> DataFrame:
    """``correct, total`` among the first ``max_vocab`` words, query words not counting.

    ``vocab`` has ``id, key, vec``. An unknown word is taken as the word 0. Of the four best
    candidates the first that is no query word must be the answer.
    """
    units = vocab.select("id", "key", unit(F.col("vec")).alias("vec"))
    out = _distinct_lines(analogies)
    for name in "abcd":
        side = units.select(F.col("key").alias(f"_k{name}"), F.col("id").alias(f"_i{name}"))
        out = out.join(side, F.col(name) == F.col(f"_k{name}"), "left").withColumn(
            f"_i{name}", F.coalesce(f"_i{name}", F.lit(0))
        ).drop(f"_k{name}")
    for name in "abc":
        side = units.select(F.col("id").alias(f"_j{name}"), F.col("vec").alias(f"_v{name}"))
        out = out.join(side, F.col(f"_i{name}") == F.col(f"_j{name}")).drop(f"_j{name}")
    queries = out.select(
        "query_id", "times", add(subtract(F.col("_vb"), F.col("_va")), F.col("_vc")).alias("vec"),
        F.array("_ia", "_ib", "_ic").alias("asked"), F.col("_id").alias("answer"),
    )
    candidates = units.filter(F.col("id") < max_vocab).select(F.col("id").alias("candidate_id"), "vec")
    best = best_matches(queries.select("query_id", "vec"), candidates, 4)
    judged = best.join(queries.select("query_id", "times", "asked", "answer"), "query_id").filter(
        ~F.array_contains("asked", F.col("candidate_id"))
    )
    chosen = judged.groupBy("query_id").agg(
        F.min_by("candidate_id", "rank").alias("chosen"), F.first("answer").alias("answer"), F.first("times").alias("times")
    )
    right = F.sum(F.when(F.col("chosen") == F.col("answer"), F.col("times")).otherwise(0))
    return chosen.agg(right.alias("correct")).select(
        F.coalesce("correct", F.lit(0)).cast("bigint").alias("correct"),
        analogies.agg(F.count("*")).scalar().alias("total"),
    )


def predicted_similarity(pairs: DataFrame, vectors: DataFrame, unknown: str = "zero") -> DataFrame:
    """``word_1, word_2, score, predicted, known``: the cosine of each pair, which stays in any case.

    A word without a vector counts as the zero vector, or with ``unknown="first"`` as the word whose
    ``id`` in ``vectors`` is 0.
    """
    units = l2_normalize(vectors)
    out = pairs
    for side in "12":
        half = units.select(F.col("key").alias(f"_k{side}"), F.col("vec").alias(f"_v{side}"))
        out = out.join(half, F.col(f"word_{side}") == F.col(f"_k{side}"), "left")
    sides = [F.col("_v1"), F.col("_v2")]
    known = sides[0].isNotNull() & sides[1].isNotNull()
    if unknown == "first":
        out = out.withColumn("_first", units.filter(F.col("id") == 0).agg(F.first("vec")).scalar())
        sides = [F.coalesce(v, F.col("_first")) for v in sides]
    predicted = F.coalesce(F.round(dot(*sides), 9), F.lit(0.0))
    return out.select("word_1", "word_2", "score", predicted.alias("predicted"), known.alias("known"))


def word_similarity_corr(pairs: DataFrame, vectors: DataFrame, unknown: str = "zero") -> DataFrame:
    """``spearman, pearson, n_unknown`` of predicted against given scores over all pairs."""
    scored = predicted_similarity(pairs, vectors, unknown)
    ranked = average_ranks(scored, ["score", "predicted"])
    return ranked.agg(
        F.corr("rank_score", "rank_predicted").alias("spearman"),
        F.corr("score", "predicted").alias("pearson"),
        F.count_if(~F.col("known")).alias("n_unknown"),
    )


def sampled_pairwise_cosine(vectors: DataFrame, n: int = 30, seed: object = 0, key: str = "key") -> DataFrame:
    """``x, y, score`` for all ordered pairs of a sample, zero vectors left out.

    The sample is the point of the operator: a similarity chart of ``n`` items. Its rows are dealt into
    blocks, and each item goes to every block once.
    """
    blocks = -(-n // PAIR_BLOCK)
    chosen = sample_rows(vectors, n, seed, key).filter(norm(F.col("vec")) > 0)
    items = materialize(chosen.select(F.col(key).alias("k"), unit(F.col("vec")).alias("v")), "sample")
    left = items.select(F.col("k").alias("x"), F.col("v").alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"))
    right = items.select(F.col("k").alias("y"), F.col("v").alias("_y"), F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int").alias("_b"))
    return left.join(right, "_b").select("x", "y", dot(F.col("_x"), F.col("_y")).alias("score"))


def nearest_label(train: DataFrame, test: DataFrame) -> DataFrame:
    """``test_id, label, score``: the label of the training vector with the greatest dot product.

    ``train`` has ``train_id, vec, label`` and ``test`` has ``test_id, vec``.
    """
    queries = test.select(F.col("test_id").alias("query_id"), "vec")
    candidates = train.select(F.col("train_id").alias("candidate_id"), "vec")
    best = best_matches(queries, candidates, 1)
    labels = train.select(F.col("train_id").alias("candidate_id"), "label")
    return best.join(labels, "candidate_id").select(F.col("query_id").alias("test_id"), "label", "score")


def classifier_accuracy(predictions: DataFrame, truth: str = "truth", label: str = "label") -> DataFrame:
    right = (F.col(truth) == F.col(label)).cast("bigint")
    return predictions.agg(
        F.sum(right).alias("correct"), F.count("*").alias("total"), F.avg(right).alias("accuracy")
    )


def attention_edges(scores: Column) -> Column:
    """Edge weights of an attention matrix: (w - mean) / (max - mean).

    Cells below the mean and on the diagonal are set to 0 first, and so come out negative.
    """
    flat = F.flatten(scores)
    mean = F.aggregate(flat, F.lit(0.0), lambda a, x: a + x) / F.size(flat)

    def scaled(kept: Column, m: Column) -> Column:
        return let(
            F.array_max(F.flatten(kept)) - m,
            lambda span: F.transform(kept, lambda row: F.transform(row, lambda w: (w - m) / span)),
        )

    def edges(m: Column) -> Column:
        kept = F.transform(
            scores, lambda row, i: F.transform(row, lambda w, j: F.when((i == j) | (w < m), 0.0).otherwise(w))
        )
        return let(kept, lambda k: scaled(k, m))

    return F.when(F.size(scores) > 0, let(mean, edges))


def sum_attention_heads(layers: Column, length: Column) -> Column:
    """The last layer's heads added up, cut to the sentence: [layer][head][i][j] to [i][j]."""
    heads = F.element_at(layers, -1)
    first = F.element_at(heads, 1)
    rest = F.slice(heads, 2, F.size(heads))
    total = F.aggregate(
        rest, first, lambda acc, head: F.zip_with(acc, head, lambda a, h: F.zip_with(a, h, lambda x, y: x + y))
    )
    cut = F.transform(total, lambda row: F.slice(row, F.lit(1), length))
    return F.slice(cut, F.lit(1), length)


def pool_tokens(df: DataFrame, sequence: str, pos: str = "pos", column: str = "vec") -> DataFrame:
    """``first, last, mean``: one vector per sequence out of its token vectors."""
    return df.groupBy(sequence).agg(
        F.min_by(column, pos).alias("first"),
        F.max_by(column, pos).alias("last"),
        vector_to_array(Summarizer.mean(array_to_vector(column))).alias("mean"),
    )


def gather_positions(vectors: Column, positions: Column) -> Column:
    """The vectors at the listed zero-based positions of a sequence."""
    return F.transform(positions, lambda p: F.get(vectors, p))


def homonym_occurrences(
    df: DataFrame, word: str, keep: list[str], tokens: str = "tokens", vectors: str = "vectors",
    piece_marks: bool = False,
) -> DataFrame:
    """``pos, vec, sentence`` for every use of a word, which is quoted in its sentence."""
    clean = (lambda t: F.replace(t, F.lit("##"), F.lit(""))) if piece_marks else (lambda t: t)
    quoted = F.transform(
        tokens, lambda t: F.when(t == word, F.concat(F.lit('"'), clean(t), F.lit('"'))).otherwise(clean(t))
    )
    used = df.filter(F.array_contains(tokens, word)).select(
        *keep, F.array_join(quoted, " ").alias("sentence"),
        F.posexplode(F.arrays_zip(F.col(tokens).alias("t"), F.col(vectors).alias("v"))).alias("pos", "o"),
    )
    return used.filter(F.col("o.t") == word).select(
        *keep, F.col("pos").cast("bigint").alias("pos"), F.col("o.v").alias("vec"), "sentence"
    )


def topic_top_docs(results: DataFrame, n: int = 10, key: str = "doc_id") -> DataFrame:
    """The ``n`` most probable documents of each topic."""
    order = Window.partitionBy("topic").orderBy(F.col("prob").desc(), key)
    return results.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= n)
