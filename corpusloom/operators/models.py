"""Model-fitting jobs on Spark ML, and vectors derived from fitted ones."""

from __future__ import annotations

import math

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let, scale
from corpusloom.functions.text import char_ngrams
from corpusloom.operators.pairs import BLOCK, SkipGram, factorize_pairs
from corpusloom.operators.statistics import cooccurrence_linear, distinct_bow, pmi
from corpusloom.operators.svd import truncated_svd
from corpusloom.operators.vectors import sum_word_vectors
from corpusloom.operators.vocabulary import in_vocab
from corpusloom.plans.ranking import with_row_number
from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize


def train_word2vec(
    df: DataFrame, vocab: DataFrame, row_key: list[str], size: int = 100, window: int = 5, epochs: int = 5,
    negative: float = 5.0, sample: float = 1e-3, seed: int = 1, column: str = "tokens", weight: str | None = None,
    block: int = BLOCK, sweeps: int = 1,
) -> DataFrame:
    """``key, vec``: skip-gram word vectors against ``negative`` drawn words for every seen pair.

    ``vocab`` has ``id`` from 0, ``token`` and ``freq``; other words are left out before windows are taken. A window's
    width is drawn evenly from one to ``window``, and a word of share f stays with probability sqrt(``sample`` / f):
    both enter as expected weights of the pairs, which are added up over the corpus once and then factorized in
    blocks. No vector comes to the driver.
    """
    vocab = materialize(vocab.select("id", "token", "freq"), "vocab")
    cells = cooccurrence_linear(in_vocab(df, vocab, row_key, column, "ids", weight).select("ids"), window)
    facts = vocab.agg(F.count("*").alias("words"), F.sum("freq").alias("total")).first()
    if sample:
        stays = F.least(F.lit(1.0), F.sqrt(F.lit(sample * float(facts["total"] or 0)) / F.col("freq")))
        rows = vocab.select(F.col("id").alias("row_id"), stays.alias("_r"))
        columns = vocab.select(F.col("id").alias("col_id"), stays.alias("_c"))
        weighed = F.col("value") * F.col("_r") * F.col("_c")
        cells = cells.join(rows, "row_id").join(columns, "col_id").select("row_id", "col_id", weighed.alias("value"))
    found, _ = factorize_pairs(cells, facts["words"], facts["words"], size, epochs, seed=seed, objective=SkipGram(negative), block=block, sweeps=sweeps)
    return found.filter("side = 'row'").join(vocab, "id").select(F.col("token").alias("key"), "vec")


def word_lsa(cells: DataFrame, vocab: DataFrame, width: int, k: int = 100, use_pmi: bool = False) -> DataFrame:
    """``key, vec``: latent vectors of words from co-occurrence, raw or as association scores."""
    matrix = pmi(cells).withColumnRenamed("pmi", "value") if use_pmi else cells
    scores = truncated_svd(matrix, width, k)
    return scores.join(vocab.select(F.col("id").alias("row_id"), F.col("token").alias("key")), "row_id").select(
        "key", "vec"
    )


def doc_lsa(weights: DataFrame, terms: DataFrame, width: int, k: int = 100) -> DataFrame:
    """``doc_id, vec`` from ``doc_id, term, tfidf`` and the ids of a bounded list of terms."""
    ids = terms.select(F.col("token").alias("term"), F.col("id").alias("col_id"))
    cells = weights.join(ids, "term").select(F.col("doc_id").alias("row_id"), "col_id", F.col("tfidf").alias("value"))
    return truncated_svd(cells, width, k).withColumnRenamed("row_id", "doc_id")


def fit_topics(
    df: DataFrame, k: int = 30, vocab_size: int = 100_000, iterations: int = 20, seed: int = 1, column: str = "tokens"
) -> tuple[LDAModel, CountVectorizerModel]:
    """A topic model over documents as sets of words.

    The counted documents are written once, as every iteration reads them.
    """
    bags = materialize(df.select(distinct_bow(F.col(column)).alias("bag")), "bags")
    words = CountVectorizer(inputCol="bag", outputCol="features", vocabSize=vocab_size, binary=True).fit(bags)
    model = LDA(k=k, maxIter=iterations, seed=seed, optimizer="online").fit(
        materialize(words.transform(bags).select("features"), "bags")
    )
    return model, words


def topic_probabilities(
    df: DataFrame, model: LDAModel, words: CountVectorizerModel, column: str = "tokens"
) -> DataFrame:
    """The frame with ``probs``, the topic shares of each row."""
    bags = df.withColumn("bag", distinct_bow(F.col(column)))
    scored = model.transform(words.transform(bags))
    return scored.withColumn("probs", vector_to_array("topicDistribution")).drop(
        "bag", "features", "topicDistribution"
    )


def dominant_topic(probs: Column, threshold: float = 0.5) -> Column:
    """``topic, prob`` of the topic above the threshold, or NULL."""
    top = F.array_max(probs)
    topic = F.array_position(probs, top) - 1
    return F.when(top > threshold, F.struct(topic.cast("bigint").alias("topic"), top.alias("prob")))


def topic_results(df: DataFrame, model: LDAModel, words: CountVectorizerModel, threshold: float = 0.5) -> DataFrame:
    """Documents with a dominant topic; the others are left out."""
    scored = topic_probabilities(df, model, words).withColumn("_t", dominant_topic(F.col("probs"), threshold))
    kept = scored.filter(F.col("_t").isNotNull())
    return kept.select(*df.columns, "_t.topic", "_t.prob")


def score_new_docs(df: DataFrame, model: LDAModel, words: CountVectorizerModel, threshold: float = 0.5) -> DataFrame:
    """Every document with its dominant topic, or the remark that there is none."""
    scored = topic_probabilities(df, model, words).withColumn("_t", dominant_topic(F.col("probs"), threshold))
    remark = F.when(F.col("_t").isNull(), "there is no dominant topic")
    return scored.select(*df.columns, "_t.topic", "_t.prob", remark.alias("remark"))


def topic_top_words(model: LDAModel, words: CountVectorizerModel, n: int = 10) -> DataFrame:
    """``topic, rank, word, weight`` of the strongest words."""
    spark = model.describeTopics(1).sparkSession
    names = spark.createDataFrame(list(enumerate(words.vocabulary)), "term int, word string")
    listed = model.describeTopics(n).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t")
    )
    return listed.select(
        "topic", (F.col("rank") + 1).alias("rank"), F.col("t.termIndices").alias("term"),
        F.col("t.termWeights").alias("weight"),
    ).join(names, "term").select("topic", "rank", "word", "weight")


def tag_vectors(df: DataFrame, vectors: DataFrame, row_key: list[str], tag: str = "tag", column: str = "tokens") -> DataFrame:
    """``tag, vec``: the mean vector of all known words in the documents of a tag.

    Documents are summed in place; a tag then adds up one vector per document, partly before
    the shuffle, whatever its size.
    """
    summed = sum_word_vectors(df.select(*row_key, tag, column), vectors, row_key, column)
    known = summed.filter(F.col("known") > 0)
    sums = known.groupBy(F.col(tag).alias("tag")).agg(
        vector_to_array(Summarizer.sum(array_to_vector("vec"))).alias("vec"), F.sum("known").alias("known")
    )
    return sums.select("tag", scale(F.col("vec"), 1.0 / F.col("known")).alias("vec"))


def _tag_cells(df: DataFrame, vocab: DataFrame, row_key: list[str], tag: str, column: str) -> tuple[DataFrame, DataFrame]:
    """``tag, id`` numbered from 0, and how often each vocabulary word stands in the documents of each tag."""
    coded = in_vocab(df.select(*row_key, F.col(tag).alias("tag"), column), vocab, row_key, column, "ids")
    counted = materialize(
        unnest(coded, "ids", "tag", value="col_id").groupBy("tag", "col_id").agg(F.count("*").alias("value")), "tag-words"
    )
    tags = materialize(with_row_number(counted.select("tag").filter("tag IS NOT NULL").distinct(), [F.col("tag")], "id"), "tags")
    cells = counted.join(tags, "tag").select(F.col("id").alias("row_id"), "col_id", F.col("value").cast("double"))
    return tags, cells


def train_tag_vectors(
    df: DataFrame, vocab: DataFrame, row_key: list[str], size: int = 100, epochs: int = 5, negative: float = 5.0,
    seed: int = 1, tag: str = "tag", column: str = "tokens", block: int = BLOCK, sweeps: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """``tag, vec`` of paragraph vectors, and ``id, vec, n`` of the word outputs they were trained with.

    A tag's vector predicts the words of its documents against ``negative`` drawn words for each, whatever their
    order. Words are counted per tag, partly before the shuffle, so a tag of any size is one row of counts. Tags whose
    documents hold no word of ``vocab``, and NULL tags, get no vector.
    """
    vocab = materialize(vocab.select("id", "token", "freq"), "vocab")
    tags, cells = _tag_cells(df, vocab, row_key, tag, column)
    found, _ = factorize_pairs(cells, tags.count(), vocab.count(), size, epochs, seed=seed, objective=SkipGram(negative), block=block, sweeps=sweeps)
    words = found.filter("side = 'column'").join(vocab, "id").select("id", "vec", F.col("freq").alias("n"))
    return found.filter("side = 'row'").join(tags, "id").select("tag", "vec"), words


def infer_tag_vectors(
    df: DataFrame, vocab: DataFrame, words: DataFrame, row_key: list[str], size: int = 100, epochs: int = 5,
    negative: float = 5.0, seed: int = 1, tag: str = "tag", column: str = "tokens", block: int = BLOCK, sweeps: int = 2,
) -> DataFrame:
    """``tag, vec`` of new tags by the same steps, the word outputs of ``train_tag_vectors`` staying as they are."""
    tags, cells = _tag_cells(df, vocab, row_key, tag, column)
    found, _ = factorize_pairs(
        cells, tags.count(), words.count(), size, epochs, seed=seed, objective=SkipGram(negative), block=block, sweeps=sweeps, fixed=words
    )
    return found.filter("side = 'row'").join(tags, "id").select("tag", "vec")


def ngram_vectors(vectors: DataFrame, low: int = 3, high: int = 6) -> DataFrame:
    """``gram, vec``: the mean vector of the words that hold each character n-gram."""
    grams = F.array_distinct(char_ngrams(F.col("key"), low, high))
    long = vectors.select(F.explode(grams).alias("gram"), array_to_vector("vec").alias("_v"))
    return long.groupBy("gram").agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("vec"))


def oov_vectors(words: DataFrame, vectors: DataFrame, low: int = 3, high: int = 6, word: str = "token") -> DataFrame:
    """``token, vec``: unknown words as the mean of their known n-grams' vectors."""
    unknown = words.select(F.col(word).alias("token")).distinct().join(
        vectors.select(F.col("key").alias("token")), "token", "left_anti"
    )
    asked = unknown.withColumn("grams", F.array_distinct(char_ngrams(F.col("token"), low, high)))
    known = ngram_vectors(vectors, low, high).withColumnRenamed("gram", "key")
    summed = sum_word_vectors(asked, known, ["token"], "grams").filter(F.col("known") > 0)
    return summed.select("token", scale(F.col("vec"), 1.0 / F.col("known")).alias("vec"))


def average_snapshots(df: DataFrame, last: int, name: str = "name", step: str = "step", column: str = "vec") -> DataFrame:
    """``name, idx, value``: element-wise mean of each tensor over its last snapshots."""
    newest = Window.partitionBy(name).orderBy(F.col(step).desc())
    kept = df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= last)
    long = unnest(kept, column, F.col(name).alias("name"), value="_x", pos="idx")
    return long.groupBy("name", "idx").agg(F.avg("_x").alias("value"))


def softmax_weights(raw: list[float]) -> list[float]:
    """Softmax of the raw layer weights, each raised by one over their number."""
    shifted = [math.exp(w + 1.0 / len(raw)) for w in raw]
    return [w / sum(shifted) for w in shifted]


def weighted_layer_sum(
    df: DataFrame, raw_weights: list[float], gamma: float = 1.0, layer_norm: bool = False,
    batch: str = "batch", mask: str = "mask", layers: str = "layers",
) -> DataFrame:
    """Add ``vec``: the weighted sum of a token's layer vectors, times gamma.

    With ``layer_norm`` each layer is first normalised by mean and variance over all unmasked
    entries of the batch, which are added up before the shuffle.
    """
    weights = softmax_weights(raw_weights)
    if not layer_norm:
        summed = _combine(F.col(layers), [F.lit(w) for w in weights], [F.lit(0.0)] * len(weights))
        return df.withColumn("vec", F.transform(summed, lambda x: x * gamma))
    vectors = unnest(df.filter(F.col(mask)), layers, batch, value="_v", pos="_l")
    entries = unnest(vectors, "_v", batch, "_l", value="_x")
    stats = entries.groupBy(batch, "_l").agg(F.avg("_x").alias("_m"), F.var_pop("_x").alias("_s"))
    ordered = F.sort_array(F.collect_list(F.struct("_l", "_m", "_s")))
    per_batch = stats.groupBy(batch).agg(ordered.alias("_stats"))
    joined = df.join(per_batch, batch)
    factors, shifts = [], []
    for i, w in enumerate(weights):
        stat = F.get("_stats", F.lit(i))
        factor = F.lit(w) / F.sqrt(stat["_s"] + 1e-12)
        factors.append(factor)
        shifts.append(-stat["_m"] * factor)
    summed = _combine(F.col(layers), factors, shifts)
    return joined.withColumn("vec", F.transform(summed, lambda x: x * gamma)).drop("_stats")


def _affine(factor: Column, shift: Column):
    pair = F.struct(factor.alias("f"), shift.alias("s"))
    return lambda vec: let(pair, lambda p: F.transform(vec, lambda x: x * p["f"] + p["s"]))


def _combine(layers: Column, factors: list[Column], shifts: list[Column]) -> Column:
    total = None
    for i, (factor, shift) in enumerate(zip(factors, shifts)):
        part = _affine(factor, shift)(F.get(layers, F.lit(i)))
        total = part if total is None else F.zip_with(total, part, lambda a, b: a + b)
    return total
