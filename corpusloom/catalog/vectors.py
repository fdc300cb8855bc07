"""Queries for models, vectors, similarity and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.base import (
    LINE_KEY, SQL_TOKENS, WORDS, Catalog, common_words, counts, documents, table, token_docs,
    token_lines, with_,
)
from corpusloom.catalog.stats import WORD_VECTORS, cells_harmonic, coded_lines, word_vectors
from corpusloom.functions.arrays import softmax
from corpusloom.functions.hashing import pick
from corpusloom.functions.text import whitespace_tokens
from corpusloom.operators import corpus, metrics, models, pairs, statistics, vocabulary
from corpusloom.operators import vectors as vs
from corpusloom.plans.ranking import top_ranked
from corpusloom.session import materialize

catalog = Catalog()

DIM = 64


def embeddings(spark, sf):
    """``vec_id, key, vec, label`` with keys v0, v1, ..."""
    raw = table(spark, sf, "embeddings")
    return raw.select(
        "vec_id", F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("key"),
        F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("bigint").alias("label"),
    )


def rounded(df, column="vec", digits=4):
    return df.withColumn(column, F.transform(column, lambda x: F.round(x, digits)))


def dims(df, *keep, column="vec", digits=6):
    """Long form of a vector column, rounded."""
    return df.select(*keep, F.posexplode(column).alias("d", "x")).select(
        *keep, F.col("d").cast("bigint").alias("d"), F.round("x", digits).alias("x")
    )


EMB = """
emb AS (SELECT vec_id, 'v' || vec_id AS key, embedding::DOUBLE[] AS vec, label::BIGINT AS label FROM embeddings),
normed AS (SELECT *, sqrt(list_dot_product(vec, vec)) AS len FROM emb),
units AS (SELECT vec_id, key, label, CASE WHEN len > 0 THEN list_transform(vec, lambda x: x / len) ELSE vec END AS vec FROM normed)"""


def sql_dims(source: str, keep: str, column: str = "vec") -> str:
    return f"""
SELECT {keep}, d - 1 AS d, round(x, 6) AS x FROM (
  SELECT {keep}, unnest({column}) AS x, generate_subscripts({column}, 1) AS d FROM {source})"""


# ------------------------------------------------------------------ vectors of words and sentences


@catalog.add(with_(EMB) + sql_dims("units", "vec_id"))
def l2_normalize(spark, sf):
    return dims(vs.l2_normalize(embeddings(spark, sf)), "vec_id")


@catalog.add(with_(EMB) + "SELECT vec_id, round(len, 6) AS length FROM normed WHERE len > 0")
def drop_zero_vectors(spark, sf):
    from corpusloom.functions.arrays import norm

    kept = corpus.drop_zero_vectors(embeddings(spark, sf))
    return kept.select("vec_id", F.round(norm(F.col("vec")), 6).alias("length"))


LINE_SUMS = WORD_VECTORS + """,
vec_units AS (SELECT key, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM vectors),
known AS (SELECT doc_id, line_no, vec FROM tokens JOIN {table} ON key = token),
cells_ AS (SELECT doc_id, line_no, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS d FROM known),
sums AS (SELECT doc_id, line_no, d, sum(x) AS x FROM cells_ GROUP BY ALL),
every AS (SELECT doc_id, line_no, len(tokens) AS n, d FROM token_lines, range({dim}) r(d))"""


@catalog.add(with_(LINE_SUMS.replace("{table}", "vec_units").replace("{dim}", "64")) + """
SELECT e.doc_id, e.line_no, e.d, round(coalesce(x, 0) / n, 6) AS x FROM every e
LEFT JOIN sums s ON s.doc_id = e.doc_id AND s.line_no = e.line_no AND s.d = e.d
""")
def sentence_mean(spark, sf):
    means = vs.sentence_mean(token_lines(spark, sf), word_vectors(spark, sf), LINE_KEY)
    return dims(means, *LINE_KEY)


BOW = with_(LINE_SUMS.replace("{table}", "vectors").replace("{dim}", "64")) + """,
lens AS (SELECT doc_id, line_no, sqrt(sum(x * x)) AS len FROM sums GROUP BY ALL)
SELECT e.doc_id, e.line_no, e.d, round(coalesce(x / len, 0), 6) AS x FROM every e
LEFT JOIN sums s ON s.doc_id = e.doc_id AND s.line_no = e.line_no AND s.d = e.d
LEFT JOIN lens l ON l.doc_id = e.doc_id AND l.line_no = e.line_no
"""


@catalog.add(BOW)
def sentence_bow_vector(spark, sf):
    return dims(vs.sentence_bow_vector(token_lines(spark, sf), word_vectors(spark, sf), LINE_KEY), *LINE_KEY)


@catalog.add(BOW)
def sentence_bow_vector_joined(spark, sf):
    # The form for vector tables too large to ship.
    freq = counts(spark, sf).withColumnRenamed("token", "key")
    table_ = word_vectors(spark, sf).join(freq, "key")
    summed = vs.sum_word_vectors(token_lines(spark, sf), table_, LINE_KEY, weight="freq", max_words=10)
    return dims(vs.l2_normalize(summed), *LINE_KEY)


@catalog.add(with_(
    WORD_VECTORS, """
per_tag AS (SELECT source AS tag, count(*) AS n, vec FROM tokens JOIN documents USING (doc_id) JOIN vectors ON key = token GROUP BY ALL),
long_ AS (SELECT tag, n, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS d FROM per_tag)""")
    + "SELECT tag, d, round(sum(n * x) / sum(n), 6) AS x FROM long_ GROUP BY ALL")
def tag_vectors(spark, sf):
    docs = documents(spark, sf).select(
        "doc_id", F.col("source").alias("tag"), whitespace_tokens(F.col("text")).alias("tokens")
    )
    return dims(models.tag_vectors(docs, word_vectors(spark, sf), ["doc_id"]), "tag")


@catalog.add(with_(WORD_VECTORS) + """,
grams AS (SELECT DISTINCT key, substr('<' || key || '>', s, k) AS gram FROM vectors, range(3, 7) r(k), range(1, 60) q(s)
  WHERE s + k - 1 <= length(key) + 2),
gram_cells AS (SELECT gram, d, avg(x) AS x FROM (
  SELECT gram, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS d FROM grams JOIN vectors USING (key)) GROUP BY ALL),
words AS (SELECT token FROM counts WHERE token NOT IN (SELECT key FROM vectors)),
wgrams AS (SELECT DISTINCT token, substr('<' || token || '>', s, k) AS gram FROM words, range(3, 7) r(k), range(1, 400) q(s)
  WHERE s + k - 1 <= length(token) + 2)
SELECT token, round(avg(x) FILTER (d = 0), 6) AS x0, round(avg(x) FILTER (d = 63), 6) AS x63 FROM wgrams JOIN gram_cells USING (gram) WHERE d IN (0, 63) GROUP BY token
""")
def oov_vectors(spark, sf):
    vecs = models.oov_vectors(counts(spark, sf), word_vectors(spark, sf))
    return vecs.select(
        "token", F.round(F.get("vec", F.lit(0)), 6).alias("x0"), F.round(F.get("vec", F.lit(63)), 6).alias("x63")
    )


# ------------------------------------------------------------------ similarity and analogy


@catalog.add(with_(EMB) + """
SELECT key, round(score, 6) AS score, rn - 1 AS rank FROM (
  SELECT u.key, round(list_dot_product(u.vec, q.vec), 9) AS score,
         row_number() OVER (ORDER BY round(list_dot_product(u.vec, q.vec), 9) DESC, u.key) AS rn
  FROM units u, (SELECT vec FROM units WHERE key = 'v7') q) WHERE rn BETWEEN 2 AND 11
""")
def most_similar(spark, sf):
    vectors = embeddings(spark, sf)
    best = vs.most_similar(vectors, vs.vector_of(vectors, "v7"))
    return best.withColumn("score", F.round("score", 6))


@catalog.add(with_(EMB) + """
SELECT key, round(score, 6) AS score, rn - 1 AS rank FROM (
  SELECT u.vec_id AS key, round(list_dot_product(u.vec, q.vec), 9) AS score,
         row_number() OVER (ORDER BY round(list_dot_product(u.vec, q.vec), 9) DESC, u.vec_id) AS rn
  FROM units u, (SELECT vec FROM units WHERE vec_id = 42) q) WHERE rn BETWEEN 2 AND 6
""")
def most_similar_docs(spark, sf):
    best = vs.most_similar_docs(embeddings(spark, sf), 42, 5, "vec_id")
    return best.withColumn("score", F.round("score", 6))


TAGS = EMB + """,
tag_cells AS (SELECT label, d, avg(x) AS x FROM (SELECT label, unnest(vec) AS x, generate_subscripts(vec, 1) AS d FROM emb) GROUP BY ALL),
tags AS (SELECT 'MOVIE_' || label AS tag, label, list(x ORDER BY d) AS vec FROM tag_cells GROUP BY label),
tag_units AS (SELECT tag, label, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM tags)"""


def label_means(spark, sf):
    means = embeddings(spark, sf).select("label", F.posexplode("vec").alias("d", "x")).groupBy("label", "d").agg(
        F.avg("x").alias("x")
    )
    ordered = F.sort_array(F.collect_list(F.struct("d", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda e: e["x"]).alias("vec"))


@catalog.add(with_(TAGS) + """
SELECT tag AS key, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, tag) AS rank FROM (
  SELECT u.tag, round(list_dot_product(u.vec, q.vec), 9) AS score
  FROM tag_units u, (SELECT vec FROM tag_units WHERE tag = 'MOVIE_3') q WHERE u.tag <> 'MOVIE_3')
QUALIFY rank <= 5
""")
def most_similar_tags(spark, sf):
    tags = label_means(spark, sf).select(corpus.tag_document(F.col("label")).alias("tag"), "vec")
    return vs.most_similar_tags(tags, "MOVIE_3", 5).withColumn("score", F.round("score", 6))


def analogies(spark, sf):
    """Every run of four consecutive vectors; the last three lack an answer, and every fifth is there twice."""
    name = lambda i: F.concat(F.lit("v"), (F.col("vec_id") + i).cast("string"))
    runs = table(spark, sf, "embeddings").select("vec_id", *[name(i).alias(c) for i, c in enumerate("abcd")])
    return runs.unionByName(runs.filter(F.col("vec_id") % 5 == 0)).drop("vec_id")


ANALOGY = EMB + f""",
asked AS (SELECT vec_id, key AS a, 'v' || (vec_id + 1) AS b, 'v' || (vec_id + 2) AS c, 'v' || (vec_id + 3) AS d, unnest(range(1 + (vec_id % 5 = 0)::INT)) AS copy FROM emb),
zero AS (SELECT list_transform(range({DIM}), lambda i: 0::DOUBLE) AS z),
query AS (SELECT q.*, list_transform(range(1, {DIM + 1}), lambda i:
    coalesce(vb.vec, z)[i] + coalesce(vc.vec, z)[i] - coalesce(va.vec, z)[i]) AS vec
  FROM asked q LEFT JOIN units va ON va.key = q.a LEFT JOIN units vb ON vb.key = q.b LEFT JOIN units vc ON vc.key = q.c, zero)"""


@catalog.add(with_(ANALOGY) + sql_dims("query", "a"))
def analogy_queries(spark, sf):
    return dims(vs.analogy_queries(analogies(spark, sf), embeddings(spark, sf), DIM), "a")


@catalog.add(with_(ANALOGY) + """,
query_units AS (SELECT a, d, copy, CASE WHEN list_dot_product(vec, vec) > 0 THEN list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) ELSE vec END AS vec FROM query),
scored AS (SELECT a, d, u.key, row_number() OVER (PARTITION BY a, copy ORDER BY round(list_dot_product(q.vec, u.vec), 9) DESC, u.key) AS rn
  FROM query_units q, units u)
SELECT count(*) FILTER (WHERE key = d AND rn BETWEEN 2 AND 31) AS correct, (SELECT count(*) FROM query) AS total FROM scored
""")
def analogy_accuracy(spark, sf):
    return vs.analogy_accuracy(analogies(spark, sf), embeddings(spark, sf), DIM)


@catalog.add(with_(EMB) + f""",
asked AS (SELECT vec_id * 2 + copy AS q, vec_id AS ia, vec_id + 1 AS ib, vec_id + 2 AS ic, vec_id + 3 AS i_d
  FROM (SELECT vec_id, unnest(range(1 + (vec_id % 5 = 0)::INT)) AS copy FROM emb)),
fixed AS (SELECT q, ia, CASE WHEN ib IN (SELECT vec_id FROM emb) THEN ib ELSE 0 END AS ib,
  CASE WHEN ic IN (SELECT vec_id FROM emb) THEN ic ELSE 0 END AS ic, CASE WHEN i_d IN (SELECT vec_id FROM emb) THEN i_d ELSE 0 END AS answer FROM asked),
query AS (SELECT f.*, list_transform(range(1, {DIM + 1}), lambda i: vb.vec[i] - va.vec[i] + vc.vec[i]) AS vec
  FROM fixed f JOIN units va ON va.vec_id = ia JOIN units vb ON vb.vec_id = ib JOIN units vc ON vc.vec_id = ic),
scored AS (SELECT q.*, u.vec_id AS cand, row_number() OVER (PARTITION BY q ORDER BY round(list_dot_product(q.vec, u.vec), 9) DESC, u.vec_id) AS rn
  FROM query q, units u WHERE u.vec_id < 20000),
first_ AS (SELECT q, answer, arg_min(cand, rn) AS chosen FROM scored WHERE rn <= 4 AND cand NOT IN (ia, ib, ic) GROUP BY ALL)
SELECT count(*) FILTER (WHERE chosen = answer) AS correct, (SELECT count(*) FROM query) AS total FROM first_
""")
def analogy_accuracy_3cosadd(spark, sf):
    vocab = embeddings(spark, sf).select(F.col("vec_id").alias("id"), "key", "vec")
    return vs.analogy_accuracy_3cosadd(analogies(spark, sf), vocab)


def similarity_pairs(spark, sf):
    """Neighbouring vectors, scored by whether they share a label; the last has no partner."""
    v = embeddings(spark, sf)
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("label").alias("next"))
    pairs = v.join(after, "vec_id", "left")
    return pairs.select(
        F.col("key").alias("word_1"), F.concat(F.lit("v"), (F.col("vec_id") + 1).cast("string")).alias("word_2"),
        F.coalesce((F.col("label") == F.col("next")).cast("double"), F.lit(0.0)).alias("score"),
    )


def sql_corr(predicted: str) -> str:
    return f""",
pairs AS (SELECT a.vec_id, coalesce((a.label = b.label)::INT::DOUBLE, 0) AS score, b.vec IS NULL AS lost,
  round({predicted}, 9) AS predicted FROM units a LEFT JOIN units b ON b.vec_id = a.vec_id + 1),
ranks AS (SELECT score, predicted, lost,
  rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rs,
  rank() OVER (ORDER BY predicted) + (count(*) OVER (PARTITION BY predicted) - 1) / 2.0::DOUBLE AS rp FROM pairs)
SELECT round(corr(rs, rp), 6) AS spearman, round(corr(score, predicted), 6) AS pearson,
       count(*) FILTER (WHERE lost) AS n_unknown FROM ranks"""


def rounded_corr(df):
    return df.select(
        F.round("spearman", 6).alias("spearman"), F.round("pearson", 6).alias("pearson"), "n_unknown"
    )


@catalog.add(with_(EMB) + sql_corr("coalesce(list_dot_product(a.vec, b.vec), 0)"))
def word_similarity_corr(spark, sf):
    return rounded_corr(vs.word_similarity_corr(similarity_pairs(spark, sf), embeddings(spark, sf)))


@catalog.add(with_(EMB) + sql_corr("list_dot_product(a.vec, coalesce(b.vec, (SELECT vec FROM units WHERE vec_id = 0)))"))
def word_similarity_corr_cosine(spark, sf):
    pairs = similarity_pairs(spark, sf)
    vocab = embeddings(spark, sf).withColumn("id", F.col("vec_id"))
    return rounded_corr(vs.word_similarity_corr(pairs, vocab, unknown="first"))


@catalog.add(with_(EMB) + """,
chosen AS (SELECT key, vec FROM units ORDER BY md5(concat_ws('|', '3', key)), key LIMIT 30)
SELECT x.key AS x, y.key AS y, round(list_dot_product(x.vec, y.vec), 6) AS score FROM chosen x, chosen y
""")
def sampled_pairwise_cosine(spark, sf):
    pairs = vs.sampled_pairwise_cosine(embeddings(spark, sf), 30, 3)
    return pairs.withColumn("score", F.round("score", 6))


NEAREST = """
SELECT test_id, label, round(score, 6) AS score FROM (
  SELECT t.test_id, r.label, round(list_dot_product(t.vec, r.vec), 9) AS score,
         row_number() OVER (PARTITION BY t.test_id ORDER BY round(list_dot_product(t.vec, r.vec), 9) DESC, r.{key}) AS rn
  FROM {test} t, {train} r) WHERE rn = 1"""


@catalog.add(
    with_(WORD_VECTORS, EMB, """
known AS (SELECT item_id AS test_id, vec FROM (
    SELECT item_id, unnest(list_filter(string_split_regex(text, '[ \\n]+'), lambda t: t <> '')) AS token FROM benchmark) b JOIN vectors ON key = token),
sums AS (SELECT test_id, d, sum(x) AS x FROM (SELECT test_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS d FROM known) GROUP BY ALL),
lists AS (SELECT test_id, list(x ORDER BY d) AS vec FROM sums GROUP BY test_id),
test AS (SELECT item_id AS test_id, coalesce(list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))), list_transform(range(64), lambda i: 0::DOUBLE)) AS vec
  FROM benchmark LEFT JOIN lists ON test_id = item_id)""")
    + NEAREST.format(key="vec_id", test="test", train="emb")
)
def nearest_label(spark, sf):
    items = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("test_id"), whitespace_tokens(F.col("text")).alias("tokens")
    )
    test = vs.sentence_bow_vector(items, word_vectors(spark, sf), ["test_id"])
    train = embeddings(spark, sf).withColumnRenamed("vec_id", "train_id")
    return vs.nearest_label(train, test).withColumn("score", F.round("score", 6))


def centroid_predictions(spark, sf):
    train = label_means(spark, sf).select(F.col("label").alias("train_id"), "label", "vec")
    test = embeddings(spark, sf).withColumnRenamed("vec_id", "test_id")
    best = vs.nearest_label(train, test)
    return best.join(test.select("test_id", F.col("label").alias("truth")), "test_id")


@catalog.add(with_(TAGS, " best AS (" + NEAREST.format(
    key="label", test="(SELECT vec_id AS test_id, vec FROM emb)", train="tags") + ")") + """
SELECT sum((best.label = emb.label)::INT)::BIGINT AS correct, count(*) AS total, round(avg((best.label = emb.label)::INT), 6) AS accuracy
FROM best JOIN emb ON vec_id = test_id
""")
def classifier_accuracy(spark, sf):
    scores = vs.classifier_accuracy(centroid_predictions(spark, sf))
    return scores.withColumn("accuracy", F.round("accuracy", 6))


@catalog.add(with_(WORD_VECTORS) + f""",
weighted AS (SELECT key, list_transform(vec, lambda x: x * w) AS vec FROM (
  SELECT key, vec, 0.0001::DOUBLE / (freq / (SELECT sum(freq) FROM counts)::DOUBLE + 0.0001::DOUBLE) AS w FROM vectors JOIN counts ON token = key)),
known AS (SELECT doc_id, vec FROM tokens JOIN labels USING (doc_id) JOIN weighted ON key = token),
sums AS (SELECT doc_id, d, sum(x) AS x FROM (SELECT doc_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS d FROM known) GROUP BY ALL),
lists AS (SELECT doc_id, list(x ORDER BY d) AS vec FROM sums GROUP BY doc_id),
labelled AS (SELECT l.doc_id, l.quality::BIGINT AS label,
  coalesce(list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))), list_transform(range({DIM}), lambda i: 0::DOUBLE)) AS vec
  FROM labels l JOIN documents USING (doc_id) LEFT JOIN lists USING (doc_id)),
best AS ({NEAREST.format(key="train_id", test="(SELECT doc_id AS test_id, vec FROM labelled WHERE doc_id % 5 = 0)", train="(SELECT doc_id AS train_id, vec, label FROM labelled WHERE doc_id % 5 <> 0)")})
SELECT sum((best.label = l.label)::INT)::BIGINT AS correct, count(*) AS total, round(avg((best.label = l.label)::INT), 6) AS accuracy
FROM best JOIN labelled l ON l.doc_id = test_id
""")
def document_label_accuracy(spark, sf):
    """Labelled documents as weighted bags of word vectors; every fifth is judged by its nearest neighbour."""
    weighted = statistics.sif_weights(counts(spark, sf), word_vectors(spark, sf)).select("key", "vec")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("label"))
    rows = token_docs(spark, sf).join(labels, "doc_id")
    found = materialize(vs.sentence_bow_vector(rows, weighted, ["doc_id"]).select("doc_id", "label", "vec"), "labelled")
    fifth = F.col("doc_id") % 5 == 0
    train = found.filter(~fifth).withColumnRenamed("doc_id", "train_id")
    test = found.filter(fifth).select(F.col("doc_id").alias("test_id"), "vec", F.col("label").alias("truth"))
    judged = vs.nearest_label(train, test.select("test_id", "vec")).join(test.select("test_id", "truth"), "test_id")
    return vs.classifier_accuracy(judged).withColumn("accuracy", F.round("accuracy", 6))


ASKED = ["the", "of", "and", "the", "no-such-word"]


@catalog.add(with_(WORD_VECTORS) + f""",
vec_units AS (SELECT key, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM vectors),
asked AS (SELECT unnest({ASKED!r}) AS key),
sums AS (SELECT d, sum(x) / {len(ASKED)} AS x FROM (
  SELECT unnest(vec) AS x, generate_subscripts(vec, 1) AS d FROM asked JOIN vec_units USING (key)) GROUP BY d),
mean AS (SELECT list(x ORDER BY d) AS vec FROM sums),
query AS (SELECT list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM mean)
SELECT key, round(score, 6) AS score, rn - 1 AS rank FROM (
  SELECT u.key, round(list_dot_product(u.vec, q.vec), 9) AS score,
         row_number() OVER (ORDER BY round(list_dot_product(u.vec, q.vec), 9) DESC, u.key) AS rn
  FROM vec_units u, query q) WHERE rn BETWEEN 2 AND 11
""")
def most_similar_sentence(spark, sf):
    """Words nearest to the mean of a sentence's unit vectors; unknown words count as zero."""
    vectors = materialize(word_vectors(spark, sf), "word-vectors")
    best = vs.most_similar(vectors, vs.query_vector(spark, ASKED, vectors))
    return best.withColumn("score", F.round("score", 6))


def square(vec, n, start=0):
    """A vector's entries from ``start`` as an n x n matrix."""
    return F.array(*[F.slice(vec, start + 1 + i * n, n) for i in range(n)])


def cells(df, key, column):
    rows = df.select(key, F.posexplode(column).alias("i", "row"))
    return rows.select(key, F.col("i").cast("bigint").alias("i"), F.posexplode("row").alias("j", "w")).select(
        key, "i", F.col("j").cast("bigint").alias("j"), F.round("w", 6).alias("w")
    )


GRID = EMB + """,
grid AS (SELECT vec_id, (k - 1) // 8 AS i, (k - 1) % 8 AS j, w FROM (
  SELECT vec_id, unnest(vec) AS w, generate_subscripts(vec, 1) AS k FROM emb))"""


@catalog.add(with_(GRID) + """,
means AS (SELECT *, avg(w) OVER (PARTITION BY vec_id) AS mean FROM grid),
kept AS (SELECT *, CASE WHEN i = j OR w < mean THEN 0 ELSE w END AS k FROM means)
SELECT vec_id, i, j, round((k - mean) / (max(k) OVER (PARTITION BY vec_id) - mean), 6) AS w FROM kept
""")
def attention_edges(spark, sf):
    # Each vector read as the 8 x 8 attention matrix of a sentence.
    matrix = embeddings(spark, sf).select("vec_id", vs.attention_edges(square(F.col("vec"), 8)).alias("m"))
    return cells(matrix, "vec_id", "m")


@catalog.add(with_(EMB) + """,
heads AS (SELECT vec_id, (k - 1) // 32 AS layer, (k - 1) % 32 // 16 AS head, (k - 1) % 16 // 4 AS i, (k - 1) % 4 AS j, w FROM (
  SELECT vec_id, unnest(vec) AS w, generate_subscripts(vec, 1) AS k FROM emb))
SELECT vec_id, i, j, round(sum(w), 6) AS w FROM heads WHERE layer = 1 AND i < 2 + vec_id % 3 AND j < 2 + vec_id % 3 GROUP BY ALL
""")
def sum_attention_heads(spark, sf):
    # Two layers of two heads over four places; sentences are two to four tokens long.
    vec = F.col("vec")
    layer = lambda at: F.array(square(vec, 4, at), square(vec, 4, at + 16))
    length = (2 + F.col("vec_id") % 3).cast("int")
    summed = embeddings(spark, sf).select(
        "vec_id", vs.sum_attention_heads(F.array(layer(0), layer(32)), length).alias("m")
    )
    return cells(summed, "vec_id", "m")


@catalog.add(with_(EMB) + """,
ends AS (SELECT label, arg_min(vec, vec_id) AS f, arg_max(vec, vec_id) AS l FROM emb GROUP BY label),
means AS (SELECT label, d, avg(x) AS x FROM (SELECT label, unnest(vec) AS x, generate_subscripts(vec, 1) AS d FROM emb) GROUP BY ALL)
SELECT label, d - 1 AS d, round(f[d], 6) AS first, round(l[d], 6) AS last, round(x, 6) AS mean FROM ends JOIN means USING (label)
""")
def pool_tokens(spark, sf):
    pooled = vs.pool_tokens(embeddings(spark, sf), "label", "vec_id")
    long = pooled.select("label", F.posexplode(F.arrays_zip("first", "last", "mean")).alias("d", "z"))
    return long.select(
        "label", F.col("d").cast("bigint").alias("d"),
        *[F.round(f"z.{c}", 6).alias(c) for c in ("first", "last", "mean")],
    )


@catalog.add(with_(EMB) + """
SELECT vec_id, n::BIGINT AS n, d, round(vec[4 * p + d + 1], 6) AS x FROM emb,
  (VALUES (0, 0), (1, 5), (2, 15)) s(n, q), range(4) r(d), LATERAL (SELECT (q + vec_id) % 16 AS p)
""")
def gather_positions(spark, sf):
    # Each vector read as a sequence of sixteen token vectors.
    tokens = F.array(*[F.slice("vec", 4 * i + 1, 4) for i in range(16)])
    wanted = F.array(*[((F.col("vec_id") + q) % 16).cast("int") for q in (0, 5, 15)])
    got = embeddings(spark, sf).select("vec_id", vs.gather_positions(tokens, wanted).alias("g"))
    long = got.select("vec_id", F.posexplode("g").alias("n", "v"))
    return dims(long.select("vec_id", F.col("n").cast("bigint").alias("n"), "v"), "vec_id", "n", column="v")


@catalog.add(with_(SQL_TOKENS) + """
SELECT t.doc_id, t.line_no, t.pos, round((t.pos / len(l.tokens)::DOUBLE), 6) AS x,
       array_to_string(list_transform(l.tokens, lambda w: CASE WHEN w = 'in' THEN '"in"' ELSE w END), ' ') AS sentence
FROM tokens t JOIN token_lines l ON l.doc_id = t.doc_id AND l.line_no = t.line_no WHERE token = 'in'
""")
def homonym_occurrences(spark, sf):
    # A token's vector here is its relative place in the line.
    n = F.size("tokens")
    vectors = F.transform("tokens", lambda t, i: F.array(i / n))
    rows = token_lines(spark, sf).withColumn("vectors", vectors)
    uses = vs.homonym_occurrences(rows, "in", LINE_KEY)
    return uses.select(*LINE_KEY, "pos", F.round(F.get("vec", F.lit(0)), 6).alias("x"), "sentence")


@catalog.add(with_(EMB) + """
SELECT topic, doc_id, prob, row_number() OVER (PARTITION BY topic ORDER BY prob DESC, doc_id) AS rank FROM (
  SELECT label AS topic, vec_id AS doc_id, round(vec[1] * vec[1], 6) AS prob FROM emb) QUALIFY rank <= 10
""")
def topic_top_docs(spark, sf):
    first = F.get("vec", F.lit(0))
    results = embeddings(spark, sf).select(
        F.col("label").alias("topic"), F.col("vec_id").alias("doc_id"), F.round(first * first, 6).alias("prob")
    )
    return vs.topic_top_docs(results)


# ------------------------------------------------------------------ models


@catalog.add(with_(EMB) + """,
newest AS (SELECT label, vec, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS rn FROM emb QUALIFY rn <= 5),
long_ AS (SELECT label, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS idx FROM newest)
SELECT label AS name, idx, round(avg(x), 6) AS value FROM long_ GROUP BY ALL
""")
def average_snapshots(spark, sf):
    means = models.average_snapshots(embeddings(spark, sf), 5, "label", "vec_id")
    return means.withColumn("value", F.round("value", 6))


RAW = [0.3, -0.2, 0.5, 0.0]
LAYERED = EMB + """,
layered AS (SELECT label AS batch, vec_id, vec_id % 7 <> 0 AS mask, (k - 1) // 16 AS layer, (k - 1) % 16 AS d, x FROM (
  SELECT label, vec_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS k FROM emb)),
raw_w AS (SELECT * FROM (VALUES (0, 0.3::DOUBLE), (1, -0.2::DOUBLE), (2, 0.5::DOUBLE), (3, 0::DOUBLE)) v(layer, w)),
weights AS (SELECT layer, exp(w + 0.25) / sum(exp(w + 0.25)) OVER () AS w FROM raw_w)"""


def layered(spark, sf):
    """Each vector as the four layer vectors of one token; labels are batches."""
    layers = F.array(*[F.slice("vec", 16 * i + 1, 16) for i in range(4)])
    return embeddings(spark, sf).select(
        "vec_id", F.col("label").alias("batch"), (F.col("vec_id") % 7 != 0).alias("mask"), layers.alias("layers")
    )


@catalog.add(with_(LAYERED) + "SELECT vec_id, d, round(1.5::DOUBLE * sum(w * x), 6) AS x FROM layered JOIN weights USING (layer) GROUP BY ALL")
def weighted_layer_sum(spark, sf):
    return dims(models.weighted_layer_sum(layered(spark, sf), RAW, 1.5), "vec_id")


@catalog.add(with_(LAYERED) + """,
stats AS (SELECT batch, layer, avg(x) AS m, var_pop(x) AS v FROM layered WHERE mask GROUP BY ALL)
SELECT vec_id, d, round(sum(w * (x - m) / sqrt(v + 1e-12)), 6) AS x FROM layered JOIN weights USING (layer) JOIN stats USING (batch, layer) GROUP BY ALL
""")
def weighted_layer_sum_normed(spark, sf):
    return dims(models.weighted_layer_sum(layered(spark, sf), RAW, layer_norm=True), "vec_id")


@catalog.add(None)
def train_word2vec(spark, sf):
    return rounded(models.train_word2vec(token_docs(spark, sf), common_words(spark, sf), ["doc_id"]))


@catalog.add(None)
def train_tag_vectors(spark, sf):
    docs = token_docs(spark, sf).withColumn("tag", corpus.tag_document(F.col("doc_id")))
    return rounded(models.train_tag_vectors(docs, common_words(spark, sf), ["doc_id"])[0])


def lsa_words(spark, sf):
    """Words counted ten times or more, and their linear co-occurrence."""
    vocab = materialize(top_ranked(counts(spark, sf).filter("freq >= 10"), WORDS, "freq", "token"), "lsa-words")
    coded = vocabulary.in_vocab(token_lines(spark, sf), vocab, LINE_KEY, weight="freq").select("ids")
    return vocab, statistics.cooccurrence_linear(coded)


@catalog.add(None)
def word_lsa(spark, sf):
    vocab, cells = lsa_words(spark, sf)
    return dims(models.word_lsa(cells, vocab, vocab.count()), "key")


@catalog.add(None)
def word_lsa_pmi(spark, sf):
    vocab, cells = lsa_words(spark, sf)
    return dims(models.word_lsa(cells, vocab, vocab.count(), use_pmi=True), "key")


@catalog.add(None)
def doc_lsa(spark, sf):
    lowered = token_docs(spark, sf).select(F.explode("tokens").alias("t")).groupBy(F.lower("t").alias("token")).agg(
        F.count("*").alias("freq")
    )
    terms = materialize(top_ranked(lowered, WORDS, "freq", "token"), "lsa-terms")
    return dims(models.doc_lsa(statistics.tfidf(token_docs(spark, sf)), terms, terms.count()), "doc_id")


def named_pairs(spark, sf, cells, objective):
    """``side, token, vec`` of the common words from their co-occurrence."""
    words = materialize(common_words(spark, sf), "words")
    size = words.count()
    found, _ = pairs.factorize_pairs(cells, size, size, objective=objective)
    return rounded(found.join(words, "id").select("side", "token", "vec"))


@catalog.add(None)
def factorize_pairs(spark, sf):
    return named_pairs(spark, sf, cells_harmonic(spark, sf), pairs.Association())


@catalog.add(None)
def factorize_log_counts(spark, sf):
    return named_pairs(spark, sf, statistics.cooccurrence_glove(coded_lines(spark, sf)), pairs.LogCount())


def topics(spark, sf):
    docs = token_docs(spark, sf)
    model, words = models.fit_topics(docs, 30, 100_000, 5)
    return docs, model, words


@catalog.add(None)
def topic_results(spark, sf):
    docs, model, words = topics(spark, sf)
    return models.topic_results(docs, model, words).select("doc_id", "topic", F.round("prob", 3).alias("prob"))


@catalog.add(None)
def topic_top_words(spark, sf):
    _, model, words = topics(spark, sf)
    return models.topic_top_words(model, words, 10).withColumn("weight", F.round("weight", 5))


@catalog.add(None)
def score_new_docs(spark, sf):
    _, model, words = topics(spark, sf)
    fresh = table(spark, sf, "benchmark").select("item_id", whitespace_tokens(F.col("text")).alias("tokens"))
    scored = models.score_new_docs(fresh, model, words)
    return scored.select("item_id", "topic", F.round("prob", 3).alias("prob"), "remark")


# ------------------------------------------------------------------ metrics


def predictions(spark, sf):
    """Events as predictions: the user is the true class, the predicted one is drawn."""
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        e.alias("step"), (F.col("user_id") % 4).alias("label"), pick(4, 1, e).alias("predicted"),
        F.when(F.col("event_type") == "purchase", 0.5).otherwise(1.0).alias("weight"),
        (F.col("value") / 100).alias("loss"),
    )


PREDICTIONS = """
predictions AS (SELECT event_id AS step, user_id % 4 AS label,
  ('0x' || substr(md5(concat_ws('|', '1', CAST(event_id AS VARCHAR))), 1, 15))::BIGINT % 4 AS predicted,
  CASE WHEN event_type = 'purchase' THEN 0.5::DOUBLE ELSE 1 END AS weight, value / 100 AS loss FROM events)"""


def rounded(df, *columns, digits=6):
    for column in columns:
        df = df.withColumn(column, F.round(column, digits))
    return df


@catalog.add(with_(PREDICTIONS) + """
SELECT round(sum(CASE WHEN label = predicted THEN weight ELSE 0 END) / sum(weight), 6) AS accuracy,
       round(sum(weight * loss) / sum(weight), 6) AS loss FROM predictions
""")
def masked_lm_metrics(spark, sf):
    return rounded(metrics.masked_lm_metrics(predictions(spark, sf)), "accuracy", "loss")


@catalog.add(with_(PREDICTIONS) + """
SELECT round(avg((label = predicted)::INT), 6) AS accuracy, round(avg(loss), 6) AS loss FROM predictions
""")
def next_sentence_metrics(spark, sf):
    return rounded(metrics.next_sentence_metrics(predictions(spark, sf)), "accuracy", "loss")


@catalog.add(with_(PREDICTIONS) + "SELECT round(exp(avg(loss)), 6) AS perplexity FROM predictions")
def perplexity(spark, sf):
    return rounded(metrics.perplexity(predictions(spark, sf)), "perplexity")


@catalog.add(with_(PREDICTIONS) + """
SELECT step, round(exp(loss), 6) AS batch_perplexity, round(exp(avg(loss) OVER (ORDER BY step)), 6) AS perplexity FROM predictions
""")
def running_perplexity(spark, sf):
    return rounded(metrics.running_perplexity(predictions(spark, sf)), "batch_perplexity", "perplexity")


@catalog.add(with_(PREDICTIONS) + """
SELECT (step - 1) // 100 AS interval, round(avg(loss) / ln(2), 6) AS bits, round(exp(avg(loss)), 6) AS perplexity
FROM predictions WHERE step >= 1 GROUP BY ALL
""")
def bits_per_char(spark, sf):
    # Steps count from 1; the event before the first step is no step.
    steps = predictions(spark, sf).filter(F.col("step") >= 1)
    return rounded(metrics.bits_per_char(steps, 100), "bits", "perplexity")


@catalog.add(with_(PREDICTIONS) + """
SELECT (step - 1) // 50 AS interval, round(avg(loss), 6) AS loss FROM predictions WHERE step >= 1 GROUP BY ALL
""")
def interval_losses(spark, sf):
    steps = predictions(spark, sf).filter(F.col("step") >= 1)
    return rounded(metrics.interval_losses(steps, 50), "loss")


@catalog.add("""
SELECT step, score FROM (SELECT event_id AS step, value AS score,
  coalesce(max(value) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS best FROM events)
WHERE score > greatest(best, 0)
""")
def best_checkpoints(spark, sf):
    scores = table(spark, sf, "events").select(F.col("event_id").alias("step"), F.col("value").alias("score"))
    return metrics.best_checkpoints(scores)


@catalog.add(with_(EMB) + "SELECT vec_id, (list_position(vec[1:10], list_max(vec[1:10])) - 1)::BIGINT AS predicted FROM emb")
def argmax_prediction(spark, sf):
    logits = F.slice("vec", 1, 10)
    return embeddings(spark, sf).select("vec_id", metrics.argmax_prediction(logits).alias("predicted"))


@catalog.add(with_(EMB) + """,
e AS (SELECT vec_id, list_transform(vec[1:10], lambda x: exp(x - list_max(vec[1:10]))) AS l FROM emb)
SELECT vec_id, d - 1 AS d, round(x / s, 6) AS x FROM (
  SELECT vec_id, list_sum(l) AS s, unnest(l) AS x, generate_subscripts(l, 1) AS d FROM e)
""")
def softmax_probs(spark, sf):
    probs = embeddings(spark, sf).select("vec_id", softmax(F.slice("vec", 1, 10)).alias("vec"))
    return dims(probs, "vec_id")
