"""Queries for co-occurrence, association and term weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.base import (
    LEAST, LINE_KEY, SQL_COUNTS, SQL_TOKENS, WORDS, Catalog, common_words, counts, joined, sql_ranked, table,
    token_docs, token_lines, with_,
)
from corpusloom.operators import pairwise
from corpusloom.operators import statistics as st
from corpusloom.operators import vocabulary
from corpusloom.plans.ranking import top_ranked
from corpusloom.sources import writers

catalog = Catalog()

def coded_lines(spark, sf):
    """Lines as ids of the vocabulary's words, other words left out."""
    return vocabulary.in_vocab(token_lines(spark, sf), common_words(spark, sf), LINE_KEY).select("ids")


def cells_harmonic(spark, sf):
    return st.cooccurrence_harmonic(coded_lines(spark, sf))


CODED = (
    SQL_COUNTS + "," + sql_ranked(WORDS, least=LEAST) + """,
coded AS (SELECT doc_id, line_no, id, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS p
  FROM tokens JOIN ranked USING (token))"""
)


def sql_pairs(window: int, weight: str, source: str = "coded") -> str:
    return f""",
pairs AS (SELECT a.id AS x, b.id AS y, {weight} AS w FROM {source} a JOIN {source} b
  ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND b.p > a.p AND b.p <= a.p + {window})"""


BOTH = "SELECT x, y, w FROM pairs UNION ALL SELECT y, x, w FROM pairs"
CELLS = CODED + sql_pairs(10, "1.0::DOUBLE / (b.p - a.p)") + f""",
cells AS (SELECT x AS row_id, y AS col_id, fsum(w) AS value FROM (
  {BOTH} UNION ALL SELECT id, id, 1.0 FROM coded) GROUP BY ALL)"""


@catalog.add(with_(CELLS) + "SELECT row_id, col_id, round(value, 6) AS value FROM cells")
def cooccurrence_harmonic(spark, sf):
    return cells_harmonic(spark, sf).withColumn("value", F.round("value", 6))


@catalog.add(
    with_(SQL_COUNTS, " ranked AS (SELECT token, row_number() OVER (ORDER BY freq DESC, token) - 1 AS id FROM counts WHERE freq >= 10)",
          """ coded AS (SELECT doc_id, line_no, id, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS p
          FROM tokens LEFT JOIN ranked USING (token))""")
    + sql_pairs(3, "(4 - (b.p - a.p)) / 3.0::DOUBLE")
    + f"SELECT x AS row_id, y AS col_id, round(sum(w), 6) AS value FROM ({BOTH}) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL"
)
def cooccurrence_linear(spark, sf):
    vocab = vocabulary.vocab_ranked(vocabulary.vocab_min_count(counts(spark, sf), 10))
    coded = vocabulary.encode_with_unknown(token_lines(spark, sf), vocab, LINE_KEY, -1)
    return st.cooccurrence_linear(coded.select("ids")).withColumn("value", F.round("value", 6))


@catalog.add(
    with_(SQL_COUNTS, " ranked AS (SELECT token, row_number() OVER (ORDER BY freq DESC, token) - 1 AS id FROM counts WHERE freq >= 5)",
          """ coded AS (SELECT doc_id, line_no, id, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS p
          FROM tokens JOIN ranked USING (token))""")
    + sql_pairs(15, "1.0::DOUBLE / (b.p - a.p)")
    + f"SELECT x AS row_id, y AS col_id, round(sum(w), 6) AS value FROM ({BOTH}) GROUP BY ALL"
)
def cooccurrence_glove(spark, sf):
    vocab = vocabulary.vocab_ranked(vocabulary.vocab_min_count(counts(spark, sf), 5))
    coded = vocabulary.in_vocab(token_lines(spark, sf), vocab, LINE_KEY).select("ids")
    return st.cooccurrence_glove(coded).withColumn("value", F.round("value", 6))


@catalog.add(with_(CELLS) + "SELECT row_id, round(sum(value), 4) AS row_sum FROM cells GROUP BY row_id")
def marginals(spark, sf):
    return st.marginals(cells_harmonic(spark, sf)).withColumn("row_sum", F.round("row_sum", 4))


@catalog.add(with_(CELLS) + """
SELECT row_id, col_id, round(value, 6) AS value FROM cells
""")
def shuffle_pairs(spark, sf):
    return st.shuffle_pairs(cells_harmonic(spark, sf), 5).withColumn("value", F.round("value", 6))


@catalog.add(with_(CELLS) + """
SELECT row_id % 8 AS row_shard, row_id // 8 AS local_row, col_id % 8 AS col_shard, col_id // 8 AS local_col,
       round(value, 6) AS value FROM cells
""")
def cooc_shards(spark, sf):
    return writers.cooc_shards(cells_harmonic(spark, sf), 8).withColumn("value", F.round("value", 6))


MARGINS = CELLS + """,
rows_ AS (SELECT row_id, fsum(value) AS row_sum FROM cells GROUP BY 1),
cols_ AS (SELECT col_id, fsum(value) AS col_sum FROM cells GROUP BY 1),
tot AS (SELECT fsum(value) AS total FROM cells)"""


@catalog.add(with_(MARGINS) + """
SELECT row_id, col_id, round(pmi, 4) AS pmi FROM (
  SELECT row_id, col_id, ln(value * total / (row_sum * col_sum)) AS pmi
  FROM cells JOIN rows_ USING (row_id) JOIN cols_ USING (col_id), tot) WHERE pmi >= ln(5.0)
""")
def pmi(spark, sf):
    return st.pmi(cells_harmonic(spark, sf), symmetric=True).withColumn("pmi", F.round("pmi", 4))


@catalog.add(with_(MARGINS) + """
SELECT row_id, col_id, round(ln(value) - ln(row_sum + 1) - ln(col_sum + 1) + ln(total + 1), 4) AS target,
       round(sqrt(value), 4) AS weight
FROM cells JOIN rows_ USING (row_id) JOIN cols_ USING (col_id), tot
""")
def pmi_targets(spark, sf):
    targets = st.pmi_targets(cells_harmonic(spark, sf), symmetric=True)
    return targets.withColumn("target", F.round("target", 4)).withColumn("weight", F.round("weight", 4))


@catalog.add(with_(MARGINS) + """,
scored AS (SELECT row_id, col_id, round(ln(value * total / (row_sum * col_sum)), 6) AS pmi
  FROM cells JOIN rows_ USING (row_id) JOIN cols_ USING (col_id), tot),
best AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY pmi DESC, col_id) AS rank FROM scored QUALIFY rank <= 20)
SELECT w.token AS word, c.token AS collocate, rank, pmi
FROM best JOIN ranked w ON w.id = row_id JOIN ranked c ON c.id = col_id
""")
def top_collocates(spark, sf):
    vocab = common_words(spark, sf)
    coded = vocabulary.in_vocab(token_lines(spark, sf), vocab, LINE_KEY).select("ids")
    scores = st.pmi(st.cooccurrence_harmonic(coded), float("-inf"), symmetric=True)
    best = st.top_collocates(scores.withColumn("pmi", F.round("pmi", 6)), 20)
    words = vocab.select(F.col("id").alias("row_id"), F.col("token").alias("word"))
    others = vocab.select(F.col("id").alias("col_id"), F.col("token").alias("collocate"))
    named = best.join(words, "row_id").join(others, "col_id")
    return named.select(
        "word", "collocate", F.col("rank").cast("bigint").alias("rank"), "pmi"
    )


@catalog.add(with_(SQL_TOKENS) + """,
tf AS (SELECT doc_id, lower(token) AS term, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT doc_id, term, tf, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS r FROM tf JOIN df USING (term))
SELECT doc_id, term, tf, round(r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM raw
""")
def tfidf(spark, sf):
    return st.tfidf(token_docs(spark, sf)).withColumn("tfidf", F.round("tfidf", 6))


SIMILAR = with_(SQL_TOKENS) + """,
tf AS (SELECT doc_id, lower(token) AS term, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT doc_id, term, tf, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS r FROM tf JOIN df USING (term)),
bags AS (SELECT doc_id, list((term, tf) ORDER BY term) AS bag FROM documents LEFT JOIN tf USING (doc_id) GROUP BY doc_id),
members AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY bag) AS representative FROM bags),
w AS (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS w FROM raw JOIN members USING (doc_id) WHERE doc_id = representative),
near AS (SELECT a.doc_id AS x, b.doc_id AS y, round(sum(a.w * b.w), 9) AS score
  FROM w a JOIN w b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL HAVING round(sum(a.w * b.w), 9) >= 0.8)
"""


@catalog.add(SIMILAR + "SELECT x, y, round(score, 6) AS score FROM near")
def similar_documents(spark, sf):
    """All pairs of different documents with a TF-IDF cosine of 0.8 and more, between the smallest ids of equal bags of words."""
    pairs, _ = pairwise.similar_documents(token_docs(spark, sf))
    return pairs.withColumn("score", F.round("score", 6))


@catalog.add(SIMILAR + """,
ends AS (SELECT x AS d FROM near UNION ALL SELECT y FROM near)
SELECT doc_id, representative, (SELECT count(*) FROM ends WHERE d = representative) AS n_links FROM members
""")
def similar_document_links(spark, sf):
    """Every document with its class of equal bags and the number of other classes that are similar to it."""
    pairs, members = pairwise.similar_documents(token_docs(spark, sf))
    return pairwise.count_links(pairs, members)


WORD_VECTORS = SQL_COUNTS + "," + sql_ranked(WORDS) + """,
vectors AS (SELECT token AS key, embedding::DOUBLE[] AS vec FROM ranked JOIN embeddings ON vec_id = id)"""


def word_vectors(spark, sf):
    """The vector table keyed by the words of the same rank."""
    vocab = top_ranked(counts(spark, sf), WORDS, "freq", "token")
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    return vocab.join(vectors, "id").select(F.col("token").alias("key"), "vec")


@catalog.add(with_(WORD_VECTORS) + """
SELECT key, round(w, 6) AS weight, round(list_sum(list_transform(vec, lambda x: x * w)), 6) AS vec_sum, round(vec[1] * w, 6) AS first
FROM (SELECT key, vec, 0.0001::DOUBLE / (coalesce(freq, 0) / (SELECT sum(freq) FROM counts)::DOUBLE + 0.0001::DOUBLE) AS w
      FROM vectors LEFT JOIN counts ON token = key)
""")
def sif_weights(spark, sf):
    weighted = st.sif_weights(counts(spark, sf), word_vectors(spark, sf))
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return weighted.select(
        "key", F.round("weight", 6).alias("weight"), F.round(total, 6).alias("vec_sum"),
        F.round(F.get("vec", F.lit(0)), 6).alias("first"),
    )


@catalog.add(with_(SQL_TOKENS) + """
SELECT doc_id, string_agg(token, ' ' ORDER BY token) AS terms FROM (SELECT DISTINCT doc_id, token FROM tokens) GROUP BY doc_id
""")
def distinct_bow(spark, sf):
    bags = token_docs(spark, sf).filter(F.size("tokens") > 0)
    return bags.select("doc_id", joined(st.distinct_bow(F.col("tokens"))).alias("terms"))


@catalog.add(with_(SQL_TOKENS) + """
SELECT doc_id, string_agg(token, ' ' ORDER BY line_no, pos) AS terms FROM tokens
WHERE regexp_matches(token, '(tion|ment|ung)[.,]?$') AND token NOT IN ('tion', 'ment', 'ung') GROUP BY doc_id
""")
def term_filter(spark, sf):
    kept = st.term_filter(F.col("tokens"), ["tion", "ment", "ung"], "(tion|ment|ung)[.,]?$")
    docs = token_docs(spark, sf).select("doc_id", kept.alias("terms")).filter(F.size("terms") > 0)
    return docs.select("doc_id", joined("terms").alias("terms"))
