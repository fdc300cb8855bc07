"""Queries that write the tables in a corpus format and read them back.

They compare what comes back with the table itself, so a writer and its reader are checked
together over whole tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from corpusloom.catalog.base import (
    SQL_COUNTS, SQL_LINES, Catalog, counts, documents, sql_ranked, table, with_,
)
from corpusloom.catalog.stats import CELLS, cells_harmonic
from corpusloom.catalog.texts import ANALOGY_LINES, STRIP, WIKI_CLEAN
from corpusloom.functions import text as tx
from corpusloom.functions.hashing import digest
from corpusloom.functions.text import whitespace_tokens
from corpusloom.operators import vocabulary
from corpusloom.plans.ranking import top_ranked
from corpusloom.session import scratch_dir
from corpusloom.sources import readers, writers

catalog = Catalog()


def fresh(spark, name):
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")


def one_line(column="text"):
    return F.regexp_replace(column, "\\s+", " ")


FLAT = "regexp_replace(text, '\\s+', ' ', 'g')"


@catalog.add(f"SELECT {STRIP} AS text, count(*) AS n FROM (" + with_(SQL_LINES) + " SELECT * FROM lines) GROUP BY 1")
def read_text_lines(spark, sf):
    path = fresh(spark, "lines")
    documents(spark, sf).select("text").write.text(path)
    return readers.read_lines(spark, path).groupBy("text").agg(F.count("*").alias("n"))


@catalog.add(f"SELECT doc_id::VARCHAR AS id, trim({FLAT}) AS text, quality::BIGINT AS label FROM documents JOIN labels USING (doc_id) WHERE trim({FLAT}) <> ''")
def read_labelled_tsv(spark, sf):
    path = fresh(spark, "reviews")
    rows = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), F.trim(one_line()), F.col("quality").cast("string"))
    rows.select(line.alias("id\tdocument\tlabel")).write.option("header", True).option("quote", "").option(
        "sep", "\u0001"
    ).csv(path)
    back = readers.read_labelled_tsv(spark, path)
    return back.select("id", "text", F.col("label").cast("bigint").alias("label"))


@catalog.add(f"SELECT {STRIP} AS text, source AS tag, count(*) AS n FROM documents WHERE {STRIP} <> '' GROUP BY ALL")
def read_review_json(spark, sf):
    # Every file is one array of reviews, written over several lines.
    path = fresh(spark, "json")
    review = F.struct(F.col("text").alias("review"), F.col("source").alias("movie_id"))
    files = documents(spark, sf).groupBy(F.pmod("doc_id", F.lit(16)).alias("file")).agg(F.collect_list(review).alias("r"))
    files.repartition(16, "file").select("file", F.to_json("r", {"pretty": "true"}).alias("value")).write.option(
        "lineSep", "\n"
    ).partitionBy("file").text(path)
    rows = readers.read_review_json(spark, f"{path}/*")
    return rows.groupBy("text", "tag").agg(F.count("*").alias("n"))


# What stands before every article; nested brackets are at most three deep, as the SQL repeats three passes.
WIKI_MARKUP = (
    "{{Infobox|a={{n|x {{m}}}}|b=c}}<!-- no -->Start<ref name=r/> one<ref>note [[x]]</ref> [[Target page|label]] [[plain]] "
    "[[File:p.png|thumb|a [[q|caption]] here]] [[File:bare.png]] {| class=t\n| cell {| in |} |} [[Category:C|key]] "
    "[http://e.org/x named link] a&nbsp;b &lt;end&gt;\n"
)


def wiki_sql(text: str) -> str:
    def replace(inner: str, pattern: str, kept: str = "") -> str:
        return f"regexp_replace({inner}, '{pattern}', '{kept}', 'g')"

    out = replace(text, "(?s)<!--.*?-->")
    for name in tx.WIKI_ELEMENTS:
        out = replace(replace(out, rf"<{name}\b[^<>]*/>"), rf"(?s)<{name}\b[^<>]*>.*?</{name} *>")
    for pattern, kept in ((tx.WIKI_TEMPLATE, ""), (tx.WIKI_TABLE, "")):
        for _ in range(3):
            out = replace(out, pattern, kept)
    out = replace(replace(out, tx.WIKI_CATEGORY), tx.WIKI_BARE_FILE)
    for _ in range(3):
        out = replace(out, tx.WIKI_LINK, r"\1")
    out = replace(replace(out, tx.WIKI_ADDRESS, r"\1"), "<[^<>]*>")
    for sign, letter in tx.WIKI_SIGNS.items():
        out = f"replace({out}, '{sign}', '{letter}')"
    return out


@catalog.add(f"""
WITH plain AS (SELECT page_id, url, {wiki_sql("'" + WIKI_MARKUP + "' || html")} AS html FROM pages),
pieces AS (SELECT page_id AS doc_id, url AS title, list_filter(list_transform(list_filter(string_split({WIKI_CLEAN}, ' '),
   lambda t: NOT starts_with(t, '_')), lambda t: regexp_replace(t, '\\*$|:$|^파일:.+|^;', '', 'g')), lambda t: t <> '') AS tokens FROM plain)
SELECT doc_id, title, array_to_string(tokens, ' ') AS tokens FROM pieces WHERE len(tokens) >= 50
""")
def read_wiki_xml(spark, sf):
    path = fresh(spark, "wiki")
    table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.lit(0).alias("ns"), F.col("url").alias("title"),
        F.struct(F.concat(F.lit(WIKI_MARKUP), "html").alias("text")).alias("revision"),
    ).write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").option("compression", "bzip2").save(path)
    back = readers.read_wiki_xml(spark, path)
    return back.select("doc_id", "title", F.array_join("tokens", " ").alias("tokens"))


@catalog.add(with_(SQL_LINES) + f""",
marked AS (SELECT doc_id, line_no, {STRIP} AS text, {STRIP} = '' AS blank FROM (
  SELECT * FROM lines UNION ALL SELECT doc_id, max(line_no) + 1, '' FROM lines GROUP BY doc_id)),
grouped AS (SELECT *, sum(blank::INT) OVER (ORDER BY doc_id, line_no) AS g FROM marked),
numbered AS (SELECT dense_rank() OVER (ORDER BY g) - 1 AS doc_no, row_number() OVER (PARTITION BY g ORDER BY doc_id, line_no) - 1 AS sent_no, text FROM grouped WHERE NOT blank)
SELECT doc_no, sent_no, text FROM numbered
""")
def read_blankline_docs(spark, sf):
    path = fresh(spark, "docs")
    text = F.concat("text", F.lit("\n"))
    documents(spark, sf).repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(text.alias("value")).write.text(path)
    return readers.read_blankline_docs(spark, path)


@catalog.add(f"SELECT {FLAT} AS text, source, lang FROM documents")
def read_records(spark, sf):
    path = fresh(spark, "records")
    rows = documents(spark, sf).select(one_line().alias("text"), "source", "lang")
    writers.write_records(rows, path)
    return readers.read_records(spark, path, ["text", "source", "lang"])


VECTOR_SQL = "SELECT 'v' || vec_id AS key, len(embedding) AS dim, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total FROM embeddings"


def vectors_back(spark, sf, layout, sep):
    path = fresh(spark, "vectors")
    rows = table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("key"), F.col("embedding").alias("vec")
    )
    if layout == "header+space":
        head = spark.createDataFrame([("500", [64.0])], "key string, vec array<float>")
        rows = rows.unionByName(head.withColumn("vec", F.col("vec").cast("array<int>").cast("array<float>")))
        line = F.when(F.size("vec") > 1, writers.vector_line("key", "vec", sep)).otherwise(F.lit("500 64"))
        rows.select(line.alias("value")).write.text(path)
    else:
        writers.write_vectors(rows, path, sep=sep)
    back = readers.read_vectors(spark, path, layout)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return back.select("key", F.size("vec").cast("bigint").alias("dim"), F.round(total, 4).alias("total"))


@catalog.add(VECTOR_SQL)
def read_vectors_space(spark, sf):
    return vectors_back(spark, sf, "space", " ")


@catalog.add(VECTOR_SQL)
def read_vectors_header(spark, sf):
    return vectors_back(spark, sf, "header+space", " ")


@catalog.add(VECTOR_SQL)
def read_vectors_tab(spark, sf):
    return vectors_back(spark, sf, "tab", "\t")


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(20000))
    + " SELECT * FROM (VALUES (0, '</S>'), (1, '<S>'), (2, '<UNK>')) s(id, token) UNION ALL SELECT id + 3, token FROM ranked"
)
def read_vocab(spark, sf):
    path = fresh(spark, "vocab")
    writers.write_vocab(vocabulary.vocab_top_k(counts(spark, sf), 20_000), path)
    return readers.read_vocab(spark, path)


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(20000))
    + " SELECT * FROM (VALUES (0, '</S>'), (1, '<S>'), (2, '<UNK>')) s(id, token) UNION ALL SELECT id + 3, token FROM ranked"
)
def read_lm_vocab(spark, sf):
    path = fresh(spark, "vocab")
    ranked = top_ranked(counts(spark, sf), 20_000, "freq", "token").select("id", "token")
    writers.write_vocab(writers.vocab_with_specials(ranked, ["</S>", "!!!MAXTERMID", "<S>", "<UNK>"]), path)
    return readers.read_lm_vocab(spark, path, require_specials=True)


@catalog.add("""
SELECT 'v' || a.vec_id AS word_1, 'v' || b.vec_id AS word_2, (a.label = b.label)::INT::DOUBLE AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def read_similarity_pairs(spark, sf):
    path = fresh(spark, "pairs")
    v = table(spark, sf, "embeddings").select("vec_id", "label")
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("label").alias("next"))
    name = lambda c: F.concat(F.lit("v"), c.cast("string"))
    v.join(after, "vec_id").select(
        name(F.col("vec_id")), name(F.col("vec_id") + 1), (F.col("label") == F.col("next")).cast("double")
    ).write.csv(path)
    return readers.read_similarity_pairs(spark, path)


@catalog.add(f"""
WITH {ANALOGY_LINES}
SELECT CASE WHEN len(w) = 4 THEN w[1] END AS a, CASE WHEN len(w) = 4 THEN w[2] END AS b, CASE WHEN len(w) = 4 THEN w[3] END AS c, w[len(w)] AS d
FROM (SELECT string_split(text, ' ') AS w, text FROM analogy_lines) WHERE NOT starts_with(text, '#')
""")
def read_analogies(spark, sf):
    path = fresh(spark, "analogies")
    name = lambda i: F.concat(F.lit("v"), (F.col("vec_id") + i).cast("string"))
    vectors = table(spark, sf, "embeddings")
    fourth = F.when(F.col("vec_id") % 3 != 0, name(3))
    rows = vectors.select(F.concat_ws(" ", name(0), name(1), name(2), fourth).alias("text"))
    rows.unionByName(vectors.select(F.lit("# comment").alias("text"))).write.text(path)
    return readers.read_analogies(spark, path)


@catalog.add("SELECT vec_id, 65::BIGINT AS n, (label + 64 * 65 // 2)::BIGINT AS total FROM (SELECT vec_id, label FROM embeddings)")
def read_id_lines(spark, sf):
    path = fresh(spark, "ids")
    rows = table(spark, sf, "embeddings")
    line = F.concat_ws(" ", F.col("vec_id").cast("string"), F.col("label").cast("string"), F.array_join(F.sequence(F.lit(1), F.lit(64)), " "))
    rows.select(line.alias("value")).write.text(path)
    ids = readers.read_id_lines(spark, path).select(F.get("ids", F.lit(0)).cast("bigint").alias("vec_id"), F.expr("slice(ids, 2, 65)").alias("r"))
    return ids.select("vec_id", F.size("r").cast("bigint").alias("n"), F.aggregate("r", F.lit(0), lambda a, x: a + x).cast("bigint").alias("total"))


@catalog.add(f"SELECT count(*) AS total, true AS within FROM documents")
def write_line_shards(spark, sf):
    path = fresh(spark, "shards")
    writers.write_line_shards(documents(spark, sf).select(one_line().alias("text")), path, 100)
    files = spark.read.text(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("total"), (F.max("n") <= 100).alias("within"))


@catalog.add("""
SELECT shard, doc_id FROM (SELECT doc_id,
  (row_number() OVER (ORDER BY md5(concat_ws('|', '4', CAST(doc_id AS VARCHAR)))) - 1) % 10 AS shard FROM documents)
""")
def write_example_shards(spark, sf):
    path = fresh(spark, "examples")
    writers.write_example_shards(documents(spark, sf).select("doc_id", "text"), path, 10, digest(4, F.col("doc_id")))
    return spark.read.parquet(path).select(F.col("shard").cast("bigint").alias("shard"), "doc_id")


@catalog.add(with_(CELLS) + """
SELECT row_id % 4 AS row_shard, col_id % 4 AS col_shard, row_id // 4 AS local_row, col_id // 4 AS local_col, round(value, 6) AS value FROM cells
""")
def write_cooc_shards(spark, sf):
    path = fresh(spark, "cooc")
    writers.write_cooc_shards(cells_harmonic(spark, sf), path, 4)
    back = spark.read.parquet(path)
    return back.select(
        F.col("row_shard").cast("bigint").alias("row_shard"), F.col("col_shard").cast("bigint").alias("col_shard"),
        "local_row", "local_col", F.round("value", 6).alias("value"),
    )


@catalog.add(f"""
SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda t: t <> '')) AS n FROM documents
""")
def tokenized_cache(spark, sf):
    path = fresh(spark, "tokens")
    build = lambda df: df.select("doc_id", whitespace_tokens(F.col("text")).alias("tokens"))
    writers.tokenized_cache(documents(spark, sf), path, build)
    again = writers.tokenized_cache(documents(spark, sf), path, build)
    return again.select("doc_id", F.size("tokens").cast("bigint").alias("n"))
