"""Registered queries of the operators, over whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog.base import Catalog, documents, spread, table
from corpusloom.llm import (
    bpe, languages, mixing, neighbours, packing, pages, pseudonyms, quality, resample, runs, secrets, simhash, warc,
)

catalog = Catalog()
add = catalog.add
PSEUDONYM_KEY = "corpusloom"


@add()
def op1_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.extract(spread(table(spark, sf, "pages"), "page_id"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@add()
def op2_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf).select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@add()
def op3_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    done = documents(spark, sf).select("doc_id", pseudonyms.replace_private(F.col("text"), PSEUDONYM_KEY).alias("done"))
    return done.select("doc_id", "done.text", "done.n_private")


@add()
def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(secrets.scan(documents(spark, sf).select("doc_id", "text")))


@add()
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).withColumn("held_out", languages.held_out(F.col("doc_id")))
    dictionaries = languages.learn_dictionaries(docs.filter("NOT held_out").select("text", "lang"))
    found = languages.predict(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def captures(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a full response and one later revisit of it under another form of its URL.

    One revisit in seven names another entity tag. All follows from the rows of ``pages``.
    """
    rows = spread(table(spark, sf, "pages"), "page_id").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    length = F.length("html").cast("string")
    full = rows.select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 100).alias("time"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("ETag"), tag, F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), length,
            F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.col("html").alias("payload"),
    )
    time = F.col("page_id") * 100 + 1 + F.col("page_id") * 7919 % 100_000
    again = rows.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.regexp_replace("url", "^https?:", "HTTP:").alias("url"), time.alias("time"),
        F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.when(F.col("page_id") % 7 == 0, '"other"').otherwise(tag), F.lit("Cache-Control"), F.lit("max-age=120"),
            F.lit("Content-Length"), F.lit("0"), F.lit("Date"), time.cast("string"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return full.unionByName(again)


SQL_WARC = r"""
WITH addressed AS (
  SELECT page_id, coalesce(html, '') AS html,
         regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/(index\.html?)?$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*[^?#]*\?([^#]*)', 1), '&'),
           lambda p: p <> '' AND NOT regexp_full_match(p, '(utm_[a-z]*|ref|fbclid|gclid|sessionid)(=.*)?'))) AS params
  FROM pages),
pages_by_key AS (
  SELECT *, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS key,
         '"' || md5(html) || '"' AS tag, page_id * 100 + 1 + page_id * 7919 % 100000 AS again
  FROM addressed),
paired AS (
  SELECT v.page_id * 2 + 1 AS record_id, v.key AS canonical_url, v.again AS time, r.page_id * 2 AS response_id, r.html, r.tag AS stored,
         CASE WHEN v.page_id % 7 = 0 THEN '"other"' ELSE v.tag END AS renewed
  FROM pages_by_key v ASOF LEFT JOIN (SELECT *, page_id * 100 AS time FROM pages_by_key) r ON v.key = r.key AND v.again > r.time),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no earlier response' WHEN stored = renewed THEN 'resolved' ELSE 'changed' END AS outcome FROM paired)
SELECT record_id, canonical_url, time, response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=120;content-length=' || length(html) ||
         ';content-type=text/html;date=' || time || ';etag=' || renewed END AS headers,
       CASE WHEN outcome = 'resolved' THEN length(html)::BIGINT END AS n_chars,
       CASE WHEN outcome = 'resolved' THEN md5(html) END AS payload_md5
FROM judged
"""


@add(SQL_WARC)
def op6_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    found = warc.resolve_revisits(captures(spark, sf))
    lines = F.sort_array(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select(
        "record_id", "canonical_url", "time", "response_id", "outcome", F.array_join(lines, ";").alias("headers"),
        F.length("payload").cast("bigint").alias("n_chars"), F.md5("payload").alias("payload_md5"),
    )


# Shares are found in the order of size over weight, as in mixing.targets; the place of a document
# in its queue, the finish times and the cut follow by running sums.
SQL_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS size,
         substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS shuffle
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most FROM totals),
ranked AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS budget,
         (sum(source_size) OVER () - coalesce(sum(most) OVER earlier, 0))::BIGINT AS left_words,
         (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::BIGINT AS left_weight
  FROM weighed
  WINDOW earlier AS (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, most::DOUBLE * left_weight <= weight * left_words::DOUBLE AS cut FROM ranked),
shares AS (
  SELECT *, CASE WHEN cut THEN most::DOUBLE
                 ELSE weight * (max(left_words) FILTER (NOT cut) OVER ())::DOUBLE / (max(left_weight) FILTER (NOT cut) OVER ())
            END AS target
  FROM marked),
served AS (
  SELECT place, shuffle, sum(size)::BIGINT AS size
  FROM sized JOIN shares ON sized.source IS NOT DISTINCT FROM shares.source
  WHERE size > 0 AND target > 0 GROUP BY place, shuffle),
queued AS (
  SELECT *, sum(size) OVER (PARTITION BY place ORDER BY shuffle)::BIGINT AS upto FROM served),
turns AS (
  SELECT q.place, shuffle, turn, size, turn * source_size + upto AS reach, target, budget
  FROM queued q JOIN shares USING (place), (SELECT unnest([0, 1, 2]) AS turn)),
merged AS (
  SELECT *, sum(size) OVER (ORDER BY reach / target, place, turn, shuffle) AS total
  FROM turns WHERE reach - size < target),
ends AS (
  SELECT place, max({'turn': turn, 'shuffle': shuffle}) AS last FROM merged WHERE total <= budget GROUP BY place)
SELECT doc_id, size, source_size, target,
       (size * (coalesce(last.turn, 0) + CASE WHEN shuffle <= last.shuffle THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN shares ON sized.source IS NOT DISTINCT FROM shares.source LEFT JOIN ends USING (place)
"""


@add(SQL_MIX)
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.plan_mix(documents(spark, sf).select("doc_id", "text", "source"))


@add()
def op8_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(table(spark, sf, "embeddings"), lambda vec_id: vec_id % 50 == 0)


@add()
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    texts = documents(spark, sf).select("doc_id", "text")
    judged = quality.judge(texts, quality.learn_rules(texts, table(spark, sf, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@add()
def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(bpe.encode_and_decode(documents(spark, sf).select("doc_id", "text")))


def tailed_words(docs: DataFrame) -> DataFrame:
    """``doc_id, words``; in one document of ten, by the CRC of its id, a tail of the words is made periodic."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    marked = docs.select("doc_id", runs.words(F.col("text")).alias("w"), crc.alias("h")).withColumn("g", F.expr("h div 10"))
    begin = F.expr("CAST(g % size(w) AS INT)")
    placed = marked.withColumn("a", F.when((F.col("h") % 10 == 0) & (F.size("w") > 0), begin))
    period = F.expr("CAST(1 + (size(w) - a) div (3 + g % 8) AS INT)")
    placed = placed.withColumn("p", period)
    repeated = F.expr("transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p]))")
    return placed.select("doc_id", F.when(F.col("a").isNull(), F.col("w")).otherwise(repeated).alias("words"))


@add()
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return runs.report(runs.find_runs(tailed_words(documents(spark, sf))))


# The CRC-32 of each distinct word goes byte by byte through a table of 256 values, made by eight shifts each.
SQL_RESAMPLE = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v
    FROM range(256) t(i))),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS row_no, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
listed AS (
  SELECT side, row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
tokens AS (SELECT side, row_no, unnest(words) AS word FROM listed),
spelled AS (
  SELECT word, list_transform(range(0, len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) AS bytes
  FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM tokens)),
hashed AS (
  SELECT word, xor(list_reduce(bytes, lambda c, b: xor(c // 256, tab[(xor(c, b) % 256) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM spelled, crc_table),
placed AS (SELECT side, row_no, bucket FROM tokens JOIN hashed USING (word)),
per_bucket AS (
  SELECT id AS bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM range(10000) r(id) LEFT JOIN placed ON bucket = id GROUP BY id),
gains AS (
  SELECT bucket, floor(1000 * ln((t::DOUBLE + 1) * (sum(s) OVER () + 10000)::DOUBLE
                                 / ((s::DOUBLE + 1) * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM per_bucket),
weighed AS (
  SELECT row_no, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_no),
scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM listed LEFT JOIN weighed USING (row_no) WHERE side = 'd'),
placings AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
         count(*) FILTER (n_features >= 20) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM placings
"""


@add(SQL_RESAMPLE)
def op12_target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resample.resample(documents(spark, sf).select("doc_id", "text"), table(spark, sf, "benchmark"))


@add()
def op13_slack_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf).select("doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def all_queries():
    return dict(catalog.queries)


def all_sql():
    return dict(catalog.sql)
