"""Queries for training examples, stream windows and example shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.base import (
    LINE_KEY, SQL_COUNTS, WS, Catalog, counts, documents, joined, sql_ranked, table, token_lines, with_,
)
from corpusloom.catalog.words import PIECE_WORDS, piece_vocab, sql_pieces
from corpusloom.functions.hashing import digest, uniform
from corpusloom.functions.text import WHITESPACE, sentence_sizes, whitespace_tokens
from corpusloom.operators import examples as ex
from corpusloom.operators import streams, vocabulary
from corpusloom.operators.tokenize import SPECIALS, wordpiece
from corpusloom.plans.ranking import top_ranked
from corpusloom.sources import writers

catalog = Catalog()

WORDS = 31_995
VOCAB = WORDS + 5


def vocab(spark, sf):
    return writers.vocab_with_specials(
        top_ranked(counts(spark, sf), WORDS, "freq", "token").select("id", "token"), SPECIALS
    )


def coded_lines(spark, sf):
    """``doc_id, line_no, ids`` with the unknown word for words outside the vocabulary."""
    coded = vocabulary.encode_with_unknown(token_lines(spark, sf), vocab(spark, sf), LINE_KEY, ex.UNK)
    return coded.drop("tokens")


def coded_docs(spark, sf, parts):
    """``doc_id, source, ids, sizes``: a document's ids and the number in each of its parts."""
    full = F.filter(parts, lambda p: p.rlike(f"[^{WHITESPACE}]"))
    arrays = F.transform(full, whitespace_tokens)
    docs = documents(spark, sf).select("doc_id", "source", arrays.alias("_a")).select(
        "doc_id", "source", F.flatten("_a").alias("tokens"), F.transform("_a", lambda t: F.size(t)).alias("sizes")
    )
    coded = vocabulary.encode_with_unknown(docs, vocab(spark, sf), ["doc_id"], ex.UNK)
    return coded.drop("tokens").filter(F.size("sizes") > 0)


def line_docs(spark, sf):
    return coded_docs(spark, sf, F.split("text", "\n"))


def sentence_docs(spark, sf):
    """As ``coded_docs`` of the sentences; a text is cut into tokens once, not sentence by sentence."""
    docs = documents(spark, sf).select("doc_id", "source", whitespace_tokens(F.col("text")).alias("tokens"))
    sized = docs.withColumn("sizes", sentence_sizes(F.col("tokens")))
    return vocabulary.encode_with_unknown(sized, vocab(spark, sf), ["doc_id"], ex.UNK).drop("tokens").filter(F.size("sizes") > 0)


CODED = SQL_COUNTS + "," + sql_ranked(WORDS) + """,
coded AS (SELECT doc_id, line_no, pos, coalesce(id + 5, 1) AS id FROM tokens LEFT JOIN ranked USING (token)),
ids AS (SELECT doc_id, line_no, list(id ORDER BY pos) AS l FROM coded GROUP BY ALL)"""


def sql_draw(seed: str, *keys: str) -> str:
    parts = ", ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"('0x' || substr(md5(concat_ws('|', {parts})), 1, 15))::BIGINT"


def sql_uniform(seed: str, *keys: str) -> str:
    return f"({sql_draw(seed, *keys)} / 1152921504606846976.0::DOUBLE)"


def fill(value: str, n: str) -> str:
    return f"list_transform(range({n}), lambda i: {value})"


def text_of(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


# ------------------------------------------------------------------ classifier inputs


@catalog.add(with_(CODED) + f""",
seq AS (SELECT doc_id, line_no, list_concat(list_concat([2], l[1:126]), [3]) AS s FROM ids)
SELECT doc_id, line_no, {text_of(f"list_concat(s, {fill('0', '128 - len(s)')})")} AS input_ids,
       {text_of(f"list_concat({fill('1', 'len(s)')}, {fill('0', '128 - len(s)')})")} AS input_mask,
       {text_of(fill('0', '128'))} AS segment_ids FROM seq
""")
def features_right_pad(spark, sf):
    built = coded_lines(spark, sf).select(*LINE_KEY, ex.features_right_pad(F.col("ids")).alias("f"))
    return built.select(*LINE_KEY, *[joined(f"f.{c}").alias(c) for c in ("input_ids", "input_mask", "segment_ids")])


@catalog.add(with_(CODED) + f""",
seq AS (SELECT doc_id, line_no, l[1:62] AS s FROM ids)
SELECT doc_id, line_no, {text_of(f"list_concat({fill('0', '62 - len(s)')}, list_concat(s, [4, 3]))")} AS input_ids,
       {text_of(f"list_concat({fill('1', '62 - len(s)')}, {fill('0', 'len(s) + 2')})")} AS input_mask,
       {text_of(f"list_concat(list_concat({fill('4', '62 - len(s)')}, {fill('0', 'len(s) + 1')}), [2])")} AS segment_ids FROM seq
""")
def features_left_pad(spark, sf):
    built = coded_lines(spark, sf).select(*LINE_KEY, ex.features_left_pad(F.col("ids")).alias("f"))
    return built.select(*LINE_KEY, *[joined(f"f.{c}").alias(c) for c in ("input_ids", "input_mask", "segment_ids")])


@catalog.add(with_(CODED) + f""",
longest AS (SELECT *, max(len(l)) OVER (PARTITION BY doc_id) AS m FROM ids)
SELECT doc_id, line_no, {text_of(f"list_concat(l, {fill('0', 'm - len(l)')})")} AS ids, m AS length, len(l) AS true_length FROM longest
""")
def features_batch_pad(spark, sf):
    # The lines of a document are a batch.
    padded = ex.features_batch_pad(coded_lines(spark, sf), ex.PAD, ["doc_id"])
    return padded.withColumn("ids", joined("ids"))


def sql_epochs(limit: str) -> str:
    return f"""
WITH n AS (SELECT count(*) AS n FROM labels),
numbered AS (SELECT doc_id, epoch, row_number() OVER (PARTITION BY epoch
  ORDER BY md5(concat_ws('|', '9', CAST(epoch AS VARCHAR), CAST(doc_id AS VARCHAR)))) - 1 AS r FROM labels, range(3) e(epoch))
SELECT doc_id, epoch, r // 32 AS batch_no, r % 32 AS place FROM numbered, n {limit}"""


@catalog.add(sql_epochs("WHERE r < (n - 1) // 32 * 32"))
def epoch_batches(spark, sf):
    return ex.epoch_batches(table(spark, sf, "labels").select("doc_id"), 32, 3, 9, "doc_id")


@catalog.add(sql_epochs(""))
def epoch_batches_keep_remainder(spark, sf):
    return ex.epoch_batches(table(spark, sf, "labels").select("doc_id"), 32, 3, 9, "doc_id", "keep")


# ------------------------------------------------------------------ sentence pairs


@catalog.add("SELECT doc_id, source, copy FROM documents, range(5) r(copy)")
def duplicate_corpus(spark, sf):
    return ex.duplicate_corpus(documents(spark, sf).select("doc_id", "source"), 5)


def sql_target(doc: str = "doc_id") -> str:
    return (
        f"CASE WHEN {sql_uniform('7/short', 'copy', doc)} < 0.1 THEN 2 + {sql_draw('7/length', 'copy', doc)} % 124 ELSE 125 END"
    )


@catalog.add(f"SELECT doc_id, copy, {sql_target()} AS target FROM documents, range(5) r(copy)")
def short_target(spark, sf):
    copies = ex.duplicate_corpus(documents(spark, sf).select("doc_id"), 5)
    return copies.withColumn("target", ex.short_target(125, 0.1, 7, F.col("copy"), F.col("doc_id")))


SENTENCES = SQL_COUNTS + "," + sql_ranked(WORDS) + f""",
cut_text AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS k FROM (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'), '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS l FROM documents)),
sent_words AS (SELECT doc_id, k, list_filter(string_split_regex(s, '{WS}+'), lambda t: t <> '') AS w FROM cut_text),
sents AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS i, len(w) AS size,
         sum(len(w)) OVER (PARTITION BY doc_id ORDER BY k) AS upto
  FROM sent_words WHERE len(w) > 0),
doc_ids AS MATERIALIZED (SELECT doc_id, list(coalesce(id + 5, 1) ORDER BY line_no, pos) AS l FROM tokens LEFT JOIN ranked USING (token) GROUP BY doc_id),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS doc_no FROM sents GROUP BY doc_id),
aimed AS (SELECT doc_id, n, copy, {sql_target()} AS target FROM sizes, range(2) r(copy)),
ends AS (SELECT a.doc_id, a.copy, a.target, a.n, s.i AS start, coalesce(min(e.i) + 1, a.n) AS "end"
  FROM aimed a JOIN sents s ON s.doc_id = a.doc_id
  LEFT JOIN sents e ON e.doc_id = s.doc_id AND e.i >= s.i AND e.upto >= s.upto - s.size + a.target
  GROUP BY a.doc_id, a.copy, a.target, a.n, s.i),
steps AS MATERIALIZED (SELECT *, start + 1 + CASE WHEN "end" - start < 2 THEN 0 ELSE {sql_draw('7/cut', 'copy', 'doc_id', 'start')} % ("end" - start - 1) END AS cut,
  ("end" - start = 1 OR {sql_draw('7/next', 'copy', 'doc_id', 'start')} < 576460752303423488)::BIGINT AS is_random FROM ends),
walk AS (
  SELECT * FROM steps WHERE start = 0
  UNION ALL
  SELECT s.* FROM walk w JOIN steps s ON s.doc_id = w.doc_id AND s.copy = w.copy
    AND s.start = CASE WHEN w.is_random = 1 THEN w.cut ELSE w."end" END)
"""


def recursive(ctes: str) -> str:
    return with_(ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@catalog.add(recursive(SENTENCES) + 'SELECT doc_id, copy, target, start, cut, "end", is_random FROM walk')
def pack_segments(spark, sf):
    docs = ex.duplicate_corpus(sentence_docs(spark, sf).select("doc_id", "sizes"), 2)
    return ex.pack_segments(docs, 125).drop("chunk_no")


TRIES = "[" + ", ".join(
    sql_draw(f"7/document/{i}", "copy", "doc_id", "chunk_no") + " % (SELECT count(*) FROM sizes)" for i in range(10)
) + "]"


@catalog.add(recursive(SENTENCES) + f""",
chunks AS MATERIALIZED (SELECT w.*, row_number() OVER (PARTITION BY w.doc_id, w.copy ORDER BY start) - 1 AS chunk_no, z.doc_no FROM walk w JOIN sizes z USING (doc_id)),
bounds AS MATERIALIZED (SELECT c.*, s.upto - s.size AS a0, m.upto AS a1, e.upto AS b1 FROM chunks c
  JOIN sents s ON s.doc_id = c.doc_id AND s.i = c.start JOIN sents m ON m.doc_id = c.doc_id AND m.i = c.cut - 1
  JOIN sents e ON e.doc_id = c.doc_id AND e.i = c."end" - 1),
tried AS (SELECT *, {TRIES} AS t FROM bounds),
other AS (SELECT x.*, o.doc_id AS o_id, o.n AS o_n,
  {sql_draw('7/start', 'copy', 'x.doc_id', 'chunk_no')} % o.n AS b_start
  FROM (SELECT *, coalesce(list_filter(t, lambda d: d <> doc_no)[1], t[10]) AS o_no FROM tried WHERE is_random = 1) x JOIN sizes o ON o.doc_no = x.o_no),
foreign_ AS MATERIALIZED (SELECT x.doc_id, x.copy, x.chunk_no, x.o_id, f.upto - f.size AS f0,
    coalesce(min(g.upto), max(z.upto)) AS f1
  FROM other x JOIN sents f ON f.doc_id = x.o_id AND f.i = x.b_start
  JOIN (SELECT doc_id, max(upto) AS upto FROM sents GROUP BY doc_id) z ON z.doc_id = x.o_id
  LEFT JOIN sents g ON g.doc_id = x.o_id AND g.i >= f.i AND g.upto >= f.upto - f.size + (x.target - (x.a1 - x.a0))
  GROUP BY x.doc_id, x.copy, x.chunk_no, x.o_id, f.upto, f.size)
SELECT b.doc_id, b.copy, b.chunk_no, b.is_random, {text_of('own.l[a0 + 1:a1]')} AS tokens_a,
       CASE WHEN b.is_random = 1 THEN {text_of('oth.l[f0 + 1:f1]')} ELSE {text_of('own.l[a1 + 1:b1]')} END AS tokens_b
FROM bounds b JOIN doc_ids own ON own.doc_id = b.doc_id
LEFT JOIN foreign_ f ON f.doc_id = b.doc_id AND f.copy = b.copy AND f.chunk_no = b.chunk_no LEFT JOIN doc_ids oth ON oth.doc_id = f.o_id
""")
def next_sentence_pairs(spark, sf):
    pairs = ex.next_sentence_pairs(sentence_docs(spark, sf), 125, copies=2)
    return pairs.withColumn("tokens_a", joined("tokens_a")).withColumn("tokens_b", joined("tokens_b"))


HALVES = CODED + """,
doc_ids AS (SELECT doc_id, list(id ORDER BY line_no, pos) AS l FROM coded GROUP BY doc_id),
halves AS (SELECT doc_id, l[1:len(l) * 2 // 3] AS a, l[len(l) * 2 // 3 + 1:] AS b FROM doc_ids)"""


def halves(spark, sf):
    """Each document as a pair: two thirds of it and the rest."""
    cut = F.floor(F.size("ids") * 2 / 3).cast("int")
    return line_docs(spark, sf).select(
        "doc_id", F.slice("ids", F.lit(1), cut).alias("tokens_a"),
        F.slice("ids", cut + 1, F.size("ids") - cut).alias("tokens_b"),
    )


def sql_drops(name: str, dropped: str) -> str:
    bits = f"least(32, {dropped} - w * 32)"
    return (
        f"coalesce(list_sum(list_transform(range(({dropped} + 31) // 32), lambda w: "
        f"bit_count({sql_draw('7/' + name, 'doc_id', 'w')} & ((1::BIGINT << {bits}) - 1)))), 0)::BIGINT"
    )


TRUNCATED = HALVES + f""",
planned AS (SELECT *, len(a) AS la, len(b) AS lb,
  CASE WHEN len(a) + len(b) <= 125 THEN len(a) WHEN len(b) <= 62 THEN 125 - len(b) WHEN len(a) <= 62 THEN len(a) ELSE 63 END AS na,
  CASE WHEN len(a) + len(b) <= 125 THEN len(b) WHEN len(b) <= 62 THEN len(b) WHEN len(a) <= 62 THEN 125 - len(a) ELSE 62 END AS nb FROM halves),
fronts AS (SELECT *, {sql_drops('front_a', '(la - na)')} AS fa, {sql_drops('front_b', '(lb - nb)')} AS fb FROM planned),
cut_pairs AS (SELECT doc_id, a[fa + 1:fa + na] AS a, b[fb + 1:fb + nb] AS b FROM fronts)"""


@catalog.add(with_(TRUNCATED) + f"SELECT doc_id, {text_of('a')} AS tokens_a, {text_of('b')} AS tokens_b FROM cut_pairs")
def truncate_pair(spark, sf):
    cut = ex.truncate_pair(halves(spark, sf), 125, 7, ["doc_id"])
    return cut.select("doc_id", joined("tokens_a").alias("tokens_a"), joined("tokens_b").alias("tokens_b"))


@catalog.add(with_(TRUNCATED) + f"""
SELECT doc_id, {text_of('list_concat(list_concat(list_concat([2], a), list_concat([3], b)), [3])')} AS ids,
       {text_of(f"list_concat({fill('0', 'len(a) + 2')}, {fill('1', 'len(b) + 1')})")} AS segments FROM cut_pairs
""")
def assemble_pair(spark, sf):
    cut = ex.truncate_pair(halves(spark, sf), 125, 7, ["doc_id"])
    whole = cut.select("doc_id", ex.assemble_pair(F.col("tokens_a"), F.col("tokens_b")).alias("p"))
    return whole.select("doc_id", joined("p.ids").alias("ids"), joined("p.segments").alias("segments"))


MASKED = CODED + f""",
seq AS (SELECT doc_id, line_no, list_concat(list_concat([2], l[1:126]), [3]) AS s FROM ids),
places AS (SELECT doc_id, line_no, len(s) AS n, unnest(s) AS id, generate_subscripts(s, 1) - 1 AS i FROM seq),
ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY
    md5(concat_ws('|', '7/place', CAST(doc_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(i AS VARCHAR)))) AS rn
  FROM places WHERE id NOT IN (2, 3)),
chosen AS (SELECT * FROM ordered WHERE rn <= least(20, greatest(1, round_even(n * 0.15::DOUBLE, 0)))),
masked AS (SELECT p.doc_id, p.line_no, p.i, p.n, p.id, c.rn IS NOT NULL AS hit, CASE WHEN c.rn IS NULL THEN p.id
    WHEN {sql_uniform('7/mask', 'p.doc_id', 'p.line_no', 'p.i')} < 0.8 THEN 4
    WHEN {sql_uniform('7/keep', 'p.doc_id', 'p.line_no', 'p.i')} < 0.5 THEN p.id
    ELSE {sql_draw('7/word', 'p.doc_id', 'p.line_no', 'p.i')} % {VOCAB} END AS m
  FROM places p LEFT JOIN chosen c ON c.doc_id = p.doc_id AND c.line_no = p.line_no AND c.i = p.i),
example AS (SELECT doc_id, line_no, list(m ORDER BY i) AS masked, list(i ORDER BY i) FILTER (hit) AS positions,
    list(id ORDER BY i) FILTER (hit) AS labels FROM masked GROUP BY ALL)"""


def framed_lines(spark, sf):
    ids = F.concat(ex.lits(ex.CLS), F.slice("ids", 1, 126), ex.lits(ex.SEP))
    return coded_lines(spark, sf).select(*LINE_KEY, ids.alias("ids"))


@catalog.add(with_(MASKED) + f"""
SELECT doc_id, line_no, {text_of('masked')} AS masked, {text_of('positions')} AS positions, {text_of('labels')} AS labels FROM example
""")
def mask_tokens(spark, sf):
    masked = ex.mask_tokens(framed_lines(spark, sf), VOCAB, LINE_KEY)
    return masked.select(*LINE_KEY, *[joined(c).alias(c) for c in ("masked", "positions", "labels")])


@catalog.add(with_(MASKED) + f"""
SELECT doc_id, line_no, {text_of(f"list_concat(masked, {fill('0', '128 - len(masked)')})")} AS input_ids,
  len(masked) AS ones, {text_of(f"list_concat(positions, {fill('0', '20 - len(positions)')})")} AS masked_lm_positions,
  {text_of(f"list_concat(labels, {fill('0', '20 - len(labels)')})")} AS masked_lm_ids, len(positions)::DOUBLE AS weight, 0::BIGINT AS next_sentence_label
FROM example
""")
def pad_masked_example(spark, sf):
    lines = framed_lines(spark, sf)
    masked = ex.mask_tokens(lines, VOCAB, LINE_KEY).withColumn("segments", ex.zeros(F.size("ids"))).withColumn(
        "is_random", F.lit(0).cast("bigint")
    )
    padded = ex.pad_masked_example(masked, 128)
    return padded.select(
        *LINE_KEY, joined("input_ids").alias("input_ids"),
        F.aggregate("input_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("ones"),
        joined("masked_lm_positions").alias("masked_lm_positions"), joined("masked_lm_ids").alias("masked_lm_ids"),
        F.aggregate("masked_lm_weights", F.lit(0.0), lambda a, x: a + x).alias("weight"), "next_sentence_label",
    )


@catalog.add(None)
def masked_pair_examples(spark, sf):
    built = ex.masked_pair_examples(sentence_docs(spark, sf), VOCAB, copies=2)
    return built.select(
        "doc_id", "copy", "chunk_no", joined("input_ids").alias("input_ids"),
        joined("segment_ids").alias("segment_ids"), joined("masked_lm_positions").alias("masked_lm_positions"),
        joined("masked_lm_ids").alias("masked_lm_ids"), "next_sentence_label",
    )


# ------------------------------------------------------------------ streams


def sql_stream(order: str, partition: str) -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return CODED + f""",
placed_lines AS (SELECT t.doc_id, t.line_no, d.source, {order} AS o,
    row_number() OVER ({part}ORDER BY {order}, d.source, t.doc_id, t.line_no) - 1 AS k
  FROM token_lines t JOIN documents d ON d.doc_id = t.doc_id),
last_lines AS (SELECT doc_id, max(line_no) AS line_no FROM placed_lines GROUP BY doc_id),
marks AS (SELECT c.doc_id, c.line_no, c.pos, c.id FROM coded c UNION ALL SELECT doc_id, line_no, 1000000000, 7 FROM last_lines),
stream AS (SELECT p.source, m.doc_id, m.id, p.k, p.k % 2 = 0 AS flag,
    row_number() OVER ({part}ORDER BY p.o, p.source, m.doc_id, m.line_no, m.pos) - 1 AS loc
  FROM marks m JOIN placed_lines p ON p.doc_id = m.doc_id AND p.line_no = m.line_no)"""


def long_stream(stream):
    parts = F.arrays_zip("ids", "flags")
    long = stream.select("source", "offset", F.posexplode(parts).alias("i", "p"))
    return long.select("source", (F.col("offset") + F.col("i")).alias("loc"), F.col("p.ids").alias("id"), F.col("p.flags").alias("flag"))


@catalog.add(with_(sql_stream("''", "d.source").replace("PARTITION BY d.source ORDER BY p.o", "PARTITION BY p.source ORDER BY p.o"))
             + "SELECT source, loc, id, flag FROM stream")
def sentence_stream(spark, sf):
    return long_stream(streams.sentence_stream(line_docs(spark, sf), "source", "doc_id"))


PERMUTED = sql_stream("md5(concat_ws('|', '100', d.source))", "")


@catalog.add(with_(PERMUTED) + "SELECT source, loc, id, flag FROM stream")
def permute_shards(spark, sf):
    return long_stream(permuted_stream(spark, sf))


def permuted_stream(spark, sf):
    return streams.sentence_stream(line_docs(spark, sf), "source", "doc_id", seed=100)


def long_blocks(blocks, block):
    long = blocks.select("row", "block", F.posexplode(F.arrays_zip("ids", "starts", "ends")).alias("i", "p"))
    return long.select(
        "row", (F.col("block") * block + F.col("i")).alias("col"), F.col("p.ids").alias("id"),
        F.col("p.starts").alias("start"), F.col("p.ends").alias("end"),
    )


BATCH = PERMUTED + """,
size_ AS (SELECT count(*) // {rows} AS steps FROM stream),
grid AS (SELECT loc // steps AS "row", loc % steps AS col, id, k, steps FROM stream, size_ WHERE loc < {rows} * steps),
runs AS (SELECT "row", col, id, steps, min(col) OVER (PARTITION BY "row", k) AS start, max(col) OVER (PARTITION BY "row", k) + 1 AS "end" FROM grid)"""


@catalog.add(with_(BATCH.replace("{rows}", "16")) + 'SELECT "row", col, id, start, "end" FROM runs')
def batchify(spark, sf):
    blocks, _ = streams.batchify(permuted_stream(spark, sf), 16, 1024)
    return long_blocks(blocks, 1024)


@catalog.add(with_(BATCH.replace("{rows}", "8")) + """
SELECT "row", col, id, start, "end" FROM runs
UNION ALL SELECT "row" + 8, steps - 1 - col, id, steps - "end", steps - start FROM runs
""")
def batchify_bidirectional(spark, sf):
    blocks, _ = streams.batchify(permuted_stream(spark, sf), 16, 1024, bidirectional=True)
    return long_blocks(blocks, 1024)


def windows(spark, sf):
    blocks, steps = streams.batchify(permuted_stream(spark, sf), 16, 2048)
    return streams.segment_pair_windows(blocks, steps, 256, 128, 2048, 5)


@catalog.add(None)
def segment_pair_windows(spark, sf):
    parts = ("inp", "target", "a", "a_target", "b", "b_target")
    return windows(spark, sf).select("row", "window", "label", *[joined(c).alias(c) for c in parts])


@catalog.add(None)
def seq_features_joint(spark, sf):
    whole = streams.seq_features_joint(windows(spark, sf))
    return whole.select("row", "window", "label", *[joined(c).alias(c) for c in ("input", "target", "seg_id")])


REACH = [sum(1.0 / k for k in range(1, n + 1)) for n in range(1, streams.MAX_GRAM + 1)]
LONGER = " + ".join(f"(share >= {r!r}::DOUBLE)::INT" for r in REACH[:-1])
# Spans of a goal of 12 in contexts of six tokens per word, walked draw by draw.
SPANS = recursive(SQL_COUNTS + "," + sql_ranked(PIECE_WORDS) + sql_pieces("SELECT token FROM counts")) + f""",
laid AS (SELECT doc_id, line_no, unnest(string_split(pieces, ' ')) AS piece, pos, generate_subscripts(string_split(pieces, ' '), 1) AS part
  FROM tokens JOIN cut USING (token)),
placed AS (SELECT doc_id, line_no, CASE WHEN starts_with(piece, '##') THEN substr(piece, 3) ELSE '▁' || piece END AS piece,
  row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos, part) - 1 AS i FROM laid),
rows_ AS (SELECT doc_id, line_no, list(i ORDER BY i) FILTER (WHERE regexp_full_match(piece, '(?s)(?:[▁<].*|[!"#$%&()*+,\\-./:;?@\\[\\\\\\]^_`{{|}}~])')) AS b,
  count(*) AS size, least(12, count(*)) AS goal FROM placed GROUP BY ALL),
walk_spans AS (
  SELECT doc_id, line_no, coalesce(b, []) AS b, size, goal, 0::BIGINT AS t, 0::BIGINT AS here, 0::BIGINT AS cnt, NULL::BIGINT AS s_begin, NULL::BIGINT AS s_end FROM rows_
  UNION ALL
  SELECT doc_id, line_no, b, size, goal, t + 1, e + n * 6 - lft, cnt + e - first_, first_, e FROM (
    SELECT *, least(close_, first_ + goal - cnt) AS e FROM (
      SELECT *, b[word + 1] AS first_, b[word + n + 1] AS close_ FROM (
        SELECT *, len(list_filter(b, lambda x: x < here + lft)) AS word FROM (
          SELECT *, drawn % (n * 6) AS lft FROM (
            SELECT *, least(1 + {LONGER}, goal - cnt)::BIGINT AS n FROM (
              SELECT *, {sql_uniform('3/gram', 'doc_id', 'line_no', 't + 1')} * {REACH[-1]!r}::DOUBLE AS share,
                {sql_draw('3/left', 'doc_id', 'line_no', 't + 1')} AS drawn
              FROM walk_spans WHERE cnt < goal AND t < ceil(size / 7.0)))))) WHERE close_ IS NOT NULL)),
inside AS (SELECT p.doc_id, p.line_no, p.i, bool_or(w.s_begin <= p.i AND p.i < w.s_end) IS TRUE AS hit, max(w.cnt) AS cnt, max(w.goal) AS goal
  FROM placed p JOIN walk_spans w ON w.doc_id = p.doc_id AND w.line_no = p.line_no GROUP BY ALL),
filled AS (SELECT *, hit OR row_number() OVER (PARTITION BY doc_id, line_no, hit ORDER BY
    md5(concat_ws('|', '3/top', CAST(doc_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(i AS VARCHAR)))) <= goal - cnt AS chosen FROM inside)
SELECT doc_id, line_no, string_agg(chosen::INT::VARCHAR, ' ' ORDER BY i) AS mask, sum(chosen::INT)::BIGINT AS n FROM filled GROUP BY ALL
"""


@catalog.add(SPANS)
def span_mask(spark, sf):
    pieces = wordpiece(token_lines(spark, sf), piece_vocab(spark, sf)).filter(F.size("pieces") > 0)
    # Pieces in the marked notation: a word's first piece carries the mark, the others nothing.
    marked = F.transform("pieces", lambda p: F.when(p.startswith("##"), F.substring(p, 3, 1000)).otherwise(F.concat(F.lit("▁"), p)))
    starts = F.transform(marked, streams.is_start_piece)
    masked = streams.span_mask(pieces.select(*LINE_KEY, starts.alias("starts")), LINE_KEY, goal=12, seed=3)
    chosen = F.transform("is_masked", lambda m: m.cast("int"))
    return masked.select(
        *LINE_KEY, joined(chosen).alias("mask"),
        F.aggregate(chosen, F.lit(0), lambda a, x: a + x).cast("bigint").alias("n"),
    )


SHORT = CODED + f""",
short AS (SELECT doc_id, line_no, list_concat(list_concat(l[1:14], {fill('0', '14 - len(l[1:14])')}), [4, 3]) AS s FROM ids),
cells AS (SELECT doc_id, line_no, unnest(s) AS id, generate_subscripts(s, 1) - 1 AS i FROM short),
sigma AS (SELECT doc_id, line_no, j, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY
    md5(concat_ws('|', '6', CAST(doc_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(j AS VARCHAR)))) - 1 AS place
  FROM short, range(8) r(j)),
facts AS (SELECT c.*, sg.j + c.i // 8 * 8 AS ord, {sql_uniform('8', 'c.doc_id', 'c.line_no', 'c.i')} < 0.3 AS picked, id IN (4, 3) AS mark
  FROM cells c JOIN sigma sg ON sg.doc_id = c.doc_id AND sg.line_no = c.line_no AND sg.place = c.i % 8),
ranks AS (SELECT *, picked AND NOT mark AS predicted, picked OR mark AS hidden, CASE WHEN picked OR mark THEN ord ELSE -1 END AS rank FROM facts)"""


def short_sequences(spark, sf):
    """Lines cut or padded to sixteen ids that end in the marks, with drawn masks and orders."""
    head = F.slice("ids", 1, 14)
    ids = F.concat(head, ex.zeros(14 - F.size(head)), ex.lits(streams.SEP_ID, streams.CLS_ID))
    key = [F.col(k) for k in LINE_KEY]
    rows = coded_lines(spark, sf).select(*LINE_KEY, ids.alias("ids"))
    masked = F.transform("ids", lambda _, i: uniform(8, *key, i) < 0.3)
    targets = F.concat(F.slice("ids", 2, 15), ex.lits(streams.CLS_ID))
    placed = rows.select(
        *LINE_KEY, "ids", masked.alias("is_masked"), targets.alias("targets"),
        streams.permutation_order(16, 8, 6, *key).alias("ord"),
    )
    built = streams.permutation_mask(F.col("ids"), F.col("is_masked"), F.col("ord"), F.col("targets"))
    return placed.select(*LINE_KEY, "ids", built.alias("m"))


@catalog.add(with_(SHORT) + """
SELECT a.doc_id, a.line_no, a.i, string_agg(CASE WHEN b.hidden AND a.rank + CASE WHEN a.predicted THEN 0 ELSE 1 END <= b.rank
    THEN '1' ELSE '0' END, '' ORDER BY b.i) AS cells, max(a.predicted::INT)::BIGINT AS predicted, max(a.id) AS target
FROM ranks a JOIN ranks b ON a.doc_id = b.doc_id AND a.line_no = b.line_no GROUP BY ALL
""")
def permutation_mask(spark, sf):
    zipped = F.arrays_zip(F.col("m.perm_mask").alias("c"), F.col("m.target_mask").alias("p"), F.col("m.target").alias("t"))
    long = short_sequences(spark, sf).select(*LINE_KEY, F.posexplode(zipped).alias("i", "z"))
    return long.select(
        *LINE_KEY, F.col("i").cast("bigint").alias("i"), F.array_join("z.c", "").alias("cells"),
        F.col("z.p").cast("bigint").alias("predicted"), F.col("z.t").alias("target"),
    )


@catalog.add(with_(SHORT) + """,
hits AS (SELECT doc_id, line_no, i, id, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY i) - 1 AS n FROM ranks WHERE predicted),
slots AS (SELECT doc_id, line_no, n FROM short, range(16) r(n))
SELECT s.doc_id, s.line_no, s.n, coalesce(h.id, 0) AS target, (h.i IS NOT NULL)::BIGINT AS target_mask,
       CASE WHEN h.i IS NULL THEN repeat('0', 16) ELSE repeat('0', h.i) || '1' || repeat('0', 15 - h.i) END AS mapping
FROM slots s LEFT JOIN hits h ON h.doc_id = s.doc_id AND h.line_no = s.line_no AND h.n = s.n
""")
def target_mapping(spark, sf):
    rows = short_sequences(spark, sf)
    padded = streams.padded_targets(F.col("m.target"), F.col("m.target_mask"), 16)
    mapped = rows.select(*LINE_KEY, padded.alias("t"), streams.target_mapping(F.col("m.target_mask"), 16).alias("map"))
    zipped = F.arrays_zip(F.col("t.target").alias("t"), F.col("t.target_mask").alias("k"), F.col("map").alias("m"))
    long = mapped.select(*LINE_KEY, F.posexplode(zipped).alias("n", "z"))
    return long.select(
        *LINE_KEY, F.col("n").cast("bigint").alias("n"), F.col("z.t").alias("target"),
        F.col("z.k").alias("target_mask"), F.array_join("z.m", "").alias("mapping"),
    )


def sql_windows(start: int, stop: int, order: str) -> str:
    return with_(CODED) + f""",
numbered AS (SELECT doc_id, line_no, l, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS no FROM ids),
marked AS (SELECT no % 8 AS lane, no, list_concat(list_concat([{start}], {order}), [{stop}]) AS m FROM numbered),
pairs AS (SELECT lane, no, unnest(m[1:len(m) - 1]) AS input, unnest(m[2:len(m)]) AS target, unnest(range(len(m) - 1)) AS i FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY no, i) - 1 AS loc FROM pairs),
short AS (SELECT min(n) // 20 AS w FROM (SELECT lane, count(*) AS n FROM placed GROUP BY lane))
SELECT loc // 20 AS "window", lane, loc % 20 AS step, input, target FROM placed, short WHERE loc // 20 < w
"""


@catalog.add(sql_windows(1, 0, "l"))
def lm_windows(spark, sf):
    return streams.lm_windows(coded_lines(spark, sf), 8, 20, LINE_KEY)


@catalog.add(sql_windows(0, 1, "list_reverse(l)"))
def lm_windows_reverse(spark, sf):
    return streams.lm_windows(coded_lines(spark, sf), 8, 20, LINE_KEY, reverse=True)


# ------------------------------------------------------------------ shards


@catalog.add("""
SELECT doc_id, (row_number() OVER (ORDER BY md5(concat_ws('|', '4', CAST(doc_id AS VARCHAR)))) - 1) % 10 AS shard FROM documents
""")
def deal_examples(spark, sf):
    docs = documents(spark, sf).select("doc_id")
    return writers.deal_examples(docs, 10, digest(4, F.col("doc_id")))


MANIFEST = """
SELECT doc_id % 4 AS task, doc_id % 3 AS pass_id, string_agg(DISTINCT source, ' ' ORDER BY source) AS filenames,
       count(DISTINCT source) AS n_files, count(*) AS num_batch FROM documents GROUP BY ALL"""


def manifests(spark, sf):
    d = F.col("doc_id")
    batches = documents(spark, sf).select(
        (d % 4).alias("task"), (d % 3).alias("pass_id"), F.col("source").alias("filename"), F.lit(1).alias("num_batch")
    )
    return writers.shard_manifest(batches)


@catalog.add(f"SELECT task, pass_id, filenames, num_batch FROM ({MANIFEST})")
def shard_manifest(spark, sf):
    return manifests(spark, sf).withColumn("filenames", joined("filenames"))


@catalog.add(f"""
SELECT sum(floor(num_batch * (least(2, n_files) / n_files::DOUBLE)))::BIGINT AS num_batch, sum(least(2, n_files))::BIGINT AS num_files
FROM ({MANIFEST}) WHERE pass_id < 2
""")
def merge_manifests(spark, sf):
    return writers.merge_manifests(manifests(spark, sf), 2)
