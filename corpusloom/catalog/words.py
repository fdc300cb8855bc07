"""Queries for tokenizers, vocabularies and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.base import (
    LEAST, WORDS, common_words, LINE_KEY, SQL_COUNTS, SQL_LINES, SQL_TOKENS, SQL_TOKEN_LINES, WS, Catalog, counts, documents,
    joined, lines, sql_ranked, stored_counts, token_docs, token_lines, with_,
)
from corpusloom.catalog.texts import CASED, words_sql
from corpusloom.operators import corpus, tokenize, vocabulary
from corpusloom.operators.pieces import learn_bpe
from corpusloom.plans.ranking import top_ranked
from corpusloom.sources import writers

catalog = Catalog()

SPECIALS = tokenize.SPECIALS


def special_rows(names: list[str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(names)) + ") s(id, token)"


# ------------------------------------------------------------------ counting and vocabularies


@catalog.add(with_(SQL_COUNTS) + "SELECT token, freq FROM counts")
def token_counts(spark, sf):
    return counts(spark, sf)


@catalog.add(with_(SQL_COUNTS) + "SELECT sum(freq)::BIGINT AS total FROM counts")
def token_total(spark, sf):
    return vocabulary.token_total(counts(spark, sf))


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(100000))
    + f" {special_rows(vocabulary.LM_MARKS)} UNION ALL SELECT id + 3, token FROM ranked"
)
def vocab_top_k(spark, sf):
    return vocabulary.vocab_top_k(counts(spark, sf))


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(102400), " kept AS (SELECT * FROM ranked WHERE freq >= 5)")
    + " SELECT id, token, freq FROM kept WHERE id < (SELECT count(*) - count(*) % 64 FROM kept)"
)
def vocab_sharded(spark, sf):
    # Shards of 64 words: the default of 4096 leaves nothing at the smallest scale.
    return vocabulary.vocab_sharded(counts(spark, sf), shard=64)


@catalog.add(with_(SQL_COUNTS) + "SELECT token, freq FROM counts WHERE freq >= 5")
def vocab_min_count(spark, sf):
    return vocabulary.vocab_min_count(counts(spark, sf))


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(50000))
    + """ SELECT id, token FROM ranked
    UNION ALL SELECT (SELECT count(*) FROM ranked) + k, token FROM (VALUES (0, '<UNK>'), (1, '<PAD>')) s(k, token)"""
)
def vocab_for_training(spark, sf):
    return vocabulary.vocab_for_training(counts(spark, sf))


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(30000)) + f" {special_rows(SPECIALS)} UNION ALL SELECT id + 5, token FROM ranked"
)
def vocab_with_specials(spark, sf):
    ranked = top_ranked(counts(spark, sf), 30_000, "freq", "token").select("id", "token")
    return writers.vocab_with_specials(ranked, SPECIALS)


@catalog.add(
    with_(SQL_TOKENS) + """SELECT token, count(*) AS missed FROM tokens
    WHERE token NOT IN (SELECT lower(token) FROM tokens) GROUP BY token"""
)
def oov_tokens(spark, sf):
    # The vector keys are the lower-cased words, so capitalised forms are looked up in vain.
    tokens = token_docs(spark, sf).select(F.explode("tokens").alias("token"))
    keys = counts(spark, sf).select(F.lower("token").alias("key")).distinct()
    return corpus.oov_tokens(tokens, keys)


# ------------------------------------------------------------------ encoding

RANKED = sql_ranked(WORDS, least=LEAST)
PER_LINE = """
SELECT l.doc_id, l.line_no, coalesce(string_agg(CAST({id} AS VARCHAR), ' ' ORDER BY pos), '') AS ids
FROM token_lines l LEFT JOIN coded c ON c.doc_id = l.doc_id AND c.line_no = l.line_no GROUP BY ALL"""


@catalog.add(
    with_(SQL_COUNTS, RANKED, " coded AS (SELECT doc_id, line_no, pos, id FROM tokens JOIN ranked USING (token))")
    + PER_LINE.format(id="id")
)
def in_vocab(spark, sf):
    coded = vocabulary.in_vocab(token_lines(spark, sf), common_words(spark, sf), LINE_KEY)
    return coded.select(*LINE_KEY, joined("ids").alias("ids"))


@catalog.add(
    with_(SQL_COUNTS, RANKED, " coded AS (SELECT doc_id, line_no, pos, id FROM tokens JOIN ranked USING (token))")
    + PER_LINE.format(id="id")
)
def in_vocab_shuffled(spark, sf):
    # The form for vocabularies too large to ship: hot words by broadcast, the rest by shuffle.
    from corpusloom.plans.lookup import lookup_array

    coded = lookup_array(
        token_lines(spark, sf), "tokens", "ids", common_words(spark, sf), "token", "id", LINE_KEY,
        weight="freq", max_rows=100,
    )
    return coded.select(*LINE_KEY, joined("ids").alias("ids"))


@catalog.add(
    with_(
        SQL_COUNTS, RANKED,
        f" coded AS (SELECT doc_id, line_no, pos, coalesce(id, {WORDS}) AS id FROM tokens LEFT JOIN ranked USING (token))",
    )
    + PER_LINE.format(id="id")
)
def encode_with_unknown(spark, sf):
    coded = vocabulary.encode_with_unknown(token_lines(spark, sf), common_words(spark, sf), LINE_KEY, WORDS)
    return coded.select(*LINE_KEY, joined("ids").alias("ids"))


@catalog.add(
    with_(SQL_COUNTS, RANKED, " coded AS (SELECT doc_id, line_no, pos, coalesce(id + 3, 2) AS id FROM tokens LEFT JOIN ranked USING (token))")
    + """ SELECT doc_id, line_no, '1 ' || string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) || ' 0' AS ids,
       '0 ' || string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos DESC) || ' 1' AS reversed
    FROM coded GROUP BY ALL"""
)
def encode_sentences(spark, sf):
    ranked = common_words(spark, sf).select("id", "token")
    vocab = writers.vocab_with_specials(ranked, vocabulary.LM_MARKS)
    coded = vocabulary.encode_with_unknown(token_lines(spark, sf), vocab, LINE_KEY, 2)
    ids = F.col("ids")
    return coded.select(
        *LINE_KEY, joined(vocabulary.wrap_sentence(ids, 1, 0)).alias("ids"),
        joined(vocabulary.wrap_sentence(ids, 1, 0, reverse=True)).alias("reversed"),
    )


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(100000000), " coded AS (SELECT doc_id, line_no, pos, id FROM tokens JOIN ranked USING (token))")
    + PER_LINE.format(id="id")
)
def encode_strict(spark, sf):
    every = vocabulary.vocab_ranked(counts(spark, sf))
    coded = vocabulary.encode_strict(token_lines(spark, sf), every, LINE_KEY)
    return coded.select(*LINE_KEY, joined("ids").alias("ids"))


@catalog.add(
    with_(SQL_COUNTS, RANKED)
    + """ SELECT l.doc_id, l.line_no, coalesce(string_agg(c.token, ' ' ORDER BY pos), '') AS text
    FROM token_lines l LEFT JOIN (SELECT t.* FROM tokens t JOIN ranked USING (token)) c
      ON c.doc_id = l.doc_id AND c.line_no = l.line_no GROUP BY ALL"""
)
def decode_ids(spark, sf):
    vocab = common_words(spark, sf)
    coded = vocabulary.in_vocab(token_lines(spark, sf), vocab, LINE_KEY)
    return vocabulary.decode_ids(coded, vocab, LINE_KEY).select(*LINE_KEY, "text")


@catalog.add(
    with_(SQL_COUNTS)
    + """, bytes AS (SELECT token, encode(token) AS b FROM counts),
    codes AS (SELECT token, list_transform(range(least(octet_length(b), 10)),
         lambda i: ('0x' || substr(hex(b), 2 * i + 1, 2))::BIGINT + 1) AS c FROM bytes)
    SELECT token, array_to_string(list_concat(list_concat([259], c), list_concat([260],
         list_transform(range(10 - len(c)), lambda i: 261))), ' ') AS ids FROM codes"""
)
def char_ids(spark, sf):
    return counts(spark, sf).select("token", joined(vocabulary.char_ids(F.col("token"), 12)).alias("ids"))


@catalog.add(
    with_(SQL_TOKEN_LINES) + "SELECT doc_id, line_no, len(tokens) + 2 AS n_rows, (len(tokens) + 2) * 12 AS n_codes FROM token_lines"
)
def encode_chars(spark, sf):
    cube = token_lines(spark, sf).select(*LINE_KEY, vocabulary.encode_chars(F.col("tokens"), 12).alias("c"))
    return cube.select(
        *LINE_KEY, F.size("c").cast("bigint").alias("n_rows"), F.size(F.flatten("c")).cast("bigint").alias("n_codes")
    )


@catalog.add(
    with_(SQL_COUNTS, RANKED, " coded AS (SELECT doc_id, line_no, pos, id FROM tokens JOIN ranked USING (token))",
          " ids AS (SELECT doc_id, line_no, list(id + 1 ORDER BY pos) AS l FROM coded GROUP BY ALL)")
    + """ SELECT doc_id, line_no, array_to_string(list_concat(l,
       list_transform(range(max(len(l)) OVER (PARTITION BY doc_id) - len(l)), lambda i: 0)), ' ') AS ids FROM ids"""
)
def shift_mask_ids(spark, sf):
    # A document is the batch: its lines are padded to the longest.
    coded = vocabulary.in_vocab(token_lines(spark, sf), common_words(spark, sf), LINE_KEY)
    coded = coded.filter(F.size("ids") > 0)
    longest = coded.groupBy("doc_id").agg(F.max(F.size("ids")).alias("longest"))
    return coded.join(longest, "doc_id").select(
        *LINE_KEY, joined(vocabulary.shift_mask_ids(F.col("ids"), F.col("longest"))).alias("ids")
    )


# ------------------------------------------------------------------ pieces, merges, scores, spacing

PIECE_WORDS = 10_000  # with endings and letters a vocabulary of about 32,000 pieces at most


def piece_vocab(spark, sf):
    """Frequent words as starting pieces, their endings and all letters as continuations."""
    top = top_ranked(counts(spark, sf), PIECE_WORDS, "freq", "token").select("token")
    chars = F.split("token", "")
    tails = top.filter(F.length("token") > 2).select(
        F.concat(F.lit("##"), F.expr("right(token, 2)")).alias("token")
    )
    letters = top.select(F.explode(chars).alias("c"))
    both = letters.select(F.explode(F.array("c", F.concat(F.lit("##"), "c"))).alias("token"))
    return top.union(tails).union(both).distinct()


def sql_pieces(words: str) -> str:
    """``cut``: the pieces of every token of ``words``, walked from left to right; needs ``ranked``."""
    return f""",
words AS ({words}),
vocab AS (
  SELECT token AS piece FROM ranked UNION SELECT '##' || right(token, 2) FROM ranked WHERE length(token) > 2
  UNION SELECT ch FROM (SELECT unnest(string_split(token, '')) AS ch FROM ranked)
  UNION SELECT '##' || ch FROM (SELECT unnest(string_split(token, '')) AS ch FROM ranked)),
cand AS (
  SELECT token, s, CASE WHEN s > 1 THEN '##' ELSE '' END || substr(token, s, k) AS piece, k
  FROM (SELECT token, unnest(range(1, length(token) + 1)) AS s FROM words WHERE length(token) <= 200) t, range(1, 60) r(k)
  WHERE s + k - 1 <= length(token)),
hit AS (SELECT c.token, c.s, max(c.k) AS k FROM cand c JOIN vocab v USING (piece) GROUP BY ALL),
walk AS (
  SELECT token, 1 AS s FROM words WHERE length(token) <= 200
  UNION ALL
  SELECT w.token, w.s + coalesce(h.k, 1) FROM walk w LEFT JOIN hit h ON h.token = w.token AND h.s = w.s
  WHERE w.s + coalesce(h.k, 1) <= length(w.token)),
cut AS (
  SELECT token, string_agg(CASE WHEN s > 1 THEN '##' ELSE '' END || substr(token, s, k), ' ' ORDER BY s) AS pieces
  FROM walk JOIN hit USING (token, s) GROUP BY token
  UNION ALL SELECT token, '[UNK]' FROM words WHERE length(token) > 200)"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@catalog.add(recursive(with_(SQL_COUNTS, sql_ranked(PIECE_WORDS)) + sql_pieces("SELECT token FROM counts") + """
SELECT l.doc_id, l.line_no, coalesce(string_agg(c.pieces, ' ' ORDER BY c.pos), '') AS pieces
FROM token_lines l LEFT JOIN (SELECT doc_id, line_no, pos, pieces FROM tokens JOIN cut USING (token)) c
  ON c.doc_id = l.doc_id AND c.line_no = l.line_no GROUP BY ALL
"""))
def wordpiece(spark, sf):
    pieces = tokenize.wordpiece(token_lines(spark, sf), piece_vocab(spark, sf))
    return pieces.select(*LINE_KEY, joined("pieces").alias("pieces"))


@catalog.add(recursive(
    with_(SQL_COUNTS, sql_ranked(PIECE_WORDS)) + sql_pieces("SELECT token FROM counts") + " SELECT token, pieces FROM cut"
))
def wordpiece_words(spark, sf):
    words = counts(spark, sf).select("token", F.array("token").alias("tokens"))
    pieces = tokenize.wordpiece(words, piece_vocab(spark, sf))
    return pieces.filter(F.size("pieces") > 0).select("token", joined("pieces").alias("pieces"))


@catalog.add(recursive(with_(SQL_COUNTS, sql_ranked(PIECE_WORDS), f"""
basic AS (SELECT doc_id, {words_sql(CASED)} AS l FROM documents),
basic_tokens AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM basic)""")
    + sql_pieces("SELECT DISTINCT token FROM basic_tokens") + """
SELECT b.doc_id, coalesce(string_agg(c.pieces, ' ' ORDER BY c.pos), '') AS pieces
FROM basic b LEFT JOIN (SELECT doc_id, pos, pieces FROM basic_tokens JOIN cut USING (token)) c ON c.doc_id = b.doc_id GROUP BY ALL
"""))
def full_tokenize(spark, sf):
    pieces = tokenize.full_tokenize(documents(spark, sf), piece_vocab(spark, sf))
    return pieces.select("doc_id", joined("pieces").alias("pieces"))


@catalog.add(with_(SQL_COUNTS) + """,
syms AS (SELECT freq, string_split('▁' || token, '') AS l FROM counts),
pairs AS (SELECT freq, l[i] AS "left", l[i + 1] AS "right" FROM
  (SELECT freq, l, unnest(range(1, len(l))) AS i FROM syms))
SELECT "left", "right", sum(freq)::BIGINT AS n FROM pairs GROUP BY ALL
""")
def merge_pair_counts(spark, sf):
    return tokenize.pair_counts(tokenize.symbol_words(counts(spark, sf)))


@catalog.add(None)
def learn_merges(spark, sf):
    return learn_bpe(stored_counts(spark, sf))


@catalog.add(None)
def trained_wordpiece(spark, sf):
    return tokenize.pieces_to_wordpiece(learn_bpe(stored_counts(spark, sf)))


@catalog.add(
    with_(SQL_COUNTS, sql_ranked(3000), """ trained AS (
      SELECT CASE WHEN id % 3 = 0 THEN '▁' || token ELSE token END AS piece, id + 4 AS rank FROM ranked
      UNION ALL SELECT * FROM (VALUES ('▁', 0), ('<unk>', 1), ('<s>', 2), ('</s>', 3)) s(piece, rank))""")
    + f""" {special_rows(SPECIALS)} UNION ALL
    SELECT row_number() OVER (ORDER BY rank) + 4, CASE WHEN starts_with(piece, '▁') THEN replace(piece, '▁', '') ELSE '##' || piece END
    FROM trained WHERE piece NOT IN ('▁', '<unk>', '<s>', '</s>')"""
)
def pieces_to_wordpiece(spark, sf):
    ranked = top_ranked(counts(spark, sf), 3000, "freq", "token")
    piece = F.when(F.col("id") % 3 == 0, F.concat(F.lit("▁"), "token")).otherwise(F.col("token"))
    own = spark.createDataFrame(list(enumerate(tokenize.TRAINER_PIECES)), "rank bigint, piece string")
    trained = ranked.select((F.col("id") + 4).alias("rank"), piece.alias("piece")).unionByName(own)
    return tokenize.pieces_to_wordpiece(trained)


SCORES = SQL_COUNTS + """,
prefixes AS (
  SELECT prefix, length(prefix) AS len, sum(freq)::BIGINT AS n
  FROM (SELECT substr(token, 1, k) AS prefix, freq FROM counts, range(1, 12) r(k) WHERE k <= length(token))
  GROUP BY ALL),
nexts AS (SELECT left(prefix, len - 1) AS parent, sum(n) AS s, sum(n * ln(n)) AS nlogn FROM prefixes WHERE len > 1 GROUP BY 1),
scored AS (
  SELECT p.prefix AS word, p.n, pow(p.n / f.n, 1.0 / (p.len - 1)) AS cohesion,
         greatest(coalesce(ln(s) - nlogn / s, 0), 0) AS entropy
  FROM prefixes p JOIN prefixes f ON f.prefix = left(p.prefix, 1) LEFT JOIN nexts x ON x.parent = p.prefix
  WHERE p.len BETWEEN 2 AND 10 AND p.n >= {min}),
scores AS (SELECT *, cohesion * exp(entropy) AS score FROM scored WHERE cohesion >= 0.05 AND entropy >= 0)"""


@catalog.add(with_(SCORES.replace("{min}", "10")) + """
SELECT word, n, round(cohesion, 6) AS cohesion, round(entropy, 5) AS entropy, round(score, 5) AS score FROM scores
""")
def word_scores(spark, sf):
    scores = tokenize.word_scores(stored_counts(spark, sf), min_frequency=10)
    return scores.select(
        "word", "n", F.round("cohesion", 6).alias("cohesion"), F.round("entropy", 5).alias("entropy"),
        F.round("score", 5).alias("score"),
    )


@catalog.add(with_(SCORES.replace("{min}", "10")) + """,
cand AS (SELECT c.token, c.freq, k, coalesce(s.score, 0) AS score
  FROM counts c, range(1, 400) r(k) LEFT JOIN scores s ON s.word = substr(c.token, 1, k) WHERE k <= length(c.token)),
best AS (SELECT token, freq, k, row_number() OVER (PARTITION BY token ORDER BY score DESC, k DESC) AS rn FROM cand)
SELECT token, freq, substr(token, 1, k) AS "left", substr(token, k + 1) AS "right" FROM best WHERE rn = 1
""")
def best_left_parts(spark, sf):
    c = stored_counts(spark, sf)
    return tokenize.best_left_parts(c, tokenize.word_scores(c, min_frequency=10))


@catalog.add(None)
def l_tokenize(spark, sf):
    c = stored_counts(spark, sf)
    parts = tokenize.l_tokenize(
        token_lines(spark, sf), c, tokenize.word_scores(c, min_frequency=10), LINE_KEY
    )
    return parts.select(*LINE_KEY, joined("parts").alias("parts"))


SPACING = SQL_LINES + f""",
squeezed AS (SELECT doc_id, line_no, array_to_string(list_filter(string_split_regex(text, '{WS}+'), lambda t: t <> ''), ' ') AS t FROM lines),
units AS (SELECT doc_id, line_no, regexp_extract_all(t, '[^ ] ?') AS u FROM squeezed WHERE t <> ''),
boundaries AS (
  SELECT doc_id, line_no, i, length(u[i]) > 1 AS spaced,
         CASE WHEN i > 1 THEN left(u[i - 1], 1) ELSE '' END || left(u[i], 1) || ' ' || left(u[i + 1], 1)
         || CASE WHEN i + 2 <= len(u) THEN left(u[i + 2], 1) ELSE '' END AS context
  FROM (SELECT *, unnest(range(1, len(u))) AS i FROM units)),
model AS (SELECT context, sum(spaced::INT)::BIGINT AS spaced, count(*) AS total FROM boundaries GROUP BY context)"""


@catalog.add(with_(SPACING) + "SELECT * FROM model")
def train_spacing(spark, sf):
    return tokenize.train_spacing(lines(spark, sf))


@catalog.add(with_(SPACING) + """,
told AS (SELECT b.doc_id, b.line_no, b.i, m.spaced / m.total >= 0.5 AS yes FROM boundaries b JOIN model m USING (context)),
chars AS (SELECT doc_id, line_no, unnest(u) AS unit, generate_subscripts(u, 1) AS i FROM units)
SELECT c.doc_id, c.line_no, trim(string_agg(left(unit, 1) || CASE WHEN coalesce(yes, false) THEN ' ' ELSE '' END, '' ORDER BY c.i)) AS corrected
FROM chars c LEFT JOIN told t ON t.doc_id = c.doc_id AND t.line_no = c.line_no AND t.i = c.i GROUP BY ALL
""")
def apply_spacing(spark, sf):
    rows = lines(spark, sf)
    return tokenize.apply_spacing(rows, tokenize.train_spacing(rows), LINE_KEY).select(*LINE_KEY, "corrected")
