"""Queries for text cleaning, sentence cutting, corpus rows and source parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.base import (
    SQL_LINES, SQL_TOKENS, WS, Catalog, documents, joined, lines, table, token_docs, with_,
)
from corpusloom.functions import hangul
from corpusloom.functions import text as tx
from corpusloom.functions.unicode import decode_utf8, normalize_text, strip_accents
from corpusloom.operators import corpus
from corpusloom.operators.tokenize import basic_tokens, tokenize_corpus
from corpusloom.sources import readers, writers

catalog = Catalog()



def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^{WS}+|{WS}+$', '', 'g')"


def words_sql(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{WS}+'), lambda t: t <> '')"


def control_sql(text: str) -> str:
    spaced = rf"regexp_replace({text}, '[\t\n\r\p{{Zs}}]', ' ', 'g')"
    return rf"regexp_replace({spaced}, '[\x{{0}}\x{{fffd}}\p{{Cc}}\p{{Cf}}]', '', 'g')"


STRIP = strip_sql("text")
PUNCT = r"[!-/:-@\[-`{-~\p{P}]"
CJK = (
    r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}"
    r"\x{2b740}-\x{2b81f}\x{2b820}-\x{2ceaf}\x{f900}-\x{faff}\x{2f800}-\x{2fa1f}]"
)
# Latin letters of the test corpus written as Hangul, so that the letter functions have work.
LATIN = "abcdefghijklmnopqrstuvwxyz"
SYLLABLES = "가나다라마바사아자차카타파하한글힣쌀꽃값닭뷁의왜윤넋"

# ------------------------------------------------------------------ lines and fields


@catalog.add(with_(SQL_LINES) + f"""
SELECT doc_id, line_no, {STRIP} AS text FROM lines WHERE {STRIP} <> ''
""")
def read_lines_and_drop_empty(spark, sf):
    return corpus.drop_empty(lines(spark, sf))


RECORD = "concat_ws('␞', text, source, CAST(doc_id AS VARCHAR))"


@catalog.add(f"""
SELECT string_split({RECORD}, '␞')[1] AS text, string_split({RECORD}, '␞')[2] AS tag,
       string_split({RECORD}, '␞')[3] AS doc_id
FROM documents WHERE len(string_split({RECORD}, '␞')) = 3
""")
def parse_record_fields(spark, sf):
    raw = documents(spark, sf).select(
        F.concat_ws(tx.RECORD_SEPARATOR, "text", "source", F.col("doc_id").cast("string")).alias("text")
    )
    return readers.parse_records(raw, ["text", "tag", "doc_id"])


@catalog.add(f"""
SELECT concat_ws('␞', CAST(doc_id AS VARCHAR), source, text) AS line FROM documents
""")
def record_lines(spark, sf):
    return documents(spark, sf).select(writers.record_line(["doc_id", "source", "text"]).alias("line"))


@catalog.add("""
SELECT doc_id, text FROM documents
WHERE len(string_split(concat_ws('␞', text, CASE WHEN doc_id % 3 > 0 THEN lang END), '␞')) = 2
""")
def drop_malformed_lines(spark, sf):
    # Every third record lacks its second field.
    raw = documents(spark, sf).select(
        "doc_id", F.col("text").alias("whole"),
        F.concat_ws(tx.RECORD_SEPARATOR, "text", F.when(F.col("doc_id") % 3 > 0, F.col("lang"))).alias("text"),
    )
    return corpus.drop_malformed(raw, 2).select("doc_id", F.col("whole").alias("text"))


@catalog.add(f"""
SELECT doc_id, CAST(CASE WHEN quality > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS label, text
FROM (SELECT d.doc_id, quality, {STRIP} AS text
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id) WHERE text <> ''
""")
def labelled_sentences(spark, sf):
    rows = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    return corpus.drop_empty(rows).select(
        "doc_id", corpus.binarize_label(F.col("quality")).cast("bigint").alias("label"), "text"
    )


@catalog.add("SELECT doc_id, 'MOVIE_' || source AS tag, text FROM documents")
def tagged_documents(spark, sf):
    return documents(spark, sf).select("doc_id", corpus.tag_document(F.col("source")).alias("tag"), "text")


@catalog.add(f"""
SELECT doc_id, i - 1 AS sent_no, s AS text FROM (
  SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, string_split(regexp_replace({STRIP}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS l
    FROM documents))
""")
def split_sentences(spark, sf):
    return corpus.explode_sentences(documents(spark, sf), "text", "doc_id")


@catalog.add(with_(SQL_LINES) + f""",
marked AS (SELECT doc_id, line_no, {STRIP} AS text, {STRIP} = '' AS blank FROM (
  SELECT doc_id, line_no, text FROM lines
  UNION ALL SELECT doc_id, max(line_no) + 1, '' FROM lines GROUP BY doc_id)),
grouped AS (SELECT *, sum(blank::INT) OVER (ORDER BY doc_id, line_no) AS g FROM marked)
SELECT dense_rank() OVER (ORDER BY g) - 1 AS doc_no,
       row_number() OVER (PARTITION BY g ORDER BY doc_id, line_no) - 1 AS sent_no, text
FROM grouped WHERE NOT blank
""")
def blankline_documents(spark, sf):
    # The lines of all documents as one stream, a blank line after each document.
    with_end = F.concat(F.split("text", "\n"), F.array(F.lit("")))
    stream = documents(spark, sf).select("doc_id", F.posexplode(with_end).alias("line_no", "text"))
    return readers.blankline_documents(stream, ["doc_id", "line_no"])


@catalog.add("""
SELECT doc_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark
UNION ALL SELECT page_id, html FROM pages
""")
def concat_corpora(spark, sf):
    bench = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    return readers.concat_corpora(documents(spark, sf).select("doc_id", "text"), bench, pages)


FILES = "(SELECT url AS path, row_number() OVER (ORDER BY url) - 1 AS n FROM (SELECT DISTINCT url FROM pages))"


@catalog.add(f"SELECT path, n % 7 AS worker FROM {FILES}")
def assign_files_strided(spark, sf):
    paths = table(spark, sf, "pages").select(F.col("url").alias("path")).distinct()
    return readers.assign_files(paths, 7)


@catalog.add(f"""
SELECT path, least(n // ((SELECT count(DISTINCT url) FROM pages) // 7), 6) AS worker FROM {FILES}
""")
def assign_files_contiguous(spark, sf):
    paths = table(spark, sf, "pages").select(F.col("url").alias("path")).distinct()
    return readers.assign_files(paths, 7, "contiguous")


@catalog.add("""
SELECT doc_id, source, lang FROM (SELECT *, md5(concat_ws('|', '11', CAST(doc_id AS VARCHAR))) AS h FROM documents)
ORDER BY h, doc_id LIMIT 30
""")
def sample_rows(spark, sf):
    return corpus.sample_rows(documents(spark, sf).select("doc_id", "source", "lang"), 30, 11, "doc_id")


@catalog.add(f"""
SELECT DISTINCT unnest(list_filter(string_split({STRIP}, ' '), lambda t: t <> '')) AS word
FROM documents WHERE NOT starts_with(text, '#')
""")
def evaluation_words(spark, sf):
    return corpus.eval_word_set(documents(spark, sf))


ANALOGY_LINES = """
analogy_lines AS (SELECT 'v' || a || ' v' || (a + 1) || ' v' || (a + 2) || CASE WHEN a % 3 = 0 THEN '' ELSE ' v' || (a + 3) END AS text
  FROM (SELECT vec_id AS a FROM embeddings)
  UNION ALL SELECT '# comment ' || label FROM embeddings)"""


@catalog.add(f"""
WITH {ANALOGY_LINES}
SELECT CASE WHEN len(w) = 4 THEN w[1] END AS a, CASE WHEN len(w) = 4 THEN w[2] END AS b, CASE WHEN len(w) = 4 THEN w[3] END AS c, w[len(w)] AS d
FROM (SELECT string_split(text, ' ') AS w, text FROM analogy_lines) WHERE NOT starts_with(text, '#')
""")
def parse_analogies(spark, sf):
    v, name = F.col("vec_id"), lambda c: F.concat(F.lit("v"), c.cast("string"))
    vectors = table(spark, sf, "embeddings")
    fourth = F.when(v % 3 != 0, name(v + 3))
    rows = vectors.select(F.concat_ws(" ", name(v), name(v + 1), name(v + 2), fourth).alias("text"))
    comments = vectors.select(F.concat(F.lit("# comment "), F.col("label").cast("string")).alias("text"))
    return readers.parse_analogies(rows.unionByName(comments))


@catalog.add("""
SELECT 'v' || vec_id AS key, list_sum(list_transform(embedding, lambda x: x::DOUBLE)).round(4) AS total,
       len(embedding) AS dim FROM embeddings
""")
def parse_vector_lines(spark, sf):
    # Vectors written as lines and read back.
    vectors = table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("key"), F.col("embedding").alias("vec")
    )
    back = readers.parse_vectors(vectors.select(writers.vector_line("key", "vec").alias("text")))
    return back.select(
        "key", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        F.size("vec").cast("bigint").alias("dim"),
    )


@catalog.add(r"""
SELECT doc_id, line_no, len(l) AS n, list_sum(l)::BIGINT AS total FROM (
  SELECT doc_id, line_no, list_transform(list_filter(string_split_regex(regexp_replace(text, '[^0-9]+', ' ', 'g'), ' +'),
         lambda t: t <> ''), lambda t: right(t, 9)::BIGINT) AS l
  FROM (""" + with_(SQL_LINES) + r""" SELECT * FROM lines)) WHERE len(l) > 0
""")
def parse_id_lines(spark, sf):
    # The digit runs of every line are its ids; nine digits at most fit an integer.
    digits = F.regexp_replace(F.regexp_replace("text", "[^0-9]+", " "), r"\d+(?=\d{9}\b)", "")
    ids = lines(spark, sf).select("doc_id", "line_no", readers.id_lists(digits).alias("ids"))
    return ids.filter(F.size("ids") > 0).select(
        "doc_id", "line_no", F.size("ids").cast("bigint").alias("n"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
    )


@catalog.add("""
WITH a AS (SELECT conv_id, turn, text FROM conversations)
SELECT c.conv_id, c.turn, 0::BIGINT AS line, c.text FROM a c
UNION ALL
SELECT c.conv_id, c.turn, 1::BIGINT AS line, c.text || ' ' || c.text FROM a c
UNION ALL
SELECT c.conv_id, c.turn, 2::BIGINT AS line, c.text || ' ' || CAST(c.turn AS VARCHAR) FROM a c
""")
def flatten_qa(spark, sf):
    # Each turn is the context of one paragraph whose question has two answers.
    turns = table(spark, sf, "conversations")
    answers = F.array(
        F.struct(F.col("text").alias("text")), F.struct(F.col("turn").cast("string").alias("text"))
    )
    qas = F.array(F.struct(F.col("text").alias("question"), answers.alias("answers")))
    paragraph = F.struct(F.col("text").alias("context"), qas.alias("qas"))
    nested = turns.select(
        "conv_id", "turn", F.array(F.struct(F.array(paragraph).alias("paragraphs"))).alias("data")
    )
    return readers.flatten_qa(nested, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.col("line").cast("bigint").alias("line"), "text"
    )


# ------------------------------------------------------------------ cleaning

WIKI_CLEAN = f"""
replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+$', ' '),
  '(ftp|https?)?://[!$-_a-z]+', ' ', 'g'),
  '''+|=+[^\\n]{{2,30}}=+|__TOC__|ファイル:[^\\n]+|:(en|de|it|fr|es|kr|zh|no|fi):|\\n', ' ', 'g'),
  '[{WS[1:-1]}\\x{{3099}}\\x{{309a}}]+', ' ', 'g'), ', )', '')
"""


@catalog.add(f"SELECT page_id, {WIKI_CLEAN} AS text FROM pages")
def wiki_clean(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.wiki_clean(F.col("html")).alias("text"))


@catalog.add(f"""
SELECT page_id, array_to_string(list_filter(list_transform(list_filter(string_split({WIKI_CLEAN}, ' '),
   lambda t: NOT starts_with(t, '_')),
   lambda t: regexp_replace(t, '\\*$|:$|^파일:.+|^;', '', 'g')), lambda t: t <> ''), ' ') AS tokens FROM pages
""")
def wiki_tokens(spark, sf):
    return table(spark, sf, "pages").select("page_id", joined(tx.wiki_tokens(F.col("html"))).alias("tokens"))



@catalog.add(f"SELECT doc_id, {control_sql('text')} AS text FROM documents")
def clean_control(spark, sf):
    return documents(spark, sf).select("doc_id", tx.clean_control(F.col("text")).alias("text"))


@catalog.add(f"""
SELECT doc_id, regexp_replace(translate(text, 'aeiou', '一㐀豈가あ'), '({CJK})', ' \\1 ', 'g') AS text FROM documents
""")
def space_cjk(spark, sf):
    # Vowels stand in for ideographs of three blocks, a syllable and a kana.
    return documents(spark, sf).select(
        "doc_id", tx.space_cjk(F.translate("text", "aeiou", "一㐀豈가あ")).alias("text")
    )


PARTED = f"regexp_replace(text, '({PUNCT})', ' \\1 ', 'g')"


@catalog.add(f"""
SELECT doc_id, array_to_string({words_sql(PARTED)}, ' ') AS tokens
FROM documents
""")
def split_punct(spark, sf):
    return token_docs(spark, sf).select("doc_id", joined(tx.split_punct(F.col("tokens"))).alias("tokens"))


@catalog.add("SELECT doc_id, strip_accents(lower(text)) AS text FROM documents")
def strip_accents_lower(spark, sf):
    return documents(spark, sf).select("doc_id", strip_accents(F.col("text")).alias("text"))


BASIC = "regexp_replace(strip_accents(lower(regexp_replace(" + control_sql("text") + f", '({CJK})', ' \\1 ', 'g'))), '({PUNCT})', ' \\1 ', 'g')"


@catalog.add(f"SELECT doc_id, array_to_string({words_sql(BASIC)}, ' ') AS tokens FROM documents")
def basic_tokens_lower(spark, sf):
    return documents(spark, sf).select("doc_id", joined(basic_tokens(F.col("text"))).alias("tokens"))


CASED = "regexp_replace(regexp_replace(" + control_sql("text") + f", '({CJK})', ' \\1 ', 'g'), '({PUNCT})', ' \\1 ', 'g')"


@catalog.add(f"SELECT doc_id, array_to_string({words_sql(CASED)}, ' ') AS tokens FROM documents")
def basic_tokens_cased(spark, sf):
    return documents(spark, sf).select("doc_id", joined(basic_tokens(F.col("text"), lower=False)).alias("tokens"))


@catalog.add(f"""
SELECT doc_id, replace(replace(strip_accents(array_to_string({words_sql('text')}, ' ')), '``', '"'), '''''', '"') AS text
FROM documents
""")
def normalize_text_plain(spark, sf):
    return documents(spark, sf).select("doc_id", normalize_text(F.col("text")).alias("text"))


@catalog.add(f"""
SELECT doc_id, lower(replace(replace(array_to_string({words_sql('text')}, ' '), '``', '"'), '''''', '"')) AS text
FROM documents
""")
def normalize_text_lower_keep_accents(spark, sf):
    return documents(spark, sf).select(
        "doc_id", normalize_text(F.col("text"), lower=True, keep_accents=True).alias("text")
    )


@catalog.add(r"""
SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(text, '(\p{Nd})', ' \1 ', 'g'), ' '),
       lambda t: t <> ''), ' ') AS tokens FROM documents
""")
def space_digits(spark, sf):
    return documents(spark, sf).select("doc_id", joined(tx.space_digits(F.col("text"))).alias("tokens"))


@catalog.add("""
WITH c AS (SELECT doc_id, unnest(l) AS ch, generate_subscripts(l, 1) AS i FROM (
  SELECT doc_id, string_split(text, '') AS l FROM documents)),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS g FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ch, g ORDER BY i) AS k FROM r)
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN
  (SELECT doc_id, string_agg(ch, '' ORDER BY i) AS text FROM n WHERE k <= 3 GROUP BY doc_id) t ON t.doc_id = d.doc_id
""")
def collapse_repeats(spark, sf):
    return documents(spark, sf).select("doc_id", tx.collapse_repeats(F.col("text")).alias("text"))


HANGUL = f"translate(text, '{LATIN}', '{SYLLABLES}')"
SPELL = f"""
array_to_string(list_transform(string_split({HANGUL}, ''), lambda c:
  CASE WHEN unicode(c) BETWEEN 44032 AND 55203 THEN
    substr('{hangul.INITIALS}', CAST((unicode(c) - 44032) // 588 + 1 AS BIGINT), 1)
    || substr('{hangul.MEDIALS}', CAST((unicode(c) - 44032) % 588 // 28 + 1 AS BIGINT), 1)
    || substr('{hangul.FINALS}', CAST((unicode(c) - 44032) % 28 + 1 AS BIGINT), 1)
  ELSE c END), '')"""


@catalog.add(f"SELECT doc_id, regexp_replace({SPELL}, '[ \\n]+', ' ', 'g') AS text FROM documents")
def to_jamo(spark, sf):
    return documents(spark, sf).select(
        "doc_id", hangul.to_jamo(F.translate("text", LATIN, SYLLABLES)).alias("text")
    )


@catalog.add(f"SELECT doc_id, regexp_replace({HANGUL}, '[ \\n]+', ' ', 'g') AS text FROM documents")
def from_jamo(spark, sf):
    spelled = hangul.to_jamo(F.translate("text", LATIN, SYLLABLES))
    return documents(spark, sf).select("doc_id", spelled.alias("s")).select(
        "doc_id", hangul.from_jamo(F.col("s")).alias("text")
    )


@catalog.add("SELECT doc_id, text FROM documents")
def decode_utf8_ignore(spark, sf):
    # A byte that is no UTF-8 follows every line; decoding leaves it out.
    broken = F.unhex(F.replace(F.hex(F.encode("text", "UTF-8")), F.lit("0A"), F.lit("0AFF")))
    raw = documents(spark, sf).select("doc_id", F.concat(broken, F.unhex(F.lit("C3"))).alias("raw"))
    return raw.select("doc_id", decode_utf8(F.col("raw")).alias("text"))


@catalog.add(f"""
SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(
  array_to_string({words_sql('text')}, ' '), '(\\p{{Nd}})', ' \\1 ', 'g'), ' '), lambda t: t <> ''), ' ') AS tokens
FROM documents
""")
def tokenize_corpus_whitespace(spark, sf):
    return tokenize_corpus(documents(spark, sf)).select("doc_id", "tokens")


@catalog.add(with_(SQL_TOKENS) + r""",
cut AS (SELECT doc_id, line_no, pos, unnest(CASE WHEN regexp_matches(token, '\p{Nd},$')
  THEN [regexp_replace(token, ',$', ''), ','] ELSE [token] END) AS piece FROM tokens)
SELECT piece, count(*) AS n FROM cut GROUP BY piece
""")
def cut_digit_comma(spark, sf):
    pieces = token_docs(spark, sf).select(F.explode(tx.cut_digit_comma(F.col("tokens"))).alias("piece"))
    return pieces.groupBy("piece").agg(F.count("*").alias("n"))


@catalog.add(with_(SQL_TOKENS) + """,
words AS (SELECT '<' || token || '>' AS w, count(*) AS n FROM tokens GROUP BY 1),
grams AS (SELECT substr(w, s, k) AS gram, n FROM words, range(3, 7) r(k), range(1, 400) q(s)
          WHERE s + k - 1 <= length(w))
SELECT gram, sum(n)::BIGINT AS n FROM grams GROUP BY gram
""")
def char_ngrams(spark, sf):
    words = token_docs(spark, sf).select(F.explode("tokens").alias("token")).groupBy("token").count()
    grams = words.select(F.explode(tx.char_ngrams(F.col("token"), 3, 6)).alias("gram"), "count")
    return grams.groupBy("gram").agg(F.sum("count").alias("n"))
