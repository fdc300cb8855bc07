"""Readers for the corpus formats: lines, records, reviews, question answering, wiki, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import split_record, strip, whitespace_tokens, wiki_text, wiki_tokens
from corpusloom.plans.ranking import with_prefix_sums, with_row_number

REVIEW_SCHEMA = "review string, movie_id string"
QA_SCHEMA = (
    "data array<struct<paragraphs: array<struct<context: string, qas: array<struct<"
    "question: string, answers: array<struct<text: string>>>>>>>>"
)
WIKI_SCHEMA = "id long, ns long, title string, redirect string, revision struct<text: string>"
# Names with a meaning of their own in a language-model vocabulary file.
LM_SPECIALS = {"bos": "<S>", "eos": "</S>", "unk": "<UNK>"}
LM_IGNORED = "!!!MAXTERMID"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, stripped at both ends."""
    return spark.read.text(path).select(strip(F.col("value")).alias("text"))


# Columns that order the rows of ``read_ordered_lines``.
LINE_ORDER = ["file", "block", "place"]


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``file, block, place``, which put them in the order of the files.

    A file is read in splits. The split's start orders the splits, and inside one split the row
    counter of its task grows with the lines, so files of any size keep their order unread as a
    whole.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"),
    )


def read_labelled_tsv(spark: SparkSession, path: str, with_label: bool = True) -> DataFrame:
    """``id, sentence, label`` with a header line; rows without exactly three fields are left out."""
    lines = spark.read.csv(
        path, sep="\u0001", header=True, quote="", schema="value string", enforceSchema=True
    )
    fields = F.split(strip(F.col("value")), "\t")
    rows = lines.filter(F.size(fields) == 3).select(
        fields[0].alias("id"), fields[1].alias("text"), fields[2].cast("int").alias("label")
    )
    kept = rows.filter(F.length("text") > 0)
    return kept if with_label else kept.drop("label")


def read_review_json(spark: SparkSession, path: str) -> DataFrame:
    """Every file is an array of reviews; empty ones are dropped."""
    return clean_reviews(spark.read.schema(REVIEW_SCHEMA).json(path, multiLine=True))


def clean_reviews(rows: DataFrame) -> DataFrame:
    """``text, tag`` of reviews that are not empty."""
    return rows.select(strip(F.col("review")).alias("text"), F.col("movie_id").alias("tag")).filter(
        F.length("text") > 0
    )


def read_qa_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested question answering to text rows, see ``flatten_qa``."""
    return flatten_qa(spark.read.schema(QA_SCHEMA).json(path, multiLine=True))


def flatten_qa(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each context, followed by ``question answer`` for every answer, in document order.

    Columns in ``keep``, such as a file name, go along.
    """
    key = keep or []
    paragraphs = df.select(*key, F.posexplode("data").alias("article", "_a")).select(
        *key, "article", F.posexplode("_a.paragraphs").alias("paragraph", "_p")
    )
    answers = F.flatten(
        F.transform(
            "_p.qas",
            lambda qa: F.transform(
                qa["answers"], lambda a: F.concat_ws(" ", qa["question"], a["text"])
            ),
        )
    )
    texts = F.concat(F.array("_p.context"), answers)
    return paragraphs.select(*key, "article", "paragraph", F.posexplode(texts).alias("line", "text"))


def read_wiki_xml(spark: SparkSession, path: str, min_tokens: int = 50) -> DataFrame:
    """Articles of a MediaWiki dump (plain or compressed) as cleaned tokens, without markup.

    Articles of fewer than ``min_tokens`` tokens are left out, as are redirects and other namespaces.
    """
    pages = spark.read.format("xml").option("rowTag", "page").schema(WIKI_SCHEMA).load(path)
    articles = pages.filter((F.col("ns") == 0) & F.col("redirect").isNull())
    return articles.select(
        F.col("id").alias("doc_id"), "title", wiki_tokens(wiki_text(F.col("revision.text"))).alias("tokens")
    ).filter(F.size("tokens") >= min_tokens)


def blankline_documents(lines: DataFrame, order: list[str]) -> DataFrame:
    """Number documents that are separated by blank lines, without losing the sentence order.

    ``lines`` has ``text`` and the columns of ``order``, a total order over the table. Gives
    ``doc_no, sent_no, text`` without blank lines, documents counted from 0 without gaps.
    """
    stripped = lines.withColumn("text", strip(F.col("text"))).withColumn(
        "_blank", (F.length("text") == 0).cast("bigint")
    )
    sums = with_prefix_sums(
        stripped.withColumn("_full", 1 - F.col("_blank")),
        [F.col(c) for c in order],
        {"_blanks": "_blank", "_sents": "_full"},
    ).filter(F.col("_blank") == 0)
    # The blank lines so far name the document; its first sentence tells where numbering starts.
    heads = sums.groupBy("_blanks").agg(F.min("_sents").alias("_first"))
    numbered = with_prefix_sums(
        heads.withColumn("_one", F.lit(1).cast("bigint")), [F.col("_blanks")], {"doc_no": "_one"}
    ).select("_blanks", "_first", "doc_no")
    return sums.join(numbered, "_blanks").select(
        "doc_no", (F.col("_sents") - F.col("_first")).alias("sent_no"), "text"
    )


def read_blankline_docs(spark: SparkSession, path: str) -> DataFrame:
    """One sentence per line, blank lines between documents."""
    return blankline_documents(read_ordered_lines(spark, path), LINE_ORDER)


def parse_records(lines: DataFrame, names: list[str], column: str = "text") -> DataFrame:
    """Positional columns of record-separated lines; lines of another width are left out."""
    fields = split_record(F.col(column))
    return lines.filter(F.size(fields) == len(names)).select(
        *[fields[i].alias(name) for i, name in enumerate(names)]
    )


def read_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return parse_records(read_lines(spark, path), names)


def parse_vectors(lines: DataFrame, sep: str = " ", column: str = "text") -> DataFrame:
    """``key, vec`` from lines of a key and its numbers."""
    parts = F.split(strip(F.col(column)), sep)
    return lines.select(
        parts[0].alias("key"), F.slice(parts, 2, F.size(parts)).cast("array<double>").alias("vec")
    )


def read_vectors(spark: SparkSession, path: str, layout: str = "space") -> DataFrame:
    """Vectors in one of the layouts ``space``, ``header+space`` (a count line first) or ``tab``."""
    lines = spark.read.text(path).withColumnRenamed("value", "text")
    if layout == "header+space":
        lines = lines.filter(~F.col("text").rlike(r"^\d+ \d+\s*$"))
    return parse_vectors(lines, "\t" if layout == "tab" else " ")


def _numbered_tokens(lines: DataFrame) -> DataFrame:
    tokens = lines.withColumn("token", strip(F.col("text"))).drop("text")
    return with_row_number(tokens, [F.col(c) for c in LINE_ORDER], "id").select("token", "id")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``token, id`` where the id is the line number, running on over part files."""
    return _numbered_tokens(read_ordered_lines(spark, path))


def read_lm_vocab(spark: SparkSession, path: str, require_specials: bool = False) -> DataFrame:
    """As ``read_vocab`` without the reserved line; can insist on the sentence marks."""
    lines = read_ordered_lines(spark, path)
    vocab = _numbered_tokens(lines.filter(strip(F.col("text")) != LM_IGNORED))
    if require_specials:
        names = list(LM_SPECIALS.values())
        found = vocab.filter(F.col("token").isin(names)).select("token").distinct().count()
        if found < len(names):
            raise ValueError(f"the vocabulary must hold {', '.join(names)}")
    return vocab


def read_similarity_pairs(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, sep=sep, schema="word_1 string, word_2 string, score double")


def parse_analogies(lines: DataFrame, sep: str = " ", column: str = "text") -> DataFrame:
    """``a, b, c, d``: three words and the answer of each line.

    Tab lines of other width are skipped, and a ``#`` there is a word like any other. With spaces,
    comments and blank lines are skipped; a line of other width is still asked, with NULL for the three
    words and its last word as the answer.
    """
    text = strip(F.col(column))
    words = F.split(text, sep)
    whole = F.size(words) == 4
    if sep == "\t":
        return lines.filter(whole).select(*[F.get(words, i).alias(name) for i, name in enumerate("abcd")])
    kept = lines.filter((F.length(text) > 0) & ~F.col(column).startswith("#"))
    asked = [F.when(whole, F.get(words, i)).alias(name) for i, name in enumerate("abc")]
    return kept.select(*asked, F.element_at(words, -1).alias("d"))


def read_analogies(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return parse_analogies(spark.read.text(path).withColumnRenamed("value", "text"), sep)


def id_lists(col: Column) -> Column:
    """Whitespace-separated integers as an array."""
    return whitespace_tokens(col).cast("array<int>")


def read_id_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(id_lists(F.col("value")).alias("ids"))


def concat_corpora(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """All rows of all corpora, duplicates kept."""
    out = first
    for other in rest:
        out = out.unionByName(other)
    return out


def assign_files(paths: DataFrame, workers: int, mode: str = "strided") -> DataFrame:
    """``path, worker`` over the sorted paths.

    ``strided`` deals them out in turn. ``contiguous`` gives each worker an equal run and the
    last one the remainder.
    """
    numbered = with_row_number(paths.select("path"), [F.col("path")], "_no")
    if mode == "strided":
        worker = F.col("_no") % workers
    elif mode == "contiguous":
        each = paths.agg(F.floor(F.count("*") / workers)).scalar()
        run = F.floor(F.col("_no") / F.greatest(each, F.lit(1)))
        worker = F.when(each == 0, workers - 1).otherwise(F.least(run, F.lit(workers - 1)))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return numbered.select("path", worker.cast("bigint").alias("worker"))
