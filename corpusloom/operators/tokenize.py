"""Tokenizers: whitespace and punctuation, word pieces, learned merges, word scores, spacing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as tx
from corpusloom.functions.unicode import strip_accents
from corpusloom.plans.lookup import MAX_BROADCAST_ROWS, lookup_array, lookup_rows, map_blocks, map_elements, small_table
from corpusloom.plans.ranking import with_row_number
from corpusloom.plans.unnest import unnest
from corpusloom.session import materialize
from corpusloom.sources.writers import vocab_with_specials

UNKNOWN = "[UNK]"
MAX_WORD_CHARS = 200
BYTES_AT_ONCE = 1 << 21
# Special tokens of a word-piece vocabulary, and pieces the trainer adds itself.
SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
TRAINER_PIECES = ["▁", "<unk>", "<s>", "</s>"]
SPACE_MARK = "▁"


def basic_tokens(col: Column, lower: bool = True) -> Column:
    """Clean, part ideographs, lower-case and strip accents if asked, part punctuation."""
    cleaned = tx.space_cjk(tx.clean_control(col))
    if lower:
        cleaned = strip_accents(cleaned)
    return tx.whitespace_tokens(tx.space_punct(cleaned))


def tokenize_corpus(
    df: DataFrame,
    tokenizer: Callable[[Column], Column] = tx.whitespace_tokens,
    column: str = "text",
    out: str = "tokens",
) -> DataFrame:
    """Apply a tokenizer (text column to array column), then part digits, and join by spaces."""
    joined = F.array_join(tokenizer(F.col(column)), " ")
    return df.withColumn(out, F.array_join(tx.space_digits(joined), " "))


def greedy_pieces(word: str, vocab: set[str], longest: int) -> list[str]:
    """Longest match from the left; a character that starts no piece is passed over."""
    if len(word) > MAX_WORD_CHARS:
        return [UNKNOWN]
    pieces, at = [], 0
    while at < len(word):
        mark = "##" if at else ""
        for end in range(min(len(word), at + longest), at, -1):
            if mark + word[at:end] in vocab:
                pieces.append(mark + word[at:end])
                at = end
                break
        else:
            at += 1
    return pieces


def wordpiece(
    df: DataFrame, vocab: DataFrame, column: str = "tokens", out: str = "pieces", token: str = "token",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Cut the words of an array column into pieces of the vocabulary.

    A piece vocabulary is a fixed-size model; its size is checked before it is shipped. The
    corpus itself is then rewritten in place, without a shuffle. With a larger one the distinct words
    are cut by joins and looked up; both forms give the same pieces.
    """
    rows = small_table(vocab.select(token), max_rows)
    if rows is None:
        return _wordpiece_joined(df, vocab.select(F.col(token).alias("_piece")), column, out)
    shared = df.sparkSession.sparkContext.broadcast(rows)

    def make() -> Callable[[str], list[str]]:
        pieces = set(shared.value.column(0).to_pylist())
        longest = max((len(p) for p in pieces), default=1)

        @lru_cache(maxsize=200_000)
        def cut(word: str) -> list[str]:
            return [] if word is None else greedy_pieces(word, pieces, longest)

        return cut

    return map_elements(df, column, out, T.StringType(), make, nested=True)


def _wordpiece_joined(df: DataFrame, vocab: DataFrame, column: str, out: str) -> DataFrame:
    """The longest piece at every place of a word by a join, then a walk over the word's places."""
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    counted = unnest(numbered, column, value="_word").groupBy("_word").agg(F.count("*").alias("_n"))
    words = materialize(counted, "words")
    short = words.filter(F.length("_word").between(1, MAX_WORD_CHARS)).select("_word")
    longest = vocab.agg(F.coalesce(F.max(F.length("_piece")), F.lit(0))).scalar()
    places = short.select("_word", longest.alias("_most"), F.explode(F.sequence(F.lit(1), F.length("_word"))).alias("_s"))
    most = F.least(F.length("_word") - F.col("_s") + 1, F.greatest(F.col("_most"), F.lit(1)))
    spans = places.select("_word", "_s", F.explode(F.sequence(F.lit(1), most)).alias("_k"))
    mark = F.when(F.col("_s") > 1, "##").otherwise("")
    spans = spans.withColumn("_piece", F.concat(mark, F.substr("_word", F.col("_s"), F.col("_k"))))
    hits = spans.join(vocab.distinct(), "_piece").groupBy("_word", "_s").agg(F.max(F.struct("_k", "_piece")).alias("_h"))
    steps = hits.groupBy("_word").agg(F.map_from_entries(F.collect_list(F.struct("_s", "_h"))).alias("_steps"))

    def step(state: Column, at: Column) -> Column:
        found = F.col("_steps")[at]
        here = state["at"] == at
        return (
            F.when(here & found.isNotNull(), F.struct((at + found["_k"]).alias("at"), F.concat(state["p"], F.array(found["_piece"])).alias("p")))
            .when(here, F.struct((at + 1).alias("at"), state["p"].alias("p"))).otherwise(state)
        )

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("p"))
    walked = F.aggregate(F.sequence(F.lit(1), F.length("_word")), start, step)["p"]
    cut = steps.select("_word", walked.alias("_pieces"))
    over = words.filter(F.length("_word") > MAX_WORD_CHARS).select("_word", F.array(F.lit(UNKNOWN)).alias("_pieces"))
    table = materialize(cut.unionByName(over).join(words, "_word"), "pieces")
    found = lookup_array(numbered, column, out, table, "_word", "_pieces", ["_row"], weight="_n", nested=True)
    return found.drop("_row")


def full_tokenize(
    df: DataFrame, vocab: DataFrame, column: str = "text", out: str = "pieces", lower: bool = False
) -> DataFrame:
    """Basic tokens, then word pieces."""
    words = df.withColumn("_words", basic_tokens(F.col(column), lower))
    return wordpiece(words, vocab, "_words", out).drop("_words")


# ---------------------------------------------------------------- learned merges


def symbol_words(word_counts: DataFrame) -> DataFrame:
    """``symbols, freq`` per word: its characters between spaces, led by the space mark."""
    chars = F.split(F.concat(F.lit(SPACE_MARK), "token"), "")
    joined = F.concat(F.lit(" "), F.array_join(chars, " "), F.lit(" "))
    return word_counts.select(joined.alias("symbols"), "freq")


def pair_counts(words: DataFrame) -> DataFrame:
    """``left, right, n``: how often two symbols stand side by side, weighted by word count."""
    symbols = F.split(F.trim(F.col("symbols")), " ")
    pairs = F.arrays_zip(
        F.slice(symbols, 1, F.size(symbols) - 1).alias("left"),
        F.slice(symbols, 2, F.size(symbols)).alias("right"),
    )
    cells = words.filter(F.size(symbols) > 1).select(F.explode(pairs).alias("p"), "freq")
    return cells.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(
        F.sum("freq").cast("bigint").alias("n")
    )


def pieces_to_wordpiece(pieces: DataFrame, piece: str = "piece", rank: str = "rank") -> DataFrame:
    """``token, id``: five specials, then trained pieces in continuation notation.

    ``rank`` orders the pieces; ids count them without gaps.
    """
    kept = pieces.filter((F.length(piece) > 0) & ~F.col(piece).isin(TRAINER_PIECES))
    starts = F.col(piece).startswith(SPACE_MARK)
    token = F.when(starts, F.replace(F.col(piece), F.lit(SPACE_MARK), F.lit(""))).otherwise(
        F.concat(F.lit("##"), piece)
    )
    named = kept.select(token.alias("token"), F.col(rank).alias("_rank"))
    numbered = with_row_number(named, [F.col("_rank")], "id")
    return vocab_with_specials(numbered.select("id", "token"), SPECIALS)


# ---------------------------------------------------------------- word scores


def prefix_counts(word_counts: DataFrame, max_length: int = 10) -> DataFrame:
    """``prefix, len, n``: how many tokens start with each left part, up to one character more."""
    lengths = F.sequence(F.lit(1), F.least(F.length("token"), F.lit(max_length + 1)))
    prefixes = F.transform(lengths, lambda k: F.struct(F.left("token", k).alias("prefix"), k.alias("len")))
    rows = word_counts.filter(F.length("token") > 0).select(F.explode(prefixes).alias("p"), "freq")
    return rows.groupBy("p.prefix", "p.len").agg(F.sum("freq").cast("bigint").alias("n"))


def word_scores(
    word_counts: DataFrame,
    min_frequency: int = 100,
    min_cohesion: float = 0.05,
    min_entropy: float = 0.0,
    max_length: int = 10,
) -> DataFrame:
    """``word, n, cohesion, entropy, score`` of left parts with at least two characters.

    Cohesion is (n(w) / n(first character))^(1/(len-1)), entropy that of the next character,
    and the score their product with the entropy as exponent.
    """
    counts = prefix_counts(word_counts, max_length)
    own = F.struct(F.col("prefix").alias("word"), F.col("n"), F.lit(0).cast("bigint").alias("s"), F.lit(0.0).alias("nlogn"))
    parent = F.struct(
        F.left("prefix", F.col("len") - 1).alias("word"), F.lit(0).cast("bigint").alias("n"),
        F.col("n").alias("s"), (F.col("n") * F.log("n")).alias("nlogn"),
    )
    # Each prefix reports to itself and to the prefix it extends: one grouping gives both the
    # count and the spread of the next characters, without joining the table to itself.
    merged = counts.select(F.inline(F.array(own, parent))).groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("s").alias("_s"), F.sum("nlogn").alias("_nlogn")
    )
    # A row per distinct first character of Unicode at most: small enough to ship.
    first = word_counts.filter(F.length("token") > 0).groupBy(F.left("token", F.lit(1)).alias("_first")).agg(
        F.sum("freq").alias("_first_n")
    )
    entropy = F.when(F.col("_s") > 0, F.log("_s") - F.col("_nlogn") / F.col("_s")).otherwise(0.0)
    length = F.length("word")
    scored = (
        merged.filter(length.between(2, max_length) & (F.col("n") >= min_frequency))
        .withColumn("_first", F.left("word", F.lit(1)))
        .join(F.broadcast(first), "_first")
        .select(
            "word", "n", F.pow(F.col("n") / F.col("_first_n"), 1.0 / (length - 1)).alias("cohesion"),
            F.greatest(entropy, F.lit(0.0)).alias("entropy"),
        )
    )
    kept = scored.filter((F.col("cohesion") >= min_cohesion) & (F.col("entropy") >= min_entropy))
    return kept.withColumn("score", F.col("cohesion") * F.exp("entropy"))


def best_left_parts(word_counts: DataFrame, scores: DataFrame) -> DataFrame:
    """``token, freq, left, right``: each word cut after its best-scoring left part.

    Without a scored part the whole word is the left part. Equal scores go to the longer part.
    """
    lengths = F.sequence(F.lit(1), F.length("token"))
    prefixes = F.transform(lengths, lambda k: F.left("token", k))
    long = word_counts.filter(F.length("token") > 0).select(
        "token", "freq", F.explode(prefixes).alias("_prefix")
    )
    found = lookup_rows(long, "_prefix", scores, "word", "score", weight="n")
    best = found.groupBy("token", "freq").agg(
        F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("s"), F.length("_prefix").alias("l"))).alias("b")
    )
    return best.select(
        "token", "freq",
        F.expr("left(token, b.l)").alias("left"),
        F.expr("substring(token, b.l + 1)").alias("right"),
    )


def l_tokenize(
    df: DataFrame, word_counts: DataFrame, scores: DataFrame, row_key: list[str],
    column: str = "tokens", out: str = "parts",
) -> DataFrame:
    """Replace every word of an array column by its left part and the rest."""
    cut = best_left_parts(word_counts, materialize(scores, "scores"))
    parts = F.array_remove(F.array("left", "right"), "")
    table = materialize(cut.select("token", "freq", parts.alias("parts")), "parts")
    return lookup_array(
        df, column, out, table, "token", "parts", row_key, default=None, weight="freq", nested=True
    )


# ---------------------------------------------------------------- spacing


def squeezed(col: Column) -> Column:
    """The tokens of a line with one space between them."""
    return F.array_join(tx.whitespace_tokens(col), " ")


class _Characters:
    """The characters but spaces of squeezed lines, and the contexts of the boundaries between them.

    A context is the two characters on the left of a boundary, a space and the two on the right, as far as the line goes.
    """

    def __init__(self, texts: pa.Array) -> None:
        joined = "\n".join(t or "" for t in texts.to_pylist())  # a squeezed line holds no line end
        codes = np.frombuffer((joined + "\n").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((codes != 32) & (codes != 10))
        self.known, places = np.unique(codes[at], return_inverse=True)
        self.places = places + 1  # 0 stands for no character
        self.owner = (np.cumsum(codes == 10) - (codes == 10))[at]
        self.spaced = codes[at + 1] == 32
        # Boundaries go by the character before them.
        self.inner = np.flatnonzero(np.diff(self.owner) == 0)

    def contexts(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct contexts, and which of them each boundary has."""
        i = self.inner
        edge = np.concatenate([[0, 0], self.places, [0, 0]])
        owner = np.concatenate([[-1, -1], self.owner, [-1, -1]])
        mine, wide = self.owner[i], len(self.known) + 1
        before = np.where(owner[i + 1] == mine, edge[i + 1], 0) * wide + edge[i + 2]
        after = edge[i + 3] * wide + np.where(owner[i + 4] == mine, edge[i + 4], 0)
        left, of_left = np.unique(before, return_inverse=True)
        right, of_right = np.unique(after, return_inverse=True)
        cells, which = np.unique(of_left * max(len(right), 1) + of_right, return_inverse=True)
        spelt = np.array(["", *map(chr, self.known.tolist())], object)
        left, right = left[cells // max(len(right), 1)], right[cells % max(len(right), 1)]
        names = spelt[left // wide] + spelt[left % wide] + " " + spelt[right // wide] + spelt[right % wide]
        return pa.array(names.tolist(), pa.string()), which

    def joined(self, space: np.ndarray, count: int) -> pa.Array:
        """The lines with a space after the characters that ``space`` marks."""
        sizes = np.bincount(self.owner, 1 + space, count).astype(np.int64)
        codes = np.full(len(self.places) + int(space.sum()), 32, np.uint32)
        codes[np.arange(len(self.places)) + np.cumsum(space) - space] = self.known[self.places - 1]
        text, ends = codes.tobytes().decode("utf-32-le"), np.concatenate([[0], np.cumsum(sizes)]).tolist()
        return pa.array([text[a:b].strip(" ") for a, b in zip(ends, ends[1:])], pa.string())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of some million bytes of their last column."""
    for batch in batches:
        ends = np.asarray(pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).cast(pa.int64())))
        cuts = [0, *(np.flatnonzero(np.diff(ends // BYTES_AT_ONCE)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def train_spacing(df: DataFrame, column: str = "text") -> DataFrame:
    """``context, spaced, total``: how often a space stands in each character context."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            chars = _Characters(batch.column(0))
            names, which = chars.contexts()
            spaced = np.bincount(which, chars.spaced[chars.inner], len(names)).astype(np.int64)
            total = np.bincount(which, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names, pa.array(spaced), pa.array(total)], names=["context", "spaced", "total"])

    parts = df.select(squeezed(F.col(column))).mapInArrow(count, "context string, spaced bigint, total bigint")
    return parts.groupBy("context").agg(F.sum("spaced").alias("spaced"), F.sum("total").alias("total"))


def apply_spacing(
    df: DataFrame, model: DataFrame, row_key: list[str], column: str = "text", out: str = "corrected",
    threshold: float = 0.5, min_total: int = 1, max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Set or remove spaces where the model has seen the context; other columns carry through.

    A context seen fewer than ``min_total`` times leaves the text as it is. Empty rows go. A model of modest size is
    shipped; of a larger one each block of rows gets the contexts that it holds.
    """
    join, keep, space = F.lit(0), F.lit(1), F.lit(2)
    often = F.when(F.col("total") < min_total, keep).when(F.col("spaced") / F.col("total") >= threshold, space).otherwise(join)
    least = model.filter("context IS NOT NULL").groupBy("context").agg(F.min(often).alias("decision"))
    decided = materialize(least, "decisions")
    full = df.filter(F.col(column).rlike(f"[^{tx.WHITESPACE}]")).withColumn("_t", squeezed(F.col(column)))

    def fill(texts: pa.Array, table: pa.Table) -> list[pa.Array]:
        chars = _Characters(texts)
        names, which = chars.contexts()
        at = pc.index_in(names, value_set=table.column(0).combine_chunks())
        told = table.column(1).combine_chunks().take(at).fill_null(1).to_numpy()[which]
        marks, inner = chars.spaced.copy(), chars.inner
        marks[inner] = np.where(told == 1, marks[inner], told == 2)
        return [chars.joined(marks, len(texts))]

    fields = [T.StructField(out, T.StringType())]
    rows = small_table(decided, max_rows)
    if rows is None:
        def distinct(texts: pa.Array) -> pa.Array:
            return _Characters(texts).contexts()[0]

        told = map_blocks(full, "_t", decided, "context", "decision", fill, fields, added=False, size=F.length("_t"), keys=distinct)
        return told.drop("_t")
    shared = df.sparkSession.sparkContext.broadcast(rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            filled = fill(batch.columns[-1], shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *filled], names=[*batch.schema.names, out])

    return full.mapInArrow(place, T.StructType(full.schema.fields + fields)).drop("_t")
