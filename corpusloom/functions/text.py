"""String columns for cleaning and splitting text. All of them stay inside Spark's engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let

# The characters Python calls whitespace, as one regular-expression class body.
WHITESPACE = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Patterns of the wiki cleaner.
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+(?=\n?\z)"
URL = r"(?:ftp|https?)?://[!$-_a-z]+"
WIKI_NOISE = (
    r"(?d)'+|=+.{2,30}=+|__TOC__|ファイル:.+|:(?:en|de|it|fr|es|kr|zh|no|fi):|\n"
)
WIKI_SPACES = "[" + WHITESPACE + r"\x{3099}\x{309a}]+"
WIKI_TOKEN_NOISE = r"\*$|:$|^파일:.+|^;"
# Code-point blocks of ideographs.
IDEOGRAPHS = (
    r"\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}"
    r"\x{2b740}-\x{2b81f}\x{2b820}-\x{2ceaf}\x{f900}-\x{faff}\x{2f800}-\x{2fa1f}"
)
# ASCII characters that count as punctuation beside Unicode category P.
PUNCTUATION = r"!-/:-@\[-`{-~\p{P}"
RECORD_SEPARATOR = "␞"


def strip(col: Column) -> Column:
    """Remove whitespace of any kind at both ends; NULL counts as empty."""
    ends = f"^[{WHITESPACE}]+|[{WHITESPACE}]+$"
    return F.regexp_replace(F.coalesce(col, F.lit("")), ends, "")


def whitespace_tokens(col: Column) -> Column:
    """Split on runs of whitespace, without empty tokens."""
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), f"[{WHITESPACE}]+"), "")


# Markup of wiki articles. Elements go with what they hold; the innermost of templates,
# tables and links hold no brackets of their own.
WIKI_ELEMENTS = ("ref", "math", "nowiki", "gallery", "timeline", "source", "code")
WIKI_TEMPLATE = r"\{\{[^{}]*\}\}"
WIKI_TABLE = r"\{\|[^{}]*\|\}"
WIKI_CATEGORY = r"\[\[(?:[Cc]ategory|분류):[^\[\]]*\]\]"
WIKI_BARE_FILE = r"\[\[(?:[Ff]ile|[Ii]mage|파일|그림):[^\[\]|]*\]\]"
WIKI_LINK = r"\[\[(?:[^\[\]]*\|)?([^\[\]|]*)\]\]"
WIKI_ADDRESS = r"\[(?:https?|ftp)://[^ \t\n\[\]]+ ?([^\[\]]*)\]"
WIKI_SIGNS = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}


def _innermost(col: Column, opening: str, pattern: str, kept: str = "") -> Column:
    """``col`` with ``pattern`` replaced again and again until nothing changes, innermost first.

    A pass replaces at least one match, so there are never more passes than openings.
    """
    def step(state: Column, _: Column) -> Column:
        done = F.regexp_replace(state["text"], pattern, kept)
        return F.when(
            state["going"], let(done, lambda new: F.struct(new.alias("text"), (new != state["text"]).alias("going")))
        ).otherwise(state)

    passes = F.sequence(F.lit(1), F.regexp_count(col, F.lit(opening)))
    start = F.struct(col.alias("text"), F.lit(True).alias("going"))
    return F.when(col.rlike(opening), F.aggregate(passes, start, step)["text"]).otherwise(col)


def wiki_text(col: Column) -> Column:
    """The prose of a wiki article: comments, elements, templates, tables, categories and tags go, links and
    files keep their label or caption. NULL counts as empty."""
    out = F.regexp_replace(F.coalesce(col, F.lit("")), "(?s)<!--.*?-->", "")
    for name in WIKI_ELEMENTS:
        out = F.regexp_replace(out, rf"<{name}\b[^<>]*/>", "")
        out = F.regexp_replace(out, rf"(?s)<{name}\b[^<>]*>.*?</{name} *>", "")
    out = let(out, lambda t: _innermost(t, r"\{\{", WIKI_TEMPLATE))
    out = let(out, lambda t: _innermost(t, r"\{\|", WIKI_TABLE))
    for pattern in (WIKI_CATEGORY, WIKI_BARE_FILE):
        out = F.regexp_replace(out, pattern, "")
    out = let(out, lambda t: _innermost(t, r"\[\[", WIKI_LINK, "$1"))
    out = F.regexp_replace(F.regexp_replace(out, WIKI_ADDRESS, "$1"), "<[^<>]*>", "")
    for sign, letter in WIKI_SIGNS.items():
        out = F.replace(out, F.lit(sign), F.lit(letter))
    return out


def wiki_clean(col: Column) -> Column:
    """Blank out addresses, links, headings and wiki markup, then squeeze spaces."""
    out = F.regexp_replace(F.coalesce(col, F.lit("")), EMAIL, " ")
    out = F.regexp_replace(out, URL, " ")
    out = F.regexp_replace(out, WIKI_NOISE, " ")
    out = F.regexp_replace(out, WIKI_SPACES, " ")
    return F.replace(out, F.lit(", )"), F.lit(""))


def wiki_tokens(col: Column) -> Column:
    """Tokens of ``wiki_clean``: names starting with an underscore go, edge marks are cut."""
    pieces = F.filter(F.split(wiki_clean(col), " "), lambda t: ~t.startswith("_"))
    return F.array_remove(
        F.transform(pieces, lambda t: F.regexp_replace(t, WIKI_TOKEN_NOISE, "")), ""
    )


def clean_control(col: Column) -> Column:
    """Tab, newline and every space separator become a space; control characters vanish."""
    spaced = F.regexp_replace(F.coalesce(col, F.lit("")), r"[\t\n\r\p{Zs}]", " ")
    return F.regexp_replace(spaced, r"[\x{0}\x{fffd}\p{Cc}\p{Cf}]", "")


def space_cjk(col: Column) -> Column:
    """A space on both sides of every ideograph."""
    return F.regexp_replace(col, f"([{IDEOGRAPHS}])", " $1 ")


def space_punct(col: Column) -> Column:
    """A space on both sides of every punctuation character."""
    return F.regexp_replace(col, f"([{PUNCTUATION}])", " $1 ")


def split_punct(tokens: Column) -> Column:
    """Cut each token at punctuation, which stays as tokens of one character."""
    return whitespace_tokens(space_punct(F.array_join(tokens, " ")))


def space_digits(col: Column) -> Column:
    """Every decimal digit becomes a token of its own."""
    return F.array_remove(F.split(F.regexp_replace(col, r"(\p{Nd})", " $1 "), " "), "")


def collapse_repeats(col: Column, keep: int = 3) -> Column:
    """Runs of one character longer than ``keep`` are cut to ``keep``."""
    return F.regexp_replace(col, r"(?s)(.)\1{%d,}" % keep, "$1" * keep)


def split_sentences(col: Column) -> Column:
    """Sentences: cut at whitespace that follows a full stop, exclamation or question mark."""
    return F.split(strip(col), rf"(?<=[.!?])[{WHITESPACE}]+")


def sentence_sizes(tokens: Column) -> Column:
    """How many of a text's ``whitespace_tokens`` each of its sentences holds: one ends with a token that has their mark at its end."""
    def is_end(token: Column, i: Column) -> Column:
        return token.endswith(".") | token.endswith("!") | token.endswith("?") | (i == F.size(tokens) - 1)

    ends = F.filter(F.transform(tokens, lambda t, i: F.when(is_end(t, i), i + 1)), lambda e: e.isNotNull())
    return let(ends, lambda at: F.transform(at, lambda e, i: e - F.when(i > 0, F.get(at, i - 1)).otherwise(0)))


def split_record(col: Column) -> Column:
    """Positional fields of a line joined by the record separator."""
    return F.split(col, RECORD_SEPARATOR)


def char_ngrams(word: Column, low: int, high: int) -> Column:
    """Substrings of ``<word>`` with ``low`` to ``high`` characters, repeats kept."""
    def grams(framed: Column) -> Column:
        def of_size(n: Column) -> Column:
            last = F.length(framed) - n + 1
            starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda s: F.substr(framed, s, n))

        return F.flatten(F.transform(F.sequence(F.lit(low), F.lit(high)), of_size))

    return let(F.concat(F.lit("<"), word, F.lit(">")), grams)


def cut_digit_comma(pieces: Column) -> Column:
    """A piece ending in digit and comma is cut so that the comma stands alone."""
    return F.flatten(
        F.transform(
            pieces,
            lambda p: F.when(
                p.rlike(r"\p{Nd},$"), F.array(F.regexp_replace(p, ",$", ""), F.lit(","))
            ).otherwise(F.array(p)),
        )
    )
