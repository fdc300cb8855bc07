"""Secret scan: fixed patterns, and a test of token efficiency for strings that no pattern knows.

A vocabulary learned from text spends few characters per token on random strings and many on words. Runs
of key characters that spend too few are reported as ``random``, unless their form says that they
are a digest, an identifier or a number.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches

KINDS = ("assign", "access", "hex", "random")
DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
MAX_CHARS_PER_TOKEN = 2.2
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# Forms that are random by nature but no secrets, or no random strings at all.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9+/_=-]+")
# Words of camel case; figures only stand before or after the letters of a part.
PART = re.compile(r"[0-9]*+([A-Za-z]*+)[0-9]*+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
JOINTS = re.compile(r"[+/_=-]+")


@lru_cache(maxsize=4)
def vocabulary_at(path: str):
    """The byte-level vocabulary at ``path``, read once per process."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def joined_words(run: str, encoding, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Whether ``run`` is words joined by separators or camel case, each of them token-efficient by itself.

    Words of one or two letters say nothing: they pass alone between separators, if others make up
    more than half of the letters.
    """
    long = short = 0
    for part in JOINTS.split(run):
        form = PART.fullmatch(part)
        if not form:
            return False
        letters = form.group(1)
        if len(letters) <= 2:
            short += len(letters)
            continue
        for word in WORD.findall(letters):
            if len(word) <= most * len(encoding.encode_ordinary(word)):
                return False
        long += len(letters)
    return long > short


def known_form(run: str, encoding, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Whether ``run`` is a digest, an identifier or a number by its form."""
    if DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    return bool(UUID.fullmatch(run) or NUMBER.fullmatch(run)) or joined_words(run, encoding, most)


def find_spans(text: str, encoding, most: float = MAX_CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then kind."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = list(found)
    for m in RUN.finditer(text):
        start, end = m.span()
        run = m.group()
        if len(run) > most * len(encoding.encode_ordinary(run)) or known_form(run, encoding, most):
            continue
        if not any(a <= start and end <= b for _, a, b in base):
            found.append(("random", start, end))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = DEFAULT_VOCABULARY,
    most: float = MAX_CHARS_PER_TOKEN,
) -> DataFrame:
    """``id, spans`` for every row, the spans of the whole text in the order of ``find_spans``.

    NULL and empty texts have none; texts of any length are scanned whole, an empty table gives an empty table. Repeated rows are scanned apart; other columns are ignored. ``most``
    is the number of characters per token up to which a run counts as random.
    """
    def setup():
        encoding = vocabulary_at(public_tokenizers.path(vocabulary))

        def work(keys, texts):
            spans = [find_spans(t, encoding, most) if t else [] for t in texts]
            return [keys, [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]]

        return work

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = df.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return map_batches(narrow, schema, setup).withColumnRenamed("id", id_column)


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` of the rows of ``scan``."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return scanned.select(
        id_column, *[count(kind) for kind in KINDS], F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
