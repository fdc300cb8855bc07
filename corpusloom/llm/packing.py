"""Packing tokenized documents into sequences of a fixed length by minimum bin slack.

A document's ids are those of a tokenizer file, closed by one end id. Documents longer than a sequence are cut
into pieces of its length; only the last piece may be shorter. Packing depends on nothing but how many pieces
of each length there are, so the plan is made on that histogram, which has no more rows than a sequence has
tokens, whatever the corpus holds. For one bin after the other, a subset-sum over the available lengths, as a
bitset of reachable fills, finds the fullest combination; it is removed and the next bin looks at what is left.
As long as the same combination stays available it stays the fullest, so it is taken for as many bins at once
as its lengths allow. Fullest bins may use up the short pieces that later bins need, so plans are also made in which
every bin holds the greatest length left, and in which a bin may stay slack by a few tokens if longer pieces
then go in; the plan of fewest bins is used, and the first that meets the lower bound ends the search.

Pieces of one length are numbered in a hashed order, and each combination owns a range of the numbers of its
lengths: a piece finds its sequence and its offset by its length and number in one sorted array, which goes to
every task. Only narrow rows are shuffled, and a very frequent length is numbered in many parts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from functools import lru_cache
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm.batches import map_batches
from corpusloom.llm.bpe import _byte_letters
from corpusloom.plans.ranking import with_hash_order
from corpusloom.session import materialize

VOCABULARY = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 1
CACHED_WORDS = 400_000
CACHED_LENGTH = 32
SPACES = re.compile(r"[^\t-\r ]+")
# Letters that have one lower-case form each and are never composed, and signs that are neither letter nor number.
LETTERS = "a-zß-öø-įı-ňŊ-ž"
PLAIN = r"\x00-\x7FÀ-ÖØ-öø-įı-ňŊ-ž«»–—‘’“”„…"
BUCKET_ROWS = 4096
SLACKS = (0, 16, 256, 1024)


class Words(dict):
    """Ids by word as little-endian bytes; short words are kept up to a bound, then forgotten all at once."""

    def __init__(self, compute: Callable[[str], bytes]) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, word: str) -> bytes:
        ids = self.compute(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts under a lower-casing word vocabulary, as little-endian unsigned 32-bit numbers.

    All ids come from the tokenizer's library. Plain texts are cut into words here, as the vocabulary's own
    cut does, and the library's model is asked once per distinct word; any other text is cut at its spaces,
    and the library encodes each distinct part that is not plain.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        letters = _byte_letters()
        self.letters = {b: letters[b] for b in range(256)}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile(f"[{PLAIN}]*")
        self.cut = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\t-\\r {LETTERS}0-9]+")
        self.words = Words(self.word)
        self.parts = Words(self.part)

    def word(self, word: str) -> bytes:
        """Ids of one word of the cut, in lower case."""
        symbols = word.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(symbols)], "<u4").tobytes()

    def part(self, part: str) -> bytes:
        """Ids of what stands between two spaces."""
        if self.is_plain(part):
            return b"".join(map(self.words.__getitem__, self.cut.findall(part.lower())))
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def is_plain(self, text: str) -> bool:
        return self.plain.fullmatch(text) is not None and not any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        """Ids of a text; special tokens that it spells out become their ids."""
        if self.is_plain(text):
            return b"".join(map(self.words.__getitem__, self.cut.findall(text.lower())))
        return b"".join(map(self.parts.__getitem__, SPACES.findall(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The vocabulary at ``path``, read once per process."""
    return Encoder(path)


def cut_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY,
    length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = True,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every piece of every row.

    ``start`` counts the ids of the document before the piece. NULL and empty texts are one piece that holds the
    end id alone. Rows that share an id give their pieces each; an empty table gives an empty table.
    """
    end = np.array([end_id], "<u4").tobytes()

    def setup():
        book = encoder(public_tokenizers.path(vocabulary))

        def work(keys, texts):
            out = [[] for _ in range(6 if keep_ids else 5)]
            for key, text in zip(keys, texts):
                ids = (book.encode(text) if text else b"") + end
                for place, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    row = (key, place, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<u4").astype(np.int32))
                    for column, value in zip(out, row):
                        column.append(value)
            return out

        return work

    kind = df.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(narrow, schema, setup).withColumnRenamed("id", id_column)


def fullest(counts: dict[int, int], capacity: int, anchored: bool = False, slack: int = 0) -> dict[int, int]:
    """How often each length comes in the fullest combination of at most ``capacity`` tokens.

    Bit f of ``reach`` says that some combination of the lengths so far fills f tokens. Lengths enter from the
    greatest down, each by doubling up to its count, until the capacity, less ``slack``, is reached, so of equally
    full combinations the one found leaves the small lengths for later. With ``anchored`` the greatest length
    is in the bin from the start.
    """
    left, out = counts, {}
    if anchored:
        most = max(counts)
        out[most], capacity = 1, capacity - most
        left = counts | {most: counts[most] - 1}
    reach, mask, steps, enough = 1, (1 << capacity + 1) - 1, [], max(capacity - slack, 0)
    for length in sorted((x for x, n in left.items() if n and x <= capacity), reverse=True):
        if reach >> enough:
            break
        steps.append((length, reach))
        more, copies = min(left[length], capacity // length), 1
        while more:
            copies = min(copies, more)
            reach |= reach << length * copies & mask
            more -= copies
            copies *= 2
    fill = reach.bit_length() - 1
    for length, before in reversed(steps):
        while not before >> fill & 1:
            fill -= length
            out[length] = out.get(length, 0) + 1
    return out


def minimum_slack(counts: dict[int, int], capacity: int, anchored: bool = False, slack: int = 0) -> list[tuple[dict[int, int], int]]:
    """Combinations and the number of bins each of them fills, until no piece is left."""
    left = {x: n for x, n in counts.items() if n}
    plan = []
    while left:
        combination = fullest(left, capacity, anchored, slack)
        times = min(left[x] // n for x, n in combination.items())
        for x, n in combination.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        plan.append((combination, times))
    return plan


class Plan:
    """Sequence and offset of a piece by its length and its number among the pieces of that length."""

    def __init__(self, counts: dict[int, int], capacity: int = LENGTH) -> None:
        least = -(-sum(x * n for x, n in counts.items()) // capacity)
        self.bins, chosen = sum(counts.values()) + 1, []
        for slack, anchored in product(SLACKS, (True, False)):
            made = minimum_slack(counts, capacity, anchored, slack)
            bins = sum(times for _, times in made)
            if bins < self.bins:
                self.bins, chosen = bins, made
            if bins == least:
                break
        lengths = np.array(sorted(counts), np.int64)
        self.base = np.zeros(capacity + 1, np.int64)
        self.base[lengths] = np.cumsum([0, *[counts[x] for x in lengths.tolist()]])[:-1]
        used, rows, first = dict.fromkeys(counts, 0), [], 0
        for combination, times in chosen:
            offset = 0
            for length, copies in combination.items():
                rows.append((int(self.base[length]) + used[length], copies, first, offset))
                used[length] += copies * times
                offset += length * copies
            first += times
        # A range of places, in order: where it starts, pieces per bin, its first bin, the offset in the bin.
        self.ranges = np.array(sorted(rows), np.int64).reshape(-1, 4)

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.base[length] + number
        start, copies, first, offset = self.ranges[np.searchsorted(self.ranges[:, 0], at, side="right") - 1].T
        inside = at - start
        return first + inside // copies, offset + inside % copies * length


def pack(pieces: DataFrame, id_column: str = "doc_id", capacity: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: which sequence a piece is in, and the tokens before it there.

    ``pieces`` should be a written table of ``id, piece, length, ids_crc32``, lengths from 1 to ``capacity``. Any
    other columns ride along. Equal rows are pieces each. An empty table gives an empty table. The driver sees one
    count per length.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan, rows, width = Plan(counts, capacity), sum(counts.values()), 1
    while rows >> 4 * width > BUCKET_ROWS:
        width += 1
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_column, "piece", "ids_crc32")])
    numbered = with_hash_order(pieces, F.md5(key), "_number", ["length"], width)
    kind = T.StructType.fromDDL("sequence_id bigint, offset bigint")
    fields = list(to_arrow_schema(kind))
    book = pieces.sparkSession.sparkContext.broadcast(plan)

    def placed(length: pa.Array, number: pa.Array) -> pa.Array:
        columns = book.value.place(length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=fields)

    placed.__annotations__ = {"length": pa.Array, "number": pa.Array, "return": pa.Array}
    found = numbered.withColumn("_at", F.arrow_udf(placed, kind)("length", "_number"))
    return found.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def pack_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY,
    length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids`` of every piece of ``df``.

    Texts are tokenized once; the pieces are written to the shared folder and packed from there.
    """
    pieces = materialize(cut_documents(df, id_column, text_column, vocabulary, length, end_id, keep_ids), "pieces")
    return pack(pieces, id_column, length)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, starts``: the tokens of every sequence and where its pieces start, from pieces with ids."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return held.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))
