"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The vocabulary is read from a tokenizer's JSON file; nothing is trained. A text is cut at the
special tokens it spells out and then into the pieces of the byte-level pattern. Inside a piece
every adjacent pair of symbols is a leaf of a segment tree that holds ``(rank, place)``; the root
is the leftmost pair of lowest rank. Merging it changes three leaves, each in logarithmic time,
and this goes on until the root says that no pair can merge. A run of n bytes without a break
therefore costs O(n log n), whatever its length.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
CACHED_PIECES = 200_000
CACHED_LENGTH = 48
NODE_WIDTH = 64
PLACE_BITS = 40
PLACE_MASK = (1 << PLACE_BITS) - 1
_NONE = (1 << 30) - 1


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def own_cut(path: str) -> Callable[[str], list]:
    """The library's cut into pieces, loaded by the few tasks that meet a doubtful text."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str


class Pieces(dict):
    """Ids by piece; short pieces are remembered up to a bound, then forgotten all at once."""

    def __init__(self, compute: Callable[[str], tuple[int, ...]]) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.compute(piece)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A byte-level BPE vocabulary: ``encode`` and ``decode``."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocab: dict[str, int] = model["model"]["vocab"]
        letters = _byte_letters()
        of_letter = {letter: byte for byte, letter in letters.items()}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.shift = max(vocab.values()).bit_length()
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(model["model"]["merges"]):
            self.ranks.setdefault(vocab[left] << self.shift | vocab[right], rank)
            self.merged.append(vocab[left + right])
        self.bytes_of = {i: bytes(of_letter[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special_pattern = (
            regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
            if self.special else None
        )
        # Unicode versions differ in which of the code points that are unassigned here are letters
        # or numbers; texts that hold one are cut by the vocabulary's own library.
        unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
        self.doubtful = frozenset(regex.findall(r"[\p{L}\p{N}]", unassigned))
        self.beyond = re.compile(f"[{min(self.doubtful)}-\U0010ffff]") if self.doubtful else None
        self.path = path
        self.pieces = Pieces(self.piece)

    def merge(self, symbols: list[int]) -> list[int]:
        """``symbols`` after all merges, lowest rank first and leftmost among equals."""
        if len(symbols) - 1 > NODE_WIDTH:
            return self._merge_tree(symbols)
        # The pairs fit one node of the tree: its least entry, at its first place, is the root.
        get, shift, merged = self.ranks.get, self.shift, self.merged
        pairs = [get(a << shift | b, _NONE) for a, b in zip(symbols, symbols[1:])]
        while pairs:
            rank = min(pairs)
            if rank == _NONE:
                break
            at = pairs.index(rank)
            new = symbols[at] = merged[rank]
            del pairs[at], symbols[at + 1]
            if at:
                pairs[at - 1] = get(symbols[at - 1] << shift | new, _NONE)
            if at < len(pairs):
                pairs[at] = get(new << shift | symbols[at + 1], _NONE)
        return symbols

    def _merge_tree(self, symbols: list[int]) -> list[int]:
        """The same for a piece of any length, with ``(rank, place)`` as one number in each leaf."""
        get, shift, merged = self.ranks.get, self.shift, self.merged
        count = len(symbols)
        leaves = 1 << (count - 2).bit_length()
        none = _NONE << PLACE_BITS
        tree = [none] * (2 * leaves)

        def entry(left: int, right: int) -> int:
            rank = get(symbols[left] << shift | symbols[right])
            return none if rank is None else rank << PLACE_BITS | left

        tree[leaves:leaves + count - 1] = [entry(i, i + 1) for i in range(count - 1)]
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        following = list(range(1, count + 1))
        before = list(range(-1, count - 1))

        def update(leaf: int, value: int) -> None:
            node = leaves + leaf
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] != none:
            at = tree[1] & PLACE_MASK
            symbols[at] = merged[tree[1] >> PLACE_BITS]
            gone = following[at]
            after = following[at] = following[gone]
            if after < count:
                before[after] = at
                update(gone, none)
                update(at, entry(at, after))
            else:
                update(at, none)
            if at:
                update(before[at], entry(before[at], at))
        out, at = [], 0
        while at < count:
            out.append(symbols[at])
            at = following[at]
        return out

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of the pattern."""
        return tuple(self.merge([*map(self.byte_ids.__getitem__, piece.encode())]))

    def _plain(self, text: str, out: list[int]) -> None:
        if self.beyond is not None and self.beyond.search(text) and not self.doubtful.isdisjoint(text):
            pieces = [text[a:b] for _, (a, b) in own_cut(self.path)(text)]
        else:
            pieces = self.pattern.findall(text)
        out += chain.from_iterable(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; special tokens that it spells out become their ids."""
        out: list[int] = []
        at = 0
        if self.special_pattern is not None:
            for found in self.special_pattern.finditer(text):
                if found.start() > at:
                    self._plain(text[at:found.start()], out)
                out.append(self.special[found.group()])
                at = found.end()
        if at < len(text):
            self._plain(text[at:] if at else text, out)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The vocabulary at ``path``, read once per process."""
    return Codec(path)


def encode_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = DEFAULT_VOCABULARY
) -> DataFrame:
    """``id, ids, n_tokens`` for every row: one row out per row in, repeated rows included.

    NULL text counts as empty and gives no ids; a NULL id stays NULL. Other columns are ignored, so
    their names cannot clash. ``vocabulary`` is a file that every worker's installation holds.
    """
    def setup():
        book = codec(public_tokenizers.path(vocabulary))

        def work(keys, texts):
            ids = [book.encode(t) if t else [] for t in texts]
            return [keys, ids, [len(i) for i in ids]]

        return work

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = df.schema[id_column].dataType.simpleString()
    out = map_batches(narrow, f"id {kind}, ids array<int>, n_tokens bigint", setup)
    return out.withColumnRenamed("id", id_column)


def decode_documents(
    df: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", vocabulary: str = DEFAULT_VOCABULARY,
    keep: list[str] | None = None,
) -> DataFrame:
    """``id, decoded`` and the columns in ``keep`` for every row; NULL ids give an empty text."""
    kept = keep or []

    def setup():
        book = codec(public_tokenizers.path(vocabulary))

        def work(keys, ids, *others):
            return [keys, [book.decode(i or []) for i in ids], *others]

        return work

    narrow = df.select(
        F.col(id_column).alias("id"), F.col(ids_column).alias("ids"),
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)],
    )
    kinds = [f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    kind = df.schema[id_column].dataType.simpleString()
    out = map_batches(narrow, ", ".join([f"id {kind}", "decoded string", *kinds]), setup)
    return out.toDF(id_column, "decoded", *kept)


def encode_and_decode(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = DEFAULT_VOCABULARY
) -> DataFrame:
    """``id, ids, n_tokens, decoded``: both directions in one pass over the texts.

    NULL and empty texts have no ids and decode to an empty text; long ones are encoded whole. An empty table gives an
    empty table; repeated rows and other columns as in ``encode_documents``.
    """
    def setup():
        book = codec(public_tokenizers.path(vocabulary))

        def work(keys, texts):
            ids = [book.encode(t) if t else [] for t in texts]
            return [keys, ids, [len(i) for i in ids], [book.decode(i) for i in ids]]

        return work

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = df.schema[id_column].dataType.simpleString()
    out = map_batches(narrow, f"id {kind}, ids array<int>, n_tokens bigint, decoded string", setup)
    return out.withColumnRenamed("id", id_column)


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of the rows of ``encode_and_decode``."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        id_column, "n_tokens", F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
