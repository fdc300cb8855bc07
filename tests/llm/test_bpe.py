import random

import public_tokenizers
import pytest
from samples import ROWS, no_documents, odd_documents
from tokenizers import Tokenizer

from corpusloom.llm import bpe

PATH = public_tokenizers.path(bpe.DEFAULT_VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def naive_merge(codec, symbols):
    symbols = list(symbols)
    while True:
        ranks = [codec.ranks.get(a << codec.shift | b) for a, b in zip(symbols, symbols[1:])]
        known = [r for r in ranks if r is not None]
        if not known:
            return symbols
        at = ranks.index(min(known))
        symbols[at:at + 2] = [codec.merged[min(known)]]


def test_tree_merges_like_repeated_search():
    codec, draw = bpe.codec(PATH), random.Random(3)
    for size in (0, 1, 2, 3, 17, 66, 130, 400):
        symbols = [codec.byte_ids[ord(draw.choice("abcdeth "))] for _ in range(size)]
        want = naive_merge(codec, symbols)
        assert codec.merge(list(symbols)) == want
        if size > 1:
            assert codec._merge_tree(list(symbols)) == want


def test_texts_agree_with_the_library(library):
    codec, draw = bpe.codec(PATH), random.Random(5)
    letters = [chr(c) for c in range(0x20, 0x3000)] + ["<|endoftext|>", " ", "\n", "  ", "'s", "՘", "\U000107bb", "\x00"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 80))) for _ in range(400)]
    texts += ["", "a" * 5000, "ab" * 9000, " " * 999, "<|endoftext|>" * 3, "�", *[r[1] for r in ROWS if r[1]]]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_odd_rows(spark, library):
    rows = bpe.encode_and_decode(odd_documents(spark)).collect()
    assert len(rows) == len(ROWS)
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in ROWS)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert sorted(r.decoded for r in rows) == sorted(t or "" for _, t, *_ in ROWS)
    assert bpe.encode_documents(no_documents(spark)).count() == 0


def test_decoding_keeps_columns_and_mends_broken_bytes(spark):
    df = spark.createDataFrame([(1, [162], "k"), (2, None, "l"), (3, [15496], "m")], "doc_id long, ids array<int>, id string")
    rows = {r.doc_id: (r.decoded, r.id) for r in bpe.decode_documents(df, keep=["id"]).collect()}
    assert rows == {1: ("�", "k"), 2: ("", "l"), 3: ("Hello", "m")}


def test_query_agrees_with_the_library(spark, sf, library):
    import hashlib

    from corpusloom.llm.queries import all_queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = all_queries()["op10_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
