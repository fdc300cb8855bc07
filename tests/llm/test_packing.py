import bisect
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import ROWS, no_documents, odd_documents
from tokenizers import Tokenizer

from corpusloom.llm import packing
from corpusloom.llm.queries import op13_slack_packing

PATH = public_tokenizers.path(packing.VOCABULARY)
COLUMNS = ["piece", "start", "length", "ids_crc32"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def by_library(library, text, length=4096):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
    cut = [np.array(ids[a:a + length], "<u4") for a in range(0, len(ids), length)]
    return [(i, i * length, len(c), zlib.crc32(c.tobytes())) for i, c in enumerate(cut)]


def same(library, text):
    assert np.frombuffer(packing.encoder(PATH).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]


ODD = [
    "It's they'RE we've I'm you'll he'd 's 'S ''s !'s 'x '1 'sx rock'n'roll", "a1b22c333 12,345.67 x--y__z", "ÀÉÎÕÜ Straße ŒUVRE žluťoučký İstanbul ISTANBUL ıŉſ",
    "éä ́x Ａｂｃ ﬁ ² ½ Ⅷ ٣ 漢字かな 한국 🎉👍🏽  a b　c​d", "<|endoftext|>a<|startoftext|> <|END|> x<|endoftext|>y é<|endoftext|>",
    "«a» – b — ‘c’ “d” „e” …f", "ΑΣ ΌΔΟΣ ς ẞ ǅ", "".join(map(chr, range(1, 0x250))), " ".join(map(chr, range(1, 0x250))), "'".join(map(chr, range(1, 0x180))),
    "x" * 5000, "\x1c\x1d\x1e\x1f a\x85b\x0bc", "",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(library, text):
    same(library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAbBzZ'sStTrRvV 01\n.,-!<|>éÉßÿŸ–’”́中"), max_size=30))
def test_ids_of_any_text(text):
    same(Tokenizer.from_file(PATH) if not hasattr(test_ids_of_any_text, "book") else test_ids_of_any_text.book, text)


test_ids_of_any_text.book = Tokenizer.from_file(PATH)


def best_fill(lengths, capacity):
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= capacity}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=12))
def test_every_bin_is_the_fullest(lengths):
    counts = Counter(lengths)
    found = packing.fullest(counts, 20)
    assert all(n <= counts[x] for x, n in found.items()) and sum(x * n for x, n in found.items()) == best_fill(lengths, 20)
    most = max(lengths)
    rest = list(lengths)
    rest.remove(most)
    held = packing.fullest(counts, 20, anchored=True)
    assert held[most] >= 1 and sum(x * n for x, n in held.items()) == most + best_fill(rest, 20 - most)
    # Taking a combination for many bins at once is the same as looking for each bin anew.
    left, bins = dict(counts), 0
    for combination, times in packing.minimum_slack(counts, 20):
        for _ in range(times):
            fill = best_fill([x for x, n in left.items() for _ in range(n)], 20)
            assert sum(x * n for x, n in combination.items()) == fill
            for x, n in combination.items():
                left[x] -= n
        bins += times
    assert not any(left.values()) and bins >= -(-sum(lengths) // 20)


def best_fit(lengths, capacity):
    """Bins of best fit, longest first."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        bisect.insort(gaps, (gaps.pop(at) if at < len(gaps) else capacity) - x)
    return len(gaps)


@pytest.mark.parametrize("low,high,hot", [(1, 4097, 0), (1000, 3000, 0), (1100, 1700, 0), (1, 3000, 1500), (1, 600, 500)])
def test_plans_are_near_the_bound(low, high, hot):
    draw = random.Random(low)
    lengths = [draw.randrange(low, high) for _ in range(3000)] + [hot] * (1500 if hot else 0)
    plan = packing.Plan(Counter(lengths))
    assert -(-sum(lengths) // 4096) <= plan.bins <= 1.01 * best_fit(lengths, 4096)


def check(rows, capacity=4096):
    """Every sequence is gapless from 0 and within its capacity."""
    for _, held in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in held:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len({r.sequence_id for r in rows})


def test_query(spark, sf, library):
    rows = op13_slack_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    mine = sorted((r.doc_id, *[r[c] for c in COLUMNS]) for r in rows)
    assert mine == sorted((i, *p) for i, t in texts.items() for p in by_library(library, t))
    assert check(rows) <= 1.01 * -(-sum(r.length for r in rows) // 4096) + 1


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_lengths_and_repeated_rows(spark, seed):
    draw = random.Random(seed)
    lengths = [700] * 900 + [draw.randrange(1, 4097) for _ in range(600)] + [4096] * 50
    data = [(i // 2 if i % 3 else None, 0, x, 7) for i, x in enumerate(lengths)]
    pieces = spark.createDataFrame(data, "doc_id long, piece int, length long, ids_crc32 long").withColumn("_bucket", F.lit("clash"))
    rows = packing.pack(pieces.drop("_bucket")).collect()
    assert Counter(r.length for r in rows) == Counter(lengths)
    bins = check(rows)
    assert bins == packing.Plan(Counter(lengths)).bins <= best_fit(lengths, 4096)
    again = packing.pack(pieces.drop("_bucket").repartition(5)).collect()
    assert sorted(rows, key=repr) == sorted(again, key=repr)


def test_odd_rows(spark, library):
    rows = packing.pack_documents(odd_documents(spark), length=64, keep_ids=True).collect()
    mine = sorted(((r.doc_id, *[r[c] for c in COLUMNS]) for r in rows), key=repr)
    assert mine == sorted(((i, *p) for i, t, *_ in ROWS for p in by_library(library, t, 64)), key=repr)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    check(rows, 64)
    assert packing.pack_documents(no_documents(spark)).count() == 0


def test_sequences_hold_all_tokens(spark):
    df = odd_documents(spark).filter("doc_id <> 6")
    packed = packing.pack_documents(df, length=16, keep_ids=True)
    rows = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in rows) == packed.agg(F.sum("length")).first()[0]
    assert all(len(r.ids) <= 16 and r.starts[0] == 0 for r in rows)
    ids = {(r.sequence_id, r.offset): r.ids for r in packed.collect()}
    assert all(r.ids[s:s + len(ids[r.sequence_id, s])] == ids[r.sequence_id, s] for r in rows for s in r.starts)
