import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import ROWS, no_documents, odd_documents

from corpusloom.llm import runs
from corpusloom.llm.queries import op11_periodic_runs, tailed_words


def plain_runs(words, repeats=4, least=6):
    """Every maximal stretch of every period, by trying all of them."""
    n, out, seen = len(words), [], set()
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            # A stretch that a smaller period explains has been seen; it is that period's run or inside it.
            if j > i and j - i + q >= 2 * q and (i, j - i + q) not in seen:
                seen.add((i, j - i + q))
                if j - i + q >= max(least, repeats * q):
                    out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out)


def found(lists, **limits):
    book = {}
    codes = np.array([book.setdefault(w, len(book)) for words in lists for w in words], np.int64)
    return runs.runs_of_texts(codes, np.cumsum([0, *map(len, lists)]), **limits)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=5))
def test_same_runs_as_trying_every_period(lists):
    assert found(lists) == [plain_runs(w) for w in lists]
    assert found(lists, repeats=2, least=2) == [plain_runs(w, 2, 2) for w in lists]


@pytest.mark.parametrize("chunk", [2, 1024])
def test_same_runs_with_planted_periods(monkeypatch, chunk):
    monkeypatch.setattr(runs, "CHUNK", chunk)
    draw = random.Random(chunk)
    lists = []
    for _ in range(60):
        words = [draw.randrange(30) for _ in range(draw.randrange(60))]
        for _ in range(draw.randrange(4)):
            period = [draw.randrange(4) for _ in range(draw.randrange(1, 9))]
            words += (period * draw.randrange(2, 7))[: draw.randrange(1, 60)] + [draw.randrange(30) for _ in range(5)]
        lists.append(words)
    for repeats, least in ((4, 6), (2, 2), (3, 11), (5, 3)):
        assert found(lists, repeats=repeats, least=least) == [plain_runs(w, repeats, least) for w in lists]


def test_long_texts_stay_quick():
    n = 200_000
    draw = np.random.default_rng(0)
    texts = [
        np.zeros(n, np.int64), np.arange(n) % 7, np.arange(n) % (n // 5), draw.integers(0, 2, n),
        np.concatenate([np.append(np.arange(8), 100 + i) for i in range(n // 9)]),
    ]
    start = time.perf_counter()
    first, second, third, *_ = [runs.runs_of_texts(t, np.array([0, len(t)]))[0] for t in texts]
    assert (first, second, third) == ([(0, n, 1)], [(0, n, 7)], [(0, n, n // 5)])
    assert time.perf_counter() - start < 60


def plain_report(doc_id, words):
    rows = plain_runs(words)
    drop = {i for s, length, q in rows for i in range(s + q, s + length)}
    top = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(rows), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in rows)),
        digest(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def by_hand(doc_id, text):
    import re
    import zlib

    words = re.findall(r"[^ \t-\r]+", text or "")
    h, n = zlib.crc32(str(doc_id if doc_id is not None else "").encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_periodic_runs(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    short = [r for r in rows if len(texts[r.doc_id] or "") < 12_000]
    assert len(short) > 0.9 * len(rows) and any(r.n_runs for r in short)
    for r in short:
        assert tuple(r)[:8] == plain_report(r.doc_id, by_hand(r.doc_id, texts[r.doc_id])), r.doc_id


def test_odd_rows(spark):
    df = odd_documents(spark).withColumns({"words": F.lit("clash"), "runs": F.lit(1), "found": F.lit(1), "collapsed": F.lit(1)})
    tokens = df.drop("words").withColumn("words", runs.words(F.col("text")))
    rows = runs.find_runs(tokens).collect()
    assert len(rows) == len(ROWS)
    long = next(r for r in rows if r.doc_id == 6)
    assert [tuple(x) for x in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word " + "x" * 20_000
    assert all(r.runs == [] and r.collapsed == "" for r in rows if r.doc_id in (3, 4, 5))
    assert runs.find_runs(tokens.filter("false")).count() == 0
    assert runs.report(runs.find_runs(tailed_words(no_documents(spark)))).count() == 0
    assert runs.report(runs.find_runs(tailed_words(odd_documents(spark)))).count() == len(ROWS)
    nulls = spark.createDataFrame([(1, None), (2, ["a", None] * 6), (3, [])], "doc_id long, words array<string>")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(nulls).collect()}
    assert got == {1: ([], ""), 2: ([(0, 12, 2)], "a"), 3: ([], "")}
