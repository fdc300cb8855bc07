import hashlib
import math
import random
import re
import zlib

import pytest
from parity import compare, connect
from pyspark.sql import functions as F
from samples import CLASHES, ROWS, no_documents, odd_documents

from corpusloom.llm import resample
from corpusloom.llm.queries import SQL_RESAMPLE, op12_target_resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found(text, longest):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def by_hand(rows, target, longest=1, count=10_000, least_words=20, percent=10, seed="2024"):
    bucket = lambda f: zlib.crc32(f.encode()) % count
    listed = [(i, *found(t, longest)) for i, t in rows]
    s, t = [0] * count, [0] * count
    for _, _, fs in listed:
        for f in fs:
            s[bucket(f)] += 1
    for text in target:
        for f in found(text, longest)[1]:
            t[bucket(f)] += 1
    total_s, total_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + count) / ((s[b] + 1) * (total_t + count)))) for b in range(count)]
    out, able = [], []
    for i, words, fs in listed:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= least_words:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = place + 1
    return sorted(map(tuple, out), key=repr)


def test_query_equals_sql(spark, sf):
    assert compare(spark, connect(sf), sf, "op12", op12_target_resampling, SQL_RESAMPLE) is None


def many(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "A1", "x"]
    texts = ["  ".join(draw.choices(words, k=draw.choice([0, 3, 19, 20, 21, 60]))) for _ in range(n)]
    return [(draw.randrange(n) if draw.random() < 0.97 else None, draw.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (3, 25, 20), (1, 100, 0), (2, 0, 5)])
def test_same_rows_as_by_hand(spark, longest, percent, least):
    rows, target = many(longest, 400), ["w1 w2 Ünï w3", None, "w5 w5"]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in [*CLASHES, "score", "rank", "s", "t"]})
    aim = spark.createDataFrame([(t,) for t in target], "text string").withColumn("bucket", F.lit(1))
    mine = resample.resample(df, aim, longest=longest, count=97, percent=percent, least_words=least)
    assert sorted([tuple(r) for r in mine.collect()], key=repr) == by_hand(rows, target, longest, 97, least, percent)


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    # Few distinct scores and a coarse sketch: the bracket often starts on the wrong side.
    rows = [(i, float(i % 7) ** 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s double").select("id", F.col("s").cast("long").alias("score"), F.lit(True).alias("eligible"))
    df.cache()
    order = sorted(df.collect(), key=lambda r: (-r.score, r.id))
    for draw in (1, 2, 299, 428, 429, 1500, 2999, 3000):
        bracket = resample.bracket_cutoff(df, draw, 3000, accuracy=10)
        cut = order[draw - 1].score
        assert (bracket.low is None or bracket.low <= cut) and (bracket.high is None or cut <= bracket.high)
        assert bracket.above == sum(r.score > (bracket.high if bracket.high is not None else 99) for r in order)
        got = resample.draw_highest(df, draw, 3000, "id", accuracy=10).filter("rank IS NOT NULL").orderBy("rank").collect()
        assert [r.id for r in got] == [r.id for r in order[:draw]]
        assert [r["rank"] for r in got] == list(range(1, draw + 1))
    df.unpersist()


def test_a_sketch_that_misses_is_widened(spark, monkeypatch):
    df = spark.range(1000).select("id", F.col("id").alias("score"))
    monkeypatch.setattr(resample.F, "percentile_approx", lambda c, q, a: F.array(*[F.lit(10 * (i + 1)) for i in range(len(q))]))
    bracket = resample.bracket_cutoff(df, 500, 1000, accuracy=1000)
    assert (bracket.low, bracket.high) == (None, None) and (bracket.above, bracket.inside) == (0, 1000)


def test_odd_rows(spark):
    aim = odd_documents(spark).select("text")
    rows = resample.resample(odd_documents(spark), aim).collect()
    assert sorted([tuple(r) for r in rows], key=repr) == by_hand([r[:2] for r in ROWS], [r[1] for r in ROWS])
    assert resample.resample(no_documents(spark), aim).count() == 0
    assert resample.resample(odd_documents(spark), no_documents(spark)).count() == len(ROWS)
    assert resample.resample(odd_documents(spark), aim, percent=100).filter("rank = 1").count() == 1
