import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import neighbours


def exact(rows, is_query, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array(v, np.float64))
    ids = sorted(good)
    units = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids])
    out = {}
    for i in filter(is_query, ids):
        scores = units @ units[ids.index(i)]
        order = sorted((-round(s, 12), j) for s, j in zip(scores, ids) if j != i)
        out[i] = [(j, -s) for s, j in order[:k]]
    return out


def found(df, is_query, k=5):
    out = {}
    for r in sorted(neighbours.search(df, is_query, k).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit("clash") for c in ("vec", "vkey", "lst", "score", "rank", "query_id", "members")}
    )


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (8, []), (9, [0.0, -1.0]), (10, [1.0, 0.0]),
    ]
    got = found(frame(spark, rows), lambda c: c % 5 == 0)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {0: [1, 10, 2, 9], 10: [0, 1, 2, 9]}
    assert got[0][2][1] == pytest.approx(0.5 ** 0.5, abs=1e-15) and got[0][0][1] == 1.0
    assert neighbours.search(frame(spark, rows).filter("false"), lambda c: c % 5 == 0).count() == 0
    assert neighbours.search(frame(spark, rows[4:9]), lambda c: c % 5 == 0).count() == 0


def test_common_vector_and_recall(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(4000)]
    rows += [(i, rows[0][1]) for i in range(4000, 6000)]
    got = found(frame(spark, rows), lambda c: c % 50 == 0)
    want = exact(rows, lambda i: i % 50 == 0)
    assert set(got) == set(want)
    assert [i for i, _ in got[4000]] == [0, 4001, 4002, 4003, 4004]
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    for q in want:
        scores = dict(want[q])
        assert all(abs(s - scores[i]) < 1e-9 for i, s in got[q] if i in scores)


def test_query_recall(spark):
    from corpusloom.llm.queries import all_queries

    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = exact(rows, lambda i: i % 50 == 0)
    got = {}
    for r in all_queries()["op8_nearest_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def plain(rows, is_query, k=5):
    """Every pair by the measure itself: sums in the order of the components."""
    good = {i: np.array(v, np.float64) for i, v in rows}
    total = lambda a, b: np.cumsum(a * b)[-1]
    length = {i: np.sqrt(total(v, v)) for i, v in good.items()}
    out = {}
    for i in filter(is_query, good):
        order = sorted((-total(good[i], v) / (length[i] * length[j]), j) for j, v in good.items() if j != i)
        out[i] = [(j, -s) for s, j in order[:k]]
    return out


def test_a_ray_of_scaled_vectors_is_ranked_by_score_and_id(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [(i, (base * (i + 1)).astype(np.float32).tolist()) for i in range(61)]
    assert found(frame(spark, rows), lambda c: c % 50 == 0) == plain(rows, lambda i: i % 50 == 0)


def test_many_exact_multiples_tie_by_id(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=8).astype(np.float32)
    scales = [2.0 ** (i % 60 - 30) for i in range(2000)]
    rows = [(i * 7919 % 2003, (base * np.float32(s)).tolist()) for i, s in enumerate(scales)]
    rows += [(3000 + i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    got, want = found(frame(spark, rows), lambda c: c % 100 == 0), plain(rows, lambda i: i % 100 == 0)
    ray = [q for q in want if q < 3000]
    assert len(ray) > 15 and all(got[q] == want[q] for q in ray)
