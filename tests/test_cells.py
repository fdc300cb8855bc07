"""Summed pair weights: what moves between tasks, and sums by brute force for ids of any width."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import statistics as st


def brute(rows, window, own):
    cells = Counter()
    for ids in rows:
        for i, a in enumerate(ids or []):
            if a is None or a < 0:
                continue
            if own:
                cells[a, a] += 1
            for d in range(1, window + 1):
                if i + d < len(ids) and ids[i + d] is not None and ids[i + d] >= 0:
                    cells[a, ids[i + d]] += 1 / d
                    cells[ids[i + d], a] += 1 / d
    return cells


def drawn(n, top, seed=5):
    draw = random.Random(seed)
    rows = [[draw.choice([-1, draw.randrange(top), draw.randrange(3)]) for _ in range(draw.randrange(12))] for _ in range(n)]
    return rows + [None, [], [None, 1, 1], [7]]


def test_buckets_move_and_not_cells():
    rows = [[i, i + 1, i + 2, 5000 - i] for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], names=["ids"])
    moved = [b for b in st._cell_sums([2, 1], 3)(iter([batch]))]
    assert sum(b.num_rows for b in moved) <= st.BUCKETS < sum(sum(b.column("n").to_pylist()) for b in moved)


@pytest.mark.parametrize("top, at_once", [(40, 1 << 22), (40, 16), (5000, 64), (1 << 40, 64)])
def test_cells_by_brute_force(spark, monkeypatch, top, at_once):
    monkeypatch.setattr(st, "PAIRS_AT_ONCE", at_once)
    rows = drawn(80, top)
    df = spark.createDataFrame([(r,) for r in rows], "ids array<bigint>").repartition(3)
    for built, own in ((st.cooccurrence_harmonic(df, 4), True), (st.cooccurrence_glove(df, 4), False)):
        got = built.collect()
        want = brute(rows, 4, own)
        assert len(got) == len(want) and all(abs(want[r.row_id, r.col_id] - r.value) < 1e-9 for r in got)
    assert st.cooccurrence_harmonic(df.filter("false")).count() == 0
    # Weights without a common denominator are summed as doubles.
    assert sum(r.value for r in st.cooccurrence_glove(df, 25).collect()) == pytest.approx(sum(brute(rows, 25, False).values()))


def test_best_columns_by_chunks(spark, monkeypatch):
    """Ties, equal rows, NULLs and values that are no numbers rank as in one window over everything."""
    draw = random.Random(2)
    rows = [(draw.choice([1, 2, 3, None]), draw.choice([*range(9), None]), draw.choice([0.5, 1.0, 2.0, -3.0, float("nan"), None]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, col_id bigint, pmi double, n int").coalesce(1)
    order = Window.partitionBy("row_id").orderBy(F.col("pmi").desc(), "col_id")
    want = df.withColumn("rank", F.row_number().over(order)).filter("rank <= 4")
    monkeypatch.setattr(st, "PAIRS_AT_ONCE", 50)
    got = st.top_collocates(df, 4)

    def shown(found):
        return sorted(str((r.row_id, r.rank, r.pmi, r.col_id)) for r in found.collect())

    assert got.columns == want.columns and shown(got) == shown(want)
    kept = df.filter("pmi < 9 AND row_id + col_id IS NOT NULL").mapInArrow(st._best_of_chunks(1), df.schema)
    assert kept.count() <= 6 * 3


def test_exact_sums_cost_no_decimal_per_row(spark):
    draw = random.Random(3)
    rows = [(i % 4, draw.choice([draw.uniform(-9, 9), 1 / 3, 2e5 + draw.random(), None, float("nan"), float("inf")])) for i in range(400)] + [(9, None)]
    df = spark.createDataFrame(rows, "k int, value double")
    exact, plain = st.exact_sum("value"), F.sum(F.col("value").cast("decimal(28,12)")).cast("double")
    for r in df.groupBy("k").agg(exact.alias("a"), plain.alias("b")).collect():
        assert r.a == r.b or r.a == pytest.approx(r.b, abs=1e-10)
    plan = df.groupBy("k").agg(exact)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(cast(" not in plan and "as decimal(28,12)" not in plan
