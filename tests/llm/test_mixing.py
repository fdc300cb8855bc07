import random

import duckdb
import pytest
from pyspark.sql import functions as F
from samples import CLASHES, ROWS, SCHEMA, no_documents, odd_documents

from corpusloom.llm import mixing
from corpusloom.llm.queries import SQL_MIX

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def by_sql(rows):
    import pyarrow as pa

    documents = pa.table({  # noqa: F841  read by name
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
        "source": pa.array([r[3] for r in rows], pa.string()),
    })
    return sorted(duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({SQL_MIX})").fetchall(), key=repr)


def many(seed, docs, sources):
    draw = random.Random(seed)
    names = [*[f"s{i}" for i in range(sources)], None, "Ä", "z"]
    weight = [draw.random() ** 3 for _ in names]
    return [(i, "w " * draw.choice([0, 1, 3, 40, 300]), "en", draw.choices(names, weight)[0], 0) for i in range(docs)]


@pytest.mark.parametrize("rows", [ROWS, many(1, 400, 7), many(2, 900, 2), [(i, "a b", "en", "only", 3) for i in range(50)]])
def test_plan_agrees_with_sql(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES})
    mine = mixing.plan_mix(df).select(*COLUMNS).collect()
    assert sorted([tuple(r) for r in mine], key=repr) == by_sql(rows)


def test_targets_are_met_and_capped(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)  # more digits, same rows
    rows = many(3, 1500, 12)
    plan = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA)).collect()
    source = {r[0]: r[3] for r in rows}
    total = sum(r.size for r in plan)
    target = {source[r.doc_id]: r.target for r in plan}
    taken = {}
    for r in plan:
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size and r.target <= 3 * r.source_size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert abs(sum(target.values()) - total) < 1e-6 * total and total - 300 <= sum(taken.values()) <= total
    assert all(abs(taken[s] - target[s]) <= 300 for s in target)


def test_documents_come_as_often_as_planned(spark):
    df = odd_documents(spark)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    plan = [r for r in mixing.plan_mix(df).collect() if r.size]
    assert mixed.count() == sum(r.taken // r.size for r in plan)
    assert mixing.mix(no_documents(spark)).count() == 0 and mixing.plan_mix(no_documents(spark)).count() == 0
    assert mixing.mix(df.filter("doc_id IN (3, 4)")).count() == 0
