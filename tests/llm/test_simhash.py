import re

import numpy as np
import xxhash
from pyspark.sql import functions as F
from samples import ROWS, no_documents, odd_documents

from corpusloom.llm import simhash
from corpusloom.llm.components import connected_components


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(values, radius):
    """Least index of each value's group, by comparing all pairs."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if bin((a ^ values[j]) & (2**64 - 1)).count("1") <= radius:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


def chained(count, size, seed):
    """Fingerprints in chains of near ones, some far longer than the radius."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        value = int(rng.integers(0, 2**63))
        for _ in range(size):
            for bit in rng.integers(0, 64, rng.integers(1, 6)):
                value ^= 1 << int(bit)
            out.append(value)
    return list(dict.fromkeys(v - 2**64 if v >= 2**63 else v for v in out))


def test_fingerprints():
    for text in ["a", "a b c", "A b C d e", "x y z", "É é", None, "", " \r\n", "w " * 70_000, "a a a a a"]:
        assert simhash.fingerprint(text) % 2**64 == slow_fingerprint(text)


def test_trees_find_all_pairs():
    rng = np.random.default_rng(1)
    values = np.unique(np.array(chained(20, 12, 4), np.int64).view(np.uint64))
    cells = np.sort(rng.integers(0, 3, len(values)))
    forest, found = simhash.Forest(values, cells), set()
    for query, node in forest.search(values, cells, 4):
        found |= set(zip(query.tolist(), node.tolist()))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    assert found == set(zip(*np.nonzero(near & (cells[:, None] == cells[None, :]))))


def test_links_with_small_shards_lose_nothing(spark):
    values = chained(12, 40, 2)
    want = slow_groups(values, 4)
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    for shard in (5, 1024):
        parts = {r.node: r.root for r in connected_components(simhash.links(distinct, 4, shard)).collect()}
        mine = [parts.get(v, v) for v in values]
        assert len(set(zip(mine, want))) == len(set(want)) == len(set(mine))


def test_every_plan_covers_the_radius():
    for count in (10, 10**7, 10**10, 10**14):
        blocks, tables = simhash.shard_plan(count, 4)
        assert sum(w for _, w in blocks) == 64
        covered = [set(t) for t in tables]
        for hit in ((0, 1, 2, 3), tuple(range(len(blocks)))[-4:], (0, 2, 4, 5)):
            assert any(not c & set(hit) for c in covered)


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 900), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in connected_components(chain).collect()}
    assert roots == {i: 0 for i in range(201)} | {900: 900, 901: 900}


def test_odd_rows(spark):
    rows = simhash.near_duplicates(odd_documents(spark)).collect()
    assert len(rows) == len(ROWS)
    got = sorted((str(r.doc_id), r.component_id) for r in rows)
    assert got == sorted([("1", 1), ("1", 1), ("2", 1), ("3", 3), ("4", 3), ("5", 3), ("6", 6), ("7", 7), ("None", None)])
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_one_row_of_each_group_is_kept(spark):
    df = odd_documents(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "6", "7", "None"]
    assert simhash.keep_one(no_documents(spark)).count() == 0


def test_query_agrees_with_all_pairs(spark, sf):
    from corpusloom.llm.queries import all_queries

    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    values = [slow_fingerprint(r.text) for r in docs]
    want = {docs[i].doc_id: (f"{values[i]:016x}", docs[g].doc_id) for i, g in enumerate(slow_groups(values, 4))}
    rows = all_queries()["op2_simhash_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want


def test_written_digits(spark):
    row = spark.range(1).select(simhash.as_hex(F.lit(-1).cast("bigint")), simhash.as_hex(F.lit(10).cast("bigint"))).first()
    assert tuple(row) == ("f" * 16, "0" * 15 + "a")
