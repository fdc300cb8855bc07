"""Pair vectors: the loss and its slope by hand, planted structure, and the same vectors for any blocks' order."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import pairs
from corpusloom.operators.models import infer_tag_vectors, train_tag_vectors, train_word2vec


def planted(spark, groups=4, each=12, seed=3):
    """Words of one group are seen together often, words of two groups hardly ever."""
    draw = random.Random(seed)
    n, rows = groups * each, []
    for i in range(n):
        for j in range(n):
            same = i % groups == j % groups
            if draw.random() < (0.9 if same else 0.15):
                rows.append((i, j, float(draw.randrange(20, 60) if same else draw.randrange(1, 4))))
    return n, rows, spark.createDataFrame(rows, "row_id long, col_id long, value double")


def dense_loss(n, rows, x, y):
    """The objective over all cells, unseen ones included, from its definition."""
    counts = np.zeros((n, n))
    for i, j, v in rows:
        counts[i, j] = v
    level = math.log(counts.sum() + 1) - np.log1p(counts.sum(1))[:, None] - np.log1p(counts.sum(0))[None, :]
    error = x @ y.T - level
    seen = counts > 0
    return (np.log1p(np.exp(error)) * ~seen).sum() + 0.5 * (np.sqrt(counts) * (error - np.log(np.where(seen, counts, 1))) ** 2 * seen).sum()


def matrices(found, n):
    got = {(r.side, r.id): r.vec for r in found.collect()}
    assert len(got) == 2 * n
    return [np.array([got[s, i] for i in range(n)]) for s in ("row", "column")]


def test_slopes_follow_from_the_loss():
    draw = np.random.default_rng(0)
    product = draw.normal(size=(3, 4))
    margins = pairs.Margins(np.array([9.0, 4.0, 300.0]), np.array([1.0, 5.0, 7.0, 400.0]), 413.0, 99.0)
    at, count = (np.array([0, 2]), np.array([1, 3])), np.array([5.0, 300.0])
    for objective in (pairs.Association(0.5, 2.0, 0.5), pairs.LogCount(), pairs.SkipGram(3.0)):
        slope, loss = objective.slope(product, margins, at, count)
        for i in range(3):
            for j in range(4):
                moved = product.copy()
                moved[i, j] += 1e-6
                assert (objective.slope(moved, margins, at, count)[1] - loss) / 1e-6 == pytest.approx(slope[i, j], abs=1e-3)


@pytest.mark.parametrize("block", [4096, 13])
def test_planted_groups_are_found(spark, block):
    n, rows, cells = planted(spark)
    first, _ = pairs.factorize_pairs(cells, n, n, 8, 0, block=block)
    found, losses = pairs.factorize_pairs(cells, n, n, 8, 5 if block > n else 3, block=block, sweeps=5)
    x, y = matrices(found, n)
    assert losses[-1] < losses[0] and all(b < 1.05 * a for a, b in zip(losses, losses[1:]))
    assert dense_loss(n, rows, x, y) < 0.5 * dense_loss(n, rows, *matrices(first, n))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T - 2 * np.eye(n)
    assert np.mean([near[i].argmax() % 4 == i % 4 for i in range(n)]) > 0.95


def test_unseen_pairs_are_held_down(spark):
    n, rows, cells = planted(spark)
    found, _ = pairs.factorize_pairs(cells, n, n, 8, 4, sweeps=10)
    x, y = matrices(found, n)
    product, seen = x @ y.T, np.zeros((n, n), bool)
    for i, j, _ in rows:
        seen[i, j] = True
    other = np.arange(n)[:, None] % 4 != np.arange(n)[None, :] % 4
    assert product[~seen & other].mean() < product[seen & ~other].mean() - 1


def test_log_counts_with_biases(spark):
    n, rows, cells = planted(spark)
    found, losses = pairs.factorize_pairs(cells, n, n, 8, 4, objective=pairs.LogCount(), sweeps=20)
    assert losses[-1] < 0.2 * losses[0]
    x, _ = matrices(found, n)
    assert x.shape == (n, 8)


def test_any_partitioning_gives_the_same_vectors(spark):
    n, _, cells = planted(spark)
    one, losses = pairs.factorize_pairs(cells, n, n, 4, 2, block=20)
    two, again = pairs.factorize_pairs(cells.repartition(7), n, n, 4, 2, block=20)
    assert losses == again and sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_uneven_sides_and_empty_cells(spark):
    cells = spark.createDataFrame([(0, 0, 3.0), (6, 1, 0.0), (2, 9, 5.0)], "row_id long, col_id long, value double")
    found, losses = pairs.factorize_pairs(cells, 7, 2, 3, 2, block=2)
    assert {(r.side, r.id) for r in found.collect()} == {("row", i) for i in range(7)} | {("column", i) for i in range(2)}
    empty, _ = pairs.factorize_pairs(cells.filter("false"), 3, 3, 2, 1)
    assert empty.filter(F.size("vec") == 2).count() == 6


def test_word_vectors_find_planted_contexts(spark):
    """Words of one country share contexts, and so do words of one role: neighbours and analogies follow."""
    draw, docs = random.Random(8), []
    for _ in range(3000):
        place, role = draw.randrange(6), draw.choice("kq")
        around = [f"g{place}_{draw.randrange(5)}" for _ in range(3)] + [f"{role}ctx{draw.randrange(5)}" for _ in range(2)]
        draw.shuffle(around)
        docs.append((len(docs), [*around[:2], f"{role}{place}", *around[2:], f"once{len(docs)}"]))
    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    words = sorted({t for _, d in docs for t in d if not t.startswith("once")})
    vocab = spark.createDataFrame([(i, w, sum(d.count(w) for _, d in docs)) for i, w in enumerate(words)], "id long, token string, freq long")
    vecs = {r.key: np.array(r.vec) for r in train_word2vec(df, vocab, ["doc_id"], 16, 5, 20, block=20, sweeps=2).collect()}
    assert sorted(vecs) == words
    unit = {w: v / np.linalg.norm(v) for w, v in vecs.items()}

    def nearest(v, leave):
        return max((w for w in words if w not in leave), key=lambda w: unit[w] @ v / np.linalg.norm(v))

    assert all(nearest(unit[f"g{i}_{j}"], {f"g{i}_{j}"}).startswith(f"g{i}_") or nearest(unit[f"g{i}_{j}"], {f"g{i}_{j}"})[1:] == str(i) for i in range(6) for j in range(5))
    asked = [(i, j) for i in range(6) for j in range(6) if i != j]
    right = [nearest(unit[f"k{i}"] - unit[f"k{j}"] + unit[f"q{j}"], {f"k{i}", f"k{j}", f"q{j}"}) == f"q{i}" for i, j in asked]
    assert np.mean(right) > 0.8


def topical(seed, docs, names):
    """Documents of eight topics: two words in nine tell the topic, the others are common to all."""
    draw, rows = random.Random(seed), []
    for i in range(docs):
        topic = i % 8
        words = [f"t{topic}w{draw.randrange(12)}" if draw.random() < 0.22 else f"common{int(draw.paretovariate(0.8)) % 60}" for _ in range(25)]
        rows.append((i, f"{names}{i}", topic, words))
    return rows


def test_tag_vectors_tell_topics_and_new_documents(spark):
    rows, new = topical(1, 160, "a"), topical(2, 80, "b")
    schema = "doc_id long, tag string, topic int, tokens array<string>"
    words = sorted({w for _, _, _, d in rows for w in d})
    vocab = spark.createDataFrame([(i, w, sum(d.count(w) for _, _, _, d in rows)) for i, w in enumerate(words)], "id long, token string, freq long")
    trained, outputs = train_tag_vectors(spark.createDataFrame(rows, schema), vocab, ["doc_id"], 16, 4, sweeps=60)
    outputs = outputs.cache()
    inferred = infer_tag_vectors(spark.createDataFrame(new, schema), vocab, outputs, ["doc_id"], 16, 2, sweeps=60)
    held = {r.tag: np.array(r.vec) for r in trained.collect()}
    asked = {r.tag: np.array(r.vec) for r in inferred.collect()}
    assert len(held) == 160 and len(asked) == 80

    def share(held, asked):
        names = sorted(held)
        unit = np.array([held[n] / np.linalg.norm(held[n]) for n in names])
        topic = {t: k for _, t, k, _ in rows + new}
        return np.mean([topic[names[int((unit @ v).argmax())]] == topic[n] for n, v in asked.items()])

    assert share(held, asked) > 0.8  # one in eight by chance
    odd = spark.createDataFrame([(1, None, 0, ["common1"]), (2, "x", 0, None), (3, "y", 0, ["never"]), (4, "z", 0, ["common1"])], schema)
    assert [r.tag for r in infer_tag_vectors(odd, vocab, outputs, ["doc_id"], 16, 2).collect()] == ["z"]
