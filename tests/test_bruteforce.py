"""Distributed operators against plain loops, and the same result for any partitioning."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import unicode
from corpusloom.operators import examples as ex
from corpusloom.operators import metrics, models, streams, svd, tokenize, vectors, vocabulary
from corpusloom.operators import vectors as vectors_module
from corpusloom.plans import blocks, lookup
from corpusloom.plans.lookup import lookup_array
from corpusloom.plans.ranking import average_ranks, top_ranked, with_prefix, with_row_number


def test_prefix_totals(spark):
    rnd = random.Random(1)
    values = [rnd.randint(0, 9) for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(values)), "k bigint, v bigint").repartition(13)
    rows = with_prefix(df, [F.col("k")], {"s": ("sum", "v"), "m": ("max", "v")}).orderBy("k").collect()
    total, best = 0, None
    for row, v in zip(rows, values):
        assert (row["s"], row["m"]) == (total, best)
        total, best = total + v, v if best is None else max(best, v)
    numbers = with_row_number(df, [F.col("k").desc()], "n").orderBy("k").collect()
    assert [r["n"] for r in numbers] == list(range(4999, -1, -1))


def test_top_ranked_breaks_ties_by_key(spark):
    counts = spark.createDataFrame([(f"t{i:03}", i % 3) for i in range(300)], "token string, freq bigint")
    rows = top_ranked(counts, 150, "freq", "token").orderBy("id").collect()
    want = sorted(((-(i % 3), f"t{i:03}") for i in range(300)))[:150]
    assert [r["token"] for r in rows] == [t for _, t in want]


def test_average_ranks(spark):
    df = spark.createDataFrame([(x,) for x in [3.0, 1.0, 3.0, 2.0, 3.0]], "x double")
    got = sorted((r["x"], r["rank_x"]) for r in average_ranks(df, ["x"]).collect())
    assert got == [(1.0, 1.0), (2.0, 2.0), (3.0, 4.0), (3.0, 4.0), (3.0, 4.0)]


@pytest.mark.parametrize("default", [None, -1])
def test_lookup_forms_agree(spark, default):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice("aaaaaaaaabcdxyz-") for _ in range(rnd.randint(0, 9))]) for i in range(200)]
    rows = [(i, [None if t == "-" else t for t in ts]) for i, ts in rows] + [(200, None), (201, []), (202, [None])]
    df = spark.createDataFrame([(ts, i) for i, ts in rows], "ts array<string>, k bigint").repartition(5)
    # The least value of a key counts; NULL keys and values are no entries.
    entries = [(c, i, 10 - i) for i, c in enumerate("abcd")] + [("a", 7, 1), (None, 3, 1), ("y", None, 1)]
    table = spark.createDataFrame(entries, "token string, id bigint, freq bigint")
    ids = dict(zip("abcd", range(4)))
    want = {k: [ids.get(t, default) for t in ts or [] if default is not None or t in ids] for k, ts in rows}
    for max_rows in (100, 2):
        for weight in ("freq", None):
            got = lookup_array(df, "ts", "ids", table, "token", "id", ["k"], default, weight, max_rows=max_rows)
            assert got.columns == ["ts", "k", "ids"]
            assert {r["k"]: r["ids"] for r in got.collect()} == want
    empty = table.filter("false")
    assert {r["k"]: r["ids"] for r in lookup_array(df, "ts", "ids", empty, "token", "id", ["k"], default).collect()} == {
        k: [default] * len(ts or []) if default is not None else [] for k, ts in rows
    }


def test_block_matches_agree(spark, monkeypatch):
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(40, 5)), rng.normal(size=(70, 5))
    c[10] = c[20]
    frame = lambda m, name: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} bigint, vec array<double>")
    queries, candidates = frame(q, "query_id"), frame(c, "candidate_id")
    scores = np.round(q @ c.T, 9)
    want = {(i, r + 1): int(j) for i in range(40) for r, j in enumerate(np.lexsort((np.arange(70), -scores[i]))[:3])}
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    for max_shipped in (100, 50, 5):
        best = blocks.best_matches(queries.repartition(3), candidates.repartition(4), 3, max_shipped).collect()
        assert {(r["query_id"], r["rank"]): r["candidate_id"] for r in best} == want
        assert blocks.best_matches(queries, candidates.filter("false"), 3, max_shipped).count() == 0


def test_repeated_and_odd_analogy_lines(spark):
    words = {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [1.0, 1.0], "d": [-1.0, 1.0], "e": [0.5, 1.0]}
    vectors = spark.createDataFrame([(w, v) for w, v in words.items()], "key string, vec array<double>")
    lines = [("a", "b", "c", "e"), ("a", "b", "zz", "d"), (None, None, None, "c")]
    schema = "a string, b string, c string, d string"
    unit = {w: np.array(v) / np.linalg.norm(v) for w, v in words.items()}

    def right(a, b, c, d):
        asked = [unit.get(w, np.zeros(2)) for w in (a, b, c)]
        query = asked[1] + asked[2] - asked[0]
        query = query / (np.linalg.norm(query) or 1.0)
        ranked = sorted(unit, key=lambda w: (-round(float(unit[w] @ query), 9), w))
        return d in ranked[1:3]

    want = sum(right(*line) for line in lines)
    for times in (1, 2):
        got = vectors_module.analogy_accuracy(spark.createDataFrame(lines * times, schema), vectors, 2, n=2).first()
        assert (got["correct"], got["total"]) == (want * times, 3 * times)
    vocab = vectors.withColumn("id", F.ascii("key") - 97)
    once = vectors_module.analogy_accuracy_3cosadd(spark.createDataFrame(lines[:2], schema), vocab).first()
    twice = vectors_module.analogy_accuracy_3cosadd(spark.createDataFrame(lines[:2] * 2, schema), vocab).first()
    assert (twice["correct"], twice["total"]) == (2 * once["correct"], 4)


def test_unknown_words_stay_in_the_sample(spark):
    vectors = spark.createDataFrame([("a", [3.0, 0.0], 0), ("b", [1.0, 1.0], 1)], "key string, vec array<double>, id int")
    pairs = spark.createDataFrame([("a", "b", 1.0), ("a", "zz", 2.0), ("b", "b", 3.0)], "word_1 string, word_2 string, score double")
    zero = [r["predicted"] for r in vectors_module.predicted_similarity(pairs, vectors).orderBy("score").collect()]
    first = [r["predicted"] for r in vectors_module.predicted_similarity(pairs, vectors, "first").orderBy("score").collect()]
    assert zero == pytest.approx([0.5**0.5, 0.0, 1.0], abs=1e-8) and first == pytest.approx([0.5**0.5, 1.0, 1.0], abs=1e-8)
    assert vectors_module.word_similarity_corr(pairs, vectors).first()["n_unknown"] == 1


def test_stream_windows(spark):
    rnd = random.Random(5)
    docs = []
    for d in range(60):
        sizes = [rnd.choice([1, 2, 5, 9, 40]) for _ in range(rnd.randint(1, 8))]
        docs.append((d, "s", [rnd.randint(10, 99) for _ in range(sum(sizes))], sizes))
    df = spark.createDataFrame(docs, "doc_id bigint, source string, ids array<bigint>, sizes array<int>").repartition(7)
    stream = streams.sentence_stream(df, "source", "doc_id", seed=1)
    flat = [x for _, _, ids, _ in docs for x in [*ids, 7]]
    runs = [s for _, _, _, sizes in docs for s in [*sizes[:-1], sizes[-1] + 1]]
    edges = np.concatenate([[0], np.cumsum(runs)])
    starts, ends = np.repeat(edges[:-1], runs), np.repeat(edges[1:], runs)
    block_table, steps = streams.batchify(stream, 3, 64)
    assert steps == len(flat) // 3
    windows = streams.segment_pair_windows(block_table, steps, 24, 8, 64, 9).collect()
    room, seen = 24 - 8 - 3, {}
    for r in windows:
        ids = flat[r["row"] * steps : (r["row"] + 1) * steps]
        edges_of = {int(s) - r["row"] * steps for s in starts[r["row"] * steps : (r["row"] + 1) * steps]} | {0}
        begin, a, b = r["window"] * 8 + 8, r["a"], r["b"]
        seen.setdefault(r["row"], set()).add(r["window"])
        assert r["inp"] == ids[begin - 8 : begin] and r["target"] == ids[begin - 7 : begin + 1]
        assert a == ids[begin : begin + len(a)] and r["a_target"] == ids[begin + 1 : begin + 1 + len(a)]
        assert a and b and len(a) + len(b) == room and r["b_target"][:-1] == b
        # B begins with a sentence; with label 1 the one that A's last sentence is followed by.
        places = [s for s in edges_of if ids[s : s + len(b) + 1] == r["b_target"]]
        assert places
        if r["label"] == 1:
            assert any(begin + len(a) <= s < begin + room for s in places)
    for row, numbers in seen.items():
        fits = [w for w in range(steps) if w * 8 + 24 <= steps and w * 8 + 8 + room < steps]
        assert numbers == set(fits)
    assert {r["label"] for r in windows} == {0, 1} and len(seen) == 3
    joint = streams.seq_features_joint(streams.segment_pair_windows(block_table, steps, 24, 8, 64, 9))
    assert all(len(r["input"]) == len(r["target"]) == len(r["seg_id"]) == 24 for r in joint.collect())


def test_truncation_matches_one_by_one(spark):
    cases = [(a, b, m) for a in range(1, 14) for b in range(1, 14) for m in (5, 6, 9)]
    df = spark.createDataFrame(cases, "a bigint, b bigint, m bigint")
    na, nb = ex.truncated_lengths(F.col("a"), F.col("b"), F.col("m"))
    for row in df.select("*", na.alias("na"), nb.alias("nb")).collect():
        a, b = row["a"], row["b"]
        while a + b > row["m"]:
            if a > b:
                a -= 1
            else:
                b -= 1
        assert (row["na"], row["nb"]) == (a, b)


def test_examples_do_not_depend_on_partitions(spark):
    rnd = random.Random(6)
    docs = []
    for d in range(80):
        sizes = [rnd.randint(1, 30) for _ in range(rnd.randint(1, 9))]
        docs.append((d, [rnd.randint(5, 99) for _ in range(sum(sizes))], sizes))
    df = spark.createDataFrame(docs, "doc_id bigint, ids array<bigint>, sizes array<int>")
    results = []
    for parts in (1, 8):
        rows = ex.masked_pair_examples(df.repartition(parts), 100, 32, 5, copies=2).collect()
        results.append(sorted(tuple(map(str, r)) for r in rows))
        for r in rows:
            assert len(r["input_ids"]) == len(r["input_mask"]) == len(r["segment_ids"]) == 32
            assert len(r["masked_lm_positions"]) == len(r["masked_lm_ids"]) == len(r["masked_lm_weights"]) == 5
    assert results[0] == results[1]


def test_span_mask_reaches_its_goal(spark):
    rnd = random.Random(7)
    rows = [(i, [rnd.random() < 0.7 for _ in range(n)]) for i, n in enumerate([5, 30, 128, 128, 128])]
    df = spark.createDataFrame(rows, "k bigint, starts array<boolean>")
    for reverse in (False, True):
        masked = streams.span_mask(df, ["k"], goal=20, reverse=reverse).collect()
        assert [sum(r["is_masked"]) for r in sorted(masked)] == [5, 20, 20, 20, 20]
        assert all(len(r["is_masked"]) == len(r["starts"]) for r in masked)
    free = streams.span_mask(df, ["k"]).collect()
    assert sum(sum(r["is_masked"]) for r in free) > 0


def test_joint_permutation_mask(spark):
    df = spark.createDataFrame([([[0, 1], [0, 0]], [[1]])], "a array<array<int>>, b array<array<int>>")
    got = df.select(streams.joint_permutation_mask(F.col("a"), F.col("b")).alias("m")).head()["m"]
    assert got == [[0, 1, 1], [0, 0, 1], [0, 0, 1]]


def test_svd_gives_scaled_left_vectors(spark):
    rng = np.random.default_rng(8)
    dense = rng.normal(size=(30, 12)) * (rng.random((30, 12)) < 0.6)
    cells = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    df = spark.createDataFrame(cells, "row_id bigint, col_id bigint, value double")
    rows = {r["row_id"]: r["vec"] for r in models.truncated_svd(df, 12, 4).collect()}
    got = np.array([rows[i] for i in range(30)])
    sigma = np.linalg.svd(dense, compute_uv=False)[:4]
    gram = got.T @ got
    assert np.allclose(np.sqrt(np.diag(gram)), sigma, atol=1e-6)
    assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-6)


@pytest.mark.parametrize("block,fan_in", [(1024, 16), (7, 2)])
def test_svd_in_blocks_and_a_tree(spark, monkeypatch, block, fan_in):
    monkeypatch.setattr(svd, "BLOCK", block)
    monkeypatch.setattr(svd, "FAN_IN", fan_in)
    rng = np.random.default_rng(9)
    dense = rng.normal(size=(80, 5)) @ rng.normal(size=(5, 50)) * 3 + rng.normal(size=(80, 50)) * 0.01
    dense[rng.random(80) < 0.1] = 0
    dense[:, 11] = 0
    cells = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    df = spark.createDataFrame(cells, "row_id bigint, col_id bigint, value double")
    rows = {r["row_id"]: r["vec"] for r in models.truncated_svd(df, 50, 5).collect()}
    left, sigma, right = np.linalg.svd(dense, full_matrices=False)
    right = right[:5] * np.sign(right[np.arange(5), np.abs(right[:5]).argmax(axis=1)])[:, None]
    assert np.allclose(np.array([rows[i] for i in sorted(rows)]), (dense @ right.T)[sorted(rows)], atol=1e-5)
    assert models.truncated_svd(df.filter("false"), 50, 5).count() == 0
    rank_one = models.truncated_svd(df.filter("col_id = 3"), 50, 5).collect()
    assert np.allclose([r["vec"][0] for r in rank_one], [dense[r["row_id"], 3] for r in rank_one], atol=1e-6)


def test_query_vector_and_ranks(spark):
    table = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [1.0, 1.0]), ("d", [-1.0, 0.0])], "key string, vec array<double>"
    )
    assert vectors.query_vector(spark, ["a", "b", "zz"], table) == pytest.approx([1 / 3, 1 / 3])
    best = vectors.most_similar(table, vectors.query_vector(spark, ["a", "b"], table), 2).orderBy("rank").collect()
    assert [r["key"] for r in best] == ["a", "b"]


def test_zero_vectors(spark):
    table = spark.createDataFrame([("a", [3.0, 4.0])], "key string, vec array<double>")
    df = spark.createDataFrame([(1, ["a", "x"]), (2, ["x"]), (3, [])], "k int, tokens array<string>")
    bow = {r["k"]: r["vec"] for r in vectors.sentence_bow_vector(df, table, ["k"]).collect()}
    assert bow == {1: pytest.approx([0.6, 0.8]), 2: [0.0, 0.0], 3: [0.0, 0.0]}
    mean = {r["k"]: r["vec"] for r in vectors.sentence_mean(df, table, ["k"]).collect()}
    assert mean == {1: pytest.approx([0.3, 0.4]), 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_running_metrics(spark):
    losses = [0.5, 1.5, 1.0, 2.0]
    df = spark.createDataFrame(list(enumerate(losses)), "step bigint, loss double").repartition(3)
    got = [r["perplexity"] for r in metrics.running_perplexity(df).orderBy("step").collect()]
    assert got == pytest.approx([np.exp(np.mean(losses[: i + 1])) for i in range(4)])
    scores = spark.createDataFrame([(1, 0.4), (2, 0.3), (3, 0.5), (4, 0.5)], "step bigint, score double")
    assert [r["step"] for r in metrics.best_checkpoints(scores).orderBy("step").collect()] == [1, 3]


def test_encode_wrappers(spark):
    df = spark.createDataFrame([([5, 6],)], "ids array<int>")
    row = df.select(
        vocabulary.wrap_sentence(F.col("ids"), 1, 0).alias("f"),
        vocabulary.wrap_sentence(F.col("ids"), 1, 0, reverse=True).alias("r"),
        vocabulary.shift_mask_ids(F.col("ids"), 4).alias("s"),
    ).head()
    assert (row["f"], row["r"], row["s"]) == ([1, 5, 6, 0], [0, 6, 5, 1], [6, 7, 0, 0])


def test_wordpiece_forms_agree(spark):
    pieces = ["un", "##aff", "##able", "a", "##c", "ab", "##b", "é", "##漢字"]
    rows = [(1, ["unaffable", "abc", "zzz", None, "", "é漢字"], "x"), (1, [], "y"), (2, None, "z"), (3, ["a" * 201, "abcb"], "w")]
    df = spark.createDataFrame(rows, "k bigint, tokens array<string>, pieces_ string")
    vocab = spark.createDataFrame([(p,) for p in [*pieces, "un"]], "token string")
    want = [["un", "##aff", "##able", "ab", "##c", "é", "##漢字"], [], [], ["[UNK]", "ab", "##c", "##b"]]
    for max_rows in (100, 1):
        got = tokenize.wordpiece(df, vocab, max_rows=max_rows).orderBy("k", "pieces_").collect()
        assert [r["pieces"] for r in got] == want


def test_similarity_chart_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(f"k{i}", v.tolist()) for i, v in enumerate(rng.normal(size=(30, 4)))]
    df = spark.createDataFrame(rows, "key string, vec array<double>")
    whole = {(r["x"], r["y"]): r["score"] for r in vectors_module.sampled_pairwise_cosine(df, 20).collect()}
    monkeypatch.setattr(vectors_module, "PAIR_BLOCK", 6)
    cut = {(r["x"], r["y"]): r["score"] for r in vectors_module.sampled_pairwise_cosine(df, 20).collect()}
    assert len(whole) == 400 and whole == cut


def test_a_block_asks_once(spark):
    rows = [(i, [f"t{(i * j) % 9}" for j in range(i % 7)] + [None] if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, ts array<string>").coalesce(1)
    asked = lookup._distinct_elements(lookup._in_blocks(df, "ts", 24), "ts", df.schema["ts"].dataType.elementType).collect()
    assert len(asked) == len(set(asked)) and 9 < len(asked) < df.selectExpr("explode(ts)").count()


def test_vectors_move_once_per_block(spark, monkeypatch):
    """The joined sums equal those in place: rows of equal keys, NULLs, repeated words, words without a vector."""
    monkeypatch.setattr(vectors, "BLOCK_ELEMENTS", 40)
    rows = [(i // 3, [f"t{(i * j) % 9}" for j in range(i % 7)] + [None] if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, tokens array<string>").repartition(3)
    table = spark.createDataFrame([(f"t{i}", [i + 0.5, float(-i), 1.0]) for i in range(7)], "key string, vec array<double>")
    want, got = (
        sorted(str((r.k, r.vec, r.known, r.total)) for r in vectors.sum_word_vectors(df, table, ["k"], max_words=n).collect()) for n in (100, 2)
    )
    assert got == want and len(got) == 60
    plan = vectors.sum_word_vectors(df, table, ["k"], max_words=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Summarizer" not in plan


def test_a_large_table_meets_blocks_of_rows(spark, monkeypatch):
    """Rows keep their own arrays, nested values too, and no element moves as a row of its own; rows of one key share theirs."""
    monkeypatch.setattr(lookup, "BLOCK_ELEMENTS", 40)
    rows = [(i, [f"t{(i * j) % 9}" for j in range(i % 7)] + [None] if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, ts array<string>").repartition(3)
    table = spark.createDataFrame([(f"t{i}", [f"a{i}", "b"][: i % 3]) for i in range(8)], "token string, parts array<string>")
    want, got = (
        sorted(str((r.k, r.ts, r.out)) for r in lookup_array(df, "ts", "out", table, "token", "parts", ["k"], None, None, True, n).collect())
        for n in (100, 2)
    )
    assert got == want and len(got) == 60
    plan = lookup_array(df, "ts", "out", table, "token", "parts", ["k"], nested=True, max_rows=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    few = spark.createDataFrame([(1, ["a", "b"]), (1, ["b"]), (2, ["a", "c"]), (None, ["a"])], "k long, ts array<string>")
    ids = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id long")
    shared = lookup_array(few, "ts", "ids", ids, "token", "id", ["k"], -1, max_rows=1).collect()
    assert sorted((r.k or 0, r.ids) for r in shared) == [(0, []), (1, [1, 2, 2]), (1, [1, 2, 2]), (2, [1, -1])]


def test_spacing_against_a_walk_over_the_characters(spark, monkeypatch):
    """Both forms of the model, rows of one key, NULLs, blanks, single characters and characters beyond the basic plane."""
    monkeypatch.setattr(tokenize, "BYTES_AT_ONCE", 64)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abc가나 \t\U0001f600́") for _ in range(rnd.randint(0, 30))) for _ in range(150)] + [None, " ", "a", " a b ", "\n"]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "k long, text string").repartition(4)
    units = [re.findall("[^ ] ?", " ".join((t or "").split())) for t in texts]
    tally = {}
    for u in units:
        for i in range(len(u) - 1):
            context = (u[i - 1][0] if i else "") + u[i][0] + " " + "".join(x[0] for x in u[i + 1 : i + 3])
            spaced, total = tally.get(context, (0, 0))
            tally[context] = spaced + (len(u[i]) > 1), total + 1
    model = tokenize.train_spacing(df)
    assert {r.context: (r.spaced, r.total) for r in model.collect()} == tally
    want = []
    for i, u in enumerate(units):
        if u:
            marks = [tally.get((u[j - 1][0] if j else "") + u[j][0] + " " + "".join(x[0] for x in u[j + 1 : j + 3]), (0, 0)) for j in range(len(u) - 1)]
            out = [x if total < 3 else x[0] + " " * (spaced / total >= 0.5) for x, (spaced, total) in zip(u, marks)] + [u[-1][0]]
            want.append((i // 2, texts[i], "".join(out)))
    for most in (10_000, 2):
        got = tokenize.apply_spacing(df, model, ["k"], min_total=3, max_rows=most)
        assert got.columns == ["k", "text", "corrected"]
        assert sorted((r.k, r.text, r.corrected) for r in got.collect()) == sorted(want)


def test_batches_are_worked_on_in_parts(monkeypatch):
    """A batch bounds rows only: long ones are taken in parts, and nothing is lost or moved between rows."""
    monkeypatch.setattr(lookup, "ELEMENTS_AT_ONCE", 40)
    lists = pa.array([list(range(i % 23)) if i % 4 else None for i in range(90)], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(90)), lists], names=["k", "ids"])
    parts = list(lookup.in_parts(iter([batch, batch.slice(0, 0), batch.slice(7, 3)]), 1))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist() + batch.slice(7, 3).to_pylist()
    assert max(len(p.column(1).flatten()) for p in parts) <= 40 + 23 and len(parts) > 20
    monkeypatch.setattr(unicode, "BYTES_AT_ONCE", 10)
    texts = ["abc", None, "é" * 9, "", "z" * 30, "Å"] * 5
    got = unicode._each(pa.array(texts), lambda t: t.upper() if not t.isascii() else t, pc.string_is_ascii)
    assert got.to_pylist() == [t if t is None or t.isascii() else t.upper() for t in texts]
    assert unicode._each(pa.array([], pa.string()), str).to_pylist() == []


def test_drawn_places_move_without_their_windows(spark):
    """Windows are written once; what draws segment B sees no tokens of theirs."""
    from corpusloom.operators import streams

    rows = [(r, b, [r * 1000 + i for i in span], [i // 5 * 5 for i in span], [i // 5 * 5 + 5 for i in span])
            for r in range(2) for b in range(4) for span in [range(b * 64, min(b * 64 + 64, 200))]]
    blocks = spark.createDataFrame(rows, "row long, block long, ids array<bigint>, starts array<bigint>, ends array<bigint>")
    found = streams.segment_pair_windows(blocks, 200, 24, 8, 64)
    assert "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    assert len({(w.row, w.window) for w in got}) == len(got) and {w.label for w in got} == {0, 1}
    for w in got:
        assert w.inp == [w.row * 1000 + w.window * 8 + i for i in range(8)]
        assert w.b == list(range(w.b[0], w.b[0] + len(w.b))) and w.b_target[0] == w.b[0] and len(w.a) + len(w.b) <= 13
        assert w.label == 0 or w.b[0] > w.a[-1]
