import numpy as np
from samples import ROWS, no_documents, odd_documents

from corpusloom.llm import quality


def slow_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    from collections import Counter

    count, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            marked |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked)]


def test_statistics():
    texts = ["a b a b a b", "a a a", "a a a a", "x", "", None, "l1\nl1\n\n \nl2 \nl1 ", "# $ <b> é漢 \x0b q", "r s t " * 400, ROWS[7][1]]
    for text in texts:
        assert quality.statistics_of(text)[:5] == slow_statistics(text)


def test_wide_vocabulary_needs_two_steps(monkeypatch):
    words = [f"w{i % 1_100_000}" for i in range(1_100_004)]
    assert quality.repeated_words(words) == 8


def test_list_finds_planted_conjunction():
    rng = np.random.default_rng(0)
    table = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = ((table["a"] > 0.7) & (table["b"] < 0.4)) | (table["c"] > 0.95)
    rules = quality.learn_list(table, bad)
    hit = np.zeros(len(bad), bool)
    for rule in rules:
        hit |= quality._covered(rule, table, len(bad))
    assert (hit == bad).mean() > 0.97 and all(1 <= len(r) <= 4 for r in rules)


def test_no_rule_without_both_classes():
    table = {"a": np.arange(10.0)}
    assert quality.learn_list(table, np.zeros(10, bool)) == []
    assert quality.learn_list({"a": np.empty(0)}, np.empty(0, bool)) == []


def test_odd_rows(spark):
    df = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (None, 0, "x"), (6, None, "x")], "doc_id long, quality int, text string")
    for rules in ([], quality.learn_rules(df, labels), quality.learn_rules(df, labels.filter("false"))):
        rows = quality.judge(df, rules).collect()
        assert len(rows) == len(ROWS)
        assert all(r.base_failed and not r.kept for r in rows)
    assert quality.judge(no_documents(spark), []).count() == 0


def test_column_and_array_forms_agree(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rules = [
        (quality.Condition("symbol_share", True, 0.01), quality.Condition("words", True, 100.0)),
        (quality.Condition("repeat_share", True, 0.3),), (quality.Condition("mean_word", False, 4.5),),
        (quality.Condition("dup_line_share", True, 0.01),), (quality.Condition("capital_share", True, 0.5),),
    ]
    rows = quality.judge(texts, rules).toPandas()
    numbers = {s: rows[s].to_numpy(float) for s in quality.STATISTICS}
    with np.errstate(all="ignore"):
        table = {n: np.nan_to_num(f(numbers), nan=0.0, posinf=0.0) for n, f in quality.FEATURES.items()}
    first = np.full(len(rows), np.nan)
    for number in range(len(rules) - 1, -1, -1):
        first[quality._covered(rules[number], table, len(rows))] = number
    assert np.array_equal(first, rows["rule"].to_numpy(float), equal_nan=True)


def test_query_keeps_good_documents(spark):
    from corpusloom.llm.queries import all_queries

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = all_queries()["op9_quality_rules"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == slow_statistics(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert np.mean([kept == (label == 1) for label, kept in judged]) > 0.97
