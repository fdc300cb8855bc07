"""Small hand-worked cases, most of them Hangul or special tokens the tables do not hold."""

import math
import random

from pyspark.sql import functions as F

from corpusloom.functions import hangul
from corpusloom.functions import text as tx
from corpusloom.functions.hashing import draw_of
from corpusloom.functions.unicode import decode_utf8, normalize_text, strip_accents
from corpusloom.operators import examples as ex
from corpusloom.operators import statistics as st
from corpusloom.operators import streams, tokenize, vectors, vocabulary
from corpusloom.sources import writers


def one(spark, value, column):
    return spark.createDataFrame([(value,)], ["x"]).select(column(F.col("x")).alias("y")).head()["y"]


def test_jamo(spark):
    assert one(spark, "한글 a", hangul.to_jamo) == "ㅎㅏㄴㄱㅡㄹ a"
    assert one(spark, "나", hangul.to_jamo) == "ㄴㅏ-"
    assert one(spark, "ㅋㅏ", hangul.to_jamo) == "ㅋ---ㅏ-"
    assert one(spark, "ㄴㅏ-ㅎㅏㄴ", hangul.from_jamo) == "나한"
    every = "".join(chr(c) for c in range(0xAC00, 0xD7A4))
    assert one(spark, every, lambda c: hangul.from_jamo(hangul.to_jamo(c))) == every


def test_cleaning(spark):
    assert one(spark, "a12", tx.space_digits) == ["a", "1", "2"]
    assert one(spark, ["don't."], tx.split_punct) == ["don", "'", "t", "."]
    assert one(spark, "A b. C! D", tx.split_sentences) == ["A b.", "C!", "D"]
    assert one(spark, "aaaaab", tx.collapse_repeats) == "aaab"
    assert one(spark, "중中文a", tx.space_cjk) == "중 中  文 a"
    assert one(spark, "a\u0000b​c\td e", tx.clean_control) == "abc d e"
    assert one(spark, " 　x y ", tx.strip) == "x y"
    assert one(spark, "see http://x.org/a?b=1 ''b'' ==T t== :en: __TOC__ x, )", tx.wiki_clean) == "see b x"
    assert one(spark, "x@y.org", tx.wiki_clean) == " "
    assert one(spark, "_x a* b: ;c 파일:q.png d", tx.wiki_tokens) == ["a", "b", "c", "d"]
    assert spark.range(1).select(tx.whitespace_tokens(F.lit(None).cast("string")).alias("y")).head()["y"] == []
    assert one(spark, ["▁2000,", "x,", ","], tx.cut_digit_comma) == ["▁2000", ",", "x,", ","]


def test_unicode_forms(spark):
    assert one(spark, "ÉcoleÑ한", strip_accents) == "ecolen\u1112\u1161\u11ab"
    assert one(spark, "  ``falsé''  ﬁ ", normalize_text) == '"false" fi'
    assert one(spark, "Ünï", lambda c: normalize_text(c, lower=True, keep_accents=True)) == "ünï"
    assert one(spark, bytearray(b"a\xffb\xc3"), decode_utf8) == "ab"


def test_wordpiece(spark):
    def cut(word, pieces):
        df = spark.createDataFrame([([word],)], ["tokens"])
        vocab = spark.createDataFrame([(p,) for p in pieces], ["token"])
        return tokenize.wordpiece(df, vocab).head()["pieces"]

    assert cut("unaffable", ["un", "##aff", "##able"]) == ["un", "##aff", "##able"]
    assert cut("abc", ["a", "##c"]) == ["a", "##c"]
    assert cut("x" * 201, ["x", "##x"]) == ["[UNK]"]
    assert cut("x" * 200, ["x", "##x"])[:2] == ["x", "##x"]


def test_pieces_to_wordpiece(spark):
    pieces = spark.createDataFrame([("▁", 0), ("▁x", 1), ("y", 2), ("<s>", 3)], ["piece", "rank"])
    rows = tokenize.pieces_to_wordpiece(pieces).orderBy("id").collect()
    assert [r["token"] for r in rows] == ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "x", "##y"]
    assert [r["id"] for r in rows] == list(range(7))


def test_cooccurrence_and_margins(spark):
    cells = st.cooccurrence_harmonic(spark.createDataFrame([([0, 1, 0],)], "ids array<bigint>"))
    values = {(r["row_id"], r["col_id"]): r["value"] for r in cells.collect()}
    assert values == {(0, 1): 2.0, (1, 0): 2.0, (0, 0): 3.0, (1, 1): 1.0}
    sums = {r["row_id"]: r["row_sum"] for r in st.marginals(cells).collect()}
    assert sums == {0: 5.0, 1: 3.0}


def test_linear_weights_count_gaps_as_distance(spark):
    cells = st.cooccurrence_linear(spark.createDataFrame([([0, -1, 1],)], "ids array<bigint>"), 3)
    values = {(r["row_id"], r["col_id"]): r["value"] for r in cells.collect()}
    assert set(values) == {(0, 1), (1, 0)} and math.isclose(values[0, 1], 2 / 3)


def test_vocab_sharded(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3), ("d", 1)], ["token", "freq"])
    kept = vocabulary.vocab_sharded(counts, 10, 2, 2).orderBy("id").collect()
    assert [r["token"] for r in kept] == ["a", "b"]


def test_encode_strict_fails_on_unknown(spark):
    import pytest

    df = spark.createDataFrame([(1, ["a", "z"])], "doc_id int, tokens array<string>")
    vocab = spark.createDataFrame([(0, "a")], "id bigint, token string")
    with pytest.raises(Exception, match="token not in the vocabulary: z"):
        vocabulary.encode_strict(df, vocab, ["doc_id"]).collect()


def test_classifier_inputs(spark):
    df = spark.createDataFrame([([10, 11],)], "ids array<bigint>")
    left = df.select(ex.features_left_pad(F.col("ids"), 6).alias("f")).head()["f"]
    assert left["input_ids"] == [0, 0, 10, 11, 4, 3]
    assert left["input_mask"] == [1, 1, 0, 0, 0, 0]
    assert left["segment_ids"] == [4, 4, 0, 0, 0, 2]
    right = df.select(ex.features_right_pad(F.col("ids"), 6).alias("f")).head()["f"]
    assert right["input_ids"] == [2, 10, 11, 3, 0, 0]
    assert right["input_mask"] == [1, 1, 1, 1, 0, 0]


def test_epoch_batches_of_64(spark):
    df = spark.range(64)
    batches = lambda how: ex.epoch_batches(df, 32, 1, 1, "id", how).select("batch_no").distinct().count()
    assert [batches(h) for h in ("drop_one", "drop", "keep")] == [1, 2, 2]


def test_masking_twenty_tokens(spark):
    ids = [2] + list(range(10, 28)) + [3]
    row = ex.mask_tokens(spark.createDataFrame([(1, ids)], "k bigint, ids array<bigint>"), 100, ["k"]).head()
    assert len(row["positions"]) == 3 and row["positions"] == sorted(row["positions"])
    assert not set(row["positions"]) & {0, 19}
    assert row["labels"] == [ids[p] for p in row["positions"]]


def test_attention_edges(spark):
    df = spark.createDataFrame([([[0.5, 0.5], [0.9, 0.1]],)], "m array<array<double>>")
    got = df.select(vectors.attention_edges(F.col("m")).alias("e")).head()["e"]
    want = [[-1.25, 0.0], [1.0, -1.25]]
    assert all(math.isclose(a, b, abs_tol=1e-9) for x, y in zip(got, want) for a, b in zip(x, y))


def test_start_pieces(spark):
    pieces = ["▁a", "b", "<sep>", ",", "ab,", "\\", "]"]
    df = spark.createDataFrame([(p,) for p in pieces], ["p"])
    flags = [r["s"] for r in df.select(streams.is_start_piece(F.col("p")).alias("s")).collect()]
    assert flags == [True, False, True, True, False, True, True]


def test_vocab_with_specials(spark):
    ranked = spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, token string")
    rows = writers.vocab_with_specials(ranked, ["<S>"]).orderBy("id").collect()
    assert [(r["id"], r["token"]) for r in rows] == [(0, "<S>"), (1, "a"), (2, "b")]


def test_char_ids(spark):
    got = one(spark, "é", lambda c: vocabulary.char_ids(c, 6))
    assert got == [259, 0xC3 + 1, 0xA9 + 1, 260, 261, 261]
    assert one(spark, "abcdef", lambda c: vocabulary.char_ids(c, 5)) == [259, 98, 99, 100, 260]


def test_cooccurrence_in_parts(spark, monkeypatch):
    """Parts cut inside rows, gaps, NULLs and ids too wide for one number give the sums of all pairs."""
    rng = random.Random(3)
    rows = [[rng.choice([-1, 0, 1, 2, 3, 9]) for _ in range(rng.randrange(40))] for _ in range(30)] + [None, [], [5, None, 5]]
    monkeypatch.setattr(st, "PAIRS_AT_ONCE", 64)
    for shift in (0, 1 << 40):
        ids = [[i + shift if i is not None and i >= 0 else i for i in r] if r is not None else None for r in rows]
        want = {}
        for row in ids:
            for p, a in enumerate(row or []):
                for d, b in enumerate((row[p:p + 11])):
                    if a is not None and b is not None and min(a, b) >= 0:
                        for cell in ((a, b), (b, a)):
                            want[cell] = want.get(cell, 0) + (1 / d if d else 0.5)
        found = st.cooccurrence_harmonic(spark.createDataFrame([(i,) for i in ids], "ids array<bigint>"))
        got = {(r.row_id, r.col_id): r.value for r in found.collect()}
        assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-9 for c in got)


def test_cooccurrence_is_shuffled_once(spark):
    cells = st.cooccurrence_harmonic(spark.createDataFrame([([0, 1, 0],)], "ids array<bigint>"))
    assert cells._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_shuffled_pairs_carry_a_number(spark):
    cells = spark.range(50).selectExpr("id % 7 AS row_id", "id AS col_id", "1.5D AS value")
    mixed = st.shuffle_pairs(cells, 5)
    rows = [(r.row_id, r.col_id) for r in mixed.collect()]
    assert rows == sorted(rows, key=lambda c: draw_of("5", *c)) and rows != sorted(rows)
    assert "conv(" in mixed._jdf.queryExecution().optimizedPlan().toString()


def test_cooc_shards_are_dealt_by_blocks(spark, tmp_path):
    cells = spark.range(3000).selectExpr("id AS row_id", "id * 7 % 11 AS col_id", "1.0D AS value")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_cooc_shards(cells, str(tmp_path / "shards"), 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "shards").rglob("*.parquet"))
    assert len(files) > 4
    blocks = []
    for file in files:
        rows = [(r.local_row, r.local_col) for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows)
        blocks += {r // writers.SHARD_ROWS for r, _ in rows}
    assert len(blocks) == len(set(blocks)) and spark.read.parquet(str(tmp_path / "shards")).count() == 3000


def test_sentence_sizes(spark):
    texts = ["A b. C d! e", " x.y z.  ", "...", "a b? c .", "", None, "\n\t", "a\x01b. c", "한글. 둘 셋!? 넷", "a.\n\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    full = F.filter(tx.split_sentences(F.col("t")), lambda p: p.rlike(f"[^{tx.WHITESPACE}]"))
    by_part = F.transform(full, lambda p: F.size(tx.whitespace_tokens(p)))
    rows = df.withColumn("tokens", tx.whitespace_tokens(F.col("t"))).select(tx.sentence_sizes(F.col("tokens")).alias("got"), by_part.alias("want"))
    found = [(r.got, r.want) for r in rows.collect()]
    assert [got for got, _ in found] == [want for _, want in found]
    assert found[0][0] == [2, 2, 1] and found[4][0] == found[5][0] == found[6][0] == []
