"""Trained pieces against a trainer that counts all pairs anew for every merge."""

import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.operators import pieces, tokenize


def plain_trainer(words, vocab_size, coverage=1.0, max_length=16):
    uses = Counter()
    for w, n in words.items():
        for c in "▁" + w:
            uses[c] += n
    ranked, seen, chars = sorted(uses.items(), key=lambda x: (-x[1], x[0])), 0, []
    for c, n in ranked:
        if seen >= coverage * sum(uses.values()):
            break
        chars.append(c)
        seen += n
    split = []
    for w, n in words.items():
        part = []
        for c in [*("▁" + w), None]:
            if c in chars:
                part.append(c)
            elif part:
                split.append((part, n))
                part = []
    made, banned, number = [], set(), {c: i for i, c in enumerate(chars)}
    while len(made) < vocab_size - 3 - len(chars):
        counts = Counter()
        for part, n in split:
            for a, b in zip(part, part[1:]):
                counts[a, b] += n
        able = [(-n, len(a + b), a + b, number[a], number[b], a, b) for (a, b), n in counts.items() if (a, b) not in banned and len(a + b) <= max_length]
        if not able:
            break
        *_, a, b = min(able)
        if a + b in number:
            banned.add((a, b))
            continue
        number[a + b] = len(number)
        made.append(a + b)
        for place, (part, n) in enumerate(split):
            out, i = [], 0
            while i < len(part):
                pair = part[i:i + 2] == [a, b]
                out.append(a + b if pair else part[i])
                i += 1 + pair
            split[place] = (out, n)
    return ["<unk>", "<s>", "</s>", *made, *chars]


def word_table(spark, words):
    return spark.createDataFrame(list(words.items()), "token string, freq long")


def drawn(seed, letters, size, most=9):
    draw = random.Random(seed)
    stems = ["".join(draw.choices(letters, k=draw.randrange(1, 5))) for _ in range(40)]
    return Counter({"".join(draw.choices(stems, k=draw.randrange(1, 4)))[:most]: draw.randrange(1, 60) for _ in range(size)})


@pytest.mark.parametrize("seed,letters,first,chains", [(1, "ab", 2, 3), (2, "abcde", 4, 20), (3, "abcdefghij", 64, 60_000), (4, "aab$.\\漢🎉", 8, 60_000)])
def test_same_pieces_as_a_plain_trainer(spark, monkeypatch, seed, letters, first, chains):
    monkeypatch.setattr(pieces, "FIRST_PAIRS", first)
    words = drawn(seed, letters, 250)
    got = pieces.learn_bpe(word_table(spark, words), 160, 1.0, most_chains=chains).orderBy("rank").collect()
    assert [r.piece for r in got] == plain_trainer(words, 160) and [r["rank"] for r in got] == list(range(len(got)))


def test_coverage_length_and_exhaustion(spark):
    words = drawn(5, "aaaaabbbbcccdde", 120) | Counter({"": 3, "aaaaaaaaaaaaaaaaaaaaaaaa": 50, "zaz": 1, "abz": 2})
    for size, coverage, longest in ((90, 0.97, 16), (60, 0.9, 3), (100_000, 0.999, 16)):
        got = pieces.learn_bpe(word_table(spark, words), size, coverage, longest).orderBy("rank").collect()
        assert [r.piece for r in got] == plain_trainer(words, size, coverage, longest)
    assert [r.piece for r in pieces.learn_bpe(word_table(spark, words).filter("false"), 50).collect()] == ["<unk>", "<s>", "</s>"]
    nulls = spark.createDataFrame([(None, 3), ("ab", 2)], "token string, freq long")
    assert "ab" in {r.piece for r in pieces.learn_bpe(nulls, 50, 1.0).collect()}


def test_a_repeated_spelling_is_made_once(spark):
    # "abc" can come from ab+c and from a+bc.
    words = Counter({"abcx": 50, "ab": 60, "zbc": 70, "bc": 40, "yabc": 30, "abcabc": 5})
    got = [r.piece for r in pieces.learn_bpe(word_table(spark, words), 60, 1.0).orderBy("rank").collect()]
    assert got == plain_trainer(words, 60) and len(set(got)) == len(got)


def test_trained_pieces_feed_a_vocabulary(spark):
    words = drawn(6, "abcdef", 200)
    trained = pieces.learn_bpe(word_table(spark, words), 120, 1.0)
    vocab = tokenize.pieces_to_wordpiece(trained)
    tokens = [r.token for r in vocab.orderBy("id").collect()]
    assert tokens[:5] == tokenize.SPECIALS and len(tokens) == 5 + trained.count() - 4
    cut = tokenize.wordpiece(spark.createDataFrame([([w for w in words if w],)], "tokens array<string>"), vocab)
    assert "[UNK]" not in cut.first()["pieces"]


def test_chains_are_maximal():
    pairs = np.array([5, 7, -1, 7, 7, 9, 5, -1])
    starts, ends = pieces._chains(pairs, np.array([5, 7]))
    assert (starts.tolist(), ends.tolist()) == ([0, 3, 6], [3, 6, 8])
