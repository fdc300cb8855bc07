"""Quality rules: decision lists learned from labelled statistics by sequential covering.

A rule is a conjunction of thresholds on a document's statistics and rejects what it covers. Rules are
found one after another: conditions are added while they raise the information gained on the growing
part of the labelled rows, then the last ones are dropped again while that helps on the pruning part.
Rows covered by a rule leave before the next one is sought. The list is short, readable, and is
applied as one chained Spark condition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import text_function

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]
FEATURES = {
    "words": lambda s: s["n_words"],
    "mean_word": lambda s: (s["word_chars"] - s["n_symbols"]) / s["n_words"],
    "symbol_share": lambda s: s["n_symbols"] / s["word_chars"],
    "repeat_share": lambda s: s["n_repeat_words"] / s["n_words"],
    "dup_line_share": lambda s: s["n_dup_lines"] / s["n_lines"],
    "capital_share": lambda s: s["n_capitals"] / s["word_chars"],
}


# ---- statistics


def repeated_words(words: list) -> int:
    """Words inside a window of three that occurs at least twice, the first occurrence included."""
    if len(words) < 4:
        return 0
    seen: dict = {}
    number = seen.setdefault
    ids = np.array([number(w, len(seen)) for w in words], np.int64)
    size = len(seen)
    pairs = ids[:-1] * size + ids[1:]
    if size >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    marked = np.zeros(len(ids), bool)
    marked[:-2] |= again
    marked[1:-1] |= again
    marked[2:] |= again
    return int(marked.sum())


def statistics_of(text: str | None) -> list[int]:
    """The values of ``STATISTICS`` for one text; all 0 for NULL."""
    if not text:
        return [0] * len(STATISTICS)
    raw = text.encode()
    words = raw.split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    octets = np.frombuffer(raw, np.uint8)
    return [
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(np.count_nonzero((octets - 65).astype(np.uint8) < 26)),
    ]


def document_statistics(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``id``, ``STATISTICS`` and the columns in ``keep`` for every row, over its whole text.

    Whatever names ``keep`` has, the statistics come first; the caller keeps the names apart.
    """
    kept = keep or []

    def work(texts):
        rows = [statistics_of(t) for t in texts]
        return [[r[i] for r in rows] for i in range(len(STATISTICS))]

    counted = text_function(work, ", ".join(f"{s} bigint" for s in STATISTICS))
    narrow = df.select(
        F.col(id_column).alias("id"), counted(F.col(text_column)).alias("s"),
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)],
    )
    return narrow.select("id", "s.*", *[f"k{i}" for i in range(len(kept))]).toDF(id_column, *STATISTICS, *kept)


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# ---- rules


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` if ``above``, else ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values >= self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        s = {name: F.nullif(F.col(name), F.lit(0)) if name in DIVISORS else F.col(name) for name in STATISTICS}
        value = F.coalesce(FEATURES[self.feature](s).cast("double"), F.lit(0.0))
        return value >= self.threshold if self.above else value <= self.threshold


DIVISORS = ("n_words", "word_chars", "n_lines")
Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for condition in rule:
        out &= condition.covers(table)
    return out


def _candidates(table: dict[str, np.ndarray], most: int = 128) -> list[tuple[Condition, float]]:
    """Midpoints between neighbouring values, each with the gap around it in standard deviations.

    If there are many, those at evenly spaced ranks and those of the widest gaps are taken.
    """
    out = []
    for name, values in table.items():
        distinct = np.unique(values)
        middles, gaps = (distinct[1:] + distinct[:-1]) / 2, np.diff(distinct) / (values.std() or 1.0)
        if len(middles) > most:
            even = np.linspace(0, len(middles) - 1, most // 2).astype(int)
            some = np.union1d(even, np.argsort(-gaps, kind="stable")[: most // 2])
            middles, gaps = middles[some], gaps[some]
        out += [(Condition(name, above, float(m)), float(g)) for m, g in zip(middles, gaps) for above in (True, False)]
    return out


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, longest: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < longest:
        here = {k: v[inside] for k, v in table.items()}
        p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
        if not n0 or not p0:
            break
        best, gain = None, (1e-9, 0.0)
        wrong = bad[inside]
        for condition, gap in _candidates(here):
            hit = condition.covers(here)
            p, n = int((hit & wrong).sum()), int((hit & ~wrong).sum())
            if p:
                g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                if (g, gap) > gain:  # of equal gains the one with more room around its threshold
                    best, gain = condition, (g, gap)
        if best is None:
            break
        rule += (best,)
        inside &= best.covers(table)
    return rule


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = _covered(r, table, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    shorter = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(shorter, key=lambda r: (worth(r), -len(r)))


def learn_list(
    table: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, longest: int = 4, most: int = 16
) -> list[Rule]:
    """Rules that reject ``bad`` rows, in order. Every third row of each class is held back for pruning.

    A rule must reach ``precision`` on the held-back rows it covers, or the list ends: good
    documents are kept in case of doubt. No rule is found where one class is missing.
    """
    held = np.zeros(len(bad), bool)
    for kind in (np.flatnonzero(bad), np.flatnonzero(~bad)):
        held[kind[2::3]] = True
    parts = []
    for mask in (~held, held):
        parts.append(({k: v[mask] for k, v in table.items()}, bad[mask]))
    (grow, grow_bad), (prune, prune_bad) = parts
    rules: list[Rule] = []
    while len(rules) < most and grow_bad.any():
        rule = _grow(grow, grow_bad, longest)
        if not rule:
            break
        rule = _prune(rule, prune, prune_bad)
        hit = _covered(rule, prune, len(prune_bad))
        if not hit.any() or prune_bad[hit].mean() < precision:
            break
        rules.append(rule)
        stay = ~_covered(rule, grow, len(grow_bad))
        grow, grow_bad = {k: v[stay] for k, v in grow.items()}, grow_bad[stay]
        prune, prune_bad = {k: v[~hit] for k, v in prune.items()}, prune_bad[~hit]
    return rules


def rejected(rules: list[Rule]) -> Column:
    """The list as one chained condition: the number of the first rule that fits, else NULL."""
    chain = None
    for number, rule in enumerate(rules):
        fits = rule[0].column()
        for condition in rule[1:]:
            fits = fits & condition.column()
        chain = F.when(fits, number) if chain is None else chain.when(fits, number)
    return F.lit(None).cast("int") if chain is None else chain


def learn_rules(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", sample: int = 20_000,
) -> list[Rule]:
    """A decision list for ``df`` from the labels 0 (bad) and 1 of its documents.

    At most ``sample`` labelled documents are learned from: those whose ids have the least hashes, without
    those that the base test rejects anyway. Conflicting labels of an id count as bad; NULL ids and
    NULL labels are left out.
    """
    known = (
        labels.select(F.col(id_column).alias("_key"), F.col(label_column).alias("_label"))
        .filter("_key IS NOT NULL AND _label IS NOT NULL")
        .groupBy("_key").agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_key"), "_key").limit(sample)
    )
    chosen = df.select(F.col(id_column).alias("_key"), F.col(text_column).alias("text")).join(F.broadcast(known), "_key")
    rows = (
        document_statistics(chosen, "_key", "text", keep=["_label"]).filter(~base_failed())
        .orderBy(F.xxhash64("_key"), "_key", *STATISTICS).limit(sample).toPandas()
    )
    numbers = {s: rows[s].to_numpy(np.float64) for s in STATISTICS}
    with np.errstate(divide="ignore", invalid="ignore"):
        table = {name: np.nan_to_num(value(numbers), nan=0.0, posinf=0.0) for name, value in FEATURES.items()}
    return learn_list(table, rows["_label"].to_numpy(np.float64) == 0)


def judge(
    df: DataFrame, rules: list[Rule], id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``id``, ``STATISTICS``, ``base_failed``, ``rule``, ``kept`` and the columns in ``keep`` per row.

    ``rule`` is the number of the first rule that rejects the row. NULL and empty texts have no words and
    fail the base test. Repeated rows are judged apart, with equal results. Texts of any length are
    counted whole; an empty table gives an empty table.
    """
    rows = document_statistics(df, id_column, text_column, keep)
    return (
        rows.withColumn("base_failed", base_failed()).withColumn("rule", rejected(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
