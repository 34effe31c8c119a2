"""Quality rules: base rules on counts, and a decision list learned by sequential covering.

The learner grows one conjunction of thresholds at a time by information gain on two thirds of its sample, drops last conditions while
that helps on the other third, and goes on with the rows that no rule covers. The list comes out as one ordered Spark conditional
expression (CASE WHEN) over statistics columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import label_sample, only_columns
from tremor.llm.docstats import COUNTS, FEATURES, document_stats

#: Labelled rows that the list is fitted on at most.
SAMPLE = 20_000
MIN_WORDS, MAX_REPEATS = 50, 50
CUTS, MOST_CONDITIONS, MOST_RULES, LEAST_PRECISION = 48, 4, 16, 0.8


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.limit if self.above else v <= self.limit

    def column(self, features: Column) -> Column:
        v = features[FEATURES.index(self.feature)]
        return v > F.lit(self.limit) if self.above else v <= F.lit(self.limit)


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: list[Condition] = []
    rows = np.ones(len(x), bool)
    for _ in range(MOST_CONDITIONS):
        p, n = int((rows & bad).sum()), int((rows & ~bad).sum())
        if not p or not n:
            break
        base, best = math.log2(p / (p + n)), (1e-9, None)
        for j, name in enumerate(FEATURES):
            v, y = x[rows, j], bad[rows]
            order = np.argsort(v)
            v, y = v[order], y[order]
            pos = np.concatenate([[0], np.cumsum(y)])
            ends = np.unique(np.searchsorted(v, np.quantile(v, np.linspace(0, 1, CUTS)), "right"))
            for e in ends[(ends > 0) & (ends < len(v))]:
                limit = (v[e - 1] + v[e]) / 2
                for above, tp, all_ in ((False, pos[e], e), (True, p - pos[e], len(v) - e)):
                    if tp:
                        gain = tp * (math.log2(tp / all_) - base)
                        if gain > best[0]:
                            best = (gain, Condition(name, above, float(limit)))
        if best[1] is None:
            break
        rule.append(best[1])
        rows &= best[1].holds(x)
    return tuple(rule)


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    rows = covered(rule, x)
    p, n = int((rows & bad).sum()), int((rows & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject. Each must reach ``LEAST_PRECISION`` on rows it was not grown on; none is learned without both classes."""
    rules: list[Rule] = []
    part = np.random.default_rng(5).permutation(len(x)) % 3
    left = np.ones(len(x), bool)
    while len(rules) < MOST_RULES and (left & bad).any():
        grow, prune = left & (part != 0), left & (part == 0)
        rule = _grow(x[grow], bad[grow])
        while len(rule) > 1 and _worth(rule[:-1], x[prune], bad[prune]) >= _worth(rule, x[prune], bad[prune]):
            rule = rule[:-1]
        rows = covered(rule, x) & left
        p, n = int((rows & bad & prune).sum()), int((rows & ~bad & prune).sum())
        if not rule or p < 2 or p / (p + n) < LEAST_PRECISION:
            break
        rules.append(rule)
        left &= ~rows
    return rules


def expression(rules: list[Rule], features: Column) -> Column:
    """The number of the first rule that holds, null if none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        test = F.lit(True)
        for c in rule:
            test = test & c.column(features)
        out = F.when(test, F.lit(k)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[Rule]:
    """Rules from at most ``most`` labelled rows that are not held out; no rows, no rules."""
    sample = label_sample(labels, "quality", most)
    if not sample:
        return []
    ids = F.broadcast(docs.sparkSession.createDataFrame(sample, f"doc_id {dict(labels.dtypes)['doc_id']}, y int"))
    rows = document_stats(only_columns(docs, "doc_id", "text").join(ids, "doc_id"), ["y"]).select("y", "features").toArrow()
    if not rows.num_rows:
        return []
    x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    y = rows.column("y").to_numpy()
    order = np.lexsort((*x.T, y))  # the same list whatever order the rows came in
    return learn(x[order], y[order] == 0)


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, kept, and rule (the text of the rule that rejected it).

    Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has none and fails the base rules. ``kept`` is false if the base rules fail or a
    learned rule holds. Repeated rows are judged each; null ids are kept as they are. Without labels only the base rules reject.
    """
    rules = fit(docs, labels)
    stats = document_stats(only_columns(docs, "doc_id", "text"), ["doc_id"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATS * F.col("n_words"))
    judged = stats.select("doc_id", *COUNTS, failed.alias("base_failed"), expression(rules, F.col("features")).alias("k"))
    texts = F.array(*[F.lit(" AND ".join(map(str, r))) for r in rules]) if rules else F.array().cast("array<string>")
    return judged.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.col("k").isNull()).alias("kept"), F.when(F.col("base_failed"), F.lit("base")).otherwise(F.get(texts, F.col("k"))).alias("rule"))
