"""Quality classifier as a sparse rule ensemble.

Shallow trees are grown on random parts of a labelled sample; every path from a root
becomes a conjunctive rule; a lasso logistic regression gives most rules weight zero;
the rest is compiled into one Spark column, so that scoring is an ordinary projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.stats import crc_of_id, document_statistics, features, labelled_sample
from creditloom.llm.tables import stored
from creditloom.llm.trees import Tree, boost, sigmoid

Condition = tuple[int, bool, float]  # feature, is it "<=", threshold


@dataclass
class RuleModel:
    names: list[str]
    rules: list[tuple[Condition, ...]]
    weights: list[float]
    intercept: float

    def column(self) -> Column:
        """Probability of class 1 over the feature columns."""
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            tests = [F.col(self.names[f]) <= t if down else F.col(self.names[f]) > t for f, down, t in rule]
            total = total + F.when(reduce(lambda a, b: a & b, tests), float(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def extract_rules(trees: list[Tree]) -> list[tuple[Condition, ...]]:
    """The conditions on the way to each node below a root, without repeats.

    Several bounds of one feature in one direction are reduced to the tightest.
    """
    found: dict[tuple[Condition, ...], None] = {}

    def walk(tree: Tree, node: int, path: dict[tuple[int, bool], float]) -> None:
        if path:
            found[tuple(sorted((f, down, t) for (f, down), t in path.items()))] = None
        f = tree.feature[node]
        if f < 0:
            return
        t = tree.threshold[node]
        walk(tree, tree.left[node], path | {(f, True): min(t, path.get((f, True), t))})
        walk(tree, tree.right[node], path | {(f, False): max(t, path.get((f, False), t))})

    for tree in trees:
        walk(tree, 0, {})
    return list(found)


def apply_rules(x: np.ndarray, rules: list[tuple[Condition, ...]]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, down, t in rule:
            out[:, k] *= (x[:, f] <= t) if down else (x[:, f] > t)
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient steps; the intercept carries no penalty."""
    centre = x.mean(axis=0)
    xc = x - centre
    rate = 4.0 * len(y) / max(np.linalg.norm(xc.T @ xc, 2) + len(y), 1e-9)
    w, b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    v, vb, t = w, b, 1.0
    for _ in range(steps):
        r = sigmoid(xc @ v + vb) - y
        new = v - rate * (xc.T @ r) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = vb - rate * r.mean()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new, new_b, after
    return w, float(b - centre @ w)


def train(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, penalties=(0.003, 0.001, 0.0003)) -> RuleModel:
    """Rules and weights; the penalty is the one with the least loss on a fifth of the rows.

    With one class or no rows the model is a constant.
    """
    grown, base = boost(x, y, [0] * len(names), trees, depth, rate=0.1, share=0.5, seed=1)
    rules = extract_rules(grown)
    if not rules:
        return RuleModel(names, [], [], base)
    z = apply_rules(x, rules)
    check = np.arange(len(y)) % 5 == 0

    def loss(penalty: float) -> float:
        w, b = lasso_logistic(z[~check], y[~check], penalty)
        p = np.clip(sigmoid(z[check] @ w + b), 1e-6, 1 - 1e-6)
        return float(-np.mean(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)))

    w, b = lasso_logistic(z, y, min(penalties, key=loss))
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel(names, [rules[k] for k in used], [float(w[k]) for k in used], b)


def fit(statistics: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> RuleModel:
    """A model from at most ``max_rows`` labelled documents, chosen by a hash of the id."""
    names = list(features())
    sample = labelled_sample(statistics, labels, "quality", max_rows).select(
        *[c.cast("double").alias(n) for n, c in features().items()], "label"
    )
    rows = sample.toPandas()
    x = rows[names].to_numpy(dtype=float).reshape(-1, len(names))
    return train(x, rows["label"].to_numpy(dtype=float), names)


def classify_quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.5, max_rows: int = 20_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, the features, held_out, score, predicted.

    Labels of rows where ``held_out`` is true are never read; by default that is
    crc32(doc_id as text) mod 3 = 1. Null and empty texts are scored by their zero
    statistics; repeated rows get a row each; an empty table gives an empty result.
    """
    statistics = stored(document_statistics(docs), "quality-statistics")
    held = held_out if held_out is not None else crc_of_id() % 3 == 1
    model = fit(statistics.filter(~held), labels, max_rows)
    wide = statistics.select("*", *[c.cast("double").alias(n) for n, c in features().items()])
    return (
        wide.withColumn("held_out", held)
        .withColumn("score", model.column())
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
