"""Quality classifier: a sparse ensemble of rules taken from trees, with weights by logistic lasso, compiled to columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.quality_rules import with_statistics
from sluice.session import materialize

SAMPLE = 20_000  # labelled rows that the rules are fitted on, at most; the lowest hashes of doc_id
TREES, DEPTH, LEAF, RATE, BINS = 30, 3, 15, 0.3, 32
PENALTIES = (0.03, 0.01, 0.003, 0.001)

Condition = tuple[int, bool, float]  # feature, above, cut


def features(stats: Column) -> dict[str, Column]:
    """What rules look at: shares of a text's words, letters and lines. A text without words has 0 in all of them."""
    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    words = stats["n_words"]
    return {
        "words": F.log1p(words.cast("double")),
        "word_length": share(stats["word_chars"], words),
        "symbols": share(stats["n_symbols"], words),
        "dup_lines": share(stats["n_dup_lines"], stats["n_lines"]),
        "repeats": share(stats["n_repeat_words"], words),
        "capitals": share(stats["n_upper"], stats["n_alnum"]),
        "marks": share(stats["n_marks"], words),
        "other_chars": share(stats["word_chars"] - stats["n_alnum"], stats["word_chars"]),
        "variety": share(stats["n_distinct"], F.least(words, F.lit(300))),
        "same_next": share(stats["n_same"], words),
        "line_words": share(words, stats["n_lines"]),
    }


@dataclass
class RuleModel:
    names: list[str]
    rules: list[tuple[tuple[Condition, ...], float]]
    bias: float

    def score(self, columns: dict[str, Column]) -> Column:
        """Probability of a good text, as one expression."""
        logit = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for feature, above, cut in rule:
                value = columns[self.names[feature]]
                holds = holds & ((value > cut) if above else (value <= cut))
            logit = logit + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _holds(x: np.ndarray, rule: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, above, cut in rule:
        out &= (x[:, feature] > cut) == above
    return out


def _grow(x: np.ndarray, binned: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, fitted: np.ndarray) -> list:
    """One regression tree on the gradient; returns its paths and adds its values to ``fitted``."""
    rules, todo = [], [((), np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        if path:
            rules.append(path)
        best = (1e-6, None)
        g, h = slope[rows], curve[rows]
        whole = g.sum() ** 2 / (h.sum() + 1.0)
        if len(path) < DEPTH and len(rows) >= 2 * LEAF:
            for f, edges in enumerate(cuts):
                if not len(edges):
                    continue
                at = binned[rows, f]
                sg = np.cumsum(np.bincount(at, g, len(edges) + 1))[:-1]
                sh = np.cumsum(np.bincount(at, h, len(edges) + 1))[:-1]
                n = np.cumsum(np.bincount(at, minlength=len(edges) + 1))[:-1]
                gain = sg**2 / (sh + 1.0) + (g.sum() - sg) ** 2 / (h.sum() - sh + 1.0) - whole
                gain[(n < LEAF) | (len(rows) - n < LEAF)] = 0
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, k))
        if best[1] is None:
            fitted[rows] += RATE * g.sum() / (h.sum() + 1.0)
            continue
        f, k = best[1]
        low = binned[rows, f] <= k
        todo.append(((*path, (f, False, float(cuts[f][k]))), rows[low]))
        todo.append(((*path, (f, True, float(cuts[f][k]))), rows[~low]))
    return rules


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    n, k = z.shape
    weights, bias, ahead, ahead_bias, pace = np.zeros(k), math.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)), np.zeros(k), 0.0, 1.0
    ahead_bias = bias
    top = np.ones(k)
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        top = z.T @ (z @ top)
        top /= np.linalg.norm(top) + 1e-12
    step = 1.0 / (0.25 * float(top @ (z.T @ (z @ top))) / n + 0.25 + 1e-9)
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ ahead + ahead_bias, -30, 30))) - y
        moved = ahead - step * (z.T @ error) / n
        fresh = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        fresh_bias = ahead_bias - step * error.mean()
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = fresh + (pace - 1) / faster * (fresh - weights)
        ahead_bias = fresh_bias + (pace - 1) / faster * (fresh_bias - bias)
        weights, bias, pace = fresh, fresh_bias, faster
    return weights, bias


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    """Boosted trees give the paths, the lasso their weights; the penalty with the least loss on every fifth row is taken.

    With one class or no rows the model is the share of good rows, or one half.
    """
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(names, [], math.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    logit = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    rules: dict[frozenset, tuple] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        for rule in _grow(x, binned, cuts, y - p, p * (1 - p), logit):
            rules.setdefault(frozenset(rule), rule)
    listed = list(rules.values())
    z = np.stack([_holds(x, r) for r in listed], axis=1).astype(float)
    spread = np.maximum(z.std(axis=0), 1e-3)
    test = np.arange(len(y)) % 5 == 0

    def loss(w: np.ndarray, b: float) -> float:
        p = np.clip(1 / (1 + np.exp(-np.clip(z[test] / spread @ w + b, -30, 30))), 1e-6, 1 - 1e-6)
        return float(-np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)))

    penalty = min(PENALTIES, key=lambda c: loss(*_lasso(z[~test] / spread, y[~test], c)))
    weights, bias = _lasso(z / spread, y, penalty)
    kept = [(rule, float(w / s)) for rule, w, s in zip(listed, weights, spread) if abs(w) > 1e-9]
    return RuleModel(names, kept, float(bias))


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids, by the CRC-32 of their text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, RuleModel]:
    """``docs`` (doc_id, text) to (doc_id, held_out, score), and the model. ``labels`` has doc_id and quality (0, 1 or null).

    Statistics of every whole text are computed once, inside the row, and written without the text. Rules are fitted on labelled
    rows that are not held out, at most ``sample`` of them; ids, sources, languages and labels are no inputs of a score. All
    documents are scored, empty and null texts too. Repeated rows are scored alike; an empty table gives an empty result.
    """
    counted = with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats")
    written = materialize(counted, "rule-statistics")
    columns = features(F.col("stats"))
    names = list(columns)
    valued = written.select("doc_id", *[columns[c].alias(c) for c in names])
    known = labels.where("quality in (0, 1)").select("doc_id", "quality")
    train = (valued.join(known, "doc_id").where(~held_out(F.col("doc_id")))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *names).limit(sample).collect())
    x = np.array([[r[c] for c in names] for r in train], float).reshape(len(train), len(names))
    model = fit_rules(x, np.array([r["quality"] for r in train], float), names)
    scored = valued.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score({c: F.col(c) for c in names}).alias("score"))
    return scored, model
