"""Weak supervision over votes: expectation-maximisation on a histogram of vote patterns, compiled to column expressions.

A rule votes 1 (yes), 0 (no) or null (abstains). Rules are taken as independent given the hidden class. Spark counts how often
each pattern of votes occurs; with k rules there are at most 3 ** k patterns, whatever the number of rows, so the histogram is
small and the iterations on it cost the same for any corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class VoteModel:
    """``log_odds[rule][vote]`` is what a vote adds to the log odds of yes; abstaining adds nothing."""

    prior: float
    log_odds: dict[str, tuple[float, float]]
    accuracy: dict[str, tuple[float, float]]

    def posterior(self, votes: dict[str, Column]) -> Column:
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, (no, yes) in self.log_odds.items():
            logit += F.when(votes[name].isNull(), F.lit(0.0)).when(votes[name] == 1, F.lit(yes)).otherwise(F.lit(no))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def histogram(df: DataFrame, votes: list[str]) -> list[tuple[tuple[int | None, ...], int]]:
    """Vote patterns and their counts, at most 3 ** len(votes) of them, in a fixed order."""
    if len(votes) > 9:
        raise ValueError("more than nine rules make the table of patterns large; merge some")
    rows = df.groupBy(*votes).count().collect()
    found = [(tuple(r[v] for v in votes), r["count"]) for r in rows]
    return sorted(found, key=lambda x: tuple(-1 if v is None else v for v in x[0]))


def fit(patterns: list[tuple[tuple[int | None, ...], int]], names: list[str], start: dict[str, tuple[float, float]],
        prior: float, strength: float = 0.02, rounds: int = 100) -> VoteModel:
    """Estimate P(vote yes | class) for each rule and class, and the share of yes.

    ``start[rule]`` holds the believed accuracies (a yes vote when the class is yes, a no vote when it is no). They begin the
    iteration and stay as pseudo-counts worth ``strength`` of the rows, so a rule that never votes keeps them and the classes
    cannot swap. ``prior`` is treated alike. An empty table returns the beliefs.
    """
    total = sum(n for _, n in patterns)
    weight = max(1.0, strength * total)
    accuracy, share = dict(start), prior
    for _ in range(rounds):
        yes_mass = weight * prior
        hits = {r: [weight * start[r][0], weight, weight * start[r][1], weight] for r in names}
        for votes, n in patterns:
            logit = math.log(share / (1 - share))
            for rule, vote in zip(names, votes):
                if vote is not None:
                    a, b = accuracy[rule]
                    logit += math.log(a / (1 - b)) if vote else math.log((1 - a) / b)
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, logit))))
            yes_mass += n * p
            for rule, vote in zip(names, votes):
                if vote is not None:
                    h = hits[rule]
                    h[0] += n * p * vote
                    h[1] += n * p
                    h[2] += n * (1 - p) * (1 - vote)
                    h[3] += n * (1 - p)
        clip = lambda x: min(0.999, max(0.001, x))
        updated = {r: (clip(h[0] / h[1]), clip(h[2] / h[3])) for r, h in hits.items()}
        share_now = clip(yes_mass / (total + weight))
        moved = max([abs(share_now - share), *(abs(x - y) for r in names for x, y in zip(updated[r], accuracy[r]))])
        accuracy, share = updated, share_now
        if moved < 1e-9:
            break
    odds = {r: (math.log((1 - a) / b), math.log(a / (1 - b))) for r, (a, b) in accuracy.items()}
    return VoteModel(share, odds, accuracy)
