"""Document quality by Bradley-Terry ranking.

A document's strength is a weighted sum of measures of its whole text.  The weights come
from preference pairs: a document marked good is preferred to one marked poor, and the
probability of that is the logistic of the difference of their strengths, so the loss is
a logistic loss on differences of measures and needs no intercept.  The scale to a score
from 0 to 1 comes afterwards: the strength at the quantile that cuts off as many training
documents as are marked poor gets the score ``CUT``.

The fit uses at most ``max_rows`` labelled documents of each mark, those with the
smallest hash of their id, and ``max_pairs`` pairs of them.  Scoring reads every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import logit, sigmoid, text_chunks

CUT = 0.3
MAX_ROWS = 6000
MAX_PAIRS = 120_000
_LETTERS = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKS = re.compile(r"[^\w\s.,]")
_MARK_RUNS = re.compile(r"[^\w\s]{2,}")
_ENDS = re.compile(r"[.!?](?:\s|$)")
_DIGITS = re.compile(r"\d")


def measures(text: str | None) -> list[float]:
    """Numbers that describe a whole text, each roughly between 0 and 1 or a logarithm."""
    text = text or ""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    counts = Counter(words)
    top = sorted(counts.values(), reverse=True)[:3] + [0, 0, 0]
    repeats = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(len(lines), 1)
    short = sum(1 for x in lines if len(x.split()) <= 3)
    lengths = np.array([len(w) for w in words] or [0])
    marked = sum(1 for w in words if _MARK_RUNS.search(w)) if _MARK_RUNS.search(text) else 0
    letters = sum(map(len, _LETTERS.findall(text)))
    raw = text.encode("utf-8", "replace")
    return [
        np.log1p(len(words)),
        np.log1p(len(words)) ** 2 / 10,
        len(counts) / n,
        len(counts) / np.sqrt(n),
        top[0] / n,
        sum(top[:3]) / n,
        repeats / n,
        float(repeats > 0.2 * n),
        float(lengths.mean()) / 10,
        float(lengths.std()) / 10,
        len(_UPPER.findall(text)) / size,
        len(_MARKS.findall(text)) / size,
        marked / n,
        float(marked > 0.3 * n),
        letters / size,
        len(_DIGITS.findall(text)) / size,
        len(_ENDS.findall(text)) / n,
        text.count(",") / n,
        text.count("|") / n,
        float(text.count("|") > 0.3 * n),
        text.count("!") / n,
        short / n_lines,
        1 - len(set(lines)) / n_lines,
        n_lines / n,
        len(zlib.compress(raw, 1)) / max(len(raw), 20),
        sum(1 for w in words if w[-1].isalnum()) / n,
        sum(1 for w in words if w[0].isupper()) / n,
    ]


N_MEASURES = len(measures(""))


@dataclass(frozen=True)
class Ranking:
    """Strength ``((x - middle) / spread) @ weights``; ``at`` and ``scale`` make it a score."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    at: float
    scale: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -6, 6) @ self.weights

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        x = np.array([measures(t) for t in texts], dtype=float)
        return sigmoid((self.strength(x) - self.at) / self.scale + logit(CUT))


def fit_ranking(
    x: np.ndarray,
    good: np.ndarray,
    poor_share: float | None = None,
    max_pairs: int = MAX_PAIRS,
    steps: int = 600,
    l2: float = 1e-4,
) -> Ranking:
    """Fit on measures and a mask of good rows.

    ``poor_share`` is the share of poor rows in the table, by default that in the rows.
    With rows of one mark only there is no pair, all weights are zero and every score is
    ``CUT`` or more.
    """
    if not len(x):
        x = np.zeros((1, N_MEASURES))
        good = np.ones(1, dtype=bool)
    middle, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - middle) / spread, -6, 6)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    weights = np.zeros(x.shape[1])
    if not len(up) or not len(down):
        return Ranking(middle, spread, weights, 0.0, 1.0)
    pick = np.random.default_rng(8)
    n_pairs = min(max_pairs, len(up) * len(down))
    better, worse = pick.choice(up, n_pairs), pick.choice(down, n_pairs)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    batch = min(n_pairs, 8192)
    for step in range(1, steps + 1):
        rows = pick.integers(0, n_pairs, batch)
        difference = z[better[rows]] - z[worse[rows]]
        lost = sigmoid(-(difference @ weights))
        gradient = -(difference.T @ lost) / batch + l2 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.05 * (1 - step / (steps + 1))
        weights = weights - rate * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8
        )
    strength = z @ weights
    share = float((~good).mean()) if poor_share is None else poor_share
    weight = np.where(good, (1 - share) / max(good.mean(), 1e-9), share / max((~good).mean(), 1e-9))
    order = np.argsort(strength, kind="stable")
    mass = np.cumsum(weight[order]) / weight.sum()
    k = min(int(np.searchsorted(mass, share)), len(order) - 1)
    at = float((strength[order[k]] + strength[order[min(k + 1, len(order) - 1)]]) / 2)
    return Ranking(middle, spread, weights, at, 1.0)


def learn_ranking(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Ranking:
    """Fit from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    NULL ids and marks are no training rows; an id marked twice counts by its lower mark.
    At most ``2 * max_rows`` rows of measures come to the driver.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .withColumn("_order", F.xxhash64(F.col("doc_id"), F.lit(8)))
    )
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    drawn = (
        known.filter("quality = 1").orderBy("_order", "doc_id").limit(max_rows)
        .unionByName(known.filter("quality = 0").orderBy("_order", "doc_id").limit(max_rows))
        .select("doc_id", "quality")
    )

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in text_chunks(batches):
            x = [[float(v) for v in measures(t)] for t in chunk["text"]]
            yield chunk[["doc_id", "quality"]].assign(x=x)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")  # a bounded sample of ids
        .select("doc_id", "text", "quality")
        .mapInPandas(measured, f"doc_id {id_type}, quality int, x array<double>")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, N_MEASURES)
    total = counts.get(0, 0) + counts.get(1, 0)
    share = counts.get(0, 0) / total if total else None
    return fit_ranking(x, rows["quality"].to_numpy() == 1, share)


def score(ranking: Ranking, text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(ranking.scores(texts.tolist()), dtype=float)

    return F.pandas_udf(run, "double")(text)
