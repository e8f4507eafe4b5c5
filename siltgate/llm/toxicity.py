"""Toxicity by a classifier chain.

Categories are predicted one after the other.  Each has its own logistic model over the
0/1 features of a text (words, marks, word beginnings of four and five letters, and a few
bands of length, repetition, capitals and marks); from the second on, a model also sees
the log odds that the earlier models give.  While training, those log odds come from
models fitted on the other folds, so a later model learns how far an earlier one can be
trusted on texts it has not seen.

The fit uses at most ``max_rows`` labelled texts per combination of categories, those
with the smallest hash of their id; the bound keeps the driver's share constant.  Texts
become sets of 64-bit feature numbers inside the tasks.  A category's model keeps those
whose share among its texts is at least twice or at most half that among the others (a
text's length alone shifts shares by less), at most ``max_features`` by chi-square.  Scoring reads every text whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.llm.common import hash64, letter_tokens, logit, sigmoid, text_chunks
from siltgate.llm.linear import Sparse, chi_square, fit_logistic

_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")
MAX_ROWS = 1500
MAX_FEATURES = 800
FOLDS = 5


def _bands(text: str, tokens: list[str], distinct: int) -> list[str]:
    n = len(tokens)
    marks = sum(1 for t in tokens if not t[0].isalpha())
    upper = len(_UPPER.findall(text))
    return [
        f"\x00n{int(np.log2(n + 1))}",
        f"\x00d{int(10 * distinct / max(n, 1))}",
        f"\x00m{int(10 * marks / max(n, 1))}",
        f"\x00u{int(10 * upper / max(len(text), 1))}",
    ]


def text_features(text: str | None) -> list[str]:
    """Distinct features of a whole text; NULL and empty texts have their bands only."""
    text = text or ""
    tokens = letter_tokens(text)
    kinds = set(tokens)
    features = set(kinds)
    features.update("\x01" + t[:4] for t in kinds if len(t) >= 4)
    features.update("\x01" + t[:5] for t in kinds if len(t) >= 5)
    return [*features, *_bands(text, tokens, len(kinds))]


def feature_rows(texts: Sequence[str | None]) -> list[np.ndarray]:
    """Sorted feature numbers of each text; a feature is hashed once per call."""
    lists = [text_features(t) for t in texts]
    hashes = hash64([f for row in lists for f in row]).view(np.int64)
    ends = np.cumsum([len(row) for row in lists])[:-1]
    return [np.sort(part) for part in np.split(hashes, ends)]


@dataclass(frozen=True)
class Chain:
    """``weights[c]`` per feature, ``links[c]`` per earlier category, ``bias[c]``, ``cuts[c]``."""

    categories: tuple[str, ...]
    features: np.ndarray
    weights: np.ndarray
    links: tuple[np.ndarray, ...]
    bias: np.ndarray
    cuts: np.ndarray

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        out = np.empty((len(texts), len(self.categories)))
        for i, row in enumerate(feature_rows(texts)):
            place = np.searchsorted(self.features, row)
            place[place == len(self.features)] = 0
            hit = place[self.features[place] == row] if len(self.features) else place[:0]
            odds = self.weights[:, hit].sum(axis=1) + self.bias
            for c, link in enumerate(self.links):
                if c:
                    odds[c] += link @ logit(out[i, :c])
                out[i, c] = sigmoid(odds[c])
        return out


def _best_cut(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The probability with the best F1; the middle of the gap where classes part."""
    order = np.argsort(-p, kind="stable")
    hit, total = np.cumsum(weight[order] * y[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (total + max((weight * y).sum(), 1e-9))
    k = int(np.argmax(f1)) if len(f1) else 0
    if not len(f1) or not y.any():
        return 0.5
    after = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + after) / 2)


def fit_chain(
    rows: list[np.ndarray],
    labels: np.ndarray,
    categories: Sequence[str],
    weight: np.ndarray | None = None,
    max_features: int = MAX_FEATURES,
    folds: int = FOLDS,
    l2: float = 0.3,
) -> Chain:
    """Fit on feature numbers and a 0/1 matrix of labels, one column per category.

    ``weight`` says how many rows each sampled row stands for; it shapes the cuts and
    the intercepts.  Without any row every probability is one half.
    """
    n, k = labels.shape
    weight = np.ones(n) if weight is None else weight
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    features, place = np.unique(flat, return_inverse=True)
    place = place.astype(np.int32)
    row_of = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    del flat
    present = np.bincount(place, minlength=len(features))
    chosen = np.zeros((k, len(features)), dtype=bool)
    for c in range(k):
        n_pos = int(labels[:, c].sum())
        positive = np.bincount(place, weights=labels[row_of, c], minlength=len(features))
        score = chi_square(present, positive, n, n_pos)
        ratio = ((positive + 0.5) / (n_pos + 1)) / ((present - positive + 0.5) / (n - n_pos + 1))
        telling = (present >= 3) & (score > 6.0) & ((ratio >= 2) | (ratio <= 0.5))
        keep = np.flatnonzero(telling)
        chosen[c, keep[np.argsort(-score[keep], kind="stable")][:max_features]] = True

    used = np.flatnonzero(chosen.any(axis=0))
    fold = np.arange(n) % folds
    odds = np.zeros((n, k))  # out of fold
    weights, links, bias, cuts = np.zeros((k, len(used))), [], [], []
    for c in range(k):
        own = np.flatnonzero(chosen[c])
        column = np.full(len(features), -1)
        column[own] = np.arange(len(own))
        hit = column[place] >= 0
        x = Sparse.sorted(row_of[hit], column[place[hit]], n, len(own))
        y = labels[:, c].astype(float)
        # The sample holds more of the rare class than the table; shift back.
        share, sampled = (np.average(y, weights=weight), y.mean()) if n else (0.5, 0.5)
        shift = float(logit(share) - logit(sampled))
        for f in range(folds):
            train, test = fold != f, fold == f
            if not train.any() or not test.any():
                continue
            w, v, b = fit_logistic(x.take(train), odds[train, :c], y[train], l2)
            odds[test, c] = x.take(test).times(w) + odds[test, :c] @ v + b + shift
        w, v, b = np.zeros(len(own)), np.zeros(c), 0.0
        if n:
            w, v, b = fit_logistic(x, odds[:, :c], y, l2)
        odds[:, c] = np.clip(odds[:, c], -12, 12)
        weights[c, np.searchsorted(used, own)] = w
        links.append(v)
        bias.append(b + shift)
        cuts.append(_best_cut(sigmoid(odds[:, c]), y, weight))
    return Chain(
        tuple(categories), features[used], weights, tuple(links), np.array(bias), np.array(cuts)
    )


def learn_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    max_rows: int = MAX_ROWS,
    **options,
) -> Chain:
    """Fit from ``docs`` (doc_id, text) and ``labels`` (doc_id and a 0/1 column per category).

    Rows with a NULL id or a NULL category are no training rows; an id that is labelled
    twice counts by its largest labels.  Brings ids of the sample and then their feature
    numbers to the driver: at most ``max_rows`` times 2 to the number of categories.
    """
    flags = [F.max(F.col(c).cast("int")).alias(c) for c in categories]
    known = (
        labels.select("doc_id", *categories)
        .dropna()
        .groupBy("doc_id")
        .agg(*flags)
        .withColumn("_order", F.xxhash64(F.col("doc_id"), F.lit(7)))
    )
    sample, stands = None, {}
    for row in known.groupBy(*categories).count().collect():
        combo = tuple(row[c] for c in categories)
        of_combo = known
        for c in categories:
            of_combo = of_combo.filter(F.col(c) == row[c])
        part = of_combo.orderBy("_order", "doc_id").limit(max_rows)
        stands[combo] = row["count"] / min(row["count"], max_rows)
        sample = part if sample is None else sample.unionByName(part)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in text_chunks(batches):
            packed = [r.tobytes() for r in feature_rows(chunk["text"].tolist())]
            yield chunk[["doc_id", *categories]].assign(features=packed)

    if sample is None:
        return fit_chain([], np.zeros((0, len(categories)), np.int64), categories, **options)
    drawn = sample.select("doc_id", *categories)
    flags_type = ", ".join(f"`{c}` int" for c in categories)
    read = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")  # a bounded sample of ids
        .select("doc_id", "text", *categories)
        .mapInPandas(features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {flags_type}, features binary")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    rows = [np.frombuffer(b, np.int64) for b in read["features"]]
    y = read[list(categories)].to_numpy(dtype=np.int64)
    weight = np.array([stands[tuple(r)] for r in y.tolist()])
    return fit_chain(rows, y, categories, weight, **options)


def score(chain: Chain, text: Column) -> Column:
    """Struct with ``p_<category>`` and, by the chain's cuts, ``is_<category>``."""

    def run(texts: pd.Series) -> pd.DataFrame:
        out = {}
        p = np.concatenate(
            [
                chain.probabilities(c["text"].tolist())
                for c in text_chunks(iter([texts.to_frame("text")]))
            ]
            or [np.empty((0, len(chain.categories)))]
        )
        for c, name in enumerate(chain.categories):
            out[f"p_{name}"] = p[:, c]
            out[f"is_{name}"] = p[:, c] >= chain.cuts[c]
        return pd.DataFrame(out)

    fields = []
    for name in chain.categories:
        fields += [T.StructField(f"p_{name}", T.DoubleType()), T.StructField(f"is_{name}", T.BooleanType())]
    return F.pandas_udf(run, T.StructType(fields))(text)
