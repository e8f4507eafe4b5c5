"""Toxicity, language and quality beside slow versions of themselves, on the given tables."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from siltgate.llm import language, linear, quality, toxicity
from siltgate.llm.common import CHUNK_CHARS, hash64, table
from siltgate.llm.queries import QUERIES, toxicity_chain
from tests.llm.helpers import odd_texts
from tests.llm.test_filters import slow_counts

SF = "/root/testdata/sf0.001"


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


# --- language ---------------------------------------------------------------------


def number(gram):
    out = 0
    for c in gram:
        out = (out << 21) | ord(c)
    return out


def ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))][:size]


def test_languages_of_the_query_are_those_of_the_slow_version(spark):
    import zlib

    rows = table(spark, SF, "documents").collect()
    size, totals = language.PROFILE_SIZE, defaultdict(Counter)
    for r in rows:
        if r.lang is not None and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            totals[r.lang].update(slow_counts(r.text))
    profiles = {lang: {g: k for k, g in enumerate(ranked(c, size))} for lang, c in totals.items()}
    got = {r.doc_id: r for r in QUERIES["op2_language"](spark, SF).collect()}
    draw = random.Random(1)
    for r in draw.sample(rows, 60):
        own = ranked(slow_counts(r.text or ""), size)
        if not own:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        far = {
            lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()
        }
        best = min(sorted(far), key=far.__getitem__)
        assert got[r.doc_id].lang_pred == best
        assert got[r.doc_id].score == pytest.approx(1 - far[best] / (size * len(own)), abs=1e-12)


# --- toxicity ---------------------------------------------------------------------


def slow_odds(chain, text):
    """Log odds of each category, one after the other, feature by feature."""
    numbers = {int(hash64([f]).view(np.int64)[0]) for f in toxicity.text_features(text)}
    odds = []
    for c in range(len(chain.categories)):
        z = chain.bias[c]
        for k, feature in enumerate(chain.features.tolist()):
            if feature in numbers:
                z += chain.weights[c, k]
        for j in range(c):
            p = min(max(sigmoid(min(max(odds[j], -40), 40)), 1e-6), 1 - 1e-6)
            z += chain.links[c][j] * math.log(p / (1 - p))
        odds.append(z)
    return odds


def test_the_chain_of_the_query_is_that_of_the_slow_version(spark):
    docs = table(spark, SF, "documents")
    chain = toxicity_chain(docs, table(spark, SF, "labels"))
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for doc_id in random.Random(2).sample(sorted(texts), 40):
        p = [sigmoid(min(max(z, -40), 40)) for z in slow_odds(chain, texts[doc_id])]
        r = got[doc_id]
        assert (r.p_low_quality, r.p_toxic) == pytest.approx(p, abs=1e-9)
        assert r.is_toxic == (r.p_toxic >= chain.cuts[1]) and r.kept == (not r.is_toxic)
    assert chain.links[1].shape == (1,) and CHUNK_CHARS > 0
    for text in odd_texts(random.Random(5)):
        assert np.isfinite(chain.probabilities([text])).all()


def loss(x, dense, y, w, v, b, l2):
    z = x @ w + dense @ v + b
    return float(np.mean(np.logaddexp(0, z) - y * z) + l2 / (2 * len(y)) * (w @ w + v @ v))


def test_the_logistic_fit_is_near_the_least_loss():
    """Against plain Newton steps on the dense matrix."""
    draw = np.random.default_rng(3)
    x = (draw.random((300, 12)) < 0.3).astype(float)
    dense = draw.standard_normal((300, 2))
    y = (draw.random(300) < 1 / (1 + np.exp(-(x @ draw.standard_normal(12) + dense[:, 0])))).astype(float)
    l2, whole = 0.3, np.hstack((x, dense, np.ones((300, 1))))
    penalty = np.diag([l2 / 300] * 14 + [0.0])
    best = np.zeros(15)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(whole @ best)))
        slope = whole.T @ (p - y) / 300 + penalty @ best
        best -= np.linalg.solve((whole * (p * (1 - p))[:, None]).T @ whole / 300 + penalty, slope)
    rows, columns = np.nonzero(x)
    sparse = linear.Sparse.sorted(rows, columns, 300, 12)
    w, v, b = linear.fit_logistic(sparse, dense, y, l2)
    least = loss(x, dense, y, best[:12], best[12:14], best[14], l2)
    assert least <= loss(x, dense, y, w, v, b, l2) <= least + 0.002


# --- quality ----------------------------------------------------------------------


def pair_loss(z, good, weights, l2):
    s = z @ weights
    return float(np.mean(np.logaddexp(0, -(s[good][:, None] - s[~good][None, :])))) + l2 / 2 * float(weights @ weights)


def test_the_ranking_is_near_the_least_loss_over_all_pairs():
    draw = np.random.default_rng(4)
    x = draw.standard_normal((120, quality.N_MEASURES))
    good = (x[:, 0] + 0.5 * x[:, 1] + draw.standard_normal(120)) > 0
    ranking = quality.fit_ranking(x, good)
    z = np.clip((x - ranking.middle) / ranking.spread, -6, 6)
    weights = np.zeros(x.shape[1])
    for _ in range(4000):  # plain descent over every pair
        s = z @ weights
        lost = 1 / (1 + np.exp(s[good][:, None] - s[~good][None, :]))
        slope = -(z[good].T @ lost.sum(axis=1) - z[~good].T @ lost.sum(axis=0)) / lost.size + 1e-4 * weights
        weights -= 0.5 * slope
    least = pair_loss(z, good, weights, 1e-4)
    assert least - 1e-6 <= pair_loss(z, good, ranking.weights, 1e-4) <= least + 0.02


def test_quality_scores_are_those_of_the_slow_version(spark):
    import zlib

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    train = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    texts = {r.doc_id: r.text for r in docs.collect()}
    chosen = labels.filter("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 != 0")
    ranking = quality.learn_ranking(docs, chosen)
    ids = sorted(i for i in train if i in texts)
    x = np.array([[float(v) for v in quality.measures(texts[i])] for i in ids])
    assert np.allclose(ranking.middle, x.mean(axis=0)) and len(ids) > 20
    got = {r.doc_id: r for r in QUERIES["op8_quality"](spark, SF).collect()}
    for i in random.Random(6).sample(sorted(texts), 50):
        strength = 0.0
        for k, v in enumerate(quality.measures(texts[i])):
            z = (float(v) - ranking.middle[k]) / ranking.spread[k]
            strength += min(max(z, -6), 6) * ranking.weights[k]
        want = sigmoid((strength - ranking.at) / ranking.scale + math.log(0.3 / 0.7))
        assert got[i].score == pytest.approx(want, abs=1e-9)
        assert got[i].predicted == (got[i].score >= 0.3)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
