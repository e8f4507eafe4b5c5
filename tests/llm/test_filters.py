"""Language, toxicity and quality: small fits, odd rows, held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltgate.llm import language, quality, toxicity
from siltgate.llm.common import crc_mod, table
from siltgate.llm.queries import QUERIES
from tests.llm.helpers import documents, odd_texts, sentence, with_clashes

SF = "/root/testdata/sf0.01"


# --- language --------------------------------------------------------------------


def slow_counts(text):
    counts = {}
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = " " + " ".join(letters.split()) + " "
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if g == " " or (n == 3 and g[1] == " "):
                continue
            counts[g] = counts.get(g, 0) + 1
    return counts


@pytest.mark.parametrize("text", ["The cat, the CAT!", "Straße 漢字 x", "a", "  ", "İstanbul 12 ab"])
def test_ngrams_equal_a_plain_count(text):
    grams, counts = language.ngram_counts(text)

    def key(g):
        out = 0
        for c in g:
            out = (out << 21) | ord(c)
        return out

    want = {key(g): n for g, n in slow_counts(text).items()} if text.strip() else {}
    assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == want


def test_out_of_place_distance(spark):
    rows = [(1, "aab aab ab", "x"), (2, "zzy zzy zy", "y"), (3, None, "y"), (4, "qq", None)]
    train = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    profiles = language.learn_profiles(train, size=5)
    assert profiles.languages == ("x", "y")
    mine = sorted(slow_counts("aab ab").items(), key=lambda x: (-x[1], [ord(c) for c in x[0]]))
    assert profiles.predict("aab ab")[0] == "x" and len(mine) > 5
    assert profiles.predict("zy zy")[0] == "y"
    for text in (None, "", " 12 !?"):
        assert profiles.predict(text) == ("und", 0.0)
    lang, score = profiles.predict("漢字")
    assert lang in ("x", "y") and score == 0.0


def test_language_of_odd_rows(spark):
    docs = documents(spark, odd_texts(random.Random(1)), lang="en", extra=True)
    profiles = language.learn_profiles(docs)
    got = docs.select("doc_id", language.predict_language(profiles, F.col("text")).alias("p")).collect()
    assert [r.p.lang for r in sorted(got)] == ["und", "und", "und", "en", "und", "en", "en", "en", "und"]
    none = language.learn_profiles(documents(spark, []))
    assert none.predict("abc") == ("und", 0.0)


def test_held_out_language_accuracy(spark):
    got = QUERIES["op2_language"](spark, SF).filter("held_out").join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    r = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a > 0.97 and 0 <= r.lo <= r.hi <= 1


# --- toxicity --------------------------------------------------------------------


def labelled(spark, n=240):
    draw = random.Random(2)
    texts, flags = [], []
    for i in range(n):
        rude, shout = i % 4 == 0, i % 3 == 0
        words = sentence(draw, 30).split()
        if rude:
            words[draw.randrange(30)] = draw.choice(["nastyword", "vileword"]) + draw.choice(["", "s"])
        text = " ".join(words)
        texts.append(text + " !!!!" * 5 if shout else text)
        flags.append((i, int(shout), int(rude)))
    return documents(spark, texts, extra=True), spark.createDataFrame(flags, "doc_id long, shout int, rude int")


def test_a_chain_finds_what_it_was_taught(spark):
    docs, flags = labelled(spark)
    train = flags.filter("doc_id % 5 != 0").unionByName(spark.createDataFrame([(None, 1, 1), (3, None, 0)], flags.schema))
    chain = toxicity.learn_chain(docs, train, ["shout", "rude"])
    assert [len(x) for x in chain.links] == [0, 1]
    got = docs.select("doc_id", toxicity.score(chain, F.col("text")).alias("s")).join(flags, "doc_id")
    wrong = got.filter("s.is_rude != (rude = 1) OR s.is_shout != (shout = 1)")
    assert wrong.count() == 0


def test_later_models_learn_from_out_of_fold_odds():
    """The second category repeats the first, which has no feature of its own but noise."""
    draw = np.random.default_rng(0)
    y = (np.arange(300) % 2).astype(np.int64)
    noise = [np.array([1000 + i, int(draw.integers(0, 5)), 50 + yi]) for i, yi in enumerate(y)]
    chain = toxicity.fit_chain([np.sort(r) for r in noise], np.stack((y, y), axis=1), ["a", "b"])
    assert chain.links[1][0] > 0.1  # leans on the first model's odds


def test_toxicity_of_odd_rows_and_empty_tables(spark):
    docs, flags = labelled(spark)
    chain = toxicity.learn_chain(docs, flags, ["shout", "rude"])
    odd = documents(spark, odd_texts(random.Random(1)))
    got = odd.select(toxicity.score(chain, F.col("text")).alias("s")).select("s.*").collect()
    assert len(got) == 9 and not any(r.is_rude for r in got)
    assert documents(spark, []).select(toxicity.score(chain, F.col("text")).alias("s")).count() == 0
    none = toxicity.learn_chain(docs, flags.limit(0), ["shout", "rude"])
    assert none.probabilities(["x", None]).shape == (2, 2)


def test_the_sample_is_bounded(spark):
    docs, flags = labelled(spark)
    chain = toxicity.learn_chain(docs, flags, ["shout", "rude"], max_rows=10)
    assert chain.categories == ("shout", "rude")


def test_toxic_documents_are_found(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = QUERIES["op1_toxicity"](spark, SF).join(labels, "doc_id")
    assert got.filter("is_toxic != (toxic = 1)").count() <= 0.01 * got.count()
    assert QUERIES["op1_toxicity"](spark, SF).count() == docs.count()


# --- quality ---------------------------------------------------------------------


def test_ranking_prefers_what_was_preferred():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((400, quality.N_MEASURES))
    strength = 2 * x[:, 3] - x[:, 5]
    good = strength > np.quantile(strength, 0.2)
    ranking = quality.fit_ranking(x, good)
    got = ranking.strength(x)
    assert (got[good][:, None] > got[~good][None, :]).mean() > 0.97
    weights = ranking.weights
    assert weights[3] > 0 > weights[5] and np.abs(weights).argmax() == 3


def test_quality_of_odd_rows(spark):
    x = np.array([quality.measures(t) for t in odd_texts(random.Random(1))], dtype=float)
    assert np.isfinite(x).all()
    one_sided = quality.fit_ranking(x, np.ones(len(x), bool))
    assert (one_sided.scores([None, "a b c", ""]) >= quality.CUT - 1e-9).all()
    assert quality.fit_ranking(np.zeros((0, quality.N_MEASURES)), np.zeros(0, bool)).scores([]).shape == (0,)
    empty = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ranking = quality.learn_ranking(empty, labels)
    assert empty.select(quality.score(ranking, F.col("text")).alias("s")).count() == 0


def test_held_out_quality(spark):
    labels = table(spark, SF, "labels")
    got = QUERIES["op8_quality"](spark, SF).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted != quality").count() <= 0.05 * got.count()
    assert got.filter("score < 0 OR score > 1").count() == 0
    assert got.filter(crc_mod("doc_id", 5) != 0).count() == 0
