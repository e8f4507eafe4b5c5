from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltgate.llm import recurrent as r
from siltgate.llm.common import WordHasher, ascii_words
from tests.llm.helpers import documents, odd_texts, sentence


def small_vocabulary():
    class_of = np.repeat(np.arange(3), 4).astype(np.int32)
    return r.Vocabulary(
        np.arange(12, dtype=np.int64), np.full(12, 5), np.arange(12, dtype=np.int32), class_of,
        np.searchsorted(class_of, np.arange(4)), np.full(r.TAIL_CLASSES, 9.0), 100, 12,
    )


def test_gradients_equal_differences():
    """Backpropagation through a window, checked weight by weight."""
    model = r.Model(small_vocabulary(), hidden=3)
    for n in r.Model.NAMES:
        setattr(model, n, getattr(model, n).astype(np.float64))
    draw = np.random.default_rng(0)
    inputs, targets = draw.integers(0, 20, (5, 2)), draw.integers(0, 20, (5, 2))
    h = draw.standard_normal((2, 3))
    _, grad, _ = r.window_gradient(model, inputs, targets, h)
    for n in r.Model.NAMES:
        weights = getattr(model, n)
        for at in draw.integers(0, weights.size, 12):
            where = np.unravel_index(at, weights.shape)
            kept, losses = weights[where], []
            for move in (1e-5, -1e-5):
                weights[where] = kept + move
                losses.append(r.window_gradient(model, inputs, targets, h)[0])
            weights[where] = kept
            assert grad[n][where] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-5)


def test_no_state_passes_an_end_in_training():
    """A window with two documents has the loss and gradients of two windows."""
    model = r.Model(small_vocabulary(), hidden=3)
    for n in r.Model.NAMES:
        setattr(model, n, getattr(model, n).astype(np.float64))
    draw, end = np.random.default_rng(3), 2
    one, two = np.append(draw.integers(3, 20, 4), end), np.append(draw.integers(3, 20, 6), end)
    run = np.concatenate((one, two))[:, None]
    before = np.concatenate(([[end]], run[:-1]))
    loss, grad, _ = r.window_gradient(model, before, run, np.zeros((1, 3)), end)
    parts = [
        r.window_gradient(model, before[s], run[s], draw.standard_normal((1, 3)), end)
        for s in (slice(0, 5), slice(5, 12))
    ]
    assert loss == pytest.approx(sum(p[0] for p in parts))
    for n in r.Model.NAMES:
        assert np.allclose(grad[n], sum(p[1][n] for p in parts))


def test_windows_are_worked_out_in_arrays_that_stay():
    """The second window takes no new room to speak of, and the first one's gradients stay."""
    model, draw = r.Model(small_vocabulary()), np.random.default_rng(6)
    inputs, targets = draw.integers(0, 20, (2, 32, 256), dtype=np.int32)
    h = np.zeros((256, r.HIDDEN), np.float32)
    one = r.window_gradient(model, inputs, targets, h, 2)
    kept = {n: g.copy() for n, g in one[1].items()}
    tracemalloc.start()
    two = r.window_gradient(model, inputs, targets, h, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4e6
    assert all((kept[n] == one[1][n]).all() and (kept[n] == two[1][n]).all() for n in kept)


def test_words_are_found_without_a_search():
    draw, ends = np.random.default_rng(7), np.iinfo(np.int64)
    some = np.append(draw.integers(ends.min, ends.max, 3000), (ends.min, ends.max, -1, 0, r.END))
    for listed in (some, some[:1], some[:0], np.arange(-40, 40)):
        listed = np.unique(listed)
        asked = np.concatenate((some, some + 1, listed, np.arange(-50, 50)))
        want = [{v: k for k, v in enumerate(listed.tolist())}.get(v, -1) for v in asked.tolist()[-200:]]
        assert r.Lookup(listed)(asked)[-200:].tolist() == want
        assert r.Lookup(listed)(listed).tolist() == list(range(len(listed)))


def test_powers_of_two():
    x = np.linspace(-115, 115, 100_001, dtype=np.float32)
    got = x.copy()
    r._exp2(got, r.Scratch())
    assert np.abs(got / np.exp2(x.astype(float)) - 1).max() < 4e-6


def test_averages_are_weighted_by_tokens():
    tokens, weights = r._averaged((1, {"u": np.array([0.0])}), (3, {"u": np.array([4.0])}))
    assert tokens == 4 and weights["u"].tolist() == [3.0]


def test_every_token_is_trained_on_once():
    vocabulary = small_vocabulary()
    for n in (1, 31, 32, 33, 7001):
        trainer = r.Trainer(r.Model(vocabulary, hidden=3), 0)
        trainer.read(np.arange(n) % 12)
        assert trainer.tokens == n


def held_out_gain(spark, texts, probe, partitions):
    docs = documents(spark, texts).repartitionByRange(partitions, "doc_id")
    probes = documents(spark, [(-1, probe)])
    row = r.score_documents(probes, docs).collect()[0]
    return (row.score - row.base_score) / row.n_tokens


def test_what_only_the_last_partition_holds_is_learnt(spark):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(12)]
    texts = [" ".join(draw.choices(words, k=120)) for _ in range(400)]
    turns = " ".join(words[k % 12] for k in range(120))
    without = held_out_gain(spark, texts, turns, 4)
    with_turns = held_out_gain(spark, texts + [turns] * 100, turns, 5)
    assert with_turns > without + 0.2


def test_a_few_long_documents_are_learnt_from(spark):
    words = [f"w{k}" for k in range(9)]
    long = " ".join(words[k % 9] for k in range(20_000))
    assert held_out_gain(spark, [long] * 10, " ".join(words * 20), 2) > 0.5


def test_the_output_is_a_distribution():
    vocabulary = small_vocabulary()
    model = r.Model(vocabulary, hidden=4)
    h = np.random.default_rng(1).standard_normal((1, 4)).astype(np.float32)
    symbols = np.arange(12 + r.TAIL_CLASSES)
    logs, _ = model.output(np.repeat(h, len(symbols), axis=0), symbols)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_documents_are_read_whole_and_alone():
    """The score of a document does not depend on its neighbours or on window cuts."""
    vocabulary = small_vocabulary()
    model = r.Model(vocabulary, hidden=4)
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, 20, n).astype(np.int32) for n in (1, 700, 3, 40, 40)]
    together = r.document_logs(model, 0, docs, rows=50)
    for d, got in zip(docs, together, strict=True):
        h, total, before = np.zeros((1, 4), np.float32), 0.0, 0
        for s in d:
            h, _ = model.step(np.array([before]), h)
            total += model.output(h, np.array([s]))[0][0]
            before = s
        assert got == pytest.approx(total, rel=1e-4)
    assert r.document_logs(model, 0, []).shape == (0,)


def test_texts_become_words_once(spark, monkeypatch):
    """Counting, training and scoring read the same lots, whose words and places are the texts."""
    draw, tables = random.Random(4), {}
    plain = r.written
    monkeypatch.setattr(r, "written", lambda df, to, *by: tables.setdefault(to, plain(df, to, *by)))
    texts = [*odd_texts(draw), *[sentence(draw, k) for k in range(40)], None]
    docs = documents(spark, texts)
    r.score_documents(docs, F.col("doc_id") % 3 != 0)
    (_, lots), *rest = ((to.rsplit("/", 1)[1].split("-")[0], df) for to, df in tables.items())
    assert [name for name, _ in rest] == ["words", *["weights"] * r.ROUNDS, "scores"]
    got, hasher = {}, WordHasher()
    for lot in lots.toPandas().itertuples():
        words, places = r._words_of(lot)[0], r._places_of(lot)
        sizes, ids = (np.frombuffer(x, np.int64) for x in (lot.sizes, lot.ids))
        assert lot.tokens == len(places) == sizes.sum()
        assert (np.frombuffer(lot.counts, np.uint32) == np.bincount(places)).all()
        assert all((lot.turn >= 0) == (k % 3 != 0) for k in ids)
        got |= zip(ids.tolist(), np.split(words[places], np.cumsum(sizes)[:-1]), strict=True)
    assert sorted(got) == list(range(len(texts)))
    for k, text in enumerate(texts):
        assert (got[k] == r._tokens([text], hasher)[0]).all()


def test_long_ids_beside_missing_ones_stay_exact(spark):
    docs = documents(spark, [(2**53 + 1, "a b"), (None, "c"), (-(2**62) - 1, None)])
    got = r.score_documents(docs, docs)
    assert {(x.doc_id, x.n_tokens) for x in got.collect()} == {(2**53 + 1, 3), (None, 2), (-(2**62) - 1, 1)}


def test_a_condition_learns_what_its_rows_teach(spark):
    draw = random.Random(9)
    docs = documents(spark, [*[sentence(draw, k) for k in range(60)], None, ""])
    key = lambda x: (x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6))
    one = r.score_documents(docs, F.col("doc_id") % 4 != 0).collect()
    two = r.score_documents(docs, docs.filter("doc_id % 4 != 0")).collect()
    assert len(one) == 62 and Counter(map(key, one)) == Counter(map(key, two))


@pytest.mark.parametrize("listed", [10_000, 20])
def test_scores_of_all_documents(spark, monkeypatch, listed):
    """Base score and counts against plain counting, with and without the join."""
    monkeypatch.setattr(r, "SHORT_WORDS", 15)
    monkeypatch.setattr(r.build_vocabulary, "__defaults__", (listed,))
    draw = random.Random(5)
    texts = [*odd_texts(draw), *[sentence(draw, k) for k in range(60)], "Unseen words only", None]
    rows = [*enumerate(texts), (None, "no id here"), (3, texts[20]), (3, texts[20])]
    docs = documents(spark, rows, extra=True)
    training = docs.filter("doc_id % 3 != 0")
    got = r.score_documents(docs, training).collect()
    assert len(got) == len(rows)

    counts = Counter()
    for doc_id, t in rows:
        if doc_id is not None and doc_id % 3:
            counts.update([*ascii_words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for doc_id, t in rows:
        tokens = [*ascii_words(t), None]
        base = sum(np.log10((counts[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in tokens)
        want[doc_id, len(tokens), sum(counts[x] > 0 for x in tokens), total, round(base, 4)] += 1
    assert Counter((x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 4)) for x in got) == want
    assert all(np.isfinite(x.score) and x.score < 0 for x in got)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert r.score_documents(none, none).collect() == []
    some = documents(spark, ["a b", None])
    got = r.score_documents(some, none).collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens) for x in sorted(got)] == [(3, 0, 0), (1, 0, 0)]
    assert all(np.isfinite(x.score) and np.isfinite(x.base_score) for x in got)


def test_the_model_beats_word_counts_on_held_out_text(spark):
    from siltgate.llm.queries import QUERIES

    got = QUERIES["op7_language_model"](spark, "/root/testdata/sf0.01").filter("held_out")
    sums = got.selectExpr("sum(score) AS s", "sum(base_score) AS b", "sum(n_tokens) AS n").first()
    assert (sums.s - sums.b) / sums.n > 0.15
