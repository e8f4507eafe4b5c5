from __future__ import annotations

import random
import tracemalloc
import weakref

import numpy as np
import pandas as pd
import pytest

from siltgate.llm import near_duplicates as nd
from siltgate.llm import shingles as sh
from siltgate.llm.common import CHUNK_CHARS, WordHasher, ascii_words, text_chunks
from siltgate.llm.components import connected_components
from siltgate.llm.queries import QUERIES
from tests.llm.helpers import documents, odd_texts, sentence


def brute(rows, width, percent):
    """``(doc_id, n_shingles, component)`` of (doc_id, text) rows from sets of word tuples."""
    sets = []
    for _, text in rows:
        w = ascii_words(text)
        n = min(width, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        ((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=repr,
    )


def edited(draw, text, n):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return " ".join(words)


@pytest.mark.parametrize(("width", "percent"), [(4, 80), (5, 80), (2, 50)])
def test_components_equal_brute_force(spark, width, percent):
    draw = random.Random(width)
    texts = odd_texts(draw)
    passage = sentence(draw, 40)
    for size in (1, 2, 3, 5, 30, 200, 400):
        base = sentence(draw, size)
        texts += [base, base.upper(), base + " tail", edited(draw, base, 1), edited(draw, base, 1 + size // 60)]
        texts += [passage + " " + sentence(draw, size)]
    base = sentence(draw, 150)
    texts += [edited(draw, base, k % 9) for k in range(40)]  # a group around the threshold
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [(None, base), (None, None), (1000, "another text under a used id"), rows[-1]]
    got = nd.near_duplicates(documents(spark, rows, extra=True), width, percent, bands=20 if percent > 60 else 40, rows=6 if percent > 60 else 3)
    out = got.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr) == brute(rows, width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_members_that_differ_from_the_centre(spark):
    """A chain: neighbours are similar, ends are not; stars alone would miss links."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " x") for i in range(0, 60, 7)]
    got = nd.near_duplicates(documents(spark, rows), 4, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 4, 80)


def test_blocks_cover_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 4)
    draw = random.Random(3)
    base = sentence(draw, 120)
    rows = [(i, edited(draw, base, i % 10)) for i in range(90)]
    got = nd.near_duplicates(documents(spark, rows), 4, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 4, 80)


def test_bands_that_agree_in_stored_bits_only(spark):
    """A pair away from the centre whose hashes of an earlier band differ above the low 8 bits."""
    draw = random.Random(749)
    w = [f"w{draw.randrange(10**6)}" for _ in range(20)]
    rows = [(0, " ".join(w[:9])), (1, " ".join(w[2:11])), (2, " ".join(w[2:5] + w[11:17]))]
    sets = sh.shingle_sets([t for _, t in rows], 1)
    a, b, centre = (sh.signature(s, sh.multipliers(2)).tolist() for s in sets)
    assert a[0] != b[0] and a[0] % 256 == b[0] % 256 and centre[0] not in (a[0], b[0])
    assert a[1] == b[1] == centre[1] and nd._set_hash(sets[2]) < min(map(nd._set_hash, sets[:2]))
    got = nd.near_duplicates(documents(spark, rows), 1, 50, rows=1, bands=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 1, 50)


def test_empty_table(spark):
    assert nd.near_duplicates(documents(spark, [])).collect() == []


def test_keep_one_of_each_keeps_columns_and_null_ids(spark):
    text = "one two three four five six"
    docs = documents(spark, [(5, text), (3, text), (None, text), (9, "other words here"), (7, None)], extra=True)
    kept = nd.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id) for r in kept.collect()), key=str) == [3, 7, 9, None]


def test_keep_one_of_each_judges_rows(spark):
    """Ids that come twice: a unique text under one stays, repeated rows stay once."""
    text, near = "one two three four five six", "ONE two three four five six"
    rows = [
        (3, text), (5, near), (5, "a text that nothing else resembles at all"),  # (5, near) alone goes
        (3, text), (3, text), (3, near), (8, "some words of its own under eight"), (8, None), (8, None), (None, "null id"),
    ]
    docs = documents(spark, rows, extra=True)
    kept = nd.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "").lower()) for r in kept.collect()), key=repr)
    assert got == sorted([(3, text), (5, rows[2][1]), rows[6], (8, ""), (8, ""), rows[9]], key=repr)


def test_words_are_cut_as_the_contract_says():
    texts = ["a\x0bb\x0cc\x1cd\x85e\xa0f", None, "", "Ä Z", "  x  "]
    hashes, _, counts = WordHasher()(texts)
    assert counts.tolist() == [len(ascii_words(t)) for t in texts] == [3, 0, 0, 2, 1]
    words = [w for t in texts for w in ascii_words(t)]
    assert len(set(hashes.tolist())) == len(set(words))
    assert WordHasher()(["x"])[0][0] == hashes[-1]


def test_prune_limits_follow_the_posterior():
    for n, least in sh.prune_limits(0.8, 1e-3, 16, 64):
        grid = np.linspace(0, 1, 20001)

        def above(m, n=n, grid=grid):
            density = grid**m * (1 - grid) ** (n - m)
            return density[grid >= 0.8].sum() / density.sum()

        assert above(least) >= 1e-3 * 0.98
        assert least == 0 or above(least - 1) < 1e-3 * 1.02


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 160)]
    edges += [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(60)]
    got = {r.v: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert got == {v: x for v, x in label.items() if any(v in e and e[0] != e[1] for e in edges)}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op4_near_duplicates"](spark, sf).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 4, 80)


@pytest.mark.parametrize("middle", [2, None])
def test_a_row_without_an_id_connects_others(spark, middle):
    """1 ~ middle ~ 3, where 1 and 3 are too far apart to be linked themselves."""
    words = [f"w{k}" for k in range(120)]
    texts = [(1, words), (middle, [*words[:-6], *"abcdef"]), (3, [*"uvwxyz", *words[6:-6], *"abcdef"])]
    rows = [(i, " ".join(t)) for i, t in texts] + [(None, "all by itself with no name at all")] * 2
    got = nd.near_duplicates(documents(spark, rows), width=4).collect()
    of = {r["doc_id"]: r["component_id"] for r in got if r["n_shingles"] > 50}
    assert set(of.values()) == {1}
    alone = [r for r in got if r["n_shingles"] < 50]
    assert [(r["component_id"], r["kept"]) for r in alone] == [(None, True)] * 2


def test_tasks_hold_little_at_a_time():
    """A batch goes before the next one is read; the hashes of a chunk take little room."""
    made = []

    def batches():
        for _ in range(3):
            assert all(ref() is None for ref in made)
            batch = pd.DataFrame({"text": ["some words " * 50_000] * 4})
            made.append(weakref.ref(batch))
            yield batch
            del batch

    hasher = WordHasher()
    tracemalloc.start()
    for chunk in text_chunks(batches(), most=nd.CHUNK):
        sh.shingle_sets(chunk["text"].tolist(), 5, hasher)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    assert CHUNK_CHARS <= 1_000_000
