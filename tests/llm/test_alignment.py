from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltgate.llm import alignment
from siltgate.llm.queries import QUERIES
from tests.llm.helpers import documents, odd_texts

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
WORDS = alignment.Vocabularies()


def spans(ids, raw):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(raw[i])))
        at += len(raw[i])
    return out


def brute_force(rows):
    """The same digest token by token, with the libraries' own ids."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = b = []
        if text:
            target = (" " + text).encode()
            a = spans(a_model.encode(" " + text, add_special_tokens=False).ids, WORDS.raw_a)
            b = spans(b_model.encode(text), WORDS.raw_b)
            if any(b"".join(raw[t[0]] for t in x) != target for x, raw in ((a, WORDS.raw_a), (b, WORDS.raw_b))):
                a = b = []
        links, first = [], 0
        for i, start, end in a:
            while first < len(b) and b[first][2] <= start:
                first += 1
            k = first
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        counts.update(links)
        found.append((doc_id, a, b, links))
    most = Counter()
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, a, b, links in found:
        shared = sorted({t[2] for t in a} & {t[2] for t in b})
        groups = [([], []) for _ in shared]
        for side, tokens in enumerate((a, b)):
            for i, _, end in tokens:
                groups[bisect_left(shared, end)][side].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in groups]
        text = ";".join(groups)
        out.append(
            (
                doc_id, len(a), len(b), len(shared), len(links),
                sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return out


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 400), max_size=120), st.sets(st.integers(0, 400), max_size=300))
def test_galloping_finds_the_ranks(short, long):
    short, long = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    if len(long):
        assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def test_galloping_over_uneven_stretches():
    draw = np.random.default_rng(3)
    long = np.cumsum(np.concatenate([draw.integers(1, 3, 20_000), draw.integers(1, 900, 500), np.ones(20_000, int)]))
    short = np.unique(draw.choice(np.concatenate((long, long + 1, [0, long[-1] + 9])), 3000))
    assert (alignment.gallop(short, long) == np.searchsorted(long, short)).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=40), st.lists(st.integers(1, 6), min_size=1, max_size=40))
def test_links_are_all_overlaps(a, b):
    a, b = a + [max(1, sum(b) - sum(a))] * (sum(b) > sum(a)), b + [max(1, sum(a) - sum(b))] * (sum(a) > sum(b))
    aligned = alignment.Aligned(np.array(a), np.array(b))
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    expected = {
        (i, j)
        for i in range(len(a))
        for j in range(len(b))
        if max(ends_a[i] - a[i], ends_b[j] - b[j]) < min(ends_a[i], ends_b[j])
    }
    links = list(zip(*(x.tolist() for x in aligned.links()), strict=True))
    assert len(links) == len(expected) and set(links) == expected
    assert ends_a[aligned.last_a].tolist() == sorted(set(ends_a) & set(ends_b))
    places = np.concatenate(aligned.order(len(a), len(b)))
    assert sorted(places.tolist()) == list(range(len(a) + len(b)))


def texts(draw):
    return [
        *odd_texts(draw), "same words here", "same words here", "a▁b", "x<|endoftext|>y </s>", "漢字かな 😀  end",
        "tabs\t\tand\n\nlines  ", "The tokenization of antidisestablishmentarianism",
    ]


def test_rows_of_the_query(spark, tmp_path):
    rows = list(enumerate(texts(random.Random(5)))) + [(None, "no id"), (3, "id twice")]
    documents(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_alignment"](spark, str(tmp_path))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_force(rows), key=repr)


def test_pairs_beyond_the_listed_ones_count_too(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(alignment, "_HELD_PAIRS", 40)
    rows = list(enumerate(texts(random.Random(6))))
    expected = sorted(brute_force(rows), key=repr)
    for listed in (0, 40, 10**6):
        got = alignment.align(documents(spark, rows), listed=listed)
        assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_groups_of_the_operator(spark):
    row = alignment.align(documents(spark, ["hello world"]), with_groups=True).collect()[0]
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]
    groups = [[list(map(int, side.split(","))) for side in g.split("|")] for g in row["groups"].split(";")]
    for a, b in groups:
        assert b"".join(WORDS.raw_a[i] for i in a) == b"".join(WORDS.raw_b[i] for i in b)


def test_no_rows_and_no_tokens(spark):
    assert alignment.align(documents(spark, [])).count() == 0
    assert [tuple(r)[1:] for r in alignment.align(documents(spark, [None, ""])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_what_decides_the_listed_pairs(spark):
    pairs = spark.createDataFrame([(k, n) for k, n in enumerate([1, 1, 2, 3, 4, 9])], "key long, n long")
    assert [alignment._listed_from(pairs, most) for most in (6, 5, 4, 2, 1, 0)] == [1, 2, 2, 4, 8, 16]
