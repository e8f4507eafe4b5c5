from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from siltgate.llm import pieces
from siltgate.llm.queries import QUERIES
from tests.llm.helpers import documents, odd_texts

PATH = public_tokenizers.path(pieces.MODEL)
MODEL = pieces.PieceModel(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)

PARTS = ["a", "b", " ", "  ", "\n", "\t", "é", "漢", "字", "e", "th", "ing", "▁", "0", "<0x41>", "</s>", "😀", "́", "."]


def one_at_a_time(scores, text):
    """Merging as it is defined: the best pair of all, the leftmost of equal ones, again and again."""
    parts = list(text)
    while True:
        pairs = [(-scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
        if not pairs:
            return parts
        k = min(pairs)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PARTS), max_size=30).map("".join)))
def test_ids_and_text_are_those_of_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    ids = LIBRARY.encode(text)
    assert MODEL.encode(text).tolist() == ids
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_any_ids_are_decoded_as_by_the_library(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=2, max_size=5), max_size=25), st.text("abcd", max_size=30), st.randoms())
def test_backtracking_gives_what_merging_gives(words, text, draw):
    ranked = [*"abc", *sorted(words)]
    draw.shuffle(ranked)
    merges = pieces.Merges({w: -float(k) for k, w in enumerate(ranked)})
    expected = one_at_a_time(merges.scores, text)
    assert merges(text) == merges._of_long(text) == expected
    assert pieces.Backtracker(merges)(text) == expected


def test_a_greedy_start_is_taken_back():
    merges = pieces.Merges({"a": -9.0, "b": -9.1, "c": -9.2, "bc": -1.0, "ab": -2.0, "abc": -3.0, "bcc": -4.0})
    split = pieces.Backtracker(merges)
    assert split("abc") == merges("abc") == ["abc"]
    assert split("abcc") == one_at_a_time(merges.scores, "abcc")


@pytest.mark.parametrize("text", [" " * 5000, "x" * 20_000, "ab" * 9000 + " ", "漢" * 3000, "\n" * 4000 + "a  b   c"])
def test_long_runs(text):
    assert MODEL.encode(text).tolist() == LIBRARY.encode(text)


def test_what_is_remembered_is_bounded():
    made = []
    seen = pieces.Memory(lambda key: made.append(key) or key.encode(), 10)
    for k in range(100):
        assert seen[str(k)] == str(k).encode() and seen["often"] == b"often"
        assert len(seen) <= 10 and len(seen.older) <= 10
    assert made.count("often") == 1 and len(made) == 101
    assert seen["x" * 1000] and "x" * 1000 not in seen


def test_rows_of_the_query(spark, tmp_path):
    draw = random.Random(4)
    texts = [*odd_texts(draw), "same", "same", " lead", "two  gaps\nand lines", (None, "no id"), (7, "id twice")]
    documents(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_pieces"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = []
    for k, t in enumerate(texts):
        k, t = t if isinstance(t, tuple) else (k, t)
        ids = LIBRARY.encode(t or "")
        digests = [",".join(map(str, ids)), LIBRARY.decode(ids)]
        expected.append((k, len(ids), *(hashlib.sha256(d.encode()).hexdigest() for d in digests)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_ids_and_text_of_the_operator(spark):
    rows = pieces.tokens(documents(spark, ["hello  world", None])).orderBy("doc_id").collect()
    assert rows[0]["ids"] == LIBRARY.encode("hello  world") and rows[0]["decoded"] == "hello  world"
    assert rows[1]["ids"] == [] and rows[1]["decoded"] == "" and rows[1]["n_tokens"] == 0


def test_no_rows(spark):
    assert pieces.tokens(documents(spark, [])).count() == 0
