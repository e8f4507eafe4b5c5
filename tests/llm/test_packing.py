from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltgate.llm import packing
from siltgate.llm.queries import QUERIES
from tests.llm.helpers import documents, odd_texts, sentence


def one_by_one(lengths, capacity):
    """Room left in each sequence when every piece is placed for itself."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def check_places(places, capacity):
    """``places``: (sequence, offset, length); gapless from 0 and within the capacity."""
    by = {}
    for s, o, n in places:
        by.setdefault(s, []).append((o, n))
    rooms = []
    for v in by.values():
        end = 0
        for o, n in sorted(v):
            assert o == end
            end += n
        assert end <= capacity
        rooms.append(capacity - end)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=150))))
def test_steps_equal_placing_one_by_one(case):
    capacity, lengths = case
    places, counted = [], Counter()
    for s in packing.best_fit_decreasing(Counter(lengths), capacity):
        assert s.first_rank == counted[s.length]
        counted[s.length] += s.pieces
        places += [(s.sequence + j // s.each, s.offset + j % s.each * s.length, s.length) for j in range(s.pieces)]
    assert counted == Counter(lengths)
    assert check_places(places, capacity) == one_by_one(lengths, capacity)


def test_the_tree_finds_the_least_room():
    draw = random.Random(1)
    tree, on = packing.CapacityTree(37), set()
    for _ in range(2000):
        room = draw.randint(0, 37)
        (on.discard if room in on else on.add)(room)
        tree.set(room, room in on)
        size = draw.randint(1, 37)
        assert tree.least_from(size) == min((r for r in on if r >= size), default=None)


def test_lengths_that_do_not_fit_are_refused():
    with pytest.raises(ValueError, match="does not fit"):
        packing.best_fit_decreasing({11: 1}, 10)


def encoders():
    import public_tokenizers as p
    from tokenizers import Tokenizer

    names = [p.path(f"byte_bpe_50k.{e}") for e in ("json", "tiktoken")]
    return packing.public_encoder(*names, p.PATTERN), Tokenizer.from_file(names[0])


def test_both_ways_to_the_ids_agree():
    encode, exact = encoders()
    draw = random.Random(2)
    alphabet = [chr(c) for c in range(0x250)] + list("  \n\t'srtm dléñß漢😀")
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 60))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "a <|endoftext|> b", "a" * 3000, "x\x85y\xa0\x1cz  \n\n 'll 'LL", *filter(None, odd_texts(draw))]
    for t in texts:
        assert encode(t).tolist() == exact.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("buckets", [1, 7])
def test_pieces_of_all_documents(spark, monkeypatch, buckets):
    if buckets > 1:
        monkeypatch.setattr(packing, "BUCKET_ROWS", 20)
    draw = random.Random(3)
    texts = [*odd_texts(draw), *[sentence(draw, k % 90) for k in range(120)]]
    rows = [*enumerate(texts), (None, "no id"), (3, "again three"), (3, "again three")]
    packed = packing.pack_documents(documents(spark, rows, extra=True), capacity=128, with_ids=True)
    out = packed.collect()
    _, exact = encoders()
    want = Counter()
    for doc_id, t in rows:
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 2]
        starts = packing.cut_points(len(ids), 128)
        assert all(b - a == 128 for a, b in zip(starts[1:], [*starts[2:], len(ids)], strict=False))
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    rooms = check_places([(r.sequence_id, r.offset, r.length) for r in out], 128)
    assert rooms == one_by_one([r.length for r in out], 128)
    whole = {r.sequence_id: r.ids for r in packing.sequence_rows(packed).collect()}
    for r in out:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, [])).collect() == []


def test_query_packs_every_document(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op6_packing"](spark, sf).collect()
    rooms = check_places([(r.sequence_id, r.offset, r.length) for r in out], 1024)
    assert rooms == one_by_one([r.length for r in out], 1024)
    assert {r.doc_id for r in out} == {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
