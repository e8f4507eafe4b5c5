"""Each stage against brute force, on odd rows, and the whole run."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as cp
from siltgate.llm.common import table
from siltgate.sources import staging_dir, written
from tests.llm import test_native, test_near_duplicates, test_packing
from tests.llm.helpers import documents, odd_texts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and gave."""
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, SF), staging_dir(spark, "test"))
        seen[name] = (docs, out)
        docs = out
    return seen


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name][0].columns == stages[name][1].columns


def test_toxic_documents_go(spark, stages):
    given, left = stages["toxicity"]
    labels = table(spark, SF, "labels")
    toxic = ids(given.join(labels.filter("toxic = 1"), "doc_id"))
    clean = ids(given.join(labels.filter("toxic = 0"), "doc_id"))
    kept = set(ids(left))
    # Eleven toxic labels to learn from: a few clean documents may be taken for toxic.
    assert toxic and not kept & set(toxic)
    assert len(set(clean) - kept) <= 0.05 * len(clean)


def test_texts_in_a_language_stay(stages):
    given, left = stages["language"]
    assert ids(left) == ids(given.filter(r"text RLIKE '\\p{L}'"))


def test_one_of_each_group_stays(stages):
    given, left = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert ids(left) == sorted(d for d, _, c in test_near_duplicates.brute(rows, 5, 80) if d == c)


def test_contaminated_documents_go(spark, stages):
    given, left = stages["decontamination"]
    rows = [(r.doc_id, r.text) for r in given.collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert ids(left) == sorted(r[0] for r in test_native.brute(rows, items) if not r[5])


def test_what_is_left_is_packed(spark, stages):
    given, packed = stages["packing"]
    out = packed.collect()
    rooms = test_packing.check_places([(r.sequence_id, r.offset, r.length) for r in out], 1024)
    assert rooms == test_packing.one_by_one([r.length for r in out], 1024)
    assert {r.doc_id for r in out} == set(ids(given))
    whole = cp.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, out))


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES], ids=[n for n, _ in cp.STAGES])
def test_odd_rows_and_empty_tables(spark, stage):
    texts = odd_texts(random.Random(1))
    docs = documents(spark, [*enumerate(texts), (None, "no id"), (5, texts[5]), (40, None)], lang="en", extra=True)
    for given in (docs, docs.limit(0)):
        out = stage(spark, given, SF)
        if stage is not cp.pack:
            assert out.columns == given.columns
        assert out.count() <= 400
