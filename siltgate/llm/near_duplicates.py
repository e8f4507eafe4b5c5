"""Near-duplicates by MinHash bands and sequential Bayesian verification.

Texts with the same set of shingles are one class, found by a hash of the whole set, so
exact copies cost one row per task before anything else happens.  Classes are linked if
their sets reach the similarity; the steps are

1. *Bands.*  A signature of ``HASHES`` minima is cut into bands of ``ROWS``; classes that
   agree on a band share a bucket.  A pair of similarity 0.8 misses all buckets with
   probability 5e-6.
2. *Stars.*  Each bucket compares its members with one of them, not with each other, so
   a large group of copies makes as many pairs as members.
3. *Sequential verification.*  Signatures are compared in batches of 16 hashes.  With a
   uniform prior the similarity follows a Beta distribution; a pair whose posterior
   probability of reaching the threshold falls below ``MISS`` is dropped after any batch.
   Survivors are verified on their full shingle sets.
4. *The rest.*  Verified links are contracted to components.  Buckets that still hold
   several components compare members of different ones, in blocks of at most
   ``BLOCK`` against ``BLOCK``: the members of the bucket's largest component only with
   the others, never with each other.  A block answers with the members that need their
   sets, then with verified links, never with a list of candidate pairs.  Nothing is
   capped: every pair that shares a bucket is either in one component already or goes
   through step 3.

Empty documents (NULL, or no words) are linked with nothing.  Rows are judged one by one:
an id that comes twice with different texts is two documents, with the same text two
copies.  A component is named after its smallest non-NULL id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import WordHasher, mix64, text_chunks, whole_groups
from siltgate.llm.components import connected_components
from siltgate.llm.shingles import (
    band_keys,
    multipliers,
    prune_limits,
    shingle_sets,
    signature,
    similar,
    survivors,
)
from siltgate.sources import staging_dir, written

ROWS, BANDS = 6, 40
HASHES = ROWS * BANDS
MISS = 1e-6
BLOCK = 512
#: Characters hashed at a time.
CHUNK = 500_000
#: Ids, 16 bytes each, that a broadcast may hold.
BROADCAST_IDS = 2_000_000


def _set_hash(s: np.ndarray) -> int:
    """Order-free hash of a whole set; NULL (None) for the empty one."""
    parts = mix64(np.append(s, np.uint64(len(s))))
    return int(mix64(parts.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def document_classes(docs: DataFrame, width: int, hashes: int = HASHES, rows: int = ROWS) -> DataFrame:
    """``doc_id, h, n_shingles, v, sig, bands``; ``v`` names the shingle set, NULL if empty.

    ``h`` is a hash of the text as it is.
    """
    drawn = multipliers(hashes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for chunk in text_chunks(batches, most=CHUNK):
            sets = shingle_sets(chunk["text"].tolist(), width, hasher)
            full = [s for s in sets if len(s)]
            sigs = np.array([signature(s, drawn) for s in full], dtype=np.uint32).reshape(-1, hashes)
            keys = iter(band_keys(sigs, rows))
            short = iter((sigs & np.uint32(255)).astype(np.uint8))
            yield pd.DataFrame(
                {
                    "doc_id": chunk["doc_id"].astype("Int64"),
                    "h": chunk["h"],
                    "n_shingles": [len(s) for s in sets],
                    "v": pd.array([_set_hash(s) if len(s) else None for s in sets], dtype="Int64"),
                    "sig": [next(short).tobytes() if len(s) else None for s in sets],
                    "bands": [next(keys) if len(s) else None for s in sets],
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h")).mapInPandas(
        run, "doc_id long, h long, n_shingles long, v long, sig binary, bands array<long>"
    )


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``v, set`` of the wanted classes (``v, doc_id, h``), read again from one text of each.

    A class is found by an id; one whose rows have none, by the hash of a text among the
    rows without an id, of which each task keeps one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for chunk in text_chunks(batches, most=CHUNK):
            sets = shingle_sets(chunk["text"].tolist(), width, hasher)
            out = chunk[["v"]].assign(set=[s.tobytes() for s in sets])
            yield out[[len(s) > 0 and _set_hash(s) == v for s, v in zip(sets, chunk["v"], strict=True)]]

    wanted = written(wanted, staging_dir(docs.sparkSession, "wanted"))
    n = wanted.selectExpr("count(doc_id) AS named", "count_if(doc_id IS NULL) AS nameless").first()
    named, nameless = (wanted.filter(f"doc_id IS {part} NULL") for part in ("NOT", ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.join(
        F.broadcast(named) if n["named"] <= BROADCAST_IDS else named, "doc_id"
    ).select("v", "text")
    if n["nameless"]:
        nameless = nameless.select("v", "h")
        by_text = rows.filter("doc_id IS NULL").selectExpr("xxhash64(text) AS h", "text").join(
            F.broadcast(nameless) if n["nameless"] <= BROADCAST_IDS else nameless, "h"
        )
        found = found.unionByName(by_text.groupBy("v").agg(F.first("text").alias("text")))
    sets = found.mapInPandas(run, "v long, set binary")
    return written(sets.dropDuplicates(["v"]), staging_dir(docs.sparkSession, "sets"))


def _prune(pairs: DataFrame, sigs: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """Pairs ``a, b`` that sequential comparison of their signatures leaves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            left, right = (
                np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1)
                for c in ("sig_a", "sig_b")
            )
            yield batch.iloc[survivors(left, right, limits)[0]][["a", "b"]]

    with_a = pairs.join(sigs.selectExpr("v AS a", "sig AS sig_a"), "a")
    both = with_a.join(sigs.selectExpr("v AS b", "sig AS sig_b"), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInPandas(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch["set_a"], batch["set_b"], strict=True)
            ]
            yield batch[["a", "b"]][keep]

    with_a = pairs.join(sets.selectExpr("v AS a", "set AS set_a"), "a")
    both = with_a.join(sets.selectExpr("v AS b", "set AS set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInPandas(run, "a long, b long")


def _blocks(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``key, band, part, side, v, label`` of the comparisons that are still to be made.

    A part is one block of the smaller components of a bucket against one block of its
    largest (sides 0 and 1) or against one of the smaller (0 and 1, or 2 for a block
    against itself).
    """
    here = written(
        buckets.join(labels, "v", "left").selectExpr(
            "key", "band", "v", "coalesce(label, v) AS label"
        ),
        staging_dir(buckets.sparkSession, "labelled"),
    )
    mixed = (
        here.groupBy("key", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(
            F.expr("max(struct(n, label)) AS top"),
            F.sum("n").alias("n"),
            F.count("*").alias("n_labels"),
        )
        .filter("n_labels > 1")
        .selectExpr(
            "key",
            "top.label AS top",
            f"CAST(ceil(top.n / {BLOCK}) AS INT) AS many",
            f"CAST(ceil((n - top.n) / {BLOCK}) AS INT) AS few",
        )
    )
    rows = here.join(mixed, "key").selectExpr(
        "key", "band", "v", "label", "many", "few", "label = top AS is_top",
        "CAST(pmod(xxhash64(v), IF(label = top, many, few)) AS INT) AS own",
    )
    # Parts: f * (many + few) + j; j < many is a block of the largest component.
    return rows.selectExpr(
        "key", "band", "v", "label",
        "explode(IF(is_top,"
        " transform(sequence(0, few - 1), f -> struct(f * (many + few) + own AS part, 1 AS side)),"
        " concat(transform(sequence(0, many - 1), j -> struct(own * (many + few) + j AS part, 0 AS side)),"
        "  transform(sequence(0, few - 1), f -> struct("
        "   least(f, own) * (many + few) + many + greatest(f, own) AS part,"
        "   IF(f = own, 2, IF(own < f, 0, 1)) AS side))))) AS p",
    ).select("key", "band", "p.part", "p.side", "v", "label")


def _pairs_of_block(part: pd.DataFrame, limits: list[tuple[int, int]]):
    """Unordered places of a block's pairs that pass the signatures, each pair in one band only.

    ``earlier`` holds the keys of the bands before this one, whole: signatures keep 8 bits of
    a hash, so two may agree on a band without a common bucket there.
    """
    side, label = part["side"].to_numpy(), part["label"].to_numpy()
    sigs = np.frombuffer(b"".join(part["sig"]), np.uint8).reshape(len(part), -1)
    earlier = np.array(part["earlier"].tolist(), dtype=np.int64).reshape(len(part), -1)
    zero, one = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    for i in zero:
        js = one[(label[one] != label[i]) & ((side[one] == 1) | (one > i))]
        if not len(js):
            continue
        # A pair that shares an earlier bucket is compared there.
        js = js[~(earlier[js] == earlier[i]).any(axis=1)]
        left = np.broadcast_to(sigs[i], (len(js), sigs.shape[1]))
        for j in js[survivors(left, sigs[js], limits)[0]]:
            yield int(i), int(j)


def _rest_of_links(
    docs: DataFrame, ids: DataFrame, buckets: DataFrame, sigs: DataFrame, labels: DataFrame,
    width: int, percent: int, limits: list[tuple[int, int]],
) -> DataFrame:
    spark = docs.sparkSession

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, ("key", "part")):
            hit = sorted({x for pair in _pairs_of_block(part, limits) for x in pair})
            if hit:
                yield part.iloc[hit]

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, ("key", "part")):
            sets = [np.frombuffer(s, np.uint64) for s in part["set"]]
            v, label, root = part["v"].to_numpy(), part["label"].to_numpy(), {}
            out = []

            def find(x, root=root):
                while root.get(x, x) != x:
                    x = root[x]
                return x

            for i, j in _pairs_of_block(part, limits):
                x, y = find(label[i]), find(label[j])
                # Two components that this block has joined need no second link.
                if x != y and similar(sets[i], sets[j], percent):
                    root[x] = y
                    out.append((v[i], v[j]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    schema = "key long, part int, side int, v long, label long, sig binary, earlier array<long>"
    todo = _blocks(buckets, labels).join(sigs, "v").selectExpr(
        "key", "part", "side", "v", "label", "sig", "slice(bands, 1, band) AS earlier"
    )
    asked = written(
        todo.repartition("key", "part").sortWithinPartitions("key", "part", "v").mapInPandas(needed, schema),
        staging_dir(spark, "blocks"),
    )
    sets = _sets_of(docs, ids.join(asked.select("v").distinct(), "v", "left_semi"), width)
    return (
        asked.join(sets, "v")
        .repartition("key", "part")
        .sortWithinPartitions("key", "part", "v")
        .mapInPandas(linked, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS,
    rows: int = ROWS, bands: int = BANDS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Links documents whose sets of ``width``-word shingles have
    ``100 * |A & B| >= percent * |A | B|``.  Tables in between go to the shared folder.

    Rows with a NULL id link like others, so they may connect two documents; they are never
    the smallest id, and a component of such rows alone has a NULL ``component_id``, of which
    all are ``kept``.  Empty and NULL texts are alone and kept, rows of one id are judged one
    by one.
    """
    return _judged(docs, width, percent, miss, rows, bands).drop("h", "root")


def _judged(
    docs: DataFrame, width: int, percent: int, miss: float = MISS, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """Rows of ``near_duplicates`` with ``h`` of the text and ``root``, one value per component.

    ``root`` is NULL for empty documents.
    """
    spark = docs.sparkSession
    limits = prune_limits(percent / 100, miss, hashes=rows * bands)
    classes = written(
        document_classes(docs, width, rows * bands, rows), staging_dir(spark, "classes")
    )
    texts = classes.filter("v IS NOT NULL")
    # Copies have equal signatures; one row of each class is enough.
    one = written(
        texts.groupBy("v").agg(
            F.min("doc_id").alias("doc_id"), F.min("h").alias("h"), F.expr("min(struct(sig, bands)) AS s")
        ).selectExpr("v", "doc_id", "h", "s.sig AS sig", "s.bands AS bands"),
        staging_dir(spark, "signatures"),
    )
    ids = one.select("v", "doc_id", "h")
    sigs = one.select("v", "sig")
    banded = one.select("v", F.posexplode("bands").alias("band", "key"))
    shared = (
        banded.groupBy("key")
        .agg(F.min("v").alias("center"), F.max("v").alias("last"))
        .filter("center < last")
        .select("key", "center")
    )
    buckets = written(
        banded.join(shared, "key").select("key", "band", "v", "center"), staging_dir(spark, "buckets")
    )
    stars = buckets.filter("v <> center").selectExpr("v AS a", "center AS b").distinct()
    alive = written(_prune(stars, sigs, limits), staging_dir(spark, "pairs"))
    wanted = alive.selectExpr("a AS v").unionByName(alive.selectExpr("b AS v")).distinct()
    sets = _sets_of(docs, ids.join(wanted, "v", "left_semi"), width)
    links = written(_verify(alive, sets, percent), staging_dir(spark, "links"))
    labels = connected_components(links)
    more = written(
        _rest_of_links(
            docs, ids, buckets.drop("center"), one.drop("doc_id", "h"), labels, width, percent, limits
        ),
        staging_dir(spark, "links"),
    )
    if not more.isEmpty():
        contracted = labels.selectExpr("v AS a", "label AS b")
        labels = connected_components(contracted.unionByName(more))
    return _components(classes, one.selectExpr("v", "doc_id AS least"), labels)


def _components(classes: DataFrame, ids: DataFrame, labels: DataFrame) -> DataFrame:
    # Few classes are linked at all; the others are components of their own.
    linked = labels.join(ids, "v")
    named = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    joined = linked.join(named, "label").select("v", "label", "component_id")
    of_class = ids.join(joined, "v", "left").selectExpr(
        "v", "coalesce(label, v) AS root", "coalesce(component_id, least) AS component_id"
    )
    return (
        classes.select("doc_id", "h", "n_shingles", "v")
        .join(of_class, "v", "left")
        .select(
            "doc_id",
            "h",
            "root",
            "n_shingles",
            F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", _same("doc_id", "component_id"))
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, one row of each component.

    It is that with the smallest id, then the smallest hash of its text; of rows equal in
    both any one.  Rows with a NULL id and empty documents stay.
    """
    spark = docs.sparkSession
    judged = _judged(docs, width, percent).filter("root IS NOT NULL AND doc_id IS NOT NULL")
    texts = written(
        judged.groupBy("root", "doc_id", "h").agg(F.count("*").alias("n")), staging_dir(spark, "texts")
    )
    first = texts.groupBy("root").agg(F.expr("min(struct(doc_id, h)) AS s"))
    first = first.selectExpr("s.doc_id AS doc_id", "s.h AS h")
    gone = texts.join(first, ["doc_id", "h"], "left_anti")
    again = written(
        texts.filter("n > 1").join(first, ["doc_id", "h"], "left_semi"), staging_dir(spark, "again")
    )
    here = ["CAST(d.doc_id AS BIGINT)", "xxhash64(d.text)"]
    same = F.expr(f"{here[0]} = t.doc_id AND {here[1]} = t.h")
    left = docs.alias("d").join(gone.alias("t"), same, "left_anti")
    if again.isEmpty():
        return left
    once = left.alias("d").join(again.alias("t"), same, "left_anti")
    several = left.alias("d").join(again.alias("t"), same, "left_semi").alias("d")
    one = several.groupBy(*map(F.expr, here)).agg(F.first(F.struct("d.*")).alias("r"))
    return once.unionByName(one.select("r.*"))
