"""Benchmark decontamination: a hash set of test n-grams against every training window.

Built from DataFrame functions only.  Words are maximal runs of a-z, 0-9 and anything
beyond ASCII, after lower-casing A-Z.  A window is ``n`` words of a test item; an item
with fewer words is one shorter window.  Documents are scanned in three steps, each once
whatever sizes the windows have:

1. every window of every size in use becomes one 64-bit key, the hash of its size, its
   first, last and two inner words, and a hash join with the keys of the test windows keeps
   the positions that may match (the keys are broadcast only if they measure no more than
   ``BROADCAST_BYTES``; otherwise both sides shuffle);
2. positions go back to their document, where all words of the window are cut out and
   compared with the test window (broadcast by its measured width, likewise), so a hash
   collision changes nothing;
3. hit words, hit items and the verdict are counted per document.

Rows are told apart by id and text, so repeated rows get equal answers.  NULL and
wordless texts have no words, no hits and are not contaminated; a NULL id is kept as it
is.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WINDOW_WORDS = 13
BROADCAST_BYTES = 64 * 1024 * 1024
#: What a key takes in a broadcast hash relation, with its slot.
KEY_BYTES = 32


def word_array(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS + "+"), lambda w: w != "")


def _offsets(size: int) -> list[int]:
    """Places of the words that make a window's key."""
    return sorted({0, (size - 1) // 3, 2 * (size - 1) // 3, size - 1})


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, size, gram``: each distinct window of each item as an array of words."""
    return (
        benchmark.select(F.col("item_id"), word_array(F.col("text")).alias("w"))
        .filter("size(w) > 0")
        .selectExpr("item_id", "w", f"least(size(w), {n}) AS size")
        .selectExpr(
            "item_id",
            "size",
            "explode(transform(sequence(1, size(w) - size + 1), i -> slice(w, i, size))) AS gram",
        )
        .distinct()
    )


def _sized(small: DataFrame, size: int) -> DataFrame:
    return F.broadcast(small) if size <= BROADCAST_BYTES else small


def _key(words: str, size: int, first: str) -> str:
    """Hash of a window of ``words`` that starts at place ``first``."""
    return f"xxhash64({size}, {', '.join(f'get({words}, {first} + {p})' for p in _offsets(size))})"


def window_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, text_hash, hit_words, items`` of the documents with a test window.

    ``hit_words`` are the 1-based places of words inside such a window, ``items`` the ids
    of the items it comes from, sorted as text.  Runs one small job that counts and measures
    the test windows by size.
    """
    windows = benchmark_windows(benchmark, n)
    # At most n rows.  An id or a word of a window costs its bytes and a slot.
    width = "sum(aggregate(gram, 64, (n, x) -> n + octet_length(x) + 16)) AS width"
    ids = "sum(octet_length(CAST(item_id AS STRING)) + 24) AS ids"
    sizes = windows.groupBy("size").agg(F.count("*").alias("n"), F.expr(width), F.expr(ids)).collect()
    total = sum(r["n"] for r in sizes)
    wide = sum(r["width"] + (r["ids"] or 0) for r in sizes)
    sizes = sorted(r["size"] for r in sizes)
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    if sizes:
        at_each = ", ".join(
            f"transform(w, (x, i) -> struct({_key('w', s, 'i')} AS key, i + 1 AS pos, {s} AS size))"
            for s in sizes
        )
        in_gram = " ".join(f"WHEN {s} THEN {_key('gram', s, '0')}" for s in sizes)
        keys = windows.selectExpr(f"CASE size {in_gram} END AS key").distinct()
        positions = (
            docs.select("doc_id", "text_hash", word_array(F.col("text")).alias("w"))
            .selectExpr("doc_id", "text_hash", f"inline(concat({at_each}))")
            .join(_sized(keys, total * KEY_BYTES), "key", "left_semi")
        )
    else:
        positions = docs.selectExpr("doc_id", "text_hash", "0 AS pos", "0 AS size").limit(0)
    # Repeated rows find the same places; a set per document is bounded by its words.
    candidates = positions.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("pos", "size")).alias("places")
    )
    grams = windows.groupBy("size", "gram").agg(
        F.collect_set(F.col("item_id").cast("string")).alias("ids")
    )
    return (
        docs.alias("d")
        .join(
            candidates.alias("c"),
            F.expr("d.doc_id <=> c.doc_id AND d.text_hash = c.text_hash"),
        )
        .select("d.doc_id", "d.text_hash", "c.places", word_array(F.col("d.text")).alias("w"))
        .selectExpr(
            "doc_id",
            "text_hash",
            "explode(transform(places, h -> struct(h.pos AS pos, h.size AS size, "
            "slice(w, h.pos, h.size) AS gram))) AS h",
        )
        .select("doc_id", "text_hash", "h.pos", "h.size", "h.gram")
        .join(_sized(grams, wide), ["size", "gram"])
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set(F.struct("pos", "size")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"),
        )
        .selectExpr(
            "doc_id",
            "text_hash",
            "array_sort(array_distinct(flatten(transform(spans, "
            "s -> sequence(s.pos, s.pos + s.size - 1))))) AS hit_words",
            "items",
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, n_words, hit_words, items`` for every row of ``docs``."""
    counted = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.greatest(F.size(word_array(F.col("text"))), F.lit(0)).alias("n_words"),
    )
    return _with_hits(counted, window_hits(docs, benchmark, n)).select(
        "doc_id", "n_words", "hit_words", "items"
    )


def _with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    return (
        rows.alias("d")
        .join(
            hits.alias("v"),
            F.expr("d.doc_id <=> v.doc_id AND d.text_hash = v.text_hash"),
            "left",
        )
        .select(
            "d.*",
            F.expr("coalesce(v.hit_words, CAST(array() AS array<int>))").alias("hit_words"),
            F.expr("coalesce(v.items, CAST(array() AS array<string>))").alias("items"),
        )
    )


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least one word in twenty lies inside a test window."""
    return F.expr(f"{n_hit} > 0 AND 20L * {n_hit} >= {n_words}")


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with all its columns, without the contaminated rows."""
    hits = window_hits(docs, benchmark, n)
    words = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.greatest(F.size(word_array(F.col("text"))), F.lit(0)).alias("n_words"),
    )
    bad = (
        _with_hits(words, hits)
        .withColumn("n_hit", F.size("hit_words"))
        .filter(contaminated())
        .select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text"))
        .distinct()
    )
    return docs.alias("d").join(
        bad.alias("bad"),
        F.expr("d.doc_id <=> bad._bad_id AND xxhash64(d.text) = bad._bad_text"),
        "left_anti",
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, text, n_removed``: each hit word goes with the separators before it."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"({SEPARATORS}*{word})"), 1)
    rest = F.regexp_extract("text", f"({SEPARATORS}*)$", 1)
    left = F.filter(pieces, lambda p, i: ~F.array_contains("hit_words", i + 1))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return _with_hits(rows, window_hits(docs, benchmark, n)).select(
        "doc_id",
        F.when(F.size("hit_words") == 0, F.col("text"))
        .otherwise(F.concat(F.array_join(left, ""), rest))
        .alias("text"),
        F.size("hit_words").alias("n_removed"),
    )


def digest(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """The operator's report: counts, verdict and a hash of the item ids per document."""
    return (
        contamination(docs, benchmark, n)
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.size("hit_words").cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", contaminated())
    )
