"""Alignment of two tokenizers over the same text, and how often their tokens meet.

Tokens of A (byte-level) and B (pieces with byte fallback) are laid over the bytes of a
space and the text.  The ends that both share cut the text into groups.  They are found by
galloping: the shorter list of ends drives, each of its ends is looked for in the longer
one from where its neighbours lead, in steps that double until it is passed, then by
halving.  An end's rank there says whether it is shared, and the difference of two
neighbouring ranks which tokens of the longer list a token overlaps.  All ends of a chunk
of documents gallop together, as their bytes put end to end are one text to both.

Tokens are written once as packed ids; counting links and the digest read them from there.
Links are counted inside the tasks before they are shuffled.  The pairs counted most
(``LISTED`` at most) travel to the tasks as two arrays; links of all others are joined with
their counts, so no pair and no link is left out at any size.

NULL and empty texts have no tokens; neither have texts that one of the two does not give
back byte by byte (a U+2581 in the text comes back as a space).  Rows are judged one by
one: repeated rows, repeated and NULL ids stay rows of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import per_process, text_chunks
from siltgate.llm.packing import public_encoder
from siltgate.llm.pieces import MODEL, PieceTable
from siltgate.sources import staging_dir, written

BYTES = "byte_bpe_50k"
#: Pairs that travel to the tasks, 13 bytes each.
LISTED = 1_500_000
#: Tokens of A that a task aligns at a time, about; longer documents are cut at shared ends.
CHUNK_TOKENS = 100_000
#: Different pairs a task holds before it passes its counts on.
_HELD_PAIRS = 2_000_000
_HEADS = 32


# --- galloping ----------------------------------------------------------------


def _search(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Number of smaller elements in ``long`` for each element of ``short``.

    Gallops up or down from ``guess`` until the place is passed, then halves.
    """
    n = len(long)
    # long[low] < x <= long[high], with low = -1 and high = n as the outer bounds.
    low = np.full(len(short), -1)
    high = np.full(len(short), n)
    smaller = long[guess] < short
    low[smaller], high[~smaller] = guess[smaller], guess[~smaller]
    up, down, step = np.flatnonzero(smaller), np.flatnonzero(~smaller), 1
    while len(up) or len(down):
        at = low[up] + step
        at, up = at[at < n], up[at < n]
        passed = long[at] >= short[up]
        high[up[passed]], low[up[~passed]] = at[passed], at[~passed]
        up = up[~passed]
        at = high[down] - step
        at, down = at[at >= 0], down[at >= 0]
        passed = long[at] < short[down]
        low[down[passed]], high[down[~passed]] = at[passed], at[~passed]
        down = down[~passed]
        step *= 2
    left = np.flatnonzero(high - low > 1)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        smaller = long[middle] < short[left]
        low[left[smaller]], high[left[~smaller]] = middle[smaller], middle[~smaller]
        left = left[high[left] - low[left] > 1]
    return high


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Ranks in ``long`` of the rising ``short``, which should be the shorter list.

    Every 32nd element goes first; the others start between their neighbours' ranks.
    """
    m, n = len(short), len(long)
    if not m or not n:
        return np.zeros(m, np.int64)
    heads = np.arange(0, m, _HEADS)
    ranks = _search(short[heads], long, heads * n // m)
    if m <= _HEADS:
        between = np.full(m, ranks[0])
    else:
        between = np.interp(np.arange(m), heads, ranks).astype(np.int64)
    return _search(short, long, np.minimum(between, n - 1))


class Aligned:
    """Groups and links of the tokens of one text, or of several texts end to end.

    ``size_a`` and ``size_b`` are the bytes of each token; both sum up to the same.
    """

    def __init__(self, size_a: np.ndarray, size_b: np.ndarray):
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        self.a_drives = len(ends_a) <= len(ends_b)
        short, long = (ends_a, ends_b) if self.a_drives else (ends_b, ends_a)
        rank = gallop(short, long)
        shared = long[rank] == short if len(short) else np.zeros(0, bool)
        #: Where groups end: places of the last tokens in the short and the long list.
        last = np.flatnonzero(shared), rank[shared]
        self.last_a, self.last_b = last if self.a_drives else last[::-1]
        # A short token meets the long ones from the first that ends beyond its start
        # to the one its own end lies in.
        self.first = np.zeros(len(short), np.int64)
        self.first[1:] = rank[:-1] + shared[:-1]
        self.many = rank - self.first + 1

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two tokens of each link, in order of the driving list."""
        ends = np.cumsum(self.many)
        short = np.repeat(np.arange(len(self.many)), self.many)
        long = np.arange(ends[-1] if len(ends) else 0) + (self.first - ends + self.many)[short]
        return (short, long) if self.a_drives else (long, short)

    def order(self, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of A and of B when groups are written A first, then B."""
        group_a = np.zeros(n_a + 1, np.int64)
        group_a[self.last_a + 1] = 1
        group_b = np.zeros(n_b + 1, np.int64)
        group_b[self.last_b + 1] = 1
        of_a, of_b = np.cumsum(group_a)[:-1], np.cumsum(group_b)[:-1]
        before_a = np.concatenate(([0], self.last_b + 1))[of_a]
        before_b = (self.last_a + 1)[of_b]
        return np.arange(n_a) + before_a, np.arange(n_b) + before_b


# --- tokens -------------------------------------------------------------------


def _id_type(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


class Vocabularies:
    """Bytes of the tokens of both vocabularies, and how ids are packed."""

    def __init__(self, a: str = BYTES, b: str = MODEL):
        import json

        import public_tokenizers as files

        self.first = None  # the encoder of A, made where it is needed

        self.paths = files.path(f"{a}.json"), files.path(f"{a}.tiktoken"), files.PATTERN
        with open(self.paths[0], encoding="utf-8") as text:
            content = json.load(text)
        named = dict(content["model"]["vocab"])
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        back = _byte_letters()
        self.raw_a = [b""] * (max(*named.values(), *special.values()) + 1)
        for piece, i in named.items():
            if piece not in special:
                self.raw_a[i] = bytes(back[c] for c in piece)
        self.pieces = PieceTable(files.path(b))
        self.raw_b = self.pieces.raw
        self.type_a, self.type_b = _id_type(len(self.raw_a)), _id_type(len(self.raw_b))
        self.size_a = np.array([len(r) for r in self.raw_a])
        self.size_b = np.array([len(r) for r in self.raw_b])

    def keys(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, Aligned]:
        """The pair of ids of each link, the place of its token of A, and the alignment."""
        aligned = Aligned(self.size_a[chunk.ids_a], self.size_b[chunk.ids_b])
        at_a, at_b = aligned.links()
        return chunk.ids_a[at_a] * len(self.raw_b) + chunk.ids_b[at_b], at_a, aligned

    def encode(self, texts) -> Iterator[tuple[bytes, bytes]]:
        """Packed ids of both tokenizers; empty where they do not give the text back."""
        if self.first is None:
            self.first = plain_encoder(*self.paths)
        for text in texts:
            if not isinstance(text, str) or not text:
                yield b"", b""
                continue
            target = b" " + text.encode()
            a, b = self.first(" " + text), self.pieces.model.encode(text)
            if _bytes(self.raw_a, a.tolist()) != target or _bytes(self.raw_b, b) != target:
                yield b"", b""
                continue
            yield a.astype(self.type_a).tobytes(), np.array(b, self.type_b).tobytes()


def _bytes(raw: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(raw.__getitem__, ids))


def vocabularies(a: str, b: str) -> Vocabularies:
    return per_process(f"vocabularies {a} {b}", lambda: Vocabularies(a, b))


def plain_encoder(json_path: str, ranks_path: str, pattern: str):
    """``public_encoder`` for texts in which the strings of special tokens are plain text."""
    from tokenizers import Tokenizer

    encode = public_encoder(json_path, ranks_path, pattern)
    plain = Tokenizer.from_file(json_path)
    plain.encode_special_tokens = True
    special = [t.content for t in plain.get_added_tokens_decoder().values()]

    def ids(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(plain.encode(text, add_special_tokens=False).ids, "<u4")
        return encode(text)

    return ids


def _byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for
    itself, the other bytes in their order for U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_rows(docs: DataFrame, a: str = BYTES, b: str = MODEL) -> DataFrame:
    """``row, doc_id, a, b``: packed ids of each row of ``docs``, with a number for the row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabularies(a, b)
        for chunk in text_chunks(batches):
            ids = list(words.encode(chunk["text"]))
            out = pd.DataFrame(ids, columns=["a", "b"])
            out.insert(0, "doc_id", chunk["doc_id"].astype("Int64"))
            yield out

    return (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInPandas(run, "doc_id long, a binary, b binary")
        .withColumn("row", F.monotonically_increasing_id())
    )


@dataclass
class Chunk:
    """Whole documents end to end, or a part of one: ``rows`` says which rows of the batch,
    ``n_a`` and ``n_b`` how many tokens of each; ``last`` that the last row ends here."""

    rows: range
    ids_a: np.ndarray
    ids_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    last: bool = True


def _chunks(batch: pd.DataFrame, words: Vocabularies) -> Iterator[Chunk]:
    """Batches cut by tokens, so that no document is too long to be aligned in pieces."""
    width_a, width_b = np.dtype(words.type_a).itemsize, np.dtype(words.type_b).itemsize
    n_a = batch["a"].str.len().to_numpy(np.int64) // width_a
    n_b = batch["b"].str.len().to_numpy(np.int64) // width_b
    part = (np.cumsum(n_a) - n_a) // CHUNK_TOKENS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        # Only the last document of a part can be longer than a chunk.
        whole = j - 1 if n_a[j - 1] > CHUNK_TOKENS else j
        ids_a, ids_b = (
            np.frombuffer(b"".join(batch[c].iloc[i:whole]), t).astype(np.int64)
            for c, t in (("a", words.type_a), ("b", words.type_b))
        )
        if whole > i:
            yield Chunk(range(i, whole), ids_a, ids_b, n_a[i:whole], n_b[i:whole])
        if whole < j:
            a, b = (np.frombuffer(batch[c].iat[whole], t) for c, t in (("a", words.type_a), ("b", words.type_b)))
            for ids_a, ids_b, last in _pieces(a, b, words):
                n = np.array([len(ids_a)]), np.array([len(ids_b)])
                yield Chunk(range(whole, j), ids_a, ids_b, *n, last)


def _pieces(a: np.ndarray, b: np.ndarray, words: Vocabularies):
    """A long document in parts that end where both have a token's end."""
    at_a = at_b = 0
    width = CHUNK_TOKENS
    while at_a < len(a):
        ids_a = a[at_a : at_a + width].astype(np.int64)
        ids_b = b[at_b : at_b + width].astype(np.int64)
        ends_a, ends_b = np.cumsum(words.size_a[ids_a]), np.cumsum(words.size_b[ids_b])
        rank = gallop(ends_a, ends_b)
        inside = rank < len(ends_b)
        shared = np.flatnonzero(inside & (ends_b[np.minimum(rank, len(ends_b) - 1)] == ends_a))
        if not len(shared):  # no end is shared so far: look further
            width *= 2
            continue
        n_a, n_b = int(shared[-1]) + 1, int(rank[shared[-1]]) + 1
        at_a, at_b = at_a + n_a, at_b + n_b
        yield ids_a[:n_a], ids_b[:n_b], at_a == len(a)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[starts], np.add.reduceat(counts, starts)


def pair_counts(tokens: DataFrame, a: str = BYTES, b: str = MODEL) -> DataFrame:
    """``key, n``: links of each pair of ids in all rows; ``key`` is ``a * size of B + b``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabularies(a, b)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for chunk in (c for batch in batches for c in _chunks(batch, words)):
            keys = words.keys(chunk)[0]
            if not len(keys):
                continue
            held.append(np.unique(keys, return_counts=True))
            size += len(held[-1][0])
            if size > _HELD_PAIRS:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                if 2 * size > _HELD_PAIRS:
                    yield pd.DataFrame({"key": held[0][0], "n": held[0][1]})
                    held, size = [], 0
        if held:
            keys, counts = _summed(*map(np.concatenate, zip(*held, strict=True)))
            yield pd.DataFrame({"key": keys, "n": counts})

    found = tokens.select("a", "b").mapInPandas(run, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def _marked(counts: DataFrame, size_b: int) -> DataFrame:
    """``key, n, best``: whether no other pair of the same B id has more links."""
    # One row per id of B, so never more than the vocabulary has.
    most = counts.groupBy(F.expr(f"key % {size_b}").alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(F.broadcast(most), F.expr(f"key % {size_b} = _b")).selectExpr(
        "key", "n", "n = _most AS best"
    )


def _listed_from(pairs: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs have as many links."""
    sizes = pairs.groupBy(F.expr("length(bin(n))").alias("bits")).count().collect()  # 63 at most
    total, least = 0, 0
    for bits, many in sorted(((r[0], r[1]) for r in sizes), reverse=True):
        total += many
        if total > most:
            return 1 << bits
        least = 1 << (bits - 1)
    return least


# --- digest -------------------------------------------------------------------


def align(
    docs: DataFrame, a: str = BYTES, b: str = MODEL, listed: int = LISTED, with_groups: bool = False
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row
    and, if asked for, ``groups``: ids as ``a1,a2|b1;a3|b2,b3``."""
    spark = docs.sparkSession
    size_b = len(Vocabularies(a, b).raw_b)
    tokens = written(token_rows(docs, a, b), staging_dir(spark, "aligned"))
    counts = written(pair_counts(tokens, a, b), staging_dir(spark, "pairs"))
    pairs = _marked(counts, size_b)
    least = _listed_from(counts, listed)
    top = pairs.filter(F.col("n") >= least).toPandas().sort_values("key")  # ``listed`` at most
    keys = top["key"].to_numpy(np.int64)
    n, best = top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)
    shared = spark.sparkContext.broadcast((keys, n, best))
    rows = _digests(tokens, shared, a, b, with_groups)
    if counts.filter(F.col("n") < least).isEmpty():
        return rows.drop("row")
    rest = (
        _unlisted(tokens, shared, a, b)
        .join(pairs.filter(F.col("n") < least).withColumnRenamed("n", "of_pair"), "key")
        .groupBy("row")
        .agg(
            F.sum(F.expr("IF(best, n, 0)")).alias("more_best"),
            F.sum(F.expr("n * of_pair")).alias("more_sum"),
        )
    )
    more = {"n_best": "more_best", "count_sum": "more_sum"}
    return rows.join(rest, "row", "left").select(
        *[
            F.expr(f"{c} + coalesce({more[c]}, 0) AS {c}") if c in more else F.col(c)
            for c in rows.columns
            if c != "row"
        ]
    )


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key in the sorted ``keys``, and whether it is there."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _by_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return np.diff(sums[ends], prepend=0)


def _digests(tokens: DataFrame, listed, a: str, b: str, with_groups: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabularies(a, b)
        keys, counts, best = listed.value
        n_ids = len(words.raw_a), len(words.raw_b)
        #: Every id with the mark that follows it.
        marked = np.array(
            [f"{i}{mark}" for marks, n in zip((",|", ",;"), n_ids, strict=True) for mark in marks for i in range(n)],
            dtype=object,
        )
        for batch in batches:
            n = np.zeros((6, len(batch)), np.int64)
            shas = [hashlib.sha256() for _ in range(len(batch))]
            groups: list[list[str]] = [[] for _ in range(len(batch))]
            for chunk in _chunks(batch, words):
                wanted, at_a, aligned = words.keys(chunk)
                rows = slice(chunk.rows.start, chunk.rows.stop)
                ends_a, ends_b = np.cumsum(chunk.n_a), np.cumsum(chunk.n_b)
                at, there = _found(keys, wanted)
                at, there = at[there], there.nonzero()[0]
                n[0, rows] += chunk.n_a
                n[1, rows] += chunk.n_b
                n[2, rows] += np.diff(np.searchsorted(aligned.last_a, ends_a), prepend=0)
                # Links come in order of their documents.
                ends = np.searchsorted(at_a, ends_a)
                of_link = np.ones(len(at_a), np.int64)
                n[3, rows] += _by_row(of_link, ends)
                for k, values in ((4, best), (5, counts)):
                    of_link[:] = 0
                    of_link[there] = values[at]
                    n[k, rows] += _by_row(of_link, ends)
                ids_a, ids_b = chunk.ids_a.copy(), chunk.ids_b + 2 * n_ids[0]
                ids_a[aligned.last_a] += n_ids[0]
                ids_b[aligned.last_b] += n_ids[1]
                in_order = np.empty(len(ids_a) + len(ids_b), np.int64)
                place_a, place_b = aligned.order(len(ids_a), len(ids_b))
                in_order[place_a], in_order[place_b] = ids_a, ids_b
                cuts = (ends_a + ends_b).tolist()
                for row, i, j in zip(chunk.rows, [0, *cuts[:-1]], cuts, strict=True):
                    text = "".join(marked[in_order[i:j]])
                    if chunk.last:
                        text = text[:-1]  # no mark after the last group
                    shas[row].update(text.encode())
                    if with_groups:
                        groups[row].append(text)
            names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
            out = pd.DataFrame(
                {"row": batch["row"], "doc_id": batch["doc_id"].astype("Int64")}
                | dict(zip(names, n, strict=True))
                | {"groups_sha256": [s.hexdigest() if k else "" for s, k in zip(shas, n[0], strict=True)]}
            )
            yield out.assign(groups=["".join(g) for g in groups]) if with_groups else out

    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups_sha256 string"
    )
    return tokens.select("row", "doc_id", "a", "b").mapInPandas(
        run, schema + (", groups string" if with_groups else "")
    )


def _unlisted(tokens: DataFrame, listed, a: str, b: str) -> DataFrame:
    """``row, key, n``: links of pairs that are not listed, counted for each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabularies(a, b)
        keys = listed.value[0]
        for batch in batches:
            for chunk in _chunks(batch, words):
                wanted, at_a, _ = words.keys(chunk)
                rest = ~_found(keys, wanted)[1]
                of = np.searchsorted(np.cumsum(chunk.n_a), at_a[rest], side="right")
                row = batch["row"].to_numpy()[chunk.rows.start + of]
                out = pd.DataFrame({"row": row, "key": wanted[rest]})
                yield out.groupby(["row", "key"], as_index=False).size().rename(columns={"size": "n"})

    return tokens.select("row", "a", "b").mapInPandas(run, "row long, key long, n long")
