"""Best-fit decreasing packing of token pieces into sequences.

Pieces are placed in order of falling length, each into the open sequence with the least
room that still fits, or into a new one.  A segment tree over the possible remaining
capacities finds that sequence in logarithmic time.  Equal lengths and equal capacities
are interchangeable, so the packing works on counts: the tree's leaves hold groups of
sequences with the same room, and one step places as many pieces of one length as fill a
group.  The result is exactly that of placing pieces one by one, while the driver's work
depends on the capacity alone, not on the number of pieces.

Spark then deals the places out: pieces of one length are numbered (in buckets of bounded
size, whose starts are a running sum), and a piece's number falls into one of the steps,
which says sequence and offset.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.llm.common import text_chunks
from siltgate.sources import staging_dir, written

CAPACITY = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"
BUCKET_ROWS = 10_000
_MERGED_ALIKE = 0x0250  # below: Latin letters, where both libraries cut words alike


class CapacityTree:
    """Which remaining capacities are on offer; the least one that fits in log time."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width < capacity + 1:
            self.width *= 2
        self.filled = bytearray(2 * self.width)

    def set(self, room: int, present: bool) -> None:
        k = self.width + room
        self.filled[k] = present
        while k > 1:
            k //= 2
            self.filled[k] = self.filled[2 * k] | self.filled[2 * k + 1]

    def least_from(self, size: int) -> int | None:
        """The least capacity of at least ``size`` that some sequence has left."""
        k = self.width + size
        if self.filled[k]:
            return size
        while k > 1 and (k % 2 or not self.filled[k + 1]):
            k //= 2
        if k <= 1:
            return None
        k += 1
        while k < self.width:
            k = 2 * k if self.filled[2 * k] else 2 * k + 1
        return k - self.width


@dataclass(frozen=True)
class Step:
    """Pieces ``first_rank ..`` of a length go, ``each`` to a sequence, from ``sequence`` on."""

    length: int
    first_rank: int
    pieces: int
    sequence: int
    each: int
    offset: int


def best_fit_decreasing(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Step]:
    """The steps that place ``counts[length]`` pieces of each length, 1 to ``capacity``."""
    tree = CapacityTree(capacity)
    groups: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, how many)
    steps, opened = [], 0

    def offer(room: int, first: int, many: int) -> None:
        if many and room:
            groups.setdefault(room, []).append((first, many))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit into {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = tree.least_from(length)
            if room is None:
                room, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            else:
                first, many = groups[room].pop()
                if not groups[room]:
                    tree.set(room, False)
            each = room // length
            full = min(many, left // each)
            placed = full * each
            if full:
                steps.append(Step(length, rank, placed, first, each, capacity - room))
                offer(room - each * length, first, full)
                rank, left = rank + placed, left - placed
            if left and full < many:  # the last pieces do not fill a sequence
                steps.append(Step(length, rank, left, first + full, each, capacity - room))
                offer(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            offer(room, first + full, many - full)
    return steps


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; pieces of length 0 get NULL for both.

    ``pieces`` should be a written table: it is read twice.  Brings one count per length
    to the driver.  Equal rows are pieces of their own.
    """
    columns = pieces.columns
    counts = {
        r[0]: r[1]
        for r in pieces.filter(F.col(length) > 0).groupBy(length).agg(F.count("*")).collect()
    }
    steps = best_fit_decreasing(counts, capacity)
    buckets = sum(counts.values()) // BUCKET_ROWS + 1
    dealt = pieces.withColumn(
        "_bucket", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(buckets))
    )
    in_bucket = Window.partitionBy(length, "_bucket").orderBy(*[F.col(f"`{c}`") for c in columns])
    before = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(length, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(F.col(length).alias("_length"), F.col("_bucket").alias("_of"), "_start")
    )
    ranked = (
        dealt.withColumn("_k", F.row_number().over(in_bucket) - 1)
        .join(starts, (F.col(length) == F.col("_length")) & (F.col("_bucket") == F.col("_of")), "left")
        .withColumn("_rank", F.col("_start") + F.col("_k"))
    )
    spark = pieces.sparkSession
    table = spark.createDataFrame(
        [(s.length, s.first_rank, s.first_rank + s.pieces, s.sequence, s.each, s.offset) for s in steps],
        "_len long, _from long, _to long, _seq long, _each long, _off long",
    )
    placed = ranked.join(
        F.broadcast(table),  # steps depend on the capacity, not on the number of pieces
        (F.col(length) == F.col("_len")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
        "left",
    )
    return placed.select(
        *[F.col(f"`{c}`") for c in columns],
        F.expr("_seq + (_rank - _from) DIV _each").alias("sequence_id"),
        F.expr(f"_off + pmod(_rank - _from, _each) * `{length}`").alias("offset"),
    )


def cut_points(n_ids: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of the pieces of a document: all full but the first, which takes the rest."""
    first = n_ids % capacity or min(capacity, n_ids)
    return [0, *range(first, n_ids, capacity)]


def public_encoder(json_path: str, ranks_path: str, pattern: str):
    """Function from text to ids (uint32) of the tokenizer file.

    Texts of Latin letters go through the rank file of the same vocabulary, which gives
    the same ids four times faster; other texts, and those that spell a special token,
    go through the tokenizer file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL not in text and (text.isascii() or ord(max(text)) < _MERGED_ALIKE):
            return np.array(fast.encode_ordinary(text), dtype="<u4")
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
    vocabulary: str = "byte_bpe_50k",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is the ids of its whole text and then ``end_id``; NULL is an empty text.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        encode = public_encoder(
            public_tokenizers.path(f"{vocabulary}.json"),
            public_tokenizers.path(f"{vocabulary}.tiktoken"),
            public_tokenizers.PATTERN,
        )
        for chunk in text_chunks(batches):
            rows = []
            for doc_id, text in zip(chunk["doc_id"], chunk["text"], strict=True):
                ids = np.append(encode(text if isinstance(text, str) else ""), np.uint32(end_id))
                ids = ids.astype("<u4")
                starts = cut_points(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    part = ids[a:b].tobytes()
                    row = (doc_id, k, a, b - a, zlib.crc32(part))
                    rows.append((*row, ids[a:b].tolist()) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        cut, schema + (", ids array<long>" if with_ids else "")
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places; pieces are written once in between."""
    pieces = token_pieces(docs, capacity, with_ids=with_ids)
    return pack(written(pieces, staging_dir(docs.sparkSession, "pieces")), capacity)


def sequence_rows(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the sequences themselves, from pieces packed with their ids."""
    return packed.groupBy("sequence_id").agg(
        F.expr("flatten(transform(array_sort(collect_list(struct(offset, ids))), x -> x.ids))").alias("ids")
    )
