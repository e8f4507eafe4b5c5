"""What several operators share: tables, row keys, hashes of words, small linear models."""

from __future__ import annotations

import functools
import pickle
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of text that one task holds as Python words at a time.
CHUNK_CHARS = 1_000_000

_TOKENS = re.compile(r"[^\W\d_]+|[^\w\s]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else, unlike ``lower``."""
    return F.translate(column, UPPER, LOWER)


def crc_mod(doc_id: str, n: int) -> Column:
    """Remainder of the CRC-32 of the id's text; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def per_process(name: str, make):
    """What ``make()`` gives, made once in each Python process.

    Spark's Python workers go from task to task, but functions arrive anew each time and
    lose what they had in their globals; this is kept where modules are.
    """
    kept = sys.modules.setdefault("_siltgate_kept", types.ModuleType("_siltgate_kept")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def merged_states(states: DataFrame, merge, fan_in: int = 8):
    """One state of the pickled ones in ``states`` (part, state); None if there are none.

    ``part`` numbers the tasks that made them.  They are merged ``fan_in`` at a time in as
    many rounds as it takes, so neither a task nor the driver ever holds more.
    """

    def both(one, two):
        return two if one is None else merge(one, two)

    def of_group(group: pd.DataFrame) -> pd.DataFrame:
        whole = functools.reduce(both, map(pickle.loads, group["state"]), None)
        return pd.DataFrame({"part": group["part"].min(), "state": [pickle.dumps(whole)]})

    last = states.agg(F.max("part")).first()[0]
    lanes = 0 if last is None else last + 1
    while lanes > fan_in:
        lanes = -(-lanes // fan_in)
        states = (
            states.withColumn("part", F.col("part") % lanes)
            .groupBy("part")
            .applyInPandas(of_group, "part long, state binary")
        )
    found = (pickle.loads(row["state"]) for row in states.orderBy("part").collect())
    return functools.reduce(both, found, None)


def text_chunks(
    batches: Iterator[pd.DataFrame], text: str = "text", most: int = CHUNK_CHARS
) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches so that no chunk has much more than ``most`` characters.

    Rows stay whole: a longer text is a chunk of its own.
    """
    for batch in batches:
        if not len(batch):
            continue
        size = batch[text].str.len().fillna(0).to_numpy(dtype=np.int64)
        part = (np.cumsum(size) - size) // most
        for start, end in _runs(part):
            yield batch.iloc[start:end].reset_index(drop=True)
        del batch, size, part  # not kept while the next one is read


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def whole_groups(
    batches: Iterator[pd.DataFrame], keys: tuple[str, ...]
) -> Iterator[pd.DataFrame]:
    """Groups of rows with equal ``keys`` from batches that are sorted by them.

    A batch may end within a group; its last group waits for the next batch.
    """
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        new = np.zeros(len(batch), dtype=bool)
        for key in keys:
            values = batch[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield batch.iloc[a:b]
        rest = batch.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z, then words between space, tab, LF, VT, FF and CR.

    ``bytes.split`` cuts at exactly these six, ``bytes.lower`` changes A-Z alone.
    """
    return [] if text is None else text.encode("utf-8", "replace").lower().split()


def hash64(words: list) -> np.ndarray:
    """64-bit SipHash of each word (str or bytes); equal words are hashed once."""
    if not words:
        return np.empty(0, np.uint64)
    array = np.empty(len(words), dtype=object)
    array[:] = words
    return pd.util.hash_array(array)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer with full avalanche (splitmix64), in wrapping uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def letter_tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters, and runs of marks such as ``!!`` or ``|``."""
    return [] if not text else _TOKENS.findall(text.lower())


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class WordHasher:
    """64-bit hashes of the words of many texts, without making a Python object per word.

    A word (see ``ascii_words``) is a polynomial in an odd base over random numbers for its
    bytes, modulo 2**64; running sums of the whole buffer give every word at once.  The
    result is mixed with the word's length.
    """

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and last two bytes of each word, and the number of words of each text.

        Texts are strings, or their bytes in UTF-8; anything else has no words.
        """
        raw = [t.encode("utf-8", "replace") if isinstance(t, str) else t for t in texts]
        raw = [t.lower() if isinstance(t, bytes | bytearray) else b"" for t in raw]
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        buffer = np.frombuffer(b" " + b" ".join(raw) + b" ", dtype=np.uint8)
        n = len(buffer)
        if len(self.up) < n + 1:
            self.up = _powers(_BASE, n + 1)
            self.down = _powers(pow(_BASE, -1, 2**64), n + 1)
        space = (buffer == 32) | (buffer - np.uint8(9) < 5)  # 9 to 13: smaller ones wrap around
        # Spaces at both ends, so edges come in pairs.
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, stops = edges[::2].copy(), edges[1::2].copy()
        terms = _BYTES.take(buffer, mode="clip")
        terms *= self.up[:n]
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        words = (sums[stops] - sums[starts]) * self.down[starts]
        words = mix64(words ^ ((stops - starts).astype(np.uint64) << np.uint64(48)))
        tails = buffer[stops - 1].astype(np.int32) + 256 * buffer[stops - 2].astype(np.int32)
        return words, tails, np.diff(np.searchsorted(starts, ends, side="right"), prepend=0)
