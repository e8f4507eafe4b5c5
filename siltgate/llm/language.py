"""Language identification by rank order of n-grams.

A profile is a list of the most frequent n-grams (one to three letters, a space marking
each word end) in falling order.  A document's own list is compared with every language
profile by out-of-place distance: the sum, over the document's n-grams, of how far each
one's rank is from its rank in the profile, or the greatest possible distance if the
profile lacks it.  The nearest profile wins.

Profiles are counted over every training row.  An n-gram is one 64-bit number made of its
code points, so any alphabet works and nothing is hashed together.  Tasks add up their
counts before the shuffle, which is by language and n-gram, so a language with most of
the rows costs no single task more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.llm.common import text_chunks

PROFILE_SIZE = 400
UNKNOWN = "und"
_SPACE = 32


def _points(text: str) -> np.ndarray:
    """Code points of the lower-case letters with single spaces between and around words."""
    lowered = text.lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    kinds, places = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in kinds.tolist()], dtype=bool)
    points = np.where(letter[places], points, _SPACE)
    points = np.concatenate(([_SPACE], points, [_SPACE]))
    keep = (points != _SPACE) | np.concatenate(([True], points[:-1] != _SPACE))
    return points[keep]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the whole text as numbers, and how often each occurs."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    p = _points(text)
    if len(p) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    two = (p[:-1] << 21) | p[1:]
    three = (two[:-1] << 21) | p[2:]
    # A space inside an n-gram would join two words; at its ends it marks a word's end.
    three = three[p[1:-1] != _SPACE]
    return np.unique(np.concatenate((p[p != _SPACE], two, three)), return_counts=True)


def top_ngrams(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, ties by number."""
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))][:size]


@dataclass(frozen=True)
class Profiles:
    """``ranks[l, k]``: rank of n-gram ``grams[k]`` in language ``l``, ``size`` if absent."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; the score is one minus the share of the greatest distance.

        ``und`` and 0 for a text that is NULL or has no letter, or without any profile.
        """
        grams, counts = ngram_counts(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        own = top_ngrams(grams, counts, self.size)
        place = np.searchsorted(self.grams, own)
        place[place == len(self.grams)] = 0
        known = self.grams[place] == own
        rank = np.arange(len(own))
        far = np.full((len(self.languages), len(own)), self.size, dtype=np.int64)
        in_profile = self.ranks[:, place[known]]
        far[:, known] = np.where(
            in_profile < self.size, np.abs(in_profile - rank[known]), self.size
        )
        total = far.sum(axis=1)
        best = int(np.argmin(total))
        return self.languages[best], float(1 - total[best] / (self.size * len(own)))


def _partial_counts(size_limit: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in text_chunks(batches):
            for lang, rows in chunk.groupby("lang"):
                parts = [ngram_counts(t) for t in rows["text"]]
                grams = np.concatenate([g for g, _ in parts] or [np.empty(0, np.int64)])
                counts = np.concatenate([c for _, c in parts] or [np.empty(0, np.int64)])
                distinct, place = np.unique(grams, return_inverse=True)
                summed = np.bincount(place, weights=counts, minlength=len(distinct))
                yield pd.DataFrame(
                    {"lang": lang, "gram": distinct, "n": summed.astype(np.int64)}
                )

    return count


def learn_profiles(train: DataFrame, size: int = PROFILE_SIZE) -> Profiles:
    """Profiles from all rows of ``train`` (``lang``, ``text``); rows without lang are skipped.

    Runs one job; ``size`` n-grams per language come to the driver.
    """
    rows = (
        train.select("lang", "text")
        .filter("lang IS NOT NULL AND text IS NOT NULL")
        .mapInPandas(_partial_counts(size), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        # Each task keeps its top n-grams per language; a language's list is one row then.
        .selectExpr("lang", "struct(-n AS rank, gram) AS item", "pmod(xxhash64(gram), 64) AS part")
    )
    from pyspark.sql import Window

    by_part = Window.partitionBy("lang", "part").orderBy("item")
    by_lang = Window.partitionBy("lang").orderBy("item")
    top = (
        rows.withColumn("k", F.row_number().over(by_part))
        .filter(F.col("k") <= size)
        .withColumn("k", F.row_number().over(by_lang))
        .filter(F.col("k") <= size)
        .select("lang", "k", F.col("item.gram").alias("gram"))
        .collect()
    )
    languages = tuple(sorted({r["lang"] for r in top}))
    grams = np.array(sorted({r["gram"] for r in top}), dtype=np.int64)
    ranks = np.full((len(languages), len(grams)), size, dtype=np.int64)
    for r in top:
        ranks[languages.index(r["lang"]), np.searchsorted(grams, r["gram"])] = r["k"] - 1
    return Profiles(languages, grams, ranks, size)


def predict_language(profiles: Profiles, text: Column) -> Column:
    """Struct ``lang, score`` for a text column."""

    def predict(texts: pd.Series) -> pd.DataFrame:
        rows = [profiles.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang", "score"]).astype({"lang": object, "score": float})

    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return F.pandas_udf(predict, schema)(text)
