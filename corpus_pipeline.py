"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame that is written as
Parquet and read again as the next one's ``docs``.  All but the last keep the columns of
``documents``, whatever they are, and remove rows; the last returns the pieces of the
documents that are left with their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import decontamination, language, near_duplicates, packing, toxicity
from siltgate.llm.common import table
from siltgate.llm.queries import toxicity_chain
from siltgate.sources import staging_dir, written

#: A text whose n-grams are further than this from every language is in none of them.
MIN_LANGUAGE_SCORE = 0.25


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the chain calls toxic go; empty and NULL texts are not toxic."""
    chain = toxicity_chain(docs, table(spark, sf_dir, "labels"))
    return docs.filter(~toxicity.score(chain, F.col("text"))["is_toxic"])


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those that resemble no language of the corpus.

    Without any labelled language only the first rule holds.
    """
    profiles = language.learn_profiles(docs)
    if not profiles.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language.predict_language(profiles, F.col("text"))
    keep = (found["lang"] != language.UNKNOWN) & (found["score"] >= MIN_LANGUAGE_SCORE)
    return docs.filter(keep)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that with the smallest id."""
    return near_duplicates.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words inside benchmark windows go."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents that are left, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Classifiers and packing have no SQL form; the tests run each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), staging_dir(spark, f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
