"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import (
    alignment,
    decontamination,
    embeddings,
    language,
    licenses,
    near_duplicates,
    packing,
    pieces,
    quality,
    recurrent,
    toxicity,
    whitening,
    wrappers,
)
from siltgate.llm.common import crc_mod, table
from siltgate.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]


def toxicity_labels(labels: DataFrame) -> DataFrame:
    """The chain's categories: a poor text first, then a toxic one."""
    return labels.selectExpr("doc_id", "1 - quality AS low_quality", "toxic")


def toxicity_chain(docs: DataFrame, labels: DataFrame) -> toxicity.Chain:
    return toxicity.learn_chain(docs, toxicity_labels(labels), ["low_quality", "toxic"])


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, is_toxic, kept`` (not toxic)."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity_chain(docs, table(spark, sf_dir, "labels"))
    return (
        docs.select("doc_id", toxicity.score(chain, F.col("text")).alias("s"))
        .select("doc_id", "s.p_low_quality", "s.p_toxic", "s.is_toxic")
        .withColumn("kept", ~F.col("is_toxic"))
    )


def language_profiles(docs: DataFrame) -> language.Profiles:
    """Learned from every document with a lang whose id falls outside the held-out quarter."""
    return language.learn_profiles(docs.filter(crc_mod("doc_id", 4) != 2))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``."""
    docs = table(spark, sf_dir, "documents")
    profiles = language_profiles(docs)
    return docs.select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        language.predict_language(profiles, F.col("text")).alias("p"),
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, license, origin, cosine, from_dir`` of documents laid out as files."""
    files = licenses.documents_as_files(table(spark, sf_dir, "documents"))
    return licenses.scan(files).selectExpr(
        "try_cast(element_at(split(path, '/'), -1) AS BIGINT) AS doc_id",
        "license", "origin", "cosine", "from_dir",
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` at four words and similarity 0.8."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` at cosine 0.95."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    docs = table(spark, sf_dir, "documents")
    scored = recurrent.score_documents(docs, crc_mod("doc_id", 10) != 0)
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 10) == 0).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    docs = table(spark, sf_dir, "documents")
    train = table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 5) != 0)
    ranking = quality.learn_ranking(docs, train)
    return docs.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        quality.score(ranking, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, text, n_chars``."""
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    return decontamination.digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    return whitening.whiten(whitening.fixed_point(table(spark, sf_dir, "embeddings")))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return pieces.tokens(table(spark, sf_dir, "documents"), with_ids=False)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    return alignment.align(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of ``corpus_pipeline`` over ``documents``."""
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_language,
        op3_licenses,
        op4_near_duplicates,
        op5_embeddings,
        op6_packing,
        op7_language_model,
        op8_quality,
        op9_main_text,
        op10_decontamination,
        op11_whitening,
        op12_pieces,
        op13_alignment,
        pipeline,
    )
}
