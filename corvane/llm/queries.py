"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import (
    alignment,
    kneser_ney,
    language,
    line_dedup,
    packing,
    parity_join,
    phrases,
    repetition,
    secrets,
    sql,
    token_trees,
    toxicity,
    whitening,
    window_dedup,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(folds: int) -> Column:
    """The remainder that decides what is learned from; null for a row without id, so its ``held_out`` is null, too."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    labelled = toxicity.labelled_documents(documents, _table(spark, folder, "labels"))
    scored = toxicity.score(documents, toxicity.fit(labelled.where(_fold(5) != 0)))
    return scored.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", F.expr("cast(score >= 0.5 as int) as predicted"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


def op3_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    scored = kneser_ney.score(documents, kneser_ney.fit(documents.where(F.coalesce(_fold(7) != 2, F.lit(True)))))
    return scored.withColumn("held_out", _fold(7) == 2)


def op4_token_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Counts before and after masking all longer numbers."""
    return token_trees.recounted(token_trees.with_masking(token_trees.count(_table(spark, folder, "documents"))))


def op5_windows(spark: SparkSession, folder: str) -> DataFrame:
    return window_dedup.remove_repeated_windows(_table(spark, folder, "documents"), give_text=False)


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    predicted = language.predict(documents, language.fit(documents.where(_fold(4) != 2)))
    return predicted.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op8_phrases(spark: SparkSession, folder: str) -> DataFrame:
    judged = phrases.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return judged.drop("items", "near_items")


def op9_parity(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.similar_documents(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.measure(_table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.remove_repeated_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_secrets": op2_secrets,
        "op3_kneser_ney": op3_kneser_ney,
        "op4_token_trees": op4_token_trees,
        "op5_windows": op5_windows,
        "op6_language": op6_language,
        "op7_packing": op7_packing,
        "op8_phrases": op8_phrases,
        "op9_parity": op9_parity,
        "op10_repetition": op10_repetition,
        "op11_whitening": op11_whitening,
        "op12_lines": op12_lines,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
