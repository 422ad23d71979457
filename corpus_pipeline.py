"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
result as Parquet below the shared folder and hands it to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import packing, parity_join, phrases, repetition, secrets
from corvane.llm.exchange import free_name, text_hash, written

# Near copies: five words and 0.8; op9_parity has values of its own.
SHINGLE = 5
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that repeat themselves or are too short go, null and empty ones with them.

    Each row is judged by its text alone, so repeated rows go or stay together. An empty table stays empty.
    """
    return repetition.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows of ``PERCENT`` similarity one stays: that of the smallest id, rows without one last; of equal ids the one of the smallest text hash.

    Only rows proven similar go, whatever their ids; of rows equal in id and text any one stays. Texts without words are not compared: of
    those the rows of one id go but for one, and all without an id stay. An empty table stays empty.
    """
    key, id_key = free_name(docs, "text_hash"), free_name(docs, "row_id")
    rows = docs.withColumn(key, text_hash()).withColumn(id_key, F.col("doc_id").cast("bigint"))
    found = parity_join.similar_documents(docs.select(text_hash().alias("doc_id"), "text"), size=SHINGLE, percent=PERCENT)
    found = found.selectExpr("doc_id as hash", "if(n_shingles > 0, component_id, null) as component").distinct()
    named = rows.groupBy(F.col(key).alias("hash"), F.col(id_key).alias("id")).agg(F.count("*").alias("n")).join(found, "hash")
    of_group = F.min(F.struct(F.col("id").isNull(), "id", "hash", "n")).alias("first")
    alone = F.when(F.col("component").isNull(), F.struct("id", F.when(F.col("id").isNull(), F.col("hash"))))
    stay = named.groupBy("component", alone.alias("alone")).agg(of_group).select("component", "first.id", "first.hash", "first.n")
    # Rows of which one is as good as another are told apart only where there are several.
    one = (F.col("n") == 1) | (F.col("component").isNull() & F.col("id").isNull())
    stay = written(stay, "stay")
    same = (F.col(f"r.{key}") == F.col("s.hash")) & F.col(f"r.{id_key}").eqNullSafe(F.col("s.id"))
    once, several = (rows.alias("r").join(stay.where(which).alias("s"), same, "left_semi") for which in (one, ~one))
    return once.unionByName(several.dropDuplicates([key, id_key])).drop(key, id_key)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which a twentieth or more are passages of the benchmark go, whatever other rows of their id hold.

    Each row is judged by its text alone, so repeated rows go or stay together; null and empty texts stay. Without
    items, or without documents, nothing goes.
    """
    key = free_name(docs, "text_hash")
    judged = phrases.decontaminate(docs.select(text_hash().alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = judged.where("contaminated").select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, text_hash()).join(hit, key, "left_anti").drop(key)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays, its ``n_chars`` that of the new text.

    A text is masked by its own findings, so repeated rows alike; null and empty texts stay as they are (``n_chars`` of null is
    null). An empty table stays empty.
    """
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: each document's pieces with sequence and offset.

    A null or empty text is its closing id alone, repeated rows are packed each, pieces of one length are interchangeable and
    dealt out in order of id, place and content. An empty table gives no piece.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", pack_sequences),
]

# Token ids, the forest and the similarity components are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of the folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
