"""The search job: from a text dump to the best documents of a term."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import terms
from corvane.operators.ranking import top_k
from corvane.sinks import write_ranked_tsv, write_tsv
from corvane.sources.rejects import LineCount
from corvane.sources.tabbed import read_corpus


def best_documents(corpus: DataFrame, term: str, k: int = 100) -> DataFrame:
    """``(title, tfidf)`` of the ``k`` best documents, equal scores by title."""
    return top_k(terms.tfidf_of_term(corpus, term), "tfidf", "title", k=k)


def search_job(
    spark: SparkSession,
    corpus_path: str,
    term: str,
    all_path: str,
    best_path: str,
    k: int = 100,
    strict: bool = False,
    count: LineCount | None = None,
) -> None:
    """Write every document's score for the term (word, title, score), and the ranked list of the best."""
    corpus = read_corpus(spark, corpus_path, strict, count)
    scored = terms.tfidf_of_term(corpus, term).persist()
    try:
        write_tsv(scored.select(F.lit(term).alias("word"), "title", "tfidf"), all_path)
        write_ranked_tsv(top_k(scored, "tfidf", "title", k=k), best_path)
    finally:
        scored.unpersist()


def index_job(spark: SparkSession, corpus_path: str, out_path: str, strict: bool = False, count: LineCount | None = None) -> None:
    """Write count, inverse document frequency and score of every word of every document (word, title, tf, idf, score)."""
    scored = terms.tfidf(read_corpus(spark, corpus_path, strict, count))
    write_tsv(scored.select("word", "title", "tf", "idf", "tfidf"), out_path)
