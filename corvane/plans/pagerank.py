"""The ranking job: from arcs and a node mapping to the best pages with their titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.scoring import BASE_RANK, DAMPING
from corvane.operators import rank_run
from corvane.operators.graph import adjacency, corpus_arcs, link_counts
from corvane.operators.pagerank import pagerank
from corvane.operators.ranking import top_k
from corvane.sinks import write_ranked_tsv, write_tsv
from corvane.sources.rejects import LineCount
from corvane.sources.tabbed import read_arcs, read_corpus, read_nodes


def with_titles(ranks: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(id, title, rank)``; a node without a title in the mapping goes by its id."""
    titles = nodes.groupBy("id").agg(F.min("title").alias("title"))
    return ranks.join(titles, "id", "left").select("id", F.coalesce("title", "id").alias("title"), "rank")


def best_pages(ranks: DataFrame, nodes: DataFrame, k: int = 100, digits: int = 6) -> DataFrame:
    """``(title, pagerank)`` of the ``k`` highest ranks, equal ranks by title.

    Ranks are rounded first: nodes in the same position get the same rank, but
    sums in another order can differ in the last bits. Only nodes that reach the
    ``k``-th rank, ties included, get their titles attached.
    """
    rounded = ranks.withColumn("rank", F.round("rank", digits))
    least = rounded.orderBy(F.desc("rank")).limit(k).agg(F.min("rank")).scalar()
    titled = with_titles(rounded.where(F.col("rank") >= least), nodes)
    return top_k(titled.select("title", F.col("rank").alias("pagerank")), "pagerank", "title", k=k)


def pagerank_job(
    spark: SparkSession,
    arcs_path: str,
    nodes_path: str,
    best_path: str,
    iterations: int = 10,
    unique_arcs: bool = False,
    k: int = 100,
    all_path: str | None = None,
    damping: float = DAMPING,
    base: float = BASE_RANK,
    strict: bool = False,
    arc_count: LineCount | None = None,
    node_count: LineCount | None = None,
    tolerance: float | None = None,
    run: str | None = None,
) -> DataFrame:
    """Write the ranked list of the best pages and, if asked for, all ranks; these are also returned."""
    nodes = read_nodes(spark, nodes_path, strict, node_count)
    if run and rank_run.states(spark, run):
        arc_count = None  # a run that goes on has its arcs already
    ranks = pagerank(read_arcs(spark, arcs_path, strict, arc_count), nodes, iterations, unique_arcs, damping=damping, base=base, tolerance=tolerance, run=run)
    write_ranked_tsv(best_pages(ranks, nodes, k), best_path)
    if all_path:
        write_tsv(ranks, all_path)
    return ranks


def graph_job(
    spark: SparkSession, corpus_path: str, arcs_path: str, lists_path: str, strict: bool = False, count: LineCount | None = None
) -> None:
    """Write the arcs of a corpus's links (source, target) and from these the adjacency lists (id, part, targets by blanks)."""
    write_tsv(corpus_arcs(read_corpus(spark, corpus_path, strict, count)), arcs_path)
    lists = adjacency(link_counts(read_arcs(spark, arcs_path)))
    write_tsv(lists.select("id", "part", F.array_join("neighbors", " ").alias("neighbors")), lists_path)
