"""The jobs for ``spark-submit jobs.py <job> ...``; ``--help`` lists their options."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corvane.functions.scoring import BASE_RANK, DAMPING
from corvane.operators.throughput import TARGET, reached
from corvane.plans.pagerank import graph_job, pagerank_job
from corvane.plans.search import index_job, search_job
from corvane.plans.throughput import throughput_report
from corvane.sinks import write_tsv
from corvane.sources.logs import read_rps_stream
from corvane.sources.rejects import LineCount, counting_session
from corvane.streaming.throughput import windowed_totals, write_final_windows


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(description=__doc__)
    jobs = main.add_subparsers(dest="job", required=True)

    search = jobs.add_parser("search", help="documents of a term by TF-IDF")
    search.add_argument("corpus", help="tab-separated text: title in field 1, text in field 3")
    search.add_argument("--term", default="cloud")
    search.add_argument("--top", type=int, default=100)
    search.add_argument("--all", default="tfidf_all", help="folder for every document's score")
    search.add_argument("--out", default="tfidf", help="folder for the ranked list")

    index = jobs.add_parser("index", help="TF-IDF of every word of every document")
    index.add_argument("corpus", help="tab-separated text: title in field 1, text in field 3")
    index.add_argument("--out", default="index", help="folder for word, title, count, idf, score")

    graph = jobs.add_parser("graph", help="arcs and adjacency lists from the links in a corpus")
    graph.add_argument("corpus", help="tab-separated text: title in field 1, text in field 3")
    graph.add_argument("--arcs", default="arcs", help="folder for source, target")
    graph.add_argument("--out", default="adjacency", help="folder for id, part, targets")

    rank = jobs.add_parser("pagerank", help="pages by PageRank")
    rank.add_argument("arcs", help="tab-separated text: source, target")
    rank.add_argument("nodes", help="tab-separated text: id, title")
    rank.add_argument("--iterations", type=int, default=10)
    rank.add_argument("--unique-arcs", action="store_true", help="count repeated arcs once")
    rank.add_argument("--damping", type=float, default=DAMPING, help="share of rank that travels over arcs")
    rank.add_argument("--base", type=float, default=BASE_RANK, help="rank that every node keeps")
    rank.add_argument("--tolerance", type=float, help="stop when no rank changes by more")
    rank.add_argument("--run", help="folder that keeps arcs and states; a run in it is gone on with")
    rank.add_argument("--top", type=int, default=100)
    rank.add_argument("--all", help="folder for every node's rank")
    rank.add_argument("--out", default="pagerank", help="folder for the ranked list")

    measure = jobs.add_parser("throughput", help="throughput of finished or running tests, from their logs")
    measure.add_argument("logs", help="folder with files test.<id>.log")
    measure.add_argument("--target", type=float, default=TARGET)
    measure.add_argument("--out", default="throughput", help="folder for test, latest throughput, first minute")

    watch = jobs.add_parser("watch", help="throughput per minute from a growing folder of records")
    watch.add_argument("records", help="folder of parquet files: test_id, ts, node, rps")
    watch.add_argument("--state", required=True, help="folder for the query's progress, on shared storage")
    watch.add_argument("--lateness", default="10 minutes")
    watch.add_argument("--target", type=float, help="write only minutes that reach it")
    watch.add_argument("--once", action="store_true", help="end when all present records are read")
    watch.add_argument("--out", default="throughput_minutes")
    for job in (search, index, graph, rank):
        job.add_argument("--strict", action="store_true", help="stop at the first rejected line")
    return main


def run(spark: SparkSession, options: argparse.Namespace) -> list[LineCount]:
    """Run the job; how many lines of its inputs were read and rejected is returned."""
    spark = counting_session(spark)
    if options.job == "search":
        counts = [LineCount("corpus")]
        search_job(spark, options.corpus, options.term, options.all, options.out, options.top, options.strict, *counts)
    elif options.job == "index":
        counts = [LineCount("corpus")]
        index_job(spark, options.corpus, options.out, options.strict, *counts)
    elif options.job == "graph":
        counts = [LineCount("corpus")]
        graph_job(spark, options.corpus, options.arcs, options.out, options.strict, *counts)
    elif options.job == "pagerank":
        counts = [LineCount("arcs"), LineCount("nodes")]
        pagerank_job(
            spark,
            options.arcs,
            options.nodes,
            options.out,
            options.iterations,
            options.unique_arcs,
            options.top,
            options.all,
            options.damping,
            options.base,
            options.strict,
            *counts,
            options.tolerance,
            options.run,
        )
    elif options.job == "throughput":
        counts = [LineCount("logs")]
        write_tsv(throughput_report(spark, options.logs, options.target, *counts), options.out)
    else:
        counts = []
        totals = windowed_totals(read_rps_stream(spark, options.records), lateness=options.lateness)
        if options.target is not None:
            totals = reached(totals, options.target)
        write_final_windows(totals, options.out, options.state, options.once).awaitTermination()
    return counts


if __name__ == "__main__":
    arguments = parser().parse_args()
    for count in run(SparkSession.builder.appName(f"corvane {arguments.job}").getOrCreate(), arguments):
        print(count)
