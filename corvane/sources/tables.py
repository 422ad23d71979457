"""The sample warehouse tables seen as corpus, graph, logs and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions.logs import header_line, value_line

# Event ids that share a block of a log.
EVENTS_PER_BLOCK = 1 << 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """A null text is empty and keeps its document."""
    documents = table(spark, folder, "documents").where("doc_id is not null")
    return documents.selectExpr("cast(doc_id as string) as title", "coalesce(text, '') as text")


def pages_corpus(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").where("url is not null")
    return pages.selectExpr("url as title", "coalesce(html, '') as text")


def _trade_pairs(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    sold = items.join(orders, items.l_orderkey == orders.o_orderkey, "left").selectExpr(
        "concat('c', o_custkey) as customer",
        "concat('p', l_partkey) as part",
        "concat('s', l_suppkey) as supplier",
        "if(l_suppkey % 2 = 0, concat('c', o_custkey), null) as served",
    )
    return sold.selectExpr("stack(3, customer, part, part, supplier, supplier, served) as (src, dst)")


def trade_arcs(spark: SparkSession, folder: str) -> DataFrame:
    """Customers link to the parts they order, parts to their suppliers, and
    suppliers of even key to the customers they serve."""
    return _trade_pairs(spark, folder).where("src is not null and dst is not null")


def trade_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, title)``; part names repeat, so a part's title shows its key as well."""
    customers = table(spark, folder, "customer").selectExpr("concat('c', c_custkey) as id", "c_name as title")
    parts = table(spark, folder, "part").selectExpr(
        "concat('p', p_partkey) as id", "concat(p_name, ' #', p_partkey) as title"
    )
    suppliers = table(spark, folder, "supplier").selectExpr("concat('s', s_suppkey) as id", "s_name as title")
    return customers.unionByName(parts).unionByName(suppliers)


def _event_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(test_id, minute, event_id, node, rps)``: events of a type and an hour, each hour since the epoch standing for a minute."""
    events = table(spark, folder, "events").where("event_type is not null and ts is not null")
    return events.selectExpr(
        "event_type as test_id",
        "unix_date(cast(ts as date)) * 24 + hour(ts) as minute",
        "event_id",
        "cast(user_id as string) as node",
        "cast(value as double) as rps",
    )


def event_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` written as test logs, one per event type: section ``[Minute n]`` holds the events of hour n.

    A section's lines are cut into blocks of limited size by their event ids, so there are more blocks where there are more events.
    """
    records = _event_records(spark, folder)
    headers = records.select("test_id", "minute").distinct().select(
        "test_id", F.struct("minute", F.lit(-1).cast("bigint").alias("part")).alias("block"), F.lit(-1).cast("bigint").alias("seq"),
        header_line(F.col("minute")).alias("line"),
    )
    part = F.coalesce(F.floor(F.col("event_id") / EVENTS_PER_BLOCK), F.lit(0))
    values = records.select(
        "test_id", F.struct("minute", F.greatest(part, F.lit(0)).cast("bigint").alias("part")).alias("block"),
        F.col("event_id").alias("seq"), value_line(F.col("node"), F.col("rps")).alias("line"),
    )
    return headers.unionByName(values)


def numbered_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``event_log_lines`` with tests numbered in the order of their types, as names of log files need a number."""
    types = event_log_names(spark, folder).select("test_id", F.row_number().over(Window.orderBy("test_id")).alias("number"))
    lines = event_log_lines(spark, folder).join(types, "test_id")
    return lines.select(F.col("number").cast("string").alias("test_id"), "block", "seq", "line")


def event_log_names(spark: SparkSession, folder: str) -> DataFrame:
    return _event_records(spark, folder).select("test_id").distinct()


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """``(test_id, ts, node, rps)`` as a stream over the events files."""
    schema = table(spark, folder, "events").schema
    # As a pattern the path may be one file or a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events[.]parquet")
    return stream.select(
        F.col("event_type").alias("test_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("node"),
        F.col("value").alias("rps"),
    )


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as the lines of a text dump: number, title, language, text with its line ends written out."""
    text = F.regexp_replace(F.regexp_replace("text", "\t", " "), "\r\n|\r|\n", r"\\\\n")
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", F.concat_ws(" ", F.lit("Document"), "doc_id").alias("title"), "lang", text.alias("text"))


def conversation_batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Conversations as documents that go on: their first turns, their second ones, and all later ones."""
    turns = table(spark, folder, "conversations").where("conv_id is not null and turn is not null")
    first = turns.agg(F.min("turn")).first()[0] or 0
    rows = turns.selectExpr("cast(conv_id as string) as title", "coalesce(text, '') as text", "turn")
    return [rows.where(which).select("title", "text") for which in (f"turn = {first}", f"turn = {first + 1}", f"turn > {first + 1}")]


def trade_arc_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The arcs of ``trade_arcs`` as lines, with an empty target where a supplier serves nobody."""
    return _trade_pairs(spark, folder).selectExpr("coalesce(src, '') as src", "coalesce(dst, '') as dst")
