"""An iterated PageRank as a stored run: arcs and states in bucketed tables, one row of progress per iteration.

Arcs are stored once, bucketed and sorted by source, and every state in as many buckets by id, so
arcs and state are read in place and join there: of an iteration only the
contributions move, summed up within each task before, and the new state is written where they arrive. How many move depends on
how many arcs of one receiver a task holds, so where there are many arcs buckets are few and each is cut into slices by
receiver: a task joins one slice of a bucket, a cell, and a receiver gets one contribution of each bucket at most. The few
sources with very many arcs stay out of the buckets: their arcs are stored as they come and get the shares by broadcast.

What an iteration needs to know of the one before - the rank held by dangling nodes - and what a user wants to
know - the mass of all ranks and their largest change - are observed metrics of the
pass that writes the state, in its last stage, so they take no job of their own and no task counts twice. A state counts once its
row of progress is there. A run that broke off goes on from that one.

The loop has a session of its own, planned without adaptive execution, as buckets are laid out on purpose;
the caller's session keeps its settings.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvane.functions.scoring import FIRST_RANK, damped
from corvane.operators.graph import find_hubs, link_counts, node_table
from corvane.session import session_like

MASS = "coalesce(sum(case when out_degree = 0 then rank end), 0D)"
# Arcs per cell, some tens of megabytes.
LINKS_PER_CELL = 2_000_000

STATE = ("id", "out_degree", "out_links", "rank")
LINK_COLUMNS = "src string, dst string, copies bigint"
STATE_COLUMNS = "id string, out_degree bigint, out_links bigint, rank double"
PROGRESS = "iteration int, nodes bigint, mass double, dangling double, change double, buckets int, hubs int, slices int"


def initial_state(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Every node with rank 1."""
    return node_table(links, nodes).withColumn("rank", F.lit(FIRST_RANK)).select(*STATE)


def shares(state: DataFrame) -> DataFrame:
    """What each node with outgoing arcs sends along one arc."""
    return state.where("out_degree > 0").selectExpr("id as src", "out_links", "rank / out_degree as share")


def sent(links_with_shares: DataFrame) -> DataFrame:
    """``(id, contribution)``, one row per different arc."""
    return links_with_shares.selectExpr("dst as id", "share * copies as contribution")


def received(contributions: DataFrame) -> DataFrame:
    """Sums per receiver; much linked nodes are summed up before the shuffle."""
    return contributions.groupBy("id").agg(F.sum("contribution").alias("contribution"))


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per state of a run: ``mass`` is the sum of all ranks, ``dangling`` that of nodes without arcs, ``change`` the largest of any rank."""
    return spark.read.schema(PROGRESS).parquet(f"{folder}/progress").orderBy("iteration")


def states(spark: SparkSession, folder: str) -> list:
    """The rows of ``progress``; none where no run has been started."""
    try:
        return progress(spark, folder).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


class _Tables:
    """Bucketed tables by their paths, named in the catalog as long as they are used."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.names = buckets, []

    def _name(self) -> str:
        self.names.append(f"corvane_{uuid.uuid4().hex}")
        return self.names[-1]

    def write(self, rows: DataFrame, path: str, key: str, *partition_by: str) -> str:
        """A bucket's ``rows`` (of one value of ``partition_by``) lie in one partition, so each bucket is one sorted file."""
        name = self._name()
        whole = rows.write.format("parquet").bucketBy(self.buckets, key).sortBy(key).option("path", path).mode("overwrite")
        (whole.partitionBy(*partition_by) if partition_by else whole).saveAsTable(name)
        return name

    def stored(self, spark: SparkSession, path: str, columns: str, key: str) -> str:
        name = self._name()
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def forget(self, spark: SparkSession) -> None:
        """The files stay."""
        for name in self.names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _observed(state: DataFrame, change: str) -> tuple[DataFrame, Observation]:
    metrics = Observation()
    mass, dangling = F.sum("rank").alias("mass"), F.expr(MASS).alias("dangling")
    return state.observe(metrics, F.count(F.lit(1)).alias("nodes"), mass, dangling, F.expr(f"max({change})").alias("change")), metrics


def _told(spark: SparkSession, folder: str, iteration: int, metrics: Observation, buckets: int, hubs: int, slices: int) -> dict:
    got = metrics.get
    row = {"iteration": iteration, "nodes": got["nodes"], "mass": float(got["mass"] or 0), "dangling": got["dangling"], "change": float(got["change"] or 0)}
    row |= {"buckets": buckets, "hubs": hubs, "slices": slices}
    spark.createDataFrame([tuple(row.values())], PROGRESS).coalesce(1).write.mode("append").parquet(f"{folder}/progress")
    return row


def grid(parallelism: int, links: int) -> tuple[int, int]:
    """Buckets and slices for so many arcs: as few buckets as keep all cores busy and cells small, and not more than there are slices beyond that."""
    cells = -(-links // LINKS_PER_CELL)
    buckets = max(parallelism, math.isqrt(max(cells - 1, 0)) + 1)
    return buckets, max(1, -(-cells // buckets))


def _write_cells(plain: DataFrame, unique_arcs: bool, tables: _Tables, slices: int, path: str) -> None:
    """The arcs moved once, to their cells, and counted there: the sources that have very many are not among them."""
    cell = f"cast(pmod(hash(src), {tables.buckets}) * {slices} + pmod(xxhash64(dst), {slices}) as int) as cell"
    dealt = plain.selectExpr("src", "dst", cell).repartitionById(tables.buckets * slices, "cell")
    counted = link_counts(dealt, unique_arcs, "cell")
    if slices == 1:
        tables.write(counted.drop("cell"), path, "src")
    else:
        tables.write(counted.selectExpr("src", "dst", "copies", f"cell % {slices} as slice"), path, "src", "slice")


def _stored_links(spark: SparkSession, tables: _Tables, folder: str, slices: int) -> list[DataFrame]:
    """The arcs of each slice that has any."""
    paths = [f"{folder}/arcs"]
    if slices > 1:
        found = spark.read.schema(f"{LINK_COLUMNS}, slice int").parquet(*paths).select("slice").distinct().collect()  # no more than slices
        paths = [f"{folder}/arcs/slice={r.slice}" for r in sorted(found)]
    return [spark.table(tables.stored(spark, path, LINK_COLUMNS, "src")) for path in paths]


def _start(arcs: DataFrame, nodes: DataFrame | None, folder: str, unique_arcs: bool, hub_share: int, min_hub_links: int) -> dict:
    """Store arcs and the first state."""
    spark = arcs.sparkSession
    whole = arcs.where("src is not null and dst is not null")
    hubs, total = find_hubs(whole, "src", hub_share, min_hub_links)
    buckets, slices = grid(spark.sparkContext.defaultParallelism, total)
    tables = _Tables(buckets)
    try:
        plain = whole
        if hubs:
            listed = spark.createDataFrame([(h,) for h in hubs], "src string")
            listed.write.mode("overwrite").parquet(f"{folder}/hubs")
            plain = whole.join(F.broadcast(listed), "src", "left_anti")  # no more rows than hub_share
            of_hubs = whole.join(F.broadcast(listed), "src", "left_semi")
            link_counts(of_hubs, unique_arcs).write.mode("overwrite").parquet(f"{folder}/hub_arcs")
        _write_cells(plain, unique_arcs, tables, slices, f"{folder}/arcs")
        links = spark.read.schema(LINK_COLUMNS).parquet(f"{folder}/arcs").select("src", "dst", "copies")
        if hubs:
            links = links.unionByName(spark.read.schema(LINK_COLUMNS).parquet(f"{folder}/hub_arcs"))
        state, metrics = _observed(initial_state(links, nodes).repartition(buckets, "id"), "0D")
        tables.write(state, f"{folder}/state-0", "id")
    finally:
        tables.forget(spark)
    return _told(spark, folder, 0, metrics, buckets, len(hubs), slices)


def next_state(links: DataFrame | list[DataFrame], state: DataFrame, hub_links: DataFrame | None, hubs: DataFrame | None, per_node: float, damping: float, base: float) -> DataFrame:
    """``state`` after one more iteration, with the rank ``before``; ``links`` may be cut into slices."""
    given = shares(state)
    slices = links if isinstance(links, list) else [links]
    moved = reduce(DataFrame.unionByName, (sent(x.join(given.hint("merge"), "src")) for x in slices))
    if hubs is not None:
        of_hubs = given.join(F.broadcast(hubs), "src", "left_semi")
        moved = moved.unionByName(sent(hub_links.join(F.broadcast(of_hubs), "src")))
    contribution = F.coalesce("contribution", F.lit(0.0))
    rank = damped(contribution, F.lit(per_node), damping, base).alias("rank")
    joined = state.join(received(moved).hint("merge"), "id", "left")
    return joined.select("id", "out_degree", "out_links", rank, F.col("rank").alias("before"))


def loop_session(spark: SparkSession, buckets: int) -> SparkSession:
    return session_like(
        spark,
        {
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": str(buckets),
            "spark.sql.sources.bucketing.maxBuckets": str(max(buckets, 100_000)),
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
            "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",  # a bucket is one sorted file
        },
    )


def ranks(
    arcs: DataFrame,
    nodes: DataFrame | None,
    folder: str,
    iterations: int,
    unique_arcs: bool,
    hub_share: int,
    min_hub_links: int,
    damping: float,
    base: float,
    tolerance: float | None,
) -> DataFrame:
    """``(id, rank)`` after the iterations of the run in ``folder``, which is started or gone on with."""
    spark = arcs.sparkSession
    done = states(spark, folder)
    last = done[-1].asDict() if done else _start(arcs, nodes, folder, unique_arcs, hub_share, min_hub_links)
    if last["iteration"] > iterations:
        last = next(r.asDict() for r in done if r.iteration == iterations)
    elif last["iteration"] < iterations:
        own, tables = loop_session(spark, last["buckets"]), _Tables(last["buckets"])
        hubs = hub_links = None
        if last["hubs"]:
            hubs = own.read.schema("src string").parquet(f"{folder}/hubs")
            hub_links = own.read.schema(LINK_COLUMNS).parquet(f"{folder}/hub_arcs")
        try:
            links = _stored_links(own, tables, folder, last["slices"] or 1)
            state = own.table(tables.stored(own, f"{folder}/state-{last['iteration']}", STATE_COLUMNS, "id"))
            for iteration in range(last["iteration"] + 1, iterations + 1):
                if tolerance is not None and last["iteration"] and last["change"] <= tolerance:
                    break
                per_node = last["dangling"] / last["nodes"] if last["nodes"] else 0.0
                new, metrics = _observed(next_state(links, state, hub_links, hubs, per_node, damping, base), "abs(rank - before)")
                state = own.table(tables.write(new.drop("before"), f"{folder}/state-{iteration}", "id"))
                last = _told(own, folder, iteration, metrics, last["buckets"], last["hubs"], last["slices"] or 1)
        finally:
            tables.forget(own)
    return spark.read.schema(STATE_COLUMNS).parquet(f"{folder}/state-{last['iteration']}").select("id", "rank")
