"""Adjacency lists, degrees and dangling nodes of a directed graph.

Arcs are a DataFrame ``(src, dst)``; the same arc may occur several times and
then counts several times. A node mapping is a DataFrame with an ``id`` column.
The node set holds the mapping's ids and both ends of every arc.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.links import link_targets
from corvane.operators.lookup import attach
from corvane.session import laid_out, prepare_checkpoints

# Entries in one stored list. A longer list becomes several rows of the same node.
MAX_LIST = 10_000
# A node with at least one of so many of all links has its list made by several tasks, unless they are fewer than MIN_HUB_LINKS.
HUBS = 20_000
MIN_HUB_LINKS = 200_000
# Counters of the sketch that finds such nodes; its error is at most 1 / (0.75 * SKETCH_ITEMS) of all links.
SKETCH_ITEMS = 1 << 16

NODE_COUNTS = ("out_degree", "out_links", "in_degree", "in_links")


def corpus_arcs(corpus: DataFrame) -> DataFrame:
    """``(src, dst)`` from the link targets written in the documents of a corpus ``(title, text)``."""
    return corpus.select(F.col("title").alias("src"), F.explode(link_targets(F.col("text"))).alias("dst"))


def link_counts(arcs: DataFrame, unique: bool = False, *by: str) -> DataFrame:
    """``(src, dst, copies)``: each different arc once, copies combined before the shuffle.

    Arcs that lack an end are no arcs. With ``unique`` repeated arcs count as one. Columns ``by`` that follow from the ends
    are kept, and arcs that lie by them are counted where they are.
    """
    copies = F.lit(1).cast("bigint") if unique else F.count("*")
    whole = arcs.where("src is not null and dst is not null")
    return whole.groupBy(*by, "src", "dst").agg(copies.alias("copies"))


def reverse(links: DataFrame) -> DataFrame:
    """The same arcs with their ends swapped."""
    return links.withColumnsRenamed({"src": "dst", "dst": "src"})


def node_table(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """One row per node: ``out_degree`` and ``in_degree`` count arcs, ``out_links``
    and ``in_links`` different arcs.

    Both ends of an arc come from one pass over it and meet in one aggregation
    with the ids of the mapping, so a node that is only linked to, only linking,
    or only listed gets its row without a join.
    """
    columns = ", ".join(("id", *NODE_COUNTS))
    ends = links.selectExpr(f"stack(2, src, copies, 1L, 0L, 0L, dst, 0L, 0L, copies, 1L) as ({columns})")
    if nodes is not None:
        listed = nodes.where("id is not null").selectExpr("id", *(f"0L as {c}" for c in NODE_COUNTS))
        ends = ends.unionByName(listed)
    return ends.groupBy("id").agg(*(F.expr(f"sum({c}) as {c}") for c in NODE_COUNTS))


def degrees(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    return node_table(links, nodes).select("id", "out_degree", "in_degree")


def dangling_nodes(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Ids without outgoing arcs."""
    return node_table(links, nodes).where("out_degree = 0").select("id")


def find_hubs(rows: DataFrame, key: str, hot_share: int = HUBS, least: int = MIN_HUB_LINKS) -> tuple[list, int]:
    """The keys of at least ``1 / hot_share`` of the rows and no fewer than ``least``, ``hot_share`` at most, and the number of rows.

    From a frequent-items sketch, whose error is below ``1 / hot_share``; it is merged from one of each task.
    """
    sketch = rows.agg(F.expr(f"approx_top_k({key}, {hot_share}, {SKETCH_ITEMS})").alias("top"), F.count("*").alias("total")).first()
    limit = max(least, sketch["total"] // hot_share)
    return [x["item"] for x in sketch["top"] or () if x["count"] >= limit], sketch["total"]


def _hubs(links: DataFrame, own: str, hot_share: int = HUBS, least: int = MIN_HUB_LINKS) -> DataFrame:
    """``(id)`` of the nodes whose links no one task should hold."""
    found, _ = find_hubs(links, own, hot_share, least)
    return links.sparkSession.createDataFrame([(x,) for x in found], "id string")


def _hub_places(rows: DataFrame) -> DataFrame:
    """``_places`` for nodes whose links are too many for one task.

    Links are cut by range of (id, entry) into slices of equal size, so such a node has several, in order. Places are
    counted within each slice, and the slices of one node add up. Slices come from a sample, so they are
    checkpointed: all readers must see the same ones.
    """
    sliced = rows.repartitionByRange("id", "entry").withColumn("slice", F.spark_partition_id()).checkpoint()
    sizes = sliced.groupBy("id", "slice").agg(F.sum("copies").alias("size"))
    earlier = Window.partitionBy("id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    later = sizes.select("id", "slice", F.sum("size").over(earlier).alias("skipped")).where("skipped is not null")
    before = Window.partitionBy("id", "slice").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
    counted = sliced.withColumn("within", F.sum("copies").over(before)).join(later, ["id", "slice"], "left")
    return counted.selectExpr("id", "entry", "copies", "coalesce(skipped, 0L) + coalesce(within, 0L) as first")


def _places(rows: DataFrame) -> DataFrame:
    """``(id, entry, copies, first)``: where in the sorted list of ``id`` the copies of ``entry`` begin, from 0.

    A node's links meet in one task, by one exchange; what is done by node after this stays there.
    """
    before = Window.partitionBy("id").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("id", "entry", "copies", F.coalesce(F.sum("copies").over(before), F.lit(0)).alias("first"))


def _cut_lists(places: DataFrame, name: str, max_list: int) -> DataFrame:
    """Each sorted list in runs of ``max_list`` entries: ``part`` p holds those at the places p * max_list and following."""
    cut = places.selectExpr("*", f"explode(sequence(first div {max_list}, (first + copies - 1) div {max_list})) as part")
    dealt = cut.selectExpr(
        "id",
        "cast(part as int) as part",
        f"""array_repeat(entry, cast(least(first + copies, (part + 1) * {max_list})
            - greatest(first, part * {max_list}) as int)) as entries""",
    )
    grouped = dealt.groupBy("id", "part").agg(F.expr("collect_list(entries) as entries"))
    return grouped.selectExpr("id", "part", f"sort_array(flatten(entries)) as {name}")


def _lists(links: DataFrame, own: str, other: str, name: str, max_list: int, hubs: DataFrame | None = None) -> DataFrame:
    """The ``other`` ends per ``own`` end in sorted order, cut into runs of ``max_list``.

    The parts of a node one after the other are its whole sorted list, and only the last may be shorter. After
    ``links`` is laid down, links of all but the few ``hubs`` move once, to the task of their node, where they are
    sorted, placed and collected; links of hubs, which no one task could hold, go by ranges instead.
    """
    rows = links.selectExpr(f"{own} as id", f"{other} as entry", "copies")
    if hubs is None:
        hubs = _hubs(rows, "id")
    if hubs.isEmpty():
        return _cut_lists(_places(rows), name, max_list)
    hubs = F.broadcast(hubs)  # no more than HUBS rows
    of_hubs = _cut_lists(_hub_places(rows.join(hubs, "id", "left_semi")), name, max_list)
    return _cut_lists(_places(rows.join(hubs, "id", "left_anti")), name, max_list).unionByName(of_hubs)


def _laid_down(links: DataFrame) -> DataFrame:
    """The links computed once, for the sketch and the lists alike."""
    prepare_checkpoints(links.sparkSession)  # for the slices of hubs
    return laid_out(links, "links", "src")


def adjacency(links: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """``(id, part, neighbors)`` for every node with outgoing arcs."""
    return _lists(_laid_down(links), "src", "dst", "neighbors", max_list)


def reverse_adjacency(links: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """``(id, part, linked_from)`` for every node with incoming arcs."""
    return _lists(_laid_down(links), "dst", "src", "linked_from", max_list)


def dangling_with_inlinks(links: DataFrame, max_list: int = MAX_LIST, **hot) -> DataFrame:
    """``(id, part, linked_from)`` for nodes that are linked to but link nowhere."""
    sizes = node_table(links).where("in_links > 0").selectExpr("id as dst", "out_degree", "in_links")
    leading_nowhere = attach(links, sizes, "dst", "in_links", **hot).where("out_degree = 0")
    return _lists(_laid_down(leading_nowhere), "dst", "src", "linked_from", max_list)


def adjacency_with_dangling(
    links: DataFrame, nodes: DataFrame | None = None, max_list: int = MAX_LIST
) -> DataFrame:
    """``adjacency`` and, with null for their list, the dangling nodes."""
    links = _laid_down(links)
    dangling = dangling_nodes(links, nodes).selectExpr(
        "id", "0 as part", "cast(null as array<string>) as neighbors"
    )
    return _lists(links, "src", "dst", "neighbors", max_list).unionByName(dangling)


def both_lists(links: DataFrame, nodes: DataFrame | None = None, max_list: int = MAX_LIST) -> DataFrame:
    """``(id, part, out_degree, in_degree, neighbors, linked_from)`` for every node.

    A list is null in rows beyond its last part; a degree of 0 tells that there is none at all.
    A node without any arc has one row. Both ends of a link move once, to the tasks of their nodes, and there become degrees and
    lists; nodes that are a hub one way or the other have their lists made apart and joined part by part.
    """
    links = _laid_down(links)
    out_hubs, in_hubs = (_hubs(links.select(F.col(own).alias("id")), "id") for own in ("src", "dst"))
    ends = links.selectExpr("stack(2, src, dst, copies, true, dst, src, copies, false) as (id, entry, copies, out)")
    if nodes is not None:
        listed = nodes.where("id is not null").selectExpr("id", "cast(null as string) as entry", "0L as copies", "true as out")
        ends = ends.unionByName(listed)
    if out_hubs.isEmpty() and in_hubs.isEmpty():
        return _both_in_place(ends, max_list)
    hubs = F.broadcast(out_hubs.union(in_hubs).distinct())  # no more than 2 * HUBS rows
    return _both_in_place(ends.join(hubs, "id", "left_anti"), max_list).unionByName(_both_of_hubs(links, hubs, out_hubs, in_hubs, max_list))


def _both_in_place(ends: DataFrame, max_list: int) -> DataFrame:
    """Degrees and lists from ``(id, entry, copies, out)``, both ways in one exchange; a null entry only names the node."""
    before = Window.partitionBy("id", "out").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
    both = Window.partitionBy("id")
    placed = (
        ends.repartition("id")
        .withColumn("first", F.coalesce(F.sum("copies").over(before), F.lit(0)))
        .withColumn("out_degree", F.sum(F.expr("if(out, copies, 0L)")).over(both))
        .withColumn("in_degree", F.sum(F.expr("if(out, 0L, copies)")).over(both))
    )
    parts = f"""case when entry is not null then sequence(first div {max_list}, (first + copies - 1) div {max_list})
        when out_degree + in_degree = 0 then array(0L) end"""
    dealt = placed.selectExpr("*", f"explode({parts}) as part").selectExpr(
        "id", "cast(part as int) as part", "out_degree", "in_degree", "out",
        f"""if(entry is null, null, array_repeat(entry, cast(least(first + copies, (part + 1) * {max_list})
            - greatest(first, part * {max_list}) as int))) as entries""",
    )
    grouped = dealt.groupBy("id", "part", "out_degree", "in_degree").agg(
        F.expr("collect_list(entries) filter (where out) as neighbors"), F.expr("collect_list(entries) filter (where not out) as linked_from")
    )
    whole = "if(size({0}) = 0, null, sort_array(flatten({0}))) as {0}"
    return grouped.selectExpr("id", "part", "out_degree", "in_degree", whole.format("neighbors"), whole.format("linked_from"))


def _both_of_hubs(links: DataFrame, hubs: DataFrame, out_hubs: DataFrame, in_hubs: DataFrame, max_list: int) -> DataFrame:
    """The rows of ``hubs``: lists that may be too long for one task meet by node and part, the few degrees are broadcast."""
    out_links = links.join(hubs.withColumnRenamed("id", "src"), "src", "left_semi").select(links.columns)
    in_links = links.join(hubs.withColumnRenamed("id", "dst"), "dst", "left_semi").select(links.columns)
    counted = out_links.selectExpr("src as id", "copies as out_degree", "0L as in_degree").unionByName(
        in_links.selectExpr("dst as id", "0L as out_degree", "copies as in_degree")
    )
    sizes = counted.groupBy("id").agg(F.sum("out_degree").alias("out_degree"), F.sum("in_degree").alias("in_degree"))
    outgoing = _lists(out_links, "src", "dst", "neighbors", max_list, out_hubs)
    incoming = _lists(in_links, "dst", "src", "linked_from", max_list, in_hubs)
    listed = outgoing.join(incoming, ["id", "part"], "full_outer")
    return listed.join(F.broadcast(sizes), "id").select("id", "part", "out_degree", "in_degree", "neighbors", "linked_from")
