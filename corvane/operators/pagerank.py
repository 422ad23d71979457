"""PageRank, one step at a time and iterated.

Dangling nodes share their rank equally with all nodes in every iteration, so
the ranks always sum up to the number of nodes.

``links`` is ``(src, dst, copies)`` from ``graph.link_counts``; ``state`` has one
row per node: ``(id, out_degree, out_links, rank)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scoring import BASE_RANK, DAMPING, damped
from corvane.operators import rank_run
from corvane.operators.graph import HUBS
from corvane.operators.lookup import MIN_HOT_ROWS, attach
from corvane.operators.rank_run import MASS, received, sent, shares, initial_state
from corvane.session import laid_out, scratch_path


def laid_down(links: DataFrame, nodes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The links and the nodes' first state, each computed once and written for a plan that reads them often."""
    links = laid_out(links, "links", "src")
    return links, laid_out(initial_state(links, nodes), "state", "id")


def initial_ranks(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    return initial_state(links, nodes).select("id", "rank")


def contributions(links: DataFrame, state: DataFrame, **hot) -> DataFrame:
    """``(id, contribution)`` for the nodes that receive anything over arcs."""
    return received(sent(attach(links, shares(state), "src", "out_links", **hot)))


def dangling_mass(state: DataFrame) -> DataFrame:
    """``mass``, the rank held by nodes without outgoing arcs."""
    return state.selectExpr(f"{MASS} as mass")


def _redistributed(state: DataFrame) -> Column:
    """What every node gets of the dangling nodes' rank."""
    return state.selectExpr(f"try_divide({MASS}, count(*)) as per_node").scalar()


def _updated(
    state: DataFrame, gains: DataFrame, damping: float = DAMPING, base: float = BASE_RANK
) -> DataFrame:
    """``state`` with new ranks; a left join, since every node keeps its rank."""
    contribution = F.coalesce("contribution", F.lit(0.0))
    rank = damped(contribution, _redistributed(state), damping, base).alias("rank")
    return state.join(gains, "id", "left").select("id", "out_degree", "out_links", rank)


def pagerank_step(
    links: DataFrame, state: DataFrame, damping: float = DAMPING, base: float = BASE_RANK, **hot
) -> DataFrame:
    """``state`` after one more iteration, as one lazy plan."""
    return _updated(state, contributions(links, state, **hot), damping, base)


def pagerank(
    arcs: DataFrame,
    nodes: DataFrame | None = None,
    iterations: int = 10,
    unique_arcs: bool = False,
    max_hot: int = HUBS,
    min_hot_rows: int = MIN_HOT_ROWS,
    damping: float = DAMPING,
    base: float = BASE_RANK,
    tolerance: float | None = None,
    run: str | None = None,
) -> DataFrame:
    """``(id, rank)`` after a number of iterations, or after the first in which no rank changes by more than ``tolerance``.

    A node keeps ``base`` and gets ``damping`` times what it receives; the ranks sum up to
    the number of nodes if the two sum up to 1.

    ``run`` is a folder that keeps arcs, states and progress (``rank_run.progress``). A folder with a run in it is gone on
    with from its last written state, with its own arcs; without a folder a new one is used.
    """
    folder = run or scratch_path(arcs.sparkSession, "pagerank")
    return rank_run.ranks(arcs, nodes, folder, iterations, unique_arcs, min(max_hot, HUBS), min_hot_rows, damping, base, tolerance)
