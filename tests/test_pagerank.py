import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corvane.operators import pagerank as P
from corvane.operators import rank_run
from corvane.plans.pagerank import best_pages, pagerank_job
from test_graph import EVERY_KEY_HOT, LIST, SOME_KEYS_HOT, links_of, nodes_of

THREE = [("page1", "page2"), ("page1", "page3"), ("page2", "page3"), ("page2", "page1")]


def arcs_of(spark, arcs):
    return spark.createDataFrame(arcs, "src string, dst string")


def rounded(ranks):
    return {r.id: round(r["rank"], 6) for r in ranks.collect()}


def brute_force(arcs, ids, iterations):
    nodes = sorted(set(ids) | {a for a, _ in arcs} | {b for _, b in arcs})
    out = {n: [b for a, b in arcs if a == n] for n in nodes}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(iterations):
        received = dict.fromkeys(nodes, 0.0)
        lost = sum(rank[n] for n in nodes if not out[n])
        for n in nodes:
            for other in out[n]:
                received[other] += rank[n] / len(out[n])
        rank = {n: 0.15 + 0.85 * (received[n] + lost / len(nodes)) for n in nodes}
    return {n: round(r, 6) for n, r in rank.items()}


@pytest.mark.parametrize("hot", [{}, EVERY_KEY_HOT])
def test_first_iteration_of_the_worked_pages(spark, hot):
    links = links_of(spark, THREE)
    state = P.initial_state(links, nodes_of(spark, ["page1", "page2", "page3"]))
    assert rows(P.initial_ranks(links)) == [("page1", 1.0), ("page2", 1.0), ("page3", 1.0)]
    assert rows(P.contributions(links, state, **hot)) == [("page1", 0.5), ("page2", 0.5), ("page3", 1.0)]
    assert P.dangling_mass(state).first().mass == 1.0
    after = P.pagerank_step(links, state, **hot)
    assert rounded(after) == {"page1": 0.858333, "page2": 0.858333, "page3": 1.283333}
    assert after.columns == state.columns


def test_ten_iterations_of_the_worked_pages(spark):
    ranks = P.pagerank(arcs_of(spark, THREE))
    assert rounded(ranks) == {"page1": 0.875912, "page2": 0.875912, "page3": 1.248175}


def test_ten_iterations_of_the_worked_list(spark):
    ranks = P.pagerank(arcs_of(spark, LIST))
    assert rounded(ranks) == {"a": 0.440066, "b": 0.564319, "c": 0.803597, "d": 1.486333, "e": 1.705686}


def test_no_dangling_node(spark):
    circle = [("a", "b"), ("b", "c"), ("c", "a")]
    links = links_of(spark, circle)
    assert P.dangling_mass(P.initial_state(links)).first().mass == 0.0
    assert rounded(P.pagerank(arcs_of(spark, circle), iterations=3)) == {"a": 1.0, "b": 1.0, "c": 1.0}


def test_repeated_arcs_weigh_more_unless_unique(spark):
    arcs = [("a", "b"), ("a", "b"), ("a", "c")]
    assert rounded(P.pagerank(arcs_of(spark, arcs), iterations=4)) == brute_force(arcs, [], 4)
    assert rounded(P.pagerank(arcs_of(spark, arcs), iterations=4, unique_arcs=True)) == brute_force(
        sorted(set(arcs)), [], 4
    )


@pytest.mark.parametrize("hot", [{}, SOME_KEYS_HOT, EVERY_KEY_HOT])
def test_ranks_against_brute_force(spark, hot):
    random.seed(9)
    arcs = [("hub", f"n{i}") for i in range(60)] + [(f"n{i}", "sink") for i in range(30)]
    arcs += [(f"n{random.randrange(25)}", f"n{random.randrange(60)}") for _ in range(120)] + [("n3", "n3")]
    ids = ["n1", "n1", "hub", "listed only", "listed, too"]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    ranks = P.pagerank(arcs_of(spark, arcs), nodes_of(spark, ids), iterations=6, **hot)
    assert rounded(ranks) == brute_force(arcs, ids, 6)
    assert ranks.agg(F.sum("rank")).first()[0] == pytest.approx(ranks.count())
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_total_rank_stays_and_every_node_keeps_one(spark):
    links = links_of(spark, LIST)
    state = P.initial_state(links, nodes_of(spark, ["alone"]))
    for _ in range(2):
        state = P.pagerank_step(links, state)
        assert [r.id for r in state.orderBy("id").collect()] == ["a", "alone", "b", "c", "d", "e"]
        assert state.agg(F.sum("rank")).first()[0] == pytest.approx(6)


def test_no_arcs_at_all(spark):
    assert rounded(P.pagerank(arcs_of(spark, []), nodes_of(spark, ["x", "y"]), iterations=2)) == {"x": 1.0, "y": 1.0}


def test_only_contributions_move_in_an_iteration(spark, tmp_path):
    """Arcs and state lie where they are needed: one keyed shuffle per iteration, and neither is sorted again."""
    folder = str(tmp_path / "run")
    P.pagerank(arcs_of(spark, LIST), iterations=1, run=folder)
    (buckets,) = {r.buckets for r in rank_run.progress(spark, folder).collect()}
    own, tables = rank_run.loop_session(spark, buckets), rank_run._Tables(buckets)
    links = own.table(tables.stored(own, f"{folder}/arcs", rank_run.LINK_COLUMNS, "src"))
    state = own.table(tables.stored(own, f"{folder}/state-1", rank_run.STATE_COLUMNS, "id"))
    plan = rank_run.next_state(links, state, None, None, 0.0, 0.85, 0.15)._jdf.queryExecution().executedPlan().toString()
    tables.forget(own)
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1  # of what was received
    assert not spark.catalog.listTables()


def test_arcs_in_slices_give_the_same_ranks_and_fewer_contributions(spark, tmp_path, monkeypatch):
    """Buckets stay few where there are many arcs; slices of them by receiver are joined apart and no arc is shuffled or sorted again."""
    assert rank_run.grid(12, 450_000_000) == (15, 15) and rank_run.grid(8, 0) == (8, 1) and rank_run.grid(1000, 450_000_000) == (1000, 1)
    random.seed(5)
    arcs = [("hub", f"n{i}") for i in range(60)] + [(f"n{random.randrange(40)}", f"n{random.randrange(60)}") for _ in range(400)]
    arcs += arcs[100:120]
    monkeypatch.setattr(rank_run, "LINKS_PER_CELL", 10)
    for name, found in (("many", arcs), ("one", [(f"n{i}", "sink") for i in range(300)])):
        folder = str(tmp_path / name)
        got = P.pagerank(arcs_of(spark, found), nodes_of(spark, ["alone"]), iterations=3, run=folder)
        assert rounded(got) == brute_force(found, ["alone"], 3)
        (told,) = {(r.buckets, r.slices) for r in rank_run.progress(spark, folder).collect()}
        assert told[1] > 1
        assert rounded(P.pagerank(arcs_of(spark, []), iterations=4, run=folder)) == brute_force(found, ["alone"], 4)
    own, tables = rank_run.loop_session(spark, told[0]), rank_run._Tables(told[0])
    links = rank_run._stored_links(own, tables, str(tmp_path / "many"), 2)
    state = own.table(tables.stored(own, str(tmp_path / "many" / "state-1"), rank_run.STATE_COLUMNS, "id"))
    plan = rank_run.next_state(links, state, None, None, 0.0, 0.85, 0.15)._jdf.queryExecution().executedPlan().toString()
    tables.forget(own)
    assert len(links) > 1 and plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert not spark.catalog.listTables()


def test_links_of_a_step_are_written_compressed_and_in_order(spark):
    arcs = [(f"n{i * 7 % 40:02}", f"n{i % 11:02}") for i in range(300)]
    links, state = P.laid_down(links_of(spark, arcs), nodes_of(spark, ["alone"]))
    assert all(".zstd." in name for frame in (links, state) for name in frame.inputFiles()) and links.inputFiles()
    for part in links.select("src").rdd.glom().collect():
        assert list(part) == sorted(part)
    assert links.agg(F.sum("copies")).first()[0] == 300 and state.count() == 41


@pytest.mark.parametrize("hot", [{}, SOME_KEYS_HOT])
def test_a_run_goes_on_from_its_last_state(spark, tmp_path, hot):
    random.seed(4)
    arcs = [("hub", f"n{i}") for i in range(60)] + [(f"n{random.randrange(25)}", f"n{random.randrange(60)}") for _ in range(120)]
    folder = str(tmp_path / "run")
    first = P.pagerank(arcs_of(spark, arcs), iterations=5, run=folder, **hot)
    assert rounded(first) == brute_force(arcs, [], 5)
    # A state without its row of progress was broken off and is written anew.
    spark.range(3).write.parquet(f"{folder}/state-6")
    nothing = arcs_of(spark, [])  # the arcs are those of the run
    assert rounded(P.pagerank(nothing, iterations=8, run=folder, **hot)) == brute_force(arcs, [], 8)
    assert [r.iteration for r in rank_run.progress(spark, folder).collect()] == list(range(9))
    assert rounded(P.pagerank(nothing, iterations=5, run=folder, **hot)) == brute_force(arcs, [], 5)
    assert not spark.catalog.listTables()


def test_every_iteration_tells_its_mass_and_change(spark, tmp_path):
    folder = str(tmp_path / "run")
    P.pagerank(arcs_of(spark, LIST), nodes_of(spark, ["alone"]), iterations=4, run=folder)
    told = rank_run.progress(spark, folder).collect()
    assert [r.nodes for r in told] == [6] * 5 and [r.mass for r in told] == [pytest.approx(6)] * 5
    before = dict.fromkeys(brute_force(LIST, ["alone"], 0), 1.0)
    for r in told[1:]:
        after = brute_force(LIST, ["alone"], r.iteration)
        assert r.change == pytest.approx(max(abs(after[n] - before[n]) for n in after), abs=2e-6)
        assert r.dangling == pytest.approx(after["e"] + after["alone"], abs=2e-6)
        before = after


def test_a_run_stops_when_ranks_hardly_change(spark, tmp_path):
    folder = str(tmp_path / "run")
    ranks = P.pagerank(arcs_of(spark, LIST), iterations=200, tolerance=1e-3, run=folder)
    told = [r for r in rank_run.progress(spark, folder).collect() if r.iteration]
    assert 5 < len(told) < 60 and told[-1].change <= 1e-3 < told[-2].change
    assert rounded(ranks) == brute_force(LIST, [], len(told))


def test_job_writes_titles_in_rank_order(spark, tmp_path):
    (tmp_path / "arcs").write_text("".join(f"{a}\t{b}\n" for a, b in LIST + [("d", "f")]))
    (tmp_path / "nodes").write_text("a\tAlpha\nb\tBeta, Inc\nc\tGamma\nd\tDelta\ne\tZeta\na\tAlpha\n")
    ranks = pagerank_job(spark, str(tmp_path / "arcs"), str(tmp_path / "nodes"), str(tmp_path / "best"))
    assert ranks.count() == 6
    (part,) = (tmp_path / "best").glob("part-*")
    lines = [line.split("\t") for line in part.read_text().splitlines()]
    assert [title for title, _ in lines] == ["Delta", "Zeta", "f", "Gamma", "Beta, Inc", "Alpha"]
    nodes = spark.createDataFrame([("e", "Zeta")], "id string, title string")
    assert [r.title for r in best_pages(ranks, nodes, k=2).collect()] == ["d", "Zeta"]


def test_damping_and_base_are_parameters(spark):
    arcs = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c")]
    frame = spark.createDataFrame(arcs, "src string, dst string")
    ranks = dict.fromkeys("abcd", 1.0)
    for _ in range(3):
        got = dict.fromkeys("abcd", 0.0)
        for src, dst in arcs:
            got[dst] += ranks[src] / sum(s == src for s, _ in arcs)
        ranks = {node: 0.5 + 0.5 * x for node, x in got.items()}
    found = {r.id: r.rank for r in P.pagerank(frame, iterations=3, damping=0.5, base=0.5).collect()}
    assert found == pytest.approx(ranks)
