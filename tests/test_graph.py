import random
from collections import defaultdict

import pytest
from conftest import rows

from corvane.operators import graph as G
from corvane.sources.tabbed import ARC_FIELDS, read_arcs, read_nodes, short_rows

LIST = [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d"), ("d", "e")]
EVERY_KEY_HOT = {"max_hot": 1000, "min_hot_rows": 0}
SOME_KEYS_HOT = {"max_hot": 1000, "min_hot_rows": 20}


def links_of(spark, arcs, unique=False):
    return G.link_counts(spark.createDataFrame(arcs, "src string, dst string"), unique)


def nodes_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_adjacency_of_the_worked_list(spark):
    links = links_of(spark, LIST)
    assert rows(G.adjacency(links)) == [
        ("a", 0, ["b", "c", "d"]),
        ("b", 0, ["c", "d"]),
        ("c", 0, ["d"]),
        ("d", 0, ["e"]),
    ]
    assert rows(G.reverse_adjacency(links)) == [
        ("b", 0, ["a"]),
        ("c", 0, ["a", "b"]),
        ("d", 0, ["a", "b", "c"]),
        ("e", 0, ["d"]),
    ]
    assert rows(G.dangling_nodes(links)) == [("e",)]
    assert rows(G.dangling_with_inlinks(links)) == [("e", 0, ["d"])]


def test_every_node_has_degrees(spark):
    arcs = [("a", "b"), ("a", "b"), ("b", "b"), ("b", "out, of map"), (None, "b"), ("b", None)]
    links = links_of(spark, arcs)
    nodes = nodes_of(spark, ["a", "b", "alone", "alone", None])
    assert rows(G.degrees(links, nodes)) == [
        ("a", 2, 0),
        ("alone", 0, 0),
        ("b", 2, 3),
        ("out, of map", 0, 1),
    ]
    assert rows(G.dangling_nodes(links, nodes)) == [("alone",), ("out, of map",)]
    assert rows(G.adjacency_with_dangling(links, nodes)) == [
        ("a", 0, ["b", "b"]),
        ("alone", 0, None),
        ("b", 0, ["b", "out, of map"]),
        ("out, of map", 0, None),
    ]
    assert rows(G.both_lists(links, nodes)) == [
        ("a", 0, 2, 0, ["b", "b"], None),
        ("alone", 0, 0, 0, None, None),
        ("b", 0, 2, 3, ["b", "out, of map"], ["a", "a", "b"]),
        ("out, of map", 0, 0, 1, None, ["b"]),
    ]
    # Beyond a list's last part its column is null, and the degree tells that it has others.
    assert rows(G.both_lists(links, nodes, max_list=2))[2:4] == [
        ("b", 0, 2, 3, ["b", "out, of map"], ["a", "a"]),
        ("b", 1, 2, 3, None, ["b"]),
    ]
    assert rows(G.degrees(links_of(spark, arcs, unique=True), nodes))[0] == ("a", 1, 0)


@pytest.mark.parametrize("hot", [{}, SOME_KEYS_HOT, EVERY_KEY_HOT])
def test_dangling_nodes_lists_do_not_depend_on_hot_keys(spark, hot):
    arcs = [(f"n{i:03}", "sink") for i in range(70)] + [("n001", "n002"), ("n001", "sink")]
    expected = sorted(src for src, dst in arcs if dst == "sink")
    found = rows(G.dangling_with_inlinks(links_of(spark, arcs), max_list=30, **hot))
    assert found == [("sink", p, expected[30 * p : 30 * p + 30]) for p in range(3)]


def test_long_lists_come_in_parts_and_whole(spark):
    random.seed(5)
    arcs = [("hub", f"n{i % 200}") for i in range(450)] + [("twins", "same")] * 95
    arcs += [(f"n{random.randrange(60)}", f"n{random.randrange(60)}") for _ in range(300)]
    expected = defaultdict(list)
    for src, dst in arcs:
        expected[src].append(dst)
    found = rows(G.adjacency(links_of(spark, arcs), max_list=30))
    assert sorted(found) == sorted(
        (src, p, sorted(dsts)[30 * p : 30 * p + 30])
        for src, dsts in expected.items()
        for p in range(-(-len(dsts) // 30))
    )


def test_reading_arcs_and_nodes(spark, tmp_path):
    (tmp_path / "arcs").write_text("a\tb\tignored\nb\tc, d\nlonely\n")
    (tmp_path / "nodes").write_text("a\tTitle A\nb\n")
    assert rows(read_arcs(spark, str(tmp_path / "arcs"))) == [("a", "b"), ("b", "c, d")]
    assert short_rows(spark, str(tmp_path / "arcs"), ARC_FIELDS).first().rejected == 1
    assert rows(read_nodes(spark, str(tmp_path / "nodes"))) == [("a", "Title A"), ("b", None)]


def test_arcs_of_a_corpus(spark):
    pages = [
        ("p1", '<a href="q, r">x</a> <a class="y" href="p2">z</a><a href="p2">again</a>'),
        ("p2", "<a href='single'>no</a> <a HREF=\"upper\">no</a>"),
        ("p3", '<link href="">'),
    ]
    corpus = spark.createDataFrame(pages, "title string, text string")
    assert rows(G.corpus_arcs(corpus)) == [("p1", "p2"), ("p1", "p2"), ("p1", "q, r"), ("p3", "")]


def test_hubs_get_the_same_lists(spark, monkeypatch):
    """By ranges over several tasks, as by one task."""
    arcs = [("hub", f"n{i % 900:04}") for i in range(3000)] + [(f"n{i:04}", f"n{(i * 7) % 50:04}") for i in range(900)]
    links = G.link_counts(spark.createDataFrame(arcs, "src string, dst string"))
    plain = [rows(G.adjacency(links, 40)), rows(G.reverse_adjacency(links, 40))]
    monkeypatch.setattr(G, "_hubs", lambda rows, own: rows.sparkSession.createDataFrame([("hub",), ("n0007",)], "id string"))
    assert [rows(G.adjacency(links, 40)), rows(G.reverse_adjacency(links, 40))] == plain
    assert len([r for r in plain[0] if r[0] == "hub"]) == 75


def test_hubs_are_found_by_their_share(spark):
    arcs = [("hub", f"n{i}") for i in range(500)] + [(f"n{i}", "x") for i in range(1500)]
    links = G.link_counts(spark.createDataFrame(arcs, "src string, dst string"))
    assert rows(G._hubs(links, "src", 10, 100)) == [("hub",)]
    assert rows(G._hubs(links, "dst", 2, 100)) == [("x",)]
    assert rows(G._hubs(links, "src", 10, 501)) == []
    assert rows(G._hubs(links.where("src = 'none'"), "src", 10, 1)) == []


def test_links_move_once_for_lists(spark):
    arcs = [(f"n{i % 30}", f"n{i}") for i in range(300)]
    links = G._laid_down(G.link_counts(spark.createDataFrame(arcs, "src string, dst string")))
    plan = G._lists(links, "src", "dst", "neighbors", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan


def test_both_lists_move_links_once(spark):
    """One exchange for degrees and lists of both directions, and none of finished lists."""
    arcs = [(f"n{i % 30}", f"n{i}") for i in range(300)]
    nodes = spark.createDataFrame([("alone",), ("alone",), ("n1",)], "id string")
    found = G.both_lists(G.link_counts(spark.createDataFrame(arcs, "src string, dst string")), nodes, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert rows(found)[0] == ("alone", 0, 0, 0, None, None)


def test_both_lists_of_hubs_and_of_others(spark, monkeypatch):
    """Hubs one way, the other or both, with parts on one side only."""
    arcs = [("hub", f"n{i % 90:02}") for i in range(300)] + [(f"n{i:02}", "goal") for i in range(90)] + [("goal", "hub"), ("n07", "n07"), ("n07", "n07")]
    arcs += [(f"n{i % 17:02}", f"n{(i * 7) % 50:02}") for i in range(200)]
    links = G.link_counts(spark.createDataFrame(arcs, "src string, dst string"))
    nodes = spark.createDataFrame([("alone",), ("hub",), (None,)], "id string")
    expected = {}
    for node in {x for a in arcs for x in a} | {"alone"}:
        out, into = sorted(d for s, d in arcs if s == node), sorted(s for s, d in arcs if d == node)
        for p in range(max(1, -(-len(out) // 20), -(-len(into) // 20))):
            expected[node, p] = (len(out), len(into), out[20 * p : 20 * p + 20] or None, into[20 * p : 20 * p + 20] or None)
    whole = sorted(((*k, *v) for k, v in expected.items()), key=repr)
    assert rows(G.both_lists(links, nodes, 20)) == whole
    named = iter([["hub", "n07"], ["goal", "n07"]] * 2)
    monkeypatch.setattr(G, "_hubs", lambda r, own: r.sparkSession.createDataFrame([(x,) for x in next(named)], "id string"))
    assert rows(G.both_lists(links, nodes, 20)) == whole
