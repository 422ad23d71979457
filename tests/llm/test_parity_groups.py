"""The similarity join on large groups: near copies around the limit, passages of otherwise different texts, one segment over several cells."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import LOWER, sentence, words

from corvane.llm import parity_join


def shingles(text, size=4):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, percent=85, size=4):
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    return {i: least[root(k)] for k, (i, _) in enumerate(rows)}


def clustered_rows(seed):
    rng = random.Random(seed)
    rows = []
    for length, copies, changes in ((60, 40, 2), (60, 40, 1), (150, 30, 4), (15, 25, 1), (400, 12, 9), (6, 12, 1)):
        base = sentence(rng, length, 10**6).split()
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(changes + 1)):
                text[rng.randrange(length)] = f"new{rng.randrange(10**6)}"
            rows.append(" ".join(text))
    passage = sentence(rng, 40, 10**6)
    rows += [f"{sentence(rng, rng.randrange(3, 40), 10**6)} {passage}" for _ in range(60)]
    rows += [sentence(rng, rng.randrange(1, 12), 3) for _ in range(80)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, cell, share, percent, size", [(1, 1 << 15, 64, 85, 4), (2, 6, 1, 85, 4), (3, 3, 2, 80, 5), (4, 10, 1, 70, 3)])
def test_groups_equal_brute_force(spark, seed, cell, share, percent, size):
    """Also where segments of a few classes are dealt out already."""
    rows = clustered_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = parity_join.similar_documents(docs, size=size, percent=percent, cell=cell, sample_share=share)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute(rows, percent, size)


@pytest.mark.parametrize("cell_shingles", [2_000_000, 300])
def test_pairs_that_fail_do_not_part_a_group(spark, cell_shingles):
    """All classes in one tree by pairs with the smallest one, most of which fail: the rest is found by looking again."""
    rows = clustered_rows(5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = docs.mapInArrow(parity_join._signer(4, 85, 64), parity_join.SIGNED).where("n_shingles > 0")
    of_doc = {r.doc_id: r["class"] for r in signed.collect()}
    known = sorted(set(of_doc.values()))
    paired = spark.createDataFrame([(parity_join.EDGE, None, known[0], x, None, None) for x in known[1:]], parity_join.PAIRED)
    classes = signed.groupBy("class").agg(F.min("doc_id").alias("first_id"))
    found = {r["class"]: r.component for r in parity_join._linked(docs, classes, paired, 4, 85, 1 << 15, cell_shingles).collect()}
    expected, got = brute(rows), {}
    for i, c in of_doc.items():
        got.setdefault(found.get(c, c), []).append(i)
    assert {i: min(group) for group in got.values() for i in group} == {i: expected[i] for i in of_doc}


def test_texts_do_not_move_for_their_sets(spark, changed, tmp_path):
    """Sets of a few classes are made where their texts are read, also where no join is broadcast; rows without id and repeated rows as well."""
    changed("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(k if k % 9 else None, f"word{k // 2} is one of these words and {k // 2} more") for k in range(2000)] + [(7, "again the same id")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    signed = docs.mapInArrow(parity_join._signer(4, 85, 64), parity_join.SIGNED).cache()
    classes = signed.groupBy("class").agg(F.min("doc_id").alias("first_id"))
    needed = classes.where("class % 20 = 0").select("class")
    sets = parity_join._text_sets(docs, classes, needed, 4)
    assert {r["class"] for r in sets.collect()} == {r["class"] for r in needed.collect()}
    expected = {r["class"]: r.n_shingles for r in signed.collect()}
    assert all(r.n == expected[r["class"]] for r in sets.collect())
    plan = sets._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    at = next(k for k, line in enumerate(plan) if "MapInArrow" in line)
    depths = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in plan]
    below = plan[at + 1 : next((k for k in range(at + 1, len(plan)) if depths[k] <= depths[at]), len(plan))]
    assert any("FileScan" in line for line in below) and not any("Exchange" in line for line in below)
    signed.unpersist()


def test_a_forest_connects_what_may_be_similar():
    rng = np.random.default_rng(3)
    for groups in (3, 40):
        n = 200
        sizes, sketches = rng.integers(90, 110, n), rng.integers(0, 4, (n, parity_join.SKETCH_WORDS)).astype(np.uint64) << np.uint64(3)
        segments = np.sort(rng.integers(0, groups, 3 * n)).astype(np.uint64)
        member = rng.integers(0, n, 3 * n)
        order = np.lexsort((member, segments))
        member = member[order]
        once = np.concatenate([[True], (segments[1:] != segments[:-1]) | (member[1:] != member[:-1])])
        segments, member = segments[once], member[once]
        pairs, roots = parity_join._forest_pairs(segments, member, sizes, sketches, 95)
        assert len(pairs) == n - len(set(roots.tolist()))
        for a, b in pairs:
            assert parity_join._similar(sizes[a], sketches[a], sizes[b : b + 1], sketches[b : b + 1], 95)[1].all() and roots[a] == roots[b]
        for s in np.unique(segments):
            group = member[segments == s]
            for k, a in enumerate(group):
                near = parity_join._similar(sizes[a], sketches[a], sizes[group[k + 1 :]], sketches[group[k + 1 :]], 95)[1]
                assert (roots[group[k + 1 :]][near] == roots[a]).all()
