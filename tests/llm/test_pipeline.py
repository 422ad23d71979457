"""The stages of the pipeline on a few rows each."""

import collections
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
import tokenizers
from test_operators import sentence

from corvane.llm import packing, repetition
from corvane.llm.tokens import default_vocabulary, encode

SCHEMA = "doc_id bigint, text string, source string"


@pytest.fixture(scope="module")
def rng():
    return random.Random(12)


def texts_of(frame):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in frame.collect())


def test_only_the_contaminated_row_goes(spark, rng, tmp_path):
    passage = sentence(rng, 60)
    spark.createDataFrame([("q", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(i, sentence(rng, 80), "s") for i in (None, None, 1, 2)]
    docs = spark.createDataFrame([*clean, (None, passage, "s"), (1, f"a {passage} b", "s")], SCHEMA)
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert texts_of(kept) == texts_of(spark.createDataFrame(clean, SCHEMA))


def test_one_row_of_each_group_stays(spark, rng):
    shared, other, lone, copied, unnamed = (sentence(rng, 80) for _ in range(5))
    rows = [
        (1, shared), (1, other), (5, other),  # one id with two texts, of which a larger id has a copy
        (7, copied), (None, copied), (None, unnamed), (None, unnamed), (None, lone), (None, ""), (None, ""), (8, None), (8, None),
    ]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([(*r, "s") for r in rows], SCHEMA), "")
    stays = [(1, shared), (1, other), (7, copied), (None, unnamed), (None, lone), (None, ""), (None, ""), (8, None)]
    assert texts_of(kept) == texts_of(spark.createDataFrame([(*r, "s") for r in stays], SCHEMA))


def test_copies_of_four_fifths_go(spark, rng):
    text = sentence(rng, 500, 10**6)
    rows = [(1, text, "s"), (2, f"{text} {sentence(rng, 100, 10**6)}", "s"), (3, f"{text} {sentence(rng, 150, 10**6)}", "s")]  # 0.83 and 0.77 of the first
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([rows[0], rows[1]], SCHEMA), "")
    assert [r.doc_id for r in kept.collect()] == [1]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([rows[0], rows[2]], SCHEMA), "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


CLASHING = "doc_id bigint, text string, lang string, _row string, _secrets string, text_hash string, row_id string, secrets string, hash string, id string, n string, component string, found string, n_chars int"


def clashing(rows):
    return [(i, t, *["x"] * 11, len(t or "")) for i, t in rows]


def stage_rows(rng):
    """One of each kind of row that a stage decides on."""
    passage, shared = sentence(rng, 60), sentence(rng, 80)
    rows = [(i, sentence(rng, 60 + i)) for i in range(12)]
    rows += [(20, f"{rows[3][1]} extra word"), (21, shared), (22, shared), (None, shared)]  # near and exact copies
    rows += [(30, f"{passage} {sentence(rng, 30)}"), (31, None), (32, ""), (33, "few words only"), (34, "same words again " * 30)]
    rows += [(40 + i, f'{sentence(rng, 50)} token = "{"".join(rng.choices("0123456789abcdef", k=40))}" {sentence(rng, 20)}') for i in range(8)]
    rows += [(60 + i, f"{sentence(rng, 50)} Karte {rng.randrange(10**15, 10**16)} {sentence(rng, 20)}") for i in range(8)]
    return rows, passage


@pytest.fixture
def tables(spark, rng, tmp_path):
    rows, passage = stage_rows(rng)
    spark.createDataFrame(clashing(rows), CLASHING).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows


def passing(text):
    """The quality rules word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    chars = max(1, sum(map(len, w)))
    failed = len(w) < repetition.MIN_WORDS
    for n, limit in repetition.NGRAM_LIMITS.items():
        grams = collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
        hit = {j for k in range(len(w) - n + 1) if grams[tuple(w[k : k + n])] > 1 for j in range(k, k + n)}
        failed |= sum(len(w[j]) for j in hit) / chars > limit
        failed |= n == 8 and 100 * len(hit) > 30 * len(w)
    failed |= sum(len(b) for a, b in zip(w, w[1:]) if a == b) / chars > repetition.ECHO_LIMIT
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        again += sum(map(len, own)) if own and line in seen else 0
        seen.add(line)
    return not (failed or again / chars > repetition.LINE_CHARS_LIMIT)


def test_every_stage_keeps_the_columns(spark, tables, monkeypatch):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert (out.columns, [f.dataType for f in out.schema]) == (docs.columns, [f.dataType for f in docs.schema]), name
        others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
        assert out.select(*others).distinct().collect() == docs.select(*others).distinct().collect(), name
        docs = out


def test_quality_rules_against_brute_force(spark, rng):
    rows = stage_rows(rng)[0] + [(90, "line of words one two three\n" * 4 + sentence(rng, 12)), (91, "echo echo " * 9 + sentence(rng, 12)), (92, sentence(rng, 400, 12)), (93, sentence(rng, 300, 40))]
    kept = corpus_pipeline.quality_rules(spark, spark.createDataFrame(clashing(rows), CLASHING), "")
    assert texts_of(kept) == texts_of(spark.createDataFrame([(i, t, "") for i, t in rows if passing(t)], SCHEMA))


def test_secret_scans_mask_and_keep_all(spark, tables):
    folder, rows = tables
    clean = corpus_pipeline.secret_scans(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    masked = [(i, re.sub('"[0-9a-f]{40}"', '"[secret]"', t) if t else t) for i, t in rows]
    assert sorted((str(r.doc_id), r.text or "") for r in clean) == sorted((str(i), t or "") for i, t in masked)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in clean)


def packed_texts(pieces, texts):
    """Whether the pieces are the tokens of the texts, each once and in sequences without a gap."""
    vocabulary = default_vocabulary()
    ids = [(i, np.append(encode(vocabulary, t, special=True), 0).astype("<u4")) for i, t in texts]
    starts = collections.defaultdict(set)
    for r in pieces:
        starts[r.doc_id, r.doc_tokens].add((r.start, r.length))
    wanted = collections.Counter((i, a, n, zlib.crc32(x[a : a + n].tobytes()), len(x)) for i, x in ids for a, n in starts[i, len(x)])
    held = collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces)
    spans = collections.defaultdict(list)
    for r in pieces:
        spans[r.sequence_id].append((r.offset, r.length))
    for x in spans.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 1024
    return held == wanted


def test_run_against_brute_force(spark, tables):
    folder, rows = tables
    left = [(i, t) for i, t in rows if passing(t)]
    # Near copies: 5 words, 0.8; the smallest id stays, rows without one go first.
    sets = [set(zip(*(t.lower().split()[k:] for k in range(5)))) for _, t in left]
    group = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    left = [min((left[k] for k in range(len(left)) if group[k] == g), key=lambda r: (r[0] is None, r[0] or 0)) for g in sorted(set(group))]
    left = [(i, t) for i, t in left if i != 30]  # holds the benchmark's passage
    left = [(i, re.sub('"[0-9a-f]{40}"', '"[secret]"', t)) for i, t in left]
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {i for i, _ in left}
    assert packed_texts(got, left)


def test_a_stage_on_an_empty_table_and_without_items(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.createDataFrame([], CLASHING)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).isEmpty(), name
    docs = spark.createDataFrame(clashing([(1, "a b c"), (2, None), (2, None)]), CLASHING)
    assert corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).count() == 3


def test_odd_texts_do_not_stop_the_last_stage(spark):
    texts = [(1, " " * 1_000_000), (2, "a" * 200_000), (3, "!" * 200_000), (4, None), (4, None), (None, "x<|endoftext|>y"), (None, "x<|endoftext|>y")]
    got = corpus_pipeline.pack_sequences(spark, spark.createDataFrame(clashing(texts), CLASHING), "").collect()
    assert packed_texts(got, texts)
    (one,) = {r.ids_crc32 for r in got if r.doc_id is None}
    tokenizer = tokenizers.Tokenizer.from_file(default_vocabulary())
    ids = [*tokenizer.encode("x<|endoftext|>y", add_special_tokens=False).ids, 0]
    assert 50256 in ids and one == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_many_equal_rows_are_packed_apart(spark):
    rows = [(None, "the same text")] * 900 + [(i, f"text number {i}") for i in range(100)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(got) == 1000 and packed_texts(got, rows)
    assert len({(r.sequence_id, r.offset) for r in got}) == 1000
    assert len({r.sequence_id for r in got}) <= sum(r.length for r in got) / 1024 + 2
