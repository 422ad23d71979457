"""Whitening, line deduplication and alignment of tokenizers against brute force, on odd rows and on empty tables."""

import collections
import hashlib
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.llm import alignment, csr, line_dedup, whitening
from corvane.llm.tokens import default_pieces, default_vocabulary, encode, vocabulary

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key(row):
    return tuple((x is not None, x) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


# ---- whitening

VECTORS = "vec_id bigint, embedding array<double>, component string, n string, packed string, whitened string"


def vector_rows(wild=False):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0.1 * k, 0.3 + 0.1 * k) for k in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # a third of the rows are one vector
    rows += [(7, rows[7][1]), (None, rows[8][1]), (2001, None), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, []), (2004, [1.0, 2.0])]
    rows += [(2005, [float("nan")] + [0.0] * 5), (2006, [float("inf")] + [0.0] * 5), (2007, [0.0] * 6), (2008, [-0.0] * 6)]
    if wild:
        rows += [(3000, [1e6, -1e9, 3e12, 0.0, 1.0, 2.0]), (3001, [1e300, -1e300, 0.0, 0.0, 0.0, 0.0]), (3002, [-4e13] * 6)]
    return [(*r, "c", "n", "p", "w") for r in rows]


def brute_whitening(rows):
    good = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v)]
    xs = [(i, [int(np.floor(min(max(64 * c, -(2.0**62)), 2.0**62))) + 1000000 for c in v]) for i, v in good]
    fit = sorted({tuple(x) for _, x in xs})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    cov = np.array([[float(Fraction(sum((n * a[i] - sums[i]) * (n * a[j] - sums[j]) for a in fit), n**3)) for j in range(6)] for i in range(6)])
    deviation = {tuple(x): sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in xs}
    return xs, n, sums, cov, deviation


@pytest.mark.parametrize("wild", [False, True])
def test_whitening(spark, wild):
    rows = vector_rows(wild)
    xs, n, sums, cov, deviation = brute_whitening(rows)
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    kept = int((values > 6 * np.finfo(float).eps * values[0]).sum())
    per_row = collections.defaultdict(list)
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        per_row[r.vec_id, r.deviation].append((r.component, r.whitened, r.explained))
    assert len(got) == kept * len(xs)
    counted = collections.Counter((i, d if (d := deviation[tuple(x)]) < 2**63 else None) for i, x in xs)
    assert {k: len(v) // kept for k, v in per_row.items()} == counted
    for i, x in xs:
        d = deviation[tuple(x)] if deviation[tuple(x)] < 2**63 else None
        centred = np.array([float(Fraction(a * n - s, n)) for a, s in zip(x, sums)])
        for component, value, explained in per_row[i, d]:
            k = component - 1
            assert np.isclose(explained, values[k] / np.trace(cov), rtol=1e-9)
            if not wild and counted[i, d] == 1:
                assert np.isclose(abs(value), abs(centred @ axes[:, k]) / np.sqrt(values[k]), atol=1e-9)


def test_polarised_covariance_equals_that_of_products(spark):
    rows = vector_rows(True)
    _, n, sums, cov, _ = brute_whitening(rows)
    packed = whitening.quantised(spark.createDataFrame(rows, VECTORS)).where("size = 6").select("packed").distinct()
    rests = [s % n for s in sums]
    squares = whitening._added(packed.mapInArrow(whitening._squarer(np.array([s // n for s in sums])), whitening.SUMS))
    assert np.allclose(whitening.covariance(squares, n, rests), cov, rtol=1e-14)


def test_whitening_of_few_vectors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert whitening.whiten(frame([])).collect() == []
    assert whitening.whiten(frame([(1, [0.5, 0.25])] * 3)).collect() == []  # nothing varies
    got = whitening.whiten(frame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in got) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


# ---- lines

LINES = "doc_id bigint, text string, at string, copy string, hash string, runs string, n_lines string, start string"


def line_rows():
    rng = random.Random(9)
    line = lambda i: f"This is Line number {i} é"
    rows = [(i, "\n".join(line(rng.randrange(60)) if rng.random() < 0.5 else f"own {i} {k} words" for k in range(rng.randrange(1, 12)))) for i in range(40)]
    common = "The common license LINE"
    rows += [(100 + i, f"{common}\nunique text {i}\n  {common.upper()} \t\r\nshort\n") for i in range(30)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (5, "another text of id five\n" + line(3)), (None, common), (None, "only nulls hold this"), (None, "only nulls hold this\nonly nulls hold this")]
    rows += [(200, ""), (201, None), (202, "\n\n"), (203, " \x0b\x0c "), (204, "ÀÉÎ upper accents"), (205, "àéî upper accents"), (206, " not stripped "), (207, "not stripped")]
    rows += [(208, "123456789"), (209, "123456789"), (210, "1234567890"), (211, "1234567890"), (212, "日本語日本語日本語日"), (213, "日本語日本語日本語日"), (214, "\n".join(line(i % 60) for i in range(5000)))]
    return [(*r, "a", "c", "h", "r", "n", "s") for r in rows]


def brute_lines(rows):
    keyed = [(i, [(x, x.strip(" \t\n\x0b\x0c\r").translate(LOWER)) for x in (t or "").split("\n")]) for i, t, *_ in rows]
    holders = collections.defaultdict(set)
    for i, lines in keyed:
        for _, k in lines:
            holders[k].add(i)
    place = lambda i: (i is None, i or 0)
    out = []
    for i, lines in keyed:
        gone = [len(k) >= 10 and len(holders[k]) > 1 and min(holders[k], key=place) != i for _, k in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for (x, _), g in zip(lines, gone) if not g)))
    return out


@pytest.mark.parametrize("hot_keys, least", [(line_dedup.HOT_KEYS, line_dedup.LEAST_HOT), (50, 10), (20_000, 1)])
def test_lines(spark, hot_keys, least):
    """By ranges alone, some lines as hot ones, and all as hot ones."""
    got = line_dedup.remove_repeated_lines(spark.createDataFrame(line_rows(), LINES), hot_keys=hot_keys, least=least)
    same(got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect(), brute_lines(line_rows()))


def test_hot_lines_are_found(spark):
    docs = spark.createDataFrame(line_rows(), LINES)
    found = line_dedup.lines(docs)
    hot = {r.hash for r in line_dedup.hot_hashes(found, 20, 2).collect()}
    counts = {r.hash: r["count"] for r in found.groupBy("hash").count().collect()}
    assert {h for h, n in counts.items() if n >= sum(counts.values()) / 20} <= hot
    assert len(hot) <= 20


def test_bitmaps_hold_runs(spark):
    docs = spark.createDataFrame([(1, "line number one\nline number two\nline number three"), (2, "line number one\nline number two\nown line of two\nline number three")], "doc_id int, text string")
    (got,) = line_dedup.line_bitmaps(docs).collect()
    assert got.doc_id == 2 and [tuple(x) for x in got.runs] == [(0, 2), (3, 1)]


def test_lines_are_dealt_by_one_range_exchange(spark):
    docs = spark.createDataFrame(line_rows(), LINES)
    dropped = line_dedup.dropped_lines(line_dedup.lines(docs))
    plan = dropped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(hash") == 1 and "Python" not in plan and "Arrow" not in plan


def test_lines_of_an_empty_table(spark):
    assert line_dedup.remove_repeated_lines(spark.createDataFrame([], LINES)).collect() == []


# ---- alignment

TEXTS = "doc_id bigint, text string, links string, n string, n_a string"


def text_rows():
    rows = ["Hello world, this is a test.", "it's  2 spaces\n\n x<|endoftext|> </s><unk>", "日本語 ñandú straße", "", None, " ", "ﬁ ▁ under", "a\x00b", "x" * 3000, " " * 5000 + "end", "tab\tand\r\nline", "é" * 10, "the the the", "<0x41> byte", "🙂🙃"]
    return [(i, t, "l", "n", "a") for i, t in enumerate(rows)] + [(0, rows[0], "l", "n", "a"), (None, rows[0], "l", "n", "a")]


def brute_tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return [], []
    a = Tokenizer.from_file(default_vocabulary())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
    known = vocabulary(default_vocabulary()).token_bytes
    of_a = [(i, known[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = f" {text}".encode()
    return (of_a, of_b) if b"".join(x for _, x in of_a) == whole == b"".join(x for _, x in of_b) else ([], [])


def spans(tokens):
    out, at = [], 0
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute_alignment(rows):
    docs = []
    for doc_id, text, *_ in rows:
        a, b = map(spans, brute_tokens(text))
        both = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for cut in both:
            groups.append(([x for x in a if low <= x[1] < cut], [x for x in b if low <= x[1] < cut]))
            low = cut
        links = [(x[0], y[0]) for x in a for y in b if x[2] == y[2]]
        written = ";".join(",".join(str(x[0]) for x in p) + "|" + ",".join(str(x[0]) for x in q) for p, q in groups)
        docs.append((doc_id, a, b, groups, links, hashlib.sha256(written.encode()).hexdigest() if a else ""))
    counts = collections.Counter(p for d in docs for p in d[4])
    top = collections.Counter()
    for (_, y), c in counts.items():
        top[y] = max(top[y], c)
    return docs, [
        (i, len(a), len(b), len(g), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), sha, sum(len(p) * len(q) for p, q in g))
        for i, a, b, g, links, sha in docs
    ]


def test_alignment(spark):
    rows = text_rows()
    got = alignment.alignment(spark.createDataFrame(rows, TEXTS).repartition(3))
    _, expected = brute_alignment(rows)
    same(got.collect(), expected)
    assert sum(e[1] == 0 for e in expected) == 3  # null, empty, and the text that B does not give back


def test_overlap_and_shared_group_links(spark):
    rows = [r for r in text_rows() if r[1] is None or len(r[1]) < 100][:12]
    frame = spark.createDataFrame(rows, TEXTS)
    docs, _ = brute_alignment(rows)
    overlapping, shared = [], []
    for i, a, b, groups, *_ in docs:
        for m, x in enumerate(a):
            for n, y in enumerate(b):
                if (size := min(x[2], y[2]) - max(x[1], y[1])) > 0:
                    overlapping.append((i, m, n, x[0], y[0], size, x[2] == y[2]))
        for g, (p, q) in enumerate(groups):
            shared += [(i, a.index(x), b.index(y), x[0], y[0], g) for x in p for y in q]
    same(alignment.overlap_links(frame).collect(), overlapping)
    same(alignment.shared_group_links(frame).collect(), shared)


def test_groups_and_their_pairs_are_products(monkeypatch):
    """The query's own groups come from the bytes they share with tokens, and its pairs from the product of both sides' groups."""
    products, multiply = [], alignment.row_products

    def recorded(x, y):
        out = list(multiply(x, y))
        products.append((x, y, out))
        return iter(out)

    def dense(m):
        return np.array([np.bincount(m.indices[m.indptr[i] : m.indptr[i + 1]], minlength=m.width) for i in range(len(m))])

    monkeypatch.setattr(alignment, "row_products", recorded)
    written = ["it's  2 spaces", None, "日本語 ñandú straße", "the the"]
    (out,) = alignment._aligner(default_vocabulary(), default_pieces())(iter([pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": written})]))
    docs, expected = brute_alignment(list(enumerate(written)))
    assert out["n_shared"].to_pylist() == [e[-1] for e in expected]
    _, of_a, of_b, shared = products
    sizes = [p[-1][2] - p[0][1] for d in docs for p, _ in d[3]]
    assert np.diff(of_a[0].indptr).tolist() == np.diff(of_b[0].indptr).tolist() == sizes
    for (group_bytes, byte_tokens, _), got in ((of_a, dense(shared[0]).T), (of_b, dense(shared[1]))):
        assert (got == (dense(group_bytes) @ dense(byte_tokens) > 0)).all()
    assert sum(len(i) for i, *_ in shared[2]) == sum(e[-1] for e in expected)


def test_products_of_rows():
    rng = np.random.default_rng(4)
    a, b = rng.random((40, 30)) < 0.2, rng.random((30, 50)) < 0.2
    made = lambda m: csr.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1])
    for most in (1, 37, 1 << 20):
        out = np.zeros((40, 50), int)
        for i, j, v in csr.row_products(made(a), made(b), most):
            out[i, j] += v
        assert (out == a.astype(int) @ b.astype(int)).all()
    assert (csr.row_products is not None) and (made(a).transposed().transposed().indices == made(a).indices).all()
    assert list(csr.row_products(csr.runs(np.zeros(0, int)), csr.runs(np.zeros(0, int)))) == []


def test_counted_links_end_together(spark):
    """The bound of the table that is sent to the tasks: the bytes of one id are the end of the other's."""
    aligned = alignment.aligned_documents(spark.createDataFrame(text_rows(), TEXTS))
    known = alignment.tokenizers(default_vocabulary(), default_pieces())
    for r in alignment.link_counts(aligned, len(known.bytes_b)).collect():
        a, b = known.bytes_a[r.link // len(known.bytes_b)], known.bytes_b[r.link % len(known.bytes_b)]
        assert a.endswith(b) or b.endswith(a)


def test_alignment_of_an_empty_table(spark):
    assert alignment.alignment(spark.createDataFrame([], TEXTS)).collect() == []
    assert alignment.overlap_links(spark.createDataFrame([], TEXTS)).collect() == []


# ---- token ids

@pytest.mark.parametrize("special", [False, True])
def test_ids_of_odd_texts(special):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    tokenizer.encode_special_tokens = not special
    white = [" " * 3000, "\n" * 2500 + " ", "　" * 1500 + "\t", "\x85 \xa0" * 700]
    odd = ["a <|endoftext|> b<|endoftext|>", "<|endoftext|>", "<|endoftext|", "x" + white[0] + "y", white[0], "x" + white[1] + "あ", white[2] + "y  ", "a" + white[3] + "1", "it's" + " " * 1000 + "'s" + " " * 999]
    for text in odd:
        assert encode(default_vocabulary(), text, special).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:20]


@pytest.mark.parametrize("sign", [" ", "\n", "a", "!", "中"])
def test_a_million_equal_characters(sign):
    assert len(encode(default_vocabulary(), f"x{sign * 1_000_000}y")) > 0
