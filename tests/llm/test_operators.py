"""The operators against brute force on a small fixture of odd rows, and on empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import kneser_ney, language, packing, parity_join, phrases, repetition, secrets, token_trees, toxicity, window_dedup
from corvane.llm.tokens import default_vocabulary, encode

SPACE = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id bigint, text string, lang string, n_words string, score string, part string, segment string"


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}é" if rng.random() < 0.1 else f"Wort{rng.randrange(words)}" for _ in range(n))


def fixture_rows():
    rng = random.Random(5)
    base = [sentence(rng, 120) for _ in range(12)]
    near = [b.split() for b in base]
    for words in near:
        words[60] = "Changed"
    passage = sentence(rng, 60)
    out = base + [" ".join(w) for w in near] + base[:4]
    out += [f"{sentence(rng, 30)} {passage} {sentence(rng, 25)}" for _ in range(6)]
    out += ["", " \n\t ", None, "one", "one two", "ONE two", "a b c d", "the line\n" * 12, "x " * 300, sentence(rng, 8000)]
    rows = [(i, x) for i, x in enumerate(out)]
    rows += [(3, out[3]), (None, base[5]), (None, None)]  # repeated rows, and rows without id
    return [(*r, "de", "n", "s", "p", "g") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(SPACE, text or "")


def key(row):
    return tuple((x is not None, x) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_repetition(docs):
    expected = []
    for i, text, *_ in fixture_rows():
        w = words(text)
        grams = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        expected.append((i, len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)))
    got = repetition.measure(docs).select("doc_id", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    same(got, expected)
    assert repetition.kept_documents(docs).columns == docs.columns


def test_windows(docs):
    first = {}
    last = 1 << 62
    rows = [(last if i is None else i, i, words(t)) for i, t, *_ in fixture_rows()]
    for order, _, w in rows:
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(first.get(g, last), order)
    expected = []
    for order, i, w in rows:
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < order for j in range(k, k + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        expected.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    same(window_dedup.remove_repeated_windows(docs).collect(), expected)


def test_parity_join(docs):
    rows = [(i, words((t or "").translate(LOWER))) for i, t, *_ in fixture_rows()]
    sets = [frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset() for _, w in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(x for x in (i, least.get(g)) if x is not None) if (i, least.get(g)) != (None, None) else None
    expected = [(i, len(s), least[g] if s else i) for (i, _), s, g in zip(rows, sets, group, strict=True)]
    same(parity_join.similar_documents(docs).select("doc_id", "n_shingles", "component_id").collect(), expected)


def test_no_similar_pair_is_missed_by_segments():
    """Sets at the very limit share a segment, whatever their size."""
    rng = np.random.default_rng(1)
    for size in (6, 7, 13, 40, 137, 600, 2500):
        for _ in range(10):
            common = rng.integers(1, 1 << 63, size).astype(np.uint64)
            extra = rng.integers(1, 1 << 63, int(size * 0.15 / 0.85)).astype(np.uint64)
            cut = rng.integers(0, len(extra) + 1)
            a, b = (np.sort(np.concatenate([common, e])) for e in (extra[:cut], extra[cut:]))
            found = parity_join._sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 85)
            order = np.where(found.filled, 1 + found.numbers % np.uint64(3), parity_join.EMPTY).astype(np.uint8)
            shared, _ = parity_join.texts.repeated(found.numbers)
            order[found.filled & ~shared] = 0  # as counted over the two
            at = parity_join._chosen(found, order)
            of_a = found.sketch[at] < 2
            assert set(found.numbers[at][of_a]) & set(found.numbers[at][~of_a])


def test_phrases(spark, docs):
    rows = fixture_rows()
    items = [(1, " ".join(rows[2][1].split()[10:40])), (2, "wort1"), (3, None), (4, "..."), (10, "never seen before here at all"), (1, "one two")]
    items += [(None, "a b c d")]
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = find(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add("" if i is None else str(i))
    expected = []
    for i, t, *_ in rows:
        w, hit, found = find(t), set(), set()
        for g, ids in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    index = phrases.build_index(docs)
    for query_chars in (1 << 20, 60):  # one pass, and several
        got = phrases.search(index, benchmark, query_chars=query_chars)
        same(got.drop("items", "near_items").collect(), expected)


def test_proximity(spark):
    text = " ".join(f"t{i}" for i in range(30))
    moved = text.replace("t5 ", "t5 inserted ")
    docs = spark.createDataFrame([(1, text), (2, moved)], "doc_id bigint, text string")
    item = spark.createDataFrame([(7, " ".join(f"t{i}" for i in range(2, 10)))], "item_id bigint, text string")
    got = {r.doc_id: (r.items, r.near_items) for r in phrases.decontaminate(docs, item).collect()}
    assert got == {1: (["7"], ["7"]), 2: ([], ["7"])}


def test_packing(docs):
    vocabulary = default_vocabulary()
    texts = {}
    for i, t, *_ in fixture_rows():
        texts.setdefault(i, set()).add((*encode(vocabulary, t).tolist(), 0))
    used = collections.defaultdict(list)
    for r in packing.pack(docs).collect():
        sums = [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for ids in texts[r.doc_id] if len(ids) == r.doc_tokens]
        assert r.ids_crc32 in sums
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(used) == list(range(len(used)))
    assert sum(n for x in used.values() for _, n in x) == sum(len(encode(vocabulary, t)) + 1 for _, t, *_ in fixture_rows())


@pytest.mark.parametrize("histogram", [{700: 50, 600: 40, 333: 7, 1: 3, 1024: 2, 512: 9}, {k: k % 7 + 1 for k in range(300, 900, 3)}, {5: 1}, {}])
def test_plan_holds_every_piece(histogram):
    held = collections.Counter()
    for pattern, times in packing.plan(histogram):
        assert sum(k * n for k, n in pattern.items()) <= 1024
        held.update({k: n * times for k, n in pattern.items()})
    assert held == collections.Counter(histogram)


def test_token_trees(docs):
    vocabulary = default_vocabulary()
    edited = token_trees.with_masking(token_trees.count(docs), "[0-9]{2,}", "77777 x")
    got = token_trees.recounted(edited).select("doc_id", "n_tokens", "n_tokens_after").collect()
    expected = [(i, len(encode(vocabulary, t)), len(encode(vocabulary, re.sub("[0-9]{2,}", "77777 x", t or "")))) for i, t, *_ in fixture_rows()]
    same(got, expected)


def test_leaves_are_cut_wherever_it_is_safe():
    """Counts of leaves add up to those of the text, whatever the script; texts without blanks between letters have leaves, too."""
    rng = random.Random(3)
    signs = "ab1 ,.'\n\t中文。「é\u0301ſ½²_-s't  \u3000\xa0😀"
    cases = ["".join(rng.choices(signs, k=300)) for _ in range(60)] + ["a, b. " * 300, "中文字，中文。" * 300, "it's we'll they'd' 's ''" * 60, "x" * 3000]
    for text in cases:
        cuts = token_trees.leaf_cuts(text, 7)
        leaves = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
        assert sum(len(encode(default_vocabulary(), x)) for x in leaves) == len(encode(default_vocabulary(), text)), text
    assert len(token_trees.leaf_cuts("a, b. " * 5000)) > 50 and len(token_trees.leaf_cuts("中文字，中文。" * 3000)) > 40


def test_candidates_and_features_against_brute_force(spark):
    texts = ['key: token = "Ab1Cd2Ef3Gh4Ij5K" 42, x', "weg /usr/lib/Ab1Cd2Ef3Gh4Ij5K/x9 hier", "nothing here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = secrets.candidates(docs)
    words = spark.createDataFrame([("usr",), ("lib",)], "part string")
    pairs = secrets.common_pairs(found)
    beside = " ".join(f"{r.before} {r.after}" for r in found.collect()).lower()
    counted = collections.Counter(x for w in re.findall("[a-z]+", beside) for x in (w[k : k + 2] for k in range(len(w) - 1)))
    assert pairs == pytest.approx({k: math.log10(v / sum(counted.values())) for k, v in counted.items()})
    got = {r.doc_id: r for r in secrets.describe(found, words, pairs).collect()}
    assert sorted(got) == [0, 1]
    for r in got.values():
        value = r.found
        kinds = re.sub("[0-9]+", "0", re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", value)))
        letters = [value.lower()[k : k + 2] for k in range(len(value) - 1) if re.fullmatch("[a-z]{2}", value.lower()[k : k + 2])]
        expected = {
            "n_chars": len(value), "n_runs": len(kinds), "digit_share": sum(c.isdigit() for c in value) / len(value),
            "to_digit": len(re.findall("[A-Za-z](?=[0-9])", value)) / len(value), "to_upper": len(re.findall("[a-z](?=[A-Z])", value)) / len(value),
            "pair_commonness": sum(pairs.get(x, secrets.RARE_PAIR) for x in letters) / max(1, len(letters)),
            "before_chars": len(r.before), "after_chars": len(r.after), "rest_chars": len(r.word) - len(value),
            "covered_share": sum(len(x) for x in re.findall("[a-z]{3,}", value.lower()) if x in ("usr", "lib")) / len(value),
        }
        assert {k: r[k] for k in expected} == pytest.approx(expected)
    assert (got[0].announced, got[1].announced) == (1.0, 0.0)


def test_dictionary_counts_documents(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Haus haus", "haus Baum", "baum", None, "Haus"])], "doc_id bigint, text string")
    parts = spark.createDataFrame([("haus",), ("haus",), ("nie",)], "part string")
    assert [r.part for r in secrets.dictionary(docs, parts, 3).collect()] == ["haus"]
    assert secrets.dictionary(docs, parts, 4).isEmpty()


def test_ids_are_those_of_the_tokenizer_file():
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(default_vocabulary())
    tokenizer.encode_special_tokens = True
    for text in [t for _, t, *_ in fixture_rows() if t] + ["it's  2 spaces\n\n x<|endoftext|>", "日本語 ñandú", "\x1c a b"]:
        assert encode(default_vocabulary(), text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_kneser_ney(docs):
    rows = [(i, [*words((t or "").translate(LOWER)), "</s>"]) for i, t, *_ in fixture_rows()]
    counts = collections.Counter(w for _, x in rows for w in x)
    pairs = collections.Counter(p for _, x in rows for p in zip(["<s>", *x], x))
    discounts = kneser_ney._discounts([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    before = collections.Counter(w for _, w in pairs)
    low = kneser_ney._discounts([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)])
    n, free = collections.Counter(), collections.Counter()
    for (h, _), c in pairs.items():
        n[h] += c
        free[h] += discounts[min(c, 3) - 1]
    low_free = sum(low[min(c, 3) - 1] for c in before.values())
    single = lambda w: (before[w] - low[min(before[w], 3) - 1] + low_free / (len(counts) + 1)) / len(pairs)
    total = sum(counts.values())
    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in kneser_ney.score(docs, kneser_ney.fit(docs)).collect()}
    for i, x in rows:
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in x)
        chance = [(max(pairs[p] - discounts[min(pairs[p], 3) - 1], 0) + free[p[0]] * single(p[1])) / n[p[0]] for p in zip(["<s>", *x], x)]
        near = [g for g in got if g[:2] == (i, len(x)) and math.isclose(g[2], base, rel_tol=1e-6) and math.isclose(g[3], sum(map(math.log10, chance)), rel_tol=1e-6)]
        assert near, (i, len(x))


def test_toxicity_learns_insults(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        text = sentence(rng, 60).split()
        if toxic := i % 4 == 0:
            text[rng.randrange(60)] = rng.choice(["idiot", "moron"])
        rows.append((i, " ".join(text), toxic))
    labelled = spark.createDataFrame([(i, t, int(x)) for i, t, x in rows] + [(None, "idiot", 0), (7, "x", None)], "doc_id bigint, text string, label int")
    scored = {r.doc_id: r.score for r in toxicity.score(labelled.where("doc_id > 400"), toxicity.fit(labelled.where("doc_id < 400"))).collect()}
    right = sum((scored[i] >= 0.5) == x for i, _, x in rows if i > 400)
    assert right >= 0.95 * len(scored)


def test_toxicity_of_terms_that_are_neutral_apart(spark):
    """The label depends only on whether both or neither of two words are there, so neither tells anything alone."""
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        text, insult, group = sentence(rng, 12).split(), rng.random() < 0.5, rng.random() < 0.5
        text += ["insultx"] * insult + ["groupy"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(insult == group)))
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    scored = {r.doc_id: r.score for r in toxicity.score(labelled.where("doc_id >= 2400"), toxicity.fit(labelled.where("doc_id < 2400"))).collect()}
    assert sum((scored[i] >= 0.5) == x for i, _, x in rows if i >= 2400) >= 0.9 * len(scored)


def test_few_labels_of_a_kind_are_learned_from(spark):
    """A thousandth of the rows is toxic: the sample keeps them."""
    rng = random.Random(9)
    rows = [(i, f"{sentence(rng, 10)} {'idiot' if i % 300 == 0 else 'freund'}", int(i % 300 == 0)) for i in range(9000)]
    rows += [(None, "idiot", 1), (5, None, 0), (5, None, 0)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string, label int"), train_rows=400)
    got = toxicity.score(spark.createDataFrame([(1, "du idiot"), (2, "du freund"), (3, None), (3, None)], "doc_id bigint, text string"), model).collect()
    score = {r.doc_id: r.score for r in got}
    assert score[1] > 0.5 > score[2] and len(got) == 4


def test_language(spark):
    rng = random.Random(3)
    parts = {"en": "the ing tion er ed".split(), "de": "sch ein ung keit der".split(), "fr": "eau oi ez le ment".split(), "es": "ción ado os la ll".split()}
    rows = [(i, " ".join("".join(rng.choices(parts[x], k=rng.randrange(1, 4))) for _ in range(25)), x) for i, x in enumerate(list(parts) * 60)]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 3!", "en"), (902, "x", None), (None, "der", "de")], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language.predict(docs, language.fit(docs.where("doc_id < 160 or doc_id >= 900"))).collect()}
    assert sum(got[i].lang_pred == x for i, _, x in rows if i >= 160) >= 78
    assert got[900].lang_pred == got[901].lang_pred == "und"


def test_secrets(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(30)]
    rows = [(i, f'und token = "{x}" oder') for i, x in enumerate(hexes)] + [(100 + i, f"Karte {rng.randrange(10**15, 10**16)} da") for i in range(30)]
    rows += [(200, None), (201, ""), (0, f'und token = "{hexes[0]}" oder')]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, found int")
    found = secrets.scan(docs).collect()
    assert {r.found for r in found if r.is_secret} == set(hexes) and len(found) == 61
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert not clean.where(F.col("text").rlike("[0-9a-f]{40}")).count()


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    frames = [
        repetition.measure(empty), window_dedup.remove_repeated_windows(empty), parity_join.similar_documents(empty), phrases.decontaminate(empty, benchmark),
        packing.pack(empty), token_trees.recounted(token_trees.with_masking(token_trees.count(empty))), kneser_ney.score(empty, kneser_ney.fit(empty)),
        toxicity.score(empty, toxicity.fit(toxicity.labelled_documents(empty, labels))), language.predict(empty, language.fit(empty)), secrets.scan(empty), secrets.redact(empty),
    ]
    for frame in frames:
        assert frame.isEmpty()


def test_rows_are_masked_by_their_own_secrets(spark, monkeypatch):
    monkeypatch.setattr(secrets, "scan", lambda rows: secrets.candidates(rows).withColumn("is_secret", F.col("before").contains("token")))
    rows = [(i, text) for i in (None, 1) for text in (f'token = "{"0af" * 8}"', f'Karte "{"0af" * 8}"')]
    clean = secrets.redact(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.text for r in clean) == sorted([f'Karte "{"0af" * 8}"', 'token = "[secret]"'] * 2)


def test_announced_values_are_candidates_whatever_their_form(spark):
    rows = ["x password: hunter2", 'db_password = "a b!c$d"', "API_KEY=Tr0ub4dor&3, dann", '{"token":"k!","secret":"z"}', "Authorization: Bearer ab.cd", "xoxb-abcdefghij", "Author: Anna", "secret ="]
    got = secrets.candidates(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()
    expected = [(0, 2, "hunter2"), (1, 2, "a b!c$d"), (2, 0, "Tr0ub4dor&3"), (3, 0, "k!"), (3, 0, "z"), (4, 2, "ab.cd"), (5, 0, "xoxb-abcdefghij")]
    assert sorted((r.doc_id, r.at, r.found) for r in got) == expected


def test_announced_values_are_masked_where_announced(spark):
    texts = ["zu hunt: password: hunt, hunt", 'db_password = "a b!c$d\\\\E" a', "API_KEY=Tr0ub4dor&3, dann"]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    clean = sorted(r.text for r in secrets.redact(docs).collect())
    assert clean == ["API_KEY=[secret], dann", 'db_password = "[secret]" a', "zu hunt: password: [secret], hunt"]


def test_copies_do_not_shrink_the_training_sample(spark):
    rng = random.Random(6)
    values = [("".join(rng.choices("0123456789abcdef", k=40)), 1.0) for _ in range(20)] + [(str(rng.randrange(10**15, 10**16)), 0.0) for _ in range(20)]
    findings = spark.createDataFrame([(x, "", "", x, label) for x, label in values for _ in range(200)], "found string, before string, after string, word string, label double")
    docs = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(values)], "doc_id bigint, text string")
    assert [r.is_secret for r in secrets.scan(docs, findings, train_rows=100).orderBy("doc_id").collect()] == [label == 1 for _, label in values]


def test_an_announced_false_finding_is_not_a_secret(spark):
    rng = random.Random(7)
    rows = [f'token = "{"".join(rng.choices("0123456789abcdef", k=40))}"' for _ in range(30)] + [f"Karte {rng.randrange(10**15, 10**16)} da" for _ in range(30)]
    rows.append('token = "1234567890123456"')
    found = secrets.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in found if r.is_secret} == set(range(30))
