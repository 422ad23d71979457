import math
import random
import re
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import terms
from corvane.operators.ranking import top_k
from corvane.plans.search import best_documents, search_job
from corvane.sources.tabbed import CORPUS_FIELDS, read_corpus, short_rows

CORPUS = [
    "1\tAlpha\t2015\t<p>Cloud cloud, sky!</p>",
    "2\tBeta\t2015\tCloud 9\\nrain",
    "3\tGamma, Inc\t2015\tSky-blue",
    "4\tBeta\t2015\tcloud",
    "5\tshort row",
]


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "dump.tsv"
    path.write_text("\n".join(CORPUS) + "\n")
    return str(path)


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("<p>Cloud cloud, sky!</p>", ["cloud", "cloud", "sky"]),
        ("Cloud 9\\nrain", ["cloud", "rain"]),
        ("a<b attr='x > y'>c", ["a", "y", "c"]),
        ("a<b\n>c", ["a", "b", "c"]),
        ("a <never closed", ["a", "never", "closed"]),
        ("in<b>side</b>word", ["in", "side", "word"]),
        ("Ünïcode ДОМ 日本", ["ünïcode", "дом", "日本"]),
        ("<>x", ["x"]),
        ("a\\Nb", ["a", "b"]),
        ("12 34 --", [""]),
        ("", [""]),
        ("tab\tand\nnewline\r\n", ["tab", "and", "newline"]),
    ],
)
def test_cleaning(spark, raw, expected):
    frame = spark.createDataFrame([(raw,)], "text string")
    assert frame.select(T.words(F.col("text"))).first()[0] == expected


def test_occurrences_agree_with_words(spark):
    texts = ["The the other theme", "<the>the", "the\\nthe", "", "THE-the'the", "thé the", "a\\nthe"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for term in ("the", "The", "th", "", "the the", "n", ".*"):
        counted = frame.select(
            T.occurrences(F.col("text"), term).alias("fast"),
            F.size(F.filter(T.words(F.col("text")), lambda w: (w == term) & (w != ""))).alias("plain"),
        )
        assert all(fast == plain for fast, plain in counted.collect()), term


def test_scores_of_the_worked_corpus(spark, dump):
    scored = terms.tfidf(read_corpus(spark, dump))
    found = {(r.word, r.title): (r.tf, r.df, round(r.tfidf, 6)) for r in scored.collect()}
    assert found == {
        ("cloud", "Alpha"): (2, 2, 0.810930),
        ("cloud", "Beta"): (2, 2, 0.810930),
        ("sky", "Alpha"): (1, 2, 0.405465),
        ("sky", "Gamma, Inc"): (1, 2, 0.405465),
        ("blue", "Gamma, Inc"): (1, 1, 1.098612),
        ("rain", "Beta"): (1, 1, 1.098612),
    }


def test_short_lines_are_counted_or_stop_the_job(spark, dump):
    assert short_rows(spark, dump, CORPUS_FIELDS).first().rejected == 1
    with pytest.raises(Exception, match="fewer than 4 fields"):
        read_corpus(spark, dump, strict=True).collect()


def test_a_document_without_words_still_counts(spark):
    corpus = spark.createDataFrame([("a", "x"), ("b", "123"), ("c", "")], "title string, text string")
    assert terms.corpus_size(corpus).first().n == 3
    only = ("a", pytest.approx(math.log(3)))
    assert rows(terms.tfidf(corpus), "title", "tfidf") == [only]
    assert rows(terms.tfidf_of_term(corpus, "x")) == [only]
    assert rows(terms.tfidf_of_term(corpus, "123")) == []


def test_no_documents(spark):
    corpus = spark.createDataFrame([], "title string, text string")
    assert rows(terms.tfidf(corpus)) == []
    assert rows(best_documents(corpus, "x")) == []


def test_best_documents_break_ties_by_whole_title(spark, dump):
    corpus = read_corpus(spark, dump)
    assert [r.title for r in best_documents(corpus, "cloud").collect()] == ["Alpha", "Beta"]
    assert [r.title for r in best_documents(corpus, "blue").collect()] == ["Gamma, Inc"]
    assert [r.title for r in best_documents(corpus, "cloud", k=1).collect()] == ["Alpha"]
    assert best_documents(corpus, "Cloud").collect() == []


def test_top_k_is_the_start_of_the_whole_order(spark):
    data = [(i, (i * 37) % 11 / 10, f"t{(i * 13) % 50:02d}") for i in range(50)]
    frame = spark.createDataFrame(data, "id int, score double, title string")
    expected = sorted(data, key=lambda r: (-r[1], r[2]))
    for k in (1, 7, 50, 100):
        assert [tuple(r) for r in top_k(frame, "score", "title", k=k).collect()] == expected[:k]


def test_search_job_writes_all_scores_and_one_ranked_file(spark, dump, tmp_path):
    every, best = tmp_path / "all", tmp_path / "best"
    for _ in range(2):  # a second run replaces the first
        search_job(spark, dump, "sky", str(every), str(best))
    parts = list(best.glob("part-*"))
    assert len(parts) == 1
    lines = [line.split("\t") for line in parts[0].read_text().splitlines()]
    assert [title for title, _ in lines] == ["Alpha", "Gamma, Inc"]
    assert all(math.isclose(float(score), math.log(1.5)) for _, score in lines)
    written = [line.split("\t")[:2] for p in every.glob("part-*") for line in p.read_text().splitlines()]
    assert sorted(written) == [["sky", "Alpha"], ["sky", "Gamma, Inc"]]


def brute_force(corpus):
    words = {}
    for title, text in corpus:
        cleaned = re.sub("<[^>\n]*>", " ", text).lower().replace("\\n", " ")
        words.setdefault(title, Counter()).update(re.findall("[a-z]+", cleaned))
    df = Counter(word for counts in words.values() for word in counts)
    return sorted(
        (word, title, tf, df[word], round(tf * math.log(len(words) / df[word]), 9))
        for title, counts in words.items()
        for word, tf in counts.items()
    )


@pytest.mark.parametrize("hot", [{}, {"max_hot": 5, "min_hot_rows": 3}, {"max_hot": 1000, "min_hot_rows": 0}])
def test_scores_against_brute_force(spark, hot):
    random.seed(3)
    vocabulary = ["the"] * 30 + ["a"] * 10 + [f"w{chr(97 + i)}" for i in range(20)] + ["<b>", "\\n", "7", ".", "X<i>y"]
    corpus = [
        (f"t{random.randrange(60)}", " ".join(random.choices(vocabulary, k=random.randrange(12))))
        for _ in range(100)
    ]
    frame = spark.createDataFrame(corpus, "title string, text string")
    scored = terms.tfidf(frame, **hot).select("word", "title", "tf", "df", F.round("tfidf", 9))
    expected = brute_force(corpus)
    assert sorted(tuple(r) for r in scored.collect()) == expected
    assert rows(terms.term_frequency(frame), "word", "title", "tf") == [r[:3] for r in expected]
    assert rows(terms.document_frequency(frame)) == sorted({(r[0], r[3]) for r in expected})
    the = terms.tfidf_of_term(frame, "the").select("title", F.round("tfidf", 9))
    assert rows(the) == sorted((r[1], r[4]) for r in expected if r[0] == "the")


@pytest.mark.parametrize("kind", ["parquet", "text"])
def test_the_corpus_is_read_and_shuffled_once(spark, tmp_path, kind):
    path = str(tmp_path / "corpus")
    made = spark.range(50).selectExpr("concat('t', id) as title", "concat('the w', id % 7) as text")
    if kind == "parquet":
        made.write.parquet(path)
        corpus = spark.read.parquet(path)
    else:
        made.selectExpr("concat_ws('\t', 'id', title, 'year', text) as value").write.text(path)
        corpus = read_corpus(spark, path)
    scored = terms.tfidf(corpus, max_hot=10, min_hot_rows=5)
    execution = scored._jdf.queryExecution()
    assert execution.toRdd().count() == 100
    final = execution.executedPlan().toString()
    executed = re.sub(r"== Initial Plan ==.*?(?=== Final Plan ==|\Z)", "", final, flags=re.S)
    assert executed.count("FileScan") == 1


def test_words_move_by_document(spark):
    """Words are counted where the text is read and move as lists; documents of several rows, in several tasks, are added up."""
    rng = random.Random(4)
    texts = [(f"t{rng.randrange(60)}", " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(30)))) for _ in range(150)]
    texts += [("empty", ""), ("empty", "12 -"), ("once", "a a <b> É é")]
    corpus = spark.createDataFrame(texts, "title string, text string").repartition(7)
    counts, held = {}, Counter()
    for title, text in texts:
        counts.setdefault(title, Counter()).update(re.sub(r"<b>|[^a-zé]", " ", text.lower()).split())
    for found in counts.values():
        held.update(found.keys())
    expected = [(w, t, n, held[w], math.log(len(counts) / held[w])) for t, found in counts.items() for w, n in found.items()]
    scored = terms.tfidf(corpus)
    assert [x[:4] for x in rows(scored, "word", "title", "tf", "df", "idf")] == [x[:4] for x in sorted(expected, key=repr)]
    assert {(w, round(i, 9)) for w, i in rows(scored, "word", "idf")} == {(w, round(i, 9)) for w, _, _, _, i in expected}
    assert "Exchange hashpartitioning(title" in scored._jdf.queryExecution().executedPlan().toString()


def test_words_are_scored_as_lists_of_titles(spark):
    """A word's documents meet their document count as lists and are taken apart after it; lists of one word go to several tasks."""
    corpus = spark.range(300).selectExpr("concat('t', id) as title", "concat('the w', chr(97 + id % 7)) as text")
    scored = terms.tfidf(corpus, max_hot=10, min_hot_rows=5)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Generate" not in plan[plan.index("Join") :]
    assert "Exchange hashpartitioning(word#" in plan and re.search(r"hashpartitioning\(word#\d+, titles#\d+", plan)
    execution = scored._jdf.queryExecution()
    assert execution.toRdd().count() == 600
    final = re.sub(r"== Initial Plan ==.*?(?=== Final Plan ==|\Z)", "", execution.executedPlan().toString(), flags=re.S)
    assert final.count("MapInArrow") == 1


def test_documents_that_go_on_in_the_next_batch_and_odd_titles(spark, changed):
    rng = random.Random(5)
    names = ["a\nb", "a%0Ab", "a%250Ab", "%", "%25", "50%", "", "\n", "a", "b", "tab\t"]
    texts = [(rng.choice(names), " ".join(rng.choices(["x", "y", "Z", "7", "<i>"], k=rng.randrange(6)))) for _ in range(120)] + [("a", "x " * 500)] * 9
    corpus = spark.createDataFrame(texts, "title string, text string").repartition(5)
    counts = {}
    for title, text in texts:
        counts.setdefault(title, Counter()).update(re.findall("[a-z]", text.replace("<i>", " ").lower()))
    held = Counter(w for found in counts.values() for w in found)
    expected = sorted(((w, t, n, held[w]) for t, found in counts.items() for w, n in found.items()), key=repr)
    for size in ("1", "2", "7", "10000"):
        changed("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert rows(terms.tfidf(corpus), "word", "title", "tf", "df") == expected, size
