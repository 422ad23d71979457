"""The written index, counts that are kept up to date, ranks within groups, and published results."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corvane.operators import terms
from corvane.operators.ranking import top_k_per_group
from corvane.plans import index
from corvane.sinks import publish, versions
from corvane.sources.published import read_published

TEXTS = [(f"t{i:03}", " ".join(f"w{chr(97 + k % 26)}{chr(97 + i % 7)}" for k in range(i % 40)) + " cloud" * (i % 3)) for i in range(120)]


def corpus_of(spark, texts):
    return spark.createDataFrame(texts, "title string, text string")


def leaf_metric(frame, name):
    """A number of the executed scan, as its plan tells it."""
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get(name).get().value()


def test_a_word_is_read_from_its_own_files(spark, tmp_path):
    corpus, folder = corpus_of(spark, TEXTS), str(tmp_path / "index")
    written = index.write_index(corpus, folder, buckets=16)
    assert written == terms.tfidf(corpus).count()
    for term in ("cloud", "waa", "wzg", "nowhere", "wa"):
        found = index.find(spark, folder, term)
        assert rows(found) == rows(terms.tfidf_of_term(corpus, term))
    found = index.find(spark, folder, "cloud")
    assert leaf_metric(found, "numOutputRows") < written / 4  # a bucket at most
    files = len(read_published(spark, folder).inputFiles())
    assert leaf_metric(found, "numFiles") < files / 4


def test_scores_are_computed_once(spark, tmp_path):
    """No row of the scores is made for a sample before those that are written."""
    made = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    scored = terms.tfidf

    def counted(corpus):
        found = scored(corpus)
        return found.mapInArrow(tell, found.schema)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(terms, "tfidf", counted)
        written = index.write_index(corpus_of(spark, TEXTS), str(tmp_path / "index"), buckets=16)
    assert made.value == written > 0


def test_a_large_bucket_has_several_files(spark, changed, tmp_path):
    changed("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    changed("spark.sql.adaptive.coalescePartitions.enabled", "false")
    index.write_index(corpus_of(spark, TEXTS), str(tmp_path / "index"), buckets=1)
    stored = read_published(spark, str(tmp_path / "index"))
    assert len(stored.inputFiles()) > 1
    of_file = stored.withColumn("file", F.input_file_name()).select("file", "word", "title").collect()
    for file in {r.file for r in of_file}:
        held = [(r.word, r.title) for r in of_file if r.file == file]
        assert held == sorted(held)


@pytest.mark.parametrize("k", [1, 3, 500])
def test_best_rows_of_each_group(spark, k):
    scored = terms.tfidf(corpus_of(spark, TEXTS))
    expected = {}
    for r in scored.collect():
        expected.setdefault(r.word, []).append((-r.tf, r.title))
    expected = sorted((w, t, p + 1) for w, x in expected.items() for p, (_, t) in enumerate(sorted(x)[:k]))
    best = top_k_per_group(scored, "word", "tf", "title", k=k)
    assert sorted(tuple(r) for r in best.select("word", "title", "rank").collect()) == expected
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan  # in the tasks before the shuffle, and after it


def test_counts_are_kept_up_to_date(spark, tmp_path):
    """Three additions, with titles that go on (t001, t002) and one that comes again as it was (t005)."""
    folder = str(tmp_path / "counts")
    later = [("t001", "cloud rain new"), ("t002", ""), ("t005", TEXTS[5][1]), ("n1", "cloud new"), ("n1", "new other")]
    last = [("t001", "rain rain cloud"), ("n1", "cloud"), ("n2", "cloud")]
    batches = [TEXTS, later, last]
    for count, batch in zip((120, 1, 1), batches, strict=True):
        assert index.add_documents(corpus_of(spark, batch), folder, buckets=8) == count
    whole = terms.tfidf(corpus_of(spark, [x for b in batches for x in b]))
    columns = ["word", "title", "tf", "df", F.round("tfidf", 9)]
    assert rows(index.kept_tfidf(spark, folder), *columns) == rows(whole, *columns)
    tf, df, n = index.kept_counts(spark, folder)
    assert n == 122 and {r.word: r.df for r in df.collect()}["rain"] == 1


def test_a_batch_that_breaks_off_is_not_seen(spark, tmp_path):
    folder = str(tmp_path / "counts")
    index.add_documents(corpus_of(spark, TEXTS[:50]), folder)
    broken = corpus_of(spark, TEXTS[50:]).withColumn("title", F.when(F.col("title") == "t100", F.raise_error(F.lit("broken off"))).otherwise(F.col("title")))
    with pytest.raises(Exception, match="broken off"):
        index.add_documents(broken, folder)
    assert rows(index.kept_tfidf(spark, folder), "word", "title", "tf") == rows(terms.tfidf(corpus_of(spark, TEXTS[:50])), "word", "title", "tf")
    index.add_documents(corpus_of(spark, TEXTS[50:]), folder)
    assert rows(index.kept_tfidf(spark, folder), "word", "title", "df") == rows(terms.tfidf(corpus_of(spark, TEXTS)), "word", "title", "df")


def test_no_old_document_is_read_for_new_ones(spark, tmp_path):
    """Counts are read of the buckets alone that hold titles that come again."""
    folder = str(tmp_path / "counts")
    index.add_documents(corpus_of(spark, TEXTS), folder, buckets=32)
    old = index._batches(spark, folder, "tf")
    bucket = corpus_of(spark, [TEXTS[7]]).select(index._bucket("title", F.lit(32)).alias("b")).first().b
    assert leaf_metric(old.where(F.col("bucket").isin([bucket])), "numOutputRows") < old.count() / 4


def test_a_broken_write_leaves_the_old_result(spark, tmp_path):
    folder = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        read_published(spark, folder)
    assert publish(spark.range(10), folder) == 10
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken off"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken off"):
        publish(broken, folder)
    assert rows(read_published(spark, folder)) == sorted([(i,) for i in range(10)], key=repr)
    assert publish(spark.range(3), folder) == 3
    assert rows(read_published(spark, folder)) == [(0,), (1,), (2,)] and read_published(spark, folder, version=1).count() == 10
    assert publish(spark.range(0), folder) == 0 and read_published(spark, folder).count() == 0


def test_a_reader_checks_the_rows(spark, tmp_path):
    folder = str(tmp_path / "result")
    publish(spark.range(10).repartition(3), folder)
    (entry,) = versions(spark, folder)
    next((tmp_path / "result" / entry.name).glob("part-*.parquet")).unlink()
    with pytest.raises(ValueError, match="rows where 10 were written"):
        read_published(spark, folder)
