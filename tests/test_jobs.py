from conftest import rows

import jobs
from test_streaming import at
from test_text import CORPUS
from test_throughput import LOGS
from corvane.sources.logs import RPS_RECORD


def run(spark, *arguments):
    jobs.run(spark, jobs.parser().parse_args([str(a) for a in arguments]))


def lines(folder):
    return sorted(line for part in folder.glob("part-*") for line in part.read_text().splitlines())


def test_search_and_throughput(spark, tmp_path):
    (tmp_path / "dump").write_text("\n".join(CORPUS))
    run(spark, "search", tmp_path / "dump", "--all", tmp_path / "all", "--out", tmp_path / "best", "--top", 1)
    assert [line.split("\t")[0] for line in lines(tmp_path / "best")] == ["Alpha"]
    assert [line.split("\t")[1] for line in lines(tmp_path / "all")] == ["Alpha", "Beta"]

    (tmp_path / "logs").mkdir()
    for name, text in LOGS.items():
        (tmp_path / "logs" / name).write_text(text)
    run(spark, "throughput", tmp_path / "logs", "--out", tmp_path / "report", "--target", 510.25)
    assert lines(tmp_path / "report") == ["1425\t1700.75\t1", "5\t0.0\t", "77\t4000.5\t1"]


def test_pagerank(spark, tmp_path):
    (tmp_path / "arcs").write_text("a\tb\nb\ta\n")
    (tmp_path / "nodes").write_text("a\tA\nb\tB\n")
    run(spark, "pagerank", tmp_path / "arcs", tmp_path / "nodes", "--iterations", 2, "--out", tmp_path / "best",
        "--all", tmp_path / "all")
    assert lines(tmp_path / "best") == ["A\t1.0", "B\t1.0"]
    assert lines(tmp_path / "all") == ["a\t1.0", "b\t1.0"]


def test_watch(spark, tmp_path):
    data = [
        ("1", at(9, 0, 1), "a", 5.0),
        ("1", at(9, 0, 2), "b", 6.0),
        ("2", at(9, 0), "a", 1.0),
        ("1", at(9, 30), "a", 9.0),
    ]
    spark.createDataFrame(data, RPS_RECORD).coalesce(1).write.parquet(str(tmp_path / "in"))
    folders = ["--state", tmp_path / "state", "--out", tmp_path / "out"]
    run(spark, "watch", tmp_path / "in", *folders, "--once", "--target", 11)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("1", at(9, 0), 11.0)]
