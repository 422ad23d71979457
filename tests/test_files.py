"""Lines of text files that are rejected, and logs written as files and read back."""

import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_jobs import lines as written_lines
from test_jobs import run
from test_text import CORPUS

import jobs
from corvane.operators import graph
from corvane.operators import throughput as T
from corvane.plans.search import search_job
from corvane.sinks import write_logs
from corvane.sources import tables
from corvane.sources.logs import read_log_lines, read_log_names
from corvane.sources.rejects import LineCount
from corvane.sources.tabbed import read_arcs, read_corpus, read_nodes


@pytest.fixture
def file_of(tmp_path):
    def write(*lines):
        path = tmp_path / "lines"
        path.write_text("".join(f"{x}\n" for x in lines))
        return str(path)

    return write


def run_counted(spark, *arguments):
    return [str(c) for c in jobs.run(spark, jobs.parser().parse_args([str(a) for a in arguments]))]


def test_fields_that_make_a_line(spark, file_of):
    dump = ["1\tA\t\ttext", "2\tB\t2015\t", "3\tC\t2015\t\t", "4\tD\t2015\t\tmore", "5\t\t2015\ttext", "", "6", "\tE\t\tx\t\t"]
    count = LineCount("corpus")
    assert rows(read_corpus(spark, file_of(*dump), count=count)) == [("A", "text"), ("D", ""), ("E", "x")]
    assert (count.lines, count.rejected) == (8, 5)
    count = LineCount("arcs")
    arcs = ["a\tb", "a\t", "a", "\tb", "", "a\t\tc", "b\ta\t\t"]
    assert rows(read_arcs(spark, file_of(*arcs), count=count)) == [("a", "b"), ("b", "a")]
    assert (count.lines, count.rejected) == (7, 5)
    count = LineCount("nodes")
    nodes = ["a\tTitle", "b", "c\t", "", "\tTitle", "d\t\tx"]
    assert rows(read_nodes(spark, file_of(*nodes), count=count)) == [("a", "Title"), ("b", None), ("c", None), ("d", None)]
    assert (count.lines, count.rejected) == (6, 2)


def test_strict_reading_stops_at_a_rejected_line(spark, file_of):
    for read in (read_corpus, read_arcs, read_nodes):
        with pytest.raises(Exception, match="empty title or id: \\tlonely"):
            read(spark, file_of("\tlonely"), strict=True).collect()
        assert read(spark, file_of("a\tb\tc\td"), strict=True).count() == 1


def test_jobs_tell_the_rejected_lines(spark, tmp_path):
    (tmp_path / "dump").write_text("\n".join(CORPUS))
    outs = ["--all", tmp_path / "all", "--out", tmp_path / "best"]
    assert run_counted(spark, "search", tmp_path / "dump", *outs) == ["corpus: 5 lines, 1 rejected"]
    assert run_counted(spark, "index", tmp_path / "dump", "--out", tmp_path / "index") == ["corpus: 5 lines, 1 rejected"]
    assert len(written_lines(tmp_path / "index")) == 6
    assert next(x for x in written_lines(tmp_path / "index") if x.startswith("rain")).split("\t")[:3] == ["rain", "Beta", "1"]
    with pytest.raises(Exception, match="fewer than 4 fields"):
        run(spark, "search", tmp_path / "dump", *outs, "--strict")

    (tmp_path / "arcs").write_text("a\tb\nb\ta\nlonely\na\t\n")
    (tmp_path / "nodes").write_text("a\tA\nb\tB\n\n")
    ranked = run_counted(spark, "pagerank", tmp_path / "arcs", tmp_path / "nodes", "--iterations", 1, "--out", tmp_path / "ranks")
    assert ranked == ["arcs: 4 lines, 2 rejected", "nodes: 3 lines, 1 rejected"]

    for told in ("arcs: 4 lines, 2 rejected", "arcs: not read"):  # a run that goes on has its arcs
        ranked = run_counted(spark, "pagerank", tmp_path / "arcs", tmp_path / "nodes", "--iterations", 1, "--run", tmp_path / "run", "--out", tmp_path / "ranks")
        assert ranked == [told, "nodes: 3 lines, 1 rejected"]

    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "test.3.log").write_text("[Test]\ntype=x\n[Minute 1]\na=1\nnot a value\n")
    reported = run_counted(spark, "throughput", tmp_path / "logs", "--out", tmp_path / "report")
    assert reported == ["logs: 5 lines, 2 rejected"]
    assert written_lines(tmp_path / "report") == ["3\t1.0\t"]


def test_arcs_and_lists_of_a_corpus_as_a_job(spark, tmp_path):
    pages = ['1\tp1\t\t<a href="p2">x</a> <a href="p3">y</a> <a href="p2">z</a>', '2\tp2\t\t<a href="p1">x</a>', "3\tp3\t\tno link", "short"]
    (tmp_path / "dump").write_text("\n".join(pages))
    told = run_counted(spark, "graph", tmp_path / "dump", "--arcs", tmp_path / "arcs", "--out", tmp_path / "lists")
    assert told == ["corpus: 4 lines, 1 rejected"]
    assert written_lines(tmp_path / "arcs") == ["p1\tp2", "p1\tp2", "p1\tp3", "p2\tp1"]
    assert written_lines(tmp_path / "lists") == ["p1\t0\tp2 p2 p3", "p2\t0\tp1"]


def test_rejected_lines_are_counted_by_the_pass_that_works(spark, tmp_path):
    """The job's scans of the dump are as many with the count as without."""
    (tmp_path / "dump").write_text("\n".join(CORPUS))
    tracker = spark.sparkContext.statusTracker()
    jobs_run = []
    for count in (None, LineCount("corpus")):
        spark.sparkContext.setJobGroup(f"counting {count is None}", "")
        search_job(spark, str(tmp_path / "dump"), "cloud", str(tmp_path / "all"), str(tmp_path / "best"), 5, False, count)
        jobs_run.append(len(tracker.getJobIdsForGroup(f"counting {count is None}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_run[0] == jobs_run[1] > 0
    assert (count.lines, count.rejected) == (5, 1)


# ---- logs

ODD = [-5.25, None, 1e-12, 1e300, float("nan"), float("inf"), float("-inf"), -0.0, 0.1 + 0.2, 12345678.9, 5e-324]


@pytest.fixture
def odd_events(spark, tmp_path):
    hour = dt.datetime(2024, 1, 1, 5)
    data = [(i, hour, None if i == 3 else 7 * i, "kind", v) for i, v in enumerate(ODD)]
    data += [(None, hour, 1, "kind", 2.0), (None, hour, None, "kind", None), (-4, hour + dt.timedelta(hours=1), 9, "kind", 3.0)]
    data += [(50 + i, hour, 2, "other", 4.0) for i in range(30)] + [(90, None, 1, "kind", 1.0), (91, hour, 1, None, 1.0)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path), data


def key(row):
    return tuple((x is not None, x) for x in row)


def expected_rows(data, names):
    hour = lambda ts: int((ts - dt.datetime(1970, 1, 1)).total_seconds() // 3600)
    found = [(names[kind], hour(ts), None if user is None else str(user), repr(v)) for _, ts, user, kind, v in data if ts and kind]
    return sorted(found, key=key)


def plain(frame):
    return sorted(((r.test_id, r.minute, r.node, repr(r.rps)) for r in frame.collect()), key=key)


def test_no_event_is_lost_on_the_way_through_lines(spark, odd_events):
    folder, data = odd_events
    lines = tables.event_log_lines(spark, folder)
    assert plain(T.rps_rows(lines)) == expected_rows(data, {"kind": "kind", "other": "other"})


def test_no_event_is_lost_on_the_way_through_files(spark, odd_events, tmp_path, changed):
    folder, data = odd_events
    changed("spark.sql.files.maxPartitionBytes", "64")
    changed("spark.sql.files.openCostInBytes", "0")
    write_logs(tables.numbered_log_lines(spark, folder), str(tmp_path / "logs"))
    lines = read_log_lines(spark, str(tmp_path / "logs"))
    assert lines.select("block").distinct().count() > 5
    assert plain(T.rps_rows(lines)) == expected_rows(data, {"kind": "1", "other": "2"})
    assert rows(read_log_names(spark, str(tmp_path / "logs"))) == [("1",), ("2",)]


def test_lines_of_a_log_stay_in_order_over_its_parts(spark, tmp_path, changed):
    changed("spark.sql.shuffle.partitions", "5")
    changed("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lines = [("8", i // 50, i % 50, f"[Minute {i}]" if i % 3 == 0 else f"n{i}={i}") for i in range(900)] + [("9", 0, 0, "started")]
    frame = spark.createDataFrame(lines, "test_id string, block int, seq int, line string").repartition(4)
    write_logs(frame, str(tmp_path / "logs"))
    parts = sorted((tmp_path / "logs" / "log=test.8.log").glob("part-*"))
    assert len(parts) > 2
    assert [x for p in parts for x in p.read_text().splitlines()] == [x[3] for x in lines if x[0] == "8"]
    got = T.rps_per_minute(read_log_lines(spark, str(tmp_path / "logs")))
    assert rows(got) == sorted([("8", i, float(2 * i + 3)) for i in range(0, 900, 3)], key=repr)


def test_a_node_that_no_line_can_hold_stops_the_writer(spark):
    from corvane.functions.logs import value_line

    for node in ("a=b", "x\ny", "[x", "\\N", ""):
        frame = spark.createDataFrame([(node, 1.0)], "node string, rps double")
        with pytest.raises(Exception, match="not a node of a log"):
            frame.select(value_line(F.col("node"), F.col("rps"))).collect()


def test_a_report_needs_one_pass(spark, odd_events):
    folder, _ = odd_events
    lines = tables.event_log_lines(spark, folder)
    got = {r.test_id: (r.total_rps, r.first_minute) for r in T.rps_report(lines, tables.event_log_names(spark, folder), 100).collect()}
    totals = T.rps_per_minute(lines)
    latest = {r.test_id: r.total_rps for r in T.rps_latest(lines, tables.event_log_names(spark, folder)).collect()}
    first = {r.test_id: r.first_minute for r in T.rps_target(totals, 100).collect()}
    assert got == {t: (latest[t], first.get(t)) for t in latest}
    assert math.isclose(latest["other"], 120.0)


def test_files_give_the_graph_of_the_table(spark, tmp_path):
    arcs = [("a", "b"), ("a", "c"), ("b", "c")]
    (tmp_path / "arcs").write_text("".join(f"{a}\t{b}\n" for a, b in arcs) + "c\t\n")
    (tmp_path / "nodes").write_text("a\nb\nc\nd\n\n")
    got = graph.degrees(graph.link_counts(read_arcs(spark, str(tmp_path / "arcs"))), read_nodes(spark, str(tmp_path / "nodes")))
    assert rows(got) == [("a", 2, 0), ("b", 1, 1), ("c", 0, 2), ("d", 0, 0)]
