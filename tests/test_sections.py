"""The continuing query over sections: what a test's last section has come to, and the first one at a target."""

import datetime as dt
import random

import pytest
from conftest import rows

from corvane.sources.logs import RPS_RECORD, read_rps_stream
from corvane.streaming import sections as S


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=minute, seconds=second)


@pytest.fixture
def feed(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    session = S.keyed_session(spark)

    def write(data):
        spark.createDataFrame(data, RPS_RECORD).coalesce(1).write.mode("append").parquet(str(source))

    def run(target=100.0):
        reports = S.watched_sections(read_rps_stream(session, str(source)), target)
        out = str(tmp_path / "out")
        S.write_sections(reports, out, str(tmp_path / "state"), once=True).awaitTermination()
        return spark.read.schema(reports.schema).parquet(out)

    return write, run


def test_the_section_being_filled_and_the_first_at_the_target(feed):
    write, run = feed
    write([("1", at(0), "a", 60.0), ("1", at(0, 59), "b", 50.0), ("1", at(1), "a", 7.0), ("2", at(0), "a", 9.0), ("3", at(0), "a", None)])
    reports = run()
    assert rows(S.latest_sections(reports)) == [("1", at(1), 7.0), ("2", at(0), 9.0), ("3", at(0), 0.0)]
    assert rows(S.first_sections(reports)) == []  # no section is closed yet

    # The restarted query goes on with its state: the open section grows, older ones may still.
    write([("1", at(1, 30), "b", 3.0), ("2", at(0, 10), "a", 0.5), (None, at(1), "a", 1.0), ("1", None, "a", 1.0)])
    reports = run()
    assert rows(S.latest_sections(reports)) == [("1", at(1), 10.0), ("2", at(0), 9.5), ("3", at(0), 0.0)]
    assert rows(S.first_sections(reports)) == []

    write([("4", at(30), "a", 1.0)])  # closes what is ten minutes older
    reports = run()
    assert rows(S.first_sections(reports)) == [("1", at(0), 110.0)]

    # Too late for a closed section; and a target is reported once.
    write([("2", at(0, 20), "a", 1000.0), ("1", at(31), "a", 500.0), ("2", at(31), "a", 100.0), ("5", at(60), "a", 1.0)])
    reports = run()
    assert rows(S.first_sections(reports)) == [("1", at(0), 110.0), ("2", at(31), 100.0)]
    latest = rows(S.latest_sections(reports))
    assert latest == [("1", at(31), 500.0), ("2", at(31), 100.0), ("3", at(0), 0.0), ("4", at(30), 1.0), ("5", at(60), 1.0)]
    assert reports.where("kind = 'latest' and test_id = '2'").count() == 3


def test_sections_equal_sums_over_all_records(feed):
    """A test that holds most records, unordered within the lateness, over three starts of the query."""
    write, run = feed
    rng = random.Random(1)
    expected: dict = {}
    for part in range(3):
        data = []
        for _ in range(400):
            test = "hot" if rng.random() < 0.6 else f"t{rng.randrange(5)}"
            minute, second, rps = part * 9 + rng.randrange(9), rng.randrange(60), float(rng.randrange(20))
            data.append((test, at(minute, second), "n", rps))
            expected.setdefault(test, {}).setdefault(minute, 0.0)
            expected[test][minute] += rps
        write(data)
        reports = run(target=60.0)
    write([("end", at(60), "n", 0.0)])
    reports = run(target=60.0)
    expected["end"] = {60: 0.0}
    assert rows(S.latest_sections(reports)) == sorted([(t, at(max(s)), s[max(s)]) for t, s in expected.items()], key=repr)
    first = {t: min((m for m, total in s.items() if total >= 60), default=None) for t, s in expected.items()}
    assert rows(S.first_sections(reports)) == sorted([(t, at(m), expected[t][m]) for t, m in first.items() if m is not None], key=repr)


def test_the_users_session_keeps_its_state_store(spark, tmp_path):
    before = spark.conf.get(S.STATE_STORE)
    own = S.keyed_session(spark)
    assert spark.conf.get(S.STATE_STORE) == before != own.conf.get(S.STATE_STORE)
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="keyed_session"):
        S.watched_sections(read_rps_stream(spark, str(tmp_path / "in")))
