import datetime as dt

import pytest
from conftest import rows

from corvane.operators.throughput import reached
from corvane.sources.logs import RPS_RECORD, read_rps_stream
from corvane.streaming.throughput import windowed_totals, write_final_windows


def at(hour, minute, second=0):
    return dt.datetime(2024, 1, 1, hour, minute, second)


@pytest.fixture
def feed(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()

    def write(data):
        frame = spark.createDataFrame(data, RPS_RECORD).coalesce(1)
        frame.write.mode("append").parquet(str(source))

    def run():
        totals = windowed_totals(read_rps_stream(spark, str(source)))
        out = str(tmp_path / "out")
        write_final_windows(totals, out, str(tmp_path / "state"), once=True).awaitTermination()
        return spark.read.schema(totals.schema).parquet(out)

    return write, run


def test_windows_are_written_when_final_and_late_rows_are_dropped(feed):
    write, run = feed
    write(
        [
            ("1", at(10, 0, 5), "a", 100.0),
            ("1", at(10, 0, 55), "b", 50.0),
            ("1", at(10, 1, 0), "a", 7.0),
            ("2", at(10, 0, 30), "a", 9.0),
            ("1", at(10, 12, 0), "a", 1.0),
        ]
    )
    closed = [("1", at(10, 0), 150.0), ("1", at(10, 1), 7.0), ("2", at(10, 0), 9.0)]
    assert rows(run()) == sorted(closed, key=repr)

    # The restarted query knows its watermark: one row is too late, one is not.
    write([("1", at(10, 0, 30), "a", 1000.0), ("1", at(10, 12, 30), "b", 2.0), ("1", at(10, 40), "a", 5.0)])
    windows = run()
    assert rows(windows) == sorted([*closed, ("1", at(10, 12), 3.0)], key=repr)
    assert rows(reached(windows, 100)) == [("1", at(10, 0), 150.0)]
