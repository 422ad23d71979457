import pytest
from conftest import rows

from corvane.operators import throughput as T
from corvane.plans.throughput import throughput_report
from corvane.sources.logs import read_log_lines, read_log_names

LOGS = {
    "test.1425.log": "[Test]\ntype=horizontal\n[Minute 1]\nec2-a=510.25\n[Minute 2]\nec2-a=900.50\nec2-b=800.25\n",
    "test.77.log": "[Minute 1]\nec2-c=4000.50\n",
    "test.5.log": "started\n",
    "notes.txt": "[Minute 1]\nec2-z=9000\n",
}


@pytest.fixture
def write_logs(tmp_path):
    def write(logs):
        folder = tmp_path / "logs"
        folder.mkdir()
        for name, text in logs.items():
            (folder / name).write_text(text)
        return str(folder)

    return write


def lines_of(spark, texts):
    """Each text as one log, all of it in one block."""
    data = [(test, 0, i, line) for test, text in texts.items() for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(data, "test_id string, block int, seq bigint, line string")


def test_worked_logs(spark, write_logs):
    folder = write_logs(LOGS)
    lines = read_log_lines(spark, folder)
    assert rows(T.rps_rows(lines)) == [
        ("1425", 1, "ec2-a", 510.25),
        ("1425", 2, "ec2-a", 900.5),
        ("1425", 2, "ec2-b", 800.25),
        ("77", 1, "ec2-c", 4000.5),
    ]
    totals = T.rps_per_minute(lines)
    assert rows(totals) == [("1425", 1, 510.25), ("1425", 2, 1700.75), ("77", 1, 4000.5)]
    tests = read_log_names(spark, folder)
    assert rows(tests) == [("1425",), ("5",), ("77",)]
    assert rows(T.rps_latest(lines, tests)) == [("1425", 1700.75), ("5", 0.0), ("77", 4000.5)]
    assert rows(T.rps_target(totals)) == [("77", 1)]
    assert rows(throughput_report(spark, folder)) == [
        ("1425", 1700.75, None),
        ("5", 0.0, None),
        ("77", 4000.5, 1),
    ]


def test_values_and_targets(spark):
    text = "[Minute 3]\na=7\nb=55\nc=12a3\nd=1.5x\n=9\ne=3937.999\nf=0.001 \nno value\ng=.5"
    totals = T.rps_per_minute(lines_of(spark, {"1": text}))
    assert rows(totals) == [("1", 3, pytest.approx(4000))]
    assert rows(T.rps_target(totals, 3999.9999999)) == [("1", 3)]
    text = "[Minute 1]\na=3999.5\n[Minute 2]\na=2000\nb=2000\n[Minute 4]\na=9999"
    exact = T.rps_per_minute(lines_of(spark, {"1": text}))
    assert rows(T.rps_target(exact)) == [("1", 2)]


def test_sections_end_at_the_next_header(spark):
    text = "x=1\n[Minute 1]\na=10\n[Summary]\ntotal=500\n[Minute 2]\na=20"
    lines = lines_of(spark, {"1": text})
    assert rows(T.rps_rows(lines)) == [("1", 1, "a", 10.0), ("1", 2, "a", 20.0)]


def test_the_last_section_counts_even_if_just_begun(spark):
    lines = lines_of(spark, {"1": "[Minute 1]\na=10\n[Minute 2]", "2": "[Minute 9]\na=1\n[Minute 3]\na=2\n[End]\nb=7"})
    tests = spark.createDataFrame([("1",), ("2",), ("3",)], "test_id string")
    assert rows(T.rps_latest(lines, tests)) == [("1", 0.0), ("2", 2.0), ("3", 0.0)]


def test_sections_reach_over_the_splits_of_a_log(spark, write_logs, changed):
    text, expected = "", []
    for minute in range(1, 12):
        text += f"[Minute {minute}]\n"
        for node in range(9):
            text += f"ec2-{node}={minute}.{node}\n"
            expected.append(("8", minute, f"ec2-{node}", float(f"{minute}.{node}")))
    folder = write_logs({"test.8.log": text, "test.9.log": "[Minute 1]\na=1\n"})
    changed("spark.sql.files.maxPartitionBytes", "40")
    changed("spark.sql.files.openCostInBytes", "0")
    lines = read_log_lines(spark, folder)
    assert lines.where("test_id = '8'").select("block").distinct().count() > 20
    assert rows(T.rps_rows(lines)) == sorted([*expected, ("9", 1, "a", 1.0)], key=repr)
