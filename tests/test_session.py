import tempfile

from types import SimpleNamespace

import pytest

from corvane import session as S


def fake(named=None, current=None, master="spark://cluster"):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: current, master=master))


def test_the_named_folder_is_used():
    assert S.shared_folder(fake("hdfs://shared/spark/")) == "hdfs://shared/spark"
    assert S.shared_folder(fake(current="hdfs://shared/other")) == "hdfs://shared/other"
    assert S.scratch_path(fake("hdfs://shared"), "x").startswith("hdfs://shared/x-")


def test_a_cluster_must_name_a_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.shared_folder(fake())
    assert S.shared_folder(fake(master="local[2]")).startswith(tempfile.gettempdir())


def test_a_session_of_its_own_leaves_the_others_settings(spark, changed):
    changed("spark.sql.autoBroadcastJoinThreshold", "12345")
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    own = S.session_like(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3"})
    assert [own.conf.get(k) for k in keys] == ["false", "3", "12345"]
    assert [spark.conf.get(k) for k in keys] == before
    assert own.sparkContext is spark.sparkContext


def test_partitions_follow_the_rows(spark, changed):
    cores = spark.sparkContext.defaultParallelism
    changed("spark.sql.shuffle.partitions", str(100 * cores))
    assert S.partitions_for(spark, 5, 10) == cores
    assert S.partitions_for(spark, 50 * cores * 10 + 1, 10) == 50 * cores + 1
    assert S.partitions_for(spark, 10**9, 10) == 10**8
