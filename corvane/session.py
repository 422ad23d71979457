"""Session settings the jobs rely on, and where they may write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: str = "*", memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and benchmarks.

    On a cluster ``spark-submit`` brings the settings instead: a shuffle
    partition count that gives partitions of about 200 MB, and
    ``spark.checkpoint.dir`` on storage that all executors share. The hash join
    threshold is of use there too: once a side has been shuffled and every
    partition of it is known to be small, the other side need not be sorted.
    """
    partitions = "8" if cores == "*" else cores
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .getOrCreate()
    )


def session_like(spark: SparkSession, options: dict[str, str]) -> SparkSession:
    """A new session of the same application with the settings of ``spark`` and some others; ``spark`` keeps its own."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **options}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    go without: its machine is the whole cluster, so a temporary folder will do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="corvane-")


def prepare_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding a folder already set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def laid_out(frame: DataFrame, name: str, *order: str) -> DataFrame:
    """The frame computed once and written below the shared folder, compressed, each partition in ``order``: equal values lie together."""
    path = scratch_path(frame.sparkSession, name)
    frame.sortWithinPartitions(*order).write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int) -> int:
    """Partitions for this many rows: work for all cores, and none larger than asked for."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_partition))
