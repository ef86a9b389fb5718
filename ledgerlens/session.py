"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library assumes: UTC and AQE.

    Checkpoint files go when no DataFrame refers to them any more, and columns
    do not record the Python line that made them, which halves the time to
    build a plan.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# A task's share of the input, uncompressed sizes being unknown.
TASK_BYTES = 128 << 20


def partitions_for(input_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """Shuffle partitions for an input of so many bytes on disk: in proportion, at any size."""
    return max(1, -(-input_bytes // task_bytes))


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Run a block with at least ``n`` shuffle partitions, and put the setting back.

    Never fewer than set: AQE merges partitions that prove small, but cannot
    split an aggregate's too large ones.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if n is not None and n > int(before):
        spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="ledgerlens-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared scratch folder."""
    return f"{_ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared scratch folder, for plans that read one intermediate several times.

    As parquet: it is computed once, its size is known to later joins, and they
    read the columns that they need.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
