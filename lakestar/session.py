"""The Spark session and the shared folder that intermediate tables live in."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakestar")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Where staged tables go: ``spark.checkpoint.dir``, which every executor reaches.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakestar-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/lakestar/{label}-{uuid.uuid4().hex}"


#: Whether Spark deletes the shuffle files of a job as it ends; else they stay until the driver collects its garbage.
FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writers: Counter[int] = Counter()
_before: dict[int, str | None] = {}
_switch = threading.Lock()


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files behind: what they shuffled is in the written table.

    Writes may run side by side; the session gets its own setting back after the last one.
    """
    # sessions of one JVM session are one, whatever Python holds them by
    key = spark._jsparkSession.hashCode()
    with _switch:
        if not _writers[key]:
            _before[key] = spark.conf.get(FREEING, None)
            spark.conf.set(FREEING, "true")
        _writers[key] += 1
    try:
        yield
    finally:
        with _switch:
            _writers[key] -= 1
            if not _writers[key]:
                del _writers[key]
                before = _before.pop(key)
                spark.conf.unset(FREEING) if before is None else spark.conf.set(FREEING, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    What follows does not recompute it, and a lost executor cannot make two readers see
    different rows. The schema is known, so reading it back opens no footer up front.
    """
    path = fresh_folder(df.sparkSession, label)
    with freeing_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
