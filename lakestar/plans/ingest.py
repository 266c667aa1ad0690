"""Landing to bronze to silver, batch by batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.silver import clean, with_period
from lakestar.sources.landing import FILE_IDENTITY, MALFORMED, landing_files, read_landing
from lakestar.sources.ledger import BRONZE, GOLD, MALFORMED_LINES, SILVER, few_rows
from lakestar.sources.tables import Lake, gathered
from lakestar.specs import PERIOD, RAW_COLUMNS


#: Files whose names are on the driver at a time.
FILES_PER_BATCH = 10_000


def taken_files(lake: Lake) -> DataFrame:
    """The files that batches have taken, whether listed by a job or read by a stream."""
    return lake.ledger.entries(BRONZE).select(F.col("item").alias("source_file"), "modified_at")


def new_files(lake: Lake) -> DataFrame:
    """Landing files no batch has taken. A file delivered again under its name is new."""
    return landing_files(lake.spark, lake.landing).join(taken_files(lake), list(FILE_IDENTITY), "left_anti")


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Stored:
    """What a batch wrote: the attempt, the rows each file gave, and of how many lines none came."""

    attempt: str
    rows: dict[str, int]
    malformed: int = 0
    malformed_attempt: str | None = None


def write_bronze(lake: Lake, rows: DataFrame, batch_id: int, files: int, gather: bool = True) -> Stored:
    """Write raw rows by month. This is the only shuffle between the files and the fact.

    Files that hold a month or two each need none: ``gather=False``. Rows are counted by file (there
    are ``files`` of them) in the tasks that write them, so nothing is read again, and a task that
    is repeated counts once. Malformed lines are not written with the rows; only if there are any,
    the files are read once more and the lines are written to a table beside them.
    """
    if MALFORMED not in rows.columns:
        rows = rows.withColumn(MALFORMED, F.lit(None).cast("string"))
    dated = with_period(rows)
    dated = gathered(dated, *PERIOD) if gather else dated
    seen, good = Observation(), F.isnull(MALFORMED)
    # a sketch with room for every file counts exactly; lines that are no sales count as the file null
    per_file = F.when(good, F.coalesce("source_file", F.lit("")))
    counted = dated.observe(
        seen,
        F.call_function("approx_top_k", per_file, F.lit(files + 1), F.lit(2 * (files + 1))).alias("files"),
        F.count("*").alias("lines"),
        F.count_if(~good).alias("malformed"),
    )
    attempt = lake.write_batch(counted.where(good).drop(MALFORMED), lake.bronze, batch_id, PERIOD)
    found = seen.get
    stored = Stored(attempt, {r["item"]: r["count"] for r in found["files"] if r["item"] is not None}, found["malformed"])
    if sum(stored.rows.values()) + stored.malformed != found["lines"]:
        raise RuntimeError(f"batch {batch_id} has more than the {files} files it was said to have")
    if stored.malformed:
        # with all fields, as far as they could be read: Spark takes no offence at a field it isn't asked for
        lines = rows.where(~good).select(*RAW_COLUMNS, "source_file", F.col(MALFORMED).alias("line"))
        stored = replace(stored, malformed_attempt=lake.write_batch(lines, lake.malformed, batch_id))
    return stored


def record_bronze(
    lake: Lake,
    files: Sequence[tuple[str, dt.datetime]],
    batch_id: int,
    stored: Stored,
    stamp: dt.datetime,
    source: str | None = None,
) -> None:
    """Record the files of a batch with the rows each gave, 0 for a file with a header only.

    Malformed lines are recorded first: a batch is finished with its files.
    """
    if stored.malformed:
        lines = few_rows(lake.spark, "item string, row_count long", [("malformed_lines", stored.malformed)])
        lake.ledger.record(MALFORMED_LINES, batch_id, lines, stamp, written=stored.malformed_attempt)
    items = lake.spark.createDataFrame(
        [(name, at, stored.rows.get(name, 0)) for name, at in files],
        "item string, modified_at timestamp, row_count long",
    )
    lake.ledger.record(BRONZE, batch_id, items, stamp, written=stored.attempt, source=source)


def move_to(spark: SparkSession, paths: Sequence[str], folder: str) -> None:
    """Move files, by the file system's own rename; names that are taken get a number."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(conf)
    system.mkdirs(target)
    for path in paths:
        source = jvm.org.apache.hadoop.fs.Path(path)
        there, n = jvm.org.apache.hadoop.fs.Path(target, source.getName()), 0
        while system.exists(there):
            n += 1
            there = jvm.org.apache.hadoop.fs.Path(target, f"{source.getName()}.{n}")
        if not system.rename(source, there):
            raise OSError(f"could not move {path} to {folder}")


def ingest(
    lake: Lake,
    stamp: dt.datetime | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    gather: bool = True,
    archive: bool = False,
) -> list[int]:
    """Take every new landing file, oldest first; the numbers of the batches written.

    A batch's list of files is fixed before anything is read, so a file that arrives
    meanwhile waits for a later batch. The reader needs the paths on the driver: that many,
    and no more, are there at a time, and batches follow until no file is left. With
    ``archive``, files move out of the landing folder once their batch is recorded.
    """
    batches = []
    while True:
        oldest = new_files(lake).orderBy("modified_at", "source_file").limit(files_per_batch)
        files = oldest.select(*FILE_IDENTITY, "path").collect()
        if files:
            batch_id = lake.ledger.last_batch(BRONZE) + 1
            rows = read_landing(lake.spark, [f.path for f in files], malformed=True)
            stored = write_bronze(lake, rows, batch_id, len(files), gather)
            listed = [(f.source_file, f.modified_at) for f in files]
            record_bronze(lake, listed, batch_id, stored, stamp or now())
            batches.append(batch_id)
            if archive:
                move_to(lake.spark, [f.path for f in files], lake.archive)
        if len(files) < files_per_batch:
            return batches


def write_silver(
    lake: Lake,
    rows: DataFrame,
    batch_id: int,
    stamp: dt.datetime | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Write clean rows, gathered by month, as a silver batch and record it with what it lacks.

    The tasks that write the rows count them.
    """
    seen = Observation()
    lacking = [F.count_if(F.isnull(c)).alias(f"null_{c}") for c in ("sale_date", "unit_price", "unit_cost", "units")]
    counted = rows.observe(seen, F.count("*").alias("rows"), *lacking)
    written = lake.write_batch(counted, lake.silver, batch_id, PERIOD, max_records_per_file)
    items = few_rows(lake.spark, "item string, row_count long", list(seen.get.items()))
    lake.ledger.record(SILVER, batch_id, items, stamp or now(), written=written)


def batch_quality(lake: Lake) -> DataFrame:
    """``batch_id``, ``item``, ``row_count``: what batches lacked, lost or left behind.

    The counts are recorded with the batch. Those of a later attempt replace the earlier ones.
    Batches of the landing folder that had malformed lines have their number.
    """
    stages = (MALFORMED_LINES, SILVER, GOLD)
    counted = [lake.ledger.entries(stage).filter("row_count is not null") for stage in stages]
    return (
        reduce(DataFrame.unionByName, counted)
        .groupBy("batch_id", "item")
        .agg(F.max_by("row_count", "attempt").alias("row_count"))
    )


def refine(lake: Lake, max_records_per_file: int | None = None) -> list[int]:
    """Clean every bronze batch that silver lacks.

    One batch is one job over its files only, without a shuffle: bronze files hold one month.
    """
    batches = lake.ledger.pending(BRONZE, SILVER)
    for batch_id in batches:
        rows = clean(lake.bronze_sales([batch_id]))
        write_silver(lake, rows, batch_id, max_records_per_file=max_records_per_file)
    return batches
