"""The ledger: which files and batches each stage has finished, and where they lie.

Every attempt to write a batch has a folder of its own. It is written in full first and
recorded last, by one file, and readers take exactly the attempts that are recorded. So
a reader never sees half a batch, and what a failed run left behind is never read,
whatever comes after it. Entries are only ever added: of two for the same batch the later
attempt counts. One job at a time may write to a lake.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
#: Lines of landing files that are no sales; a batch without any has no entry.
MALFORMED_LINES = "malformed"

_ENTRY = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("max_date", T.DateType()),
        T.StructField("written", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("stage", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
    ]
)


def new_attempt() -> str:
    """A name that no other attempt has and that sorts after the earlier ones."""
    return f"a{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*nulls).filter(F.lit(False))


def few_rows(spark: SparkSession, schema: T.StructType | str, rows: list[tuple]) -> DataFrame:
    """A handful of rows as literals: no Python worker, one task."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    structs = [
        F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]
        )
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def entries(self, stage: str) -> DataFrame:
        """What ``stage`` has recorded; no rows before its first batch."""
        try:
            found = self.spark.read.schema(_ENTRY).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            found = no_rows(self.spark, _ENTRY)
        return found.filter(F.col("stage") == stage)

    def record(
        self,
        stage: str,
        batch_id: int,
        items: DataFrame,
        stamp: dt.datetime,
        *,
        written: str | None = None,
        source: str | None = None,
    ) -> None:
        """Record a batch. ``items`` has ``item`` and any of the other entry columns.

        ``written`` is the attempt that holds the rows, unless ``items`` says so per item;
        ``source`` tells a micro-batch of a stream apart from others.
        """
        given = {"written": written, "source": source}
        columns = [
            F.col(f.name)
            if f.name in items.columns
            else F.lit(given.get(f.name)).cast(f.dataType).alias(f.name)
            for f in _ENTRY.fields[:7]
        ]
        (
            items.select(*columns, F.lit(stamp).alias("recorded_at"))
            .coalesce(1)  # one file, which is there or not
            .write.parquet(f"{self.path}/stage={stage}/batch_id={batch_id}/attempt={new_attempt()}")
        )

    def finished(self, stage: str) -> list[tuple[int, str]]:
        """Batch and the attempt that holds its rows, for each batch of a stage."""
        rows = (
            self.entries(stage)
            .groupBy("batch_id")
            .agg(F.max_by("written", "attempt").alias("written"))
            .orderBy("batch_id")
            .collect()
        )
        return [(r.batch_id, r.written) for r in rows]

    def batch_of(self, stage: str, source: str) -> int | None:
        """The batch that a micro-batch was recorded as."""
        return self.entries(stage).filter(F.col("source") == source).agg(F.max("batch_id")).first()[0]

    def last_batch(self, stage: str) -> int:
        """The highest finished batch of a stage, 0 before the first."""
        return self.entries(stage).agg(F.max("batch_id")).first()[0] or 0

    def pending(self, upstream: str, downstream: str) -> list[int]:
        """Batches one stage has finished after the last one of the next stage, oldest first."""
        waiting = self.entries(upstream).filter(F.col("batch_id") > self.last_batch(downstream))
        return [r.batch_id for r in waiting.select("batch_id").distinct().orderBy("batch_id").collect()]

    def current_versions(self) -> dict[str, Current]:
        """What each gold table consists of now."""
        tables = self.entries(GOLD).filter("version is not null")
        latest = tables.groupBy("item", "version", "batch_id").agg(
            F.max_by(F.struct("written", "max_date"), "attempt").alias("at")
        )
        version = F.col("version")
        newest = latest.groupBy("item").agg(F.max(version).alias("newest"))
        rows = (
            latest.join(newest, "item")
            .filter(version == F.col("newest"))
            .groupBy("item", "version")
            .agg(
                F.max("batch_id").alias("batch_id"),
                F.max("at.max_date").alias("max_date"),
                F.sort_array(
                    F.collect_list(F.when(F.isnotnull("at.written"), F.struct("batch_id", "at.written")))
                ).alias("parts"),
            )
            .collect()
        )
        return {
            r["item"]: Current(r.version, r.batch_id, tuple(tuple(p) for p in r.parts), r.max_date)
            for r in rows
        }


@dataclass(frozen=True)
class Current:
    """Version and last batch of a gold table, the (batch, attempt) folders it is read from, and
    the latest date in them, if it has one."""

    version: int
    batch_id: int
    parts: tuple[tuple[int, str], ...] = ()
    max_date: dt.date | None = None
