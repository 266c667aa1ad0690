"""Batch tables: ``batch_id=<n>/attempt=<a>`` folders, each written once as a whole.

A table is read from the folders that the ledger names and no others, so a retried job
cannot repeat rows, without needing a transactional format. ``fmt='delta'`` makes each table
one Delta table with the attempt as a column; no Delta jar is at hand here, so that path is
untested.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.session import freeing_shuffles
from lakestar.sources.ledger import BRONZE, MALFORMED_LINES, SILVER, Current, Ledger, new_attempt, no_rows
from lakestar.specs import (
    ATTEMPT,
    BATCH,
    BRONZE_SCHEMA,
    GOLD_SCHEMAS,
    MALFORMED_SCHEMA,
    ROW_PLACE,
    SILVER_SCHEMA,
)


#: Of partitioned tables in Parquet: less to write than by Spark's default. Dimensions keep that one, or Spark
#: would broadcast more of them by the bytes of their files.
COMPRESSION = "zstd"


def gathered(rows: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one partition value together before they are written.

    Otherwise every task writes a file for every month it meets. A small month shares a task,
    and a month with a third of all rows is split over many, so the number of files follows
    the bytes. Rows read from a table that has these partitions are together already: every
    file of it holds one month.
    """
    return rows.hint("rebalance", *[F.col(c) for c in columns])


def gathered_by_month(rows: DataFrame, date: str) -> DataFrame:
    """As :func:`gathered`, by the month of a date; in the shuffle one number stands for year and month."""
    month = "__month"
    numbered = rows.withColumn(month, F.year(date) * 12 + F.month(date))
    return gathered(numbered, month).drop(month)


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a table. Rows for a partitioned one should come :func:`gathered`."""
    writer = df.write.format(fmt).mode(mode).partitionBy(*partition_by)
    if partition_by and fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with freeing_shuffles(df.sparkSession):
        writer.save(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """Read a table by path.

    With a schema, a column that older files lack reads as null and no footer is opened to
    plan the query. ``merge_schema`` finds the union of columns itself, from every footer.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt == "parquet":
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def with_place(rows: DataFrame) -> DataFrame:
    """Rows of a scan with a number that tells each from all others and that a repeated task gives again.

    It is made of the row's file and its place there, so it must be taken at the scan, before
    rows of several scans come together; who doesn't use it doesn't pay for it.
    """
    return rows.withColumn(ROW_PLACE, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


@dataclass(frozen=True)
class Lake:
    """Where the layers are. One root; landing may be elsewhere."""

    spark: SparkSession
    root: str
    landing_path: str | None = None
    fmt: str = "parquet"

    @property
    def landing(self) -> str:
        return self.landing_path or f"{self.root}/landing"

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/sales"

    @property
    def malformed(self) -> str:
        return f"{self.root}/bronze/malformed"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/sales"

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")

    def gold(self, table: str, version: int) -> str:
        return f"{self.root}/gold/{table}/v={version}"

    def write_batch(
        self,
        df: DataFrame,
        path: str,
        batch_id: int,
        partition_by: Sequence[str] = (),
        max_records_per_file: int | None = None,
    ) -> str:
        """Write one attempt at a batch and return its name, to be recorded."""
        attempt = new_attempt()
        if self.fmt == "delta":  # untested: no jar is at hand
            rows = df.withColumns({BATCH: F.lit(batch_id).cast("long"), ATTEMPT: F.lit(attempt)})
            writer = rows.write.format("delta").mode("append").option("mergeSchema", True)
            if max_records_per_file:
                writer = writer.option("maxRecordsPerFile", max_records_per_file)
            with freeing_shuffles(df.sparkSession):
                writer.partitionBy(BATCH, ATTEMPT, *partition_by).save(path)
            return attempt
        write_table(
            df.drop(BATCH),
            self.folder(path, batch_id, attempt),
            mode="error",
            partition_by=partition_by,
            max_records_per_file=max_records_per_file,
            fmt=self.fmt,
        )
        return attempt

    @staticmethod
    def folder(path: str, batch_id: int, attempt: str) -> str:
        return f"{path}/{BATCH}={batch_id}/{ATTEMPT}={attempt}"

    def read_parts(
        self, path: str, schema: T.StructType, parts: Sequence[tuple[int, str]]
    ) -> DataFrame:
        """The rows of exactly these (batch, attempt) folders."""
        if not parts:
            return no_rows(self.spark, schema)
        if self.fmt == "delta":
            rows = self.spark.read.format("delta").load(path)
            return rows.filter(F.col(ATTEMPT).isin([a for _, a in parts])).select(*schema.names)
        reader = self.spark.read.format(self.fmt).schema(schema).option("basePath", path)
        return reader.load([self.folder(path, b, a) for b, a in parts]).select(*schema.names)

    def _stage(self, stage: str, path: str, schema: T.StructType, batches: Sequence[int] | None) -> DataFrame:
        parts = self.ledger.finished(stage)
        if batches is not None:
            parts = [p for p in parts if p[0] in set(batches)]
        return self.read_parts(path, schema, parts)

    def bronze_sales(self, batches: Sequence[int] | None = None) -> DataFrame:
        """The finished bronze batches, or those of them that are named."""
        return self._stage(BRONZE, self.bronze, BRONZE_SCHEMA, batches)

    def silver_sales(self, batches: Sequence[int] | None = None) -> DataFrame:
        return self._stage(SILVER, self.silver, SILVER_SCHEMA, batches)

    def malformed_lines(self, batches: Sequence[int] | None = None) -> DataFrame:
        """Lines that are no sales: ``source_file``, ``line``, ``batch_id``, and the fields that could be read."""
        return self._stage(MALFORMED_LINES, self.malformed, MALFORMED_SCHEMA, batches)

    def gold_table(self, table: str, at: Current | None = None) -> DataFrame:
        """The finished batches of a gold table's current version; empty before the first.

        ``at`` is the table's entry of ``ledger.current_versions()``, if at hand.
        """
        schema = GOLD_SCHEMAS[table]
        at = at or self.ledger.current_versions().get(table)
        if at is None:
            return no_rows(self.spark, schema)
        return self.read_parts(self.gold(table, at.version), schema, at.parts)
