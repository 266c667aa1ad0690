"""Bucketed tables: rows that lie by a key already, so that joins on it need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakestar.session import freeing_shuffles


@dataclass(frozen=True)
class Buckets:
    """Where bucketed tables are kept, and into how many buckets their rows are dealt.

    Tables that are joined need one number of buckets; two to three times the cores is a start, and
    a bucket should hold a few hundred megabytes at most.
    """

    spark: SparkSession
    database: str
    folder: str
    count: int

    def write(self, rows: DataFrame, table: str, by: Sequence[str]) -> DataFrame:
        """Deal the rows out by ``by``, one sorted file per bucket, and return the table.

        This is the shuffle that later joins on the same columns do without. A table of that name is
        replaced; its files stay for those who read them.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.folder}/catalog'")
        name = f"{self.database}.{table}"
        writer = (
            rows.repartition(self.count, *by)
            .write.format("parquet")
            .mode("overwrite")
            .bucketBy(self.count, *by)
            .sortBy(*by)
            .option("path", f"{self.folder}/{table}-{uuid.uuid4().hex}")
        )
        with freeing_shuffles(rows.sparkSession):
            writer.saveAsTable(name)
        return self.spark.table(name)
