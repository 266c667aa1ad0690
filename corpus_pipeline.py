"""Documents to shards: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage takes the documents that the one before kept and returns the same columns; the last
one adds ``shard`` and ``slot``. Whatever else the input's columns are called, stages see them
under neutral names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm import decontaminate, minhash, mixing, quality, sharding
from lakestar.llm.common import neutral, word_count, written

SHARDS = 16
SEED = 20


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null or empty text fails them; repeated rows are judged alike and count as often as they stand; an
    empty table stays empty.
    """
    rows, named = neutral(docs)
    judged = quality.verdicts(quality.measure(rows, named.to["text"]), (named.to["lang"], named.to["source"]))
    return named.back(judged.where("kept"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least row number.

    Null, empty and blank texts are no copies of each other, each of them stays; of repeated rows one
    stays; an empty table stays empty.
    """
    rows, named = neutral(docs)
    return named.back(minhash.one_of_each(rows, named.to["text"]))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate.

    A null or empty text has no words and stays; null or empty items find nothing; repeated rows go or
    stay together; an empty table on either side loses no row.
    """
    rows, named = neutral(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return named.back(decontaminate.clean(rows, items, named.to["text"]))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a row for each copy.

    A document without words (null, empty) has no size and is not taken; a null source is one like others,
    the last; documents that tie are ordered by what the mix draws for their ids; an empty table stays empty.
    """
    rows, named = neutral(docs)
    sized = rows.withColumn("size", word_count(F.col(named.to["text"])))
    taken = mixing.mix(sized, named.to["doc_id"], "size", named.to["source"], seed=SEED).where("copies > 0")
    return named.back(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their place in it.

    Rows count, whatever is in them: nulls, empty texts and repeated rows are dealt out like others; an
    empty table stays empty.
    """
    return sharding.shuffle_to_shards(docs, SHARDS, seed=SEED)


STAGES = [
    ("quality", good),
    ("near_dedup", distinct),
    ("decontamination", clean),
    ("mixing", mixed),
    ("sharding", to_shards),
]

#: SQL can express neither the robust distances nor the signatures; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
