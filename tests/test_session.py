"""Where staged tables go, and what writes leave behind."""

from __future__ import annotations

import time
from types import SimpleNamespace

import pytest
from settings import settings

from lakestar.plans.periods import replace_months
from lakestar.session import FREEING, freeing_shuffles, fresh_folder, shared_folder, staged
from lakestar.sources.buckets import Buckets
from lakestar.sources.tables import write_table
from lakestar.specs import PERIOD


def cluster(setting=None, context_dir=None, master="spark://host:7077"):
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": setting}.get(key) or default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: context_dir)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_folder_the_cluster_names():
    assert shared_folder(cluster("hdfs://c/checkpoints/")) == "hdfs://c/checkpoints"
    assert shared_folder(cluster(None, "s3a://b/x")) == "s3a://b/x"
    assert fresh_folder(cluster("hdfs://c/x"), "t").startswith("hdfs://c/x/lakestar/t-")


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(cluster())


def test_the_test_session_uses_its_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def _shuffle_files(spark) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum("shuffle_" in f for f in manager.getAllFiles().mkString("\n").split("\n") if f.endswith(".data"))


def _settles_at(spark, most: int) -> bool:
    """Files are deleted beside the job's end, soon after it."""
    until = time.time() + 20
    while _shuffle_files(spark) > most and time.time() < until:
        time.sleep(0.1)
    return _shuffle_files(spark) <= most


@pytest.mark.parametrize("write", ["staged", "table", "months", "buckets"])
def test_a_written_table_leaves_no_shuffle_files(spark, write):
    rows = spark.range(1000).selectExpr("id", "cast(2000 as int) sale_year", "cast(id % 3 as int) sale_month")
    before = _shuffle_files(spark)
    dealt = rows.repartition(5, "sale_month")
    path = fresh_folder(spark, "freed")
    if write == "staged":
        staged(dealt, "freed")
    elif write == "table":
        write_table(dealt, path, partition_by=PERIOD)
    elif write == "months":
        assert len(replace_months(dealt, path)) == 3
    else:
        Buckets(spark, "freed_" + path.rsplit("-", 1)[-1], path, 4).write(rows, "t", ["id"])
    assert _settles_at(spark, before)
    assert spark.conf.get(FREEING) == "false"


def test_writes_side_by_side_give_the_setting_back_after_the_last(spark):
    with settings(spark, {FREEING: "false"}):
        first, second = freeing_shuffles(spark), freeing_shuffles(spark)
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(FREEING) == "true"
        with pytest.raises(OSError), freeing_shuffles(spark):
            raise OSError
        second.__exit__(None, None, None)
        assert spark.conf.get(FREEING) == "false"
