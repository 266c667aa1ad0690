"""Lookups in buckets: the same rows as by broadcast, no shuffle of the staged rows, hot keys split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from sample import raw_rows, silver_of
from settings import settings

from lakestar.operators.colocated import attach_colocated, stage_rows
from lakestar.operators.dimensions import build_dimensions
from lakestar.operators.fact import build_fact, build_fact_colocated
from lakestar.operators.lookup import DuplicateLookupKey, Limits, Lookup, attach
from lakestar.plans.ingest import write_silver
from lakestar.plans.load import load_full, load_increment
from lakestar.session import fresh_folder
from lakestar.sources.buckets import Buckets
from lakestar.sources.tables import Lake, with_place
from lakestar.specs import CUSTOMER

PLAIN = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def buckets(spark):
    folder = fresh_folder(spark, "buckets")
    return Buckets(spark, "buckets_" + folder.rsplit("-", 1)[-1], folder, 8)


@pytest.fixture
def scanned(spark, tmp_path):
    """20,000 rows in files, a third of them equal ones of one key, a tenth without a key."""
    key = F.expr("case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 200) end")
    value = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    spark.range(20_000).select(key.alias("a"), value.alias("v")).repartition(4).write.parquet(str(tmp_path / "t"))
    return with_place(spark.read.parquet(str(tmp_path / "t")))


def members(spark):
    return spark.createDataFrame([("hot", 1), (None, 2), *[(f"k{i}", 10 + i) for i in range(0, 200, 2)]], "a string, sk long")


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [Limits(), Limits(rows_per_task=500)], ids=["whole keys", "salted"])
def test_rows_are_those_of_the_broadcast_join(spark, scanned, buckets, how, limits):
    lookup = Lookup("t", members(spark), ("a",), "sk")
    staged = stage_rows(scanned, lookup, buckets, limits)
    got = attach_colocated(staged, staged.rows.select("a", "v", "__salt"), lookup, buckets, how)
    assert got.columns == ["a", "v", "sk"]
    assert sorted_rows(got) == sorted_rows(attach(scanned.select("a", "v"), [lookup], how))


def test_staged_rows_are_not_shuffled(spark, scanned, buckets):
    lookup = Lookup("t", members(spark), ("a",), "sk")
    staged = stage_rows(scanned, lookup, buckets)
    with settings(spark, PLAIN):
        joined = attach_colocated(staged, staged.rows, lookup, buckets)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_equal_rows_of_a_hot_key_lie_in_many_buckets(spark, scanned, buckets):
    lookup = Lookup("t", members(spark), ("a",), "sk")
    staged = stage_rows(scanned, lookup, buckets, Limits(rows_per_task=500))
    hot = staged.rows.where("a = 'hot'")
    assert hot.select("__salt").distinct().count() == 14
    assert hot.select(F.input_file_name()).distinct().count() >= 4
    with settings(spark, PLAIN):
        joined = attach_colocated(staged, staged.rows, lookup, buckets).where("a = 'hot'")
        assert joined.groupBy(F.spark_partition_id()).count().count() >= 4


def test_the_fact_by_buckets_is_the_fact(spark, tmp_path, buckets):
    lake = Lake(spark, str(tmp_path))
    write_silver(lake, silver_of(spark, raw_rows(400)), 1)
    dimensions = build_dimensions(lake.silver_sales())
    lookup = Lookup(CUSTOMER.name, dimensions[CUSTOMER.name], ("customer_id",), CUSTOMER.sk)
    staged = stage_rows(with_place(lake.silver_sales()), lookup, buckets, Limits(rows_per_task=50))
    want = sorted_rows(build_fact(lake.silver_sales(), dimensions))
    for _ in range(2):  # rows are staged once for several loads
        assert sorted_rows(build_fact_colocated(staged, lookup, dimensions, buckets)) == want and len(want) == 400
    doubled = dimensions | {CUSTOMER.name: dimensions[CUSTOMER.name].unionByName(dimensions[CUSTOMER.name])}
    with pytest.raises(DuplicateLookupKey):
        build_fact_colocated(staged, Lookup(CUSTOMER.name, doubled[CUSTOMER.name], ("customer_id",), CUSTOMER.sk), doubled, buckets)


def test_equal_rows_of_a_default_increment_reach_many_tasks(spark, tmp_path, recwarn):
    """The slice and the undated sales come together in a union; rows bring their places."""
    lake = Lake(spark, str(tmp_path))
    rows = raw_rows(30)
    write_silver(lake, silver_of(spark, rows), 1)
    load_full(lake)
    alike = [dict(rows[0], sale_date="2013-01-01")] * 3000
    write_silver(lake, silver_of(spark, [*alike, dict(rows[1], sale_date="")]).repartition(4), 2)
    seen = []
    from lakestar.operators import lookup as module

    real = module.salted_facts

    def noting(facts, *more):
        salted = real(facts, *more)
        seen.append(salted.select("__salt").distinct().count())
        return salted

    module.salted_facts = noting
    try:
        load_increment(lake, limits=Limits(broadcast_bytes=-1, rows_per_task=400))
    finally:
        module.salted_facts = real
    assert seen and max(seen) >= 7
    assert lake.gold_table("fact_sales").count() == 30 + 3001
    assert not [w for w in recwarn if "equal rows of a hot key" in str(w.message)]
