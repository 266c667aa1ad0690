"""Failures between write and record, batch and stream on one lake, what loads lose."""

from __future__ import annotations

import datetime as dt
import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from sample import raw_rows, silver_of, write_csv

from lakestar.operators.incremental import mark_of
from lakestar.plans.ingest import batch_quality, ingest, new_files, refine, write_silver
from lakestar.plans.load import compact_fact, load_full, load_increment, mark_of_lake, star
from lakestar.sources.catalog import count_registered, register_gold
from lakestar.sources.landing import header_of
from lakestar.sources.ledger import GOLD, SILVER
from lakestar.sources.tables import Lake
from lakestar.specs import CUSTOMER, DIMENSIONS, FACT, MANUFACTURER
from lakestar.streaming.ingest import run_available, to_bronze, to_gold


@contextmanager
def losing(lake, stage):
    """The job dies when it is about to record this stage."""
    ledger = type(lake.ledger)
    record = ledger.record

    def dying(self, at, *args, **kwargs):
        if at == stage:
            raise OSError("lost")
        return record(self, at, *args, **kwargs)

    ledger.record = dying
    try:
        with pytest.raises(OSError, match="lost"):
            yield
    finally:
        ledger.record = record


@pytest.fixture(scope="module")
def silver(spark):
    return silver_of(spark, raw_rows(300)).cache()


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    return Lake(spark, str(tmp_path))


def deliver(lake, name, rows):
    write_csv(os.path.join(lake.landing, name), rows)


def sound(lake, rows):
    """The fact has so many rows and every dimension one member per key, keys from 1."""
    tables = star(lake)
    assert tables[FACT].count() == rows
    for d in DIMENSIONS:
        members = tables[d.name].collect()
        assert sorted(r[d.sk] for r in members) == list(range(1, len(members) + 1)), d.name
        assert len({tuple(r[c] for c in d.key) for r in members}) == len(members), d.name


def test_a_lost_increment_then_a_newer_batch(lake, silver):
    write_silver(lake, silver.filter("customer_id < 10"), 1)
    load_full(lake)
    write_silver(lake, silver.filter("customer_id between 10 and 24"), 2)
    with losing(lake, GOLD):
        load_increment(lake, late="ledger")
    write_silver(lake, silver.filter("customer_id > 24"), 3)
    assert load_increment(lake, late="ledger") == 3
    sound(lake, 300)


def test_a_lost_first_load(lake, silver):
    write_silver(lake, silver.filter("customer_id < 20"), 1)
    with losing(lake, GOLD):
        load_full(lake)
    assert star(lake)[FACT].count() == 0
    write_silver(lake, silver.filter("customer_id >= 20"), 2)
    load_increment(lake, late="ledger")
    sound(lake, 300)


def test_lost_silver_is_not_read(lake, silver):
    write_silver(lake, silver.filter("customer_id < 10"), 1)
    with losing(lake, SILVER):
        write_silver(lake, silver.filter("customer_id >= 10"), 2)
    load_full(lake)
    sound(lake, silver.filter("customer_id < 10").count())
    write_silver(lake, silver.filter("customer_id >= 10"), 2)
    load_increment(lake, late="ledger")
    sound(lake, 300)


def test_a_load_lost_twice_and_a_full_load_on_the_same_batch(lake, silver):
    write_silver(lake, silver, 1)
    load_full(lake)
    for _ in range(2):
        with losing(lake, GOLD):
            load_full(lake)
        sound(lake, 300)
    load_full(lake)
    sound(lake, 300)
    assert lake.ledger.current_versions()[FACT].version == 2


def renamed(rows, name="Other"):
    return [dict(r, manufacturer=name) if r["manufacturer_id"] == 1 else r for r in rows]


@pytest.mark.parametrize("on_change", ["update", "keep"])
def test_a_renamed_manufacturer_loses_no_sale(spark, lake, on_change):
    rows = raw_rows(100)
    write_silver(lake, silver_of(spark, rows[:50]), 1)
    load_full(lake)
    mixed = [*rows[50:75], *renamed(rows[75:], "New"), *renamed(rows[75:80], "Newer")]
    write_silver(lake, silver_of(spark, mixed), 2)
    load_increment(lake, late="ledger", on_change=on_change)
    assert lake.gold_table(FACT).count() == 50 + len(mixed)
    names = {r.manufacturer for r in lake.gold_table(MANUFACTURER.name).filter("manufacturer_id = 1").collect()}
    assert len(names) == 1 and (on_change == "update" or names == {"Maker 1"})


def test_a_renamed_manufacturer_in_a_full_load(spark, lake):
    rows = raw_rows(100)
    write_silver(lake, silver_of(spark, [*rows[:50], *renamed(rows[50:])]), 1)
    load_full(lake, versions="latest")
    assert lake.gold_table(FACT).count() == 100


def test_lookup_by_name_records_what_it_loses(spark, lake):
    rows = raw_rows(100)
    write_silver(lake, silver_of(spark, [*rows[:50], *renamed(rows[50:])]), 1)
    load_full(lake, versions="latest", manufacturer_by_name=True)
    kept = lake.gold_table(FACT).count()
    found = {r["item"]: r["row_count"] for r in batch_quality(lake).collect()}
    assert kept < 100 and found["lost_dim_manufacturer"] == 100 - kept
    assert (found["rows_offered"], found["rows_loaded"], found["lost_dim_product"]) == (100, kept, 0)


def test_batch_then_stream(lake):
    deliver(lake, "one.csv", raw_rows(30, seed=1))
    header = header_of(lake.spark, lake.landing)
    ingest(lake)
    refine(lake)
    load_full(lake)
    deliver(lake, "two.csv", raw_rows(20, seed=2))
    run_available(lake, header, to_gold)
    assert lake.bronze_sales().count() == 50
    sound(lake, 50)
    run_available(lake, header, to_gold)
    sound(lake, 50)


def test_stream_then_batch(lake):
    deliver(lake, "one.csv", raw_rows(30, seed=1))
    run_available(lake, header_of(lake.spark, lake.landing))
    assert new_files(lake).isEmpty() and ingest(lake) == []
    deliver(lake, "two.csv", raw_rows(20, seed=2))
    assert ingest(lake) == [2] and refine(lake) == [1, 2]
    assert lake.silver_sales().count() == 50


def test_bronze_stream_then_gold_stream(lake):
    deliver(lake, "one.csv", raw_rows(30, seed=1))
    header = header_of(lake.spark, lake.landing)
    run_available(lake, header, to_bronze)
    run_available(lake, header, to_bronze)
    assert lake.bronze_sales().count() == 30
    deliver(lake, "two.csv", raw_rows(30, seed=2))
    run_available(lake, header, to_gold)
    assert lake.bronze_sales().count() == 60
    sound(lake, 60)


def test_archived_files_leave_the_landing_folder(lake):
    deliver(lake, "a b.csv", raw_rows(5))
    ingest(lake, archive=True)
    deliver(lake, "a b.csv", raw_rows(6, seed=2))
    ingest(lake, archive=True)
    assert os.listdir(lake.landing) == [] or not [f for f in os.listdir(lake.landing) if f.endswith(".csv")]
    kept = [f for f in os.listdir(lake.archive) if not f.startswith(".")]
    assert sorted(kept) == ["a b.csv", "a b.csv.1"] and lake.bronze_sales().count() == 11


def test_undated_sales_are_loaded_once_and_late_ones_counted(spark, lake):
    rows = raw_rows(60, first=dt.date(2012, 1, 1))
    write_silver(lake, silver_of(spark, rows[:20]), 1)
    load_full(lake)
    mark = mark_of_lake(lake)
    later = [dict(r, sale_date="2013-01-01") for r in rows[20:40]]
    bad = [dict(r, sale_date="no date") for r in rows[40:45]]
    old = [dict(r, sale_date="2010-01-01") for r in rows[45:52]]
    write_silver(lake, silver_of(spark, [*later, *bad, *old]), 2)
    load_increment(lake)
    fact = lake.gold_table(FACT)
    assert fact.count() == 45 and fact.filter("sale_date is null").count() == 5
    found = {r["item"]: r["row_count"] for r in batch_quality(lake).filter("batch_id = 2").collect()}
    assert (found["null_sale_date"], found["left_late"], found["rows_loaded"]) == (5, 7, 25)
    write_silver(lake, silver_of(spark, [dict(rows[0], sale_date="2013-02-01")]), 3)
    load_increment(lake, with_undated=False)
    assert lake.gold_table(FACT).count() == 46 and mark < mark_of_lake(lake) == dt.date(2013, 2, 1)


def test_the_mark_opens_no_file_of_the_fact(lake, silver, monkeypatch):
    write_silver(lake, silver, 1)
    load_full(lake)
    want = mark_of(lake.gold_table(FACT))
    monkeypatch.setattr(Lake, "read_parts", lambda *a: pytest.fail("a table was read"))
    assert mark_of_lake(lake) == want


def test_catalog_over_increments_a_failure_and_a_new_version(spark, lake, silver):
    def shown():
        register_gold(lake, "gold_protocol")
        return {r.table_name: r.row_count for r in count_registered(spark, "gold_protocol").collect()}

    write_silver(lake, silver.filter("customer_id < 10"), 1)
    load_full(lake)
    tables = {d: star(lake)[d].count() for d in star(lake)}
    assert shown() == tables
    write_silver(lake, silver.filter("customer_id between 10 and 24"), 2)
    with losing(lake, GOLD):
        load_increment(lake, late="ledger")
    assert shown() == tables
    load_increment(lake, late="ledger")
    write_silver(lake, silver.filter("customer_id > 24"), 3)
    load_increment(lake, late="ledger")
    assert shown()[FACT] == 300
    before = lake.gold_table(FACT)
    want = sorted(map(repr, before.collect()))
    compact_fact(lake)
    assert shown()[FACT] == 300 and shown()[CUSTOMER.name] == star(lake)[CUSTOMER.name].count()
    assert sorted(map(repr, lake.gold_table(FACT).collect())) == want == sorted(map(repr, before.collect()))
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert files(lake.gold_table(FACT)) < files(before)
