"""Landing files: headers, types, provenance, the ledger, and the stream."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from sample import raw_rows, write_csv

from lakestar.operators.incremental import mark_of
from lakestar.plans.ingest import ingest, new_files, refine
from lakestar.plans.load import load_increment
from lakestar.sources.landing import header_of, landing_files, read_landing
from lakestar.sources.ledger import BRONZE, SILVER
from lakestar.sources.tables import Lake
from lakestar.specs import RAW_COLUMNS
from lakestar.streaming.ingest import run_available, to_bronze, to_gold


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    return Lake(spark, str(tmp_path))


def deliver(lake, name, rows, **options):
    write_csv(os.path.join(lake.landing, name), rows, **options)


def test_types_are_declared_and_bad_values_are_null(lake):
    rows = raw_rows(3)
    rows[0]["sale_date"] = "31/12/2011"
    rows[1]["units"] = "many"
    deliver(lake, "a.csv", rows)
    got = read_landing(lake.spark, lake.landing)
    assert dict(got.dtypes)["postal_code"] == "string" and dict(got.dtypes)["sale_date"] == "date"
    found = {r.email_name + str(r.unit_price): r for r in got.collect()}
    first, second, third = (found[r["email_name"] + str(r["unit_price"])] for r in rows)
    assert first.sale_date is None and first.units == rows[0]["units"]
    assert second.units is None and second.product_id == rows[1]["product_id"]
    assert third.sale_date == dt.date.fromisoformat(rows[2]["sale_date"])
    assert third.postal_code == rows[2]["postal_code"]


def test_header_in_source_names_and_any_order(lake):
    rows = raw_rows(20)
    deliver(lake, "a.csv", rows, header=tuple(reversed(RAW_COLUMNS)), source_names=True)
    got = read_landing(lake.spark, lake.landing)
    assert set(got.columns) == {*RAW_COLUMNS, "source_file"}
    want = sorted((r["product"], r["unit_price"], r["district"]) for r in rows if r["district"])
    read = got.filter("district is not null").select("product", "unit_price", "district")
    assert sorted(map(tuple, read.collect())) == want


def test_files_with_different_headers_do_not_mix(lake):
    deliver(lake, "a.csv", raw_rows(5))
    deliver(lake, "b.csv", raw_rows(5), header=tuple(reversed(RAW_COLUMNS)))
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(lake.spark, lake.landing, RAW_COLUMNS).collect()


def test_a_missing_column_is_named(lake):
    deliver(lake, "a.csv", raw_rows(2), header=[c for c in RAW_COLUMNS if c != "units"])
    with pytest.raises(ValueError, match="units"):
        read_landing(lake.spark, lake.landing)


def test_file_names_are_those_on_disk(lake):
    names = {"vendas 2012.csv", "a+b.csv", "plain.csv"}
    for name in names:
        deliver(lake, name, raw_rows(4))
    got = read_landing(lake.spark, lake.landing).select("source_file").distinct().collect()
    assert {r.source_file for r in got} == names
    assert {r.source_file for r in landing_files(lake.spark, lake.landing).collect()} == names


def test_each_file_is_taken_once(lake):
    deliver(lake, "one.csv", raw_rows(30, seed=1))
    deliver(lake, "empty.csv", [])
    assert ingest(lake) == [1]
    assert ingest(lake) == []
    deliver(lake, "two 2.csv", raw_rows(20, seed=2))
    assert [r.source_file for r in new_files(lake).collect()] == ["two 2.csv"]
    assert ingest(lake) == [2]
    entries = lake.ledger.entries(BRONZE).select("batch_id", "item", "row_count").collect()
    assert {tuple(r) for r in entries} == {(1, "one.csv", 30), (1, "empty.csv", 0), (2, "two 2.csv", 20)}
    assert lake.bronze_sales().count() == 50
    # the same name with new content is a new file
    deliver(lake, "one.csv", raw_rows(7, seed=3))
    os.utime(os.path.join(lake.landing, "one.csv"), (2_000_000_000, 2_000_000_000))
    assert ingest(lake) == [3]
    assert lake.bronze_sales().count() == 57


def test_many_files_make_several_batches(lake):
    for i in range(5):
        deliver(lake, f"f{i}.csv", raw_rows(3, seed=i))
        os.utime(os.path.join(lake.landing, f"f{i}.csv"), (1_000_000 - i, 1_000_000 - i))
    assert ingest(lake, files_per_batch=2) == [1, 2, 3]
    entries = lake.ledger.entries(BRONZE).select("batch_id", "item").collect()
    assert {tuple(r) for r in entries} == {(1, "f4.csv"), (1, "f3.csv"), (2, "f2.csv"), (2, "f1.csv"), (3, "f0.csv")}
    assert lake.bronze_sales().count() == 15


def test_a_batch_written_twice_counts_once(lake):
    """A run that fails after writing and before recording is repeated without harm."""
    deliver(lake, "one.csv", raw_rows(30))
    record = type(lake.ledger).record
    try:
        type(lake.ledger).record = lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
        with pytest.raises(OSError):
            ingest(lake)
    finally:
        type(lake.ledger).record = record
    deliver(lake, "two.csv", raw_rows(5, seed=9))
    assert ingest(lake) == [1]
    assert lake.bronze_sales().count() == 35


def test_gathering_changes_files_not_rows(lake, tmp_path):
    deliver(lake, "one.csv", raw_rows(60))
    ingest(lake)
    (tmp_path / "other").mkdir()
    other = Lake(lake.spark, str(tmp_path / "other"), landing_path=lake.landing)
    ingest(other, gather=False)
    rows = [sorted(map(repr, table.bronze_sales().collect())) for table in (lake, other)]
    assert rows[0] == rows[1] and len(rows[0]) == 60


def test_a_sale_without_a_date_reaches_the_fact(lake):
    """It lies in no month and after no mark, so only loads by batch take it."""
    rows = raw_rows(40)
    deliver(lake, "one.csv", rows[:20])
    ingest(lake)
    refine(lake)
    load_increment(lake)
    deliver(lake, "two.csv", [dict(r, sale_date="no date") for r in rows[20:]])
    ingest(lake)
    refine(lake)
    load_increment(lake, late="ledger")
    fact = lake.gold_table("fact_sales")
    assert fact.count() == 40 and fact.filter("sale_date is null and sale_year is null").count() == 20
    assert mark_of(fact) == max(dt.date.fromisoformat(r["sale_date"]) for r in rows[:20])


def test_refine_takes_pending_batches_only(lake):
    deliver(lake, "one.csv", raw_rows(30))
    ingest(lake)
    assert refine(lake) == [1]
    assert refine(lake) == []
    deliver(lake, "two.csv", raw_rows(20, seed=2))
    ingest(lake)
    assert refine(lake) == [2]
    assert lake.silver_sales().count() == 50
    assert lake.ledger.last_batch(SILVER) == 2


def test_refine_needs_no_shuffle_and_reads_its_batch_only(lake):
    from lakestar.operators.silver import clean

    for i in (1, 2):
        deliver(lake, f"{i}.csv", raw_rows(30, seed=i))
        ingest(lake)
    rows = clean(lake.bronze_sales([2]))
    assert "Exchange" not in rows._jdf.queryExecution().toString()
    assert rows.inputFiles() and all("batch_id=2" in f for f in rows.inputFiles())


def test_stream_reads_each_file_once_and_archives(lake):
    deliver(lake, "one.csv", raw_rows(30))
    header = header_of(lake.spark, lake.landing)
    run_available(lake, header, archive=True)
    deliver(lake, "two.csv", raw_rows(20, seed=2))
    run_available(lake, header, archive=True)
    run_available(lake, header, archive=True)
    counts = lake.bronze_sales().groupBy("batch_id").count().collect()
    assert {tuple(r) for r in counts} == {(1, 30), (2, 20)}
    files = lake.ledger.entries(BRONZE).select("item", "row_count").collect()
    assert {tuple(r) for r in files} == {("one.csv", 30), ("two.csv", 20)}


def test_stream_resumes_after_a_failure(lake):
    """The step fails after it has recorded its batch; the repeated micro-batch adds nothing."""
    deliver(lake, "one.csv", raw_rows(30))
    header = header_of(lake.spark, lake.landing)
    tries = []

    def step(lake, rows, source, stamp):
        to_bronze(lake, rows, source, stamp)
        tries.append(source)
        if len(tries) == 1:
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        run_available(lake, header, step)
    run_available(lake, header, step)
    assert tries == ["stream-0", "stream-0"]
    assert lake.bronze_sales().count() == 30
    assert lake.ledger.last_batch(BRONZE) == 1


def test_stream_to_gold_counts_late_sales(lake):
    """A second delivery with older dates reaches the fact; known members keep their keys."""
    deliver(lake, "one.csv", raw_rows(200, seed=1, first=dt.date(2012, 6, 1)))
    header = header_of(lake.spark, lake.landing)
    run_available(lake, header, to_gold)
    before = {r.customer_id: r.customer_sk for r in lake.gold_table("dim_customer").collect()}
    deliver(lake, "late.csv", raw_rows(100, seed=5, first=dt.date(2011, 1, 1)))
    run_available(lake, header, to_gold)
    after = {r.customer_id: r.customer_sk for r in lake.gold_table("dim_customer").collect()}
    assert lake.gold_table("fact_sales").count() == 300
    assert before.items() <= after.items()
    assert sorted(after.values()) == list(range(1, len(after) + 1))
    old = lake.gold_table("fact_sales").filter(F.col("sale_date") < "2012-01-01")
    assert old.count() == 100
