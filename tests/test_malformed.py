"""Malformed landing lines, counts taken in the writing tasks, and bounded micro-batches."""

from __future__ import annotations

import os

import pytest
from sample import raw_rows, write_csv

from lakestar.plans import ingest as ingest_module
from lakestar.plans.ingest import batch_quality, ingest, refine, write_silver
from lakestar.plans.load import load_full, load_increment
from lakestar.sources.landing import header_of
from lakestar.sources.ledger import BRONZE
from lakestar.sources.tables import Lake
from lakestar.specs import RAW_COLUMNS
from lakestar.streaming.ingest import run_available, to_bronze, to_gold


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    return Lake(spark, str(tmp_path))


def deliver(lake, name, rows, *lines):
    path = os.path.join(lake.landing, name)
    write_csv(path, rows)
    with open(path, "a") as file:
        file.write("".join(f"{line}\r\n" for line in lines))


def field(row, **changed):
    return ",".join(str("" if v is None else v) for v in (row | changed).values())


def broken_lines():
    row = {c: r for c, r in raw_rows(1, seed=8)[0].items() if c in RAW_COLUMNS} | {"email_name": "x", "city": "y"}
    row = {c: row[c] for c in RAW_COLUMNS}
    return [field(row, units="many"), "2012-01-01,too,few", field(row) + ",one too many", field(row, unit_price="1.2.3")]


def quality(lake):
    return {(r.batch_id, r["item"]): r.row_count for r in batch_quality(lake).collect()}


def test_rows_and_malformed_lines_add_up(lake):
    bad = broken_lines()
    deliver(lake, "one.csv", raw_rows(30), *bad[:3])
    deliver(lake, "two 2.csv", raw_rows(20, seed=2), bad[3])
    deliver(lake, "clean.csv", raw_rows(7, seed=3))
    assert ingest(lake) == [1]
    assert lake.bronze_sales().count() == 57
    got = {(r.source_file, r.line, r.batch_id) for r in lake.malformed_lines().collect()}
    assert got == {("one.csv", line, 1) for line in bad[:3]} | {("two 2.csv", bad[3], 1)}
    entries = {r["item"]: r.row_count for r in lake.ledger.entries(BRONZE).collect()}
    assert entries == {"one.csv": 30, "two 2.csv": 20, "clean.csv": 7}
    assert quality(lake) == {(1, "malformed_lines"): 4}


def test_a_batch_without_malformed_lines_has_no_entry(lake):
    deliver(lake, "one.csv", raw_rows(10))
    ingest(lake)
    assert quality(lake) == {} and lake.malformed_lines().count() == 0


def test_only_malformed_lines(lake):
    deliver(lake, "one.csv", [], *broken_lines())
    assert ingest(lake) == [1] and refine(lake) == [1]
    assert lake.bronze_sales().count() == 0 and lake.malformed_lines().count() == 4
    assert quality(lake)[1, "malformed_lines"] == 4 and quality(lake)[1, "rows"] == 0
    load_increment(lake)
    assert lake.gold_table("fact_sales").count() == 0


def test_an_unreadable_date_is_not_malformed(lake):
    deliver(lake, "one.csv", [dict(r, sale_date="31/12/2011") for r in raw_rows(5)])
    ingest(lake)
    refine(lake)
    assert lake.malformed_lines().count() == 0 and quality(lake)[1, "null_sale_date"] == 5


def test_lines_of_an_attempt_that_was_lost_are_not_read(lake, monkeypatch):
    deliver(lake, "one.csv", raw_rows(10), *broken_lines())
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "record_bronze", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest(lake)
    assert lake.malformed_lines().count() == 0
    ingest(lake)
    assert lake.malformed_lines().count() == 4 and lake.bronze_sales().count() == 10


def test_a_stream_sets_malformed_lines_aside(lake):
    deliver(lake, "one.csv", raw_rows(30), *broken_lines())
    run_available(lake, header_of(lake.spark, lake.landing), to_gold)
    assert lake.bronze_sales().count() == 30 == lake.gold_table("fact_sales").count()
    assert lake.malformed_lines().count() == 4 and quality(lake)[1, "malformed_lines"] == 4


# --- counts


real = Lake.read_parts


def test_writing_and_recording_a_batch_reads_nothing_again(lake, monkeypatch):
    """Neither bronze nor silver is read to be counted: their folders are asked for by no one."""
    read = []
    monkeypatch.setattr(Lake, "read_parts", lambda self, path, *a: read.append(path) or real(self, path, *a))
    deliver(lake, "one.csv", raw_rows(30))
    ingest(lake)
    assert read == []
    rows = lake.bronze_sales()
    read.clear()
    from lakestar.operators.silver import clean

    write_silver(lake, clean(rows), 1)
    assert read == [] and quality(lake)[1, "rows"] == 30


def test_loading_reads_the_fact_it_wrote_never_and_silver_once_for_it(lake, monkeypatch):
    deliver(lake, "one.csv", raw_rows(60))
    ingest(lake)
    refine(lake)
    read = []
    monkeypatch.setattr(Lake, "read_parts", lambda self, path, *a: read.append(path) or real(self, path, *a))
    load_full(lake)
    assert not [p for p in read if "fact_sales" in p] and read.count(lake.silver) == 1
    assert quality(lake)[1, "rows_offered"] == 60 == quality(lake)[1, "rows_loaded"]


def test_counts_of_rows_that_are_read_twice_by_one_plan(lake):
    """A gathered month is split over tasks and files, and every row is counted once."""
    deliver(lake, "big.csv", raw_rows(3000))
    for gather in (True, False):
        stored = ingest_module.write_bronze(
            lake, ingest_module.read_landing(lake.spark, lake.landing, malformed=True), 1, 1, gather
        )
        assert stored.rows == {"big.csv": 3000} and stored.malformed == 0


def test_more_files_than_said_are_refused(lake):
    for i in range(40):
        deliver(lake, f"{i}.csv", raw_rows(2, seed=i))
    rows = ingest_module.read_landing(lake.spark, lake.landing, malformed=True)
    assert len(ingest_module.write_bronze(lake, rows, 1, 40).rows) == 40
    with pytest.raises(RuntimeError, match="more than the 3 files"):
        ingest_module.write_bronze(lake, rows, 1, 3)


# --- admission


def test_a_backlog_passes_in_bounded_batches(lake):
    for i in range(7):
        deliver(lake, f"f{i}.csv", raw_rows(10, seed=i))
    header = header_of(lake.spark, lake.landing)
    run_available(lake, header, max_files=3)
    sizes = lake.ledger.entries(BRONZE).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [1, 3, 3]
    assert lake.bronze_sales().count() == 70


def test_a_backlog_is_bounded_by_bytes(lake):
    for i in range(4):
        deliver(lake, f"f{i}.csv", raw_rows(50, seed=i))
    size = os.path.getsize(os.path.join(lake.landing, "f0.csv"))
    run_available(lake, header_of(lake.spark, lake.landing), max_bytes=2 * size + size // 2)
    sizes = lake.ledger.entries(BRONZE).groupBy("batch_id").count().collect()
    assert len(sizes) >= 2 and lake.bronze_sales().count() == 200


def test_a_restart_between_batches_of_a_backlog(lake):
    """The second of three micro-batches is lost before it is recorded; what was done is not done again."""
    for i in range(6):
        deliver(lake, f"f{i}.csv", raw_rows(10, seed=i))
    header = header_of(lake.spark, lake.landing)
    done = []

    def step(lake, rows, source, stamp):
        if len(done) == 1 and source not in done:
            done.append(source)
            raise OSError("lost")
        to_bronze(lake, rows, source, stamp)
        done.append(source)

    with pytest.raises(Exception, match="lost"):
        run_available(lake, header, step, max_files=2)
    assert lake.bronze_sales().count() == 20
    run_available(lake, header, step, max_files=2)
    assert lake.bronze_sales().count() == 60 and lake.ledger.last_batch(BRONZE) == 3
    taken = [r["item"] for r in lake.ledger.entries(BRONZE).collect()]
    assert sorted(taken) == [f"f{i}.csv" for i in range(6)]


def test_one_bound_at_a_time(lake):
    from lakestar.sources.landing import stream_landing

    with pytest.raises(ValueError, match="not by both"):
        stream_landing(lake.spark, lake.landing, RAW_COLUMNS, max_files=1, max_bytes=1)
