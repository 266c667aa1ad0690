"""Dimensions, fact and loads: the rules and the invariants of SURVEY section 5."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from sample import raw_rows, silver_of
from settings import settings

from lakestar.functions.calendar import later_than, up_to
from lakestar.operators.analytics import load_check, sales_by_category_year, sales_by_year
from lakestar.operators.dimensions import build_dimensions, latest_members, members, stamped, upsert
from lakestar.operators.fact import build_fact, rejects
from lakestar.operators.incremental import high_water_mark, mark_of, slice_after
from lakestar.operators.lookup import DuplicateLookupKey, Limits
from lakestar.plans.ingest import write_silver
from lakestar.plans.load import load_full, load_increment, star
from lakestar.sources.ledger import GOLD
from lakestar.sources.tables import Lake, gathered, read_table, write_table
from lakestar.specs import (
    CATEGORY,
    CUSTOMER,
    DIMENSIONS,
    FACT,
    FACT_LOOKUPS,
    FACT_LOOKUPS_BY_NAME,
    GEOGRAPHY,
    MANUFACTURER,
    PERIOD,
    PRODUCT,
)

NEVER_BROADCAST = Limits(broadcast_bytes=-1, rows_per_task=40)


def lake_of(spark, path, rows, batch_id=1) -> Lake:
    lake = Lake(spark, str(path))
    write_silver(lake, rows, batch_id)
    return lake


def resolved(tables) -> list[tuple]:
    """Fact rows with keys replaced by what they stand for."""
    rows = tables[FACT]
    for d in FACT_LOOKUPS:
        rows = rows.join(tables[d.name].select(d.sk, F.col(d.lookup).alias(f"{d.name}_value")), d.sk)
    keep = [c for c in rows.columns if not c.endswith("_sk") and c != "updated_at"]
    return sorted(map(tuple, rows.select(*sorted(keep)).collect()), key=repr)


@pytest.fixture(scope="module")
def silver(spark):
    return silver_of(spark, raw_rows(400)).cache()


def test_derived_dimensions_have_the_members_of_the_rows(silver):
    built = build_dimensions(silver)
    for spec in DIMENSIONS:
        if spec.parent is None:
            want = sorted(map(tuple, members(silver, spec).collect()), key=repr)
            got = built[spec.name].select(*spec.columns).collect()
            assert sorted(map(tuple, got), key=repr) == want, spec.name
        keys = sorted(r[spec.sk] for r in built[spec.name].select(spec.sk).collect())
        assert keys == list(range(1, len(keys) + 1))


def test_null_in_the_place(silver):
    safe = build_dimensions(silver, [CUSTOMER])[CUSTOMER.name]
    literal = build_dimensions(silver, [CUSTOMER], null_safe=False)[CUSTOMER.name]
    assert safe.filter("geography_sk is null").isEmpty()
    without = {r.customer_id for r in literal.filter("geography_sk is null").collect()}
    want = {r.customer_id for r in silver.filter("district is null").collect()}
    assert without == want and want


def test_fact_and_dimensions_agree(spark, silver, tmp_path):
    lake = lake_of(spark, tmp_path, silver)
    load_full(lake)
    tables = star(lake)
    assert tables[FACT].count() == silver.count()
    columns = ["sale_date", "units", "unit_price", "unit_cost", "total_sales", "sale_year", "sale_month"]
    values = [F.col(d.lookup).alias(f"{d.name}_value") for d in FACT_LOOKUPS]
    want = silver.select(*columns, *values)
    want = sorted(map(tuple, want.select(*sorted(want.columns)).collect()), key=repr)
    assert resolved(tables) == want


@pytest.mark.parametrize("limits", [Limits(), NEVER_BROADCAST], ids=["broadcast", "salted"])
def test_keys_and_fact_do_not_depend_on_the_join(spark, silver, limits):
    tables = {n: stamped(t, None) for n, t in build_dimensions(silver, limits=limits).items()}
    plain = {n: stamped(t, None) for n, t in build_dimensions(silver).items()}
    for name, table in tables.items():
        assert sorted(map(tuple, table.collect()), key=repr) == sorted(
            map(tuple, plain[name].collect()), key=repr
        )
    fact = build_fact(silver, tables, limits=limits)
    assert sorted(map(tuple, fact.collect()), key=repr) == sorted(
        map(tuple, build_fact(silver, plain).collect()), key=repr
    )


@pytest.mark.parametrize("seed", [11])
def test_full_load_equals_first_load_plus_increments(spark, tmp_path, seed):
    """For random cuts and shuffled input; members of the increment that are new come last."""
    rng = random.Random(seed)
    rows = raw_rows(300, seed=4)
    whole = lake_of(spark, tmp_path / "whole", silver_of(spark, rows))
    load_full(whole)
    want = resolved(star(whole))
    rng.shuffle(rows)
    silver = silver_of(spark, rows)
    first, second = sorted(dt.date(2011, 11, 1) + dt.timedelta(days=rng.randint(5, 140)) for _ in "ab")
    lake = lake_of(spark, tmp_path / "cut", silver.filter(up_to(first)))
    load_full(lake)
    keys = {d.name: {tuple(r) for r in lake.gold_table(d.name).drop("updated_at").collect()} for d in DIMENSIONS}
    write_silver(lake, silver.filter(later_than(first) & up_to(second)), 2)
    load_increment(lake)
    write_silver(lake, silver.filter(later_than(second)), 3)
    load_increment(lake, late="ledger")
    tables = star(lake)
    assert resolved(tables) == want
    for d in DIMENSIONS:
        now = {tuple(r) for r in tables[d.name].drop("updated_at").collect()}
        assert keys[d.name] <= now, f"{d.name} changed earlier keys"
        assert len(now) == star(whole)[d.name].count()
        sks = sorted(r[d.sk] for r in tables[d.name].collect())
        assert sks == list(range(1, len(sks) + 1))
    assert load_increment(lake) is None


def test_a_repeated_load_replaces_its_own_rows(spark, silver, tmp_path):
    """A load that dies before it is recorded leaves nothing that readers see."""
    lake = lake_of(spark, tmp_path, silver.filter("sale_year = 2011"))
    load_full(lake)
    loaded = lake.gold_table(FACT).count()
    write_silver(lake, silver.filter("sale_year = 2012"), 2)
    ledger = type(lake.ledger)
    record = ledger.record
    try:
        ledger.record = lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
        with pytest.raises(OSError):
            load_increment(lake)
    finally:
        ledger.record = record
    assert lake.gold_table(FACT).count() == loaded
    load_increment(lake)
    assert lake.gold_table(FACT).count() == silver.count()
    assert {r.batch_id for r in lake.ledger.entries(GOLD).collect()} == {1, 2}


def test_increment_on_an_empty_fact_takes_everything(spark, silver, tmp_path):
    lake = lake_of(spark, tmp_path, silver)
    assert mark_of(lake.gold_table(FACT)) is None
    load_increment(lake)
    assert lake.gold_table(FACT).count() == silver.count()


def test_mark_misses_late_sales_and_ledger_does_not(spark, silver, tmp_path):
    base, late = silver.filter("sale_year = 2012"), silver.filter("sale_year = 2011")
    for mode, expected in (("mark", base.count()), ("ledger", silver.count())):
        lake = lake_of(spark, tmp_path / mode, base)
        load_full(lake)
        write_silver(lake, late, 2)
        load_increment(lake, late=mode)
        assert lake.gold_table(FACT).count() == expected


def test_replacing_refresh_restarts_keys(spark, silver, tmp_path):
    lake = lake_of(spark, tmp_path, silver.filter("sale_year = 2011"))
    load_full(lake)
    later = silver.filter("sale_year = 2012 and product_id > 6")
    write_silver(lake, later, 2)
    load_increment(lake, dimensions="replace")
    products = lake.gold_table(PRODUCT.name).orderBy("product_sk").collect()
    want = sorted({r.product_id for r in later.collect()})
    assert [(r.product_id, r.product_sk) for r in products] == [(p, i + 1) for i, p in enumerate(want)]


def test_changed_member_keeps_its_key(spark, tmp_path):
    rows = raw_rows(100)
    lake = lake_of(spark, tmp_path, silver_of(spark, rows))
    load_full(lake)
    before = {r.customer_id: r for r in lake.gold_table(CUSTOMER.name).collect()}
    moved = dict(rows[0], sale_date="2013-01-01", city="Bergen", postal_code="99999", customer_id=1)
    moved["email_name"] = "(new@x.com):Name, New"
    write_silver(lake, silver_of(spark, [moved]), 2)
    stamp = dt.datetime(2013, 2, 1, tzinfo=dt.timezone.utc)
    load_increment(lake, stamp=stamp)
    after = {r.customer_id: r for r in lake.gold_table(CUSTOMER.name).collect()}
    assert after[1].customer_sk == before[1].customer_sk
    assert (after[1].full_name, after[1].email) == ("New Name", "new@x.com")
    place = lake.gold_table(GEOGRAPHY.name).filter("postal_code = '99999'").first()
    assert after[1].geography_sk == place.geography_sk
    assert after[1].updated_at is not None and before[1].updated_at is None
    assert {k: v for k, v in after.items() if k != 1} == {k: v for k, v in before.items() if k != 1}
    # the dimension has a new version; the others only gained a batch
    versions = lake.ledger.current_versions()
    at = {n: (v.version, v.batch_id) for n, v in versions.items()}
    assert at[CUSTOMER.name] == (2, 2) and at[CATEGORY.name] == (1, 2)


def test_keep_leaves_a_changed_member(spark):
    old = spark.createDataFrame([(1, "a", "x", 1, None)], "product_id long, product string, category string, product_sk long, updated_at timestamp")
    new = spark.createDataFrame([(1, "b", "x"), (None, "n", "x")], "product_id long, product string, category string")
    kept = upsert(old, new, PRODUCT, on_change="keep").snapshot().drop("updated_at").collect()
    assert {tuple(r) for r in kept} == {(1, "a", "x", 1), (None, "n", "x", 2)}
    changed = upsert(old, new, PRODUCT).snapshot().drop("updated_at").collect()
    assert {tuple(r) for r in changed} == {(1, "b", "x", 1), (None, "n", "x", 2)}


def renamed(rows):
    """The last sale of product 1 gives it another name."""
    last = dict(rows[0], product_id=1, product="Renamed", sale_date="2013-01-01")
    return [*rows, last]


def test_two_versions_of_a_product(spark, tmp_path):
    rows = renamed(raw_rows(100))
    silver = silver_of(spark, rows)
    lake = lake_of(spark, tmp_path, silver)
    with pytest.raises(DuplicateLookupKey, match="dim_product"):
        load_full(lake)
    load_full(lake, on_duplicate="fan_out")
    ones = silver.filter("product_id = 1").count()
    assert lake.gold_table(FACT).count() == len(rows) + ones
    load_full(lake, versions="latest")
    assert lake.gold_table(FACT).count() == len(rows)
    product = lake.gold_table(PRODUCT.name).filter("product_id = 1").collect()
    assert [r["product"] for r in product] == ["Renamed"]


def test_one_name_for_two_manufacturers(spark):
    rows = [dict(r, manufacturer="Same") for r in raw_rows(50)]
    silver = silver_of(spark, rows)
    tables = build_dimensions(silver)
    assert tables[MANUFACTURER.name].count() == len({r["manufacturer_id"] for r in rows})
    assert build_fact(silver, tables).count() == 50
    with pytest.raises(DuplicateLookupKey, match="dim_manufacturer"):
        build_fact(silver, tables, by=FACT_LOOKUPS_BY_NAME)


def test_latest_members(spark):
    silver = silver_of(spark, renamed(raw_rows(100)))
    latest = {r.product_id: r["product"] for r in latest_members(silver, PRODUCT).collect()}
    assert latest == {p: "Renamed" if p == 1 else f"Product {p}" for p in latest}


@pytest.mark.parametrize("limits", [Limits(), NEVER_BROADCAST], ids=["broadcast", "salted"])
def test_rejects_and_fact_add_up(spark, limits):
    rows = [dict(r, segment=None) if i % 7 == 0 else r for i, r in enumerate(raw_rows(140))]
    silver = silver_of(spark, rows)
    tables = build_dimensions(silver.filter("customer_id < 30"))
    lost = {r.dimension: r.rows_lost for r in rejects(silver, tables, limits=limits).collect()}
    known = [r for r in rows if r["customer_id"] < 30]
    assert lost["dim_segment"] == 20 and lost["dim_category"] == 0
    assert lost["dim_customer"] == len(rows) - len(known)
    kept = [r for r in known if r["segment"] is not None]
    assert build_fact(silver, tables, limits=limits).count() == len(kept)


def test_high_water_mark(spark, silver):
    assert high_water_mark(silver).columns == ["max_sale_date"]
    assert mark_of(silver) == max(r.sale_date for r in silver.collect())
    assert mark_of(silver.limit(0)) is None


def test_report_is_ordered_and_right(spark, silver):
    tables = {n: stamped(t, None) for n, t in build_dimensions(silver).items()}
    fact = build_fact(silver, tables)
    report = [tuple(r) for r in sales_by_category_year(fact, tables[CATEGORY.name]).collect()]
    totals = {}
    for r in silver.collect():
        key = (r.category, r.sale_year)
        totals[key] = totals.get(key, 0) + r.total_sales
    want = sorted(((c, y, t) for (c, y), t in totals.items()), key=lambda x: (x[1], -x[2]))
    assert report == want
    years = [tuple(r) for r in sales_by_year(fact).collect()]
    assert years == [(y, sum(t for (_, yy), t in totals.items() if yy == y)) for y in (2011, 2012)]


def test_load_check(spark, silver):
    assert load_check(silver).collect() == [([2012], True)]
    assert load_check(silver, 2012).collect() == [([], False)]
    assert load_check(silver.limit(0)).collect() == [([], False)]


def test_file_caps(spark, tmp_path):
    rows = spark.range(10).withColumn("sale_year", F.lit(2012)).coalesce(1)
    write_table(rows, str(tmp_path / "t"), partition_by=["sale_year"], max_records_per_file=3)
    assert len(list((tmp_path / "t" / "sale_year=2012").glob("*.parquet"))) == 4


def test_old_files_read_with_a_new_column(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(stamped(spark.range(2), dt.datetime(2012, 1, 1)), path, mode="append")
    merged = read_table(spark, path, merge_schema=True)
    declared = read_table(spark, path, merged.schema)
    for table in (merged, declared):
        assert table.filter("updated_at is null").count() == 3 and table.count() == 5


def test_slice_prunes_partitions(spark, silver, tmp_path):
    lake = lake_of(spark, tmp_path, silver)
    rows = slice_after(lake.silver_sales(), dt.date(2012, 2, 10))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "sale_year" in filters and "sale_month" in filters
    assert "GreaterThan(sale_date" in plan


def test_fact_join_broadcasts_and_does_not_shuffle(spark, silver, tmp_path):
    lake = lake_of(spark, tmp_path, silver)
    load_full(lake)
    fact = build_fact(lake.silver_sales(), star(lake))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 5
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_a_month_with_a_third_of_all_rows_is_written_by_many_tasks(spark, tmp_path):
    months = F.when(F.col("id") % 3 == 0, 1).otherwise(2 + F.col("id") % 11).cast("int")
    rows = spark.range(0, 600_000, 1, 16).select(
        F.sha2(F.hex("id"), 512).alias("text"), F.lit(2012).alias("sale_year"), months.alias("sale_month")
    )
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2m",
    }
    path = tmp_path / "t"
    with settings(spark, small):
        write_table(gathered(rows, *PERIOD), str(path), partition_by=PERIOD)
    files = {m: len(list(path.glob(f"sale_year=2012/sale_month={m}/*.parquet"))) for m in (1, 2)}
    assert files[1] > 4 > files[2] / 4
    assert read_table(spark, str(path)).count() == 600_000
