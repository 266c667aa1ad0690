"""The registered queries, by name. Each takes a session and a folder of test tables.

Queries that write use a lake of their own in the shared folder and return what they read
back. Decimals are returned as doubles and dates as text, which print alike everywhere.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.functions.calendar import later_than, up_to
from lakestar.functions.money import money
from lakestar.operators.analytics import load_check, sales_by_category_year, sales_by_year
from lakestar.operators.dimensions import (
    build_dimension,
    build_dimensions,
    latest_members,
    stamped,
    upsert,
    with_parent_key,
)
from lakestar.operators.colocated import stage_rows
from lakestar.operators.fact import build_fact_colocated, rejects
from lakestar.operators.incremental import mark_of, slice_after
from lakestar.operators.lookup import Lookup
from lakestar.operators.silver import clean, clean_as_text, with_period
from lakestar.plans.ingest import batch_quality, ingest, new_files, refine, write_silver
from lakestar.plans.load import compact_fact, load_full, load_increment, mark_from_footers, star
from lakestar.plans.periods import bronze_months, deliver_months, in_months, silver_months
from lakestar.session import freeing_shuffles, fresh_folder, staged
from lakestar.sources import catalog
from lakestar.sources.buckets import Buckets
from lakestar.sources.fixture import CUT, sales, tables
from lakestar.sources.landing import header_of, read_landing, rows_per_file
from lakestar.sources.ledger import BRONZE, SILVER, few_rows
from lakestar.sources.tables import Lake, read_table, with_place, write_table
from lakestar.specs import (
    BATCH,
    CATEGORY,
    CUSTOMER,
    FACT,
    FACT_FILE_ROWS,
    FACT_LOOKUPS,
    FACT_MEASURES,
    GEOGRAPHY,
    MANUFACTURER,
    PERIOD,
    PRODUCT,
    ROW_PLACE,
    SEGMENT,
    SILVER_FILE_ROWS,
    STAMP,
    Dimension,
)
from lakestar.streaming.ingest import run_available, to_bronze, to_gold

Query = Callable[[SparkSession, str], DataFrame]

# The test sales end in 2001, so the load check of the queries asks for later than this.
CHECK_AFTER = 1997
CHECK_FAILS = 2001
LOADED_AT = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, order kept."""
    shown = {
        T.DecimalType: lambda c: F.col(c).cast("double").alias(c),
        T.DateType: lambda c: F.col(c).cast("string").alias(c),
    }
    return df.select(
        *[shown.get(type(f.dataType), F.col)(f.name) for f in df.schema.fields]
    )


def silver(spark: SparkSession, folder: str, few: bool = False) -> DataFrame:
    return clean(sales(spark, folder, few=few))


def new_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, fresh_folder(spark, label))


def lake_with(spark: SparkSession, label: str, rows: DataFrame) -> Lake:
    """A lake whose first silver batch holds the rows."""
    lake = new_lake(spark, label)
    write_silver(lake, rows, 1, LOADED_AT)
    return lake


def silver_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Silver to be written to a partitioned table."""
    return clean(sales(spark, folder, by_month=True))


def later_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The sales after the cut, to be written to a partitioned table. They are few, so joins begin with their orders."""
    return clean(sales(spark, folder, by_month=True, few=True)).filter(later_than(CUT))


def later_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The raw sales after the cut, to be delivered."""
    return sales(spark, folder, few=True).filter(F.col("sale_date") > F.lit(CUT))


def loaded_lake(spark: SparkSession, folder: str, label: str) -> Lake:
    lake = lake_with(spark, label, silver_by_month(spark, folder))
    load_full(lake, max_records_per_file=FACT_FILE_ROWS)
    return lake


def lake_in_two_loads(spark: SparkSession, folder: str, label: str) -> Lake:
    """Sales up to the cut loaded in full, the later ones as an increment."""
    lake = lake_with(spark, label, silver_by_month(spark, folder).filter(up_to(CUT)))
    load_full(lake)
    write_silver(lake, later_silver(spark, folder), 2, LOADED_AT)
    load_increment(lake, stamp=LOADED_AT)
    return lake


def published(spark: SparkSession, label: str, table: DataFrame) -> DataFrame:
    """Write a dimension and read it back."""
    path = fresh_folder(spark, label)
    write_table(table, path)
    return read_table(spark, path, table.schema)


# --- sources and bronze


@query
def scan_provenance(spark, folder):
    """Rows per source file, for every table the sales come from."""
    return reduce(DataFrame.unionByName, [rows_per_file(t) for t in tables(spark, folder).values()])


@query
def distinct_source_files(spark, folder):
    """The names of the files that gave rows to a batch."""
    return scan_provenance(spark, folder).select("source_file").distinct()


def _deliver(lake: Lake, rows: DataFrame, compression: str = "gzip") -> None:
    """Headed CSV files, a file per task. Compressed ones are read by one task each; few large files should not be."""
    with freeing_shuffles(rows.sparkSession):
        rows.write.mode("append").option("header", True).option("compression", compression).csv(lake.landing)


@query
def landing_csv_scan(spark, folder):
    """Sales written as headed CSV files and read back with types."""
    lake = new_lake(spark, "landing")
    _deliver(lake, sales(spark, folder))
    rows = read_landing(spark, lake.landing).drop("source_file")
    cents = {c: money(F.col(c)) for c in ("unit_price", "unit_cost")}
    return plain(rows.withColumns(cents).withColumn("order_id", F.col("order_id").cast("long")))


@query
def malformed_lines(spark, folder):
    """A delivery in which some units and prices are no numbers: rows kept, lines set aside, both counted."""
    lake = new_lake(spark, "malformed")
    no_units, no_price = F.col("product_id") % 7 == 0, F.col("order_id") % 11 == 0
    broken = sales(spark, folder).withColumns(
        {
            "units": F.when(no_units, "many").otherwise(F.col("units").cast("string")),
            "unit_price": F.when(no_price, "n/a").otherwise(F.col("unit_price").cast("string")),
        }
    )
    _deliver(lake, broken)
    ingest(lake, LOADED_AT)
    kept = lake.bronze_sales().agg(F.lit("rows_kept").alias("item"), F.count("*").alias("row_count"))
    recorded = lake.ledger.entries(BRONZE).agg(F.lit("rows_recorded").alias("item"), F.sum("row_count").alias("row_count"))
    lines = lake.malformed_lines().agg(
        F.count("*").alias("lines_kept"),
        F.count_if(F.col("line").contains(",many,")).alias("lines_without_units"),
        F.count_if(F.col("line").contains(",n/a,")).alias("lines_without_price"),
    )
    counted = batch_quality(lake).select("item", "row_count")
    return reduce(
        DataFrame.unionByName, [kept, recorded, lines.unpivot([], lines.columns, "item", "row_count"), counted]
    )


@query
def bronze_partitioned_roundtrip(spark, folder):
    """Rows and units per year and month of the partitioned bronze table."""
    path = fresh_folder(spark, "bronze")
    write_table(with_period(sales(spark, folder, by_month=True)), path, partition_by=PERIOD)
    return read_table(spark, path).groupBy(*PERIOD).agg(
        F.count("*").alias("row_count"), F.sum("units").alias("units")
    )


# --- silver


@query
def silver_clean(spark, folder):
    return plain(silver(spark, folder))


@query
def silver_text_format(spark, folder):
    """Money as text, totals null where the price text has a comma."""
    return plain(
        clean_as_text(sales(spark, folder)).select(
            "order_id",
            "product_id",
            "manufacturer_id",
            "units",
            F.col("unit_price").alias("unit_price_text"),
            F.col("unit_cost").alias("unit_cost_text"),
            F.col("total_sales").alias("total_sales_text"),
        )
    )


@query
def silver_partitioned_roundtrip(spark, folder):
    """Rows and totals per year and month of the partitioned silver table."""
    path = fresh_folder(spark, "silver")
    write_table(
        silver_by_month(spark, folder),
        path,
        partition_by=PERIOD,
        max_records_per_file=SILVER_FILE_ROWS,
    )
    return plain(
        read_table(spark, path)
        .groupBy(*PERIOD)
        .agg(F.count("*").alias("row_count"), F.sum("total_sales").alias("total_sales"))
    )


#: The month that is delivered again.
AGAIN = (2000, 6)


@query
def period_redelivery(spark, folder):
    """A month is delivered again, twice, with fewer rows and other units: it alone changes, and once."""
    lake = new_lake(spark, "months")
    deliver_months(lake, sales(spark, folder, by_month=True), gather=False)
    month = in_months([AGAIN])
    rows = sales(spark, folder, few=True)  # of one month
    again = staged(with_period(rows).filter(month & (F.col("product_id") % 3 != 0)).drop(*PERIOD), "again")
    for _ in range(2):
        deliver_months(lake, again.withColumn("units", F.col("units") * 2))
    bronze = bronze_months(lake).groupBy(*PERIOD).agg(F.count("*").alias("bronze_rows"), F.sum("units").alias("units"))
    total = F.sum("total_sales").alias("total_sales")
    clean_rows = silver_months(lake).groupBy(*PERIOD).agg(F.count("*").alias("silver_rows"), total)
    return plain(bronze.join(clean_rows, list(PERIOD)))


# --- dimensions


def _dimension(spec: Dimension) -> Query:
    def run(spark, folder):
        rows = silver(spark, folder)
        return published(spark, spec.name, build_dimension(rows, spec))

    run.__name__ = spec.name
    return query(run)


for _spec in (PRODUCT, CATEGORY, SEGMENT, MANUFACTURER, GEOGRAPHY):
    _dimension(_spec)


@query
def dim_customer(spark, folder):
    """Customers with the key of their place; a null district is a place like others."""
    table = build_dimensions(silver(spark, folder), [CUSTOMER])[CUSTOMER.name]
    return published(spark, CUSTOMER.name, table)


@query
def dim_customer_null_unsafe(spark, folder):
    """As ``dim_customer``, but a null in the place leaves the customer without one (key null)."""
    rows = silver(spark, folder)
    table = build_dimensions(rows, [CUSTOMER], null_safe=False)[CUSTOMER.name]
    return published(spark, CUSTOMER.name, table)


# --- fact


@query
def fact_sales(spark, folder):
    """The fact of a full load: silver, six dimensions and the fact written, the fact read."""
    lake = loaded_lake(spark, folder, "fact")
    return plain(lake.gold_table(FACT).drop(STAMP))


#: Sales that one bucket should hold: a task sorts, writes and joins a bucket.
BUCKET_ROWS = 1_000_000


def _rows_of(lake: Lake) -> int:
    """How many rows silver has, from the ledger."""
    counted = lake.ledger.entries(SILVER).filter(F.col("item") == "rows")
    return counted.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]


@query
def fact_by_buckets(spark, folder):
    """The fact with customers looked up in buckets: sales and members lie alike, sales are not shuffled for it."""
    lake = lake_with(spark, "buckets", silver_by_month(spark, folder))
    tables_now = {name: staged(t, name) for name, t in build_dimensions(lake.silver_sales()).items()}
    count = max(8, math.ceil(_rows_of(lake) / BUCKET_ROWS))
    buckets = Buckets(spark, _database(lake), f"{lake.root}/buckets", count)
    lookup = Lookup(CUSTOMER.name, tables_now[CUSTOMER.name], (CUSTOMER.lookup,), CUSTOMER.sk)
    needed = ["sale_date", *[d.lookup for d in FACT_LOOKUPS], *FACT_MEASURES, *PERIOD]
    rows = stage_rows(with_place(lake.silver_sales()).select(*needed, ROW_PLACE), lookup, buckets)
    return plain(build_fact_colocated(rows, lookup, tables_now, buckets).drop(STAMP))


@query
def fact_rejects(spark, folder):
    """All sales against the dimensions of the first load: rows that find no key, by dimension."""
    lake = lake_with(spark, "rejects", silver_by_month(spark, folder).filter(up_to(CUT)))
    load_full(lake)
    write_silver(lake, later_silver(spark, folder), 2, LOADED_AT)
    return rejects(lake.silver_sales(), star(lake))


# --- incremental


@query
def high_water_mark(spark, folder):
    """The latest date of the fact of a first load, from the footers of its files."""
    lake = lake_with(spark, "mark", silver_by_month(spark, folder).filter(up_to(CUT)))
    load_full(lake)
    return plain(few_rows(spark, "max_sale_date date", [(mark_from_footers(lake),)]))


@query
def incremental_slice(spark, folder):
    """Sales after the mark of the first load, read from partitioned silver."""
    lake = lake_with(spark, "slice", silver_by_month(spark, folder))
    rows = lake.silver_sales()
    mark = mark_of(rows.filter(up_to(CUT)))
    return plain(slice_after(rows, mark).drop("source_file", BATCH))


@query
def dim_refresh_slice(spark, folder):
    """Products of the increment only, keys from 1: the replacing refresh."""
    rows = silver(spark, folder, few=True).filter(later_than(CUT))
    table = stamped(build_dimension(rows, PRODUCT), LOADED_AT)
    return published(spark, "refresh", table).drop(STAMP)


@query
def dim_customer_upsert(spark, folder):
    """Customers of the first load with their keys, and new ones of the increment after them."""
    wanted = [*CUSTOMER.columns, "sale_date"]
    rows = silver(spark, folder).select(*wanted, *PERIOD)
    buyers = staged(rows.dropDuplicates([*CUSTOMER.columns, "sale_date"]), "buyers")
    base = build_dimensions(buyers.filter(up_to(CUT)), [GEOGRAPHY, CUSTOMER])
    places = published(spark, "places", stamped(base[GEOGRAPHY.name], None))
    known = published(spark, "customers", stamped(base[CUSTOMER.name], None))
    later = buyers.filter(later_than(CUT))
    new_places = upsert(places, latest_members(later, GEOGRAPHY), GEOGRAPHY).added()
    incoming = with_parent_key(
        latest_members(later, CUSTOMER), CUSTOMER, places.unionByName(new_places)
    )
    return published(spark, "upsert", upsert(known, incoming, CUSTOMER).snapshot()).drop(STAMP)


@query
def fact_append_schema_evolution(spark, folder):
    """A fact written without the stamp, then appended to with it; rows by stamp present."""
    path = fresh_folder(spark, "evolution")
    fact = loaded_lake(spark, folder, "evolution-fact").gold_table(FACT).drop(STAMP)
    write_table(
        fact.filter(up_to(CUT)), path, partition_by=PERIOD, max_records_per_file=FACT_FILE_ROWS
    )
    write_table(
        stamped(fact.filter(later_than(CUT)), LOADED_AT),
        path,
        mode="append",
        partition_by=PERIOD,
        max_records_per_file=FACT_FILE_ROWS,
    )
    stored = read_table(spark, path, merge_schema=True)
    return plain(
        stored.groupBy(F.isnull(STAMP).alias("before_stamp")).agg(
            F.count("*").alias("row_count"), F.sum("total_sales").alias("total_sales")
        )
    )


@query
def fact_incremental_total(spark, folder):
    """Totals by year after a first load and an increment."""
    lake = lake_in_two_loads(spark, folder, "increment")
    return plain(sales_by_year(lake.gold_table(FACT)))


@query
def audit_stamp(spark, folder):
    """For each gold table after an increment: rows, rows it stamped, and how many stamps."""
    tables_now = star(lake_in_two_loads(spark, folder, "audit"))
    counts = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.count(STAMP).alias("stamped"),
            F.count_distinct(F.col(STAMP)).alias("stamps"),
        )
        for name, table in tables_now.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def landing_ledger(spark, folder):
    """Two deliveries ingested by the ledger: what each batch holds, and what is left to take."""
    lake = new_lake(spark, "ledger")
    rows = sales(spark, folder)
    _deliver(lake, rows.filter(F.col("sale_date") <= F.lit(CUT)))
    ingest(lake, LOADED_AT)
    _deliver(lake, later_sales(spark, folder))
    ingest(lake, LOADED_AT)
    left = new_files(lake).agg(F.count("*").alias("row_count"))
    batches = lake.ledger.entries(BRONZE).groupBy(BATCH).agg(F.sum("row_count").alias("row_count"))
    return batches.unionByName(left.withColumn(BATCH, F.lit(0).cast("long")))


# --- reports


@query
def sales_by_category_year_report(spark, folder):
    """Total sales by category and year, from the gold tables of a full load."""
    lake = loaded_lake(spark, folder, "report")
    return plain(sales_by_category_year(lake.gold_table(FACT), lake.gold_table(CATEGORY.name)))


QUERIES["sales_by_category_year"] = QUERIES.pop("sales_by_category_year_report")


@query
def sales_by_category_year_text(spark, folder):
    """The same report with money as text: rows whose total is no number add nothing."""
    rows = clean_as_text(sales(spark, folder))
    total = F.sum(F.col("total_sales").try_cast("decimal(18,2)")).alias("total_sales")
    return plain(
        rows.groupBy("category", "sale_year")
        .agg(total)
        .orderBy("sale_year", F.desc("total_sales"))
    )


@query
def sales_by_year_report(spark, folder):
    return plain(sales_by_year(loaded_lake(spark, folder, "years").gold_table(FACT)))


QUERIES["sales_by_year"] = QUERIES.pop("sales_by_year_report")


@query
def load_check_years(spark, folder):
    """The years after two thresholds that the fact holds; the load does not reach the second."""
    fact = staged(loaded_lake(spark, folder, "check").gold_table(FACT).select("sale_year"), "check-years")
    checks = [
        load_check(fact, year).select(
            F.lit(year).alias("after"), F.array_join("years", ",").alias("years"), "passed"
        )
        for year in (CHECK_AFTER, CHECK_FAILS)
    ]
    return checks[0].unionByName(checks[1])


# --- what loads lack, what lost attempts leave, and many batches as one


@query
def load_after_failed_attempt(spark, folder):
    """Attempts at silver and at the fact are left unrecorded, a newer batch comes, and all is loaded: nothing twice."""
    lake = lake_with(spark, "failed", silver_by_month(spark, folder).filter(up_to(CUT)))
    load_full(lake)
    later = staged(later_silver(spark, folder), "later")
    middle = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    lake.write_batch(later.filter(middle), lake.silver, 2, PERIOD)  # written, not recorded
    write_silver(lake, later.filter(middle), 2, LOADED_AT)
    lake.write_batch(lake.gold_table(FACT), lake.gold(FACT, 1), 2, PERIOD)
    write_silver(lake, later.filter(~middle), 3, LOADED_AT)
    load_increment(lake, late="ledger", stamp=LOADED_AT)
    counts = [
        table.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, table in star(lake).items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def compacted_fact_total(spark, folder):
    """Totals by year of a fact whose two batches were written together."""
    lake = lake_in_two_loads(spark, folder, "compact")
    compact_fact(lake, LOADED_AT)
    return plain(sales_by_year(lake.gold_table(FACT)))


@query
def batch_quality_counts(spark, folder):
    """What an increment lacked, lost and left behind: a third of its sales is undated, a third late."""
    lake = lake_with(spark, "quality", silver_by_month(spark, folder).filter(up_to(CUT)))
    load_full(lake)
    third = F.pmod("customer_id", F.lit(3))
    day, nothing = F.date_sub(F.lit(CUT), 60), F.lit(None)
    odd = (
        later_silver(spark, folder)
        .withColumn("sale_date", F.when(third == 0, nothing).when(third == 1, day).otherwise(F.col("sale_date")))
        .withColumn("unit_price", F.when(F.col("product_id") % 5 == 0, nothing).otherwise(F.col("unit_price")))
    )
    write_silver(lake, with_period(odd.drop(*PERIOD)), 2, LOADED_AT)
    load_increment(lake, stamp=LOADED_AT)
    return batch_quality(lake).filter(F.col(BATCH) == 2).drop(BATCH)


QUERIES["batch_quality"] = QUERIES.pop("batch_quality_counts")


# --- catalog and streams


def _database(lake: Lake) -> str:
    return "lakestar_" + lake.root.rsplit("-", 1)[-1]


@query
def register_gold_catalog(spark, folder):
    """Row counts of the gold tables, listed and read through the catalog."""
    lake = loaded_lake(spark, folder, "catalog")
    catalog.register_gold(lake, _database(lake))
    return catalog.count_registered(spark, _database(lake))


@query
def register_gold_increment(spark, folder):
    """Row counts through the catalog after a load with statistics, an increment that uses them, and a new switch."""
    lake = lake_with(spark, "switch", silver_by_month(spark, folder).filter(up_to(CUT)))
    database = _database(lake)
    load_full(lake)
    catalog.register_gold(lake, database)
    catalog.analyze_gold(lake, database)
    write_silver(lake, later_silver(spark, folder), 2, LOADED_AT)
    load_increment(lake, stamp=LOADED_AT, database=database)
    catalog.register_gold(lake, database)
    return catalog.count_registered(spark, database)


@query
def legacy_names_report(spark, folder):
    """The category report as SQL on the source names of the tables and columns."""
    lake = loaded_lake(spark, folder, "names")
    database = _database(lake)
    catalog.register_gold(lake, database)
    catalog.register_legacy_views(spark, database)
    return plain(
        spark.sql(
            f"""
            SELECT c.Categoria, f.Ano, sum(f.TotalVendas) AS SomaTotalVendas
            FROM {database}.Fato_Vendas f
            JOIN {database}.Dim_Categoria c ON f.Sk_categoria = c.Sk_categoria
            GROUP BY c.Categoria, f.Ano
            ORDER BY f.Ano, SomaTotalVendas DESC
            """
        )
    )


def _stream_twice(spark: SparkSession, folder: str, label: str, step) -> Lake:
    """Two deliveries, each followed by a run; a third run finds nothing new."""
    lake = new_lake(spark, label)
    rows = sales(spark, folder)
    _deliver(lake, rows.filter(F.col("sale_date") <= F.lit(CUT)))
    header = header_of(spark, lake.landing)
    run_available(lake, header, step, archive=True, stamp=LOADED_AT)
    _deliver(lake, later_sales(spark, folder))
    run_available(lake, header, step, archive=True, stamp=LOADED_AT)
    run_available(lake, header, step, archive=True, stamp=LOADED_AT)
    return lake


@query
def landing_stream_ingest(spark, folder):
    """Rows and units per batch and year after streaming two deliveries into bronze."""
    bronze = _stream_twice(spark, folder, "stream", to_bronze).bronze_sales()
    return bronze.groupBy(BATCH, "sale_year").agg(
        F.count("*").alias("row_count"), F.sum("units").alias("units")
    )


@query
def landing_stream_admission(spark, folder):
    """A backlog of six files streamed two files at a time: rows and units by year, and how many batches."""
    lake = new_lake(spark, "admission")
    _deliver(lake, sales(spark, folder, files=6), compression="none")
    run_available(lake, header_of(spark, lake.landing), to_bronze, stamp=LOADED_AT, max_files=2)
    years = lake.bronze_sales().groupBy("sale_year").agg(F.count("*").alias("row_count"), F.sum("units").alias("units"))
    files = lake.ledger.entries(BRONZE).groupBy(BATCH).agg(F.count("*").alias("files"))
    batches = files.agg(F.count("*").alias("batches"), F.max("files").alias("most_files"))
    few = batches.first()
    return years.select("*", F.lit(few.batches).alias("batches"), F.lit(few.most_files).alias("most_files"))


@query
def stream_to_gold_total(spark, folder):
    """Rows and totals by year of the fact after streaming two deliveries through all layers."""
    fact = _stream_twice(spark, folder, "gold", to_gold).gold_table(FACT)
    return plain(
        fact.groupBy("sale_year").agg(
            F.count("*").alias("row_count"), F.sum("total_sales").alias("total_sales")
        )
    )


@query
def landing_to_gold_report(spark, folder):
    """Files to report in batch: ingest, refine, full load, category totals."""
    lake = new_lake(spark, "whole")
    _deliver(lake, sales(spark, folder))
    ingest(lake, LOADED_AT)
    refine(lake)
    load_full(lake)
    return plain(sales_by_category_year(lake.gold_table(FACT), lake.gold_table(CATEGORY.name)))
