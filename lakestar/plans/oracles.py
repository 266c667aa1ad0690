"""For each registered query, SQL that gives the same rows on the same tables."""

from __future__ import annotations

from lakestar.plans.queries import AGAIN, CHECK_AFTER, CHECK_FAILS
from lakestar.sources.fixture import CUT, ORDER_LINES_SQL, SALES_SQL, TABLES

CUT_DATE = f"date '{CUT.isoformat()}'"

_NAMES = {t: t for t in TABLES}
SALES = SALES_SQL.format(order_lines=f"({ORDER_LINES_SQL.format(**_NAMES)})", **_NAMES)

SILVER_FROM_SALES = """
select order_id, sale_date,
       lower(regexp_replace(string_split(email_name, ':')[1], '[()]', '', 'g')) as email,
       nm[2] || ' ' || nm[1] as full_name,
       string_split(city, ',')[1] as city, state, region, district, country, postal_code,
       product_id, product, category, segment, manufacturer_id, manufacturer, customer_id,
       units, p2 as unit_price, c2 as unit_cost,
       cast(p2 * units as decimal(18,2)) as total_sales,
       cast(year(sale_date) as int) as sale_year, cast(month(sale_date) as int) as sale_month
from (
  select *, cast(replace(format('{:,.2f}', unit_price), ',', '') as decimal(18,2)) as p2,
            cast(replace(format('{:,.2f}', unit_cost), ',', '') as decimal(18,2)) as c2,
            string_split(string_split(email_name, ':')[2], ', ') as nm
  from sales)
"""

TEXT_FROM_SALES = """
select order_id, product_id, manufacturer_id, category, units, price as unit_price_text,
       cost as unit_cost_text,
       format('{:,.2f}', try_cast(price as double) * units) as total_sales_text,
       cast(year(sale_date) as int) as sale_year
from (
  select *, format('{:,.2f}', unit_price) as price, format('{:,.2f}', unit_cost) as cost
  from sales)
"""

GEO = ("city", "state", "region", "district", "country", "postal_code")


def _with(body: str, **ctes: str) -> str:
    head = ", ".join(f"{name} as ({text})" for name, text in ctes.items())
    return f"with {head} {body}"


def on_sales(body: str, **ctes: str) -> str:
    return _with(body, sales=SALES, **ctes)


def on_silver(body: str, **ctes: str) -> str:
    return _with(body, sales=SALES, silver=SILVER_FROM_SALES, **ctes)


def _order(columns) -> str:
    return ", ".join(f"{c} nulls first" for c in columns)


def _dimension(columns, key: str, source: str = "silver") -> str:
    names = ", ".join(columns)
    return (
        f"select {names}, row_number() over (order by {_order(columns)}) as {key} "
        f"from (select distinct {names} from {source})"
    )


def _customers(source: str, same: str) -> str:
    columns = ("customer_id", "full_name", "email", *GEO)
    match = " and ".join(f"c.{g} {same} g.{g}" for g in GEO)
    return (
        f"select customer_id, full_name, email, geography_sk, customer_sk "
        f"from ({_dimension(columns, 'customer_sk', source)}) c left join "
        f"({_dimension(GEO, 'geography_sk', source)}) g on {match}"
    )


def _star(source: str = "silver") -> dict[str, str]:
    return {
        "dim_product": _dimension(("product_id", "product", "category"), "product_sk", source),
        "dim_category": _dimension(("category",), "category_sk", source),
        "dim_segment": _dimension(("segment",), "segment_sk", source),
        "dim_manufacturer": _dimension(
            ("manufacturer_id", "manufacturer"), "manufacturer_sk", source
        ),
        "dim_geography": _dimension(GEO, "geography_sk", source),
        "dim_customer": _customers(source, "is not distinct from"),
    }


LOOKUPS = {
    "dim_product": "product_id",
    "dim_category": "category",
    "dim_segment": "segment",
    "dim_manufacturer": "manufacturer_id",
    "dim_customer": "customer_id",
}

FACT = """
select sale_date, product_sk, category_sk, segment_sk, manufacturer_sk, customer_sk, units,
       unit_price, unit_cost, total_sales, sale_year, sale_month
from silver
join (select product_id, product_sk from dim_product) using (product_id)
join dim_category using (category)
join dim_segment using (segment)
join (select manufacturer_id, manufacturer_sk from dim_manufacturer) using (manufacturer_id)
join (select customer_id, customer_sk from dim_customer) using (customer_id)
"""

MONEY = "cast(sum(total_sales) as double) as total_sales"

CATEGORY_REPORT = on_silver(
    f"select c.category, f.sale_year, {MONEY} from fact f "
    "join dim_category c on f.category_sk = c.category_sk group by 1, 2",
    **_star(),
    fact=FACT,
)

BASE = f"select * from silver where sale_date <= {CUT_DATE}"
LATER = f"select * from silver where sale_date > {CUT_DATE}"


def _provenance(select: str) -> str:
    return " union all ".join(
        select.format(name=f"'{t}.parquet' as source_file", table=t) for t in TABLES
    )


def _new_members() -> str:
    keys = {
        "dim_product": "product_id",
        "dim_category": "category",
        "dim_segment": "segment",
        "dim_manufacturer": "manufacturer_id",
        "dim_geography": "(" + ", ".join(f"coalesce({g}, '')" for g in GEO) + ")",
        "dim_customer": "customer_id",
    }
    parts = [
        f"select '{table}' as table_name, (select count(distinct {key}) from silver) as row_count, "
        f"(select count(distinct {key}) from later where {key} not in "
        f"(select {key} from base)) as stamped"
        for table, key in keys.items()
    ]
    parts.append(
        "select 'fact_sales', (select count(*) from silver), (select count(*) from later)"
    )
    return " union all ".join(parts)


def _with_cents(columns: str) -> str:
    return (
        f"select order_id, sale_date_text as sale_date, {columns}, units, "
        "cast(replace(format('{:,.2f}', unit_price), ',', '') as double) as unit_price, "
        "cast(replace(format('{:,.2f}', unit_cost), ',', '') as double) as unit_cost "
        "from (select *, strftime(sale_date, '%Y-%m-%d') as sale_date_text from sales)"
    )


SILVER_ROWS = (
    "select * replace (strftime(sale_date, '%Y-%m-%d') as sale_date, "
    "cast(unit_price as double) as unit_price, cast(unit_cost as double) as unit_cost, "
    "cast(total_sales as double) as total_sales) from "
)

ORACLES: dict[str, str] = {
    "scan_provenance": _provenance("select {name}, count(*) as row_count from {table}"),
    "distinct_source_files": _provenance("select distinct {name} from {table}"),
    "landing_csv_scan": on_sales(
        _with_cents(
            "campaign_id, email_name, city, state, region, district, country, postal_code, "
            "product_id, product, category, segment, manufacturer_id, manufacturer, customer_id"
        )
    ),
    "malformed_lines": on_sales(
        "select unnest(['rows_kept', 'rows_recorded', 'lines_kept', 'lines_without_units', 'lines_without_price', "
        "'malformed_lines']) as item, unnest([n - bad, n - bad, bad, no_units, no_price, bad]) as row_count from ("
        "select count(*) as n, count(*) filter (product_id % 7 = 0 or order_id % 11 = 0) as bad, "
        "count(*) filter (product_id % 7 = 0) as no_units, count(*) filter (order_id % 11 = 0) as no_price from sales)"
    ),
    "period_redelivery": on_silver(
        "select sale_year, sale_month, count(*) as bronze_rows, cast(sum(units) as bigint) as units, "
        f"count(*) as silver_rows, {MONEY} from delivered group by 1, 2",
        delivered="select * from silver where not (sale_year = {0} and sale_month = {1}) union all "
        "select * replace (units * 2 as units, total_sales * 2 as total_sales) from silver "
        "where sale_year = {0} and sale_month = {1} and product_id % 3 <> 0".format(*AGAIN),
    ),
    "bronze_partitioned_roundtrip": on_sales(
        "select cast(year(sale_date) as int) as sale_year, "
        "cast(month(sale_date) as int) as sale_month, count(*) as row_count, "
        "cast(sum(units) as bigint) as units from sales group by 1, 2"
    ),
    "silver_clean": on_silver(SILVER_ROWS + "silver"),
    "silver_text_format": on_sales(
        "select order_id, product_id, manufacturer_id, units, unit_price_text, unit_cost_text, "
        "total_sales_text from texts",
        texts=TEXT_FROM_SALES,
    ),
    "silver_partitioned_roundtrip": on_silver(
        f"select sale_year, sale_month, count(*) as row_count, {MONEY} from silver group by 1, 2"
    ),
    **{name: on_silver(text) for name, text in _star().items()},
    "dim_customer_null_unsafe": on_silver(
        _customers("silver", "=")
    ),
    "fact_sales": on_silver(SILVER_ROWS + f"({FACT})", **_star()),
    "fact_by_buckets": on_silver(SILVER_ROWS + f"({FACT})", **_star()),
    "fact_rejects": on_silver(
        " union all ".join(
            f"select '{table}' as dimension, count(*) as rows_lost from silver s where not exists "
            f"(select 1 from base b where b.{key} = s.{key})"
            for table, key in LOOKUPS.items()
        ),
        base=BASE,
    ),
    "high_water_mark": on_silver(
        "select strftime(max(sale_date), '%Y-%m-%d') as max_sale_date from base", base=BASE
    ),
    "incremental_slice": on_silver(
        "select * exclude (order_id) from ("
        + SILVER_ROWS
        + "silver where sale_date > (select max(sale_date) from base))",
        base=BASE,
    ),
    "dim_refresh_slice": on_silver(
        _dimension(("product_id", "product", "category"), "product_sk", "later"), later=LATER
    ),
    "dim_customer_upsert": on_silver(
        "select * from old union all "
        "select customer_id, full_name, email, geography_sk, "
        "(select max(customer_sk) from old) + row_number() over (order by customer_id) "
        "from (select distinct customer_id, full_name, email, geography_sk from later l "
        "left join places g on "
        + " and ".join(f"l.{g} is not distinct from g.{g}" for g in GEO)
        + " where customer_id not in (select customer_id from old))",
        base=BASE,
        later=LATER,
        places=_dimension(GEO, "geography_sk", "base"),
        old=_customers("base", "is not distinct from"),
    ),
    "fact_append_schema_evolution": on_silver(
        f"select sale_date <= {CUT_DATE} as before_stamp, count(*) as row_count, {MONEY} "
        "from fact group by 1",
        **_star(),
        fact=FACT,
    ),
    "fact_incremental_total": on_silver(f"select sale_year, {MONEY} from silver group by 1"),
    "audit_stamp": on_silver(
        "select *, cast(least(stamped, 1) as bigint) as stamps from members",
        base=BASE,
        later=LATER,
        members=_new_members(),
    ),
    "landing_ledger": on_sales(
        "select cast(1 as bigint) as batch_id, "
        f"cast(count(*) as bigint) as row_count from sales where sale_date <= {CUT_DATE} "
        f"union all select 2, count(*) from sales where sale_date > {CUT_DATE} "
        "union all select 0, 0"
    ),
    "sales_by_category_year": CATEGORY_REPORT,
    "landing_to_gold_report": CATEGORY_REPORT,
    "legacy_names_report": (
        'select category as "Categoria", sale_year as "Ano", total_sales as "SomaTotalVendas" '
        f"from ({CATEGORY_REPORT})"
    ),
    "sales_by_category_year_text": on_sales(
        "select category, sale_year, "
        "cast(sum(try_cast(total_sales_text as decimal(18,2))) as double) as total_sales "
        "from texts group by 1, 2",
        texts=TEXT_FROM_SALES,
    ),
    "sales_by_year": on_silver(f"select sale_year, {MONEY} from fact group by 1", **_star(), fact=FACT),
    "load_check_years": on_silver(
        " union all ".join(
            f"select {year} as after, coalesce(string_agg(sale_year::varchar, ',' order by sale_year), '') as years, "
            f"count(*) > 0 as passed from (select distinct sale_year from fact where sale_year > {year})"
            for year in (CHECK_AFTER, CHECK_FAILS)
        ),
        **_star(),
        fact=FACT,
    ),
    "load_after_failed_attempt": on_silver(
        " union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {name}" for name in _star()
        )
        + " union all select 'fact_sales', count(*) from fact",
        **_star(),
        fact=FACT,
    ),
    "compacted_fact_total": on_silver(f"select sale_year, {MONEY} from silver group by 1"),
    "batch_quality": on_silver(
        "select unnest(['rows', 'null_sale_date', 'null_unit_price', 'null_unit_cost', 'null_units', "
        "'left_late', 'rows_offered', 'rows_loaded']) as item, "
        "unnest([n, undated, unpriced, cast(0 as bigint), cast(0 as bigint), late, n - late, n - late]) as row_count from ("
        "select count(*) as n, count(*) filter (customer_id % 3 = 0) as undated, "
        "count(*) filter (product_id % 5 = 0) as unpriced, count(*) filter (customer_id % 3 = 1) as late from later)",
        later=LATER,
    ),
    "register_gold_catalog": on_silver(
        " union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {name}" for name in _star()
        )
        + " union all select 'fact_sales', count(*) from fact",
        **_star(),
        fact=FACT,
    ),
    "register_gold_increment": on_silver(
        " union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {name}" for name in _star()
        )
        + " union all select 'fact_sales', count(*) from fact",
        **_star(),
        fact=FACT,
    ),
    "landing_stream_admission": on_sales(
        "select cast(year(sale_date) as int) as sale_year, count(*) as row_count, cast(sum(units) as bigint) as units, "
        "cast(3 as bigint) as batches, cast(2 as bigint) as most_files from sales group by 1"
    ),
    "landing_stream_ingest": on_sales(
        f"select cast(case when sale_date <= {CUT_DATE} then 1 else 2 end as bigint) as batch_id, "
        "cast(year(sale_date) as int) as sale_year, count(*) as row_count, "
        "cast(sum(units) as bigint) as units from sales group by 1, 2"
    ),
    "stream_to_gold_total": on_silver(
        f"select sale_year, count(*) as row_count, {MONEY} from silver group by 1"
    ),
}
