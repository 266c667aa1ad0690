"""Raw sales made from the test tables: one row per order line."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession

from lakestar.sources.tables import gathered_by_month

TABLES = ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")

# Where the fixture splits into a first load and an increment.
CUT = dt.date(2001, 6, 30)

# What the checking engine runs.
ORDER_LINES_SQL = """
select o_orderkey, o_orderdate, o_custkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_discount
from {lineitem}
join {orders} on l_orderkey = o_orderkey
"""
SALES_SQL = """
with places as (
  select n_nationkey, concat(n_name, ', ', r_name) as city, n_name as state, r_name as region,
         case when n_nationkey % 5 = 0 then null else concat('D', cast(n_nationkey % 5 as string)) end as district,
         r_name as country, lpad(cast(n_nationkey as string), 5, '0') as postal_code
  from {nation} join {region} on n_regionkey = r_regionkey
), buyers as (
  select c_custkey as customer_id, c_mktsegment as segment,
         concat('(', replace(c_name, '#', '.'), '@EXAMPLE.com):', split_part(c_name, '#', 2), ', ', split_part(c_name, '#', 1)) as email_name,
         city, state, region, district, country, postal_code
  from {customer} join places on c_nationkey = n_nationkey
)
select o_orderkey as order_id, l_linenumber as campaign_id,
       cast(o_orderdate as date) as sale_date, email_name,
       city, state, region, district, country, postal_code,
       p_partkey as product_id, p_name as product, p_type as category, segment,
       s_suppkey as manufacturer_id, s_name as manufacturer, customer_id,
       cast(l_quantity as int) as units,
       l_extendedprice / l_quantity as unit_price,
       l_extendedprice * (1 - l_discount) / l_quantity as unit_cost
from {order_lines} as order_lines
join buyers on o_custkey = customer_id
join {part} on l_partkey = p_partkey
join {supplier} on l_suppkey = s_suppkey
"""


# The same rows on Spark. Whatever is larger than a table of places goes through shuffles, so rows stay narrow up
# to the last one: customers come with their orders, of which there are fewer than lines; what a
# customer's names and place are made of goes along, and texts are put together at the end.
BUYERS_ORDERS_SQL = """
select o_orderkey, cast(o_orderdate as date) as sale_date, c_custkey, c_name, c_mktsegment, c_nationkey
from {orders} join {customer} on o_custkey = c_custkey
"""
NARROW_COLUMNS = """
select o_orderkey, sale_date, c_custkey, c_name, c_mktsegment, c_nationkey,
       l_linenumber, p_partkey, p_name, p_type, s_suppkey, s_name, l_quantity, l_extendedprice, l_discount
"""
# Orders first: if few of them are wanted, few lines meet their parts.
NARROW_SALES_SQL = (
    NARROW_COLUMNS
    + """
from {lineitem}
join {buyers_orders} on l_orderkey = o_orderkey
join {part} on l_partkey = p_partkey
join {supplier} on l_suppkey = s_suppkey
"""
)
# Orders last: the lines of an order lie side by side in what follows, and what they share takes little room there.
SALES_BY_ORDER_SQL = (
    NARROW_COLUMNS
    + """
from {lineitem}
join {part} on l_partkey = p_partkey
join {buyers_orders} on l_orderkey = o_orderkey
join {supplier} on l_suppkey = s_suppkey
"""
)
# The same for a number of files: the join with the orders is the last that deals rows out.
LINES_SQL = """
select l_orderkey, l_linenumber, p_partkey, p_name, p_type, s_suppkey, s_name, l_quantity, l_extendedprice, l_discount
from {lineitem}
join {part} on l_partkey = p_partkey
join {supplier} on l_suppkey = s_suppkey
"""
SALES_IN_PARTS_SQL = NARROW_COLUMNS + "from {lines} join {buyers_orders} on l_orderkey = o_orderkey"
NAMED_SALES_SQL = """
with places as (
  select n_nationkey, concat(n_name, ', ', r_name) as city, n_name as state, r_name as region,
         case when n_nationkey % 5 = 0 then null else concat('D', cast(n_nationkey % 5 as string)) end as district,
         r_name as country, lpad(cast(n_nationkey as string), 5, '0') as postal_code
  from {nation} join {region} on n_regionkey = r_regionkey
)
select /*+ broadcast(places) */
       o_orderkey as order_id, l_linenumber as campaign_id, sale_date,
       concat('(', replace(c_name, '#', '.'), '@EXAMPLE.com):', split_part(c_name, '#', 2), ', ', split_part(c_name, '#', 1)) as email_name,
       city, state, region, district, country, postal_code,
       p_partkey as product_id, p_name as product, p_type as category, c_mktsegment as segment,
       s_suppkey as manufacturer_id, s_name as manufacturer, c_custkey as customer_id,
       cast(l_quantity as int) as units,
       l_extendedprice / l_quantity as unit_price,
       l_extendedprice * (1 - l_discount) / l_quantity as unit_cost
from {narrow} join places on c_nationkey = n_nationkey
"""


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES}


def sales(
    spark: SparkSession, folder: str, by_month: bool = False, few: bool = False, files: int | None = None
) -> DataFrame:
    """Raw sales; ``by_month`` for those to be written to a partitioned table.

    They are gathered by month after all joins of large tables, each of which deals rows out anew, and
    before their texts are put together. ``few``: a filter on the date will leave few of them. ``files``:
    that many tasks write them, each some pieces of the last join one after the other, so that no shuffle
    is made for it. The rows are the same, joined in another order.
    """
    found = tables(spark, folder)
    take = lambda *names: {t: found[t] for t in names}
    orders = spark.sql(BUYERS_ORDERS_SQL, **take("orders", "customer"))
    if files:
        pieces = files * math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / files)
        lines = spark.sql(LINES_SQL, **take("lineitem", "part", "supplier")).repartition(pieces, "l_orderkey")
        narrow = spark.sql(SALES_IN_PARTS_SQL, lines=lines, buyers_orders=orders.repartition(pieces, "o_orderkey"))
    else:
        joins = NARROW_SALES_SQL if few else SALES_BY_ORDER_SQL
        narrow = spark.sql(joins, buyers_orders=orders, **take("lineitem", "part", "supplier"))
    if by_month:
        narrow = gathered_by_month(narrow, "sale_date")
    named = spark.sql(NAMED_SALES_SQL, narrow=narrow, **take("nation", "region"))
    return named.coalesce(files) if files else named
