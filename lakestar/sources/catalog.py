"""Catalog registration of the gold tables, and views under the source names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.lookup import ROW_BYTES, Lookup, Size, measure
from lakestar.sources.ledger import Current, few_rows
from lakestar.sources.tables import Lake
from lakestar.specs import ATTEMPT, BATCH, FACT, FACT_LOOKUPS, GOLD_SCHEMAS, PERIOD, Dimension

# Table and column names that existing queries on the source tables use.
LEGACY_VIEWS = {
    "Dim_Produto": (
        "dim_product",
        {
            "product_id": "IDProduto",
            "product": "Produto",
            "category": "Categoria",
            "product_sk": "Sk_produto",
            "updated_at": "data_atualizacao",
        },
    ),
    "Dim_Categoria": (
        "dim_category",
        {"category": "Categoria", "category_sk": "Sk_categoria", "updated_at": "data_atualizacao"},
    ),
    "Dim_Segmento": (
        "dim_segment",
        {"segment": "Segmento", "segment_sk": "Sk_segmento", "updated_at": "data_atualizacao"},
    ),
    "Dim_Fabricante": (
        "dim_manufacturer",
        {
            "manufacturer_id": "IDFabricante",
            "manufacturer": "Fabricante",
            "manufacturer_sk": "Sk_fabricante",
            "updated_at": "data_atualizacao",
        },
    ),
    "Dim_Geografia": (
        "dim_geography",
        {
            "city": "Cidade",
            "state": "Estado",
            "region": "Regiao",
            "district": "Distrito",
            "country": "Pais",
            "postal_code": "CodigoPostal",
            "geography_sk": "Sk_categoria",
            "updated_at": "data_atualizacao",
        },
    ),
    "Dim_Cliente": (
        "dim_customer",
        {
            "customer_id": "IDCliente",
            "full_name": "Nome",
            "email": "Email",
            "geography_sk": "Sk_categoria",
            "customer_sk": "Sk_cliente",
            "updated_at": "data_atualizacao",
        },
    ),
    "Fato_Vendas": (
        "fact_sales",
        {
            "sale_date": "DataVenda",
            "product_sk": "Sk_produto",
            "category_sk": "Sk_categoria",
            "segment_sk": "Sk_segmento",
            "manufacturer_sk": "Sk_fabricante",
            "customer_sk": "Sk_cliente",
            "units": "Unidades",
            "unit_price": "PrecoUnitario",
            "unit_cost": "CustoUnitario",
            "total_sales": "TotalVendas",
            "updated_at": "data_atualizacao",
            "sale_year": "Ano",
            "sale_month": "Mes",
        },
    ),
}


#: Table properties: that all parts of a table are there, and what its statistics were taken of.
COMPLETE = "lakestar.complete"
UNIQUE = "lakestar.unique"


def register_gold(lake: Lake, database: str) -> DataFrame:
    """Create the database and one name per gold table; return (table, path).

    A name is a view of an external table that holds exactly the folders the ledger names, which
    is made for this state of the table, filled, and only then shown: one ``CREATE OR REPLACE
    VIEW`` is the switch, so a reader sees all of the state before or all of the new one. The
    table of the state before stays for those who read it, older ones go; their files stay.
    """
    spark = lake.spark
    _run(spark, f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{lake.root}/catalog'")
    rows = []
    for table, at in sorted(lake.ledger.current_versions().items()):
        path = lake.gold(table, at.version)
        shown = _backing(spark, database, table)
        name = f"{table}{_STATE}{_state(at)}"
        if shown != name:
            _fill(lake, database, table, name, path, at, shown)
            if spark.catalog.tableExists(f"{database}.{table}") and shown is None:
                _run(spark, f"DROP TABLE {database}.{table}")  # a table of that name hides nothing: it is external
            _run(spark, f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{name}")
            for old in _backings(spark, database, table):
                if old not in (name, shown):
                    _run(spark, f"DROP TABLE IF EXISTS {database}.{old}")
        rows.append((table, path))
    return few_rows(spark, "table_name string, path string", rows)


def _run(spark: SparkSession, statement: str) -> DataFrame:
    return spark.sql(statement)


_STATE = "__state_"


def _state(at: Current) -> str:
    """What tells a table's contents from those before: its version, and its last part and their number."""
    last = at.parts[-1][1].replace("-", "_") if at.parts else "none"
    return f"v{at.version}_n{len(at.parts)}_{last}"


def _backings(spark: SparkSession, database: str, table: str) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{table}{_STATE}*'").collect()
    return [r.tableName for r in found]


def _backing(spark: SparkSession, database: str, table: str) -> str | None:
    """The table that a name shows now."""
    name = f"{database}.{table}"
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    text = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "View Text"]
    return text[0].rsplit(".", 1)[-1] if text else None


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _fill(lake: Lake, database: str, table: str, name: str, path: str, at: Current, before: str | None) -> None:
    """Make the table of one state; one that a lost run left half made is made again."""
    spark, full = lake.spark, f"{database}.{name}"
    if spark.catalog.tableExists(full):
        if _properties(spark, full).get(COMPLETE):
            return
        _run(spark, f"DROP TABLE {full}")
    inner = list(PERIOD) if table == FACT else []
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GOLD_SCHEMAS[table].fields)
    _run(
        spark,
        f"CREATE TABLE {full} ({columns}, {BATCH} bigint, {ATTEMPT} string) USING {lake.fmt} "
        f"PARTITIONED BY ({', '.join([BATCH, ATTEMPT, *inner])}) LOCATION '{path}'",
    )
    if lake.fmt == "parquet":
        # months of parts that the state before has are listed there
        known = [r.partition for r in spark.sql(f"SHOW PARTITIONS {database}.{before}").collect()] if before else []
        added = []
        for batch_id, written in at.parts:
            folder, own = lake.folder(path, batch_id, written), f"{BATCH}={batch_id}/{ATTEMPT}={written}"
            months = [k.removeprefix(own) for k in known if f"{k}/".startswith(f"{own}/")]
            for month in months or (_months(spark, folder) if inner else [""]):
                added.append(f"{_spec(own + month)} LOCATION '{folder}{month}'")
        _alter(spark, full, "ADD IF NOT EXISTS", added)
    _run(spark, f"ALTER TABLE {full} SET TBLPROPERTIES ('{COMPLETE}' = 'true')")


def analyze_gold(lake: Lake, database: str, by: Sequence[Dimension] = FACT_LOOKUPS) -> None:
    """Take statistics of the registered dimensions' lookup columns, and note which are unique.

    A load that is told the database then knows what to broadcast without a job of its own, for
    every dimension that has not changed since.
    """
    spark = lake.spark
    names = {d: _backing(spark, database, d.name) for d in by}
    fresh = {d: f"{database}.{n}" for d, n in names.items() if n and UNIQUE not in _properties(spark, f"{database}.{n}")}
    lookups = [Lookup(d.name, spark.table(name), (d.lookup,), d.sk) for d, name in fresh.items()]
    sizes = measure(lookups) if lookups else {}
    for d, name in fresh.items():
        _run(spark, f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {d.lookup}")
        size = sizes[d.name]
        # Spark's distinct counts are estimates: whether a key names several members is counted
        _run(spark, f"ALTER TABLE {name} SET TBLPROPERTIES ('{UNIQUE}' = '{d.lookup}:{size.rows - size.keys}')")


def known_sizes(
    lake: Lake, database: str, versions: dict[str, Current], by: Sequence[Dimension] = FACT_LOOKUPS
) -> dict[str, Size]:
    """Sizes of the lookups whose statistics were taken of just these contents; no job runs for them."""
    spark, found = lake.spark, {}
    for d in by:
        name = f"{database}.{d.name}{_STATE}{_state(versions[d.name])}"
        if not spark.catalog.tableExists(name):
            continue
        column, surplus = _properties(spark, name).get(UNIQUE, ":").split(":")
        if column != d.lookup:
            continue
        whole = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Statistics"]
        about = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect()}
        counted = re.search(r"(\d+) rows", whole[0] if whole else "")
        if not counted or about.get("avg_col_len") in (None, "NULL"):
            continue
        rows = int(counted[1]) - int(about["num_nulls"])
        # a number's length is that of its text in measure(); 20 is the longest
        length = int(about["avg_col_len"]) if isinstance(GOLD_SCHEMAS[d.name][column].dataType, T.StringType) else 20
        found[d.name] = Size(rows, rows - int(surplus), rows * (2 * length + ROW_BYTES))
    return found


def _spec(partition: str) -> str:
    parts = [v.split("=", 1) for v in partition.split("/")]
    return "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in parts) + ")"


def _alter(spark: SparkSession, name: str, what: str, specs: list[str]) -> None:
    """A statement for some hundred partitions at a time."""
    glue = ", " if what.startswith("DROP") else " "
    for i in range(0, len(specs), 500):
        _run(spark, f"ALTER TABLE {name} {what} {glue.join(specs[i : i + 500])}")


def _months(spark: SparkSession, folder: str) -> list[str]:
    """The year and month folders of one attempt, from its own listing."""
    year, month = PERIOD
    found = spark.read.parquet(folder).select(year, month).distinct().collect()
    shown = [["__HIVE_DEFAULT_PARTITION__" if x is None else x for x in r] for r in found]
    return [f"/{year}={y}/{month}={m}" for y, m in shown]


def registered_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the gold tables a database lists; what stands behind them, and other views, are left out."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.name in GOLD_SCHEMAS)


def count_registered(spark: SparkSession, database: str) -> DataFrame:
    """Rows per registered table, read through the catalog in one query."""
    counts = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count")
        )
        for name in registered_tables(spark, database)
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def register_legacy_views(spark: SparkSession, database: str) -> None:
    """Views that give the registered tables their source names, so old SQL runs as it is."""
    for view, (table, names) in LEGACY_VIEWS.items():
        columns = ", ".join(f"{ours} AS {theirs}" for ours, theirs in names.items())
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT {columns} FROM {database}.{table}"
        )
