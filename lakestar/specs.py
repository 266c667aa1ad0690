"""What the tables are: columns, types, keys. Builders take these instead of repeating them."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# File caps that users of the original jobs rely on.
SILVER_FILE_ROWS = 50_000
FACT_FILE_ROWS = 1_000_000

# The year a load has to reach to pass the default check.
CHECK_YEAR = 2011

# Source column names accepted in a landing header, and their engine names.
SOURCE_NAMES = {
    "Data": "sale_date",
    "EmailNome": "email_name",
    "Cidade": "city",
    "PrecoUnitario": "unit_price",
    "CustoUnitario": "unit_cost",
    "Unidades": "units",
    "IdCampanha": "campaign_id",
    "IDProduto": "product_id",
    "Produto": "product",
    "Categoria": "category",
    "Segmento": "segment",
    "IDFabricante": "manufacturer_id",
    "Fabricante": "manufacturer",
    "Estado": "state",
    "Regiao": "region",
    "Distrito": "district",
    "Pais": "country",
    "CodigoPostal": "postal_code",
    "IDCliente": "customer_id",
}

RAW_TYPES = {
    "sale_date": T.DateType(),
    "email_name": T.StringType(),
    "city": T.StringType(),
    "unit_price": T.DoubleType(),
    "unit_cost": T.DoubleType(),
    "units": T.IntegerType(),
    "campaign_id": T.IntegerType(),
    "product_id": T.LongType(),
    "product": T.StringType(),
    "category": T.StringType(),
    "segment": T.StringType(),
    "manufacturer_id": T.LongType(),
    "manufacturer": T.StringType(),
    "state": T.StringType(),
    "region": T.StringType(),
    "district": T.StringType(),
    "country": T.StringType(),
    "postal_code": T.StringType(),
    "customer_id": T.LongType(),
}
RAW_COLUMNS = tuple(RAW_TYPES)

PERIOD = ("sale_year", "sale_month")
STAMP = "updated_at"
BATCH = "batch_id"
ATTEMPT = "attempt"
#: Column that tells rows of a scan apart, see ``sources.tables.with_place``.
ROW_PLACE = "__row"

SILVER_TYPES = {
    "sale_date": T.DateType(),
    "email": T.StringType(),
    "full_name": T.StringType(),
    **{
        name: kind
        for name, kind in RAW_TYPES.items()
        if name not in ("sale_date", "email_name", "campaign_id")
    },
    "unit_price": MONEY,
    "unit_cost": MONEY,
    "total_sales": MONEY,
    "source_file": T.StringType(),
    "sale_year": T.IntegerType(),
    "sale_month": T.IntegerType(),
}


def struct(types: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


BRONZE_SCHEMA = struct(
    {
        **RAW_TYPES,
        "source_file": T.StringType(),
        "sale_year": T.IntegerType(),
        "sale_month": T.IntegerType(),
        BATCH: T.LongType(),
    }
)
SILVER_SCHEMA = struct({**SILVER_TYPES, BATCH: T.LongType()})
MALFORMED_SCHEMA = struct(
    {**RAW_TYPES, "source_file": T.StringType(), "line": T.StringType(), BATCH: T.LongType()}
)


@dataclass(frozen=True)
class Dimension:
    """A dimension: the silver columns it takes and how its members are told apart.

    ``key`` identifies a member when new data meets old; ``lookup`` is the column the fact
    joins on. A ``parent`` dimension replaces its own columns here by its surrogate key.
    """

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    sk: str
    lookup: str | None = None
    parent: Dimension | None = None

    @property
    def attributes(self) -> tuple[str, ...]:
        """Published columns except the surrogate key, parent columns already replaced."""
        if self.parent is None:
            return self.columns
        own = tuple(c for c in self.columns if c not in self.parent.columns)
        return (*own, self.parent.sk)

    @property
    def schema(self) -> T.StructType:
        types = {c: SILVER_TYPES.get(c, T.LongType()) for c in self.attributes}
        return struct({**types, self.sk: T.LongType(), STAMP: T.TimestampType()})


PRODUCT = Dimension(
    "dim_product",
    columns=("product_id", "product", "category"),
    key=("product_id",),
    sk="product_sk",
    lookup="product_id",
)
CATEGORY = Dimension(
    "dim_category", columns=("category",), key=("category",), sk="category_sk", lookup="category"
)
SEGMENT = Dimension(
    "dim_segment", columns=("segment",), key=("segment",), sk="segment_sk", lookup="segment"
)
MANUFACTURER = Dimension(
    "dim_manufacturer",
    columns=("manufacturer_id", "manufacturer"),
    key=("manufacturer_id",),
    sk="manufacturer_sk",
    lookup="manufacturer_id",
)
#: As the original jobs join it: a manufacturer that changes its name loses the sales under the other.
MANUFACTURER_BY_NAME = replace(MANUFACTURER, lookup="manufacturer")
GEOGRAPHY = Dimension(
    "dim_geography",
    columns=("city", "state", "region", "district", "country", "postal_code"),
    key=("city", "state", "region", "district", "country", "postal_code"),
    sk="geography_sk",
)
CUSTOMER = Dimension(
    "dim_customer",
    columns=("customer_id", "full_name", "email", *GEOGRAPHY.columns),
    key=("customer_id",),
    sk="customer_sk",
    lookup="customer_id",
    parent=GEOGRAPHY,
)

DIMENSIONS = (PRODUCT, CATEGORY, SEGMENT, MANUFACTURER, GEOGRAPHY, CUSTOMER)

# A dimension whose columns all lie in another one's is read off that one's members, which
# are few, instead of off the sales rows. The set of members is the same.
DERIVED_FROM = {CATEGORY: PRODUCT, GEOGRAPHY: CUSTOMER}

FACT = "fact_sales"
FACT_LOOKUPS = (PRODUCT, CATEGORY, SEGMENT, MANUFACTURER, CUSTOMER)
FACT_LOOKUPS_BY_NAME = (PRODUCT, CATEGORY, SEGMENT, MANUFACTURER_BY_NAME, CUSTOMER)
FACT_MEASURES = ("units", "unit_price", "unit_cost", "total_sales")
FACT_SCHEMA = struct(
    {
        "sale_date": T.DateType(),
        **{d.sk: T.LongType() for d in FACT_LOOKUPS},
        **{m: SILVER_TYPES[m] for m in FACT_MEASURES},
        STAMP: T.TimestampType(),
        "sale_year": T.IntegerType(),
        "sale_month": T.IntegerType(),
    }
)

GOLD_SCHEMAS = {**{d.name: d.schema for d in DIMENSIONS}, FACT: FACT_SCHEMA}
