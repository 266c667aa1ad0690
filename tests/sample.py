"""Small hand-made sales for tests."""

from __future__ import annotations

import csv
import datetime as dt
import random

from lakestar.specs import RAW_COLUMNS, SOURCE_NAMES

PLACES = [
    ("Lyon, France", "Rhone", "East", "D1", "France", "00007"),
    ("Oslo", "Oslo", "North", None, "Norway", "01234"),
    ("Porto, Portugal", "Porto", "West", "D3", "Portugal", "40000"),
]


def raw_rows(count: int = 300, seed: int = 1, first: dt.date = dt.date(2011, 11, 1)) -> list[dict]:
    """Sales over some months; a third of them from one customer."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        customer = 1 if rng.random() < 1 / 3 else rng.randint(2, 40)
        city, state, region, district, country, postal = PLACES[customer % 3]
        product = rng.randint(1, 12)
        maker = product % 4 + 1
        rows.append(
            {
                "sale_date": (first + dt.timedelta(days=rng.randint(0, 150))).isoformat(),
                "email_name": f"(C{customer}@X.com):Last{customer}, First{customer}",
                "city": city,
                "unit_price": round(rng.uniform(1, 3000), 3),
                "unit_cost": round(rng.uniform(1, 2000), 3),
                "units": rng.randint(1, 9),
                "campaign_id": rng.randint(1, 5),
                "product_id": product,
                "product": f"Product {product}",
                "category": f"Category {product % 3}",
                "segment": f"Segment {product % 2}",
                "manufacturer_id": maker,
                "manufacturer": f"Maker {maker}",
                "state": state,
                "region": region,
                "district": district,
                "country": country,
                "postal_code": postal,
                "customer_id": customer,
            }
        )
    return rows


def write_csv(path, rows: list[dict], header=RAW_COLUMNS, source_names: bool = False) -> None:
    theirs = {ours: name for name, ours in SOURCE_NAMES.items()}
    with open(path, "w", newline="") as file:
        out = csv.writer(file)
        out.writerow([theirs[h] if source_names else h for h in header])
        out.writerows([["" if r[h] is None else r[h] for h in header] for r in rows])


def silver_of(spark, rows: list[dict]):
    from lakestar.operators.silver import clean
    from lakestar.specs import RAW_TYPES, struct
    from pyspark.sql import types as T

    schema = struct({**RAW_TYPES, "sale_date": T.StringType()})
    return clean(spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], schema))
