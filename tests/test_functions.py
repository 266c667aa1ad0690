"""Scalar rules, on values that exercise each of them, with ANSI mode on and off."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F
from settings import settings

from lakestar.functions import calendar, money, text


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def session(spark, request):
    with settings(spark, {"spark.sql.ansi.enabled": request.param}):
        yield spark


def evaluate(spark, values, kind, expression):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in rows.select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, email, name",
    [
        ("(Ann.Lee@X.com):Lee, Ann", "ann.lee@x.com", "Ann Lee"),
        ("((a)@x):L, F", "a@x", "F L"),
        ("a@x: Lee, Ann", "a@x", "Ann  Lee"),
        ("a@x:Lee, Ann:more", "a@x", "Ann Lee"),
        ("a@x:Lee, Ann, Dr", "a@x", "Ann Lee"),
        ("a@x:Lee Ann", "a@x", None),
        ("a@x:Lee,Ann", "a@x", None),
        ("Just text", "just text", None),
        ("", "", None),
        (None, None, None),
    ],
)
def test_contact(session, raw, email, name):
    assert evaluate(session, [raw], "string", text.email) == [email]
    assert evaluate(session, [raw], "string", text.full_name) == [name]


def test_city(session):
    got = evaluate(session, ["Lyon, France", "Lyon", ", x", None], "string", text.city_name)
    assert got == ["Lyon", "Lyon", "", None]


def test_file_names(session):
    names = ["vendas%202012.csv", "a+b.csv", "plain.csv"]
    got = evaluate(session, names, "string", text.plain_file_name)
    assert got == ["vendas 2012.csv", "a+b.csv", "plain.csv"]
    assert evaluate(session, ["s3://b/c/d.csv", "d.csv"], "string", text.base_name) == ["d.csv"] * 2


CASES = [0.125, 0.135, 2.675, 0.375, 999.995, 1234.565, -1234.5, -0.125, 0.0, 1e12 + 0.125]


def test_money(session):
    # Decimal(v) is the exact value of the double
    want = [Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_EVEN) for v in CASES]
    assert evaluate(session, CASES, "double", money.money) == want
    assert evaluate(session, CASES, "double", money.money_text) == [f"{w:,}" for w in want]


def test_money_of_no_number(session):
    assert evaluate(session, [None, float("nan"), float("inf")], "double", money.money) == [None] * 3


def test_money_equals_its_text_on_many_values(spark):
    """The short way and the way through text agree: ties, near ties, all magnitudes."""
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 15) for _ in range(20_000)]
    values += [rng.randint(-(10**9), 10**9) / 1000 for _ in range(20_000)]
    values += [rng.randint(-(10**12), 10**12) / 8 for _ in range(20_000)]
    values += [(rng.randint(0, 10**8) + 0.5) / 100 for _ in range(20_000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    by_text = F.replace(money.money_text(F.col("v")), F.lit(","), F.lit("")).cast("decimal(18,2)")
    assert rows.filter(~money.money(F.col("v")).eqNullSafe(by_text)).count() == 0


def test_number_in_text(session):
    got = evaluate(session, ["12.50", "1,234.57", "x", None], "string", money.number_in_text)
    assert got == [12.5, None, None, None]


def test_dates(session):
    values = ["2012-03-04", "04/03/2012", "2012-13-01", "", None]
    got = evaluate(session, values, "string", calendar.iso_date)
    assert got == [dt.date(2012, 3, 4), None, None, None, None]


@pytest.mark.parametrize("mark", [dt.date(2011, 12, 31), dt.date(2012, 2, 29), dt.date(2012, 5, 1)])
def test_mark_splits_dated_sales(spark, mark):
    days = [dt.date(2011, 10, 1) + dt.timedelta(days=i) for i in range(400)]
    rows = spark.createDataFrame([(d,) for d in days], "sale_date date").withColumns(
        calendar.period(F.col("sale_date"))
    )
    later = {r.sale_date for r in rows.filter(calendar.later_than(mark)).collect()}
    earlier = {r.sale_date for r in rows.filter(calendar.up_to(mark)).collect()}
    assert later == {d for d in days if d > mark}
    assert earlier == {d for d in days if d <= mark}
    assert rows.filter(calendar.later_than(None)).count() == len(days)
