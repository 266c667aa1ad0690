"""Money: two decimals, rounded half to even on the exact value of the double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestar.specs import MONEY


def money_text(amount: Column) -> Column:
    """``1234.565`` -> ``'1,234.56'``."""
    return F.format_number(amount, 2)


def money(amount: Column) -> Column:
    """The value :func:`money_text` shows, as a decimal that can be added and multiplied.

    Only near a tie does the exact value of the double decide, and only there, or where cents
    are too many for a double, is the text made and read. Elsewhere the nearest cent is the
    same and costs a fraction.
    """
    cents = amount * 100
    far_from_tie = F.abs(cents - F.floor(cents) - 0.5) > 1e-4
    in_range = F.abs(cents) < 1e11
    by_text = F.replace(money_text(amount), F.lit(","), F.lit("")).try_cast(MONEY)
    return F.when(in_range & far_from_tie, (F.rint(cents) / 100).cast(MONEY)).otherwise(by_text)


def line_total(unit_price: Column, units: Column) -> Column:
    """Price times units; the price is rounded before, not the product after."""
    return (unit_price * units).cast(MONEY)


def number_in_text(text: Column) -> Column:
    """A money text as a number, null where the text has a thousands comma."""
    return text.try_cast("double")
