"""Text rules of the silver layer. Each is null for a missing part, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def email(email_name: Column) -> Column:
    """``(Mail@x):Last, First`` -> ``mail@x``: before the first colon, no parentheses, lower case."""
    mail = F.substring_index(email_name, ":", 1)
    # two literal replacements cost half of one translate or one pattern
    return F.lower(F.replace(F.replace(mail, F.lit("(")), F.lit(")")))


def full_name(email_name: Column) -> Column:
    """``(mail):Last, First`` -> ``First Last``.

    Text past a second colon or a second ``", "`` is not part of the name, nothing is
    trimmed, and a name without ``", "`` is null.
    """
    last_first = F.split(F.get(F.split(email_name, ":"), F.lit(1)), ", ")
    return F.concat(F.get(last_first, F.lit(1)), F.lit(" "), F.get(last_first, F.lit(0)))


def city_name(city: Column) -> Column:
    """``City, more`` -> ``City``."""
    return F.substring_index(city, ",", 1)


def base_name(path: Column) -> Column:
    """The last part of a path."""
    return F.regexp_extract(path, "([^/]+)$", 1)


def plain_file_name(name: Column) -> Column:
    """A file name as it is on disk, from the percent-encoded one of the file metadata.

    ``url_decode`` reads ``+`` as a space, and a ``+`` in the metadata is a real plus.
    """
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
