"""Session settings for the length of a ``with`` block."""

from __future__ import annotations

from contextlib import contextmanager


@contextmanager
def settings(spark, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key)
            if value is not None:
                spark.conf.set(key, value)
