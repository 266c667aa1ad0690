"""Every registered query against its SQL, and what the driver expects of the entry points."""

from __future__ import annotations

import sys

import pytest
from compare import difference

from __spark_entry__ import entry, oracle_sql, queries
from lakestar.plans.oracles import ORACLES
from lakestar.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("gone", ["corpus_pipeline", "lakestar.llm"])
def test_entry_points_without_the_training_data_part(monkeypatch, gone):
    for name in [n for n in sys.modules if n.startswith(gone)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, gone, None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline" if gone != "corpus_pipeline" else "none", raising=False)
    assert set(queries()) == set(QUERIES) and set(oracle_sql()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, folder, name):
    assert difference(spark, folder, name) is None


def test_entry(spark):
    report = entry(spark)
    assert report.columns == ["category", "sale_year", "total_sales"]
    rows = [tuple(r) for r in report.collect()]
    assert rows == sorted(rows, key=lambda r: (r[1], -r[2])) and rows
