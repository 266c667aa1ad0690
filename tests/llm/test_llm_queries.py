"""The registered queries against their SQL, or against what their operator's test compares with."""

from __future__ import annotations

import pytest
from compare import difference

from __spark_entry__ import oracle_sql, queries
from lakestar.llm.oracles import ORACLES
from lakestar.llm.queries import QUERIES

COLUMNS = {
    "op1_minhash": {"doc_id", "group_id"},
    "op2_suffixes": {"doc_id", "start_word", "end_word", "copies", "is_first"},
    "op3_pitman_yor": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op5_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op7_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"},
    "op12_token_file": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op9_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) == set(ORACLES) | set(COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, name):
    assert difference(spark, folder, name) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows_of_the_others(spark, folder, name):
    got = QUERIES[name](spark, folder)
    assert set(got.columns) == COLUMNS[name] and "void" not in dict(got.dtypes).values()
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert name == "op2_suffixes" or got.count() == documents
