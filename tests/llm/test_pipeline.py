"""Every stage of the pipeline against a plain version of its rule, over all rows."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import edges
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline as pipeline  # noqa: E402
import test_decontaminate  # noqa: E402
import test_minhash  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The documents before the first stage and after each."""
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        out.append(pipeline.written(stage(spark, out[-1], folder), f"test-{name}"))
    return [x.collect() for x in out]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_and_columns(stages):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    for before, after in zip(stages[:4], stages[1:5]):
        assert list(after[0].asDict()) == COLUMNS
        assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    assert list(stages[5][0].asDict()) == [*COLUMNS, "shard", "slot"]


def test_quality_rejects_what_the_operator_rejects_and_the_base_rules(stages):
    kept = texts(stages[1])
    for doc, text in texts(stages[0]).items():
        words = (text or "").split()
        assert len(words) >= 20 or doc not in kept
    assert 0.7 * len(stages[0]) < len(kept) < len(stages[0])


def test_one_of_each_group_stays(stages):
    kept = set(texts(stages[2]))
    for group in test_minhash.brute(texts(stages[1])):
        assert len(group & kept) == 1


def test_contaminated_documents_go_and_no_others(spark, folder, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    judged = test_decontaminate.brute(list(texts(stages[2]).items()), items)
    assert set(texts(stages[3])) == {doc for doc, *_, contaminated in judged if not contaminated}


def test_the_mix_takes_whole_copies_near_the_targets(stages):
    size = {r["doc_id"]: len(r["text"].split()) for r in stages[3]}
    source = {r["doc_id"]: r["source"] for r in stages[3]}
    taken = Counter(r["doc_id"] for r in stages[4])
    assert max(taken.values()) <= 3
    words = Counter()
    for doc, n in taken.items():
        words[source[doc]] += n * size[doc]
    own = Counter()
    for doc, s in source.items():
        own[s] += size[doc]
    assert abs(sum(words.values()) - sum(own.values())) < 0.05 * sum(own.values())


def test_shards_hold_every_copy_once(stages):
    assert Counter(r["doc_id"] for r in stages[5]) == Counter(r["doc_id"] for r in stages[4])
    shards = Counter(r["shard"] for r in stages[5])
    assert set(shards) == set(range(16)) and max(shards.values()) - min(shards.values()) <= 1


def test_edges(spark, folder):
    docs = edges.clashing(edges.documents(spark).unionByName(edges.documents(spark)))
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns, name
        assert got.count() <= 2 * len(edges.rows()) * 3
        assert stage(spark, docs.limit(0), folder).count() == 0, name
