"""Token files: exact round trips, and documents against the tokenizer on whole texts."""

from __future__ import annotations

import random
import struct
import zlib

import edges
import numpy as np
import pyarrow as pa
import pytest

from lakestar.llm import tokenfile as t
from lakestar.session import fresh_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = "ab 's\t\n\r\x0b\x0c\x1c\x1d\x85\xa0 　éÉéΣςσ1２Ⅷ世界😀İ'<|endoftext|>.,-ſKÅ가가̀​﻿\x00ªºµ×÷ßÿÀZ"


def library(path, texts, end=2):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path).encode_batch([x or "" for x in texts], add_special_tokens=False)
    return [[*f.ids, end] for f in found]


def brute(docs, path):
    """(doc_id, start, n_tokens, crc32) of documents in order of their ids."""
    out, start = [], 0
    for (doc_id, _), ids in zip(docs, library(path, [text for _, text in docs])):
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def digests(spark, rows, path=WORDS, parts=5):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = t.round_trip(df, path, 2).select("doc_id", "start", "n_tokens", "ids_crc32")
    return sorted(map(tuple, found.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
@pytest.mark.parametrize("most", [1, 2, 300, 49_000, 2**32 - 1])
def test_blocks_give_back_their_ids(n, most):
    rng = np.random.default_rng(n + most)
    ids = rng.integers(0, most, n, dtype=np.uint32)
    ids[rng.random(n) < 0.05] = 2**32 - 1  # exceptions
    starts, blocks = t.pack(ids)
    assert (t.unpack(memoryview(blocks), starts)[:n] == ids).all() and starts.size == -(-n // t.BLOCK)


def test_rare_large_ids_do_not_widen_a_block():
    ids = np.arange(256, dtype=np.uint32) % 16
    ids[::32] = 40_000
    _, blocks = t.pack(ids)
    assert len(blocks) == struct.calcsize(t.BLOCK_HEADER) + 256 * 4 // 8 + 8 * 5


def test_a_segment_is_read_in_part_and_damage_is_found():
    ids = np.random.default_rng(3).integers(0, 50_000, 5000, dtype=np.uint32)
    said = t.segment(3, 70, [7, None], [ids[:1000].tobytes(), ids[1000:].tobytes()])
    (s,) = t.segments(said + b"\n")
    assert (s.part, s.first, s.docs, s.sizes.tolist()) == (3, 70, [7, None], [1000, 4000])
    for a, b in [(0, 1), (255, 257), (300, 300), (1000, 5000), (4990, 9999), (-5, 3)]:
        assert (s.ids_between(a, b) == ids[max(0, a) : b]).all()
    for at in (0, 40, len(said) // 2, len(said) - 1):
        with pytest.raises((ValueError, struct.error)):
            list(t.segments(said[:at] + bytes([said[at] ^ 1]) + said[at + 1 :] + b"\n"))


def test_words_apart_is_the_library_on_whole_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [x + rng.choice(["<|endoftext|>", " <|startoftext|>x", "It's. Über!?"]) for x in texts[:500]]
    encoder = t.Encoder(WORDS)
    assert encoder.apart
    for _ in range(2):  # words unknown, words known
        assert list(encoder.encode(pa.array(texts))) == encoder._library(texts)


def test_other_vocabularies_are_encoded_whole():
    encoder = t.Encoder(BYTES)
    assert not encoder.apart
    texts = ["two  spaces, and\n\nlines", None, " lead"]
    assert list(encoder.encode(pa.array(texts))) == encoder._library([x or "" for x in texts])


def test_long_texts_are_cut_between_words_only(monkeypatch):
    monkeypatch.setattr(t, "PIECE", 100)
    text = edges.LONG[:20_000] + "x" * 500 + " é" * 300
    assert b"".join(t.pieces(text.encode())) == text.encode()
    texts = ["short one", text, "", None, "after"]
    encoder = t.Encoder(WORDS)
    assert list(encoder.encode(pa.array(texts))) == encoder._library([x or "" for x in texts])


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_files_say_what_the_library_says(spark, path):
    rng = random.Random(2)
    rows = [(i * 3, " ".join(rng.choice(["alpha", "Beta!", "gämma", "d3lta"]) for _ in range(rng.randrange(60)))) for i in range(300)]
    shuffled = rng.sample(rows, len(rows))
    assert digests(spark, shuffled, path) == brute(rows, path)


def test_rows_of_all_kinds_and_the_ids_themselves(spark):
    rows = [(r[0], r[1]) for r in edges.rows()]
    got = digests(spark, rows)
    want = brute(rows, WORDS)
    assert sorted((r[0] is None, r[0] or 0, *r[2:]) for r in got) == sorted((r[0] is None, r[0] or 0, *r[2:]) for r in want)
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    path = fresh_folder(spark, "own-files")
    t.write_tokens(edges.clashing(edges.documents(spark)), path, WORDS, 2)
    read = sorted((tuple(r["ids"]) for r in t.read_tokens(spark, path).collect()))
    assert read == sorted(map(tuple, library(WORDS, [text for _, text in rows])))


def test_many_segments_and_files_and_one_id_in_a_third_of_rows(spark, monkeypatch):
    monkeypatch.setattr(t, "SEGMENT_IDS", 50)
    monkeypatch.setattr(t, "FILE_SEGMENTS", 2)
    rows = [(i, f"text number {i} " * 9) for i in range(200)] + [(50, "same text")] * 100
    got = digests(spark, rows)
    assert [r[0] for r in got] == sorted(i for i, _ in rows)
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows, WORDS))
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]


def test_an_empty_table_gives_no_rows(spark):
    assert digests(spark, []) == []
