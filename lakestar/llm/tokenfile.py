"""Token ids in binary files of patched frame-of-reference blocks.

Documents are sorted by id over all tasks, encoded, and written by Spark's own committed writer,
so a lost executor leaves no half file among the others. A file is a row of segments; a segment
holds whole documents, one at least:

====================  ======================================================================
``header``            magic, part and place of the segment's first id in its part, numbers of
                      documents, ids and blocks, bytes of all blocks
document ids          int64 each, then one byte each: whether there is one
document sizes        uint32 each: ids of the document, its end id included
block starts          uint32 each: first byte of a block, counted from the first block
blocks                256 ids each (the last one padded): least id (uint32), width (uint8), number
                      of exceptions (uint16); ids less the least one in ``width`` bits each;
                      places (uint8) and values (uint32, less the least id) of the exceptions
check                 crc32 of all that, and a line feed
====================  ======================================================================

A block's width is the number of bits that nine in ten of its ids need; ids that need more are
exceptions. Numbers are little-endian. The starts allow for reading some blocks alone (``ids_between``).
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.llm.common import col, written
from lakestar.session import fresh_folder

BLOCK = 256
#: Share of a block's ids that its width must hold.
SHARE = 0.9
#: Ids after which a segment ends with the document at hand, and segments of one file.
SEGMENT_IDS = 1 << 18
FILE_SEGMENTS = 32
#: Bytes of text that are cut into words at a time.
PIECE = 4 << 20
#: Words whose ids a worker process remembers (some 50 MB), and the length of the longest.
KNOWN_WORDS, LONG_WORD = 1 << 18, 64
MAGIC = b"LSTK"
HEADER = "<4sIQIQII"
BLOCK_HEADER = "<IBH"
SPACE = b" \t\n\r\x0b\x0c"


# ---- ids to bytes and back


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers as rows of bytes, ``width`` bits a number."""
    rows, n = values.shape
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(rows, n, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(rows, n * width), axis=1, bitorder="little")


def _numbers(packed: np.ndarray, width: int) -> np.ndarray:
    """What ``_bits`` packed into rows of one block each."""
    rows = len(packed)
    bits = np.zeros((rows, BLOCK, 32), np.uint8)
    if width:
        bits[:, :, :width] = np.unpackbits(packed, axis=1, count=BLOCK * width, bitorder="little").reshape(rows, BLOCK, width)
    return np.packbits(bits, axis=2, bitorder="little").view("<u4").reshape(rows, BLOCK)


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts, and the blocks."""
    blocks = -(-ids.size // BLOCK)
    if not blocks:
        return np.zeros(0, "<u4"), b""
    padded = np.full(blocks * BLOCK, ids[-1], np.uint32)
    padded[: ids.size] = ids
    grid = padded.reshape(blocks, BLOCK)
    least = grid.min(axis=1)
    over = grid - least[:, None]
    need = np.frexp(over.astype(np.float64))[1]  # bits of each number
    width = np.sort(need, axis=1)[:, int(np.ceil(SHARE * BLOCK)) - 1]
    beyond = need > width[:, None]
    out: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        bits = _bits(np.where(beyond[own], 0, over[own]), int(w))
        for b, row in zip(own, bits):
            places = np.flatnonzero(beyond[b])
            head = struct.pack(BLOCK_HEADER, int(least[b]), int(w), places.size)
            out[b] = head + row.tobytes() + places.astype(np.uint8).tobytes() + over[b][places].astype("<u4").tobytes()
    sizes = np.array([len(b) for b in out])
    return (np.cumsum(sizes) - sizes).astype("<u4"), b"".join(out)


def unpack(blocks: memoryview, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that start there, padding included."""
    heads = [struct.unpack_from(BLOCK_HEADER, blocks, s) for s in starts.tolist()]
    out = np.empty((len(heads), BLOCK), np.uint32)
    width = np.array([w for _, w, _ in heads], np.int64)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        size = BLOCK * int(w) // 8
        first = starts[own].astype(np.int64) + struct.calcsize(BLOCK_HEADER)
        data = np.frombuffer(blocks, np.uint8)
        out[own] = _numbers(data[first[:, None] + np.arange(size)], int(w))
    for b, (least, w, n) in enumerate(heads):
        if n:
            at = int(starts[b]) + struct.calcsize(BLOCK_HEADER) + BLOCK * w // 8
            out[b, np.frombuffer(blocks, np.uint8, n, at)] = np.frombuffer(blocks, "<u4", n, at + n)
        out[b] += np.uint32(least)
    return out.reshape(-1)


@dataclass
class Segment:
    part: int
    first: int
    docs: list[int | None]
    sizes: np.ndarray
    n_ids: int
    starts: np.ndarray
    blocks: memoryview

    def ids(self) -> np.ndarray:
        return unpack(self.blocks, self.starts)[: self.n_ids]

    def ids_between(self, start: int, stop: int) -> np.ndarray:
        """Ids at places ``start`` to ``stop`` of the segment; only their blocks are read."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        low = start // BLOCK
        found = unpack(self.blocks, self.starts[low : -(-stop // BLOCK)])
        return found[start - low * BLOCK : stop - low * BLOCK]


def segment(part: int, first: int, docs: list[int | None], ids: list[bytes]) -> bytes:
    """One segment without its line feed; ``ids`` are little-endian uint32 of each document."""
    whole = np.frombuffer(b"".join(ids), "<u4")
    starts, blocks = pack(whole)
    head = struct.pack(HEADER, MAGIC, part, first, len(docs), whole.size, starts.size, len(blocks))
    numbers = np.array([0 if d is None else d for d in docs], "<i8").tobytes()
    known = bytes(d is not None for d in docs)
    sizes = np.array([len(i) // 4 for i in ids], "<u4").tobytes()
    said = head + numbers + known + sizes + starts.tobytes() + blocks
    return said + struct.pack("<I", zlib.crc32(said))


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of one file."""
    view, at = memoryview(content), 0
    while at < len(content):
        magic, part, first, n_docs, n_ids, n_blocks, size = struct.unpack_from(HEADER, view, at)
        docs_at = at + struct.calcsize(HEADER)
        sizes_at = docs_at + 9 * n_docs
        starts_at = sizes_at + 4 * n_docs
        blocks_at = starts_at + 4 * n_blocks
        end = blocks_at + size
        if magic != MAGIC or struct.unpack_from("<I", view, end)[0] != zlib.crc32(view[at:end]):
            raise ValueError(f"no whole segment at byte {at}")
        known = view[docs_at + 8 * n_docs : sizes_at].tolist()
        docs = [d if k else None for d, k in zip(np.frombuffer(view, "<i8", n_docs, docs_at).tolist(), known)]
        sizes = np.frombuffer(view, "<u4", n_docs, sizes_at)
        yield Segment(part, first, docs, sizes, n_ids, np.frombuffer(view, "<u4", n_blocks, starts_at), view[blocks_at:end])
        at = end + 5  # the check and the line feed


# ---- texts to ids


def words_apart(spec: dict) -> bool:
    """Whether a tokenizer encodes a text as it encodes the words between its ASCII white space.

    So it is if white space parts tokens and is dropped, and nothing looks across it: the normalizers
    compose characters and lower them one by one, the text is split by a pattern whose matches hold no
    white space, no token is added around, and special strings hold none and take none. Letters
    and the marks after them are then encoded apart, too, and letters as their lower-case form.
    """
    space = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    normal = {"type": "Sequence", "normalizers": [{"type": "NFC"}, space, {"type": "Lowercase"}]}
    # fixed value: what splits this vocabulary's texts
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True}
    as_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    return (
        spec["normalizer"] == normal
        and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [split, as_bytes]}
        and spec["post_processor"] is None
        and not spec["model"].get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        and all(t["content"].split() == [t["content"]] for t in spec["added_tokens"])
    )


def _gathered(flat: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (of these sizes, one after the other) that ``own`` asks for, and where each ends."""
    starts = np.cumsum(sizes) - sizes
    n = sizes[own]
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if ends.size else 0) + np.repeat(starts[own] - (ends - n), n)], ends


class Encoder:
    """Ids of texts; words are encoded once and remembered where the tokenizer allows for that."""

    #: Letters that case and composition change one by one, and marks that are encoded apart from them.
    word = r"^(?P<letters>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<marks>[.,;:!?]*)$"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            self.apart = words_apart(json.load(file))
        self.known: dict[bytes, bytes] = {b"": b""}

    @classmethod
    def of_process(cls, path: str) -> Encoder:
        """One encoder per file and worker process: what a task has met, later ones know."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        kept = sys.modules.setdefault("lakestar_encoders", types.ModuleType("lakestar_encoders")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words; one of lower-case ASCII letters is a single piece, which the model takes as it is."""
        plain = [w for w in words if w.isalpha() and w.islower()]
        found = {w: array("I", [t.id for t in self.model.tokenize(w.decode())]).tobytes() for w in plain}
        others = [w for w in words if w not in found]
        return found | dict(zip(others, self._library([w.decode("utf-8", "replace") for w in others])))

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has."""
        words = words.cast(pa.binary()).to_pylist()
        ids = list(map(self.known.get, words))
        new = self._new([w for w, i in zip(words, ids) if i is None])
        ids = [new[w] if i is None else i for w, i in zip(words, ids)]
        if len(self.known) < KNOWN_WORDS:  # the words met first are the frequent ones: they stay
            self.known.update((w, i) for w, i in new.items() if len(w) <= LONG_WORD)
        return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _texts(self, texts: pa.Array) -> list[bytes]:
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        whole = words.dictionary
        split = pc.extract_regex(whole, self.word)
        letters, marks = (pc.struct_field(split, name) for name in ("letters", "marks"))
        stems = pc.if_else(split.is_valid(), pc.utf8_lower(letters), whole)
        units = pa.concat_arrays([stems, pc.if_else(split.is_valid(), marks, "")]).dictionary_encode()
        flat, sizes = self._ids(units.dictionary)
        both = units.indices.to_numpy().reshape(2, -1)
        flat, ends = _gathered(flat, sizes, both.T.reshape(-1))  # each distinct word: its letters, its marks
        flat, ends = _gathered(flat, np.diff(ends[1::2], prepend=0), words.indices.to_numpy())
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])]
        return [flat[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian uint32 ids of each whole text; null is an empty one."""
        if not self.apart:
            for text in texts.cast(pa.binary()):
                yield self._library([(text.as_py() or b"").decode("utf-8", "replace")])[0]
            return
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        at = 0
        while at < len(texts):
            stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), PIECE)))
            if sizes[at] > PIECE:
                whole = texts[at].cast(pa.binary()).as_py()
                yield b"".join([i for piece in pieces(whole) for i in self._texts(as_text([piece]))])
                stop = at + 1
            else:
                yield from self._texts(pc.fill_null(texts.slice(at, stop - at), ""))
            at = stop


def as_text(texts: list[bytes]) -> pa.Array:
    """Bytes as strings, unchecked."""
    return pa.array(texts, pa.binary()).view(pa.string())


def pieces(text: bytes, size: int | None = None) -> Iterator[bytes]:
    """A text cut at white space, ``size`` bytes or the word that crosses them at a time."""
    at = 0
    while at < len(text):
        end = at + (size or PIECE)
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[at:end]
        at = end


# ---- tables to files and back


def write_tokens(
    df: DataFrame, path: str, tokenizer: str, end_id: int | None = None, text: str = "text", doc_id: str = "doc_id"
) -> None:
    """Encode all texts and write them to files under ``path``, by ascending ``doc_id``.

    ``tokenizer`` is a file of the tokenizers library, at the same place on every executor. Texts are
    encoded whole, special strings in them as the library does by default, nothing is added but
    ``end_id``. A null text is an empty one; null ids come first; rows of one id are ordered by their
    texts, repeated rows are all kept. An empty table gives no segment. Other columns are not read.
    """
    rows = df.select(col(doc_id).cast("long").alias("id"), col(text).alias("text"))
    # the row's number deals out rows of one id and text; their order among each other makes no difference
    order = [F.asc_nulls_first("id"), F.asc_nulls_first("hash"), F.asc("row_no")]
    dealt = rows.withColumns({"hash": F.xxhash64("text"), "row_no": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of_process(tokenizer), TaskContext.get().partitionId()
        end = b"" if end_id is None else struct.pack("<I", end_id)
        docs, ids, n, first = [], [], 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([segment(part, first, docs, ids)], pa.binary())], ["segment"])

        for batch in batches:
            for doc, found in zip(batch.column("id").to_pylist(), encoder.encode(batch.column("text"))):
                docs.append(doc)
                ids.append(found + end)
                n += len(ids[-1]) // 4
                if n >= SEGMENT_IDS:
                    yield out()
                    docs, ids, n, first = [], [], 0, first + n
        if docs:
            yield out()

    # Spark's text writer puts a string's bytes as they are, and a line feed after each
    said = dealt.mapInArrow(encode, "segment binary").select(F.col("segment").cast("string"))
    said.write.option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def _placed(rows: DataFrame, label: str) -> DataFrame:
    """``start`` instead of ``part`` and ``place``: ids of all documents before."""
    rows = written(rows, label)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per task that wrote
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(parts, "part").withColumn("start", F.col("before") + F.col("place")).drop("part", "place", "before")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of its ids as uint32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for s in segments(content.as_py()):
                    ends = np.cumsum(s.sizes, dtype=np.int64)
                    begins = ends - s.sizes
                    raw = memoryview(s.ids().astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                    columns = [
                        pa.array([s.part] * len(s.docs), pa.int64()),
                        pa.array(begins + s.first, pa.int64()),
                        pa.array(s.docs, pa.int64()),
                        pa.array(s.sizes.astype(np.int64)),
                        pa.array(crc, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "place", "doc_id", "n_tokens", "ids_crc32"])

    schema = "part long, place long, doc_id long, n_tokens long, ids_crc32 long"
    return _placed(_files(spark, path).mapInArrow(decode, schema), "token-digests")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id`` and its ``ids``, the end id included."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for s in segments(content.as_py()):
                    places = pa.array(np.concatenate([[0], np.cumsum(s.sizes)]), pa.int32())
                    ids = pa.ListArray.from_arrays(places, pa.array(s.ids().astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([pa.array(s.docs, pa.int64()), ids], ["doc_id", "ids"])

    return _files(spark, path).mapInArrow(decode, "doc_id long, ids array<int>")


def round_trip(
    df: DataFrame, tokenizer: str, end_id: int | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Write the files to the shared folder and read each document's digest from them."""
    path = fresh_folder(df.sparkSession, "token-files")
    write_tokens(df, path, tokenizer, end_id, text, doc_id)
    return read_digests(df.sparkSession, path)
