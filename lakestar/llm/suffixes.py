"""Passages that repeat across or within documents, by a sparse suffix array.

Only suffixes that start at minimisers are kept: of every ``reach`` successive runs of eight words the one
with the least hash, which the text itself selects, so a repeated passage has them at
the same places wherever it stands. Suffixes are ordered by the hashes of their first eight words
and then of their first ``ahead`` words, with document and position last, and cut into ranges of
equal size; even a passage that a third of all documents share is spread over tasks. A suffix
that begins like a neighbour is a match.

Matches are extended to the left and right: the windows of 50 words in which a matched suffix may be
the first minimiser are hashed, and windows that occur twice are repeated. Every repeated window is
found, since both its places keep the same suffix and both suffixes have a neighbour that begins
alike; comparing with the two neighbours alone would miss a passage that a third text shares
further on one side and less on the other. Overlapping windows are joined to spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import col, numbered, step_aside, written
from lakestar.llm.shingles import WordHashes, runs

#: Words of a passage that counts as repeated.
WORDS = 50
#: Words whose hash decides on minimisers.
GRAM = 8
#: Runs of GRAM words of which one is kept.
REACH = 34
#: Words from a kept suffix to the end of the shortest window in which it is the first.
AHEAD = WORDS - REACH + 1
#: Pieces of a span, with the copies of the span they were found in.
PIECES = "array<struct<start:int,end:int,copies:bigint>>"


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def minimisers(grams: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Positions of the least of every ``reach`` successive hashes, the last of equal ones."""
    if len(grams) < reach:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams[::-1], reach)
    starts = np.arange(len(windows))
    return np.unique(len(grams) - 1 - (starts + windows.argmin(axis=1)))


def _kept(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of kept suffixes with the hashes of their first GRAM and AHEAD words."""
    grams = runs(hashes, GRAM)
    at = minimisers(grams)
    ahead = runs(hashes, AHEAD)
    at = at[at < len(ahead)]
    return at, grams[at], ahead[at]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its number of words, a digest of them, and the kept suffixes."""
    known = WordHashes()
    for batch in batches:
        sizes, digests, kept = [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = _words(text)
            sizes.append(len(words))
            digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
            kept.append(_kept(known.of(words if len(words) >= WORDS else [])))
        ends = np.cumsum([0] + [len(k[0]) for k in kept]).astype(np.int32)
        at, gram, ahead = (np.concatenate([k[i] for k in kept]) for i in range(3))
        flat = pa.StructArray.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(ahead.view(np.int64))],
            ["at", "gram", "ahead"],
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_no"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), flat),
            ],
            ["row_no", "n_words", "digest", "kept"],
        )


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of suffixes in order, those that begin like a neighbour.

    The first and the last of the range pass, too: their other neighbour is in another range.
    """
    held: pa.RecordBatch | None = None
    before: tuple[int, int] | None = None

    def emit(batch: pa.RecordBatch, after: tuple[int, int] | None) -> pa.RecordBatch:
        nonlocal before
        gram, ahead = (batch.column(c).to_numpy() for c in ("gram", "ahead"))
        same = (gram[1:] == gram[:-1]) & (ahead[1:] == ahead[:-1])
        match = np.zeros(len(gram), bool)
        match[1:] |= same
        match[:-1] |= same
        match[0] |= before is None or before == (gram[0], ahead[0])
        match[-1] |= after is None or after == (gram[-1], ahead[-1])
        before = (gram[-1], ahead[-1])
        return batch.select(["row_no", "at"]).filter(pa.array(match))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield emit(held, (batch.column("gram")[0].as_py(), batch.column("ahead")[0].as_py()))
        held = batch
    if held is not None:
        yield emit(held, None)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of WORDS words in which a matched suffix may be the first minimiser.

    ``fresh`` are the first ones of their kind in the text.
    """
    known = WordHashes()
    for batch in batches:
        rows, starts, keys, fresh = [], [], [], []
        for row, text, places in zip(
            batch.column("row_no").to_pylist(),
            batch.column("text").cast(pa.binary()).to_pylist(),
            batch.column("places").to_pylist(),
        ):
            hashes = runs(known.of(_words(text)), WORDS)
            near = np.zeros(len(hashes) + REACH, np.int32)
            for p in places:
                near[max(0, p - REACH + 1)] += 1
                near[min(p + 1, len(near) - 1)] -= 1
            at = np.flatnonzero(np.cumsum(near)[: len(hashes)] > 0)
            rows.append(np.full(len(at), row, np.int64))
            starts.append(at.astype(np.int32))
            keys.append(hashes[at].view(np.int64))
            fresh.append(np.zeros(len(at), bool))
            fresh[-1][np.unique(keys[-1], return_index=True)[1]] = True
        if rows:
            arrays = [np.concatenate(x) for x in (rows, starts, keys, fresh)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["row_no", "start", "window", "fresh"])


def _joined(windows: DataFrame) -> DataFrame:
    """Maximal spans of overlapping or touching windows per row.

    ``own`` windows have their first place here; ``again`` is what of a span none of them covers.
    """
    order = Window.partitionBy("row_no").orderBy("start")
    apart = F.coalesce((F.col("start") - F.lag("start").over(order) > WORDS).cast("int"), F.lit(0))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max(F.when(F.col("own"), F.col("start"))).over(earlier) + WORDS, F.lit(0))
    piece = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    gap = F.when(F.col("own") & (F.col("covered") < F.col("start")), piece(F.col("covered"), F.col("start")))
    last = piece(F.coalesce(F.col("own_end"), F.col("start")), F.col("end"))
    pieces = F.transform(
        F.concat("gaps", F.array(last)), lambda x: piece(F.greatest(x["start"], F.col("start")), x["end"])
    )
    return (
        windows.withColumn("apart", apart)
        .withColumn("covered", covered)
        .withColumn("span", F.sum("apart").over(order))
        .groupBy("row_no", "span")
        .agg(
            F.min("start").alias("start"),
            (F.max("start") + WORDS).alias("end"),
            F.max("copies").alias("copies"),
            (F.max(F.when(F.col("own"), F.col("start"))) + WORDS).alias("own_end"),
            F.sort_array(F.collect_list(gap)).alias("gaps"),
        )
        .withColumn("again", F.filter(pieces, lambda x: x["start"] < x["end"]))
        .withColumn("again", F.transform("again", lambda x: x.withField("copies", F.col("copies"))))
        .drop("span", "own_end", "gaps")
    )


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``row_no``, ``start``, ``end`` (words), ``copies``, ``again`` of every maximal repeated span.

    ``rows`` are numbered, with a ``text``. A text of 50 words or more that has exact copies is
    one span, with the number of its copies. In a text without copies a span is a union of
    overlapping windows of 50 words that stand at two places or more, the copies of a text
    counted once; ``copies`` is how often its most frequent window does.

    ``again`` are the pieces of the span to drop so that a passage stays once. The first place of a
    window is in the least row, and there the first one. All of a text that has a copy in a lesser
    row goes; of other texts what windows cover whose first place is elsewhere, but for words that a
    window in its first place needs. So no window loses its first place, and one stays in another
    place only if windows that have theirs there cover all of it.
    """
    found = written(
        rows.select("row_no", "text").mapInArrow(
            _suffixes,
            "row_no long, n_words long, digest binary, kept array<struct<at:int,gram:long,ahead:long>>",
        ),
        "suffixes",
    )
    long = found.select("row_no", "n_words", "digest").where(F.col("n_words") >= WORDS)
    classes = written(
        long.groupBy("digest", "n_words").agg(F.min("row_no").alias("rep"), F.count("*").alias("n")), "suffix-classes"
    )
    keys = ["gram", "ahead", "row_no", "at"]
    ordered = found.select("row_no", F.inline("kept")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    matched = ordered.mapInArrow(_matched, "row_no long, at int").groupBy("row_no").agg(F.collect_list("at").alias("places"))
    once = matched.join(classes.select(F.col("rep").alias("row_no")), "row_no", "left_semi")
    once = written(once, "suffix-matches")
    # the numbers first: while they are few, Spark need not shuffle texts
    wanted = written(once.select("row_no").sort("row_no"), "suffix-texts")
    windows = written(
        rows.select("row_no", "text").join(wanted, "row_no", "left_semi")
        .join(once, "row_no")
        .select("row_no", "text", "places")
        .mapInArrow(_windows, "row_no long, start int, window long, fresh boolean"),
        "suffix-windows",
    )
    twice = windows.groupBy("window").agg(F.count("*").alias("copies"), F.min("row_no").alias("first_row"))
    repeats = written(twice.where("copies > 1"), "suffix-repeats")
    here = F.col("fresh") & (F.col("row_no") == F.col("first_row"))
    own = _joined(windows.join(repeats, "window").select("row_no", "start", "copies", here.alias("own")))
    parts = own.join(classes.withColumn("row_no", F.col("rep")), "row_no").select(
        "digest", "start", "end", "copies", "rep", "n", "again"
    )
    parts = written(parts, "suffix-parts")
    within = parts.where("n > 1").groupBy("digest").agg(F.sort_array(F.flatten(F.collect_list("again"))).alias("again"))
    whole = classes.where("n > 1").join(within, "digest", "left").select(
        "digest", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"), F.col("n").alias("copies"),
        "rep", "n", F.coalesce("again", F.array().cast(PIECES)).alias("again"),
    )
    spans = written(parts.where("n = 1").unionByName(whole), "suffix-spans")
    all_of_it = F.array(F.struct("start", "end", "copies")).cast(PIECES)
    again = F.when(F.col("row_no") == F.col("rep"), F.col("again")).otherwise(all_of_it)
    return long.join(spans, "digest").select("row_no", "start", "end", "copies", again.alias("again"))


def with_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df``, a row for each repeated span with ``start``, ``end``, ``copies``, ``again``.

    ``again`` are the pieces of the span that stand elsewhere before; dropping these words keeps a
    passage once (see ``repeated_spans``). ``first`` tells whether anything else is in the span, so dropping
    spans that are not first loses no passage, but leaves the pieces of the others. Rows without a repeated span don't come back; nor do
    null, empty or short texts. Repeated rows are copies. Input columns with a result's name are kept
    as ``<name>_input``.
    """
    rows = numbered(step_aside(df, ("row_no", "start", "end", "copies", "again", "first")), "suffix-rows")
    spans = written(repeated_spans(rows.select("row_no", col(text).alias("text"))), "suffix-result")
    whole = F.exists("again", lambda x: (x["start"] == F.col("start")) & (x["end"] == F.col("end")))
    return rows.join(spans, "row_no").withColumn("first", ~whole)
