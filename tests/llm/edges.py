"""Rows that operators must take in their stride."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = (
    "row_no", "group_no", "stays", "start", "end", "copies", "first", "size", "target", "found", "kept", "key",
    "distance", "n_words", "n_hit", "items", "contaminated", "shard", "slot", "held_out", "score", "block", "w", "t", "x",
)
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))


def rows() -> list[tuple]:
    plain = "the quick brown fox jumps over the lazy dog and runs away from the farm to the wood at night"
    return [
        (1, plain + " one two three four five six", "en", "a", 10),
        (1, plain + " one two three four five six", "en", "a", 10),  # a repeated row
        (2, None, "en", "a", None),
        (3, "", None, "a", 0),
        (4, " \n\t ", "en", None, 4),
        (None, plain.upper() + " ONE TWO THREE FOUR FIVE SIX", None, None, None),
        (5, LONG, "en", "b", len(LONG)),
        (6, "word", "de", "b", 4),
        (7, "éà 世界 😀 𝔘 naïve\x00zero", "fr", "b", 9),
        (None, None, None, None, None),
    ]


def documents(spark) -> DataFrame:
    return spark.createDataFrame(rows(), DOCS)


def clashing(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING if c not in df.columns and c not in keep})


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], DOCS)
