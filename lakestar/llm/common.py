"""What the operators of this package share: names, row numbers, written tables, uniform numbers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.session import fresh_folder

#: White space that ends a word: space, and the characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def step_aside(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Input columns that bear a result's name are kept as ``<name>_input``."""
    for name in names:
        for own in [c for c in df.columns if c.lower() == name.lower()]:
            df = df.withColumnRenamed(own, free_name(df, f"{own}_input"))
    return df


def written(df: DataFrame, label: str, level: int = 3) -> DataFrame:
    """``df`` written once to the shared folder and read back, so a lost executor changes nothing.

    ``level`` of compression: 9 takes 8 % less disk for texts and some more time.
    """
    path = fresh_folder(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    writer.option("parquet.compression.codec.zstd.level", str(level)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str, name: str = "row_no", level: int = 3) -> DataFrame:
    """The rows with a number each that no other row has; frozen, because they are written.

    Rows are told apart by it whatever their ids say: ids may be null or repeated. The low 33
    bits count the rows of one partition.
    """
    return written(df.withColumn(name, F.monotonically_increasing_id()), label, level)


def without(rows: DataFrame, dropped: DataFrame, label: str) -> DataFrame:
    """The rows whose ``row_no`` is not in ``dropped``.

    The numbers are written, so Spark knows their size and need not shuffle texts while they are few.
    """
    numbers = written(dropped.select("row_no").distinct().sort("row_no"), label)
    return rows.join(numbers, "row_no", "left_anti")


#: Bits of a map of numbers: 8 MB, whatever the data.
MAP_BITS = 1 << 26
#: Bits that one of Spark's bitmap aggregates covers.
_BITMAP = 32768


def bit_map(df: DataFrame, place: Column) -> np.ndarray:
    """A map of fixed size with the bits set whose ``place`` (a long; the low bits count) some row has.

    It goes to tasks that look through many rows for few: a row whose bit isn't set is none of those
    wanted; a row that shares a bit with a wanted one costs some work and must do no harm.
    """
    at = F.pmod(place, F.lit(MAP_BITS))
    parts = (
        df.select((at / _BITMAP).cast("int").alias("part"), (at % _BITMAP).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()  # at most MAP_BITS / _BITMAP rows of 4 KB
    )
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for r in parts:
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[r["part"] * (_BITMAP // 8) :][: bits.size] = bits
    return out


def in_map(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bit of each place is set."""
    at = place & (MAP_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def row_place(row_no: Column) -> Column:
    """A place for numbers as ``numbered`` gives them: rows of one partition lie side by side."""
    return F.shiftrightunsigned(row_no, 33) * 40503 + row_no.bitwiseAND(F.lit((1 << 33) - 1))


def row_places(row_no: np.ndarray) -> np.ndarray:
    return (row_no >> 33) * 40503 + (row_no & ((1 << 33) - 1))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 53 random bits that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def word_count(text: Column) -> Column:
    """Number of words; none for a null text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


@dataclass(frozen=True)
class Named:
    """Neutral names (``to``) by what columns were called."""

    to: dict[str, str]

    def back(self, df: DataFrame) -> DataFrame:
        """Only the columns that ``neutral`` got, under the names they had."""
        return df.select(*[col(new).alias(old) for old, new in self.to.items()])


def neutral(df: DataFrame) -> tuple[DataFrame, Named]:
    """``df`` with columns called in_0, in_1, ..., which clash with no operator's results."""
    named = Named({name: f"in_{i}" for i, name in enumerate(df.columns)})
    return df.select(*[col(old).alias(new) for old, new in named.to.items()]), named
