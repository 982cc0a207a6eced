"""First copy of each key with a narrow shuffle: only rows whose key may occur twice travel whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.operators.cleaning import keep_first
from roadbook.spec import ARRIVAL

# Marks of key hashes, 64 in a row: at most BITS / 64 rows (4.2 million) go to all tasks, whatever
# the input. The more keys repeat, the more others share their marks and travel too.
BITS = 1 << 28


def repeated_marks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """word and bits: which of BITS places belong to the hash of a key that a day has more than once.

    The only shuffle of all rows is of 64-bit hashes of (day, key), summed within each task first. Keys
    of equal hash count as one here, which marks more than need be and never less.
    """
    hashes = rows.groupBy(F.xxhash64("dt", *keys).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    repeated = hashes.where("n > 1").select(_place("hash").alias("place"))
    word, bit = F.shiftright("place", 6), (F.col("place") % 64).cast("int")
    marks = repeated.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    return marks.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def first_copies(
    rows: DataFrame, keys: Sequence[str], marks: DataFrame, order: Sequence[str | Column] = (ARRIVAL,)
) -> DataFrame:
    """``keep_first`` of rows that are cheap to read twice, with marks from ``repeated_marks``.

    Rows of unmarked keys pass as they are, without a shuffle.
    """
    place = _place(F.xxhash64("dt", *keys))
    spread = rows.withColumns({"_word": F.shiftright(place, 6), "_bit": (place % 64).cast("int")})
    marked = spread.join(F.broadcast(marks), F.col("_word") == F.col("word"), "left")
    is_marked = F.expr("coalesce(shiftright(bits, _bit) & 1, 0) = 1")
    single = marked.where(~is_marked).select(*rows.columns)
    several = marked.where(is_marked).select(*rows.columns)
    return single.unionByName(keep_first(several, keys, order))


def _place(hashed: str | Column) -> Column:
    return F.pmod(hashed, F.lit(BITS))
