"""A full outer join that a hot key cannot stall.

Spark splits skewed partitions of inner and one-sided outer joins at run time, but not of a full
outer join, which also keeps all rows of a key in memory. Here the join is a left join, which
streams them, with hot keys split over tasks, and the rows that matched nothing are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this many rows, and is split into parts of about as many.
ROWS_PER_PART = 2_000_000
# A hot key also holds more than this share of all rows, so there are fewer hot keys than this.
HOT_SHARE_OF = 10_000
# Rows without a key match nothing: each goes to a part of its own hash, below the parts of keys.
_HASHES = 1 << 30


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows (``_rows``) each key has."""
    return df.where(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Keys above ``rows_per_part`` rows with ``_parts``, how many to split each into.

    Every one has more than 1 / HOT_SHARE_OF of the rows, so there are fewer than HOT_SHARE_OF of
    them whatever the size of the data, and the result may be broadcast. Any other key has so few
    rows that it can stay whole.
    """
    rows = F.col("_rows")
    share = counts.agg(F.sum("_rows") / F.lit(HOT_SHARE_OF)).scalar()
    return (
        counts.where((rows > rows_per_part) & (rows > share))
        .withColumn("_parts", F.ceil(rows / rows_per_part).cast("int"))
        .drop("_rows")
    )


def full_outer_one_to_many(
    one: DataFrame,
    many: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``one`` FULL OUTER JOIN ``many`` USING (keys), where ``one`` has each key once at most.

    Rows of a hot key in ``many`` are spread over parts by a hash of ``spread_by``, and its row of
    ``one`` is repeated for every part. The result is the same as that of the plain join.
    """
    keys = list(keys)
    counts = rows_per_key(many, keys)
    hot = F.broadcast(hot_keys(counts, rows_per_part))
    # Part 0 has the row of ``one``, so rows without a key stay out of it.
    part_of_key = F.pmod(F.xxhash64(*spread_by), F.coalesce("_parts", F.lit(1)))
    part_of_none = -1 - F.pmod(F.xxhash64(*spread_by), F.lit(_HASHES))
    part = F.when(_has_key(keys), part_of_key).otherwise(part_of_none).cast("int")
    spread = many.join(hot, keys, "left").withColumn("_part", part).drop("_parts")
    every_part = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = one.join(hot, keys, "left").withColumn("_part", F.explode(every_part)).drop("_parts")
    # Compared with <=>, or Spark would filter NULL keys out of ``one`` here but not below, and so
    # compute it twice.
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*keys, "_part")]
    joined = (
        spread.alias("m")
        .join(repeated.alias("o"), same, "left")
        .select("m.*", *[f"o.`{c}`" for c in one.columns if c not in keys])
        .drop("_part")
    )
    # The condition is always true; with it, Spark sees the counts of ``hot`` again and reuses them.
    alone = one.join(counts.where("_rows > 0"), keys, "left_anti")
    return joined.unionByName(alone, allowMissingColumns=True)
