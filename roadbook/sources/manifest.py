"""A manifest beside a table: for each day its rows and a hash of them that their order does not change.

It is written from the files as they lie after a write, into a folder that readers of the table skip.
``checked`` reads a table and fails, when it is executed, if a day is not what its manifest says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGESTS = "dt date, rows long, hash_xor long, hash_sum long"
# So many rows of a day leave the sum of hashes (24 bits each) within a long.
_SUM_BITS = 24


def digests(rows: DataFrame) -> DataFrame:
    """dt, rows, and two sums of the hashes of all columns, in whatever order rows and columns are.

    The exclusive or has all 64 bits but misses pairs of equal rows, which the other sum has.
    """
    columns = sorted(c for c in rows.columns if c != "dt")
    # A null is told from its neighbours' values by what stands in its place.
    hashed = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])
    small = F.shiftrightunsigned("hash", 64 - _SUM_BITS)
    return (
        rows.select("dt", hashed.alias("hash"))
        .groupBy("dt")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.bit_xor("hash").alias("hash_xor"),
            F.sum(small).alias("hash_sum"),
        )
    )


def seal(table: DataFrame, path: str) -> None:
    """Write the manifest of the table at ``path``, which ``table`` reads."""
    digests(table).coalesce(1).write.mode("overwrite").json(_place(path))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DIGESTS).json(_place(path))


def checked(read: Callable[[], DataFrame], path: str) -> DataFrame:
    """What ``read`` gives, with a check in the plan that each day is as the manifest has it."""
    table = read()
    now = digests(table).withColumn("side", F.lit(1))
    sealed = manifest(table.sparkSession, path).withColumn("side", F.lit(-1))
    # A day that is alike on both sides leaves one group of two rows.
    sums = ["dt", "rows", "hash_xor", "hash_sum"]
    days = now.unionByName(sealed).groupBy(*sums).agg(F.sum("side").alias("side"))
    told = F.concat(F.lit("not as sealed: dt="), F.coalesce(F.col("dt").cast("string"), F.lit("null")))
    # It hangs on the sum, so that Spark does not ask it of the days before they are grouped.
    odd = F.when(F.col("side") != 0, F.raise_error(told).cast("boolean")).otherwise(F.lit(False))
    wrong = days.where(odd)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
    return table.unionByName(wrong.select(*none))


def _place(path: str) -> str:
    return f"{path}/_manifest"
