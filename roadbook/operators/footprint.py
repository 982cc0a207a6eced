"""What a query has to scan: files and bytes, and what that costs where scans are billed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.functions import human_bytes

# Price in USD of a scanned TB, and bytes in a TB.
USD_PER_TB = 5.0
BYTES_PER_TB = 1024**4


def scan_footprint(scenario: str, files: DataFrame, matched: DataFrame) -> DataFrame:
    """One row: files and bytes that are scanned, and how many rows the query matched.

    ``files`` is a listing (``sources.listing``) of what the scan opens: a condition on ``dt`` prunes it
    as it prunes folders. A file counts with its whole length, whichever columns are read.
    """
    touched = files.select("length", F.lit(1).alias("file"))
    numbers = touched.unionByName(
        matched.select(F.lit(1).alias("matched")), allowMissingColumns=True
    )
    return numbers.agg(
        F.lit(scenario).alias("scenario"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes_scanned"),
        F.count("file").alias("files_touched"),
        F.count("matched").alias("rows_matched"),
    )


def scan_cost_comparison(footprints: DataFrame, city: str, day: str) -> DataFrame:
    """The ``before`` and ``after`` footprints of a question in one record, with the saving."""

    def of(scenario: str) -> Column:
        names = ("bytes_scanned", "files_touched", "rows_matched")
        is_it = F.col("scenario") == scenario
        return F.struct(*[F.max(F.when(is_it, F.col(n))).alias(n) for n in names])

    def cost(scenario: str) -> Column:
        return F.col(f"{scenario}.bytes_scanned") / F.lit(BYTES_PER_TB) * F.lit(USD_PER_TB)

    share = F.try_divide(F.col("after.bytes_scanned"), F.col("before.bytes_scanned"))
    return footprints.agg(of("before").alias("before"), of("after").alias("after")).select(
        F.lit(day).alias("target_dt"),
        F.lit(city).alias("target_city"),
        "before",
        "after",
        F.round((F.lit(1.0) - share) * 100.0, 1).alias("reduction_pct"),
        cost("before").alias("before_cost_usd"),
        cost("after").alias("after_cost_usd"),
        human_bytes(F.col("before.bytes_scanned")).alias("before_size"),
        human_bytes(F.col("after.bytes_scanned")).alias("after_size"),
    )


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as JSON in a single file."""
    report.coalesce(1).write.mode("overwrite").json(path)
