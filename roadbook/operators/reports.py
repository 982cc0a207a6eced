"""Row-count reports of the three zones. Each is one aggregation, whatever it counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.functions import percent, round_half_up


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rows_per_day(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each dataset on each day."""
    tagged = [df.select(F.lit(name).alias("dataset"), "dt") for name, df in datasets.items()]
    return _union(tagged).groupBy("dataset", "dt").agg(F.count(F.lit(1)).alias("row_count"))


def cleaning_report(datasets: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per dataset: raw rows, rows that were staged, rows dropped and their share in percent.

    ``datasets`` maps a name to its (raw, cleaned) frames. The empty global counts keep a dataset
    without rows in the report.
    """

    def counted(name: str, df: DataFrame, raw: int) -> DataFrame:
        n = F.count(F.lit(1))
        return df.agg(
            F.lit(name).alias("dataset"),
            (n * raw).alias("raw_rows"),
            (n * (1 - raw)).alias("staged_rows"),
        )

    counts = _union(
        counted(name, df, raw)
        for name, (dirty, cleaned) in datasets.items()
        for df, raw in ((dirty, 1), (cleaned, 0))
    )
    return _with_dropped(
        counts.groupBy("dataset").agg(
            F.sum("raw_rows").alias("raw_rows"), F.sum("staged_rows").alias("staged_rows")
        )
    )


def _with_dropped(counts: DataFrame) -> DataFrame:
    raw, dropped = F.col("raw_rows"), F.col("dropped_rows")
    share = F.coalesce(percent(dropped, raw), F.lit(0.0))
    return counts.withColumn("dropped_rows", raw - F.col("staged_rows")).withColumn(
        "dropped_pct", round_half_up(share, 1)
    )


def build_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per gold table: rows and days."""
    return (
        rows_per_day(tables)
        .groupBy(F.col("dataset").alias("table_name"))
        .agg(
            F.sum("row_count").alias("row_count"),
            F.count("dt").alias("partition_count"),
        )
    )


def cleaning_report_of_counts(entered: Mapping[str, DataFrame]) -> DataFrame:
    """The cleaning report from counts by day (raw_rows, rows) of each dataset."""

    def counted(name: str, days: DataFrame) -> DataFrame:
        return days.agg(
            F.lit(name).alias("dataset"),
            F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("raw_rows"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("staged_rows"),
        )

    return _with_dropped(_union(counted(name, days) for name, days in entered.items()))


def build_report_of_counts(entered: DataFrame, tables: Sequence[str]) -> DataFrame:
    """The build report from counts by day (name, rows); a day without rows is none."""
    known = entered.where((F.col("rows") > 0) & F.col("name").isin(*tables))
    return known.groupBy(F.col("name").alias("table_name")).agg(
        F.sum("rows").alias("row_count"), F.count("dt").alias("partition_count")
    )
