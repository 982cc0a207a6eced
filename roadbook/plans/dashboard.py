"""Datasets behind the dashboard, over a range of days that by default is the fleet table's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.functions import percent, round_half_even, stable
from roadbook.plans.analytics import Day, day, worst_sla_city_days


def date_bounds(fleet: DataFrame) -> DataFrame:
    """First and last day on file."""
    return fleet.agg(F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))


def listed_date_bounds(spark: SparkSession, bounds: tuple[Day, Day] | None) -> DataFrame:
    """The same from ``sources.lake.day_bounds``, without reading anything."""
    low, high = bounds or (None, None)
    one = spark.range(1)
    return one.select(_day_or_null(low).alias("min_dt"), _day_or_null(high).alias("max_dt"))


def _day_or_null(value: Day | None) -> Column:
    return F.lit(None if value is None else str(value)).cast("date")


def in_range(
    table: DataFrame,
    fleet: DataFrame,
    first: Day | None = None,
    last: Day | None = None,
    bounds: tuple[Day, Day] | None = None,
) -> DataFrame:
    """Rows of ``table`` from ``first`` to ``last``; a bound not given is that of ``fleet``.

    With ``bounds`` (``sources.lake.day_bounds`` of the fleet table) it is known when the query is
    planned, and folders outside are pruned; without, it is read from the table by a scalar subquery.
    """
    low, high = bounds or (None, None)
    first, last = first or low, last or high
    low = fleet.agg(F.min("dt")).scalar() if first is None else day(first)
    high = fleet.agg(F.max("dt")).scalar() if last is None else day(last)
    return table.where(F.col("dt").between(low, high))


def kpis(fleet: DataFrame, sla: DataFrame) -> DataFrame:
    """The four headline numbers in one row.

    Both tables go into a single aggregation; a column the other table lacks is NULL there and
    so counts for nothing.
    """
    numbers = fleet.select("active_time_pct", "distance_km").unionByName(
        sla.select("sla_compliance_pct", "total_deliveries"), allowMissingColumns=True
    )
    return numbers.agg(
        F.avg("active_time_pct").alias("avg_active_time_pct"),
        F.sum("distance_km").alias("total_distance_km"),
        F.avg("sla_compliance_pct").alias("avg_sla_compliance_pct"),
        F.sum("total_deliveries").alias("total_deliveries"),
    )


def daily_active(fleet: DataFrame) -> DataFrame:
    """Mean active share of the fleet per day."""
    return (
        fleet.where(F.col("dt").isNotNull())
        .groupBy("dt")
        .agg(F.avg("active_time_pct").alias("active_time_pct"))
        .orderBy("dt")
    )


def worst_vehicles(fleet: DataFrame, k: int = 10) -> DataFrame:
    """The k vehicles with the lowest mean active share, not rounded."""
    return (
        fleet.where(F.col("vehicle_id").isNotNull())
        .groupBy("vehicle_id")
        .agg(F.avg("active_time_pct").alias("active_time_pct"))
        .orderBy(stable(F.col("active_time_pct")).asc_nulls_last(), "vehicle_id")
        .limit(k)
    )


def driver_leaderboard(drivers: DataFrame, k: int = 10, min_completed: int = 5) -> DataFrame:
    """The k drivers with the best on-time rate over the whole range."""
    completed, on_time = F.col("deliveries_completed"), F.col("on_time_deliveries")
    return (
        drivers.where(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(
            F.sum("deliveries_completed").alias("deliveries_completed"),
            F.sum("on_time_deliveries").alias("on_time_deliveries"),
        )
        .where(completed >= min_completed)
        .withColumn("on_time_rate_pct", round_half_even(percent(on_time, completed), 1))
        .orderBy(F.col("on_time_rate_pct").desc_nulls_last(), "driver_id")
        .limit(k)
    )


def city_sla_series(sla: DataFrame) -> DataFrame:
    """SLA compliance by day, one line per city."""
    return sla.select("dt", "city", "sla_compliance_pct").orderBy(
        F.col("dt").asc_nulls_last(), F.col("city").asc_nulls_last()
    )


def worst_breach_days(sla: DataFrame, k: int = 10) -> DataFrame:
    """The k city-days with the most late deliveries."""
    return worst_sla_city_days(sla, k)
