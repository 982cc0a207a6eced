"""The analytical queries. Each takes gold tables (or raw rows) and returns a lazy DataFrame.

Ties under a limit are broken by the group key, so results do not change between runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.functions import parse_number, parse_timestamp, percent, round_half_up, whole_minutes

Day = dt.date | str


def day(value: Day):
    """A literal DATE."""
    return F.lit(str(value)).cast("date")


def underutilized_vehicles(fleet: DataFrame, k: int = 5) -> DataFrame:
    """The k vehicles with the lowest mean share of active time."""
    return (
        fleet.groupBy("vehicle_id")
        .agg(
            round_half_up(F.avg("active_time_pct"), 1).alias("avg_active_pct"),
            round_half_up(F.avg("distance_km"), 1).alias("avg_daily_km"),
        )
        .orderBy(F.col("avg_active_pct").asc_nulls_last(), F.col("vehicle_id").asc_nulls_last())
        .limit(k)
    )


def driver_leaderboard(
    drivers: DataFrame,
    days: int = 7,
    k: int = 5,
    min_completed: int = 5,
    last: Day | None = None,
) -> DataFrame:
    """The k drivers with the best on-time rate over the ``days`` days up to ``last``.

    ``sources.lake.day_bounds`` has the last day of a table in the lake; older folders are then pruned
    when the query is planned. Without it, the last day is read from the table by a scalar subquery.
    """
    if last is None:
        first_day = drivers.agg(F.date_sub(F.max("dt"), days - 1)).scalar()
    else:
        first_day = day(dt.date.fromisoformat(str(last)) - dt.timedelta(days - 1))
    completed, on_time = F.sum("deliveries_completed"), F.sum("on_time_deliveries")
    return (
        drivers.where(F.col("dt") >= first_day)
        .groupBy("driver_id")
        .agg(
            completed.alias("deliveries_completed"),
            round_half_up(percent(on_time, completed), 1).alias("on_time_rate_pct"),
        )
        .where(F.col("deliveries_completed") >= min_completed)
        .orderBy(F.col("on_time_rate_pct").desc_nulls_last(), F.col("driver_id").asc_nulls_last())
        .limit(k)
    )


def city_sla_trend(sla: DataFrame, first: Day | None = None, last: Day | None = None) -> DataFrame:
    """SLA compliance of each city day by day, over all days or those from ``first`` to ``last``."""
    if first is not None:
        sla = sla.where(F.col("dt") >= day(first))
    if last is not None:
        sla = sla.where(F.col("dt") <= day(last))
    return sla.select("dt", "city", "sla_compliance_pct", "total_deliveries").orderBy(
        F.col("city").asc_nulls_last(), F.col("dt").asc_nulls_last()
    )


def worst_sla_city_days(sla: DataFrame, k: int = 10) -> DataFrame:
    """The k city-days with the most late deliveries."""
    return (
        sla.where(F.col("breached_deliveries") > 0)
        .select(
            "dt",
            "city",
            "breached_deliveries",
            "avg_breach_overage_minutes",
            "sla_compliance_pct",
        )
        .orderBy(
            F.col("breached_deliveries").desc_nulls_last(),
            F.col("dt").asc_nulls_last(),
            F.col("city").asc_nulls_last(),
        )
        .limit(k)
    )


def _mean_hours_per_day(drivers: DataFrame) -> DataFrame:
    mean = round_half_up(F.avg("hours_worked"), 2)
    return drivers.groupBy("dt").agg(mean.alias("avg_driver_hours_same_day"))


def utilization_vs_hours(
    fleet: DataFrame, drivers: DataFrame, k: int | None = 20
) -> DataFrame:
    """Active share of each vehicle-day beside the mean driver hours of that day.

    Hours are averaged per day before the join, so vehicles and drivers of a day never multiply.
    The join keeps every vehicle-day exactly once, which lets the limit go first; only the days of
    the k rows are then read from the drivers' table. ``k=None`` gives all rows.
    """
    by_day = [F.col("dt").asc_nulls_last(), F.col("vehicle_id").asc_nulls_last()]
    vehicle_days = fleet.select("dt", "vehicle_id", "active_time_pct")
    if k is None:
        return vehicle_days.join(_mean_hours_per_day(drivers), "dt", "left").orderBy(*by_day)
    first_rows = vehicle_days.orderBy(*by_day).limit(k)
    of_their_days = drivers.where(
        F.col("dt").between(
            first_rows.agg(F.min("dt")).scalar(), first_rows.agg(F.max("dt")).scalar()
        )
    )
    joined = first_rows.join(_mean_hours_per_day(of_their_days), "dt", "left")
    return joined.orderBy(*by_day).limit(k)


def raw_city_day_sla(deliveries: DataFrame, city: str, on: Day) -> DataFrame:
    """SLA of one city and day straight from raw deliveries, as asked before there was a gold table.

    It differs from the gold figure: repeats count, failed deliveries count as late, and the
    minutes taken are cut to whole ones.
    """
    minutes = whole_minutes(
        parse_timestamp(F.col("assigned_at")), parse_timestamp(F.col("completed_at"))
    )
    in_time = minutes <= parse_number(F.col("promised_minutes"))
    score = F.when((F.col("status") == "COMPLETED") & in_time, 100.0).otherwise(0.0)
    return (
        deliveries.where((F.col("dt") == day(on)) & (F.col("city") == city))
        .groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("total_deliveries"),
            round_half_up(F.avg(score), 1).alias("sla_compliance_pct"),
        )
    )


def sla_point_lookup(sla: DataFrame, city: str, on: Day) -> DataFrame:
    """SLA of one city and day from gold; reads one folder.

    Execution fails where that day has no rows at all; a city without rows on it gives none. Nothing is
    run until then.
    """
    that_day = sla.where(F.col("dt") == day(on))
    answer = that_day.where(F.col("city") == city).select("total_deliveries", "sla_compliance_pct")
    failure = F.raise_error(F.lit(f"no rows on file for dt={on}")).cast("boolean")
    missing = F.when(F.col("rows") == 0, failure).otherwise(F.lit(False))
    nothing = that_day.agg(F.count(F.lit(1)).alias("rows")).where(missing)
    none = [F.lit(None).cast(answer.schema[c].dataType).alias(c) for c in answer.columns]
    return answer.unionByName(nothing.select(*none))
