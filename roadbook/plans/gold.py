"""Silver to gold: three daily tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.functions import elapsed_hours, elapsed_minutes, percent, round_half_up
from roadbook.operators.skew import ROWS_PER_PART, full_outer_one_to_many


def _status(name: str) -> Column:
    return F.col("status") == name


def daily_fleet_utilization(telemetry: DataFrame) -> DataFrame:
    """Per vehicle and day: pings, mean speed, distance, share of pings with the engine on / off."""
    pings = F.count(F.lit(1))
    active = F.count_if("engine_on")
    return telemetry.groupBy("dt", "vehicle_id").agg(
        pings.alias("ping_count"),
        round_half_up(F.avg("speed_kmph"), 2).alias("avg_speed_kmph"),
        round_half_up(F.max("odometer_km") - F.min("odometer_km"), 2).alias("distance_km"),
        round_half_up(percent(active, pings), 1).alias("active_time_pct"),
        round_half_up(percent(pings - active, pings), 1).alias("idle_time_pct"),
    )


def _net_hours() -> Column:
    breaks = F.coalesce("break_minutes", F.lit(0.0)) / F.lit(60.0)
    return elapsed_hours(F.col("clock_in"), F.col("clock_out")) - breaks


def shift_hours(shifts: DataFrame) -> DataFrame:
    """Per closed shift: hours from clock-in to clock-out less the break."""
    return shifts.where(F.col("clock_out").isNotNull()).select(
        "dt", "driver_id", round_half_up(_net_hours(), 2).alias("hours_worked")
    )


def _with_minutes(deliveries: DataFrame) -> DataFrame:
    """Adds ``minutes``, from assignment to completion, of completed deliveries (else NULL)."""
    minutes = elapsed_minutes(F.col("assigned_at"), F.col("completed_at"))
    return deliveries.withColumn("minutes", F.when(_status("COMPLETED"), minutes))


def delivery_stats(deliveries: DataFrame) -> DataFrame:
    """Per driver and day: deliveries assigned, completed and on time, mean minutes taken."""
    return (
        _with_minutes(deliveries)
        .groupBy("dt", "driver_id")
        .agg(
            F.count(F.lit(1)).alias("deliveries_assigned"),
            F.count_if(_status("COMPLETED")).alias("deliveries_completed"),
            F.count_if(F.col("minutes") <= F.col("promised_minutes")).alias("on_time_deliveries"),
            round_half_up(F.avg("minutes"), 2).alias("avg_delivery_minutes"),
        )
    )


def driver_performance(
    shifts: DataFrame,
    deliveries: DataFrame,
    one_row_per_driver_day: bool = False,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Deliveries and hours side by side, for drivers with either on that day.

    A driver with several shifts in a day gets a row for each, with the delivery counts repeated;
    ``one_row_per_driver_day`` sums the hours instead.
    """
    keys = ["dt", "driver_id"]
    stats = delivery_stats(deliveries)
    if one_row_per_driver_day:
        total = round_half_up(F.sum("hours_worked"), 2).alias("hours_worked")
        joined = stats.join(shift_hours(shifts).groupBy(*keys).agg(total), keys, "full_outer")
    else:
        # Two shifts of a driver-day never share their clock-in, so it spreads a hot key evenly.
        closed = shifts.where(F.col("clock_out").isNotNull()).select(
            *keys, "clock_in", round_half_up(_net_hours(), 2).alias("hours_worked")
        )
        joined = full_outer_one_to_many(stats, closed, keys, ["clock_in"], rows_per_part)
    completed, on_time = F.col("deliveries_completed"), F.col("on_time_deliveries")
    rate = F.when(completed > 0, round_half_up(percent(on_time, completed), 1))
    return joined.select(
        *keys,
        "hours_worked",
        F.coalesce("deliveries_assigned", F.lit(0)).alias("deliveries_assigned"),
        F.coalesce(completed, F.lit(0)).alias("deliveries_completed"),
        F.coalesce(on_time, F.lit(0)).alias("on_time_deliveries"),
        rate.alias("on_time_rate_pct"),
        "avg_delivery_minutes",
    )


def delivery_sla_compliance(deliveries: DataFrame) -> DataFrame:
    """Per city and day: deliveries failed, on time and late, how late, share on time."""
    overage = F.col("minutes") - F.col("promised_minutes")
    late = F.col("minutes") > F.col("promised_minutes")
    on_time = F.count_if(F.col("minutes") <= F.col("promised_minutes"))
    completed = F.count_if(_status("COMPLETED"))
    return (
        _with_minutes(deliveries)
        .groupBy("dt", "city")
        .agg(
            F.count(F.lit(1)).alias("total_deliveries"),
            F.count_if(_status("FAILED")).alias("failed_deliveries"),
            on_time.alias("on_time_deliveries"),
            F.count_if(late).alias("breached_deliveries"),
            round_half_up(F.avg(F.when(late, overage)), 2).alias("avg_breach_overage_minutes"),
            round_half_up(percent(on_time, completed), 1).alias("sla_compliance_pct"),
        )
    )
