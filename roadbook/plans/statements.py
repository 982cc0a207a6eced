"""The analytical queries as SQL statements with named parameters, for whoever asks in SQL.

Tables are parameters too, so a statement runs on the views of a session (``lake.register_views``) and
on the tables of a database (``lake.register_tables``) alike. They give what the functions of
``plans.analytics`` give, under the same column names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# Names of the tables that a statement may read, by parameter.
TABLES = {
    "fleet": "daily_fleet_utilization",
    "drivers": "driver_performance",
    "sla": "delivery_sla_compliance",
    "raw_deliveries": "raw_delivery_completions",
}


def _rounded(value: str, places: int) -> str:
    """Ten decimals first, so that a tie is one whatever order the floats were summed in."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 10)), {places}) AS DOUBLE)"


STATEMENTS = {
    "underutilized_vehicles": f"""
        SELECT vehicle_id,
               {_rounded("avg(active_time_pct)", 1)} AS avg_active_pct,
               {_rounded("avg(distance_km)", 1)} AS avg_daily_km
        FROM IDENTIFIER(:fleet)
        GROUP BY vehicle_id
        ORDER BY avg_active_pct NULLS LAST, vehicle_id NULLS LAST
        LIMIT :k""",
    "driver_leaderboard": f"""
        WITH period AS (
            SELECT driver_id, sum(deliveries_completed) AS deliveries_completed,
                   sum(on_time_deliveries) AS on_time
            FROM IDENTIFIER(:drivers)
            WHERE dt BETWEEN date_sub(:last, :days - 1) AND :last
            GROUP BY driver_id)
        SELECT driver_id, deliveries_completed,
               {_rounded("100D * on_time / nullif(deliveries_completed, 0)", 1)} AS on_time_rate_pct
        FROM period
        WHERE deliveries_completed >= :least
        ORDER BY on_time_rate_pct DESC NULLS LAST, driver_id NULLS LAST
        LIMIT :k""",
    "city_sla_trend": """
        SELECT dt, city, sla_compliance_pct, total_deliveries
        FROM IDENTIFIER(:sla)
        WHERE dt >= :first AND dt <= :last
        ORDER BY city NULLS LAST, dt NULLS LAST""",
    "worst_sla_city_days": """
        SELECT dt, city, breached_deliveries, avg_breach_overage_minutes, sla_compliance_pct
        FROM IDENTIFIER(:sla)
        WHERE breached_deliveries >= 1
        ORDER BY breached_deliveries DESC, dt NULLS LAST, city NULLS LAST
        LIMIT :k""",
    "utilization_vs_hours": f"""
        WITH day_hours AS (
            SELECT dt, {_rounded("avg(hours_worked)", 2)} AS avg_driver_hours_same_day
            FROM IDENTIFIER(:drivers)
            GROUP BY dt)
        SELECT dt, vehicle_id, active_time_pct, avg_driver_hours_same_day
        FROM IDENTIFIER(:fleet) LEFT JOIN day_hours USING (dt)
        ORDER BY dt NULLS LAST, vehicle_id NULLS LAST
        LIMIT :k""",
    "raw_city_day_sla": f"""
        WITH scored AS (
            SELECT city, CASE WHEN status = 'COMPLETED'
                AND timestampdiff(MINUTE, try_cast(assigned_at AS TIMESTAMP),
                                  try_cast(completed_at AS TIMESTAMP))
                    <= try_cast(promised_minutes AS DOUBLE) THEN 100D ELSE 0D END AS score
            FROM IDENTIFIER(:raw_deliveries)
            WHERE dt = :day AND city = :city)
        SELECT city, count(*) AS total_deliveries, {_rounded("avg(score)", 1)} AS sla_compliance_pct
        FROM scored
        GROUP BY city""",
}

# What a parameter is where it is not given; first and last then have to be.
DEFAULTS = {
    "underutilized_vehicles": {"k": 5},
    "driver_leaderboard": {"k": 5, "days": 7, "least": 5},
    "city_sla_trend": {"first": dt.date(1000, 1, 1), "last": dt.date(9999, 12, 31)},
    "worst_sla_city_days": {"k": 10},
    "utilization_vs_hours": {"k": 20},
    "raw_city_day_sla": {},
}


def ask(spark: SparkSession, name: str, database: str | None = None, **parameters) -> DataFrame:
    """The answer to a statement; its tables are views of the session, or tables of ``database``.

    Days are given as dates or ISO text. The raw table is a view in any case (``lake.register_raw``).
    """
    statement = STATEMENTS[name]
    values = {**DEFAULTS[name], **parameters}
    for key in ("first", "last", "day"):
        if key in values:
            values[key] = dt.date.fromisoformat(str(values[key]))
    for key, table in TABLES.items():
        if f":{key})" in statement:
            inside = database and not table.startswith("raw_")
            values.setdefault(key, f"{database}.{table}" if inside else table)
    return spark.sql(statement, args=values)
