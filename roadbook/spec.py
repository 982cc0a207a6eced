"""What each dataset of the lake looks like and which rows of it are valid."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Columns that bronze readers add to the data columns.
ARRIVAL = "_arrival"  # sortable position of the row among the rows of its day
VALID = "_valid"  # whether the row meets the rules of its dataset
CORRUPT = "_corrupt_record"  # text of a line that is not JSON


@dataclass(frozen=True)
class DatasetSpec:
    """One event dataset.

    columns            silver columns in order, with their Spark types
    required_numeric   numeric columns without which a row is malformed
    required_timestamp the event time, without which a row is malformed
    ranges             inclusive bounds a numeric column has to keep
    keys               natural key, unique per day after cleaning
    """

    name: str
    columns: Mapping[str, str]
    keys: tuple[str, ...]
    required_timestamp: str
    required_numeric: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    def of_type(self, sql_type: str) -> tuple[str, ...]:
        return tuple(c for c, t in self.columns.items() if t == sql_type)

    @property
    def raw_schema(self) -> T.StructType:
        """Bronze fields as text, so that a wrong type in one row loses nothing, plus the day."""
        schema = T.StructType([T.StructField(c, T.StringType()) for c in self.columns])
        return schema.add(CORRUPT, T.StringType()).add("dt", T.DateType())

    @property
    def silver_schema(self) -> T.StructType:
        schema = T.StructType()
        for name, sql_type in self.columns.items():
            schema = schema.add(name, sql_type)
        return schema.add("dt", "date")


# Dataset names, columns, required fields, speed bounds and natural keys.
# Minutes are DOUBLE although the sources send whole ones: a fraction must not be cut or dropped.
VEHICLE_TELEMETRY = DatasetSpec(
    name="vehicle_telemetry",
    columns={
        "vehicle_id": "string",
        "timestamp": "timestamp",
        "lat": "double",
        "lon": "double",
        "speed_kmph": "double",
        "fuel_level_pct": "double",
        "engine_on": "boolean",
        "odometer_km": "double",
        "city": "string",
    },
    keys=("vehicle_id", "timestamp"),
    required_timestamp="timestamp",
    required_numeric=("speed_kmph", "fuel_level_pct", "lat", "lon"),
    ranges={"speed_kmph": (0, 160)},
)

DRIVER_SHIFT_LOGS = DatasetSpec(
    name="driver_shift_logs",
    columns={
        "driver_id": "string",
        "vehicle_id": "string",
        "clock_in": "timestamp",
        "clock_out": "timestamp",
        "break_minutes": "double",
        "city": "string",
    },
    keys=("driver_id", "clock_in"),
    required_timestamp="clock_in",
)

DELIVERY_COMPLETIONS = DatasetSpec(
    name="delivery_completions",
    columns={
        "delivery_id": "string",
        "driver_id": "string",
        "vehicle_id": "string",
        "assigned_at": "timestamp",
        "completed_at": "timestamp",
        "status": "string",
        "promised_minutes": "double",
        "distance_km": "double",
        "city": "string",
    },
    keys=("delivery_id",),
    required_timestamp="assigned_at",
    required_numeric=("promised_minutes", "distance_km"),
)

DATASETS = (VEHICLE_TELEMETRY, DRIVER_SHIFT_LOGS, DELIVERY_COMPLETIONS)

# Names and columns of the gold tables.
GOLD_SCHEMAS = {
    "daily_fleet_utilization": (
        "vehicle_id string, ping_count long, avg_speed_kmph double, distance_km double, "
        "active_time_pct double, idle_time_pct double, dt date"
    ),
    "driver_performance": (
        "driver_id string, hours_worked double, deliveries_assigned long, "
        "deliveries_completed long, on_time_deliveries long, on_time_rate_pct double, "
        "avg_delivery_minutes double, dt date"
    ),
    "delivery_sla_compliance": (
        "city string, total_deliveries long, failed_deliveries long, on_time_deliveries long, "
        "breached_deliveries long, avg_breach_overage_minutes double, sla_compliance_pct double, "
        "dt date"
    ),
}
GOLD_TABLES = tuple(GOLD_SCHEMAS)
