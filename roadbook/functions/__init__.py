"""Column expressions shared by the plans. All are built-in Spark SQL, no Python runs per row."""

from roadbook.functions.numbers import (
    human_bytes,
    parse_number,
    percent,
    round_half_even,
    round_half_up,
    stable,
)
from roadbook.functions.times import (
    elapsed_hours,
    elapsed_minutes,
    elapsed_seconds,
    parse_timestamp,
    whole_minutes,
)

__all__ = [
    "elapsed_hours",
    "elapsed_minutes",
    "elapsed_seconds",
    "human_bytes",
    "parse_number",
    "parse_timestamp",
    "percent",
    "round_half_even",
    "round_half_up",
    "stable",
    "whole_minutes",
]
