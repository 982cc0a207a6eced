"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """Text (or a number) as DOUBLE; NULL where it is not a number.

    Java's parser also takes "NaN", a type suffix ("12d", "1.5f") and hexadecimal floats ("0x1p3"),
    which are no numbers here.
    """
    shown = F.rtrim(text.cast("string"))
    lettered = F.substring(shown, -1, 1).isin("d", "D", "f", "F", "n", "N") & ~F.endswith(
        F.lower(shown), F.lit("inf")
    )
    hexadecimal = F.contains(F.lower(shown), F.lit("x"))
    return F.when(~lettered & ~hexadecimal, text.try_cast("double"))


def is_number(value: Column) -> Column:
    """Neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def round_half_up(value: Column, places: int) -> Column:
    """ROUND of a double by its decimal digits, ties away from zero.

    Going through ten decimals first makes a tie a tie whatever the summation order left in the
    last bits. Values that do not fit the decimal (huge, infinite, NaN) are rounded as they are.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), places).cast("double")
    return F.coalesce(exact, F.round(value, places))


def round_half_even(value: Column, places: int) -> Column:
    """Round a double to the nearest multiple of 10^-places, ties to the even digit."""
    scale = F.lit(10.0**places)
    return F.bround(value * scale, 0) / scale


def stable(value: Column) -> Column:
    """Sort key for a float aggregate: equal means stay equal in whatever order they were summed."""
    return round_half_up(value, 6)


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent, as DOUBLE; NULL where the whole is 0 or NULL."""
    return F.try_divide(part * F.lit(100.0), whole)


def human_bytes(size: Column) -> Column:
    """A byte count as text: one decimal, steps of 1024, B to TB, ties to the even digit."""
    text = None
    for power, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        scaled = F.bround(size / F.lit(float(1024**power)), 1)
        shown = F.format_string(f"%.1f {unit}", scaled)
        below = size < F.lit(1024 ** (power + 1))
        if unit == "TB":
            return text.otherwise(shown)
        text = F.when(below, shown) if text is None else text.when(below, shown)
