"""Time expressions. Timestamps are TIMESTAMP in a UTC session (see ``session.working_session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may follow a date: a clock of 12 or 24 hours, in ISO's extended or basic form, and an offset.
_CLOCK = "[ h:m:s a][ h:m a][['T'][ ][H:m:s[.SSSSSSSSS]][HHmmss[.SSSSSSSSS]][H:m][HHmm]]"
_OFFSET = "[ ][XXX][XX][X][z]"
_DIVIDERS = ("-", "/", ".")


def _with_dividers(*fields: str) -> str:
    """Optional patterns of the fields with each divider."""
    return "".join(f"[{divider.join(fields)}]" for divider in _DIVIDERS)


# The grammar: what a text has to look like to be tried, and how it is then read. The first form that
# can read a text wins, so a date of three numbers is month first unless the first is above 12.
FORMS: tuple[tuple[str, str], ...] = (
    (r"^\d{4}[-/.]\d", _with_dividers("yyyy", "M", "d")),
    (r"^\d{8}(\D|$)", "yyyyMMdd"),
    (r"^\d{14}(\D|$)", "yyyyMMddHHmmss[.SSSSSSSSS]"),
    (r"^(0?[1-9]|1[0-2])[-/.]\d{1,2}[-/.]\d{4}", _with_dividers("M", "d", "yyyy")),
    (r"^\d{1,2}[-/.](0?[1-9]|1[0-2])[-/.]\d{4}", _with_dividers("d", "M", "yyyy")),
    (r"^\d{1,2}[- ][A-Za-z]{3}", "[d-MMM-yyyy][d MMM yyyy][d MMMM yyyy][d-MMMM-yyyy]"),
    (r"^[A-Za-z]{3,9} \d", "[MMM d, yyyy][MMMM d, yyyy][MMM d yyyy][MMMM d yyyy]"),
    (r"^\d{4}[-/. ][A-Za-z]{3}", "[yyyy-MMM-d][yyyy MMM d][yyyy/MMM/d]"),
)


def parse_timestamp(text: Column) -> Column:
    """Text (or a timestamp) as TIMESTAMP; NULL where it is not one.

    ISO 8601 in its extended form (a year of four digits first) is cast, which is all that most
    sources send. Any other text is tried by the FORMS in order: ISO's basic form, dates with slashes
    or dots, month names, 12-hour clocks. An offset (``Z``, ``+05:30``, ``+0530``, ``+05``, ``UTC``) is
    applied; without one the session's zone holds. A time without a date is not completed with the
    day of the run, and a year alone needs its four digits.
    """
    shown = F.trim(text.cast("string"))
    # Cast only where the year has four digits: "202401" would be the year 202,401.
    extended = F.when(F.substring(shown, 5, 1).isin("-", ""), text.try_cast("timestamp"))
    dated = F.instr(F.substring(shown, 1, 4), ":") == 0
    tried = [extended, *[F.when(shown.rlike(like), _read(shown, form)) for like, form in FORMS]]
    return F.when(dated, F.coalesce(*tried))


def _read(text: Column, date: str) -> Column:
    return F.try_to_timestamp(text, F.lit(date + _CLOCK + _OFFSET))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end with their fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def elapsed_minutes(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(60.0)


def elapsed_hours(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def whole_minutes(start: Column, end: Column) -> Column:
    """Complete minutes from start to end, the fraction cut off."""
    return F.timestamp_diff("MINUTE", start, end)
