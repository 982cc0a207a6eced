"""Bronze to silver: coerce, validate, deduplicate. Every step is lazy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.functions import parse_number, parse_timestamp
from roadbook.functions.numbers import is_number
from roadbook.sources.bronze import with_arrival
from roadbook.spec import ARRIVAL, VALID, DatasetSpec


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as DOUBLE; what is not a number becomes NULL."""
    return df.withColumns({c: parse_number(F.col(c)) for c in columns})


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as TIMESTAMP; what is not one becomes NULL."""
    return df.withColumns({c: parse_timestamp(F.col(c)) for c in columns})


def drop_malformed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every column holds a number; all rows if no column is named."""
    return df.where(_all(is_number(F.col(c)) for c in columns))


def require(df: DataFrame, column: str) -> DataFrame:
    """Keep rows where the column is not NULL."""
    return df.where(F.col(column).isNotNull())


def within_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows whose columns lie inside their inclusive bounds."""
    return df.where(_all(F.col(c).between(low, high) for c, (low, high) in ranges.items()))


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (ARRIVAL,)
) -> DataFrame:
    """The first row, by ``order``, of each key within a day.

    ``row_number() = 1`` lets Spark keep one row per key in every map task (WindowGroupLimit)
    before it shuffles, so a key that holds a third of all rows costs its reducer one row per task.
    """
    first = Window.partitionBy("dt", *keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop rows that equal another one in every column.

    After ``keep_first`` it changes nothing: equal rows share their key.
    """
    return df.distinct()


def typed(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Raw fields with their silver types, NULL where a value does not fit."""
    rows = coerce_numeric(raw, spec.of_type("double"))
    rows = parse_timestamps(rows, spec.of_type("timestamp"))
    return rows.withColumns({c: F.col(c).try_cast("boolean") for c in spec.of_type("boolean")})


def judged(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All rows of a raw dataset typed, with VALID; of a row that is not valid only ``dt`` remains.

    Written once, it says how many rows came in on each day and how many of them were valid, and the
    rest of cleaning reads columns of it instead of raw text.
    """
    rows = typed(raw, spec)
    if ARRIVAL not in rows.columns:
        rows = with_arrival(rows)
    ranges = [F.col(c).between(low, high) for c, (low, high) in spec.ranges.items()]
    required = [is_number(F.col(c)) for c in spec.required_numeric]
    valid = _all([*required, F.col(spec.required_timestamp).isNotNull(), *ranges])
    rows = rows.withColumn(VALID, F.coalesce(valid, F.lit(False)))
    kept = [F.when(F.col(VALID), F.col(c)).alias(c) for c in (*spec.columns, ARRIVAL)]
    return rows.select(*kept, VALID, "dt")


def _valid(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    df = drop_malformed(df, spec.required_numeric)
    df = require(df, spec.required_timestamp)
    return within_ranges(df, spec.ranges)


def clean(raw: DataFrame, spec: DatasetSpec, prefer: str | None = None) -> DataFrame:
    """Silver rows of a raw dataset, as ``read_raw`` gives it or with an ARRIVAL column of its own.

    Validity comes before deduplication, so an invalid first copy does not hide a good later one.
    With ``prefer`` (say ``clock_out``), copies that fill this column win over earlier ones that
    do not; by default the first copy wins even if it is less complete.
    """
    rows = typed(raw, spec)
    if ARRIVAL not in rows.columns:
        rows = with_arrival(rows)
    valid = _valid(rows, spec)
    return keep_first(valid, spec.keys, first_by(prefer)).select(*spec.columns, "dt")


def first_by(prefer: str | None) -> list[str | Column]:
    """The order in which copies win: by arrival, those that fill ``prefer`` before the others."""
    return [ARRIVAL] if prefer is None else [F.col(prefer).isNull(), ARRIVAL]


def _all(conditions) -> Column:
    return reduce(and_, conditions, F.lit(True))
