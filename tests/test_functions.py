import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadbook import functions as fn


def values(spark, data, schema, expression):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in data], schema)
    return [row[0] for row in df.select(expression).collect()]


def test_parse_number_keeps_numbers_and_nulls_the_rest(spark):
    texts = ["1.5", " 2 ", "-3e2", "unknown", "", None, "12d", "1.5F", "7.D ", "true", "0x1A"]
    got = values(spark, texts, "v string", fn.parse_number(F.col("v")))
    assert got == [1.5, 2.0, -300.0] + [None] * 8


def test_parse_number_of_non_finite_text(spark):
    texts = ["inf", "-Infinity", "nan", "NaN "]
    got = values(spark, texts, "v string", fn.parse_number(F.col("v")))
    assert got == [float("inf"), float("-inf"), None, None]


def test_parse_number_leaves_doubles(spark):
    numbers = [1.5, 1e300, float("nan"), None]
    got = values(spark, numbers, "v double", fn.parse_number(F.col("v")))
    assert got == [1.5, 1e300, None, None]


def test_parse_timestamp(spark):
    texts = ["2024-01-02T03:04:05", "2024-01-02T03:04:05.678901", "not-a-time", "12:30", None, ""]
    got = values(spark, texts, "v string", F.unix_micros(fn.parse_timestamp(F.col("v"))))
    second = 1_704_164_645
    assert got == [second * 10**6, second * 10**6 + 678901, None, None, None, None]


# Texts that pandas reads as well, each on its own.
READ_ALIKE = """
2024-01-02T03:04:05|2024-01-02 03:04|2024-01-02|2024-1-2 3:4:5|2024-01|2024|2024-01-02T03
2024-01-02T03:04:05Z|2024-01-02T03:04:05z|2024-01-02T03:04:05+05:30|2024-01-02T03:04:05+0530
2024-01-02T03:04:05+05|2024-01-02 03:04:05 +05:30|2024-01-02 03:04:05 UTC|2024-01-02t03:04:05
2024/01/02|2024/1/2 03:04:05|2024.01.02|01/02/2024|13/01/2024|1/2/2024 3:04 PM|20240102
20240102T030405|20240102 030405|20240102030405|20240102T0304|20240102T030405Z|20240102T030405+0530
2 Jan 2024|02-Jan-2024 10:00|Jan 2, 2024|January 2, 2024 10:00:00 pm|2 January 2024|2024-Jan-02
2024-01-02 03:04:05 AM|2024-01-02 12:04 am|01-02-2024|01.02.2024|2024-01-02T030405|2024-01-02 3:04:05.5
2024-02-29|2024-01-02T03:04:05.123456+05:30|  2024-01-02 |2024-01-02T03:04:05-08:00
2023-02-29|2024-02-30|2024-13-01|2024-01-02T24:00:00|2024-01-02T03:04:60|2024-01-02 13:04 PM|202401
2024-002|2024-W01-2|T12:30|1704164645|NaT||not-a-time|12024-01-02|31/02/2024|20241301|2024-01-02 25:00
""".strip("\n").replace("\n", "|").split("|")


def test_parse_timestamp_reads_what_pandas_reads(spark):
    import pandas as pd

    got = values(spark, READ_ALIKE, "v string", F.unix_micros(fn.parse_timestamp(F.col("v"))))
    for text, micros in zip(READ_ALIKE, got):
        expected = pd.to_datetime(text, errors="coerce", utc=True)
        assert micros == (None if expected is pd.NaT else expected.value // 1000), text


def test_parse_timestamp_takes_no_time_without_a_date(spark):
    texts = ["12:30", "9:05", "12:30:00", "T12:30", "12:3-05:00", "now", "today", " 7:15 ", "noon"]
    assert values(spark, texts, "v string", fn.parse_timestamp(F.col("v"))) == [None] * len(texts)


def test_parse_timestamp_leaves_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05.678901' AS v UNION ALL SELECT NULL")
    got = df.select(F.unix_micros(fn.parse_timestamp(F.col("v")))).collect()
    assert [r[0] for r in got] == [1_704_164_645_678_901, None]


@pytest.mark.parametrize(
    "value, places, expected",
    [
        (1.005, 2, 1.01),
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (12.349999999, 2, 12.35),
        (66.66666, 1, 66.7),
        (1e15, 1, 1e15),
        (1e300, 2, 1e300),
        (None, 2, None),
    ],
)
def test_round_half_up(spark, value, places, expected):
    assert values(spark, [value], "v double", fn.round_half_up(F.col("v"), places)) == [expected]


def test_round_half_up_passes_non_finite_values(spark):
    got = values(
        spark, [float("inf"), float("nan")], "v double", fn.round_half_up(F.col("v"), 2)
    )
    assert got[0] == float("inf") and got[1] != got[1]


def test_round_half_even(spark):
    got = values(
        spark, [12.45, 12.35, 0.25, 0.75, -0.25], "v double", fn.round_half_even(F.col("v"), 1)
    )
    assert got == [round(v * 10) / 10 for v in (12.45, 12.35, 0.25, 0.75, -0.25)]


def test_percent_is_null_without_a_whole(spark):
    got = values(
        spark, [(1, 8), (1, 0), (0, 5), (None, 5)], "a long, b long", fn.percent(F.col("a"), F.col("b"))
    )
    assert got == [12.5, None, 0.0, None]


def test_elapsed_and_whole_minutes(spark):
    start = dt.datetime(2024, 1, 1, 8, 0, 50)
    end = dt.datetime(2024, 1, 1, 8, 31, 44, 562497)
    a, b = F.col("a"), F.col("b")
    row = (
        spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
        .select(
            fn.elapsed_seconds(a, b),
            fn.elapsed_minutes(a, b),
            fn.elapsed_hours(a, b),
            fn.whole_minutes(a, b),
        )
        .first()
    )
    assert row[0] == 1854.562497
    assert row[1] == 1854.562497 / 60.0
    assert row[2] == 1854.562497 / 3600.0
    assert row[3] == 30


def test_whole_minutes_counts_complete_ones(spark):
    start, end = dt.datetime(2024, 1, 1, 0, 0, 50), dt.datetime(2024, 1, 1, 0, 1, 10)
    df = spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
    assert df.select(fn.whole_minutes(F.col("a"), F.col("b"))).first()[0] == 0


def test_human_bytes(spark):
    sizes = [0, 1023, 1024, 1280, 1792, 988536, 5277, 1024**2, 3 * 1024**3, 5 * 1024**4, 1024**5]
    got = values(spark, sizes, "v long", fn.human_bytes(F.col("v")))

    def expected(n):
        for unit in ("B", "KB", "MB", "GB"):
            if n < 1024:
                return f"{n:.1f} {unit}"
            n /= 1024
        return f"{n:.1f} TB"

    assert got == [expected(n) for n in sizes]


@pytest.mark.parametrize(("value", "places", "expected"), [(2.0049997, 2, 2.0), (49.9499996, 1, 49.9)])
def test_rounding_once(spark, value, places, expected):
    assert values(spark, [value], "v double", fn.round_half_up(F.col("v"), places)) == [expected]


def test_hexadecimal_floats_are_no_numbers(spark):
    assert values(spark, ["0x1p3", "8"], "v string", fn.parse_number(F.col("v"))) == [None, 8.0]
