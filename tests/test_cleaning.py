import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadbook.operators import cleaning
from roadbook.spec import (
    ARRIVAL,
    CORRUPT,
    DELIVERY_COMPLETIONS,
    DRIVER_SHIFT_LOGS,
    VEHICLE_TELEMETRY,
)

DAY = dt.date(2024, 3, 1)


def raw(spark, spec, records):
    """Raw rows of one day in the order given; fields not given are null."""
    fields = [f.name for f in spec.raw_schema]
    data = [
        tuple((DAY if f == "dt" else None) if f not in r else r[f] for f in fields) + (i,)
        for i, r in enumerate(records)
    ]
    schema = spec.raw_schema.add(ARRIVAL, "long")
    return spark.createDataFrame(data, schema)


def ping(vehicle="VEH-001", second=0, **fields):
    good = {
        "vehicle_id": vehicle,
        "timestamp": f"2024-03-01T08:00:{second:02d}",
        "lat": "28.4",
        "lon": "77.1",
        "speed_kmph": "40.5",
        "fuel_level_pct": "50",
        "engine_on": "true",
        "odometer_km": "1000.5",
        "city": "Pune",
    }
    return good | fields


def clean_pings(spark, *records):
    return cleaning.clean(raw(spark, VEHICLE_TELEMETRY, records), VEHICLE_TELEMETRY)


def test_types_after_cleaning(spark):
    assert clean_pings(spark, ping()).schema == VEHICLE_TELEMETRY.silver_schema
    row = clean_pings(spark, ping()).first()
    assert (row.speed_kmph, row.engine_on, row.dt) == (40.5, True, DAY)


@pytest.mark.parametrize("column", VEHICLE_TELEMETRY.required_numeric)
@pytest.mark.parametrize("value", ["unknown", None, "nan", ""])
def test_required_number_missing_drops_the_row(spark, column, value):
    assert clean_pings(spark, ping(**{column: value})).count() == 0


def test_other_numbers_may_be_missing(spark):
    row = clean_pings(spark, ping(odometer_km="broken")).first()
    assert row.odometer_km is None


@pytest.mark.parametrize("speed, kept", [("0", 1), ("160", 1), ("160.1", 0), ("-0.1", 0), ("inf", 0)])
def test_speed_bounds_are_inclusive(spark, speed, kept):
    assert clean_pings(spark, ping(speed_kmph=speed)).count() == kept


def test_event_time_is_required(spark):
    assert clean_pings(spark, ping(timestamp="not-a-time"), ping(timestamp=None)).count() == 0


def test_first_valid_copy_wins(spark):
    got = clean_pings(
        spark,
        ping(speed_kmph="unknown"),
        ping(speed_kmph="10"),
        ping(speed_kmph="20"),
        ping(second=1, speed_kmph="30"),
    )
    assert rows(got, "speed_kmph") == [(10.0,), (30.0,)]


def test_key_is_the_parsed_time_not_its_text(spark):
    got = clean_pings(
        spark,
        ping(timestamp="2024-03-01T08:00:00"),
        ping(timestamp="2024-03-01T08:00:00.000000"),
        ping(timestamp="2024-03-01 08:00:00"),
    )
    assert got.count() == 1


def test_same_key_on_another_day_stays(spark):
    got = clean_pings(spark, ping(), ping(dt=dt.date(2024, 3, 2)))
    assert got.count() == 2


def test_line_that_is_not_json_is_dropped(spark):
    assert clean_pings(spark, {CORRUPT: "{broken"}, ping()).count() == 1


def shift(clock_out, **fields):
    return {
        "driver_id": "DRV-001",
        "vehicle_id": "VEH-001",
        "clock_in": "2024-03-01T08:00:00",
        "clock_out": clock_out,
        "break_minutes": "30",
        "city": "Noida",
    } | fields


def test_open_shift_first_hides_the_closed_copy_unless_preferred(spark):
    records = raw(spark, DRIVER_SHIFT_LOGS, [shift(None), shift("2024-03-01T16:00:00")])
    assert cleaning.clean(records, DRIVER_SHIFT_LOGS).first().clock_out is None
    preferred = cleaning.clean(records, DRIVER_SHIFT_LOGS, prefer="clock_out").collect()
    assert [r.clock_out for r in preferred] == [dt.datetime(2024, 3, 1, 16)]


def test_bad_clock_out_means_open_shift(spark):
    got = cleaning.clean(
        raw(spark, DRIVER_SHIFT_LOGS, [shift("later"), shift(None, clock_in="soon")]),
        DRIVER_SHIFT_LOGS,
    ).collect()
    assert [r.clock_out for r in got] == [None]


def delivery(**fields):
    return {
        "delivery_id": "DEL-1",
        "driver_id": "DRV-001",
        "vehicle_id": "VEH-001",
        "assigned_at": "2024-03-01T09:00:00",
        "completed_at": "2024-03-01T09:30:00.5",
        "status": "COMPLETED",
        "promised_minutes": "45",
        "distance_km": "4.2",
        "city": "Delhi",
    } | fields


def test_delivery_rules(spark):
    records = [
        delivery(distance_km="bad"),
        delivery(promised_minutes=None),
        delivery(assigned_at="never"),
        delivery(status="FAILED", completed_at=None),
        delivery(),
        delivery(delivery_id="DEL-2"),
    ]
    got = cleaning.clean(raw(spark, DELIVERY_COMPLETIONS, records), DELIVERY_COMPLETIONS)
    assert rows(got, "delivery_id", "status") == [("DEL-1", "FAILED"), ("DEL-2", "COMPLETED")]


def test_no_required_numbers_keeps_all_rows(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "v double")
    assert cleaning.drop_malformed(df, []).count() == 2


def test_distinct_rows_changes_nothing_after_keep_first(spark):
    once = clean_pings(spark, ping(), ping(), ping(second=1))
    assert rows(cleaning.distinct_rows(once)) == rows(once)


def test_hot_key_is_cut_to_one_row_per_task_before_the_shuffle(spark, plan):
    text = plan(clean_pings(spark, ping()))
    partial, exchange = text.rindex("Partial"), text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text and partial > exchange  # below it in the tree


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    records = [
        ping(f"VEH-{rng.randrange(3)}", rng.randrange(6), speed_kmph=str(rng.randrange(-20, 190)))
        for _ in range(400)
    ]
    df = raw(spark, VEHICLE_TELEMETRY, records)
    first = rows(cleaning.clean(df, VEHICLE_TELEMETRY))
    for n in (1, 3, 7):
        mixed = df.repartition(n, F.rand(n))
        assert rows(cleaning.clean(mixed, VEHICLE_TELEMETRY)) == first


def test_cleaning_twice_changes_nothing(spark):
    rng = random.Random(6)
    records = [ping(second=rng.randrange(10), lat=rng.choice(["28.1", "x"])) for _ in range(60)]
    once = clean_pings(spark, *records)
    again = cleaning.clean(once.withColumn(ARRIVAL, F.lit(0)), VEHICLE_TELEMETRY)
    assert rows(again) == rows(once)
