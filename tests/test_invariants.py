"""Random small datasets against a row-by-row model, and properties that always hold."""

import datetime as dt

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadbook.operators import cleaning
from roadbook.plans import gold
from roadbook.spec import ARRIVAL, DELIVERY_COMPLETIONS, VEHICLE_TELEMETRY

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
DAYS = [dt.date(2024, 3, n) for n in (1, 2)]

pings = st.lists(
    st.tuples(
        st.sampled_from(DAYS),
        st.sampled_from(["A", "B", None]),
        st.sampled_from(["2024-03-01T08:00:00", "2024-03-01 08:00:00.0", "2024-03-01T08:00:01", "x"]),
        st.sampled_from(["10", "160", "161", "-1", "unknown", None, "20.5"]),
        st.sampled_from(["28.4", "", "nan"]),
    ),
    max_size=60,
)

deliveries = st.lists(
    st.tuples(
        st.sampled_from(DAYS),
        st.sampled_from(["A", "B", None]),
        st.sampled_from(["Pune", "Delhi", None]),
        st.sampled_from(["COMPLETED", "FAILED", "RETURNED", None]),
        st.one_of(st.none(), st.integers(0, 7200)),
        st.sampled_from([30.0, 60.0, 45.5]),
    ),
    max_size=60,
)


def first_valid(records):
    """(day, vehicle, second) -> speed of the first valid ping, one row after the other."""
    found = {}
    for day, vehicle, time, speed, lat in records:
        try:
            valid = 0 <= float(speed) <= 160 and float(lat) == float(lat) and time != "x"
        except (TypeError, ValueError):
            valid = False
        if valid:
            found.setdefault((day, vehicle, int(time[17:19])), float(speed))
    return found


@FEW
@given(pings, st.integers(1, 9))
def test_cleaning_equals_the_model_however_rows_are_partitioned(spark, records, tasks):
    schema = f"dt date, vehicle_id string, timestamp string, speed_kmph string, lat string, {ARRIVAL} long"
    data = [(*record, n) for n, record in enumerate(records)]
    others = {c: F.lit(None).cast("string") for c in ("engine_on", "odometer_km", "city")}
    given_numbers = {c: F.lit("1") for c in ("lon", "fuel_level_pct")}
    raw = spark.createDataFrame(data, schema).withColumns(others | given_numbers)
    got = cleaning.clean(raw.repartition(tasks), VEHICLE_TELEMETRY)
    second = F.second("timestamp")
    assert rows(got, "dt", "vehicle_id", second, "speed_kmph") == sorted(
        ((*key, speed) for key, speed in first_valid(records).items()), key=repr
    )


@FEW
@given(deliveries)
def test_counts_of_gold_add_up(spark, records):
    start = dt.datetime(2024, 3, 1, 9)
    fields = [f.name for f in DELIVERY_COMPLETIONS.silver_schema]
    data = []
    for n, (day, driver, city, status, seconds, promised) in enumerate(records):
        end = None if seconds is None else start + dt.timedelta(seconds=seconds)
        row = {
            "delivery_id": str(n),
            "driver_id": driver,
            "city": city,
            "status": status,
            "assigned_at": start,
            "completed_at": end,
            "promised_minutes": promised,
            "dt": day,
        }
        data.append(tuple(row.get(f) for f in fields))
    table = spark.createDataFrame(data, DELIVERY_COMPLETIONS.silver_schema)

    def count(key, test):
        return sum(1 for r in records if (r[0], r[2]) == key and test(r))

    def late(r):
        return r[3] == "COMPLETED" and r[4] is not None and r[4] / 60 > r[5]

    sla = gold.delivery_sla_compliance(table).collect()
    assert len(sla) == len({(r[0], r[2]) for r in records})
    for row in sla:
        key = (row.dt, row.city)
        completed = count(key, lambda r: r[3] == "COMPLETED")
        assert row.total_deliveries == count(key, lambda r: True)
        assert row.failed_deliveries == count(key, lambda r: r[3] == "FAILED")
        assert row.breached_deliveries == count(key, late)
        assert row.on_time_deliveries + row.breached_deliveries <= completed
        assert row.failed_deliveries + completed <= row.total_deliveries
        assert (row.sla_compliance_pct is None) == (completed == 0)
    stats = gold.delivery_stats(table).collect()
    assert sum(r.deliveries_assigned for r in stats) == len(records)
    assert sum(r.on_time_deliveries for r in stats) == sum(r.on_time_deliveries for r in sla)
