import datetime as dt

import pytest
from pyspark.errors import PySparkException
from conftest import rows
from pyspark.sql import functions as F

from roadbook.plans import analytics, dashboard
from roadbook.spec import GOLD_SCHEMAS, GOLD_TABLES

FLEET, DRIVERS, SLA = (f"dt date, {s.removesuffix(', dt date')}" for s in GOLD_SCHEMAS.values())


def d(day):
    return dt.date(2024, 3, day)


def fleet(spark, *records):
    data = [(d(day), v, 1, 0.0, km, active, 0.0) for day, v, km, active in records]
    return spark.createDataFrame(data, FLEET)


def drivers(spark, *records):
    data = [(d(day), who, hours, n, n, ok, None, None) for day, who, hours, n, ok in records]
    return spark.createDataFrame(data, DRIVERS)


def sla(spark, *records):
    data = [(d(day), city, n, 0, 0, late, 1.5, pct) for day, city, n, late, pct in records]
    return spark.createDataFrame(data, SLA)


def collected(df):
    return [tuple(r) for r in df.collect()]


def test_underutilized_vehicles(spark):
    table = fleet(
        spark, (1, "B", 10.0, 50.0), (2, "B", 11.0, 60.0), (1, "A", 4.0, 55.0), (1, "C", 1.0, None)
    )
    got = collected(analytics.underutilized_vehicles(table))
    assert got == [("A", 55.0, 4.0), ("B", 55.0, 10.5), ("C", None, 1.0)]
    assert collected(analytics.underutilized_vehicles(table, k=1)) == [("A", 55.0, 4.0)]


def test_driver_leaderboard_takes_seven_days_and_five_deliveries(spark):
    table = drivers(
        spark,
        (1, "old", 8.0, 100, 100),  # the day before the window
        (2, "A", 8.0, 3, 3),
        (8, "A", 8.0, 3, 2),
        (8, "few", 8.0, 4, 4),
        (8, "B", None, 6, 6),
        (8, "C", 1.0, 6, 6),
    )
    got = collected(analytics.driver_leaderboard(table))
    assert got == [("B", 6, 100.0), ("C", 6, 100.0), ("A", 6, 83.3)]


def test_city_sla_trend(spark):
    table = sla(spark, (2, "Pune", 5, 0, 90.0), (1, "Pune", 4, 0, 80.0), (1, "Delhi", 3, 0, None))
    assert collected(analytics.city_sla_trend(table)) == [
        (d(1), "Delhi", None, 3),
        (d(1), "Pune", 80.0, 4),
        (d(2), "Pune", 90.0, 5),
    ]
    later = analytics.city_sla_trend(table, d(2), "2024-03-09")
    assert collected(later) == [(d(2), "Pune", 90.0, 5)]


def test_worst_sla_city_days(spark):
    table = sla(
        spark,
        (1, "Pune", 9, 2, 1.0),
        (2, "Delhi", 9, 2, 2.0),
        (1, "Delhi", 9, 2, 3.0),
        (3, "Delhi", 9, 0, 4.0),
        (4, "Delhi", 9, 7, 5.0),
    )
    got = [r[:3] for r in collected(analytics.worst_sla_city_days(table, k=3))]
    assert got == [(d(4), "Delhi", 7), (d(1), "Delhi", 2), (d(1), "Pune", 2)]


def test_utilization_vs_hours(spark):
    vehicles = fleet(
        spark, (2, "A", 1.0, 70.0), (1, "B", 1.0, 50.0), (1, "A", 1.0, 60.0), (3, "A", 1.0, 80.0)
    )
    people = drivers(
        spark, (1, "x", 8.0, 0, 0), (1, "y", 7.01, 0, 0), (1, "z", None, 0, 0), (3, "x", None, 0, 0)
    )
    expected = [
        (d(1), "A", 60.0, 7.51),
        (d(1), "B", 50.0, 7.51),
        (d(2), "A", 70.0, None),
        (d(3), "A", 80.0, None),
    ]
    assert collected(analytics.utilization_vs_hours(vehicles, people, k=None)) == expected
    assert collected(analytics.utilization_vs_hours(vehicles, people)) == expected
    assert collected(analytics.utilization_vs_hours(vehicles, people, k=2)) == expected[:2]
    assert collected(analytics.utilization_vs_hours(vehicles.limit(0), people)) == []


def test_raw_city_day_sla_counts_repeats_and_cuts_minutes(spark):
    schema = (
        "city string, status string, assigned_at string, completed_at string, "
        "promised_minutes string, dt date"
    )
    start = "2024-03-01T09:00:00"
    on_time = ("Delhi", "COMPLETED", start, "2024-03-01T09:30:54", "30", d(1))
    df = spark.createDataFrame(
        [
            on_time,
            on_time,
            ("Delhi", "COMPLETED", start, "2024-03-01T09:31:00", "30", d(1)),
            ("Delhi", "FAILED", start, None, "30", d(1)),
            ("Delhi", "COMPLETED", start, "2024-03-01T09:30:00", "30", d(2)),
            ("Pune", "COMPLETED", start, "2024-03-01T09:30:00", "30", d(1)),
        ],
        schema,
    )
    assert collected(analytics.raw_city_day_sla(df, "Delhi", d(1))) == [("Delhi", 4, 50.0)]


def test_sla_point_lookup(spark):
    table = sla(spark, (1, "Pune", 9, 2, 1.0), (1, "Delhi", 8, 2, 2.0))
    assert collected(analytics.sla_point_lookup(table, "Delhi", d(1))) == [(8, 2.0)]
    assert collected(analytics.sla_point_lookup(table, "Noida", d(1))) == []
    missing = analytics.sla_point_lookup(table, "Delhi", d(2))  # no job yet, so no failure
    for run in (missing.collect, missing.count):
        with pytest.raises(PySparkException, match="no rows on file for dt=2024-"):
            run()


def test_sla_point_lookup_starts_no_job_until_it_is_executed(spark):
    table = sla(spark, (1, "Delhi", 8, 2, 2.0))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup", "point lookup")
    try:
        found = analytics.sla_point_lookup(table, "Delhi", d(1))
        assert len(tracker.getJobIdsForGroup("lookup")) == 0
        assert collected(found) == [(8, 2.0)]
        assert len(tracker.getJobIdsForGroup("lookup")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_known_bounds_prune_folders_when_the_query_is_planned(gold_on_disk, plan):
    drivers, fleet_table = gold_on_disk["driver_performance"], gold_on_disk["daily_fleet_utilization"]
    for frame in (
        analytics.driver_leaderboard(drivers, days=2, last=d(4)),
        dashboard.in_range(drivers, fleet_table, bounds=(d(2), d(3))),
        dashboard.in_range(drivers, fleet_table, first=d(2), bounds=(d(1), d(3))),
    ):
        text = plan(frame)
        assert "PartitionFilters: [isnotnull(dt" in text and "ubquery" not in text


def test_leaderboard_up_to_a_given_day(spark):
    schema = "driver_id string, deliveries_completed long, on_time_deliveries long, dt date"
    table = spark.createDataFrame([("A", 6, 6, d(1)), ("A", 6, 3, d(8)), ("B", 6, 6, d(3))], schema)
    assert collected(analytics.driver_leaderboard(table)) == collected(
        analytics.driver_leaderboard(table, last=str(d(8)))
    )
    assert collected(analytics.driver_leaderboard(table, days=1, last=d(8))) == [("A", 6, 50.0)]


# --- dashboard --------------------------------------------------------------------------------


def test_range_defaults_to_the_days_of_the_fleet(spark):
    vehicles = fleet(spark, (2, "A", 1.0, 1.0), (4, "A", 1.0, 1.0))
    table = sla(spark, *[(day, "Pune", 1, 0, 1.0) for day in (1, 2, 3, 4, 5)])

    def days(*bounds):
        return [r[0].day for r in rows(dashboard.in_range(table, vehicles, *bounds), "dt")]

    assert days() == [2, 3, 4]
    assert days(d(3)) == [3, 4]
    assert days(None, "2024-03-02") == [2]
    assert collected(dashboard.date_bounds(vehicles)) == [(d(2), d(4))]


def test_kpis_skip_nulls(spark):
    vehicles = fleet(spark, (1, "A", 2.0, 40.0), (1, "B", 3.5, 50.0), (1, "C", None, None))
    table = sla(spark, (1, "Pune", 10, 0, 80.0), (1, "Delhi", 5, 0, None), (1, "Noida", 5, 0, 90.0))
    assert collected(dashboard.kpis(vehicles, table)) == [(45.0, 5.5, 85.0, 20)]


def test_daily_active_and_worst_vehicles(spark):
    vehicles = fleet(
        spark,
        (1, "B", 1.0, 0.1), (2, "B", 1.0, 0.2), (3, "B", 1.0, 0.3),
        (1, "A", 1.0, 0.3), (2, "A", 1.0, 0.2), (3, "A", 1.0, 0.1),
        (3, None, 1.0, 0.0),
    )
    assert [r[0] for r in collected(dashboard.daily_active(vehicles))] == [d(1), d(2), d(3)]
    # The means are equal whatever the last bits of the two sums are.
    assert [r[0] for r in collected(dashboard.worst_vehicles(vehicles))] == ["A", "B"]
    assert [r[0] for r in collected(dashboard.worst_vehicles(vehicles, k=1))] == ["A"]


def test_dashboard_leaderboard_rounds_half_to_even(spark):
    table = drivers(
        spark,
        (1, "A", None, 1000, 100),
        (2, "A", None, 1000, 149),  # 249 / 2000 = 12.45 %
        (1, "B", None, 4, 4),
        (1, None, None, 10, 10),
        (1, "C", None, 5, 5),
    )
    got = collected(dashboard.driver_leaderboard(table))
    assert got == [("C", 5, 5, 100.0), ("A", 2000, 249, 12.4)]


def test_city_series_and_worst_days(spark):
    table = sla(spark, (2, "Pune", 5, 1, 90.0), (1, "Pune", 4, 3, 80.0), (1, "Delhi", 3, 0, None))
    assert collected(dashboard.city_sla_series(table)) == [
        (d(1), "Delhi", None),
        (d(1), "Pune", 80.0),
        (d(2), "Pune", 90.0),
    ]
    assert [r[:3] for r in collected(dashboard.worst_breach_days(table))] == [
        (d(1), "Pune", 3),
        (d(2), "Pune", 1),
    ]


# --- plans over Parquet -----------------------------------------------------------------------


@pytest.fixture
def gold_on_disk(spark, tmp_path):
    """Three gold tables of ten days, by name."""
    days = range(1, 11)
    made = (
        fleet(spark, *[(n, v, 1.0, 50.0) for n in days for v in "ABC"]),
        drivers(spark, *[(n, w, 8.0, 6, 5) for n in days for w in "XYZ"]),
        sla(spark, *[(n, c, 5, n, 90.0) for n in days for c in ("Delhi", "Pune")]),
    )
    tables = {}
    for name, df in zip(GOLD_TABLES, made):
        path = f"{tmp_path}/{name}"
        df.write.partitionBy("dt").parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables



def test_last_days_are_pruned_by_partition(gold_on_disk, plan):
    text = plan(analytics.driver_leaderboard(gold_on_disk["driver_performance"]))
    assert "PartitionFilters: [isnotnull(dt" in text and ">= Subquery" in text
    assert "TakeOrderedAndProject" in text


def test_limit_goes_before_the_join_and_prunes_the_other_table(gold_on_disk, plan):
    text = plan(
        analytics.utilization_vs_hours(
            gold_on_disk["daily_fleet_utilization"], gold_on_disk["driver_performance"]
        )
    )
    join = text.index("Join")
    assert "TakeOrderedAndProject" in text[join:]
    assert "PartitionFilters: [isnotnull(dt" in text[join:] and "CartesianProduct" not in text


def test_trend_and_lookup_read_the_named_days_and_columns(gold_on_disk, plan):
    table = gold_on_disk["delivery_sla_compliance"]
    trend = plan(analytics.city_sla_trend(table, d(2), d(4)))
    assert "PartitionFilters: [isnotnull(dt" in trend
    assert "failed_deliveries" not in trend
    point = plan(analytics.sla_point_lookup(table, "Delhi", d(2)))
    assert "PushedFilters: [IsNotNull(city), EqualTo(city,Delhi)]" in point
    read = "struct<city:string,total_deliveries:bigint,sla_compliance_pct:double>"
    assert f"ReadSchema: {read}" in point


def test_kpis_are_one_aggregation_without_a_cross_join(gold_on_disk, plan):
    text = plan(
        dashboard.kpis(
            gold_on_disk["daily_fleet_utilization"], gold_on_disk["delivery_sla_compliance"]
        )
    )
    assert text.count("Exchange") == 1 and "Join" not in text and "Cartesian" not in text
