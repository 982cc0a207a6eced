import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadbook.operators import skew
from roadbook.plans import gold
from roadbook.spec import DELIVERY_COMPLETIONS, DRIVER_SHIFT_LOGS, VEHICLE_TELEMETRY

DAY = dt.date(2024, 3, 1)


def at(hour, minute=0, second=0, micro=0):
    return dt.datetime(2024, 3, 1, hour, minute, second, micro)


def table(spark, spec, records):
    fields = [f.name for f in spec.silver_schema]
    data = [tuple(({"dt": DAY} | r).get(f) for f in fields) for r in records]
    return spark.createDataFrame(data, spec.silver_schema)


def shifts(spark, *records):
    return table(spark, DRIVER_SHIFT_LOGS, records)


def deliveries(spark, *records):
    return table(spark, DELIVERY_COMPLETIONS, records)


def worked(driver, start, end, break_minutes=0.0):
    return {
        "driver_id": driver,
        "clock_in": start,
        "clock_out": end,
        "break_minutes": break_minutes,
    }


def done(driver="A", minutes=30.0, promised=45.0, status="COMPLETED", city="Pune", **fields):
    start = at(9)
    end = None if minutes is None else start + dt.timedelta(minutes=minutes)
    return {
        "driver_id": driver,
        "city": city,
        "status": status,
        "assigned_at": start,
        "completed_at": end,
        "promised_minutes": promised,
    } | fields


def test_daily_fleet_utilization(spark):
    pings = [
        {"vehicle_id": "V", "speed_kmph": s, "odometer_km": o, "engine_on": e}
        for s, o, e in [(10.0, 5.5, True), (20.0, 2.0, True), (30.005, None, None)]
    ]
    got = gold.daily_fleet_utilization(table(spark, VEHICLE_TELEMETRY, pings)).collect()
    assert [tuple(r) for r in got] == [(DAY, "V", 3, 20.0, 3.5, 66.7, 33.3)]


def test_shift_hours_of_closed_shifts(spark):
    got = gold.shift_hours(
        shifts(
            spark,
            worked("A", at(8, 43), at(16, 37, 50, 562497), 15.0),
            worked("B", at(8), at(10), None),
            worked("C", at(8), None, 15.0),
        )
    )
    assert rows(got, "driver_id", "hours_worked") == [("A", 7.66), ("B", 2.0)]


def test_delivery_stats(spark):
    got = gold.delivery_stats(
        deliveries(
            spark,
            done(minutes=45.0),
            done(minutes=45.01),
            done(minutes=None, status="FAILED"),
            done(minutes=None),  # completed at an unknown time: neither on time nor late
            done(minutes=10.0, status="RETURNED"),
            done("B", minutes=None, status="FAILED"),
        )
    )
    assert rows(got) == [(DAY, "A", 5, 3, 1, 45.01), (DAY, "B", 1, 0, 0, None)]


def test_delivery_sla_compliance(spark):
    got = gold.delivery_sla_compliance(
        deliveries(
            spark,
            done(minutes=45.0),
            done(minutes=50.0),
            done(minutes=46.0),
            done(minutes=None),
            done(minutes=None, status="FAILED"),
            done(minutes=10.0, status="RETURNED"),
            done(minutes=None, status=None),
            done(minutes=None, status="FAILED", city="Noida"),
        )
    )
    assert rows(got) == [
        (DAY, "Noida", 1, 1, 0, 0, None, None),
        (DAY, "Pune", 7, 1, 1, 2, 3.0, 25.0),
    ]


def performance(spark, **options):
    return gold.driver_performance(
        shifts(
            spark,
            worked("A", at(6), at(8)),
            worked("A", at(10), at(13)),
            worked("C", at(6), at(7)),
            worked("D", at(6), None),
            worked(None, at(6), at(7)),
        ),
        deliveries(spark, done(), done("B", minutes=60.0), done(None)),
        **options,
    )


def test_driver_performance_joins_both_sides(spark):
    assert rows(performance(spark)) == sorted(
        [
            (DAY, "A", 2.0, 1, 1, 1, 100.0, 30.0),
            (DAY, "A", 3.0, 1, 1, 1, 100.0, 30.0),
            (DAY, "B", None, 1, 1, 0, 0.0, 60.0),
            (DAY, "C", 1.0, 0, 0, 0, None, None),
            (DAY, None, 1.0, 0, 0, 0, None, None),
            (DAY, None, None, 1, 1, 1, 100.0, 30.0),
        ],
        key=repr,
    )


def test_driver_performance_with_one_row_per_driver_day(spark):
    got = rows(performance(spark, one_row_per_driver_day=True), "driver_id", "hours_worked")
    assert ("A", 5.0) in got and len([r for r in got if r[0] == "A"]) == 1


def test_splitting_hot_drivers_changes_nothing(spark):
    assert rows(performance(spark, rows_per_part=1)) == rows(performance(spark))


@pytest.fixture
def skewed(spark):
    """300 of 420 rows on one key, 60 without a key, the rest spread; ``one`` lacks some keys."""
    n = F.col("id")
    key = F.when(n < 300, "hot").when(n < 360, None).otherwise(F.concat(F.lit("k"), n % 40))
    many = spark.range(420).select(key.alias("k"), n.alias("v"))
    names = ["hot", None, *[f"k{i}" for i in range(0, 60, 2)]]
    one = spark.createDataFrame([(k, i) for i, k in enumerate(names)], "k string, n int")
    return one, many


@pytest.mark.parametrize("rows_per_part", [1, 7, 50, 1000])
def test_split_join_equals_plain_full_outer_join(skewed, rows_per_part):
    one, many = skewed
    got = skew.full_outer_one_to_many(one, many, ["k"], ["v"], rows_per_part)
    assert rows(got, "k", "n", "v") == rows(one.join(many, "k", "full_outer"), "k", "n", "v")


def test_hot_keys_have_a_share_of_the_rows(skewed, monkeypatch):
    _, many = skewed
    counts = skew.rows_per_key(many, ["k"])
    assert rows(skew.hot_keys(counts, 50)) == [("hot", 6)]
    assert skew.hot_keys(counts, 1).count() == counts.where("_rows > 1").count() > 1
    monkeypatch.setattr(skew, "HOT_SHARE_OF", 2)
    assert rows(skew.hot_keys(counts, 1)) == [("hot", 300)]


def test_two_thousand_hot_keys_are_all_split(spark):
    many = spark.range(6_000).select((F.col("id") % 2_000).alias("k"))
    assert skew.hot_keys(skew.rows_per_key(many, ["k"]), 2).count() == 2_000


def test_keys_with_a_small_share_join_unsplit(skewed, monkeypatch):
    monkeypatch.setattr(skew, "HOT_SHARE_OF", 2)
    one, many = skewed
    got = skew.full_outer_one_to_many(one, many, ["k"], ["v"], 1)
    assert rows(got, "k", "n", "v") == rows(one.join(many, "k", "full_outer"), "k", "n", "v")


def test_hot_key_and_missing_key_are_spread_over_tasks(spark, skewed):
    one, many = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = skew.full_outer_one_to_many(one, many, ["k"], ["v"], 10)
        tasks = dict(
            got.select("k", F.spark_partition_id().alias("task"))
            .groupBy("k")
            .agg(F.countDistinct("task"))
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks["hot"] > 4 and tasks[None] > 4


def test_drivers_join_reads_deliveries_once(spark, tmp_path):
    shifts(spark, worked("A", at(6), at(8))).write.parquet(f"{tmp_path}/s")
    deliveries(spark, done()).write.parquet(f"{tmp_path}/d")
    joined = gold.driver_performance(*(spark.read.parquet(f"{tmp_path}/{n}") for n in "sd"))
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert len([line for line in scans if "assigned_at" in line]) == 1
    assert "FullOuter" not in final and "Cartesian" not in final and "NestedLoop" not in final


def test_gold_tables_pre_aggregate_before_the_shuffle(spark, plan):
    text = plan(gold.delivery_sla_compliance(deliveries(spark, done())))
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("partial_count")
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
