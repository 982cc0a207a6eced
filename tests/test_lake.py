import datetime as dt
import glob
import gzip
import json
import logging
import os
import re
import shutil

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadbook import session
from roadbook.__main__ import main as command
from roadbook.operators import dedupe, footprint, reports
from roadbook.operators.cleaning import clean
from roadbook.plans import analytics, dashboard, job, schedule, statements
from roadbook.session import scratch_dir
from roadbook.sources import bronze, listing, manifest, sample
from roadbook.sources import lake as zones
from roadbook.spec import (
    ARRIVAL,
    DATASETS,
    DELIVERY_COMPLETIONS,
    DRIVER_SHIFT_LOGS,
    GOLD_SCHEMAS,
    VEHICLE_TELEMETRY,
)
from roadbook.streaming.arrivals import refresh_on_arrival

DAY_1, DAY_2, DAY_3 = (dt.date(2024, 3, n) for n in (1, 2, 3))


def land_lines(lake, spec, day, records, part=0):
    """Raw files as a source system writes them."""
    folder = f"{lake.raw(spec.name)}/dt={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-{part:04d}.json", "w") as out:
        for record in records:
            out.write(record if isinstance(record, str) else json.dumps(record))
            out.write("\n")


def shift(driver, day, clock_out="16:00:00", break_minutes=30):
    return {
        "driver_id": driver,
        "vehicle_id": "VEH-001",
        "clock_in": f"{day}T08:00:00",
        "clock_out": clock_out and f"{day}T{clock_out}",
        "break_minutes": break_minutes,
        "city": "Pune",
    }


def ping(vehicle, day, second, **fields):
    return {
        "vehicle_id": vehicle,
        "timestamp": f"{day}T08:00:{second:02d}",
        "lat": 28.4,
        "lon": 77.1,
        "speed_kmph": 40.0,
        "fuel_level_pct": 50.0,
        "engine_on": True,
        "odometer_km": 100.0 + second,
        "city": "Pune",
    } | fields


def delivery(number, day, done="09:30:00", **fields):
    return {
        "delivery_id": f"DEL-{number}",
        "driver_id": "DRV-001",
        "vehicle_id": "VEH-001",
        "assigned_at": f"{day}T09:00:00",
        "completed_at": done and f"{day}T{done}",
        "status": "COMPLETED" if done else "FAILED",
        "promised_minutes": 45,
        "distance_km": 4.2,
        "city": "Delhi",
    } | fields


def fill(lake, day):
    """A day with one defect of each kind in every dataset."""
    land_lines(
        lake,
        VEHICLE_TELEMETRY,
        day,
        [
            ping("VEH-001", day, 0, speed_kmph="unknown"),
            ping("VEH-001", day, 0),
            ping("VEH-001", day, 0),
            ping("VEH-001", day, 5, engine_on=False),
            ping("VEH-001", day, 6, lat=None),
            ping("VEH-002", day, 7, speed_kmph=161),
            "{this is not json",
        ],
    )
    land_lines(
        lake,
        DRIVER_SHIFT_LOGS,
        day,
        [
            shift("DRV-001", day),
            shift("DRV-002", day, None),
            shift("DRV-001", day, None),
            shift("DRV-002", day),
            shift("DRV-003", day, break_minutes=None),
        ],
    )
    land_lines(
        lake,
        DELIVERY_COMPLETIONS,
        day,
        [delivery(1, day), delivery(1, day), delivery(2, day, "09:50:00"), delivery(3, day, None)],
    )


@pytest.fixture
def lake(tmp_path):
    return zones.Lake(str(tmp_path / "lake"))


@pytest.fixture
def filled(lake):
    fill(lake, DAY_1)
    fill(lake, DAY_2)
    return lake


# --- bronze -----------------------------------------------------------------------------------


def test_raw_fields_are_text_and_the_day_comes_from_the_path(spark, filled):
    raw = bronze.read_raw(spark, filled.raw("vehicle_telemetry"), VEHICLE_TELEMETRY)
    assert dict(raw.dtypes)["speed_kmph"] == "string" and dict(raw.dtypes)["dt"] == "date"
    assert rows(raw.where("speed_kmph = 'unknown'"), "engine_on", "dt") == [
        ("true", DAY_1),
        ("true", DAY_2),
    ]
    assert raw.count() == 14


def test_only_the_named_days_are_read(spark, filled, plan):
    raw = bronze.read_raw(
        spark, filled.raw("vehicle_telemetry"), VEHICLE_TELEMETRY, [DAY_2]
    )
    assert rows(raw.select("dt").distinct()) == [(DAY_2,)]
    assert f"(dt#" in plan(raw).split("PartitionFilters")[1].split("]")[0]


def test_arrival_follows_line_order_in_split_files(spark, lake):
    records = [{"vehicle_id": f"{n:06d}", "city": "x" * 50} for n in range(5000)]
    land_lines(lake, VEHICLE_TELEMETRY, DAY_1, records[:3000], part=0)
    land_lines(lake, VEHICLE_TELEMETRY, DAY_1, records[3000:], part=1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = bronze.with_arrival(
            bronze.read_raw(spark, lake.raw("vehicle_telemetry"), VEHICLE_TELEMETRY)
        )
        assert raw.rdd.getNumPartitions() > 5
        found = [r.vehicle_id for r in raw.orderBy(ARRIVAL).select("vehicle_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [r["vehicle_id"] for r in records]


def test_missing_dataset_is_empty_with_a_message(spark, lake, caplog):
    with caplog.at_level(logging.WARNING):
        raw = bronze.read_raw(spark, lake.raw("vehicle_telemetry"), VEHICLE_TELEMETRY)
    assert raw.count() == 0 and "no raw files" in caplog.text
    assert {*VEHICLE_TELEMETRY.columns, "dt", ARRIVAL} <= set(bronze.with_arrival(raw).columns)
    assert bronze.raw_lines(spark, lake.raw("vehicle_telemetry")).count() == 0


def test_landing_keeps_nulls_and_arrival_order(spark, lake):
    n = F.col("id")
    day = F.when(n % 3 == 0, F.lit(DAY_1)).otherwise(F.lit(DAY_2))
    df = spark.range(3000).select(
        n.cast("string").alias("vehicle_id"),
        F.lit(None).cast("string").alias("city"),
        day.alias("dt"),
        (-n).alias(ARRIVAL),
    )
    path = lake.raw("vehicle_telemetry")
    bronze.land_raw(df.repartition(5), path)
    lines = [json.loads(x) for f in glob.glob(f"{path}/dt={DAY_1}/*.json") for x in open(f)]
    assert set(lines[0]) == {"vehicle_id", "city"}
    back = bronze.with_arrival(bronze.read_raw(spark, path, VEHICLE_TELEMETRY, [str(DAY_1)]))
    order = [int(r.vehicle_id) for r in back.orderBy(ARRIVAL).select("vehicle_id").collect()]
    assert order == sorted(range(0, 3000, 3), reverse=True)


def test_sample_deliveries_are_landed_compressed_with_the_copies_of_a_key_in_order(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(sample, "LAND_ROWS", 40)
    spark.range(1, 61).selectExpr(
        "id AS o_orderkey", "id * 3 AS o_custkey", "concat(id % 5 + 1, '-X') AS o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(480).selectExpr(
        "id % 60 + 1 AS l_orderkey", "1000 - id AS l_partkey", "id % 7 AS l_suppkey",
        "int(id % 2) AS l_linenumber", "double(id % 50 + 1) AS l_quantity", "double(id) AS l_extendedprice",
        "0.05D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus",
        "timestamp '1995-01-01' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    path = lake.raw("delivery_completions")
    sample.land(spark, str(tmp_path), "delivery_completions", path)
    files = glob.glob(f"{path}/dt=*/*")
    assert files and all(f.endswith(".json.gz") for f in files)
    lines = [(json.loads(x)["delivery_id"], f, n) for f in files for n, x in enumerate(gzip.open(f, "rt"))]
    assert len(lines) == 480
    places = {}
    for key, file, _ in lines:
        places.setdefault(key, set()).add(file)
    assert all(len(of) == 1 for of in places.values()) and len({f for _, f, _ in lines}) > 30
    raw = bronze.read_raw(spark, path, DELIVERY_COMPLETIONS)
    first = clean(raw, DELIVERY_COMPLETIONS)
    wanted = clean(sample.deliveries(spark, str(tmp_path)), DELIVERY_COMPLETIONS)
    assert rows(first) == rows(wanted) and first.count() == len(places)
    days = job.list_raw(spark, lake)["delivery_completions"]
    assert sum(d.bytes for d in days.values()) == listing.GZIPPED * sum(map(os.path.getsize, files))


def test_sample_deliveries_are_sorted_before_they_are_made_into_records(spark, lake, tmp_path, monkeypatch):
    spark.range(6).selectExpr("id AS o_orderkey", "id AS o_custkey", "'1-X' AS o_orderpriority").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    spark.range(12).selectExpr(
        "id % 6 AS l_orderkey", "20 - id AS l_partkey", "id AS l_suppkey", "int(id) AS l_linenumber",
        "1D AS l_quantity", "2D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
        "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp '1995-01-01' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    plans, land_raw = [], sample.land_raw

    def watched(records, *others, **named):
        plans.append(records._jdf.queryExecution().optimizedPlan().toString().splitlines())
        return land_raw(records, *others, **named)

    monkeypatch.setattr(sample, "land_raw", watched)
    path = lake.raw("delivery_completions")
    sample.land(spark, str(tmp_path), "delivery_completions", path)
    (steps,) = plans
    made = next(n for n, step in enumerate(steps) if "AS delivery_id" in step)
    ordered = [n for n, step in enumerate(steps) if "Sort [" in step]
    assert len(ordered) == 1 and ordered[0] > made
    files = glob.glob(f"{path}/dt=*/*.json")
    lines = [[json.loads(x) for x in open(f)] for f in files]
    assert len(lines) == 6
    for two in lines:  # the line of the smaller l_partkey, which has the larger number, comes first
        numbers = [int(line["delivery_id"].split("-")[2]) for line in two]
        assert len(numbers) == 2 and numbers[0] == numbers[1] + 6


def test_landing_again_replaces_only_its_days(spark, lake):
    path = lake.raw("driver_shift_logs")
    schema = "driver_id string, dt date"
    bronze.land_raw(spark.createDataFrame([("a", DAY_1), ("b", DAY_2)], schema), path)
    bronze.land_raw(spark.createDataFrame([("c", DAY_2)], schema), path)
    assert rows(bronze.infer_raw(spark, path)) == [("a", DAY_1), ("c", DAY_2)]


def test_inferred_scan_finds_types(spark, filled):
    raw = bronze.infer_raw(spark, filled.raw("delivery_completions"))
    assert dict(raw.dtypes)["promised_minutes"] == "bigint"
    assert dict(raw.dtypes)["dt"] == "date"


@pytest.mark.parametrize("spec", DATASETS, ids=lambda spec: spec.name)
def test_cleaning_parses_once_and_stays_small_enough_to_be_compiled(spark, filled, plan, spec):
    cleaned = clean(bronze.read_raw(spark, filled.raw(spec.name), spec), spec)
    text = plan(cleaned)
    checks = [line for line in text.splitlines() if "Filter " in line and "_rank" not in line]
    assert checks and not any("cast(" in line for line in checks)
    cleaned.collect()
    execution = cleaned._jdf.queryExecution()
    stages = spark._jvm.PythonSQLUtils.explainString(execution, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", stages)]
    assert sizes and max(sizes) < 8000  # the JVM interprets larger methods


# --- silver and gold on disk ------------------------------------------------------------------


def test_job_from_raw_files_to_answers(spark, filled):
    result = job.run(spark, filled, cost_of=("Delhi", DAY_2))
    assert rows(result.cleaning) == [
        ("delivery_completions", 8, 6, 2, 25.0),
        ("driver_shift_logs", 10, 6, 4, 40.0),
        ("vehicle_telemetry", 14, 4, 10, 71.4),
    ]
    assert rows(result.gold) == [
        ("daily_fleet_utilization", 2, 2),
        ("delivery_sla_compliance", 2, 2),
        ("driver_performance", 4, 2),
    ]
    assert rows(spark.table("driver_performance").where(F.col("dt") == F.lit(DAY_1)).drop("dt")) == [
        ("DRV-001", 7.5, 3, 2, 1, 50.0, 40.0),
        ("DRV-003", 8.0, 0, 0, 0, None, None),
    ]
    assert rows(spark.table("daily_fleet_utilization").drop("dt"))[0] == (
        "VEH-001", 2, 40.0, 5.0, 50.0, 50.0,
    )
    answers = {name: rows(df) for name, df in result.queries.items()}
    assert answers["underutilized_vehicles"] == [("VEH-001", 50.0, 5.0)]
    assert answers["driver_leaderboard_7d"] == []
    assert answers["worst_sla_city_days"][0] == (DAY_1, "Delhi", 1, 5.0, 50.0)
    assert answers["utilization_vs_hours"] == [
        (DAY_1, "VEH-001", 50.0, 7.75),
        (DAY_2, "VEH-001", 50.0, 7.75),
    ]
    raw = glob.glob(f"{filled.raw('delivery_completions')}/*/*.json")
    curated = glob.glob(f"{filled.curated('delivery_sla_compliance')}/dt={DAY_2}/*.parquet")
    cost = result.cost.first()
    assert cost.before.asDict() == {
        "bytes_scanned": sum(map(os.path.getsize, raw)),
        "files_touched": 2,
        "rows_matched": 8,
    }
    assert cost.after.asDict() == {
        "bytes_scanned": os.path.getsize(curated[0]),
        "files_touched": 1,
        "rows_matched": 1,
    }
    assert len(glob.glob(f"{filled.cost_report}/*.json")) == 1


def test_command_line_prints_the_answers(spark, filled, capsys, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    command(["run", "--lake", filled.base, "--city", "Delhi", "--day", str(DAY_1)])
    shown = capsys.readouterr().out
    assert "driver_leaderboard_7d" in shown and "reduction_pct" in shown
    command(["silver", "--lake", filled.base, "--only", str(DAY_1)])
    command(["gold", "--lake", filled.base, "--only", str(DAY_1)])
    command(["queries", "--lake", filled.base])
    assert "worst_sla_city_days" in capsys.readouterr().out


def test_dataset_that_never_arrived_leaves_its_tables_empty(spark, lake):
    land_lines(lake, DELIVERY_COMPLETIONS, DAY_1, [delivery(1, DAY_1)])
    result = job.run(spark, lake)
    assert rows(result.cleaning)[2] == ("vehicle_telemetry", 0, 0, 0, 0.0)
    assert rows(spark.table("driver_performance"), "driver_id", "hours_worked") == [("DRV-001", None)]
    assert spark.table("daily_fleet_utilization").count() == 0


def test_small_days_are_written_as_one_file(spark, filled):
    job.build_silver(spark, filled)
    assert len(glob.glob(f"{filled.staging('vehicle_telemetry')}/dt={DAY_1}/*.parquet")) == 1


def test_big_days_are_split_over_tasks(spark, lake):
    df = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("vehicle_id"), F.lit(DAY_1).alias("dt")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        zones.write_days(df, lake.staging("x"), ["vehicle_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{lake.staging('x')}/dt={DAY_1}/*.parquet")) > 3
    assert spark.read.parquet(lake.staging("x")).count() == 200_000


def test_rerun_of_a_day_replaces_it_and_leaves_the_others(spark, filled):
    job.build_silver(spark, filled)
    job.build_gold(spark, filled)
    before = rows(zones.read_gold(spark, filled, "delivery_sla_compliance"))
    land_lines(filled, DELIVERY_COMPLETIONS, DAY_2, [delivery(9, DAY_2)], part=1)
    only = [DAY_2]
    job.build_silver(spark, filled, only)
    job.build_gold(spark, filled, only)
    after = rows(zones.read_gold(spark, filled, "delivery_sla_compliance"), "dt", "total_deliveries")
    assert after == [(DAY_1, 3), (DAY_2, 4)]
    job.build_silver(spark, filled)
    job.build_gold(spark, filled)
    again = rows(zones.read_gold(spark, filled, "delivery_sla_compliance"))
    assert again[0] == before[0] and len(again) == 2


@pytest.mark.parametrize("only", [None, [DAY_2]])
def test_day_that_lost_all_its_rows_is_removed(spark, filled, only):
    job.build_silver(spark, filled)
    job.build_gold(spark, filled)
    land_lines(filled, DELIVERY_COMPLETIONS, DAY_2, [delivery(1, DAY_2, distance_km="bad")])
    job.build_silver(spark, filled, only)
    job.build_gold(spark, filled, only)
    assert zones.days_on_file(spark, filled.staging("delivery_completions")) == [str(DAY_1)]
    assert zones.days_on_file(spark, filled.curated("delivery_sla_compliance")) == [str(DAY_1)]
    performance = zones.read_gold(spark, filled, "driver_performance")
    assert rows(performance.where(F.col("dt") == F.lit(DAY_2)), "deliveries_assigned") == [(0,), (0,)]


def test_dataset_that_is_gone_leaves_silver_alone(spark, filled):
    job.build_silver(spark, filled)
    elsewhere = zones.Lake(filled.base + "-none")
    spec = DELIVERY_COMPLETIONS
    empty = clean(bronze.read_raw(spark, elsewhere.raw(spec.name), spec), spec)
    zones.write_days(empty, filled.staging(spec.name), spec.keys)
    assert zones.days_on_file(spark, filled.staging(spec.name)) == [str(DAY_1), str(DAY_2)]


def test_other_files_in_a_raw_folder_are_no_data(spark, filled):
    folder = f"{filled.raw('vehicle_telemetry')}/dt={DAY_1}"
    with open(f"{folder}/README.txt", "w") as out:
        out.write("not data\n")
    path = filled.raw("vehicle_telemetry")
    assert bronze.read_raw(spark, path, VEHICLE_TELEMETRY).count() == 14
    assert bronze.raw_lines(spark, path).count() == 14


def test_sql_on_the_views_gives_the_same_answers(spark, filled):
    answers = job.run(spark, filled).queries

    def ask(sql):
        return rows(spark.sql(sql))

    assert rows(answers["city_sla_trend"]) == ask(
        "SELECT dt, city, sla_compliance_pct, total_deliveries FROM delivery_sla_compliance"
    )
    assert rows(answers["worst_sla_city_days"]) == ask(
        """SELECT dt, city, breached_deliveries, avg_breach_overage_minutes, sla_compliance_pct
           FROM delivery_sla_compliance WHERE breached_deliveries > 0"""
    )
    assert rows(answers["utilization_vs_hours"]) == ask(
        """SELECT f.dt, f.vehicle_id, f.active_time_pct, round(avg(p.hours_worked), 2)
           FROM daily_fleet_utilization f LEFT JOIN driver_performance p ON f.dt = p.dt
           GROUP BY f.dt, f.vehicle_id, f.active_time_pct"""
    )
    assert rows(answers["driver_leaderboard_7d"]) == ask(
        """SELECT driver_id, sum(deliveries_completed), sum(on_time_deliveries)
           FROM driver_performance
           WHERE dt >= (SELECT cast(max(dt) AS date) - INTERVAL 6 DAY FROM driver_performance)
           GROUP BY driver_id HAVING sum(deliveries_completed) >= 5"""
    )


def test_statements_answer_what_the_functions_answer(spark, filled):
    answers = job.run(spark, filled).queries
    zones.register_raw(spark, filled)
    zones.register_tables(spark, filled, "fleet_asked")
    _, last = zones.day_bounds(spark, filled.curated("driver_performance"))
    try:
        for database in (None, "fleet_asked"):
            asked = {
                "underutilized_vehicles": {},
                "driver_leaderboard": {"last": last, "least": 1},
                "city_sla_trend": {},
                "worst_sla_city_days": {},
                "utilization_vs_hours": {},
            }
            for name, parameters in asked.items():
                found = statements.ask(spark, name, database, **parameters)
                if name == "driver_leaderboard":
                    drivers = zones.read_gold(spark, filled, "driver_performance")
                    known = analytics.driver_leaderboard(drivers, min_completed=1)
                else:
                    known = answers[name]
                assert found.columns == known.columns
                assert found.collect() == known.collect() != [], name
            fields = ("city", "status", "assigned_at", "completed_at", "promised_minutes")
            raw = bronze.read_raw_fields(
                spark, filled.raw("delivery_completions"), DELIVERY_COMPLETIONS, *fields
            )
            found = statements.ask(spark, "raw_city_day_sla", database, city="Delhi", day=DAY_1)
            assert found.collect() == analytics.raw_city_day_sla(raw, "Delhi", DAY_1).collect() != []
    finally:
        spark.sql("DROP DATABASE fleet_asked CASCADE")


def test_statement_parameters_are_values_and_no_sql(spark, filled):
    job.run(spark, filled)
    zones.register_raw(spark, filled)
    odd = statements.ask(spark, "raw_city_day_sla", city="Delhi' OR '1' = '1", day=DAY_1)
    assert odd.collect() == []


def test_bounds_come_from_folders_that_have_files(spark, filled):
    job.run(spark, filled)
    path = filled.curated("daily_fleet_utilization")
    assert zones.day_bounds(spark, path) == (str(DAY_1), str(DAY_2))
    os.makedirs(f"{path}/dt={DAY_3}")
    assert zones.day_bounds(spark, path) == (str(DAY_1), str(DAY_2))
    assert zones.day_bounds(spark, path + "-none") is None
    known = dashboard.listed_date_bounds(spark, zones.day_bounds(spark, path))
    assert known.collect() == dashboard.date_bounds(zones.read_gold(spark, filled, "daily_fleet_utilization")).collect()
    assert dashboard.listed_date_bounds(spark, None).first() == (None, None)


def test_cached_tables_follow_their_files(spark, filled):
    job.run(spark, filled)
    name = "delivery_sla_compliance"
    cache = zones.TableCache(spark, filled)
    first = cache.table(name)
    before = first.agg(F.sum("total_deliveries")).first()[0]
    assert first.storageLevel.useMemory and cache.table(name) is first
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    land_lines(filled, DELIVERY_COMPLETIONS, DAY_2, [delivery(77, DAY_2)], part=5)
    job.run(spark, filled)
    second = cache.table(name)
    assert second is not first and second.storageLevel.useMemory
    assert second.agg(F.sum("total_deliveries")).first()[0] == before + 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept  # the copy from before is gone
    cache.release()
    assert not second.storageLevel.useMemory
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept - 1


# --- manifests --------------------------------------------------------------------------------


def test_manifest_notices_lost_repeated_and_changed_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    rows_of = "select date'2024-01-01' + cast(id % 3 as int) as dt, id, if(id % 7 = 0, null, id) as v"
    table = spark.sql(f"{rows_of} from range(300)")

    def read():
        return spark.read.schema("id long, v long, dt date").parquet(path)

    zones.write_days(table, path, ["id"])
    manifest.seal(read(), path)
    assert manifest.checked(read, path).count() == 300 and read().count() == 300
    zones.write_days(table.repartition(7), path)  # another order, other files
    assert rows(manifest.checked(read, path)) == rows(table.select("id", "v", "dt"))
    wrong = {
        "lost": table.where("id <> 17"),
        "repeated": table.union(table.where("id = 17")),
        "paired": table.union(table.where("id = 17")).union(table.where("id = 17")),
        "changed": table.withColumn("v", F.expr("if(id = 17, 18, v)")),
        "moved": table.withColumn("v", F.expr("if(id = 17, null, v)")).withColumn("id", F.expr("if(id = 17, 18, id)")),
        "a day more": table.union(spark.sql("select date'2024-02-01', 1L, 1L")),
    }
    for what, changed in wrong.items():
        zones.write_days(changed, path)
        with pytest.raises(PySparkException, match="not as sealed: dt=2024-0"):
            manifest.checked(read, path).collect()
            pytest.fail(what)
        shutil.rmtree(f"{path}/dt=2024-02-01", ignore_errors=True)
    shutil.rmtree(f"{path}/dt=2024-01-02")
    with pytest.raises(PySparkException, match="not as sealed: dt=2024-01-02"):
        manifest.checked(read, path).collect()


# --- answers on screen ------------------------------------------------------------------------


def test_answers_are_printed_whole_page_by_page(spark, capsys):
    from roadbook import __main__ as screen

    screen._show("numbers", spark.range(250).selectExpr("id", "if(id = 3, null, repeat('x', id % 5)) as t"))
    lines = capsys.readouterr().out.splitlines()
    assert lines[1] == "=== numbers" and lines[-1] == "(250 rows)"
    assert [int(x.split("|")[0]) for x in lines if x[:1].isdigit()] == list(range(250))
    assert sum(line.startswith("id") for line in lines) == 3 and any("NULL" in line for line in lines)
    screen._show("none", spark.range(0))
    assert "(0 rows)" in capsys.readouterr().out


def test_catalog_names(spark, filled, tmp_path):
    job.build_silver(spark, filled)
    job.build_gold(spark, filled)
    zones.register_views(spark, filled, include_silver=False)
    assert spark.sql("SELECT count(*) FROM daily_fleet_utilization").first()[0] == 2
    zones.register_tables(spark, filled, "fleet_curated")
    try:
        query = "SELECT count(*) FROM fleet_curated.{} WHERE dt = DATE '2024-03-02'"
        assert spark.sql(query.format("delivery_completions")).first()[0] == 3
        assert spark.sql("SHOW PARTITIONS fleet_curated.driver_performance").count() == 2
        cached = zones.cached_table(spark, "fleet_curated.driver_performance")
        assert cached.count() == 4 and dict(cached.dtypes)["dt"] == "date"
        cached.unpersist()
    finally:
        spark.sql("DROP DATABASE fleet_curated CASCADE")
    assert zones.read_gold(spark, filled, "driver_performance").count() == 4


def test_failure_ends_the_run(spark, lake):
    fill(lake, DAY_1)
    with pytest.raises(Exception):
        job.run(spark, lake, cost_of=("Delhi", DAY_3))


# --- reports ----------------------------------------------------------------------------------


def test_cleaning_report_of_a_dataset_without_rows(spark):
    empty = spark.createDataFrame([], "dt date")
    assert rows(reports.cleaning_report({"x": (empty, empty)})) == [("x", 0, 0, 0, 0.0)]


def test_scan_costs(spark):
    footprints = spark.createDataFrame(
        [("before", 988536, 14, 636), ("after", 5277, 1, 1)],
        "scenario string, bytes_scanned long, files_touched long, rows_matched long",
    )
    got = footprint.scan_cost_comparison(footprints, "Delhi", "2026-09-01").first()
    assert (got.target_city, got.target_dt, got.reduction_pct) == ("Delhi", "2026-09-01", 99.5)
    assert (got.before_size, got.after_size) == ("965.4 KB", "5.2 KB")
    assert f"{got.before_cost_usd:.7f} {got.after_cost_usd:.8f}" == "0.0000045 0.00000002"


def test_report_is_one_json_object(spark, tmp_path):
    path = str(tmp_path / "report")
    footprint.write_report(spark.createDataFrame([(1, "a")], "n int, s string"), path)
    (file,) = glob.glob(f"{path}/*.json")
    assert json.load(open(file)) == {"n": 1, "s": "a"}


def test_listing_has_sizes_by_day_and_opens_nothing(spark, filled):
    path = filled.raw("vehicle_telemetry")
    sizes = [os.path.getsize(f) for f in sorted(glob.glob(f"{path}/*/*.json"))]
    places = {"a": path, "gone": path + "-none"}
    listed = listing.by_day(listing.stored_listing(spark, places, ".json"))
    assert {d: day.bytes for d, day in listed["a"].items()} == dict(zip((str(DAY_1), str(DAY_2)), sizes))
    assert "gone" not in listed
    assert listing.by_day(listing.list_files(spark, places, ".json")) == listed
    land_lines(filled, VEHICLE_TELEMETRY, DAY_2, [ping("V9", DAY_2, 1)], part=9)
    after = listing.by_day(listing.list_files(spark, places, ".json"))
    one, two = str(DAY_1), str(DAY_2)
    assert after["a"][one] == listed["a"][one] and after["a"][two] != listed["a"][two]


def test_listing_is_packed_by_count_of_files(spark, tmp_path, monkeypatch):
    for day in range(1, 5):
        os.makedirs(tmp_path / f"dt=2024-01-0{day}")
        for part in range(10):
            with open(tmp_path / f"dt=2024-01-0{day}" / f"part-{part}.json", "wb") as file:
                file.truncate(200 * 1024**2)  # sparse: it takes no space
    files = listing.list_files(spark, {"big": str(tmp_path)}, ".json")
    assert files.rdd.getNumPartitions() == 1 and files.count() == 40
    monkeypatch.setattr(listing, "FILES_PER_TASK", 10)
    assert 4 <= listing.list_files(spark, {"big": str(tmp_path)}, ".json").rdd.getNumPartitions() <= 5


def test_shuffles_grow_with_the_input_in_a_session_of_their_own(spark):
    before = spark.conf.getAll

    def partitions(size):
        own = session.working_session(spark, size)
        assert own.conf.get("spark.sql.shuffle.partitions") == "8"
        assert own.conf.get("spark.sql.session.timeZone") == "UTC"
        return own.conf.get(session.PARTITIONS, None)

    assert partitions(10 * 1024**2) is None
    assert partitions(1024**4) == "4096"
    assert partitions(100 * 1024**4) == "409600"
    assert spark.conf.getAll == before


def test_days_are_built_in_groups_of_bounded_size():
    sizes = {"2024-01-03": 30, "2024-01-01": 40, "2024-01-02": 50, "2024-01-04": 500, "2024-01-05": 10}
    groups = schedule.groups_of_days(sizes, 100)
    assert [(g.days, g.bytes) for g in groups] == [
        (("2024-01-01", "2024-01-02"), 90),
        (("2024-01-03",), 30),
        (("2024-01-04",), 500),
        (("2024-01-05",), 10),
    ]
    assert schedule.groups_of_days({}) == []


def test_groups_give_what_one_build_gives(spark, filled, tmp_path):
    whole = zones.Lake(str(tmp_path / "whole"))
    shutil.copytree(f"{filled.base}/raw", f"{whole.base}/raw")
    before = spark.conf.getAll
    job.build_silver(spark, whole)
    job.build_gold(spark, whole)
    job.build_silver(spark, filled, group_bytes=1)
    job.build_gold(spark, filled, group_bytes=1)
    assert spark.conf.getAll == before
    for spec in DATASETS:
        one, many = (zones.read_silver(spark, lake, spec) for lake in (whole, filled))
        assert rows(one) == rows(many) != []
    for name in GOLD_SCHEMAS:
        one, many = (zones.read_gold(spark, lake, name) for lake in (whole, filled))
        assert rows(one) == rows(many) != []


# --- narrow dedupe ----------------------------------------------------------------------------


def test_narrow_dedupe_gives_what_the_wide_one_gives(spark, filled):
    for spec in DATASETS:
        raw = bronze.read_raw(spark, filled.raw(spec.name), spec)
        for prefer in (None, spec.required_timestamp):
            narrow, counts, _ = job.clean_staged(spark, raw, spec, prefer)
            assert rows(narrow) == rows(clean(raw, spec, prefer)) != []
        assert counts.agg(F.sum("raw_rows")).first()[0] == raw.count()


def test_narrow_dedupe_shuffles_only_rows_whose_key_repeats(spark, plan):
    data = spark.range(100_000).selectExpr(
        "date_add(date'2024-01-01', cast(id % 3 as int)) as dt",
        "cast(id % 99000 as string) as k",
        "id as _arrival",
        "repeat('x', 200) as wide",
    )
    marks = dedupe.repeated_marks(data, ["k"])
    marks = spark.createDataFrame(marks.collect(), marks.schema)
    assert 900 < sum(bin(r.bits & (2**64 - 1)).count("1") for r in marks.collect()) <= 1000
    found = dedupe.first_copies(data, ["k"], marks)
    # The same key on another day is no copy: 1,000 keys repeat on the same day (99,000 is 3 * 33,000).
    assert found.count() == 99_000 and found.agg(F.max("_arrival")).first()[0] == 98_999
    exchanges = [line for line in plan(found).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1
    assert found.where("_arrival < 0").count() == 0


def test_cleaning_tasks_read_a_few_typed_rows_each(spark, lake, monkeypatch):
    small, many, most = 64 * 1024, 20_000, []
    monkeypatch.setattr(job, "STAGED_BYTES", small, raising=False)
    narrow = {**getattr(job, "NARROW", {}), "spark.sql.files.maxPartitionBytes": str(small)}
    monkeypatch.setattr(job, "NARROW", narrow, raising=False)

    def watched(step):
        def run(rows, *others):
            counts = rows.groupBy(F.spark_partition_id()).count().collect()
            most.append(max(n for _, n in counts))
            return step(rows, *others)

        return run

    for name in ("repeated_marks", "first_copies"):
        monkeypatch.setattr(job, name, watched(getattr(job, name)))
    drivers = [f"DRV-{n * 2654435761 % 2**32:010d}" for n in range(many)]
    land_lines(lake, DRIVER_SHIFT_LOGS, DAY_1, [shift(driver, DAY_1) for driver in drivers])
    job.build_silver(spark, lake)
    assert len(most) == 2 and max(most) < many / 2
    assert zones.read_silver(spark, lake, DRIVER_SHIFT_LOGS).count() == many


def test_tasks_that_count_key_hashes_get_fewer_bytes_than_those_that_sort_rows(spark, lake, monkeypatch):
    given = {}

    def watched(name, step):
        def run(rows, *others):
            size = rows.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
            given[name] = int(size.removesuffix("m"))
            return step(rows, *others)

        return run

    for name in ("repeated_marks", "first_copies"):
        monkeypatch.setattr(job, name, watched(name, getattr(job, name)))
    land_lines(lake, DRIVER_SHIFT_LOGS, DAY_1, [shift("DRV-001", DAY_1)])
    job.build_silver(spark, lake)
    assert given["repeated_marks"] < given["first_copies"] <= 8


def test_narrow_dedupe_of_a_hot_key_and_of_equal_marks(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "BITS", 64)  # every key shares its mark with others
    data = spark.range(3000).selectExpr(
        "date'2024-01-01' as dt", "if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as _arrival"
    )
    found = dedupe.first_copies(data, ["k"], dedupe.repeated_marks(data, ["k"]))
    assert found.count() == 2001 and found.where("k = 'hot'").first()._arrival == 0


# --- the ledger -------------------------------------------------------------------------------


def test_run_that_was_stopped_between_zones_goes_on(spark, filled, monkeypatch):
    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(job, "gold_tables", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            job.run(spark, filled)
    silver = {f: os.path.getmtime(f) for f in glob.glob(f"{filled.base}/staging/**/*.parquet", recursive=True)}
    assert silver and not glob.glob(f"{filled.base}/curated/*/dt=*")
    result = job.run(spark, filled)
    assert {f: os.path.getmtime(f) for f in silver} == silver
    assert result.gold.count() == 3

    gold = glob.glob(f"{filled.base}/curated/**/*.parquet", recursive=True)
    job.run(spark, filled)
    assert glob.glob(f"{filled.base}/curated/**/*.parquet", recursive=True) == gold
    job.run(spark, filled, fresh=True)
    assert not set(gold) & set(glob.glob(f"{filled.base}/curated/**/*.parquet", recursive=True))


def test_run_stopped_between_groups_goes_on(spark, filled, monkeypatch):
    write, calls = job._write_silver, []

    def stops(own, lake, spec, days, listed):
        calls.append((spec.name, tuple(days)))
        if str(DAY_2) in days:
            raise RuntimeError("stopped")
        return write(own, lake, spec, days, listed)

    with monkeypatch.context() as broken:
        broken.setattr(job, "_write_silver", stops)
        with pytest.raises(RuntimeError):
            job.build_silver(spark, filled, group_bytes=1)
    stale, behind = job.unfinished(spark, filled, job.list_raw(spark, filled))
    assert (stale, behind) == ([str(DAY_2)], [str(DAY_1)])
    job.run(spark, filled)
    assert job.unfinished(spark, filled, job.list_raw(spark, filled)) == ([], [])


def test_run_rebuilds_days_whose_files_changed(spark, filled):
    job.run(spark, filled)
    land_lines(filled, DELIVERY_COMPLETIONS, DAY_2, [delivery(99, DAY_2)], part=7)
    assert job.unfinished(spark, filled, job.list_raw(spark, filled)) == ([str(DAY_2)], [])
    before = job.cleaning_report(spark, filled).where("dataset = 'delivery_completions'").first()
    result = job.run(spark, filled)
    after = result.cleaning.where("dataset = 'delivery_completions'").first()
    assert (after.raw_rows, after.staged_rows) == (before.raw_rows + 1, before.staged_rows + 1)


def test_run_of_a_day_whose_files_are_gone_removes_its_rows(spark, filled):
    job.run(spark, filled)
    shutil.rmtree(f"{filled.base}/raw/delivery_completions/dt={DAY_2}")
    job.run(spark, filled)  # nothing arrived, so nothing is built
    assert zones.read_silver(spark, filled, DELIVERY_COMPLETIONS).where(F.col("dt") == DAY_2).count() > 0
    job.run(spark, filled, [DAY_2])
    assert zones.read_silver(spark, filled, DELIVERY_COMPLETIONS).where(F.col("dt") == DAY_2).count() == 0
    sla = zones.read_gold(spark, filled, "delivery_sla_compliance")
    assert [r.dt for r in sla.select("dt").distinct().collect()] == [DAY_1]
    assert job.unfinished(spark, filled, job.list_raw(spark, filled), [DAY_2]) == ([], [])


def test_reports_read_no_data(spark, filled):
    job.run(spark, filled)
    for report in (job.cleaning_report(spark, filled), job.build_report(spark, filled)):
        read = report.inputFiles()
        assert read and all("/ledger/" in file for file in read)
    counted = reports.cleaning_report(
        {
            spec.name: (bronze.raw_lines(spark, filled.raw(spec.name)), zones.read_silver(spark, filled, spec))
            for spec in DATASETS
        }
    )
    assert rows(job.cleaning_report(spark, filled), *counted.columns) == rows(counted)
    tables = {name: zones.read_gold(spark, filled, name) for name in GOLD_SCHEMAS}
    assert rows(job.build_report(spark, filled)) == rows(reports.build_report(tables))


def test_scratch_data_of_a_build_is_removed(spark, filled):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    kept = set(glob.glob(f"{shared}/roadbook/*/*"))
    job.build_silver(spark, filled)
    left = {os.path.basename(p) for p in set(glob.glob(f"{shared}/roadbook/*/*")) - kept}
    assert not any(name.startswith(("judged", "repeated")) for name in left)


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second


# --- files as they arrive ---------------------------------------------------------------------


def test_arriving_files_rebuild_their_days_only(spark, lake, tmp_path):
    def refresh():
        refresh_on_arrival(spark, lake, str(tmp_path / "seen"))

    def written():
        pattern = f"{lake.base}/*/*/dt=*/*.parquet"
        return {f: os.path.getmtime(f) for f in glob.glob(pattern)}

    land_lines(lake, DRIVER_SHIFT_LOGS, DAY_1, [shift("DRV-001", DAY_1)])  # the others come later
    refresh()
    assert zones.read_gold(spark, lake, "driver_performance").count() == 1
    fill(lake, DAY_1)
    land_lines(lake, DRIVER_SHIFT_LOGS, DAY_1, [shift("DRV-004", DAY_1)], part=1)
    refresh()
    first = written()
    fill(lake, DAY_2)
    land_lines(lake, DELIVERY_COMPLETIONS, DAY_2, [delivery(1, DAY_2, "09:10:00")], part=1)
    refresh()
    second = written()
    assert all(second.get(f) == t for f, t in first.items())
    land_lines(lake, DELIVERY_COMPLETIONS, DAY_1, [delivery(7, DAY_1)], part=1)  # comes late
    refresh()
    assert {f: t for f, t in written().items() if "03-02" in f} == {
        f: t for f, t in second.items() if "03-02" in f
    }
    got = {spec.name: rows(zones.read_silver(spark, lake, spec)) for spec in DATASETS}
    full = zones.Lake(lake.base + "-full")
    for spec in DATASETS:
        raw = bronze.read_raw(spark, lake.raw(spec.name), spec)
        zones.write_days(clean(raw, spec), full.staging(spec.name))
        assert rows(zones.read_silver(spark, full, spec)) == got[spec.name]
    refresh()


def test_old_rewritten_and_removed_files_are_noticed(spark, lake, tmp_path):
    def refresh():
        return refresh_on_arrival(spark, lake, str(tmp_path / "seen"))

    def delivered():
        sla = zones.read_gold(spark, lake, "delivery_sla_compliance")
        return dict(sla.groupBy(F.col("dt").cast("string")).agg(F.sum("total_deliveries")).collect())

    def land(day, *numbers, part=0):
        land_lines(
            lake, DELIVERY_COMPLETIONS, day, [delivery(n, day) for n in numbers], part=part
        )

    land(DAY_1, 1)
    assert refresh() == [str(DAY_1)] and refresh() == []
    land(DAY_2, 1, 2)
    for file in glob.glob(f"{lake.raw('delivery_completions')}/dt={DAY_2}/*"):
        os.utime(file, (1_000_000_000, 1_000_000_000))  # restored from a copy of years ago
    assert refresh() == [str(DAY_2)]
    assert delivered() == {str(DAY_1): 1, str(DAY_2): 2}
    land(DAY_1, 1, 2, 3)  # under the same name
    assert refresh() == [str(DAY_1)]
    assert delivered() == {str(DAY_1): 3, str(DAY_2): 2}
    for file in glob.glob(f"{lake.raw('delivery_completions')}/dt={DAY_2}/*.json"):
        os.remove(file)
    assert refresh() == [str(DAY_2)]
    assert delivered() == {str(DAY_1): 3} and refresh() == []


def test_days_gone_from_the_raw_zone_are_not_dropped_rows(spark, lake):
    for day in (DAY_1, DAY_2):
        land_lines(lake, DELIVERY_COMPLETIONS, day, [delivery(1, day)])
    job.build_silver(spark, lake)
    shutil.rmtree(f"{lake.raw('delivery_completions')}/dt={DAY_2}")
    found = job.cleaning_report(spark, lake).where("dataset = 'delivery_completions'")
    assert rows(found, "raw_rows", "staged_rows", "dropped_rows") == [(1, 1, 0)]
