"""Raw-shaped datasets derived from the star-schema sample tables, for queries, tests and bench.

Telemetry and shifts come from ``events``, deliveries from ``lineitem`` joined to ``orders``. They
carry the defects of real bronze data: re-sent copies, malformed copies, missing and mistyped
values. Each frame has the raw columns, ``dt`` and ARRIVAL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.session import working_session
from roadbook.sources.bronze import land_raw
from roadbook.spec import ARRIVAL

# The cities, and minutes promised by order priority 1 to 5.
CITIES = ("Delhi", "Gurugram", "Noida", "Bengaluru", "Pune", "Hyderabad")
PROMISED_MINUTES = (30, 45, 60, 90, 120)
# Rows of the source that a task lands; while they are joined and sorted they take some 0.4 KB each.
LAND_ROWS = 150_000
# A dataset that so few tasks land stays plain JSON.
PLAIN_TASKS = 2
# Columns by which deliveries arrive.
ARRIVES_BY = (
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_shipdate",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 3, "0"))


def _city(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, CITIES)), (number % 6 + 1).cast("int"))


def _iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _after(start: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + seconds.cast("long") * 1_000_000)


def _copies(df: DataFrame, **kept: Column) -> DataFrame:
    """Each row once for every copy number whose condition holds (``m1`` stands for -1)."""
    numbers = {"m1": -1, "c0": 0, "c1": 1, "c2": 2}
    none = F.array().cast("array<int>")
    copies = [F.when(cond, F.array(F.lit(numbers[n]))).otherwise(none) for n, cond in kept.items()]
    return df.withColumn("cp", F.explode(F.concat(*copies)))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("at"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    cp = F.col("cp")
    rows = _copies(
        _events(spark, sf_dir), c0=F.lit(True), c1=e % 50 == 0, m1=e % 75 == 0
    )
    speed = (
        F.when((cp == -1) | (e % 97 == 0), "unknown")
        .when(e % 101 == 0, None)
        .when(e % 89 == 0, "-1.0")
        .otherwise(F.col("value").cast("string"))
    )
    return rows.select(
        _numbered("VEH-", F.col("user_id") % 25 + 1).alias("vehicle_id"),
        F.when(e % 211 == 0, "not-a-time").otherwise(_iso(F.col("at"))).alias("timestamp"),
        F.when(e % 103 != 0, (e % 1200 + 28400 - 600) / 1e3).alias("lat"),
        (((e * 7) % 1200 + 77100 - 600) / 1e3).alias("lon"),
        speed.alias("speed_kmph"),
        F.when(e % 107 != 0, F.col("k").cast("double")).alias("fuel_level_pct"),
        (F.col("event_type") != "error").alias("engine_on"),
        (e.cast("double") * 0.5).alias("odometer_km"),
        _city(F.col("user_id")).alias("city"),
        F.to_date("at").alias("dt"),
        (e * 4 + cp).alias(ARRIVAL),
    )


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    cp = F.col("cp")
    rows = _copies(
        _events(spark, sf_dir).where(F.col("event_type") == "signup"),
        c0=F.lit(True),
        c1=e % 33 == 0,
        m1=(e % 40).isin(0, 10),
        c2=e % 40 == 20,
    )
    end = _after(F.col("at"), F.col("k") * 160 + 21600)
    return rows.select(
        _numbered("DRV-", F.col("user_id") % 30 + 1).alias("driver_id"),
        _numbered("VEH-", e % 25 + 1).alias("vehicle_id"),
        _iso(F.col("at")).alias("clock_in"),
        F.when(~cp.isin(-1, 2), _iso(end)).alias("clock_out"),
        F.when(e % 61 != 0, e % 5 * 15).alias("break_minutes"),
        _city(e).alias("city"),
        F.to_date("at").alias("dt"),
        (e * 4 + cp).alias(ARRIVAL),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What deliveries are made of, and their day: under half as wide as the records."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority")
    )
    # Shuffled on purpose: the sample comes as one file, which only one task could read.
    rows = _table(spark, sf_dir, "lineitem").join(
        orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    dt = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    return rows.withColumn("dt", dt)


def _as_deliveries(lines: DataFrame) -> DataFrame:
    key, dt = F.col("o_orderkey"), F.col("dt")
    assigned = _after(dt.cast("timestamp"), (key % 840) * 60 + 21600)
    failed = (
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & (F.round(F.col("l_tax") * 100) >= 6)
    )
    taken = (F.col("l_quantity") * 150 + F.round(F.col("l_discount") * 100) * 6).cast("long")
    return lines.select(
        F.concat_ws("-", F.lit("DEL"), "l_orderkey", "l_linenumber").alias("delivery_id"),
        _numbered("DRV-", F.col("l_suppkey") % 30 + 1).alias("driver_id"),
        _numbered("VEH-", F.col("l_partkey") % 25 + 1).alias("vehicle_id"),
        _iso(assigned).alias("assigned_at"),
        F.when(~failed, _iso(_after(assigned, taken))).alias("completed_at"),
        F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"),
        F.element_at(F.array(*map(F.lit, PROMISED_MINUTES)), F.col("priority")).alias(
            "promised_minutes"
        ),
        F.when(F.col("l_partkey") % 211 == 0, "bad")
        .otherwise((F.col("l_quantity") / 2).cast("string"))
        .alias("distance_km"),
        _city(F.col("o_custkey")).alias("city"),
        "dt",
        F.struct(*ARRIVES_BY).alias(ARRIVAL),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_deliveries(_order_lines(spark, sf_dir))


RAW = {
    "vehicle_telemetry": telemetry,
    "driver_shift_logs": shifts,
    "delivery_completions": deliveries,
}


def land(spark: SparkSession, sf_dir: str, name: str, path: str) -> None:
    """Write a dataset to the raw zone: as plain JSON if a task or two land it, else compressed, as plain
    JSON is ten times as much.

    Deliveries come out of a join with all lines of an order in one task, so that they are sorted
    where they are, before they are made into records; the others are dealt by ranges.
    """
    joined = RAW[name] is deliveries
    rows = _table(spark, sf_dir, "lineitem" if joined else "events").count()  # from the footers
    tasks = max(1, -(-rows // LAND_ROWS))
    own = working_session(
        spark,
        **{
            "spark.sql.shuffle.partitions": str(tasks),
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.enabled": "false",
        },
    )
    compression = "gzip" if tasks > PLAIN_TASKS else "none"
    if joined:
        lines = _order_lines(own, sf_dir).sortWithinPartitions("dt", *ARRIVES_BY)
        land_raw(_as_deliveries(lines).drop(ARRIVAL), path, compression=compression)
    else:
        land_raw(RAW[name](own, sf_dir), path, tasks, compression=compression)
