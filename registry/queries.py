"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

They run on the sample lake, each on the zone it would use in production: cleaning steps on raw
JSON, gold tables on silver Parquet, analytical and dashboard queries on gold Parquet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.sample_lake import catalog, sample_lake
from roadbook import functions
from roadbook.functions import round_half_up
from roadbook.operators import cleaning, footprint, reports
from roadbook.plans import analytics, dashboard, gold, job, statements
from roadbook.session import scratch_dir, use_utc, working_session
from roadbook.sources import bronze, manifest, sample
from roadbook.sources import lake as zones
from roadbook.spec import (
    DATASETS,
    DELIVERY_COMPLETIONS,
    DRIVER_SHIFT_LOGS,
    GOLD_TABLES,
    VEHICLE_TELEMETRY,
    DatasetSpec,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries on the sample tables.
CITY = "Delhi"
DAY = "2024-01-15"
FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-25"

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    def with_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir.rstrip("/"))

    QUERIES[query.__name__] = with_utc
    return query


def _raw(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    return bronze.read_raw(spark, sample_lake(spark, sf_dir).raw(spec.name), spec)


def _silver(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    return zones.read_silver(spark, sample_lake(spark, sf_dir), spec)


def _gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    lake = sample_lake(spark, sf_dir)
    return tuple(zones.read_gold(spark, lake, name) for name in GOLD_TABLES)


def _bounds(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str] | None:
    return zones.day_bounds(spark, sample_lake(spark, sf_dir).curated(name))


def _six_places(df: DataFrame, *columns: str) -> DataFrame:
    """Unrounded float aggregates to six places, so that summation order is no matter."""
    return df.withColumns({c: round_half_up(F.col(c), 6) for c in columns})


# --- cleaning steps ---------------------------------------------------------------------------


@register
def silver_coerce_numeric(spark, sf_dir):
    required = VEHICLE_TELEMETRY.required_numeric
    rows = cleaning.coerce_numeric(_raw(spark, sf_dir, VEHICLE_TELEMETRY), required)
    return rows.select("vehicle_id", "timestamp", *required)


@register
def silver_drop_malformed(spark, sf_dir):
    required = VEHICLE_TELEMETRY.required_numeric
    rows = cleaning.coerce_numeric(_raw(spark, sf_dir, VEHICLE_TELEMETRY), required)
    return cleaning.drop_malformed(rows, required).select("vehicle_id", "timestamp", *required)


@register
def silver_parse_timestamps(spark, sf_dir):
    pings = cleaning.parse_timestamps(_raw(spark, sf_dir, VEHICLE_TELEMETRY), ["timestamp"])
    shifts = cleaning.parse_timestamps(
        _raw(spark, sf_dir, DRIVER_SHIFT_LOGS), ["clock_in", "clock_out"]
    )
    deliveries = cleaning.parse_timestamps(
        _raw(spark, sf_dir, DELIVERY_COMPLETIONS), ["assigned_at", "completed_at"]
    )
    pings = cleaning.require(pings, "timestamp").select(
        F.col("vehicle_id").alias("source_id"),
        F.col("timestamp").alias("event_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
    )
    shifts = cleaning.require(shifts, "clock_in").select(
        F.col("driver_id").alias("source_id"),
        F.col("clock_in").alias("event_time"),
        F.col("clock_out").alias("end_time"),
    )
    deliveries = cleaning.require(deliveries, "assigned_at").select(
        F.col("delivery_id").alias("source_id"),
        F.col("assigned_at").alias("event_time"),
        F.col("completed_at").alias("end_time"),
    )
    return pings.unionByName(shifts).unionByName(deliveries)


# How event times are written for timestamp_forms, by event number.
WRITTEN = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy/MM/dd HH:mm:ss",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd",
    "MM/dd/yyyy hh:mm a",
    "dd MMM yyyy HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss'+0530'",
    "yyyy.MM.dd HH:mm'Z'",
    "yyyyMMddHHmmss",
    "HH:mm:ss",
    "MMMM d, yyyy h:mm:ss a",
)


@register
def timestamp_forms(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    form = F.col("event_id") % len(WRITTEN)
    at = F.col("ts").cast("timestamp")
    text = F.element_at(F.array(*[F.date_format(at, w) for w in WRITTEN]), (form + 1).cast("int"))
    rows = events.select("event_id", form.alias("form"), text.alias("text"))
    return rows.select("event_id", "form", functions.parse_timestamp(F.col("text")).alias("parsed"))


@register
def silver_speed_range(spark, sf_dir):
    rows = cleaning.coerce_numeric(_raw(spark, sf_dir, VEHICLE_TELEMETRY), ["speed_kmph"])
    valid = cleaning.within_ranges(rows, VEHICLE_TELEMETRY.ranges)
    return valid.select("vehicle_id", "timestamp", "speed_kmph")


def _cleaned(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    """Silver rows as the job makes them."""
    lake = sample_lake(spark, sf_dir)
    size = sum(day.bytes for day in job.list_raw(spark, lake).get(spec.name, {}).values())
    raw = bronze.read_raw(working_session(spark, size), lake.raw(spec.name), spec)
    return job.clean_staged(spark, raw, spec)[0]


@register
def silver_dedupe_telemetry(spark, sf_dir):
    return _cleaned(spark, sf_dir, VEHICLE_TELEMETRY)


@register
def silver_dedupe_shifts(spark, sf_dir):
    return _cleaned(spark, sf_dir, DRIVER_SHIFT_LOGS)


@register
def silver_dedupe_shifts_prefer_closed(spark, sf_dir):
    return cleaning.clean(
        _raw(spark, sf_dir, DRIVER_SHIFT_LOGS), DRIVER_SHIFT_LOGS, prefer="clock_out"
    )


@register
def silver_dedupe_deliveries(spark, sf_dir):
    return _cleaned(spark, sf_dir, DELIVERY_COMPLETIONS)


@register
def dedupe_full_row(spark, sf_dir):
    rows = cleaning.typed(_raw(spark, sf_dir, VEHICLE_TELEMETRY), VEHICLE_TELEMETRY)
    return cleaning.distinct_rows(rows.select(*VEHICLE_TELEMETRY.columns, "dt"))


# --- zone reports -----------------------------------------------------------------------------


@register
def bronze_rows_per_day(spark, sf_dir):
    lake = sample_lake(spark, sf_dir)
    return reports.rows_per_day(
        {spec.name: bronze.raw_lines(spark, lake.raw(spec.name)) for spec in DATASETS}
    )


@register
def silver_cleaning_report(spark, sf_dir):
    return job.cleaning_report(spark, sample_lake(spark, sf_dir))


@register
def gold_build_report(spark, sf_dir):
    return job.build_report(spark, sample_lake(spark, sf_dir))


# --- gold tables ------------------------------------------------------------------------------


@register
def daily_fleet_utilization(spark, sf_dir):
    return gold.daily_fleet_utilization(_silver(spark, sf_dir, VEHICLE_TELEMETRY))


@register
def shift_hours(spark, sf_dir):
    return gold.shift_hours(_silver(spark, sf_dir, DRIVER_SHIFT_LOGS))


@register
def delivery_stats(spark, sf_dir):
    return gold.delivery_stats(_silver(spark, sf_dir, DELIVERY_COMPLETIONS))


@register
def driver_performance(spark, sf_dir):
    return gold.driver_performance(
        _silver(spark, sf_dir, DRIVER_SHIFT_LOGS), _silver(spark, sf_dir, DELIVERY_COMPLETIONS)
    )


@register
def driver_performance_by_day(spark, sf_dir):
    return gold.driver_performance(
        _silver(spark, sf_dir, DRIVER_SHIFT_LOGS),
        _silver(spark, sf_dir, DELIVERY_COMPLETIONS),
        one_row_per_driver_day=True,
    )


@register
def delivery_sla_compliance(spark, sf_dir):
    return gold.delivery_sla_compliance(_silver(spark, sf_dir, DELIVERY_COMPLETIONS))


# --- analytical queries -----------------------------------------------------------------------


@register
def q1_underutilized_vehicles(spark, sf_dir):
    fleet, _, _ = _gold(spark, sf_dir)
    return analytics.underutilized_vehicles(fleet)


@register
def q2_driver_leaderboard_7d(spark, sf_dir):
    _, drivers, _ = _gold(spark, sf_dir)
    _, last = _bounds(spark, sf_dir, "driver_performance")
    return analytics.driver_leaderboard(drivers, last=last)


@register
def q3_city_sla_trend(spark, sf_dir):
    _, _, sla = _gold(spark, sf_dir)
    return analytics.city_sla_trend(sla)


@register
def q3_city_sla_trend_between(spark, sf_dir):
    _, _, sla = _gold(spark, sf_dir)
    return analytics.city_sla_trend(sla, FIRST_DAY, LAST_DAY)


@register
def q4_worst_sla_city_days(spark, sf_dir):
    _, _, sla = _gold(spark, sf_dir)
    return analytics.worst_sla_city_days(sla)


@register
def q5_utilization_vs_hours(spark, sf_dir):
    fleet, drivers, _ = _gold(spark, sf_dir)
    return analytics.utilization_vs_hours(fleet, drivers)


@register
def q5_utilization_vs_hours_all(spark, sf_dir):
    fleet, drivers, _ = _gold(spark, sf_dir)
    return analytics.utilization_vs_hours(fleet, drivers, k=None)


@register
def before_raw_city_day_sla(spark, sf_dir):
    raw = bronze.read_raw_fields(
        spark,
        sample_lake(spark, sf_dir).raw(DELIVERY_COMPLETIONS.name),
        DELIVERY_COMPLETIONS,
        "city",
        "status",
        "assigned_at",
        "completed_at",
        "promised_minutes",
    )
    return analytics.raw_city_day_sla(raw, CITY, DAY)


@register
def sla_point_lookup(spark, sf_dir):
    _, _, sla = _gold(spark, sf_dir)
    return analytics.sla_point_lookup(sla, CITY, DAY)


# --- dashboard --------------------------------------------------------------------------------


def _in_range(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    tables = _gold(spark, sf_dir)
    return tuple(dashboard.in_range(t, tables[0], FIRST_DAY, LAST_DAY) for t in tables)


@register
def dash_date_bounds(spark, sf_dir):
    return dashboard.listed_date_bounds(spark, _bounds(spark, sf_dir, "daily_fleet_utilization"))


@register
def dash_kpis(spark, sf_dir):
    fleet, _, sla = _in_range(spark, sf_dir)
    return _six_places(
        dashboard.kpis(fleet, sla),
        "avg_active_time_pct",
        "total_distance_km",
        "avg_sla_compliance_pct",
    )


@register
def dash_kpis_all_days(spark, sf_dir):
    fleet, _, sla = _gold(spark, sf_dir)
    bounds = _bounds(spark, sf_dir, "daily_fleet_utilization")
    masked = [dashboard.in_range(table, fleet, bounds=bounds) for table in (fleet, sla)]
    return _six_places(
        dashboard.kpis(*masked),
        "avg_active_time_pct",
        "total_distance_km",
        "avg_sla_compliance_pct",
    )


@register
def dash_daily_active(spark, sf_dir):
    fleet, _, _ = _in_range(spark, sf_dir)
    return _six_places(dashboard.daily_active(fleet), "active_time_pct")


@register
def dash_worst_vehicles(spark, sf_dir):
    fleet, _, _ = _in_range(spark, sf_dir)
    return _six_places(dashboard.worst_vehicles(fleet), "active_time_pct")


@register
def dash_driver_leaderboard(spark, sf_dir):
    _, drivers, _ = _in_range(spark, sf_dir)
    return dashboard.driver_leaderboard(drivers)


@register
def dash_city_sla_series(spark, sf_dir):
    _, _, sla = _in_range(spark, sf_dir)
    return dashboard.city_sla_series(sla)


@register
def dash_worst_breach_days(spark, sf_dir):
    _, _, sla = _in_range(spark, sf_dir)
    return dashboard.worst_breach_days(sla)


# --- the same queries in SQL, on tables of the catalog ----------------------------------------


def _ask(spark: SparkSession, sf_dir: str, name: str, **parameters) -> DataFrame:
    lake, database = catalog(spark, sf_dir)
    zones.register_raw(spark, lake)
    return statements.ask(spark, name, database, **parameters)


@register
def sql_underutilized_vehicles(spark, sf_dir):
    return _ask(spark, sf_dir, "underutilized_vehicles")


@register
def sql_driver_leaderboard(spark, sf_dir):
    _, last = _bounds(spark, sf_dir, "driver_performance")
    return _ask(spark, sf_dir, "driver_leaderboard", last=last)


@register
def sql_city_sla_trend(spark, sf_dir):
    return _ask(spark, sf_dir, "city_sla_trend", first=FIRST_DAY, last=LAST_DAY)


@register
def sql_worst_sla_city_days(spark, sf_dir):
    return _ask(spark, sf_dir, "worst_sla_city_days")


@register
def sql_utilization_vs_hours(spark, sf_dir):
    return _ask(spark, sf_dir, "utilization_vs_hours")


@register
def sql_raw_city_day_sla(spark, sf_dir):
    return _ask(spark, sf_dir, "raw_city_day_sla", city=CITY, day=DAY)


# --- the job ----------------------------------------------------------------------------------


@register
def job_run(spark, sf_dir):
    """A run on the raw zone into new zones, another one that finds nothing to do, and its reports."""
    raw = sample_lake(spark, sf_dir)
    lake = zones.Lake(scratch_dir(spark, "job"), raw_base=raw.base)
    job.run(spark, lake)
    result = job.run(spark, lake)
    silver = result.cleaning.select(
        F.lit("silver").alias("zone"),
        F.col("dataset").alias("name"),
        "raw_rows",
        F.col("staged_rows").alias("row_count"),
        F.lit(None).cast("long").alias("days"),
    )
    gold_rows = result.gold.select(
        F.lit("gold").alias("zone"),
        F.col("table_name").alias("name"),
        F.lit(None).cast("long").alias("raw_rows"),
        "row_count",
        F.col("partition_count").alias("days"),
    )
    return silver.unionByName(gold_rows)


# --- sources and sinks ------------------------------------------------------------------------


def _together(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All tables in one, each row with the name of its table; columns a table lacks are NULL."""
    named = [table.withColumn("name", F.lit(name)) for name, table in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@register
def bronze_roundtrip(spark, sf_dir):
    lake = zones.Lake(scratch_dir(spark, "bronze"))

    def back(spec: DatasetSpec) -> DataFrame:
        path = lake.raw(spec.name)
        read = partial(bronze.read_raw_fields, spark, path, spec, *spec.columns)
        sample.land(spark, sf_dir, spec.name, path)
        manifest.seal(read(), path)
        return manifest.checked(read, path)

    tables = job.at_once(partial(back, spec) for spec in DATASETS)
    return _together(dict(zip((spec.name for spec in DATASETS), tables)))


@register
def bronze_inferred_scan(spark, sf_dir):
    lake = sample_lake(spark, sf_dir)
    raw = bronze.infer_raw(spark, lake.raw(DRIVER_SHIFT_LOGS.name))
    columns = ("driver_id", "vehicle_id", "clock_in", "clock_out", "break_minutes", "city")
    return raw.select("dt", *columns)


@register
def silver_roundtrip(spark, sf_dir):
    lake = zones.Lake(scratch_dir(spark, "silver"))

    def back(spec: DatasetSpec) -> DataFrame:
        path = lake.staging(spec.name)
        read = partial(zones.read_silver, spark, lake, spec)
        cleaned = cleaning.clean(_raw(spark, sf_dir, spec), spec)
        zones.write_days(cleaned, path, spec.keys)
        manifest.seal(read(), path)
        return manifest.checked(read, path)

    tables = job.at_once(partial(back, spec) for spec in DATASETS)
    return _together(dict(zip((spec.name for spec in DATASETS), tables)))


@register
def gold_roundtrip(spark, sf_dir):
    lake, of = zones.Lake(scratch_dir(spark, "gold")), sample_lake(spark, sf_dir)

    def back(name: str) -> DataFrame:
        path = lake.curated(name)
        read = partial(zones.read_gold, spark, lake, name)
        zones.write_days(zones.read_gold(spark, of, name), path, [job.GOLD_KEYS[name]])
        manifest.seal(read(), path)
        return manifest.checked(read, path)

    tables = job.at_once(partial(back, name) for name in GOLD_TABLES)
    return _together(dict(zip(GOLD_TABLES, tables)))


@register
def raw_rows_matched(spark, sf_dir):
    path = sample_lake(spark, sf_dir).raw(DELIVERY_COMPLETIONS.name)
    raw = bronze.read_raw_fields(spark, path, DELIVERY_COMPLETIONS, "city")
    matched = raw.where(F.col("city") == CITY)
    return matched.agg(F.lit(CITY).alias("city"), F.count(F.lit(1)).alias("rows_matched"))


@register
def human_bytes(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    step = F.pow(F.lit(1024), F.col("o_orderkey") % 5).cast("long")
    size = (F.col("o_totalprice") / 100).cast("long") * step
    return orders.select(
        "o_orderkey", size.alias("bytes"), functions.human_bytes(size).alias("human")
    )


@register
def scan_footprint(spark, sf_dir):
    return job.footprints(spark, sample_lake(spark, sf_dir), CITY, DAY)


@register
def scan_cost_comparison(spark, sf_dir):
    return job.cost_comparison(spark, sample_lake(spark, sf_dir), CITY, DAY)


def _document_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a listing, a day for each source: all of them against one day's."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    number = F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("int")
    files = documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("length"),
        F.date_add(analytics.day(FIRST_DAY), number).alias("dt"),
        "lang",
    )
    one_day = files.where(F.col("dt") == analytics.day(DAY))
    footprints = [
        footprint.scan_footprint(name, found, found.where("lang = 'en'"))
        for name, found in (("before", files), ("after", one_day))
    ]
    return footprints[0].unionByName(footprints[1])


@register
def document_scan_footprint(spark, sf_dir):
    return _document_footprints(spark, sf_dir)


@register
def document_scan_cost(spark, sf_dir):
    cost = footprint.scan_cost_comparison(_document_footprints(spark, sf_dir), CITY, DAY)
    return cost.select(
        "target_dt",
        "target_city",
        *[
            F.col(f"{side}.{name}").alias(f"{side}_{name}")
            for side in ("before", "after")
            for name in ("bytes_scanned", "files_touched", "rows_matched")
        ],
        "reduction_pct",
        "before_cost_usd",
        "after_cost_usd",
        "before_size",
        "after_size",
    )
