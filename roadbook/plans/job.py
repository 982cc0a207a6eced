"""The daily job: clean raw days, rebuild their gold rows, answer the queries, report.

Days are built in groups of a bounded size, each zone written before the next is built from it. The
ledger knows which days are done, and from which files: a run that was stopped goes on where it was,
and each write replaces whole days, so doing a step twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from itertools import chain
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.operators import footprint, reports
from roadbook.operators.cleaning import first_by, judged
from roadbook.operators.dedupe import first_copies, repeated_marks
from roadbook.plans import analytics, gold
from roadbook.plans.schedule import GROUP_BYTES, groups_of_days
from roadbook.session import scratch_dir, working_session
from roadbook.sources import bronze, ledger
from roadbook.sources.bronze import RAW_SUFFIX, Days, on_days
from roadbook.sources.lake import (
    Lake,
    day_bounds,
    days_on_file,
    make_folder,
    read_gold,
    read_silver,
    register_views,
    remove_folder,
    write_days,
)
from roadbook.sources.ledger import Entry
from roadbook.sources.listing import Day, by_day, list_files, stored_listing
from roadbook.spec import (
    DATASETS,
    DELIVERY_COMPLETIONS,
    DRIVER_SHIFT_LOGS,
    GOLD_TABLES,
    VALID,
    VEHICLE_TELEMETRY,
    DatasetSpec,
)

T = TypeVar("T")

# Rows are sorted by this column within the days of a gold table.
GOLD_KEYS = dict(zip(GOLD_TABLES, ("vehicle_id", "driver_id", "city")))
# What each gold table is built from.
GOLD_SOURCES = dict(
    zip(
        GOLD_TABLES,
        (
            (VEHICLE_TELEMETRY,),
            (DRIVER_SHIFT_LOGS, DELIVERY_COMPLETIONS),
            (DELIVERY_COMPLETIONS,),
        ),
    )
)
# Bytes of typed rows that a cleaning task reads, and of shuffled ones: as rows that are hashed and
# sorted in memory, they are some ten times as much. Row groups are as small, or they were not split.
STAGED_BYTES, SILVER_BYTES = 8 * 1024**2, "8m"
# Bytes of shuffled key hashes that a task counts: of 9 bytes each, which take 64 and more in its map.
HASHED_BYTES = "4m"
# A shuffle of a cleaning task starts with so many times the partitions that a session has for its input.
SILVER_SPREAD = 4
NARROW = {
    "spark.sql.files.maxPartitionBytes": str(STAGED_BYTES),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": SILVER_BYTES,
}
# Fingerprint of a day that has no files.
NO_FILES = 0

Listed = Mapping[str, Mapping[str, Day]]


def at_once(steps: Iterable[Callable[[], T]]) -> list[T]:
    """Run independent writes together, so that none waits for the last tasks of another."""
    with ThreadPoolExecutor() as pool:
        return [step.result() for step in [pool.submit(step) for step in steps]]


def list_raw(spark: SparkSession, lake: Lake) -> dict[str, dict[str, Day]]:
    """The days of each raw dataset with their bytes and fingerprints."""
    return by_day(list_files(spark, {spec.name: lake.raw(spec.name) for spec in DATASETS}, RAW_SUFFIX))


def _sizes(listed: Listed, names: Iterable[str], days: Iterable[str]) -> dict[str, int]:
    """For each day the bytes of the largest of the named inputs."""
    none = Day(0, NO_FILES)
    return {day: max(listed.get(n, {}).get(day, none).bytes for n in names) for day in days}


def _all_days(listed: Listed, days: Days) -> list[str]:
    found = {day for of in listed.values() for day in of} if days is None else {str(d) for d in days}
    return sorted(found)


def clean_staged(
    spark: SparkSession, raw: DataFrame, spec: DatasetSpec, prefer: str | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Silver rows as ``clean`` gives them, counts by day, and the scratch folders behind both.

    Raw text is parsed once, in the session of ``raw``, and all that is shuffled of every row is a hash
    of its key, in a session like it with smaller tasks. What is returned belongs to ``spark``.
    """
    hashed = {**NARROW, "spark.sql.adaptive.advisoryPartitionSizeInBytes": HASHED_BYTES}
    own = working_session(raw.sparkSession, **hashed)
    judged_at, marks_at = (scratch_dir(own, f"{kind}-{spec.name}") for kind in ("judged", "repeated"))

    def written(rows: DataFrame, path: str, session: SparkSession) -> DataFrame:
        return session.read.schema(rows.schema).parquet(path)

    rows = judged(raw, spec)
    rows.write.option("parquet.block.size", STAGED_BYTES).parquet(judged_at)
    marks = repeated_marks(written(rows, judged_at, own).where(VALID), spec.keys)
    marks.write.parquet(marks_at)
    staged, marks = written(rows, judged_at, spark), written(marks, marks_at, spark)
    valid = staged.where(VALID).drop(VALID)
    rows = first_copies(valid, spec.keys, marks, first_by(prefer)).select(*spec.columns, "dt")
    counts = staged.groupBy("dt").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(VALID).alias("valid_rows")
    )
    return rows, counts, [judged_at, marks_at]


def build_silver(
    spark: SparkSession,
    lake: Lake,
    days: Days = None,
    listed: Listed | None = None,
    group_bytes: int = GROUP_BYTES,
) -> None:
    """Clean the raw datasets, all days or the given ones, and enter them in the ledger.

    Of all days, a dataset's own ones in the raw zone are built; of given days, those of each dataset.
    """
    listed = list_raw(spark, lake) if listed is None else listed
    for spec in DATASETS:
        make_folder(spark, lake.staging(spec.name))
    names = [spec.name for spec in DATASETS]
    for group in groups_of_days(_sizes(listed, names, _all_days(listed, days)), group_bytes):
        own = working_session(spark, SILVER_SPREAD * group.bytes)
        parts = [
            (spec, [d for d in group.days if days is not None or d in listed.get(spec.name, {})])
            for spec in DATASETS
        ]
        found = at_once(partial(_write_silver, own, lake, s, d, listed) for s, d in parts if d)
        ledger.enter(own, lake, "silver", chain.from_iterable(found))


def _write_silver(
    spark: SparkSession, lake: Lake, spec: DatasetSpec, days: list[str], listed: Listed
) -> list[Entry]:
    raw = bronze.read_raw(spark, lake.raw(spec.name), spec, days)
    rows, counts, scratch = clean_staged(working_session(spark, **NARROW), raw, spec)
    try:
        write_days(rows, lake.staging(spec.name), spec.keys, covers=days)
        came = ledger.counts_by_day(counts)
    finally:
        for path in scratch:
            remove_folder(spark, path)
    written = ledger.counts_by_day(_rows_per_day(read_silver(spark, lake, spec).where(on_days(days))))
    of, none = listed.get(spec.name, {}), Day(0, NO_FILES)
    return [
        Entry(
            spec.name,
            day,
            of.get(day, none).mark,
            came.get(day, {}).get("raw_rows", 0),
            came.get(day, {}).get("valid_rows", 0),
            written.get(day, {}).get("rows", 0),
        )
        for day in days
    ]


def _rows_per_day(table: DataFrame) -> DataFrame:
    """Rows of each day; from Parquet files it reads nothing but their footers."""
    return table.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


def gold_tables(spark: SparkSession, lake: Lake, days: Days = None) -> dict[str, DataFrame]:
    """The gold tables as plans over the silver zone."""
    telemetry, shifts, deliveries = (
        read_silver(spark, lake, spec).where(on_days(days))
        for spec in (VEHICLE_TELEMETRY, DRIVER_SHIFT_LOGS, DELIVERY_COMPLETIONS)
    )
    tables = (
        gold.daily_fleet_utilization(telemetry),
        gold.driver_performance(shifts, deliveries),
        gold.delivery_sla_compliance(deliveries),
    )
    return dict(zip(GOLD_TABLES, tables))


def build_gold(
    spark: SparkSession,
    lake: Lake,
    days: Days = None,
    group_bytes: int = GROUP_BYTES,
) -> None:
    """Aggregate silver into the gold tables, all days or the given ones, and enter them in the ledger.

    Of all days, those that silver or a gold table has.
    """
    for name in GOLD_TABLES:
        make_folder(spark, lake.curated(name))
    places = {spec.name: lake.staging(spec.name) for spec in DATASETS}
    staged, marks = at_once(
        [
            lambda: by_day(list_files(spark, places, ".parquet")),
            lambda: ledger.finished(spark, lake, "silver"),
        ]
    )
    wanted = set(_all_days(staged, days))
    if days is None:
        wanted |= {day for name in GOLD_TABLES for day in days_on_file(spark, lake.curated(name))}
    for group in groups_of_days(_sizes(staged, list(staged) or [""], wanted), group_bytes):
        own = working_session(spark, group.bytes)
        tables = gold_tables(own, lake, group.days)
        found = at_once(
            partial(_write_gold, own, lake, name, table, group.days, marks)
            for name, table in tables.items()
        )
        ledger.enter(own, lake, "gold", chain.from_iterable(found))


def _write_gold(
    spark: SparkSession,
    lake: Lake,
    name: str,
    table: DataFrame,
    days: tuple[str, ...],
    marks: Mapping[tuple[str, str], int],
) -> list[Entry]:
    write_days(table, lake.curated(name), [GOLD_KEYS[name]], covers=days)
    written = ledger.counts_by_day(_rows_per_day(read_gold(spark, lake, name).where(on_days(days))))
    return [
        Entry(name, day, gold_mark(name, day, marks), None, None, written.get(day, {}).get("rows", 0))
        for day in days
    ]


def gold_mark(name: str, day: str, silver: Mapping[tuple[str, str], int]) -> int:
    """Fingerprint of what a gold day is built from, by those of its silver days."""
    return reduce(
        lambda mark, spec: (mark * 31 + silver.get((spec.name, day), NO_FILES)) % 2**63,
        GOLD_SOURCES[name],
        NO_FILES,
    )


def unfinished(
    spark: SparkSession, lake: Lake, listed: Listed, days: Days = None
) -> tuple[list[str], list[str]]:
    """The days that silver, and those that gold has not built from the raw files as they are now.

    A silver day that is to be built is to be built in gold as well, and is not named there.
    """
    zones = ("silver", "gold")
    silver, done = at_once(partial(ledger.finished, spark, lake, zone) for zone in zones)
    wanted = _all_days(listed, days)

    def changed(name: str, day: str) -> bool:
        of = listed.get(name, {})
        if day in of:
            return silver.get((name, day)) != of[day].mark
        # Its files are gone, or never came: that counts where the day was asked for.
        return days is not None and silver.get((name, day), NO_FILES) != NO_FILES

    stale = [day for day in wanted if any(changed(spec.name, day) for spec in DATASETS)]
    behind = [
        day
        for day in wanted
        if day not in stale
        and any(done.get((name, day)) != gold_mark(name, day, silver) for name in GOLD_TABLES)
    ]
    return stale, behind


def queries(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The five queries on gold."""
    fleet, drivers, sla = (read_gold(spark, lake, name) for name in GOLD_TABLES)
    _, last = day_bounds(spark, lake.curated("driver_performance")) or (None, None)
    return {
        "underutilized_vehicles": analytics.underutilized_vehicles(fleet),
        "driver_leaderboard_7d": analytics.driver_leaderboard(drivers, last=last),
        "city_sla_trend": analytics.city_sla_trend(sla),
        "worst_sla_city_days": analytics.worst_sla_city_days(sla),
        "utilization_vs_hours": analytics.utilization_vs_hours(fleet, drivers),
    }


def cleaning_report(spark: SparkSession, lake: Lake, days: Days = None) -> DataFrame:
    """Raw against staged rows of the days that lie in the raw zone, or of the given ones.

    The counts are those that were entered when the days were built; no data is read. A day that is no
    longer in the raw zone does not count.
    """
    built = ledger.entries(spark, lake, "silver")

    def of(spec: DatasetSpec) -> DataFrame:
        covered = days_on_file(spark, lake.raw(spec.name)) if days is None else days
        return built.where((F.col("name") == spec.name) & on_days(covered))

    return reports.cleaning_report_of_counts({spec.name: of(spec) for spec in DATASETS})


def build_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows and days of the gold tables, as entered when they were built; no data is read."""
    return reports.build_report_of_counts(ledger.entries(spark, lake, "gold"), GOLD_TABLES)


def footprints(spark: SparkSession, lake: Lake, city: str, on: analytics.Day) -> DataFrame:
    """Scanning raw deliveries for one city (all days) against one day of the gold table."""
    raw = lake.raw(DELIVERY_COMPLETIONS.name)
    curated = lake.curated("delivery_sla_compliance")
    of_city = bronze.read_raw_fields(spark, raw, DELIVERY_COMPLETIONS, "city").where(
        F.col("city") == city
    )
    point = analytics.sla_point_lookup(read_gold(spark, lake, "delivery_sla_compliance"), city, on)
    that_day = F.col("dt") == analytics.day(on)
    listing = stored_listing(spark, {"before": raw}, RAW_SUFFIX).unionByName(
        stored_listing(spark, {"after": curated}, ".parquet").where(that_day)
    )
    before, after = (listing.where(F.col("name") == name) for name in ("before", "after"))
    return footprint.scan_footprint("before", before, of_city).unionByName(
        footprint.scan_footprint("after", after, point)
    )


def cost_comparison(spark: SparkSession, lake: Lake, city: str, on: analytics.Day) -> DataFrame:
    """What the question for one city and day costs on raw data and on gold."""
    return footprint.scan_cost_comparison(footprints(spark, lake, city, on), city, str(on))


@dataclass(frozen=True)
class JobResult:
    """Lazy frames: what was cleaned, what was built, the answers by query name, the scan costs."""

    cleaning: DataFrame
    gold: DataFrame
    queries: dict[str, DataFrame]
    cost: DataFrame | None


def run(
    spark: SparkSession,
    lake: Lake,
    days: Days = None,
    cost_of: tuple[str, analytics.Day] | None = None,
    fresh: bool = False,
) -> JobResult:
    """Build silver and gold from the raw zone, name the tables, and prepare the answers.

    Days that the ledger has as built from the raw files as they are now are left alone, unless
    ``fresh``; so a run that was stopped goes on with what is left. With ``cost_of``, a (city, day), the
    scan comparison is written next to the zones as JSON. Any failure ends the run.
    """
    listed = list_raw(spark, lake)
    if fresh:
        stale, behind = _all_days(listed, days), []
    else:
        stale, behind = unfinished(spark, lake, listed, days)
    if stale and days is None:
        of_stale = {n: {d: of[d] for d in of if d in stale} for n, of in listed.items()}
        build_silver(spark, lake, None, of_stale)
    elif stale:
        build_silver(spark, lake, stale, listed)
    if stale or behind:
        build_gold(spark, lake, sorted({*stale, *behind}))
    register_views(spark, lake)
    cost = None
    if cost_of:
        footprint.write_report(cost_comparison(spark, lake, *cost_of), lake.cost_report)
        cost = spark.read.json(lake.cost_report)
    return JobResult(
        cleaning=cleaning_report(spark, lake, days),
        gold=build_report(spark, lake),
        queries=queries(spark, lake),
        cost=cost,
    )
