"""Folders of the lake, its Parquet tables and their names in the catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.sources import bronze
from roadbook.sources.listing import Day, by_day, list_files
from roadbook.spec import DATASETS, GOLD_SCHEMAS, DatasetSpec


@dataclass(frozen=True)
class Lake:
    """Where the zones lie: raw (bronze), staging (silver), curated (gold)."""

    base: str
    raw_base: str = ""  # where the raw zone lies, if not beside the others

    def raw(self, name: str) -> str:
        return f"{self.raw_base or self.base}/raw/{name}"

    def staging(self, name: str) -> str:
        return f"{self.base}/staging/{name}"

    def curated(self, name: str) -> str:
        return f"{self.base}/curated/{name}"

    @property
    def ledger(self) -> str:
        return f"{self.base}/ledger"

    @property
    def cost_report(self) -> str:
        return f"{self.base}/cost_comparison"


def _folder(spark: SparkSession, path: str):
    """A folder with the file system it lies on (Hadoop objects)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def write_text(spark: SparkSession, path: str, name: str, text: str) -> None:
    """A small file, written under a name that readers skip and then renamed."""
    folder, files = _folder(spark, path)
    files.mkdirs(folder)
    hidden = _folder(spark, f"{path}/_{name}")[0]
    out = files.create(hidden)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not files.rename(hidden, _folder(spark, f"{path}/{name}")[0]):
        raise OSError(f"{path}/{name} could not be written")


def size_on_file(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all below a folder; 0 where there is nothing."""
    folder, files = _folder(spark, path)
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """The numbered tables below ``path`` that were written to the end, in order."""
    folder, files = _folder(spark, path)
    listed = files.listStatus(folder) if files.exists(folder) else []
    names = [status.getPath().getName() for status in listed]
    numbers = sorted(int(name) for name in names if name.isdigit())
    return [n for n in numbers if files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0])]


def days_on_file(spark: SparkSession, path: str) -> list[str]:
    """The days that have a folder at ``path``; none if there is nothing."""
    folder, files = _folder(spark, path)
    listed = files.listStatus(folder) if files.exists(folder) else []
    names = [status.getPath().getName() for status in listed]
    return sorted(name.removeprefix("dt=") for name in names if name.startswith("dt="))


def _any_file(spark: SparkSession, path: str):
    """One file of a folder, or None."""
    folder, files = _folder(spark, path)
    listed = files.listStatus(folder) if files.exists(folder) else []
    return next((status.getPath() for status in listed if status.isFile()), None)


def day_bounds(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """First and last day of a table by its folders, those without a file left out. No file is opened."""
    days = days_on_file(spark, path)

    def first(ordered: Iterable[str]) -> str | None:
        return next((d for d in ordered if _any_file(spark, f"{path}/dt={d}") is not None), None)

    low = first(days)
    return None if low is None else (low, first(reversed(days)))


def write_days(
    table: DataFrame,
    path: str,
    sort_by: Sequence[str] = (),
    gather: bool = True,
    covers: Iterable[dt.date | str] = (),
) -> None:
    """Write a table as Parquet, one folder per ``dt``; only the days it holds are replaced.

    ``gather`` shuffles each day into files of the advisory partition size: a small day becomes
    one file, a day of terabytes is split over many tasks. A table of a single day can do without.
    Rows are sorted inside a file, so that row-group statistics help filters on these columns.

    ``covers`` names the days the table speaks for. One of them that it has no rows for is removed:
    it is known by a file from before, which the write would have replaced.
    """
    spark = table.sparkSession
    before = [_any_file(spark, f"{path}/dt={day}") for day in covers]
    if gather:
        table = table.hint("rebalance", F.col("dt"))
    (
        table.sortWithinPartitions("dt", *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )
    _, files = _folder(spark, path)
    for file in before:
        if file is not None and files.exists(file):
            files.delete(file.getParent(), True)


def read_silver(spark: SparkSession, lake: Lake, spec: DatasetSpec) -> DataFrame:
    return spark.read.schema(spec.silver_schema).parquet(lake.staging(spec.name))


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return spark.read.schema(GOLD_SCHEMAS[name]).parquet(lake.curated(name))


def _tables(spark: SparkSession, lake: Lake, include_silver: bool) -> Iterator[tuple]:
    """Name, path and rows of each table."""
    for name in GOLD_SCHEMAS:
        yield name, lake.curated(name), read_gold(spark, lake, name)
    for spec in DATASETS if include_silver else ():
        yield spec.name, lake.staging(spec.name), read_silver(spark, lake, spec)


def register_views(spark: SparkSession, lake: Lake, include_silver: bool = True) -> None:
    """Name the gold (and silver) tables for SQL in this session."""
    for name, _, table in _tables(spark, lake, include_silver):
        table.createOrReplaceTempView(name)


def register_tables(
    spark: SparkSession, lake: Lake, database: str, include_silver: bool = True
) -> None:
    """Enter the tables in the catalog as external tables with all the days they have now.

    The catalog then knows the days, and a query need not list the folders. Run it again after
    new days were written.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path, rows in _tables(spark, lake, include_silver):
        table = f"{database}.{name}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        if spark.catalog.tableExists(table) and not _is_at(spark, table, path, rows):
            spark.sql(f"DROP TABLE {table}")  # external: its files stay
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
            f"USING parquet PARTITIONED BY (dt) LOCATION '{quoted}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def _is_at(spark: SparkSession, table: str, path: str, rows: DataFrame) -> bool:
    """Whether the catalog has this place and these columns for the table."""
    known = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    place = known.data_type.removeprefix("file:").replace("//", "/").rstrip("/") if known else ""
    wanted = path.removeprefix("file:").replace("//", "/").rstrip("/")
    fields = {f.name: f.dataType for f in spark.table(table).schema}
    return place == wanted and fields == {f.name: f.dataType for f in rows.schema}


def register_raw(spark: SparkSession, lake: Lake) -> None:
    """Name the raw datasets for SQL in this session, fields as text: raw_<dataset>."""
    for spec in DATASETS:
        table = bronze.read_raw_fields(spark, lake.raw(spec.name), spec, *spec.columns)
        table.createOrReplaceTempView(f"raw_{spec.name}")


def cached_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table kept in memory (and on disk beyond it) while a dashboard is in use."""
    return spark.table(name).cache()


class TableCache:
    """Gold tables kept in memory (and on disk beyond it), each in the version its files have.

    ``table`` lists the table's files, which opens none, and reads them again if they are no longer the
    ones that were read: a day that was rebuilt is seen, and the copy from before is released.
    """

    def __init__(self, spark: SparkSession, lake: Lake):
        self._spark, self._lake = spark, lake
        self._kept: dict[str, tuple[dict[str, Day], DataFrame]] = {}

    def table(self, name: str) -> DataFrame:
        path = self._lake.curated(name)
        version = by_day(list_files(self._spark, {name: path}, ".parquet")).get(name, {})
        kept = self._kept.get(name)
        if kept is None or kept[0] != version:
            self.release(name)
            self._spark.catalog.refreshByPath(path)
            kept = self._kept[name] = (version, read_gold(self._spark, self._lake, name).persist())
        return kept[1]

    def release(self, name: str | None = None) -> None:
        """Give up the copy of a table, or of all."""
        for known in [name] if name else list(self._kept):
            _, table = self._kept.pop(known, (None, None))
            if table is not None:
                table.unpersist(blocking=True)
