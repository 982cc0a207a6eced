"""Bronze zone: JSON lines as sent by the source systems, one folder per day."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from roadbook.spec import ARRIVAL, CORRUPT, DatasetSpec

log = logging.getLogger(__name__)

Days = Sequence[dt.date | str] | None

# Names of raw files: JSON lines, plain or compressed.
RAW_SUFFIX = ".{json,json.gz}"

def _reader(spark: SparkSession) -> DataFrameReader:
    """Other files in a raw folder are not data."""
    return spark.read.option("pathGlobFilter", f"*{RAW_SUFFIX}")


def _or_empty(spark: SparkSession, path: str, schema, read) -> DataFrame:
    """The result of ``read``, or no rows of ``schema`` where nothing lies at ``path``."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no raw files found at %s", path)
        return spark.createDataFrame([], schema)


def on_days(days: Days) -> Column:
    """The condition that ``dt`` is one of these days; always true for None."""
    if days is None:
        return F.lit(True)
    return F.col("dt").isin([dt.date.fromisoformat(str(day)) for day in days])


def read_raw(
    spark: SparkSession, path: str, spec: DatasetSpec, days: Days = None
) -> DataFrame:
    """All (or some) days of a raw dataset in one scan, fields as text, ``dt`` from the folders.

    Two more columns tell where a line comes from: its file, and the block of the file that its
    task reads. ``with_arrival`` turns them into the position of the line.
    """
    raw = _or_empty(
        spark,
        path,
        spec.raw_schema,
        lambda: _reader(spark)
        .schema(spec.raw_schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .select("*", F.col("_metadata.file_name"), F.col("_metadata.file_block_start")),
    )
    if "file_name" not in raw.columns:
        raw = raw.withColumns({"file_name": F.lit(""), "file_block_start": F.lit(0)})
    return raw.where(on_days(days))


def with_arrival(raw: DataFrame) -> DataFrame:
    """Adds ARRIVAL, the position of a line: file, block, and a number that rises along the block.

    It follows line order however files are split over tasks, as long as nothing has shuffled the
    rows since ``read_raw``. The number also keeps Spark from moving later filters below this
    point, so columns computed before it are computed once and not again inside each filter.
    """
    position = F.struct("file_name", "file_block_start", F.monotonically_increasing_id())
    return raw.withColumn(ARRIVAL, position).drop("file_name", "file_block_start")


def read_raw_fields(
    spark: SparkSession, path: str, spec: DatasetSpec, *fields: str
) -> DataFrame:
    """Only some fields of a raw dataset and ``dt``, for queries that go to bronze directly."""
    schema = spec.raw_schema
    wanted = type(schema)([schema[name] for name in (*fields, "dt")])
    return _or_empty(spark, path, wanted, lambda: _reader(spark).schema(wanted).json(path))


def infer_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw dataset with the types Spark finds in it. Reads everything once more to find them."""
    return _reader(spark).json(path)


def raw_lines(spark: SparkSession, path: str, days: Days = None) -> DataFrame:
    """The non-blank lines of a raw dataset, unparsed: one row (``dt``) per record."""
    schema = "value string, dt date"
    lines = _or_empty(spark, path, schema, lambda: _reader(spark).schema(schema).text(path))
    return lines.where(on_days(days) & (F.trim("value") != "")).select("dt")


def land_raw(
    records: DataFrame,
    path: str,
    tasks: int | None = None,
    dealt: bool = False,
    compression: str = "none",
) -> None:
    """Write records as JSON lines per day; days that are written replace what was there.

    Null fields stay in the record. Where the frame has the ARRIVAL column, lines and files are
    laid out in its order, which ``read_raw`` then finds again. The records are so dealt out by
    ranges, as many as there are to be ``tasks``, or as configured. With ``dealt``, all records of a
    key already lie in one task: they stay there, in order within their file, and nothing is shuffled.
    """
    if ARRIVAL in records.columns:
        by_arrival = ["dt", ARRIVAL]
        if not dealt:
            # A number of its own is kept as it is, while the configured one is cut down to what pays off.
            records = records.repartitionByRange(*([tasks] if tasks else []), *by_arrival)
        records = records.sortWithinPartitions(*by_arrival).drop(ARRIVAL)
    (
        records.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .option("compression", compression)
        .partitionBy("dt")
        .json(path)
    )
