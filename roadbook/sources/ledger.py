"""What the job has finished: for each zone, table and day the input it was built from and its counts.

A log: each finished group of days appends one file, and the last row of a (name, day) holds. A rerun so
replaces its counts, and what has no row, or a row for other input, is still to be done. Counts are those
of files that were written to the end, so tasks that run twice do not show in them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.sources.lake import Lake, write_text


class Entry(NamedTuple):
    """mark: fingerprint of the input files; raw_rows, valid_rows: what came in; rows: what was written."""

    name: str
    dt: str
    mark: int
    raw_rows: int | None
    valid_rows: int | None
    rows: int


ENTRIES = "name string, dt date, mark long, raw_rows long, valid_rows long, rows long"
_LOG = ENTRIES + ", version long"


def entries(spark: SparkSession, lake: Lake, zone: str) -> DataFrame:
    """The rows of a zone that hold now; none if nothing has been built yet."""
    try:
        log = spark.read.schema(_LOG).json(f"{lake.ledger}/{zone}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRIES)
    held = [F.max_by(c, "version").alias(c) for c in ("mark", "raw_rows", "valid_rows", "rows")]
    return log.groupBy("name", "dt").agg(*held)


def finished(spark: SparkSession, lake: Lake, zone: str) -> dict[tuple[str, str], int]:
    """The mark of each (name, day) that is done. A row for each comes to the driver."""
    rows = entries(spark, lake, zone).select("name", F.col("dt").cast("string").alias("dt"), "mark")
    return {(r.name, r.dt): r.mark for r in rows.toLocalIterator()}


def enter(spark: SparkSession, lake: Lake, zone: str, found: Iterable[Entry]) -> None:
    """Append the entries of one group of days, as a file of its own that is there whole or not at all."""
    version = time.time_ns()
    lines = [json.dumps({**entry._asdict(), "version": version}) for entry in found]
    if lines:
        name = f"{version}-{uuid.uuid4().hex[:8]}.json"
        write_text(spark, f"{lake.ledger}/{zone}", name, "\n".join(lines) + "\n")


def counts_by_day(counts: DataFrame) -> dict[str, dict[str, int]]:
    """Rows (dt, counts) by day. A row for each day comes to the driver."""
    rows = counts.withColumn("dt", F.col("dt").cast("string")).toLocalIterator()
    return {row.dt: row.asDict() for row in rows}
