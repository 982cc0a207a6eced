"""What files lie in a zone: one listing, stored, that sizing, scan footprints and arrivals share.

Spark's binary source lists files (over the cluster where there are many folders) and opens none as
long as no content is asked for. A listing is packed into tasks by the number of files, not by their
bytes, which nobody reads.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.session import scratch_dir, working_session

FILES_PER_TASK = 10_000
# Bytes of text behind a byte of a compressed file.
GZIPPED = 10
FILES = "name string, path string, modificationTime timestamp, length long, dt date"


def list_files(spark: SparkSession, places: Mapping[str, str], suffix: str) -> DataFrame:
    """name, path, modificationTime, length and dt of the files below each named place.

    The frame belongs to a session of its own; ``stored_listing`` gives one for the caller's.
    """
    own = working_session(
        spark, **{"spark.sql.files.maxPartitionBytes": str(2**60), "spark.sql.files.openCostInBytes": "1"}
    )
    reader = own.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    listed, most = [], 1
    for name, place in places.items():
        try:
            files = reader.load(place)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        most = max(most, len(files._jdf.inputFiles()))
        day = F.col("dt") if "dt" in files.columns else F.lit(None)  # an empty folder has no days
        listed.append(
            files.select(
                F.lit(name).alias("name"), "path", "modificationTime", "length", day.cast("date").alias("dt")
            )
        )
    # Read when the listing is planned: so many tasks at least, of about equal bytes.
    own.conf.set("spark.sql.files.minPartitionNum", str(-(-most // FILES_PER_TASK)))
    return reduce(DataFrame.unionByName, listed) if listed else own.createDataFrame([], FILES)


def stored_listing(spark: SparkSession, places: Mapping[str, str], suffix: str) -> DataFrame:
    """The same, taken now and written to the scratch folder; files that land later are not in it."""
    path = scratch_dir(spark, "listing")
    list_files(spark, places, suffix).write.parquet(path)
    return spark.read.schema(FILES).parquet(path)


@dataclass(frozen=True)
class Day:
    """The files of one name on one day: how many bytes (a compressed file's as those of its text are
    estimated), and a fingerprint that changes with them."""

    bytes: int
    mark: int


def by_day(listing: DataFrame) -> dict[str, dict[str, Day]]:
    """For each name its days. A row for each name and day comes to the driver."""
    mark = F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime")))
    plain = F.col("length") * F.when(F.col("path").endswith(".gz"), GZIPPED).otherwise(1)
    days = (
        listing.where("dt is not null")
        .groupBy("name", F.col("dt").cast("string").alias("dt"))
        .agg(F.sum(plain).alias("bytes"), mark.alias("mark"))
    )
    found: dict[str, dict[str, Day]] = {}
    for row in days.toLocalIterator():
        found.setdefault(row.name, {})[row.dt] = Day(row.bytes, row.mark)
    return {name: dict(sorted(of.items())) for name, of in found.items()}
