"""Rebuild the days whose raw files have changed, and no others.

What lies in the raw zone (path, length and modification time of each file) is compared with what
lay there when the last refresh ended. A day with a file that is new, rewritten or gone is rebuilt as
a whole by the ordinary batch job, whatever the age of the file. The listing is kept only after the
rebuild, so a refresh that fails is repeated by the next one, which changes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.plans import job
from roadbook.sources.bronze import RAW_SUFFIX
from roadbook.sources.lake import Lake, complete_versions, make_folder, remove_folder
from roadbook.sources.listing import FILES, by_day, stored_listing
from roadbook.spec import DATASETS

def changed_days(before: DataFrame, now: DataFrame) -> DataFrame:
    """The days (``dt``) of files that are in one listing and not, or not so, in the other."""
    both = before.withColumn("side", F.lit(1)).unionByName(now.withColumn("side", F.lit(2)))
    one_sided = both.groupBy(*before.columns).agg(F.count_distinct("side").alias("sides"))
    return one_sided.where("sides = 1").select("dt").distinct()


def refresh_on_arrival(spark: SparkSession, lake: Lake, checkpoint: str) -> list[str]:
    """Bring silver and gold up to date with the raw zone; the days that were rebuilt.

    Run it whenever data lands, one at a time. ``checkpoint`` is the folder that keeps the listing.
    A dataset of which nothing has arrived yet is watched as well.
    """
    for spec in DATASETS:
        make_folder(spark, lake.raw(spec.name))
    # Written before it is used: files that land during the rebuild belong to the next refresh.
    now = stored_listing(spark, {spec.name: lake.raw(spec.name) for spec in DATASETS}, RAW_SUFFIX)
    versions = complete_versions(spark, checkpoint)
    if versions:
        before = spark.read.schema(FILES).parquet(f"{checkpoint}/{versions[-1]}")
    else:
        before = spark.createDataFrame([], FILES)
    days = sorted(str(row.dt) for row in changed_days(before, now).collect())  # one row per day
    if days:
        job.build_silver(spark, lake, days, by_day(now))
        job.build_gold(spark, lake, days)
        last = versions[-1] if versions else 0
        now.write.mode("overwrite").parquet(f"{checkpoint}/{last + 1}")
    for version in versions[: -1 if not days else None]:
        remove_folder(spark, f"{checkpoint}/{version}")
    return days
