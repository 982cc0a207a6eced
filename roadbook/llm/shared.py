"""Intermediate tables in the folder that the cluster shares, and this package on its executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import roadbook
from roadbook.session import scratch_dir

_SHIPPED: set[str] = set()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once as Parquet below spark.checkpoint.dir and read from there.

    A lost executor costs no stage before the written one, and no text is read twice.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_keys(docs: DataFrame, id_col: str, key: str) -> tuple[DataFrame, int]:
    """docs with a column key, the id as a long or, for each row without one, a number of its own above
    all ids; and the greatest id. Rows without an id are stored, so that they keep their number.
    """
    own = F.col(f"`{id_col}`").cast("long")
    last, lost = docs.agg(F.max(own), F.count_if(own.isNull())).first()
    last = -1 if last is None else last
    given = docs.withColumn(key, own)
    if not lost:
        return given, last
    if last + lost >= 2**63:
        raise ValueError("no numbers are left above the greatest id for the rows without one")
    rows = docs.where(own.isNull()).withColumn(key, F.monotonically_increasing_id())
    rows = stored(rows, "rows-without-id")
    # A row for each task that wrote some, with where its numbers begin.
    parts = rows.groupBy(F.shiftright(key, 33).alias("part")).agg(F.max(key).alias("most")).collect()
    begins, at = [], last + 1
    for part, most in sorted(map(tuple, parts)):
        begins.append((part, at - (part << 33)))
        at += most - (part << 33) + 1
    names = [f"_{key}_part", f"_{key}_begin"]
    begins = docs.sparkSession.createDataFrame(begins, ", ".join(f"`{n}` long" for n in names))
    rows = rows.join(F.broadcast(begins), F.shiftright(key, 33) == F.col(names[0]))
    rows = rows.withColumn(key, F.col(key) + F.col(names[1])).select(*[f"`{c}`" for c in given.columns])
    return given.where(F.col(key).isNotNull()).unionByName(rows), last


def ship_package(spark: SparkSession) -> SparkSession:
    """Give executors this package, once for each application; Spark serves the file to them."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(roadbook.__file__))
        folder = tempfile.mkdtemp(prefix="roadbook-")  # the driver serves it while it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, "roadbook.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for top, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(top, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark
