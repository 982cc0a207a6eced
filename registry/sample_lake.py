"""A lake over the sample tables: landed as JSON, then built by the daily job."""

from __future__ import annotations

import hashlib
import os
from functools import partial
from threading import Lock

from pyspark.sql import SparkSession

from roadbook.plans import job
from roadbook.session import scratch_dir, use_utc
from roadbook.sources import sample
from roadbook.sources.lake import Lake, register_tables

_lakes: dict[tuple[str, str], Lake] = {}
_building = Lock()


def new_lake(spark: SparkSession) -> Lake:
    """An empty lake in the shared scratch folder."""
    return Lake(scratch_dir(use_utc(spark), "lake"))


def land(spark: SparkSession, sf_dir: str, lake: Lake) -> None:
    """Write the three sample datasets to the raw zone."""
    job.at_once(partial(sample.land, spark, sf_dir, name, lake.raw(name)) for name in sample.RAW)


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, os.path.realpath(sf_dir)


def remember(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    """Let the queries on ``sf_dir`` use this lake."""
    _lakes[_key(spark, sf_dir)] = lake
    return lake


def sample_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of ``sf_dir``, built once per application: all gold queries read the same tables."""
    with _building:
        known = _lakes.get(_key(spark, sf_dir))
        if known:
            return known
        lake = new_lake(spark)
        land(spark, sf_dir, lake)
        job.build_silver(spark, lake)
        job.build_gold(spark, lake)
        return remember(spark, sf_dir, lake)


def catalog(spark: SparkSession, sf_dir: str) -> tuple[Lake, str]:
    """The lake of ``sf_dir`` and the database that names its tables, entered once per lake."""
    lake = sample_lake(spark, sf_dir)
    name = "roadbook_" + hashlib.md5(lake.base.encode()).hexdigest()[:12]
    with _building:
        if not spark.catalog.databaseExists(name):
            place = scratch_dir(spark, "database")
            spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
            register_tables(spark, lake, name)
    return lake, name
