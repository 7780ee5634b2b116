"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:  # tests and single machines
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = getattr(shared_dir, "own", None) or "file://" + tempfile.mkdtemp(prefix="lodestone-")
        shared_dir.own = at
    return at.rstrip("/")


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lodestone/{uuid.uuid4().hex}"


def freed(spark: SparkSession) -> None:
    """Lets go of the shuffles of plans that nobody holds any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """df written and read again: short lineage that survives lost executors."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
