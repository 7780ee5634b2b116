"""What the operators share: the shared scratch folder, tables in it, and small column helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in every word-based contract: space and U+0009 to U+000D.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.  Where it is unset, a local session (tests) gets one of its own; a cluster can't."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = getattr(scratch_dir, "own", None)
        if at is None:
            at = scratch_dir.own = "file://" + tempfile.mkdtemp(prefix="lodestone-")
    return at.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/lodestone/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends here and survives lost executors.

    Writers hold a row group, and readers decode one at a time: where rows are megabytes long, `group_rows` bounds it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes what stored() wrote; df must not be used afterwards."""
    path = getattr(df, "_stored_path", None)
    if path:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def released() -> None:
    """Called where a task's Python work ends: what the worker no longer uses goes back to the machine, since idle workers stay."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows per Arrow batch: whole texts are long, and a worker holds a batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for the plans that run inside; the session's setting comes back at the end."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
