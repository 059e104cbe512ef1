"""Sinks and views (K3-K5)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PACKED = "zstd"         # of the Parquet files that a job keeps or stages


@contextmanager
def _conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    keep = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if keep is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, keep)


@contextmanager
def side_by_side(spark: SparkSession, files: int) -> Iterator[None]:
    """Tasks of a partitioned write keep up to so many files open, one for each partition value, and do
    not sort their rows by it in executor memory; tasks that reach the number sort the rest."""
    with _conf(spark, OPEN_FILES, str(files)):
        yield


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write are removed when it ends; else they stay on the executors' disks until
    the driver happens to collect its garbage. Only for writes: a DataFrame collected again would shuffle again."""
    with _conf(spark, CLEANUP, "true"):
        yield


def append(df: DataFrame, path: str) -> None:
    """K4: append-only table (reconciliation log)."""
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """K3: full overwrite (snapshot tables)."""
    df.write.mode("overwrite").parquet(path)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """K5: expose lazy report DataFrames to SQL users as temp views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
