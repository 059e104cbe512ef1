"""Tables that a job writes for itself, to read them more than once.

Unlike a persisted DataFrame they take no executor memory, whatever their size.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from recurra.sources.sinks import PACKED, shuffles_removed


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def staged(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to a new folder below ``folder`` and read back; that one goes with the application at the latest."""
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{uuid4().hex}"
    with shuffles_removed(spark):
        df.write.option("compression", PACKED).parquet(path)
    fs, where = _folder(spark, path)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove the staged tables below a folder."""
    fs, where = _folder(spark, folder)
    fs.delete(where, True)
