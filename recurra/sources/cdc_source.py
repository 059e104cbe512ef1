"""CDC sources (S1): anything that yields message text in ``value``.

One stream carries all five topics (the reference opens one subscription per
topic); the topic of each message is kept in ``topic``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.sources.sinks import shuffles_removed, side_by_side

TOPICS = 16             # files that a task writes side by side
MESSAGES = 1_000_000    # of a file at most: a compressed file is read by one task


def read_cdc_files(spark: SparkSession, path: str, stream: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files laid out as ``<path>/<topic>/<file>``: (topic, value)."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("recursiveFileLookup", "true")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    topic = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:topic=)?([^/]+)/[^/]+$", 1)
    return df.select(topic.alias("topic"), "value")


def from_kafka(df: DataFrame) -> DataFrame:
    """Rows of a ``kafka`` source (binary key/value) -> (topic, value)."""
    return df.select("topic", F.col("value").cast("string").alias("value"))


def write_cdc_files(messages: DataFrame, path: str) -> None:
    """Lay (topic, value) rows out as the file source above expects.

    A task keeps a file open for each topic, so that the traffic is not sorted
    by topic in executor memory; tasks with more topics than that still sort.
    The text is compressed, as it is by far the largest thing that a run has on disk.
    """
    spark = messages.sparkSession
    with side_by_side(spark, TOPICS), shuffles_removed(spark):
        (messages.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", MESSAGES)
         .partitionBy("topic").text(path))
