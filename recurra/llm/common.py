"""Helpers shared by the corpus operators: words, row keys, written tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.session import checkpoint_root

# A word is a maximal run of characters other than these six.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null, empty or blank text."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once; a lambda would repeat an outer expression for every element."""
    return F.transform(F.array(value), body)[0]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages restart from the files, so a lost executor costs no more than
    its running tasks. The table is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    keep = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")       # the table replaces the shuffle files behind it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, keep)
    jvm, sc = spark._jvm, spark.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove written tables before the application ends; only what nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root), root the least node reached.

    Large-star / small-star rounds: every round points the neighbours of a node
    at the least of them, until the links are stars around their roots. A round
    costs two grouped minima and two joins over the links; nothing is gathered
    on the driver but a count and a hash of the links. Nodes without a link are
    not in the result.
    """
    links = cut(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        small = small.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").where("u <> v").distinct()
        links = cut(small, "small-star")
        seen = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state:
            return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
        state = seen
