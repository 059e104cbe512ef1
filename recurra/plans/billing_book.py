"""The operational tables as a versioned book to which billing days are applied.

``BillingBook`` holds subscriptions, invoices and merchants, one row per key, in
buckets of the key. ``run(as_of, ...)`` works out the change sets of a day
(``operators.billing.billing_day``) from the tables as they stand, stores them,
and then merges each into its table: only the buckets with a changed key are
rewritten, as a version that a pointer then names (``streaming.versioned``).

The mark of a pointer is the last day applied. Change sets are stored before any
table changes, so a run that stops at any step is finished by a rerun from the
same change sets, and a rerun of a finished day changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recurra import schemas
from recurra.operators import billing
from recurra.operators.latest import latest_version
from recurra.streaming.versioned import VersionedTable

TABLES = ("subscriptions", "invoices", "merchants")
BUCKETS = 64
PARTS = 64          # into which the rows of a bucket are dealt by key


def _day(as_of) -> int:
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return as_of.year * 10_000 + as_of.month * 100 + as_of.day


class BillingBook:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/tables-{self.buckets}/{name}",
                              f"{self.root}/pointers-{self.buckets}/{name}", "bucket")

    def _changes(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/changes/{name}", f"{self.root}/pointers-changes/{name}", "as_of")

    def _bucketed(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(schemas.TABLES[name][1]), F.lit(self.buckets)).cast("int"))

    def _dealt(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows shuffled once, by bucket and part of the bucket: rows of a key meet, and a task writes few buckets."""
        part = F.pmod(F.xxhash64(F.lit(PARTS), schemas.TABLES[name][1]), F.lit(PARTS)).cast("int")
        return self._bucketed(name, rows).withColumn("part", part).repartition("bucket", "part")

    def load(self, name: str, rows: DataFrame, mark: int = 0, order: Sequence[str] | None = None) -> None:
        """Fill a table that has no version yet; one row per key.

        With ``order``, ``rows`` are versions, and the last of each key is taken in the shuffle that fills the buckets.
        """
        table, columns = self._table(name), [f.name for f in schemas.TABLES[name][0].fields]
        if table.pointer().seq >= 0:
            raise ValueError(f"{name} is filled already")
        if order is None:
            filled = self._bucketed(name, rows.select(*columns)).hint("rebalance", "bucket")
        else:
            versions = self._dealt(name, rows.select(*columns, *[c for c in order if c not in columns]))
            filled = latest_version(versions, ["bucket", "part", schemas.TABLES[name][1]], order).select(*columns, "bucket")
        table.replace(filled, mark)

    def table(self, name: str) -> DataFrame:
        rows, schema = self._table(name).read(), schemas.TABLES[name][0]
        return self.spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())

    def version(self, name: str) -> int:
        return self._table(name).pointer().seq

    def changes(self, name: str, as_of) -> DataFrame | None:
        """The stored change set of a day, with the rules that made each row; None if nothing changed."""
        return self._changes(name).read([f"as_of={_day(as_of)}"])

    def run(self, as_of, attempts: DataFrame, plan_changes: DataFrame) -> None:
        """Apply a day. A day before the last one applied is refused."""
        day = _day(as_of)
        if any((self._table(t).pointer().mark or 0) > day for t in TABLES):
            raise ValueError(f"a later day than {as_of} has been applied")
        todo = [t for t in TABLES if (self._changes(t).pointer().mark or 0) < day]
        if todo:
            found = billing.billing_day(*[self.table(t) for t in TABLES], attempts, plan_changes, as_of)
            for t in todo:
                self._changes(t).replace(getattr(found, t).withColumn("as_of", F.lit(day)), day)
        for t in TABLES:
            if (self._table(t).pointer().mark or 0) < day:
                self._merge(t, as_of, day)

    def _merge(self, name: str, as_of, day: int) -> None:
        table, changes, key = self._table(name), self.changes(name, as_of), schemas.TABLES[name][1]
        columns = [f.name for f in schemas.TABLES[name][0].fields]
        if changes is None:
            table.replace(self._bucketed(name, self.table(name).limit(0)), day)
            return
        new = self._bucketed(name, changes.select(*columns))
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]      # at most ``buckets`` of them
        old = table.read([f"bucket={b}" for b in touched])
        if old is None:
            table.replace(new.hint("rebalance", "bucket"), day)
            return
        # a row of the table stays where its key has no change; both meet in the one shuffle that also fills the buckets
        rows = old.select(*columns).withColumn("changed", F.lit(False)) \
            .unionByName(changes.select(*columns).withColumn("changed", F.lit(True)))
        replaced = F.max("changed").over(Window.partitionBy("bucket", "part", key))
        merged = self._dealt(name, rows).withColumn("replaced", replaced).filter(
            F.col("changed") | ~F.col("replaced") | F.col(key).isNull())
        table.replace(merged.select(*columns, "bucket"), day)
