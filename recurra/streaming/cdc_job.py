"""The streaming CDC job.

One Structured Streaming query reads all topics; each micro-batch is decoded
once (into files below ``<out>/staging``, as long as it runs) and fanned out to
  * the event logs ``<out>/logs/<table>_stream`` plus ``dead_letter`` and
    ``deletes``, partitioned by ``batch_id`` and written with dynamic partition
    overwrite, so a replayed batch rewrites exactly its own rows (K1, T4);
  * the merchant state ``<out>/state`` (K2), a per-merchant mergeable record
    bucketed by ``pmod(xxhash64(merchant_id), buckets)``; only buckets touched
    by the batch are read, merged and written anew, as a version that a
    pointer then names (``streaming.versioned``);
  * per-batch partial aggregates of the materialized views (K6), whose
    re-aggregation equals the direct aggregate over the log; views of the latest
    versions by signed deltas against the current versions ``<out>/current-N``;
  * the last invoices of every merchant (L2) ``<out>/last-N``, in the merchant's
    bucket (both in ``streaming.views``).

Tables beside the state are versioned too. The current versions are marked with
the last batch merged into them: its deltas were written before, so a replay of
that batch or of an earlier one leaves both as they are. A view or last-rows
table has to be declared from the first batch on.

The state merge is commutative, associative and idempotent: each field group
keeps its value with its order key (max wins), and the failure counter keeps the
latest non-failed attempt key of a merchant and, as rows of their own, the
distinct failed attempts after it. So batches may arrive in any order, or twice,
with the same final state, and no row grows with a merchant's failures. The
failure rows lie in the merchant's bucket; they meet the reset keys by merchant
and salt of the attempt, so that a hot merchant's rows go to ``SALTS`` tasks.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from recurra import schemas
from recurra.operators import cdc
from recurra.operators import state as st
from recurra.operators.latest import latest_version
from recurra.functions.calendar import month_start, not_after_day
from recurra.plans import serving
from recurra.session import checkpoint_root
from recurra.sources.sinks import PACKED, shuffles_removed, side_by_side
from recurra.sources.staging import remove, staged
from recurra.streaming import views as sv
from recurra.streaming.versioned import VersionedTable

STATE_BUCKETS = 64
SPAN = 1000             # batches that a partition of a compacted side log holds
MERGE_ROWS = 2_000_000  # of a batch that are merged into the last rows at once, more only in a single bucket
UNTIMED = "__HIVE_DEFAULT_PARTITION__"
LAST_INVOICES = sv.LastRows("invoices_stream", "merchant_id", "invoice_id", "date_emission", serving.INVOICE_ORDER, 12)


# ------------------------------------------------------------------ state record

def _pair(value: str, src: list[str]) -> Column:
    ordv = F.when(F.col("src").isin(*src), F.col("ord"))
    return F.max_by(F.struct(F.col("ord").alias("ord"), F.col(value).alias("v")), ordv)


def _salt(attempt_id: str) -> Column:
    return F.pmod(F.xxhash64(attempt_id), F.lit(st.SALTS)).cast("int")


def _since_reset(fails: DataFrame, merchants: DataFrame) -> DataFrame:
    """The failure rows after their merchant's reset key, met by merchant and salt."""
    resets = merchants.filter(F.col("reset").isNotNull()).select(
        F.col("merchant_id").alias("of"), "reset", F.explode(F.sequence(F.lit(0), F.lit(st.SALTS - 1))).alias("of_salt"))
    fails = fails.withColumn("salt", _salt("fail.attempt_id"))
    met = (F.col("merchant_id") == F.col("of")) & (F.col("salt") == F.col("of_salt"))
    kept = fails.join(resets, met & (F.col("fail") <= F.col("reset")), "left_anti")
    return kept.drop("salt")


def _with_failures(merchants: DataFrame, fails: DataFrame) -> DataFrame:
    """Merchant rows and failure rows as one relation; ``fail`` is null in the former, all else in the latter."""
    return (merchants.withColumn("fail", F.lit(None).cast(fails.schema["fail"].dataType))
            .unionByName(fails, allowMissingColumns=True))


def state_partials(events: DataFrame, buckets: int = STATE_BUCKETS) -> DataFrame:
    """Mergeable records of a set of events: one row per merchant, and one per failed attempt of its current run."""
    key = F.struct(F.col("att.created_at").alias("created_at"), F.col("ord.key").alias("attempt_id"))
    is_att = F.col("src") == "payment_attempts"
    failed = is_att & (F.col("att.statut") == "failed")
    not_failed = is_att & ~F.col("att.statut").eqNullSafe("failed")
    ev = events.withColumn("_k", key)
    merchants = ev.groupBy("merchant_id").agg(
        _pair("sub", ["subscriptions"]).alias("sub_p"),
        _pair("mer", ["merchants"]).alias("mer_p"),
        _pair("att", ["payment_attempts"]).alias("att_p"),
        _pair("plan", ["merchants", "subscriptions"]).alias("plan_p"),
        F.max("ts").alias("updated_at"),
        F.max(F.when(not_failed, F.col("_k"))).alias("reset"))
    # failed attempts after this batch's own reset point only (the current run)
    fails = _since_reset(ev.filter(failed).select("merchant_id", F.col("_k").alias("fail")).distinct(), merchants)
    return (_with_failures(merchants, fails)
            .withColumn("bucket", F.pmod(F.xxhash64("merchant_id"), F.lit(buckets)).cast("int")))


def merge_partials(records: DataFrame) -> DataFrame:
    """Merge records of the same merchant (any order, duplicates allowed)."""
    def best(c: str) -> Column:
        return F.max_by(F.col(c), F.col(c + ".ord"))
    merchants = records.filter(F.col("fail").isNull()).groupBy("merchant_id", "bucket").agg(
        best("sub_p").alias("sub_p"), best("mer_p").alias("mer_p"), best("att_p").alias("att_p"),
        best("plan_p").alias("plan_p"), F.max("updated_at").alias("updated_at"), F.max("reset").alias("reset"))
    fails = records.filter(F.col("fail").isNotNull()).select("merchant_id", "bucket", "fail").distinct()
    return _with_failures(merchants, _since_reset(fails, merchants)).select(*records.columns)


def state_view(records: DataFrame, failures: bool = True) -> DataFrame:
    """Stored records -> MERCHANT_STATE rows; without ``failures`` these are not read, and their counter is not counted."""
    merchants = records.filter(F.col("fail").isNull())
    fields = merchants.select("merchant_id", F.col("sub_p.v").alias("sub"), F.col("mer_p.v").alias("mer"),
                              F.col("att_p.v").alias("att"), F.struct(F.col("plan_p.v").alias("plan")).alias("plan_v"),
                              "updated_at")
    run = (records.filter(F.col("fail").isNotNull()).groupBy("merchant_id", _salt("fail.attempt_id").alias("salt"))
           .agg(F.count_distinct("fail.attempt_id").alias("n")).groupBy("merchant_id").agg(F.sum("n").alias("n")))
    fails = (merchants.filter(F.col("att_p").isNotNull()).select("merchant_id").join(run, "merchant_id", "left")
             .select("merchant_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("nb_echecs_paiement_consecutifs")))
    if not failures:
        fails = fails.filter(F.lit(False))      # an empty side, and the join with it, leave the plan
    return st.assemble(fields, fails).select(*[f.name for f in schemas.MERCHANT_STATE.fields])


# ------------------------------------------------------------------ micro-batch writer

@dataclass
class CdcJob:
    out: str
    buckets: int = STATE_BUCKETS
    # T4: delivery is at-least-once; with dedupe, byte-identical redeliveries
    # inside a micro-batch are dropped before decoding (the reference's logs
    # keep them, so it is off by default). Replays of a whole batch are
    # already exact through the batch_id overwrite.
    dedupe: bool = False
    # Also drop messages that one of so many batches before had: their digests
    # are kept per batch, and removed when no batch to come looks at them.
    dedupe_batches: int = 0
    views: dict[str, sv.StoredView] = field(default_factory=sv.stored_views)
    last: dict[str, sv.LastRows] = field(default_factory=lambda: {"invoices": LAST_INVOICES})

    def __post_init__(self):
        followed = {(v.table, v.latest) for v in self.views.values() if v.latest}
        if len(followed) > len({t for t, _ in followed}):
            raise ValueError("views of one log have to agree on its latest version")

    def path(self, *parts: str) -> str:
        return "/".join([self.out.rstrip("/"), *parts])

    def _write_batch_partition(self, df: DataFrame, path: str, batch_id: int) -> None:
        spark = df.sparkSession
        with side_by_side(spark, 2), shuffles_removed(spark):       # the rows are not sorted by their one batch_id
            (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("compression", PACKED)
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.dedupe or self.dedupe_batches:
            batch = batch.dropDuplicates([c for c in batch.columns if c in ("topic", "value")])
        if self.dedupe_batches:
            batch = self._first_seen(batch, batch_id)
        remove(spark, self.path("staging"))              # left by a crash
        try:
            envelope = cdc.parse_envelope(batch)
            routed = cdc.route(envelope, self._staged(cdc.judge(envelope), "judged"))    # each message is parsed once
            events = st.state_events(*[routed.state[t] for t in cdc.STATE_TABLES])
            state = self._staged(state_partials(events, self.buckets), "state")
            for name, rows in routed.logs.items():
                self._write_batch_partition(rows, self.path("logs", name), batch_id)
            self._write_batch_partition(routed.dead_letter, self.path("dead_letter"), batch_id)
            self._write_batch_partition(routed.deletes, self.path("deletes"), batch_id)
            self._unstaged(spark, "judged")                  # before the merges, which shuffle
            # the rows just written: their plan is a scan, not the whole decoding
            wanted = {v.table for v in (*self.views.values(), *self.last.values())}
            written = {t: self._written(spark, t, batch_id) for t in wanted}
            for name, view in self.views.items():
                if not view.latest:
                    self._write_batch_partition(view.partials(written[view.table]), self.path("partials", name), batch_id)
            for table, latest in {v.table: v.latest for v in self.views.values() if v.latest}.items():
                self._follow(spark, written[table], table, latest, batch_id)
            for name, last in self.last.items():
                self._merge_last(spark, written[last.table], name, last)
            self._merge_partials(spark, state)
        finally:
            remove(spark, self.path("staging"))

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """A table that a batch reads more than once, in files: executors hold none of it, however long the batch."""
        return staged(df, self.path("staging", name))

    def _unstaged(self, spark: SparkSession, name: str) -> None:
        """Remove a staged table that nothing reads any more."""
        remove(spark, self.path("staging", name))

    def _written(self, spark: SparkSession, table: str, batch_id: int) -> DataFrame:
        """The log rows of a batch, as written; none where it has no folder."""
        folder = self.path("logs", table, f"batch_id={batch_id}")
        schema = StructType([f for f in self._log_schema(table).fields if f.name not in ("cdc_timestamp", "batch_id")])
        there = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(folder)

    def _first_seen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The messages that none of the ``dedupe_batches`` batches before had (T4).

        A batch looks at earlier batches only and writes its digests as a
        partition of its own, so a replay drops what the first run dropped.
        """
        spark, path = batch.sparkSession, self.path("seen")
        digest = F.unhex(F.sha2(F.concat_ws("\n", F.coalesce("topic", F.lit("")), F.col("value").isNull().cast("string"),
                                            F.coalesce("value", F.lit(""))), 256))
        first = batch_id - self.dedupe_batches
        keyed = batch.withColumn("_message", digest)
        self._write_batch_partition(keyed.select("_message"), path, batch_id)
        seen = spark.read.schema("_message binary, batch_id int").parquet(path)
        _remove_batches(spark, path, first - 1)
        earlier = seen.filter((F.col("batch_id") >= first) & (F.col("batch_id") < batch_id)).select("_message")
        return keyed.join(earlier, "_message", "left_anti").drop("_message")

    def _state(self, spark: SparkSession) -> VersionedTable:
        state = VersionedTable(spark, self.path("state"), self.path("pointers", "state"), "bucket")
        stored = state.pointer().mark
        if stored not in (None, self.buckets):
            raise ValueError(f"{self.path('state')} has {stored} buckets, not {self.buckets}")
        return state

    def _compacted(self, spark: SparkSession, table: str) -> VersionedTable:
        return VersionedTable(spark, self.path("compacted", table), self.path("pointers", table), "mois")

    def _merge_state(self, spark: SparkSession, events: DataFrame) -> None:
        self._merge_partials(spark, self._staged(state_partials(events, self.buckets), "state"))

    def _merge_partials(self, spark: SparkSession, new: DataFrame) -> None:
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # <= buckets ints
        if not touched:
            return
        state = self._state(spark)
        old = state.read([f"bucket={b}" for b in touched])
        parts = [new] if old is None else [new, old.select(*new.columns)]
        # merged buckets are a new version, and the old one stays until a
        # pointer names the new: a crash in between is repaired by the
        # replay, as the merge is idempotent
        state.replace(merge_partials(_union(parts)).hint("rebalance", "bucket"), self.buckets)

    # ---------------------------------------------------------------- views of latest versions, last rows

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _bucketed(self, spark: SparkSession, kind: str, name: str) -> VersionedTable:
        folder = f"{kind}-{self.buckets}"
        return VersionedTable(spark, self.path(folder, name), self.path("pointers", folder, name), "bucket")

    @staticmethod
    def _touched(rows: DataFrame) -> list[str]:
        return [f"bucket={r.bucket}" for r in rows.select("bucket").distinct().collect()]      # <= buckets ints

    def _follow(self, spark: SparkSession, batch: DataFrame, table: str, latest: sv.Latest, batch_id: int) -> None:
        """Merge a batch into the current versions of a log, and write its signed partials of the latest views."""
        current = self._bucketed(spark, "current", table)
        mark = current.pointer().mark
        if mark is not None and mark >= batch_id:
            return                                  # a replay: the deltas were written before the mark
        batch = batch.withColumn("bucket", self._bucket(latest.key))
        touched = self._touched(batch)
        if not touched:
            return
        versions = self._staged(sv.replaced(batch, current.read(touched), latest), "versions")
        delta = sv.signed(versions)
        for name, view in self.views.items():
            if view.latest and view.table == table:
                self._write_batch_partition(view.partials(delta), self.path("partials", name), batch_id)
        current.replace(versions.select("now.*").hint("rebalance", "bucket"), batch_id)
        self._unstaged(spark, "versions")

    def _merge_last(self, spark: SparkSession, batch: DataFrame, name: str, last: sv.LastRows) -> None:
        """Merge a batch into the last rows, some buckets after the other: the merge shuffles whole rows more than
        once, so that a large batch would have its size on disk as often. A replay after a crash merges all again."""
        batch, bucket = batch.filter(F.col(last.owner).isNotNull()), self._bucket(last.owner)
        sizes = batch.groupBy(bucket.alias("bucket")).count().collect()     # <= buckets pairs
        stored = self._bucketed(spark, "last", name)
        for some in _in_slices({r["bucket"]: r["count"] for r in sizes}, MERGE_ROWS):
            rows = batch if len(some) == len(sizes) else batch.filter(bucket.isin(some))
            old = stored.read([f"bucket={b}" for b in some])
            parts = [rows] if old is None else [rows, old.select(*batch.columns)]
            stored.replace(last.merge(parts).withColumn("bucket", bucket).hint("rebalance", "bucket"))

    def start(self, source: DataFrame, checkpoint: str | None = None, trigger: dict | None = None,
              name: str = "cdc_job") -> StreamingQuery:
        spark = source.sparkSession
        ckpt = checkpoint or (checkpoint_root(spark) + "/streams/" + name)
        writer = source.writeStream.foreachBatch(self.process).option("checkpointLocation", ckpt) \
            .queryName(name)
        writer = writer.trigger(**(trigger or {"processingTime": "15 minutes"}))
        return writer.start()

    # ---------------------------------------------------------------- compaction

    @staticmethod
    def _log_schema(table: str):
        source = {v: k for k, v in schemas.LOG_TABLES.items()}[table]
        return StructType(schemas.log_schema(source).fields + [StructField("batch_id", IntegerType(), True)])

    def _read_log(self, spark: SparkSession, table: str) -> DataFrame:
        """Per-batch log with its declared schema (an empty folder is an empty log)."""
        return spark.read.schema(self._log_schema(table)).parquet(self.path("logs", table))

    def _compacted_through(self, spark: SparkSession, table: str) -> int:
        mark = self._compacted(spark, table).pointer().mark
        return -1 if mark is None else mark

    def compact(self, spark: SparkSession, table: str, through_batch: int) -> None:
        """Rewrite the closed micro-batches (``batch_id <= through_batch``) of a
        log into month partitions, then drop their per-batch directories.

        Idempotent and crash-safe: a month is rebuilt from its compacted rows
        and the newer batches, as a new version. Months and watermark change
        together, with the pointer that names the versions, before any batch
        directory is removed; readers only take batches above the watermark
        from the per-batch log. Rows without a time are a month of their own.
        """
        done = self._compacted_through(spark, table)
        if through_batch <= done:
            _remove_batches(spark, self.path("logs", table), done)     # left by a crash
            return
        ts = _log_time(table)
        fresh = (self._read_log(spark, table)
                 .filter((F.col("batch_id") > done) & (F.col("batch_id") <= through_batch))
                 .withColumn("mois", month_start(ts)))
        months = [r.mois for r in fresh.select("mois").distinct().collect()]   # calendar-bounded
        comp = self._compacted(spark, table)
        old = comp.read([f"mois={UNTIMED if m is None else m}" for m in months])
        parts = [fresh] if old is None else [fresh, old.withColumn("mois", F.col("mois").cast("date")).select(*fresh.columns)]
        # rows of a month lie by key, so that a read of some keys skips row groups
        rows = _union(parts).hint("rebalance", "mois").sortWithinPartitions("mois", _log_key(table))
        comp.replace(rows, through_batch)
        _remove_batches(spark, self.path("logs", table), through_batch)

    def _side(self, spark: SparkSession, name: str) -> VersionedTable:
        return VersionedTable(spark, self.path("compacted", name), self.path("pointers", name), "span")

    def _fresh_side(self, spark: SparkSession, name: str, after: int) -> DataFrame | None:
        path = self.path(*name.split("/"))
        if not _batches(spark, path):
            return None
        return spark.read.parquet(path).filter(F.col("batch_id") > after)

    def side_logs(self) -> list[str]:
        return ["dead_letter", "deletes", *[f"partials/{v}" for v in self.views]]

    def compact_side(self, spark: SparkSession, name: str, through_batch: int) -> None:
        """Rewrite the closed batches of a side log, or of a view's partials, into partitions of ``SPAN`` batches.

        As ``compact``: new partitions and watermark change together, and only then are
        batch folders removed. Partials of a key are merged, so that a view stays as large as
        its keys; other rows are kept as they are.
        """
        side = self._side(spark, name)
        mark = side.pointer().mark
        done, path = -1 if mark is None else mark, self.path(*name.split("/"))
        fresh = self._fresh_side(spark, name, done) if through_batch > done else None
        if fresh is not None:
            fresh = fresh.filter(F.col("batch_id") <= through_batch).withColumn(
                "span", F.floor(F.col("batch_id") / SPAN).cast("int"))
            spans = [f"span={s}" for s in range(max(done, 0) // SPAN, through_batch // SPAN + 1)]
            old = side.read(spans)
            rows = fresh if old is None else fresh.unionByName(old.select(*fresh.columns))
            if name.startswith("partials/"):
                batch = F.least(F.col("span") * SPAN + SPAN - 1, F.lit(through_batch)).cast("int").alias("batch_id")
                merged = self.views[name.split("/", 1)[1]].merge(rows, "span")
                rows = merged.select(*[c for c in rows.columns if c not in ("span", "batch_id")], batch, "span")
            side.replace(rows.hint("rebalance", "span"), through_batch)
        mark = side.pointer().mark
        _remove_batches(spark, path, -1 if mark is None else mark)

    # ---------------------------------------------------------------- readers

    def side(self, spark: SparkSession, name: str) -> DataFrame | None:
        """A side log or the partials of a view: compacted spans plus the batches since; None where nothing was written."""
        side = self._side(spark, name)
        mark = side.pointer().mark
        fresh, old = self._fresh_side(spark, name, -1 if mark is None else mark), side.read()
        if fresh is None or old is None:
            return fresh if old is None else old.drop("span")
        return fresh.unionByName(old.select(*fresh.columns))

    def log(self, spark: SparkSession, table: str, until: dt.date | str | None = None) -> DataFrame:
        """The event log: compacted months plus the batches written since.

        With ``until``, the rows timed on that day or before: later months and the
        rows without a time, a month of their own, are not read.
        """
        done = self._compacted_through(spark, table)
        fresh = self._read_log(spark, table).filter(F.col("batch_id") > done)
        comp, months = self._compacted(spark, table), None
        if until is not None:
            last = str(until)[:7]
            held = [p for p in comp.pointer().versions if not p.endswith(UNTIMED)]
            months = [p for p in held if p.removeprefix("mois=")[:7] <= last]
        compacted = comp.read(months)
        rows = fresh if compacted is None else fresh.unionByName(compacted.select(*fresh.columns))
        return rows if until is None else rows.filter(not_after_day(_log_time(table), until))

    def merchant_state(self, spark: SparkSession) -> DataFrame:
        records = self._state(spark).read()
        if records is None:
            return spark.createDataFrame([], schemas.MERCHANT_STATE)
        return state_view(records)

    def merchant(self, spark: SparkSession, merchant_id: str) -> DataFrame:
        """A10: the stored row of one merchant, read from its bucket alone; empty when unknown."""
        bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(merchant_id)), F.lit(self.buckets))).first()[0]
        records = self._state(spark).read([f"bucket={bucket}"])
        if records is None:
            return spark.createDataFrame([], schemas.MERCHANT_STATE)
        return state_view(records.filter(F.col("merchant_id") == merchant_id))

    def state_mrr(self, spark: SparkSession) -> DataFrame:
        """A9 from the stored state; the failure rows, not asked for, are neither counted nor joined."""
        records = self._state(spark).read()
        state = spark.createDataFrame([], schemas.MERCHANT_STATE) if records is None else \
            state_view(records, failures=False)
        return serving.state_mrr_snapshot(state)

    def view(self, spark: SparkSession, name: str) -> DataFrame:
        """K6: the materialized view as the merge of its partials."""
        view, partials = self.views[name], self.side(spark, f"partials/{name}")
        if partials is None:
            log = spark.createDataFrame([], self._log_schema(view.table))
            partials = view.partials(log.withColumn("sign", F.lit(1)))
        return view.finish(partials)

    def _log_owners(self, spark: SparkSession, last: sv.LastRows, owners: DataFrame) -> DataFrame:
        """Current rows of some owners, from the log: their rows' keys first, as a version may name another owner."""
        log = self.log(spark, last.table)
        named = log.join(owners.select(last.owner), last.owner, "left_semi").select(last.key).distinct()
        current = latest_version(log.join(named, last.key, "left_semi"), last.key, list(last.order))
        return current.join(owners.select(last.owner), last.owner, "left_semi")

    def last_rows(self, spark: SparkSession, name: str, owner: str | None = None) -> DataFrame:
        """L2: the first rows of every owner, or of one (whose bucket alone is read), numbered by ``rang``.

        Owners whose rows changed rank are read from the log; where there are none, the log is not read.
        """
        last = self.last[name]
        part = None
        if owner is not None:
            bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(owner)), F.lit(self.buckets))).first()[0]
            part = [f"bucket={bucket}"]
        schema = self._log_schema(last.table)
        columns = [c for c in schema.names if c not in ("cdc_timestamp", "batch_id")]
        stored = self._bucketed(spark, "last", name).read(part)
        if stored is None:
            return last.first(spark.createDataFrame([], schema).select(*columns))
        if owner is not None:
            stored = stored.filter(F.col(last.owner) == owner)
        noted = stored.filter(F.col(last.key).isNull()).select(last.owner)
        rows = stored.filter(F.col(last.key).isNotNull()).select(*columns)
        if not noted.isEmpty():
            rows = rows.join(noted, last.owner, "left_anti").select(*columns).unionByName(
                self._log_owners(spark, last, noted).select(*columns))
        return last.first(rows)

    def merchant_invoices(self, spark: SparkSession, merchant_id: str) -> DataFrame:
        """The last invoices of one merchant, from its bucket."""
        rows = self.last_rows(spark, "invoices", merchant_id)
        return rows.select(*[f.name for f in schemas.INVOICES.fields])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _in_slices(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Buckets by their rows, in slices of at most so many rows; a larger bucket is a slice of its own."""
    out, held = [], 0
    for b, n in sorted(sizes.items()):
        if not out or held + n > most:
            out, held = [*out, []], 0
        out[-1].append(b)
        held += n
    return out


def _log_time(table: str) -> str:
    return "created_at" if table == "payment_attempts_stream" else "updated_at"


def _log_key(table: str) -> str:
    return next(schemas.TABLES[t][1] for t, log in schemas.LOG_TABLES.items() if log == table)


def _batches(spark: SparkSession, path: str) -> list:
    """The ``batch_id=N`` directories of a folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("batch_id=")]


def _remove_batches(spark: SparkSession, path: str, through_batch: int) -> None:
    """Delete ``batch_id=N`` directories with N <= through_batch (already compacted)."""
    for folder in _batches(spark, path):
        if int(folder.getName().split("=", 1)[1]) <= through_batch:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
