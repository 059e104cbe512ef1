"""Streaming-vs-batch MRR reconciliation.

Everything up to the log row is one lazy plan: both sides are filtered on
the day bound at the scan, the streaming side is reduced to the current
version of each subscription by a partial aggregate (shuffle by
subscription_id), and the batch side joins on that partitioning.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions.calendar import not_after_day
from recurra.functions.numeric import relative_gap, threshold_status
from recurra.functions.text import money_text, percent_text
from recurra.operators import cdc

SUM_TYPE = "decimal(20,2)"
THRESHOLD = 0.001

# Version orders. The reference order is (updated_at DESC, amount DESC); the
# CDC position is appended so ties are resolved the same way on every run.
TIE_BREAK_ORDER = ("updated_at", "montant_mensuel_cad", "cdc_ts_ms")
ARRIVAL_ORDER = ("updated_at", "cdc_ts_ms")


def _day(as_of) -> dt.date:
    return dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def _latest(stream: DataFrame, as_of, order) -> DataFrame:
    """Current (statut, amount) of every subscription, date bound applied
    before the dedup, ``active`` test after it."""
    ordering = F.struct(*[F.col(c) for c in order])
    value = F.struct(F.col("statut"), F.col("montant_mensuel_cad"))
    return (stream.filter(not_after_day(F.col("updated_at"), _day(as_of)))
            .groupBy("subscription_id").agg(F.max_by(value, ordering).alias("v"))
            .select("subscription_id", F.col("v.statut").alias("statut"),
                    F.col("v.montant_mensuel_cad").alias("amount")))


def _batch_active(batch: DataFrame, as_of) -> DataFrame:
    return (batch.filter((F.col("statut") == "active") & not_after_day(F.col("updated_at"), _day(as_of)))
            .select("subscription_id", F.col("montant_mensuel_cad").alias("amount_batch")))


def _zero_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast(SUM_TYPE)


def reconcile(stream: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """One row (mrr_streaming, mrr_batch, common_subs) over the
    subscriptions active on both sides."""
    s = _latest(stream, as_of, TIE_BREAK_ORDER).filter(F.col("statut") == "active")
    j = s.join(_batch_active(batch, as_of), "subscription_id", "inner")
    return j.agg(_zero_sum(F.col("amount")).alias("mrr_streaming"),
                 _zero_sum(F.col("amount_batch")).alias("mrr_batch"),
                 F.count(F.lit(1)).alias("common_subs"))


def status_row(totals: DataFrame, as_of, threshold: float = THRESHOLD) -> DataFrame:
    """R2: the reconciliation-log row without its wall-clock stamp: date,
    both totals, ecart_pct, status. No row when the batch MRR is 0."""
    gap = relative_gap(F.col("mrr_streaming"), F.col("mrr_batch"))
    return (totals.filter(F.col("mrr_batch") != 0)
            .select(F.lit(_day(as_of)).alias("date"),
                    F.col("mrr_streaming").alias("mrr_streaming_cad"),
                    F.col("mrr_batch").alias("mrr_batch_cad"),
                    gap.alias("ecart_pct"),
                    threshold_status(gap, threshold).alias("status")))


def reconciliation_status(stream: DataFrame, batch: DataFrame, as_of,
                          threshold: float = THRESHOLD) -> DataFrame:
    return status_row(reconcile(stream, batch, as_of), as_of, threshold)


def log_row(status: DataFrame) -> DataFrame:
    """Row for the append-only reconciliation log (K4): adds checked_at."""
    return status.withColumn("checked_at", cdc.processing_time())


# The alert texts of the reconciliation job, word for word.
ALERT_KO = ":x: Reconciliation KO — {date} | Streaming: {streaming} CAD | Batch: {batch} CAD | Ecart: {gap}"
ALERT_OK = ":white_check_mark: Reconciliation OK — {date} | MRR: {streaming} CAD | Ecart: {gap}"


def _fill(template: str, **values: Column) -> Column:
    """Build ``template`` as a column: literal text between ``{name}`` slots."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p or i % 2])


def alert_text(status: DataFrame) -> DataFrame:
    """The alert message for each status row, as a column."""
    values = dict(date=F.col("date").cast("string"),
                  streaming=money_text(F.col("mrr_streaming_cad")),
                  batch=money_text(F.col("mrr_batch_cad")),
                  gap=percent_text(F.col("ecart_pct")))
    return status.select("date", "status",
                         F.when(F.col("status") == "KO", _fill(ALERT_KO, **values))
                         .otherwise(_fill(ALERT_OK, **values)).alias("message"))


def iterations(stream: DataFrame, batch: DataFrame, as_of, threshold: float = THRESHOLD) -> DataFrame:
    """The documented iterations of the reconciliation in one pass.

    1 raw      sum of every active log row (no dedup) vs all batch actives
    2 dedup    current version by (updated_at, arrival) vs all batch actives
    3 join     as 2, restricted to subscriptions present on both sides
    4 tiebreak current version by (updated_at, amount, arrival), both sides (= R1)

    One scan of each table: the log is reduced per subscription (both version
    orders and the raw active sum in the same aggregate), full-outer joined
    with the batch actives, and summed once; ``inline`` turns the single
    total row into one row per iteration.
    """
    day = _day(as_of)
    amount, statut = F.col("montant_mensuel_cad"), F.col("statut")
    value = F.struct(statut, amount)
    per_sub = (stream.filter(not_after_day(F.col("updated_at"), day))
               .groupBy("subscription_id")
               .agg(F.sum(F.when(statut == "active", amount)).alias("raw"),
                    F.max_by(value, F.struct(*[F.col(c) for c in ARRIVAL_ORDER])).alias("v_plain"),
                    F.max_by(value, F.struct(*[F.col(c) for c in TIE_BREAK_ORDER])).alias("v_tb")))
    j = per_sub.join(_batch_active(batch, day), "subscription_id", "full_outer")
    b = F.col("amount_batch")
    matched = b.isNotNull() & F.col("v_plain").isNotNull()
    plain_active = F.col("v_plain.statut") == "active"
    tb_active = F.col("v_tb.statut") == "active"
    t = j.agg(
        _zero_sum(F.col("raw")).alias("s1"), _zero_sum(b).alias("b_all"),
        _zero_sum(F.when(plain_active, F.col("v_plain.montant_mensuel_cad"))).alias("s2"),
        _zero_sum(F.when(plain_active & matched, F.col("v_plain.montant_mensuel_cad"))).alias("s3"),
        _zero_sum(F.when(plain_active & matched, b)).alias("b3"),
        F.count_if(plain_active & matched).alias("n3"),
        _zero_sum(F.when(tb_active & matched, F.col("v_tb.montant_mensuel_cad"))).alias("s4"),
        _zero_sum(F.when(tb_active & matched, b)).alias("b4"),
        F.count_if(tb_active & matched).alias("n4"))

    def it(n, label, s, bb, common):
        return F.struct(F.lit(n).alias("iteration"), F.lit(label).alias("variant"),
                        F.col(s).alias("mrr_streaming_cad"), F.col(bb).alias("mrr_batch_cad"),
                        (F.col(common) if common else F.lit(None).cast("bigint")).alias("common_subs"))
    rows = t.select(F.inline(F.array(it(1, "raw", "s1", "b_all", None), it(2, "dedup", "s2", "b_all", None),
                                     it(3, "dedup_join", "s3", "b3", "n3"),
                                     it(4, "dedup_join_tiebreak", "s4", "b4", "n4"))))
    gap = relative_gap(F.col("mrr_streaming_cad"), F.col("mrr_batch_cad"))
    return (rows.filter(F.col("mrr_batch_cad") != 0)
            .select("iteration", "variant", "mrr_streaming_cad", "mrr_batch_cad", "common_subs",
                    gap.alias("ecart_pct"), threshold_status(gap, threshold).alias("status")))
