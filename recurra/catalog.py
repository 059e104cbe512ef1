"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the billing tables from the driver tables (see
``recurra.fixtures``) and runs one operator or report over all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra import fixtures as fx
from recurra import schemas
from recurra.operators import billing, cdc
from recurra.operators import state as st
from recurra.operators.latest import latest_version
from recurra.plans import metrics, reconcile, serving
from recurra.session import checkpoint_root, tune
from recurra.sources import snapshot
from recurra.sources.staging import staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)
        run.__name__ = run.__qualname__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- metric views

@register("mrr_current")
def q_mrr_current(spark, sf):
    return metrics.mrr_current(fx.subscriptions_stream(spark, sf))


@register("mrr_active_arr")
def q_mrr_active_arr(spark, sf):
    return metrics.mrr_active_arr(metrics.mrr_current(fx.subscriptions_stream(spark, sf)))


@register("churn_monthly")
def q_churn_monthly(spark, sf):
    return metrics.churn_monthly(fx.subscriptions_stream(spark, sf))


@register("churn_rate")
def q_churn_rate(spark, sf):
    return metrics.churn_rate(metrics.churn_monthly(fx.subscriptions_stream(spark, sf)))


@register("plan_change_movement")
def q_plan_change_movement(spark, sf):
    return metrics.plan_change_movement(fx.plan_changes_stream(spark, sf))


@register("nrr_monthly")
def q_nrr_monthly(spark, sf):
    return metrics.nrr_monthly(fx.subscriptions_stream(spark, sf), fx.plan_changes_stream(spark, sf))


@register("mrr_waterfall")
def q_mrr_waterfall(spark, sf):
    return metrics.mrr_waterfall(fx.subscriptions_stream(spark, sf), fx.plan_changes_stream(spark, sf))


@register("failed_payment_rate")
def q_failed_payment_rate(spark, sf):
    return metrics.failed_payment_rate(fx.payment_attempts_stream(spark, sf))


@register("failed_payment_rate_corrected")
def q_failed_payment_rate_corrected(spark, sf):
    return metrics.failed_payment_rate(fx.payment_attempts_stream(spark, sf),
                                       metrics.CORRECTED_SUCCESS)


# ---------------------------------------------------------------- versions, reconciliation


RECONCILE_AS_OF = "2001-08-01"


@register("latest_subscription_version")
def q_latest_subscription_version(spark, sf):
    return latest_version(fx.subscriptions_stream(spark, sf), "subscription_id", reconcile.TIE_BREAK_ORDER)


@register("reconciliation_totals")
def q_reconciliation_totals(spark, sf):
    return reconcile.reconcile(fx.subscriptions_stream(spark, sf), fx.subscriptions_batch(spark, sf),
                               RECONCILE_AS_OF)


@register("reconciliation_status")
def q_reconciliation_status(spark, sf):
    return reconcile.reconciliation_status(fx.subscriptions_stream(spark, sf),
                                           fx.subscriptions_batch(spark, sf), RECONCILE_AS_OF)


@register("reconciliation_alert")
def q_reconciliation_alert(spark, sf):
    return reconcile.alert_text(q_reconciliation_status(spark, sf))


@register("reconciliation_iterations")
def q_reconciliation_iterations(spark, sf):
    return reconcile.iterations(fx.subscriptions_stream(spark, sf), fx.subscriptions_batch(spark, sf),
                                RECONCILE_AS_OF)


@register("snapshot_typed_subscriptions")
def q_snapshot_typed_subscriptions(spark, sf):
    lines = snapshot.dump_lines(fx.subscriptions_batch(spark, sf), "subscriptions", "\t", "NULL")
    return snapshot.parse_snapshot_lines(lines, "subscriptions", "\t", "NULL")


@register("snapshot_typed_invoices")
def q_snapshot_typed_invoices(spark, sf):
    current = latest_version(fx.invoices_stream(spark, sf), "invoice_id", ("updated_at", "cdc_ts_ms"))
    lines = snapshot.dump_lines(current, "invoices", "\t", "NULL")
    return snapshot.parse_snapshot_lines(lines, "invoices", "\t", "NULL")


# ---------------------------------------------------------------- CDC decoding



def _decoded(spark, sf, table=None):
    """Decoded CDC traffic; with ``table``, only that table's topic is read
    (one topic per table), so the other topics are never parsed."""
    return cdc.decode(fx.cdc_messages(spark, sf, (table,) if table else None))


@register("cdc_envelope")
def q_cdc_envelope(spark, sf):
    """Table, op and position read from both envelope shapes."""
    e = cdc.parse_envelope(fx.cdc_messages(spark, sf)).filter(~F.col("corrupt"))
    return e.groupBy("table", "op").agg(F.count(F.lit(1)).alias("n_messages"),
                                        F.sum("ts_ms").alias("sum_ts_ms"),
                                        F.count_if(F.col("has_after")).alias("n_with_after"))


def _normalised(table):
    def q(spark, sf):
        return cdc.normalise(_decoded(spark, sf, table).ok, table).drop("cdc_timestamp")
    return q


for _t in ["subscriptions", "invoices", "payment_attempts", "plan_changes", "merchants"]:
    register(f"cdc_normalise_{_t}")(_normalised(_t))


def _long(spark, sf, type_name):
    """Every column of one type, over all tables, as (table, id, cdc_ts_ms, column, value)."""
    out = None
    for t, (schema, key, _) in schemas.TABLES.items():
        cols = [f.name for f in schema.fields if f.dataType.typeName() == type_name]
        if not cols:
            continue
        rows = cdc.normalise(_decoded(spark, sf, t).ok, t)
        long = rows.unpivot([key, "cdc_ts_ms"], cols, "column_name", "value") \
            .select(F.lit(t).alias("source_table"), F.col(key).alias("entity_id"), "cdc_ts_ms",
                    "column_name", "value")
        out = long if out is None else out.unionByName(long)
    return out


@register("cdc_decode_date")
def q_cdc_decode_date(spark, sf):
    return _long(spark, sf, "date")


@register("cdc_decode_decimal")
def q_cdc_decode_decimal(spark, sf):
    return _long(spark, sf, "decimal")


@register("cdc_decode_boolean")
def q_cdc_decode_boolean(spark, sf):
    return _long(spark, sf, "boolean")


@register("cdc_decode_timestamp")
def q_cdc_decode_timestamp(spark, sf):
    return _long(spark, sf, "timestamp_ntz")


@register("cdc_dead_letter")
def q_cdc_dead_letter(spark, sf):
    dl = _decoded(spark, sf).dead_letter
    return dl.groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n_messages"))


@register("cdc_deletes")
def q_cdc_deletes(spark, sf):
    d = _decoded(spark, sf).deletes
    return d.select(F.col("table").alias("source_table"), "op",
                    cdc.entity_key(F.col("table"), F.col("before")).alias("entity_id"), "ts_ms")


@register("cdc_topic_route")
def q_cdc_topic_route(spark, sf):
    m = fx.cdc_messages(spark, sf)
    routed = cdc.route_topic(F.col("topic"), fx.CDC_PREFIX, fx.CDC_DB)
    return (m.select(routed.alias("topic"))
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"))
            .select("topic", cdc.topic_table(F.col("topic")).alias("source_table"), "n_messages"))


def _routed(spark, sf):
    return cdc.route(cdc.parse_envelope(fx.faulty_messages(spark, sf)))


@register("cdc_dead_letter_faulty")
def q_cdc_dead_letter_faulty(spark, sf):
    """Every reason for which a message of an erring producer is set aside."""
    return _routed(spark, sf).dead_letter.groupBy("table", "reason").agg(F.count(F.lit(1)).alias("n_messages"))


@register("cdc_log_faulty")
def q_cdc_log_faulty(spark, sf):
    """The attempts of an erring producer that the event log takes."""
    return _routed(spark, sf).logs["payment_attempts_stream"].drop("cdc_timestamp")


@register("merchant_state_faulty")
def q_merchant_state_faulty(spark, sf):
    """The state takes every change that names a merchant, also those that the log refuses."""
    envelope = cdc.parse_envelope(fx.faulty_messages(spark, sf))
    # read more than once below: parsed once, and written
    judged = staged(cdc.judge(envelope).filter("to_state"), f"{checkpoint_root(spark)}/staged")
    return st.merchant_state(*[cdc.route(envelope, judged).state[t] for t in cdc.STATE_TABLES])


# ---------------------------------------------------------------- merchant state, serving


LOOKUP_MERCHANT = "MCH-000042"


def _state(spark, sf):
    return st.merchant_state(fx.merchants(spark, sf), fx.subscriptions_stream(spark, sf),
                             fx.payment_attempts_stream(spark, sf))


@register("consecutive_failures")
def q_consecutive_failures(spark, sf):
    return st.consecutive_failures(fx.payment_attempts_stream(spark, sf))


@register("merchant_state")
def q_merchant_state(spark, sf):
    return _state(spark, sf)


@register("state_mrr_snapshot")
def q_state_mrr_snapshot(spark, sf):
    return serving.state_mrr_snapshot(_state(spark, sf))


@register("merchant_lookup")
def q_merchant_lookup(spark, sf):
    return serving.merchant_lookup(_state(spark, sf), LOOKUP_MERCHANT)


@register("last_invoices_per_merchant")
def q_last_invoices_per_merchant(spark, sf):
    return serving.last_invoices(serving.current_invoices(fx.invoices_stream(spark, sf)), 12)


# ---------------------------------------------------------------- billing jobs


BILLING_AS_OF = "2000-06-01"
RETRY_AS_OF = "2024-06-01"       # some of the recorded attempts are past, some are still to come
CDC_COLUMNS = ("cdc_operation", "cdc_timestamp", "cdc_ts_ms")


def _current_subs(spark, sf, as_of=BILLING_AS_OF):
    """Subscription table as of a day: the latest version of each written by then."""
    known = billing.known_at(fx.subscriptions_stream(spark, sf), as_of)
    return latest_version(known, "subscription_id", reconcile.TIE_BREAK_ORDER).drop(*CDC_COLUMNS)


def _current_invoices(spark, sf, as_of):
    return serving.current_invoices(billing.known_at(fx.invoices_stream(spark, sf), as_of)).drop(*CDC_COLUMNS)


@register("billing_due")
def q_billing_due(spark, sf):
    return billing.billing_due(_current_subs(spark, sf), BILLING_AS_OF)


@register("billing_run")
def q_billing_run(spark, sf):
    return billing.billing_run(_current_subs(spark, sf), BILLING_AS_OF).invoices


@register("billing_run_subscriptions")
def q_billing_run_subscriptions(spark, sf):
    return billing.billing_run(_current_subs(spark, sf), BILLING_AS_OF).subscriptions


@register("retry_candidates")
def q_retry_candidates(spark, sf):
    return billing.retry_candidates(_current_invoices(spark, sf, RETRY_AS_OF), RETRY_AS_OF)


def _retries(spark, sf):
    return billing.apply_retries(_current_invoices(spark, sf, RETRY_AS_OF), fx.payment_attempts_stream(spark, sf),
                                 _current_subs(spark, sf, RETRY_AS_OF), fx.merchants(spark, sf), RETRY_AS_OF)


@register("retry_apply_invoices")
def q_retry_apply_invoices(spark, sf):
    return _retries(spark, sf).invoices


@register("retry_apply_subscriptions")
def q_retry_apply_subscriptions(spark, sf):
    return _retries(spark, sf).subscriptions


@register("retry_apply_merchants")
def q_retry_apply_merchants(spark, sf):
    return _retries(spark, sf).merchants


@register("trial_expiry")
def q_trial_expiry(spark, sf):
    return billing.expire_trials(_current_subs(spark, sf), BILLING_AS_OF)


@register("scheduled_cancellation")
def q_scheduled_cancellation(spark, sf):
    return billing.cancel_scheduled(_current_subs(spark, sf), BILLING_AS_OF)


def _plan_changes(spark, sf):
    return billing.apply_plan_changes(_current_subs(spark, sf), fx.merchants(spark, sf),
                                      billing.known_at(fx.plan_changes_stream(spark, sf), BILLING_AS_OF))


@register("plan_change_apply")
def q_plan_change_apply(spark, sf):
    return _plan_changes(spark, sf).subscriptions


@register("plan_change_apply_merchants")
def q_plan_change_apply_merchants(spark, sf):
    return _plan_changes(spark, sf).merchants


_BOOKS: dict = {}


def _book(spark: SparkSession, sf: str):
    """The operational tables after one billing day with all of its rules; one book for the queries of a session."""
    from uuid import uuid4

    from recurra.plans.billing_book import BillingBook

    key = (spark.sparkContext.applicationId, id(spark), sf.rstrip("/"))
    if key not in _BOOKS:
        book = BillingBook(spark, f"{checkpoint_root(spark)}/books/{uuid4().hex}", buckets=8)
        book.load("subscriptions", _current_subs(spark, sf, RETRY_AS_OF))
        book.load("invoices", billing.known_at(fx.invoices_stream(spark, sf), RETRY_AS_OF), order=serving.INVOICE_ORDER)
        book.load("merchants", fx.merchants(spark, sf))
        book.run(RETRY_AS_OF, fx.payment_attempts_stream(spark, sf), fx.plan_changes_stream(spark, sf))
        _BOOKS[key] = book
    return _BOOKS[key]


def _applied(table):
    def q(spark, sf):
        return _book(spark, sf).table(table)
    q.__doc__ = f"B1-B6: {table} after the folded change set of a billing day, one row per key."
    return q


for _t in ["subscriptions", "invoices", "merchants"]:
    register(f"billing_apply_{_t}")(_applied(_t))


# ---------------------------------------------------------------- de-duplicated variants (one row per subscription)

@register("mrr_current_latest")
def q_mrr_current_latest(spark, sf):
    return metrics.mrr_current(fx.subscriptions_stream(spark, sf), latest_only=True)


@register("mrr_waterfall_latest")
def q_mrr_waterfall_latest(spark, sf):
    return metrics.mrr_waterfall(fx.subscriptions_stream(spark, sf), fx.plan_changes_stream(spark, sf),
                                 latest_only=True)


# ---------------------------------------------------------------- the streaming job, end to end

_STREAM_RUNS: dict = {}


def _streamed(spark: SparkSession, sf: str):
    """Run the streaming CDC job once (``availableNow``) over the traffic
    derived from the driver tables and return it; the run lives under the
    session's shared checkpoint folder. Batch and stream must agree, so the
    results are checked against the batch oracles."""
    from uuid import uuid4

    from recurra.sources.cdc_source import read_cdc_files, write_cdc_files
    from recurra.streaming.cdc_job import CdcJob

    key = (spark.sparkContext.applicationId, id(spark), sf.rstrip("/"))
    if key not in _STREAM_RUNS:
        run = uuid4().hex
        root = f"{checkpoint_root(spark)}/streamed/{run}"
        for table in fx.WIRE_FORMAT:        # topic by topic, so that only the shuffle of one is on disk
            write_cdc_files(fx.cdc_messages(spark, sf, (table,)), root + "/source")
        job = CdcJob(root + "/out", buckets=16)
        q = job.start(read_cdc_files(spark, root + "/source"), checkpoint=root + "/checkpoint",
                      trigger={"availableNow": True}, name=f"cdc_{run}")
        q.awaitTermination()
        _STREAM_RUNS[key] = job
    return _STREAM_RUNS[key]


@register("merchant_state_streamed")
def q_merchant_state_streamed(spark, sf):
    return _streamed(spark, sf).merchant_state(spark)


@register("merchant_lookup_stored")
def q_merchant_lookup_stored(spark, sf):
    """A10 on the state that the streaming job stores: one bucket is read."""
    return _streamed(spark, sf).merchant(spark, LOOKUP_MERCHANT)


@register("state_mrr_stored")
def q_state_mrr_stored(spark, sf):
    """A9 on the state that the streaming job stores."""
    return _streamed(spark, sf).state_mrr(spark)


@register("dead_letter_streamed")
def q_dead_letter_streamed(spark, sf):
    """The dead letters that the streaming job wrote."""
    dead = _streamed(spark, sf).side(spark, "dead_letter")
    return dead.groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n_messages"))


@register("deletes_streamed")
def q_deletes_streamed(spark, sf):
    """The deletes that the streaming job wrote."""
    return _streamed(spark, sf).side(spark, "deletes").select(
        F.col("table").alias("source_table"), "op", cdc.entity_key(F.col("table"), F.col("before")).alias("entity_id"), "ts_ms")


@register("mrr_current_streamed")
def q_mrr_current_streamed(spark, sf):
    return _streamed(spark, sf).view(spark, "mrr_current")


@register("churn_monthly_streamed")
def q_churn_monthly_streamed(spark, sf):
    return _streamed(spark, sf).view(spark, "churn_monthly")


@register("mrr_current_latest_stored")
def q_mrr_current_latest_stored(spark, sf):
    """The view of the latest versions, kept by signed deltas."""
    return _streamed(spark, sf).view(spark, "mrr_current_latest")


@register("churn_monthly_latest_stored")
def q_churn_monthly_latest_stored(spark, sf):
    return _streamed(spark, sf).view(spark, "churn_monthly_latest")


@register("failed_payment_rate_stored")
def q_failed_payment_rate_stored(spark, sf):
    """Rates as ratios of stored sums."""
    return _streamed(spark, sf).view(spark, "failed_payment_rate_corrected")


@register("last_invoices_stored")
def q_last_invoices_stored(spark, sf):
    """L2 for all merchants, from the rows that the streaming job keeps for each."""
    return _streamed(spark, sf).last_rows(spark, "invoices").select(
        "merchant_id", "rang", "invoice_id", "subscription_id", "montant_cad", "statut", "date_emission")


@register("merchant_invoices_stored")
def q_merchant_invoices_stored(spark, sf):
    """L2 for one merchant: one bucket is read."""
    return _streamed(spark, sf).merchant_invoices(spark, LOOKUP_MERCHANT)


@register("subscriptions_stream_streamed")
def q_subscriptions_stream_streamed(spark, sf):
    """The event log that the streaming job wrote, whole."""
    return _streamed(spark, sf).log(spark, "subscriptions_stream").drop("cdc_timestamp", "batch_id")


@register("merchant_invoices")
def q_merchant_invoices(spark, sf):
    """L2 for one merchant; the limit of 12 is the report."""
    return serving.merchant_invoices(serving.current_invoices(fx.invoices_stream(spark, sf)).drop(*CDC_COLUMNS),
                                     LOOKUP_MERCHANT)


@register("churn_monthly_latest")
def q_churn_monthly_latest(spark, sf):
    return metrics.churn_monthly(fx.subscriptions_stream(spark, sf), latest_only=True)


@register("nrr_monthly_latest")
def q_nrr_monthly_latest(spark, sf):
    return metrics.nrr_monthly(fx.subscriptions_stream(spark, sf), fx.plan_changes_stream(spark, sf),
                               latest_only=True)
