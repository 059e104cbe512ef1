"""Reads the serving layer answers (A9, A10, L2), as DataFrames over the
state table and the invoice log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.operators.latest import latest_version

INVOICE_ORDER = ("updated_at", "cdc_ts_ms")


def merchant_lookup(state: DataFrame, merchant_id: str) -> DataFrame:
    """A10: the state row of one merchant; empty when unknown (the 404).
    The key predicate is pushed below the state aggregate by Catalyst, so only
    that merchant's events are aggregated."""
    return state.filter(F.col("merchant_id") == F.lit(merchant_id))


def state_mrr_snapshot(state: DataFrame) -> DataFrame:
    """MRR and number of merchants whose subscription is active."""
    active = state.filter(F.col("statut_abonnement") == "active")
    return active.agg(F.coalesce(F.sum("montant_mensuel_cad"), F.lit(0)).cast("decimal(20,2)").alias("mrr_cad"),
                      F.count(F.lit(1)).alias("active_merchants"))


def current_invoices(invoices_log: DataFrame) -> DataFrame:
    """Current version of every invoice from its change log (the reference
    reads an invoice store no job writes)."""
    order = [c for c in INVOICE_ORDER if c in invoices_log.columns]
    return latest_version(invoices_log, "invoice_id", order)


def last_invoices(invoices: DataFrame, n: int = 12) -> DataFrame:
    """L2, all merchants: the ``n`` latest invoices of each merchant by
    emission date (then invoice id). The row_number filter becomes a
    WindowGroupLimit, which keeps at most ``n`` rows per merchant per task
    before the shuffle, so a merchant with a huge history does not move it."""
    w = Window.partitionBy("merchant_id").orderBy(F.col("date_emission").desc(), F.col("invoice_id").desc())
    return (invoices.withColumn("rang", F.row_number().over(w)).filter(F.col("rang") <= n)
            .select("merchant_id", "rang", "invoice_id", "subscription_id", "montant_cad", "statut",
                    "date_emission"))


def merchant_invoices(invoices: DataFrame, merchant_id: str, n: int = 12) -> DataFrame:
    """L2, one merchant: the serving read (filter, order, limit)."""
    return (invoices.filter(F.col("merchant_id") == F.lit(merchant_id))
            .orderBy(F.col("date_emission").desc(), F.col("invoice_id").desc()).limit(n))
