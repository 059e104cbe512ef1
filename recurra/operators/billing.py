"""Billing-table transitions (B1-B6) as set-based jobs.

The reference applies these rules with throttled row-at-a-time SQL against
the operational database (a few rows per timer tick). Here each rule is one
DataFrame job over the current tables and a parameter ``as_of`` (the job's
"now"); it returns the rows it changes, to be merged by the caller. Random
outcomes of the simulator are inputs (recorded payment attempts), never drawn.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra import schemas

MAX_ATTEMPTS = 3          # dunning stops, and the merchant churns, at the 3rd failure
RETRY_AFTER_DAYS = 3      # a failed invoice is retried once untouched for 3 days


def _now(as_of) -> tuple[Column, Column]:
    """(timestamp_ntz literal, date literal) for ``as_of`` (date or datetime or ISO text)."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    return F.lit(as_of).cast("timestamp_ntz"), F.lit(as_of.date())


def known_at(log: DataFrame, as_of, column: str = "updated_at") -> DataFrame:
    """The rows of a log written by ``as_of``: a rule knows nothing later. Take
    the current version of each key from these."""
    return log.filter(F.col(column) <= _now(as_of)[0])


def _cols(table: str) -> list[str]:
    return [f.name for f in schemas.TABLES[table][0].fields]


# ------------------------------------------------------------------ B1

def billing_due(subs: DataFrame, as_of) -> DataFrame:
    """Active subscriptions whose next payment date is due, with the date the
    next cycle moves to (+1 month, clamped to the month end)."""
    _, today = _now(as_of)
    due = subs.filter((F.col("statut") == "active") & (F.col("date_prochain_paiement") <= today))
    return (due
            .select("subscription_id", "merchant_id", "montant_mensuel_cad", "date_prochain_paiement",
                    F.add_months("date_prochain_paiement", 1).alias("date_prochain_paiement_suivante")))


class BillingRun(NamedTuple):
    invoices: DataFrame
    subscriptions: DataFrame


def billing_run(subs: DataFrame, as_of, outcome: str | None = None) -> BillingRun:
    """New invoices for the due subscriptions and their advanced next date.

    ``outcome`` names a column of ``subs`` holding the payment result
    ('paid'/'failed'); without it the invoices are 'pending'. Invoice ids are
    derived from the whole subscription id and the due date, so a rerun gives
    the same rows, and two cycles billed on one day give two invoices.
    """
    now, today = _now(as_of)
    due = subs.filter((F.col("statut") == "active") & (F.col("date_prochain_paiement") <= today))
    statut = F.col(outcome) if outcome else F.lit("pending")
    invoices = due.select(
        F.concat(F.lit("INV-"), "subscription_id", F.lit("-"),
                 F.regexp_replace(F.col("date_prochain_paiement").cast("string"), "-", "")).alias("invoice_id"),
        "merchant_id", "subscription_id", F.col("montant_mensuel_cad").alias("montant_cad"),
        statut.alias("statut"), today.alias("date_emission"), today.alias("date_echeance"),
        (now if outcome else F.lit(None).cast("timestamp_ntz")).alias("date_paiement"),
        F.lit(1).alias("tentatives_paiement"), now.alias("updated_at"))
    advanced = due.withColumns({"date_prochain_paiement": F.add_months("date_prochain_paiement", 1),
                                "updated_at": now}).select(*_cols("subscriptions"))
    return BillingRun(invoices, advanced)


# ------------------------------------------------------------------ B2 / B3

def retry_candidates(invoices: DataFrame, as_of) -> DataFrame:
    """Failed invoices with fewer than 3 attempts, untouched for 3 days."""
    now, _ = _now(as_of)
    return invoices.filter((F.col("statut") == "failed")
                                     & (F.col("tentatives_paiement") < MAX_ATTEMPTS)
                                     & (F.col("updated_at") < F.timestamp_add("DAY", F.lit(-RETRY_AFTER_DAYS), now)))


class RetryResult(NamedTuple):
    invoices: DataFrame
    subscriptions: DataFrame
    merchants: DataFrame


def apply_retries(invoices: DataFrame, attempts: DataFrame, subs: DataFrame, merchants: DataFrame,
                  as_of) -> RetryResult:
    """Apply recorded retry outcomes to the dunning candidates.

    The outcome of retry n of an invoice is its attempt numbered n (latest
    one if recorded twice), made by ``as_of``. Success: invoice paid. Failure:
    attempt count +1; at the 3rd failure the merchant and its active
    subscriptions churn.
    """
    now, _ = _now(as_of)
    cand = retry_candidates(invoices, as_of).withColumn("_n", F.col("tentatives_paiement") + 1)
    # candidates first: of all attempts only those that decide one are aggregated
    made = known_at(attempts, as_of, "created_at").withColumn("_n", F.col("tentative_numero"))
    outcome = (made.join(cand.select("invoice_id", "_n"), ["invoice_id", "_n"], "left_semi").groupBy("invoice_id", "_n")
               .agg(F.max_by("statut", F.struct("created_at", "attempt_id")).alias("_outcome")))
    tried = cand.join(outcome, ["invoice_id", "_n"], "inner")
    ok = F.col("_outcome") == "succeeded"
    updated = tried.withColumns({
        "statut": F.when(ok, F.lit("paid")).otherwise(F.col("statut")),
        "tentatives_paiement": F.col("_n").cast("int"),
        "date_paiement": F.when(ok, now).otherwise(F.col("date_paiement")),
        "updated_at": now,
    })
    churned = (tried.filter(~ok & (F.col("_n") >= MAX_ATTEMPTS)).select("merchant_id").distinct())
    subs_out = (subs.filter(F.col("statut") == "active").join(churned, "merchant_id", "left_semi")
                .withColumns({"statut": F.lit("churned"), "updated_at": now}).select(*_cols("subscriptions")))
    merch_out = (merchants.join(churned, "merchant_id", "left_semi")
                 .withColumns({"statut": F.lit("churned"), "updated_at": now}).select(*_cols("merchants")))
    return RetryResult(updated.select(*_cols("invoices")), subs_out, merch_out)


# ------------------------------------------------------------------ B4 / B5

def expire_trials(subs: DataFrame, as_of) -> DataFrame:
    """Trial subscriptions whose trial ended before ``as_of`` -> churned."""
    now, _ = _now(as_of)
    end = F.col("periode_essai_fin")
    due = subs.filter((F.col("statut") == "trial") & end.isNotNull() & (end.cast("timestamp_ntz") < now))
    return (due
            .withColumns({"statut": F.lit("churned"), "updated_at": now}).select(*_cols("subscriptions")))


def cancel_scheduled(subs: DataFrame, as_of) -> DataFrame:
    """Subscriptions flagged for cancellation whose payment date is due ->
    cancelled, flag cleared."""
    now, today = _now(as_of)
    due = subs.filter((F.col("annulation_schedulee") == F.lit(True))
                                & (F.col("date_prochain_paiement") <= today))
    return (due
            .withColumns({"statut": F.lit("cancelled"), "annulation_schedulee": F.lit(False), "updated_at": now})
            .select(*_cols("subscriptions")))


# ------------------------------------------------------------------ B6

class PlanChangeResult(NamedTuple):
    subscriptions: DataFrame
    merchants: DataFrame


def apply_plan_changes(subs: DataFrame, merchants: DataFrame, changes: DataFrame) -> PlanChangeResult:
    """Apply the latest plan change of each subscription (and of each
    merchant) unless the row is newer: plan, monthly amount and updated_at
    follow the change. A row stamped at the same instant as the change is
    taken as written before it (the change is recorded, then applied).
    Returns the changed rows only."""
    pos = [F.col("cdc_ts_ms")] if "cdc_ts_ms" in changes.columns else []
    order = F.struct(F.col("updated_at"), *pos, F.col("change_id"))
    change = F.struct("nouveau_plan", "nouveau_montant_cad", F.col("updated_at").alias("at"))
    by_sub = changes.groupBy("subscription_id").agg(F.max_by(change, order).alias("_c"))
    by_merchant = changes.groupBy("merchant_id").agg(F.max_by(change, order).alias("_c"))
    s = (subs.join(by_sub, "subscription_id", "inner").filter(F.col("_c.at") >= F.col("updated_at"))
         .withColumns({"plan": F.col("_c.nouveau_plan"), "montant_mensuel_cad": F.col("_c.nouveau_montant_cad"),
                       "updated_at": F.col("_c.at")}).select(*_cols("subscriptions")))
    m = (merchants.join(by_merchant, "merchant_id", "inner").filter(F.col("_c.at") >= F.col("updated_at"))
         .withColumns({"plan": F.col("_c.nouveau_plan"), "updated_at": F.col("_c.at")})
         .select(*_cols("merchants")))
    return PlanChangeResult(s, m)


# ------------------------------------------------------------------ all rules of a day

# The order in which the rules of a day are applied: each reads the row as the rules before it left it.
RULES = ("plan_change", "trial_expiry", "scheduled_cancellation", "billing_run", "dunning")


class BillingDay(NamedTuple):
    """Change sets, one row per changed key, with the names of the ``rules`` that changed it, in order."""

    subscriptions: DataFrame
    invoices: DataFrame
    merchants: DataFrame


def _apply(rows: DataFrame, rule: str, when: Column, **values: Column) -> DataFrame:
    """One rule folded into the rows: the values where ``when`` holds, and its name noted."""
    rows = rows.withColumn("_hit", F.coalesce(when, F.lit(False)))
    return rows.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in values.items()}
                            | {"rules": F.when(F.col("_hit"), F.array_append("rules", F.lit(rule))).otherwise(F.col("rules"))})


def _latest_changes(changes: DataFrame, key: str) -> DataFrame:
    pos = [F.col("cdc_ts_ms")] if "cdc_ts_ms" in changes.columns else []
    return changes.groupBy(F.col(key).alias("_key")).agg(F.max_by(
        F.struct("nouveau_plan", "nouveau_montant_cad", F.col("updated_at").alias("at")),
        F.struct(F.col("updated_at"), *pos, F.col("change_id"))).alias("_c"))


def billing_day(subs: DataFrame, invoices: DataFrame, merchants: DataFrame, attempts: DataFrame, changes: DataFrame,
                as_of) -> BillingDay:
    """All rules at ``as_of`` over the current tables, folded per key into one row.

    Where rules meet in one subscription, the order of RULES decides: one that is
    cancelled today is not billed, a new price is billed at once, and what was
    billed today may still churn with its merchant. An invoice is retried or new,
    never both. Attempts and plan changes after ``as_of`` are not known yet.
    """
    now, today = _now(as_of)
    none = F.array().cast("array<string>")
    known = known_at(changes, as_of)
    retries = apply_retries(invoices, attempts, subs, merchants, as_of)
    lost = (retries.invoices.filter((F.col("statut") != "paid") & (F.col("tentatives_paiement") >= MAX_ATTEMPTS))
            .select(F.col("merchant_id").alias("_lost")).distinct())
    applies = F.col("_c").isNotNull() & (F.col("_c.at") >= F.col("updated_at"))

    s = subs.select(*_cols("subscriptions")).join(_latest_changes(known, "subscription_id"),
                                                  F.col("subscription_id") == F.col("_key"), "left")
    s = s.join(lost, F.col("merchant_id") == F.col("_lost"), "left").withColumn("rules", none)
    s = _apply(s, "plan_change", applies, plan=F.col("_c.nouveau_plan"), montant_mensuel_cad=F.col("_c.nouveau_montant_cad"),
               updated_at=F.col("_c.at"))
    s = _apply(s, "trial_expiry", (F.col("statut") == "trial") & (F.col("periode_essai_fin").cast("timestamp_ntz") < now),
               statut=F.lit("churned"), updated_at=now)
    s = _apply(s, "scheduled_cancellation", F.col("annulation_schedulee") & (F.col("date_prochain_paiement") <= today),
               statut=F.lit("cancelled"), annulation_schedulee=F.lit(False), updated_at=now)
    s = s.withColumn("due", F.when((F.col("statut") == "active") & (F.col("date_prochain_paiement") <= today),
                                   F.col("date_prochain_paiement")))
    s = _apply(s, "billing_run", F.col("due").isNotNull(), date_prochain_paiement=F.add_months("due", 1), updated_at=now)
    s = _apply(s, "dunning", F.col("_lost").isNotNull() & (F.col("statut") == "active"), statut=F.lit("churned"), updated_at=now)

    billed = s.filter(F.col("due").isNotNull()).select(
        F.concat(F.lit("INV-"), "subscription_id", F.lit("-"), F.regexp_replace(F.col("due").cast("string"), "-", ""))
        .alias("invoice_id"), "merchant_id", "subscription_id", F.col("montant_mensuel_cad").alias("montant_cad"),
        F.lit("pending").alias("statut"), today.alias("date_emission"), today.alias("date_echeance"),
        F.lit(None).cast("timestamp_ntz").alias("date_paiement"), F.lit(1).alias("tentatives_paiement"), now.alias("updated_at"),
        F.array(F.lit("billing_run")).alias("rules"))

    m = merchants.select(*_cols("merchants")).join(_latest_changes(known, "merchant_id"),
                                                   F.col("merchant_id") == F.col("_key"), "left")
    m = m.join(lost, F.col("merchant_id") == F.col("_lost"), "left").withColumn("rules", none)
    m = _apply(m, "plan_change", applies, plan=F.col("_c.nouveau_plan"), updated_at=F.col("_c.at"))
    m = _apply(m, "dunning", F.col("_lost").isNotNull(), statut=F.lit("churned"), updated_at=now)

    changed = F.size("rules") > 0
    return BillingDay(
        s.filter(changed).select(*_cols("subscriptions"), "rules"),
        retries.invoices.withColumn("rules", F.array(F.lit("dunning"))).unionByName(billed),
        m.filter(changed).select(*_cols("merchants"), "rules"))
