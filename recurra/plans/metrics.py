"""Recurring-revenue metric views.

Each view is a function of DataFrames returning a lazy DataFrame. Where the
SQL views scan the subscription log several times (one CTE per measure) the
functions scan each input once: every row emits its contributions keyed by
the month it belongs to, and one partial+final aggregate produces all
measures. Month-keyed results are tiny (one row per month), so the single
partition window in NRR is bounded by the calendar, not by the data.

``latest_only=True`` first keeps the current version of every subscription
(the log counts an entity once per version, which inflates sums).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.calendar import month_start
from recurra.functions.numeric import safe_divide
from recurra.operators.latest import latest_version

SUM_TYPE = "decimal(20,2)"
CHURN_STATUSES = ("cancelled", "churned")
NEW_STATUSES = ("active", "trial")


def _subs(subs: DataFrame, latest_only: bool) -> DataFrame:
    if not latest_only:
        return subs
    order = ["updated_at", "montant_mensuel_cad"] + (["cdc_ts_ms"] if "cdc_ts_ms" in subs.columns else [])
    return latest_version(subs, "subscription_id", order)


def _money_sum(c: Column) -> Column:
    return F.sum(c).cast(SUM_TYPE)


# ------------------------------------------------------------------ A1 / A2

def mrr_current(subs: DataFrame, latest_only: bool = False) -> DataFrame:
    """mois, plan, statut, nb_abonnements, mrr_cad."""
    s = _subs(subs, latest_only)
    return (s.groupBy(month_start("updated_at").alias("mois"), "plan", "statut")
            .agg(F.count(F.lit(1)).alias("nb_abonnements"),
                 _money_sum(F.col("montant_mensuel_cad")).alias("mrr_cad")))


def mrr_active_arr(mrr: DataFrame) -> DataFrame:
    """Active rows of ``mrr_current`` with ARR = MRR * 12."""
    return (mrr.filter(F.col("statut") == "active")
            .select("mois", "plan", "nb_abonnements", "mrr_cad",
                    (F.col("mrr_cad") * 12).cast(SUM_TYPE).alias("arr_cad")))


# ------------------------------------------------------------------ A3 / A4

def churn_monthly(subs: DataFrame, latest_only: bool = False) -> DataFrame:
    """mois, statut, nb_subscriptions, mrr_cad."""
    s = _subs(subs, latest_only)
    return (s.groupBy(month_start("updated_at").alias("mois"), "statut")
            .agg(F.count(F.lit(1)).alias("nb_subscriptions"),
                 _money_sum(F.col("montant_mensuel_cad")).alias("mrr_cad")))


def churn_rate(churn: DataFrame) -> DataFrame:
    """Re-aggregation of ``churn_monthly``: churned / total per month."""
    churned = F.sum(F.when(F.col("statut").isin(*CHURN_STATUSES), F.col("nb_subscriptions"))
                    .otherwise(F.lit(0)))
    total = F.sum("nb_subscriptions")
    return (churn.groupBy("mois")
            .agg(churned.cast("bigint").alias("nb_churned"), total.cast("bigint").alias("nb_total"),
                 safe_divide(churned, total).alias("churn_rate")))


# ------------------------------------------------------------------ A8

def _movement(changes: DataFrame) -> tuple[Column, Column]:
    new, old = F.col("nouveau_montant_cad"), F.col("ancien_montant_cad")
    expansion = F.when(new > old, new - old).otherwise(F.lit(0))
    contraction = F.when(new < old, old - new).otherwise(F.lit(0))
    return expansion, contraction


def plan_change_movement(changes: DataFrame) -> DataFrame:
    """mois, expansion_mrr, contraction_mrr (by effective month)."""
    expansion, contraction = _movement(changes)
    return (changes.groupBy(month_start("date_effet").alias("mois"))
            .agg(_money_sum(expansion).alias("expansion_mrr"),
                 _money_sum(contraction).alias("contraction_mrr")))


# ------------------------------------------------------------------ A5 / A6

_MEASURES = ("present", "mrr_active", "churned", "new_mrr", "expansion", "contraction")


def _contributions(subs: DataFrame, changes: DataFrame, with_new: bool,
                   create_ops: Sequence[str]) -> DataFrame:
    """One narrow pass per input: rows of (mois, measure columns).

    A subscription row contributes its active/churned amount to the month of
    ``updated_at`` and, for creations, its amount to the month of
    ``date_debut``. A plan change contributes to the month of ``date_effet``.
    Measures a row does not feed are null, so sums keep SQL null semantics;
    secondary months that are null are dropped (a null month never joins).
    """
    amount, statut = F.col("montant_mensuel_cad"), F.col("statut")
    none = F.lit(None).cast("decimal(12,2)")
    by_update = F.struct(
        month_start("updated_at").alias("mois"), F.lit(1).alias("present"),
        F.when(statut == "active", amount).otherwise(F.lit(0)).cast("decimal(12,2)").alias("mrr_active"),
        # a null month never matches the churn CTE's join in the view
        F.when(F.col("updated_at").isNotNull() & statut.isin(*CHURN_STATUSES), amount)
         .cast("decimal(12,2)").alias("churned"),
        none.alias("new_mrr"), none.alias("expansion"), none.alias("contraction"))
    rows = [by_update]
    if with_new:
        is_new = F.col("cdc_operation").isin(*create_ops) & statut.isin(*NEW_STATUSES)
        by_start = F.struct(
            month_start("date_debut").alias("mois"), F.lit(0).alias("present"),
            none.alias("mrr_active"), none.alias("churned"),
            F.when(is_new, amount).cast("decimal(12,2)").alias("new_mrr"),
            none.alias("expansion"), none.alias("contraction"))
        rows.append(F.when(is_new & F.col("date_debut").isNotNull(), by_start))
    s = (subs.select(F.explode(F.array(*rows)).alias("r")).filter(F.col("r").isNotNull())
         .select("r.*"))
    expansion, contraction = _movement(changes)
    c = changes.filter(F.col("date_effet").isNotNull()).select(
        month_start("date_effet").alias("mois"), F.lit(0).alias("present"),
        none.alias("mrr_active"), none.alias("churned"), none.alias("new_mrr"),
        expansion.cast("decimal(12,2)").alias("expansion"),
        contraction.cast("decimal(12,2)").alias("contraction"))
    return s.unionByName(c)


def _monthly(subs, changes, with_new, create_ops) -> DataFrame:
    rows = _contributions(subs, changes, with_new, create_ops)
    # months only reached through plan changes or start dates are not part of
    # the result (the views are driven by the subscription months)
    return (rows.groupBy("mois")
            .agg(F.max("present").alias("present"),
                 _money_sum(F.col("mrr_active")).alias("mrr_end"),
                 F.coalesce(_money_sum(F.col("churned")), F.lit(0).cast(SUM_TYPE)).alias("churned_mrr"),
                 F.coalesce(_money_sum(F.col("new_mrr")), F.lit(0).cast(SUM_TYPE)).alias("new_mrr"),
                 F.coalesce(_money_sum(F.col("expansion")), F.lit(0).cast(SUM_TYPE)).alias("expansion_mrr"),
                 F.coalesce(_money_sum(F.col("contraction")), F.lit(0).cast(SUM_TYPE))
                 .alias("contraction_mrr"))
            .filter(F.col("present") == 1).drop("present"))


def nrr_monthly(subs: DataFrame, changes: DataFrame, latest_only: bool = False) -> DataFrame:
    """mois, mrr_end, churned_mrr, expansion_mrr, contraction_mrr, nrr.

    nrr = (mrr_end + churned - expansion) / previous present month's mrr_end
    (the view's code, not its header comment; LAG skips missing months).
    Like the waterfall and the failure rate, sorted by month (L1).
    """
    m = _monthly(_subs(subs, latest_only), changes, False, ("c",))
    prev = F.lag("mrr_end").over(Window.orderBy("mois"))
    return m.select(
        "mois", "mrr_end", "churned_mrr", "expansion_mrr", "contraction_mrr",
        safe_divide(F.col("mrr_end") + F.col("churned_mrr") - F.col("expansion_mrr"), prev).alias("nrr")).orderBy("mois")


def mrr_waterfall(subs: DataFrame, changes: DataFrame, latest_only: bool = False,
                  create_ops: Sequence[str] = ("c",)) -> DataFrame:
    """mois, new_mrr, expansion_mrr, contraction_mrr, churned_mrr, mrr_end, arr_end."""
    m = _monthly(_subs(subs, latest_only), changes, True, create_ops)
    return m.select("mois", "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "mrr_end",
                    (F.col("mrr_end") * 12).cast(SUM_TYPE).alias("arr_end")).orderBy("mois")


# ------------------------------------------------------------------ A7

ERROR_CODES = ("insufficient_funds", "card_expired", "do_not_honor", "lost_card")
# The view tests statut = 'success' while attempts are recorded as
# 'succeeded'; the literal view therefore counts no success at all.
LITERAL_SUCCESS = ("success",)
CORRECTED_SUCCESS = ("success", "succeeded")


def failed_payment_rate(attempts: DataFrame, success_values: Sequence[str] = LITERAL_SUCCESS) -> DataFrame:
    """mois, total_attempts, nb_success, nb_failed, failed_rate, err_* counts,
    recovery_rate, revenue_at_risk_cad."""
    statut = F.col("statut")
    ok = statut.isin(*success_values)
    failed = statut == "failed"
    n_failed = F.count_if(failed)
    aggs = [F.count(F.lit(1)).alias("total_attempts"),
            F.count_if(ok).alias("nb_success"),
            n_failed.alias("nb_failed"),
            safe_divide(n_failed, F.count(F.lit(1))).alias("failed_rate")]
    aggs += [F.count_if(F.col("code_erreur") == code).alias(f"err_{code}") for code in ERROR_CODES]
    aggs += [safe_divide(F.count_if(ok & (F.col("tentative_numero") > 1)), n_failed).alias("recovery_rate"),
             _money_sum(F.when(failed, F.col("montant_cad")).otherwise(F.lit(0))).alias("revenue_at_risk_cad")]
    return attempts.groupBy(month_start("created_at").alias("mois")).agg(*aggs).orderBy("mois")
