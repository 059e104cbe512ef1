"""Keyed merchant state (M1-M6): one merged row per merchant.

The document store of the reference applies field-level patches in arrival
order. Here the state is a pure function of the change rows, so it is the
same for any arrival order, for replays, and for batch vs stream:

* every source row becomes an event with an order key
  ``(version time, source rank, CDC position, entity id)``;
* each field group takes the value of its latest event (``max_by`` over the
  order key, partial aggregation before the shuffle by merchant);
* ``plan_actuel`` is shared by merchants and subscriptions: latest of both;
* the failure counter is the number of failed attempts strictly after the
  latest non-failed attempt (``consecutive_failures``), distinct by attempt,
  which replaces the non-idempotent increment.

A merchant with several subscriptions shows its latest one (state is keyed by
merchant, as in the reference).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra import schemas

# Tie order between sources at the same instant: a subscription change wins
# over the merchant row written at the same time.
SOURCE_RANK = {"merchants": 0, "subscriptions": 1, "payment_attempts": 2}

# Parts into which a merchant's failed attempts are split; every merchant's reset
# point is copied as often.
SALTS = 16


def _pos(df: DataFrame) -> Column:
    return F.col("cdc_ts_ms") if "cdc_ts_ms" in df.columns else F.lit(None).cast("bigint")


def _order(ts: str, src: str, df: DataFrame, key: str) -> Column:
    return F.struct(F.col(ts).alias("ts"), F.lit(SOURCE_RANK[src]).alias("rank"),
                    _pos(df).alias("pos"), F.col(key).alias("key"))


_SUB = "struct<plan:string,statut:string,montant_mensuel_cad:decimal(10,2),date_prochain_paiement:date,annulation_schedulee:boolean>"
_MER = "struct<nom:string,email:string,plan:string,statut:string,province:string>"
_ATT = "struct<created_at:timestamp_ntz,statut:string>"


def state_events(merchants: DataFrame | None = None, subscriptions: DataFrame | None = None,
                 attempts: DataFrame | None = None) -> DataFrame:
    """M1-M3 inputs as one event relation:
    (merchant_id, src, ord, ts, plan, sub, mer, att)."""
    none = lambda t: F.lit(None).cast(t)
    parts = []
    if subscriptions is not None:
        s = subscriptions
        parts.append(s.select(
            "merchant_id", F.lit("subscriptions").alias("src"),
            _order("updated_at", "subscriptions", s, "subscription_id").alias("ord"),
            F.col("updated_at").alias("ts"), "plan",
            F.struct("plan", "statut", "montant_mensuel_cad", "date_prochain_paiement",
                     "annulation_schedulee").alias("sub"),
            none(_MER).alias("mer"), none(_ATT).alias("att")))
    if merchants is not None:
        m = merchants
        parts.append(m.select(
            "merchant_id", F.lit("merchants").alias("src"),
            _order("updated_at", "merchants", m, "merchant_id").alias("ord"),
            F.col("updated_at").alias("ts"), "plan", none(_SUB).alias("sub"),
            F.struct("nom", "email", "plan", "statut", "province").alias("mer"),
            none(_ATT).alias("att")))
    if attempts is not None:
        a = attempts
        parts.append(a.select(
            "merchant_id", F.lit("payment_attempts").alias("src"),
            _order("created_at", "payment_attempts", a, "attempt_id").alias("ord"),
            F.col("created_at").alias("ts"), none("string").alias("plan"),
            none(_SUB).alias("sub"), none(_MER).alias("mer"),
            F.struct("created_at", "statut").alias("att")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    mid = F.col("merchant_id")
    return out.filter(mid.isNotNull() & (mid != ""))  # C12


def _latest(value: str, src: list[str]) -> Column:
    return F.max_by(F.col(value), F.when(F.col("src").isin(*src), F.col("ord")))


def merchant_fields(events: DataFrame) -> DataFrame:
    """M1-M3, M5, M6: latest value of each field group per merchant."""
    return events.groupBy("merchant_id").agg(
        _latest("sub", ["subscriptions"]).alias("sub"),
        _latest("mer", ["merchants"]).alias("mer"),
        _latest("att", ["payment_attempts"]).alias("att"),
        F.max_by(F.struct("plan"), F.when(F.col("src").isin("merchants", "subscriptions"), F.col("ord")))
         .alias("plan_v"),
        F.max("ts").alias("updated_at"))


def consecutive_failures(attempts: DataFrame, salts: int = SALTS) -> DataFrame:
    """M4: merchant_id, nb_echecs_paiement_consecutifs for every merchant with
    attempts: failed attempts strictly after the latest non-failed one in
    (created_at, attempt_id) order, counted once per attempt_id.

    The reset point is an aggregate with map-side partials. The failed attempts
    meet it on (merchant, salt of the attempt), so a hot merchant's rows go to
    ``salts`` tasks; copies of an attempt share a salt, so the distinct counts
    of the salts add up.
    """
    key = F.struct("created_at", "attempt_id")
    not_failed = ~F.col("statut").eqNullSafe("failed")
    valid = attempts.filter(F.col("merchant_id").isNotNull() & (F.col("merchant_id") != ""))
    reset = valid.groupBy("merchant_id").agg(F.max(F.when(not_failed, key)).alias("reset"))
    resets = reset.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    failed = valid.filter(F.col("statut") == "failed").select(
        "merchant_id", key.alias("k"), "attempt_id",
        F.pmod(F.xxhash64("attempt_id"), F.lit(salts)).cast("int").alias("salt"))
    after = (failed.join(resets, ["merchant_id", "salt"])
             .filter(F.col("reset").isNull() | (F.col("k") > F.col("reset")))
             .groupBy("merchant_id", "salt").agg(F.count_distinct("attempt_id").alias("n"))
             .groupBy("merchant_id").agg(F.sum("n").alias("n")))
    return (reset.select("merchant_id").join(after, "merchant_id", "left")
            .select("merchant_id", F.coalesce("n", F.lit(0)).cast("bigint")
                    .alias("nb_echecs_paiement_consecutifs")))


def assemble(fields: DataFrame, failures: DataFrame) -> DataFrame:
    """Final state row (MERCHANT_STATE schema). Amount and cancellation flag
    default to 0 / false once a subscription has been seen."""
    has_sub = F.col("sub").isNotNull()
    j = fields.join(failures, "merchant_id", "left")
    return j.select(
        "merchant_id", F.col("mer.nom").alias("nom"), F.col("mer.email").alias("email"),
        F.col("mer.province").alias("province"), F.col("plan_v.plan").alias("plan_actuel"),
        F.col("mer.statut").alias("statut_merchant"), F.col("sub.statut").alias("statut_abonnement"),
        F.when(has_sub, F.coalesce(F.col("sub.montant_mensuel_cad"), F.lit(0).cast("decimal(10,2)")))
         .alias("montant_mensuel_cad"),
        F.col("sub.date_prochain_paiement").alias("date_prochain_paiement"),
        F.when(has_sub, F.coalesce(F.col("sub.annulation_schedulee"), F.lit(False))).alias("annulation_schedulee"),
        F.col("att.created_at").alias("derniere_tentative_paiement"),
        F.col("att.statut").alias("statut_derniere_tentative"),
        "nb_echecs_paiement_consecutifs", "updated_at")


def merchant_state(merchants: DataFrame | None, subscriptions: DataFrame | None,
                   attempts: DataFrame | None) -> DataFrame:
    """Batch form of the merged state from the three change sources."""
    fields = merchant_fields(state_events(merchants, subscriptions, attempts))
    if attempts is None:
        fails = fields.select("merchant_id", F.lit(None).cast("bigint").alias("nb_echecs_paiement_consecutifs"))
    else:
        fails = consecutive_failures(attempts)
    return assemble(fields, fails).select(*[f.name for f in schemas.MERCHANT_STATE.fields])
