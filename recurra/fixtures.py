"""Billing tables derived from the driver's generic tables.

The driver ships TPC-H-like tables (``orders``, ``customer``, ``events``). The
billing model is mapped onto them row by row, so every billing table grows
with the data: orders -> subscription versions, invoices and plan changes;
customer -> merchants; events -> payment attempts. All mappings are narrow
projections (no shuffle) except ``subscriptions_batch`` (latest version per
subscription) and the scalar ``min(o_orderdate)`` used by ``merchants``.

The same mapping is written in SQL for the DuckDB oracle (``recurra.oracle``).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.functions.text import padded_id
from recurra.operators.latest import latest_version

# Fixed values of the billing domain: plans and their monthly price in CAD,
# payment error codes.
PLAN_PRICES = {"starter": 99, "pro": 299, "enterprise": 799, "enterprise_plus": 1499}
ERROR_CODES = ["insufficient_funds", "card_expired", "do_not_honor", "lost_card"]

# Mapping choices of this fixture (not reference values).
PRIORITY_PLAN = {"1-URGENT": "enterprise_plus", "2-HIGH": "enterprise", "3-MEDIUM": "pro"}
SEGMENT_PLAN = {"AUTOMOBILE": "enterprise_plus", "BUILDING": "enterprise", "MACHINERY": "pro"}
PROVINCES = ["QC", "ON", "BC", "AB"]
KEY_PLAN = ["starter", "pro", "enterprise", "enterprise_plus"]


def _memo(fn):
    """Reuse the DataFrame (the plan object, not data) built for the same
    application, input folder and arguments: building these plans costs
    thousands of driver round trips and a footer read per table, and the
    inputs are read-only. Every action still recomputes from the files."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str, *args):
        key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), args)
        if key not in cache:
            cache[key] = fn(spark, sf_dir, *args)
        return cache[key]
    return wrapper


@_memo
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default))


def _money(v) -> Column:
    return (F.lit(v) if not isinstance(v, Column) else v).cast("decimal(10,2)")


def _merchant_of(custkey: Column) -> Column:
    # two customers share one merchant: odd keys fold onto the even one below
    return padded_id("MCH", custkey - custkey % 2, 6)


def _priority_plan(o) -> Column:
    return _case(o.o_orderpriority, PRIORITY_PLAN, "starter")


def _plan_price(plan: Column) -> Column:
    return _money(_case(plan, PLAN_PRICES, None))


@_memo
def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    first_order = table(spark, sf_dir, "orders").select(F.min("o_orderdate")).scalar()
    k = F.col("c_custkey")
    return c.select(
        padded_id("MCH", k, 6).alias("merchant_id"),
        F.col("c_name").alias("nom"),
        F.concat(F.lower("c_name"), F.lit("@example.ca")).alias("email"),
        _case(F.col("c_mktsegment"), SEGMENT_PLAN, "starter").alias("plan"),
        F.when(k % 4 == 0, "trial").when(k % 4 == 3, "churned").otherwise("active").alias("statut"),
        F.lit("1995-01-01").cast("date").alias("date_inscription"),
        F.lit("CA").alias("pays"),
        F.element_at(F.array(*[F.lit(p) for p in PROVINCES + ["other"]]),
                     (F.col("c_nationkey") % 5 + 1).cast("int")).alias("province"),
        F.timestamp_add("DAY", (k * 37 % 2500).cast("int"), first_order).alias("updated_at"),
    )


@_memo
def subscriptions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, status, ts = o.o_orderkey, o.o_orderstatus, o.o_orderdate
    trial = (status == "P") & (key % 5 == 0)
    plan = _priority_plan(o)
    return o.select(
        padded_id("SUB", o.o_custkey, 6).alias("subscription_id"),
        _merchant_of(o.o_custkey).alias("merchant_id"),
        plan.alias("plan"),
        F.when((status == "F") & (key % 3 == 0), "cancelled")
         .when((status == "F") & (key % 3 == 1), "churned")
         .when(status == "F", "past_due")
         .when(trial, "trial").otherwise("active").alias("statut"),
        _plan_price(plan).alias("montant_mensuel_cad"),
        F.lit("CAD").alias("devise"),
        F.to_date(ts).alias("date_debut"),
        F.to_date(F.timestamp_add("DAY", F.lit(30), ts)).alias("date_prochain_paiement"),
        F.when(trial, F.to_date(F.timestamp_add("DAY", F.lit(14), ts))).alias("periode_essai_fin"),
        (key % 7 == 0).alias("annulation_schedulee"),
        ts.alias("updated_at"),
        F.when(key % 4 == 0, "c").otherwise("u").alias("cdc_operation"),
        F.timestamp_add("HOUR", F.lit(1), ts).alias("cdc_timestamp"),
        key.alias("cdc_ts_ms"),
    )


SUBSCRIPTION_COLUMNS = ["subscription_id", "merchant_id", "plan", "statut", "montant_mensuel_cad",
                        "devise", "date_debut", "date_prochain_paiement", "periode_essai_fin",
                        "annulation_schedulee", "updated_at"]

# The order that picks the current version of a subscription: newest change,
# then the larger amount (final state of a same-instant downgrade+upgrade),
# then the CDC position.
SUBSCRIPTION_VERSION_ORDER = ("updated_at", "montant_mensuel_cad", "cdc_ts_ms")


@_memo
def subscriptions_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of the operational table: the current version of each
    subscription, minus the ones deleted since (ids ending in 9, only in the
    log), with a price correction on ids ending in 77 (batch differs)."""
    latest = latest_version(subscriptions_stream(spark, sf_dir), "subscription_id",
                            SUBSCRIPTION_VERSION_ORDER)
    sid = F.col("subscription_id")
    return (latest.filter(~sid.endswith("9"))
            .withColumn("montant_mensuel_cad",
                        (F.col("montant_mensuel_cad")
                         + F.when(sid.endswith("77"), 1).otherwise(0)).cast("decimal(10,2)"))
            .select(*SUBSCRIPTION_COLUMNS))


@_memo
def invoices_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ts = o.o_orderdate
    return o.select(
        padded_id("INV", o.o_orderkey, 9).alias("invoice_id"),
        _merchant_of(o.o_custkey).alias("merchant_id"),
        padded_id("SUB", o.o_custkey, 6).alias("subscription_id"),
        _money(o.o_totalprice).alias("montant_cad"),
        F.when(o.o_orderstatus == "F", "paid").when(o.o_orderstatus == "P", "failed")
         .otherwise("pending").alias("statut"),
        F.to_date(ts).alias("date_emission"),
        F.to_date(F.timestamp_add("DAY", F.lit(15), ts)).alias("date_echeance"),
        F.when(o.o_orderstatus == "F", ts).alias("date_paiement"),
        (o.o_orderkey % 4).cast("int").alias("tentatives_paiement"),
        ts.alias("updated_at"),
        F.lit("c").alias("cdc_operation"),
        F.timestamp_add("HOUR", F.lit(1), ts).alias("cdc_timestamp"),
        o.o_orderkey.alias("cdc_ts_ms"),
    )


@_memo
def payment_attempts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempts(spark, sf_dir).drop("event_type")


@_memo
def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    failed = e.event_type.isin("error", "view")
    return e.select(
        padded_id("ATT", e.event_id, 9).alias("attempt_id"),
        padded_id("INV", e.event_id, 9).alias("invoice_id"),
        padded_id("MCH", e.user_id, 6).alias("merchant_id"),
        _money(e.value).alias("montant_cad"),
        F.when(failed, "failed").otherwise("succeeded").alias("statut"),
        F.when(failed, F.element_at(F.array(*[F.lit(x) for x in ERROR_CODES]),
                                    (e.event_id % 4 + 1).cast("int"))).alias("code_erreur"),
        F.lit("stripe").alias("gateway"),
        (e.event_id % 3 + 1).cast("int").alias("tentative_numero"),
        F.timestamp_add("DAY", (e.event_id % 11 * 30).cast("int"), e.ts).alias("created_at"),
        F.lit("c").alias("cdc_operation"),
        F.timestamp_add("HOUR", F.lit(1), e.ts).alias("cdc_timestamp"),
        e.event_id.alias("cdc_ts_ms"),
        e.event_type,
    )


@_memo
def plan_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 == 0)
    ts = o.o_orderdate
    old_plan = _priority_plan(o)
    new_plan = F.element_at(F.array(*[F.lit(p) for p in KEY_PLAN]), (o.o_orderkey % 4 + 1).cast("int"))
    return o.select(
        padded_id("CHG", o.o_orderkey, 9).alias("change_id"),
        _merchant_of(o.o_custkey).alias("merchant_id"),
        padded_id("SUB", o.o_custkey, 6).alias("subscription_id"),
        old_plan.alias("ancien_plan"),
        new_plan.alias("nouveau_plan"),
        _plan_price(old_plan).alias("ancien_montant_cad"),
        _plan_price(new_plan).alias("nouveau_montant_cad"),
        F.to_date(ts).alias("date_effet"),
        F.lit("upgrade_volontaire").alias("motif"),
        ts.alias("updated_at"),
        F.lit("c").alias("cdc_operation"),
        F.timestamp_add("HOUR", F.lit(1), ts).alias("cdc_timestamp"),
        o.o_orderkey.alias("cdc_ts_ms"),
    )


LOGS = {
    "subscriptions": subscriptions_stream,
    "invoices": invoices_stream,
    "payment_attempts": payment_attempts_stream,
    "plan_changes": plan_changes_stream,
}


# ------------------------------------------------------------------ CDC wire

CDC_PREFIX = "billing"
CDC_DB = "billing_db"

# How each table is put on the wire, so every decoder path sees whole tables:
# envelope shape, money encoding, date encoding, timestamp encoding.
WIRE_FORMAT = {
    "subscriptions": ("root", "text", "days", "millis"),
    "invoices": ("payload", "base64", "days", "millis"),
    "payment_attempts": ("root", "base64", "days", "iso"),
    "plan_changes": ("root", "text", "iso", "millis"),
    "merchants": ("payload", "text", "days", "iso"),
}


def _encode_after(df: DataFrame, tbl: str) -> Column:
    from recurra import schemas
    from recurra.functions.decode import (encode_decimal_base64, encode_epoch_date,
                                          encode_epoch_millis, encode_iso_utc)
    _, money, dates, stamps = WIRE_FORMAT[tbl]
    fields = []
    for f in schemas.TABLES[tbl][0].fields:
        c, t = F.col(f.name), f.dataType.typeName()
        if t == "decimal":
            c = encode_decimal_base64(c, 2) if money == "base64" else c.cast("string")
        elif t == "date":
            c = encode_epoch_date(c) if dates == "days" else c.cast("string")
        elif t == "boolean":
            c = c.cast("int")
        elif t == "timestamp_ntz":
            c = encode_epoch_millis(c) if stamps == "millis" else encode_iso_utc(c)
        fields.append(c.alias(f.name))
    return F.struct(*fields)


def _message(tbl: str, before: Column, after: Column, op: Column, ts_ms: Column) -> Column:
    env = F.struct(before.alias("before"), after.alias("after"),
                   F.struct(F.lit(CDC_DB).alias("db"), F.lit(tbl).alias("table")).alias("source"),
                   op.alias("op"), ts_ms.alias("ts_ms"))
    if WIRE_FORMAT[tbl][0] == "payload":
        env = F.struct(env.alias("payload"))
    return F.to_json(env)


@_memo
def cdc_messages(spark: SparkSession, sf_dir: str, topics: tuple[str, ...] | None = None,
                 partitions: int | None = None) -> DataFrame:
    """The CDC topic traffic the source tables would produce: (topic, value).

    Every row version of every table is one message. Subscriptions that are
    only in the log (ids ending in 9) were deleted: each gets a delete
    message after its last version. Attempts from ``error`` events also
    arrive a second time cut short (an unparseable message).

    Like a partitioned topic, messages are spread over ``partitions`` by
    (topic, primary key) -- the producer-side key partitioning -- so decoding
    runs on all cores instead of one task per (single row group) input file.
    ``topics`` (table names) restricts the traffic to those tables' topics.
    """
    want = set(topics or WIRE_FORMAT)
    n = partitions or spark.sparkContext.defaultParallelism

    def by_key(df: DataFrame, key: str) -> DataFrame:
        # key partitioning happens on the narrow rows, before encoding
        return df.repartition(n, key)
    raw_topic = lambda t: F.lit(f"{CDC_PREFIX}.{CDC_DB}.{t}")
    no_before = F.lit(None).cast("string")
    parts = []
    for tbl, build in [("subscriptions", subscriptions_stream), ("invoices", invoices_stream),
                       ("plan_changes", plan_changes_stream)]:
        if tbl not in want:
            continue
        d = by_key(build(spark, sf_dir), _KEYS[tbl])
        parts.append(d.select(raw_topic(tbl).alias("topic"), F.col(_KEYS[tbl]).alias("_key"),
                              _message(tbl, no_before, _encode_after(d, tbl), F.col("cdc_operation"),
                                       F.col("cdc_ts_ms")).alias("value")))
    if "payment_attempts" in want:
        parts += _attempt_messages(by_key(_attempts(spark, sf_dir), "attempt_id"), raw_topic, no_before)
    if "merchants" in want:
        m = by_key(merchants(spark, sf_dir), "merchant_id")
        parts.append(m.select(raw_topic("merchants").alias("topic"), F.col("merchant_id").alias("_key"),
                              _message("merchants", no_before, _encode_after(m, "merchants"), F.lit("c"),
                                       F.regexp_extract("merchant_id", r"(\d+)$", 1).cast("bigint"))
                              .alias("value")))
    if "subscriptions" in want:
        parts.append(_delete_messages(spark, sf_dir, raw_topic))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_key")


def _attempt_messages(a: DataFrame, raw_topic, no_before) -> list[DataFrame]:
    msg = _message("payment_attempts", no_before, _encode_after(a, "payment_attempts"),
                   F.col("cdc_operation"), F.col("cdc_ts_ms"))
    copies = F.array(msg, F.when(F.col("event_type") == "error", F.substring(msg, 1, 40)))
    return [a.select(raw_topic("payment_attempts").alias("topic"), F.col("attempt_id").alias("_key"),
                     F.explode(copies).alias("value")).filter(F.col("value").isNotNull())]


# Every sixteenth attempt, or subscription version, by key: the fault in its message.
FAULTS = 16


@_memo
def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic of attempts, subscriptions and merchants from a producer that errs: (topic, value).

    Of the attempts, by event id modulo 16: 0 without invoice_id, 1 with an
    amount that is neither number nor bytes, 3 with a number in words, 4 without
    merchant_id, 5 cut short. Subscription versions with 2 have no date in date_debut.
    """
    topic = lambda t: F.lit(f"{CDC_PREFIX}.{CDC_DB}.{t}").alias("topic")
    no_before = F.lit(None).cast("string")

    def wrong(df: DataFrame, tbl: str, faults: dict[str, tuple[int, str | None]]) -> Column:
        after, kind = _encode_after(df, tbl), F.pmod(F.col("cdc_ts_ms"), F.lit(FAULTS))
        for name, (k, text) in faults.items():
            after = after.withField(name, F.when(kind == k, F.lit(text)).otherwise(after[name].cast("string")))
        return _message(tbl, no_before, after, F.col("cdc_operation"), F.col("cdc_ts_ms"))

    a, s = payment_attempts_stream(spark, sf_dir), subscriptions_stream(spark, sf_dir)
    sent = wrong(a, "payment_attempts", {"invoice_id": (0, None), "montant_cad": (1, "12,5 CAD"),
                                         "tentative_numero": (3, "three"), "merchant_id": (4, None)})
    cut = F.when(F.pmod(F.col("cdc_ts_ms"), F.lit(FAULTS)) == 5, F.substring(sent, 1, 40)).otherwise(sent)
    return (a.select(topic("payment_attempts"), cut.alias("value"))
            .unionByName(s.select(topic("subscriptions"), wrong(s, "subscriptions", {"date_debut": (2, "soon")}).alias("value")))
            .unionByName(cdc_messages(spark, sf_dir, ("merchants",))))


def _delete_messages(spark, sf_dir, raw_topic) -> DataFrame:
    gone = (subscriptions_stream(spark, sf_dir).filter(F.col("subscription_id").endswith("9"))
            .groupBy("subscription_id", "merchant_id").agg(F.max("cdc_ts_ms").alias("last")))
    before = F.to_json(F.struct("subscription_id", "merchant_id"))
    return gone.select(raw_topic("subscriptions").alias("topic"), F.col("subscription_id").alias("_key"),
                       _message("subscriptions", before, F.lit(None).cast("string"), F.lit("d"),
                                F.col("last") + 1).alias("value"))


_KEYS = {"subscriptions": "subscription_id", "invoices": "invoice_id", "plan_changes": "change_id"}
