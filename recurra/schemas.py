"""Declared schemas of every relation. Never inferred (money must stay
DECIMAL(10,2), flags BOOLEAN)."""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampNTZType, DoubleType)

MONEY = DecimalType(10, 2)
MONEY_SUM = DecimalType(20, 2)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


MERCHANTS = _s(
    ("merchant_id", StringType()), ("nom", StringType()), ("email", StringType()),
    ("plan", StringType()), ("statut", StringType()), ("date_inscription", DateType()),
    ("pays", StringType()), ("province", StringType()), ("updated_at", TimestampNTZType()),
)

SUBSCRIPTIONS = _s(
    ("subscription_id", StringType()), ("merchant_id", StringType()), ("plan", StringType()),
    ("statut", StringType()), ("montant_mensuel_cad", MONEY), ("devise", StringType()),
    ("date_debut", DateType()), ("date_prochain_paiement", DateType()),
    ("periode_essai_fin", DateType()), ("annulation_schedulee", BooleanType()),
    ("updated_at", TimestampNTZType()),
)

INVOICES = _s(
    ("invoice_id", StringType()), ("merchant_id", StringType()), ("subscription_id", StringType()),
    ("montant_cad", MONEY), ("statut", StringType()), ("date_emission", DateType()),
    ("date_echeance", DateType()), ("date_paiement", TimestampNTZType()),
    ("tentatives_paiement", IntegerType()), ("updated_at", TimestampNTZType()),
)

PAYMENT_ATTEMPTS = _s(
    ("attempt_id", StringType()), ("invoice_id", StringType()), ("merchant_id", StringType()),
    ("montant_cad", MONEY), ("statut", StringType()), ("code_erreur", StringType()),
    ("gateway", StringType()), ("tentative_numero", IntegerType()),
    ("created_at", TimestampNTZType()),
)

PLAN_CHANGES = _s(
    ("change_id", StringType()), ("merchant_id", StringType()), ("subscription_id", StringType()),
    ("ancien_plan", StringType()), ("nouveau_plan", StringType()),
    ("ancien_montant_cad", MONEY), ("nouveau_montant_cad", MONEY), ("date_effet", DateType()),
    ("motif", StringType()), ("updated_at", TimestampNTZType()),
)

# Source tables by name, with primary key and the column that orders versions.
TABLES = {
    "merchants": (MERCHANTS, "merchant_id", "updated_at"),
    "subscriptions": (SUBSCRIPTIONS, "subscription_id", "updated_at"),
    "invoices": (INVOICES, "invoice_id", "updated_at"),
    "payment_attempts": (PAYMENT_ATTEMPTS, "attempt_id", "created_at"),
    "plan_changes": (PLAN_CHANGES, "change_id", "updated_at"),
}

# Event logs: source table -> log table (merchants have no log), plus the
# columns the log declares REQUIRED.
LOG_TABLES = {
    "subscriptions": "subscriptions_stream",
    "invoices": "invoices_stream",
    "payment_attempts": "payment_attempts_stream",
    "plan_changes": "plan_changes_stream",
}
REQUIRED = {
    "subscriptions": ("subscription_id", "merchant_id"),
    "invoices": ("invoice_id", "merchant_id"),
    "payment_attempts": ("attempt_id", "invoice_id"),
    "plan_changes": ("change_id", "merchant_id"),
}

CDC_COLUMNS = _s(
    ("cdc_operation", StringType()), ("cdc_timestamp", TimestampNTZType()),
    ("cdc_ts_ms", LongType()),
)


def log_schema(table: str) -> StructType:
    return StructType(TABLES[table][0].fields + CDC_COLUMNS.fields)


RECONCILIATION_LOG = _s(
    ("date", DateType()), ("mrr_streaming_cad", MONEY_SUM), ("mrr_batch_cad", MONEY_SUM),
    ("ecart_pct", DoubleType()), ("status", StringType()), ("checked_at", TimestampNTZType()),
)

MERCHANT_STATE = _s(
    ("merchant_id", StringType()), ("nom", StringType()), ("email", StringType()),
    ("province", StringType()), ("plan_actuel", StringType()), ("statut_merchant", StringType()),
    ("statut_abonnement", StringType()), ("montant_mensuel_cad", MONEY),
    ("date_prochain_paiement", DateType()), ("annulation_schedulee", BooleanType()),
    ("derniere_tentative_paiement", TimestampNTZType()), ("statut_derniere_tentative", StringType()),
    ("nb_echecs_paiement_consecutifs", LongType()), ("updated_at", TimestampNTZType()),
)
