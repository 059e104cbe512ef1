"""Independent SQL formulations (DuckDB dialect) of every registered query.

The driver registers its parquet tables as views (orders, customer, events,
...). The billing tables are derived from them with the same mapping as
``recurra.fixtures``, written here as CTEs, so each oracle query is a plain
SQL statement over the driver tables.
"""

from __future__ import annotations

_PLAN_BY_PRIORITY = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'enterprise_plus' WHEN '2-HIGH' THEN 'enterprise' "
                     "WHEN '3-MEDIUM' THEN 'pro' ELSE 'starter' END")
_PRICE_BY_PRIORITY = ("CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1499 WHEN '2-HIGH' THEN 799 "
                      "WHEN '3-MEDIUM' THEN 299 ELSE 99 END AS DECIMAL(10,2))")
_MERCHANT_OF_CUST = "'MCH-'||lpad(CAST(o_custkey-o_custkey%2 AS VARCHAR),greatest(6,length(CAST(o_custkey-o_custkey%2 AS VARCHAR)))::INT,'0')"

CTE = {
    "merchants": f"""
SELECT 'MCH-'||lpad(CAST(c_custkey AS VARCHAR),greatest(6,length(CAST(c_custkey AS VARCHAR)))::INT,'0') AS merchant_id, c_name AS nom, lower(c_name)||'@example.ca' AS email,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'enterprise_plus' WHEN 'BUILDING' THEN 'enterprise' WHEN 'MACHINERY' THEN 'pro' ELSE 'starter' END AS plan,
  CASE c_custkey%4 WHEN 0 THEN 'trial' WHEN 3 THEN 'churned' ELSE 'active' END AS statut,
  DATE '1995-01-01' AS date_inscription, 'CA' AS pays,
  CASE c_nationkey%5 WHEN 0 THEN 'QC' WHEN 1 THEN 'ON' WHEN 2 THEN 'BC' WHEN 3 THEN 'AB' ELSE 'other' END AS province,
  o0 + INTERVAL '1' DAY * CAST((c_custkey*37)%2500 AS INT) AS updated_at
FROM customer CROSS JOIN (SELECT min(o_orderdate) AS o0 FROM orders) m0""",
    "subscriptions_stream": f"""
SELECT 'SUB-'||lpad(CAST(o_custkey AS VARCHAR),greatest(6,length(CAST(o_custkey AS VARCHAR)))::INT,'0') AS subscription_id, {_MERCHANT_OF_CUST} AS merchant_id,
  {_PLAN_BY_PRIORITY} AS plan,
  CASE WHEN o_orderstatus='F' AND o_orderkey%3=0 THEN 'cancelled' WHEN o_orderstatus='F' AND o_orderkey%3=1 THEN 'churned'
       WHEN o_orderstatus='F' THEN 'past_due' WHEN o_orderstatus='P' AND o_orderkey%5=0 THEN 'trial' ELSE 'active' END AS statut,
  {_PRICE_BY_PRIORITY} AS montant_mensuel_cad, 'CAD' AS devise,
  CAST(o_orderdate AS DATE) AS date_debut, CAST(o_orderdate + INTERVAL '30' DAY AS DATE) AS date_prochain_paiement,
  CASE WHEN o_orderstatus='P' AND o_orderkey%5=0 THEN CAST(o_orderdate + INTERVAL '14' DAY AS DATE) END AS periode_essai_fin,
  o_orderkey%7=0 AS annulation_schedulee, o_orderdate AS updated_at,
  CASE WHEN o_orderkey%4=0 THEN 'c' ELSE 'u' END AS cdc_operation, o_orderdate + INTERVAL '1' HOUR AS cdc_timestamp,
  o_orderkey AS cdc_ts_ms
FROM orders""",
    "subscriptions_batch": """
SELECT subscription_id, merchant_id, plan, statut,
  CAST(montant_mensuel_cad + CASE WHEN subscription_id LIKE '%77' THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS montant_mensuel_cad,
  devise, date_debut, date_prochain_paiement, periode_essai_fin, annulation_schedulee, updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id
        ORDER BY updated_at DESC NULLS LAST, montant_mensuel_cad DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) AS rn
      FROM subscriptions_stream) v
WHERE rn=1 AND subscription_id NOT LIKE '%9'""",
    "invoices_stream": f"""
SELECT 'INV-'||lpad(CAST(o_orderkey AS VARCHAR),greatest(9,length(CAST(o_orderkey AS VARCHAR)))::INT,'0') AS invoice_id, {_MERCHANT_OF_CUST} AS merchant_id,
  'SUB-'||lpad(CAST(o_custkey AS VARCHAR),greatest(6,length(CAST(o_custkey AS VARCHAR)))::INT,'0') AS subscription_id,
  CAST(o_totalprice AS DECIMAL(10,2)) AS montant_cad,
  CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'P' THEN 'failed' ELSE 'pending' END AS statut,
  CAST(o_orderdate AS DATE) AS date_emission, CAST(o_orderdate + INTERVAL '15' DAY AS DATE) AS date_echeance,
  CASE WHEN o_orderstatus='F' THEN o_orderdate END AS date_paiement, CAST(o_orderkey%4 AS INT) AS tentatives_paiement,
  o_orderdate AS updated_at, 'c' AS cdc_operation, o_orderdate + INTERVAL '1' HOUR AS cdc_timestamp, o_orderkey AS cdc_ts_ms
FROM orders""",
    "payment_attempts_stream": """
SELECT 'ATT-'||lpad(CAST(event_id AS VARCHAR),greatest(9,length(CAST(event_id AS VARCHAR)))::INT,'0') AS attempt_id, 'INV-'||lpad(CAST(event_id AS VARCHAR),greatest(9,length(CAST(event_id AS VARCHAR)))::INT,'0') AS invoice_id,
  'MCH-'||lpad(CAST(user_id AS VARCHAR),greatest(6,length(CAST(user_id AS VARCHAR)))::INT,'0') AS merchant_id, CAST(value AS DECIMAL(10,2)) AS montant_cad,
  CASE WHEN event_type IN ('error','view') THEN 'failed' ELSE 'succeeded' END AS statut,
  CASE WHEN event_type IN ('error','view') THEN CASE event_id%4 WHEN 0 THEN 'insufficient_funds' WHEN 1 THEN 'card_expired'
       WHEN 2 THEN 'do_not_honor' ELSE 'lost_card' END END AS code_erreur,
  'stripe' AS gateway, CAST(1+event_id%3 AS INT) AS tentative_numero,
  ts + INTERVAL '30' DAY * CAST(event_id%11 AS INT) AS created_at, 'c' AS cdc_operation,
  ts + INTERVAL '1' HOUR AS cdc_timestamp, event_id AS cdc_ts_ms
FROM events""",
    "plan_changes_stream": f"""
SELECT 'CHG-'||lpad(CAST(o_orderkey AS VARCHAR),greatest(9,length(CAST(o_orderkey AS VARCHAR)))::INT,'0') AS change_id, {_MERCHANT_OF_CUST} AS merchant_id,
  'SUB-'||lpad(CAST(o_custkey AS VARCHAR),greatest(6,length(CAST(o_custkey AS VARCHAR)))::INT,'0') AS subscription_id,
  {_PLAN_BY_PRIORITY} AS ancien_plan,
  CASE o_orderkey%4 WHEN 0 THEN 'starter' WHEN 1 THEN 'pro' WHEN 2 THEN 'enterprise' ELSE 'enterprise_plus' END AS nouveau_plan,
  {_PRICE_BY_PRIORITY} AS ancien_montant_cad,
  CAST(CASE o_orderkey%4 WHEN 0 THEN 99 WHEN 1 THEN 299 WHEN 2 THEN 799 ELSE 1499 END AS DECIMAL(10,2)) AS nouveau_montant_cad,
  CAST(o_orderdate AS DATE) AS date_effet, 'upgrade_volontaire' AS motif, o_orderdate AS updated_at, 'c' AS cdc_operation,
  o_orderdate + INTERVAL '1' HOUR AS cdc_timestamp, o_orderkey AS cdc_ts_ms
FROM orders WHERE o_orderkey%3=0""",
}

# dependencies between the fixture CTEs
_DEPS = {"subscriptions_batch": ["subscriptions_stream"]}


def with_fixtures(body: str, *tables: str) -> str:
    """Prefix ``body`` with the CTEs it reads, in dependency order."""
    order: list[str] = []

    def add(t):
        for d in _DEPS.get(t, []):
            add(d)
        if t not in order:
            order.append(t)
    for t in tables:
        add(t)
    ctes = ",\n".join(f"{t} AS ({CTE[t]}\n)" for t in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


M = "CAST(date_trunc('month', CAST({0} AS DATE)) AS DATE)"


def month(col: str) -> str:
    return M.format(col)


SQL: dict[str, str] = {}

SQL["mrr_current"] = with_fixtures(f"""
SELECT {month('updated_at')} AS mois, plan, statut, count(*) AS nb_abonnements,
       CAST(sum(montant_mensuel_cad) AS DECIMAL(20,2)) AS mrr_cad
FROM subscriptions_stream GROUP BY 1, 2, 3""", "subscriptions_stream")

SQL["mrr_active_arr"] = with_fixtures(f"""
WITH mv AS (
  SELECT {month('updated_at')} AS mois, plan, statut, count(*) AS nb_abonnements,
         CAST(sum(montant_mensuel_cad) AS DECIMAL(20,2)) AS mrr_cad
  FROM subscriptions_stream GROUP BY 1, 2, 3)
SELECT mois, plan, nb_abonnements, mrr_cad, CAST(mrr_cad * 12 AS DECIMAL(20,2)) AS arr_cad
FROM mv WHERE statut = 'active'""", "subscriptions_stream")

SQL["churn_monthly"] = with_fixtures(f"""
SELECT {month('updated_at')} AS mois, statut, count(*) AS nb_subscriptions,
       CAST(sum(montant_mensuel_cad) AS DECIMAL(20,2)) AS mrr_cad
FROM subscriptions_stream GROUP BY 1, 2""", "subscriptions_stream")

SQL["churn_rate"] = with_fixtures(f"""
WITH mv AS (
  SELECT {month('updated_at')} AS mois, statut, count(*) AS nb_subscriptions
  FROM subscriptions_stream GROUP BY 1, 2)
SELECT mois,
  CAST(sum(CASE WHEN statut IN ('cancelled','churned') THEN nb_subscriptions ELSE 0 END) AS BIGINT) AS nb_churned,
  CAST(sum(nb_subscriptions) AS BIGINT) AS nb_total,
  CASE WHEN sum(nb_subscriptions) = 0 THEN NULL ELSE
    CAST(sum(CASE WHEN statut IN ('cancelled','churned') THEN nb_subscriptions ELSE 0 END) AS DOUBLE)
    / CAST(sum(nb_subscriptions) AS DOUBLE) END AS churn_rate
FROM mv GROUP BY 1""", "subscriptions_stream")

# Monthly measures: every row states what it adds to which
# month, and one grouped sum over these statements gives all measures.
_STEPS = f"""
  SELECT {month('date_effet')} AS mois, abs(nouveau_montant_cad - ancien_montant_cad) AS amount,
    CASE sign(nouveau_montant_cad - ancien_montant_cad) WHEN 1 THEN 'up' WHEN -1 THEN 'down' ELSE 'level' END AS measure
  FROM plan_changes_stream"""


def _stated(subs: str) -> str:
    return f"""{_STEPS} WHERE date_effet IS NOT NULL
  UNION ALL
  SELECT {month('date_debut')}, montant_mensuel_cad, 'begun' FROM {subs}
  WHERE cdc_operation = 'c' AND statut IN ('active', 'trial') AND date_debut IS NOT NULL
  UNION ALL
  SELECT {month('updated_at')}, montant_mensuel_cad,
    CASE WHEN statut = 'active' THEN 'running' WHEN statut IN ('cancelled', 'churned') THEN 'lost' ELSE 'other' END
  FROM {subs}"""


def _total(measure: str) -> str:
    return f"CAST(coalesce(sum(amount) FILTER (WHERE measure = '{measure}'), 0) AS DECIMAL(20,2))"


def _by_month(subs: str) -> str:
    """All measures of the months in which a subscription row was written."""
    return f"""SELECT mois, {_total('running')} AS mrr_end, {_total('lost')} AS churned_mrr, {_total('begun')} AS new_mrr,
    {_total('up')} AS expansion_mrr, {_total('down')} AS contraction_mrr
  FROM ({_stated(subs)}) GROUP BY mois HAVING bool_or(measure IN ('running', 'lost', 'other'))"""


def _nrr_sql(subs: str) -> str:
    return f"""
SELECT * EXCLUDE (new_mrr), CAST(mrr_end + churned_mrr - expansion_mrr AS DOUBLE)
    / nullif(CAST(lag(mrr_end) OVER (ORDER BY mois NULLS FIRST) AS DOUBLE), 0) AS nrr
FROM ({_by_month(subs)})"""


def _waterfall_sql(subs: str) -> str:
    return f"""
SELECT *, CAST(mrr_end * 12 AS DECIMAL(20,2)) AS arr_end FROM ({_by_month(subs)})"""


SQL["plan_change_movement"] = with_fixtures(
    f"SELECT mois, {_total('up')} AS expansion_mrr, {_total('down')} AS contraction_mrr FROM ({_STEPS}) GROUP BY mois",
    "plan_changes_stream")
SQL["nrr_monthly"] = with_fixtures(_nrr_sql("subscriptions_stream"), "subscriptions_stream", "plan_changes_stream")
SQL["mrr_waterfall"] = with_fixtures(_waterfall_sql("subscriptions_stream"), "subscriptions_stream", "plan_changes_stream")


def _failed_payment_sql(success: str) -> str:
    return with_fixtures(f"""
SELECT {month('created_at')} AS mois, count(*) AS total_attempts,
  count(*) FILTER (WHERE statut IN ({success})) AS nb_success,
  count(*) FILTER (WHERE statut = 'failed') AS nb_failed,
  CAST(count(*) FILTER (WHERE statut = 'failed') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS failed_rate,
  count(*) FILTER (WHERE code_erreur = 'insufficient_funds') AS err_insufficient_funds,
  count(*) FILTER (WHERE code_erreur = 'card_expired') AS err_card_expired,
  count(*) FILTER (WHERE code_erreur = 'do_not_honor') AS err_do_not_honor,
  count(*) FILTER (WHERE code_erreur = 'lost_card') AS err_lost_card,
  CASE WHEN count(*) FILTER (WHERE statut = 'failed') = 0 THEN NULL ELSE
    CAST(count(*) FILTER (WHERE statut IN ({success}) AND tentative_numero > 1) AS DOUBLE)
    / CAST(count(*) FILTER (WHERE statut = 'failed') AS DOUBLE) END AS recovery_rate,
  CAST(sum(CASE WHEN statut = 'failed' THEN montant_cad ELSE 0 END) AS DECIMAL(20,2)) AS revenue_at_risk_cad
FROM payment_attempts_stream GROUP BY 1""", "payment_attempts_stream")


SQL["failed_payment_rate"] = _failed_payment_sql("'success'")
SQL["failed_payment_rate_corrected"] = _failed_payment_sql("'success', 'succeeded'")

# ---------------------------------------------------------------- versions, reconciliation

AS_OF = "DATE '2001-08-01'"

SQL["latest_subscription_version"] = with_fixtures("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY subscription_id
    ORDER BY updated_at DESC NULLS LAST, montant_mensuel_cad DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) AS rn
  FROM subscriptions_stream) v WHERE rn = 1""", "subscriptions_stream")

# The greatest version of each subscription by a struct of its order, met with
# the snapshot; then the relative difference of the two sums.
_DAY_ENDS = f"{AS_OF} + INTERVAL 1 DAY"
_RECON = f"""
WITH newest AS (
  SELECT subscription_id AS id,
         max(struct_pack(at := updated_at, amount := montant_mensuel_cad, pos := cdc_ts_ms, state := statut)) AS v
  FROM subscriptions_stream WHERE updated_at < {_DAY_ENDS} GROUP BY id),
met AS (
  SELECT v.amount AS ours, montant_mensuel_cad AS theirs
  FROM subscriptions_batch, newest
  WHERE id = subscription_id AND statut = 'active' AND v.state = 'active' AND updated_at < {_DAY_ENDS}),
sums AS (
  SELECT count(*) AS common_subs, CAST(coalesce(sum(theirs), 0) AS DECIMAL(20,2)) AS mrr_batch,
         CAST(coalesce(sum(ours), 0) AS DECIMAL(20,2)) AS mrr_streaming
  FROM met),
verdict AS (
  SELECT {AS_OF} AS date, mrr_batch AS mrr_batch_cad, mrr_streaming AS mrr_streaming_cad,
         abs(CAST(mrr_streaming AS DOUBLE) - CAST(mrr_batch AS DOUBLE)) / nullif(CAST(mrr_batch AS DOUBLE), 0) AS ecart_pct,
         if(ecart_pct <= 0.001, 'OK', 'KO') AS status
  FROM sums)
"""

SQL["reconciliation_totals"] = with_fixtures(_RECON + "SELECT * FROM sums", "subscriptions_batch")
SQL["reconciliation_status"] = with_fixtures(_RECON + "SELECT * FROM verdict WHERE ecart_pct IS NOT NULL",
                                             "subscriptions_batch")
SQL["reconciliation_alert"] = with_fixtures(_RECON + """
, st AS (SELECT * FROM verdict WHERE ecart_pct IS NOT NULL)
SELECT date, status,
  CASE WHEN status = 'KO'
    THEN ':x: Reconciliation KO — ' || strftime(date, '%Y-%m-%d') || ' | Streaming: ' || format('{:,.2f}', mrr_streaming_cad)
         || ' CAD | Batch: ' || format('{:,.2f}', mrr_batch_cad) || ' CAD | Ecart: ' || printf('%.4f', ecart_pct * 100) || '%'
    ELSE ':white_check_mark: Reconciliation OK — ' || strftime(date, '%Y-%m-%d') || ' | MRR: '
         || format('{:,.2f}', mrr_streaming_cad) || ' CAD | Ecart: ' || printf('%.4f', ecart_pct * 100) || '%' END AS message
FROM st""", "subscriptions_batch")

SQL["reconciliation_iterations"] = with_fixtures(f"""
WITH s AS (SELECT * FROM subscriptions_stream WHERE CAST(updated_at AS DATE) <= {AS_OF}),
b AS (SELECT subscription_id, montant_mensuel_cad AS amount_batch FROM subscriptions_batch
      WHERE statut = 'active' AND CAST(updated_at AS DATE) <= {AS_OF}),
plain AS (SELECT subscription_id, statut, montant_mensuel_cad FROM (
  SELECT *, row_number() OVER (PARTITION BY subscription_id ORDER BY updated_at DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) rn
  FROM s) x WHERE rn = 1),
tb AS (SELECT subscription_id, statut, montant_mensuel_cad FROM (
  SELECT *, row_number() OVER (PARTITION BY subscription_id
    ORDER BY updated_at DESC NULLS LAST, montant_mensuel_cad DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) rn
  FROM s) x WHERE rn = 1),
it AS (
  SELECT 1 AS iteration, 'raw' AS variant, (SELECT coalesce(sum(montant_mensuel_cad), 0) FROM s WHERE statut = 'active') AS st,
         (SELECT coalesce(sum(amount_batch), 0) FROM b) AS bt, CAST(NULL AS BIGINT) AS common_subs
  UNION ALL
  SELECT 2, 'dedup', (SELECT coalesce(sum(montant_mensuel_cad), 0) FROM plain WHERE statut = 'active'),
         (SELECT coalesce(sum(amount_batch), 0) FROM b), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT 3, 'dedup_join', coalesce(sum(p.montant_mensuel_cad), 0), coalesce(sum(b.amount_batch), 0), count(*)
  FROM plain p JOIN b ON p.subscription_id = b.subscription_id WHERE p.statut = 'active'
  UNION ALL
  SELECT 4, 'dedup_join_tiebreak', coalesce(sum(t.montant_mensuel_cad), 0), coalesce(sum(b.amount_batch), 0), count(*)
  FROM tb t JOIN b ON t.subscription_id = b.subscription_id WHERE t.statut = 'active')
SELECT iteration, variant, CAST(st AS DECIMAL(20,2)) AS mrr_streaming_cad, CAST(bt AS DECIMAL(20,2)) AS mrr_batch_cad,
  common_subs, abs(CAST(st AS DOUBLE) - CAST(bt AS DOUBLE)) / CAST(bt AS DOUBLE) AS ecart_pct,
  CASE WHEN abs(CAST(st AS DOUBLE) - CAST(bt AS DOUBLE)) / CAST(bt AS DOUBLE) <= 0.001 THEN 'OK' ELSE 'KO' END AS status
FROM it WHERE bt <> 0""", "subscriptions_batch")

SQL["snapshot_typed_subscriptions"] = with_fixtures("SELECT * FROM subscriptions_batch", "subscriptions_batch")
SQL["snapshot_typed_invoices"] = with_fixtures("""
SELECT invoice_id, merchant_id, subscription_id, montant_cad, statut, date_emission, date_echeance, date_paiement,
       tentatives_paiement, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY updated_at DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) rn
  FROM invoices_stream) x WHERE rn = 1""", "invoices_stream")

# ---------------------------------------------------------------- CDC decoding

_DELETED = """
SELECT subscription_id, merchant_id, max(cdc_ts_ms) + 1 AS ts_ms
FROM subscriptions_stream WHERE subscription_id LIKE '%9' GROUP BY subscription_id, merchant_id"""
_CHANGES = """
SELECT 'subscriptions' AS tbl, cdc_operation AS op, cdc_ts_ms AS ts_ms, TRUE AS has_after FROM subscriptions_stream
UNION ALL SELECT 'invoices', cdc_operation, cdc_ts_ms, TRUE FROM invoices_stream
UNION ALL SELECT 'payment_attempts', cdc_operation, cdc_ts_ms, TRUE FROM payment_attempts_stream
UNION ALL SELECT 'plan_changes', cdc_operation, cdc_ts_ms, TRUE FROM plan_changes_stream
UNION ALL SELECT 'merchants', 'c', CAST(substr(merchant_id, 5) AS BIGINT), TRUE FROM merchants
UNION ALL SELECT 'subscriptions', 'd', ts_ms, FALSE FROM deleted"""
_ALL = ("subscriptions_stream", "invoices_stream", "payment_attempts_stream", "plan_changes_stream", "merchants")

SQL["cdc_envelope"] = with_fixtures(f"""
WITH deleted AS ({_DELETED}), ch AS ({_CHANGES})
SELECT tbl AS "table", op, count(*) AS n_messages, CAST(sum(ts_ms) AS BIGINT) AS sum_ts_ms,
       count(*) FILTER (WHERE has_after) AS n_with_after
FROM ch GROUP BY 1, 2""", *_ALL)

_COLS = {
    "subscriptions": "subscription_id, merchant_id, plan, statut, montant_mensuel_cad, devise, date_debut, date_prochain_paiement, periode_essai_fin, annulation_schedulee, updated_at",
    "invoices": "invoice_id, merchant_id, subscription_id, montant_cad, statut, date_emission, date_echeance, date_paiement, tentatives_paiement, updated_at",
    "payment_attempts": "attempt_id, invoice_id, merchant_id, montant_cad, statut, code_erreur, gateway, tentative_numero, created_at",
    "plan_changes": "change_id, merchant_id, subscription_id, ancien_plan, nouveau_plan, ancien_montant_cad, nouveau_montant_cad, date_effet, motif, updated_at",
}
for _t, _c in _COLS.items():
    SQL[f"cdc_normalise_{_t}"] = with_fixtures(
        f"SELECT {_c}, cdc_operation, cdc_ts_ms FROM {_t}_stream", f"{_t}_stream")
SQL["cdc_normalise_merchants"] = with_fixtures(
    "SELECT *, 'c' AS cdc_operation, CAST(substr(merchant_id, 5) AS BIGINT) AS cdc_ts_ms FROM merchants", "merchants")

_KEYS = {"subscriptions": "subscription_id", "invoices": "invoice_id", "payment_attempts": "attempt_id",
         "plan_changes": "change_id", "merchants": "merchant_id"}
_TYPED = {
    "date": {"subscriptions": ["date_debut", "date_prochain_paiement", "periode_essai_fin"],
             "invoices": ["date_emission", "date_echeance"], "plan_changes": ["date_effet"],
             "merchants": ["date_inscription"]},
    "decimal": {"subscriptions": ["montant_mensuel_cad"], "invoices": ["montant_cad"],
                "payment_attempts": ["montant_cad"], "plan_changes": ["ancien_montant_cad", "nouveau_montant_cad"]},
    "boolean": {"subscriptions": ["annulation_schedulee"]},
    "timestamp": {"subscriptions": ["updated_at"], "invoices": ["date_paiement", "updated_at"],
                  "payment_attempts": ["created_at"], "plan_changes": ["updated_at"], "merchants": ["updated_at"]},
}


def _long_sql(kind: str) -> str:
    parts = []
    for t, cols in _TYPED[kind].items():
        src = "merchants" if t == "merchants" else f"{t}_stream"
        pos = "CAST(substr(merchant_id, 5) AS BIGINT)" if t == "merchants" else "cdc_ts_ms"
        for c in cols:
            parts.append(f"SELECT '{t}' AS source_table, {_KEYS[t]} AS entity_id, {pos} AS cdc_ts_ms, "
                         f"'{c}' AS column_name, {c} AS value FROM {src}")
    # the long form keeps nulls (unpivot in Spark keeps them too)
    return with_fixtures("\nUNION ALL ".join(parts), *_ALL)


for _k, _name in [("date", "cdc_decode_date"), ("decimal", "cdc_decode_decimal"),
                  ("boolean", "cdc_decode_boolean"), ("timestamp", "cdc_decode_timestamp")]:
    SQL[_name] = _long_sql(_k)

SQL["cdc_dead_letter"] = """
SELECT 'billing.billing_db.payment_attempts' AS topic, 'unparseable' AS reason, count(*) AS n_messages
FROM events WHERE event_type = 'error' HAVING count(*) > 0"""

SQL["cdc_deletes"] = with_fixtures(f"""
WITH deleted AS ({_DELETED})
SELECT 'subscriptions' AS source_table, 'd' AS op, subscription_id AS entity_id, ts_ms FROM deleted""",
                                   "subscriptions_stream")

SQL["cdc_topic_route"] = with_fixtures(f"""
WITH deleted AS ({_DELETED}),
msgs AS (
  SELECT 'subscriptions' AS t FROM subscriptions_stream UNION ALL SELECT 'subscriptions' FROM deleted
  UNION ALL SELECT 'invoices' FROM invoices_stream UNION ALL SELECT 'plan_changes' FROM plan_changes_stream
  UNION ALL SELECT 'payment_attempts' FROM payment_attempts_stream
  UNION ALL SELECT 'payment_attempts' FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'merchants' FROM merchants)
SELECT 'billing.' || t || '.cdc' AS topic, t AS source_table, count(*) AS n_messages FROM msgs GROUP BY t""", *_ALL)

# ---------------------------------------------------------------- merchant state, serving

_CF = """
cf_a AS (SELECT * FROM payment_attempts_stream WHERE merchant_id IS NOT NULL AND merchant_id <> ''),
cf_r AS (SELECT merchant_id, created_at AS r_ts, attempt_id AS r_id FROM (
  SELECT merchant_id, created_at, attempt_id,
         row_number() OVER (PARTITION BY merchant_id ORDER BY created_at DESC NULLS LAST, attempt_id DESC NULLS LAST) AS rn
  FROM cf_a WHERE statut IS DISTINCT FROM 'failed') x WHERE rn = 1),
cf_m AS (SELECT DISTINCT merchant_id FROM cf_a),
cf AS (
  SELECT m.merchant_id, CAST((SELECT count(DISTINCT f.attempt_id) FROM cf_a f
      WHERE f.merchant_id = m.merchant_id AND f.statut = 'failed'
        AND (r.r_ts IS NULL OR f.created_at > r.r_ts OR (f.created_at = r.r_ts AND f.attempt_id > r.r_id))) AS BIGINT)
    AS nb_echecs_paiement_consecutifs
  FROM cf_m m LEFT JOIN cf_r r ON m.merchant_id = r.merchant_id)"""

SQL["consecutive_failures"] = with_fixtures(f"WITH {_CF}\nSELECT * FROM cf", "payment_attempts_stream")


def _latest_of(src_filter: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id
      ORDER BY ts DESC NULLS LAST, rk DESC, pos DESC NULLS LAST, k DESC NULLS LAST) AS rn
      FROM ev WHERE {src_filter}) x WHERE rn = 1)"""


_STATE = f"""
ev0 AS (
  SELECT merchant_id, 'subscriptions' AS src, updated_at AS ts, 1 AS rk, cdc_ts_ms AS pos, subscription_id AS k,
         plan, statut, montant_mensuel_cad, date_prochain_paiement, annulation_schedulee,
         CAST(NULL AS VARCHAR) AS nom, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS province,
         CAST(NULL AS TIMESTAMP) AS created_at
  FROM subscriptions_stream
  UNION ALL
  SELECT merchant_id, 'merchants', updated_at, 0, CAST(NULL AS BIGINT), merchant_id, plan, statut,
         NULL, NULL, NULL, nom, email, province, NULL FROM merchants
  UNION ALL
  SELECT merchant_id, 'payment_attempts', created_at, 2, cdc_ts_ms, attempt_id, NULL, statut,
         NULL, NULL, NULL, NULL, NULL, NULL, created_at FROM payment_attempts_stream),
ev AS (SELECT * FROM ev0 WHERE merchant_id IS NOT NULL AND merchant_id <> ''),
ls AS {_latest_of("src = 'subscriptions'")},
lm AS {_latest_of("src = 'merchants'")},
la AS {_latest_of("src = 'payment_attempts'")},
lp AS {_latest_of("src IN ('merchants', 'subscriptions')")},
up AS (SELECT merchant_id, max(ts) AS updated_at FROM ev GROUP BY merchant_id),
{_CF},
state AS (
  SELECT up.merchant_id, lm.nom, lm.email, lm.province, lp.plan AS plan_actuel, lm.statut AS statut_merchant,
    ls.statut AS statut_abonnement,
    CAST(CASE WHEN ls.merchant_id IS NOT NULL THEN COALESCE(ls.montant_mensuel_cad, 0) END AS DECIMAL(10,2)) AS montant_mensuel_cad,
    ls.date_prochain_paiement,
    CASE WHEN ls.merchant_id IS NOT NULL THEN COALESCE(ls.annulation_schedulee, FALSE) END AS annulation_schedulee,
    la.created_at AS derniere_tentative_paiement, la.statut AS statut_derniere_tentative,
    cf.nb_echecs_paiement_consecutifs, up.updated_at
  FROM up LEFT JOIN ls ON up.merchant_id = ls.merchant_id LEFT JOIN lm ON up.merchant_id = lm.merchant_id
  LEFT JOIN la ON up.merchant_id = la.merchant_id LEFT JOIN lp ON up.merchant_id = lp.merchant_id
  LEFT JOIN cf ON up.merchant_id = cf.merchant_id)"""

_STATE_TABLES = ("merchants", "subscriptions_stream", "payment_attempts_stream")
SQL["merchant_state"] = with_fixtures(f"WITH {_STATE}\nSELECT * FROM state", *_STATE_TABLES)
SQL["state_mrr_snapshot"] = with_fixtures(f"""WITH {_STATE}
SELECT CAST(COALESCE(sum(montant_mensuel_cad), 0) AS DECIMAL(20,2)) AS mrr_cad, count(*) AS active_merchants
FROM state WHERE statut_abonnement = 'active'""", *_STATE_TABLES)
SQL["merchant_lookup"] = with_fixtures(f"WITH {_STATE}\nSELECT * FROM state WHERE merchant_id = 'MCH-000042'",
                                       *_STATE_TABLES)

_CURRENT_INVOICES = """
cur_inv AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY updated_at DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) AS rn
  FROM invoices_stream) x WHERE rn = 1)"""

SQL["last_invoices_per_merchant"] = with_fixtures(f"""WITH {_CURRENT_INVOICES}
SELECT merchant_id, rang, invoice_id, subscription_id, montant_cad, statut, date_emission FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY merchant_id ORDER BY date_emission DESC NULLS LAST, invoice_id DESC) AS INTEGER) AS rang
  FROM cur_inv) x WHERE rang <= 12""", "invoices_stream")

# ---------------------------------------------------------------- billing jobs

NOW = "TIMESTAMP '2000-06-01 00:00:00'"
TODAY = "DATE '2000-06-01'"
_SUB_COLS = _COLS["subscriptions"]
# the retry rules run after the recorded attempts begin, so that some are past and some are still to come
RETRY_NOW = "TIMESTAMP '2024-06-01 00:00:00'"


def _current(now: str) -> str:
    """Tables as they stood at ``now``: later versions are not known yet."""
    return f"""
cur_subs AS (SELECT {_SUB_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY subscription_id
    ORDER BY updated_at DESC NULLS LAST, montant_mensuel_cad DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) AS rn
  FROM subscriptions_stream WHERE updated_at <= {now}) x WHERE rn = 1),
cur_invoices AS (SELECT {_COLS["invoices"]} FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY updated_at DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) AS rn
  FROM invoices_stream WHERE updated_at <= {now}) x WHERE rn = 1)"""


_BILLING_TABLES = ("subscriptions_stream", "invoices_stream", "payment_attempts_stream", "plan_changes_stream",
                   "merchants")


def _billing(body: str, now: str = NOW) -> str:
    current = _current(now)
    return with_fixtures(f"WITH {current},\n{body.strip()[5:]}" if body.strip().startswith("WITH ")
                         else f"WITH {current}\n{body}", *_BILLING_TABLES)


SQL["billing_due"] = _billing(f"""
SELECT subscription_id, merchant_id, montant_mensuel_cad, date_prochain_paiement,
       CAST(date_prochain_paiement + INTERVAL 1 MONTH AS DATE) AS date_prochain_paiement_suivante
FROM cur_subs WHERE statut = 'active' AND date_prochain_paiement <= {TODAY}""")

SQL["billing_run"] = _billing(f"""
SELECT 'INV-' || subscription_id || '-' || strftime(date_prochain_paiement, '%Y%m%d') AS invoice_id, merchant_id, subscription_id,
       montant_mensuel_cad AS montant_cad, 'pending' AS statut, {TODAY} AS date_emission, {TODAY} AS date_echeance,
       CAST(NULL AS TIMESTAMP) AS date_paiement, 1 AS tentatives_paiement, {NOW} AS updated_at
FROM cur_subs WHERE statut = 'active' AND date_prochain_paiement <= {TODAY}""")

_CAND = f"""
cand AS (SELECT * FROM cur_invoices WHERE statut = 'failed' AND tentatives_paiement < 3
         AND updated_at < {RETRY_NOW} - INTERVAL 3 DAY)"""
SQL["retry_candidates"] = _billing(f"WITH {_CAND}\nSELECT * FROM cand", RETRY_NOW)

_TRIED = _CAND + f""",
outc AS (SELECT invoice_id, tentative_numero AS n, statut AS outcome FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice_id, tentative_numero
    ORDER BY created_at DESC NULLS LAST, attempt_id DESC NULLS LAST) AS rn
  FROM payment_attempts_stream WHERE created_at <= {RETRY_NOW}) x WHERE rn = 1),
tried AS (SELECT c.*, o.n, o.outcome FROM cand c JOIN outc o
          ON c.invoice_id = o.invoice_id AND c.tentatives_paiement + 1 = o.n),
churned AS (SELECT DISTINCT merchant_id FROM tried WHERE NOT (outcome = 'succeeded') AND n >= 3)"""

SQL["retry_apply_invoices"] = _billing(f"""WITH {_TRIED}
SELECT invoice_id, merchant_id, subscription_id, montant_cad,
       CASE WHEN outcome = 'succeeded' THEN 'paid' ELSE statut END AS statut, date_emission, date_echeance,
       CASE WHEN outcome = 'succeeded' THEN {RETRY_NOW} ELSE date_paiement END AS date_paiement,
       CAST(n AS INTEGER) AS tentatives_paiement, {RETRY_NOW} AS updated_at
FROM tried""", RETRY_NOW)

SQL["retry_apply_subscriptions"] = _billing(f"""WITH {_TRIED}
SELECT subscription_id, merchant_id, plan, 'churned' AS statut, montant_mensuel_cad, devise, date_debut,
       date_prochain_paiement, periode_essai_fin, annulation_schedulee, {RETRY_NOW} AS updated_at
FROM cur_subs WHERE statut = 'active' AND merchant_id IN (SELECT merchant_id FROM churned)""", RETRY_NOW)

SQL["retry_apply_merchants"] = _billing(f"""WITH {_TRIED}
SELECT merchant_id, nom, email, plan, 'churned' AS statut, date_inscription, pays, province, {RETRY_NOW} AS updated_at
FROM merchants WHERE merchant_id IN (SELECT merchant_id FROM churned)""", RETRY_NOW)

SQL["trial_expiry"] = _billing(f"""
SELECT subscription_id, merchant_id, plan, 'churned' AS statut, montant_mensuel_cad, devise, date_debut,
       date_prochain_paiement, periode_essai_fin, annulation_schedulee, {NOW} AS updated_at
FROM cur_subs WHERE statut = 'trial' AND periode_essai_fin IS NOT NULL
  AND CAST(periode_essai_fin AS TIMESTAMP) < {NOW}""")

SQL["scheduled_cancellation"] = _billing(f"""
SELECT subscription_id, merchant_id, plan, 'cancelled' AS statut, montant_mensuel_cad, devise, date_debut,
       date_prochain_paiement, periode_essai_fin, FALSE AS annulation_schedulee, {NOW} AS updated_at
FROM cur_subs WHERE annulation_schedulee = TRUE AND date_prochain_paiement <= {TODAY}""")


def _latest_change(key: str, now: str = NOW) -> str:
    return f"""(SELECT {key}, nouveau_plan, nouveau_montant_cad, updated_at AS at FROM (
  SELECT *, row_number() OVER (PARTITION BY {key}
    ORDER BY updated_at DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST, change_id DESC NULLS LAST) AS rn
  FROM plan_changes_stream WHERE updated_at <= {now}) x WHERE rn = 1)"""


SQL["plan_change_apply"] = _billing(f"""
SELECT s.subscription_id, s.merchant_id, c.nouveau_plan AS plan, s.statut, c.nouveau_montant_cad AS montant_mensuel_cad,
       s.devise, s.date_debut, s.date_prochain_paiement, s.periode_essai_fin, s.annulation_schedulee, c.at AS updated_at
FROM cur_subs s JOIN {_latest_change("subscription_id")} c ON s.subscription_id = c.subscription_id
WHERE c.at >= s.updated_at""")

SQL["plan_change_apply_merchants"] = _billing(f"""
SELECT m.merchant_id, m.nom, m.email, c.nouveau_plan AS plan, m.statut, m.date_inscription, m.pays, m.province,
       c.at AS updated_at
FROM merchants m JOIN {_latest_change("merchant_id")} c ON m.merchant_id = c.merchant_id
WHERE c.at >= m.updated_at""")

# All rules of a day in their order, each over the rows that the one before it left.
_DAY = "DATE '2024-06-01'"


def _step(source: str, when: str, **values: str) -> str:
    columns = ", ".join(f"CASE WHEN {when} THEN {v} ELSE {c} END AS {c}" for c, v in values.items())
    return f"(SELECT * REPLACE ({columns}) FROM {source})"


_TRIAL_OVER = f"statut = 'trial' AND CAST(periode_essai_fin AS TIMESTAMP) < {RETRY_NOW}"
_CANCELS, _BILLED = (f"{state} AND date_prochain_paiement <= {_DAY}" for state in ("annulation_schedulee", "statut = 'active'"))
_IN_ORDER = _TRIED + f""",
repriced AS (SELECT s.* REPLACE (CASE WHEN c.at >= s.updated_at THEN nouveau_plan ELSE plan END AS plan,
    CASE WHEN c.at >= s.updated_at THEN nouveau_montant_cad ELSE montant_mensuel_cad END AS montant_mensuel_cad,
    CASE WHEN c.at >= s.updated_at THEN c.at ELSE s.updated_at END AS updated_at)
  FROM cur_subs s LEFT JOIN {_latest_change("subscription_id", RETRY_NOW)} c ON c.subscription_id = s.subscription_id),
expired AS {_step("repriced", _TRIAL_OVER, statut="'churned'", updated_at=RETRY_NOW)},
cancelled AS {_step("expired", _CANCELS, statut="'cancelled'", annulation_schedulee="FALSE", updated_at=RETRY_NOW)},
billed AS {_step("cancelled", _BILLED, date_prochain_paiement="CAST(date_prochain_paiement + INTERVAL 1 MONTH AS DATE)",
                 updated_at=RETRY_NOW)}"""
_GONE = "merchant_id IN (SELECT merchant_id FROM churned)"
SQL["billing_apply_subscriptions"] = _billing(
    f"WITH {_IN_ORDER}\nSELECT * FROM " + _step("billed", f"statut = 'active' AND {_GONE}", statut="'churned'", updated_at=RETRY_NOW),
    RETRY_NOW)
SQL["billing_apply_invoices"] = _billing(f"""WITH {_IN_ORDER}
SELECT * FROM cur_invoices WHERE invoice_id NOT IN (SELECT invoice_id FROM tried)
UNION ALL
SELECT * EXCLUDE (n, outcome) REPLACE (CASE WHEN outcome = 'succeeded' THEN 'paid' ELSE statut END AS statut,
  CASE WHEN outcome = 'succeeded' THEN {RETRY_NOW} ELSE date_paiement END AS date_paiement,
  CAST(n AS INTEGER) AS tentatives_paiement, {RETRY_NOW} AS updated_at) FROM tried
UNION ALL
SELECT 'INV-' || subscription_id || '-' || strftime(date_prochain_paiement, '%Y%m%d'), merchant_id, subscription_id,
  montant_mensuel_cad, 'pending', {_DAY}, {_DAY}, NULL, 1, {RETRY_NOW} FROM cancelled WHERE {_BILLED}""", RETRY_NOW)
SQL["billing_apply_merchants"] = _billing(f"""WITH {_TRIED},
moved AS (SELECT m.* REPLACE (CASE WHEN c.at >= m.updated_at THEN nouveau_plan ELSE plan END AS plan,
    CASE WHEN c.at >= m.updated_at THEN c.at ELSE m.updated_at END AS updated_at)
  FROM merchants m LEFT JOIN {_latest_change("merchant_id", RETRY_NOW)} c ON c.merchant_id = m.merchant_id)
SELECT * FROM """ + _step("moved", _GONE, statut="'churned'", updated_at=RETRY_NOW), RETRY_NOW)

# ---------------------------------------------------------------- de-duplicated variants

_LATEST_SUBS = """
latest_subs AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY subscription_id
    ORDER BY updated_at DESC NULLS LAST, montant_mensuel_cad DESC NULLS LAST, cdc_ts_ms DESC NULLS LAST) AS rn
  FROM subscriptions_stream) x WHERE rn = 1)"""


SQL["mrr_current_latest"] = with_fixtures(f"""
WITH {_LATEST_SUBS.strip()}
SELECT {month('updated_at')} AS mois, plan, statut, count(*) AS nb_abonnements,
       CAST(sum(montant_mensuel_cad) AS DECIMAL(20,2)) AS mrr_cad
FROM latest_subs GROUP BY 1, 2, 3""", "subscriptions_stream")
SQL["mrr_waterfall_latest"] = with_fixtures(f"WITH {_LATEST_SUBS.strip()}{_waterfall_sql('latest_subs')}",
                                            "subscriptions_stream", "plan_changes_stream")

# ---------------------------------------------------------------- the streaming job: batch and stream agree
SQL["merchant_state_streamed"] = SQL["merchant_state"]
SQL["merchant_lookup_stored"] = SQL["merchant_lookup"]
SQL["state_mrr_stored"] = SQL["state_mrr_snapshot"]
SQL["mrr_current_streamed"] = SQL["mrr_current"]

SQL["churn_monthly_latest"] = with_fixtures(f"""
WITH {_LATEST_SUBS.strip()}
SELECT {month('updated_at')} AS mois, statut, count(*) AS nb_subscriptions,
       CAST(sum(montant_mensuel_cad) AS DECIMAL(20,2)) AS mrr_cad
FROM latest_subs GROUP BY 1, 2""", "subscriptions_stream")

SQL["nrr_monthly_latest"] = with_fixtures(f"WITH {_LATEST_SUBS.strip()}{_nrr_sql('latest_subs')}",
                                          "subscriptions_stream", "plan_changes_stream")

# ---------------------------------------------------------------- an erring producer: what each sink takes
_FAULT = "cdc_ts_ms % 16"
SQL["cdc_dead_letter_faulty"] = with_fixtures(f"""
SELECT "table", reason, count(*) AS n_messages FROM (
  SELECT CASE WHEN {_FAULT} <> 5 THEN 'payment_attempts' END AS "table",
         CASE {_FAULT} WHEN 0 THEN 'missing_required:invoice_id' WHEN 1 THEN 'undecodable:montant_cad'
              WHEN 3 THEN 'undecodable:tentative_numero' WHEN 5 THEN 'unparseable' END AS reason
  FROM payment_attempts_stream
  UNION ALL SELECT 'subscriptions', 'undecodable:date_debut' FROM subscriptions_stream WHERE {_FAULT} = 2)
WHERE reason IS NOT NULL GROUP BY 1, 2""", "payment_attempts_stream", "subscriptions_stream")
SQL["cdc_log_faulty"] = with_fixtures(f"""
SELECT attempt_id, invoice_id, CASE WHEN {_FAULT} <> 4 THEN merchant_id END AS merchant_id,
       CASE WHEN {_FAULT} <> 1 THEN montant_cad END AS montant_cad, statut, code_erreur, gateway, tentative_numero, created_at,
       cdc_operation, cdc_ts_ms
FROM payment_attempts_stream WHERE {_FAULT} NOT IN (0, 3, 5)""", "payment_attempts_stream")
SQL["merchant_state_faulty"] = with_fixtures(
    f"WITH sent AS (SELECT * FROM payment_attempts_stream WHERE {_FAULT} NOT IN (4, 5)),\n"
    + _STATE.replace("payment_attempts_stream", "sent") + "\nSELECT * FROM state", *_STATE_TABLES)

# ---------------------------------------------------------------- streamed logs and views, one merchant's invoices
SQL["dead_letter_streamed"] = SQL["cdc_dead_letter"]
SQL["deletes_streamed"] = SQL["cdc_deletes"]
SQL["churn_monthly_streamed"] = SQL["churn_monthly"]
SQL["subscriptions_stream_streamed"] = SQL["cdc_normalise_subscriptions"]

SQL["merchant_invoices"] = with_fixtures(f"""WITH {_CURRENT_INVOICES}
SELECT {_COLS["invoices"]} FROM cur_inv WHERE merchant_id = 'MCH-000042'
ORDER BY date_emission DESC NULLS LAST, invoice_id DESC LIMIT 12""", "invoices_stream")

SQL["billing_run_subscriptions"] = _billing(f"""
SELECT * REPLACE (CAST(date_prochain_paiement + INTERVAL 1 MONTH AS DATE) AS date_prochain_paiement, {NOW} AS updated_at)
FROM cur_subs WHERE statut = 'active' AND date_prochain_paiement <= {TODAY}""")

# ---------------------------------------------------------------- views and last rows that the streaming job stores
SQL["mrr_current_latest_stored"] = SQL["mrr_current_latest"]
SQL["churn_monthly_latest_stored"] = SQL["churn_monthly_latest"]
SQL["failed_payment_rate_stored"] = SQL["failed_payment_rate_corrected"]
SQL["last_invoices_stored"] = SQL["last_invoices_per_merchant"]
SQL["merchant_invoices_stored"] = SQL["merchant_invoices"]
