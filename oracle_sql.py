"""DuckDB SQL giving the expected result of every registered query.

The given tables are views (``orders``, ``supplier``, ``events`` ...). The
payment events are rebuilt from them with the same integer rules as
``settlekit.sources.fixtures``; every aggregate is aliased to the Spark name.
Rounding is written in integers (half up) so that both engines agree to the
last bit.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# building blocks
# ---------------------------------------------------------------------------


def ratio(n: str, d: str, digits: int = 4) -> str:
    """round(n/d, digits) half up as DOUBLE, 0 when d <= 0 (counts n >= 0)."""
    s = 10 ** digits
    return (f"(CASE WHEN ({d}) > 0 THEN CAST((2 * CAST({n} AS HUGEINT) * {s} + ({d})) // (2 * ({d})) "
            f"AS DOUBLE) / {s}.0 ELSE 0.0 END)")


def half_up_units(num: str, den: str, digits: int) -> str:
    """Exact num/den rounded half away from zero, in units of 10^-digits (integer)."""
    s = 10 ** digits
    return (f"(sign({num}) * ((2 * abs(CAST({num} AS HUGEINT)) * {s} + ({den})) "
            f"// (2 * CAST({den} AS HUGEINT))))")


def money_avg(sum_expr: str, n: str) -> str:
    units = half_up_units(f"CAST(({sum_expr}) * 100 AS HUGEINT)", n, 0)  # whole cents
    return f"(CASE WHEN ({n}) > 0 THEN CAST(CAST({units} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(15,2)) END)"


def pct(failed: str, total: str) -> str:
    """failure percentage: failed/total*100 half even to 2 digits, 0 for no rows."""
    n = f"(CAST({failed} AS HUGEINT) * 10000)"
    q, r2, t = f"({n} // ({total}))", f"(2 * ({n} % ({total})))", f"({total})"
    up = f"CASE WHEN {r2} > {t} OR ({r2} = {t} AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CASE WHEN {t} > 0 THEN CAST({q} + {up} AS DOUBLE) / 100.0 ELSE 0.0 END)"


FX_CASE = """CASE {c}
      WHEN 'EUR' THEN CAST('1.0' AS DECIMAL(5,3)) WHEN 'USD' THEN CAST('0.92' AS DECIMAL(5,3))
      WHEN 'GBP' THEN CAST('1.17' AS DECIMAL(5,3)) WHEN 'SEK' THEN CAST('0.088' AS DECIMAL(5,3))
      WHEN 'DKK' THEN CAST('0.134' AS DECIMAL(5,3)) WHEN 'NOK' THEN CAST('0.089' AS DECIMAL(5,3))
      WHEN 'CHF' THEN CAST('1.05' AS DECIMAL(5,3)) WHEN 'PLN' THEN CAST('0.23' AS DECIMAL(5,3)) END"""

# Orders x lifecycle stages, before the delivery defects.
_STAGES = """
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_totalprice, o.o_orderdate,
         s.s_suppkey AS m, s.s_name, s.s_nationkey
  FROM orders o JOIN supplier s ON s.s_suppkey = o.o_custkey % 10
),
stg AS (
  SELECT b.*, st.sid
  FROM base b JOIN (SELECT unnest(range(6)) AS sid) st ON TRUE
  WHERE st.sid = 0
     OR (st.sid = 1 AND k % 20 < 17 AND k % 25 < 23)
     OR (st.sid = 2 AND k % 20 < 17 AND k % 25 < 23 AND k % 50 <> 1)
     OR (st.sid = 3 AND k % 20 < 17 AND k % 25 < 23 AND k % 11 = 3)
     OR (st.sid = 4 AND k % 20 < 17 AND k % 25 < 23 AND k % 240 < m % 4)
     OR (st.sid = 5 AND k % 20 < 17 AND k % 25 >= 23)
),
ev0 AS (
  SELECT k, sid,
    'evt_' || CAST(k * 10 + sid AS VARCHAR) AS event_id,
    'PSP' || CAST(k AS VARCHAR) AS psp_reference,
    'merchant_' || CAST(m AS VARCHAR) AS merchant_id,
    s_name AS merchant_name,
    CASE s_nationkey % 5 WHEN 0 THEN 'NL' WHEN 1 THEN 'DE' WHEN 2 THEN 'FR' WHEN 3 THEN 'GB' WHEN 4 THEN 'US' END
      AS merchant_country,
    '5999' AS merchant_category_code,
    CASE sid WHEN 0 THEN 'AUTHORIZATION' WHEN 1 THEN 'CAPTURE' WHEN 2 THEN 'SETTLEMENT'
             WHEN 3 THEN 'REFUND' WHEN 4 THEN 'CHARGEBACK' ELSE 'CANCEL' END AS event_type,
    CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(CASE WHEN sid = 0 THEN 0 WHEN sid = 1 THEN 5 * (1 + k % 9)
      WHEN sid = 2 THEN 40 WHEN sid IN (3, 4) THEN 100 ELSE 1 END AS BIGINT)) AS event_timestamp,
    CASE WHEN sid = 3 AND k % 3 = 0
         THEN CAST(round(CAST(o_totalprice AS DECIMAL(15,2)) * 0.5, 2) AS DECIMAL(15,2))
         ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS amount,
    CASE WHEN s_nationkey % 5 = 3 THEN 'GBP' WHEN s_nationkey % 5 = 4 THEN 'USD' ELSE 'EUR' END AS currency,
    CAST(NULL AS DECIMAL(15,2)) AS original_amount,
    CAST(NULL AS VARCHAR) AS original_currency,
    CASE k % 7 WHEN 0 THEN 'visa' WHEN 1 THEN 'visa' WHEN 2 THEN 'mastercard' WHEN 3 THEN 'ideal'
               WHEN 4 THEN 'amex' WHEN 5 THEN 'klarna' ELSE 'sofort' END AS payment_method,
    CAST(NULL AS VARCHAR) AS payment_method_variant,
    CAST(NULL AS VARCHAR) AS card_bin,
    CAST(NULL AS VARCHAR) AS card_last_four,
    CASE k % 4 WHEN 0 THEN 'NL' WHEN 1 THEN 'DE' WHEN 2 THEN 'BE' ELSE 'SE' END AS issuer_country,
    'ecommerce' AS shopper_interaction,
    'shopper_' || CAST(ck AS VARCHAR) AS shopper_reference,
    CASE WHEN sid > 0 OR k % 20 < 17 THEN '00' WHEN k % 20 = 17 THEN '05'
         WHEN k % 20 = 18 THEN '51' WHEN k % 20 = 19 THEN '54' END AS acquirer_response_code,
    CASE WHEN k % 7 IN (0, 1, 2, 4) THEN k % 10 < 7 END AS is_3ds_authenticated,
    CAST((k * 37 + ck) % 101 AS INTEGER) AS risk_score
  FROM stg
)"""

EVENT_COLS = """event_id, psp_reference, merchant_id, merchant_name, merchant_country,
    merchant_category_code, event_type, event_timestamp, amount, currency, original_amount,
    original_currency, payment_method, payment_method_variant, card_bin, card_last_four,
    issuer_country, shopper_interaction, shopper_reference, acquirer_response_code,
    is_3ds_authenticated, risk_score"""

# ``pe``: the stored payment events (23 columns).
PE = ("WITH " + _STAGES + """,
pe AS (
  SELECT """ + EVENT_COLS + """,
    CAST(round(amount * (""" + FX_CASE.format(c="currency") + """), 2) AS DECIMAL(15,2)) AS amount_eur
  FROM ev0
)""")

# Delivery defects on authorizations (FIXTURES.md §3), as typed columns.
_DELIVERED = """,
dv AS (
  SELECT k, sid,
    CASE WHEN sid = 0 AND k % 307 = 4 THEN NULL ELSE event_id END AS event_id,
    psp_reference,
    CASE WHEN sid = 0 AND k % 307 = 4 THEN NULL ELSE merchant_id END AS merchant_id,
    merchant_name, merchant_country, merchant_category_code,
    CASE WHEN sid = 0 AND k % 503 = 2 THEN 'UNKNOWN' ELSE event_type END AS event_type,
    event_timestamp,
    CASE WHEN sid = 0 AND k % 401 = 3 THEN -amount ELSE amount END AS amount,
    CASE WHEN sid = 0 AND k % 997 = 0 THEN NULL WHEN sid = 0 AND k % 499 = 1 THEN 'XXX' ELSE currency END
      AS currency,
    original_amount, original_currency, payment_method, payment_method_variant, card_bin,
    card_last_four, issuer_country, shopper_interaction, shopper_reference,
    acquirer_response_code, is_3ds_authenticated, risk_score,
    CASE WHEN sid = 0 AND k % 211 = 5 THEN 2 ELSE 1 END AS copies
  FROM ev0
),
dv_reason AS (
  SELECT dv.*, concat_ws(', ',
    CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
    CASE WHEN psp_reference IS NULL THEN 'missing_psp_reference' END,
    CASE WHEN merchant_id IS NULL THEN 'missing_merchant_id' END,
    CASE WHEN amount IS NULL THEN 'missing_amount' END,
    CASE WHEN currency IS NULL THEN 'missing_currency' END,
    CASE WHEN event_type IS NULL THEN 'missing_event_type' END,
    CASE WHEN currency IS NOT NULL AND currency NOT IN ('EUR','USD','GBP','SEK','DKK','NOK','CHF','PLN')
         THEN 'invalid_currency' END,
    CASE WHEN event_type IS NOT NULL AND event_type NOT IN
         ('AUTHORIZATION','CAPTURE','SETTLEMENT','REFUND','CHARGEBACK','CANCEL') THEN 'invalid_event_type' END,
    CASE WHEN amount IS NOT NULL AND amount <= 0 THEN 'non_positive_amount' END
  ) AS rejection_reason
  FROM dv
),
valid AS (
  SELECT DISTINCT """ + EVENT_COLS + """,
    CAST(round(amount * (""" + FX_CASE.format(c="currency") + """), 2) AS DECIMAL(15,2)) AS amount_eur
  FROM dv_reason WHERE rejection_reason = ''
),
rejected AS (
  SELECT event_id, rejection_reason, psp_reference, event_type, currency, CAST(amount AS DOUBLE) AS amount,
    event_timestamp FROM dv_reason, range(2) r(i)
  WHERE rejection_reason <> '' AND r.i < copies
  UNION ALL
  SELECT NULL AS event_id,
    'missing_event_id, missing_psp_reference, missing_merchant_id, missing_amount, missing_currency, missing_event_type'
    AS rejection_reason, NULL, NULL, NULL, NULL, NULL
  FROM ev0 WHERE sid = 0 AND k % 601 = 6
)"""

DELIVERED = PE + _DELIVERED

# ---------------------------------------------------------------------------
# marts
# ---------------------------------------------------------------------------

SETTLEMENT = PE + """,
agg AS (
  SELECT CAST(event_timestamp AS DATE) AS settlement_date, merchant_id, merchant_name, merchant_country,
    CAST(sum(CASE WHEN event_type = 'AUTHORIZATION' THEN amount_eur ELSE 0 END) AS DECIMAL(25,2)) AS total_authorized,
    CAST(sum(CASE WHEN event_type = 'CAPTURE' THEN amount_eur ELSE 0 END) AS DECIMAL(25,2)) AS total_captured,
    CAST(sum(CASE WHEN event_type = 'REFUND' THEN amount_eur ELSE 0 END) AS DECIMAL(25,2)) AS total_refunded,
    CAST(sum(CASE WHEN event_type = 'CHARGEBACK' THEN amount_eur ELSE 0 END) AS DECIMAL(25,2)) AS total_chargebacks,
    CAST(count(*) FILTER (WHERE event_type = 'AUTHORIZATION') AS BIGINT) AS transaction_count,
    CAST(count(*) FILTER (WHERE event_type = 'CHARGEBACK') AS BIGINT) AS chargeback_count
  FROM pe GROUP BY ALL
)
SELECT settlement_date, merchant_id, merchant_name, merchant_country,
  total_authorized, total_captured, total_refunded, total_chargebacks,
  CAST(total_captured - total_refunded - total_chargebacks AS DECIMAL(25,2)) AS net_settlement_eur,
  transaction_count, chargeback_count,
  """ + ratio("chargeback_count", "transaction_count") + """ AS chargeback_ratio,
  'EUR' AS currency
FROM agg"""

PERFORMANCE = PE + """,
agg AS (
  SELECT CAST(event_timestamp AS DATE) AS report_date, payment_method, issuer_country,
    CAST(count(*) AS BIGINT) AS total_authorizations,
    CAST(count(*) FILTER (WHERE acquirer_response_code = '00') AS BIGINT) AS successful_authorizations,
    sum(amount_eur) AS vol, count(amount_eur) AS priced,
    count(*) FILTER (WHERE is_3ds_authenticated) AS secure
  FROM pe WHERE event_type = 'AUTHORIZATION' GROUP BY ALL
)
SELECT report_date, payment_method, issuer_country, total_authorizations, successful_authorizations,
  """ + ratio("successful_authorizations", "total_authorizations") + """ AS authorization_rate,
  """ + money_avg("vol", "priced") + """ AS avg_amount_eur,
  CAST(vol AS DECIMAL(25,2)) AS total_volume_eur,
  """ + ratio("secure", "total_authorizations") + """ AS is_3ds_rate
FROM agg"""

ALERTS = PE + """,
st AS (
  SELECT merchant_id, merchant_name,
    CAST(count(*) FILTER (WHERE event_type = 'AUTHORIZATION') AS BIGINT) AS transaction_count,
    CAST(count(*) FILTER (WHERE event_type = 'CHARGEBACK') AS BIGINT) AS chargeback_count
  FROM pe WHERE event_type IN ('AUTHORIZATION', 'CHARGEBACK') GROUP BY ALL
),
r AS (
  SELECT *, """ + ratio("chargeback_count", "transaction_count") + """ AS chargeback_ratio FROM st
),
c AS (
  SELECT *,
    CASE WHEN chargeback_ratio > 0.009 AND chargeback_ratio > 0.010 THEN 'both'
         WHEN chargeback_ratio > 0.009 THEN 'visa'
         WHEN chargeback_ratio > 0.010 THEN 'mastercard' END AS threshold_exceeded
  FROM r
),
s AS (
  SELECT *, CASE WHEN threshold_exceeded IS NOT NULL THEN 'critical'
                 WHEN chargeback_ratio > 0.005 THEN 'warning' END AS severity
  FROM c
)
SELECT (SELECT max(CAST(event_timestamp AS DATE)) FROM pe) AS alert_date,
  merchant_id, merchant_name, chargeback_count, transaction_count, chargeback_ratio,
  threshold_exceeded, CAST(0.009 AS DOUBLE) AS visa_threshold, CAST(0.010 AS DOUBLE) AS mc_threshold, severity
FROM s WHERE severity IS NOT NULL"""

LIFECYCLE = PE + """
SELECT psp_reference,
  CAST(count(*) FILTER (WHERE event_type = 'AUTHORIZATION') AS BIGINT) AS has_auth,
  CAST(count(*) FILTER (WHERE event_type = 'CAPTURE') AS BIGINT) AS has_capture,
  CAST(count(*) FILTER (WHERE event_type = 'SETTLEMENT') AS BIGINT) AS has_settlement,
  CAST(count(*) FILTER (WHERE event_type = 'REFUND') AS BIGINT) AS has_refund
FROM pe GROUP BY psp_reference"""

# The join form: every authorization row times each capture of its transaction.
_PAIRS = """,
lc AS (
  SELECT psp_reference,
    count(*) FILTER (WHERE event_type = 'CAPTURE') AS has_capture,
    count(*) FILTER (WHERE event_type = 'SETTLEMENT') AS has_settlement,
    count(*) FILTER (WHERE event_type = 'REFUND') AS has_refund
  FROM pe GROUP BY psp_reference
),
au AS (
  SELECT psp_reference, merchant_id, CAST(event_timestamp AS DATE) AS report_date,
         CAST(floor(epoch(event_timestamp)) AS BIGINT) AS a_s
  FROM pe WHERE event_type = 'AUTHORIZATION' AND psp_reference IS NOT NULL
),
cp AS (
  SELECT psp_reference, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS c_s
  FROM pe WHERE event_type = 'CAPTURE'
),
pairs AS (
  SELECT au.*, lc.has_capture, lc.has_settlement, lc.has_refund, cp.c_s - au.a_s AS d_s
  FROM au JOIN lc USING (psp_reference) LEFT JOIN cp USING (psp_reference)
)"""

LATENCY = PE + _PAIRS + """
SELECT a.psp_reference, a.merchant_id, a.report_date, a.auths,
  CAST(lc.has_capture AS BIGINT) AS captures, CAST(lc.has_settlement AS BIGINT) AS settlements,
  CAST(lc.has_refund AS BIGINT) AS refunds, p.pairs, p.delay_secs,
  CASE WHEN p.pairs > 0 THEN CAST(""" + half_up_units("p.delay_secs", "p.pairs * 3600", 2) + """ AS DOUBLE) / 100.0 END
    AS avg_hours
FROM (SELECT psp_reference, merchant_id, report_date, CAST(count(*) AS BIGINT) AS auths
      FROM au GROUP BY ALL) a
JOIN lc USING (psp_reference)
JOIN (SELECT psp_reference, merchant_id, report_date, CAST(count(d_s) AS BIGINT) AS pairs,
             CAST(coalesce(sum(d_s), 0) AS DECIMAL(38,0)) AS delay_secs
      FROM pairs GROUP BY ALL) p USING (psp_reference, merchant_id, report_date)"""

FUNNEL = PE + _PAIRS + """,
agg AS (
  SELECT report_date, merchant_id,
    CAST(count(*) AS BIGINT) AS authorized_count,
    CAST(sum(CASE WHEN has_capture > 0 THEN 1 ELSE 0 END) AS BIGINT) AS captured_count,
    CAST(sum(CASE WHEN has_settlement > 0 THEN 1 ELSE 0 END) AS BIGINT) AS settled_count,
    CAST(sum(CASE WHEN has_refund > 0 THEN 1 ELSE 0 END) AS BIGINT) AS refunded_count,
    sum(d_s) AS dsum, count(d_s) AS dn
  FROM pairs GROUP BY ALL
)
SELECT report_date, merchant_id, authorized_count, captured_count, settled_count, refunded_count,
  """ + ratio("captured_count", "authorized_count") + """ AS auth_to_capture_rate,
  """ + ratio("settled_count", "captured_count") + """ AS capture_to_settle_rate,
  """ + ratio("refunded_count", "captured_count") + """ AS refund_rate,
  CASE WHEN dn > 0 THEN CAST(""" + half_up_units("dsum", "dn * 3600", 2) + """ AS DOUBLE) / 100.0 END
    AS avg_auth_to_capture_hours
FROM agg"""


# transactions with several captures and authorizations (at other hours, without a method)
FUNNEL_MULTI = (PE + """,
pe2 AS (
  SELECT event_id, psp_reference, merchant_id, event_type, event_timestamp FROM pe
  UNION ALL
  SELECT event_id || '_b', psp_reference, merchant_id, event_type, event_timestamp + INTERVAL 200 MINUTE FROM pe
  WHERE event_type = 'CAPTURE' AND CAST(psp_reference[4:] AS BIGINT) % 3 = 0
  UNION ALL
  SELECT event_id || '_b', psp_reference, merchant_id, event_type, event_timestamp + INTERVAL 200 MINUTE FROM pe
  WHERE event_type = 'AUTHORIZATION' AND CAST(psp_reference[4:] AS BIGINT) % 7 = 0
)""" + re.sub(r"\bpe\b", "pe2", FUNNEL[len(PE):]))

# ---------------------------------------------------------------------------
# ingest
# ---------------------------------------------------------------------------

_WIRE_COLS = """event_id, psp_reference, merchant_id, merchant_name, merchant_country,
    merchant_category_code, event_type, event_timestamp, CAST(amount AS DOUBLE) AS amount, currency,
    CAST(original_amount AS DOUBLE) AS original_amount, original_currency, payment_method,
    payment_method_variant, card_bin, card_last_four, issuer_country, shopper_interaction,
    shopper_reference, acquirer_response_code, is_3ds_authenticated, risk_score"""

_NOT_JSON = "FROM ev0 WHERE sid = 0 AND k % 601 = 6"

PARSE_EVENTS = DELIVERED + """
SELECT """ + _WIRE_COLS + """ FROM dv, range(2) r(i) WHERE r.i < copies
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL """ + _NOT_JSON

REJECTION_REASONS = DELIVERED + """
SELECT event_id, psp_reference, event_type, rejection_reason
FROM dv_reason, range(2) r(i) WHERE r.i < copies
UNION ALL
SELECT NULL, NULL, NULL,
  'missing_event_id, missing_psp_reference, missing_merchant_id, missing_amount, missing_currency, missing_event_type'
""" + _NOT_JSON

FX_NORMALIZE = DELIVERED + """
SELECT event_id, currency, amount,
  CAST(round(amount * (""" + FX_CASE.format(c="currency") + """), 2) AS DECIMAL(15,2)) AS amount_eur
FROM dv, range(2) r(i) WHERE r.i < copies
UNION ALL
SELECT NULL, NULL, NULL, NULL """ + _NOT_JSON

INGEST_VALID = DELIVERED + """
SELECT * FROM valid"""

INGEST_REJECTED = DELIVERED + """
SELECT event_id, rejection_reason, psp_reference, event_type, currency, amount,
  CAST(event_timestamp AS TIMESTAMP) AS event_timestamp FROM rejected"""

# strict mode: defects of time and range; NaN and out-of-range amounts are stated by key, not computed
_STRICT = """,
sd AS (
  SELECT k, sid, event_id, psp_reference, merchant_id,
    sid = 0 AND k % 701 = 7 AS bad_time, sid = 0 AND k % 709 = 8 AS is_nan,
    sid = 0 AND k % 709 <> 8 AND k % 719 = 9 AS huge,
    sid = 0 AND k % 709 <> 8 AND k % 719 <> 9 AND k % 727 = 10 AS tiny,
    sid = 0 AND k % 709 <> 8 AND k % 719 <> 9 AND k % 727 <> 10 AND k % 733 = 11 AS huge_eur,
    event_type, amount, copies,
    CASE WHEN sid = 0 AND k % 733 = 11 THEN 'GBP' ELSE currency END AS currency
  FROM dv
)"""

INGEST_STRICT = DELIVERED + _STRICT + """
SELECT event_id, psp_reference, concat_ws(', ',
    CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
    CASE WHEN psp_reference IS NULL THEN 'missing_psp_reference' END,
    CASE WHEN merchant_id IS NULL THEN 'missing_merchant_id' END,
    CASE WHEN currency IS NULL THEN 'missing_currency' END,
    CASE WHEN event_type IS NULL THEN 'missing_event_type' END,
    CASE WHEN currency IS NOT NULL AND currency NOT IN ('EUR','USD','GBP','SEK','DKK','NOK','CHF','PLN')
         THEN 'invalid_currency' END,
    CASE WHEN event_type IS NOT NULL AND event_type NOT IN
         ('AUTHORIZATION','CAPTURE','SETTLEMENT','REFUND','CHARGEBACK','CANCEL') THEN 'invalid_event_type' END,
    CASE WHEN NOT (is_nan OR huge OR tiny OR huge_eur) AND amount <= 0 THEN 'non_positive_amount' END,
    CASE WHEN is_nan OR huge OR tiny OR huge_eur THEN 'amount_out_of_range' END,
    CASE WHEN bad_time THEN 'invalid_event_timestamp' END,
    CASE WHEN is_nan THEN 'nan_amount' END) AS rejection_reason
FROM sd, range(2) r(i) WHERE r.i < copies
UNION ALL
SELECT NULL, NULL, 'missing_event_id, missing_psp_reference, missing_merchant_id, missing_amount, missing_currency, missing_event_type, missing_event_timestamp'
""" + _NOT_JSON

# events that pass the rules but not the stored table's constraints (fixed limits of its columns)
STREAM_CONTRACT = DELIVERED + """,
sc AS (
  SELECT copies, rejection_reason,
    CASE WHEN sid = 0 AND k % 751 = 14 AND event_id IS NOT NULL THEN event_id || repeat('x', 60) ELSE event_id END AS event_id,
    concat_ws(', ', CASE WHEN sid = 0 AND k % 701 = 7 THEN 'not_null_event_timestamp' END,
      CASE WHEN sid = 0 AND k % 751 = 14 AND event_id IS NOT NULL THEN 'max_length_50_event_id' END,
      CASE WHEN sid = 0 AND k % 743 = 13 THEN 'max_length_5_issuer_country' END,
      CASE WHEN sid = 0 AND k % 739 = 12 THEN 'max_length_100_shopper_reference' END) AS broken
  FROM dv_reason
),
sr AS (SELECT event_id, copies, CASE WHEN rejection_reason <> '' THEN rejection_reason ELSE broken END AS reason FROM sc)
SELECT event_id, reason, 'stored' AS kind FROM sr WHERE reason = ''
UNION ALL
SELECT event_id[:50], reason, 'rejected' FROM sr, range(2) r(i) WHERE r.i < copies AND reason <> ''
UNION ALL
SELECT NULL,
  'missing_event_id, missing_psp_reference, missing_merchant_id, missing_amount, missing_currency, missing_event_type',
  'rejected'
""" + _NOT_JSON

DEDUP_EVENTS = PE + """
SELECT * FROM pe"""

DEDUP_UNEQUAL = PE + """
SELECT event_id, psp_reference, merchant_id, merchant_name, merchant_country, merchant_category_code,
  event_type, event_timestamp, least_amount AS amount, currency, original_amount,
  original_currency, payment_method, payment_method_variant, card_bin, card_last_four, issuer_country,
  shopper_interaction, shopper_reference, acquirer_response_code, is_3ds_authenticated, risk_score,
  CAST(round(least_amount * (""" + FX_CASE.format(c="currency") + """), 2) AS DECIMAL(15,2)) AS amount_eur
FROM (SELECT *, CAST(amount - CASE WHEN event_type = 'CAPTURE' THEN 0.01 ELSE 0 END AS DECIMAL(15,2)) AS least_amount FROM pe)"""

UPSERT_FIRST_WINS = PE + """
SELECT * FROM pe WHERE event_type IN ('AUTHORIZATION', 'CAPTURE')
UNION ALL
SELECT event_id, psp_reference, merchant_id, merchant_name, merchant_country, merchant_category_code,
  event_type, event_timestamp, CAST(amount * 2 AS DECIMAL(15,2)) AS amount, currency, original_amount,
  original_currency, payment_method, payment_method_variant, card_bin, card_last_four, issuer_country,
  shopper_interaction, shopper_reference, acquirer_response_code, is_3ds_authenticated, risk_score,
  CAST(round(CAST(amount * 2 AS DECIMAL(15,2)) * (""" + FX_CASE.format(c="currency") + """), 2) AS DECIMAL(15,2))
    AS amount_eur
FROM pe WHERE event_type NOT IN ('AUTHORIZATION', 'CAPTURE')"""

_ORACLES = {
    "parse_events": PARSE_EVENTS,
    "rejection_reasons": REJECTION_REASONS,
    "fx_normalize": FX_NORMALIZE,
    "ingest_valid": INGEST_VALID,
    "ingest_rejected": INGEST_REJECTED,
    "ingest_strict": INGEST_STRICT,
    "stream_restart": INGEST_VALID,
    "dedup_events": DEDUP_EVENTS,
    "funnel_multi": FUNNEL_MULTI,
    "dedup_unequal": DEDUP_UNEQUAL,
    "upsert_first_wins": UPSERT_FIRST_WINS,
    "stream_contract": STREAM_CONTRACT,
    "stream_compacted": INGEST_VALID,
    "stream_ingest": INGEST_VALID,
    "stream_rejected": INGEST_REJECTED,
}


def oracle_sql() -> dict[str, str]:
    return {
        "merchant_settlement": SETTLEMENT,
        "payment_method_performance": PERFORMANCE,
        "chargeback_alerts": ALERTS,
        "txn_lifecycle": LIFECYCLE,
        "conversion_funnel": FUNNEL,
        "auth_to_capture_hours": LATENCY,
        **_ORACLES,
    }

# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------

import datetime as _dt  # noqa: E402

from settlekit.plans.catalogue import EVENTS_CHECKS, QUALITY_CHECKS, QUERY_AS_OF  # noqa: E402

DEFAULT_SEVERITY = {
    "not_null": "critical", "accepted_values": "warning", "uniqueness": "critical",
    "range_check": "warning", "freshness": "warning", "referential_integrity": "warning",
    "statistical_outlier": "warning", "row_count": "critical",
}

# logical table name -> relation in the oracle SQL
RELATIONS = {
    "raw.payment_events": "pe",
    "analytics.merchant_daily_settlement": "settle",
    "analytics.payment_method_performance": "perf",
    "analytics.conversion_funnel": "funnel",
    "events": "events",
    "customer": "customer",
    "supplier": "supplier",
}


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _row(table, name, ctype, status, t, f, sev, pct_expr=None, src="") -> str:
    p = pct_expr if pct_expr is not None else pct(f, t)
    return (f"SELECT {_q(table)} AS table_name, {_q(name)} AS check_name, {_q(ctype)} AS check_type, "
            f"{status} AS status, CAST({t} AS BIGINT) AS records_checked, CAST({f} AS BIGINT) AS records_failed, "
            f"CAST({p} AS DOUBLE) AS failure_percentage, {_q(sev)} AS severity {src}")


def _num(v) -> str:
    return repr(float(v)) if isinstance(v, float) else str(v)


def check_sql(table: str, cfg: dict, as_of: _dt.datetime) -> list[str]:
    r = RELATIONS[table]
    ct = cfg["check"]
    sev = cfg.get("severity", DEFAULT_SEVERITY[ct])
    fail = "CASE WHEN f > 0 THEN 'FAIL' ELSE 'PASS' END"
    if ct == "not_null":
        return [_row(table, f"not_null_{c}", ct, fail, "t", "f", sev,
                     src=f"FROM (SELECT count(*) AS t, count(*) FILTER (WHERE {c} IS NULL) AS f FROM {r})")
                for c in cfg["columns"]]
    c = cfg.get("column")
    if ct == "accepted_values":
        vals = ", ".join(_q(v) for v in cfg["values"])
        return [_row(table, f"accepted_values_{c}", ct, fail, "t", "f", sev,
                     src=f"FROM (SELECT count(*) AS t, count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})) "
                         f"AS f FROM {r})")]
    if ct == "uniqueness":
        return [_row(table, f"uniqueness_{c}", ct, fail, "t", "t - d", sev,
                     src=f"FROM (SELECT count(*) AS t, count(DISTINCT {c}) + "
                         f"(CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 1 ELSE 0 END) AS d FROM {r})")
                .replace("CASE WHEN f > 0", "CASE WHEN t - d > 0")]
    if ct == "range_check":
        conds = []
        if cfg.get("min") is not None:
            conds.append(f"{c} < {_num(cfg['min'])}")
        if cfg.get("max") is not None:
            conds.append(f"{c} > {_num(cfg['max'])}")
        if not conds:
            return []
        return [_row(table, f"range_{c}", ct, fail, "t", "f", sev,
                     src=f"FROM (SELECT count({c}) AS t, count(*) FILTER (WHERE {c} IS NOT NULL AND "
                         f"({' OR '.join(conds)})) AS f FROM {r})")]
    if ct == "freshness":
        now = f"TIMESTAMP '{as_of.isoformat(sep=' ')}'"
        age = f"((epoch_us({now}) - epoch_us(CAST(mx AS TIMESTAMP))) / 3.6e9)"
        fresh = f"(mx IS NOT NULL AND {age} <= {float(cfg['max_age_hours'])!r})"
        return [_row(table, f"freshness_{c}", ct, f"CASE WHEN {fresh} THEN 'PASS' ELSE 'FAIL' END", "t",
                     f"CASE WHEN {fresh} THEN 0 ELSE t END", sev,
                     pct_expr=f"CASE WHEN {fresh} THEN 0.0 ELSE 100.0 END",
                     src=f"FROM (SELECT count(*) AS t, max({c}) AS mx FROM {r})")]
    if ct == "referential_integrity":
        ref, rc = RELATIONS[cfg["reference_table"]], cfg["reference_column"]
        name = f"ref_integrity_{c}_to_{cfg['reference_table']}.{rc}"
        return [_row(table, name, ct, fail, "t", "f", sev,
                     src=f"FROM (SELECT count(*) AS t, count(*) FILTER (WHERE NOT EXISTS "
                         f"(SELECT 1 FROM {ref} WHERE {ref}.{rc} = k.k)) AS f "
                         f"FROM (SELECT DISTINCT {c} AS k FROM {r}) k)")]
    if ct == "statistical_outlier":
        n = float(cfg.get("n_stddev", 3))
        warn = "CASE WHEN f > 0 THEN 'WARN' ELSE 'PASS' END"
        x = f"CAST({c} AS DOUBLE)"
        out = f"(sd IS NOT NULL AND sd <> 0 AND ({x} < mean - {n!r} * sd OR {x} > mean + {n!r} * sd))"
        g = cfg.get("group_by")
        if g:
            return [_row(table, f"outlier_{c}_by_{g}", ct, warn, "t", "f", sev,
                         src=f"FROM (SELECT count(*) AS t, count(*) FILTER (WHERE {out}) AS f FROM {r} "
                             f"JOIN (SELECT {g}, avg({x}) AS mean, stddev_samp({x}) AS sd FROM {r} "
                             f"WHERE {c} IS NOT NULL GROUP BY {g}) s ON s.{g} IS NOT DISTINCT FROM {r}.{g} WHERE {c} IS NOT NULL)")]
        return [_row(table, f"outlier_{c}", ct, warn, "t", "f", sev,
                     src=f"FROM (SELECT count(*) AS t, count(*) FILTER (WHERE {out}) AS f FROM {r}, "
                         f"(SELECT avg({x}) AS mean, stddev_samp({x}) AS sd FROM {r} WHERE {c} IS NOT NULL) s "
                         f"WHERE {c} IS NOT NULL)")]
    if ct == "row_count":
        m = cfg.get("min_rows", 1)
        return [_row(table, "row_count", ct, f"CASE WHEN t >= {m} THEN 'PASS' ELSE 'FAIL' END", "t",
                     f"CASE WHEN t >= {m} THEN 0 ELSE t END", sev,
                     pct_expr=f"CASE WHEN t >= {m} THEN 0.0 ELSE 100.0 END",
                     src=f"FROM (SELECT count(*) AS t FROM {r})")]
    return []


MART_CTES = (PE + ",\nsettle AS (" + SETTLEMENT + "),\nperf AS (" + PERFORMANCE + "),\nfunnel AS ("
             + FUNNEL + "),\nalerts AS (" + ALERTS + ")")


def suite_body(checks_by_table: dict[str, list[dict]], as_of: _dt.datetime) -> str:
    parts = []
    for table, checks in checks_by_table.items():
        for cfg in checks:
            parts.extend(check_sql(table, cfg, as_of))
    return "\nUNION ALL\n".join(parts)


def suite_sql(checks_by_table: dict[str, list[dict]], as_of: _dt.datetime) -> str:
    return MART_CTES + "\n" + suite_body(checks_by_table, as_of)


def _by_type(check_type: str) -> dict[str, list[dict]]:
    out = {t: [c for c in cs if c["check"] == check_type] for t, cs in QUALITY_CHECKS.items()}
    out = {t: cs for t, cs in out.items() if cs}
    key = "outlier_grouped" if check_type == "outlier_grouped" else check_type
    if check_type == "outlier_grouped":
        out = {}
    out["events"] = EVENTS_CHECKS[key]
    return out


DQ_KEYS = {
    "dq_not_null": "not_null",
    "dq_accepted_values": "accepted_values",
    "dq_uniqueness": "uniqueness",
    "dq_range": "range_check",
    "dq_freshness": "freshness",
    "dq_referential_integrity": "referential_integrity",
    "dq_statistical_outlier": "statistical_outlier",
    "dq_row_count": "row_count",
    "dq_outlier_grouped": "outlier_grouped",
}

_ORACLES.update({k: suite_sql(_by_type(t), QUERY_AS_OF) for k, t in DQ_KEYS.items()})
# checks that can't run: one failing row each, named after the check, with its severity or "critical"
_BROKEN = [("range_check", "critical"), ("statistical_outlier", "critical"), ("freshness", "critical"),
           ("not_null", "critical"), ("referential_integrity", "warning"), ("accepted_values", "critical"),
           ("range_check", "critical"), ("row_count", "warning")]
_ORACLES["dq_errors"] = MART_CTES + "\n" + "\nUNION ALL\n".join(
    [f"SELECT 'events' AS table_name, '{t}_error' AS check_name, '{t}' AS check_type, 'FAIL' AS status, "
     f"CAST(0 AS BIGINT) AS records_checked, CAST(0 AS BIGINT) AS records_failed, CAST(0 AS DOUBLE) AS failure_percentage, "
     f"'{sev}' AS severity" for t, sev in _BROKEN]
    + [x for c in ({"check": "row_count", "min_rows": 1}, {"check": "not_null", "columns": ["event_id", "ts"]},
                   {"check": "statistical_outlier", "column": "value", "n_stddev": 3})
       for x in check_sql("events", c, QUERY_AS_OF)])
_ORACLES["quality_run"] = suite_sql(QUALITY_CHECKS, QUERY_AS_OF)

# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------

RUN_A = QUERY_AS_OF - _dt.timedelta(hours=3)
RUN_B = QUERY_AS_OF


def _ts(t: _dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


QLOG = (MART_CTES + ",\nrun_a AS (" + suite_body({"raw.payment_events": QUALITY_CHECKS["raw.payment_events"]}, RUN_A)
        + "),\nrun_b AS (" + suite_body(QUALITY_CHECKS, RUN_B) + "),\nqlog AS (SELECT " + _ts(RUN_A)
        + " AS check_timestamp, * FROM run_a UNION ALL SELECT " + _ts(RUN_B) + ", * FROM run_b),\n"
        + "latest AS (SELECT * FROM qlog WHERE check_timestamp = (SELECT max(check_timestamp) FROM qlog))")

_ORACLES.update({
    "top_settlement": MART_CTES + """
SELECT settlement_date, merchant_id, merchant_name, net_settlement_eur FROM settle
ORDER BY net_settlement_eur DESC, settlement_date, merchant_id LIMIT 20""",
    "auth_rate_series": MART_CTES + """
SELECT report_date AS time, payment_method AS metric, authorization_rate AS value FROM perf""",
    "events_by_type": PE + """
SELECT event_type, CAST(count(*) AS BIGINT) AS total FROM pe GROUP BY event_type""",
    "event_volume": PE + """
SELECT CAST(count(*) AS BIGINT) AS total_events FROM pe""",
    "worst_funnel": MART_CTES + """
SELECT report_date, merchant_id, auth_to_capture_rate, capture_to_settle_rate, refund_rate FROM funnel
ORDER BY auth_to_capture_rate, report_date, merchant_id LIMIT 20""",
    "quality_scoreboard": QLOG + """
SELECT table_name, check_name, check_type, status, severity, records_checked, records_failed,
  failure_percentage, check_timestamp FROM latest""",
    "quality_pass_rate": QLOG + """
SELECT CASE WHEN n > 0 THEN """ + ratio("p", "n") + """ END AS pass_rate
FROM (SELECT count(*) FILTER (WHERE status = 'PASS') AS p, count(*) AS n FROM latest)""",
    "quality_summary": QLOG + """
SELECT status, CAST(count(*) AS BIGINT) AS check_count,
  CAST(count(*) FILTER (WHERE severity = 'critical' AND status = 'FAIL') AS BIGINT) AS critical_failures
FROM qlog WHERE check_timestamp >= """ + _ts(RUN_B) + """ - INTERVAL 1 HOUR GROUP BY status""",
})

# ---------------------------------------------------------------------------
# write contracts
# ---------------------------------------------------------------------------

from settlekit.schemas import CONTRACTS  # noqa: E402

CONTRACT_TABLES = {
    "raw.payment_events": "pe",
    "analytics.merchant_daily_settlement": "settle",
    "analytics.payment_method_performance": "perf",
    "analytics.chargeback_alerts": "alerts",
    "analytics.conversion_funnel": "funnel",
}
_COLUMNS = {
    "pe": set(EVENT_COLS.replace("\n", " ").replace(" ", "").split(",")) | {"amount_eur"},
}


def contract_sql() -> str:
    from settlekit.operators.marts import (ALERT_COLUMNS, FUNNEL_COLUMNS, PERFORMANCE_COLUMNS,
                                           SETTLEMENT_COLUMNS)

    cols = dict(_COLUMNS)
    cols.update({"settle": set(SETTLEMENT_COLUMNS), "perf": set(PERFORMANCE_COLUMNS),
                 "alerts": set(ALERT_COLUMNS), "funnel": set(FUNNEL_COLUMNS)})
    parts = []
    for table, rel in CONTRACT_TABLES.items():
        spec = CONTRACTS[table]

        def row(constraint, column, n):
            return (f"SELECT {_q(table)} AS table_name, {_q(constraint)} AS constraint_name, "
                    f"{_q(column)} AS column_name, CAST(({n}) AS BIGINT) AS violations")
        for c in spec["not_null"]:
            parts.append(row("not_null", c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {rel}"))
        for c, n in spec["max_length"].items():
            if c in cols[rel]:
                parts.append(row(f"max_length_{n}", c,
                                 f"SELECT count(*) FILTER (WHERE length({c}) > {n}) FROM {rel}"))
        for c, (p, sc) in spec["decimal"].items():
            if c in cols[rel]:
                parts.append(row(f"decimal_{p}_{sc}", c,
                                 f"SELECT count(*) FILTER (WHERE {c} IS NOT NULL AND "
                                 f"TRY_CAST({c} AS DECIMAL({p},{sc})) IS NULL) FROM {rel}"))
        if spec["key"]:
            k = ", ".join(spec["key"])
            parts.append(row("primary_key", ",".join(spec["key"]),
                             f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {rel} GROUP BY {k})"))
    return MART_CTES + "\n" + "\nUNION ALL\n".join(parts)


_ORACLES["contract_violations"] = contract_sql()

# ---------------------------------------------------------------------------
# stored marts
# ---------------------------------------------------------------------------

_MONEY = ("total_authorized", "total_captured", "total_refunded", "total_chargebacks", "net_settlement_eur")
_PE_CANCEL = PE[:PE.rindex("FROM ev0")] + "FROM ev0 WHERE event_type = 'CANCEL'\n)"
_FUNNEL_CHECKS = [("not_null", "critical"), ("range_check", "warning"), ("row_count", "critical")]

_ORACLES.update({
    "alerts_none": MART_CTES + """
SELECT alert_date, merchant_id, chargeback_count, severity FROM alerts WHERE chargeback_ratio > 9""",
    "mart_tables_typed": MART_CTES + """
SELECT settlement_date, merchant_id, merchant_name, merchant_country, """ + ", ".join(
        f"CAST({c} AS DECIMAL(15,2)) AS {c}" for c in _MONEY) + """,
  transaction_count, chargeback_count, CAST(chargeback_ratio AS DECIMAL(5,4)) AS chargeback_ratio, currency
FROM settle""",
    "gate_missing_mart": (MART_CTES + "\n" + suite_body(
        {t: cs for t, cs in QUALITY_CHECKS.items() if t != "analytics.conversion_funnel"}, QUERY_AS_OF)
        ).replace(PE, _PE_CANCEL) + "".join(
        f"\nUNION ALL SELECT 'analytics.conversion_funnel', '{t}_error', '{t}', 'FAIL', CAST(0 AS BIGINT), "
        f"CAST(0 AS BIGINT), CAST(0 AS DOUBLE), '{sev}'" for t, sev in _FUNNEL_CHECKS),
})
