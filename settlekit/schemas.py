"""Schemas, value domains and table contracts of the payment data model.

Everything in the "fixed values" blocks must equal the behaviour being
reproduced (domains, FX rates, thresholds, rule order); it is stated once,
here, and imported everywhere else.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

# Event types in lifecycle order.
EVENT_TYPES = ["AUTHORIZATION", "CAPTURE", "SETTLEMENT", "REFUND", "CHARGEBACK", "CANCEL"]

# EUR conversion rates per supported currency.
FX_RATES_TO_EUR = {
    "EUR": "1.0",
    "USD": "0.92",
    "GBP": "1.17",
    "SEK": "0.088",
    "DKK": "0.134",
    "NOK": "0.089",
    "CHF": "1.05",
    "PLN": "0.23",
}
CURRENCIES = list(FX_RATES_TO_EUR)

PAYMENT_METHODS = ["visa", "mastercard", "amex", "ideal", "klarna", "bancontact", "sofort"]
SHOPPER_INTERACTIONS = ["ecommerce", "pos", "moto", "recurring"]

# Acquirer response codes; "00" is the only approval.
APPROVED_RESPONSE_CODE = "00"
ACQUIRER_RESPONSE_CODES = ["00", "05", "51", "14", "54", "61", "65"]

# Fields whose absence rejects an event, in the order reasons are reported.
MANDATORY_FIELDS = ["event_id", "psp_reference", "merchant_id", "amount", "currency", "event_type"]

# Event time text format on the wire.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Card-scheme chargeback thresholds and the early-warning level.
VISA_CHARGEBACK_THRESHOLD = 0.009
MC_CHARGEBACK_THRESHOLD = 0.010
WARNING_CHARGEBACK_THRESHOLD = 0.005

# Freshness limits in hours: suite check and pipeline stale-data guard.
FRESHNESS_CHECK_HOURS = 2
STALE_GUARD_HOURS = 6

# Pass-rate colour bands of the dashboard: red < 0.8 <= orange < 0.95 <= green.
PASS_RATE_BANDS = (0.8, 0.95)

# ---------------------------------------------------------------------------
# Wire and stored schemas
# ---------------------------------------------------------------------------

# The 22 fields of one JSON event message; everything nullable at parse time.
PAYMENT_EVENT_JSON_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("psp_reference", StringType()),
        StructField("merchant_id", StringType()),
        StructField("merchant_name", StringType()),
        StructField("merchant_country", StringType()),
        StructField("merchant_category_code", StringType()),
        StructField("event_type", StringType()),
        StructField("event_timestamp", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("original_amount", DoubleType()),
        StructField("original_currency", StringType()),
        StructField("payment_method", StringType()),
        StructField("payment_method_variant", StringType()),
        StructField("card_bin", StringType()),
        StructField("card_last_four", StringType()),
        StructField("issuer_country", StringType()),
        StructField("shopper_interaction", StringType()),
        StructField("shopper_reference", StringType()),
        StructField("acquirer_response_code", StringType()),
        StructField("is_3ds_authenticated", BooleanType()),
        StructField("risk_score", IntegerType()),
    ]
)
EVENT_FIELDS = [f.name for f in PAYMENT_EVENT_JSON_SCHEMA.fields]

MONEY = DecimalType(15, 2)
# Sums of money keep the ten more integer digits that Spark gives a decimal sum,
# so a transform never fails on a large group; the write contract reports it.
MONEY_SUM = DecimalType(25, 2)
FX_RATE = DecimalType(5, 3)

# Stored raw events: the 22 fields typed, plus amount_eur (ingested_at is
# added by the sink only).
PAYMENT_EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("psp_reference", StringType()),
        StructField("merchant_id", StringType()),
        StructField("merchant_name", StringType()),
        StructField("merchant_country", StringType()),
        StructField("merchant_category_code", StringType()),
        StructField("event_type", StringType()),
        StructField("event_timestamp", TimestampType()),
        StructField("amount", MONEY),
        StructField("currency", StringType()),
        StructField("original_amount", MONEY),
        StructField("original_currency", StringType()),
        StructField("payment_method", StringType()),
        StructField("payment_method_variant", StringType()),
        StructField("card_bin", StringType()),
        StructField("card_last_four", StringType()),
        StructField("issuer_country", StringType()),
        StructField("shopper_interaction", StringType()),
        StructField("shopper_reference", StringType()),
        StructField("acquirer_response_code", StringType()),
        StructField("is_3ds_authenticated", BooleanType()),
        StructField("risk_score", IntegerType()),
        StructField("amount_eur", MONEY),
    ]
)
PAYMENT_EVENT_COLUMNS = [f.name for f in PAYMENT_EVENTS_SCHEMA.fields]

REJECTED_EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("raw_payload", StringType(), False),
        StructField("raw_value", StringType()),
        StructField("rejection_reason", StringType(), False),
    ]
)

# One row per executed quality check (the log adds check_timestamp).
CHECK_RESULT_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("check_name", StringType(), False),
        StructField("check_type", StringType(), False),
        StructField("status", StringType(), False),
        StructField("records_checked", LongType(), False),
        StructField("records_failed", LongType(), False),
        StructField("failure_percentage", DoubleType(), False),
        StructField("details", StringType()),
        StructField("severity", StringType(), False),
    ]
)
CHECK_RESULT_COLUMNS = [f.name for f in CHECK_RESULT_SCHEMA.fields]

# ---------------------------------------------------------------------------
# Write contracts of the stored tables: key, NOT NULL, text length, decimal
# (precision, scale). Checked by ``settlekit.sinks.contracts`` before writes.
# ---------------------------------------------------------------------------

CONTRACTS = {
    "raw.payment_events": {
        "key": ["event_id"],
        "not_null": [
            "event_id", "psp_reference", "merchant_id", "event_type",
            "event_timestamp", "amount", "currency",
        ],
        "max_length": {
            "event_id": 50, "psp_reference": 50, "merchant_id": 50,
            "merchant_name": 200, "merchant_country": 5, "merchant_category_code": 10,
            "event_type": 30, "currency": 3, "original_currency": 3,
            "payment_method": 50, "payment_method_variant": 50, "card_bin": 6,
            "card_last_four": 4, "issuer_country": 5, "shopper_interaction": 30,
            "shopper_reference": 100, "acquirer_response_code": 10,
        },
        "decimal": {"amount": (15, 2), "original_amount": (15, 2), "amount_eur": (15, 2)},
    },
    "raw.rejected_events": {
        "key": [],
        "not_null": ["raw_payload", "rejection_reason"],
        "max_length": {"event_id": 50, "rejection_reason": 500},
        "decimal": {},
    },
    "analytics.merchant_daily_settlement": {
        "key": ["settlement_date", "merchant_id"],
        "not_null": ["settlement_date", "merchant_id"],
        "max_length": {"merchant_id": 50, "merchant_name": 200, "merchant_country": 5, "currency": 3},
        "decimal": {
            "total_authorized": (15, 2), "total_captured": (15, 2), "total_refunded": (15, 2),
            "total_chargebacks": (15, 2), "net_settlement_eur": (15, 2), "chargeback_ratio": (5, 4),
        },
    },
    "analytics.payment_method_performance": {
        "key": ["report_date", "payment_method", "issuer_country"],
        "not_null": ["report_date", "payment_method", "issuer_country"],
        "max_length": {"payment_method": 50, "issuer_country": 5},
        "decimal": {
            "authorization_rate": (5, 4), "avg_amount_eur": (15, 2),
            "total_volume_eur": (15, 2), "is_3ds_rate": (5, 4),
        },
    },
    "analytics.chargeback_alerts": {
        "key": ["alert_date", "merchant_id"],
        "not_null": ["alert_date", "merchant_id"],
        "max_length": {"merchant_id": 50, "merchant_name": 200, "threshold_exceeded": 20, "severity": 10},
        "decimal": {"chargeback_ratio": (5, 4), "visa_threshold": (5, 4), "mc_threshold": (5, 4)},
    },
    "analytics.conversion_funnel": {
        "key": ["report_date", "merchant_id"],
        "not_null": ["report_date", "merchant_id"],
        "max_length": {"merchant_id": 50},
        "decimal": {
            "auth_to_capture_rate": (5, 4), "capture_to_settle_rate": (5, 4),
            "refund_rate": (5, 4), "avg_auth_to_capture_hours": (10, 2),
        },
    },
    "analytics.data_quality_log": {
        "key": [],
        "not_null": [],
        "max_length": {
            "table_name": 100, "check_name": 100, "check_type": 50,
            "status": 10, "severity": 10,
        },
        "decimal": {"failure_percentage": (5, 2)},
    },
}

DATE = DateType()
