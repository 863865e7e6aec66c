"""Check catalogue of the payment tables, and checks over the given ``events``.

Add a dict to add a check; severity ``critical`` blocks the pipeline.
"""

from __future__ import annotations

import datetime as _dt

from settlekit.schemas import CURRENCIES, EVENT_TYPES, FRESHNESS_CHECK_HOURS

# ---------------------------------------------------------------------------
# The suite of the payment tables (tables, checks, bounds,
# severities); the alerts table has no checks.
# ---------------------------------------------------------------------------
QUALITY_CHECKS = {
    "raw.payment_events": [
        {"check": "not_null",
         "columns": ["event_id", "psp_reference", "amount", "currency", "event_type", "merchant_id"],
         "severity": "critical"},
        {"check": "accepted_values", "column": "currency", "values": CURRENCIES, "severity": "critical"},
        {"check": "accepted_values", "column": "event_type", "values": EVENT_TYPES, "severity": "critical"},
        {"check": "uniqueness", "column": "event_id", "severity": "critical"},
        {"check": "range_check", "column": "amount", "min": 0.01, "max": 999999.99, "severity": "warning"},
        {"check": "range_check", "column": "risk_score", "min": 0, "max": 100, "severity": "warning"},
        {"check": "freshness", "column": "event_timestamp", "max_age_hours": FRESHNESS_CHECK_HOURS,
         "severity": "warning"},
        {"check": "statistical_outlier", "column": "amount", "n_stddev": 3, "severity": "warning"},
        {"check": "row_count", "min_rows": 1, "severity": "critical"},
    ],
    "analytics.merchant_daily_settlement": [
        {"check": "not_null", "columns": ["settlement_date", "merchant_id", "net_settlement_eur"],
         "severity": "critical"},
        {"check": "referential_integrity", "column": "merchant_id", "reference_table": "raw.payment_events",
         "reference_column": "merchant_id", "severity": "warning"},
        {"check": "row_count", "min_rows": 1, "severity": "critical"},
        {"check": "range_check", "column": "chargeback_ratio", "min": 0.0, "max": 1.0, "severity": "warning"},
    ],
    "analytics.payment_method_performance": [
        {"check": "not_null", "columns": ["report_date", "payment_method", "authorization_rate"],
         "severity": "critical"},
        {"check": "range_check", "column": "authorization_rate", "min": 0.0, "max": 1.0, "severity": "warning"},
        {"check": "row_count", "min_rows": 1, "severity": "critical"},
    ],
    "analytics.conversion_funnel": [
        {"check": "not_null", "columns": ["report_date", "merchant_id", "authorized_count"],
         "severity": "critical"},
        {"check": "range_check", "column": "auth_to_capture_rate", "min": 0.0, "max": 1.0,
         "severity": "warning"},
        {"check": "row_count", "min_rows": 1, "severity": "critical"},
    ],
}

# The reference time of the registered quality queries (freshness ages and
# the run timestamp of the log), fixed so that results are reproducible.
QUERY_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)

# Checks over the given click-stream table ``events``: each check type with
# a passing and a failing case.
EVENTS_CHECKS = {
    "not_null": [{"check": "not_null",
                  "columns": ["event_id", "ts", "user_id", "event_type", "value", "props"]}],
    "accepted_values": [
        {"check": "accepted_values", "column": "event_type",
         "values": ["view", "click", "purchase", "signup", "error"]},
        {"check": "accepted_values", "column": "event_type",
         "values": ["view", "click", "purchase", "signup"], "severity": "critical"},
    ],
    "uniqueness": [{"check": "uniqueness", "column": "event_id"},
                   {"check": "uniqueness", "column": "user_id"}],
    "range_check": [{"check": "range_check", "column": "value", "min": 0, "max": 100},
                    {"check": "range_check", "column": "value", "min": 0.0},
                    {"check": "range_check", "column": "user_id", "max": 99}],
    "freshness": [{"check": "freshness", "column": "ts", "max_age_hours": 2},
                  {"check": "freshness", "column": "ts", "max_age_hours": 0.01, "severity": "critical"}],
    "referential_integrity": [
        {"check": "referential_integrity", "column": "user_id", "reference_table": "customer",
         "reference_column": "c_custkey"},
        {"check": "referential_integrity", "column": "user_id", "reference_table": "supplier",
         "reference_column": "s_suppkey"},
    ],
    "statistical_outlier": [{"check": "statistical_outlier", "column": "value", "n_stddev": 3},
                            {"check": "statistical_outlier", "column": "user_id", "n_stddev": 1.5}],
    "row_count": [{"check": "row_count", "min_rows": 1},
                  {"check": "row_count", "min_rows": 1_000_000_000}],
    "outlier_grouped": [{"check": "statistical_outlier", "column": "value", "n_stddev": 2,
                         "group_by": "event_type"}],
}

# Checks over ``events`` that can't be run, one of each kind, among good ones.
ERROR_CHECKS = [
    {"check": "row_count", "min_rows": 1},
    {"check": "range_check", "column": "props", "min": 0},
    {"check": "statistical_outlier", "column": "props"},
    {"check": "freshness", "column": "event_type", "max_age_hours": 2},
    # values that the column's type can't be compared with
    {"check": "accepted_values", "column": "user_id", "values": ["x"]},
    {"check": "range_check", "column": "value", "min": "low"},
    {"check": "row_count", "min_rows": "many", "severity": "warning"},
    {"check": "not_null", "columns": ["no_such_column"]},
    {"check": "referential_integrity", "column": "user_id", "reference_table": "no_such_table",
     "reference_column": "id", "severity": "warning"},
    {"check": "not_null", "columns": ["event_id", "ts"]},
    {"check": "statistical_outlier", "column": "value", "n_stddev": 3},
]
