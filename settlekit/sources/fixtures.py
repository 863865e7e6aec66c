"""Payment events derived from the given TPC-H-style tables.

Every order becomes one transaction whose lifecycle events are generated by
integer rules on the order key, so that any SQL engine can recompute the same
rows (see FIXTURES.md). The derivation is one scan of ``orders`` with a
broadcast of at most ten supplier rows and an in-task explode; the only
shuffle spreads the narrow rows of ``orders`` evenly over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.functions.money import to_eur
from settlekit.functions.time import format_event_time
from settlekit.operators.joins import join_small_side
from settlekit.schemas import (
    EVENT_FIELDS,
    EVENT_TYPES,
    MONEY,
    PAYMENT_EVENT_COLUMNS,
)
from settlekit.sources.tables import read_given

# ---------------------------------------------------------------------------
# Fixed values of the fixture derivation (FIXTURES.md §2, §3)
# ---------------------------------------------------------------------------
MERCHANT_COUNTRIES = ["NL", "DE", "FR", "GB", "US"]          # by s_nationkey % 5
METHOD_BY_KEY = ["visa", "visa", "mastercard", "ideal", "amex", "klarna", "sofort"]  # by k % 7
ISSUER_COUNTRIES = ["NL", "DE", "BE", "SE"]                  # by k % 4
DECLINE_CODES = {17: "05", 18: "51", 19: "54"}              # by k % 20 on authorizations
ORDERS_A_TASK = 250_000
CARD_METHODS = ["visa", "mastercard", "amex"]
MERCHANT_CATEGORY_CODE = "5999"
SHOPPER_INTERACTION = "ecommerce"
# Hours after the order date per lifecycle stage (sid): AUTHORIZATION 0,
# CAPTURE 5*(1 + k % 9), SETTLEMENT 40, REFUND 100, CHARGEBACK 100, CANCEL 1.


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _orders_with_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_totalprice"),
        F.col("o_orderdate"),
        (F.col("o_custkey") % 10).alias("m"),
    )
    # An input of few row groups scans as few tasks, however its bytes are split;
    # spread the narrow rows evenly, as each becomes several wide ones.
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_A_TASK))
    orders = orders.repartition(tasks)
    # Only suppliers 0..9 (and the negative mirror keys) can match
    # o_custkey % 10: the filter is pushed to the scan, and the broadcast side
    # is counted before it is shipped.
    suppliers = read_given(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("m"), "s_name", "s_nationkey"
    ).filter(F.col("m").between(-9, 9))
    return join_small_side(orders, suppliers, "m")


def _lifecycle(base: DataFrame) -> DataFrame:
    k, m = F.col("k"), F.col("m")
    captured = (k % 20 < 17) & (k % 25 < 23)
    sid = F.col("sid")
    exists = (
        (sid == 0)
        | ((sid == 1) & captured)
        | ((sid == 2) & captured & (k % 50 != 1))
        | ((sid == 3) & captured & (k % 11 == 3))
        | ((sid == 4) & captured & (k % 240 < m % 4))
        | ((sid == 5) & (k % 20 < 17) & (k % 25 >= 23))
    )
    return base.withColumn("sid", F.explode(F.sequence(F.lit(0), F.lit(5)))).filter(exists)


def _event_columns(df: DataFrame) -> DataFrame:
    k, sid = F.col("k"), F.col("sid")
    amt = F.col("o_totalprice").cast(MONEY)
    half = F.lit("0.5").cast("decimal(2,1)")
    amount = F.when((sid == 3) & (k % 3 == 0), F.round(amt * half, 2)).otherwise(amt).cast(MONEY)
    hours = (
        F.when(sid == 0, F.lit(0))
        .when(sid == 1, (k % 9 + 1) * 5)
        .when(sid == 2, F.lit(40))
        .when(sid.isin(3, 4), F.lit(100))
        .otherwise(F.lit(1))
    ).cast("long")
    ts = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + hours * 3600)
    country = _pick(MERCHANT_COUNTRIES, F.col("s_nationkey") % 5)
    currency = F.when(country == "GB", "GBP").when(country == "US", "USD").otherwise("EUR")
    method = _pick(METHOD_BY_KEY, k % 7)
    code = F.when((sid > 0) | (k % 20 < 17), F.lit("00"))
    for rem, c in DECLINE_CODES.items():
        code = code.when(k % 20 == rem, F.lit(c))
    return df.select(
        F.concat(F.lit("evt_"), (k * 10 + sid).cast("string")).alias("event_id"),
        F.concat(F.lit("PSP"), k.cast("string")).alias("psp_reference"),
        F.concat(F.lit("merchant_"), F.col("m").cast("string")).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        country.alias("merchant_country"),
        F.lit(MERCHANT_CATEGORY_CODE).alias("merchant_category_code"),
        _pick(EVENT_TYPES, sid).alias("event_type"),
        ts.alias("event_timestamp"),
        amount.alias("amount"),
        currency.alias("currency"),
        F.lit(None).cast(MONEY).alias("original_amount"),
        F.lit(None).cast("string").alias("original_currency"),
        method.alias("payment_method"),
        F.lit(None).cast("string").alias("payment_method_variant"),
        F.lit(None).cast("string").alias("card_bin"),
        F.lit(None).cast("string").alias("card_last_four"),
        _pick(ISSUER_COUNTRIES, k % 4).alias("issuer_country"),
        F.lit(SHOPPER_INTERACTION).alias("shopper_interaction"),
        F.concat(F.lit("shopper_"), F.col("ck").cast("string")).alias("shopper_reference"),
        code.alias("acquirer_response_code"),
        F.when(method.isin(CARD_METHODS), k % 10 < 7).alias("is_3ds_authenticated"),
        ((k * 37 + F.col("ck")) % 101).cast("int").alias("risk_score"),
        # kept for the delivery defects below; dropped from the stored shape
        k.alias("_k"),
        sid.alias("_sid"),
    )


def _events_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(_lifecycle(_orders_with_merchant(spark, sf_dir)))


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ``raw.payment_events`` shape (23 columns, no ``ingested_at``)."""
    ev = _events_with_keys(spark, sf_dir)
    ev = ev.withColumn("amount_eur", to_eur("amount", "currency"))
    return ev.select(*PAYMENT_EVENT_COLUMNS)


def raw_deliveries(spark: SparkSession, sf_dir: str, strict: bool = False, contract: bool = False) -> DataFrame:
    """Messages as delivered by the broker: one column ``value`` (JSON text).

    ``strict`` adds defects of time and range on AUTHORIZATION messages: an
    unparseable time, and amounts that are NaN, beyond DECIMAL(15,2), below a
    cent, or beyond it in EUR only. ``contract`` adds defects that pass the rules
    but not the stored table: an unparseable time, and texts that are too long.

    Defects on AUTHORIZATION messages (FIXTURES.md §3): NULL currency,
    unknown currency, unknown event type, negated amount, missing ids, a
    duplicate delivery, and an extra message that is not JSON.
    """
    ev = _events_with_keys(spark, sf_dir)
    k = F.col("_k")
    auth = F.col("_sid") == 0
    currency = (F.when(auth & (k % 997 == 0), F.lit(None).cast("string"))
                .when(auth & (k % 499 == 1), F.lit("XXX"))
                .otherwise(F.col("currency")))
    event_type = F.when(auth & (k % 503 == 2), F.lit("UNKNOWN")).otherwise(F.col("event_type"))
    amount = F.when(auth & (k % 401 == 3), -F.col("amount")).otherwise(F.col("amount")).cast("double")
    time = format_event_time("event_timestamp")
    if strict:
        time = F.when(auth & (k % 701 == 7), F.lit("yesterday")).otherwise(time)
        amount = (F.when(auth & (k % 709 == 8), F.lit(float("nan"))).when(auth & (k % 719 == 9), F.lit(1e14))
                  .when(auth & (k % 727 == 10), F.lit(0.001)).when(auth & (k % 733 == 11), F.lit(9e12))
                  .otherwise(amount))
        currency = F.when(auth & (k % 733 == 11), F.lit("GBP")).otherwise(currency)
    missing_ids = auth & (k % 307 == 4)
    event_id = F.when(missing_ids, F.lit(None).cast("string")).otherwise(F.col("event_id"))
    merchant_id = F.when(missing_ids, F.lit(None).cast("string")).otherwise(F.col("merchant_id"))
    texts = {}
    if contract:
        time = F.when(auth & (k % 701 == 7), F.lit("yesterday")).otherwise(time)
        event_id = F.when(auth & (k % 751 == 14), F.concat(event_id, F.repeat(F.lit("x"), 60))).otherwise(event_id)
        texts = {
            "issuer_country": F.when(auth & (k % 743 == 13), F.lit("NETHERLANDS")).otherwise(F.col("issuer_country")),
            "shopper_reference": F.when(auth & (k % 739 == 12), F.repeat(F.lit("s"), 120))
            .otherwise(F.col("shopper_reference")),
        }
    overrides = texts | {
        "event_id": event_id,
        "merchant_id": merchant_id,
        "event_type": event_type,
        "event_timestamp": time,
        "amount": amount,
        "currency": currency,
        "original_amount": F.col("original_amount").cast("double"),
    }
    message = F.to_json(F.struct(*[overrides.get(f, F.col(f)).alias(f) for f in EVENT_FIELDS]))
    copies = F.array(
        message,
        F.when(auth & (k % 211 == 5), message),
        F.when(auth & (k % 601 == 6), F.lit("not json")),
    )
    return ev.select(F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("value"))
