"""Parsing, validation, EUR conversion, de-duplication and insert-if-absent."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from settlekit.functions.money import half_up_quotient, money_avg, to_eur
from settlekit.operators import ingest
from tests.conftest import plan_text


def msg(**kw):
    base = {
        "event_id": "evt_1", "psp_reference": "PSP1", "merchant_id": "m1", "event_type": "AUTHORIZATION",
        "event_timestamp": "2024-01-01T10:00:00.123Z", "amount": 10.5, "currency": "EUR",
    }
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def annotate(spark, values, strict=False):
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    return ingest.annotate(ingest.parse_messages(raw), strict)


ALL_MISSING = ("missing_event_id, missing_psp_reference, missing_merchant_id, missing_amount, "
               "missing_currency, missing_event_type")


@pytest.mark.parametrize("text", ["not json", "", "null", "[]", None])
def test_unparseable_messages_are_missing_everything(spark, text):
    r = annotate(spark, [text]).first()
    assert r["rejection_reason"] == ALL_MISSING


def test_reasons_in_rule_order(spark):
    rows = annotate(spark, [
        msg(),
        msg(currency="XXX", event_type="BOGUS", amount=-1.0),
        msg(event_id=None, merchant_id=None),
        msg(amount=0.0),
        msg(currency=None),
    ]).select("rejection_reason").collect()
    assert [r[0] for r in rows] == [
        "",
        "invalid_currency, invalid_event_type, non_positive_amount",
        "missing_event_id, missing_merchant_id",
        "non_positive_amount",
        "missing_currency",
    ]


def test_wrong_type_field_turns_only_that_field_null(spark):
    r = annotate(spark, ['{"event_id":"e","psp_reference":"p","merchant_id":"m","event_type":"CAPTURE",'
                         '"amount":"12","currency":"EUR","risk_score":3.7}']).first()
    assert r["amount"] is None and r["risk_score"] is None
    assert r["rejection_reason"] == "missing_amount"


def test_strict_time_rejects_missing_and_bad_times(spark):
    rows = annotate(spark, [msg(event_timestamp=None), msg(event_timestamp="2024-01-01 10:00"),
                            msg()], strict=True).select("rejection_reason").collect()
    assert [r[0] for r in rows] == ["missing_event_timestamp", "invalid_event_timestamp", ""]
    # the lenient rule set accepts both; the time is then NULL, not an error
    lenient = annotate(spark, [msg(event_timestamp="2024-01-01 10:00")])
    v = ingest.valid_events(lenient).first()
    assert v["event_timestamp"] is None


def test_split_is_complete_and_disjoint(spark):
    values = [msg(event_id=f"e{i}", amount=(i - 3) * 1.0) for i in range(10)] + ["garbage"]
    a = annotate(spark, values)
    valid, rejected = ingest.valid_events(a), ingest.rejected_events(a)
    assert valid.count() + rejected.count() == len(values)
    assert valid.count() == 6
    rej = rejected.collect()
    assert all(r["raw_payload"] is not None and r["raw_value"] is not None for r in rej)
    assert {r["raw_value"] for r in rej} >= {"garbage"}


def test_fx_is_decimal_and_half_up(spark):
    df = spark.createDataFrame(
        [(Decimal("10.05"), "GBP"), (Decimal("1.25"), "USD"), (Decimal("100.00"), "SEK"),
         (Decimal("5.00"), "XXX"), (None, "EUR")],
        "amount decimal(15,2), currency string")
    got = [r[0] for r in df.select(to_eur("amount", "currency")).collect()]
    # 10.05 * 1.17 = 11.7585 -> 11.76 ; 1.25 * 0.92 = 1.15 ; 100 * 0.088 = 8.80
    assert got == [Decimal("11.76"), Decimal("1.15"), Decimal("8.80"), None, None]


def test_normalise_types_and_amount_eur(spark):
    v = ingest.valid_events(annotate(spark, [msg(amount=19.99, currency="NOK")])).first()
    assert v["amount"] == Decimal("19.99")
    assert v["amount_eur"] == Decimal("1.78")  # 19.99 * 0.089 = 1.77911
    assert str(v["event_timestamp"]) == "2024-01-01 10:00:00.123000"


def test_half_up_quotient_exact_on_large_groups(spark):
    rows = [(7, 2), (-7, 2), (1, 3), (2, 3), (123456789012345678, 1000), (5, 10000)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r[0] for r in df.select(half_up_quotient("n", "d", 2)).collect()]
    assert got == [Decimal("3.50"), Decimal("-3.50"), Decimal("0.33"), Decimal("0.67"),
                   Decimal("123456789012345.68"), Decimal("0.00")]
    # money average over a group far beyond 10,000 rows: exact cent sum / n
    df2 = spark.createDataFrame([(Decimal("100000000.05"), 20001)], "s decimal(25,2), n long")
    avg = df2.select(money_avg("s", "n")).first()[0]
    exact = (Decimal("10000000005") / 20001)
    assert avg == (exact / 100).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")


def test_dedup_is_deterministic_and_collapses(spark):
    df = spark.createDataFrame(
        [("e1", "b", 2), ("e1", "a", 9), ("e2", "x", 1), ("e1", "a", 1)],
        "event_id string, v string, n int")
    out = sorted(tuple(r) for r in ingest.dedup_events(df).collect())
    assert out == [("e1", "a", 1), ("e2", "x", 1)]


@pytest.mark.parametrize("bound", [0, 1000])
def test_insert_if_absent_first_writer_wins(spark, bound):
    stored = spark.createDataFrame([("e1", 1), ("e2", 2)], "event_id string, v int")
    incoming = spark.createDataFrame([("e2", 20), ("e3", 30), ("e3", 31)], "event_id string, v int")
    out = sorted(tuple(r) for r in ingest.insert_if_absent(incoming, stored, max_broadcast_rows=bound).collect())
    assert out == [("e3", 30), ("e3", 31)]


def test_insert_if_absent_broadcasts_batch_keys(spark):
    stored = spark.range(1000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"))
    incoming = spark.createDataFrame([("e5", 1), ("new", 2)], "event_id string, v int")
    df = ingest.insert_if_absent(incoming, stored)
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r[0] for r in df.collect()] == ["new"]


def test_size_probe_bound_and_join_choice(spark):
    from settlekit.operators.joins import fits, join_small_side

    three = spark.range(3)
    assert fits(three, 3) and not fits(three, 2) and fits(three.limit(0), 0)
    large = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(3).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan_text(join_small_side(large, small, "k", max_rows=3))
    # above the bound no broadcast is forced; the planner decides by its own statistics
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        over = join_small_side(large, small, "k", max_rows=2)
        assert "BroadcastHashJoin" not in plan_text(over)
        assert over.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
