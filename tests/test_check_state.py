"""Monthly check states, key indexes in checks, isolation at run time, bounded samples."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from settlekit.operators import ingest, marts, quality
from settlekit.operators.check_state import incremental_checks, state_table
from settlekit.plans.pipeline import run_batch
from settlekit.sinks.snapshots import open_table
from settlekit.sources.tables import read_table
from settlekit.streaming.ingest import IngestSink
from tests.conftest import plan_text

CHECKS = [
    {"check": "not_null", "columns": ["id", "amount"]},
    {"check": "accepted_values", "column": "kind", "values": ["A", "B"]},
    {"check": "range_check", "column": "amount", "min": 0, "max": 50},
    {"check": "freshness", "column": "at", "max_age_hours": 2},
    {"check": "row_count", "min_rows": 3},
    {"check": "uniqueness", "column": "id"},
    {"check": "statistical_outlier", "column": "amount", "n_stddev": 2},
]
AS_OF = dt.datetime(2024, 4, 1)
SCHEMA = "id string, kind string, amount double, at timestamp, event_month string"


def _rows(spark, months):
    rows = [(f"{m}-{k}" if k else None, "ABCD"[k % 4], None if k == 3 else 10.0 + k + (500 if m == "2024-02" and k == 7 else 0),
             dt.datetime(2024, int(m[-2:]), 1 + k) if m else None, m or None) for m in months for k in range(12)]
    return spark.createDataFrame(rows, SCHEMA)


def _store(df, path):
    df.write.mode("overwrite").partitionBy("event_month").parquet(path)
    return df.sparkSession.read.parquet(path).select("id", "kind", "amount", "at", "event_month")


def _result(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_suite_equals_the_full_one_and_reads_new_months_only(spark, tmpdir_path):
    path, root = f"{tmpdir_path}/t", f"{tmpdir_path}/state"

    def full(df):
        return _result(quality.run_table_checks(df, "t", CHECKS, as_of=AS_OF))

    def inc(df, **more):
        return _result(incremental_checks(df, "t", CHECKS, root, as_of=AS_OF, **more))

    one = _store(_rows(spark, ["2024-01", "2024-02", ""]), path)
    assert inc(one) == full(one)
    two = _store(_rows(spark, ["2024-01", "2024-02", "2024-03", ""]), path)
    assert inc(two) == full(two)
    assert open_table(spark, root, state_table("t")).count() == 4
    # rows of months that are stored already are not evaluated: they would raise
    poisoned = two.withColumn("kind", F.when(F.col("event_month") == "2024-01", F.raise_error(F.lit("read"))).otherwise(F.col("kind")))
    assert inc(poisoned) == full(two)
    with pytest.raises(Exception):
        full(poisoned)
    # a changed month is read again, one that is gone is taken out
    more = _store(_rows(spark, ["2024-01", "2024-02", "2024-03"]).filter("event_month <> '2024-02' OR amount < 100"), path)
    assert inc(more, changed=["2024-02"]) == full(more)
    # another configuration reads all months
    other = [*CHECKS, {"check": "range_check", "column": "amount", "min": 11}]
    assert _result(incremental_checks(more, "t", other, root, as_of=AS_OF)) == _result(
        quality.run_table_checks(more, "t", other, as_of=AS_OF))


def test_the_scan_of_new_months_is_pruned(spark, tmpdir_path):
    from settlekit.operators.check_state import _in_months

    df = _store(_rows(spark, ["2024-01", "2024-02", "2024-03"]), f"{tmpdir_path}/t")
    text = plan_text(df.filter(_in_months("event_month", {"2024-03"})).groupBy("event_month").count())
    assert "PartitionFilters: [event_month" in text or "PartitionFilters: [isnotnull(event_month" in text


def test_an_index_of_keys_replaces_the_shuffle(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    index = df.distinct()
    cfg = {"check": "uniqueness", "column": "id"}
    assert _result(quality.check_uniqueness(df, cfg, "t", index)) == _result(quality.check_uniqueness(df, cfg, "t"))
    stored = spark.range(5).select(F.col("id").cast("string").alias("id"))
    assert "hashpartitioning" not in plan_text(quality.check_uniqueness(stored, cfg, "t", stored))
    ref = {"check": "referential_integrity", "column": "id", "reference_table": "r", "reference_column": "id"}
    want = _result(quality.check_referential_integrity(df, ref, "t", spark.createDataFrame([("a",), ("a",)], "id string")))
    assert want == _result(quality.check_referential_integrity(df, ref, "t", df, spark.createDataFrame([("a",)], "id string")))


def test_a_check_that_fails_while_it_runs_costs_its_own_row(spark):
    df = spark.range(4).select(F.col("id"), F.when(F.col("id") == 3, F.raise_error(F.lit("broken row"))).otherwise(F.lit(1)).alias("x"))
    checks = [{"check": "row_count", "min_rows": 1}, {"check": "range_check", "column": "x", "min": 0},
              {"check": "not_null", "columns": ["id"]}]
    got = {r.check_name: r.status for r in quality.executed_checks(df, "t", checks).collect()}
    assert got == {"row_count": "PASS", "range_check_error": "FAIL", "not_null_id": "PASS"}


@pytest.mark.parametrize("cfg", [
    {"check": "accepted_values", "column": "n", "values": ["x"]}, {"check": "range_check", "column": "n", "min": "low"},
    {"check": "range_check", "column": "t", "max": "soon"}, {"check": "row_count", "min_rows": "many"},
    {"check": "freshness", "column": "t", "max_age_hours": "long"}, {"check": "statistical_outlier", "column": "n", "n_stddev": "x"},
    {"check": "accepted_values", "column": "b", "values": ["perhaps"]},
])
def test_values_of_another_kind_are_an_error_of_that_check(spark, cfg):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), True)], "n int, t timestamp, b boolean")
    got = [(r.check_name, r.status) for r in quality.run_table_checks(
        df, "t", [cfg, {"check": "row_count", "min_rows": 1}], as_of=AS_OF).collect()]
    assert sorted(got) == sorted([(f"{cfg['check']}_error", "FAIL"), ("row_count", "PASS")])


def test_values_compare_in_the_type_of_their_column(spark):
    df = spark.createDataFrame([(1, "1", dt.date(2024, 1, 1)), (2, "x", dt.date(2024, 2, 1))], "n int, s string, d date")
    checks = [{"check": "accepted_values", "column": "n", "values": ["1"]}, {"check": "accepted_values", "column": "s", "values": [1]},
              {"check": "range_check", "column": "d", "min": "2024-01-15"}, {"check": "range_check", "column": "n", "max": 1.5}]
    got = {r.check_name: (r.records_failed, r.details) for r in quality.run_table_checks(df, "t", checks).collect()}
    assert {k: v[0] for k, v in got.items()} == {"accepted_values_n": 1, "accepted_values_s": 1, "range_d": 1, "range_n": 1}
    assert got["accepted_values_s"][1].endswith("Samples: [x]")


def test_samples_ride_along_in_the_fused_pass(spark):
    df = spark.createDataFrame([(f"v{k}",) for k in range(40)] + [("ok",), (None,)], "v string")
    res = quality.run_table_checks(df, "t", [{"check": "accepted_values", "column": "v", "values": ["ok"]},
                                             {"check": "not_null", "columns": ["v"]}])
    assert "Subquery" not in plan_text(res, "formatted")
    row = [r for r in res.collect() if r.check_type == "accepted_values"][0]
    shown = row.details.split("[")[1].rstrip("]").split(", ")
    assert row.records_failed == 40 and len(shown) == 5 and len(set(shown)) == 5 and shown[0] == "v0"


def test_funnel_needs_three_exchanges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = spark.createDataFrame([("p", "m", "AUTHORIZATION", dt.datetime(2024, 1, 1))],
                                   "psp_reference string, merchant_id string, event_type string, event_timestamp timestamp")
        text = plan_text(marts.conversion_funnel(ev), "simple")
        assert text.count("Exchange hashpartitioning") <= 3 and "SortMergeJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unique_rows_are_not_sorted_by_deduplication(spark):
    rows = [(f"e{k % 9}", k, "x" * k) for k in range(10)] + [(None, 1, "a"), (None, 0, "b")]
    df = spark.createDataFrame(rows, "event_id string, n int, t string")
    got = ingest.dedup_events(df)
    assert sorted(map(str, got.collect())) == sorted(map(str, ingest.dedup_batch(df).collect()))
    text = plan_text(got, "simple")   # rows of single keys: a broadcast anti-join, no exchange, no sort
    once = text[text.index("Union"):].split("SortAggregate")[0]
    assert "Sort [" not in once.split("BroadcastExchange")[0]


def test_batch_over_a_stream_uses_month_states_and_the_key_index(spark, tmpdir_path):
    def message(event_id, time):
        return ('{"event_id":"%s","psp_reference":"p%s","merchant_id":"m","event_type":"AUTHORIZATION","amount":1.5,'
                '"currency":"EUR","payment_method":"visa","issuer_country":"NL","event_timestamp":"%s"}' % (event_id, event_id, time))

    sink = IngestSink(tmpdir_path)
    sink(spark.createDataFrame([(message("a", "2024-01-31T10:00:00.000Z"),)], "value string"), 0)
    sink(spark.createDataFrame([(message("b", "2024-02-01T10:00:00.000Z"),), (message("a", "2024-02-01T10:00:00.000Z"),)],
                               "value string"), 1)
    as_of = dt.datetime(2024, 2, 1, 11)
    whole = run_batch(spark, tmpdir_path, as_of=as_of, enforce_gate=False)
    part = run_batch(spark, tmpdir_path, as_of=as_of + dt.timedelta(minutes=5), enforce_gate=False, since=dt.date(2024, 2, 1))

    def seen(res):
        return sorted((r.table_name, r.check_name, r.status, r.records_checked, r.records_failed) for r in res.results.collect())

    assert seen(whole) == seen(part) and len(seen(whole)) >= 30
    assert open_table(spark, tmpdir_path, state_table("raw.payment_events")).count() == 2
    assert read_table(spark, "raw.payment_events", root=tmpdir_path).count() == 2
