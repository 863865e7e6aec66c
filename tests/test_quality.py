"""Quality checks on hand-written tables: statuses, counts, isolation, gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from settlekit.operators import quality
from tests.conftest import plan_text

AS_OF = dt.datetime(2024, 1, 2, 0, 0, 0)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"u{i % 3}" if i != 4 else None, float(i), dt.datetime(2024, 1, 1, 23, 0) if i else None,
             "a" if i % 2 else "b")
            for i in range(10)] + [(99, "u1", 1000.0, dt.datetime(2024, 1, 1), "zz")]
    return spark.createDataFrame(rows, "id long, user string, v double, ts timestamp, kind string")


def run(df, checks, **kw):
    res = quality.run_table_checks(df, "t", checks, as_of=AS_OF, **kw)
    return {r["check_name"]: r for r in res.collect()}


def test_not_null_per_column(table):
    r = run(table, [{"check": "not_null", "columns": ["id", "user", "ts"]}])
    assert r["not_null_id"]["status"] == "PASS"
    assert (r["not_null_user"]["status"], r["not_null_user"]["records_failed"]) == ("FAIL", 1)
    assert r["not_null_user"]["failure_percentage"] == 9.09  # 1 / 11
    assert r["not_null_ts"]["severity"] == "critical"


def test_accepted_values_ignores_nulls_and_samples(table):
    r = run(table, [{"check": "accepted_values", "column": "kind", "values": ["a", "b"]}])
    x = r["accepted_values_kind"]
    assert (x["status"], x["records_checked"], x["records_failed"], x["severity"]) == ("FAIL", 11, 1, "warning")
    assert "Samples: [zz]" in x["details"]


def test_uniqueness_counts_null_as_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    r = run(df, [{"check": "uniqueness", "column": "k"}])["uniqueness_k"]
    assert (r["records_checked"], r["records_failed"], r["status"]) == (5, 2, "FAIL")


def test_range_bounds_optional_and_none(table):
    r = run(table, [{"check": "range_check", "column": "v", "min": 1},
                    {"check": "range_check", "column": "id"}])
    assert (r["range_v"]["records_checked"], r["range_v"]["records_failed"]) == (11, 1)
    assert "range_id" not in r  # no bounds, no result


def test_freshness(spark, table):
    r = run(table, [{"check": "freshness", "column": "ts", "max_age_hours": 2}])["freshness_ts"]
    assert r["status"] == "PASS" and r["records_failed"] == 0
    r = run(table, [{"check": "freshness", "column": "ts", "max_age_hours": 0.5}])["freshness_ts"]
    assert (r["status"], r["records_failed"], r["failure_percentage"]) == ("FAIL", 11, 100.0)
    empty = spark.createDataFrame([], "ts timestamp")
    r = run(empty, [{"check": "freshness", "column": "ts", "max_age_hours": 2}])["freshness_ts"]
    assert (r["status"], r["records_checked"], r["failure_percentage"]) == ("FAIL", 0, 100.0)
    dates = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    r = run(dates, [{"check": "freshness", "column": "d", "max_age_hours": 24}])["freshness_d"]
    assert r["status"] == "PASS"  # a date counts from midnight: exactly 24 h old


def test_referential_integrity_null_is_orphan(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (7,)], "fk int")
    ref = spark.createDataFrame([(1,), (2,), (3,)], "pk int")
    cfg = {"check": "referential_integrity", "column": "fk", "reference_table": "ref", "reference_column": "pk"}
    r = run(df, [cfg], refs={"ref": ref})["ref_integrity_fk_to_ref.pk"]
    assert (r["records_checked"], r["records_failed"], r["status"]) == (4, 2, "FAIL")


def test_outlier_warns_never_fails(spark, table):
    r = run(table, [{"check": "statistical_outlier", "column": "v", "n_stddev": 3}])["outlier_v"]
    assert (r["status"], r["records_failed"], r["records_checked"]) == ("WARN", 1, 11)
    const = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    r = run(const, [{"check": "statistical_outlier", "column": "v"}])["outlier_v"]
    assert (r["status"], r["records_failed"]) == ("PASS", 0)
    one = spark.createDataFrame([(5.0,)], "v double")
    assert run(one, [{"check": "statistical_outlier", "column": "v"}])["outlier_v"]["status"] == "PASS"


def test_grouped_outliers(spark):
    rows = [("a", float(x)) for x in [1, 1, 1, 1, 1, 1, 1, 1, 1, 50]] + [("b", 1000.0), ("b", 1001.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    r = run(df, [{"check": "statistical_outlier", "column": "v", "n_stddev": 2, "group_by": "g"}])
    assert r["outlier_v_by_g"]["records_failed"] == 1  # 50 in group a; group b is normal


def test_row_count(table):
    r = run(table, [{"check": "row_count", "min_rows": 100}])["row_count"]
    assert (r["status"], r["records_failed"], r["failure_percentage"]) == ("FAIL", 11, 100.0)


def test_error_isolation_and_unknown_check(table):
    r = run(table, [{"check": "not_null", "columns": ["nope"], "severity": "warning"},
                    {"check": "bogus"},
                    {"check": "row_count"},
                    {"check": "referential_integrity", "column": "id", "reference_table": "missing",
                     "reference_column": "x"}])
    assert r["not_null_error"]["status"] == "FAIL" and r["not_null_error"]["severity"] == "warning"
    assert r["referential_integrity_error"]["status"] == "FAIL"
    assert r["row_count"]["status"] == "PASS"
    assert len(r) == 3


def test_gate(table):
    ok = quality.run_table_checks(table, "t", [{"check": "row_count"}])
    assert quality.gate(ok)["critical"] == 0
    bad = quality.run_table_checks(table, "t", [{"check": "not_null", "columns": ["user"]}])
    with pytest.raises(quality.QualityGateError):
        quality.gate(bad)
    warn_only = quality.run_table_checks(table, "t", [{"check": "not_null", "columns": ["user"],
                                                       "severity": "warning"}])
    assert quality.gate(warn_only)["failed"] == 1


def test_stale_guard(table):
    quality.stale_data_guard(table, "ts", 6, as_of=AS_OF)
    with pytest.raises(ValueError):
        quality.stale_data_guard(table, "ts", 6, as_of=AS_OF + dt.timedelta(days=1))


def test_fused_checks_are_one_aggregate_pass(table):
    checks = [{"check": "not_null", "columns": ["id", "user"]},
              {"check": "range_check", "column": "v", "min": 0, "max": 10},
              {"check": "freshness", "column": "ts", "max_age_hours": 2},
              {"check": "row_count"}]
    res = quality.run_table_checks(table, "t", checks, as_of=AS_OF)
    plan = plan_text(res)
    # one scan of the table, one exchange (the final aggregate's single partition)
    leaves = [x for x in plan.split("\n") if x.lstrip("+- *:").startswith(("Scan", "LocalTableScan"))]
    tree = plan.split("\n\n")[0]
    assert sum(tree.count(x) for x in ("LocalTableScan", "Scan ExistingRDD", "Scan parquet")) == 1, leaves
    assert tree.count("Exchange") == 1
    assert res.count() == 5


def test_checks_that_cannot_run_fail_alone(table):
    r = run(table, [{"check": "range_check", "column": "kind", "min": 0}, {"check": "row_count"},
                    {"check": "statistical_outlier", "column": "kind"},
                    {"check": "freshness", "column": "kind", "max_age_hours": 2, "severity": "warning"}])
    assert r["row_count"]["status"] == "PASS"
    for t in ("range_check", "statistical_outlier", "freshness"):
        assert r[f"{t}_error"]["status"] == "FAIL"
    assert r["freshness_error"]["severity"] == "warning"
    arrays = run(table.withColumn("s", F.array("v")), [{"check": "range_check", "column": "s", "min": 0},
                                                       {"check": "row_count"}])
    assert arrays["range_check_error"]["status"] == "FAIL" and arrays["row_count"]["status"] == "PASS"


def test_percentage_is_half_even(spark):
    df = spark.range(800).select((F.col("id") + 0).alias("id"), F.when(F.col("id") > 0, 1).alias("x"))
    [r] = quality.run_table_checks(df, "t", [{"check": "not_null", "columns": ["x"]}]).collect()
    assert (r.records_failed, r.failure_percentage) == (1, 0.12)


def test_grouped_outlier_counts_null_groups_and_salts(spark, monkeypatch):
    rows = [(g, float(v)) for g in ("a", None) for v in [1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 90]]
    df = spark.createDataFrame(rows, "g string, v double")
    cfg = {"column": "v", "n_stddev": 2, "group_by": "g"}
    [r] = quality.check_statistical_outlier(df, cfg, "t").collect()
    assert (r.records_checked, r.records_failed) == (24, 2)
    monkeypatch.setattr(quality, "DEFAULT_BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = quality.check_statistical_outlier(df, cfg, "t")
        [r] = salted.collect()
        assert (r.records_checked, r.records_failed) == (24, 2)
        assert "_salt" in plan_text(salted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unreadable_table_fails_its_checks(spark, table):
    def read(name):
        if name == "gone":
            raise FileNotFoundError(name)
        return table

    res = quality.run_stored_suite(spark, read, {"here": [{"check": "row_count"}],
                                                 "gone": [{"check": "row_count"}, {"check": "freshness", "column": "ts",
                                                                                   "max_age_hours": 1}]})
    got = {(r.table_name, r.check_name): (r.status, r.severity) for r in res.collect()}
    assert got == {("here", "row_count"): ("PASS", "critical"), ("gone", "row_count_error"): ("FAIL", "critical"),
                   ("gone", "freshness_error"): ("FAIL", "warning")}
    with pytest.raises(quality.QualityGateError):
        quality.gate(res)
