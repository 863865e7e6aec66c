"""Physical-plan properties: no pair joins, no Python in the hot path, pushdown."""

import re

import pytest

import __spark_entry__ as E
from settlekit.operators import marts, quality
from settlekit.sources.fixtures import payment_events
from tests.conftest import SF_SMALL, plan_text

# the stream keys run their stream when called; covered by test_oracle
KEYS = sorted(k for k in E.queries() if not k.startswith("stream_"))


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_join_and_no_python_udf(spark, key):
    plan = plan_text(E.queries()[key](spark, SF_SMALL))
    for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{key}: {bad}"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "payment_events")
    payment_events(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_performance_filter_and_columns_reach_the_scan(spark, stored):
    plan = plan_text(marts.payment_method_performance(stored))
    assert "EqualTo(event_type,AUTHORIZATION)" in plan
    read = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert read and all("shopper_reference" not in ln and "card_bin" not in ln for ln in read)


def test_alerts_prune_to_needed_columns(spark, stored):
    plan = plan_text(marts.chargeback_alerts(stored))
    assert "In(event_type, [AUTHORIZATION,CHARGEBACK])" in plan
    assert "Subquery" in plan  # alert date: scalar sub-query, not collect / join


def test_settlement_is_one_shuffle(spark, stored):
    plan = plan_text(marts.merchant_settlement(stored))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    exchanges = [ln for ln in plan.splitlines() if ln.startswith("Arguments: hashpartitioning")]
    assert len(exchanges) == 1


def test_fused_checks_scan_once(spark, stored):
    checks = [{"check": "not_null", "columns": ["event_id", "amount"]},
              {"check": "range_check", "column": "amount", "min": 0.01, "max": 999999.99},
              {"check": "range_check", "column": "risk_score", "min": 0, "max": 100},
              {"check": "freshness", "column": "event_timestamp", "max_age_hours": 2},
              {"check": "row_count"}]
    plan = plan_text(quality.run_table_checks(stored, "raw", checks))
    scans = [ln for ln in plan.splitlines() if re.match(r"^\(\d+\) Scan parquet", ln)]
    assert len(scans) == 1
