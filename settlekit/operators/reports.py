"""Dashboard and run-summary reports over the marts, raw events and quality log.

Top-k reports add a full tie-break to their order so that the k rows are
the same on every run; Spark plans ``orderBy().limit(k)`` as a per-partition
top-k (TakeOrderedAndProject), never a global sort.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.functions.money import safe_ratio


def status_order() -> F.Column:
    """FAIL first, then WARN, then everything else."""
    return F.when(F.col("status") == "FAIL", 1).when(F.col("status") == "WARN", 2).otherwise(3)


def top_settlement(settlement: DataFrame, n: int = 20) -> DataFrame:
    """Largest net settlements."""
    return (settlement.orderBy(F.col("net_settlement_eur").desc(), "settlement_date", "merchant_id")
            .limit(n)
            .select("settlement_date", "merchant_id", "merchant_name", "net_settlement_eur"))


def auth_rate_series(performance: DataFrame) -> DataFrame:
    """(time, metric, value) points of the authorization-rate chart."""
    return performance.select(
        F.col("report_date").alias("time"),
        F.col("payment_method").alias("metric"),
        F.col("authorization_rate").alias("value"),
    ).orderBy("time")


def events_by_type(events: DataFrame) -> DataFrame:
    return (events.groupBy("event_type").agg(F.count(F.lit(1)).alias("total"))
            .orderBy(F.col("total").desc(), "event_type"))


def event_volume(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("total_events"))


def worst_funnel(funnel: DataFrame, n: int = 20) -> DataFrame:
    """Lowest auth-to-capture rates."""
    return (funnel.orderBy("auth_to_capture_rate", "report_date", "merchant_id").limit(n)
            .select("report_date", "merchant_id", "auth_to_capture_rate", "capture_to_settle_rate",
                    "refund_rate"))


def latest_run(log: DataFrame) -> DataFrame:
    """Rows of the newest check run (scalar sub-query on the max timestamp)."""
    newest = log.select(F.max("check_timestamp")).scalar()
    return log.filter(F.col("check_timestamp") == newest)


def quality_scoreboard(log: DataFrame) -> DataFrame:
    """Latest run, failures first, then warnings, then by table."""
    return latest_run(log).orderBy(status_order(), "table_name", "check_name").select(
        "table_name", "check_name", "check_type", "status", "severity", "records_checked",
        "records_failed", "failure_percentage", "details", "check_timestamp")


def quality_pass_rate(log: DataFrame) -> DataFrame:
    """Share of PASS in the latest run, 4 digits; NULL for an empty log."""
    agg = latest_run(log).agg(F.count_if(F.col("status") == "PASS").alias("_pass"),
                              F.count(F.lit(1)).alias("_n"))
    return agg.select(F.when(F.col("_n") > 0, safe_ratio("_pass", "_n")).alias("pass_rate"))


def quality_summary(log: DataFrame, as_of: _dt.datetime | None = None, hours: int = 1) -> DataFrame:
    """Per status over the last ``hours``: check count and critical failures."""
    now = (F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
           if as_of is not None else F.current_timestamp())
    recent = log.filter(F.col("check_timestamp") >= now - F.make_dt_interval(hours=F.lit(hours)))
    return (recent.groupBy("status").agg(
        F.count(F.lit(1)).alias("check_count"),
        F.count_if((F.col("severity") == "critical") & (F.col("status") == "FAIL")).alias("critical_failures"),
    ).orderBy("status"))


def pass_rate_band(rate_col: str = "pass_rate", bands: tuple[float, float] = (0.8, 0.95)) -> F.Column:
    """Dashboard colour of a pass rate: red < 0.8 <= orange < 0.95 <= green."""
    r = F.col(rate_col)
    return F.when(r < bands[0], "red").when(r < bands[1], "orange").when(r.isNotNull(), "green")
