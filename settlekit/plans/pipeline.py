"""The daily batch: stale-data guard -> four marts -> their checks -> summary.

All work runs on one session. The raw table is read per mart with only the
columns that mart needs (Parquet pruning) rather than cached whole: at scale a
cache of the raw table would not fit, while the marts are small. Each mart is
computed once, checked against its write contract, cast to its stored types and
only then written; a mart without rows replaces the stored one too (an alert
that no longer holds must go). Without any input events nothing is written.
Quality checks of the marts read the written mart tables back; a table that
can't be read fails its checks.

The day-grained marts (settlement, performance, funnel) are stored partitioned
by ``report_month``. With ``since`` only changed months are recomputed and
replaced: the months from ``since`` on and, for the funnel (which counts a
transaction's later events with its authorization day), every month that holds
an authorization of a transaction with an event since then. The result is the
same as a full recompute. Alerts always read the whole history (two columns).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.operators import check_state, marts, quality, reports
from settlekit.plans.catalogue import QUALITY_CHECKS
from settlekit.schemas import STALE_GUARD_HOURS
from settlekit.sinks.contracts import enforced
from settlekit.session import stage_table
from settlekit.sinks.snapshots import open_table, replace_table
from settlekit.sinks.tables import stamp, write_table
from settlekit.sources.tables import read_table
from settlekit.streaming import key_index

PART_COL = "report_month"
# day column of each day-grained mart
MART_DAY = {
    "analytics.merchant_daily_settlement": "settlement_date",
    "analytics.payment_method_performance": "report_date",
    "analytics.conversion_funnel": "report_date",
}

MARTS = {
    "analytics.merchant_daily_settlement": marts.merchant_settlement,
    "analytics.payment_method_performance": marts.payment_method_performance,
    "analytics.chargeback_alerts": marts.chargeback_alerts,
    "analytics.conversion_funnel": marts.conversion_funnel,
}
RAW = "raw.payment_events"
LOG = "analytics.data_quality_log"


@dataclass
class BatchResult:
    results: DataFrame      # this run's check rows (with check_timestamp)
    summary: DataFrame      # per status over the last hour of the log
    gate: dict              # counts; raises before returning on a critical failure


def recent_events(events: DataFrame, since: _dt.date) -> DataFrame:
    """Events from the first day of ``since``'s month on.

    The time filter reaches the Parquet scan (row-group statistics); a stored
    ``event_month`` partition column (the stream sink's layout) prunes files.
    """
    start = _dt.datetime(since.year, since.month, 1)
    out = events.filter(F.col("event_timestamp") >= F.lit(start.isoformat(sep=" ")).cast("timestamp"))
    if "event_month" in events.columns:
        out = out.filter(F.col("event_month") >= F.lit(start.strftime("%Y-%m")))
    return out


def months_of(events: DataFrame) -> list[str]:
    """Distinct event months (at most one value per month of history)."""
    month = F.date_format("event_timestamp", "yyyy-MM")
    return sorted(r[0] for r in events.select(month.alias("m")).filter("m is not null").distinct().collect())


def funnel_input(events: DataFrame, since: _dt.date) -> tuple[DataFrame, list[str]]:
    """Events that the changed funnel months need, and those months.

    Changed transactions are those with an event since; the months of their
    authorizations change, and a month's rows need all events of every
    transaction authorized in it.
    """
    auth = F.col("event_type") == marts.AUTH
    changed = recent_events(events, since).select("psp_reference").distinct()
    months = months_of(events.filter(auth).join(changed, "psp_reference", "left_semi"))
    in_months = F.date_format("event_timestamp", "yyyy-MM").isin(months)
    wanted = events.filter(auth & in_months).select("psp_reference").distinct()
    rows = events.join(wanted, "psp_reference", "left_semi")
    return rows.filter(~auth | in_months), months


def compute_mart(events: DataFrame, name: str, since: _dt.date | None) -> DataFrame:
    """The mart, or with ``since`` its changed months."""
    if since is None or name not in MART_DAY:
        return MARTS[name](events)
    if name == "analytics.conversion_funnel":
        return MARTS[name](funnel_input(events, since)[0])
    return MARTS[name](recent_events(events, since))


def write_mart(mart: DataFrame, name: str, root: str, since: _dt.date | None, *, fmt: str = "parquet",
               jdbc: dict | None = None) -> None:
    """Check, cast and write a mart: full replace, or (with ``since``) replace only the recomputed months.

    Parquet marts are replaced at once: the new rows are written beside the old
    ones and shown by one commit, so the mart is readable all the time and a
    writer that dies leaves the old one.
    """
    mart = enforced(mart, name)
    if fmt != "parquet":
        if since is not None and name in MART_DAY:
            raise ValueError("since needs month-partitioned Parquet tables")
        write_table(stamp(mart), name, mode="overwrite", root=root, fmt=fmt, jdbc=jdbc)
        return
    if name not in MART_DAY:
        replace_table(stamp(mart), root, name)
        return
    out = stamp(mart).withColumn(PART_COL, F.date_format(MART_DAY[name], "yyyy-MM"))
    months = None
    if since is not None:   # one value per recomputed month; the mart is staged
        months = [r[0] for r in out.select(PART_COL).distinct().collect()]
    replace_table(out, root, name, partition_by=[PART_COL], values=months)


def check_tables(spark: SparkSession, read, root: str | None, as_of: _dt.datetime, since: _dt.date | None,
                 stored_raw: bool) -> DataFrame:
    """The suite over the stored tables.

    With ``since`` and a raw table that is partitioned by month, the raw table's
    checks read changed months only and merge the states of the others. Event ids
    of a stream's raw table are counted in its key index.
    """
    keys = open_table(spark, root, key_index.TABLE) if root is not None and stored_raw else None
    indexes = {} if keys is None else {(RAW, key_index.KEY): keys.select(key_index.KEY)}
    raw = read(RAW)
    if since is None or root is None or check_state.MONTH not in raw.columns:
        return quality.run_stored_suite(spark, read, QUALITY_CHECKS, as_of=as_of, execute=True, indexes=indexes)
    rest = {t: c for t, c in QUALITY_CHECKS.items() if t != RAW}
    out = quality.run_stored_suite(spark, read, rest, as_of=as_of, execute=True, indexes=indexes)
    changed = [m for m in months_of(recent_events(raw, since))]
    try:
        own = stage_table(check_state.incremental_checks(
            raw, RAW, QUALITY_CHECKS[RAW], root, changed=changed, as_of=as_of, indexes=indexes).coalesce(1), "checks")
    except Exception:  # noqa: BLE001 - one check fails while it runs: isolate them
        own = quality.executed_checks(raw, RAW, QUALITY_CHECKS[RAW], as_of=as_of, indexes=indexes)
    return own.unionByName(out)


def run_batch(spark: SparkSession, root: str, *, events: DataFrame | None = None,
              as_of: _dt.datetime | None = None, guard: bool = True,
              enforce_gate: bool = True, since: _dt.date | None = None, fmt: str = "parquet",
              jdbc: dict | None = None) -> BatchResult:
    """Compute, check and write the marts under ``root`` (Parquet tables, or JDBC with ``fmt``).

    ``events`` defaults to the stored raw table. ``as_of`` fixes "now" for
    freshness and the run timestamp (default: the current time). ``since``
    recomputes the changed months of the day-grained marts only.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stored = {"root": root, "fmt": fmt, "jdbc": jdbc}
    stored_raw = events is None
    if stored_raw:
        events = read_table(spark, RAW, **stored)
    run_ts = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if guard:
        quality.stale_data_guard(events, max_age_hours=STALE_GUARD_HOURS, as_of=run_ts)

    if not events.isEmpty():  # no input at all: keep the previous content
        for name in MARTS:
            write_mart(compute_mart(events, name, since), name, root, since, fmt=fmt, jdbc=jdbc)

    def read(name: str) -> DataFrame:
        return events if name == RAW else read_table(spark, name, **stored)

    found = check_tables(spark, read, root if fmt == "parquet" else None, run_ts, since, stored_raw)
    results = quality.with_check_timestamp(found, run_ts)
    write_table(results, LOG, mode="append", root=root, fmt=fmt, jdbc=jdbc)
    log = read_table(spark, LOG, **stored)
    summary = reports.quality_summary(log, as_of=run_ts)
    written = log.filter(F.col("check_timestamp") == F.lit(run_ts.isoformat(sep=" ")).cast("timestamp"))
    counts = quality.gate(written) if enforce_gate else {}
    return BatchResult(written, summary, counts)
