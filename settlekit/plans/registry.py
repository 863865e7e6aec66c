"""Named queries over the given tables: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.functions.money import to_eur
from settlekit.functions.time import parse_event_time
import datetime as _dt

from settlekit.operators import ingest, marts, quality, reports
from settlekit.plans.catalogue import ERROR_CHECKS, EVENTS_CHECKS, QUALITY_CHECKS, QUERY_AS_OF
from settlekit.schemas import EVENT_FIELDS, MONEY, PAYMENT_EVENT_COLUMNS, PAYMENT_EVENT_JSON_SCHEMA
from settlekit.session import scratch_path, shared_dir, stage_table
from settlekit.sources.fixtures import payment_events, raw_deliveries
from settlekit.sources.tables import read_given
from settlekit.streaming.ingest import REJECTED, read_stored, run_available_now


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return payment_events(spark, sf_dir)


def merchant_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.merchant_settlement(_events(spark, sf_dir))


def payment_method_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.payment_method_performance(_events(spark, sf_dir))


def chargeback_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.chargeback_alerts(_events(spark, sf_dir))


def txn_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.transaction_lifecycle(_events(spark, sf_dir))


def conversion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.conversion_funnel(_events(spark, sf_dir))


def funnel_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel where transactions have several captures (every third) and authorizations (every seventh)."""
    ev = _events(spark, sf_dir)
    number = F.substring("psp_reference", 4, 20).cast("long")
    again = ev.filter(((F.col("event_type") == marts.CAPTURE) & (number % 3 == 0))
                      | ((F.col("event_type") == marts.AUTH) & (number % 7 == 0)))
    later = again.withColumns({"event_id": F.concat("event_id", F.lit("_b")), "payment_method": F.lit(None).cast("string"),
                               "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 200 MINUTE")})
    return marts.conversion_funnel(ev.unionByName(later))


def auth_to_capture_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.auth_capture_latency(_events(spark, sf_dir))


# --- ingest -----------------------------------------------------------------


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return ingest.annotate(ingest.parse_messages(raw_deliveries(spark, sf_dir)))


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered message parsed: 22 fields, event time typed."""
    parsed = ingest.parse_messages(raw_deliveries(spark, sf_dir))
    return parsed.select(*[parse_event_time(f).alias(f) if f == "event_timestamp" else F.col(f)
                           for f in EVENT_FIELDS])


def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).select("event_id", "psp_reference", "event_type", ingest.REASON)


def fx_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EUR amounts of every delivered message (NULL for unknown currencies)."""
    parsed = ingest.parse_messages(raw_deliveries(spark, sf_dir))
    amount = F.col("amount").try_cast(MONEY)
    return parsed.select("event_id", "currency", amount.alias("amount"),
                         to_eur(amount, F.col("currency")).alias("amount_eur"))


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.dedup_events(ingest.valid_events(_annotated(spark, sf_dir)))


def _dead_letters(rejected: DataFrame) -> DataFrame:
    """Id, reasons and fields of the stored payload, read back from its JSON."""
    payload = F.from_json("raw_payload", PAYMENT_EVENT_JSON_SCHEMA)
    return rejected.withColumn("p", payload).select(
        "event_id", ingest.REASON, "p.psp_reference", "p.event_type", "p.currency", "p.amount",
        parse_event_time("p.event_timestamp").alias("event_timestamp"))


def ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dead_letters(ingest.rejected_events(_annotated(spark, sf_dir)))


def ingest_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of every message in strict mode, with bad times, NaN and amounts out of range delivered too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    parsed = ingest.parse_messages(raw_deliveries(spark, sf_dir, strict=True))
    return ingest.annotate(parsed, strict_time=True).select("event_id", "psp_reference", ingest.REASON)


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice (a full replay) collapses to one row."""
    ev = _events(spark, sf_dir)
    return ingest.dedup_events(ev.unionByName(ev))


def dedup_unequal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are delivered again, a cent cheaper: the smaller row survives, all other rows are single."""
    ev = _events(spark, sf_dir)
    less = (F.col("amount") - F.lit("0.01").cast(MONEY)).cast(MONEY)
    again = ev.filter(F.col("event_type") == "CAPTURE").withColumns(
        {"amount": less, "amount_eur": to_eur(less, F.col("currency"))})
    return ingest.dedup_events(ev.unionByName(again))


def upsert_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authorizations and captures are stored; a replay of all events with
    corrected (doubled) amounts arrives: stored rows win, the rest is inserted."""
    ev = _events(spark, sf_dir)
    stored = ev.filter(F.col("event_type").isin("AUTHORIZATION", "CAPTURE"))
    doubled = (F.col("amount") * 2).cast(MONEY)
    replay = ev.withColumns({"amount": doubled, "amount_eur": to_eur(doubled, F.col("currency"))})
    return stored.unionByName(ingest.insert_if_absent(replay, stored))


def _stream_root(spark: SparkSession, sf_dir: str) -> str:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = scratch_path(spark, "stream")
    files = _inbox(spark, sf_dir, f"{root}/inbox")
    # drained in two batches: duplicates may meet in one (dedup) or in both (insert-if-absent)
    run_available_now(spark, f"{root}/inbox", root, max_files=max(1, -(-files // 2)))
    return root


INBOX_RECORDS = 250_000  # messages in a file at most


def _inbox(spark: SparkSession, sf_dir: str, path: str, least: int = 1, records: int = INBOX_RECORDS, **defects) -> int:
    """Write the delivered messages as files whose number follows the data; returns it.

    ``least``: files that there are at least (where there are as many messages).
    """
    raw = raw_deliveries(spark, sf_dir, **defects)
    if spark.sparkContext.defaultParallelism < least:   # the tasks of a small cluster write too few
        raw = raw.repartition(least)
    raw.write.option("maxRecordsPerFile", records).text(path, compression="gzip")
    return len(spark.read.text(path).inputFiles())


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stream_root(spark, sf_dir)
    return read_stored(spark, root).select(*PAYMENT_EVENT_COLUMNS)


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stream_root(spark, sf_dir)
    return _dead_letters(read_stored(spark, root, REJECTED))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part of the messages on one checkpoint, then all of them on a fresh one, into the same tables."""
    root = scratch_path(spark, "stream")
    files = _inbox(spark, sf_dir, f"{root}/inbox")
    spark.read.text(f"{root}/inbox").filter(F.xxhash64("value") > 0).write.text(f"{root}/part", compression="gzip")
    run_available_now(spark, f"{root}/part", root, max_files=1000, checkpoint=f"{root}/_first")
    run_available_now(spark, f"{root}/inbox", root, max_files=max(1, -(-files // 2)), checkpoint=f"{root}/_second")
    return read_stored(spark, root).select(*PAYMENT_EVENT_COLUMNS)


def stream_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id that a stream has stored or rejected where some events pass the rules but break the table's constraints."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = scratch_path(spark, "stream")
    files = _inbox(spark, sf_dir, f"{root}/inbox", contract=True)
    run_available_now(spark, f"{root}/inbox", root, max_files=max(1, -(-files // 2)))
    stored = read_stored(spark, root).select("event_id", F.lit("").alias("reason"), F.lit("stored").alias("kind"))
    return stored.unionByName(read_stored(spark, root, REJECTED).select(
        "event_id", F.col(ingest.REASON).alias("reason"), F.lit("rejected").alias("kind")))


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events after a stream of a fifth of the files a batch, replayed once, whose parts were merged two by two."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = scratch_path(spark, "stream")
    # small files, so that a batch of few messages is read by several tasks too
    files = _inbox(spark, sf_dir, f"{root}/inbox", least=5, records=50_000)
    for run in ("_first", "_again"):
        # nobody else reads this root: parts that a merge has replaced go at once
        run_available_now(spark, f"{root}/inbox", root, max_files=max(1, -(-files // 5)) if run == "_first" else max(1000, files),
                          fan_in=2, checkpoint=f"{root}/{run}", keep_seconds=0)
    return read_stored(spark, root).select(*PAYMENT_EVENT_COLUMNS)


# --- quality ----------------------------------------------------------------


GIVEN = {"events", "customer", "supplier"}  # given tables that checks name


def quality_tables(spark: SparkSession, sf_dir: str, catalogue: dict[str, list[dict]]) -> dict[str, DataFrame]:
    """The tables that the catalogue checks or refers to.

    Where payment tables are among them, the derived events, which many checks
    and marts read, are staged once as a Parquet table, as the stored raw table
    would be.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    needed = set(catalogue) | {c["reference_table"] for cs in catalogue.values() for c in cs if "reference_table" in c}
    out = {n: read_given(spark, sf_dir, n) for n in needed & GIVEN}
    if any("." in n for n in needed):
        pe = stage_table(_events(spark, sf_dir), "payment_events")
        derived = {
            "raw.payment_events": lambda: pe,
            "analytics.merchant_daily_settlement": lambda: marts.merchant_settlement(pe),
            "analytics.payment_method_performance": lambda: marts.payment_method_performance(pe),
            "analytics.conversion_funnel": lambda: marts.conversion_funnel(pe),
        }
        out |= {n: derived[n]() for n in needed if n in derived}
    return out


def _checks_of_type(check_type: str) -> dict[str, list[dict]]:
    if check_type == "outlier_grouped":
        return {"events": EVENTS_CHECKS["outlier_grouped"]}
    out = {t: [c for c in cs if c["check"] == check_type] for t, cs in QUALITY_CHECKS.items()}
    out = {t: cs for t, cs in out.items() if cs}
    out["events"] = EVENTS_CHECKS[check_type]
    return out


def _dq(check_type: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checks = _checks_of_type(check_type)
        res = quality.run_suite(quality_tables(spark, sf_dir, checks), checks, as_of=QUERY_AS_OF)
        return res.drop("details")

    run.__name__ = f"dq_{check_type}"
    return run


def quality_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue over the payment events and three marts."""
    res = quality.run_suite(quality_tables(spark, sf_dir, QUALITY_CHECKS), QUALITY_CHECKS, as_of=QUERY_AS_OF)
    return res.drop("details")


def dq_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that can't run (unknown column, text where numbers or times are needed) among good ones."""
    checks = {"events": ERROR_CHECKS}
    return quality.run_suite(quality_tables(spark, sf_dir, checks), checks, as_of=QUERY_AS_OF).drop("details")


# --- reports ----------------------------------------------------------------

# Two runs in the quality log: the raw table three hours earlier, then the
# whole catalogue at QUERY_AS_OF (the "latest run").
RUN_A = QUERY_AS_OF - _dt.timedelta(hours=3)
RUN_B = QUERY_AS_OF


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = quality_tables(spark, sf_dir, QUALITY_CHECKS)
    raw_only = {"raw.payment_events": QUALITY_CHECKS["raw.payment_events"]}
    a = quality.with_check_timestamp(quality.run_suite(tables, raw_only, as_of=RUN_A), RUN_A)
    b = quality.with_check_timestamp(quality.run_suite(tables, QUALITY_CHECKS, as_of=RUN_B), RUN_B)
    # A stored log in production; here written once to the shared checkpoint
    # folder, so the reports (which read it twice) do not recompute the suite.
    shared_dir(spark)
    return a.unionByName(b).cache().checkpoint(eager=True)


def top_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_settlement(marts.merchant_settlement(_events(spark, sf_dir)))


def auth_rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.auth_rate_series(marts.payment_method_performance(_events(spark, sf_dir)))


def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.events_by_type(_events(spark, sf_dir))


def event_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_volume(_events(spark, sf_dir))


def worst_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_funnel(marts.conversion_funnel(_events(spark, sf_dir)))


def quality_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_scoreboard(quality_log(spark, sf_dir)).drop("details")


def quality_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_pass_rate(quality_log(spark, sf_dir))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_summary(quality_log(spark, sf_dir), as_of=RUN_B)


# --- stored marts -----------------------------------------------------------


def _marts_root(spark: SparkSession) -> str:
    return scratch_path(spark, "marts")


def alerts_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored alerts after a run whose thresholds no merchant passes: the earlier alerts are gone."""
    from settlekit.plans.pipeline import write_mart
    from settlekit.sources.tables import read_table

    name, root, pe = "analytics.chargeback_alerts", _marts_root(spark), _events(spark, sf_dir)
    write_mart(marts.chargeback_alerts(pe), name, root, None)
    write_mart(marts.chargeback_alerts(pe, 9.0, 9.0, 9.0), name, root, None)
    return read_table(spark, name, root=root).select("alert_date", "merchant_id", "chargeback_count", "severity")


def mart_tables_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settlement mart as stored: money DECIMAL(15,2), ratio DECIMAL(5,4)."""
    from settlekit.plans.pipeline import write_mart
    from settlekit.sources.tables import read_table

    name, root = "analytics.merchant_daily_settlement", _marts_root(spark)
    write_mart(marts.merchant_settlement(_events(spark, sf_dir)), name, root, None)
    return read_table(spark, name, root=root).select(*marts.SETTLEMENT_COLUMNS)


def gate_missing_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored suite over cancellations only: an empty mart and one that was never written fail their checks."""
    from settlekit.plans.pipeline import write_mart
    from settlekit.sources.tables import read_table

    root = _marts_root(spark)
    pe = stage_table(_events(spark, sf_dir).filter(F.col("event_type") == "CANCEL"), "cancels")
    for name, mart in (("analytics.merchant_daily_settlement", marts.merchant_settlement(pe)),
                       ("analytics.payment_method_performance", marts.payment_method_performance(pe))):
        write_mart(mart, name, root, None)

    def read(name):
        return pe if name == "raw.payment_events" else read_table(spark, name, root=root)

    return quality.run_stored_suite(spark, read, QUALITY_CHECKS, as_of=QUERY_AS_OF).drop("details")


# --- write contracts --------------------------------------------------------


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraint violations of the raw table and the four marts before a write."""
    from settlekit.sinks.contracts import check_contract

    pe = stage_table(_events(spark, sf_dir), "payment_events")
    tables = {
        "raw.payment_events": pe,
        "analytics.merchant_daily_settlement": marts.merchant_settlement(pe),
        "analytics.payment_method_performance": marts.payment_method_performance(pe),
        "analytics.chargeback_alerts": marts.chargeback_alerts(pe),
        "analytics.conversion_funnel": marts.conversion_funnel(pe),
    }
    out = None
    for name, df in tables.items():
        # the marts are derived: one pass each (see check_contract)
        part = check_contract(df, name, single_pass=df is not pe)
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {
    "merchant_settlement": merchant_settlement,
    "payment_method_performance": payment_method_performance,
    "chargeback_alerts": chargeback_alerts,
    "txn_lifecycle": txn_lifecycle,
    "conversion_funnel": conversion_funnel,
    "auth_to_capture_hours": auth_to_capture_hours,
    "funnel_multi": funnel_multi,
    "parse_events": parse_events,
    "rejection_reasons": rejection_reasons,
    "fx_normalize": fx_normalize,
    "ingest_valid": ingest_valid,
    "ingest_rejected": ingest_rejected,
    "dedup_events": dedup_events,
    "dedup_unequal": dedup_unequal,
    "upsert_first_wins": upsert_first_wins,
    "ingest_strict": ingest_strict,
    "stream_ingest": stream_ingest,
    "stream_restart": stream_restart,
    "stream_rejected": stream_rejected,
    "stream_contract": stream_contract,
    "stream_compacted": stream_compacted,
    "dq_not_null": _dq("not_null"),
    "dq_accepted_values": _dq("accepted_values"),
    "dq_uniqueness": _dq("uniqueness"),
    "dq_range": _dq("range_check"),
    "dq_freshness": _dq("freshness"),
    "dq_referential_integrity": _dq("referential_integrity"),
    "dq_statistical_outlier": _dq("statistical_outlier"),
    "dq_row_count": _dq("row_count"),
    "dq_outlier_grouped": _dq("outlier_grouped"),
    "dq_errors": dq_errors,
    "quality_run": quality_run,
    "top_settlement": top_settlement,
    "auth_rate_series": auth_rate_series,
    "events_by_type": events_by_type,
    "event_volume": event_volume,
    "worst_funnel": worst_funnel,
    "quality_scoreboard": quality_scoreboard,
    "quality_pass_rate": quality_pass_rate,
    "quality_summary": quality_summary,
    "contract_violations": contract_violations,
    "alerts_none": alerts_none,
    "mart_tables_typed": mart_tables_typed,
    "gate_missing_mart": gate_missing_mart,
}
