"""Command line: the jobs a deployment submits.

    spark-submit -m settlekit stream  --root R --source text --path IN [--available-now]
    spark-submit -m settlekit stream  --root R --source kafka --bootstrap B --topic T
    spark-submit -m settlekit mart    --root R [--since D] settlement|performance|alerts|funnel
    spark-submit -m settlekit quality --root R [TABLE]       exit code 1 on a critical failure
    spark-submit -m settlekit batch   --root R [--since D]  guard, marts, checks, summary

Tables are Parquet folders below ``--root`` (``raw.payment_events`` ...).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from settlekit.session import get_session

MART_NAMES = {
    "settlement": "analytics.merchant_daily_settlement",
    "performance": "analytics.payment_method_performance",
    "alerts": "analytics.chargeback_alerts",
    "funnel": "analytics.conversion_funnel",
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="settlekit")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--root", required=True)
    s.add_argument("--source", choices=["kafka", "text"], default="kafka")
    s.add_argument("--path")
    s.add_argument("--bootstrap")
    s.add_argument("--topic", default="payment.events.raw")
    s.add_argument("--max-per-trigger", type=int, default=500, help="broker messages per trigger (rate limit)")
    s.add_argument("--max-files", type=int, default=1000, help="message files per trigger")
    s.add_argument("--fail-on-data-loss", action="store_true", help="stop when the broker dropped offsets")
    s.add_argument("--trigger", default="10 seconds")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--strict-time", action="store_true")
    m = sub.add_parser("mart")
    m.add_argument("--root", required=True)
    m.add_argument("name", choices=sorted(MART_NAMES))
    m.add_argument("--since", help="YYYY-MM-DD: recompute from this month on only")
    q = sub.add_parser("quality")
    q.add_argument("--root", required=True)
    q.add_argument("table", nargs="?")
    b = sub.add_parser("batch")
    b.add_argument("--root", required=True)
    b.add_argument("--no-guard", action="store_true")
    b.add_argument("--since", help="YYYY-MM-DD: recompute day-grained marts from this month on only")
    for x in (m, q, b):
        x.add_argument("--format", choices=["parquet", "jdbc"], default="parquet",
                       help="where the tables are; jdbc takes its connection from the environment")
    a = p.parse_args(argv)

    spark = get_session("settlekit-" + a.cmd)
    if a.cmd == "stream":
        from settlekit.streaming.ingest import IngestSink, read_stream, start_ingest

        src = read_stream(spark, fmt=a.source, path=a.path, bootstrap_servers=a.bootstrap,
                          topic=a.topic, max_per_trigger=a.max_per_trigger, max_files=a.max_files,
                          fail_on_data_loss=a.fail_on_data_loss)
        sink = IngestSink(a.root, a.strict_time)
        start_ingest(src, sink, f"{a.root}/_checkpoints/ingest", processing_time=a.trigger,
                     available_now=a.available_now).awaitTermination()
        return 0
    if a.cmd == "mart":
        from settlekit.plans.pipeline import RAW, compute_mart, write_mart
        from settlekit.sources.tables import read_table

        name = MART_NAMES[a.name]
        events = read_table(spark, RAW, root=a.root, fmt=a.format)
        since = _dt.date.fromisoformat(a.since) if a.since else None
        if events.isEmpty():
            print(f"{name}: no input rows, table left as it is")
            return 0
        write_mart(compute_mart(events, name, since), name, a.root, since, fmt=a.format)
        return 0
    if a.cmd == "quality":
        from settlekit.operators import quality
        from settlekit.plans.catalogue import QUALITY_CHECKS
        from settlekit.sinks.tables import write_table
        from settlekit.sources.tables import read_table

        if a.table and a.table not in QUALITY_CHECKS:
            print(f"no checks configured for {a.table}", file=sys.stderr)
            return 2
        catalogue = {t: QUALITY_CHECKS[t] for t in ([a.table] if a.table else QUALITY_CHECKS)}
        # a table that can't be read fails its checks
        results = quality.with_check_timestamp(quality.run_stored_suite(
            spark, lambda n: read_table(spark, n, root=a.root, fmt=a.format), catalogue)).cache()
        write_table(results, "analytics.data_quality_log", mode="append", root=a.root, fmt=a.format)
        try:
            print(quality.gate(results))
        except quality.QualityGateError as err:
            print(err, file=sys.stderr)
            return 1
        return 0
    if a.cmd == "batch":
        from settlekit.operators.quality import QualityGateError
        from settlekit.plans.pipeline import run_batch

        try:
            since = _dt.date.fromisoformat(a.since) if a.since else None
            res = run_batch(spark, a.root, guard=not a.no_guard, since=since, fmt=a.format)
        except QualityGateError as err:
            print(err, file=sys.stderr)
            return 1
        res.summary.show(truncate=False)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
