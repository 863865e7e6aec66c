"""Streaming replay/restart, the batch pipeline, and table I/O."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from settlekit.operators import ingest
from settlekit.plans import registry
from settlekit.plans.pipeline import run_batch
from settlekit.schemas import PAYMENT_EVENT_COLUMNS
from settlekit.sinks.contracts import assert_contract, check_contract
from settlekit.sinks.tables import write_table
from settlekit.sources.fixtures import payment_events, raw_deliveries
from settlekit.sources.tables import jdbc_options, read_table
from settlekit.sinks.snapshots import Snapshots
from settlekit.streaming.ingest import REJECTED, IngestSink, read_stored, read_stream, run_available_now, start_ingest
from tests.conftest import SF_SMALL, plan_text


def _rows(df):
    return sorted(tuple(r) for r in df.select(*PAYMENT_EVENT_COLUMNS).collect())


@pytest.fixture(scope="module")
def inbox(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="settlekit-stream-")
    raw_deliveries(spark, SF_SMALL).repartition(4).write.text(f"{root}/inbox")
    return root


def test_stream_equals_batch_and_restart_adds_nothing(spark, inbox, tmpdir_path):
    root = run_available_now(spark, f"{inbox}/inbox", tmpdir_path, max_files=1)
    streamed = read_stored(spark, root)
    assert max(Snapshots(spark, root).latest().runs.values()) >= 1   # two batches at least
    batch = ingest.dedup_events(ingest.valid_events(
        ingest.annotate(ingest.parse_messages(raw_deliveries(spark, SF_SMALL)))))
    assert _rows(streamed) == _rows(batch)
    n_rej = read_stored(spark, root, REJECTED).count()
    # same checkpoint again: nothing new is delivered, the tables stay
    run_available_now(spark, f"{inbox}/inbox", tmpdir_path, max_files=1)
    assert read_stored(spark, root).count() == streamed.count()
    assert read_stored(spark, root, REJECTED).count() == n_rej
    # delivered = valid (before dedup) + rejected
    delivered = raw_deliveries(spark, SF_SMALL).count()
    annotated = ingest.annotate(ingest.parse_messages(raw_deliveries(spark, SF_SMALL)))
    assert annotated.filter(F.col("rejection_reason") == "").count() + n_rej == delivered


def test_replaying_a_batch_is_idempotent(spark, tmpdir_path):
    msgs = ['{"event_id":"e%d","psp_reference":"p","merchant_id":"m","event_type":"CAPTURE",'
            '"amount":1.5,"currency":"EUR","event_timestamp":"2024-01-01T00:00:00.000Z"}' % i for i in range(5)]
    b0 = spark.createDataFrame([(m,) for m in msgs[:3]] + [("junk",)], "value string")
    b1 = spark.createDataFrame([(m,) for m in msgs[2:]], "value string")
    sink = IngestSink(tmpdir_path)
    sink(b0, 0)
    sink(b1, 1)
    first = sorted(r["event_id"] for r in read_stored(spark, tmpdir_path).collect())
    assert first == ["e0", "e1", "e2", "e3", "e4"]  # e2 of batch 1 was already stored
    assert sink.metrics[0] == {"delivered": 4, "valid": 3}
    sink(b1, 1)  # replay after a failure before the offset commit
    sink(b0, 0)
    assert sorted(r["event_id"] for r in read_stored(spark, tmpdir_path).collect()) == first
    assert read_stored(spark, tmpdir_path, REJECTED).count() == 1


def test_stream_source_text_and_trigger(spark, inbox, tmpdir_path):
    src = read_stream(spark, fmt="text", path=f"{inbox}/inbox", max_files=2)
    assert src.isStreaming and src.columns == ["value"]
    q = start_ingest(src, IngestSink(tmpdir_path), f"{tmpdir_path}/ck", available_now=True)
    q.awaitTermination()
    assert read_stored(spark, tmpdir_path).count() > 0
    with pytest.raises(ValueError):
        read_stream(spark, fmt="socket")


def test_run_batch_writes_marts_log_and_gate(spark, tmpdir_path):
    events = payment_events(spark, SF_SMALL)
    write_table(events, "raw.payment_events", mode="overwrite", root=tmpdir_path)
    latest = events.agg(F.max("event_timestamp")).first()[0]
    res = run_batch(spark, tmpdir_path, as_of=latest + dt.timedelta(hours=1))
    for name in ["analytics.merchant_daily_settlement", "analytics.payment_method_performance",
                 "analytics.chargeback_alerts", "analytics.conversion_funnel"]:
        t = read_table(spark, name, root=tmpdir_path)
        assert t.count() > 0 and "computed_at" in t.columns
    assert res.gate["critical"] == 0
    assert res.results.count() == 30
    assert {r["status"] for r in res.summary.collect()} <= {"PASS", "WARN", "FAIL"}
    assert dict(read_table(spark, "analytics.merchant_daily_settlement", root=tmpdir_path).dtypes)[
        "chargeback_ratio"] == "decimal(5,4)"
    # a second run appends to the log; "latest run" reports still see one run
    res2 = run_batch(spark, tmpdir_path, as_of=latest + dt.timedelta(hours=2))
    assert read_table(spark, "analytics.data_quality_log", root=tmpdir_path).count() == 60
    assert res2.results.count() == 30
    with pytest.raises(ValueError):
        run_batch(spark, tmpdir_path, as_of=latest + dt.timedelta(hours=30))  # stale-data guard


@pytest.mark.parametrize("single_pass", [False, True])
def test_contract_violations_detected(spark, single_pass):
    df = spark.createDataFrame([("a", 1.5), ("a", 12.0), (None, 0.1)], "merchant_id string, chargeback_ratio double")
    spec = {"key": ["merchant_id"], "not_null": ["merchant_id"], "max_length": {"merchant_id": 0},
            "decimal": {"chargeback_ratio": (5, 4)}}
    got = {r["constraint_name"]: r["violations"]
           for r in check_contract(df, "t", spec, single_pass=single_pass).collect()}
    assert got == {"not_null": 1, "max_length_0": 2, "decimal_5_4": 1, "primary_key": 1}
    empty = {r["constraint_name"]: r["violations"]
             for r in check_contract(df.limit(0), "t", spec, single_pass=single_pass).collect()}
    assert empty == dict.fromkeys(got, 0)
    with pytest.raises(ValueError):
        assert_contract(df, "t", spec)


def test_jdbc_options_from_env_and_no_default_password():
    opts = jdbc_options(env={"PAYMENTS_DB_HOST": "db", "PAYMENTS_DB_USER": "u"})
    assert opts["url"] == "jdbc:postgresql://db:5432/payments" and opts["user"] == "u"
    assert "password" not in opts


def test_parquet_round_trip_and_partitioned_jdbc_arguments(spark, tmpdir_path):
    df = spark.range(10).withColumn("d", F.lit("2024-01-01"))
    write_table(df, "x.t", mode="overwrite", root=tmpdir_path, partition_by=["d"])
    assert os.path.isdir(f"{tmpdir_path}/x.t/d=2024-01-01")
    assert read_table(spark, "x.t", root=tmpdir_path).count() == 10
    with pytest.raises(ValueError):
        read_table(spark, "x.t", fmt="jdbc", jdbc={"url": "jdbc:none"}, partition_column="id")


def test_command_line_jobs(spark, tmpdir_path):
    from settlekit.__main__ import main

    write_table(payment_events(spark, SF_SMALL), "raw.payment_events", mode="overwrite", root=tmpdir_path)
    assert main(["mart", "--root", tmpdir_path, "funnel"]) == 0
    assert read_table(spark, "analytics.conversion_funnel", root=tmpdir_path).count() > 0
    # the raw events are decades old: freshness warns, nothing critical fails
    assert main(["quality", "--root", tmpdir_path, "raw.payment_events"]) == 0
    log = read_table(spark, "analytics.data_quality_log", root=tmpdir_path)
    assert log.filter(F.col("check_name") == "freshness_event_timestamp").first()["status"] == "FAIL"


def _message(event_id, time="2024-01-01T00:00:00.000Z", kind="AUTHORIZATION", psp="p", amount=1.5, currency="EUR"):
    return ('{"event_id":"%s","psp_reference":"%s","merchant_id":"m","event_type":"%s","amount":%s,"currency":"%s",'
            '"event_timestamp":"%s","acquirer_response_code":"00","payment_method":"visa","issuer_country":"NL"}' % (event_id, psp, kind, amount, currency, time))


def test_fresh_checkpoint_keeps_what_an_earlier_run_stored(spark, tmpdir_path):
    for run, rows in (("a", [_message("e1"), _message("e2"), "junk"]), ("b", [_message("e2"), _message("e3"), "more junk"])):
        spark.createDataFrame([(m,) for m in rows], "value string").coalesce(1).write.text(f"{tmpdir_path}/in_{run}")
        run_available_now(spark, f"{tmpdir_path}/in_{run}", tmpdir_path, checkpoint=f"{tmpdir_path}/ck_{run}")
    assert sorted(r.event_id for r in read_stored(spark, tmpdir_path).collect()) == ["e1", "e2", "e3"]
    assert read_stored(spark, tmpdir_path, REJECTED).count() == 2


@pytest.mark.parametrize("time", ["2024-03-31T00:00:00.000Z", "2023-10-03T00:00:00.000Z"])
def test_copy_dated_ninety_days_away_is_stored_once(spark, tmpdir_path, time):
    sink = IngestSink(tmpdir_path)
    sink(spark.createDataFrame([(_message("e1"),)], "value string"), 0)
    sink(spark.createDataFrame([(_message("e1", time),)], "value string"), 1)
    assert read_stored(spark, tmpdir_path).count() == 1


def test_no_money_vanishes(spark):
    rows = [_message("a", amount="1e14"), _message("b", amount="9e12", currency="GBP"), _message("c", amount="0.001"),
            _message("d", amount="NaN"), _message("e", amount="9999999999999.99"), _message("f", amount="0.01")]
    annotated = ingest.annotate(ingest.parse_messages(spark.createDataFrame([(r,) for r in rows], "value string")))
    valid = ingest.valid_events(annotated).collect()
    assert sorted(r.event_id for r in valid) == ["e", "f"]
    assert all(r.amount > 0 and r.amount_eur > 0 for r in valid)
    assert {r.rejection_reason for r in ingest.rejected_events(annotated).collect()} == {"amount_out_of_range"}


def test_since_recomputes_months_of_changed_transactions(spark, tmpdir_path):
    rows = [_message("a1", "2024-01-31T10:00:00.000Z", psp="p1"), _message("a2", "2024-01-05T10:00:00.000Z", psp="p2"),
            _message("c1", "2024-02-03T10:00:00.000Z", "CAPTURE", psp="p1")]
    parse = lambda r: ingest.valid_events(ingest.annotate(ingest.parse_messages(
        spark.createDataFrame([(x,) for x in r], "value string"))))
    as_of = dt.datetime(2024, 2, 3, 11)
    run_batch(spark, f"{tmpdir_path}/inc", events=parse(rows[:2]), as_of=as_of, guard=False, enforce_gate=False)
    for root, since in ((f"{tmpdir_path}/inc", dt.date(2024, 2, 3)), (f"{tmpdir_path}/full", None)):
        run_batch(spark, root, events=parse(rows), as_of=as_of, enforce_gate=False, since=since)
    a, b = (sorted(tuple(r) for r in read_table(spark, "analytics.conversion_funnel", root=f"{tmpdir_path}/{x}")
                   .drop("computed_at").collect()) for x in ("inc", "full"))
    assert a == b and sum(r[3] for r in a) == 1


def test_contract_violation_stops_the_write(spark, tmpdir_path):
    from settlekit.plans.pipeline import write_mart

    rows = spark.createDataFrame([(dt.date(2024, 1, 1), "m" * 60)], "report_date date, merchant_id string")
    with pytest.raises(ValueError):
        write_mart(rows, "analytics.conversion_funnel", tmpdir_path, None)
    assert not os.path.exists(f"{tmpdir_path}/analytics.conversion_funnel")


def test_shared_folder_is_required_on_a_cluster():
    from settlekit.session import shared_dir

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(Conf)
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        shared_dir(Cluster)


def test_incremental_batch_equals_full_recompute(spark, tmpdir_path):
    from settlekit.plans.pipeline import MART_DAY

    events = payment_events(spark, SF_SMALL)
    full, inc = f"{tmpdir_path}/full", f"{tmpdir_path}/inc"
    for root in (full, inc):
        write_table(events, "raw.payment_events", mode="overwrite", root=root)
    as_of = events.agg(F.max("event_timestamp")).first()[0] + dt.timedelta(hours=1)
    run_batch(spark, full, as_of=as_of)
    # the incremental root first holds marts computed before March 1998; a run
    # from a day in February on (within the lifecycle lag of the late-February
    # authorizations) replaces February onwards and keeps the older months
    old = events.filter(F.col("event_timestamp") < F.lit("1998-03-01").cast("timestamp"))
    run_batch(spark, inc, events=old, as_of=as_of, guard=False)
    run_batch(spark, inc, as_of=as_of, since=dt.date(1998, 2, 20))
    for name in MART_DAY:
        a = read_table(spark, name, root=full).drop("computed_at")
        b = read_table(spark, name, root=inc).drop("computed_at")
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_sink_moves_no_whole_rows_to_find_copies(spark, tmp_path):
    """Only rows whose key repeats are compared as a whole; a batch's other rows pass by a broadcast."""
    rows = spark.createDataFrame([(f"e{k % 50}", k) for k in range(53)], "event_id string, x long")
    keys = rows.groupBy("event_id").count().filter("count > 1").selectExpr("event_id as _key")
    out = ingest.dedup_repeated(rows, keys)
    assert sorted(map(tuple, out.collect())) == sorted((f"e{k}", k) for k in range(50))
    plan = plan_text(out)
    assert "BroadcastHashJoin LeftAnti" in plan and "SortMergeJoin" not in plan
    root = str(tmp_path / "inbox")
    files = registry._inbox(spark, "/root/testdata/sf0.001", root)
    assert files >= 2 and all(f.endswith(".gz") for f in spark.read.text(root).inputFiles())


def test_compacted_stream_keeps_no_replaced_part_and_a_compressed_inbox(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch_path", lambda *_: str(tmp_path))
    stored = registry.stream_compacted(spark, SF_SMALL)
    inbox = spark.read.text(f"{tmp_path}/inbox").inputFiles()
    assert len(inbox) >= 4 and all(f.endswith(".gz") for f in inbox)
    snapshot = Snapshots(spark, str(tmp_path)).latest()
    assert len(snapshot.runs) == 2 and max(snapshot.runs.values()) >= 2     # batches of a part of the files, then all again
    assert max(p.level for p in snapshot.of("raw.payment_events")) >= 2     # merged two by two
    for table in ("raw.payment_events", "keys"):
        there = {os.path.basename(d) for d, _, _ in os.walk(f"{tmp_path}/{table}") if os.path.basename(d).startswith("part=")}
        assert there == {f"part={p.id}" for p in snapshot.of(table)}
    ids = stored.select("event_id")
    assert ids.count() == ids.distinct().count() > 0
