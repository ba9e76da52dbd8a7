"""Streams give what the batch jobs give."""

import os
import time

import model
import pytest
from pyspark.sql import functions as F
from test_requests import random_events

from veiltext.functions.schema import TEXTS
from veiltext.operators import audit as G
from veiltext.operators import requests as R
from veiltext.operators.requests import EVENTS
from veiltext.plans import channels as C
from veiltext.sources.policies import policy_from
from veiltext.sources.sinks import read_sink, write_outputs
from veiltext.streaming.backlog import backlog_stream, live_requests
from veiltext.streaming.jobs import hourly_stream, redact_stream, rows_stream

POLICY = policy_from({"entityActions": {"SSN": "block"}})


@pytest.fixture
def texts(spark, tmp_path):
    rows = []
    for i in range(60):
        text = [
            f"Mail joe{i}@example.com or call 555-123-{4000 + i}.",
            "Nothing here.",
            f"SSN 123-45-{6000 + i} and SSN 123-45-{6000 + i}",
        ][i % 3]
        rows.append((f"r{i}", "outbound", f"s{i % 4}", i, None, None, "chat", text))
    df = spark.createDataFrame(rows, TEXTS).withColumn(
        "ts", F.timestamp_seconds(1_700_000_000 + F.col("seq") * 600)
    )
    src = str(tmp_path / "in")
    for part in range(3):
        df.filter(F.col("seq") % 3 == part).coalesce(1).write.mode("append").parquet(src)
    return src


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_redact_stream_equals_batch(spark, texts, tmp_path):
    out = str(tmp_path / "out")
    q = redact_stream(
        _stream(spark, texts, TEXTS), POLICY, "outbound", out, str(tmp_path / "cp"), available_now=True
    )
    assert q.awaitTermination(120)
    batch = C.outbound_redact(spark.read.schema(TEXTS).parquet(texts), POLICY, changed_only=False)
    key = lambda df: sorted((r.record_id, r.redacted_text) for r in df.collect())
    assert key(read_sink(spark, out, "redacted")) == key(batch)
    assert read_sink(spark, out, "entities").count() == 60 // 3 * 4
    assert read_sink(spark, out, "audit").count() == 40
    raw = {r.original for r in read_sink(spark, out, "mapping").collect()}
    assert "joe0@example.com" in raw
    for sink in ("redacted", "audit"):
        shown = str(read_sink(spark, out, sink).collect())
        assert not any(v in shown for v in raw)


def test_same_batch_written_twice_is_there_once(spark, texts, tmp_path):
    out = str(tmp_path / "out")
    df = C.outbound_redact(spark.read.schema(TEXTS).parquet(texts), POLICY)
    for _ in range(2):
        write_outputs(df, out, "outbound_scan", batch_id=7)
    write_outputs(df, out, "outbound_scan", batch_id=8)
    assert read_sink(spark, out, "redacted").count() == 80


def test_gate_stream(spark, texts, tmp_path):
    q = rows_stream(
        _stream(spark, texts, TEXTS),
        lambda s: C.inbound_gate(s, POLICY),
        str(tmp_path / "out"),
        str(tmp_path / "cp"),
        available_now=True,
    )
    assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in got} == {"block": 20, "pass": 40}


def test_hourly_stream_closes_hours(spark, texts, tmp_path):
    stream = G.span_facts(C.scan(_stream(spark, texts, TEXTS), POLICY), POLICY)
    q = hourly_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 0 and got.agg(F.max("entities")).head()[0] <= 8


@pytest.mark.parametrize("cap,max_mappings", [(50, 10_000), (3, 3)])
def test_backlog_stream_equals_model(spark, tmp_path, cap, max_mappings):
    rows = random_events(5, sessions=3, hot=120, cold=40)
    _, made, replies = model.run(rows, cap, max_mappings)
    src = str(tmp_path / "ev")
    df = spark.createDataFrame(rows, EVENTS)
    for lo, hi in ((0, 60), (60, 200), (200, 1000)):
        df.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(src)
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    q = (
        backlog_stream(_stream(spark, src, EVENTS), cap, max_mappings)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    assert q.awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.session_id, r.seq): r.request_id for r in got if r.kind == "request"} == made
    assert {
        (r.session_id, r.seq, r.pos): (r.request_id, r.status, r.error) for r in got if r.kind == "resolve"
    } == replies


def _backlog(spark, tmp_path, rows, cuts, until=None, **options):
    """Runs the stream over the events in several micro-batches; its rows and its checkpoint."""
    src, out, cp = (str(tmp_path / x) for x in ("ev", "out", "cp"))
    df = spark.createDataFrame(rows, EVENTS)
    for lo, hi in cuts:
        df.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(src)
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    stream = backlog_stream(_stream(spark, src, EVENTS), **options)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp)
    if until is None:
        assert writer.trigger(availableNow=True).start().awaitTermination(300)
    else:  # timers keep a stream at work, so it does not end by itself
        q, end = writer.trigger(processingTime="1 second").start(), time.time() + 120
        while time.time() < end and not (os.path.exists(f"{out}/_spark_metadata") and spark.read.schema(stream.schema).parquet(out).count() == until):
            time.sleep(1)
        q.stop()
    return spark.read.schema(stream.schema).parquet(out), cp


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_backlog_stream_equals_batch_in_all_columns(spark, tmp_path):
    """Replies, masks, counts and audit rows of the stream and of its state are those of the batch jobs; null is a session."""
    rows = random_events(6, sessions=2, hot=60, cold=30)
    lone = [{**e, "session_id": None} for e in rows if e["session_id"] == rows[0]["session_id"]]
    events = spark.createDataFrame(rows + lone, EVENTS)
    got, cp = _backlog(spark, tmp_path, rows + lone, ((0, 40), (40, 1000)), cap=5, max_mappings=4)
    made = R.create_requests(events, cap=5, max_mappings=4)
    replies = R.resolve_replies(events, made)
    table = R.request_table(made, replies)
    asked, settled = got.filter("kind = 'request'"), got.filter("kind = 'resolve'")
    assert _rows(asked.select(made.columns)) == _rows(made) and _rows(settled.select(replies.columns)) == _rows(replies)
    live = live_requests(spark, cp)
    assert live.columns == table.columns and _rows(live) == _rows(table)
    assert any(r.session_id is None for r in live.collect())
    for status in (None, *R.STATUSES):
        assert _rows(R.list_requests(live, status)) == _rows(R.list_requests(table, status))
    assert _rows(R.request_counts(live)) == _rows(R.request_counts(table))
    assert _rows(G.audit_request_created(asked, POLICY)) == _rows(G.audit_request_created(made, POLICY))
    assert _rows(G.audit_request_resolved(settled, POLICY)) == _rows(G.audit_request_resolved(replies, POLICY))


def test_idle_sessions_are_forgotten(spark, tmp_path):
    """With a time to live of nothing, the first micro-batch's session is gone when the next one comes."""
    event = dict(zip((f.split()[0] for f in EVENTS.split(", ")), [None] * 13, strict=True))
    rows = [
        {**event, "session_id": "a", "seq": 1, "kind": "mapping", "placeholder": "[EMAIL_1]", "original": "joe@x.org"},
        {**event, "session_id": "a", "seq": 2, "kind": "request", "placeholder": "[EMAIL_1]", "entity_type": "EMAIL"},
        {**event, "session_id": "b", "seq": 10, "kind": "request", "placeholder": "[EMAIL_1]", "entity_type": "EMAIL"},
        {**event, "session_id": "a", "seq": 20, "kind": "request", "placeholder": "[EMAIL_1]", "entity_type": "EMAIL"},
    ]
    got, _ = _backlog(spark, tmp_path, rows, ((0, 10), (10, 20), (20, 30)), until=3, idle_ms=1)
    assert [(r.seq, r.request_id, r.original_text) for r in got.orderBy("seq").collect()] == [(2, "REQ-1", "joe@x.org"), (10, "REQ-1", None), (20, "REQ-1", None)]


def test_channels_share_a_path(spark, tmp_path):
    """Jobs of several channels write to one path; none replaces another's rows, and rewritten messages, payloads and notices arrive."""
    out = str(tmp_path / "sinks")
    base = "record_id string, channel string, session_id string, seq bigint, ts timestamp, tool_name string, channel_id string"
    row = ("r1", "x", "s", 1, None, "t", "c")
    text = spark.createDataFrame([(*row, "mail joe@x.org, SSN 123-45-6789")], base + ", text string")
    message = spark.createDataFrame([(*row, '{"content":"mail joe@x.org"}')], base + ", raw string")
    payload = text.withColumn("payload", F.struct("text")).drop("text")
    policy = policy_from({"entityActions": {"SSN": "block"}})
    write_outputs(C.outbound_redact(text, policy), out, "outbound_scan", 0)
    write_outputs(C.tool_result_redact(message, policy, message="raw"), out, "tool_result_scan", 0, message="raw")
    write_outputs(C.reply_payload_redact(payload, policy), out, "reply_payload_redacted", 0)
    write_outputs(C.inbound_advisory(text, policy), out, "guardrail_scan", 0)
    write_outputs(C.inbound_gate(text, policy), out, "run_blocked", 0)
    rows = read_sink(spark, out, "redacted").collect()
    assert len(rows) == 5
    assert sum(r.redacted_text == "mail [EMAIL_1], SSN [SSN_1]" for r in rows) == 1
    assert [r.message for r in rows if r.message and "content" in r.message] == ['{"content":"mail [EMAIL_1]"}']
    assert [r.payload for r in rows if r.payload] == ['{"text":"mail [EMAIL_1], SSN [SSN_1]"}']
    assert sum("[EMAIL_1]" in (r.notice or "") for r in rows) == 1 and [r.outcome for r in rows if r.outcome] == ["block"]
    events = {r.event: r for r in read_sink(spark, out, "audit").collect()}
    assert set(events) == {"outbound_scan", "tool_result_scan", "reply_payload_redacted", "guardrail_scan", "run_blocked"}
    assert events["run_blocked"].blocked_labels == ["SSN"] and "joe" not in str(events)
