"""The channel jobs on streams: the batch functions, run per micro-batch into the four sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import audit_hourly
from ..plans import channels as C
from ..sources.policies import Policy
from ..sources.sinks import write_outputs

#: By channel: the audit event, and the job over a batch, which takes the policy and its own options.
EVENTS = {
    "inbound_gate": ("run_blocked", C.inbound_gate),
    "inbound_advisory": ("guardrail_scan", C.inbound_advisory),
    "tool_result": ("tool_result_scan", C.tool_result_redact),
    "outbound": ("outbound_scan", C.outbound_redact),
    "reply_payload": ("reply_payload_redacted", C.reply_payload_redact),
}


def redact_stream(
    texts: DataFrame,
    policy: Policy,
    channel: str,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Run a channel's job on a stream of records into the sinks under ``path``.

    ``options`` go to the job (``changed_only``, ``message``, ``payload``, ``ner``, ``allow``).  Streams
    of several channels can share a path.  A micro-batch that is run again after a failure replaces
    its own output.
    """
    event, job = EVENTS[channel]
    if channel in ("tool_result", "outbound", "reply_payload"):
        options.setdefault("changed_only", False)
    columns = {k: options[k] for k in ("message", "payload") if options.get(k)}

    def write(batch: DataFrame, batch_id: int) -> None:
        done = job(batch, policy, **options)
        write_outputs(done, path, event, batch_id, policy.audit_enabled, **columns)

    return _start(texts.writeStream.foreachBatch(write), checkpoint, available_now)


def rows_stream(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Any stateless job (gate, advisory, report) from a stream to a parquet table."""
    writer = job(stream).writeStream.format("parquet").option("path", path)
    return _start(writer, checkpoint, available_now)


def hourly_stream(
    facts: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Hourly span counts; an hour is written once the watermark has passed it."""
    writer = audit_hourly(facts).writeStream.format("parquet").option("path", path)
    return _start(writer.outputMode("append"), checkpoint, available_now)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
