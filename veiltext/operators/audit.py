"""Audit rows: counts and labels of what was found, never a value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.policies import Policy
from .policy import action_of

AUDIT = (
    "event string, record_id string, session_id string, ts timestamp, total_entities int, "
    "labels array<string>, blocked int, warned int, redacted int, blocked_labels array<string>, "
    "warned_labels array<string>, redacted_labels array<string>, tool_name string, "
    "channel_id string, request_id string, action string, entity_type string, source string"
)


def _counts(df: DataFrame) -> dict[str, Column]:
    return {"total_entities": F.col("entity_count"), "labels": F.col("labels")}


def _found(df: DataFrame) -> Column:
    return F.col("entity_count") > 0


def _guardrail(df: DataFrame) -> dict[str, Column]:
    s = F.col("summary")
    names = ("blocked", "warned", "redacted")
    return {
        "total_entities": s["total"],
        **{n: s[n] for n in names},
        **{f"{n}_labels": s[f"{n}_labels"] for n in names},
        "source": F.lit("prompt"),
    }


def _request(df: DataFrame) -> dict[str, Column]:
    names = ("request_id", "action", "entity_type")
    return {**{n: F.col(n) for n in names if n in df.columns}, "source": F.lit("backlog")}


#: By event: which rows of the job's output it is written for, and its columns besides the record's.
EVENTS: dict[str, tuple[Callable[[DataFrame], Column], Callable[[DataFrame], dict[str, Column]]]] = {
    "guardrail_scan": (lambda df: F.lit(True), _guardrail),
    "tool_result_scan": (
        _found,
        lambda df: {
            **_counts(df),
            "tool_name": F.col("tool_name"),
            "source": F.lit("tool_result"),
        },
    ),
    "outbound_scan": (
        _found,
        lambda df: {
            **_counts(df),
            "channel_id": F.col("channel_id"),
            "source": F.lit("outbound"),
        },
    ),
    "reply_payload_redacted": (_found, _counts),
    "run_blocked": (
        lambda df: F.col("outcome") == "block",
        lambda df: {"blocked": F.col("blocked"), "blocked_labels": F.col("blocked_labels")},
    ),
    "access_request_created": (lambda df: F.col("request_id").isNotNull(), _request),
    "access_request_resolved": (lambda df: F.col("error").isNull(), _request),
}


def audit_columns(df: DataFrame, event: str) -> tuple[Column, dict[str, Column]]:
    """For which rows of a job's output an audit row is due, and all its columns."""
    due, values_of = EVENTS[event]
    own = {"event": F.lit(event), **values_of(df)}
    cols = {}
    for f in T.StructType.fromDDL(AUDIT):
        record = f.name in ("record_id", "session_id", "ts") and f.name in df.columns
        value = own.get(f.name, F.col(f.name) if record else F.lit(None))
        cols[f.name] = value.cast(f.dataType)
    return due(df), cols


def _audit(df: DataFrame, policy: Policy, event: str) -> DataFrame:
    """Rows of the audit schema; none at all when the policy keeps no audit."""
    due, cols = audit_columns(df, event)
    return df.filter(F.lit(policy.audit_enabled) & due).select(
        *[c.alias(name) for name, c in cols.items()]
    )


def audit_guardrail_scan(advised: DataFrame, policy: Policy) -> DataFrame:
    """From ``inbound_advisory``."""
    return _audit(advised, policy, "guardrail_scan")


def audit_tool_result(redacted: DataFrame, policy: Policy) -> DataFrame:
    """From ``tool_result_redact``."""
    return _audit(redacted, policy, "tool_result_scan")


def audit_outbound(redacted: DataFrame, policy: Policy) -> DataFrame:
    """From ``outbound_redact``."""
    return _audit(redacted, policy, "outbound_scan")


def audit_reply_payload(redacted: DataFrame, policy: Policy) -> DataFrame:
    """From ``reply_payload_redact``."""
    return _audit(redacted, policy, "reply_payload_redacted")


def audit_blocked(gated: DataFrame, policy: Policy) -> DataFrame:
    """From ``inbound_gate``."""
    return _audit(gated, policy, "run_blocked")


def audit_request_created(requests: DataFrame, policy: Policy) -> DataFrame:
    """From the admitted rows of ``create_requests``."""
    return _audit(requests, policy, "access_request_created")


def audit_request_resolved(replies: DataFrame, policy: Policy) -> DataFrame:
    """From ``resolve_replies``: one row per id that was resolved."""
    return _audit(replies, policy, "access_request_resolved")


def span_facts(scanned: DataFrame, policy: Policy) -> DataFrame:
    """One short row per span - channel, label, action, digest of the value - and no text."""
    digest = F.unhex(F.sha2(F.col("e.text").cast("binary"), 256))
    return scanned.select(
        "record_id", "channel", "ts", F.explode("entities").alias("e")
    ).select(
        "record_id",
        "channel",
        "ts",
        F.col("e.label").alias("label"),
        action_of(F.col("e.label"), policy).alias("action"),
        digest.alias("digest"),
    )


def audit_rollup(facts: DataFrame, approximate: bool = False) -> DataFrame:
    """Spans, records and distinct values over the cube of channel, label and action.

    Facts are first counted per record, per value and per combination of the
    three columns, in one aggregate.  A record or a value is then the set of
    the combinations it has; equal sets are counted, and the cube expands the
    different sets, not records, values or spans.  What one task holds at once
    is one such set.  With ``approximate`` records and values are counted by
    sketches, which merge map-side and need no second shuffle.
    """
    keys = ["channel", "label", "action"]
    if approximate:
        base = facts.groupBy(*keys, "record_id", "digest").agg(F.count("*").alias("n"))
        sketch = F.approx_count_distinct
        return base.cube(*keys).agg(
            F.sum("n").alias("entities"),
            sketch("record_id").alias("records"),
            sketch("digest").alias("distinct_values"),
            F.grouping_id().cast("int").alias("level"),
        )
    # kind: 1 a record, 2 a value, 3 a combination, which alone keeps the number of its spans
    sets = [[*keys, "record_id"], [*keys, "digest"], keys]
    counted = facts.groupingSets(sets, *keys, "record_id", "digest").agg(
        F.count("*").alias("n"), F.grouping_id().cast("int").alias("kind")
    )
    known = "kind = 3 or kind = 1 and record_id is not null or kind = 2 and digest is not null"
    one = F.struct(*keys)
    alone = F.when(F.col("kind") == 3, one).alias("alone")
    owners = (
        counted.filter(known)
        .groupBy("kind", "record_id", "digest", alone)
        .agg(F.array_sort(F.collect_list(one)).alias("cells"), F.sum("n").alias("n"))
    )
    equal = owners.groupBy("kind", "cells").agg(F.count("*").alias("owners"), F.sum("n").alias("n"))
    number = F.when(F.col("kind") == 3, F.col("n")).otherwise(F.col("owners"))
    cells = equal.select(
        "kind",
        F.sha2(F.to_json("cells"), 256).alias("set"),
        number.alias("number"),
        F.explode("cells").alias("cell"),
    )
    kinds = {k: facts.schema[k].dataType for k in keys}
    # a bit of the level says that its column is summed over, as in grouping_id()
    levels = [
        F.struct(
            F.lit(level).alias("level"),
            *(
                (F.lit(None).cast(kinds[k]) if level & bit else F.col("cell")[k]).alias(k)
                for k, bit in zip(keys, (4, 2, 1), strict=True)
            ),
        )
        for level in range(8)
    ]
    once = cells.select("kind", "set", "number", F.inline(F.array(*levels))).distinct()
    total = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("number")).otherwise(0))
    return (
        once.groupBy("level", *keys)
        .agg(
            total(3).alias("entities"), total(1).alias("records"), total(2).alias("distinct_values")
        )
        .select(*keys, "entities", "records", "distinct_values", "level")
    )


def audit_hourly(facts: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Spans per hour, channel, label and action; on a stream, hours older than the watermark are closed."""
    base = facts.withWatermark("ts", watermark) if facts.isStreaming else facts
    return (
        base.groupBy(F.window("ts", "1 hour").alias("w"), "channel", "label", "action")
        .agg(F.count("*").alias("entities"))
        .select(F.col("w.start").alias("hour"), "channel", "label", "action", "entities")
    )
