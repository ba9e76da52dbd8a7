"""Access requests: who may see the value behind a placeholder, as table jobs over events.

Events are rows ``session_id, seq, ts, kind, ...`` with a ``seq`` that orders a
session.  The bulk of the work - looking up originals, settling resolutions -
is aggregates and joins whose keys include the request or the placeholder, so
that a hot session spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import replies as S
from .mapping import MAX_MAPPINGS, snapshot_originals
from .running import BUCKET_SPAN, running_sum
from .sessions import null_safe
from .shared import written

# --- fixed values
STATUSES = ("pending", "approved", "denied", "follow_up")
RESOLUTIONS = ("approve", "deny", "follow_up")
MAX_PENDING = 50
# ---

EVENTS = (
    "session_id string, seq bigint, ts timestamp, kind string, placeholder string, original string, "
    "entity_type string, reason string, context string, request_id string, "
    "request_ids array<string>, action string, message string"
)


def _around(parts: tuple[str, ...], *values: Column) -> Column:
    """The parts of a sentence with the values between them."""
    out = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:], strict=True):
        out += [value, F.lit(part)]
    return F.concat(*out)


def mapping_events(events: DataFrame) -> DataFrame:
    """The writes among the events, one placeholder each."""
    return events.filter("kind = 'mapping'").select(
        "session_id", "seq", F.lit(0).alias("ord"), "placeholder", "original"
    )


def resolutions(events: DataFrame) -> DataFrame:
    """One row per id that a resolve event names; the list wins over the single id."""
    listed = F.coalesce(F.size("request_ids"), F.lit(-1)) > 0
    ids = F.when(listed, F.col("request_ids")).otherwise(F.array("request_id"))
    return (
        events.filter("kind = 'resolve'")
        .select("session_id", "seq", "ts", "action", "message", listed.alias("batch"), ids.alias("ids"))
        .select(
            "session_id",
            "seq",
            "ts",
            "action",
            "message",
            "batch",
            F.posexplode("ids").alias("pos", "request_id"),
        )
    )


def _request_no(request_id: Column) -> Column:
    return F.regexp_extract(request_id, r"\AREQ-([1-9][0-9]{0,17})\z", 1).try_cast("bigint")


@null_safe
def number_requests(events: DataFrame, span: int = BUCKET_SPAN) -> DataFrame:
    """Request events with ``request_no``, their number within the session, and no cap.

    ``session_requests`` is how many the session has in all.  ``_row`` tells requests of one ``seq``
    apart and puts them in the order in which they came.
    """
    requests = events.filter("kind = 'request'").select(
        "session_id", "seq", "ts", "placeholder", "entity_type", "reason", "context",
        F.monotonically_increasing_id().alias("_row"),
    )
    one = {"request_no": F.lit(1)}
    return running_sum(
        requests, "session_id", "seq", one, span, total="session_requests", order=("_row",)
    )


def _first_terminal(numbered: DataFrame, events: DataFrame) -> DataFrame:
    """Per request the first approval or denial after it was made."""
    ends = resolutions(events).filter(F.col("action").isin("approve", "deny")).select(
        "session_id", "seq", _request_no(F.col("request_id")).alias("request_no")
    )
    made = numbered.select("session_id", "request_no", F.col("seq").alias("created_seq"))
    return (
        made.join(ends, ["session_id", "request_no"])
        .filter(F.col("seq") > F.col("created_seq"))
        .groupBy("session_id", "request_no")
        .agg(F.min("seq").alias("seq"))
    )


def _capped_sessions(numbered: DataFrame, events: DataFrame, cap: int, span: int) -> DataFrame:
    """Sessions in which, were there no cap, a request would meet ``cap`` open ones.

    Up to the first such request both runs are the same, so a session with none
    runs the same throughout.
    """
    steps = numbered.select("session_id", "seq", F.lit(1).alias("d")).unionByName(
        _first_terminal(numbered, events)
        .groupBy("session_id", "seq")
        .agg((-F.count("*")).cast("int").alias("d"))
    )
    open_now = running_sum(steps, "session_id", "seq", {"open": F.col("d")}, span)
    return (
        open_now.filter((F.col("d") == 1) & (F.col("open") > cap)).select("session_id").distinct()
    )


class PendingGate:
    """Which requests of one session are admitted: a byte per request, open or closed."""

    def __init__(self, cap: int):
        self.cap = cap
        self.open = 0
        self.closed = bytearray()

    def request(self) -> int | None:
        if self.open >= self.cap:
            return None
        self.closed.append(0)
        self.open += 1
        return len(self.closed)

    def close(self, number: int) -> None:
        if 0 < number <= len(self.closed) and not self.closed[number - 1]:
            self.closed[number - 1] = 1
            self.open -= 1


@null_safe
def admit_requests(
    events: DataFrame, cap: int = MAX_PENDING, span: int = BUCKET_SPAN
) -> DataFrame:
    """Request events with ``request_no``; null where ``cap`` requests were open.

    Whether a request is admitted depends on all earlier decisions of its
    session, but only once the cap is reached.  Sessions with no more requests
    than the cap, and those in which it is never reached, are numbered in
    parallel.  The others are walked in order with a state of one byte per
    request, over rows that hold no text.
    """
    numbered = written(number_requests.keyed(events, span), "numbered")
    busy = numbered.filter(F.col("session_requests") > cap)
    if busy.isEmpty():
        return numbered.drop("session_requests")
    capped = written(_capped_sessions(busy, events, cap, span), "capped")
    plain = numbered.join(capped, "session_id", "left_anti").drop("session_requests")
    requests = busy.join(capped, "session_id", "left_semi").drop("session_requests", "request_no")
    moves = requests.select(
        "session_id", "seq", F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("closes"), "_row"
    ).unionByName(
        resolutions(events)
        .filter(F.col("action").isin("approve", "deny"))
        .join(capped, "session_id", "left_semi")
        .select(
            "session_id", "seq", "pos", _request_no(F.col("request_id")).alias("closes"),
            F.lit(-1).cast("bigint").alias("_row"),
        )
        .filter("closes is not null")
    )

    def fold(batches: Iterator) -> Iterator:
        import pandas as pd

        session, gate = None, PendingGate(cap)
        for pdf in batches:
            out = []
            for s, _, _, closes, row in pdf.itertuples(index=False, name=None):
                if s != session:
                    session, gate = s, PendingGate(cap)
                if closes:
                    gate.close(closes)
                else:
                    out.append((row, gate.request()))
            got = pd.DataFrame(out, columns=["_row", "request_no"])
            got["request_no"] = got["request_no"].astype("Int64")
            yield got

    walked = (
        moves.repartition("session_id")
        .sortWithinPartitions("session_id", "seq", "pos", "_row")
        .mapInPandas(fold, "_row bigint, request_no bigint")
    )
    return plain.unionByName(
        requests.join(walked, "_row").select(*plain.columns)
    )


@null_safe
def create_requests(
    events: DataFrame,
    writes: DataFrame | None = None,
    cap: int = MAX_PENDING,
    max_mappings: int = MAX_MAPPINGS,
    span: int = BUCKET_SPAN,
) -> DataFrame:
    """Each request event with its id and a snapshot of the original, or with the reason it was refused.

    The original is the one of the moment the request is made; later writes to
    the map do not change it.  ``writes`` defaults to the mapping events.
    """
    admitted = admit_requests(events, cap, span)
    found = snapshot_originals(
        admitted, mapping_events(events) if writes is None else writes, max_mappings, span
    )
    ok = F.col("request_no").isNotNull()
    request_id = F.concat(F.lit("REQ-"), F.col("request_no").cast("string"))
    refusal = f"{S.REFUSED[0]}{cap}{S.REFUSED[1]}"
    reply = _around(S.CREATED, request_id, F.col("entity_type"), F.col("placeholder"))
    return found.select(
        "session_id",
        "seq",
        "ts",
        "request_no",
        F.when(ok, request_id).alias("request_id"),
        "placeholder",
        "entity_type",
        "reason",
        "context",
        F.when(ok, F.lit("pending")).alias("status"),
        F.when(ok, F.col("original_text")).alias("original_text"),
        F.when(ok, reply).alias("reply"),
        F.when(~ok, F.lit(refusal)).alias("error"),
    )


@null_safe
def resolve_replies(events: DataFrame, requests: DataFrame) -> DataFrame:
    """The result of each resolution: a status and a reply, or an error; one bad id spoils no other.

    ``requests`` is what ``create_requests`` gave.  The first approval or
    denial settles a request; before it, follow-ups may repeat.
    """
    made = requests.filter("request_id is not null").select(
        "session_id",
        "request_id",
        F.col("seq").alias("created_seq"),
        "entity_type",
        "original_text",
    )
    asked = resolutions(events)
    valid = F.col("action").isin(*RESOLUTIONS)
    known = asked.join(made, ["session_id", "request_id"], "left").withColumn(
        "known", F.coalesce(F.col("seq") > F.col("created_seq"), F.lit(False))
    )
    terminal = (
        known.filter(F.col("known") & F.col("action").isin("approve", "deny"))
        .groupBy("session_id", "request_id")
        .agg(F.min(F.struct("seq", "pos", "action")).alias("term"))
    )
    df = known.join(terminal, ["session_id", "request_id"], "left")
    here = F.struct("seq", "pos")
    settled = F.col("term").isNotNull() & (here > F.struct("term.seq", "term.pos"))
    past = F.when(F.col("term.action") == "approve", "approved").otherwise("denied")
    named = F.col("request_id")
    wrong = F.concat(F.coalesce("action", F.lit("undefined")), F.lit(S.BAD_ACTION[1] + ", ".join(RESOLUTIONS)))
    error = (
        F.when(~F.coalesce(valid, F.lit(False)), F.concat(F.lit(S.BAD_ACTION[0]), wrong))
        .when(F.coalesce(named, F.lit("")) == "", F.lit(S.NO_ID))
        .when(~F.col("known"), _around(S.NOT_FOUND, named))
        .when(settled, _around(S.SETTLED, named, past))
    )
    df = df.withColumn("error", error)
    ok = F.col("error").isNull()
    approve = ok & (F.col("action") == "approve")
    status = F.element_at(
        F.create_map(*[F.lit(x) for x in ("approve", "approved", "deny", "denied", "follow_up", "follow_up")]),
        F.col("action"),
    )
    has_text = F.coalesce(F.col("original_text"), F.lit("")) != ""
    reply = (
        F.when(
            F.col("action") == "approve",
            F.when(has_text, F.concat(F.lit(S.APPROVED), F.col("original_text"))).otherwise(S.APPROVED_BLANK),
        )
        .when(F.col("action") == "deny", F.coalesce(F.col("message"), F.lit(S.DENIED)))
        .otherwise(_around(S.ASKED, F.coalesce(F.col("message"), F.lit(""))))
    )
    return df.select(
        "session_id",
        "seq",
        "pos",
        "ts",
        "request_id",
        "action",
        "message",
        "batch",
        F.when(ok, status).alias("status"),
        F.when(approve, F.col("original_text")).alias("original_text"),
        F.when(ok & ~F.col("batch"), reply).alias("reply"),
        "error",
        F.when(ok, F.col("entity_type")).alias("entity_type"),
    )


@null_safe
def request_table(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """All requests with the state they have reached."""
    at = F.struct("seq", "pos")
    terminal = F.col("action").isin("approve", "deny")
    outcome = (
        replies.filter("error is null")
        .groupBy("session_id", "request_id")
        .agg(
            F.max(F.when(terminal, F.struct("status", "ts", "message"))).alias("term"),
            F.max_by(
                F.struct("message"), F.when(~terminal, at)
            ).alias("asked"),
        )
    )
    made = requests.filter("request_id is not null")
    return made.join(outcome, ["session_id", "request_id"], "left").select(
        "session_id",
        "request_id",
        "request_no",
        "placeholder",
        "entity_type",
        "original_text",
        "reason",
        "context",
        F.coalesce(
            F.col("term.status"), F.when(F.col("asked").isNotNull(), "follow_up"), F.lit("pending")
        ).alias("status"),
        F.col("ts").alias("created_at"),
        F.col("term.ts").alias("resolved_at"),
        F.col("asked.message").alias("follow_up_message"),
        F.col("term.message").alias("response_message"),
    )


def list_requests(table: DataFrame, status: str | None = None) -> DataFrame:
    """The view for readers: each status shows the columns that belong to it and no others.

    A status that does not exist gives one row with the error.
    """
    if status and status not in STATUSES:
        text = f"{S.BAD_STATUS[0]}{status}{S.BAD_STATUS[1]}{', '.join(STATUSES)}"
        return table.sparkSession.createDataFrame([(text,)], "error string")
    rows = table.filter(F.col("status") == status) if status else table
    is_ = lambda *names: F.col("status").isin(*names)
    return rows.select(
        "session_id",
        "request_id",
        "placeholder",
        "entity_type",
        "reason",
        "context",
        "status",
        "created_at",
        F.when(is_("approved"), F.col("original_text")).alias("original_text"),
        F.when(is_("approved", "denied"), F.col("resolved_at")).alias("resolved_at"),
        F.when(is_("denied"), F.col("response_message")).alias("response_message"),
        F.when(is_("follow_up"), F.col("follow_up_message")).alias("follow_up_message"),
    )


def list_totals(table: DataFrame, status: str | None = None) -> DataFrame:
    """Per session how many rows ``list_requests`` has, and under which filter."""
    rows = table.filter(F.col("status") == status) if status else table
    return rows.groupBy("session_id").agg(
        F.count("*").alias("total"), F.lit(status or "all").alias("filter")
    )


def request_counts(table: DataFrame) -> DataFrame:
    """Per session the requests that wait for a decision, and all of them."""
    return table.groupBy("session_id").agg(
        F.count_if(F.col("status").isin("pending", "follow_up")).alias("pending_count"),
        F.count("*").alias("total_count"),
    )


@null_safe
def get_requests(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The requests named by ``(session_id, request_id)`` rows; unknown ids give none."""
    return table.join(ids.select("session_id", "request_id").distinct(), ["session_id", "request_id"], "left_semi")
