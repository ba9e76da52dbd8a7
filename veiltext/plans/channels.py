"""The channel jobs: text records in, gated, annotated or redacted records out.

Each job is a chain of projections and filters: one narrow stage, no shuffle,
and the same function for a table and for a stream.  The steps that read the
text are fenced (see ``fence``) so that Spark evaluates them once per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import empty_array, remembered
from ..functions.detect import detect_structured
from ..functions.json_strings import message_strings
from ..functions.messages import text_in, text_replaced
from ..functions.overlap import resolve_overlaps
from ..functions.redact import placeholders, redact
from ..functions.schema import ENTITIES, MAPPING_ENTRY
from ..operators.allowing import AllowTables, drop_listed
from ..operators.policy import (
    distinct_labels,
    drop_allowed_inline,
    keep_confident,
    plan_of,
    summary_of,
)
from ..sources.policies import Policy
from ..sources.texts import nonempty

# --- the sentences of gate, notice and report, in this library's own words
NOTICE_TAG = "GUARDRAIL"
BLOCK_REASON = "policy blocks "
BLOCK_MESSAGE = ("Not delivered: the text holds values of the kind ", ". Send it again without them.")
NOTICE_BLOCKED = (
    " block] The next message holds ",
    ", which this policy blocks. Leave these values out of all you do and ask for the message without them.",
)
NOTICE_WARNED = (" warning] The next message holds ", ". Use these values only where they are needed.")
NOTICE_REDACTED = (
    " redaction] The next message holds ",
    ". Write their placeholders in place of the values; results and outgoing texts are redacted anyway.",
)
NOTICE_REFERENCE = " placeholders] The message with placeholders:\n"
REDACT_NOTE = "Placeholders stand for the values. An access request can ask a reviewer to reveal one."
# ---


def fence(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later steps read but never recompute.

    Spark moves a filter on a computed column below the projection and repeats
    the computation there.  It does not move one below a generator, so the
    value passes through ``explode`` of a one-element array.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def scan(
    texts: DataFrame,
    policy: Policy,
    ner: bool = False,
    resolve: bool = True,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Add ``entities``: structured spans, and those of column ``ner``, under the policy.

    Allowlisted spans go before overlaps are resolved, so that an allowed span
    never hides another one.  ``allow`` adds allowlists that are tables.
    """

    def found() -> Column:
        spans = drop_allowed_inline(detect_structured("text", policy.detectors), policy)
        if ner:
            sure = drop_allowed_inline(keep_confident(F.col("ner"), policy), policy)
            spans = F.concat(spans, F.coalesce(sure, F.array().cast(ENTITIES)))
        return resolve_overlaps(spans) if resolve and allow is None else spans

    key = ("scan", repr(policy), ner, resolve, allow is None)
    scanned = fence(texts, "entities", remembered(key, found))
    if allow is None:
        return scanned
    scanned = drop_listed(scanned, "entities", allow)
    return fence(scanned, "entities", resolve_overlaps("entities")) if resolve else scanned


def _redacted(df: DataFrame, spans: str, strategy: Column | str) -> DataFrame:
    def value() -> Column:
        return redact("text", spans, strategy)

    named = isinstance(strategy, str)
    out = fence(df, "_r", remembered(("redact", spans, strategy), value) if named else value())
    return (
        out.withColumn("redacted_text", F.col("_r.redacted_text"))
        .withColumn("mapping", F.col("_r.mapping"))
        .drop("_r")
    )


def _counted(df: DataFrame) -> DataFrame:
    return df.withColumn("entity_count", F.size("entities")).withColumn(
        "labels", distinct_labels(F.col("entities"))
    )


def _untouched(texts: DataFrame) -> DataFrame:
    """What a job gives under a policy that is switched off: each text as it came."""
    return _counted(
        texts.withColumn("entities", F.array().cast(ENTITIES))
        .withColumn("redacted_text", F.col("text"))
        .withColumn("mapping", empty_array(MAPPING_ENTRY))
    ).drop("text")


def _enforce(
    texts: DataFrame,
    policy: Policy,
    changed_only: bool,
    resolve: bool = True,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Structured spans only; each is redacted, whatever the action of its label."""
    if not policy.enabled:
        return _untouched(texts).filter(F.lit(not changed_only))
    found = scan(texts, policy, resolve=resolve, allow=allow)
    if changed_only:
        found = found.filter(F.size("entities") > 0)
    return _counted(_redacted(found, "entities", policy.redact_strategy)).drop("text")


def outbound_redact(
    texts: DataFrame,
    policy: Policy,
    changed_only: bool = True,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Outgoing texts with all structured values redacted; delivery is never cancelled.

    With ``changed_only`` the job gives the records that need a rewrite; without
    it also the clean ones, as they came.
    """
    return _enforce(nonempty(texts), policy, changed_only, allow=allow)


def tool_result_redact(
    records: DataFrame,
    policy: Policy,
    message: str | None = None,
    overlap_mode: str = "resolve",
    changed_only: bool = True,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Tool results with all structured values redacted.

    ``message`` names a column of JSON messages to read the text from and to
    write it back to; without it the text is in ``text``.  ``overlap_mode``
    ``resolve`` settles overlapping spans first.  ``splice`` replaces each span
    at its own offsets even where spans overlap, which can leave fragments of a
    value or eat neighbouring text; it is there for parity.
    """
    if overlap_mode not in ("resolve", "splice"):
        raise ValueError(f"unknown overlap_mode {overlap_mode!r}")
    resolve = overlap_mode == "resolve"
    if message is None:
        return _enforce(nonempty(records), policy, changed_only, resolve, allow)
    # the strings of a message are found once, for reading it and for writing it
    parsed = fence(records, "_strings", message_strings(F.col(message)))
    texts = fence(parsed, "text", text_in(F.col(message), F.col("_strings"))).filter(F.col("text") != "")
    out = _enforce(texts, policy, changed_only, resolve, allow)
    new = text_replaced(F.col(message), F.col("_strings"), F.col("redacted_text"))
    rewritten = F.when(F.col("entity_count") > 0, new).otherwise(F.col(message))
    return out.withColumn(message, rewritten).drop("redacted_text", "_strings")


def reply_payload_redact(
    records: DataFrame,
    policy: Policy,
    payload: str = "payload",
    changed_only: bool = True,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Reply payloads (a struct with a field ``text``) with that field redacted; all else is kept."""
    texts = nonempty(records.withColumn("text", F.col(payload)["text"]))
    out = _enforce(texts, policy, changed_only, allow=allow)
    return out.withColumn(
        payload, F.col(payload).withField("text", F.col("redacted_text"))
    ).drop("redacted_text")


def block_gate(scanned: DataFrame, policy: Policy) -> DataFrame:
    """Add ``outcome`` and, for blocked records, why; the gate is open unless the policy can block."""
    if not (policy.enabled and policy.blocks):
        return (
            scanned.withColumn("outcome", F.lit("pass"))
            .withColumn("reason", F.lit(None).cast("string"))
            .withColumn("message", F.lit(None).cast("string"))
            .withColumn("category", F.lit(None).cast("string"))
            .withColumn("blocked", F.lit(0))
            .withColumn("blocked_labels", F.array().cast("array<string>"))
        )
    blocked = plan_of("entities", policy)["blocked"]
    df = scanned.withColumn("blocked", F.size(blocked)).withColumn(
        "blocked_labels", distinct_labels(blocked)
    )
    names = F.array_join("blocked_labels", ", ")
    hit = F.col("blocked") > 0
    return (
        df.withColumn("outcome", F.when(hit, "block").otherwise("pass"))
        .withColumn("reason", F.when(hit, F.concat(F.lit(BLOCK_REASON), names)))
        .withColumn(
            "message",
            F.when(hit, F.concat(F.lit(BLOCK_MESSAGE[0]), names, F.lit(BLOCK_MESSAGE[1]))),
        )
        .withColumn("category", F.when(hit, "pii"))
    )


def inbound_gate(
    texts: DataFrame, policy: Policy, ner: bool = False, allow: AllowTables | None = None
) -> DataFrame:
    """Each incoming record with its outcome, ``block`` or ``pass``."""
    base = nonempty(texts)
    scanned = (
        scan(base, policy, ner, allow=allow)
        if policy.enabled and policy.blocks
        else base.withColumn("entities", F.array().cast(ENTITIES))
    )
    return block_gate(scanned, policy).drop("text", "entities", "ner")


def guardrail_notice(summary: Column, redacted_text: Column, tag: str = NOTICE_TAG) -> Column:
    """The paragraphs of advice for one record; ``None`` parts are left out."""

    def part(kind: str, words: tuple[str, str]) -> Column:
        names = F.array_join(summary[f"{kind}_labels"], ", ")
        return F.when(
            summary[kind] > 0, F.concat(F.lit(f"[{tag}{words[0]}"), names, F.lit(words[1]))
        )

    return F.concat_ws(
        "\n\n",
        part("blocked", NOTICE_BLOCKED),
        part("warned", NOTICE_WARNED),
        part("redacted", NOTICE_REDACTED),
        F.when(
            summary["redacted"] > 0, F.concat(F.lit(f"[{tag}{NOTICE_REFERENCE}"), redacted_text)
        ),
    )


def _report_scan(
    texts: DataFrame, policy: Policy, ner: bool, allow: AllowTables | None
) -> DataFrame:
    """The scan of a report: under a policy that is switched off nothing is found."""
    if policy.enabled:
        return scan(texts, policy, ner, allow=allow)
    return texts.withColumn("entities", F.array().cast(ENTITIES))


def _planned(
    texts: DataFrame, policy: Policy, ner: bool, allow: AllowTables | None = None
) -> DataFrame:
    """Scanned records with ``plan`` and ``summary``."""
    scanned = _report_scan(texts, policy, ner, allow)
    return scanned.withColumn("plan", plan_of("entities", policy)).withColumn(
        "summary", summary_of("plan")
    )


def inbound_advisory(
    texts: DataFrame,
    policy: Policy,
    ner: bool = False,
    tag: str = NOTICE_TAG,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Incoming records that hold a sensitive value, each with a notice to put before it.

    The text itself is not rewritten; the notice holds its placeholder form, in
    which the spans with action ``redact`` are replaced.
    """
    base = nonempty(texts)
    if not policy.enabled:
        base = base.filter(F.lit(False))
    scanned = scan(base, policy, ner, allow=allow).filter(F.size("entities") > 0)
    df = scanned.withColumn("plan", plan_of("entities", policy)).withColumn(
        "summary", summary_of("plan")
    )
    df = _redacted(df, "plan.redacted", policy.redact_strategy)
    return df.withColumn(
        "notice", guardrail_notice(F.col("summary"), F.col("redacted_text"), tag)
    ).drop("text", "plan", "redacted_text", "ner")


def scan_report(
    texts: DataFrame, policy: Policy, ner: bool = False, allow: AllowTables | None = None
) -> DataFrame:
    """Each record's spans, their count and a sentence about them."""
    df = _counted(_report_scan(texts, policy, ner, allow))
    names = F.array_join("labels", ", ")
    sentence = F.when(
        F.col("entity_count") > 0,
        F.concat(F.lit("Found "), F.col("entity_count").cast("string"), F.lit(" entities: "), names),
    ).otherwise("No entities detected")
    return df.withColumn("summary", sentence).drop("text", "ner")


def preview_report(
    texts: DataFrame,
    policy: Policy,
    strategy: Column | str | None = None,
    ner: bool = False,
    allow: AllowTables | None = None,
) -> DataFrame:
    """What the policy would do to each record; no value of a span is in it, and nothing is kept for later lookup."""
    how = policy.redact_strategy if strategy is None else strategy
    df = _redacted(_planned(texts, policy, ner, allow), "plan.redacted", how)
    name = F.lit(how) if isinstance(how, str) else how
    return df.withColumn("strategy", name).drop("text", "plan", "mapping", "entities", "ner")


def preview_policies(
    texts: DataFrame, policies: dict[str, Policy], ner: bool = False
) -> DataFrame:
    """``preview_report`` under several candidate policies: one row per record and candidate.

    The text is searched once for all candidates with the same detectors; each
    filters and resolves the same spans inside the row, so nothing is joined and
    nothing shuffled.
    """
    raw, searched = texts, {}
    for rules in dict.fromkeys(p.detectors for p in policies.values()):
        searched[rules] = f"_raw{len(searched)}"
        raw = fence(raw, searched[rules], remembered(("structured", rules), lambda rules=rules: detect_structured("text", rules)))

    def candidate(name: str, p: Policy) -> Column:
        es = drop_allowed_inline(F.col(searched[p.detectors]), p)
        if ner:
            es = F.concat(es, drop_allowed_inline(keep_confident(F.col("ner"), p), p))
        return F.struct(
            F.lit(name).alias("policy_id"),
            F.lit(p.redact_strategy).alias("strategy"),
            resolve_overlaps(es).alias("entities"),
        )

    df = raw.select(
        *[c for c in raw.columns if c not in (*searched.values(), "ner")],
        F.inline(F.array(*[candidate(n, p) for n, p in policies.items()])),
    )
    actions = F.lit(None).cast("struct<blocked:%s,warned:%s,redacted:%s>" % ((ENTITIES,) * 3))
    for name, p in policies.items():
        actions = F.when(F.col("policy_id") == name, plan_of("entities", p)).otherwise(actions)
    df = fence(df, "plan", actions).withColumn("summary", summary_of("plan"))
    df = _redacted(df, "plan.redacted", F.col("strategy"))
    return df.drop("text", "plan", "mapping", "entities")


def redacted_records(
    texts: DataFrame,
    policy: Policy,
    strategy: Column | str | None = None,
    ner: bool = False,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Each record with all its spans redacted; ``entities`` and ``mapping`` are for the restricted sinks."""
    how = policy.redact_strategy if strategy is None else strategy
    return _redacted(_report_scan(texts, policy, ner, allow), "entities", how).drop("text", "ner")


def redact_report(
    texts: DataFrame,
    policy: Policy,
    strategy: Column | str | None = None,
    ner: bool = False,
    allow: AllowTables | None = None,
) -> DataFrame:
    """Each record with all its spans redacted, and the placeholders used; no original is in it."""
    return (
        redacted_records(texts, policy, strategy, ner, allow)
        .withColumn("entities_found", F.size("entities"))
        .withColumn("placeholders", placeholders("mapping"))
        .withColumn("note", F.lit(REDACT_NOTE))
        .drop("entities", "mapping")
    )
