"""A policy applied to spans: thresholds, allowlist, action per label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.labels import canonical_label
from ..functions.text import fold_case, fold_value
from ..sources.policies import MAX_SUBJECT_CHARS, Policy


def _by_label(label: Column, table: dict, default) -> Column:
    if not table:
        return F.lit(default)
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(pairs[label], F.lit(default))


def threshold_of(label: Column, policy: Policy) -> Column:
    return _by_label(canonical_label(label), policy.entity_thresholds, policy.confidence_threshold)


def action_of(label: Column, policy: Policy) -> Column:
    return _by_label(label, policy.entity_actions, policy.guardrail_mode)


def keep_confident(spans: Column, policy: Policy) -> Column:
    """NER spans at or above the threshold of their label."""
    return F.filter(spans, lambda e: e["confidence"] >= threshold_of(e["label"], policy))


def allowed_exact(entity: Column, policy: Policy) -> Column | None:
    # An entry can be blank only if it was blank in the policy, and those are dropped there.
    values = {fold_value(v) for v in policy.allow_values}
    return fold_case(entity["text"]).isin(sorted(values)) if values else None


def allowed_pattern(entity: Column, policy: Policy) -> Column | None:
    """The whole span text matches a pattern; longer texts are never suppressed by one."""
    if not policy.allow_patterns:
        return None
    hit = F.lit(False)
    for p in policy.allow_patterns:
        hit = hit | entity["text"].rlike(rf"(?iu)\A(?:{p})\z")
    return (F.length(entity["text"]) <= MAX_SUBJECT_CHARS) & hit


def allowed_for_label(entity: Column, policy: Policy) -> Column | None:
    hits = None
    for label, values in policy.allow_entities.items():
        if not values:
            continue
        hit = (entity["label"] == label) & fold_case(entity["text"]).isin(
            sorted({fold_value(v) for v in values})
        )
        hits = hit if hits is None else hits | hit
    return hits


def allowed(entity: Column, policy: Policy) -> Column | None:
    """Whether a span is on the allowlist; ``None`` when the list is empty."""
    hits = None
    for rule in (allowed_exact, allowed_pattern, allowed_for_label):
        hit = rule(entity, policy)
        if hit is not None:
            hits = hit if hits is None else hits | hit
    return hits


def drop_allowed_inline(spans: Column, policy: Policy) -> Column:
    """The spans that are not allowlisted; an empty list leaves no trace in the plan.

    A policy's own entries, however many, are hash sets in the expression: they come from a file
    that the driver holds anyway.  Lists that live in tables are joined, see ``allowing.drop_listed``.
    """
    if allowed(F.struct(F.lit("").alias("text"), F.lit("").alias("label")), policy) is None:
        return spans
    return F.filter(spans, lambda e: ~allowed(e, policy))


def plan_of(entities: Column | str, policy: Policy) -> Column:
    """``struct(blocked, warned, redacted)``: the spans by the action of their label."""
    col = F.col(entities) if isinstance(entities, str) else entities

    def pick(action: str) -> Column:
        return F.filter(col, lambda e: action_of(e["label"], policy) == action)

    return F.struct(
        pick("block").alias("blocked"), pick("warn").alias("warned"), pick("redact").alias("redacted")
    )


def distinct_labels(entities: Column) -> Column:
    """Labels in the order of their first span."""
    return F.array_distinct(F.transform(entities, lambda e: e["label"]))


def summary_of(plan: Column | str) -> Column:
    """Counts and labels per action, without any value."""
    col = F.col(plan) if isinstance(plan, str) else plan
    parts = ("blocked", "warned", "redacted")
    sizes = [F.size(col[p]) for p in parts]
    return F.struct(
        (sizes[0] + sizes[1] + sizes[2]).alias("total"),
        *[s.alias(p) for s, p in zip(sizes, parts)],
        *[distinct_labels(col[p]).alias(f"{p}_labels") for p in parts],
    )
