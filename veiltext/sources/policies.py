"""Policies: read one from JSON, check it, and hold it as plain values for the jobs."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import SparkSession

from ..functions.detect import Detector
from ..functions.labels import canonical
from ..functions.redact import STRATEGIES
from ..functions.text import strip_value

# --- fixed values
ACTIONS = ("redact", "block", "warn")
MAX_PATTERN_CHARS = 512
MAX_SUBJECT_CHARS = 512
# A group that holds a quantifier and is itself quantified.
NESTED_QUANTIFIER = r"\((?:[^()\\]|\\.)*(?<!\\)[+*}](?:[^()\\]|\\.)*\)\s*[+*{]"
DEFAULT_MODEL = "onnx-community/gliner_large-v2.1"
# ---


class PolicyError(ValueError):
    """A policy that no job may run under."""


@dataclass(frozen=True)
class Policy:
    enabled: bool = True
    guardrail_mode: str = "redact"
    redact_strategy: str = "token"
    model: str = DEFAULT_MODEL
    confidence_threshold: float = 0.5
    custom_entities: tuple[str, ...] = ()
    entity_actions: dict[str, str] = field(default_factory=dict)
    entity_thresholds: dict[str, float] = field(default_factory=dict)
    allow_values: tuple[str, ...] = ()
    allow_patterns: tuple[str, ...] = ()
    allow_entities: dict[str, tuple[str, ...]] = field(default_factory=dict)
    audit_enabled: bool = True
    max_pending: int = 50
    #: Rules of the user's, see ``sources.detectors``; the JSON form holds none.
    detectors: tuple[Detector, ...] = ()

    @property
    def blocks(self) -> bool:
        """Whether any label can be blocked, that is whether the gate is in force."""
        return self.guardrail_mode == "block" or "block" in self.entity_actions.values()

    @property
    def ner_floor(self) -> float:
        """The lowest score of use: what a model is asked for and a span table is read from."""
        return min([self.confidence_threshold, *self.entity_thresholds.values()])


@dataclass(frozen=True)
class Rule:
    """What the JSON form of a policy may hold at a path.

    ``kind``: ``flag``, ``choice``, ``share`` (0 to 1), ``count`` (1 and up); ``choices`` and
    ``shares`` are objects of them by label; ``texts`` and ``patterns`` are lists of strings,
    ``lists`` an object of such lists by label.  ``null``: an explicit null reads as a missing field.
    """

    path: str
    kind: str
    choices: tuple[str, ...] = ()
    null: bool = False


#: The one table that ``policy_from``, ``load_policy`` and ``policy_lint`` go by.
RULES = (
    Rule("enabled", "flag"),
    Rule("guardrail_mode", "choice", ACTIONS),
    Rule("redactStrategy", "choice", STRATEGIES),
    Rule("confidence_threshold", "share", null=True),
    Rule("auditEnabled", "flag"),
    Rule("maxPendingRequests", "count"),
    Rule("entityConfidenceThresholds", "shares", null=True),
    Rule("entityActions", "choices", ACTIONS, null=True),
    Rule("allowlist", "object", null=True),
    Rule("allowlist.values", "texts", null=True),
    Rule("allowlist.patterns", "patterns", null=True),
    Rule("allowlist.entities", "lists", null=True),
)


def _number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _scalar_fault(kind: str, value, choices: tuple[str, ...]) -> str | None:
    if kind == "flag":
        return None if isinstance(value, bool) else "not_boolean"
    if kind == "choice":
        return None if isinstance(value, str) and value in choices else "bad_enum"
    if kind == "share":
        if not _number(value):
            return "not_number"
        return None if 0 <= value <= 1 else "out_of_range"
    good = _number(value) and math.isfinite(value) and value >= 1 and value == int(value)
    return None if good else "not_positive_integer"


def _pattern_fault(pattern: str, compiles: Callable[[str], bool]) -> str | None:
    if len(pattern) > MAX_PATTERN_CHARS:
        return "pattern_too_long"
    if re.search(NESTED_QUANTIFIER, pattern):
        return "nested_quantifier"
    return None if compiles(pattern) else "invalid_regex"


def _list_faults(path: str, value, fault_of: Callable[[str], str | None]) -> Iterator[tuple[str, str, object]]:
    if not isinstance(value, list):
        yield path, "not_array", value
        return
    for entry in value:
        fault = fault_of(strip_value(entry)) if isinstance(entry, str) else "not_string"
        if fault:
            yield path, fault, entry


def faults(config: dict, compiles: Callable[[str], bool]) -> Iterator[tuple[str, str, object]]:
    """``(path, rule, value)`` of everything in a config that breaks ``RULES``."""
    for rule in RULES:
        *parents, name = rule.path.split(".")
        holder = config
        for parent in parents:
            holder = holder.get(parent) if isinstance(holder, dict) else None
        if not isinstance(holder, dict) or name not in holder:
            continue
        value = holder[name]
        if value is None and rule.null:
            continue
        if rule.kind in ("texts", "patterns"):
            judge = (lambda p: _pattern_fault(p, compiles) if p else None) if rule.kind == "patterns" else lambda _: None
            yield from _list_faults(rule.path, value, judge)
        elif rule.kind in ("choices", "shares", "lists", "object"):
            if not isinstance(value, dict):
                yield rule.path, "not_object", value
                continue
            for key, entry in value.items() if rule.kind != "object" else ():
                path = f"{rule.path}.{key}"
                if rule.kind == "lists":
                    yield from _list_faults(path, entry, lambda _: None)
                elif fault := _scalar_fault(rule.kind.removesuffix("s"), entry, rule.choices):
                    yield path, fault, entry
        elif fault := _scalar_fault(rule.kind, value, rule.choices):
            yield rule.path, fault, value


def compiles_on_jvm(pattern: str) -> bool:
    """Whether the JVM, where patterns run, takes a pattern; without a session the first job says so."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return True
    try:
        spark.sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
    except (Py4JJavaError, IllegalArgumentException):
        return False
    return True


def _texts(values) -> tuple[str, ...]:
    """Entries of a list, trimmed, without blanks, each once."""
    return tuple(dict.fromkeys(x for v in values or () if (x := strip_value(v))))


def policy_from(config: dict) -> Policy:
    """Defaults overlaid by ``config`` (keys of the JSON form), checked and with canonical labels.

    Of keys that are one label the last counts.  A null ``confidence_threshold`` keeps every span.
    """
    for path, rule, value in faults(config, compiles_on_jvm):
        shown = json.dumps(value, ensure_ascii=False, default=str)
        raise PolicyError(f"policy field {path}: {rule} ({shown[:200]})")
    allow = config.get("allowlist") or {}
    threshold = config.get("confidence_threshold", 0.5)
    return Policy(
        enabled=config.get("enabled", True),
        guardrail_mode=config.get("guardrail_mode", "redact"),
        redact_strategy=config.get("redactStrategy", "token"),
        model=config.get("model", DEFAULT_MODEL),
        confidence_threshold=0.0 if threshold is None else float(threshold),
        custom_entities=tuple(config.get("custom_entities") or ()),
        entity_actions={canonical(k): v for k, v in (config.get("entityActions") or {}).items()},
        entity_thresholds={
            canonical(k): float(v) for k, v in (config.get("entityConfidenceThresholds") or {}).items()
        },
        allow_values=_texts(allow.get("values")),
        allow_patterns=_texts(allow.get("patterns")),
        allow_entities={canonical(k): _texts(v) for k, v in (allow.get("entities") or {}).items()},
        audit_enabled=config.get("auditEnabled", True),
        max_pending=int(config.get("maxPendingRequests", 50)),
    )


def load_policy(spark: SparkSession, path: str) -> Policy:
    """Read one policy from a JSON file on any file system Spark knows."""
    return policy_from(json.loads(spark.read.text(path, wholetext=True).head()[0]))


def policy_tables(spark: SparkSession, policy: Policy) -> dict:
    """The policy as small tables, for joins and for SQL users."""
    rows = spark.createDataFrame
    return {
        "policy_scalar": rows(
            [
                (
                    policy.enabled,
                    policy.guardrail_mode,
                    policy.redact_strategy,
                    policy.confidence_threshold,
                    policy.audit_enabled,
                    policy.max_pending,
                )
            ],
            "enabled boolean, guardrail_mode string, redact_strategy string, "
            "confidence_threshold double, audit_enabled boolean, max_pending int",
        ),
        "policy_action": rows(list(policy.entity_actions.items()), "label string, action string"),
        "policy_threshold": rows(
            list(policy.entity_thresholds.items()), "label string, threshold double"
        ),
        "allow_value": rows([(v,) for v in policy.allow_values], "value string"),
        "allow_pattern": rows([(p,) for p in policy.allow_patterns], "pattern string"),
        "allow_label_value": rows(
            [(k, v) for k, vs in policy.allow_entities.items() for v in vs],
            "label string, value string",
        ),
    }
