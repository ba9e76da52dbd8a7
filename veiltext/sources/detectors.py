"""Detectors of the user's, read from a table of rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.detect import Detector
from ..functions.labels import canonical
from ..functions.text import fold_value
from .policies import MAX_PATTERN_CHARS, NESTED_QUANTIFIER, PolicyError, compiles_on_jvm

#: Each rule is a search of every text that holds its literal, and a part of the expression.
MAX_DETECTORS = 200
# Alternatives under an unbounded repeat: Java goes one call deeper with each round, so that a long text ends the task.
_DEEP = r"\((?:[^()\\]|\\.)*(?<!\\)\|(?:[^()\\]|\\.)*\)(?:[*+]|\{[0-9]*,\})"


# In which a rule that can match no character at all does so.
_PROBES = ("", "aZ09 _-.\n\u00e9\U0001f600 x")


def _matches_nothing(pattern: str) -> bool:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return False
    compiled = spark.sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
    for probe in _PROBES:
        matcher = compiled.matcher(probe)
        while matcher.find():
            if matcher.start() == matcher.end():
                return True
    return False


def _fault(label: str | None, pattern: str | None) -> str | None:
    if not label or not fold_value(label):
        return "no label"
    if not pattern:
        return "no pattern"
    if len(pattern) > MAX_PATTERN_CHARS:
        return "pattern too long"
    if re.search(NESTED_QUANTIFIER, pattern):
        return "nested quantifier"
    if re.search(_DEEP, pattern):
        return "repeated alternatives"
    if not compiles_on_jvm(pattern):
        return "no pattern that the JVM takes"
    return "matches no character" if _matches_nothing(pattern) else None


def load_detectors(rules: DataFrame) -> tuple[Detector, ...]:
    """The rules of ``rules(label, pattern)`` and, if their order matters, ``rank``; each once.

    Without ranks, or with equal ones, rules are in the order of label and pattern.  They go into a policy
    (``replace(policy, detectors=...)``), under which every job finds their spans next to the structured ones.  A
    row that is no rule is refused, as a policy would be.
    """
    rank = F.col("rank").cast("bigint") if "rank" in rules.columns else F.lit(0).cast("bigint")
    rows = rules.select(rank.alias("rank"), "label", "pattern").distinct().orderBy("rank", "label", "pattern").limit(MAX_DETECTORS + 1).collect()
    if len(rows) > MAX_DETECTORS:
        raise PolicyError(f"more than {MAX_DETECTORS} detectors")
    faults = [(r.label, r.pattern, fault) for r in rows if (fault := _fault(r.label, r.pattern))]
    if faults:
        raise PolicyError("; ".join(f"{label!r}, {pattern!r}: {fault}" for label, pattern, fault in faults))
    return tuple(dict.fromkeys(Detector(canonical(r.label), r.pattern) for r in rows))
