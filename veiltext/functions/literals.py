"""What every match of a pattern must hold: a cheap test before the pattern itself is run."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# An escape that stands for a class, a code point, a reference or a place, not for the character after it.
_ESCAPE = re.compile(
    r"\\(?:[pP]\{[^}]*\}|[pP].|[xN]\{[^}]*\}|x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|0[0-7]{1,3}|c.|k<[^>]*>|[0-9]+|[A-Za-z])",
    re.DOTALL,
)
_REPEATED = re.compile(r"(?:([*+?])|\{([0-9]*),?[0-9]*\})[+?]?")
# Letters beyond ASCII that a search without regard to case takes for an ASCII letter, and that letter.
_LOOKALIKE = ("\u0130\u0131\u017f\u212a", "iisk")


def _after_class(pattern: str, i: int) -> int:
    """The place after the class that begins at i; classes may hold classes."""
    depth = 0
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
        elif pattern[i] == "[":
            depth += 1
            # a bracket that comes first is a plain one only outside Java; there it would be no pattern
        elif pattern[i] == "]":
            depth -= 1
            if not depth:
                return i + 1
        i += 1
    return len(pattern)


def _after_group(pattern: str, i: int) -> int:
    depth = 0
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
        elif pattern[i] == "[":
            i = _after_class(pattern, i) - 1
        elif pattern[i] == "(":
            depth += 1
        elif pattern[i] == ")":
            depth -= 1
            if not depth:
                return i + 1
        i += 1
    return len(pattern)


def required_literal(pattern: str) -> str:
    """The longest run of ASCII characters that each match of a Java pattern holds; empty if none is certain.

    Groups and classes count as unknown, and so does a whole pattern with alternatives, quoted parts or free spacing.
    """
    if "\\Q" in pattern or re.search(r"\(\?[a-zA-Z]*x", pattern):
        return ""
    runs, i = [""], 0
    while i < len(pattern):
        c, unit = pattern[i], ""
        if c == "|":
            return ""
        if c == "\\":
            escape = _ESCAPE.match(pattern, i)
            i, unit = (escape.end(), "") if escape else (i + 2, pattern[i + 1 : i + 2])
        elif c == "[":
            i = _after_class(pattern, i)
        elif c == "(":
            i = _after_group(pattern, i)
        else:
            i, unit = i + 1, "" if c in ".^$" else c
        unit = unit if unit.isascii() else ""
        times = _REPEATED.match(pattern, i)
        if times:
            i = times.end()
            surely = times[1] == "+" or (times[2] or "0").strip("0") != ""
            runs[-1] += unit if surely else ""
        elif unit:
            runs[-1] += unit
            continue
        runs.append("")
    return max(runs, key=len)


def folded(literal: str) -> str:
    """The form in which a literal is looked for in ``folded_text``."""
    return literal.translate({ord(c): chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def folded_text(text: Column) -> Column:
    """A text in which a literal stands wherever a search without regard to case could find it."""
    return F.lower(F.translate(text, *_LOOKALIKE))
