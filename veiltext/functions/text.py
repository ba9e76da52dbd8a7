"""String helpers shared by labels, allowlists and redaction."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let
from .patterns import SPACE

SLICE_BLOCK = 4096


def strip(value: Column) -> Column:
    """Remove all leading and trailing white space (Spark's ``trim`` removes blanks only)."""
    return F.regexp_replace(value, rf"\A[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+\z", "")


def fold_case(value: Column) -> Column:
    """The form in which allowlist values and span texts are compared."""
    return F.lower(strip(value))


_PYTHON_SPACE = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), SPACE)


def strip_value(value: str) -> str:
    """``strip`` of a literal."""
    return re.sub(rf"\A[{_PYTHON_SPACE}]+|[{_PYTHON_SPACE}]+\Z", "", value)


def fold_value(value: str) -> str:
    """``fold_case`` of a literal: the same white space goes, then lower case."""
    return strip_value(value).lower()


def compiles(pattern: Column) -> Column:
    """Whether the JVM, where patterns run, takes a pattern."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern).isNotNull()


def blocks_of(text: Column) -> Column:
    """The text cut into blocks of ``SLICE_BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{SLICE_BLOCK}}}"), F.lit(0))


def slice_blocks(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``[start, end)`` of a text held as ``blocks_of(text)``.

    ``substring`` walks a UTF-8 string from its first byte; over blocks the
    cost of a slice does not grow with its distance from the start.
    """
    first = F.floor(start / SLICE_BLOCK).cast("int")
    final = F.floor((end - 1) / SLICE_BLOCK).cast("int")
    head = F.get(blocks, first).substr(start % SLICE_BLOCK + 1, end - start)
    rest = F.concat(
        F.array_join(F.slice(blocks, first + 2, F.greatest(final - first - 1, F.lit(0))), ""),
        F.get(blocks, final).substr(F.lit(1), (end - 1) % SLICE_BLOCK + 1),
    )
    whole = F.when(final > first, F.concat(head, rest)).otherwise(head)
    return F.when(end > start, whole).otherwise(F.lit(""))


def with_blocks(text: Column, body) -> Column:
    """``body(blocks)`` with the text cut into blocks once."""
    return let(blocks_of(text), body)
