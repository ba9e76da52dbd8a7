"""Canonical labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let
from .text import strip

# --- fixed values: labels that stand for another one
CANONICAL = {
    "DOB": "DATE",
    "ZIP": "ZIP_CODE",
    "PER": "PERSON",
    "ORG": "ORGANIZATION",
    "GPE": "LOCATION",
    "LOC": "LOCATION",
    "FAC": "ADDRESS",
    "PHONE_NUMBER": "PHONE",
    "SOCIAL_SECURITY_NUMBER": "SSN",
    "CREDIT_CARD_NUMBER": "CREDIT_CARD",
    "DATE_OF_BIRTH": "DATE",
}
# --- fixed values: labels every NER model is asked for
NER_LABELS = (
    "person",
    "organization",
    "location",
    "address",
    "date of birth",
    "medical record number",
    "account number",
    "passport number",
)
# ---


def canonical_label(label: Column | str) -> Column:
    col = F.col(label) if isinstance(label, str) else label
    names = F.create_map(*[F.lit(x) for pair in CANONICAL.items() for x in pair])
    return let(F.upper(strip(col)), lambda k: F.coalesce(names[k], k))


def canonical(label: str) -> str:
    """``canonical_label`` for a literal, as policies are read on the driver."""
    blanks = "\t\n\x0b\f\r       　﻿" + "".join(
        map(chr, range(0x2000, 0x200B))
    )
    key = label.upper().strip(blanks)
    return CANONICAL.get(key, key)


def ner_labels(custom: Column | None = None, extra: Column | None = None) -> Column:
    """The labels to ask a model for: defaults, then custom, then call-time, each once."""
    parts = [F.array(*[F.lit(x) for x in NER_LABELS])]
    parts += [F.coalesce(x, F.array().cast("array<string>")) for x in (custom, extra) if x is not None]
    return F.array_distinct(F.concat(*parts))
