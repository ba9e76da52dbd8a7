"""Detectors: a text column in, an array of spans with exact code-point offsets out.

All detectors are built-in Spark expressions.  A detector costs nothing on a
text that lacks the characters it needs, and the offsets come from the lengths
of the matches and of the gaps between them, so no text is searched twice
unless it holds a match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .arrays import emit, empty_array, fold_emit, let
from .literals import folded, folded_text, required_literal
from .schema import ENTITIES, SOURCE_STRUCTURED

# Field order is sort order: start, end, then rank of the detector.
_RAW = "struct<start_pos:int,end_pos:int,rank:int,text:string>"


# A text cut at the matches of one rule: gap, match, gap, match, ..., gap.
_CUTS = "struct<rank:int,pieces:array<string>>"
# Set around each match to cut there; no character, and texts that hold it all
# the same take another way.
_MARK = chr(0xFFFF)


@dataclass(frozen=True)
class Detector:
    """A rule of the user's: each match of a Java pattern is a span of the label."""

    label: str
    pattern: str


def _raw(start: Column, end: Column, rank: Column, text: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start_pos"),
        end.cast("int").alias("end_pos"),
        rank.alias("rank"),
        text.alias("text"),
    )


def _rank(label: str) -> Column:
    return F.lit(P.LABELS.index(label))


def _cut(text: Column, pattern: str, rank: Column) -> Column:
    """The text cut at all matches of one rule, in a single search."""

    def pieces(marked: Column) -> Column:
        cut = F.when(marked.contains(_MARK), F.split(marked, _MARK, -1))
        return F.struct(rank.alias("rank"), cut.alias("pieces"))

    return let(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), pieces)


def _cut_marked(text: Column, pattern: str, rank: Column) -> Column:
    """``_cut`` for a text that holds the mark itself: matches and gaps from a search each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.flatten(F.zip_with(gaps, found, lambda g, f: F.array(g, f)))
    return F.struct(rank.alias("rank"), pieces.alias("pieces"))


def _cuts(need: Column, text: Column, labels: list[str]) -> Column:
    return (
        F.when(~need, empty_array(_CUTS))
        .when(text.contains(_MARK), F.array(*[_cut_marked(text, P.RULES[x], _rank(x)) for x in labels]))
        .otherwise(F.array(*[_cut(text, P.RULES[x], _rank(x)) for x in labels]))
    )


def _custom_cuts(text: Column, detectors: Sequence[Detector]) -> Column:
    """The text cut at the matches of each of the user's rules, null where a text lacks what a rule's matches must hold."""
    literals = [required_literal(d.pattern) for d in detectors]
    caseless = ["(?" in d.pattern for d in detectors]  # a flag may be set; without any a literal stands as it is

    def over(lower: Column) -> Column:
        def cuts(cut) -> Column:
            parts = []
            for k, (d, literal, fold) in enumerate(zip(detectors, literals, caseless, strict=True)):
                one = cut(text, d.pattern, F.lit(len(P.LABELS) + k))
                need = lower.contains(folded(literal)) if fold else text.contains(literal)
                parts.append(F.when(need, one) if literal else one)
            return F.array(*parts)

        return F.when(text.contains(_MARK), cuts(_cut_marked)).otherwise(cuts(_cut))

    folds = any(fold and literal for fold, literal in zip(caseless, literals, strict=True))
    return let(folded_text(text) if folds else F.lit(""), over)


def _scan_custom(text: Column, detectors: Sequence[Detector]) -> Column:
    """Spans of the user's rules; matches of no character are none."""
    if not detectors:
        return empty_array(_RAW)
    found = _scan_rules(_custom_cuts(text, detectors))
    return F.filter(found, lambda r: r["end_pos"] > r["start_pos"])


def _place(cut: Column) -> Column:
    """Spans of one rule's matches: each starts where the pieces before it end."""
    pieces = cut["pieces"]

    def step(pos: Column, i: Column) -> Column:
        value = F.get(pieces, i * 2 + 1)
        start = pos + F.length(F.get(pieces, i * 2))
        end = start + F.length(value)
        return emit(F.array(_raw(start, end, cut["rank"], value)), end)

    # k matches make 2k + 1 pieces, or 2k + 2 with a null after the last gap.
    n = F.floor((F.size(pieces) - 1) / 2).cast("int")
    start, value = F.length(F.get(pieces, F.lit(0))), F.get(pieces, F.lit(1))
    single = F.array(_raw(start, start + F.length(value), cut["rank"], value))
    return F.when(n == 1, single).otherwise(fold_emit(n, _RAW, F.lit(0), step))


def _scan_rules(cuts: Column) -> Column:
    """Spans of several rules from the texts cut at their matches."""
    return F.flatten(F.transform(F.filter(cuts, lambda c: F.size(c["pieces"]) > 2), _place))


def _scan_email(text: Column) -> Column:
    """Addresses, found outward from each ``@``.

    To the right the domain is an anchored match; to the left the local part is
    the run of local characters that ends at the ``@``, read on the reversed
    piece so that it too is anchored.  Each piece between two ``@`` is read
    once per side: linear, where a search from every possible first character
    is quadratic on long runs such as base64 or ruled lines.
    """

    def over(pieces: Column) -> Column:
        def step(carry: Column, i: Column) -> Column:
            left = F.get(pieces, i)
            at = carry["pos"] + F.length(left)
            local = F.reverse(F.regexp_extract(F.reverse(left), rf"\A[{P.EMAIL_LOCAL}]*", 0))

            def start_in(run: Column) -> Column:
                run_start = at - F.length(run)
                begin = F.greatest(run_start, carry["taken"])
                # The character before the first one that a match may take.
                before = (
                    F.when(begin > run_start, run.substr(begin - run_start, F.lit(1)))
                    .when((run_start == carry["pos"]) & (i > 0), F.lit("@"))
                    .otherwise(F.lit(" "))
                )
                window = F.concat(before, run.substr(begin - run_start + 1, F.length(run)))
                hit = F.regexp_instr(window, F.lit(rf"(?!\A){P.EMAIL_LOCAL_START}"))
                return F.when(hit > 0, begin + hit - 2)

            def settle(start: Column, domain: Column) -> Column:
                end = at + 1 + F.length(domain)
                address = F.concat(
                    left.substr(start - carry["pos"] + 1, F.length(left)), F.lit("@"), domain
                )
                found = F.when(
                    start.isNotNull(), F.array(_raw(start, end, _rank("EMAIL"), address))
                ).otherwise(empty_array(_RAW))
                taken = F.when(start.isNotNull(), end).otherwise(carry["taken"])
                return emit(
                    found,
                    F.struct(
                        (at + 1).cast("int").alias("pos"), taken.cast("int").alias("taken")
                    ),
                )

            return let(
                F.regexp_extract(F.get(pieces, i + 1), P.EMAIL_DOMAIN, 0),
                lambda domain: let(
                    F.when(domain != "", let(local, start_in)),
                    lambda start: settle(start, domain),
                ),
            )

        carry = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("taken"))
        return fold_emit(F.size(pieces) - 1, _RAW, carry, step)

    return let(F.split(text, "@", -1), over)


# What a text must hold for a label to be possible in it.
def _has_at(text: Column) -> Column:
    return text.contains("@")


def _has_separator(text: Column) -> Column:
    return text.contains(":") | text.contains("=")


def _has_digit(text: Column) -> Column:
    return text.rlike("[0-9]")


_KEYED = ["SECRET", "TOKEN"]
_NUMERIC = ["PHONE", "SSN", "CREDIT_CARD", "IP_ADDRESS", "DATE", "ZIP_CODE"]


def _emails(text: Column) -> Column:
    return F.when(_has_at(text), _scan_email(text)).otherwise(empty_array(_RAW))


def _entities(raw: Column, detectors: Sequence[Detector] = ()) -> Column:
    labels = F.array(*[F.lit(x) for x in (*P.LABELS, *(d.label for d in detectors))])
    return F.transform(
        raw,
        lambda r: F.struct(
            r["text"].alias("text"),
            F.get(labels, r["rank"]).alias("label"),
            r["start_pos"].alias("start_pos"),
            r["end_pos"].alias("end_pos"),
            F.lit(1.0).alias("confidence"),
            F.lit(SOURCE_STRUCTURED).alias("source"),
        ),
    ).cast(ENTITIES)


def detect(text: Column | str, label: str) -> Column:
    """Spans of one structured label, in text order."""
    col = F.col(text) if isinstance(text, str) else text
    if label == "EMAIL":
        return _entities(_emails(col))
    need = _has_separator(col) if label in _KEYED else _has_digit(col)
    return _entities(_scan_rules(_cuts(need, col, [label])))


def detect_structured(text: Column | str, detectors: Sequence[Detector] = ()) -> Column:
    """Spans of all nine structured labels, and of the user's rules, in one pass over the text.

    They come by start, end, then detector order, in which the user's follow the nine; overlaps stay.
    """
    col = F.col(text) if isinstance(text, str) else text
    cuts = F.concat(
        _cuts(_has_separator(col), col, _KEYED), _cuts(_has_digit(col), col, _NUMERIC)
    )
    found = [_emails(col), _scan_rules(cuts)]
    if detectors:
        found.append(_scan_custom(col, detectors))
    return _entities(F.array_sort(F.concat(*found)), detectors)


def detect_custom(text: Column | str, detectors: Sequence[Detector]) -> Column:
    """Spans of the user's rules alone, by start, end, then the rules' order."""
    col = F.col(text) if isinstance(text, str) else text
    return _entities(F.array_sort(_scan_custom(col, detectors)), detectors)


def detect_email(text):
    return detect(text, "EMAIL")


def detect_phone(text):
    return detect(text, "PHONE")


def detect_ssn(text):
    return detect(text, "SSN")


def detect_credit_card(text):
    return detect(text, "CREDIT_CARD")


def detect_secret(text):
    return detect(text, "SECRET")


def detect_token(text):
    return detect(text, "TOKEN")


def detect_ip_address(text):
    return detect(text, "IP_ADDRESS")


def detect_date(text):
    return detect(text, "DATE")


def detect_zip_code(text):
    return detect(text, "ZIP_CODE")
