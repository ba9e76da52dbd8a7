"""Replacement of spans by placeholders, and the placeholder -> original mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import empty_array, let
from .overlap import has_overlap
from .schema import MAPPING
from .text import slice_blocks, with_blocks

# --- fixed values
STRATEGIES = ("token", "mask", "hash")
HASH_CHARS = 12
# ---


def mask_of(value: Column) -> Column:
    return F.repeat(F.lit("*"), F.greatest(F.length(value), F.lit(1)))


def hash_of(label: Column, value: Column) -> Column:
    digest = F.substring(F.sha2(value.cast("binary"), 256), 1, HASH_CHARS)
    return F.concat(F.lit("["), label, F.lit("_"), digest, F.lit("]"))


def token_of(label: Column, number: Column) -> Column:
    return F.concat(F.lit("["), label, F.lit("_"), number.cast("string"), F.lit("]"))


def token_numbers(entities: Column) -> Column:
    """Per span its number among the spans of its label, counted from the end of the text.

    The spans are sorted by label and falling start; a span's number is then
    its distance from the first one of its label.
    """
    ordered = F.array_sort(
        F.transform(
            entities,
            lambda e, i: F.struct(
                e["label"].alias("label"), (-e["start_pos"]).alias("s"), i.alias("i")
            ),
        )
    )

    def number(rows: Column) -> Column:
        labels = F.transform(rows, lambda r: r["label"])
        firsts = let(
            labels,
            lambda ls: let(
                F.array_distinct(ls),
                lambda ds: F.map_from_arrays(
                    ds, F.transform(ds, lambda d: F.array_position(ls, d).cast("int"))
                ),
            ),
        )
        numbered = let(
            firsts,
            lambda f: F.transform(
                rows,
                lambda r, j: F.struct(r["i"].alias("i"), (j + 2 - f[r["label"]]).alias("n")),
            ),
        )
        return F.transform(F.array_sort(numbered), lambda x: x["n"])

    return let(ordered, number)


def _replacements(entities: Column, strategy: Column | str) -> Column:
    """Per span, in input order: start, input index, end, original and replacement."""

    def rows(replace) -> Column:
        return F.transform(
            entities,
            lambda e, i: F.struct(
                e["start_pos"].alias("start_pos"),
                i.alias("i"),
                e["end_pos"].alias("end_pos"),
                e["text"].alias("original"),
                replace(e, i).alias("placeholder"),
            ),
        )

    forms = {
        "token": lambda: let(
            token_numbers(entities),
            lambda ns: rows(lambda e, i: token_of(e["label"], F.get(ns, i))),
        ),
        "mask": lambda: rows(lambda e, i: mask_of(e["text"])),
        "hash": lambda: rows(lambda e, i: hash_of(e["label"], e["text"])),
    }
    if isinstance(strategy, str):
        return forms[strategy]()
    return (
        F.when(strategy == "mask", forms["mask"]())
        .when(strategy == "hash", forms["hash"]())
        .otherwise(forms["token"]())
    )


def _join_gaps(text: Column, spans: Column) -> Column:
    """The text with disjoint spans, sorted by start, replaced: one pass over it."""

    def build(blocks: Column) -> Column:
        pieces = F.transform(
            spans,
            lambda s, i: F.concat(
                slice_blocks(
                    blocks,
                    F.when(i > 0, F.get(spans, i - 1)["end_pos"]).otherwise(F.lit(0)),
                    s["start_pos"],
                ),
                s["placeholder"],
            ),
        )
        tail = slice_blocks(blocks, F.element_at(spans, -1)["end_pos"], F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    return with_blocks(text, build)


def _splice(text: Column, spans: Column) -> Column:
    """Replace overlapping spans right to left, each at its original offsets."""
    back = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct((-s["start_pos"]).alias("k"), s["i"].alias("i"), s.alias("s")),
        )
    )
    return F.aggregate(
        back,
        text,
        lambda acc, b: F.concat(
            acc.substr(F.lit(1), b["s"]["start_pos"]),
            b["s"]["placeholder"],
            acc.substr(b["s"]["end_pos"] + 1, F.length(acc)),
        ),
    )


def _mapping(spans: Column) -> Column:
    """Placeholder -> original by falling start.

    A placeholder that recurs (equal masks, equal hashes) keeps its first place
    and its last value.
    """
    by_key = F.array_sort(
        F.transform(
            F.array_sort(
                F.transform(
                    spans,
                    lambda s: F.struct((-s["start_pos"]).alias("k"), s["i"].alias("i"), s.alias("s")),
                )
            ),
            lambda b, o: F.struct(
                b["s"]["placeholder"].alias("placeholder"),
                o.alias("o"),
                b["s"]["original"].alias("original"),
            ),
        )
    )

    def collapse(rows: Column) -> Column:
        differs = lambda i, j: F.coalesce(
            F.get(rows, i)["placeholder"] != F.get(rows, j)["placeholder"], F.lit(True)
        )
        firsts = F.filter(rows, lambda r, i: (i == 0) | differs(i, i - 1))
        lasts = F.filter(rows, lambda r, i: differs(i, i + 1))
        pairs = F.zip_with(
            firsts,
            lasts,
            lambda a, b: F.struct(
                a["o"].alias("o"), a["placeholder"].alias("placeholder"), b["original"].alias("original")
            ),
        )
        return F.transform(
            F.array_sort(pairs),
            lambda p: F.struct(p["placeholder"].alias("placeholder"), p["original"].alias("original")),
        )

    return let(by_key, collapse).cast(MAPPING)


def redact(
    text: Column | str,
    entities: Column | str,
    strategy: Column | str = "token",
) -> Column:
    """``struct(redacted_text, mapping)`` for one text and its spans.

    ``strategy`` is the name of one, or a column of names.
    """
    t = F.col(text) if isinstance(text, str) else text
    es = F.col(entities) if isinstance(entities, str) else entities

    def apply(spans: Column) -> Column:
        ordered = F.array_sort(spans)
        joined = let(
            ordered,
            lambda o: F.when((F.size(o) > 1) & has_overlap(o), _splice(t, o)).otherwise(
                _join_gaps(t, o)
            ),
        )
        return F.struct(joined.alias("redacted_text"), _mapping(spans).alias("mapping"))

    unchanged = F.struct(t.alias("redacted_text"), empty_array("struct<placeholder:string,original:string>").alias("mapping"))
    return F.when(F.size(es) > 0, let(_replacements(es, strategy), apply)).otherwise(unchanged)


def placeholders(mapping: Column | str) -> Column:
    """The placeholders of a record, without the values behind them."""
    col = F.col(mapping) if isinstance(mapping, str) else mapping
    return F.array_distinct(F.transform(col, lambda m: m["placeholder"]))
