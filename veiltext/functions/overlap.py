"""Overlap resolution over one record's spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import emit, empty_array, fold_emit, let
from .schema import ENTITY


def resolve_overlaps(entities: Column | str) -> Column:
    """Keep one of each pair of overlapping neighbours: the surer, else the earlier one.

    Each decision depends on the span that survived so far, so this is a fold
    over the spans by start, then falling confidence, then input order; a
    window over neighbours gives wrong results on chains.  Spans of which no
    two neighbours clash, the usual case, are only put in order.
    """
    col = F.col(entities) if isinstance(entities, str) else entities

    def resolve(es: Column) -> Column:
        ordered = F.array_sort(
            F.transform(
                es,
                lambda e, i: F.struct(
                    e["start_pos"].alias("s"), (-e["confidence"]).alias("c"), i.alias("i"), e.alias("e")
                ),
            )
        )
        none = empty_array(ENTITY)

        def walk(keyed: Column) -> Column:
            def step(last: Column, i: Column) -> Column:
                cur = F.get(keyed, i)["e"]
                clash = cur["start_pos"] < last["end_pos"]
                wins = cur["confidence"] > last["confidence"]
                out = F.when(last.isNull() | clash, none).otherwise(F.array(last))
                keep = F.when(clash & ~wins, last).otherwise(cur)
                return emit(out, keep)

            return fold_emit(
                F.size(keyed),
                ENTITY,
                F.lit(None).cast(ENTITY),
                step,
                last=lambda c: F.when(c.isNull(), none).otherwise(F.array(c)),
            )

        def settle(keyed: Column) -> Column:
            clash = F.exists(
                F.sequence(F.lit(1), F.size(keyed) - 1),
                lambda i: F.get(keyed, i)["s"] < F.get(keyed, i - 1)["e"]["end_pos"],
            )
            return F.when(clash, walk(keyed)).otherwise(F.transform(keyed, lambda k: k["e"]))

        return F.when(F.size(es) < 2, es).otherwise(let(ordered, settle))

    return let(col, resolve)


def has_overlap(spans: Column) -> Column:
    """Whether spans sorted by start touch the same place (two at one start count)."""
    return F.exists(
        F.sequence(F.lit(1), F.size(spans) - 1),
        lambda i: (F.get(spans, i)["start_pos"] < F.get(spans, i - 1)["end_pos"])
        | (F.get(spans, i)["start_pos"] == F.get(spans, i - 1)["start_pos"]),
    )
