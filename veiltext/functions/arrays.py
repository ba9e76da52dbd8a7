"""Small helpers over array columns: name a value once, fold long arrays in linear memory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FOLD_BLOCK = 256
_KNOWN: dict[tuple, Column] = {}


def remembered(key: tuple, build: Callable[[], Column]) -> Column:
    """An expression built once per application.

    A detector is some thousand calls from Python into the JVM; its Column
    names columns and no table, so every DataFrame can use the same one.
    """
    full = (SparkSession.active().sparkContext.applicationId, *key)
    if full not in _KNOWN:
        _KNOWN[full] = build()
    return _KNOWN[full]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def empty_array(ddl: str) -> Column:
    """A typed empty array; ``ddl`` names the element type."""
    return F.array().cast(f"array<{ddl}>")


def emit(items: Column, carry: Column) -> Column:
    """The result of one step of ``fold_emit``."""
    return F.struct(items.alias("items"), carry.alias("carry"))


def fold_emit(
    n: Column,
    item_ddl: str,
    carry: Column,
    step: Callable[[Column, Column], Column],
    last: Callable[[Column], Column] | None = None,
) -> Column:
    """Left fold over ``0 .. n-1`` that emits items and hands a carry on.

    ``step(carry, i)`` returns ``emit(items, carry)``; ``last(carry)`` may add
    a final array of items.  A plain ``aggregate`` copies all emitted items at
    each step; here it copies those of the current block of ``FOLD_BLOCK``
    steps, so that a text with a million spans still folds in seconds.
    """
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / FOLD_BLOCK).cast("int"))

    def inner(outer: Column, block: Column) -> Column:
        lo = block * FOLD_BLOCK
        steps = F.sequence(lo, F.least(lo + FOLD_BLOCK, n) - 1)

        def one(acc: Column, i: Column) -> Column:
            return let(
                step(acc["carry"], i),
                lambda r: F.struct(
                    F.concat(acc["out"], r["items"]).alias("out"), r["carry"].alias("carry")
                ),
            )

        zero = F.struct(empty_array(item_ddl).alias("out"), outer["carry"].alias("carry"))
        return F.aggregate(steps, zero, one)

    def block_step(outer: Column, block: Column) -> Column:
        return let(
            inner(outer, block),
            lambda r: F.struct(
                F.concat(outer["done"], F.array(r["out"])).alias("done"), r["carry"].alias("carry")
            ),
        )

    def finish(outer: Column) -> Column:
        items = F.flatten(outer["done"])
        return F.concat(items, last(outer["carry"])) if last else items

    zero = F.struct(empty_array(f"array<{item_ddl}>").alias("done"), carry.alias("carry"))
    folded = F.aggregate(blocks, zero, block_step, finish)
    return F.when(n > 0, folded).otherwise(empty_array(item_ddl))
