"""Running sums and as-of values over ordered sessions, in two levels.

A window over a whole session sorts that session in one task, however long it
is.  Here the order key is cut into buckets: a window runs inside each bucket,
and what a bucket must know of the earlier ones comes from one row per bucket.
A session with a third of all rows is then spread over as many tasks as it has
buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one session per bucket, at most, when ``seq`` counts its rows.
BUCKET_SPAN = 1 << 20


def bucket_of(seq: Column | str, span: int = BUCKET_SPAN) -> Column:
    col = F.col(seq) if isinstance(seq, str) else seq
    return F.floor(col / F.lit(span))


def running_sum(
    df: DataFrame,
    session: str,
    seq: str,
    values: dict[str, Column],
    span: int = BUCKET_SPAN,
    total: str | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """Add per name the sum of its value over the session's rows up to and with this one.

    ``total`` names a further column, the number of rows of the session;
    ``order`` sorts rows of equal ``seq``.
    """
    base = df.withColumn("_b", bucket_of(seq, span))
    for name, value in values.items():
        base = base.withColumn(f"_v_{name}", value)
    earlier = Window.partitionBy(session).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = base.groupBy(session, "_b").agg(
        F.count("*").alias("_n"), *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values]
    )
    offsets = totals.select(
        session,
        "_b",
        F.sum("_n").over(Window.partitionBy(session)).alias("_total"),
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in values],
    )
    inside = (
        Window.partitionBy(session, "_b")
        .orderBy(seq, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = base.select(
        *df.columns, "_b", *[F.sum(f"_v_{n}").over(inside).alias(f"_i_{n}") for n in values]
    )
    return summed.join(offsets, [session, "_b"]).select(
        *df.columns,
        *[(F.col(f"_i_{n}") + F.col(f"_o_{n}")).alias(n) for n in values],
        *([F.col("_total").alias(total)] if total else []),
    )


def asof_value(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    seq: str,
    value: str,
    order: list[str],
    span: int = BUCKET_SPAN,
) -> DataFrame:
    """Add ``value``: that of the last row of ``right`` with equal keys and a smaller ``seq``.

    ``order`` breaks ties inside ``right``.  Keys may be as hot as they like:
    the buckets of one key are separate groups.
    """
    rank = F.struct(F.col(seq), *[F.col(c) for c in order])
    lefts = left.select(*keys, seq, F.lit(True).alias("_left"), F.struct(*left.columns).alias("_row"))
    rights = right.select(
        *keys, seq, F.lit(False).alias("_left"), F.struct(value).alias("_value"), rank.alias("_rank")
    )
    both = lefts.unionByName(rights, allowMissingColumns=True).withColumn("_b", bucket_of(seq, span))
    inside = (
        Window.partitionBy(*keys, "_b")
        .orderBy(F.col(seq), F.col("_left").desc(), "_rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    near = both.withColumn("_near", F.last("_value", ignorenulls=True).over(inside)).filter("_left")
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    far = (
        both.groupBy(*keys, "_b")
        .agg(F.max_by("_value", "_rank").alias("_last"))
        .withColumn("_far", F.last("_last", ignorenulls=True).over(earlier))
        .select(*keys, "_b", "_far")
    )
    return near.join(far, [*keys, "_b"]).select(
        "_row.*", F.coalesce(F.col("_near"), F.col("_far"))[value].alias(value)
    )
