"""The restricted placeholder -> original map: written per record, read per session."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import BUCKET_SPAN, asof_value, running_sum
from .sessions import null_safe
from .shared import written

# --- fixed value: placeholders a session keeps
MAX_MAPPINGS = 10_000
# ---

WRITES = "session_id string, seq bigint, ord int, placeholder string, original string"


def mapping_rows(redacted: DataFrame) -> DataFrame:
    """One row per placeholder of each redacted record, in the order they were made."""
    return redacted.select(
        "record_id", "session_id", "seq", F.posexplode("mapping").alias("ord", "m")
    ).select(
        "record_id",
        "session_id",
        "seq",
        "ord",
        F.col("m.placeholder").alias("placeholder"),
        F.col("m.original").alias("original"),
    )


@null_safe
def merge_mapping(writes: DataFrame) -> DataFrame:
    """The session's map: the last original of each placeholder, at the place of its first write."""
    at = F.struct("seq", "ord")
    return (
        writes.groupBy("session_id", "placeholder")
        .agg(
            F.max_by("original", at).alias("original"),
            F.min(at).alias("_first"),
            F.max("seq").alias("last_seq"),
        )
        .select(
            "session_id",
            "placeholder",
            "original",
            F.col("_first.seq").alias("first_seq"),
            F.col("_first.ord").alias("first_ord"),
            "last_seq",
        )
    )


def _crowded(merged: DataFrame, cap: int) -> DataFrame:
    """Sessions that ever held more placeholders than the cap."""
    return (
        merged.groupBy("session_id").agg(F.count("*").alias("_n")).filter(F.col("_n") > cap)
    ).select("session_id")


def _queue(merged: DataFrame, cap: int, span: int) -> tuple[DataFrame, DataFrame] | None:
    """The eviction queue of crowded sessions, and the sessions in which a placeholder returns to it.

    Suppose that no evicted placeholder is ever written again.  Then each one
    enters the queue at its first write, and the one of rank r leaves with the
    record in which that of rank r + cap enters.  If all last writes come no
    later than that, the supposition holds and the queue is exact; else the
    session is one of those returned second.
    """
    crowded = written(_crowded(merged, cap), "crowded")
    if crowded.isEmpty():
        return None
    ranked = running_sum(
        merged.join(crowded, "session_id", "left_semi").drop("original"),
        "session_id",
        "first_seq",
        {"rank": F.lit(1)},
        span,
        total="total",
        order=("first_ord",),
    )
    successors = ranked.select(
        "session_id", (F.col("rank") - cap).alias("rank"), F.col("first_seq").alias("evicted_at")
    )
    queue = written(ranked.join(successors, ["session_id", "rank"], "left"), "queue")
    returning = queue.filter(F.col("last_seq") > F.col("evicted_at")).select("session_id").distinct()
    return queue, written(returning, "returning")


class FifoMap:
    """A session's map under its cap: all writes of one record, then the oldest go."""

    def __init__(self, cap: int):
        self.cap = cap
        self.kept: dict[str, tuple] = {}

    def write(self, placeholder: str, value: tuple) -> None:
        old = self.kept.get(placeholder)
        self.kept[placeholder] = value if old is None else (value[0], *old[1:3], *value[3:])

    def settle(self) -> None:
        while len(self.kept) > self.cap:
            del self.kept[next(iter(self.kept))]


def _in_session_order(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("session_id").sortWithinPartitions("session_id", *order)


@null_safe
def evict_fifo(
    writes: DataFrame, cap: int = MAX_MAPPINGS, span: int = BUCKET_SPAN
) -> DataFrame:
    """``merge_mapping`` where each session keeps the ``cap`` placeholders that came last.

    A session with no more than ``cap`` placeholders evicts nothing.  In one
    with more, the last ``cap`` to be first written stay, unless an evicted
    placeholder came back: only then does the outcome depend on the order of
    all writes, and the session runs through an ordered pass that holds ``cap``
    entries and no more.
    """
    merged = merge_mapping.keyed(writes)
    found = _queue(merged, cap, span)
    if found is None:
        return merged
    queue, returning = found
    out = queue.filter(F.col("rank") <= F.col("total") - cap)
    gone = out.select("session_id", "placeholder")
    plain = merged.join(gone, ["session_id", "placeholder"], "left_anti")
    if returning.isEmpty():
        return plain
    plain = plain.join(returning, "session_id", "left_anti")
    ordered = _in_session_order(
        writes.join(returning, "session_id", "left_semi").select(
            "session_id", "seq", "ord", "placeholder", "original"
        ),
        "seq",
        "ord",
    )

    def fold(batches: Iterator) -> Iterator:
        import pandas as pd

        session, seq, state = None, None, FifoMap(cap)

        def flush():
            state.settle()
            return pd.DataFrame(
                [(session, p, *v) for p, v in state.kept.items()],
                columns=[
                    "session_id",
                    "placeholder",
                    "original",
                    "first_seq",
                    "first_ord",
                    "last_seq",
                ],
            )

        for pdf in batches:
            for s, q, o, p, v in pdf.itertuples(index=False, name=None):
                if s != session:
                    if session is not None:
                        yield flush()
                    session, seq, state = s, q, FifoMap(cap)
                elif q != seq:
                    state.settle()
                    seq = q
                state.write(p, (v, q, o, q))
        if session is not None:
            yield flush()

    return plain.unionByName(ordered.mapInPandas(fold, merged.schema))


@null_safe
def snapshot_originals(
    requests: DataFrame,
    writes: DataFrame,
    cap: int = MAX_MAPPINGS,
    span: int = BUCKET_SPAN,
) -> DataFrame:
    """Add ``original_text``: what the session's map held for the placeholder at ``seq``; null if nothing.

    As in ``evict_fifo`` only sessions in which a placeholder returned take the
    ordered pass.  Rows are told apart by ``_row``, so that any number may share a ``seq``.
    """
    if "_row" not in requests.columns:
        numbered = written(requests.withColumn("_row", F.monotonically_increasing_id()), "asked")
        return snapshot_originals(numbered, writes, cap, span).drop("_row")
    keys = ["session_id", "placeholder"]
    named = writes.select(*keys, "seq", "ord", F.col("original").alias("original_text"))
    asof = lambda r, w: asof_value(r, w, keys, "seq", "original_text", ["ord"], span)
    found = _queue(merge_mapping.keyed(writes), cap, span)
    if found is None:
        return asof(requests, named)
    queue, returning = found

    def until_evicted(df: DataFrame) -> DataFrame:
        ends = queue.filter("evicted_at is not null").select(*keys, "evicted_at")
        held = F.coalesce(F.col("seq") <= F.col("evicted_at"), F.lit(True))
        return (
            df.join(ends, keys, "left")
            .withColumn("original_text", F.when(held, F.col("original_text")))
            .select(*df.columns)
        )

    if returning.isEmpty():
        return until_evicted(asof(requests, named))
    calm = lambda df: df.join(returning, "session_id", "left_anti")
    plain = until_evicted(asof(calm(requests), calm(named)))
    hot = requests.join(returning, "session_id", "left_semi")
    rows = (
        writes.join(returning, "session_id", "left_semi")
        .select("session_id", "seq", "ord", "placeholder", "original", F.lit(0).cast("long").alias("_row"))
        .unionByName(
            hot.select(
                "session_id",
                "seq",
                "_row",
                F.lit(-1).alias("ord"),
                "placeholder",
                F.lit(None).cast("string").alias("original"),
            )
        )
    )

    def fold(batches: Iterator) -> Iterator:
        import pandas as pd

        session, seq, state = None, None, FifoMap(cap)
        for pdf in batches:
            out = []
            for s, q, o, p, v, row in pdf.itertuples(index=False, name=None):
                if s != session:
                    session, seq, state = s, q, FifoMap(cap)
                elif q != seq:
                    state.settle()
                    seq = q
                if o < 0:
                    held = state.kept.get(p)
                    out.append((row, held[0] if held else None))
                else:
                    state.write(p, (v,))
            yield pd.DataFrame(out, columns=["_row", "original_text"])

    looked_up = _in_session_order(rows, "seq", "ord").mapInPandas(
        fold, "_row bigint, original_text string"
    )
    return plain.unionByName(hot.join(looked_up, "_row").select(*plain.columns))


@null_safe
def lookup_original(keys: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``original`` to ``(session_id, placeholder)`` rows; null where the map has none."""
    return keys.join(
        mapping.select("session_id", "placeholder", "original"),
        ["session_id", "placeholder"],
        "left",
    )


@null_safe
def clear_sessions(mapping: DataFrame, sessions: DataFrame) -> DataFrame:
    """The map without the given sessions."""
    return mapping.join(sessions.select("session_id").distinct(), "session_id", "left_anti")


def mapping_size(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("session_id").agg(F.count("*").alias("size"))
