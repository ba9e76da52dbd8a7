"""Records without a session or without a place in it, as one session and one place of their own.

Equality joins drop rows whose key is null. Jobs over sessions therefore work on keys that are
never null, and give the nulls back at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A name that no session has, and a place before all others.
NO_SESSION = "\u0000none"
NO_SEQ = -(1 << 62)


def keyed(df: DataFrame) -> DataFrame:
    if "session_id" in df.columns:
        df = df.withColumn("session_id", F.coalesce("session_id", F.lit(NO_SESSION)))
    if "seq" in df.columns:
        df = df.withColumn("seq", F.coalesce("seq", F.lit(NO_SEQ)))
    return df


def unkeyed(df: DataFrame) -> DataFrame:
    if "session_id" in df.columns:
        df = df.withColumn("session_id", F.nullif("session_id", F.lit(NO_SESSION)))
    for name in ("seq", "first_seq", "last_seq"):
        if name in df.columns:
            df = df.withColumn(name, F.nullif(name, F.lit(NO_SEQ)))
    return df


def null_safe(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A job over sessions in which null is a session and a place like any other."""

    @wraps(job)
    def run(*args, **options) -> DataFrame:
        safe = [keyed(x) if isinstance(x, DataFrame) else x for x in args]
        named = {k: keyed(x) if isinstance(x, DataFrame) else x for k, x in options.items()}
        return unkeyed(job(*safe, **named))

    run.keyed = job  # for other jobs, whose sessions and places are keyed already
    return run
