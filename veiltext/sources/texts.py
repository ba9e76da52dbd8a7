"""Text records: one row per text with its envelope, from any table or stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import TEXTS

CHANNELS = ("inbound", "tool_result", "outbound", "reply_payload")


def texts_from(
    df: DataFrame,
    text: Column | str,
    record_id: Column | str,
    channel: Column | str,
    session_id: Column | str | None = None,
    seq: Column | str | None = None,
    ts: Column | str | None = None,
    tool_name: Column | str | None = None,
    channel_id: Column | str | None = None,
) -> DataFrame:
    """Text records of a table or stream; records without text are left out.

    Columns are given as names or as Columns; ``channel`` as a Column, or as
    the name of a channel.
    """
    given = {
        "record_id": record_id,
        "channel": F.lit(channel) if isinstance(channel, str) and channel in CHANNELS else channel,
        "session_id": session_id,
        "seq": seq,
        "ts": ts,
        "tool_name": tool_name,
        "channel_id": channel_id,
        "text": text,
    }
    schema = T.StructType.fromDDL(TEXTS)
    cols = []
    for f in schema:
        value = given[f.name]
        if value is None:
            value = F.lit(None)
        elif isinstance(value, str):
            value = F.col(value)
        cols.append(value.cast(f.dataType).alias(f.name))
    return nonempty(df.select(*cols))


def nonempty(texts: DataFrame) -> DataFrame:
    return texts.filter(F.col("text").isNotNull() & (F.col("text") != ""))


def union_texts(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
