"""Near-duplicate documents by SimHash fingerprints that meet at anchors of a covering code."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches, keyed, replayed
from veiltext.llm.components import components

SHINGLE = 3


def fingerprint(text: bytes) -> int:
    """Bits set in over half of the XXH64 hashes (seed 42) of the lower-cased text's 3-word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(x) for x in zip(*(words[k:] for k in range(SHINGLE)), strict=False)]
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(shingles), 65536):
        hashes = np.array([digest(s, 42) for s in shingles[at : at + 65536]], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles), bitorder="little").tobytes(), "little")


def _fingerprints(columns):
    for batch, texts in batches(columns):
        values = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(values)], names=["row_key", "doc_id", "fp"])


def _syndrome(half: Column) -> Column:
    """Which bit (1 to 31; 0: none) of a 32-bit value differs from the code word next to it.

    The code is the Hamming code of length 31, whose words cover all values within distance 1, times the free last bit.
    """
    syndrome = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        syndrome = syndrome + F.shiftleft(F.bit_count(half.bitwiseAND(F.lit(mask))) % 2, k)
    return syndrome.cast("int")


def _flip(value: Column, bit: Column) -> Column:
    """value with bit 1 to 31 (or none, for 0) turned over."""
    return value.bitwiseXOR(F.when(bit > 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit - 1)).otherwise(F.lit(0).cast("long")))


def halves(fps: DataFrame) -> DataFrame:
    """fp, side, half and its syndrome, for both halves of each fingerprint."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")),
        F.struct(F.lit(1).alias("side"), F.shiftrightunsigned("fp", 32).alias("half")),
    )
    out = fps.select("fp", F.explode(sides).alias("s")).select("fp", "s.side", "s.half")
    return out.withColumn("syndrome", _syndrome(F.col("half")))


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs a < b of different fingerprints (column fp) that differ in at most `radius` (up to 3) bits.

    One half of such a pair differs in at most one bit. Anchors are the words of a code that covers the halves within
    distance 1. Each fingerprint goes to its home, the anchor next to its half, and copies go to every anchor within
    covering radius plus threshold, 2: the home of either is then an anchor of the other, so one direction finds all pairs.
    """
    if not 0 <= radius <= 3:
        raise ValueError("radius: 0 to 3")
    both = halves(fps)
    own, s = _flip(F.col("half"), F.col("syndrome")), F.col("syndrome")
    home = both.select(F.col("fp").alias("a"), "side", own.alias("anchor"))
    pairs = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (i < i.bitwiseXOR(s)) & (s > 0))
    near = F.transform(pairs, lambda i: _flip(_flip(F.col("half"), i), i.bitwiseXOR(s)))
    copies = both.select(F.col("fp").alias("b"), "side", F.explode(F.concat(F.array(own, own.bitwiseXOR(F.lit(1 << 31))), near)).alias("anchor"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    met = home.join(copies, (home.side == copies.side) & (home.anchor == copies.anchor) & close)
    return met.select("a", "b").distinct()


def clusters(docs: DataFrame, work: Work, radius: int = 3) -> DataFrame:
    """row_key, doc_id, fp, component_id of keyed documents."""
    table = work.save(docs.select("row_key", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "row_key long, doc_id long, fp long"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    groups = work.save(table.groupBy("fp").agg(F.min(place).alias("place")))
    labels = components(links(groups.select("fp"), radius), work)
    named = groups.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    firsts = named.groupBy("label").agg(F.min("place").alias("first"))
    found = work.save(named.join(firsts, "label").select("fp", F.col("first.doc_id").alias("component_id"), F.col("first.row_key").alias("keep_row")))
    return table.join(found, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of docs.

    Fingerprints at most `radius` bits apart are linked; component_id is the smallest id reachable, itself included.
    Equal fingerprints are one node, so copies cost one row each. Only fingerprints and ids move, no text.

    Null or empty text, or one without words: fingerprint zero, linked like any other. A null id: a row of its own, ignored by
    the minimum; a component without any id has a null component_id. Repeated rows: all returned. No rows: none.
    """
    work = Work(docs.sparkSession)
    found = clusters(keyed(docs, id_col, text_col), work, radius)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """The rows of docs, with all their columns, that have the smallest id of their component (the first row of equal ids;
    a row without an id only where its component has none)."""
    work = Work(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    source = replayed(docs.toDF(*names), work)
    id_name, text_name = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    found = clusters(keyed(source, id_name, text_name), work, radius)
    keep = work.save(found.where("row_key = keep_row").select("row_key"))
    kept = source.withColumn("row_key", F.monotonically_increasing_id()).join(keep, "row_key", "left_semi")
    return kept.select(*names).toDF(*docs.columns)
