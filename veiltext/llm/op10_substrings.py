"""Repeated passages across documents: paragraph MinHash, banding, exact Jaccard, removals by components."""

from __future__ import annotations

import random
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veiltext.llm.banding import WORDS, bands_for, meetings, similar, sketches
from veiltext.llm.common import Work, batches, keyed, mixed, replayed, shingle_hashes, word_hashes

SHINGLE, ROWS, RECALL = 5, 2, 0.995
#: A unit ends at a pair of words whose hash is the smallest among so many pairs on either side.
REACH = 4
#: Bits of the bitmap of paragraphs worth verifying (1 MB, whatever the input).
BITMAP_BITS = 1 << 23


def _orders(n: int) -> np.ndarray:
    rng = random.Random(10)
    return np.array([rng.getrandbits(64) for _ in range(n)], dtype=np.uint64)


class Paragraphs:
    """The paragraphs with words of some texts: their documents, places, word counts, content hashes and shingle hashes.

    Each paragraph also falls into units of some nine words that end at places their own words choose, so that a
    passage has the same units wherever it stands, but for the first and the last.
    """

    def __init__(self, texts: list[bytes], units: bool = True):
        words, first, starts, ends = word_hashes(texts)
        whole = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        breaks = np.flatnonzero(whole == 10)
        line = np.searchsorted(breaks, starts)  # of each word
        at = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, np.int64)
        self.n_words = np.diff(np.append(at, len(words)))
        self.doc = np.searchsorted(first, at, side="right") - 1
        lines_before = np.searchsorted(breaks, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]) if texts else np.zeros(0, np.int64)
        self.number = line[at] - lines_before[self.doc] if len(at) else at
        self.start = at - first[self.doc] if len(at) else at
        n_shingles = np.maximum(self.n_words - SHINGLE + 1, 1)
        place = np.arange(len(words)) - np.repeat(at, self.n_words)
        rest = np.repeat(self.n_words, self.n_words) - place
        full = np.zeros(len(words), np.uint64)
        full[: max(len(words) - SHINGLE + 1, 0)] = shingle_hashes(words, SHINGLE)
        short = np.repeat(self.n_words < SHINGLE, self.n_words)
        self.c1, self.c2 = self._contents(words, at, self.n_words)
        if units:
            self._cut(words, first, line, lines_before, at)
        keep = np.where(short, place == 0, rest >= SHINGLE)
        full[at[self.n_words < SHINGLE]] = self.c1[self.n_words < SHINGLE]
        self.shingles = full[keep]
        self.bounds = np.concatenate([[0], np.cumsum(n_shingles)])

    @staticmethod
    def _contents(words: np.ndarray, at: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each run of words that begins at `at`."""
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        powers = np.cumprod(np.full(int(n_words.max()), 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)
        weighed = words * powers[np.arange(len(words)) - np.repeat(at, n_words)]
        return mixed(np.add.reduceat(weighed, at) + n_words.astype(np.uint64)), mixed(np.add.reduceat(mixed(weighed), at))

    def _cut(self, words: np.ndarray, first: np.ndarray, line: np.ndarray, lines_before: np.ndarray, at: np.ndarray) -> None:
        """unit_doc, unit_number (of its paragraph), unit_start, unit_words, unit_c1 of the units."""
        pairs = np.full(len(words) + 2 * REACH, np.iinfo(np.uint64).max, dtype=np.uint64)
        inner = slice(REACH, REACH + len(words))
        if len(words) > 1:
            pairs[REACH + 1 : REACH + len(words)] = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
        own = pairs[inner]
        least = np.ones(len(words), dtype=bool)
        for k in range(1, REACH + 1):
            least &= (own < pairs[REACH - k : REACH - k + len(words)]) & (own <= pairs[REACH + k : REACH + k + len(words)])
        starts = np.union1d(at, np.flatnonzero(least[:-1]) + 1) if len(words) else at
        self.unit_words = np.diff(np.append(starts, len(words)))
        self.unit_doc = np.searchsorted(first, starts, side="right") - 1
        self.unit_start = starts - first[self.unit_doc] if len(starts) else starts
        self.unit_number = line[starts] - lines_before[self.unit_doc] if len(starts) else starts
        self.unit_c1 = self._contents(words, starts, self.unit_words)[0]

    def bands(self, count: int) -> np.ndarray:
        """A hash for each paragraph and band of ROWS minima."""
        out = np.zeros((len(self.c1), count), np.uint64)
        if len(self.c1):
            for i, order in enumerate(_orders(count * ROWS)):
                least = np.minimum.reduceat(mixed(self.shingles ^ order), self.bounds[:-1])
                out[:, i // ROWS] = mixed(out[:, i // ROWS] * np.uint64(3) + least + np.uint64(i))
        return out


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _paragraphs(columns, bands: int, min_words: int):
    for batch, texts in batches(columns, most=2 << 20):
        got = Paragraphs(texts)
        long = got.n_words >= min_words
        doc = pa.array(got.doc[long])
        flat = _signed(got.bands(bands)[long].ravel())
        ends = pa.array(np.arange(0, (int(long.sum()) + 1) * bands, bands, dtype=np.int32))
        unit = pa.array(got.unit_doc)
        names = ["row_key", "doc_id", "paragraph", "start_word", "n_words", "c1", "c2", "bands"]
        for columns_ in (
            [doc, got.number[long], got.start[long], got.n_words[long], got.c1[long], _signed(got.c2[long]), pa.ListArray.from_arrays(ends, flat)],
            [unit, got.unit_number, got.unit_start, got.unit_words, got.unit_c1, pa.nulls(len(unit), pa.int64()), pa.nulls(len(unit), pa.list_(pa.int64()))],
        ):
            of, number, start, n_words, c1, *rest = columns_
            places = [pa.array(x.astype(t)) for x, t in ((number, np.int32), (start, np.int64), (n_words, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("row_key").take(of), batch.column("doc_id").take(of), *places, _signed(c1), *rest], names=names)


def _sets(columns, bitmap, min_words: int):
    """c1, c2, the different shingle hashes and their sketch, of the paragraphs whose c1 is in the bitmap."""
    bits = bitmap.value
    for batch, texts in batches(columns, most=2 << 20):
        got = Paragraphs(texts, units=False)
        at = got.c1 & np.uint64(BITMAP_BITS - 1)
        hit = np.flatnonzero((got.n_words >= min_words) & (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0))
        sets = [np.unique(got.shingles[got.bounds[i] : got.bounds[i + 1]]).view(np.int64) for i in hit.tolist()]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        words = pa.array(np.arange(0, (len(sets) + 1) * WORDS, WORDS, dtype=np.int32))
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.ListArray.from_arrays(words, pa.array(sketches(sets).ravel()))]
        yield pa.RecordBatch.from_arrays([_signed(got.c1[hit]), _signed(got.c2[hit]), *lists], names=["c1", "c2", "set", "sketch"])


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """Bits of the low digits of c1, gathered as at most BITMAP_BITS / 32 rows of one number."""
    low = F.col("c1").bitwiseAND(F.lit(BITMAP_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(F.lit(31)).cast("int"))
    rows = wanted.groupBy(F.shiftright(low, 5).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    words = np.zeros(BITMAP_BITS // 32, dtype="<u4")
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return words.view(np.uint8)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, min_words: int = 20) -> DataFrame:
    """The passages to remove: doc_id, paragraph (from 0), start_word, n_words, keep_doc_id, keep_paragraph.

    A passage is a paragraph (text between line ends) of at least `min_words` words, lower-cased (A-Z). Paragraphs are linked
    if their words are equal or the Jaccard similarity of their sets of 5-word shingles is at least `similarity`; bands of
    MinHash minima are tuned to meet such pairs with probability RECALL or more. Of each component the paragraph stays
    that comes first by document id, row and place; all others are returned with it. Paragraphs repeated inside one
    document count as well. A passage inside a paragraph, or over several short ones, is found by its units: runs of units
    that stand elsewhere before, of at least `min_words` words in all, are returned with the place of their first unit.

    Null or empty text, or one without such paragraphs: nothing. A null id comes after all others. Repeated rows: the later
    one's paragraphs are all returned. No rows: none.
    """
    spark = docs.sparkSession
    work = Work(spark)
    texts = keyed(replayed(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), work))
    count = bands_for(similarity, ROWS, RECALL)
    schema = "row_key long, doc_id long, paragraph int, start_word long, n_words long, c1 long, c2 long"
    both = work.save(texts.mapInArrow(partial(_paragraphs, bands=count, min_words=min_words), schema + ", bands array<long>"))
    table, units = both.where("bands is not null"), both.where("bands is null").drop("c2", "bands")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "paragraph")
    whole = table.groupBy("c1", "c2").agg(F.min(place).alias("place"), F.count("*").alias("n"), F.first("bands").alias("bands"))
    contents = work.save(whole.withColumn("node", F.monotonically_increasing_id()))
    met = meetings(contents.select("node", "bands"), work)
    wanted = work.save(contents.select("node", "c1", "c2").join(met.select("node").distinct(), "node"))
    bits = spark.sparkContext.broadcast(_bitmap(wanted))
    found = texts.mapInArrow(partial(_sets, bitmap=bits, min_words=min_words), "c1 long, c2 long, set array<long>, sketch array<long>")
    sets = work.save(found.join(wanted, ["c1", "c2"]).dropDuplicates(["node"]).select("node", "set", "sketch"))
    labels = similar(met, sets, work, similarity)
    work.drop(sets, wanted, met)
    named = contents.join(labels, "node", "left").where("n > 1 or label is not null").select("c1", "c2", "place", F.coalesce("label", "node").alias("label"))
    keep = named.groupBy("label").agg(F.min("place").alias("keep"))
    groups = work.save(named.join(keep, "label").select("c1", "c2", "keep"))
    work.drop(contents)
    met = table.drop("bands").join(groups, ["c1", "c2"])
    removed = met.where((F.col("row_key") != F.col("keep.row_key")) | (F.col("paragraph") != F.col("keep.paragraph")))
    removed = work.save(removed.select("row_key", "doc_id", "paragraph", "start_word", "n_words", "keep"))
    inside = _runs(units, removed, min_words)
    return removed.select("doc_id", "paragraph", "start_word", "n_words", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.paragraph").alias("keep_paragraph")).union(inside)


def _runs(units: DataFrame, removed: DataFrame, min_words: int) -> DataFrame:
    """Runs of at least `min_words` words of units that stand elsewhere before, outside the paragraphs that go anyway."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "start_word", "paragraph")
    first = units.groupBy("c1", "n_words").agg(F.min(place).alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = units.join(first, ["c1", "n_words"]).where((F.col("row_key") != F.col("keep.row_key")) | (F.col("start_word") != F.col("keep.start_word")))
    again = again.join(removed.select("row_key", "paragraph").distinct(), ["row_key", "paragraph"], "left_anti")
    order = Window.partitionBy("row_key").orderBy("start_word")
    begins = F.coalesce(F.lag(F.col("start_word") + F.col("n_words")).over(order) != F.col("start_word"), F.lit(True))
    numbered = again.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(order))
    at = F.struct("start_word", "paragraph", "doc_id", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.paragraph").alias("keep_paragraph"))
    runs = numbered.groupBy("row_key", "run").agg(F.min(at).alias("at"), F.sum("n_words").alias("n_words")).where(F.col("n_words") >= min_words)
    return runs.select("at.doc_id", "at.paragraph", "at.start_word", "n_words", "at.keep_doc_id", "at.keep_paragraph")
