"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches, fold, labelled, logistic

# Letters of other scripts that look like Latin ones, and the Latin letters they stand for.
HOMOGLYPHS = str.maketrans("аеоросухікмтнвԁɡһјӏѕαεορτυνικχ", "aeopocyxikmthbdghjlsaeoptuvikx")
# Digits and signs written for letters.
DIGITS = str.maketrans("0134578@$!|", "oieastbasil")
#: Phrases in which words of the lexicon are no insult.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "idiot proof", "stupid simple", "pathetic fallacy", "circus clown")

_SIGNS = re.compile(r"(?<=\w)[@$!|](?=\w)")
_MIXED = re.compile(r"\w*\d\w*")
_WORDS = re.compile(r"[^\W_]+")


def folded(text: str) -> list[str]:
    """Lower-case words with homoglyphs as Latin letters; digits and signs are letters in words that hold a letter."""
    text = unicodedata.normalize("NFKC", text).lower().translate(HOMOGLYPHS)
    text = _SIGNS.sub(lambda m: m[0].translate(DIGITS), text)
    text = _MIXED.sub(lambda m: m[0].translate(DIGITS) if re.search(r"[^\W\d_]", m[0]) else m[0], text)
    return _WORDS.findall(text)


def _terms(words: set[str]) -> set[str]:
    """Beginnings of 4 to 8 characters and whole words, each after a space; whole words end with one."""
    return {f" {w[:k]}" for w in words for k in range(4, min(9, len(w) + 1))} | {f" {w} " for w in words}


def _term_counts(columns):
    """In how many texts of either label each term and each pair of neighbours occurs."""
    for batch, texts in batches(columns):
        tally = (Counter(), Counter())
        for y, text in zip(batch.column("y").to_pylist(), texts, strict=True):
            words = folded(text.decode())
            tally[y].update(_terms(set(words)))
        terms = list(tally[0].keys() | tally[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([t[x] for x in terms], pa.int64()) for t in tally)], names=["term", "clean", "toxic"]
        )


class Lexicon:
    """Weights of terms, phrases without weight, and the constants that turn a document's hits into a probability."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.weights, self.exceptions, self.final = weights, exceptions, np.zeros(3)
        self.final[-1] = -np.inf

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def _built(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            automaton.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            phrase = f" {' '.join(folded(phrase))} "
            automaton.add_word(phrase, (len(phrase), 0.0))
        automaton.make_automaton()
        return automaton

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Of each text: log of one plus its weight, and log of one plus its weight per hundred words."""
        if not hasattr(self, "automaton"):
            self.automaton = self._built() if self.weights else None
        out = np.zeros((len(texts), 2))
        if self.automaton is None:
            return out
        for i, text in enumerate(texts):
            words = folded(text.decode())
            line = f" {' '.join(words)} "
            hits: dict[int, float] = {}
            spared: list[tuple[int, int]] = []
            for end, (length, weight) in self.automaton.iter(line):
                begin = end - length + 1
                if weight:
                    hits[begin] = max(weight, hits.get(begin, 0.0))
                else:
                    spared.append((begin, end))
            total = sum(w for at, w in hits.items() if not any(a <= at < b for a, b in spared))
            out[i] = np.log1p(total), np.log1p(100 * total / max(len(words), 1))
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return 1 / (1 + np.exp(-np.clip(features @ self.final[:-1] + self.final[-1], -500, 500)))


def _features(columns, lexicon):
    for batch, texts in batches(columns):
        got = lexicon.value.features(texts)
        yield pa.RecordBatch.from_arrays([batch.column("y"), *(pa.array(got[:, k]) for k in range(2))], names=["y", "a", "b"])


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, out: int = 2, max_train: int = 20_000, most_terms: int = 2000, evidence: float = 28.0) -> Lexicon:
    """A lexicon from at most `max_train` labelled documents; equal texts count once.

    Terms whose log-likelihood ratio towards label 1 is at least `evidence` are sorted by it, and a term that begins
    another chosen one, or is begun by one, is passed over. Its weight is its smoothed log odds.
    """
    spark = docs.sparkSession
    known = labelled(docs, labels, "toxic", folds, out, max_train).select("y", F.coalesce("text", F.lit("")).alias("text"))
    known = known.dropDuplicates(["text", "y"])
    n = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    clean, toxic = float(n.get(0, 0)), float(n.get(1, 0))
    lexicon = Lexicon({})
    if not clean or not toxic:
        return lexicon
    both = F.col("clean") + F.col("toxic")
    rate = toxic / (toxic + clean)

    def part(seen, share):
        return F.when(seen > 0, seen * F.log(seen / (both * share))).otherwise(0.0)

    table = (
        known.mapInArrow(_term_counts, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= 3) & (F.col("toxic") / toxic > 4 * F.col("clean") / clean))
        .withColumn("evidence", 2 * (part(F.col("toxic"), rate) + part(F.col("clean"), 1 - rate)))
        .where(F.col("evidence") >= evidence)
        .orderBy(F.desc("evidence"), F.length("term"), "term")
        .limit(10 * most_terms)
        .collect()
    )
    chosen: dict[str, float] = {}
    starts: set[str] = set()
    for row in table:
        term = row.term
        if len(chosen) >= most_terms or term in starts or any(term[:k] in chosen for k in range(5, len(term))):
            continue
        chosen[term] = float(np.log((row.toxic + 0.5) / (toxic - row.toxic + 0.5)) - np.log((row.clean + 0.5) / (clean - row.clean + 0.5)))
        starts.update(term[:k] for k in range(5, len(term) + 1))
    lexicon = Lexicon({t: w for t, w in chosen.items() if w > 0})
    got = known.mapInArrow(partial(_features, lexicon=spark.sparkContext.broadcast(lexicon)), "y int, a double, b double").toPandas()
    got = got.sort_values(["a", "b", "y"], ignore_index=True)
    lexicon.final = logistic(got[["a", "b"]].to_numpy(), got["y"].to_numpy().astype(float), ridge=0.1)
    return lexicon


def _score(columns, lexicon, name: str):
    for batch, texts in batches(columns, name):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lexicon.value.scores(lexicon.value.features(texts)))], names=[*batch.schema.names, "score"])


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, out: int = 2, max_train: int = 20_000, threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs; the score is the probability of label 1.

    Words are folded (homoglyphs, digits and signs for letters, case, width), the lexicon's terms and the exception
    phrases are found in one pass over the whole text, a place counts with its heaviest term unless an exception covers
    it, and the sum and the sum per word go into a logistic function fitted on the same labelled rows.

    Null or empty text: no hits, the score of a text without any. A null id: scored, not held out. Repeated rows: each scored.
    Labels of one kind or none: every score is 0. No rows: none.
    """
    Work(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    lexicon = train(texts, labels.select("doc_id", "toxic"), folds, out, max_train)
    scored = texts.mapInArrow(partial(_scored, lexicon=docs.sparkSession.sparkContext.broadcast(lexicon)), "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _scored(columns, lexicon):
    for batch, texts in batches(columns):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lexicon.value.scores(lexicon.value.features(texts)))], names=["doc_id", "score"])


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold; scored where the rows lie."""
    Work(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    lexicon = docs.sparkSession.sparkContext.broadcast(train(texts, labels.select("doc_id", "toxic"), **options))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumn("searched", F.coalesce(F.col(names[docs.columns.index(text_col)]).cast("string"), F.lit("")))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True)) + ", searched string, score double"
    kept = plain.mapInArrow(partial(_score, lexicon=lexicon, name="searched"), schema).where(F.col("score") < threshold)
    return kept.select(*names).toDF(*docs.columns)
