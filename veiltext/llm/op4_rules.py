"""Quality rules: counts of each text, a fixed base rule, and an isolation forest over the counts."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_chars", "n_lines", "n_upper", "n_digits", "n_stops", "n_distinct"]
_SYMBOLS, _UPPER, _DIGITS, _STOPS = (bytes(set(range(256)) - set(keep)) for keep in (b"#*$%&|<>", range(65, 91), range(48, 58), b".!?,;:"))


def counts(text: bytes) -> tuple[int, ...]:
    """COUNTS and MORE of one text."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if n > 3 and len(number) < n:
        size = np.int64(len(number))
        if size < 2_000_000:  # three numbers fit in 63 bits
            key = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
        else:
            _, pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
            key = pair[:-1] * size + ids[2:]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        within = np.zeros(n, dtype=bool)
        for k in range(3):
            within[k : k + len(key)] |= twice
        repeated = int(within.sum())
    return (
        n,
        len(joined.decode()),
        len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(text),
        len(lines),
        *(len(text.translate(None, drop)) for drop in (_UPPER, _DIGITS, _STOPS)),
        len(number),
    )


def _counted(columns):
    for batch, texts in batches(columns):
        rows = list(zip(*map(counts, texts), strict=True))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in rows)], names=["doc_id", *COUNTS, *MORE])


def rule_statistics(c: np.ndarray) -> np.ndarray:
    """Ratios of the counts (columns: COUNTS, MORE), on which anomalies are judged; small texts lean to the middle."""
    words, chars, symbols, dup, repeat, size, lines, upper, digits, stops, distinct = c.T.astype(float)
    return np.column_stack(
        [
            np.sqrt(symbols / (chars + 20)),
            np.sqrt((upper + 0.4) / (chars + 20)),
            np.sqrt(digits / (chars + 20)),
            repeat / (words + 10),
            dup / (lines + 3),
            (stops + 1.5) / (words + 10),
            (chars + 110) / (words + 20),
        ]
    )


def informative(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How well each statistic alone tells labels apart (rank statistic, to the fourth power), as shares; equal ones without labels."""
    n, m = int(good.sum()), int((~good).sum())
    if not n or not m:
        return np.full(x.shape[1], 1 / x.shape[1])
    out = []
    for column in x.T:
        _, at, count = np.unique(column, return_inverse=True, return_counts=True)
        rank = (np.cumsum(count) - (count - 1) / 2)[at]
        out.append(abs(2 * (rank[good].sum() - n * (n + 1) / 2) / (n * m) - 1) ** 4 + 1e-6)
    return np.array(out) / sum(out)


class Forest:
    """Isolation trees of random splits, stored as arrays: a leaf holds the path length to expect there.

    A tree splits the box that holds `within`, by a statistic drawn with the given shares at a place drawn evenly from the
    node's box, whether or not rows lie on both sides: where the sample has no rows a path ends at once.
    """

    def __init__(self, x: np.ndarray, within: np.ndarray, shares: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.sample = min(sample, max(2, len(x)))
        self.depth = int(np.ceil(np.log2(self.sample))) + 2
        nodes = 2 << self.depth
        self.feature = np.full((trees, nodes), -1, np.int8)
        self.split = np.zeros((trees, nodes))
        self.path = np.zeros((trees, nodes))
        self.shares = shares
        for tree in range(trees if len(x) else 0):
            drawn = x[rng.choice(len(x), self.sample, replace=len(x) < self.sample)]
            self._grow(tree, 1, drawn, within.min(axis=0), within.max(axis=0), 0, rng)

    @staticmethod
    def expected(n: float) -> float:
        """Mean path of an unsuccessful search among n."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    def _grow(self, tree: int, node: int, x: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, rng: np.random.Generator) -> None:
        shares = np.where(high > low, self.shares, 0)
        if depth >= self.depth or len(x) < 2 or not shares.sum():
            self.path[tree, node] = depth + self.expected(len(x))
            return
        f = int(rng.choice(len(shares), p=shares / shares.sum()))
        at = rng.uniform(low[f], high[f])
        self.feature[tree, node], self.split[tree, node] = f, at
        left, middle = x[:, f] < at, np.arange(len(low)) == f
        self._grow(tree, 2 * node, x[left], low, np.where(middle, at, high), depth + 1, rng)
        self._grow(tree, 2 * node + 1, x[~left], np.where(middle, at, low), high, depth + 1, rng)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 odd, lower the more ordinary."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for tree in range(len(self.feature)):
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                f = self.feature[tree, node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] >= self.split[tree, node]
                node = np.where(inner, 2 * node + right, node)
            total += self.path[tree, node]
        return 2 ** (-total / len(self.feature) / max(self.expected(self.sample), 1e-9))


def calibrate(scores: np.ndarray, good: np.ndarray, most_lost: float = 0.01) -> float:
    """The score above which documents go: of the thresholds that lose at most `most_lost` of the good ones, the one
    with the best sum of good kept and bad dropped. Without labels of both kinds nothing goes."""
    if not good.any() or good.all():
        return float("inf")
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    kept_good = np.cumsum(g) / g.sum()
    dropped_bad = 1 - np.cumsum(~g) / (~g).sum()
    ends = np.append(s[1:] > s[:-1], True)
    gain = np.where(ends & (kept_good >= 1 - most_lost), kept_good + dropped_bad, -1)
    at = int(gain.argmax())
    return float(s[at]) if at + 1 == len(s) else float((s[at] + s[at + 1]) / 2)


def _judge(columns, forest, threshold: float):
    for batch in columns:
        x = np.column_stack([batch.column(c).to_numpy() for c in [*COUNTS, *MORE]]) if len(batch) else np.zeros((0, 11))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(c) for c in COUNTS), pa.array(forest.value.scores(rule_statistics(x)))], names=["doc_id", *COUNTS, "anomaly"])


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = 100, sample: int = 20_000, max_labels: int = 20_000, most_lost: float = 0.01
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, anomaly of every row.

    Counts are taken over every whole text. At most `max_labels` labelled documents and `sample` others that pass the
    base rule (those of the smallest id hashes) set up the forest: its boxes hold all of them, its trees are grown on the
    labelled good ones (without any, on the others), a statistic is drawn the more often the better it tells labels apart,
    and the threshold loses at most `most_lost` of the good ones. kept: the base rule passed and the score is not above it.

    Null or empty text: no words, hence base_failed. Null ids and repeated rows: judged like any other. No labels or labels of
    one kind: the forest drops nothing. No rows: none.
    """
    spark = docs.sparkSession
    work = Work(spark)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    table = work.save(texts.mapInArrow(_counted, "doc_id long, " + ", ".join(f"{c} long" for c in [*COUNTS, *MORE])))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    drawn = table.where(~failed).orderBy(F.xxhash64("doc_id"), *COUNTS).limit(sample).toPandas()
    picked = (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    )
    marked = table.where(~failed).join(F.broadcast(picked), "doc_id").select(*COUNTS, *MORE, "y").orderBy(*COUNTS, *MORE, "y").toPandas()
    x, known = (rule_statistics(rows[[*COUNTS, *MORE]].to_numpy(dtype=np.float64)) for rows in (drawn, marked))
    good = marked["y"].to_numpy() == 1
    forest = Forest(known[good] if good.any() else x, np.vstack([x, known]), informative(known, good), trees)
    threshold = calibrate(forest.scores(known), good, most_lost)
    judged = table.mapInArrow(
        partial(_judge, forest=spark.sparkContext.broadcast(forest), threshold=threshold), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", anomaly double"
    )
    return judged.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("anomaly") <= F.lit(threshold))).alias("kept"), "anomaly")
