"""Small tables for the corpus operators: invented prose, and one with every awkward row."""

from __future__ import annotations

import random

CLASHING = ["row_key", "node", "label", "score", "keep", "band", "lines", "line_no", "held_out", "n_dropped", "fp", "text_", "y", "block", "searched", "c0"]


def prose(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    """Words with a line end every twelve or so."""
    out = []
    for _ in range(words):
        n = rng.randrange(vocabulary)
        out.append("".join("bcdfglmnprstvz"[n // 7**k % 14] + "aeiou"[n // 5**k % 5] for k in range(3)) + str(n % 3 or ""))
        out.append("\n" if rng.random() < 0.08 else " ")
    return "".join(out).strip()


def corpus(seed: int, n: int = 60) -> list[tuple[int, str]]:
    """Texts of 1 to 200 words with exact copies, near copies and shared lines."""
    rng = random.Random(seed)
    shared = [prose(rng, 30).replace("\n", " ") for _ in range(4)]
    texts: list[str] = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.4:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        else:
            text = prose(rng, rng.randrange(1, 200))
            texts.append(text + "\n" + rng.choice(shared) if kind > 0.8 else text)
    return list(enumerate(texts))


def awkward(spark):
    """Null ids and texts, empty and blank texts, a very long one, repeated rows, ties, and columns with clashing names."""
    rng = random.Random(3)
    long = prose(rng, 40_000)
    plain = prose(rng, 80)
    rows = [(1, plain), (1, plain), (2, plain), (None, plain), (3, None), (None, None), (4, ""), (5, " \n\t \n"), (6, "one"), (7, "Ünïcode tëxt ß \U0001f600"), (8, long), (9, "a" * 50_000)]
    rows.append((10, None))
    data = [(*r, *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(data, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def labels(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")
