"""Lines (6), SimHash (7), passages (10) and components against brute force."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, awkward, corpus, prose, table
from veiltext.llm.banding import CROWD, WORDS, May, _close, _near, bands_for, meetings, similar, sketches
from veiltext.llm.common import Work, keyed
from veiltext.llm.components import components
from veiltext.llm.op6_lines import EQUAL, MARKS, PASSES, RECALL, ROWS, _alike, _counted, _equal_marks, _signed, band_keys, jaccard, line_dedup, marks_of, minima, shingles
from veiltext.llm.op7_simhash import drop_near_duplicates, links, near_duplicates
from veiltext.llm.op10_substrings import Paragraphs, repeated_passages
from veiltext.llm.queries import QUERIES


class Sets:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(100)] + [(7, 7), (None, 3)]
    want = Sets()
    for a, b in edges:
        if a is not None and a != b:
            want.join(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), Work(spark)).collect()}
    assert got == {x: want.root(x) for x in want.up}
    assert components(spark.createDataFrame([], "a long, b long"), Work(spark)).collect() == []


def shingle_words(text, n=3):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])


def plain_fingerprint(text):
    shingles = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingle_words(text)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in shingles) > len(shingles))


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(8):
            values.add(x ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6))))
    values = sorted(signed(v) for v in values)
    got = {(r.a, r.b) for r in links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()}
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want and len(want) > 100


def test_near_duplicates(spark):
    rows = corpus(7, 150)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(table(spark, rows)).collect()}
    prints = {d: plain_fingerprint(t) for d, t in rows}
    sets = Sets()
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                sets.join(a, b)
    assert got == {d: (f"{p:016x}", sets.root(d)) for d, p in prints.items()}
    assert len({c for _, c in got.values()}) < 140


def test_near_duplicates_awkward(spark):
    docs = awkward(spark)
    got = near_duplicates(docs).collect()
    assert len(got) == 13
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5, 10)} == {3}
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert {r.component_id for r in got if r.doc_id is None} == {1, 3}
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8, 9]
    assert near_duplicates(table(spark, [])).collect() == []
    only_null = near_duplicates(spark.createDataFrame([(None, "a b c d")], "doc_id long, text string")).collect()
    assert only_null[0].component_id is None


def normal(line):
    return line.strip(" \t\r").lower()


def line_shingles(line):
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def plain_line_dedup(rows, similarity=0.8):
    places = {}
    for d, t in rows:
        for i, line in enumerate(t.split("\n")):
            if normal(line):
                places.setdefault(normal(line), []).append((d, i))
    sets, shingles = Sets(), {x: line_shingles(x) for x in places}
    keys = sorted(places, key=lambda x: min(places[x]))
    at = {x: n for n, x in enumerate(keys)}
    for a in keys:
        sets.root(at[a])
        for b in keys:
            if at[a] < at[b] and len(shingles[a] & shingles[b]) >= similarity * len(shingles[a] | shingles[b]):
                sets.join(at[a], at[b])
    keep = {}
    for x in keys:
        root = sets.root(at[x])
        keep[root] = min(keep.get(root, min(places[x])), min(places[x]))
    stay = set(keep.values())
    return {d: "\n".join(line for i, line in enumerate(t.split("\n")) if not normal(line) or (d, i) in stay) for d, t in rows}


@pytest.mark.parametrize("seed", [8, 9])
def test_line_dedup(spark, seed):
    rows = corpus(seed, 60)
    rows[3] = (3, "Line  one\n\n  \nLINE  one\t\nother\r\n" + rows[4][1])
    got = {r.doc_id: r for r in line_dedup(table(spark, rows)).collect()}
    want = plain_line_dedup(rows)
    assert {d: r.text for d, r in got.items()} == want
    for d, t in rows:
        assert got[d].n_lines == sum(bool(normal(x)) for x in t.split("\n"))
        assert got[d].n_lines - got[d].n_dropped == sum(bool(normal(x)) for x in want[d].split("\n"))


def test_line_dedup_hot_group_and_chain(spark):
    rng = random.Random(10)
    base = prose(rng, 60).replace("\n", " ").split(" ")
    lines = []
    for i in range(200):  # each differs from the first in one word, so they are linked through it
        words = list(base)
        words[i % 60] = f"word{i}"
        lines.append(" ".join(words))
    chain = list(base)
    for i in range(60):  # each is like the one before, the ends are not
        chain[i] = f"step{i}"
        lines.append(" ".join(chain))
    rows = list(enumerate(lines))
    got = {r.doc_id: r.text for r in line_dedup(table(spark, rows)).collect()}
    assert got == plain_line_dedup(rows)


def test_line_dedup_awkward(spark):
    docs = awkward(spark)
    out = line_dedup(docs)
    assert out.columns == [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    got = out.collect()
    assert len(got) == 13
    first, second = [r for r in got if r.doc_id == 1]
    assert {first.n_dropped == 0, second.n_dropped == 0} == {True, False}
    assert "" in (first.text, second.text)
    assert all(r.text is None and r.n_lines == 0 for r in got if r.doc_id in (3, 10))
    assert next(r.text for r in got if r.doc_id == 5) == " \n\t \n"
    assert next(r.text for r in got if r.doc_id is None and r.text is not None) == ""
    assert line_dedup(table(spark, [])).collect() == []
    assert [c for c in CLASHING if c not in out.columns] == []


def test_bands_for():
    assert bands_for(0.8, 2, 0.995) == 6 and 1 - (1 - 0.8**2) ** 6 >= 0.995 > 1 - (1 - 0.8**2) ** 5


def plain_passages(rows, similarity=0.8, min_words=20):
    found = []
    for d, t in rows:
        for i, line in enumerate(t.split("\n")):
            words = shingle_words(line, 1)
            if len(words) >= min_words:
                found.append(((d, i), " ".join(words), set(shingle_words(line, 5))))
    sets = Sets()
    for n, (_, text, own) in enumerate(found):
        sets.root(n)
        for m in range(n):
            if text == found[m][1] or len(own & found[m][2]) >= similarity * len(own | found[m][2]):
                sets.join(m, n)
    return {(*place, *found[sets.root(n)][0]) for n, (place, _, _) in enumerate(found) if sets.root(n) != n}


@pytest.mark.parametrize("seed", [11, 12])
def test_repeated_passages(spark, seed):
    rows = corpus(seed, 80)
    got = repeated_passages(table(spark, rows)).collect()
    want, texts = plain_passages(rows), dict(rows)
    found = set()
    for r in got:
        words = shingle_words(texts[r.doc_id], 1)[r.start_word : r.start_word + r.n_words]
        if (r.doc_id, r.paragraph, r.keep_doc_id, r.keep_paragraph) in want and words == shingle_words(texts[r.doc_id].split("\n")[r.paragraph], 1):
            found.add((r.doc_id, r.paragraph, r.keep_doc_id, r.keep_paragraph))
        else:  # a run of units: each of its words stands elsewhere among five equal ones
            assert len(words) == r.n_words >= 20
            elsewhere = {x for d, t in rows if d != r.doc_id for x in shingle_words(t, 5)} | {x for x in shingle_words(texts[r.doc_id], 5)}
            assert set(shingle_words(" ".join(words), 5)) & elsewhere
    assert found == want


def test_passages_inside_paragraphs(spark):
    rng = random.Random(40)
    texts = [prose(rng, 150).replace("\n", " ") for _ in range(40)]
    passages = [prose(rng, 55).replace("\n", " ") for _ in range(5)]
    for i in range(20):
        words = texts[i].split(" ")
        at = rng.randrange(len(words))
        texts[i] = " ".join([*words[:at], *passages[i % 5].upper().split(" "), *words[at:]])
    got = repeated_passages(table(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id for r in got} == set(range(5, 20))
    assert {r.doc_id: r.keep_doc_id for r in got} == {i: i % 5 for i in range(5, 20)}
    assert all(20 <= r.n_words <= 55 for r in got)


def test_repeated_passages_awkward(spark):
    got = repeated_passages(awkward(spark), min_words=5).collect()
    assert {r.keep_doc_id for r in got if r.doc_id in (1, 2, None)} == {1}
    assert {r.doc_id for r in got} <= {1, 2, None, 8}
    assert repeated_passages(table(spark, [])).collect() == []


def test_overlapping_shingles_link_lines_with_a_changed_character(spark, tmp_path):
    rng = random.Random(60)
    lines = []
    for _ in range(150):
        line = list(prose(rng, 14).replace("\n", " "))
        line[len(line) // 2] = "#"
        lines += ["".join(line), "".join(line).replace("#", "1")]
    lines += ["\U0001f600b", "\U0001f600b", "ab", "abcde", "a" * 3000]
    rows = [(d, line) for d, line in enumerate(lines)]
    table(spark, rows).repartition(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text for r in QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()}
    assert all(got[d] == "" for d in range(1, 300, 2)) and all(got[d] == lines[d] for d in range(0, 300, 2))
    assert [got[d] for d in range(300, 305)] == ["\U0001f600b", "", "ab", "abcde", "a" * 3000]


def test_line_bands_meet_at_the_least_similarity():
    """Pairs of Jaccard 0.8 in the runs that the query compares: of n runs all but the last n/9 are shared."""
    rng, each, bands = random.Random(50), 4000, bands_for(0.8, ROWS, RECALL)
    for n in (9, 18, 27, 54, 135):
        sides = [], []
        for _ in range(each):
            shared, a, b = (f"{rng.getrandbits(4 * k):0{k}x}" for k in (n + 4 - n // 9, n // 9, n // 9))
            sides[0].append((shared + a).encode())
            sides[1].append((shared + b).encode())
        dense = [minima(*shingles(x), bands * ROWS) for x in sides]
        keys = [band_keys(d) for d in dense]
        alike = ((dense[0] ^ dense[1])[:, :MARKS] & np.uint64(15) == 0).sum(axis=1) >= EQUAL
        assert keys[0].shape == (each, bands) and ((keys[0] == keys[1]).any(axis=1) & alike).mean() >= RECALL - 0.002, n


def test_marks_count_equal_minima(spark):
    rng = np.random.default_rng(12)
    a = rng.integers(0, 1 << 32, size=(200, 70), dtype=np.uint64)
    b = np.where(rng.random(a.shape) < 0.5, a, rng.integers(0, 1 << 32, size=a.shape, dtype=np.uint64))
    rows = [tuple(r) for r in np.concatenate([marks_of(a), marks_of(b)], axis=1).tolist()]
    df = spark.createDataFrame(rows, ", ".join(f"c{k} long" for k in range(8)))
    got = [r.n for r in df.select(_equal_marks([F.col(f"c{k}") for k in range(4)], [F.col(f"c{k}") for k in range(4, 8)]).alias("n")).collect()]
    assert sorted(got) == sorted(((a ^ b)[:, :MARKS] & np.uint64(15) == 0).sum(axis=1).tolist())


def test_shingles_and_minima_against_a_walk():
    rng = random.Random(7)
    lines = ["".join(rng.choice("abcé\U0001f600") for _ in range(n)) for n in (1, 4, 5, 6, 0, 64, 1000, 2)]
    hashes, count = shingles([x.encode() for x in lines])
    runs = [[x[i : i + 5] for i in range(max(1, len(x) - 4))] if x else [] for x in lines]
    assert count.tolist() == [len(r) for r in runs] and len(hashes) == count.sum()
    named = dict(zip((r for own in runs for r in own), hashes.tolist(), strict=True))
    assert len(set(named.values())) == len(named) and [named[r] for own in runs for r in own] == hashes.tolist()
    got = minima(hashes, count, 24)
    for row, own in zip(got.tolist(), runs, strict=True):
        least = {}
        for h in (named[r] for r in own):
            k = (h >> 40) * 24 >> 24
            least[k] = min(h & 0xFFFFFFFF, least.get(k, 1 << 32))
        assert not own or row == [next(least[(k + j) % 24] for j in range(24) if (k + j) % 24 in least) for k in range(24)]
    assert shingles([])[1].tolist() == []


def test_jaccard_of_pairs():
    rng = random.Random(13)
    pairs = [["".join(rng.choice("ab ") for _ in range(rng.randrange(1, 30))) for _ in range(2)] for _ in range(300)]
    pairs += [["same", "same"], ["abc", "abd"], ["x" * 5000, "x" * 7], ["é" * 9, "é" * 8 + "x"]]
    got = jaccard(*([x.encode() for x in side] for side in zip(*pairs, strict=True)))
    for (a, b), j in zip(pairs, got, strict=True):
        own, other = line_shingles(a), line_shingles(b)
        assert j == pytest.approx(len(own & other) / len(own | other))


@pytest.mark.parametrize("n", [18, 27])
def test_passage_bands_meet_at_the_least_similarity(n):
    pairs = 8000
    x = np.random.default_rng(n).integers(0, 1 << 64, size=(pairs, n + n // 9), dtype=np.uint64)
    got = Paragraphs([])
    got.shingles = np.concatenate([x[:, :n].ravel(), x[:, n // 9 :].ravel()])
    got.c1, got.bounds = np.zeros(2 * pairs, np.uint64), np.arange(2 * pairs + 1) * n
    bands = got.bands(bands_for(0.8, 2, 0.995))
    assert (bands[:pairs] == bands[pairs:]).any(axis=1).mean() >= 0.996


def test_marks_keep_short_pairs_of_the_least_similarity(spark):
    """By the query's own test: of pairs of similarity 0.8 with 5 to 40 shingles at most 0.5% are lost; with one number for all 10% were."""
    rng, ranges, each = random.Random(51), bands_for(0.8, ROWS, RECALL) * ROWS, 2000
    words = [f"w{k}" for k in range(MARKS // 16)]
    for n in (5, 9, 18, 36, 40, 130):
        lines = [f"{rng.getrandbits(4 * (n + 4)):0{n + 4}x}" for _ in range(each)]
        sides = [[x.encode() for x in lines], [x[: len(x) - n // 5].encode() for x in lines]]
        rows = []
        for side in sides:
            hashes, count = shingles(side)
            rows.append(np.concatenate([marks_of(minima(hashes, count, ranges)), count[:, None]], axis=1))
        columns = [f"{c}_{x}" for x in "ab" for c in [*words, "size"]]
        df = spark.createDataFrame([tuple(r) for r in np.concatenate(rows, axis=1).tolist()], ", ".join(f"{c} long" for c in columns))
        kept = df.where(_alike(words)(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"))).count()
        assert kept >= 0.995 * each, n


def test_pairs_that_only_meet_are_no_rows(spark):
    """Nodes of one band whose marks differ: the last comparison makes rows of pairs with marks alike alone."""
    work, seen = Work(spark), []
    met = spark.range(40).select(F.lit(7).cast("long").alias("band"), F.col("id").alias("node"), F.lit(0).cast("long").alias("head"))
    sets = spark.range(40).select(F.col("id").alias("node"), (F.col("id") / 2).cast("long").alias("set"))
    may = May(sets.withColumnRenamed("set", "mark"), lambda a, b: a("mark") == b("mark"))

    def close(rows, a, b):
        seen.append(rows)
        return rows.where(F.col(a) == F.col(b))

    labels = similar(met, sets, work, 0.8, close=close, may=may)
    assert sorted((r.node, r.label) for r in labels.collect()) == sorted((k, k - k % 2) for k in range(40))
    joins = [x for x in seen[-1]._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x and "band" in x]
    assert len(joins) == 1 and "mark" in joins[0] and seen[-1].count() <= 20


def test_meetings_in_passes(spark):
    rng, work = random.Random(14), Work(spark)
    rows = [(n, [8 * rng.randrange(20) + k for k in range(5)]) for n in range(60)] + [(60, []), (61, None)]
    items = spark.createDataFrame(rows, "node long, bands array<long>")
    once, parts = (sorted(map(tuple, meetings(items, work, k).collect())) for k in (1, 2))
    assert once == parts and len(once) > 100


def test_crowded_band_makes_rows_of_similar_lines_alone(spark):
    """Near copies of one line that are not like each other: their marks are alike, their shingles are not."""
    rng, work, seen = random.Random(15), Work(spark), []
    base, lines = prose(rng, 60).replace("\n", " ").split(" "), []
    for _ in range(30):
        words = list(base)
        for i in rng.sample(range(60), 6):
            words[i] = f"{rng.getrandbits(32):x}"
        lines.append(" ".join(words))
    lines += [x[:-1] + "#" for x in lines[:4]] + ["ab", "cd", "x" * 3000]
    near = {(a, b) for b, y in enumerate(lines) for a in range(b) if len((s := line_shingles(lines[a])) & (t := line_shingles(y))) >= 0.8 * len(s | t)}
    assert len(lines) > CROWD and 4 <= len(near) < 40
    met = spark.range(len(lines)).select(F.lit(7).cast("long").alias("band"), F.col("id").alias("node"), F.lit(0).cast("long").alias("head"))
    sets = spark.createDataFrame(list(enumerate(lines)), "node long, set string")
    may = May(sets.select("node"), lambda a, b: F.lit(True))

    def close(rows, a, b):
        if "node_a" not in rows.columns:  # heads and rounds find nothing, so that all is left to the last comparison
            return rows.where("false")
        seen.append({(min(r.node_a, r.node_b), max(r.node_a, r.node_b)) for r in rows.collect()})
        return rows

    labels = {r.node: r.label for r in similar(met, sets, work, 0.8, close=close, may=may, crowded=_counted(sets, may, work, 0.8)).collect()}
    assert near <= seen[0] and len(seen[0]) <= len(near) + 6
    assert all(labels[a] == labels[b] for a, b in near)


def _sketched(spark, sets, band=1):
    own = [np.array(sorted(x), dtype=np.int64) for x in sets]
    rows = [(band, i, x.tolist(), k.tolist()) for i, (x, k) in enumerate(zip(own, sketches(own), strict=True))]
    return spark.createDataFrame(rows, "band long, label long, set array<long>, sketch array<long>")


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_sketches_lose_no_similar_pair(spark, similarity):
    rng = random.Random(3)
    pool = [signed(rng.getrandbits(64)) for _ in range(3000)]
    sets = [set(pool[:9]), {*pool[:8]}, {*pool[:8], pool[20]}, {pool[0]}, {pool[0]}, set(pool[:2700]), set(pool[:2160])]
    for n in (5, 18, 57, 276):
        base = rng.sample(pool, n)
        sets += [set(rng.sample(base, rng.randint(n // 2 + 1, n))) | set(rng.sample(pool, rng.randrange(n // 4 + 1))) for _ in range(12)]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])}
    got = _near(_sketched(spark, sets), similarity)
    assert {(r.a, r.b) for r in got.collect()} == want and want
    plain = _sketched(spark, sets).alias("x").join(_sketched(spark, sets).alias("y"), F.col("x.label") < F.col("y.label"))
    assert {(r[0], r[1]) for r in plain.where(_close("x.set", "y.set", similarity)).select("x.label", "y.label").collect()} == want


def test_pairs_that_only_meet_are_told_by_their_sketches(spark):
    """Of a thousand paragraphs of one band with a similarity of two thirds hardly a pair has its hashes compared, and those once."""
    rng = random.Random(4)
    common = [signed(rng.getrandbits(64)) for _ in range(80)]
    sets = [{*common, *(signed(rng.getrandbits(64)) for _ in range(20))} for _ in range(1000)]
    rows = _sketched(spark, sets)
    plan = _near(rows, 0.8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_intersect(") == 1 and 0 <= plan.index("bit_count(") < plan.index("array_intersect(")
    bits = np.unpackbits(sketches([np.array(sorted(x), dtype=np.int64) for x in sets]).view(np.uint8), axis=1).astype(np.int32)
    assert bits.shape[1] == 64 * WORDS
    differ = bits @ (1 - bits).T + (1 - bits) @ bits.T
    assert (differ[np.triu_indices(1000, 1)] <= 200 / 9).mean() < 0.01
    assert _near(rows, 0.8).count() == 0


def test_lines_are_signed_in_parts(spark):
    texts = ["one line of some words\nanother line of other words\n\nOne line of some words ", None, "x\ny\nx", "z\nanother line of other words"]
    docs = keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    whole = {(r.h1, r.h2): r for r in _signed(docs, 0.8).collect()}
    parts = [_signed(docs, 0.8, k, PASSES).collect() for k in range(PASSES)]
    assert PASSES > 1 and all(parts) and {(r.h1, r.h2): r for part in parts for r in part} == whole and sum(map(len, parts)) == len(whole) == 5
    assert sorted(r.repeated for r in whole.values()) == [False, False, True, True, True]


def test_lines_leave_one_table(spark, tmp_path, monkeypatch):
    """What the steps have written is dropped as soon as nothing reads it any more; the result reads the places of lines that go."""
    from veiltext.llm import op6_lines

    made, rng = [], random.Random(17)
    monkeypatch.setattr(op6_lines, "Work", lambda spark: made.append(Work(spark)) or made[0])
    lines = [prose(rng, 12).replace("\n", " ") for _ in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", ".", " !"]) for _ in range(6))) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    out = line_dedup(spark.read.parquet(str(tmp_path / "docs")))
    left = [d.name for d in Path(made[0].root.removeprefix("file://")).iterdir() if any(d.iterdir())]
    assert made[0].count > 5 and left == [str(made[0].count)]
    assert out.count() == 40 and out.agg(F.sum("n_dropped")).head()[0] > 100
