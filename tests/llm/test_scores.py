"""Models (2, 4, 8, 9) and decontamination (3): exact parts against plain code, learned parts on held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import awkward, corpus, labels, prose, table
from veiltext.llm.op2_quality import CHUNK, HOP, ByteNet, chunks, quality
from veiltext.llm.op3_decontaminate import Items, _search, contaminated, weighted_jaccard
from veiltext.llm.op4_rules import Forest, calibrate, counts, quality_rules
from veiltext.llm.op8_toxicity import Lexicon, drop_toxic, folded, toxicity
from veiltext.llm.op9_lm import CLASSES, FEATURES, Block, expected, lm_scores, logits, observed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def noisy(seed, n):
    """Texts with label 0 where words carry signs, and a few insults (label 1 of toxic) in others."""
    rng = random.Random(seed)
    rows, good, toxic = [], [], []
    for i in range(n):
        text = prose(rng, rng.randrange(60, 160))
        bad, rude = rng.random() < 0.3, rng.random() < 0.3
        if bad:
            text = " ".join(w + rng.choice(["$$$", "%%%", "###"]) for w in text.split(" "))
        if rude:
            words = text.split(" ")
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grobian", "gr0bian", "lumpenkerl", "LUMPENsack", "grоbian"]))
            text = " ".join(words)
        rows.append((i, text))
        good.append((i, int(not bad)))
        toxic.append((i, int(rude)))
    return rows, good, toxic


def accuracy(got, truth):
    held = [r for r in got if r.held_out]
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held)


def test_chunks_cover_the_text():
    for n in (0, 1, CHUNK - 1, CHUNK, CHUNK + 1, HOP + CHUNK, 5000):
        text = bytes(i % 251 + 1 for i in range(n))
        got = chunks(text)
        joined = b"".join(c.tobytes()[:HOP] for c in got[:-1]) + got[-1].tobytes()
        assert joined.rstrip(b"\0") == text and len(joined) - n < CHUNK + 1


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net, x, y = ByteNet(), rng.integers(0, 256, (4, CHUNK)).astype(np.uint8), np.array([0, 1, 1, 0], np.float32)
    for part in net.parts():
        part += 0  # float32 parts are changed in place below

    def loss():
        z = net.logits(x)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    for part, grad in zip(net.parts(), net.gradients(x, y), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        step, was = 1e-3, part[at].copy()
        part[at] = was + step
        up = loss()
        part[at] = was - step
        down = loss()
        part[at] = was
        assert abs((up - down) / (2 * step) - grad[at]) < 0.05 * abs(grad[at]) + 1e-3


def test_quality(spark):
    rows, good, _ = noisy(1, 300)
    truth = dict(good)
    wrong = [(i, 1 - y) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, y) for i, y in good]  # held-out labels play no part
    docs = table(spark, rows)
    got = quality(docs, labels(spark, good, "quality")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert accuracy(got, truth) > 0.95
    again = quality(docs, labels(spark, wrong, "quality")).collect()
    assert {r.doc_id: r.score for r in got} == {r.doc_id: r.score for r in again}


def test_models_awkward(spark):
    docs = awkward(spark)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (2, None, None), (8, 0, 1), (1, 0, 1)], "doc_id long, quality int, toxic int")
    for marks in (empty, few):
        for got in (quality(docs, marks).collect(), toxicity(docs, marks).collect()):
            assert len(got) == 13 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert len(quality_rules(docs, marks).collect()) == 13
    kept = drop_toxic(docs, empty)
    assert kept.columns == docs.columns and kept.count() == 13
    none = table(spark, [])
    assert [f(none, few).collect() for f in (quality, toxicity, quality_rules)] == [[], [], []]
    assert {r.score for r in quality(docs, empty).collect()} == {0.5}


def plain_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    within = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(within)


def test_counts():
    texts = [t for _, t in corpus(3, 40)] + ["", " \n \n", "a a a a", "a b c a b c x", "x\ny\nx\n x\n\ny", "é# ü$$ 日本 <|>\x0b\x1cq", "a b c", "a b c d a b c"]
    texts += ["\n".join([t, t]) for t in texts]
    for text in texts:
        assert counts(text.encode())[:5] == plain_counts(text), text


def test_forest_marks_what_is_far_off():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (2000, 4))
    forest = Forest(x, np.vstack([x, np.full((1, 4), 9.0)]), np.full(4, 0.25))
    scores = forest.scores(np.vstack([x[:500], np.full((1, 4), 8.0), np.zeros((1, 4))]))
    assert scores[500] > np.quantile(scores[:500], 0.99) and scores[501] < np.median(scores[:500])
    plain = sum(path(forest, tree, x[0]) for tree in range(100)) / 100
    assert math.isclose(scores[0], 2 ** (-plain / Forest.expected(256)))


def path(forest, tree, x):
    node = 1
    while forest.feature[tree, node] >= 0:
        node = 2 * node + int(x[forest.feature[tree, node]] >= forest.split[tree, node])
    return forest.path[tree, node]


def test_calibrate():
    s, good = np.array([0.1, 0.2, 0.3, 0.4, 0.5, 0.6]), np.array([1, 1, 1, 0, 1, 0], dtype=bool)
    assert calibrate(s, good, 0.0) == pytest.approx(0.55)
    assert calibrate(s, good, 0.3) == pytest.approx(0.35)
    assert calibrate(s, good & False, 0.1) == math.inf


def test_quality_rules(spark):
    rows, good, _ = noisy(4, 250)
    got = quality_rules(table(spark, rows), labels(spark, good, "quality")).collect()
    texts, truth = dict(rows), dict(good)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    passed = [r for r in got if not r.base_failed]
    assert sum(r.kept for r in passed if truth[r.doc_id]) >= 0.97 * sum(truth[r.doc_id] for r in passed)
    assert sum(not r.kept for r in passed if not truth[r.doc_id]) > 0.9 * sum(1 - truth[r.doc_id] for r in passed)


def test_folding_and_exceptions():
    assert folded("ІDІ0T  1d10t 2024 c!own tr@sh! $$$") == ["idiot", "idiot", "2024", "ciown", "trash"]
    lexicon = Lexicon({" idiot": 3.0, " trash ": 2.0, " idioti": 5.0})
    a = np.expm1(lexicon.features([b"an idiot", b"idiotic trash", b"trash can", b"trashy", b"Trash. Can"])[:, 0])
    assert a.round(6).tolist() == [3, 7, 0, 0, 0]


def test_toxicity(spark):
    rows, _, rude = noisy(5, 400)
    got = toxicity(table(spark, rows), labels(spark, rude, "toxic")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in got)
    assert accuracy(got, dict(rude)) > 0.97
    kept = {r.doc_id for r in drop_toxic(table(spark, rows), labels(spark, rude, "toxic")).collect()}
    assert kept == {r.doc_id for r in got if not r.predicted}


def test_lm_base_and_model(spark):
    rows = [*corpus(13, 80), (500, ""), (501, None), (502, "Unseen"), (503, "unseen UNSEEN")]
    got = {r.doc_id: r for r in lm_scores(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    tally = Counter(w for d, t in rows if not held[d] for w in [*WORD.findall(lower(t)), None])
    n, v = sum(tally.values()), len(tally)
    for d, t in rows:
        tokens = [*WORD.findall(lower(t)), None]
        base = sum(math.log10((tally[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(tokens), sum(w in tally for w in tokens), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert lm_scores(table(spark, [])).collect() == []


def test_lm_sums_to_one_and_learns():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["ba", "ce", "di"]) + w for w in ["x", "y", "z"] * 20).encode() for _ in range(30)]
    block, weights = Block(texts), np.zeros((FEATURES, CLASSES), np.float32)
    assert np.allclose(np.exp(logits(weights, block.features)).sum(axis=1), 1)
    seen, meant = np.zeros((2, FEATURES, CLASSES))
    observed(block, seen)
    expected(weights, block, meant)
    assert seen[0].sum() == len(block.target) and math.isclose(meant[0].sum(), len(block.target), rel_tol=1e-5)
    one = np.zeros((FEATURES, CLASSES))
    for f, t in zip(block.features, block.target, strict=True):
        one[[0, *f], t] += 1
    assert np.array_equal(one, seen)
    before = logits(weights, block.features)[np.arange(len(block.target)), block.target].sum()
    weights = (weights + 0.5 * (seen - meant) / (np.maximum(seen, meant) + 4)).astype(np.float32)
    assert logits(weights, block.features)[np.arange(len(block.target)), block.target].sum() > before


def test_lm_awkward(spark):
    got = lm_scores(awkward(spark)).collect()
    assert len(got) == 13 and {r.n_tokens for r in got if r.doc_id in (3, 4, 5, 10)} == {1}
    assert all(not r.held_out for r in got if r.doc_id is None)


def plain_contaminated(rows, items, similarity=0.8):
    bags, weight = {}, Counter()
    for i, t in items:
        words = WORD.findall(lower(t))
        k = min(5, len(words))
        bags[i] = k, len(words), Counter(tuple(words[j : j + k]) for j in range(len(words) - k + 1))
        weight.update(bags[i][2].keys())
    weight = {s: 1 / n for s, n in weight.items()}
    best = {}
    for d, t in rows:
        words = WORD.findall(lower(t))
        for i, (k, n, bag) in bags.items():
            for at in range(len(words) - n + 1):
                own = Counter(tuple(words[j : j + k]) for j in range(at, at + n - k + 1))
                value = weighted_jaccard(own, bag, weight)
                if value >= similarity and value > best.get((d, i), (0, 0))[0]:
                    best[d, i] = value, at
    return best


def test_contaminated(spark):
    rng = random.Random(21)
    items = [(i, prose(rng, n)) for i, n in enumerate([1, 3, 5, 8, 20, 20, 35, 60])]
    items.append((8, items[7][1].replace(" ", "  ").upper()))
    rows = [(d, t) for d, t in corpus(22, 40)]
    for d in range(0, 40, 3):
        words = rows[d][1].split(" ")
        words.insert(rng.randrange(len(words) + 1), rng.choice(items[2:])[1].title())
        rows[d] = (d, " ".join(words))
    near = items[7][1].split(" ")
    near[2] = "other"
    rows += [(100, "x " + " ".join(near) + " y"), (101, " ".join(items[7][1].split(" ")[:30])), (102, items[0][1] + " q")]
    got = contaminated(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_contaminated(rows, items)
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in got}
    assert set(found) == set(want)
    assert all(math.isclose(found[k][0], want[k][0]) for k in want)
    several = contaminated(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"), pass_bytes=400).collect()
    assert {(r.doc_id, r.item_id) for r in several} >= {k for k in want if k[1] not in (7, 8)}


def test_contaminated_where_items_share_text(spark):
    rng = random.Random(31)
    common = prose(rng, 50).replace("\n", " ").split(" ")
    items = [(i, " ".join([*common, *prose(rng, 10).replace("\n", " ").split(" ")])) for i in range(10)]
    words = items[4][1].split(" ")
    rows = [(0, "before " + " ".join([*words[:30], "other", *words[31:]])), (1, " ".join([*words[:20], "other", *words[21:]]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.similarity) for r in contaminated(table(spark, rows), benchmark, rarity=False).collect()}
    assert got == {(0, 4): (1, 60, 51 / 61), (1, 4): (0, 60, 51 / 61)}
    for rarity in (True, False):
        one, many = (sorted(contaminated(table(spark, rows), benchmark, similarity=0.6, rarity=rarity, pass_bytes=n).collect()) for n in (1 << 20, 500))
        assert [r[:4] for r in one] == [r[:4] for r in many] and np.allclose([r.similarity for r in one], [r.similarity for r in many])
        assert len(one) >= 2


def test_contaminated_finds_all_at_the_least_similarity():
    rng = random.Random(32)
    found = 0
    for i in range(500):  # each end changed: 32 of 36 shingles are left, Jaccard 0.8
        words = [b"w%d" % rng.getrandbits(60) for _ in range(40)]
        items = Items([(i, b" ".join(words))], rarity=False)
        own = [b"x", b"x", *words[2:-2], b"y", b"y"]
        got = _search(own, {5: Items._hashes(own, 5)}, items, 0.8)
        found += [g[:3] for g in got] == [(0, 0, 40)] and math.isclose(got[0][3], 0.8)
    assert found == 500


@pytest.mark.parametrize("rarity", [True, False])
def test_contaminated_where_a_text_is_shorter_than_the_item(spark, rarity):
    words = [f"w{i}" for i in range(60)]
    rows = [(n, " ".join(words[:n])) for n in (59, 58, 49, 48, 30, 4, 1)] + [(100, " ".join(words[2:])), (101, " ".join(words[1:])), (102, "")]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "u v w x y"), (3, "only")], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.start_word, r.n_words, r.similarity) for r in contaminated(table(spark, rows), items, rarity=rarity).collect()}
    assert got == {d: (1, 0, n, (n - 4) / 56) for d, n in ((59, 59), (58, 58), (49, 49), (100, 58), (101, 59))}


def test_contaminated_awkward(spark):
    items = spark.createDataFrame([(1, "one"), (2, None), (3, ""), (None, "a b c d e f g"), (9, "one")], "item_id long, text string")
    got = contaminated(awkward(spark), items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(6, 1)]
    assert contaminated(table(spark, []), items).collect() == []
    assert contaminated(awkward(spark), items.limit(0)).collect() == []


def test_blocks_find_all_within_radius():
    rng = random.Random(30)
    items = Items([(i, prose(rng, 12).encode()) for i in range(40)])
    size = next(iter(items.by_size))
    prints = items.index[size][1]
    windows = np.array([int(p) ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(20))) for p in prints for _ in range(6)], dtype=np.uint64)
    at, item = items.near(size, windows)
    want = {(w, items.index[size][0][i]) for w in range(len(windows)) for i in range(len(prints)) if (int(windows[w]) ^ int(prints[i])).bit_count() <= 15}
    assert set(zip(at.tolist(), item.tolist(), strict=True)) == want
