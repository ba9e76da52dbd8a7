"""Token rows (1) and packing (5): round trips of ids, gapless places, and the best possible number of sequences."""

import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, corpus, table
from veiltext.llm.op1_tokens import token_matrix, write_token_matrix
from veiltext.llm.op5_packing import pack
from veiltext.llm.packing import best_fit_decreasing, lower_bound
from veiltext.llm.tokens import default_path, encoder


TOKENIZER = Tokenizer.from_file(default_path())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer():
    odd = ["don't WE'LL i'm", "<|endoftext|>a<|startoftext|> b", "école  x y\x1cz\x85w", "日本語のテキスト 12,345.67 ½ ǅ ﬁ İstanbul", "́ ́a", "a\x00b ﻿c", "", "  \n", "😀😀 👩‍👩‍👧", "ß ẞ ŉ"]
    texts = odd + [t for _, t in corpus(1)]
    for got, text in zip(encoder(default_path())([t.encode() for t in texts]), texts, strict=True):
        assert got.tolist() == ids_of(text), text


def test_best_fit_decreasing_against_plain_search():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice([7, 16, 100])
        lengths = [rng.randrange(0, capacity + 1) for _ in range(rng.randrange(0, 60))]
        free, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [f for f in free if f >= lengths[i]]
            space = min(fits) if fits else capacity
            if fits:
                free.remove(space)
            want[i] = capacity - space
            free.append(space - lengths[i])
        bins, offsets = best_fit_decreasing(np.array(lengths, dtype=np.int64), capacity)
        assert [want[i] for i in range(len(lengths))] == offsets.tolist()
        for b in set(bins.tolist()):
            own = sorted((o, n) for o, n, x in zip(offsets.tolist(), lengths, bins.tolist(), strict=True) if x == b)
            assert all(o + n <= p for (o, n), (p, _) in itertools.pairwise(own))
            assert sum(n for _, n in own) <= capacity


def fewest(lengths, capacity):
    """The least number of bins, by trying all ways."""
    best = len(lengths)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i, free in enumerate(bins):
            if free >= rest[0] and free not in bins[:i]:
                place(rest[1:], bins[:i] + [free - rest[0]] + bins[i + 1 :])
        place(rest[1:], [*bins, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best


def test_lower_bound_never_exceeds_the_optimum():
    rng = random.Random(4)
    above_volume = 0
    for _ in range(150):
        lengths = [rng.randrange(1, 31) for _ in range(rng.randrange(1, 9))]
        bound = lower_bound(np.array(lengths), 30)
        assert bound <= fewest(lengths, 30), lengths
        above_volume += bound > -(-sum(lengths) // 30)
    assert above_volume > 5


def check_places(rows, texts, capacity, end_id=1):
    whole, sequences = {}, {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, pieces in whole.items():
        ids = np.array([*ids_of(texts[doc]), end_id], dtype="<u4")
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        for r in pieces:
            part = ids[r.start : r.start + r.length]
            assert r.start == r.piece * capacity and len(part) == r.length == min(capacity, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@pytest.mark.parametrize(("capacity", "partition"), [(4096, 100_000), (64, 40), (200, 25)])
def test_pack(spark, capacity, partition):
    texts = dict(corpus(5, 150))
    rows = pack(table(spark, list(texts.items())), capacity=capacity, partition_pieces=partition).collect()
    assert {r.doc_id for r in rows} == set(texts)
    sequences = check_places(rows, texts, capacity)
    assert len(sequences) <= lower_bound(np.array([r.length for r in rows]), capacity) * 1.02 + 1


def test_pack_awkward(spark):
    rows = pack(awkward(spark)).collect()
    assert sum(r.piece == 0 for r in rows) == 13
    assert len([r for r in rows if r.doc_id is None and r.piece == 0]) == 2
    assert [r.length for r in rows if r.doc_id in (3, 4, 5, 10)] == [1] * 4
    assert max(r.piece for r in rows if r.doc_id == 8) > 10
    assert pack(table(spark, [])).collect() == []


def test_token_matrix(spark, tmp_path):
    texts = dict(corpus(6, 120))
    path = str(tmp_path / "matrix")
    write_token_matrix(table(spark, list(texts.items())).coalesce(2), path, width=256, window_tokens=4000)
    got = {}
    rows = spark.read.parquet(path).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        ids, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256
        assert not ids[r.n_tokens :].any()
        for k, (a, b) in enumerate(itertools.pairwise(r.cu_seqlens)):
            assert places[a:b].tolist() == list(range(b - a))
            got.setdefault(r.doc_ids[k], {})[r.pieces[k]] = (r.starts[k], ids[a:b].tolist())
    assert set(got) == set(texts)
    for doc, pieces in got.items():
        joined = [i for k in sorted(pieces) for i in pieces[k][1]]
        assert joined == [*ids_of(texts[doc]), 1]
        assert [pieces[k][0] for k in sorted(pieces)] == list(range(0, len(joined), 256))
    assert sum(r.n_tokens for r in rows) / len(rows) > 230


def test_token_matrix_awkward(spark):
    rows = token_matrix(awkward(spark)).collect()
    first = [d for r in rows for d, p in zip(r.doc_ids, r.pieces, strict=True) if p == 0]
    assert len(first) == 13 and first.count(None) == 2 and first.count(1) == 2
    assert token_matrix(table(spark, [])).collect() == []
