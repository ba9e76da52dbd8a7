"""The stages of corpus_pipeline.py, each on its own and all together, against what plain code says of the same rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import CLASHING, awkward, labels, prose, table
from tests.llm.test_duplicates import Sets, plain_fingerprint, plain_line_dedup
from tests.llm.test_scores import noisy

ITEM = " ".join(f"item{i}" for i in range(40))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of labels, one benchmark item, and documents: clean ones, insults, copies, near copies, shared lines, the item."""
    path = tmp_path_factory.mktemp("corpus")
    rng = random.Random(5)
    rows, _, rude = noisy(5, 120)
    clean = [text for (i, text), (_, bad) in zip(rows, rude, strict=True) if not bad]
    shared = prose(rng, 20).replace("\n", " ")
    extra = [clean[0], clean[1], clean[2] + "\n" + shared, prose(rng, 50) + "\n" + shared, f"before {ITEM} after", prose(rng, 9000), None, ""]
    rows = rows + list(enumerate(extra, 1000))
    table(spark, rows).withColumn("lang", F.lit("x")).write.parquet(f"{path}/documents.parquet")
    labels(spark, rude, "toxic").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, dict(rude)


def survivors(rows):
    """One row of each component of fingerprints within three bits, that of the smallest id."""
    sets, prints = Sets(), {d: plain_fingerprint(t or "") for d, t in rows}
    for a in prints:
        sets.root(a)
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                sets.join(a, b)
    return {d for d in prints if sets.root(d) == d}


def kept(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_each_stage_takes_what_the_one_before_kept(spark, folder):
    path, rows, rude = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("n_chars", F.lit(0).cast("long"))
    clean = corpus_pipeline.toxicity(spark, docs, path)
    assert clean.columns == docs.columns
    left = kept(clean)
    gone = {d for d, _ in rows} - set(left)
    assert all(rude.get(d) for d in gone) and len(gone) >= 0.8 * sum(rude.values()) and all(left[d] == t for d, t in rows if d in left)

    single = corpus_pipeline.lines(spark, clean, path)
    assert single.columns == docs.columns
    want = plain_line_dedup([(d, t or "") for d, t in left.items()])
    found = kept(single)
    assert {d: t or "" for d, t in found.items()} == want and found[1006] is None
    assert {r.doc_id: r.n_chars for r in single.collect()} == {d: None if t is None else len(t) for d, t in found.items()}

    once = corpus_pipeline.near_duplicates(spark, single, path)
    assert once.columns == docs.columns and set(kept(once)) == survivors(list(found.items()))

    free = corpus_pipeline.decontaminate(spark, once, path)
    assert free.columns == docs.columns and set(kept(once)) - set(kept(free)) == {1004}

    packed = corpus_pipeline.packing(spark, free, path).collect()
    assert {r.doc_id for r in packed} == set(kept(free)) and all(r.length <= 4096 for r in packed)
    pieces = {(r.sequence_id, r.offset): r.length for r in packed}
    for (sequence, offset), length in pieces.items():
        assert offset + length <= 4096 and (offset == 0 or any(s == sequence and o + n == offset for (s, o), n in pieces.items()))
    assert sum(r.doc_id == 1005 for r in packed) > 1


def test_run_is_its_stages_one_after_the_other(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("n_chars", F.lit(0).cast("long"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept_rows = [tuple(r) for r in stage(spark, docs, path).collect()]
        docs = spark.createDataFrame(kept_rows, "doc_id long, text string, lang string, n_chars long")
    want = corpus_pipeline.packing(spark, docs, path)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, path)
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, want.select(key).collect()))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "lines", "near_duplicates", "decontaminate", "packing"]


def test_stages_on_awkward_rows_and_empty_tables(spark, folder):
    path, _, _ = folder
    docs = awkward(spark).withColumn("n_chars", F.lit(0).cast("long"))
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(spark, docs, path), stage(spark, empty, path)
        assert none.collect() == [], name
        if name != "packing":
            assert out.columns == docs.columns and set(CLASHING) <= set(out.columns), name
            # learned from these very rows alone, toxicity may take any of them
            assert (0 if name == "toxicity" else 1) <= out.count() <= 13, name
            assert all(r.c0 == r.n_dropped == "x" for r in out.collect()), name
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_decontaminate_goes_by_rows(spark, folder):
    rows = [(None, ITEM), (None, "clean"), (7, f"x {ITEM} y"), (7, "clean as well"), (8, None), (None, None), (9, ITEM[:-7])]
    got = corpus_pipeline.decontaminate(spark, table(spark, rows), folder[0]).collect()
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={d}, text={t!r})" for d, t in (rows[1], rows[3], rows[4], rows[5]))
