"""The pipeline's stages, one after the other, against brute force on the smallest tables."""

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from clickloom.llm import bpe, exact, mixing, quality
from clickloom.session import scratch_dir
from tests.llm.conftest import words
from tests.llm.test_texts import low, shingles

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        place = scratch_dir(spark, "test-stage")
        stage(spark, frames[-1], FOLDER).write.parquet(place)
        frames.append(spark.read.parquet(place))
    assert all(f.columns == columns for f in frames[:-1])
    texts = [{r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for f in frames[:-1]]
    raw, good, unlike, apart, mixed = texts
    assert set(good) == {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    newest = {}
    for i, text in good.items():
        newest[low(text)] = max(i, newest.get(low(text), i))
    assert set(unlike) == set(newest.values())
    sets = {i: shingles(text) for i, text in unlike.items()}
    near = {i: [j for j in sets if j != i and sets[i] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])] for i in sets}
    groups, left = [], set(sets)
    while left:
        group, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            if i not in group:
                group.add(i)
                todo += near[i]
        groups.append(group)
        left -= group
    assert set(apart) == {min(g) for g in groups}
    labels = mixing.domain_labels(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    copies = {r.doc_id: r.copies for r in mixing.mix(frames[3], labels).collect()}
    assert set(mixed) == {i for i, n in copies.items() if n} and frames[4].count() == sum(copies.values())
    library = Tokenizer.from_file(bpe.default_vocabulary())
    for r in frames[-1].collect():
        ids = library.encode(mixed[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_the_last_stage_returns_the_ids(spark):
    docs = spark.createDataFrame([(1, "Hello, the World"), (2, None)], "doc_id bigint, text string")
    library = Tokenizer.from_file(bpe.default_vocabulary())
    want = {1: library.encode("Hello, the World", add_special_tokens=False).ids, 2: []}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.encode(spark, docs, FOLDER).collect()} == want


def test_stages_tell_rows_with_one_id_apart(spark, documents):
    good, other = (" ".join(f"{w}." if k % 9 == 8 else w for k, w in enumerate(words(120, seed))) for seed in (1, 2))
    bad = "$$$ !!! ### " * 30
    docs = documents((1, good), (1, bad), (None, other), (None, bad), (2, good), (2, good), (3, good.upper()), (None, None))
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns
    left = sorted(r.text for r in kept.collect() if r.doc_id != 3)
    assert left == sorted([good, other, good, good])
    folder = scratch_dir(spark, "test-index")
    unlike = exact.without_copies(docs, exact.DigestIndex(spark, folder))
    got = sorted(((r.doc_id, r.text) for r in unlike.collect()), key=repr)
    assert got == sorted([(1, bad), (None, other), (3, good.upper()), (None, None)], key=repr)
    twice = documents((5, "same words"), (5, "same words"), (4, "SAME words"), (6, "else"))
    left = exact.without_copies(twice, exact.DigestIndex(spark, scratch_dir(spark, "test-index")))
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(5, "same words"), (6, "else")]
