"""Toxicity: parts against plain versions, and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import toxicity
from tests.llm.conftest import ODD, words

FOLDER = "/root/testdata/sf0.01"


def test_words_and_stems():
    texts = ["You ÉTUDE idiot! étude", "", "ab", "x1yz_Überraschung"]
    text = toxicity.Text.of(pa.array(texts))
    assert text.counts.tolist() == [4, 0, 1, 3]
    assert text.entries(0) == sorted(["0:you", "0:étude", "0:idiot", "4:étud", "4:idio", "5:étude", "5:idiot"])
    assert text.hashes[1] == text.hashes[3] == toxicity.hash_bytes("étude".encode())
    assert text.stems[4][0] == toxicity.hash_bytes("étud".encode(), 4)
    assert text.capitals.tolist() == [5, 0, 0, 0] and text.shouts.tolist() == [1, 0, 0, 0]
    assert np.diff(text.features()[1]).tolist() == [7, 0, 1, 6]


def test_votes():
    voters = toxicity.Voters(["0:idiot", "0:scum", "4:vequ", "5:idiot"])
    clean = " ".join(words(25))
    texts = ["what an idiot", "you vequine thing", clean + " scum " + clean * 3, clean, "", "IDIOT SCUM!!!"]
    votes = voters.votes(toxicity.Text.of(pa.array(texts)))
    said = [{name for k, name in enumerate(toxicity.VOTERS) if v >> k & 1} for v in votes.tolist()]
    assert said == [{"words_0", "stems_5", "dense"}, {"stems_4", "dense", "addressed"}, {"words_1"}, {"nothing"}, set(),
                    {"words_0", "words_1", "stems_5", "several", "dense", "capitals", "shouting"}]


def test_label_model_finds_accuracies_and_the_pair_that_votes_alike():
    chooser, counts, truth = random.Random(1), {}, {}
    for _ in range(40_000):
        y = chooser.random() < 0.2
        said = [chooser.random() < (0.7 if y else 0.05) for _ in toxicity.VOTERS]
        said[1] = said[0] if chooser.random() < 0.95 else said[1]      # a copy of the first voter
        said[-1] = chooser.random() < (0.1 if y else 0.9)
        mask = sum(int(s) << k for k, s in enumerate(said))
        counts[mask] = counts.get(mask, 0) + 1
        truth[mask] = truth.get(mask, 0) + y
    model = toxicity.LabelModel(counts, {})
    assert abs(model.share - 0.2) < 0.02
    assert model.parent[1] == 0 or model.parent[0] == 1
    assert np.abs(model.table[1, 2:7].mean() - 0.7) < 0.05 and np.abs(model.table[0, 2:7].mean() - 0.05) < 0.03
    sure = [m for m, p in model.posteriors().items() if p > 0.5]
    assert sum(truth[m] for m in sure) > 0.97 * sum(truth.values())
    assert sum(counts[m] - truth[m] for m in sure) < 0.02 * 40_000


def test_a_tree_spans_all_voters():
    masks = {sum(b << k for k, b in enumerate(bits)): 1.0 for bits in itertools.islice(
        itertools.product((0, 1), repeat=len(toxicity.VOTERS)), 0, 8192, 7)}
    model = toxicity.LabelModel(masks, {(1, 1): 3.0, (0, 0): 3.0})
    assert (model.parent == -1).sum() == 1
    assert toxicity.LabelModel({}, {}).posteriors() == {}


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    known = [(truth[r.doc_id], r.predicted) for r in rows if r.doc_id in truth and r.held_out]
    assert sum(a == b for a, b in known) >= 0.93 * len(known)
    assert sum(p for t, p in known if not t) <= 0.03 * len(known)


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    scores = []
    for flip in (False, True):
        change = [(r.doc_id, 1 - r.toxic if flip and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic) for r in labels.collect()]
        table = spark.createDataFrame(change, "doc_id bigint, toxic int")
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.scored(docs, table).collect()))
    assert scores[0] == scores[1]


@pytest.mark.parametrize("labelled", [[], [(4, 1), (5, 0), (4, 0), (None, 1), (6, None), (8, 1)]])
def test_odd_rows(spark, documents, labelled):
    labels = spark.createDataFrame(labelled, "doc_id bigint, toxic int")
    rows = toxicity.scored(documents(*ODD), labels).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, _ in ODD), key=repr)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.scored(documents(), labels).collect() == []
