"""Importance resampling against a plain version, and its selection against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import resample
from tests.llm.conftest import ODD, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def plain_features(text, gram, buckets):
    found = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(found[i:i + n]) for n in range(1, gram + 1) for i in range(len(found) - n + 1)]
    return [zlib.crc32(run.encode()) % buckets for run in runs], len(found)


def plain(rows, target, percent=10, least=20, gram=1, buckets=10_000):
    made = [(i, *plain_features(text, gram, buckets)) for i, text in rows]
    s = Counter(b for _, keys, _ in made for b in keys)
    t = Counter(b for text in target for b in plain_features(text, gram, buckets)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, keys, n_words in made:
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in keys]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(keys), n_words, weight, score))
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0], r[1]))
    drawn = percent * len(able) // 100
    ranks = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted(ranks + [(*r, None) for r in out if r[2] < least], key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


TARGET = ["w1 w2 w3 W4 w5", None, "", "é w7 w7"]


@pytest.mark.parametrize("gram, percent, least", [(1, 10, 20), (1, 50, 1), (3, 100, 0), (2, 0, 20)])
def test_against_a_plain_version(spark, documents, gram, percent, least):
    rows = [*ODD, *[(100 + k, " ".join(words(10 + k, k, 60))) for k in range(60)],
            *[(500, " ".join(words(30, 7, 9)))] * 40, (500, " ".join(words(31, 7, 9)))]
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    done = resample.resampled(documents(*rows).repartition(5), target, percent, least, gram)
    assert rows_of(done) == plain(rows, TARGET, percent, least, gram)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert rows_of(resample.resampled(documents(), none)) == []
    rows = [(k, " ".join(words(25, k))) for k in range(20)]
    assert rows_of(resample.resampled(documents(*rows), none)) == plain(rows, [])


@pytest.mark.parametrize("hot", [False, True])
def test_cutoff_is_the_key_of_a_full_sort(spark, tmp_path, hot):
    chooser = random.Random(4)
    keys = [(3 if hot and k % 3 else chooser.randrange(-5, 5), chooser.randrange(4), chooser.randrange(3), k)
            for k in range(3000)]
    path = str(tmp_path / "keys")
    table = spark.createDataFrame(keys, ", ".join(f"{c} bigint" for c in resample.KEY))
    table.repartition(7, F.col("tie")).sortWithinPartitions("down").write.parquet(path)  # tasks of unlike sizes
    stored, order = spark.read.parquet(path), sorted(keys)
    for wanted in (1, 2, 777, 2999, 3000):
        assert resample.cutoff(stored, wanted) == order[wanted - 1]
    assert resample.cutoff(stored, 0) is None and resample.cutoff(stored, 3001) is None


def test_every_round_discards_a_quarter(spark, tmp_path, monkeypatch):
    path, n = str(tmp_path / "keys"), 4096
    spark.range(n).select(*[F.col("id").alias(c) for c in resample.KEY]).repartition(6).write.parquet(path)
    rounds, plainly = [], resample.before
    monkeypatch.setattr(resample, "before", lambda *a, **k: rounds.append(a) or plainly(*a, **k))
    assert resample.cutoff(spark.read.parquet(path), 1500) == (1499,) * 4
    assert len(set(rounds)) <= math.log(n, 4 / 3)


def test_long_words_and_crc():
    rows = [(1, "x" * 100_000 + " ab é" + "ü" * 47), (2, "a1b2-c3_d4")]
    keys, owner, counts = resample.features(pa.array([t for _, t in rows]), 2, 1 << 31)
    want = [plain_features(t, 2, 1 << 31)[0] for _, t in rows]
    assert [sorted(keys[owner == k].tolist()) for k in range(2)] == [sorted(w) for w in want]
    assert counts.tolist() == [3, 3]
