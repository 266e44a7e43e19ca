"""Exact dedup, near dedup, substring dedup, scores and quality against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import exact, lm, neardup, quality, substring
from clickloom.session import scratch_dir
from tests.llm.conftest import ODD, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes(range(65, 91))


def low(text):
    return (text or "").encode().translate(bytes(c + 32 if c in UPPER else c for c in range(256)))


def family(base, edits, seed):
    out = list(base)
    for k, at in enumerate(words(edits, seed, len(base))):
        out[int(at[1:])] = f"edit{seed}x{k}"
    return " ".join(out)


def corpus():
    base = words(300, 1)
    rows = [(100 + k, family(base, k % 9, k)) for k in range(60)]
    rows += [(200 + k, " ".join(words(50 + 7 * k, 50 + k))) for k in range(20)]
    shared = " ".join(words(60, 9))
    rows += [(300 + k, f"{' '.join(words(40, 300 + k))} {shared} {' '.join(words(30, 400 + k))}") for k in range(12)]
    rows += [(400 + k, " ".join(words(80, 7))) for k in range(15)]
    rows += [(500, " ".join(words(80, 7)).upper()), (501, "x " * 200), (502, "x " * 90)]
    return rows


@pytest.fixture(scope="module")
def all_rows():
    return corpus() + ODD


def test_exact_dedup_keeps_the_largest_id_of_equal_texts(spark, documents, all_rows):
    index = exact.DigestIndex(spark, scratch_dir(spark, "test-index"), buckets=4)
    got = exact.deduplicate(documents(*all_rows), index).collect()
    groups = collections.defaultdict(list)
    for i, text in all_rows:
        groups[hashlib.sha256(low(text)).hexdigest()].append(i)
    assert len(got) == len(all_rows)
    for digest, ids in groups.items():
        mine = [r for r in got if r.text_sha256 == digest]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        assert sorted(map(repr, (r.doc_id for r in mine))) == sorted(map(repr, ids))
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [keep]
    # what an earlier batch brought stays there
    later = exact.deduplicate(documents((9000, all_rows[0][1]), (9001, "quite new")), index).collect()
    assert {(r.doc_id, r.kept) for r in later} == {(9000, False), (9001, True)}
    assert next(r for r in later if r.doc_id == 9000).keep_id == max(
        i for i, text in all_rows if text == all_rows[0][1])


def test_texts_without_copies_have_their_columns(spark, documents, all_rows):
    docs = documents(*all_rows)
    kept = exact.without_copies(docs, exact.DigestIndex(spark, scratch_dir(spark, "test-index"), buckets=4))
    assert kept.columns == docs.columns
    assert kept.count() == len({low(text) for _, text in all_rows})


def shingles(text):
    w = WORD.findall(low(text))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k:k + 5]) for k in range(len(w) - 4)]) if w else frozenset()


def test_near_duplicates_equal_all_pairs(documents, all_rows):
    got = neardup.near_duplicates(documents(*all_rows)).collect()
    assert len(got) == len(all_rows)
    sets = {i: shingles(text) for i, text in all_rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low_, high = sorted((find(a), find(b)))
                parent[high] = low_
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_signature_bins_are_all_filled_and_alike_for_equal_sets():
    import numpy as np
    import pyarrow as pa

    grams, bounds = neardup.shingle_sets(pa.array(["a b c d e", "A B C D E", " ".join(words(500))]))
    sketch = neardup.signatures(grams, bounds)
    assert (sketch != neardup._EMPTY).all() and (sketch[0] == sketch[1]).all()
    assert len(np.unique(sketch[2])) > 100


def test_substring_dedup_equals_brute_force(documents, all_rows):
    got = substring.remove_repeats(documents(*all_rows)).collect()
    lists = [(i, WORD.findall((text or "").encode())) for i, text in all_rows]
    seen = collections.Counter(tuple(w[k:k + 35]) for _, w in lists for k in range(len(w) - 34))
    want = []
    for i, w in lists:
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k:k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_base_scores_equal_brute_force_and_pairs_help(documents, all_rows):
    got = lm.score_documents(documents(*all_rows)).collect()
    tokens = [(i, WORD.findall(low(text)) + [None]) for i, text in all_rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, x in tokens if i is not None and not held(i) for w in x)
    n, v = sum(counts.values()), len(counts)
    want = collections.defaultdict(list)
    for i, x in tokens:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x)
        want[i].append((held(i), len(x), sum(counts[w] > 0 for w in x), n, round(base, 6)))
    mine = collections.defaultdict(list)
    for r in got:
        mine[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
    assert {k: sorted(x) for k, x in mine.items()} == {k: sorted(x) for k, x in want.items()}
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_bloom_filter_never_misses_a_mark():
    import numpy as np

    shape = lm.Shape.of(50_000, 4, 1 << 30)
    keys = lm.mix(np.arange(1, 20_001, dtype=np.uint64))
    counts = np.arange(20_000) % 9 + 1
    filter_ = np.zeros(shape.bits // 8, np.uint8)
    for level in range(1, 5):
        for place in lm.positions(keys[lm.marks_of(counts) >= level], level, shape):
            np.bitwise_or.at(filter_, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    back = lm.probed(filter_, keys, shape)
    floor = np.where(counts == 1, 1, 0.75 * 2.0 ** lm.marks_of(counts))
    assert (back >= floor).all() and (back == floor).mean() > 0.9
    assert (lm.probed(filter_, lm.mix(np.arange(50_000, 60_000, dtype=np.uint64)), shape) > 0).mean() < 0.05


def statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    often = collections.Counter(grams)
    covered = {p for k, g in enumerate(grams) if often[g] > 1 for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics_equal_brute_force(documents, all_rows):
    rows = [*all_rows, (600, "a b\n\n a b\na b\n" * 9), (601, "# * | <x> $5 & " * 30)]
    got = quality.judge(documents(*rows)).collect()
    want = [(i, *statistics(text)) for i, text in rows]
    assert sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == \
        sorted(map(repr, want))
    for r in got:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)


def test_quality_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id AS id", "quality AS label")
    judged = quality.op10_quality_rules(spark, folder)
    rows = judged.join(labels, judged.doc_id == labels.id).filter("NOT base_failed").collect()
    assert sum(r.kept == (r.label == 1) for r in rows) > 0.9 * len(rows)


def test_expectation_maximisation_finds_the_reliable_rules():
    patterns = [((1, 1, 0), 800), ((-1, -1, 0), 100), ((1, 1, -1), 50), ((1, 1, 1), 50)]
    model = quality.fit(patterns, 3)
    assert quality.posterior((1, 1, -1), model) > 0.5 > quality.posterior((-1, -1, 0), model)
    assert quality.fit([], 3)["share"] == quality.FIRST_SHARE


@pytest.mark.parametrize("operator", [
    neardup.near_duplicates, substring.remove_repeats, lm.score_documents, quality.judge, neardup.representatives,
    lambda d: exact.deduplicate(d, exact.DigestIndex(d.sparkSession, scratch_dir(d.sparkSession, "empty"), 2)),
])
def test_an_empty_table_gives_an_empty_result(documents, operator):
    assert operator(documents()).count() == 0


def test_filter_grows_with_its_marks_and_probes_end():
    import numpy as np
    from clickloom.llm import packed

    # more marks than the 2 ** 29 bits that were once the most
    assert lm.Shape.of(1 << 32, 64).bits >= 10 << 32
    keys = np.sort(lm.mix(np.arange(1, 400_001, dtype=np.uint64)))
    counts = np.where(np.arange(400_000) % 4 == 0, 0, np.arange(400_000) % 37)
    right = np.where(counts > 0, lm.marks_of(counts), 0)
    shape = lm.Shape.of(int(right.sum()), 1)
    marks = lm.probed_marks(lm.filled(keys[counts > 0], right[counts > 0], shape), keys, shape, 6)
    assert (marks >= right).all() and (marks[counts == 0] > 0).mean() < 0.02 and (marks > right).mean() < 0.02
    # a filter without a free bit ends at the highest mark put in
    full, shape = np.full(128, 255, np.uint8), lm.Shape(1, 10)
    assert set(lm.probed_marks(full, keys[:9], shape, 5)) == {5}
    assert packed.packed_counts(np.array([1, 1 << 33])).tolist() == [1, 1 << 33]


def test_filter_is_kept_and_both_ways_to_probe_it_agree(spark, documents, all_rows):
    from clickloom.llm import packed

    docs = documents(*all_rows)
    layout = packed.Layout(7, 5)
    place = scratch_dir(spark, "kept-filter")
    slices = lm.train_filter(docs, place, layout)
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [WORD.findall(low(text)) + [None] for i, text in all_rows if not held(i)]
    assert sum(r.pairs for r in slices.collect()) == len({p for x in tokens for p in zip(x, x[1:])})
    kept = lm.Filter(spark.read.parquet(place).toArrow())
    rows = packed.sharded(docs, layout)
    asked = lm.count_pairs(rows, layout, asked=True)
    routed = {}
    for r in lm.through_slices(asked, slices).collect():
        keys = np.frombuffer(r["keys"], "<u8")
        marks = np.frombuffer(r["counts"], f"<u{len(r['counts']) // max(len(keys), 1) or 1}")
        routed.update(zip(keys.tolist(), marks.tolist()))
    every = np.unique(np.concatenate([np.frombuffer(r["keys"], "<u8") for r in asked.collect()]))
    assert [routed.get(k, 1) for k in every.tolist()] == kept.marks(every).tolist()
    told = lambda frame: sorted(map(repr, frame.collect()))
    assert told(lm.score_documents(docs)) == told(lm.score_documents(docs, broadcast_bytes=-1))


def test_scores_equal_brute_force_where_the_filter_is_wide(documents, all_rows):
    got = lm.score_documents(documents(*all_rows), bits_per_mark=2000).collect()
    tokens = [(i, WORD.findall(low(text)) + [None]) for i, text in all_rows]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    train = [x for i, x in tokens if not held(i)]
    one = collections.Counter(w for x in train for w in x)
    two = collections.Counter(p for x in train for p in zip(x, x[1:]))
    n, v = sum(one.values()), len(one)
    want = []
    for i, x in tokens:
        score = 0.0
        for k, w in enumerate(x):
            p1, p = (one[w] + 1) / (n + v + 1), None
            h = one[x[k - 1]] if k else 0
            share = 0.4 * h / (h + 20)
            c = two[x[k - 1], w] if k else 0
            step = c.bit_length()
            c = min(0.75 * 2 ** step if step > 1 else step, h, one[w])
            p = (share * c / h if h else 0) + (1 - share) * p1
            score += math.log10(p)
        want.append((i, round(score, 6)))
    assert sorted(map(repr, ((r.doc_id, round(r.score, 6)) for r in got))) == sorted(map(repr, want))
    # documents that the model has not seen gain too
    unseen = [r for r in got if r.held_out and r.n_tokens > 100]
    assert unseen and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_words_made_for_a_polynomial_have_hashes_of_their_own():
    import pyarrow as pa

    from clickloom.llm.text import find_words

    for size in (1024, 2048, 4096):
        thue = "".join("ab"[k.bit_count() % 2] for k in range(size))
        hashes = find_words(pa.array([thue, thue.translate({97: "b", 98: "a"}), thue])).hashes
        assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_substring_dedup_gives_the_texts_and_spans(documents):
    passage = words(40, 1)
    texts = {1: words(10, 2) + passage + words(5, 3), 2: passage + words(7, 4), 3: words(60, 5)}
    got = {r.doc_id: r for r in substring.cleaned(documents(*[(i, " \n".join(w)) for i, w in texts.items()])).collect()}
    assert {i: [tuple(x) for x in r.removed] for i, r in got.items()} == {1: [(10, 50)], 2: [(0, 40)], 3: []}
    assert {i: r.text for i, r in got.items()} == {1: " ".join(texts[1][:10] + texts[1][50:]), 2: " ".join(texts[2][40:]), 3: " ".join(texts[3])}


def test_rows_of_one_number_are_spread_and_none_is_lost(documents):
    """A third of the rows have one doc_id, others none; results are those of rows with numbers of their own."""
    texts = [" ".join(words(60, 40 + k % 50)) for k in range(90)]
    ids = [7 if k % 3 == 0 else None if k % 3 == 1 else 100 + k for k in range(90)]
    from clickloom.llm import packed

    rows = packed.sharded(documents(*zip(ids, texts)), packed.Layout(8, 8)).collect()
    assert len({r.shard for r in rows if r.doc_id == 7}) > 4 and len({r.shard for r in rows if r.doc_id is None}) > 4
    cut = lambda i: sorted((r.n_words, r.n_removed, r.kept_sha256) for r in
                           substring.remove_repeats(documents(*zip(i, texts))).collect())
    assert cut(ids) == cut(range(90))
    assert len(lm.score_documents(documents(*zip(ids, texts))).collect()) == 90


def test_families_of_edited_copies_lose_no_link(spark, documents):
    """Copies of one text edited in steps, cut short, or with passages of their own: links far from any centre."""
    import random

    chooser = random.Random(11)
    base, texts = words(150, 70), []
    for k in range(120):
        w = list(base)
        for _ in range(chooser.randrange(8)):
            w[chooser.randrange(len(w))] = f"z{chooser.randrange(40)}"
        if k % 4 == 0:
            w = w[:chooser.randrange(60, 150)]
        if k % 5 == 0:
            w += words(chooser.randrange(5, 80), 80 + k % 3)
        if k % 7 == 0:
            w = w[chooser.randrange(50):]
        texts.append((k + 1, " ".join(w)))
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low_, high = sorted((find(a), find(b)))
                parent[high] = low_
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(*texts)).collect()}
    assert got == {i: find(i) for i in sets} and 1 < len(set(got.values())) < 120


def test_marks_miss_no_key_and_few_others_pass(spark, monkeypatch):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id") * 7919).alias("key"), F.col("id").alias("page"))
    keys = rows.filter("page % 10 = 0").select("key")
    got = neardup.marked(rows, "key", keys)
    assert got.columns == ["key", "page", "maybe"] and got.count() == 20_000
    assert got.filter("page % 10 = 0 AND NOT maybe").count() == 0
    assert got.filter("page % 10 <> 0 AND maybe").count() < 18_000 / 12
    assert neardup.marked(rows, "key", keys.limit(0)).filter("maybe").count() == 0
    # a bitmap too small for its keys still has them all
    monkeypatch.setattr(neardup, "MOST_BITS", 1 << 10)
    assert neardup.marked(rows, "key", keys).filter("page % 10 = 0 AND maybe").count() == 2_000


def test_texts_are_not_shuffled_to_find_those_with_company(spark, documents, all_rows, monkeypatch):
    """Also where the ids are too many for Spark's own broadcasts."""
    plans, write = {}, neardup._Store.__call__

    def watched(self, frame):
        plans.setdefault(tuple(frame.columns), frame._jdf.queryExecution().executedPlan().toString())
        return write(self, frame)

    want = sorted(map(repr, neardup.near_duplicates(documents(*all_rows)).collect()))
    monkeypatch.setattr(neardup._Store, "__call__", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(map(repr, neardup.near_duplicates(documents(*all_rows)).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans["id", "text"] and "SortMergeJoin" not in plans["id", "text"]


def test_rows_sent_grow_with_buckets_and_not_with_shards_times_buckets(spark, documents, monkeypatch):
    from clickloom.llm import packed

    docs = documents(*[(k, " ".join(words(80, k))) for k in range(400)]).repartition(2).cache()
    want = sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in lm.score_documents(docs).collect())
    sent = []

    def pack(*args, **more):
        sent.append(packed.pack(*args, **more))
        return sent[-1]

    monkeypatch.setattr(lm, "pack", pack)
    monkeypatch.setattr(packed.Layout, "of", classmethod(lambda cls, docs: cls(40, 40)))
    for most in (1 << 20, -1):
        got = lm.score_documents(docs, broadcast_bytes=most).collect()
        assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    # words and pairs, each twice: a task reads a stretch of the documents and sends a row per bucket
    assert len(sent) == 4 and all(frame.count() <= 2 * 40 for frame in sent)
    docs.unpersist()


def test_stretches_end_at_their_size_and_keep_every_row(documents, monkeypatch):
    from clickloom.llm import packed

    rows = [(7, "same text"), (7, "same text"), (None, None), (8, ""), *[(k, " ".join(words(400_000, k))) for k in range(9, 17)]]
    found = packed.stretches(documents(*rows).coalesce(1), packed.Layout(4, 4)).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in found))) == sorted(map(repr, rows))
    sizes = collections.Counter()
    for r in found:
        sizes[r.shard] += len(r.text or "")
    assert len(sizes) == 2 and max(sizes.values()) <= packed.SHARD_BYTES + 3_000_000
