"""Chat formatting, WARC archives, mixing, and the queries that have SQL."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import chat, mixing, warc
from clickloom.llm.queries import ORACLE_SQL
from clickloom.session import scratch_dir
from tests.llm.conftest import ODD, words
from tests.llm.oracle import rows

MESSAGE = "conv_id bigint, node_id bigint, parent_id bigint, role string, text string, score double, total string, depth string"
PAGE = "page_id bigint, url string, html string, file string, at string, digest string"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    _, ours, theirs = rows(name, spark, "/root/testdata/sf0.001")
    assert ours == theirs


def test_the_best_branch_is_formatted_and_read_back(spark):
    told = [
        (1, 1, None, "user", "root \\ <turn x>", 0.0), (1, 2, 1, "assistant", "</turn>\n\\", 1.0), (1, 3, 1, "assistant", "b", 2.0),
        (1, 4, 2, "user", "deep", 5.0), (1, 5, 3, "user", None, 4.0), (1, 5, 3, "user", None, 4.0),  # a tie of 6.0: the smaller leaf
        (2, 1, 77, None, "", None), (3, 1, 2, "user", "ring", 1.0), (3, 2, 1, "user", "ring", 1.0), (4, 1, 1, "user", "own parent", 0.0),
        (None, 1, None, "user", "nowhere", 0.0), (5, None, None, "user", "nobody", 0.0),
    ]
    nodes = chat.nodes_of(spark.createDataFrame([(*x, "t", "d") for x in told], MESSAGE))
    both = chat.parsed(chat.formatted(chat.best_paths(nodes, 2))).collect()
    got = {(r.conv_id, r.path_rank): [tuple(t) for t in r.turns] for r in both}
    assert got == {
        (1, 1): [("user", "root \\ <turn x>"), ("assistant", "</turn>\n\\"), ("user", "deep")],
        (1, 2): [("user", "root \\ <turn x>"), ("assistant", "b"), ("user", "")],
        (2, 1): [("", "")], (4, 1): [("user", "own parent")],
    }
    first = next(r for r in both if (r.conv_id, r.path_rank) == (1, 1))
    masked = "".join(first.formatted[s.start:s.start + s.length] for s in first.loss)
    assert chat._ESCAPED.sub(r"\1", masked) == "</turn>\n\\"


def test_long_chains_and_empty_tables(spark):
    chain = [(1, k, k - 1 if k else None, "user", f"m{k}", 1.0, "", "") for k in range(300)]
    turns = chat.parsed(chat.formatted(chat.best_paths(chat.nodes_of(spark.createDataFrame(chain, MESSAGE))))).first().turns
    assert [t.text for t in turns] == [f"m{k}" for k in range(300)]
    empty = chat.best_paths(chat.nodes_of(spark.createDataFrame([], MESSAGE)))
    assert chat.parsed(chat.formatted(empty)).count() == 0


def pages_of(spark, *told):
    return spark.createDataFrame([(*x, "", "", "") for x in told], PAGE)


def test_archives_reject_magic_inside_payloads(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    told = [(k, f"http://h/{k}", f"page {k % 7} {inner if k % 3 == 0 else ''}") for k in range(40)]
    told += [(50, None, None), (51, "u\r\nX: y", ""), (52, "", inner), (52, "", inner), (None, "n", "only here"),
             (None, "n", None), (53, "", "é" * 30_000), (54, "", "\r\n\r\nWARC/1.1\r\n")]
    place = scratch_dir(spark, "test-archives")
    warc.write_archives(pages_of(spark, *told), place, records_per_file=9)
    got = warc.read_archives(spark, place).collect()
    smallest = {}
    for i, _, html in told:
        if i is not None:
            smallest[html or ""] = min(i, smallest.get(html or "", i))
    want = []
    for i, _, html in told:
        raw = (html or "").encode()
        of = smallest.get(html or "")
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if of is None or of == i else "revisit", None if of is None or of == i else of))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert warc.candidates(spark, place).count() > len(told)


def test_small_payloads_are_not_revisited_below_the_bound(spark):
    place = scratch_dir(spark, "test-archives")
    warc.write_archives(pages_of(spark, (1, "", "abc"), (2, "", "abc"), (3, "", "abcdef"), (4, "", "abcdef")), place, 5)
    assert {(r.page_id, r.record_type) for r in warc.read_archives(spark, place).collect()} == {
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")}


def test_no_pages(spark):
    place = scratch_dir(spark, "test-archives")
    warc.write_archives(pages_of(spark), place)
    assert warc.read_archives(spark, place).count() == 0


def told_domains(spark, documents):
    rows, labels = [], []
    for k in range(600):
        domain = ("good", "low", "toxic")[(k % 10 > 6) + (k % 10 > 8)]
        own = {"good": [], "low": ["buy", "cheap", "now"], "toxic": ["fool", "oaf"]}[domain]
        rows.append((k, " ".join(words(60, k, 400) + own)))
        labels.append((k, domain))
    return rows, spark.createDataFrame(labels, "doc_id bigint, domain string")


def test_rates_meet_the_targets_and_follow_the_domains(spark, documents):
    rows, labels = told_domains(spark, documents)
    docs = documents(*rows)
    held = labels.filter("doc_id % 3 = 0")
    mixed = mixing.mix(docs, labels.filter("doc_id % 3 <> 0"), {"good": 0.9, "low": 0.08, "toxic": 0.02})
    found = mixed.join(held, "doc_id").collect()
    right = sum(mixing.DOMAINS[int(np.argmax(r.posterior))] == r.domain for r in found)
    assert right > 0.9 * len(found)
    totals = mixed.agg(*[F.sum(F.get("posterior", F.lit(d)) * F.col("rate") * F.col("tokens")).alias(str(d)) for d in range(3)]).first()
    share = np.array(totals) / sum(totals)
    assert np.allclose(share, [0.9, 0.08, 0.02], atol=0.002)
    kept = {r.doc_id for r in mixed.collect() if r.copies == 1}
    assert sum(i in kept for i in range(600) if i % 10 < 7) > 0.97 * 420


def test_targets_that_cannot_be_met_are_reported(spark, documents):
    rows, labels = told_domains(spark, documents)
    docs = documents(*[r for r in rows if r[0] % 10 < 7])
    targets = {"good": 0.5, "low": 0.25, "toxic": 0.25}
    mixed = mixing.mix(docs, labels, targets, most=3).collect()
    assert all(0 <= r.rate <= 3 for r in mixed)
    _, _, miss, _ = mixing.fitted(docs, labels, targets, "good", 3)
    assert -miss[1] > 0 and -miss[2] > 0


def test_the_written_mix_meets_targets_of_common_and_rare_domains(spark, documents):
    """Domains of 90, 10, 1 and 0.1 parts: totals of the rows written, as shares of the targets."""
    names, rows, labels = ("good", "low", "odd", "toxic"), [], []
    for k in range(12_000):
        domain = names[(k % 10 == 9) + (k % 100 == 95) * 2 + (k % 1000 == 391) * 3]
        rows.append((k, " ".join([*words(40, k, 400), *[f"{domain}{k % 3}"] * 3])))
        labels.append((k, domain))
    docs, told = documents(*rows), spark.createDataFrame(labels, "doc_id bigint, domain string")
    assert [sum(d == n for _, d in labels) for n in names] == [10_668, 1200, 120, 12]
    targets = {"good": 0.9, "low": 0.06, "odd": 0.03, "toxic": 0.0004}
    weights, _, miss, _ = mixing.fitted(docs, told, targets, "good")
    written = mixing.mixed_documents(docs, told, targets)
    assert written.columns == docs.columns
    got = mixing.posteriors(written, weights).agg(*[F.sum(F.get("posterior", F.lit(d)) * F.col("tokens")) for d in range(4)]).first()
    share = np.array(got) / got[0] * 0.9
    assert np.allclose(share[:3], [0.9, 0.06, 0.03], rtol=0.07) and abs(share[3] - 0.0004) < 0.00035
    clean = {k for k, domain in labels if domain == "good"}
    assert len({r.doc_id for r in written.collect()} & clean) > 0.95 * len(clean)


def test_rows_with_one_id_are_mixed_apart(spark, documents, monkeypatch):
    rows, labels = told_domains(spark, documents)
    parts = mixing.fitted(documents(*rows), labels, {"good": 0.96, "low": 0.03, "toxic": 0.01}, "good")
    monkeypatch.setattr(mixing, "fitted", lambda *a: parts)
    left = {r.text for r in mixing.mixed_documents(documents(*[(7, text) for _, text in rows]), labels).collect()}
    good = {text for i, text in rows if i % 10 < 7}
    assert len(left & good) > 0.9 * len(good) and len(left - good) < 0.3 * (len(rows) - len(good))


def test_mixing_takes_odd_rows_and_empty_tables(spark, documents):
    _, labels = told_domains(spark, documents)
    docs = documents(*ODD)
    assert mixing.mix(docs, labels).count() == len(ODD)
    assert mixing.mixed_documents(docs, labels).columns == docs.columns
    assert mixing.mix(documents(), labels).count() == 0
    assert {r.rate for r in mixing.mix(documents((1, "a b"), (2, "c")), labels.filter("false")).collect()} != set()
