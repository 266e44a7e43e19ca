"""Encoding, decoding and prefix counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickloom.llm import bpe, prefix
from tests.llm.conftest import ODD

LETTERS = "abcdefghij thes'!.<|>$éÉΣ1\ń "


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def texts():
    chooser = random.Random(4)
    odd = [text or "" for _, text in ODD if len(text or "") < 60_000]
    odd += ["It's I'LL don't 'S !!'s we're 've", "aaaa aaaaaaaaa", "日本語 한국어 ١٢٣ ½²", "👩‍👩‍👧 emoji🏽", "Ǆ ß ẞ ſ K", "1234567 3.14"]
    return odd + ["".join(chooser.choice(LETTERS) for _ in range(chooser.randint(0, 80))) for _ in range(800)]


def test_ids_and_decoded_text_equal_the_library(spark, documents, library, texts):
    rows = list(enumerate(texts)) + [(None, None)]
    got = {r.doc_id: r for r in bpe.digests(documents(*rows), bpe.default_vocabulary()).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_decode_is_the_way_back(documents, library):
    path = bpe.default_vocabulary()
    back = bpe.decode(bpe.encode(documents((1, "Hello, the World"), (2, None)), path), path).collect()
    ids = library.encode("Hello, the World", add_special_tokens=False).ids
    assert {r.doc_id: r.text for r in back} == {1: library.decode(ids, skip_special_tokens=False), 2: ""}


def test_forgetting_changes_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    monkeypatch.setattr(prefix, "MEMORY", 50)
    monkeypatch.setattr(prefix, "PAIRS", 200)
    encoder, counter = bpe.Encoder(bpe.default_vocabulary()), prefix.PrefixCounter(bpe.default_vocabulary())
    for text in texts[:120]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text])[0].tolist() == ids
        assert counter.totals_of([text]).tolist() == [len(ids)]


def test_counts_equal_the_library(documents, library, texts):
    rows = list(enumerate(texts)) + [(None, None)]
    got = {r.doc_id: r for r in prefix.token_counts(documents(*rows), bpe.default_vocabulary(), 20).collect()}
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 20)


def test_words_made_to_share_a_polynomial_hash_are_told_apart(library):
    """Thue-Morse words over two letters and their mirrors, one at a time and together, with all their prefixes."""
    for pair in ("ab", "th", "q!"):
        signs = [bin(k).count("1") % 2 for k in range(2048)]
        made = ["".join(pair[s ^ flip] for s in signs[:n]) for n in (512, 1024, 2048) for flip in (0, 1)]
        together = prefix.PrefixCounter(bpe.default_vocabulary())
        want = [len(library.encode(t, add_special_tokens=False).ids) for t in made]
        assert together.totals_of(made).tolist() == want
        alone = [prefix.PrefixCounter(bpe.default_vocabulary()).totals_of([t]).tolist()[0] for t in made[:2]]
        assert alone == want[:2]


def test_a_last_token_is_taken_only_if_its_bytes_are_there():
    counter, data = prefix.PrefixCounter(bpe.default_vocabulary()), np.frombuffer("the thing, then this\u00e9".encode(), np.uint8)
    spelt = {i: counter.bytes[a:b].tobytes() for i, (a, b) in enumerate(zip(counter.bytes_first, counter.bytes_first[1:]))}
    for length in (1, 2, 3, 4):
        for end in range(length, len(data) + 1):
            tokens = np.arange(counter.bpe.size)
            got = counter._ends_with(tokens, data, np.full(len(tokens), end), length)
            here = data[end - length:end].tobytes()
            assert got.tolist() == [spelt[i] == here for i in tokens.tolist()]


def test_tables_hold_the_count_of_every_prefix(documents, library, texts):
    some = [t for t in texts if len(t) < 400 and "EndOfText" not in t][:150]
    rows = prefix.prefix_tables(documents(*enumerate(some)), bpe.default_vocabulary()).collect()
    for r in rows:
        want = [len(x.ids) for x in library.encode_batch([r.text[:k] for k in range(len(r.text) + 1)], add_special_tokens=False)]
        assert list(r.counts) == want


def test_truncation_asks_the_table(documents):
    tables = prefix.prefix_tables(documents((1, "the thing is here and there"), (2, "")), bpe.default_vocabulary())
    for budget in (0, 1, 3, 100):
        for r in prefix.truncate(tables, budget).collect():
            row = next(x for x in tables.collect() if x.doc_id == r.doc_id)
            best = max(k for k, n in enumerate(row.counts) if n <= budget)
            assert (r.text, r.n_tokens) == (row.text[:best], row.counts[best])


@pytest.mark.parametrize("operator", [bpe.digests, prefix.token_counts, prefix.prefix_tables])
def test_an_empty_table_gives_an_empty_result(documents, operator):
    assert operator(documents(), bpe.default_vocabulary()).count() == 0
