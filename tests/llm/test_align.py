"""Alignment of two vocabularies against a plain version."""

import hashlib
import random
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickloom.llm import align
from tests.llm.conftest import ODD, words

A, B = align.default_vocabularies()


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def plain_ids(models, text):
    """Ids and bytes of both vocabularies, without tokens where the bytes differ from the text."""
    a, b = models
    if not text:
        return [], []
    # the usual printable stand-ins of bytes
    direct = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in direct]
    of = {chr(x): x for x in direct} | {chr(256 + k): x for k, x in enumerate(rest)}
    left = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    same = all(b"".join(x for _, x in side) == want for side in (left, right))
    return (left, right) if same else ([], [])


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(models, rows):
    docs = []
    for doc_id, text in rows:
        left, right = map(spans, plain_ids(models, text))
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        grouped, low = [], 0
        for cut in cuts:
            part = [",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (left, right)]
            grouped.append("|".join(part))
            low = cut
        linked, first = [], 0
        for i, s, e in left:
            while first < len(right) and right[first][2] <= s:
                first += 1
            k = first
            while k < len(right) and right[k][1] < e:
                linked.append((i, right[k][0]))
                k += 1
        digest = hashlib.sha256(";".join(grouped).encode()).hexdigest() if left else ""
        docs.append((doc_id, len(left), len(right), len(cuts), linked, digest))
    count = Counter(pair for d in docs for pair in set(d[4]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    return sorted([(i, n, m, g, len(linked), sum(count[p] == most[p[0]] for p in linked), sum(count[p] for p in linked), digest)
                   for i, n, m, g, linked, digest in docs], key=repr)


TEXTS = [*ODD[:9], (None, "no number here at all"), (20, "a\x00b\x1cc d　e <|endoftext|> <s></s> <unk>"), (21, " lead  two\r\n\ttabs "),
         (22, "x" * 3000), (23, "▁ marks ▁"), (24, "naïve 🙂🙃 zażółć gęślą jaźń 漢字かな"), (25, "́combined é ​﻿"),
         (26, " ".join(words(400, 3))), (27, " ".join(words(400, 3))), (28, "  "), (29, "\n")]


@pytest.mark.parametrize("limit", [align.BROADCAST_PAIRS, 0])
def test_against_a_plain_version(spark, documents, models, limit):
    done = align.scored(documents(*TEXTS).repartition(3), A, B, limit)
    assert sorted(map(tuple, done.collect()), key=repr) == plain(models, TEXTS)


def test_outputs_of_the_operator(spark, documents, models):
    rows = {r.doc_id: r for r in align.alignments(documents((1, "unbelievable tokenizers"), (2, None)), A, B).collect()}
    left, right = plain_ids(models, "unbelievable tokenizers")
    groups = [[list(map(int, side.split(","))) for side in g.split("|")] for g in rows[1].groups.split(";")]
    assert [i for g in groups for i in g[0]] == [i for i, _ in left]
    assert [i for g in groups for i in g[1]] == [i for i, _ in right]
    assert sum(rows[1].times) == rows[1].n_links and rows[2].groups == "" and rows[2].pairs == []


def test_empty_table(spark, documents):
    assert align.scored(documents(), A, B).collect() == []


def test_one_long_group_has_few_links():
    import numpy as np
    # tokens that never end together: n + m - 1 links
    a, b = np.arange(0, 3_000_001, 3), np.append(0, np.arange(1, 3_000_000, 3))
    b = np.append(b, 3_000_000)
    la, lb = align.links(a[:-1], a[1:], b[:-1], b[1:])
    assert len(la) == len(a) + len(b) - 3
    side = np.repeat([0, 1], [len(a) - 1, len(b) - 1])
    assert align.groups(np.append(a[:-1], b[:-1]), np.append(a[1:], b[1:]), side).max() == 0


def test_both_libraries_give_the_same_ids():
    vocabulary, chooser = align.vocabulary(A), random.Random(5)
    assert vocabulary.fast is not None
    signs = [chr(c) for c in range(0x250)] + list(" \n\t'sre012") * 40
    texts = ["".join(chooser.choices(signs, k=chooser.randrange(1, 300))) for _ in range(4000)]
    library = vocabulary.model.encode_batch([f" {t}" for t in texts], add_special_tokens=False)
    assert all(align.OLD.fullmatch(t) for t in texts)
    assert vocabulary.encode(texts) == [e.ids for e in library]
    mixed = [*texts[:5], "漢字 𐐷", "x", "ʼn ɐ"]
    assert vocabulary.encode(mixed) == [e.ids for e in vocabulary.model.encode_batch([f" {t}" for t in mixed], add_special_tokens=False)]
