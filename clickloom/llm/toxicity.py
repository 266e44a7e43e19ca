"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

1. *Lexicons.* From a bounded sample of labelled rows (``SAMPLE``; near copies of one text count once) every word and every
   stem (a word's first 4, 5 or 6 letters) gets its log odds of occurring in toxic texts; entries whose odds are high
   beyond doubt make up word and stem lexicons.
2. *Voters.* Each lexicon votes toxic if it finds an entry; pattern voters look at how many entries there are, how dense, whether
   someone is addressed, at capitals and shouting; one voter votes clean on longer texts without any entry. All else abstains.
   There are ``len(VOTERS)`` voters, so at most 2 ** 13 patterns of votes however many documents.
3. *Label model.* Votes of one document depend on its class and on each other: stems overlap with words, density with number.
   So the model is a tree per class: the voters joined by the greatest conditional mutual information, every voter's
   rates given its parent's vote and the class. Expectation-maximisation fits it to the counted patterns of all rows that
   may be learnt from; rows of the labelled sample have their class given and weigh as much as the others together.
4. *Classifier.* A logistic regression over hashed words and stems, sparse by a penalty, learns the posteriors of a bounded sample
   (``SAMPLE`` rows of each verdict, near copies once, and the labelled sample, whose label is one more vote). It scores whole
   texts; voters, labels, ids, languages and sources have no part in a score.

Texts are read four times; only votes (an integer a row) are stored for all of them, and nothing grows on the driver.

Defined cases: a null or empty text has the score of no features; a null ``doc_id`` counts as the empty id, which is held out;
repeated rows are scored alike and all returned; an id with both labels is learnt as both; long texts are taken whole; without labels
nothing is toxic; other columns are never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.text import CHUNK_BYTES, _powers_to, chunks, gram_hashes, gram_places, mix, strings, text_bytes
from clickloom.session import scratch_dir

#: Bounds: rows of a sample for each verdict, entries of all lexicons, buckets of hashed features.
SAMPLE, ENTRIES, BUCKETS = 4_000, 4_000, 1 << 17
#: Labels are learnt from rows whose hashed id leaves another remainder than 0.
FOLDS = 5
STEMS = (4, 5, 6)
#: An entry's odds are at least this many times higher in toxic texts, by DOUBT standard errors.
ODDS, DOUBT = 4.0, 2.0
#: Words that address someone, in the languages of the texts.
ADDRESS = ("you", "your", "youre", "du", "dich", "dir", "dein", "ihr", "tu", "te", "toi", "ton", "vous", "votre", "usted", "tus")
NEAR = 3

VOTERS = ("words_0", "words_1", "words_2", "words_3", "stems_4", "stems_5", "stems_6", "several", "dense", "addressed",
          "capitals", "shouting", "nothing")
LEXICONS = 7
#: What the votes say before anything is learnt: how often a voter speaks on toxic and on clean texts.
FIRST = {"nothing": (0.1, 0.8), "capitals": (0.06, 0.05), "shouting": (0.06, 0.05)}
USUAL, PRIOR, ROUNDS = (0.4, 0.02), 4.0, 40

EPOCHS, BATCH, RATE, PENALTY = 12, 128, 0.5, 5e-4

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def hash_bytes(raw: bytes, kind: int = 0) -> int:
    """The hash that :class:`Text` gives a word of these bytes, or a stem, whose ``kind`` is its length."""
    data = np.frombuffer(raw, np.uint8)
    return int(_spans(data, np.zeros(1, np.int64), np.full(1, len(data)), kind)[0])


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
    up, down = _powers_to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(8) + np.uint64(kind))


@dataclass
class Text:
    """Words of some texts in small letters: runs of letters, and their stems, as hashes."""

    first: np.ndarray
    hashes: np.ndarray
    stems: dict[int, np.ndarray]
    longer: dict[int, np.ndarray]
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    capitals: np.ndarray
    shouts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @staticmethod
    def of(texts: pa.Array) -> Text:
        raw, at = text_bytes(texts)
        total = lambda marks: np.diff(np.append(0, np.cumsum(marks))[at])
        capitals, shouts = total((raw >= 0x41) & (raw <= 0x5A)), total(raw == 0x21)
        data, at = text_bytes(pc.utf8_lower(texts))
        inside = np.append(_LETTER[data], False)
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[at] = True
        previous = np.append(False, inside[:-1])
        start, end = np.flatnonzero(inside & (~previous | edge)), np.flatnonzero(previous & (~inside | edge))
        letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        place = np.searchsorted(letters, start)
        size = np.searchsorted(letters, end) - place
        stems, longer = {}, {}
        for k in STEMS:
            longer[k] = np.flatnonzero(size >= k)
            some = longer[k]
            stems[k] = _spans(data, start[some], letters[place[some] + k], k)
        return Text(np.searchsorted(start, at), _spans(data, start, end), stems, longer, start, end, data, capitals, shouts)

    def sketch(self) -> np.ndarray:
        """A hash that near copies mostly share: the least of their runs of five words."""
        out = np.full(len(self.counts), (1 << 64) - 1, np.uint64)
        at, owner = gram_places(self.first, 5)
        np.minimum.at(out, owner, gram_hashes(self.hashes, 5)[at] if len(at) else np.zeros(0, np.uint64))
        for k in np.flatnonzero(self.counts < 5).tolist():
            for h in self.hashes[self.first[k]:self.first[k + 1]].tolist():
                out[k] = mix(np.array([out[k] ^ np.uint64(h)], np.uint64))[0]
        return out.view(np.int64)

    def entries(self, k: int) -> list[str]:
        """The distinct words and stems of text ``k``, as lexicons write them."""
        words = {self.data[s:e].tobytes().decode() for s, e in zip(
            self.start[self.first[k]:self.first[k + 1]].tolist(), self.end[self.first[k]:self.first[k + 1]].tolist())}
        return sorted({f"0:{w}" for w in words} | {f"{n}:{w[:n]}" for w in words for n in STEMS if len(w) >= n})

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct hashed words and stems of each text end to end, and their bounds."""
        owner = self.owner
        shift = np.uint64(64 - BUCKETS.bit_length() + 1)
        keys = np.unique(np.concatenate(
            [owner * BUCKETS + (self.hashes >> shift).astype(np.int64)]
            + [owner[self.longer[n]] * BUCKETS + (self.stems[n] >> shift).astype(np.int64) for n in STEMS]))
        return keys % BUCKETS, np.searchsorted(keys, np.arange(len(self.counts) + 1) * BUCKETS)


# ---- lexicons and voters ------------------------------------------------------------------

def lexicon(sample: DataFrame) -> list[tuple[str, float]]:
    """Entries with their log odds, the surest first; at most ``ENTRIES``. ``sample`` has toxic and entries."""
    toxic = F.sum(F.col("toxic")).alias("t")
    size = sample.agg(toxic, F.count(F.lit(1)).alias("n")).first()
    in_toxic, in_clean = size["t"] or 0, size["n"] - (size["t"] or 0)
    counted = sample.select("toxic", F.explode("entries").alias("entry")).groupBy("entry").agg(
        toxic, F.sum(1 - F.col("toxic")).alias("c"))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (in_toxic + 1 - t)) - F.log(c / (in_clean + 1 - c))
    sure = odds - DOUBT * F.sqrt(1 / t + 1 / c)
    chosen = counted.where(F.col("t") > 1).select("entry", odds.alias("odds"), sure.alias("sure"))
    rows = chosen.where(F.col("sure") > float(np.log(ODDS))).orderBy(F.desc("sure"), "entry").limit(ENTRIES).collect()
    return [(r["entry"], r["odds"]) for r in rows]


class Voters:
    """The voters of a lexicon; a text's votes are a number with a bit per voter."""

    def __init__(self, entries: list[str]):
        found: dict[int, list[int]] = {0: [], **{n: [] for n in STEMS}}
        for entry in entries:
            kind, _, word = entry.partition(":")
            found[int(kind)].append(hash_bytes(word.encode(), int(kind)))
        parts = [found[0][k::4] for k in range(4)] + [found[n] for n in STEMS]
        self.lexicons = [np.sort(np.array(part, np.uint64)) for part in parts]
        self.address = np.sort(np.array([hash_bytes(w.encode()) for w in ADDRESS], np.uint64))

    @staticmethod
    def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(values), bool)
        return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values

    def votes(self, text: Text) -> np.ndarray:
        owner, n = text.owner, len(text.counts)
        any_of = lambda words: np.bincount(owner[words], minlength=n) > 0
        hit = np.zeros(len(owner), bool)
        said = []
        for k, known in enumerate(self.lexicons):
            values, words = ((text.hashes, np.arange(len(owner))) if k < 4
                             else (text.stems[STEMS[k - 4]], text.longer[STEMS[k - 4]]))
            words = words[self.among(values, known)]
            hit[words] = True
            said.append(any_of(words))
        hits = np.bincount(owner[hit], minlength=n)
        at = np.flatnonzero(hit)
        kinds = np.unique(np.stack([owner[at].astype(np.uint64), text.hashes[at]]), axis=1)[0].astype(np.int64)
        addressed = np.zeros(n, bool)
        called = np.flatnonzero(self.among(text.hashes, self.address))
        for step in (*range(-NEAR, 0), *range(1, NEAR + 1)):
            near = called + step
            fine = (near >= 0) & (near < len(owner))
            a, b = called[fine], near[fine]
            addressed[owner[a[hit[b] & (owner[a] == owner[b])]]] = True
        letters = np.diff(np.append(0, np.cumsum(text.end - text.start))[text.first])
        said += [np.bincount(kinds, minlength=n) > 1, (hits > 0) & (50 * hits >= text.counts), addressed,
                 (letters > 0) & (10 * text.capitals > 3 * letters), (text.shouts > 0) & (20 * text.shouts > text.counts),
                 (hits == 0) & (text.counts >= 20)]
        return sum(x.astype(np.int64) << k for k, x in enumerate(said))


# ---- label model --------------------------------------------------------------------------

class LabelModel:
    """A tree of voters per class: how often each speaks, given its parent's vote and the class."""

    def __init__(self, unlabelled: dict[int, float], labelled: dict[tuple[int, int], float]):
        """Counts of vote numbers, and of (vote number, class) where the class is known."""
        self.masks = np.array(sorted({*unlabelled, *(m for m, _ in labelled)}), np.int64)
        place = {m: k for k, m in enumerate(self.masks.tolist())}
        self.votes = (self.masks[:, None] >> np.arange(len(VOTERS))) & 1
        free = np.zeros(len(place))
        for m, n in unlabelled.items():
            free[place[m]] += n
        given = np.zeros((2, len(place)))
        for (m, y), n in labelled.items():
            given[y, place[m]] += n
        if given.sum() and free.sum():
            given *= free.sum() / given.sum()
        self.parent = np.full(len(VOTERS), -1)
        first = np.array([FIRST.get(v, USUAL)[::-1] for v in VOTERS])     # rows: voter, columns: class
        self.table = np.repeat(first.T[:, :, None], 2, axis=2)            # class, voter, parent's vote
        self.share = 0.1
        for step in range(ROUNDS if free.sum() + given.sum() else 0):
            toxic = self._posterior()
            weight = given + np.stack([free * (1 - toxic), free * toxic])
            if free.sum():
                self.share = float(np.clip((free * toxic).sum() / free.sum(), 1e-4, 1 - 1e-4))
            if step == ROUNDS // 4:
                self.parent = self._tree(weight)
            self.table = self._rates(weight, first)

    def _rates(self, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        table = np.empty((2, len(VOTERS), 2))
        for j, parent in enumerate(self.parent):
            for up in (0, 1):
                inside = np.ones(len(self.masks), bool) if parent < 0 else self.votes[:, parent] == up
                for y in (0, 1):
                    n, said = weight[y, inside].sum(), (weight[y, inside] * self.votes[inside, j]).sum()
                    table[y, j, up] = (said + PRIOR * first[j, y]) / (n + PRIOR)
        return np.clip(table, 1e-6, 1 - 1e-6)

    def _tree(self, weight: np.ndarray) -> np.ndarray:
        """Each voter's parent in the tree of greatest mutual information within the classes."""
        k = len(VOTERS)
        info = np.zeros((k, k))
        for y in (0, 1):
            all_ = weight[y].sum()
            if not all_:
                continue
            both = np.einsum("m,mi,mj->ij", weight[y], self.votes, self.votes) / all_
            one = np.diag(both)
            for a in (0, 1):
                for b in (0, 1):
                    p = (both if a and b else one[:, None] - both if a else one[None, :] - both if b
                         else 1 - one[:, None] - one[None, :] + both)
                    apart = np.outer(one if a else 1 - one, one if b else 1 - one)
                    fine = (p > 1e-12) & (apart > 1e-12)
                    info += all_ * np.where(fine, p * np.log(np.where(fine, p / np.where(fine, apart, 1), 1)), 0)
        parent, inside = np.full(k, -1), [0]
        while len(inside) < k:
            best = max((info[i, j], -i, -j) for i in inside for j in range(k) if j not in inside)
            parent[-best[2]] = -best[1]
            inside.append(-best[2])
        return parent

    def _posterior(self) -> np.ndarray:
        odds = np.full(len(self.masks), np.log(self.share / (1 - self.share)))
        for j, parent in enumerate(self.parent):
            up = np.zeros(len(self.masks), np.int64) if parent < 0 else self.votes[:, parent]
            for y, sign in ((1, 1), (0, -1)):
                p = self.table[y, j, up]
                odds += sign * np.log(np.where(self.votes[:, j] == 1, p, 1 - p))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def posteriors(self) -> dict[int, float]:
        """The chance of toxicity by vote number."""
        return dict(zip(self.masks.tolist(), self._posterior().tolist(), strict=True))


# ---- classifier ---------------------------------------------------------------------------

def fit_classifier(features: list[np.ndarray], wanted: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression on posteriors, both verdicts weighing the same; adaptive steps with an absolute penalty.

    ``share`` is the part of toxic texts in all of them: the last weight, the bias, is then moved half way to its log odds, so
    that a toxic text missed counts more than a clean one taken for toxic.
    """
    weights = np.zeros(BUCKETS + 1)
    if not len(wanted) or wanted.max() < 0.5:
        weights[-1] = np.log(share / (1 - share)) if len(wanted) else -5.0
        return weights
    mass = np.array([(1 - wanted).sum(), wanted.sum()])
    cost = len(wanted) / 2 * ((1 - wanted) / max(mass[0], 1e-9) + wanted / mass[1])
    past, chooser = np.full(BUCKETS + 1, 1e-6), np.random.default_rng(0)
    size = np.array([len(f) for f in features])
    first, flat = np.append(0, np.cumsum(size)), np.concatenate(features)
    steps = max(EPOCHS, 600 * BATCH // len(wanted))
    for _ in range(steps):
        order = chooser.permutation(len(wanted))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            n = size[batch]
            picks = np.arange(n.sum()) + np.repeat(first[batch] - (np.cumsum(n) - n), n)
            keys, row = flat[picks], np.repeat(np.arange(len(batch)), n)
            score = np.bincount(row, weights[keys], len(batch)) + weights[-1]
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - wanted[batch]) * cost[batch] / len(batch)
            touched, place = np.unique(keys, return_inverse=True)
            slope = np.bincount(place, error[row], len(touched))
            past[touched] += slope ** 2
            pace = RATE / np.sqrt(past[touched])
            moved = weights[touched] - pace * slope
            weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - pace * PENALTY, 0)
            past[-1] += error.sum() ** 2
            weights[-1] -= RATE / np.sqrt(past[-1]) * error.sum()
    weights[-1] += np.log(share / (1 - share)) / 2
    return weights


# ---- over the tables ----------------------------------------------------------------------

def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _described(rows: DataFrame, schema: str, make) -> DataFrame:
    """``rows`` (with a column text) mapped chunk by chunk; ``make`` gives the columns of ``schema`` from a chunk and its words."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=CHUNK_BYTES // 2):
            yield pa.RecordBatch.from_arrays(make(chunk, Text.of(strings(chunk["text"]))), names)

    return rows.mapInArrow(run, schema)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    raw, at = values.astype("<u4").tobytes(), (bounds * 4).tolist()
    return pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary())


def _sampled(docs: DataFrame, chosen: DataFrame, label: str) -> DataFrame:
    """Rows of the documents with a chosen id (at most 2 * SAMPLE ids, column verdict): a row per verdict and sketch, written."""
    spark, place = docs.sparkSession, scratch_dir(docs.sparkSession, label)
    ids = chosen.select(F.col("doc_id").alias("__id"), "verdict")
    rows = _rows(docs).join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).select("verdict", "text")

    def make(chunk, text):
        entries = [text.entries(k) for k in range(chunk.num_rows)]
        return [chunk["verdict"].combine_chunks(), pa.array(text.sketch()), pa.array(entries, pa.list_(pa.string())),
                _binary(*text.features()), strings(chunk["text"])]

    found = _described(rows, "verdict double, sketch bigint, entries array<string>, features binary, text string", make)
    # an id that very many rows repeat leaves a bounded sample all the same
    pick = F.struct(F.xxhash64("features"), "entries", "features", "text")
    once = found.groupBy("verdict", "sketch").agg(F.min(pick).alias("x")).select("verdict", "sketch", "x.entries", "x.features", "x.text")
    once.orderBy(F.xxhash64("sketch"), "verdict").limit(2 * SAMPLE).write.parquet(place)
    return spark.read.parquet(place)


def training_labels(labels: DataFrame) -> DataFrame:
    """Up to ``SAMPLE`` ids of either label that may be learnt from: doc_id and verdict, 1.0 for toxic."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("double").alias("verdict"))
    rows = rows.where(F.col("verdict").isin(0.0, 1.0) & ~held_out(F.col("doc_id"))).distinct()
    return _picked(rows)


def _picked(rows: DataFrame) -> DataFrame:
    parts = [rows.where(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
             for side in (F.col("verdict") >= 0.5, F.col("verdict") < 0.5)]
    return parts[0].unionByName(parts[1])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row doc_id, held_out, score and predicted."""
    spark = docs.sparkSession
    sample = _sampled(docs, training_labels(labels), "labelled")
    entries = [entry for entry, _ in lexicon(sample.select(F.col("verdict").cast("bigint").alias("toxic"), "entries"))]

    def votes(chunk, text):
        return [pa.array(Voters(entries).votes(text))]

    # the votes of all rows that may be learnt from: an integer each
    place = scratch_dir(spark, "votes")
    learnt = _described(_rows(docs.where(~held_out(F.col("doc_id")))), "doc_id bigint, votes bigint",
                        lambda chunk, text: [chunk["doc_id"].combine_chunks(), *votes(chunk, text)])
    learnt.write.parquet(place)
    learnt = spark.read.parquet(place)
    counted = {r["votes"]: float(r["count"]) for r in learnt.groupBy("votes").count().collect()}  # at most 2 ** 13 rows
    given = _described(sample.select("verdict", "text"), "verdict double, votes bigint",
                       lambda chunk, text: [chunk["verdict"].combine_chunks(), *votes(chunk, text)])
    given = {(r["votes"], int(r["verdict"])): float(r["count"]) for r in given.groupBy("verdict", "votes").count().collect()}
    model = LabelModel(counted, given)
    posterior = model.posteriors()

    table = spark.createDataFrame([(m, p) for m, p in posterior.items()], "votes bigint, verdict double")
    verdicts = learnt.where(F.col("doc_id").isNotNull()).join(F.broadcast(table), "votes").select("doc_id", "verdict")
    judged = _sampled(docs, _picked(verdicts.groupBy("doc_id").agg(F.max("verdict").alias("verdict"))), "judged")
    rows = judged.select("verdict", "features").unionByName(sample.select("verdict", "features"))
    rows = rows.orderBy(F.xxhash64("features"), "verdict").collect()  # at most 4 * SAMPLE rows
    weights = fit_classifier([np.frombuffer(r["features"], "<u4").astype(np.int64) for r in rows],
                             np.array([r["verdict"] for r in rows]), model.share)
    packed = weights.astype("<f4").tobytes()

    def score(chunk, text):
        known = np.frombuffer(packed, "<f4").astype(float)
        keys, bounds = text.features()
        total = np.bincount(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), known[keys], len(bounds) - 1) + known[-1]
        return [chunk["doc_id"].combine_chunks(), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))]

    done = _described(_rows(docs), "doc_id bigint, score double", score)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return scored(docs, labels)
