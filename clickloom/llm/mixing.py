"""Soft-membership mixing: document rates whose expected domain totals match targets.

1. A classifier is fitted on a labelled table (doc_id, domain): hashed words, present or not, in a
   softmax regression. The sample is bounded: the ``SAMPLE`` labelled documents with the smallest
   hashed ids. The weights are ``BUCKETS`` times the number of domains, whatever the input.
2. Every document gets the probability of each domain, so it belongs to all of them in part, and its tokens
   count towards each domain in that proportion.
3. Rates are found by projected gradient descent on the squared distance between expected domain totals and
   targets, over rates of at least 0. One step is a pass over the documents for the totals (one number
   per domain) and the same update in every row. The gradient is scaled by the inverse of the domains' Gram
   matrix over rates above 0, damped by a part of each domain's own entry, so that a rare domain moves as fast as a
   common one; a step that makes the miss larger is halved. Starting at rate 1 keeps rates near 1. Steps go on until targets
   are met or no step brings them nearer; what is still missing then is returned. A rate after k steps follows from the k
   vectors before it, so no state is carried between steps.

Targets are weights; the total is chosen so that the domain ``keep`` stays at its expected size, so
its documents keep rates near 1. A document's copies are its rate rounded up or down by chance, the chance being the
fraction, drawn from a hash of its id and text; rates within ``NEAR_ONE`` of 1 are one copy. So domains keep their totals in the
written mix but for that, however alike their documents' rates are.

Defined cases: a null or empty text has no tokens and no words; its posterior is the model's prior
answer and its rate says nothing about totals; a null doc_id is passed through; repeated rows count each and are rounded
alike if id and text are equal; with no labelled documents all domains are equally likely; domains without a target keep weight 0; other columns are
never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.text import chunks, find_words, strings
from clickloom.session import scratch_dir

#: Bounds of the classifier: labelled documents fitted on, and hashed words.
SAMPLE = 12_000
BUCKETS = 1 << 15
EPOCHS, BATCH, LEAST_STEPS, RATE = 30, 256, 800, 0.1
#: What pulls a weight to 0 per step at a full sample. The pull is a prior on the weights, whose strength against all labelled
#: rows together is the same however many there are, so that few rows are not learnt by heart.
DECAY = 1e-4
#: Totals this close to their targets are met. The descent ends too when PATIENCE steps together gain less than a thousandth;
#: STEPS is a stop for the unforeseen, and the miss is returned.
CLOSE, PATIENCE, STEPS = 1e-6, 4, 200
#: The part of a domain's own Gram entry that damps its steps.
DAMPING = 0.05
NEAR_ONE = 0.05

DOMAINS = ("good", "low", "toxic")
#: The mix that the query and the pipeline ask for.
TARGETS = {"good": 0.98, "low": 0.015, "toxic": 0.005}


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashed words of each text end to end, their bounds, and each text's word count."""
    words = find_words(texts, lower=True)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    keys = np.unique(owner * BUCKETS + (words.hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
    return keys % BUCKETS, np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS), words.counts


def training_rows(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(domain, features) of the sample: whole texts, as distinct hashed words."""
    named = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), "domain").dropna().distinct()
    # the sample is chosen by id alone, before any text is moved
    chosen = named.orderBy(F.xxhash64("doc_id", "domain"), "doc_id", "domain").limit(sample)
    chosen = chosen.select(F.col("doc_id").alias("__id"), F.col("domain").alias("__domain"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("__doc"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select(F.col("__domain").alias("domain"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            keys, bounds, _ = hashed_words(strings(chunk["text"]))
            raw, at = keys.astype("<u2").tobytes(), (bounds * 2).tolist()
            yield pa.RecordBatch.from_arrays(
                [chunk["domain"].combine_chunks(), pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary())],
                ["domain", "features"])

    return rows.mapInArrow(run, "domain string, features binary").orderBy(F.xxhash64("features"), "domain").limit(sample)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def score(weights: np.ndarray, keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The scores of texts given by their distinct words; the last row of weights is the bias."""
    size = np.diff(bounds)
    sums = np.zeros((len(size), weights.shape[1]))
    for d in range(weights.shape[1]):
        sums[:, d] = np.diff(np.append(0.0, np.cumsum(weights[keys, d]))[bounds])
    return sums + weights[-1]


def fit_classifier(rows: list, domains: tuple[str, ...] = DOMAINS) -> np.ndarray:
    """Softmax regression with a prior, by adaptive gradient steps over small batches, in a fixed order."""
    weights = np.zeros((BUCKETS + 1, len(domains)))
    rows = [r for r in rows if r["domain"] in domains]
    if not rows:
        return weights
    features = [np.frombuffer(r["features"], "<u2").astype(np.int64) for r in rows]
    want = np.eye(len(domains))[[domains.index(r["domain"]) for r in rows]]
    share = want.mean(axis=0) + 1 / len(rows)
    weights[-1] = np.log(share / share.sum())
    # a class counts by the square root of its rarity
    cost = 1 / np.sqrt(want @ share * len(domains))
    past, chooser = np.full_like(weights, 1e-8), np.random.default_rng(0)
    decay = DECAY * SAMPLE / len(rows)
    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // len(rows))):
        order = chooser.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            batch = order[at:at + BATCH]
            bounds = np.append(0, np.cumsum([len(features[i]) for i in batch]))
            keys = np.concatenate([features[i] for i in batch])
            error = (softmax(score(weights, keys, bounds)) - want[batch]) * cost[batch, None] / len(batch)
            spread = np.repeat(error, np.diff(bounds), axis=0)
            touched, place = np.unique(keys, return_inverse=True)
            slope = np.stack([np.bincount(place, spread[:, d], len(touched)) for d in range(len(domains))], 1)
            slope += decay * weights[touched]
            past[touched] += slope ** 2
            weights[touched] -= RATE * slope / np.sqrt(past[touched])
            bias = error.sum(axis=0)
            past[-1] += bias ** 2
            weights[-1] -= RATE * bias / np.sqrt(past[-1])
    return weights


def _model(weights: np.ndarray):
    """Word counts and domain probabilities of the texts of a column, by weights sent with the task."""
    packed, width = weights.astype("<f4").tobytes(), weights.shape[1]

    def judge(texts: pa.Array) -> list[pa.Array]:
        model = np.frombuffer(packed, "<f4").reshape(-1, width).astype(float)
        keys, bounds, tokens = hashed_words(strings(texts))
        p = softmax(score(model, keys, bounds))
        return [pa.array(tokens), pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * width), pa.array(p.ravel()))]

    return judge


def dice(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1, the same for the same id and text."""
    return (F.pmod(F.xxhash64(doc_id.cast("bigint"), text.cast("string")), F.lit(1 << 24)) + 0.5) / (1 << 24)


def posteriors(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per row doc_id, dice, tokens (words of the whole text) and the probability of each domain."""
    judge = _model(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield pa.RecordBatch.from_arrays([chunk["doc_id"].combine_chunks(), chunk["dice"].combine_chunks(), *judge(chunk["text"])],
                                             ["doc_id", "dice", "tokens", "posterior"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), dice(F.col("doc_id"), F.col("text")).alias("dice"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, dice double, tokens bigint, posterior array<double>")


def rate_after(steps: list[np.ndarray], most: float | None = None, posterior: str = "posterior") -> Column:
    """The rate of a row after the steps so far: each moves along the posterior, then cuts at 0, and at ``most`` if given."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in z]) for z in steps])
    width = len(steps[0])

    def step(rate, z):
        move = sum((F.get(posterior, F.lit(d)) * F.get(z, F.lit(d)) for d in range(width)), F.lit(0.0))
        moved = F.greatest(F.lit(0.0), rate - move)
        return moved if most is None else F.least(moved, F.lit(float(most)))

    return F.aggregate(moves, F.lit(1.0), step)


def copies_of(rate: Column, chance: Column) -> Column:
    """A rate as a number of copies whose expectation it is; rates near 1 are 1."""
    return F.when(F.abs(rate - 1) <= NEAR_ONE, 1).otherwise(F.floor(rate + chance)).cast("bigint")


def fit_rates(rows: DataFrame, targets: np.ndarray, most: float | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Steps of projected gradient descent towards the target totals, one small aggregate each, and the miss that is left."""
    width, steps = len(targets), []
    p = [F.get("posterior", F.lit(d)) for d in range(width)]
    tokens = F.col("tokens").cast("double")
    past: list[float] = []
    best: tuple[float, list[np.ndarray], np.ndarray] | None = None
    for _ in range(STEPS):
        state = rows.select(tokens.alias("t"), rate_after(steps, most).alias("r"), *[x.alias(f"p{d}") for d, x in enumerate(p)])
        inside = F.col("r") > 0 if most is None else (F.col("r") > 0) & (F.col("r") < most)
        free = F.when(inside, F.col("t")).otherwise(0.0)
        sums = state.agg(
            *[F.sum(F.col("r") * F.col("t") * F.col(f"p{d}")).alias(f"e{d}") for d in range(width)],
            *[F.sum(free * F.col(f"p{d}") * F.col(f"p{e}")).alias(f"g{d}_{e}") for d in range(width) for e in range(d, width)]).first()
        miss = np.array([sums[f"e{d}"] or 0.0 for d in range(width)]) - targets
        # a rare domain's miss counts against its own target
        far = float(np.abs(miss / np.maximum(targets, CLOSE * max(targets.sum(), 1.0))).max())
        if best is not None and far > best[0] and len(past) and past[-1] == best[0]:
            steps = [*best[1], (steps[-1] / 2)]   # too long a step: half of it
            past.append(far)
        else:
            if best is None or far < best[0]:
                best = (far, list(steps), miss)
            past.append(far)
            gram = np.array([[sums[f"g{min(d, e)}_{max(d, e)}"] or 0.0 for e in range(width)] for d in range(width)])
            floor = np.maximum(np.diag(gram), 1e-9 * max(np.diag(gram).max(), 1.0))
            steps = [*steps, np.linalg.solve(gram + DAMPING * np.diag(floor), miss)]
        if far <= CLOSE or len(past) > PATIENCE and min(past[-PATIENCE:]) > 0.999 * min(past[:-PATIENCE]):
            break
    return best[1], best[2]


def fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], keep: str,
           most: float | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, DataFrame]:
    """The classifier's weights, the steps of the rates, the miss left of each target, and the rows with their posteriors."""
    spark, domains = docs.sparkSession, tuple(targets)
    weights = fit_classifier(training_rows(docs, labelled).collect(), domains)  # at most SAMPLE rows
    place = scratch_dir(spark, "posteriors")
    posteriors(docs, weights).write.parquet(place)
    rows = spark.read.parquet(place)
    at = domains.index(keep)
    size = rows.agg(F.sum(F.get("posterior", F.lit(at)) * F.col("tokens"))).first()[0] or 0.0
    wanted = np.array([targets[d] for d in domains]) / targets[keep] * size
    steps, miss = fit_rates(rows, wanted, most)
    return weights, steps, miss, rows


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, keep: str = "good",
        most: float | None = None) -> DataFrame:
    """Per row doc_id, tokens, posterior, rate and copies; no rate is above ``most``, if that is given."""
    _, steps, _, rows = fitted(docs, labelled, targets, keep, most)
    rows = rows.withColumn("rate", rate_after(steps, most))
    return rows.select("doc_id", "tokens", "posterior", "rate", copies_of(F.col("rate"), F.col("dice")).alias("copies"))


def domain_labels(labels: DataFrame) -> DataFrame:
    """The labels table as domains."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, keep: str = "good",
                    most: float | None = None) -> DataFrame:
    """The documents as often as their copies say, all columns as they came.

    A rate follows from a row's own text, so rows are judged where they are: no text is shuffled, and rows that share an id
    are told apart.
    """
    weights, steps, _, _ = fitted(docs, labelled, targets, keep, most)
    judge = _model(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            columns = [chunk[c].combine_chunks() for c in chunk.column_names]
            yield pa.RecordBatch.from_arrays([*columns, judge(chunk["text"])[1]], [*chunk.column_names, "__posterior"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__posterior", T.ArrayType(T.DoubleType()))])
    judged = docs.mapInArrow(run, schema)
    times = copies_of(rate_after(steps, most, "__posterior"), dice(F.col("doc_id"), F.col("text")))
    many = judged.withColumn("__copies", times).where("__copies > 0")
    many = many.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
    return many.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    mixed = mix(docs, domain_labels(labels))
    return mixed.select("doc_id", "tokens", *[F.get("posterior", F.lit(d)).alias(f"p_{name}") for d, name in enumerate(DOMAINS)],
                        "rate", "copies")
