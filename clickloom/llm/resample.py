"""Importance resampling towards a target collection of texts.

1. Features are runs of 1 to ``GRAM`` words (A-Z lower-cased), hashed into ``BUCKETS`` buckets. How often each bucket
   occurs in the documents and in the target texts is counted over all rows; the two tables of counts have
   ``BUCKETS`` numbers whatever the input, and so has the table of gains made of them.
2. A document's weight is the mean gain of its features, looked up and summed as arrays, a chunk of texts at once.
   Gumbel noise from the hashed id is added, so the highest scores are a draw without replacement.
3. The draw is a selection, not a sort. Keys (score, doc_id, ...) are written once. In every round each task gives the
   median of its remaining keys and how many there are. The median of those medians, each weighted by its task's
   remaining keys, has at least a quarter of all remaining keys on either side, so every round discards at least that
   guaranteed part, until the cutoff key itself is found. One row per task reaches the driver.
4. Only the winners are sorted, by ranges; a rank is a row's place in its range plus the sizes of the ranges before.

Keys end with a row number, so no two are equal and repeated rows never meet in one task as a group.

Defined cases: a null or empty text has no features and weight 0; a long text is taken whole; a null ``doc_id`` draws
noise for the empty id, is passed through and loses ties; repeated rows count each and may be drawn each; equal scores go
to the smaller doc_id, then to fewer features; no target texts leave every bucket its smoothed gain; other columns are never
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.text import chunks, gram_places, strings, text_bytes
from clickloom.session import scratch_dir

#: Fixed values of the draw.
BUCKETS, GRAM, SEED = 10_000, 1, 2024
LEAST_WORDS, PERCENT = 20, 10
#: Longer words are hashed one by one.
LONG = 48

_FEATURE = np.zeros(256, dtype=bool)
_FEATURE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of each text so far, gone on over ``size`` bytes from ``start``: all texts a byte at a time."""
    state = ~state
    order = np.argsort(-size, kind="stable")
    sizes, long = size[order], int(np.searchsorted(-size[order], -LONG, side="left"))
    for i in order[:long].tolist():
        state[i] = ~np.uint32(zlib.crc32(data[start[i]:start[i] + size[i]].tobytes(), int(~state[i])))
    rest, sizes = order[long:], sizes[long:]
    now, at = state[rest], start[rest]
    for k in range(int(sizes.max(initial=0))):
        live = int(np.searchsorted(-sizes, -k, side="left"))
        now[:live] = _CRC[(now[:live] ^ data[at[:live] + k]) & 255] ^ (now[:live] >> np.uint32(8))
    state[rest] = now
    return ~state


def features(texts: pa.Array, gram: int = GRAM, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the number of the text it is in, and each text's number of words."""
    data, at = text_bytes(texts)
    data = _LOWER[data]
    inside = np.append(_FEATURE[data], False)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.append(False, inside[:-1])
    start = np.flatnonzero(inside & (~before | edge))
    stop = np.flatnonzero(before & (~inside | edge))
    first = np.searchsorted(start, at)
    crc = _advance(np.zeros(len(start), np.uint32), data, start, stop - start)
    found = [(crc, np.repeat(np.arange(len(texts)), np.diff(first)))]
    blank = np.full(1, 0x20, np.uint8)
    for size in range(2, gram + 1):
        head, owner = gram_places(first, size)
        # a run goes on from the run one word shorter, over a space and the next word
        shorter = found[-1][0]
        if size == 2:
            run = shorter[head]
        else:
            heads, _ = gram_places(first, size - 1)
            run = shorter[np.searchsorted(heads, head)]
        run = _advance(run.copy(), blank, np.zeros(len(head), np.int64), np.ones(len(head), np.int64))
        last = head + size - 1
        found.append((_advance(run, data, start[last], (stop - start)[last]), owner))
    keys = np.concatenate([c for c, _ in found]).astype(np.int64) % buckets
    return keys, np.concatenate([o for _, o in found]), np.diff(first)


def bucket_counts(texts: DataFrame, gram: int = GRAM, buckets: int = BUCKETS) -> np.ndarray:
    """How many features all texts of the column ``text`` have in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for chunk in chunks(batches):
            total += np.bincount(features(strings(chunk["text"]), gram, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a text's weight, in thousandths of the log ratio of shares."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the hashed id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def weighed(docs: DataFrame, table: np.ndarray, gram: int = GRAM) -> DataFrame:
    """Per row doc_id, n_features, n_words and weight."""
    packed, buckets = table.astype("<i8").tobytes(), len(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.frombuffer(packed, "<i8")
        for chunk in chunks(batches):
            keys, owner, n_words = features(strings(chunk["text"]), gram, buckets)
            n = np.bincount(owner, minlength=len(n_words))
            total = np.zeros(len(n_words), np.int64)
            np.add.at(total, owner, gain[keys])
            yield pa.RecordBatch.from_arrays(
                [chunk["doc_id"].combine_chunks(), pa.array(n), pa.array(n_words), pa.array(total // np.maximum(n, 1))],
                ["doc_id", "n_features", "n_words", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_features bigint, n_words bigint, weight bigint")


#: Order of the draw: the first of two keys wins. A row's number makes keys unique.
KEY = ["down", "tie", "n_features", "row"]
_KEY_TYPES = ", ".join(f"{name} bigint" for name in KEY)


def _keys(columns: list[str] = KEY) -> list[Column]:
    return [F.col(name) for name in columns]


def before(key: tuple[int, ...], strictly: bool = True) -> Column:
    """Whether a row's key comes before ``key`` in the order of the draw."""
    row, given = F.struct(*_keys()), F.struct(*[F.lit(x).cast("bigint").alias(n) for n, x in zip(KEY, key, strict=True)])
    return row < given if strictly else row <= given


def _median(rows: np.ndarray) -> list[int | None]:
    """The lower median of keys given as columns, by selection within the leading column."""
    if not len(rows[0]):
        return [None] * len(KEY)
    k = (len(rows[0]) - 1) // 2
    for depth in range(len(KEY)):
        value = np.partition(rows[depth], k)[k]
        k -= int((rows[depth] < value).sum())
        rows = rows[:, rows[depth] == value]
    return [int(x[0]) for x in rows]


def cutoff(keys: DataFrame, wanted: int) -> tuple[int, ...] | None:
    """The key with exactly ``wanted`` - 1 keys before it; None if there are not so many keys.

    One job a round: with the pivot at hand each task counts its keys before and after it and gives the median of both
    parts, so the next pivot is known whichever part is discarded.
    """
    if wanted < 1:
        return None
    low, high, pivot = None, None, None    # remaining keys lie between low and high, both excluded

    def run_with(pivot: tuple[int, ...] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [np.stack([b.column(c).to_numpy() for c in range(len(KEY))]) for b in batches if b.num_rows]
            rows = np.concatenate(parts, axis=1) if parts else np.zeros((len(KEY), 0), np.int64)
            below = np.zeros(rows.shape[1], bool)
            equal = np.ones(rows.shape[1], bool)
            if pivot is None:
                equal[:] = False
            else:
                for column, value in zip(rows, pivot, strict=True):
                    below |= equal & (column < value)
                    equal &= column == value
            above = ~below & ~equal
            sides = [(int(side.sum()), _median(rows[:, side])) for side in (below, above)]
            flat = [x for n, median in sides for x in (n, *median)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in flat], _ROUND)
        return run

    while True:
        rest = keys
        if low is not None:
            # the leading column alone reaches the files' statistics
            rest = rest.where((F.col("down") >= low[0]) & ~before(low, strictly=False))
        if high is not None:
            rest = rest.where((F.col("down") <= high[0]) & before(high))
        parts = rest.select(*_keys()).mapInArrow(run_with(pivot), ", ".join(f"{c} bigint" for c in _ROUND)).collect()
        n_before = sum(p["b_n"] for p in parts)
        if pivot is not None and wanted == n_before + 1:
            return pivot
        if pivot is not None and wanted <= n_before:
            high, side = pivot, "b"
        else:
            wanted -= n_before + (pivot is not None)
            low, side = pivot, "a"
        medians = sorted((tuple(p[f"{side}_{c}"] for c in KEY), p[f"{side}_n"]) for p in parts if p[f"{side}_n"])
        left = sum(n for _, n in medians)
        if wanted > left:
            return None
        seen = 0
        for median, n in medians:
            seen += n
            if 2 * seen >= left:
                pivot = median
                break


_ROUND = [f"{side}_{name}" for side in "ba" for name in ("n", *KEY)]


def ranked(rows: DataFrame) -> DataFrame:
    """All rows with ``rank`` 1, 2, 3 ... by :data:`KEY`: sorted by ranges, numbered within each."""
    spark, place = rows.sparkSession, scratch_dir(rows.sparkSession, "winners")
    rows.orderBy(*_keys()).withColumn("__at", F.monotonically_increasing_id()).write.parquet(place)
    stored = spark.read.parquet(place)
    part, at = F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a range
    first, done = [], 0
    for row in sorted(sizes, key=lambda r: r["__part"]):
        first.append((row["__part"], done))
        done += row["n"]
    offsets = spark.createDataFrame(first, "__part bigint, __first bigint")
    numbered = stored.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return numbered.withColumn("rank", F.col("__first") + at + 1).drop("__at", "__part", "__first")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
              gram: int = GRAM, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row doc_id, n_features, n_words, weight, score and, for the drawn part of long enough texts, rank."""
    spark, place = docs.sparkSession, scratch_dir(docs.sparkSession, "resample-keys")
    table = gains(bucket_counts(docs, gram, buckets), bucket_counts(target, gram, buckets))
    rows = weighed(docs, table, gram).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = rows.select("*", (-F.col("score")).alias("down"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    rows.sortWithinPartitions("down").write.parquet(place)
    stored = spark.read.parquet(place)
    able = stored.where(F.col("n_words") >= least_words)
    last = cutoff(able, percent * able.count() // 100)
    out = ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    if last is None:
        return stored.withColumn("rank", F.lit(None).cast("bigint")).select(*out)
    drawn = able.where((F.col("down") <= last[0]) & before(last, strictly=False))
    lost = stored.where((F.col("n_words") < least_words) | ~before(last, strictly=False))
    return ranked(drawn).select(*out).unionByName(lost.withColumn("rank", F.lit(None).cast("bigint")).select(*out))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 in SQL: a table of 256 remainders, then one look-up a byte, once per distinct word.
OP11_SQL = r"""
WITH crc_table AS (
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1
      THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS r FROM range(256) AS x(i))),
docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
marks AS (SELECT unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
used AS (SELECT row, unnest(words) AS word FROM docs),
names AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM used UNION SELECT word FROM marks)),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
    lambda i: ('0x' || substr(h, i, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])),
    4294967295::BIGINT) % 10000 AS bucket FROM names, crc_table),
s AS (SELECT bucket, count(*) AS n FROM used JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM marks JOIN hashed USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s)::DOUBLE + 10000)
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT row, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM used JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296::DOUBLE)))::BIGINT AS score FROM docs LEFT JOIN weights USING (row)),
placed AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20
    ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank FROM placed
"""
