"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped edges.

1. A document's set is its distinct five-word shingles, as 64-bit hashes. Documents with equal sets
   are one class from here on, stood for by their smallest id, so copies cost one row per task.
2. One hash per shingle: its high bits choose one of ``BINS`` bins, each bin keeps its smallest
   hash, and an empty bin takes the value of the first filled one in an order of its own (optimal
   densification). ``ROWS`` bins make a band; documents that share a band share a bucket.
3. In a bucket every member is compared with one centre only, so candidate edges grow with
   the rows. The centre is the member that shares the most buckets with others: in a family of edited
   copies this is the text the others come from. Links are confirmed on full sets, and components
   of confirmed links are found by contraction.
4. A star may miss a link between two members that are both too far from its centre. So what is
   left goes round again: a bucket is settled when all its members are in one component. The others, put together by their
   first centre B into families, are told apart by their differences from it: m elements of B that a member lacks, e of its own.
   Two members share |B| - m - m' and what they lack both and have both besides, so they are linked only if
   7 (lacked by both + own of both) >= 4 (m + m') + 3 (e + e') - |B|. Most edited copies have own elements that nobody else has, and are ruled
   out by that alone. The rest meet only where they share an own element, or, for links that
   need none, among the few that fit a member shorter than B. These small lists get eight stars, then 64 and so on, each centre
   leaving its list, until every list is settled; nothing is capped. No link between documents that share a bucket is lost.

Whole texts and bucket lists cross no shuffle only to be dropped: bitmaps of the copied sets, the shared buckets and the ids that
have company go to the rows by broadcast, and what they rule out stays where it is (:func:`marked`).

Two documents at the threshold share no bucket with probability (1 - 0.75**4)**32, 5 in a million.

Defined cases: a document without words has no set and is linked with nothing; one of fewer words
than a shingle has its whole sequence as only shingle; a row without doc_id is never linked, its
component_id is null and it is kept; rows that repeat a doc_id are one document, near to
whatever one of their texts is near to, and each is returned with its own text's set; long texts are taken whole; other
columns are never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.packed import among
from clickloom.llm.text import chunks, find_words, gram_hashes, gram_places, mix, strings
from clickloom.session import scratch_dir

SHINGLE = 5
BINS, ROWS = 128, 4
THRESHOLD_PERCENT = 75
#: Bits of a bitmap per key at least, and of all keys at most; more keys than fit let more rows pass, and lose none.
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
#: Rows that one centre's share of a comparing task may have before it is split.
SPLIT = 256

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ORDER = np.stack([np.random.default_rng(b).permutation(BINS) for b in range(BINS)])
_WEIGHTS = mix(np.arange(1, BINS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text end to end, and their bounds."""
    words = find_words(texts, lower=True)
    at, owner = gram_places(words.first, size)
    grams = gram_hashes(words.hashes, size)[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        alone = [gram_hashes(words.hashes[words.first[i]:words.first[i + 1]], int(words.counts[i]))[0] for i in short]
        grams = np.concatenate([grams, np.array(alone, np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((grams, owner)) if len(short) or len(texts) > 1 else np.argsort(grams)
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``BINS`` values per set, all filled; a set must not be empty."""
    count = len(bounds) - 1
    owner = np.repeat(np.arange(count), np.diff(bounds))
    cell = owner * BINS + (grams >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    lowest = np.ones(len(cell), bool)       # sets are sorted, so a bin's first value is its smallest
    lowest[1:] = cell[1:] != cell[:-1]
    sketch = np.full(count * BINS, _EMPTY)
    sketch[cell[lowest]] = grams[lowest]
    sketch = sketch.reshape(count, BINS)
    filled = sketch != _EMPTY
    row, bin_ = np.nonzero(~filled)
    for k in range(BINS):
        if not len(row):
            break
        source = _ORDER[bin_, k]
        hit = filled[row, source]
        sketch[row[hit], bin_[hit]] = sketch[row[hit], source[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return sketch


def bands(sketch: np.ndarray) -> np.ndarray:
    """The bucket of each band, as one 64-bit key that also names the band."""
    mixed = mix(sketch) * _WEIGHTS
    return mix(mixed.reshape(len(sketch), BINS // ROWS, ROWS).sum(axis=2, dtype=np.uint64)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_shingles, the digest of its set, and its buckets (none for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            texts = strings(chunk["text"])
            grams, bounds = shingle_sets(texts)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            keys = bands(signatures(grams, np.append(bounds[some], bounds[-1]))) if len(some) else np.zeros((0, 32), np.int64)
            offsets = np.append(0, np.cumsum(np.where(size > 0, BINS // ROWS, 0))).astype(np.int32)
            raw, at = grams.tobytes(), (bounds * 8).tolist()
            digest = [hashlib.blake2b(raw[a:b], digest_size=16).digest() if b > a else None for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([
                chunk["doc_id"].combine_chunks(), pa.array(size), pa.array(digest, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                ["doc_id", "n_shingles", "digest", "buckets"])

    return _rows(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, buckets array<bigint>")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


class _Store:
    """Intermediate tables in the shared folder; whatever is read again is read from there."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, scratch_dir(spark, "near"), 0

    def __call__(self, frame: DataFrame) -> DataFrame:
        self.n += 1
        place = f"{self.root}/{self.n}"
        frame.write.parquet(place)
        return self.spark.read.parquet(place)


def marked(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows with ``maybe``: true where the column's value is a key, and by chance for one in 16 others at most.

    ``keys`` has the column of that name alone and is read twice. It becomes a bitmap of hashes in pages of 4 KB, 32 MB
    in all at most; where that is too small for the keys, more others are true by chance. A null is a value like any other.
    """
    bits = min(MOST_BITS, max(1 << 15, 1 << (BITS_PER_KEY * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    page, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    pages = keys.groupBy(page.alias("__page")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("__page", page).join(F.broadcast(pages), "__page", "left")
    maybe = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return found.withColumn("maybe", maybe).drop("__page", "__bits")


def classes_of(known: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, buckets) of each class once; only the buckets of sets that may have copies are shuffled."""
    known = marked(known.select(F.col("doc_id").alias("id"), "digest", "buckets"), "digest", ids.filter("n > 1").select("digest"))
    copied = known.filter("maybe").join(ids, ["digest", "id"]).dropDuplicates(["digest", "id"])
    return known.filter("NOT maybe").select("id", "buckets").unionByName(copied.select("id", "buckets"))


def members_of(classes: DataFrame, store: _Store) -> DataFrame:
    """(bucket, id, shared): members of buckets of two or more; shared counts a class's company."""
    members = classes.select("id", F.explode("buckets").alias("bucket"))
    full = store(members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    members = marked(members, "bucket", full.select("bucket")).filter("maybe").drop("maybe")
    members = store(members.join(full, "bucket"))
    shared = members.groupBy("id").agg(F.sum("n").alias("shared"))
    return store(members.join(shared, "id").select("bucket", "id", "shared"))


def stars(members: DataFrame) -> DataFrame:
    """Candidate edges (id, centre) between components, one star per bucket, each edge once."""
    centre = members.groupBy("bucket").agg(F.max(F.struct("shared", (-F.col("id")).alias("id"))).alias("c"))
    near = members.join(centre, "bucket")
    pairs = near.filter(F.col("id") != -F.col("c.id")).select("id", (-F.col("c.id")).alias("centre"))
    return pairs.select(F.greatest("id", "centre").alias("id"), F.least("id", "centre").alias("centre")).distinct()


def families(open_: DataFrame) -> DataFrame:
    """Open buckets with the same first centre as one, so that members who meet in many bands meet once."""
    centre = open_.groupBy("bucket").agg(F.max(F.struct("shared", (-F.col("id")).alias("id"))).alias("c"))
    return (open_.join(centre, "bucket")
            .select((-F.col("c.id")).alias("bucket"), "id", "shared", "component").distinct())


def later_stars(open_: DataFrame, centres: int) -> tuple[DataFrame, DataFrame]:
    """Edges of the next ``centres`` stars of every open list, and what is open without these centres."""
    # the ranking is cut to as many rows per list in each task before it is shuffled
    order = Window.partitionBy("bucket").orderBy(F.desc("shared"), "id", "m", "e")
    chosen = open_.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= centres)
    chosen = chosen.select("bucket", *[F.col(c).alias(f"c_{c}") for c in ("id", "component", "m", "e", "s")])
    pairs = open_.join(chosen, "bucket").filter(
        (F.col("id") != F.col("c_id")) & (F.col("component") != F.col("c_component"))
        & (7 * (F.least("m", "c_m") + F.least("s", "c_s"))
           >= 4 * (F.col("m") + F.col("c_m")) + 3 * (F.col("e") + F.col("c_e")) - F.col("centre_size")))
    edges = pairs.select(F.greatest("id", "c_id").alias("id"), F.least("id", "c_id").alias("centre")).distinct()
    rest = open_.join(chosen.select("bucket", F.col("c_id").alias("id")), ["bucket", "id"], "left_anti")
    return edges, rest


def meetings(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """(centre, part, member, id, text) dealt out by centre, in each part the centre's own text first.

    The join by id fetches the text of either end in one shuffle; texts then meet by centre. A
    centre with many edges is split, its own text going with every part.
    """
    parts = edges.groupBy("centre").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("parts"))
    ends = edges.join(parts, "centre").select(
        "centre", F.pmod(F.hash("id"), "parts").alias("part"), "id")
    heads = parts.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                         F.col("centre").alias("id"))
    wanted = ends.unionByName(heads).join(texts, "id")
    return (wanted.select("centre", "part", (F.col("id") != F.col("centre")).alias("member"), "id", "text")
            .repartition("centre", "part").sortWithinPartitions("centre", "part", "member"))


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, np.ndarray, np.ndarray]]]:
    """Chunk by chunk (id, centre, set, centre's set) of each member that meets its centre."""
    current, head = None, np.zeros(0, np.uint64)
    for chunk in chunks(batches):
        grams, bounds = shingle_sets(strings(chunk["text"]))
        out = []
        rows = zip(*(chunk[c].to_pylist() for c in ("centre", "part", "member", "id")))
        for i, (centre, part, member, id_) in enumerate(rows):
            own = grams[bounds[i]:bounds[i + 1]]
            if not member:
                # rows that repeat the centre's id: any of their texts may be near
                head = own if current != (centre, part) else np.union1d(head, own)
                current = (centre, part)
            elif current == (centre, part):
                out.append((id_, centre, own, head))
        yield out


def confirmed(edges: DataFrame, texts: DataFrame, store: _Store) -> DataFrame:
    """The edges whose full sets are alike enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in met(batches):
            out = [(id_, centre) for id_, centre, own, head in pairs if alike(own, head)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["id", "centre"])

    return store(meetings(edges, texts).mapInArrow(run, "id bigint, centre bigint"))


def differences(family: DataFrame, texts: DataFrame) -> DataFrame:
    """Per member's text what it lacks of its centre's set (``m``), and the elements of its own (``own``, ``e`` of them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in met(batches):
            own = [x[~among(x, head)].view(np.int64) for _, _, x, head in pairs]
            lacks = [len(head) - len(x) + len(o) for (_, _, x, head), o in zip(pairs, own)]
            yield pa.RecordBatch.from_arrays([
                *(pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)), pa.array(lacks, pa.int64()),
                pa.array([len(o) for o in own], pa.int64()), pa.array([len(x[3]) for x in pairs], pa.int64()),
                pa.array(own, pa.list_(pa.int64()))], ["id", "centre", "m", "e", "centre_size", "own"])

    edges = family.filter("id <> bucket").select("id", F.col("bucket").alias("centre"))
    return meetings(edges, texts).mapInArrow(
        run, "id bigint, centre bigint, m bigint, e bigint, centre_size bigint, own array<bigint>")


def lists_of(family: DataFrame, texts: DataFrame, component: DataFrame, store: _Store) -> DataFrame:
    """The lists in which members of a family can still have links: (bucket, id, shared, m, e, s, centre_size).

    ``s`` is how many of a member's own elements any other member has too; 0 in the list for links that need none.
    With g the largest m - e of possible partners, a member has a link only if 4 m + 3 e - |B| <= 3 g + 7 s.
    """
    diff = store(differences(family, texts)
                 .withColumn("row", F.xxhash64("own", "m"))
                 .dropDuplicates(["centre", "id", "row"]))
    own = diff.select("centre", "id", "row", F.explode("own").alias("element"))
    several = own.groupBy("centre", "element").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    own = store(own.join(several, ["centre", "element"]))
    support = own.groupBy("centre", "id", "row").agg(F.count("*").alias("s"))
    label = component.select("id", F.col("component").alias("of"))
    members = (diff.drop("own").join(support, ["centre", "id", "row"], "left").fillna(0, ["s"])
               .join(label, "id").join(label.select(F.col("id").alias("centre"), F.col("of").alias("main")), "centre"))
    members = store(members.join(family.select(F.col("bucket").alias("centre"), "id", "shared"), ["centre", "id"]))
    gap, near = F.col("m") - F.col("e"), F.col("of") == F.col("main")
    most = members.groupBy("centre").agg(F.max(F.when(near, gap)).alias("near_gap"), F.max(F.when(~near, gap)).alias("far_gap"))
    # partners of the centre's component are the others; a far member's are all, the centre with m = e = 0 too
    largest = F.when(near, F.col("far_gap")).otherwise(F.greatest(F.lit(0), "near_gap", "far_gap"))
    rows = members.join(most, "centre").withColumn("room", 3 * largest - 4 * F.col("m") - 3 * F.col("e") + F.col("centre_size"))
    rows = store(rows.filter("room + 7 * s >= 0"))
    columns = ["id", "shared", "m", "e", "s", "centre_size"]
    alone = rows.filter("room >= 0").withColumn("s", F.lit(0).cast("bigint")).select(F.xxhash64("centre").alias("bucket"), *columns)
    meeting = rows.join(own, ["centre", "id", "row"]).select(F.xxhash64("centre", "element").alias("bucket"), *columns)
    return alone.unionByName(meeting)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < THRESHOLD_PERCENT * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= THRESHOLD_PERCENT * (len(a) + len(b) - both)


def components(links: DataFrame, labels: DataFrame, store: _Store) -> DataFrame:
    """(id, component) of every id of ``labels``: the smallest id that links (id, centre) reach.

    Each round points every node at its smallest neighbour, follows pointers to their ends by
    doubling, and contracts the links to the ends; the number of nodes at least halves.
    """
    links = store(links.select(F.col("id").alias("a"), F.col("centre").alias("b")).filter("a <> b"))
    labels = labels.select("id", F.col("id").alias("component"))
    while links.limit(1).count():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).select(F.col("a").alias("id"), "to"))
        while True:
            above = up.select(F.col("id").alias("to"), F.col("to").alias("end"))
            jumped = store(up.join(above, "to").select("id", F.col("to").alias("was"), F.col("end").alias("to")))
            up = jumped.select("id", "to")
            if not jumped.filter("was <> to").limit(1).count():
                break
        ends = up.select(F.col("id").alias("component"), "to")
        labels = store(labels.join(ends, "component", "left")
                       .select("id", F.coalesce("to", "component").alias("component")))
        ends = lambda c: up.select(F.col("id").alias(c), F.col("to").alias(f"{c}_end"))
        links = store(links.join(ends("a"), "a").join(ends("b"), "b").select(
            F.col("a_end").alias("a"), F.col("b_end").alias("b")).filter("a <> b").distinct())
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document n_shingles, component_id (the smallest doc_id reachable) and kept."""
    spark = docs.sparkSession
    store = _Store(spark)
    sketch = store(sketches(docs))
    known = sketch.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    ids = store(known.groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")))
    members = members_of(classes_of(known, ids), store)
    component = store(members.select("id", F.col("id").alias("component")).distinct())
    # of the texts only those are needed again that share a bucket with another; joins by id drop the few others kept
    texts = marked(_rows(docs).withColumnRenamed("doc_id", "id"), "id", component.select("id"))
    texts = store(texts.filter("maybe").drop("maybe"))
    tested, edges, rest, centres = None, stars(members), members, 1
    while True:
        edges = store(edges)
        if edges.limit(1).count():
            # earlier components take part as links of their own: each member to the smallest
            linked = confirmed(edges, texts, store).unionByName(component.select("id", F.col("component").alias("centre")))
            component = components(linked, component, store)
        tested = edges if tested is None else tested.unionByName(edges)
        open_ = store(unsettled(rest, component))
        if not open_.limit(1).count():
            break
        if centres == 1:
            lists = store(lists_of(store(families(open_)), texts, component, store))
            open_ = store(unsettled(lists, component))
        centres *= 8
        edges, rest = later_stars(open_, centres)
        edges = edges.join(tested, ["id", "centre"], "left_anti")
    own = sketch.join(ids.drop("n"), "digest", "left")
    own = own.join(component, "id", "left")
    smallest = F.coalesce("component", "id", "doc_id")
    return own.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), smallest).alias("component_id"),
                      F.coalesce(F.col("doc_id") == smallest, F.lit(True)).alias("kept"))


def unsettled(members: DataFrame, component: DataFrame) -> DataFrame:
    """The members of buckets that hold two or more components."""
    members = members.drop("component").join(component, "id")
    about = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(about.filter("low <> high").select("bucket"), "bucket")


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each component, all columns as they came."""
    kept = near_duplicates(docs).filter("kept").select(F.col("component_id").alias("__kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__kept_id")), "left_semi")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
