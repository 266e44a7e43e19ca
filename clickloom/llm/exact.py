"""Exact dedup against a persistent digest index.

The index is a Parquet table of one row per distinct text, bucketed and sorted by the text's
SHA-256. New documents are reduced to one row per digest, joined against the index by a
sort-merge anti-join that reads the index without a shuffle or sort, and what is new is appended.

Defined cases: a null text is an empty one; a null ``doc_id`` ranks below every number, and of a
group without any number one row stays; rows alike in id and text count one by one in
``group_size``, and one of them stays; other columns are never looked at, so they may have any name.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import scratch_dir


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case, every other letter unchanged."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def digest_of(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """Digests of all texts seen so far, in ``path``. One writer at a time.

    ``buckets`` is fixed when the index is made: about total digests / 2 million.
    """

    SCHEMA = "digest STRING, keep_id BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({self.SCHEMA}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        """The index as plain files: a join may then split a digest that many rows have."""
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def add(self, groups: DataFrame) -> str:
        """Append the groups (digest, keep_id) that the index has not; gives the batch's name."""
        batch = uuid.uuid4().hex
        fresh = (groups.select("digest", "keep_id").repartition(self.buckets, "digest")
                 .hint("merge").join(self.spark.table(self.table).select("digest"), "digest", "left_anti"))
        (fresh.withColumn("batch", F.lit(batch)).sortWithinPartitions("digest").select("digest", "keep_id", "batch")
         .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.table))
        return batch


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Per document its digest, the id that stays, its group's size here, and whether it stays.

    A text that an earlier batch brought stays there, so no row of this batch is kept for it.
    """
    spark = docs.sparkSession
    hashed = scratch_dir(spark, "digests")
    docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                digest_of(F.col("text")).alias("digest")).write.parquet(hashed)
    rows = spark.read.parquet(hashed)
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    batch = index.add(groups)
    state = (groups.select("digest", "group_size")
             .join(index.rows(), "digest")
             .select("digest", "keep_id", "group_size", (F.col("batch") == batch).alias("new")))
    # only rows alike in id and text meet in this window
    again = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy(F.lit(1)))
    return (rows.withColumn("copy", again).join(state, "digest")
            .select("doc_id", "keep_id", "group_size",
                    (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
                     & (F.col("copy") == 1)).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def without_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, all columns as they came.

    A semi-join finds them, so texts cross a shuffle once. Only where rows are alike in id and text too is one of them picked,
    among those rows alone.
    """
    spark, place = docs.sparkSession, scratch_dir(docs.sparkSession, "kept")
    state = deduplicate(docs, index)
    alike = state.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    (alike.filter("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_digest"), "rows")
     .write.parquet(place))
    kept = spark.read.parquet(place)
    own = docs.withColumn("__digest", digest_of(F.col("text")))
    same = (F.col("doc_id").cast("bigint").eqNullSafe(F.col("__kept_id"))
            & (F.col("__digest") == F.col("__kept_digest")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = own.join(kept.filter("rows = 1"), same, "left_semi").select(*columns)
    repeated = kept.filter("rows > 1")
    if repeated.isEmpty():
        return single
    one = own.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "__digest"])
    return single.unionByName(one.select(*columns))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicate(docs, DigestIndex(spark, scratch_dir(spark, "digest-index")))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
