r"""Reply trees to conversations.

Messages form trees: each names its parent. Iterative self-joins, each of which doubles the length
of the jumps, carry the sum of scores from the root down to every message, so that the number of joins
is the logarithm of the depth. Leaves are ranked by the score of their branch, and walking the
same jumps up from a chosen leaf marks its path. Each chosen path is formatted as one conversation.

Template: ``<turn ROLE>`` LF, the text, LF ``</turn>`` LF for each message. In texts and roles a
backslash becomes ``\\``, ``<`` becomes ``\<`` and, in roles, ``>`` becomes ``\>``; so a marker
is the only place where a ``<`` stands without a backslash, and reading back is exact. The loss mask
covers the texts of assistant turns, given as spans (start, length) in code points.

Defined cases: a null text or role is an empty one. A message whose parent is null, missing or
itself is a root. Messages that form a ring have no root and no leaf and are left out, as are rows
without a conversation's number or message's id. Rows that repeat a message's id count once (the one with the greatest fields
stays). Of branches with equal scores the one with the smaller leaf id ranks first. An empty table
gives an empty result. Other columns are never looked at. One conversation is one row, so
it must fit in one; a path is the only thing that is ever gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.text import chunks
from clickloom.session import scratch_dir

#: The added conversation of the query; fixed values.
PROBE_ID, PROBE = -7, "\\### Assistant: </turn> ok"

_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)\n</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder: later steps don't go back beyond it."""
    place = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(place)
    return frame.sparkSession.read.parquet(place)


def nodes_of(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, node_id, parent_id, role, text, score), each id once, roots with a null parent."""
    key = ["conv_id", "node_id"]
    rows = messages.select(
        *[F.col(c).cast("bigint").alias(c) for c in (*key, "parent_id")],
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).dropna(subset=key)
    newest = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in ("score", "text", "role", "parent_id")])
    rows = rows.withColumn("nth", F.row_number().over(newest)).filter("nth = 1").drop("nth")
    there = rows.select(*[F.col(c).alias(f"p_{c}") for c in key])
    near = (F.col("conv_id") == F.col("p_conv_id")) & (F.col("parent_id") == F.col("p_node_id"))
    parent = F.when(F.col("p_node_id") != F.col("node_id"), F.col("p_node_id"))
    return rows.join(there, near, "left").select(*key, parent.alias("parent_id"), "role", "text", "score")


def branch_scores(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Per message its depth and branch score, and the jump tables (1, 2, 4, ... steps up)."""
    active = _stored(nodes.select("conv_id", "node_id", F.col("parent_id").alias("up"), F.col("score").alias("total"),
                                  F.lit(1).cast("bigint").alias("depth")), "branches")
    bound = active.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    ended = active.filter("up IS NULL")
    active, jumps = active.filter("up IS NOT NULL"), []
    # only messages whose jump has not reached the root yet take part; what still jumps
    # beyond the largest conversation's size is part of a ring
    while 2 ** len(jumps) <= 2 * bound and active.limit(1).count():
        jumps.append(active.select("conv_id", "node_id", "up"))
        above = ended.unionByName(active).select(*[F.col(c).alias(f"a_{c}") for c in active.columns])
        step = (F.col("conv_id") == F.col("a_conv_id")) & (F.col("up") == F.col("a_node_id"))
        grown = _stored(active.join(above, step).select(
            "conv_id", "node_id", F.col("a_up").alias("up"), (F.col("total") + F.col("a_total")).alias("total"),
            (F.col("depth") + F.col("a_depth")).alias("depth")), "branches")
        ended = ended.unionByName(grown.filter("up IS NULL"))
        active = grown.filter("up IS NOT NULL")
    return ended.drop("up"), jumps


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The messages of each conversation's ``branches`` best paths, with path_rank and depth."""
    scored, jumps = branch_scores(nodes)
    parents = nodes.filter("parent_id IS NOT NULL").select("conv_id", F.col("parent_id").alias("node_id")).distinct()
    leaves = scored.join(parents, ["conv_id", "node_id"], "left_anti")
    # the order is cut per task before the shuffle; the window sees one group per conversation
    order = Window.partitionBy("conv_id").orderBy(F.desc("total"), "node_id")
    chosen = leaves.withColumn("path_rank", F.row_number().over(order)).filter(F.col("path_rank") <= branches)
    marked = chosen.select("conv_id", "path_rank", "node_id")
    for jump in reversed(jumps):
        step = marked.join(jump, ["conv_id", "node_id"]).select(
            "conv_id", "path_rank", F.col("up").alias("node_id"))
        marked = _stored(marked.unionByName(step).distinct(), "paths")
    return (marked.join(scored.select("conv_id", "node_id", "depth", "total"), ["conv_id", "node_id"])
            .join(nodes.select("conv_id", "node_id", "role", "text"), ["conv_id", "node_id"]))


def _escaped(text: Column, marks: str) -> Column:
    return F.regexp_replace(text, f"[{marks}]", r"\\$0")


def formatted(path: DataFrame) -> DataFrame:
    """One row per conversation and path: the template's text."""
    turn = F.concat(F.lit("<turn "), _escaped(F.col("role"), r"\\<>"), F.lit(">\n"),
                    _escaped(F.col("text"), r"\\<"), F.lit("\n</turn>\n"))
    return (path.select("conv_id", "path_rank", F.struct("depth", turn.alias("turn")).alias("part"))
            .groupBy("conv_id", "path_rank").agg(F.sort_array(F.collect_list("part")).alias("parts"))
            .select("conv_id", "path_rank", F.array_join(F.transform("parts", lambda p: p["turn"]), "").alias("formatted")))


def read_back(text: str) -> tuple[list[tuple[str, str]], list[tuple[int, int]]]:
    """The (role, text) of each turn, and the spans of the loss mask over the formatted text."""
    turns, spans, at = [], [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"not a turn at {at}")
        role, said = (_ESCAPED.sub(r"\1", found[k]) for k in (1, 2))
        turns.append((role, said))
        if role == "assistant":
            spans.append((found.start(2), len(found[2])))
        at = found.end()
    return turns, spans


def parsed(conversations: DataFrame) -> DataFrame:
    """Per formatted conversation its turns and loss spans, read from the text."""
    kind = ("conv_id bigint, path_rank int, formatted string, turns array<struct<role:string,text:string>>, "
            "loss array<struct<start:bigint,length:bigint>>")
    pair = lambda a, b, t: pa.list_(pa.struct([(a, t), (b, t)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "formatted"):
            both = [read_back(x) for x in chunk["formatted"].to_pylist()]
            turns = [[{"role": r, "text": t} for r, t in turns] for turns, _ in both]
            loss = [[{"start": a, "length": n} for a, n in spans] for _, spans in both]
            yield pa.RecordBatch.from_arrays(
                [*[chunk[c].combine_chunks() for c in ("conv_id", "path_rank", "formatted")],
                 pa.array(turns, pair("role", "text", pa.string())), pa.array(loss, pair("start", "length", pa.int64()))],
                ["conv_id", "path_rank", "formatted", "turns", "loss"])

    return conversations.select("conv_id", F.col("path_rank").cast("int").alias("path_rank"), "formatted").mapInArrow(run, kind)


def linear(conversations: DataFrame) -> DataFrame:
    """A table of turns as reply chains: each row, by turn, replies to the one before it."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("bigint")
    return (conversations.withColumn("node_id", place)
            .select("conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
                    "role", "text", F.lit(0.0).alias("score")))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE), (PROBE_ID, 1, "assistant", PROBE)],
                                  "conv_id bigint, turn bigint, role string, text string")
    nodes = _stored(nodes_of(linear(table.unionByName(probe))), "messages")
    read = parsed(formatted(best_paths(nodes)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))), "")
    loss = F.regexp_replace(masked, r"(?s)\\(.)", "$1")
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


OP2_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), j AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<turn >' || chr(10) || chr(10) || '</turn>' || chr(10)) + length(role) + length(text)
        + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', ''))
        + length(text) - length(replace(replace(text, '\', ''), '<', ''))) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM j
"""
