"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one document and votes good (1), bad (-1) or abstains (0). Votes are no longer
a chain in which every rule must pass: expectation-maximisation estimates, from the votes of all
documents, how often each rule is right about good and about bad documents, and a document is
judged by its posterior probability of being good. Documents are first counted by their pattern of
votes. There are at most 3**rules patterns whatever the input, so this table alone is small enough
to go through on the driver.

Nothing is shuffled but pattern counts; every statistic of a text is an array expression on its row.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; a very long
text is taken whole; repeated rows are judged alike and all returned; a null ``doc_id`` is passed
through; other columns are never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import scratch_dir

#: Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = "[^#*$%&|<>]+"
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

#: First guesses: how often a rule answers good, nothing and bad about a good and a bad document,
#: and the share of good documents. The guesses also count as PRIOR documents of either kind.
FIRST_GOOD = {1: 0.85, 0: 0.13, -1: 0.02}
FIRST_BAD = {1: 0.35, 0: 0.25, -1: 0.40}
FIRST_SHARE, PRIOR = 0.9, 10.0
ROUNDS = 30
KEEP_AT = 0.5


def statistics(docs: DataFrame, **more: Column) -> DataFrame:
    """Counts over each whole text, on its own row, with ``more`` columns of that row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        *[value.alias(name) for name, value in more.items()],
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.split(text, BLANKS).alias("parts"),
    )
    rows = rows.select(
        *more, "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.array_join("parts", "").alias("squeezed"),
        F.transform(F.filter("parts", lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words"),
    )
    # small letters are most of a text: what is counted below is found in the rest
    rows = rows.select("*", F.length("squeezed").cast("bigint").alias("word_chars"),
                       F.regexp_replace("squeezed", r"[a-z\p{Ll}]+", "").alias("rest")).drop("squeezed")
    kept = lambda pattern: F.length(F.regexp_replace("rest", pattern, ""))
    rows = rows.select(
        *more, "doc_id", "word_chars", "n_lines", "n_dup_lines", "words",
        kept(SYMBOLS).cast("bigint").alias("n_symbols"),
        kept(r"[^A-Z\p{Lu}]+").alias("n_upper"),
        (F.col("word_chars") - kept(r"\p{L}+")).alias("n_letters"),
        kept("[^.!?]+").alias("n_stops"),
        kept("[^!|]+").alias("n_shouts"),
    )
    rows = rows.select("*", F.size("words").cast("bigint").alias("n_words"),
                       F.size(F.array_distinct("words")).cast("bigint").alias("n_distinct"))
    words, n = F.col("words"), F.col("n_words").cast("int")
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    none = F.array().cast("array<bigint>")
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), window)).otherwise(none)
    rows = rows.select("*", grams.alias("grams")).drop("words")
    # a text without a repeated window, the usual case, is neither sorted nor walked
    pairs = F.sort_array(F.transform(F.col("grams"), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    nothing = F.array().cast("array<struct<g:bigint,i:int>>")
    rows = rows.select("*", F.when(F.size("grams") > F.size(F.array_distinct("grams")), pairs)
                       .otherwise(nothing).alias("pairs")).drop("grams")
    pairs = F.col("pairs")
    twice = F.filter(pairs, lambda p, k: ((k > 0) & (F.get(pairs, k - 1)["g"] == p["g"]))
                     | F.coalesce(F.get(pairs, k + 1)["g"] == p["g"], F.lit(False)))
    rows = rows.select("*", F.sort_array(F.transform(twice, lambda p: p["i"])).alias("at")).drop("pairs")
    at = F.col("at")
    covered = F.transform(at, lambda i, k: F.when(k > 0, F.least(F.lit(WINDOW), i - F.get(at, k - 1))).otherwise(WINDOW))
    return rows.select("*", F.aggregate(covered, F.lit(0).cast("bigint"), lambda s, x: s + x)
                       .alias("n_repeat_words")).drop("at")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules by name, as votes over :func:`statistics`."""
    n, chars, letters = F.col("n_words"), F.col("word_chars"), F.col("n_letters")
    some = n > 0
    return {
        "length": _vote(n >= 2 * MIN_WORDS, n < MIN_WORDS),
        "symbols": _vote(50 * F.col("n_symbols") < chars, some & (20 * F.col("n_symbols") > chars)),
        "symbols_a_word": _vote(20 * F.col("n_symbols") < n, some & (4 * F.col("n_symbols") > n)),
        "capitals": _vote(10 * F.col("n_upper") < letters, some & (10 * F.col("n_upper") > 4 * letters)),
        "shouts": _vote(20 * F.col("n_shouts") < n, some & (4 * F.col("n_shouts") > n)),
        "letters": _vote(20 * letters > 17 * chars, (n >= 2 * MIN_WORDS) & (10 * letters < 8 * chars)),
        "repeats": _vote(20 * F.col("n_repeat_words") <= n, 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n),
        "variety": _vote(F.when(n >= 200, False).otherwise(2 * F.col("n_distinct") > n), (n >= MIN_WORDS) & (6 * F.col("n_distinct") < n)),
        "same_lines": _vote(F.col("n_dup_lines") == 0, 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "sentences": _vote(40 * F.col("n_stops") > n, (n >= 2 * MIN_WORDS) & (200 * F.col("n_stops") < n)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> dict:
    """Expectation-maximisation over counted vote patterns, a table of bounded size.

    Rules are taken to err independently given the document's quality. Abstaining is an answer with
    a rate of its own, so a rule that speaks up about bad documents only is still told apart.
    """
    rates = {True: [dict(FIRST_GOOD) for _ in range(n_rules)], False: [dict(FIRST_BAD) for _ in range(n_rules)]}
    model = {"share": FIRST_SHARE, "rates": rates}
    total = sum(count for _, count in patterns)
    for _ in range(ROUNDS if total else 0):
        mass = {True: 0.0, False: 0.0}
        sums = {y: [{v: PRIOR * first[v] for v in first} for _ in range(n_rules)]
                for y, first in ((True, FIRST_GOOD), (False, FIRST_BAD))}
        for votes, count in patterns:
            p = posterior(votes, model)
            for y, weight in ((True, p * count), (False, (1 - p) * count)):
                mass[y] += weight
                for j, vote in enumerate(votes):
                    sums[y][j][vote] += weight
        rates = {y: [{v: x / (mass[y] + PRIOR) for v, x in rule.items()} for rule in sums[y]] for y in sums}
        model = {"share": min(max(mass[True] / total, 0.01), 0.99), "rates": rates}
    return model


def weight_of(vote: int, rule: int, model: dict) -> float:
    """What a rule's answer adds to the log odds of a good document.

    A vote never counts for the opposite of what it says, whatever the estimates.
    """
    x = math.log(model["rates"][True][rule][vote] / model["rates"][False][rule][vote])
    return max(x, 0.0) if vote > 0 else min(x, 0.0) if vote < 0 else x


def posterior(votes: tuple[int, ...], model: dict) -> float:
    """The chance that a document with these votes is good."""
    odds = math.log(model["share"] / (1 - model["share"]))
    odds += sum(weight_of(vote, j, model) for j, vote in enumerate(votes))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def judge(docs: DataFrame, **more: Column) -> DataFrame:
    """Per document its statistics, ``base_failed``, ``quality`` (the posterior) and ``kept``, with ``more`` columns of its row."""
    spark, votes, place = docs.sparkSession, rules(), scratch_dir(docs.sparkSession, "statistics")
    # a few numbers per document, written so that each text is read once
    statistics(docs, **more).select("*", *[v.alias(f"vote_{name}") for name, v in votes.items()]).write.parquet(place)
    rows = spark.read.parquet(place)
    names = [f"vote_{name}" for name in votes]
    counted = rows.groupBy(*names).count().collect()  # at most 3 ** len(votes) rows
    model = fit(sorted((tuple(row[c] for c in names), row["count"]) for row in counted), len(names))
    odds = F.lit(math.log(model["share"] / (1 - model["share"])))
    for j, name in enumerate(names):
        odds = odds + (F.when(F.col(name) > 0, weight_of(1, j, model))
                       .when(F.col(name) < 0, weight_of(-1, j, model)).otherwise(weight_of(0, j, model)))
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n)
    rows = rows.select("*", failed.alias("base_failed"), (1 / (1 + F.exp(-odds))).alias("quality"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT))


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they came: rows are told apart by id and text, not by id alone."""
    spark, place = docs.sparkSession, scratch_dir(docs.sparkSession, "kept-rows")
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    judged = judge(docs, __digest=digest).filter("kept")
    judged.select(F.col("doc_id").alias("__kept_id"), F.col("__digest").alias("__kept_digest")).distinct().write.parquet(place)
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__kept_id")) & (digest == F.col("__kept_digest"))
    return docs.join(spark.read.parquet(place), same, "left_semi")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "quality")
