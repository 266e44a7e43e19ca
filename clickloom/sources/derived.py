"""Click rows and click lines made from the ``events`` and ``pages`` tables.

Each event becomes one click on one page. The column rules are plain SQL that reads the
same in other engines, so a result can be checked elsewhere on the same input; only the
name of the text type and the epoch of a timestamp differ and are filled in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Events that one task turns into lines. An event is some 20 bytes in a compressed file and 400 as a line, so a file that is
#: one split for its reader would be one long task, and its lines would not fit the task's memory.
EVENTS_PER_TASK = 50_000

# Epoch of a zone-free timestamp, the same in every session time zone.
SPARK_EPOCH = ("(unix_date(CAST(ts AS DATE)) * 86400 + hour(ts) * 3600 + minute(ts) * 60 "
               "+ second(ts))")

CLICK_RULES = {
    "_id": "CAST(event_id AS {S})",
    "a": "CASE event_type WHEN 'view' THEN 'Reader/2.4 (tablet)' "
         "WHEN 'click' THEN 'Desk/7.1 (linux)' ELSE 'Opera' END",
    "al": "CASE user_id % 3 WHEN 0 THEN 'fi-fi' WHEN 1 THEN 'es,en;q=0.8' END",
    "c": "CASE WHEN event_id % 40 = 0 THEN NULL WHEN user_id % 5 IN (0, 1) THEN 'US' "
         "WHEN user_id % 5 = 2 THEN 'SE' WHEN user_id % 5 = 3 THEN 'GB' ELSE 'ZZ' END",
    "cy": "CASE user_id % 5 WHEN 0 THEN 'New York' WHEN 1 THEN 'Los Angeles' "
          "WHEN 2 THEN 'Lund' WHEN 3 THEN 'London' END",
    "g": "concat('g', CAST(event_id % 1000 AS {S}))",
    "gr": "CAST(user_id % 30 AS {S})",
    "h": "concat('h', CAST(event_id AS {S}))",
    "hc": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST({EPOCH} AS BIGINT) - user_id END",
    "hh": "CASE event_type WHEN 'view' THEN '1.usa.gov' WHEN 'click' THEN 'go.example.org' "
          "ELSE 'bit.ly' END",
    "l": "CASE WHEN user_id % 7 = 0 THEN 'nightbus' END",
    "lat": "CASE WHEN event_id % 45 = 0 THEN NULL "
           "ELSE CAST((user_id * 37) % 180 - 90 AS INT) END",
    "lon": "CASE WHEN event_id % 45 = 0 THEN NULL "
           "ELSE CAST((user_id * 53) % 360 - 180 AS INT) END",
    "nk": "CASE WHEN event_id % 30 = 0 THEN NULL ELSE CAST(user_id % 2 AS INT) END",
    "r": "CASE WHEN user_id % 6 = 0 THEN 'direct' ELSE concat('http://t.co/', "
         "CAST(user_id AS {S})) END",
    "t": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST({EPOCH} AS BIGINT) END",
    "tz": "CASE user_id % 4 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Europe/Stockholm' "
          "WHEN 2 THEN 'Australia/Sydney' ELSE '' END",
    "u": "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 211 = 0 THEN '' "
         "WHEN event_id % 223 = 0 THEN 'no-scheme' ELSE url END",
}


def _text(field: str) -> str:
    return (f"CASE WHEN {field} IS NULL THEN '' "
            f"ELSE concat(',\"{field}\":\"', {field}, '\"') END")


def _number(field: str) -> str:
    return (f"CASE WHEN {field} IS NULL THEN '' "
            f"ELSE concat(',\"{field}\":', CAST({field} AS {{S}})) END")


#: A click as a JSON line; fields that are NULL are absent.
LINE_RULE = "concat({})".format(", ".join([
    "'{{\"h\":\"', h, '\"'", _text("g"), _text("l"), _text("hh"), _text("u"), _text("r"),
    _text("a"), _number("t"), _number("hc"), _text("_id"), _text("al"), _text("c"),
    _text("tz"), _text("gr"), _text("cy"), _number("nk"),
    "CASE WHEN lat IS NULL THEN '' ELSE concat(',\"ll\":[', CAST(lat AS {S}), '.0,', "
    "CAST(lon AS {S}), '.0]') END", "'}}'",
]))

#: Lines next to the clicks: a second delivery, a line that is no click, a broken click.
AGAIN_RULE = "event_id % 20 = 0"
NOTE_RULE = ("event_id % 500 = 0", "concat('{{\"_note\":', CAST(event_id AS {S}), '}}')")
BROKEN_RULE = ("event_id % 1000 = 0", "concat('{{\"h\":\"broken', CAST(event_id AS {S}))")


def _spark(rule: str) -> str:
    return rule.format(S="STRING", EPOCH=SPARK_EPOCH)


def _spread(events: DataFrame) -> DataFrame:
    """The events dealt out evenly over as many tasks as their number asks for; it is read from the files' footers."""
    tasks = -(-events.count() // EVENTS_PER_TASK)
    return events.select("event_id", "ts", "user_id", "event_type").repartition(max(1, tasks))


def _numbered_clicks(spark: SparkSession, tables: str) -> DataFrame:
    events = _spread(spark.read.parquet(f"{tables}/events.parquet"))
    pages = spark.read.parquet(f"{tables}/pages.parquet").select("page_id", "url")
    page = F.col("event_id") % pages.select(F.count(F.lit(1))).scalar()
    placed = events.withColumn("page_id", page).join(pages, "page_id")
    return placed.selectExpr("event_id", *[f"{_spark(rule)} AS {name}"
                                           for name, rule in CLICK_RULES.items()])


def derived_clicks(spark: SparkSession, tables: str) -> DataFrame:
    """One click row per event, in the fields of a parsed line."""
    clicks = _numbered_clicks(spark, tables)
    ll = F.when(F.col("lat").isNotNull(), F.array(*[F.col(x).cast("double") for x in ("lat", "lon")]))
    return clicks.withColumn("ll", ll).drop("event_id", "lat", "lon")


def derived_lines(spark: SparkSession, tables: str) -> DataFrame:
    """Click lines of all events, one in twenty delivered twice, with some other lines.

    One pass: every event is turned into its one to four lines.
    """
    clicks = _numbered_clicks(spark, tables).withColumn("line", F.expr(_spark(LINE_RULE)))
    extra = [(AGAIN_RULE, "line"), *[(when, _spark(text)) for when, text in (NOTE_RULE, BROKEN_RULE)]]
    cases = [F.expr(f"CASE WHEN {when} THEN {text} END") for when, text in extra]
    return clicks.select(F.explode(F.array_compact(F.array("line", *cases))).alias("event"))
