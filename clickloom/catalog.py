"""Every query under its name, as ``(spark, folder with the tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions import (
    domain_of, epoch_text_unit, epoch_unit, geohash, parse_minute, register_functions, today_unit,
    with_country,
)
from clickloom.operators import (
    click_ids, count_table_of, day_hour_counts, distinct_ids, distinct_lines, drop_coordinates,
    drop_empty_lines, enrich_documents, export_lines, full_events, hour_counts, hour_cube,
    panel_rows, raw_by_day, rename_fields, roll_up, strip_spaces, to_documents, top, tz_hour_counts,
)
from clickloom.plans import dashboards, jobs, payloads, reads
from clickloom.plans.periods import period_totals, write_running_sums
from clickloom.schema import CLICK, COUNT_KEYS, SERVING_TABLES, UNITS, count_table
from clickloom.session import scratch_dir
from clickloom.sinks.documents import write_documents, write_lines
from clickloom.sinks.store import TableStore
from clickloom.sinks.tables import catalogue, register_tables, write_table
from clickloom.sources.derived import derived_clicks, derived_lines
from clickloom.sources.lines import click_lines, parse_clicks, read_events, register_events
from clickloom.sources.serving import first_clicks, latest_day, point_read, read_table, stored_days
from clickloom.sources.spool import spool_feed
from clickloom.streaming.counts import read_live, sliding_counts, windowed_counts
from clickloom.streaming.daily import daily_totals, line_counter
from clickloom.streaming.dedup import ids_once
from clickloom.streaming.feed import line_feed, timed_clicks
from clickloom.streaming.late import counted_lines, late_lines, newest_counts
from clickloom.streaming.pipeline import close_days, start_documents
from clickloom.streaming.replay import Replay, deliver, deliver_in_steps
from clickloom.streaming.report import RunReport, observed, totals
from clickloom.streaming.run import append_files, append_live, keep_running, start_batches, state_on_disk, state_partitions
from clickloom.streaming.tables import LIVE_COUNTS, batch_tables, start_tables

Query = Callable[[SparkSession, str], DataFrame]

#: Run time of the batch job in the registered queries: 2024-02-01 12:34:56 UTC.
RUN_EPOCH = 1706790896
#: Slices of the replay with late lines.
LATE_SLICES = 4
#: Period of the period total: the whole of January 2024.
PERIOD = (1704067200, 1706745600)


def _run() -> Column:
    return F.lit(RUN_EPOCH)


# ---- inputs -------------------------------------------------------------------------------

def _clicks(*fields: str) -> Query:
    return lambda spark, tables: parse_clicks(click_lines(derived_lines(spark, tables)), *fields)


def _documents(spark: SparkSession, tables: str) -> DataFrame:
    return panel_rows(derived_clicks(spark, tables))


def _cube(spark: SparkSession, tables: str) -> DataFrame:
    lines = click_lines(derived_lines(spark, tables), clean=True)
    return hour_cube(parse_clicks(lines, "t", "tz"))


def _counts(subject: str, unit: str) -> Query:
    return lambda spark, tables: count_table_of(derived_clicks(spark, tables), subject, unit)


def _hours(subject: str) -> Query:
    return lambda spark, tables: roll_up(_counts(subject, "minute")(spark, tables), "hour")


def _raw(spark: SparkSession, tables: str) -> DataFrame:
    return raw_by_day(derived_lines(spark, tables))


def _flat(events: DataFrame) -> DataFrame:
    """Coordinate arrays as their JSON text."""
    arrays = [name for name in ("ll", "location") if name in events.columns]
    return events.withColumns({name: F.to_json(name) for name in arrays})


# ---- functions ----------------------------------------------------------------------------

def domains(spark: SparkSession, tables: str) -> DataFrame:
    return derived_clicks(spark, tables).select("_id", "u", domain_of("u").alias("domain"))


def epochs(spark: SparkSession, tables: str) -> DataFrame:
    words = ["dia", "hora", "minuto", "segundo", "year"]
    return derived_clicks(spark, tables).select(
        "_id", *[epoch_unit("t", word).alias(word) for word in words])


def epoch_texts(spark: SparkSession, tables: str) -> DataFrame:
    text = F.coalesce(F.col("t").cast("string"), F.lit("()"))
    words = ["dia", "hora", "minuto", "segundo"]
    return derived_clicks(spark, tables).select(
        "_id", *[epoch_text_unit(text, word).alias(word) for word in words])


def _todays(minutes_back: int) -> Query:
    """Takes each click's own time as the run time."""
    def query(spark: SparkSession, tables: str) -> DataFrame:
        words = ["dia", "horas", "minutos", "segundos", "year"]
        return derived_clicks(spark, tables).select(
            "_id", *[today_unit(word, F.col("t"), minutes_back).alias(word) for word in words])
    return query


def countries(spark: SparkSession, tables: str) -> DataFrame:
    clicks = derived_clicks(spark, tables).select("_id", F.col("c").alias("country_code"))
    return with_country(clicks)


def geohashes(spark: SparkSession, tables: str) -> DataFrame:
    clicks = derived_clicks(spark, tables)
    return clicks.select("_id", geohash(F.get("ll", F.lit(0)), F.get("ll", F.lit(1))).alias("cell"))


def sql_domain_minutes(spark: SparkSession, tables: str) -> DataFrame:
    """The domain minutes as SQL text over a named table with the SQL functions."""
    register_functions(spark)
    register_events(derived_clicks(spark, tables), "clickloom_clicks")
    return spark.sql("""
        SELECT getTimeFromEpoch(t, 'dia') AS date, getDomain(u) AS domain,
               getTimeFromEpoch(t, 'minuto') AS time, count(1) AS clicks
        FROM clickloom_clicks WHERE t IS NOT NULL AND getDomain(u) IS NOT NULL
        GROUP BY ALL
    """)


# ---- lines and events ---------------------------------------------------------------------

def parsed_events(spark: SparkSession, tables: str) -> DataFrame:
    return _flat(_clicks()(spark, tables))


def archive_events(spark: SparkSession, tables: str) -> DataFrame:
    """The events of an archive of compressed text files."""
    archive = scratch_dir(spark, "archive")
    derived_lines(spark, tables).write.option("compression", "gzip").text(archive)
    return _flat(read_events(spark, archive))


def events_without_coordinates(spark: SparkSession, tables: str) -> DataFrame:
    return drop_coordinates(_clicks()(spark, tables))


def enriched(spark: SparkSession, tables: str) -> DataFrame:
    lines = drop_empty_lines(derived_lines(spark, tables))
    return _flat(enrich_documents(parse_clicks(click_lines(lines))))


def documents(spark: SparkSession, tables: str) -> DataFrame:
    """Every field of each JSON document, read back from its text."""
    docs = enrich_documents(_clicks()(spark, tables))
    read = F.from_json("document", docs.schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread"})
    return _flat(to_documents(docs).select(read.alias("d")).select("d.*"))


# ---- reads --------------------------------------------------------------------------------

def _read(read: Callable[..., DataFrame], subject: str, unit: str) -> Query:
    return lambda spark, tables: read(_counts(subject, unit)(spark, tables))


def _latest(read: Callable[..., DataFrame], subject: str, unit: str) -> Query:
    """A read of the newest day of a serving table on storage."""
    def query(spark: SparkSession, tables: str) -> DataFrame:
        root, table = scratch_dir(spark, "serving"), count_table(subject, unit)
        write_table(_counts(subject, unit)(spark, tables), f"{root}/{table}")
        served = read_table(spark, root, table)
        return read(served, latest_day(served))
    return query


def latest_counter(spark: SparkSession, tables: str) -> DataFrame:
    raw = _raw(spark, tables)
    return reads.daily_counter(raw, latest_day(raw))


def evolution(spark: SparkSession, tables: str) -> DataFrame:
    """The busiest domain's minutes over all days, with the time as a timestamp's text."""
    counts = _counts("domain", "minute")(spark, tables)
    series = reads.domain_history(counts, reads.busiest_domain(counts))
    return series.withColumn("at", parse_minute("date", "time").cast("string"))


def evolution_last40(spark: SparkSession, tables: str) -> DataFrame:
    counts = _counts("domain", "minute")(spark, tables)
    return reads.last_points(reads.domain_history(counts, reads.busiest_domain(counts)))


def latest_evolution(spark: SparkSession, tables: str) -> DataFrame:
    """The busiest domain's minutes of the newest day of a serving table on storage."""
    read = lambda served, day: reads.domain_evolution(served, reads.busiest_domain(served), day)
    return _latest(read, "domain", "minute")(spark, tables)


def counter_payload(spark: SparkSession, tables: str) -> DataFrame:
    raw = _raw(spark, tables)
    return payloads.counter_payload(reads.daily_counter(raw, latest_day(raw)), latest_day(raw))


def country_payload(spark: SparkSession, tables: str) -> DataFrame:
    return payloads.country_payload_lines(_latest(
        lambda served, day: reads.top_countries(served, day, None), "country", "minute")(spark, tables))


def evolution_payload(spark: SparkSession, tables: str) -> DataFrame:
    return payloads.evolution_payload(latest_evolution(spark, tables))


def domain_payload(spark: SparkSession, tables: str) -> DataFrame:
    return payloads.domain_payload_lines(_latest(reads.top_domains, "domain", "second")(spark, tables))


# ---- jobs and sinks -----------------------------------------------------------------------

def pattern_documents(spark: SparkSession, tables: str) -> DataFrame:
    """The batch job's three folders of JSON documents, read back."""
    out = scratch_dir(spark, "patterns")
    jobs.run_hour_patterns(derived_lines(spark, tables), out, _run())
    schema = "`@timestamp` string, timezone string, hour string, counter bigint"
    parts = [spark.read.schema(schema).json(f"{out}/{name}").withColumn("query", F.lit(name))
             for name in jobs.PATTERNS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_served: dict[tuple[str, str], str] = {}


def _serving(spark: SparkSession, tables: str) -> str:
    """The folder of the serving tables after the batch build; built once per application."""
    key = (spark.sparkContext.applicationId, tables)
    if key not in _served:
        root = scratch_dir(spark, "serving")
        # the archive of the build: its lines are made once, not by each of the build's passes
        jobs.build_serving(jobs.stored(derived_lines(spark, tables), "archive-lines"), root)
        _served[key] = root
    return _served[key]


def _long(table: str, rows: DataFrame) -> DataFrame:
    """A count table, raw lines or ids in the columns of all of them."""
    columns = ["date", "time", "country_code", "domain", "event", "id", "clicks"]
    return rows.select(F.lit(table).alias("table"), *[
        F.col(name) if name in rows.columns else F.lit(None).cast("bigint" if name == "clicks" else "string").alias(name)
        for name in columns])


def serving_sizes(spark: SparkSession, tables: str) -> DataFrame:
    """Rows and clicks of every serving table after the batch build."""
    return jobs.table_sizes(spark, _serving(spark, tables))


def serving_tables(spark: SparkSession, tables: str) -> DataFrame:
    """Every row of the serving tables after the batch build, but for the wide events."""
    root = _serving(spark, tables)
    return reduce(DataFrame.unionByName, [_long(table, read_table(spark, root, table))
                                          for table in SERVING_TABLES if table != "full_events"])


def serving_events(spark: SparkSession, tables: str) -> DataFrame:
    """The wide events after the batch build."""
    return read_table(spark, _serving(spark, tables), "full_events")


def serving_catalogue(spark: SparkSession, tables: str) -> DataFrame:
    """Days and rows of the serving tables, read through a database they are registered in."""
    root = _serving(spark, tables)
    database = f"clickloom_{root.rsplit('-', 1)[1]}"
    register_tables(spark, database, root)
    return catalogue(spark, database)


def domain_point(spark: SparkSession, tables: str) -> DataFrame:
    """The busiest domain's minutes of the newest stored day, found without reading other days."""
    root = _serving(spark, tables)
    return point_read(spark, root, "domain_minutes", reads.busiest_domain(read_table(spark, root, "domain_minutes")))


def totals_of_periods(spark: SparkSession, tables: str) -> DataFrame:
    """Clicks of one period per fiftieth click: it starts in the click's minute and lasts up to two weeks."""
    clicks, root = derived_clicks(spark, tables), scratch_dir(spark, "periods")
    write_running_sums(clicks, root)
    number = F.col("_id").try_cast("bigint")
    start = (F.col("t") - F.pmod("t", F.lit(60))).alias("start")
    periods = clicks.where((number % 50 == 1) & F.col("t").isNotNull()).select("_id", start, (number * 7 % 20_000 * 60).alias("long"))
    return period_totals(spark, root, periods.select("_id", "start", (F.col("start") + F.col("long")).alias("end")))


def _read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a folder; a malformed click's text is a field here like any other."""
    schema = enrich_documents(spark.createDataFrame([], CLICK)).schema.add("date", "string")
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_unread").json(path)


def document_files(spark: SparkSession, tables: str) -> DataFrame:
    """Enriched documents written as JSON by day, read back whole with their day."""
    out = scratch_dir(spark, "documents")
    write_documents(enrich_documents(_clicks()(spark, tables)), out)
    return _flat(_read_documents(spark, out))


def export_files(spark: SparkSession, tables: str) -> DataFrame:
    """The export written as text and read back."""
    out = scratch_dir(spark, "export")
    write_lines(export_lines(distinct_lines(_raw(spark, tables))), out)
    return spark.read.text(out).withColumnRenamed("value", "event")


# ---- streams ------------------------------------------------------------------------------

_replays: dict[tuple[str, str], Replay] = {}


def _replay(spark: SparkSession, tables: str) -> Replay:
    """The derived lines as delivered files; written once per application."""
    key = (spark.sparkContext.applicationId, tables)
    if key not in _replays:
        _replays[key] = deliver(derived_lines(spark, tables), slices=3)
    return _replays[key]


def _small_state(spark: SparkSession, replay: Replay):
    """No more state partitions than there are files or cores."""
    return state_partitions(spark, max(replay.files, spark.sparkContext.defaultParallelism))


def _stream_counts(subject: str, unit: str) -> Query:
    """A live count table after the replay."""
    def query(spark: SparkSession, tables: str) -> DataFrame:
        replay, table = _replay(spark, tables), count_table(subject, unit)
        clicks = timed_clicks(replay.feed(spark), replay.delay, "c", "u")
        counts = windowed_counts(clicks, COUNT_KEYS[subject], unit)
        root = scratch_dir(spark, f"stream-{table}")
        with _small_state(spark, replay):
            stream = append_live(counts, f"{root}/live", f"{root}/state")
        stream.awaitTermination()
        return read_live(spark, f"{root}/live", table)
    return query


def stream_ids(spark: SparkSession, tables: str) -> DataFrame:
    replay, root = _replay(spark, tables), scratch_dir(spark, "stream-ids")
    ids = ids_once(timed_clicks(replay.feed(spark), replay.delay, "_id"))
    with _small_state(spark, replay):
        stream = append_files(ids, f"{root}/click_ids", f"{root}/state")
    stream.awaitTermination()
    return read_table(spark, root, "click_ids")


def stream_documents(spark: SparkSession, tables: str) -> DataFrame:
    replay, root = _replay(spark, tables), scratch_dir(spark, "stream-documents")
    start_documents(replay.feed(spark), f"{root}/docs", f"{root}/state", None).awaitTermination()
    return _flat(_read_documents(spark, f"{root}/docs")).drop("date")


def stream_raw(spark: SparkSession, tables: str) -> DataFrame:
    """The raw table filled by the stream, then counted per day."""
    replay, root = _replay(spark, tables), scratch_dir(spark, "stream-raw")
    raw = raw_by_day(replay.feed(spark))
    append_files(raw, f"{root}/raw_clicks", f"{root}/state").awaitTermination()
    return reads.daily_counters(read_table(spark, root, "raw_clicks"))


_stores: dict[tuple[str, str], str] = {}


def _store(spark: SparkSession, tables: str) -> TableStore:
    """All live tables after the replay, a file a batch: filled by one query, once per application."""
    key = (spark.sparkContext.applicationId, tables)
    if key not in _stores:
        root = scratch_dir(spark, "store")
        feed = line_feed(spark, _replay(spark, tables).path, max(1, _replay(spark, tables).files // 4))
        start_tables(spark, feed, f"{root}/tables", f"{root}/state", fanout=3).awaitTermination()
        _stores[key] = f"{root}/tables"
    return TableStore(spark, _stores[key])


def stream_tables(spark: SparkSession, tables: str) -> DataFrame:
    """Every row of every live table."""
    store = _store(spark, tables)
    return reduce(DataFrame.unionByName, [_long(table, store.read(table))
                                          for table in [*LIVE_COUNTS, "raw_clicks", "click_ids"]])


def compacted_minutes(spark: SparkSession, tables: str) -> DataFrame:
    """The live domain minutes, after the last batch has been given to the store once more."""
    store = _store(spark, tables)
    store.commit(store.state().batch, batch_tables(derived_lines(spark, tables)))
    return store.read("domain_minutes")


def _stored_read(read: Callable[..., DataFrame], table: str) -> Query:
    """A dashboard read of the newest day of a live table, found in the manifest."""
    def query(spark: SparkSession, tables: str) -> DataFrame:
        store = _store(spark, tables)
        day = store.latest_day(table) or ""
        return read(store.read(table, day), day)
    return query


def spool_minutes(spark: SparkSession, tables: str) -> DataFrame:
    """Domain minutes from a spool by byte offsets, by a query that ends and starts again between deliveries."""
    root = scratch_dir(spark, "spool")
    for _ in deliver_in_steps(derived_lines(spark, tables), f"{root}/spool", 2, _again()):
        lines = spool_feed(spark, f"{root}/spool", range_bytes=1 << 20)
        keep_running(lambda lines=lines: start_batches(
            lines, lambda batch, n: TableStore(spark, f"{root}/tables").commit(n, {
                "domain_minutes": count_table_of(parse_clicks(click_lines(batch), "t", "u"), "domain", "minute")}),
            f"{root}/state"))
    return TableStore(spark, f"{root}/tables").read("domain_minutes")


def _again() -> Column:
    """Clicks that the derived lines deliver twice."""
    return F.get_json_object("event", "$._id").try_cast("bigint") % 20 == 0


def stream_daily(spark: SparkSession, tables: str) -> DataFrame:
    """Different lines per day: closed days by chained stateful steps, open ones from raw lines."""
    replay, root = _replay(spark, tables), scratch_dir(spark, "stream-daily")
    # a few state partitions a core, however many files: each is a store with buffers of its own
    with state_partitions(spark, 4 * spark.sparkContext.defaultParallelism), state_on_disk(spark):
        closed = append_files(line_counter(replay.feed(spark), replay.delay), f"{root}/closed", f"{root}/state")
    closed.awaitTermination()
    done = spark.read.schema("part int, clicks bigint, date string").parquet(f"{root}/closed")
    return daily_totals(done, _store(spark, tables).read("raw_clicks"))


def stream_late(spark: SparkSession, tables: str) -> DataFrame:
    """Second deliveries that come a slice too late for a count with a delay of ten minutes."""
    root = scratch_dir(spark, "stream-late")
    for _ in deliver_in_steps(derived_lines(spark, tables), f"{root}/landing", LATE_SLICES, _again()):
        lines = line_feed(spark, f"{root}/landing")
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            counts = append_live(counted_lines(lines, "10 minutes"), f"{root}/counted", f"{root}/state")
        raw = append_files(raw_by_day(lines), f"{root}/raw_clicks", f"{root}/raw-state")
        counts.awaitTermination()
        raw.awaitTermination()
    counted = spark.read.schema("time string, digest string, clicks bigint, date string, batch bigint").parquet(f"{root}/counted")
    return late_lines(read_table(spark, root, "raw_clicks"), newest_counts(counted))


def run_report(spark: SparkSession, tables: str) -> DataFrame:
    """Lines and clicks of a whole run, added up from its batches."""
    replay, root, report = _replay(spark, tables), scratch_dir(spark, "stream-report"), RunReport()
    spark.streams.addListener(report)
    try:
        query = append_files(raw_by_day(observed(replay.feed(spark))), f"{root}/raw", f"{root}/state")
        query.awaitTermination()
        report.wait(query)
    finally:
        spark.streams.removeListener(report)
    return totals(report.rows(spark)).select("lines", "clicks")


_closed: dict[tuple[str, str], str] = {}


def _closed_table(table: str) -> Query:
    """A serving table after the stream has stored the raw lines and their days were closed."""
    def query(spark: SparkSession, tables: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, tables)
        if key not in _closed:
            root = scratch_dir(spark, "closed")
            raw = raw_by_day(_replay(spark, tables).feed(spark))
            append_files(raw, f"{root}/live/raw_clicks", f"{root}/state").awaitTermination()
            close_days(spark, f"{root}/live", f"{root}/served", stored_days(spark, f"{root}/live", "raw_clicks"))
            _closed[key] = f"{root}/served"
        return read_table(spark, _closed[key], table)
    return query


# ---- the list -----------------------------------------------------------------------------

def catalog() -> dict[str, Query]:
    lines = derived_lines
    return {
        # functions
        "domain_of": domains,
        "epoch_units": epochs,
        "epoch_units_text": epoch_texts,
        "today_units": _todays(0),
        "today_minus_3": _todays(3),
        "country_names": countries,
        "geohash_cells": geohashes,
        "sql_domain_minutes": sql_domain_minutes,
        # lines and events
        "filter_click_lines": lambda s, d: click_lines(lines(s, d)),
        "clean_lines": lambda s, d: strip_spaces(lines(s, d)),
        "parse_events": parsed_events,
        "archive_events": archive_events,
        "events_without_coordinates": events_without_coordinates,
        "rename_fields": lambda s, d: _flat(rename_fields(_clicks()(s, d))),
        "enrich_docs": enriched,
        "documents_json": documents,
        "full_event": lambda s, d: full_events(_clicks()(s, d)),
        "raw_by_day": _raw,
        "distinct_lines": lambda s, d: distinct_lines(_raw(s, d)),
        "click_ids": lambda s, d: distinct_ids(click_ids(_clicks("_id", "t")(s, d))),
        "export_clicks": lambda s, d: export_lines(distinct_lines(_raw(s, d))),
        "first_clicks": lambda s, d: first_clicks(distinct_lines(_raw(s, d))),
        # counts
        "hour_counts": lambda s, d: hour_counts(_cube(s, d), _run()),
        "tz_hour_counts": lambda s, d: tz_hour_counts(_cube(s, d), _run()),
        "day_hour_counts": lambda s, d: day_hour_counts(_cube(s, d)),
        "day_hour_top20": lambda s, d: day_hour_counts(_cube(s, d)).limit(20),
        **{count_table(subject, unit): _counts(subject, unit)
           for subject in COUNT_KEYS for unit in UNITS[:2]},
        **{count_table(subject, "hour"): _hours(subject) for subject in COUNT_KEYS},
        # reads
        "daily_counter": lambda s, d: reads.daily_counters(_raw(s, d)),
        "daily_counter_latest": latest_counter,
        "top_countries": _read(reads.top_countries_per_day, "country", "minute"),
        "top_countries_from_seconds": _read(reads.top_countries_per_day, "country", "second"),
        "top_countries_ex_us": _read(
            lambda counts: reads.without_home(reads.top_countries_per_day(counts)),
            "country", "minute"),
        "top_countries_latest": _latest(reads.top_countries, "country", "minute"),
        "top_domains": _read(reads.top_domains_per_day, "domain", "second"),
        "top_domains_latest": _latest(reads.top_domains, "domain", "second"),
        "domain_evolution": evolution,
        "domain_evolution_last40": evolution_last40,
        "domain_evolution_latest": latest_evolution,
        "domain_point_read": domain_point,
        "envelope_daily_counter": counter_payload,
        "envelope_top_country": country_payload,
        "envelope_evolution": evolution_payload,
        "envelope_top_domain": domain_payload,
        # dashboards
        "docs_per_minute": lambda s, d: dashboards.docs_per_minute(_documents(s, d)),
        "period_total": lambda s, d: dashboards.period_total(_documents(s, d), *PERIOD),
        "method_share": lambda s, d: dashboards.method_share(_documents(s, d)),
        "top20_timezones": lambda s, d: dashboards.top_timezones(_documents(s, d)),
        "top50_domains": lambda s, d: dashboards.top_document_domains(_documents(s, d)),
        "geo_heatmap": lambda s, d: dashboards.geo_heatmap(_documents(s, d)),
        "geo_pyramid": lambda s, d: dashboards.geo_pyramid(_documents(s, d)),
        "period_totals": totals_of_periods,
        "known_vs_new": lambda s, d: dashboards.known_vs_new(_documents(s, d)),
        "batch_histogram": lambda s, d: dashboards.batch_histogram(hour_counts(_cube(s, d), _run())),
        "batch_total": lambda s, d: dashboards.batch_total(hour_counts(_cube(s, d), _run())),
        "tz_hour_lines": lambda s, d: dashboards.tz_lines(tz_hour_counts(_cube(s, d), _run())),
        "tz_peak_hour": lambda s, d: dashboards.tz_peak_hour(tz_hour_counts(_cube(s, d), _run())),
        # jobs and sinks
        "pattern_documents": pattern_documents,
        "serving_tables": serving_tables,
        "serving_sizes": serving_sizes,
        "serving_full_events": serving_events,
        "serving_catalogue": serving_catalogue,
        "document_files": document_files,
        "export_files": export_files,
        # streams
        **{f"stream_{count_table(subject, unit)}": _stream_counts(subject, unit)
           for subject in COUNT_KEYS for unit in UNITS[:2]},
        "stream_dedup_clicks": stream_ids,
        "stream_enrich_docs": stream_documents,
        **{f"closed_{table}": _closed_table(table)
           for table in ("domain_minutes", "country_minutes", "raw_clicks", "click_ids")},
        "stream_raw_by_day": stream_raw,
        "stream_all_tables": stream_tables,
        "stream_spool_minutes": spool_minutes,
        "stream_daily_counter": stream_daily,
        "stream_late_lines": stream_late,
        "stream_sliding_minutes": lambda s, d: sliding_counts(_store(s, d).read("domain_minutes"), 5),
        "stream_run_report": run_report,
        "compacted_live_minutes": compacted_minutes,
        "stream_top_countries": _stored_read(reads.top_countries, "country_minutes"),
        "stream_top_domains": _stored_read(reads.top_domains, "domain_seconds"),
        "stream_domain_evolution": _stored_read(
            lambda counts, day: reads.domain_evolution(counts, reads.busiest_domain(counts), day), "domain_minutes"),
    }


def flagship(spark: SparkSession, tables: str) -> DataFrame:
    """The busiest domains of the whole period."""
    counts = _counts("domain", "minute")(spark, tables)
    return top(counts.groupBy("domain").agg(F.sum("clicks").alias("clicks")), "domain")
