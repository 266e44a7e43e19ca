import json
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom.operators import count_table_of, enrich_documents, raw_by_day
from clickloom.plans import reads
from clickloom.schema import COUNT_KEYS, count_table
from clickloom.sources.lines import click_lines, parse_clicks
from clickloom.sources.serving import read_table
from clickloom.streaming import (
    append_files, append_live, close_days, line_feed, ids_once, odd_clicks, read_counts, read_live, run_for,
    start_counts, start_documents, timed_clicks, windowed_counts,
)
from clickloom.streaming.replay import deliver
from tests.conftest import SAMPLE, TABLES, click

START = 1433894400  # 2015-06-10 00:00:00


def rows_of(df):
    return Counter(tuple(row) for row in df.select(*sorted(df.columns)).collect())


class Landing:
    """A folder that receives one file per call."""

    def __init__(self, path):
        self.path, self.number = Path(path), 0
        self.path.mkdir(parents=True)

    def add(self, *events):
        self.number += 1
        text = "".join((e if isinstance(e, str) else json.dumps(e, separators=(",", ":"))) + "\n"
                       for e in events)
        time.sleep(0.02)  # files are read in order of their modification time
        (self.path / f"{self.number:03d}.txt").write_text(text)


@pytest.fixture
def landing(folder):
    return Landing(folder("landing"))


def feed(spark, landing):
    return line_feed(spark, str(landing.path), 1)


def minutes(spark, landing, delay="10 minutes", keys=("domain",)):
    clicks = timed_clicks(feed(spark, landing), delay, "c", "u")
    return windowed_counts(clicks, list(keys), "minute")


def run_live(spark, landing, out, **options):
    append_live(minutes(spark, landing, **options), f"{out}/live", f"{out}/state").awaitTermination()
    return read_live(spark, f"{out}/live", "domain_minutes")


def test_live_tables_equal_batch(spark, lines, folder):
    events = [click(_id=str(i), t=START + 37 * i, c=[None, "US", "SE"][i % 3],
                    u=[SAMPLE["u"], "", "x", "http://a.gov/"][i % 4]) for i in range(400)]
    stored = lines(*events, *events[::20], '{"h":"broken1', '{"_note":1}', "")
    replay, root = deliver(stored), folder("live")
    assert replay.files >= 5
    queries = start_counts(replay.feed(spark), root, folder("state"), replay.delay, every=None)
    for query in queries.values():
        query.awaitTermination()
    batch = parse_clicks(click_lines(stored))
    for subject in COUNT_KEYS:
        for unit in ("second", "minute"):
            table = count_table(subject, unit)
            assert rows_of(read_live(spark, f"{root}/{table}", table)) == rows_of(
                count_table_of(batch, subject, unit)), table
    raw = read_table(spark, root, "raw_clicks")
    assert rows_of(reads.daily_counters(raw)) == rows_of(reads.daily_counters(raw_by_day(stored)))
    ids = read_table(spark, root, "click_ids")
    assert Counter(r.id for r in ids.collect()) == Counter(str(i) for i in range(400))


def test_a_minute_over_several_batches_is_one_row(spark, landing, folder):
    for _ in range(3):
        landing.add(click(t=START), click(t=START + 59))
    rows = run_live(spark, landing, folder()).collect()
    assert [(r.time, r.clicks) for r in rows] == [("00:00", 6)]


def test_restart_goes_on_from_the_checkpoint(spark, landing, folder):
    out = folder()
    landing.add(click(t=START))
    assert run_live(spark, landing, out).first().clicks == 1
    assert run_live(spark, landing, out).first().clicks == 1  # nothing new
    landing.add(click(t=START + 1))
    assert run_live(spark, landing, out).first().clicks == 2


def test_a_repeated_batch_changes_nothing(spark, landing, folder):
    out = folder()
    landing.add(click(t=START), click(t=START + 60))
    landing.add(click(t=START + 1), click(t=START + 61))
    before = rows_of(run_live(spark, landing, out))
    commits = sorted((Path(out) / "state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()  # as if the driver was lost before it noted the batch
    for crc in (Path(out) / "state/commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    assert rows_of(run_live(spark, landing, out)) == before


def test_late_click_is_dropped_after_another_batch(spark, landing, folder):
    landing.add(click(t=START))
    landing.add(click(t=START + 7200))
    landing.add(click(t=START + 7201))
    landing.add(click(t=START + 1))  # two hours late, two batches after the jump
    rows = {r.time: r.clicks for r in run_live(spark, landing, folder(), delay="1 minute").collect()}
    assert rows == {"00:00": 1, "02:00": 2}


def test_empty_and_useless_batches(spark, landing, folder):
    landing.add("", '{"_note":1}')
    landing.add(click(t=START))
    landing.add('{"h":"broken1', {"h": "x"})
    assert [r.clicks for r in run_live(spark, landing, folder()).collect()] == [1]


def test_final_rows_are_appended_once(spark, landing, folder):
    out = folder()
    landing.add(click(t=START), click(t=START + 1))
    landing.add(click(t=START + 7200))
    landing.add(click(t=START + 7201))

    def run():
        counts = minutes(spark, landing, "1 minute")
        append_files(counts, f"{out}/domain_minutes", f"{out}/state").awaitTermination()
        return [(r.time, r.clicks) for r in read_table(spark, out, "domain_minutes").collect()]

    assert run() == [("00:00", 2)]  # the last minute is still open
    landing.add(click(t=START + 14400))
    landing.add(click(t=START + 14401))
    assert sorted(run()) == [("00:00", 2), ("02:00", 2)]


def test_sliding_window(spark, landing, folder):
    out = folder()
    landing.add(click(t=START + 90))
    clicks = timed_clicks(feed(spark, landing), "1 minute", "u")
    counts = windowed_counts(clicks, ["domain"], "minute", "2 minutes", "1 minute")
    append_live(counts, f"{out}/live", f"{out}/state").awaitTermination()
    rows = read_live(spark, f"{out}/live", "domain_minutes").collect()
    assert sorted(r.time for r in rows) == ["00:00", "00:01"]


def test_each_id_once_even_if_hot(spark, landing, folder):
    out = folder()
    for batch in range(3):
        landing.add(*[click(_id="hot", t=START + batch) for _ in range(200)],
                    *[click(_id=f"{batch}-{i}", t=START + batch) for i in range(20)])
    landing.add(click(_id="hot", t=START + 86400))  # another day is another row
    ids = ids_once(timed_clicks(feed(spark, landing), "10 minutes", "_id"))
    append_files(ids, f"{out}/click_ids", f"{out}/state").awaitTermination()
    found = Counter((r.date, r.id) for r in read_table(spark, out, "click_ids").collect())
    assert set(found.values()) == {1} and len(found) == 62


def test_document_stream_equals_batch(spark, landing, lines, folder):
    events = [SAMPLE, click(ll=None), click(u=None, c="ZZ"), click(t=None), '{"h":"broken1']
    landing.add(*events[:2], "")
    landing.add(*events[2:])
    out = folder()
    start_documents(feed(spark, landing), f"{out}/docs", f"{out}/state", None).awaitTermination()
    streamed = [json.loads(line) for file in Path(out, "docs").glob("date=*/*.json")
                for line in file.read_text().splitlines()]
    batch = enrich_documents(parse_clicks(lines(*events)))
    expected = [json.loads(row.d) for row in batch.select(F.to_json(F.struct("*")).alias("d")).collect()]
    key = lambda document: json.dumps(document, sort_keys=True)
    assert sorted(streamed, key=key) == sorted(expected, key=key)


def test_a_closed_day_has_late_clicks_and_no_copies(spark, landing, folder):
    out = folder()
    landing.add(click(_id="a", t=START), click(_id="b", t=START + 7200), click(_id="b", t=START + 7200))
    landing.add(click(_id="c", t=START + 14400), click(_id="d", t=START + 86400))
    landing.add(click(_id="a", t=START + 60))  # hours late
    queries = start_counts(feed(spark, landing), f"{out}/live", f"{out}/state", every=None)
    for query in queries.values():
        query.awaitTermination()
    close_days(spark, f"{out}/live", f"{out}/served", ["2015-06-10"])
    served = read_table(spark, f"{out}/served", "domain_minutes").collect()
    assert {(r.time, r.clicks) for r in served} == {("00:00", 1), ("00:01", 1), ("02:00", 2), ("04:00", 1)}
    assert read_table(spark, f"{out}/served", "raw_clicks").count() == 4
    assert sorted(r.id for r in read_table(spark, f"{out}/served", "click_ids").collect()) == ["a", "b", "c"]
    assert not Path(out, "live", "domain_minutes", "date=2015-06-10").exists()
    both = read_counts(spark, f"{out}/live/domain_minutes", f"{out}/served", "domain_minutes")
    assert sum(r.clicks for r in both.collect()) == 6


@pytest.mark.parametrize("odd", [START * 1000, START * 1_000_000, -5, 2 ** 62])
def test_an_odd_time_neither_stops_nor_moves_the_feed(spark, landing, folder, odd):
    out = folder()
    landing.add(click(_id="1", t=START), click(_id="odd", t=odd))
    landing.add(click(_id="2", t=START + 1))
    landing.add(click(_id="3", t=START + 2))
    assert sum(r.clicks for r in run_live(spark, landing, out).collect()) == 3
    append_files(odd_clicks(feed(spark, landing)), f"{out}/odd", f"{out}/odd-state").awaitTermination()
    assert [json.loads(r.event)["_id"] for r in spark.read.parquet(f"{out}/odd").collect()] == ["odd"]


def test_one_failing_query_stops_the_others(spark, landing, folder):
    out = folder()
    landing.add(click(t=START))
    good = append_live(minutes(spark, landing), f"{out}/live", f"{out}/state", every="1 second")
    broken = feed(spark, landing).select(F.raise_error(F.lit("broken")).alias("date"), "event")
    bad = append_files(broken, f"{out}/bad", f"{out}/bad-state", every="1 second")
    with pytest.raises(Exception):
        run_for([good, bad], 60)
    assert not good.isActive and not bad.isActive


def test_bounded_run(spark, landing, folder):
    out = folder()
    landing.add(click(t=START))
    query = append_live(minutes(spark, landing), f"{out}/live", f"{out}/state", every="1 second")
    query.processAllAvailable()
    run_for([query], 1)
    assert not query.isActive
    assert read_live(spark, f"{out}/live", "domain_minutes").first().clicks == 1


def test_sliding_windows_from_panes(spark, lines):
    from clickloom.streaming.counts import sliding_counts

    clicks = parse_clicks(lines(*[click(t=START + s) for s in (0, 30, 60, 290, 301, 86_399)], click(t=START, u="http://b/x")))
    panes = count_table_of(clicks, "domain", "minute")
    timed = clicks.withColumn("event_time", F.timestamp_seconds("t"))
    for length, slide in ((5, 1), (10, 5), (3, 3)):
        want = windowed_counts(timed, ["domain"], "minute", f"{length} minutes", f"{slide} minutes")
        assert rows_of(sliding_counts(panes, length, slide)) == rows_of(want)
    with pytest.raises(ValueError):
        sliding_counts(panes, 5, 2)


def test_daily_counter_of_closed_and_open_days(spark, landing, folder):
    from clickloom.streaming.daily import daily_totals, line_counter

    out, day = folder(), 86_400
    landing.add(SAMPLE, SAMPLE, click(_id="2"), '{"_note":1}')
    landing.add(SAMPLE, click(_id="2"), click(_id="3", t=SAMPLE["t"] + 60))
    landing.add(click(t=SAMPLE["t"] + 3 * day), click(t=SAMPLE["t"] + 3 * day))
    append_files(line_counter(feed(spark, landing), "1 hour"), f"{out}/closed", f"{out}/state").awaitTermination()
    closed = spark.read.schema("part int, clicks bigint, date string").parquet(f"{out}/closed")
    assert closed.agg(F.sum("clicks")).first()[0] == 3 and {r.date for r in closed.collect()} == {"2015-06-10"}
    raw = raw_by_day(spark.read.text(str(landing.path)).withColumnRenamed("value", "event"))
    assert rows_of(daily_totals(closed, raw)) == rows_of(reads.daily_counters(raw))


def test_late_lines(spark, landing, folder):
    from clickloom.streaming.late import counted_lines, late_lines, newest_counts

    out, hour = folder(), 3600
    landing.add(SAMPLE, SAMPLE)
    for name in ("new", "newer"):   # Spark judges lateness by the watermark of the batch before
        landing.add(click(t=SAMPLE["t"] + hour, _id=name))
    landing.add(SAMPLE, click(_id="late"), click(_id="late"), click(t=SAMPLE["t"] + hour - 60, _id="in time"))
    append_live(counted_lines(feed(spark, landing), "10 minutes"), f"{out}/counted", f"{out}/state").awaitTermination()
    counted = newest_counts(spark.read.schema(
        "time string, digest string, clicks bigint, date string, batch bigint").parquet(f"{out}/counted"))
    raw = spark.read.text(str(landing.path)).withColumnRenamed("value", "event")
    late = {(json.loads(r.event)["_id"], r.time, r.clicks) for r in late_lines(raw, counted).collect()}
    assert late == {(SAMPLE["_id"], "07:08", 1), ("late", "07:08", 2)}


def test_the_daily_counter_keeps_its_state_on_disk_in_any_session(spark, monkeypatch):
    from clickloom import catalog
    from clickloom.session import STATE, settings

    seen, started = {}, catalog.append_files

    def start(*args):
        seen.update({key: spark.conf.get(key) for key in STATE}, partitions=spark.conf.get("spark.sql.shuffle.partitions"))
        return started(*args)

    monkeypatch.setattr(catalog, "append_files", start)
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    provider = "spark.sql.streaming.stateStore.providerClass"
    with settings(spark, **{provider: heap}):  # Spark's default
        got = catalog.stream_daily(spark, TABLES)
        assert spark.conf.get(provider) == heap
    assert {key: seen[key] for key in STATE} == STATE and int(seen["partitions"]) <= 4 * spark.sparkContext.defaultParallelism
    assert rows_of(got) == rows_of(reads.daily_counters(raw_by_day(catalog.derived_lines(spark, TABLES))))
