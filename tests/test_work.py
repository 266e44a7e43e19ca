"""How often rows are made, read and shuffled: a test per step that was slow or bulky on larger tables."""

from collections import Counter

from pyspark.sql import functions as F

from clickloom.session import folder_names
from clickloom.sinks import store as stores, tables
from clickloom.sinks.store import TableStore
from clickloom.sources import derived
from clickloom.streaming.replay import deliver
from tests.conftest import TABLES, click


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_events_are_spread_over_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(derived, "EVENTS_PER_TASK", 10 ** 9)
    whole = Counter(r.event for r in derived.derived_lines(spark, TABLES).collect())
    monkeypatch.setattr(derived, "EVENTS_PER_TASK", 100)
    lines = derived.derived_lines(spark, TABLES)
    events = spark.read.parquet(f"{TABLES}/events.parquet").count()
    sizes = lines.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == -(-events // 100) and max(r["count"] for r in sizes) < 3 * 100
    assert Counter(r.event for r in lines.collect()) == whole


def test_no_events_are_no_lines(spark, folder):
    place = folder()
    for name in ("events", "pages"):
        spark.read.parquet(f"{TABLES}/{name}.parquet").limit(0).write.parquet(f"{place}/{name}.parquet")
    assert derived.derived_lines(spark, place).count() == 0


def test_wide_events_are_read_once(spark, monkeypatch, folder):
    written = []
    real = tables.write_table
    monkeypatch.setattr(tables, "write_table", lambda rows, *rest: (written.append(rows), real(rows, *rest)))
    place, source = folder(), folder()
    spark.createDataFrame([("d", "1", 5, "x"), ("d", "1", 5, "x"), ("d", "1", 7, None), ("d", None, 1, "y"), ("d", None, 1, "y"),
                           ("e", "1", None, None)], "date string, id string, n int, s string").write.parquet(source)
    tables.write_full_events(spark.read.parquet(source), place)
    rows = Counter((r.date, r.id, r.n, r.s) for r in spark.read.parquet(place).collect())
    assert rows == Counter({("d", "1", 7, None): 1, ("d", None, 1, "y"): 2, ("e", "1", None, None): 1})
    plan = written[0]._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1
    assert _exchanges(written[0]) == 1  # by id; that into files follows


def test_delivered_files_are_compressed(spark, lines):
    sent = lines(*[click(_id=str(k), t=1433920000 + k) for k in range(30)], "no click")
    replay = deliver(sent, slices=3)
    names = [n for n in folder_names(spark, replay.path) if not n.startswith(("_", "."))]
    assert names and all(name.endswith(".gz") for name in names)
    assert replay.files == len(names)
    assert sorted(r.value for r in spark.read.text(replay.path).collect()) == sorted(r.event for r in sent.collect())


def test_parts_are_merged_by_one_shuffle(spark, folder, monkeypatch):
    monkeypatch.setattr(stores, "FILE_BYTES", 1_500)
    put, plans = TableStore._put, []
    monkeypatch.setattr(TableStore, "_put", lambda self, rows, table, name, level: (
        plans.append((level, _exchanges(rows))), put(self, rows, table, name, level))[1])
    store = TableStore(spark, folder(), fanout=2)
    days = ("2015-06-10", "2015-06-11", None)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # small parts would be one file
    for batch in range(2):
        raw = spark.createDataFrame([(f"line {k}", days[k % 3]) for k in range(batch * 50, 150)], "event string, date string")
        counts = spark.createDataFrame([("a", "10", 2, days[0]), ("b", "10", batch, days[1])],
                                       "domain string, time string, clicks bigint, date string")
        store.commit(batch, {"raw_clicks": raw, "domain_hours": counts})
    spark.conf.set(setting, before)
    assert {level: n for level, n in plans}[1] == 1
    assert store.parts_per_day("raw_clicks") == 1
    assert Counter(r.event for r in store.read("raw_clicks").collect()) == Counter(f"line {k}" for k in range(150))
    # more than one file a day, and still one row a key
    part = next(p for p in store.state().parts if p.table == "raw_clicks" and p.day.endswith("10"))
    files = spark.read.parquet(f"{store.root}/parts/raw_clicks/{part.folder}/{part.day}")
    assert files.count() == 50 and len(files.inputFiles()) > 1
    assert {(r.domain, r.clicks) for r in store.read("domain_hours").collect()} == {("a", 4), ("b", 1)}
