"""The versioned tables: whole batches, repeats, stops in between, compaction, cleaning."""

from collections import Counter

import pytest

from clickloom.operators import count_table_of
from clickloom.session import folder_names
from clickloom.sinks.store import TableStore
from clickloom.sources.lines import click_lines, parse_clicks
from clickloom.streaming.feed import line_feed
from clickloom.streaming.tables import LIVE_COUNTS, start_tables
from tests.conftest import SAMPLE, click

ROWS = "date string, domain string, time string, clicks bigint"


def counts(spark, *rows):
    return spark.createDataFrame(rows, ROWS).select("domain", "time", "clicks", "date")


def found(store, table="domain_minutes", *days):
    return Counter({(r.date, r.domain, r.time): r.clicks for r in store.read(table, *days).collect()})


def test_batches_add_up(spark, folder):
    store = TableStore(spark, folder())
    assert store.state().batch == -1 and found(store) == {} and store.latest_day("domain_minutes") is None
    assert store.commit(0, {"domain_minutes": counts(spark, ("2024-01-01", "a", "00:01", 2), ("N/A", None, None, 1))})
    assert store.commit(3, {"domain_minutes": counts(spark, ("2024-01-01", "a", "00:01", 5), ("2024-01-02", "b", "00:02", 1))})
    assert found(store) == {("2024-01-01", "a", "00:01"): 7, ("2024-01-02", "b", "00:02"): 1, ("N/A", None, None): 1}
    assert store.days("domain_minutes") == ["2024-01-01", "2024-01-02", "N/A"]
    assert store.latest_day("domain_minutes") == "2024-01-02"
    assert found(store, "domain_minutes", "2024-01-02") == {("2024-01-02", "b", "00:02"): 1}
    files = store.read("domain_minutes", "2024-01-02").inputFiles()
    assert files and all("day=2024-01-02" in file for file in files)


def test_a_repeated_batch_changes_nothing(spark, folder):
    store, rows = TableStore(spark, folder()), counts(spark, ("2024-01-01", "a", "00:01", 2))
    assert store.commit(0, {"domain_minutes": rows}) and not store.commit(0, {"domain_minutes": rows})
    assert sum(found(store).values()) == 2


def test_a_stop_between_parts_and_switch(spark, folder, monkeypatch):
    store = TableStore(spark, folder(), fanout=2)
    store.commit(0, {"domain_minutes": counts(spark, ("2024-01-01", "a", "00:01", 2))})
    with monkeypatch.context() as broken:
        broken.setattr(store, "_switch", lambda state: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            store.commit(1, {"domain_minutes": counts(spark, ("2024-01-01", "a", "00:01", 40), ("2024-01-09", "x", "00:01", 9))})
    assert store.clean() == 0   # what the stopped batch wrote belongs to a batch still to come
    assert found(store) == {("2024-01-01", "a", "00:01"): 2}
    store.commit(1, {"domain_minutes": counts(spark, ("2024-01-01", "a", "00:01", 3))})
    assert found(store) == {("2024-01-01", "a", "00:01"): 5}


def test_parts_stay_few_and_old_ones_go(spark, folder):
    root = folder()
    store = TableStore(spark, root, fanout=3)
    for batch in range(14):
        store.commit(batch, {"domain_minutes": counts(spark, ("2024-01-01", "a", "00:01", 1), (f"2024-02-{batch + 1:02d}", "b", "00:02", 1)),
                             "raw_clicks": spark.createDataFrame([("same", "2024-01-01"), (str(batch), "2024-01-01")], "event string, date string")})
        assert store.parts_per_day("domain_minutes") <= 2 * 3
    reader = store.read("domain_minutes")
    assert found(store)["2024-01-01", "a", "00:01"] == 14 and len(found(store)) == 15
    assert store.read("raw_clicks").count() == 15
    assert store.clean() > 0
    assert reader.count() == 15    # a reader of the version in force goes on
    named = {part.folder for part in store.state().parts if part.table == "raw_clicks"}
    assert len(folder_names(spark, f"{root}/parts/raw_clicks")) <= len(named) + 3
    assert len(folder_names(spark, f"{root}/manifest")) == 2


def deliver(spark, path, *events):
    import json
    import os
    import uuid
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{uuid.uuid4().hex}.tmp", "w") as file:
        file.write("\n".join(e if isinstance(e, str) else json.dumps(e, separators=(",", ":")) for e in events) + "\n")
    os.rename(file.name, file.name.replace(".tmp", ".txt"))


def run(spark, landing, root, state, **more):
    query = start_tables(spark, line_feed(spark, landing, 1), root, state, **more)
    query.awaitTermination()
    return query


def test_live_tables_read_the_feed_once_and_survive_a_stop(spark, lines, folder, monkeypatch):
    landing, root, state = folder("landing"), folder("root"), folder("state")
    day = 86_400
    first = [SAMPLE, SAMPLE, click(c=None, _id="x"), '{"_note":1}']
    late = [click(t=SAMPLE["t"] - 40 * day, _id="late"), click(_id="more"), '{"h":"broken']
    deliver(spark, landing, *first)
    query = run(spark, landing, root, state)
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(first)   # one scan for eleven tables
    deliver(spark, landing, *late)
    with monkeypatch.context() as broken:
        broken.setattr(TableStore, "_switch", lambda self, new: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(Exception, match="stopped"):
            run(spark, landing, root, state)
    store = TableStore(spark, root)
    assert store.state().batch == 0
    run(spark, landing, root, state)
    assert store.state().batch == 1
    everything = [*first, *late]
    events = parse_clicks(click_lines(lines(*everything)))
    for table in LIVE_COUNTS:
        subject, unit = table.rsplit("_", 1)
        want = count_table_of(events, subject, unit[:-1])
        got = store.read(table).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), table
    assert store.read("raw_clicks").count() == 6 and store.read("click_ids").count() == 4
    assert folder_names(spark, f"{root}/arrived") == []
