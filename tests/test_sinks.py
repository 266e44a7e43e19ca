import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom import session
from clickloom.operators import count_table_of, enrich_documents, full_events, raw_by_day
from clickloom.plans import jobs
from clickloom.schema import COUNT_KEYS, SERVING_TABLES, UNITS, count_table
from clickloom.sinks import (
    create_tables, write_documents, write_full_events, write_lines, write_raw_clicks, write_table,
)
from clickloom.sources.lines import click_lines, parse_clicks
from clickloom.sources.serving import read_day, read_table
from tests.conftest import SAMPLE, click

DAY = 86400


def rows_of(df):
    return Counter(tuple(row) for row in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def many(lines):
    events = [click(_id=str(i), t=SAMPLE["t"] + 7001 * i, c=[None, "US", "SE"][i % 3],
                    u=[SAMPLE["u"], "", "x", "http://a.gov/"][i % 4]) for i in range(120)]
    return lines(*events, *events[:30], '{"h":"broken1', '{"_note":1}')


def test_write_replaces_only_its_days(spark, folder):
    path = folder()
    schema = "date string, domain string, time string, clicks bigint"
    write_table(spark.createDataFrame([("1", "a", "10:00", 1), ("2", "a", "10:00", 1)], schema), path)
    write_table(spark.createDataFrame([("2", "b", "10:00", 5)], schema), path)
    write_table(spark.createDataFrame([("2", "b", "10:00", 5)], schema), path)
    rows = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.date, r.domain, r.clicks) for r in rows) == [("1", "a", 1), ("2", "b", 5)]


def test_count_tables_equal_direct_counts(spark, many, folder):
    root = folder()
    jobs.build_serving(many, root)
    events = parse_clicks(click_lines(many))
    for subject in COUNT_KEYS:
        for unit in UNITS:
            table = read_table(spark, root, count_table(subject, unit))
            assert rows_of(table) == rows_of(count_table_of(events, subject, unit)), (subject, unit)
    sizes = {r["table"]: r["rows"] for r in jobs.table_sizes(spark, root).collect()}
    assert sizes["raw_clicks"] == 122 and sizes["click_ids"] == 120 and sizes["full_events"] == 121


def test_day_read_prunes_partitions_and_pushes_the_domain(spark, many, folder):
    root = folder()
    jobs.build_count_tables(parse_clicks(click_lines(many)), root)
    day = read_day(read_table(spark, root, "domain_minutes"), "2015-06-11", "a.gov")
    assert day.count() > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(domain,a.gov)" in plan


def test_setup_creates_and_resets(spark, folder):
    where = folder("db")
    create_tables(spark, "clicks_db", where)
    names = {row.tableName for row in spark.sql("SHOW TABLES IN clicks_db").collect()
             if not row.isTemporary}
    assert names == set(SERVING_TABLES) and len(names) == 12
    assert spark.table("clicks_db.full_events").columns[-1] == "date"
    assert len(spark.table("clicks_db.full_events").columns) == 17
    spark.sql("INSERT INTO clicks_db.domain_minutes VALUES ('a', '10:00', 1, '2015-06-10')")
    create_tables(spark, "clicks_db", where)
    assert spark.table("clicks_db.domain_minutes").count() == 1
    create_tables(spark, "clicks_db", where, reset=True)
    assert spark.table("clicks_db.domain_minutes").count() == 0
    spark.sql("DROP DATABASE clicks_db CASCADE")


def test_written_tables_open_by_name(spark, many, folder):
    """Files of the batch build are what the created tables read."""
    root = folder("db")
    create_tables(spark, "named_db", root)
    jobs.build_count_tables(parse_clicks(click_lines(many)), root)
    spark.sql("MSCK REPAIR TABLE named_db.country_hours")
    named = spark.table("named_db.country_hours")
    assert rows_of(named) == rows_of(read_table(spark, root, "country_hours"))
    spark.sql("DROP DATABASE named_db CASCADE")


def test_raw_table_holds_each_line_once(spark, many, folder):
    path = folder()
    for _ in range(2):
        write_raw_clicks(raw_by_day(many), path)
    assert spark.read.schema(SERVING_TABLES["raw_clicks"]).parquet(path).count() == 122


def test_full_events_once_per_day_and_id(spark, lines, folder):
    path = folder()
    events = [click(), click(), click(t=SAMPLE["t"] + DAY), {"h": "x", "t": 5}, {"h": "x", "t": 5}]
    write_full_events(full_events(parse_clicks(lines(*events))), path)
    rows = spark.read.schema(SERVING_TABLES["full_events"]).parquet(path).collect()
    assert Counter((r.date, r.id) for r in rows) == {
        ("2015-06-10", SAMPLE["_id"]): 1, ("2015-06-11", SAMPLE["_id"]): 1, ("1970-01-01", None): 2}


def test_documents_by_day(lines, folder):
    path = folder()
    write_documents(enrich_documents(parse_clicks(lines(SAMPLE, click(t=None)))), path)
    found = {}
    for file in Path(path).glob("date=*/*.json"):
        found[file.parent.name] = [json.loads(line) for line in file.read_text().splitlines()]
    assert set(found) == {"date=2015-06-10", "date=N%2FA"}
    assert found["date=2015-06-10"][0]["country"] == "Finland"


def test_pattern_documents(lines, folder):
    path = folder()
    jobs.run_hour_patterns(lines(SAMPLE, SAMPLE, click(tz="UTC"), '{"_note":1}'), path,
                           F.lit(SAMPLE["t"]))
    read = {name: [json.loads(line) for file in sorted(Path(path, name).glob("*.json"))
                   for line in file.read_text().splitlines()] for name in jobs.PATTERNS}
    assert read["query1"] == [{"@timestamp": "2015-06-10", "hour": "07", "counter": 3}]
    assert [d["timezone"] for d in read["query2"]] == ["Europe/Helsinki", "UTC"]
    assert read["query3"] == read["query1"]


def test_lines_as_text(spark, lines, folder):
    path = folder()
    write_lines(lines(SAMPLE), path)
    assert json.loads(spark.read.text(path).first().value) == SAMPLE


class FakeConf(dict):
    get = dict.get


class FakeSession:
    def __init__(self, **conf):
        self.conf = FakeConf({key.replace("__", "."): value for key, value in conf.items()})


def test_scratch_follows_the_cluster_setting():
    path = session.scratch_dir(FakeSession(spark__checkpoint__dir="s3://b/ck/"), "x")
    assert path.startswith("s3://b/ck/clickloom/x-")
    with pytest.raises(ValueError):
        session.scratch_dir(FakeSession(spark__master="yarn"), "x")
    assert "clickloom" in session.scratch_dir(FakeSession(spark__master="local[2]"), "x")
