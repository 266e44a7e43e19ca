from collections import Counter
import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickloom.operators import (
    count_table_of, day_hour_counts, exclude_value, hour_counts, hour_cube, rank_per_day, roll_up, top,
    tz_hour_counts,
)
from clickloom.plans import dashboards, jobs
from clickloom.schema import COUNT_KEYS, UNITS

EVENTS = "t bigint, c string, u string, tz string"
WIDTH = {"hour": 2, "minute": 5, "second": 8}


def rows_of(df):
    return Counter(tuple(row) for row in df.collect())


def expected(events, keys, unit):
    counts = Counter()
    for t, c, u, _ in events:
        domain = None if u is None else "N/A" if u == "" else (u.split("/") + [""] * 3)[2] or None
        found = [{"domain": domain, "country_code": c}[key] for key in keys]
        if t is None or None in found:
            continue
        at = dt.datetime.fromtimestamp(t, dt.timezone.utc)
        counts[(f"{at:%Y-%m-%d}", *found, f"{at:%H:%M:%S}"[:WIDTH[unit]])] += 1
    return Counter({(*key, n): 1 for key, n in counts.items()})


clicks = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(1433894400 - 200, 1433894400 + 200)),
    st.sampled_from([None, "US", "SE", ""]),
    st.sampled_from([None, "", "x", "http://", "http://a.gov/1", "http://b.gov"]),
    st.sampled_from([None, "", "Europe/Stockholm"]),
), min_size=1, max_size=80)


@settings(max_examples=4, deadline=None)
@given(clicks)
def test_counts_equal_brute_force(spark, events):
    df = spark.createDataFrame(events, EVENTS)
    for subject, keys in COUNT_KEYS.items():
        for unit in UNITS:
            assert rows_of(count_table_of(df, subject, unit)) == expected(events, keys, unit)
        minutes = count_table_of(df, subject, "minute")
        assert rows_of(roll_up(minutes, "hour")) == expected(events, keys, "hour")


@settings(max_examples=4, deadline=None)
@given(clicks)
def test_hour_patterns_equal_brute_force(spark, events):
    df = spark.createDataFrame(events, EVENTS)
    cube, run = hour_cube(df), F.lit(0).cast("bigint")

    def hour(t):
        return None if t is None else f"{dt.datetime.fromtimestamp(t, dt.timezone.utc):%H}"

    def day(t):
        return None if t is None else f"{dt.datetime.fromtimestamp(t, dt.timezone.utc):%Y-%m-%d}"

    def counted(key):
        return Counter({(*k, n): 1 for k, n in Counter(map(key, events)).items()})

    assert rows_of(hour_counts(cube, run)) == counted(lambda e: ("1970-01-01", hour(e[0])))
    assert rows_of(tz_hour_counts(cube, run)) == counted(lambda e: ("1970-01-01", e[3], hour(e[0])))
    assert rows_of(day_hour_counts(cube)) == counted(lambda e: (day(e[0]), hour(e[0])))


def test_pattern_order(spark):
    t = 1433894400
    events = [(t, None, None, "b"), (t + 3600, None, None, "a"), (t + 3700, None, None, "a"),
              (None, None, None, None), (t, None, None, "a")]
    cube = hour_cube(spark.createDataFrame(events, EVENTS))
    run = F.lit(t)
    assert [(r.hour, r.counter) for r in hour_counts(cube, run).collect()] == [
        ("00", 2), ("01", 2), (None, 1)]
    assert [(r.timezone, r.hour) for r in tz_hour_counts(cube, run).collect()] == [
        (None, None), ("a", "01"), ("a", "00"), ("b", "00")]


def test_shared_cube_equals_direct_patterns(spark):
    events = [(1433894400 + 977 * i, None, None, f"z{i % 3}") for i in range(500)]
    df = spark.createDataFrame(events, EVENTS)
    shared = jobs.hour_patterns(df, F.lit(0).cast("bigint"))
    assert rows_of(shared["query1"]) == rows_of(hour_counts(hour_cube(df), F.lit(0).cast("bigint")))
    assert rows_of(shared["query3"]) == rows_of(day_hour_counts(hour_cube(df)))


def test_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "k string, clicks bigint")
    assert [r.k for r in top(df, "k", 2).collect()] == ["c", "a"]
    assert [r.k for r in top(df, "k").collect()] == ["c", "a", "b", "d"]


def test_rank_per_day(spark):
    rows = [(d, k, n) for d in ("1", "2") for k, n in (("a", 1), ("b", 2), ("c", 2))]
    df = spark.createDataFrame(rows, "date string, k string, clicks bigint")
    assert sorted((r.date, r.k) for r in rank_per_day(df, "k", 2).collect()) == [
        ("1", "b"), ("1", "c"), ("2", "b"), ("2", "c")]


def test_exclude_value_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r.k for r in exclude_value(df, "k", "a").collect()] == ["b", None]


DOCS = "t bigint, location array<double>, domain string, timezone string, short_url_cname string, known_user int"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([
        (0, [11.9668, 57.7072], "a.gov", "x", "bit.ly", 1), (59, [11.9668, 57.7072], "a.gov", "y", "bit.ly", 0),
        (60, None, "b.gov", "x", "go.example.org", None), (None, [0.0, 0.0], None, None, None, 1),
    ], DOCS)


def test_panels(docs):
    assert rows_of(dashboards.docs_per_minute(docs)) == rows_of(docs.sparkSession.createDataFrame(
        [("1970-01-01 00:00", 2), ("1970-01-01 00:01", 1)], "m string, n bigint"))
    assert dashboards.period_total(docs, 0, 60).first().clicks == 2
    assert {r.short_url_cname: r.share for r in dashboards.method_share(docs).collect()} == {
        "bit.ly": 2 / 3, "go.example.org": 1 / 3}
    assert [r.timezone for r in dashboards.top_timezones(docs, 1).collect()] == ["x"]
    assert [r.domain for r in dashboards.top_document_domains(docs).collect()] == ["a.gov", "b.gov"]
    assert {r.cell: r.clicks for r in dashboards.geo_heatmap(docs, 7).collect()} == {
        "u628233": 2, "s000000": 1}
    assert {r.known_user: r.clicks for r in dashboards.known_vs_new(docs).collect()} == {1: 2, 0: 1}


def test_hour_panels(spark):
    zones = spark.createDataFrame([("x", "03", 2), ("x", "01", 2), ("x", None, 9), ("y", "23", 1)],
                                  "timezone string, hour string, counter bigint")
    assert {r.timezone: (r.hour, r.counter) for r in dashboards.tz_peak_hour(zones).collect()} == {
        "x": ("01", 2), "y": ("23", 1)}
    wide = {r.timezone: r for r in dashboards.tz_lines(zones).collect()}
    assert (wide["x"].h03, wide["x"].h00, wide["y"].h23) == (2, 0, 1)
    assert [r.hour for r in dashboards.batch_histogram(zones).collect()] == ["01", "03", "23"]
    assert dashboards.batch_total(zones).first().clicks == 14
