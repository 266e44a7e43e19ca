"""Shapes of the physical plans, and results under skew."""

import pytest
from pyspark.sql import functions as F

from clickloom.catalog import catalog
from clickloom.operators import (
    count_table_of, distinct_ids, distinct_lines, hour_cube, lines_per_day, raw_by_day,
)
from clickloom.plans import reads
from clickloom.schema import COUNT_KEYS
from clickloom.sources.lines import click_lines, parse_clicks
from tests.conftest import TABLES

#: Queries that write or stream before they return are covered by their own tests.
EAGER = ("stream_", "envelope_", "pattern_documents", "serving_tables", "document_files",
         "export_files")
LAZY = [name for name in catalog() if not name.startswith(EAGER) and not name.endswith("_latest")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(catalog()[name](spark, TABLES))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in plan


@pytest.mark.parametrize("name", ["day_hour_top20", "top20_timezones", "top50_domains", "first_clicks",
                                  "domain_evolution_last40"])
def test_limits_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan_of(catalog()[name](spark, TABLES))


def test_per_day_rank_is_cut_before_the_shuffle(spark):
    assert plan_of(catalog()["top_countries"](spark, TABLES)).count("WindowGroupLimit") == 2


def test_only_needed_columns_are_read(spark):
    plan = plan_of(catalog()["country_minutes"](spark, TABLES))
    assert "html" not in plan and "props" not in plan and "ReadSchema: struct<event_id:bigint,ts:" in plan


@pytest.mark.parametrize("make", [
    lambda events: count_table_of(events, "domain", "minute"), hour_cube,
])
def test_counts_combine_before_the_shuffle(spark, make):
    events = spark.createDataFrame([(0, "US", "http://a.gov/", "x")], "t bigint, c string, u string, tz string")
    plan = plan_of(make(events.repartition(2)))
    assert plan.index("functions=[count(1)]") < plan.index("Exchange") < plan.index("partial_count")


@pytest.fixture
def skewed(spark):
    """30,000 lines: a third is one line, a third shares one second, domain and country."""
    hot = F.lit('{"h":"hot","_id":"hot","t":1433894400,"c":"US","u":"http://hot.gov/","tz":"x"}')
    near = F.format_string(
        '{"h":"%d","_id":"%d","t":1433894400,"c":"US","u":"http://hot.gov/%d","tz":"x"}', "id", "id", "id")
    cold = F.format_string(
        '{"h":"%d","_id":"%d","t":%d,"c":"SE","u":"http://d%d.gov/","tz":"y"}', "id", "id",
        F.col("id") + 1433894400, F.col("id") % 500)
    kind = F.col("id") % 3
    return spark.range(0, 30000, 1, 8).select(F.when(kind == 0, hot).when(kind == 1, near)
                                              .otherwise(cold).alias("event"))


def test_hot_keys_give_whole_results(spark, skewed):
    events = parse_clicks(click_lines(skewed))
    for subject in COUNT_KEYS:
        for unit in ("second", "minute"):
            counts = count_table_of(events, subject, unit)
            assert counts.agg(F.sum("clicks"), F.max("clicks")).first()[0] == 30000
            assert counts.where("time LIKE '00:00%'").agg(F.max("clicks")).first()[0] == 20000
    raw = raw_by_day(skewed)
    assert lines_per_day(raw).first().clicks == 20001
    assert distinct_lines(raw).count() == 20001
    ids = events.select(F.lit("d").alias("date"), F.col("_id").alias("id"))
    assert distinct_ids(ids).count() == 20001
    top = reads.top_domains(count_table_of(events, "domain", "second"), "2015-06-10", 1).first()
    assert (top.domain, top.clicks) == ("hot.gov", 20000)


def shuffled_rows(spark, df):
    """Rows written to the shuffle of an executed query."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        node = execution.executedPlan()
        while node.nodeName() != "Exchange":
            node = node.children().apply(0)
        return node.metrics().apply("shuffleRecordsWritten").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_line_costs_one_row_per_task(spark, skewed):
    hot = skewed.where("event LIKE '%\"h\":\"hot\"%'")
    assert shuffled_rows(spark, distinct_lines(raw_by_day(hot))) <= 8
    assert shuffled_rows(spark, count_table_of(parse_clicks(hot), "domain", "second")) <= 8
