"""Counts that are known for the middle-sized tables."""

from pyspark.sql import functions as F

from clickloom.operators import count_table_of, roll_up, top
from clickloom.sources.derived import derived_clicks, derived_lines
from clickloom.sources.lines import click_lines, parse_clicks

TABLES = "/root/testdata/sf0.01"


def test_line_counts(spark):
    lines = derived_lines(spark, TABLES)
    assert (lines.count(), lines.distinct().count()) == (10530, 10030)
    clicks = parse_clicks(click_lines(lines), "_id", "_corrupt_record")
    assert clicks.count() == 10510
    assert clicks.where(F.col("_corrupt_record").isNotNull()).count() == 10
    assert clicks.agg(F.countDistinct("_id")).first()[0] == 10000


def test_count_tables(spark):
    clicks = derived_clicks(spark, TABLES)

    def size(counts):
        return tuple(counts.agg(F.count(F.lit(1)), F.sum("clicks")).first())

    assert size(count_table_of(clicks, "domain", "second")) == (9655, 9655)
    minutes = count_table_of(clicks, "domain", "minute")
    assert size(minutes) == (9639, 9655)
    assert size(roll_up(minutes, "hour")) == (8148, 9655)
    countries = count_table_of(clicks, "country", "minute")
    assert size(countries) == (9349, 9649)
    assert size(roll_up(countries, "hour")) == (2717, 9649)
    assert size(count_table_of(clicks, "country_domain", "minute")) == (9452, 9458)
    totals = countries.groupBy("country_code").agg(F.sum("clicks").alias("clicks"))
    assert {r.country_code: r.clicks for r in totals.collect()} == {
        "US": 3839, "SE": 1991, "ZZ": 1927, "GB": 1892}
    domains = minutes.groupBy("domain").agg(F.sum("clicks").alias("clicks"))
    assert [tuple(r) for r in top(domains, "domain", 3).collect()] == [
        ("blog.tionsh.example.net", 1096), ("thther.example.org", 510), ("blog.ththan.example.net", 470)]
