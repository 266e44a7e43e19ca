"""Totals of periods, cells of all zooms, point reads and registered tables."""

import random

from pyspark.sql import functions as F

from clickloom.plans import dashboards
from clickloom.plans.periods import BLOCK, period_totals, write_running_sums
from clickloom.sinks.tables import catalogue, register_tables, write_table
from clickloom.sources.serving import point_read, stored_days

DAY = 86_400


def test_periods_against_counting(spark, folder):
    chooser, root = random.Random(2), folder()
    # days apart by more than a block, before 1970 too, many clicks in one minute
    days = [-3 * BLOCK, -1, 0, 1, 2, BLOCK - 1, BLOCK, 5 * BLOCK + 7]
    times = [chooser.choice(days) * DAY + chooser.randrange(DAY) for _ in range(400)] + [DAY + 59] * 50 + [None] * 5
    write_running_sums(spark.createDataFrame([(t,) for t in times], "t bigint"), root)
    bounds = [chooser.choice([*days, -9 * BLOCK, 3, 4 * BLOCK, 99 * BLOCK]) * DAY + chooser.randrange(1440) * 60 for _ in range(300)]
    periods = [(a, b) for a, b in zip(bounds, bounds[1:])] + [(DAY, DAY + 60), (DAY + 60, DAY + 120), (0, 0)]
    done = period_totals(spark, root, spark.createDataFrame(periods, "start bigint, end bigint")).collect()
    assert len(done) == len(periods)
    for r in done:
        assert r.clicks == sum(t is not None and r.start <= t < r.end for t in times)


def test_periods_without_clicks(spark, folder):
    root = folder()
    write_running_sums(spark.createDataFrame([], "t bigint"), root)
    periods = spark.createDataFrame([(0, 600)], "start bigint, end bigint")
    assert [r.clicks for r in period_totals(spark, root, periods).collect()] == [0]


def test_every_zoom_equals_a_map_of_its_own(spark):
    chooser = random.Random(3)
    places = [[chooser.uniform(-180, 180), chooser.uniform(-90, 90)] for _ in range(300)]
    places += [[180.0, 90.0], [-180.0, -90.0], [0.0, 0.0], [-0.0001, 0.0001], None] + [[12.5, 41.9]] * 20
    docs = spark.createDataFrame([(p,) for p in places], "location array<double>")
    rows = dashboards.geo_pyramid(docs).collect()
    for p in range(1, 8):
        want = {r.cell: r.clicks for r in dashboards.geo_heatmap(docs, p).collect()}
        assert {r.cell: r.clicks for r in rows if r.precision == p} == want


def scanned(df):
    """Rows that the file scan of a plan has given out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_point_reads_open_one_day_and_skip_row_groups(spark, folder):
    root = folder()
    rows = [(f"d{k:05d}.gov", f"{h:02d}:00", 1, day) for day in ("2024-01-01", "2024-01-02", "N/A")
            for k in range(0, 2000, 2) for h in range(2)]
    counts = spark.createDataFrame(rows, "domain string, time string, clicks bigint, date string")
    write_table(counts, f"{root}/domain_minutes")
    assert stored_days(spark, root, "domain_minutes") == ["2024-01-01", "2024-01-02", "N/A"]
    found = point_read(spark, root, "domain_minutes", "d00010.gov")
    assert {(r.date, r.time) for r in found.collect()} == {("2024-01-02", "00:00"), ("2024-01-02", "01:00")}
    # lies between others, so that only the Bloom filter can tell it is not there
    absent = point_read(spark, root, "domain_minutes", "d00011.gov")
    assert scanned(absent) == 0 and scanned(found) > 0
    assert point_read(spark, root, "domain_minutes", "d00010.gov", "2024-01-01").count() == 2


def test_registered_tables(spark, folder):
    root = folder()
    counts = spark.createDataFrame([("a", "00:01", 1, "2024-01-01"), ("b", "00:01", 2, "N/A")],
                                   "domain string, time string, clicks bigint, date string")
    write_table(counts, f"{root}/domain_minutes")
    register_tables(spark, "registered", root, ["domain_minutes"])
    assert [tuple(r) for r in catalogue(spark, "registered", ["domain_minutes"]).collect()] == [("domain_minutes", 2, 2)]
    write_table(counts.withColumn("date", F.lit("2024-01-09")), f"{root}/domain_minutes")
    register_tables(spark, "registered", root, ["domain_minutes"])
    spark.catalog.refreshTable("registered.domain_minutes")
    assert spark.table("registered.domain_minutes").where("date = '2024-01-09'").count() == 2
    plan = spark.sql("DESCRIBE EXTENDED registered.domain_minutes").where("col_name = 'Statistics'").first()
    assert plan is not None and "bytes" in plan.data_type
    spark.sql("DROP DATABASE registered CASCADE")
