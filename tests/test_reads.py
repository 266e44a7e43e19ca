import json

import pytest

from clickloom.operators import raw_by_day
from clickloom.plans import payloads, reads
from clickloom.sources.serving import latest_day, read_day
from tests.conftest import SAMPLE, click

DAY = "2015-06-10"


@pytest.fixture
def countries(spark):
    rows = [(DAY, "US", "10:00", 5), (DAY, "US", "10:01", 5), (DAY, "SE", "10:00", 3), (DAY, "GB", "10:00", 3),
            (DAY, "ZZ", "10:00", 1), ("2015-06-09", "SE", "10:00", 99)]
    return spark.createDataFrame(rows, "date string, country_code string, time string, clicks bigint")


@pytest.fixture
def domains(spark):
    rows = [(DAY, "a.gov", f"{10 + i // 60}:{i % 60:02d}", i + 1) for i in range(100)]
    rows += [(DAY, "b.gov", "10:00", 7), (DAY, "b.gov", "10:00", 7), ("2015-06-09", "b.gov", "10:00", 9)]
    return spark.createDataFrame(rows, "date string, domain string, time string, clicks bigint")


def test_top_countries(countries):
    rows = reads.top_countries(countries, DAY).collect()
    assert [(r.country, r.clicks) for r in rows] == [
        ("United States", 10), ("United Kingdom", 3), ("Sweden", 3), ("ZZ", 1)]
    assert [r.country for r in reads.without_home(reads.top_countries(countries, DAY, 2)).collect()] == [
        "United Kingdom"]


def test_thirty_then_without_home(spark):
    rows = [(DAY, f"{chr(65 + i // 26)}{chr(65 + i % 26)}", "10:00", 1) for i in range(40)]
    rows += [(DAY, "US", "10:00", 50)]
    df = spark.createDataFrame(rows, "date string, country_code string, time string, clicks bigint")
    top = reads.top_countries(df, DAY)
    assert top.count() == 30 and reads.without_home(top).count() == 29
    assert reads.top_countries_per_day(df).count() == 30


def test_per_day_equals_single_days(countries):
    every = {(r.date, r.country_code, r.clicks) for r in reads.top_countries_per_day(countries).collect()}
    single = {(day, r.country_code, r.clicks) for day in (DAY, "2015-06-09")
              for r in reads.top_countries(countries, day).collect()}
    assert every == single


def test_top_domains(domains):
    assert [(r.domain, r.clicks) for r in reads.top_domains(domains, DAY).collect()] == [
        ("a.gov", 5050), ("b.gov", 14)]
    assert reads.top_domains(domains, DAY, 1).count() == 1
    assert [tuple(r) for r in reads.top_domains_per_day(domains).collect()] == [
        ("2015-06-09", "b.gov", 9), (DAY, "a.gov", 5050), (DAY, "b.gov", 14)]


def test_evolution_sums_split_minutes(domains):
    assert [(r.time, r.clicks) for r in reads.domain_evolution(domains, "b.gov", DAY).collect()] == [
        ("10:00", 14)]
    series = reads.domain_evolution(domains, "a.gov", DAY)
    assert [r.time for r in series.collect()] == [f"{10 + i // 60}:{i % 60:02d}" for i in range(100)]
    assert [r.clicks for r in reads.last_points(series).collect()] == list(range(61, 101))


def test_busiest_and_latest(domains):
    assert reads.domain_history(domains, reads.busiest_domain(domains)).count() == 100
    assert read_day(domains, latest_day(domains)).count() == 102
    assert read_day(domains).count() == 0


def test_daily_counter(lines):
    raw = raw_by_day(lines(SAMPLE, SAMPLE, click(_id="2"), {"h": "x"}))
    assert reads.daily_counter(raw, DAY).first().clicks == 2
    assert reads.daily_counter(raw, "2000-01-01").first().clicks == 0


def load(df):
    return json.loads(df.first().payload)


def test_payloads(lines, countries, domains):
    raw = raw_by_day(lines(SAMPLE, SAMPLE))
    assert load(payloads.counter_payload(reads.daily_counter(raw, DAY), DAY)) == {
        "name_query": "globalcounter", "description": "Contador de accesos diarios",
        "date": "Wed, 10 Jun 2015", "results": [{"contador": "1"}]}
    evolution = load(payloads.evolution_payload(reads.domain_evolution(domains, "b.gov", DAY)))
    assert evolution["results"] == [{"date": f"{DAY} 10:00", "dominio": "b.gov", "contador": 14}]


def test_whole_country_payload(countries):
    text = payloads.country_payload_lines(reads.top_countries(countries, DAY, None))
    whole = json.loads("".join(row.line for row in text.collect()))
    assert whole["results"][:2] == [{"country": "United States", "contador": "10"},
                                    {"country": "United Kingdom", "contador": "3"}]


def test_payload_of_nothing(countries):
    text = payloads.country_payload_lines(reads.top_countries(countries, "2000-01-01", None))
    assert json.loads("".join(row.line for row in text.collect()))["results"] == []


@pytest.mark.parametrize("day, found", [(DAY, ["a.gov", "b.gov"]), ("2000-01-01", [])])
def test_domain_payload_lines(spark, domains, folder, day, found):
    text = payloads.domain_payload_lines(reads.top_domains(domains, day))
    whole = json.loads("".join(row.line for row in text.collect()))
    assert whole["name_query"] == "topurl"
    assert [item["dominio"] for item in whole["results"]] == found
