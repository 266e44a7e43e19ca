"""Dashboard reads of the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.country import with_country
from clickloom.operators.dedup import lines_per_day
from clickloom.operators.filters import exclude_value
from clickloom.operators.topk import rank_per_day, top
from clickloom.sources.serving import read_day

#: Bars of the country chart.
TOP_COUNTRIES = 30
#: Points of a domain's evolution in the first view.
LAST_POINTS = 40
HOME_COUNTRY = "United States"


def _total(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("clicks").alias("clicks"))


def daily_counter(raw_clicks: DataFrame, day: str | Column | None = None) -> DataFrame:
    """Different lines of one day; a day without rows counts 0."""
    rows = read_day(raw_clicks, day)
    return lines_per_day(rows).agg(F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"))


def daily_counters(raw_clicks: DataFrame) -> DataFrame:
    """Different lines of every day."""
    return lines_per_day(raw_clicks)


def top_countries(counts: DataFrame, day: str | Column | None = None,
                  n: int | None = TOP_COUNTRIES, lang: str = "en") -> DataFrame:
    """Countries of one day by clicks. Takes the minute table or the second table.

    The name is joined after the cut, so at most ``n`` rows meet the dimension.
    """
    rows = top(_total(read_day(counts, day), "country_code"), "country_code", n)
    return with_country(rows, "country_code", lang).orderBy(F.desc("clicks"), "country_code")


def top_countries_per_day(counts: DataFrame, n: int = TOP_COUNTRIES, lang: str = "en") -> DataFrame:
    """:func:`top_countries` for every day at once."""
    ranked = rank_per_day(_total(counts, "date", "country_code"), "country_code", n)
    return with_country(ranked, "country_code", lang)


def without_home(countries: DataFrame, name: str = HOME_COUNTRY) -> DataFrame:
    """Take one country out of an already cut list, which gets one row shorter."""
    return exclude_value(countries, "country", name)


def top_domains(counts: DataFrame, day: str | Column | None = None,
                n: int | None = None) -> DataFrame:
    """Domains of one day by clicks, all of them unless ``n`` is given."""
    return top(_total(read_day(counts, day), "domain"), "domain", n)


def top_domains_per_day(counts: DataFrame) -> DataFrame:
    """:func:`top_domains` for every day at once, all domains."""
    return _total(counts, "date", "domain").orderBy("date", F.desc("clicks"), "domain")


def _series(counts: DataFrame) -> DataFrame:
    return _total(counts, "date", "time", "domain").select("date", "time", "domain", "clicks")


def domain_evolution(counts: DataFrame, domain: str | Column,
                     day: str | Column | None = None) -> DataFrame:
    """One domain's clicks per minute of one day, in time order."""
    return _series(read_day(counts, day, domain)).orderBy("date", "time")


def domain_history(counts: DataFrame, domain: str | Column) -> DataFrame:
    """:func:`domain_evolution` over all days."""
    return _series(counts.where(F.col("domain") == domain)).orderBy("date", "time")


def last_points(series: DataFrame, n: int = LAST_POINTS) -> DataFrame:
    """The newest ``n`` points of a series, in time order."""
    return series.orderBy(F.desc("date"), F.desc("time")).limit(n).orderBy("date", "time")


def busiest_domain(counts: DataFrame) -> Column:
    """The domain at the head of the list, as a scalar subquery."""
    return top(_total(counts, "domain"), "domain", 1).select("domain").scalar()
