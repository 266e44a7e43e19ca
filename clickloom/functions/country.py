"""Country names."""

from __future__ import annotations

from string import ascii_uppercase

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_cache: dict[tuple[str, str], list[tuple[str, str]]] = {}


def _locale_names(spark: SparkSession, lang: str) -> list[tuple[str, str]]:
    """Every two-letter code that has a display name in ``lang``, from the JVM's locale data.

    Withdrawn and reserved codes have names too; one without a name stands for itself. ``ZZ``,
    the code for no known country, is left as it is.
    """
    key = (spark.sparkContext.applicationId, lang)
    if key not in _cache:
        locale = spark.sparkContext._jvm.java.util.Locale
        language = locale.forLanguageTag(lang)
        codes = [a + b for a in ascii_uppercase for b in ascii_uppercase if a + b != "ZZ"]
        named = [(code, locale("", code).getDisplayCountry(language)) for code in codes]
        _cache[key] = [(code, name) for code, name in named if name != code]
    return _cache[key]


def country_names(spark: SparkSession, lang: str = "en") -> DataFrame:
    """The dimension ``code, country``: at most 676 rows, whatever the click volume."""
    rows = _locale_names(spark, lang)
    return spark.createDataFrame(pa.table({
        "code": [code for code, _ in rows],
        "country": [name for _, name in rows],
    }))


def with_country(df: DataFrame, code: str = "country_code", lang: str = "en",
                 name: str = "country") -> DataFrame:
    """Add the country's name; an unknown code stands for itself, in capitals.

    The dimension has one row per two-letter code, so it is always small enough to broadcast.
    """
    dim = country_names(df.sparkSession, lang).toDF("_iso", "_name")
    upper: Column = F.upper(F.col(code))
    return (
        df.join(F.broadcast(dim), upper == F.col("_iso"), "left")
        .withColumn(name, F.coalesce("_name", upper))
        .drop("_iso", "_name")
    )
