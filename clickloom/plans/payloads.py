"""The JSON payloads a dashboard page loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.clock import day_label

# Names, descriptions and keys of the payloads.
GLOBAL_COUNTER = ("globalcounter", "Contador de accesos diarios")
TOP_COUNTRY = ("topcountry", "Top urls acortadas por pais")
TOP_DOMAIN = ("topurl", "Top 20 URL's usa.gov acortadas")
EVOLUTION = ("EvolutionByDomain", "Evolución diaria de un dominio")


def _head(title: tuple[str, str]) -> list[Column]:
    return [F.lit(title[0]).alias("name_query"), F.lit(title[1]).alias("description")]


def _payload(title: tuple[str, str], results: DataFrame, *extra: Column) -> DataFrame:
    """One row with one JSON text. Only for results with a fixed bound of rows.

    Rows are put in order by their ``rank``; no rows give an empty list.
    """
    fields = [name for name in results.columns if name != "rank"]
    item = F.struct("rank", F.struct(*fields).alias("item"))
    listed = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"])
    body = results.agg(listed.alias("results"))
    return body.select(F.to_json(F.struct(*_head(title), *extra, "results")).alias("payload"))


def counter_payload(counter: DataFrame, day: str | Column) -> DataFrame:
    """The daily counter with the long label of its day."""
    day = F.lit(day) if isinstance(day, str) else day
    rows = counter.select(F.lit(1).alias("rank"), F.col("clicks").cast("string").alias("contador"))
    return _payload(GLOBAL_COUNTER, rows, day_label(day).alias("date"))


def evolution_payload(series: DataFrame) -> DataFrame:
    """One domain's minutes of one day: 1,440 rows at most."""
    minute = F.concat_ws(" ", "date", "time")
    rows = series.select(minute.alias("rank"), minute.alias("date"),
                         F.col("domain").alias("dominio"), F.col("clicks").alias("contador"))
    return _payload(EVOLUTION, rows)


def _payload_lines(title: tuple[str, str], counts: DataFrame, key: str, item: Column) -> DataFrame:
    """A payload as its text lines, in order of the counts.

    The list can have any length, so it is not gathered into one value: the lines are sorted
    across tasks, and the files written from them concatenate to the payload.
    """
    first = counts.orderBy(F.desc("clicks"), key).limit(1).select(key).scalar()
    comma = F.when(F.col(key) == first, "").otherwise(",")
    body = counts.select(F.lit(1).alias("part"), (-F.col("clicks")).alias("n"),
                         F.col(key).alias("key"), F.concat(comma, F.to_json(item)).alias("line"))
    head = F.rtrim(F.to_json(F.struct(*_head(title))), F.lit("}"))
    ends = counts.sparkSession.range(2).select(
        (F.col("id") * 2).cast("int").alias("part"), F.lit(0).cast("bigint").alias("n"),
        F.lit("").alias("key"),
        F.when(F.col("id") == 0, F.concat(head, F.lit(',"results":['))).otherwise("]}").alias("line"))
    return body.unionByName(ends).orderBy("part", "n", "key").select("line")


def country_payload_lines(countries: DataFrame) -> DataFrame:
    """All countries; the codes come from the clicks, so there may be more than are known."""
    item = F.struct("country", F.col("clicks").cast("string").alias("contador"))
    return _payload_lines(TOP_COUNTRY, countries, "country_code", item)


def domain_payload_lines(domains: DataFrame) -> DataFrame:
    """All domains."""
    item = F.struct(F.col("domain").alias("dominio"), F.col("clicks").cast("string").alias("contador"))
    return _payload_lines(TOP_DOMAIN, domains, "domain", item)
