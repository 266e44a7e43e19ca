"""Projections of click lines and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import MISSING, epoch_text_unit, epoch_unit, iso_utc
from clickloom.functions.country import with_country
from clickloom.functions.geo import inverted_location
from clickloom.functions.web import domain_of
from clickloom.operators.filters import with_values
from clickloom.schema import DOCUMENT_NAMES, FULL_EVENT_FIELDS, FULL_EVENT_NAMES


def strip_spaces(lines: DataFrame) -> DataFrame:
    """Remove every space of the line, also those inside values."""
    return lines.withColumn("event", F.replace("event", F.lit(" "), F.lit("")))


def drop_coordinates(events: DataFrame) -> DataFrame:
    return events.drop("ll")


def rename_fields(events: DataFrame) -> DataFrame:
    """Long field names; ``t``, ``ll`` and the undocumented fields keep theirs."""
    return events.withColumnsRenamed(DOCUMENT_NAMES)


def panel_rows(events: DataFrame) -> DataFrame:
    """What the dashboard's panels read of documents: no country name, so no join."""
    return rename_fields(events.withColumns({"domain": domain_of("u"), "location": inverted_location("ll")}))


def enrich_documents(events: DataFrame, lang: str = "en") -> DataFrame:
    """Search documents: time, location, domain and country name, then all fields renamed."""
    docs = with_country(rename_fields(events), "country_code", lang)
    fields = rename_fields(events).columns
    return docs.select(
        iso_utc("t").alias("@timestamp"),
        inverted_location("ll").alias("location"),
        domain_of("url").alias("domain"),
        "country",
        *fields,
    )


def to_documents(df: DataFrame, column: str = "document") -> DataFrame:
    """Each row as one JSON text; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns])).alias(column))


def raw_by_day(lines: DataFrame) -> DataFrame:
    """Every line with its day; ``N/A`` for a line without a readable epoch."""
    timed = lines.select("event", F.get_json_object("event", "$.t").alias("epoch"))
    return timed.select(epoch_text_unit("epoch", "day").alias("date"), "event")


def export_lines(raw_clicks: DataFrame) -> DataFrame:
    """Raw lines with the day as their first JSON field; the rest stays byte for byte."""
    day = F.concat(F.lit('{"date":"'), "date", F.lit('",'))
    return raw_clicks.select(F.concat(day, F.expr("substring(event, 2)")).alias("event"))


def click_ids(events: DataFrame) -> DataFrame:
    """Day and id of every click that has a time."""
    return with_values(events, "t").select(epoch_unit("t", "day").alias("date"),
                                           F.col("_id").alias("id"))


def full_events(events: DataFrame) -> DataFrame:
    """The wide event record: the day, then 16 fields under their long names."""
    day = F.coalesce(epoch_unit("t", "day"), F.lit(MISSING)).alias("date")
    return events.select(day, *[F.col(name).alias(FULL_EVENT_NAMES[name])
                                for name in FULL_EVENT_FIELDS])
