"""Schemas of click events, serving tables and documents."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_NUMBERS = {"hc": T.LongType(), "mc": T.LongType(), "nk": T.IntegerType(), "t": T.LongType(),
            "ll": T.ArrayType(T.DoubleType())}

#: One raw click line. Every field may be missing.
CLICK = T.StructType([
    T.StructField(name, _NUMBERS.get(name, T.StringType()))
    for name in ["_id", "a", "al", "c", "cy", "g", "gr", "h", "hc", "hh", "i", "k", "l", "ll",
                 "mc", "nk", "r", "t", "tz", "u", CORRUPT]
])


def click_fields(*names: str) -> T.StructType:
    """The part of :data:`CLICK` a query needs, so the parser skips the rest."""
    return T.StructType([field for field in CLICK.fields if field.name in names])


# The field names of the search documents.
DOCUMENT_NAMES = {
    "_id": "id",
    "a": "user_agent",
    "al": "accept_language",
    "c": "country_code",
    "cy": "geo_city_name",
    "g": "global_bitly_hash",
    "gr": "geo_region",
    "h": "encoding_user_bitly_hash",
    "hc": "time_hash_was_created",
    "hh": "short_url_cname",
    "l": "encoding_user_login",
    "nk": "known_user",
    "r": "referring_url",
    "tz": "timezone",
    "u": "url",
}

#: The wide event table: day first, then the long names, no coordinates.
FULL_EVENT_FIELDS = ["_id", "a", "al", "c", "cy", "g", "gr", "h", "hc", "hh", "l", "nk", "r",
                     "t", "tz", "u"]
FULL_EVENT_NAMES = {**DOCUMENT_NAMES, "t": "timestamp", "u": "long_url"}

#: Grouping keys of the count tables, by subject.
COUNT_KEYS = {
    "domain": ["domain"],
    "country_domain": ["country_code", "domain"],
    "country": ["country_code"],
}
UNITS = ["second", "minute", "hour"]


def count_table(subject: str, unit: str) -> str:
    """Name of the serving table with the counts of one subject, e.g. ``domain_minutes``."""
    return f"{subject}_{unit}s"


def _columns(names: list[str], last: str = "date string") -> str:
    return ", ".join([f"{name} string" for name in names] + [last])


#: Serving tables, one per dashboard query, all partitioned by ``date``.
SERVING_TABLES = {
    **{
        count_table(subject, unit): _columns([*keys, "time"], "clicks bigint, date string")
        for subject, keys in COUNT_KEYS.items()
        for unit in UNITS
    },
    "raw_clicks": _columns(["event"]),
    "click_ids": _columns(["id"]),
    "full_events": ", ".join(
        f"{FULL_EVENT_NAMES.get(name, name)} {CLICK[name].dataType.simpleString()}"
        for name in FULL_EVENT_FIELDS
    ) + ", date string",
}
