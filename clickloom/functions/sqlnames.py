"""The click functions under their SQL names, for queries written as SQL text.

They are SQL functions, not Python ones: Catalyst inlines the body into the plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_THIRD = "substring_index(substring_index(url, '/', 3), '/', -1)"
_DAY = "CAST(date_from_unix_date(try_cast(floor({t} / 86400) AS INT)) AS STRING)"
_CLOCK = ("concat(lpad(floor(pmod({t}, 86400) / 3600), 2, '0'), ':', "
          "lpad(floor(pmod({t}, 3600) / 60), 2, '0'), ':', lpad(pmod({t}, 60), 2, '0'))")
_EPOCH = (f"CASE unit WHEN 'dia' THEN {_DAY} WHEN 'hora' THEN left({_CLOCK}, 2) "
          f"WHEN 'minuto' THEN left({_CLOCK}, 5) WHEN 'segundo' THEN {_CLOCK} "
          "ELSE '1970-01-01' END")
_TODAY = (f"CASE unit WHEN 'dia' THEN {_DAY} WHEN 'horas' THEN concat({_DAY}, ' ', left({_CLOCK}, 2)) "
          f"WHEN 'minutos' THEN concat({_DAY}, ' ', left({_CLOCK}, 5)) "
          f"WHEN 'segundos' THEN concat({_DAY}, ' ', {_CLOCK}) ELSE '1970-01-01 00:00:00' END")


def _definitions() -> dict[str, str]:
    epoch = _EPOCH.format(t="t")
    text = _EPOCH.format(t="try_cast(t AS BIGINT)")
    now = "unix_seconds(current_timestamp())"
    return {
        "getDomain(url STRING)":
            f"CASE WHEN substring_index(url, '/', 2) <> url AND {_THIRD} <> '' THEN {_THIRD} "
            "WHEN url = '' THEN 'N/A' END",
        "getTimeFromEpoch(t BIGINT, unit STRING)": epoch,
        "getTimeFromEpoch2(t STRING, unit STRING)":
            f"CASE WHEN t IS NULL OR t IN ('', '()') THEN 'N/A' ELSE coalesce({text}, 'N/A') END",
        "getToday(unit STRING)": _TODAY.format(t=now),
        "getToday2(unit STRING)": _TODAY.format(t=f"({now} - 180)"),
    }


def register_functions(spark: SparkSession) -> None:
    """Make ``getDomain``, ``getTimeFromEpoch`` and the rest callable from ``spark.sql``."""
    for signature, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
