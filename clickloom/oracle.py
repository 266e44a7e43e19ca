"""The catalog's results once more, as SQL for DuckDB on the same tables.

Used for checking only. The input rules are shared with the derived source; everything
after them is written independently of the Spark queries.
"""

from __future__ import annotations

from clickloom.sources.derived import (
    AGAIN_RULE, BROKEN_RULE, CLICK_RULES, LINE_RULE, NOTE_RULE,
)

_RUN = "2024-02-01"


def _duck(rule: str) -> str:
    return rule.format(S="VARCHAR", EPOCH="CAST(floor(epoch(ts)) AS BIGINT)")


def _inputs() -> str:
    columns = ", ".join(f"{_duck(rule)} AS {name}" for name, rule in CLICK_RULES.items())
    note, broken = ((when, _duck(text)) for when, text in (NOTE_RULE, BROKEN_RULE))
    return f"""
clicks AS (SELECT event_id, {columns}
  FROM (SELECT *, event_id % (SELECT count(*) FROM pages) AS page_id FROM events)
  JOIN pages USING (page_id)),
lines AS (
  SELECT {_duck(LINE_RULE)} AS event FROM clicks
  UNION ALL SELECT {_duck(LINE_RULE)} FROM clicks WHERE {AGAIN_RULE}
  UNION ALL SELECT {note[1]} FROM events WHERE {note[0]}
  UNION ALL SELECT {broken[1]} FROM events WHERE {broken[0]})"""


_TEXTS = ["_id", "a", "al", "c", "cy", "g", "gr", "h", "hh", "i", "k", "l", "r", "tz", "u"]
_NUMBERS = {"hc": "BIGINT", "mc": "BIGINT", "nk": "INTEGER", "t": "BIGINT"}


def _parsed() -> str:
    fields = [f"json_extract_string(j, '$.{name}') AS {name}" for name in _TEXTS]
    fields += [f"CAST(json_extract_string(j, '$.{name}') AS {kind}) AS {name}"
               for name, kind in _NUMBERS.items()]
    return f"""
parsed AS (SELECT {', '.join(fields)}, CAST(json_extract(j, '$.ll') AS VARCHAR) AS ll,
    CASE WHEN j IS NULL THEN event END AS _corrupt_record
  FROM (SELECT event, CASE WHEN json_valid(event) THEN event::JSON END AS j
        FROM lines WHERE contains(event, '"h":')))"""


def _time(t: str, fmt: str) -> str:
    return f"strftime(make_timestamp({t} * 1000000), '{fmt}')"


_DAY, _HOUR, _MINUTE, _SECOND = "%Y-%m-%d", "%H", "%H:%M", "%H:%M:%S"
_DOMAIN = "CASE WHEN u = '' THEN 'N/A' ELSE nullif(split_part(u, '/', 3), '') END"
_NAMES = "(VALUES ('US', 'United States'), ('SE', 'Sweden'), ('GB', 'United Kingdom')) AS n(code, name)"


def _country(code: str) -> str:
    return f"coalesce((SELECT name FROM {_NAMES} WHERE n.code = upper({code})), upper({code}))"


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([_inputs(), *ctes]) + "\n" + body


def _keyed(source: str) -> str:
    return (f"\nkeyed AS (SELECT t, c AS country_code, {_DOMAIN} AS domain FROM {source} "
            "WHERE t IS NOT NULL)")


def _counts(keys: list[str], fmt: str, source: str = "clicks") -> str:
    """CTEs ``keyed`` and ``counts``."""
    names = ", ".join(keys)
    present = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    return (_keyed(source) + f",\ncounts AS (SELECT {_time('t', _DAY)} AS date, {names}, "
            f"{_time('t', fmt)} AS time, count(*) AS clicks FROM keyed WHERE {present} GROUP BY ALL)")


def _raw() -> str:
    epoch = "CASE WHEN json_valid(event) THEN CAST(json_extract_string(event, '$.t') AS BIGINT) END"
    return f"\nraw AS (SELECT coalesce({_time(f'({epoch})', _DAY)}, 'N/A') AS date, event FROM lines)"


def _documents(source: str, ll: str) -> str:
    """CTE ``docs`` with long names."""
    renames = {"_id": "id", "a": "user_agent", "al": "accept_language", "c": "country_code",
               "cy": "geo_city_name", "g": "global_bitly_hash", "gr": "geo_region",
               "h": "encoding_user_bitly_hash", "hc": "time_hash_was_created",
               "hh": "short_url_cname", "l": "encoding_user_login", "nk": "known_user",
               "r": "referring_url", "tz": "timezone", "u": "url", "t": "t"}
    fields = ", ".join(f"{short} AS {name}" for short, name in renames.items())
    return f"""
docs AS (SELECT {_time('t', '%Y-%m-%dT%H:%M:%SZ')} AS "@timestamp", {_DOMAIN} AS domain,
  {_country('c')} AS country, {fields}, {ll} FROM {source})"""


_FULL_DOCS = _documents("parsed", "i, k, mc, ll, _corrupt_record, CASE WHEN ll IS NOT NULL THEN "
                        "concat('[', json_extract_string(ll, '$[1]'), ',', "
                        "json_extract_string(ll, '$[0]'), ']') END AS location")
_FULL_EVENT = ('coalesce(substr("@timestamp", 1, 10), \'N/A\') AS date, * EXCLUDE ("@timestamp", location, domain, country, '
               "i, k, mc, ll, _corrupt_record, t, url), t AS timestamp, url AS long_url")
_PANEL_DOCS = _documents("clicks", "lat, lon")


def _panel(field: str, body: str) -> str:
    return _sql(body.format(groups=f"SELECT {field}, count(*) AS clicks FROM docs "
                            f"WHERE {field} IS NOT NULL GROUP BY {field}"), _PANEL_DOCS)


def _cube(body: str) -> str:
    hours = (f"\nhours AS (SELECT '{_RUN}' AS \"@timestamp\", {_time('t', _HOUR)} AS hour, "
             "count(*) AS counter FROM parsed GROUP BY ALL)")
    zones = (f"\nzones AS (SELECT '{_RUN}' AS \"@timestamp\", tz AS timezone, "
             f"{_time('t', _HOUR)} AS hour, count(*) AS counter FROM parsed GROUP BY ALL)")
    days = (f"\ndays AS (SELECT {_time('t', _DAY)} AS \"@timestamp\", {_time('t', _HOUR)} AS hour, "
            "count(*) AS counter FROM parsed GROUP BY ALL)")
    return _sql(body, _parsed(), hours, zones, days)


def _geohash(lat: str, lon: str, precision: int) -> str:
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2

    def grid(value: str, half: int, bits: int) -> str:
        return (f"greatest(0, least({2 ** bits - 1}, CAST(floor(({value} + {half}.0) / {2 * half}.0 "
                f"* {2 ** bits}) AS BIGINT)))")

    x, y = grid(lon, 180, lon_bits), grid(lat, 90, lat_bits)
    characters = []
    for start in range(0, 5 * precision, 5):
        bits = []
        for p in range(start, start + 5):
            value, top = (x, lon_bits) if p % 2 == 0 else (y, lat_bits)
            bits.append(f"(({value} // {2 ** (top - 1 - p // 2)}) % 2) * {2 ** (4 - p % 5)}")
        characters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', "
                          f"CAST({' + '.join(bits)} AS INTEGER) + 1, 1)")
    return f"CASE WHEN {lat} IS NOT NULL THEN {' || '.join(characters)} END"


def _today(minutes_back: int) -> str:
    t = f"(t - {minutes_back * 60})"
    formats = {"dia": "%Y-%m-%d", "horas": "%Y-%m-%d %H", "minutos": "%Y-%m-%d %H:%M",
               "segundos": "%Y-%m-%d %H:%M:%S"}
    columns = ", ".join(f"{_time(t, fmt)} AS {word}" for word, fmt in formats.items())
    return _sql(f"SELECT _id, {columns}, '1970-01-01 00:00:00' AS year FROM clicks")


def _countries(fmt: str, where: str = "TRUE") -> str:
    return _sql(f"""
SELECT * FROM (SELECT date, country_code, clicks, CAST(row_number() OVER
    (PARTITION BY date ORDER BY clicks DESC, country_code) AS INTEGER) AS rank,
    {_country('country_code')} AS country
  FROM (SELECT date, country_code, CAST(sum(clicks) AS BIGINT) AS clicks FROM counts GROUP BY ALL) s)
WHERE rank <= 30 AND {where}""", _counts(["country_code"], fmt))


_BUSIEST = ("(SELECT domain FROM counts GROUP BY domain ORDER BY sum(clicks) DESC, domain LIMIT 1)")


def _stream(keys: list[str], fmt: str) -> str:
    return _sql("SELECT * FROM counts", _parsed(), _counts(keys, fmt, "parsed"))


_KEYS = {"domain": ["domain"], "country_domain": ["country_code", "domain"],
         "country": ["country_code"]}
_FORMATS = {"seconds": _SECOND, "minutes": _MINUTE, "hours": _HOUR}


def _table_sizes() -> str:
    parts = []
    for subject, keys in _KEYS.items():
        present = " AND ".join(f"{key} IS NOT NULL" for key in keys)
        for unit, fmt in _FORMATS.items():
            rows = (f"SELECT count(*) AS n FROM keyed WHERE {present} "
                    f"GROUP BY {', '.join(keys)}, {_time('t', _DAY + ' ' + fmt)}")
            parts.append(f"SELECT '{subject}_{unit}' AS \"table\", count(*) AS rows, "
                         f"CAST(sum(n) AS BIGINT) AS clicks FROM ({rows})")
    single = {
        "raw_clicks": "SELECT DISTINCT date, event FROM raw",
        "click_ids": f"SELECT DISTINCT {_time('t', _DAY)}, _id FROM parsed WHERE t IS NOT NULL",
        "full_events": f"SELECT DISTINCT {_time('t', _DAY)}, _id FROM parsed WHERE _id IS NOT NULL "
                       f"UNION ALL SELECT {_time('t', _DAY)}, _id FROM parsed WHERE _id IS NULL",
    }
    parts += [f"SELECT '{name}', count(*), count(*) FROM ({rows})" for name, rows in single.items()]
    return _sql(" UNION ALL ".join(parts), _parsed(), _raw(), _keyed("parsed"))


def _all_rows() -> str:
    """Every row of the nine count tables, of the raw lines and the ids."""
    parts = []
    for subject, keys in _KEYS.items():
        present = " AND ".join(f"{key} IS NOT NULL" for key in keys)
        shown = ", ".join(key if key in keys else f"NULL::VARCHAR AS {key}" for key in ("country_code", "domain"))
        for unit, fmt in _FORMATS.items():
            parts.append(f"SELECT '{subject}_{unit}' AS \"table\", {_time('t', _DAY)} AS date, {_time('t', fmt)} AS time, "
                         f"{shown}, NULL::VARCHAR AS event, NULL::VARCHAR AS id, count(*) AS clicks FROM keyed "
                         f"WHERE {present} GROUP BY ALL")
    parts.append("SELECT DISTINCT 'raw_clicks', date, NULL, NULL, NULL, event, NULL, NULL::BIGINT FROM raw")
    parts.append(f"SELECT DISTINCT 'click_ids', {_time('t', _DAY)}, NULL, NULL, NULL, NULL, _id, NULL::BIGINT "
                 "FROM parsed WHERE t IS NOT NULL")
    return " UNION ALL ".join(parts)


def _all_tables() -> str:
    return _sql(_all_rows(), _parsed(), _raw(), _keyed("parsed"))


def _late(slices: int = 4, delay: int = 600) -> str:
    """Second deliveries whose minute had ended ``delay`` seconds before the newest click of the slices delivered earlier."""
    return _sql(f"""
SELECT {_time('t', _DAY)} AS date, {_time('t', _MINUTE)} AS time, event, 1 AS clicks
FROM parts JOIN reach USING (part) WHERE CAST(_id AS BIGINT) % 20 = 0 AND (t // 60 + 1) * 60 <= newest - {delay}""",
                _parsed(), f"""
bounds AS (SELECT min(t) AS first, (max(t) - min(t)) // {slices} + 1 AS width FROM parsed),
parts AS (SELECT DISTINCT event, t, _id, (t - first) // width AS part FROM bounds, (SELECT event,
    CAST(json_extract_string(j, '$.t') AS BIGINT) AS t, json_extract_string(j, '$._id') AS _id
  FROM (SELECT event, CASE WHEN json_valid(event) THEN event::JSON END AS j FROM lines
        WHERE contains(event, '"h":'))) WHERE t IS NOT NULL),
reach AS (SELECT part, max(max(t)) OVER (ORDER BY part) AS newest FROM parts GROUP BY part)""")


def _sliding(length: int) -> str:
    """Every window of some minutes with a click in it, by its first minute."""
    start = "(m - back) * 60"
    return _sql(f"SELECT {_time(start, _DAY)} AS date, domain, {_time(start, _MINUTE)} AS time, count(*) AS clicks "
                f"FROM (SELECT domain, t // 60 AS m, unnest(range({length})) AS back FROM keyed WHERE domain IS NOT NULL) "
                "GROUP BY ALL", _parsed(), _keyed("parsed"))


def _catalogue() -> str:
    """Days and rows of each serving table."""
    days = f"SELECT *, coalesce({_time('t', _DAY)}, 'N/A') AS date FROM parsed"
    wide = f"SELECT date, _id FROM ({days}) WHERE _id IS NULL UNION ALL SELECT DISTINCT date, _id FROM ({days}) WHERE _id IS NOT NULL"
    return _sql(f'SELECT "table", count(DISTINCT date) AS partitions, count(*) AS rows FROM (SELECT "table", date FROM everything '
                f"UNION ALL SELECT 'full_events', date FROM ({wide})) GROUP BY ALL",
                _parsed(), _raw(), _keyed("parsed"), f"everything AS ({_all_rows()})")


def _payload(name: str, description: str, results: str, extra: str = "''") -> str:
    head = f'{{"name_query":"{name}","description":"{description}"'
    return f"concat('{head}', {extra}, ',\"results\":[', {results}, ']}}') AS payload"


def _payload_lines(name: str, description: str, key: str, item: str, fmt: str) -> str:
    first = f"row_number() OVER (ORDER BY clicks DESC, {key}) = 1"
    return _sql(
        f"SELECT '{{\"name_query\":\"{name}\",\"description\":\"{description}\",\"results\":[' AS line "
        f"UNION ALL SELECT concat(CASE WHEN {first} THEN '' ELSE ',' END, {item}) FROM (SELECT {key}, "
        "CAST(sum(clicks) AS BIGINT) AS clicks FROM counts WHERE date = (SELECT max(date) FROM counts) "
        "GROUP BY ALL) s UNION ALL SELECT ']}'", _counts([key], fmt))


def _payloads() -> dict[str, str]:
    def item(**values: str) -> str:
        pairs = ", ',".join(f"\"{key}\":', {value}" for key, value in values.items())
        return "concat('{" + pairs + ", '}')"

    def text(value: str) -> str:
        return f"concat('\"', {value}, '\"')"

    newest = "date = (SELECT max(date) FROM counts)"
    raw_newest = "(SELECT max(date) FROM raw WHERE date <> 'N/A')"
    day = f"strftime(CAST({raw_newest} AS DATE), '%a, %-d %b %Y')"
    clicks = f"(SELECT count(DISTINCT event) FROM raw WHERE date = {raw_newest})"
    country = item(country=text(_country("country_code")), contador=text("clicks"))
    minute = item(date=text("concat(date, ' ', time)"), dominio=text("domain"), contador="clicks")
    domain = item(dominio=text("domain"), contador=text("clicks"))
    return {
        "envelope_daily_counter": _sql(
            "SELECT " + _payload("globalcounter", "Contador de accesos diarios",
                                 item(contador=text(clicks)), f"concat(',\"date\":\"', {day}, '\"')"),
            _raw()),
        "envelope_evolution": _sql(
            "SELECT " + _payload("EvolutionByDomain", "Evolución diaria de un dominio",
                                 f"string_agg({minute}, ',' ORDER BY date, time)")
            + f" FROM counts WHERE {newest} AND domain = {_BUSIEST}", _counts(["domain"], _MINUTE)),
        "envelope_top_country": _payload_lines("topcountry", "Top urls acortadas por pais",
                                               "country_code", country, _MINUTE),
        "envelope_top_domain": _payload_lines("topurl", "Top 20 URL''s usa.gov acortadas",
                                              "domain", domain, _SECOND),
    }


def oracle_sql() -> dict[str, str]:
    daily = "SELECT date, count(DISTINCT event) AS clicks FROM raw GROUP BY date"
    newest = "(SELECT max(date) FROM counts)"
    unit_words = {"dia": _DAY, "hora": _HOUR, "minuto": _MINUTE, "segundo": _SECOND}
    sql = {
        "domain_of": _sql(f"SELECT _id, u, {_DOMAIN} AS domain FROM clicks"),
        "epoch_units": _sql("SELECT _id, " + ", ".join(
            f"{_time('t', fmt)} AS {word}" for word, fmt in unit_words.items())
            + ", '1970-01-01' AS year FROM clicks"),
        "epoch_units_text": _sql("SELECT _id, " + ", ".join(
            f"coalesce({_time('t', fmt)}, 'N/A') AS {word}" for word, fmt in unit_words.items())
            + " FROM clicks"),
        "today_units": _today(0),
        "today_minus_3": _today(3),
        "country_names": _sql(f"SELECT _id, c AS country_code, {_country('c')} AS country FROM clicks"),
        "geohash_cells": _sql(f"SELECT _id, {_geohash('lat', 'lon', 7)} AS cell FROM clicks"),
        "sql_domain_minutes": _sql("SELECT * FROM counts", _counts(["domain"], _MINUTE)),
        "filter_click_lines": _sql("SELECT event FROM lines WHERE contains(event, '\"h\":')"),
        "clean_lines": _sql("SELECT replace(event, ' ', '') AS event FROM lines"),
        "parse_events": _sql("SELECT * FROM parsed", _parsed()),
        "events_without_coordinates": _sql("SELECT * EXCLUDE (ll) FROM parsed", _parsed()),
        "rename_fields": _sql('SELECT * EXCLUDE ("@timestamp", location, domain, country) FROM docs',
                              _parsed(), _FULL_DOCS),
        "enrich_docs": _sql("SELECT * FROM docs", _parsed(), _FULL_DOCS),
        "full_event": _sql(f"SELECT {_FULL_EVENT} FROM docs", _parsed(), _FULL_DOCS),
        "raw_by_day": _sql("SELECT * FROM raw", _raw()),
        "distinct_lines": _sql("SELECT DISTINCT * FROM raw", _raw()),
        "click_ids": _sql(f"SELECT DISTINCT {_time('t', _DAY)} AS date, _id AS id FROM parsed "
                          "WHERE t IS NOT NULL", _parsed()),
        "export_clicks": _sql("SELECT concat('{\"date\":\"', date, '\",', substr(event, 2)) AS event "
                              "FROM (SELECT DISTINCT * FROM raw)", _raw()),
        "first_clicks": _sql("SELECT DISTINCT * FROM raw ORDER BY date, event LIMIT 10", _raw()),
        "hour_counts": _cube("SELECT * FROM hours"),
        "tz_hour_counts": _cube("SELECT * FROM zones"),
        "day_hour_counts": _cube("SELECT * FROM days"),
        "day_hour_top20": _cube("SELECT * FROM days ORDER BY counter DESC, "
                                '"@timestamp" NULLS FIRST, hour NULLS FIRST LIMIT 20'),
        **{f"{subject}_{unit}": _sql("SELECT * FROM counts", _counts(keys, fmt))
           for subject, keys in _KEYS.items() for unit, fmt in _FORMATS.items()},
        "daily_counter": _sql(daily, _raw()),
        "daily_counter_latest": _sql(
            f"SELECT clicks FROM ({daily}) WHERE date = (SELECT max(date) FROM raw WHERE date <> 'N/A')",
            _raw()),
        "top_countries": _countries(_MINUTE),
        "top_countries_from_seconds": _countries(_SECOND),
        "top_countries_ex_us": _countries(_MINUTE, "country <> 'United States'"),
        "top_countries_latest": _sql(
            f"SELECT country_code, clicks, {_country('country_code')} AS country FROM (SELECT country_code, "
            f"CAST(sum(clicks) AS BIGINT) AS clicks FROM counts WHERE date = {newest} GROUP BY ALL "
            "ORDER BY clicks DESC, country_code LIMIT 30) s", _counts(["country_code"], _MINUTE)),
        "top_domains": _sql("SELECT date, domain, CAST(sum(clicks) AS BIGINT) AS clicks FROM counts "
                            "GROUP BY ALL", _counts(["domain"], _SECOND)),
        "top_domains_latest": _sql(
            "SELECT domain, CAST(sum(clicks) AS BIGINT) AS clicks FROM counts "
            f"WHERE date = {newest} GROUP BY ALL", _counts(["domain"], _SECOND)),
        "domain_evolution": _sql(
            f"SELECT *, concat(date, ' ', time, ':00') AS at FROM counts WHERE domain = {_BUSIEST}",
            _counts(["domain"], _MINUTE)),
        "domain_evolution_last40": _sql(
            f"SELECT * FROM counts WHERE domain = {_BUSIEST} ORDER BY date DESC, time DESC LIMIT 40",
            _counts(["domain"], _MINUTE)),
        "domain_evolution_latest": _sql(
            f"SELECT * FROM counts WHERE domain = {_BUSIEST} AND date = {newest}",
            _counts(["domain"], _MINUTE)),
        "docs_per_minute": _sql(f"SELECT {_time('t', '%Y-%m-%d %H:%M')} AS minute, count(*) AS clicks "
                                "FROM docs WHERE t IS NOT NULL GROUP BY ALL", _PANEL_DOCS),
        "period_total": _sql("SELECT count(*) AS clicks FROM docs WHERE t >= epoch(TIMESTAMP "
                             "'2024-01-01') AND t < epoch(TIMESTAMP '2024-02-01')", _PANEL_DOCS),
        "method_share": _panel("short_url_cname", "SELECT *, CAST(clicks AS DOUBLE) / "
                               "CAST((sum(clicks) OVER ()) AS DOUBLE) AS share FROM ({groups})"),
        "top20_timezones": _panel("timezone", "{groups} ORDER BY clicks DESC, timezone LIMIT 20"),
        "top50_domains": _panel("domain", "{groups} ORDER BY clicks DESC, domain LIMIT 50"),
        "known_vs_new": _panel("known_user", "{groups}"),
        "geo_heatmap": _sql(f"SELECT {_geohash('lat', 'lon', 5)} AS cell, count(*) AS clicks FROM docs "
                            "WHERE lat IS NOT NULL GROUP BY ALL", _PANEL_DOCS),
        "batch_histogram": _cube("SELECT hour, counter FROM hours WHERE hour IS NOT NULL"),
        "batch_total": _cube("SELECT count(*) AS clicks FROM parsed"),
        "tz_hour_lines": _cube("SELECT timezone, " + ", ".join(
            f"CAST(coalesce(sum(counter) FILTER (WHERE hour = '{h:02d}'), 0) AS BIGINT) AS h{h:02d}"
            for h in range(24)) + " FROM zones GROUP BY timezone"),
        "tz_peak_hour": _cube("SELECT timezone, hour, counter FROM (SELECT *, row_number() OVER "
                              "(PARTITION BY timezone ORDER BY counter DESC, hour) AS n FROM zones "
                              "WHERE hour IS NOT NULL) WHERE n = 1"),
        "pattern_documents": _cube(
            "SELECT \"@timestamp\", NULL::VARCHAR AS timezone, hour, counter, 'query1' AS query FROM hours "
            "UNION ALL SELECT \"@timestamp\", timezone, hour, counter, 'query2' FROM zones "
            "UNION ALL SELECT \"@timestamp\", NULL, hour, counter, 'query3' FROM days"),
        "serving_tables": _all_tables(),
        "serving_sizes": _table_sizes(),
        "serving_full_events": _sql(f"SELECT DISTINCT {_FULL_EVENT} FROM docs WHERE id IS NOT NULL "
                                    f"UNION ALL SELECT {_FULL_EVENT} FROM docs WHERE id IS NULL", _parsed(), _FULL_DOCS),
        "serving_catalogue": _catalogue(),
        "geo_pyramid": _sql(" UNION ALL ".join(
            f"SELECT {p} AS precision, {_geohash('lat', 'lon', p)} AS cell, count(*) AS clicks FROM docs "
            "WHERE lat IS NOT NULL GROUP BY ALL" for p in range(1, 8)), _PANEL_DOCS),
        "period_totals": _sql("SELECT _id, s AS start, e AS \"end\", (SELECT count(*) FROM clicks c WHERE c.t >= s AND c.t < e) "
                              "AS clicks FROM (SELECT _id, t - t % 60 AS s, t - t % 60 + CAST(_id AS BIGINT) * 7 % 20000 * 60 AS e "
                              "FROM clicks WHERE CAST(_id AS BIGINT) % 50 = 1 AND t IS NOT NULL)"),
        "document_files": _sql(
            "SELECT *, coalesce(substr(\"@timestamp\", 1, 10), 'N/A') AS date FROM docs", _parsed(), _FULL_DOCS),
        **{f"stream_{subject}_{unit}": _stream(keys, _FORMATS[unit])
           for subject, keys in _KEYS.items() for unit in ("seconds", "minutes")},
        "stream_raw_by_day": _sql(daily, _raw()),
        "stream_all_tables": _all_tables(),
        "stream_daily_counter": _sql(daily, _raw()),
        "stream_late_lines": _late(),
        "stream_sliding_minutes": _sliding(5),
        "stream_run_report": _sql("SELECT count(*) AS lines, count(*) FILTER (contains(event, '\"h\":')) AS clicks FROM lines"),
        "stream_top_countries": _sql(
            f"SELECT country_code, clicks, {_country('country_code')} AS country FROM (SELECT country_code, "
            f"CAST(sum(clicks) AS BIGINT) AS clicks FROM counts WHERE date = {newest} GROUP BY ALL "
            "ORDER BY clicks DESC, country_code LIMIT 30) s", _parsed(), _counts(["country_code"], _MINUTE, "parsed")),
        "stream_top_domains": _sql(
            "SELECT domain, CAST(sum(clicks) AS BIGINT) AS clicks FROM counts "
            f"WHERE date = {newest} GROUP BY ALL", _parsed(), _counts(["domain"], _SECOND, "parsed")),
        "stream_domain_evolution": _sql(
            f"SELECT * FROM counts WHERE date = {newest} AND domain = (SELECT domain FROM counts WHERE date = {newest} "
            "GROUP BY domain ORDER BY sum(clicks) DESC, domain LIMIT 1)", _parsed(), _counts(["domain"], _MINUTE, "parsed")),
    }
    sql.update(_payloads())
    sql["export_files"] = sql["export_clicks"]
    sql["stream_dedup_clicks"] = sql["closed_click_ids"] = sql["click_ids"]
    sql["closed_domain_minutes"] = sql["stream_domain_minutes"]
    sql["stream_spool_minutes"] = sql["compacted_live_minutes"] = sql["stream_domain_minutes"]
    sql["closed_country_minutes"] = sql["stream_country_minutes"]
    sql["closed_raw_clicks"] = _sql("SELECT DISTINCT date, event FROM raw", _raw())
    sql["stream_enrich_docs"] = sql["documents_json"] = sql["enrich_docs"]
    sql["domain_point_read"] = _sql(f"SELECT * FROM counts WHERE domain = {_BUSIEST} AND date = {newest}",
                                    _parsed(), _counts(["domain"], _MINUTE, "parsed"))
    sql["archive_events"] = sql["parse_events"]
    return sql
