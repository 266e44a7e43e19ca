import json

from clickloom.operators import (
    click_ids, distinct_ids, distinct_lines, drop_coordinates, drop_empty_lines, enrich_documents,
    export_lines, full_events, lines_per_day, raw_by_day, rename_fields, strip_spaces, to_documents,
)
from clickloom.schema import CLICK
from clickloom.sources.lines import click_lines, parse_clicks, read_archive, read_events, register_events
from clickloom.sources.serving import first_clicks
from tests.conftest import SAMPLE, click


def texts(df):
    return [row[0] for row in df.collect()]


def test_only_click_lines_stay(lines):
    df = lines(SAMPLE, "", '{"_heartbeat_":1}', '{"h":"broken1', {"h": None, "u": "x"})
    kept = texts(click_lines(df))
    assert len(kept) == 3 and '{"h":"broken1' in kept
    assert len(texts(drop_empty_lines(df))) == 4


def test_strip_spaces(lines):
    assert texts(strip_spaces(lines({"h": "x", "a": "Reader/2.4 (tablet; x)"}))) == [
        '{"h":"x","a":"Reader/2.4(tablet;x)"}']


def test_parse_the_sample(lines):
    row = parse_clicks(lines(SAMPLE)).first().asDict()
    assert {key: value for key, value in row.items() if value is not None} == SAMPLE
    assert list(row) == CLICK.fieldNames()


def test_malformed_and_mistyped_lines(lines):
    rows = parse_clicks(lines('{"h":"broken1', '{"h":"a","t":"soon","u":"x"}')).collect()
    assert rows[0].t is None and rows[0].h is None and rows[0]._corrupt_record == '{"h":"broken1'
    assert rows[1].t is None and rows[1].u == "x"


def test_parse_some_fields(lines):
    df = parse_clicks(lines(SAMPLE, '{"h":"broken1'), "t", "tz")
    assert [(row.t, row.tz) for row in df.collect()] == [(1433920089, "Europe/Helsinki"), (None, None)]
    assert sorted(df.columns) == ["t", "tz"]


def test_line_is_parsed_once_per_row(lines):
    df = parse_clicks(lines(SAMPLE).repartition(2), "t", "tz", "u")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_archive_folder_and_sql_name(spark, lines, folder):
    path = folder("archive")
    lines(SAMPLE, "", '{"_note":1}').coalesce(1).write.text(path)
    lines(click(_id="2")).coalesce(1).write.mode("append").option("compression", "gzip").text(path)
    assert read_archive(spark, path).count() == 4
    register_events(read_events(spark, path, "_id", "c", clean=True), "archive_clicks")
    assert spark.sql("SELECT count(DISTINCT _id) FROM archive_clicks WHERE c = 'FI'").first()[0] == 2


def test_rename_and_drop(lines):
    row = rename_fields(drop_coordinates(parse_clicks(lines(SAMPLE)))).first()
    assert row.id == SAMPLE["_id"] and row.url == SAMPLE["u"] and row.country_code == "FI"
    assert row.t == SAMPLE["t"] and "ll" not in row.asDict() and "u" not in row.asDict()


def test_enriched_document(lines):
    documents = enrich_documents(parse_clicks(lines(SAMPLE)))
    assert documents.columns[:4] == ["@timestamp", "location", "domain", "country"]
    document = json.loads(texts(to_documents(documents))[0])
    assert document["@timestamp"] == "2015-06-10T07:08:09Z"
    assert document["location"] == [25.125, 60.25] and document["ll"] == [60.25, 25.125]
    assert document["domain"] == "maps.example.gov" and document["country"] == "Finland"
    assert document["url"] == SAMPLE["u"] and document["geo_city_name"] == "Järvenpää"
    assert "known_user" not in document


def test_incomplete_documents_stay(lines):
    df = parse_clicks(lines(click(ll=None), click(u=None), click(c=None), click(t=None), click(c="ZZ"),
                            click(u="")))
    docs = enrich_documents(df).collect()
    assert [d.location is None for d in docs] == [True, False, False, False, False, False]
    assert [d.domain for d in docs][1] is None and docs[5].domain == "N/A"
    assert docs[2].country is None and docs[3]["@timestamp"] is None and docs[4].country == "ZZ"


def test_raw_lines_by_day(lines):
    df = raw_by_day(lines(SAMPLE, {"h": "x"}, '{"h":"broken1', {"h": "y", "t": 0}))
    assert [row.date for row in df.collect()] == ["2015-06-10", "N/A", "N/A", "1970-01-01"]


def test_duplicates_within_a_day(lines):
    again = click(t=1433920089 + 86400)
    raw = raw_by_day(lines(SAMPLE, SAMPLE, again, click(_id="2"), '{"h":"broken1', '{"h":"broken1'))
    assert distinct_lines(raw).count() == 4
    assert {r.date: r.clicks for r in lines_per_day(raw).collect()} == {
        "2015-06-10": 2, "2015-06-11": 1, "N/A": 1}
    ids = click_ids(parse_clicks(lines(SAMPLE, SAMPLE, again, click(t=None))))
    assert sorted(tuple(r) for r in distinct_ids(ids).collect()) == [
        ("2015-06-10", SAMPLE["_id"]), ("2015-06-11", SAMPLE["_id"])]


def test_export_puts_the_day_first(lines):
    raw = raw_by_day(lines(SAMPLE))
    text = texts(export_lines(raw))[0]
    assert text.startswith('{"date":"2015-06-10","h":"q7"')
    assert json.loads(text) == {"date": "2015-06-10", **SAMPLE}


def test_first_clicks_are_stable(lines):
    raw = raw_by_day(lines(*[click(_id=str(i), t=1433920089 - 86400 * (i % 3)) for i in range(30)]))
    rows = [tuple(r) for r in first_clicks(raw).collect()]
    assert rows == sorted((r.date, r.event) for r in raw.collect())[:10]


def test_full_event(lines):
    df = full_events(parse_clicks(lines(SAMPLE, click(t=None, nk=1))))
    assert len(df.columns) == 17 and df.columns[0] == "date"
    first, second = df.collect()
    assert (first.date, first.timestamp, first.long_url) == ("2015-06-10", 1433920089, SAMPLE["u"])
    assert (second.date, second.timestamp, second.known_user) == ("N/A", None, 1)
