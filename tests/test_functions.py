import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickloom import functions as fn


def values(spark, rows, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize("url, domain", [
    ("http://maps.example.gov/harbour/1?x=/y", "maps.example.gov"),
    ("http://u@h.gov:8080/x", "u@h.gov:8080"),
    ("HTTP://Www.NASA.gov", "Www.NASA.gov"),
    ("", "N/A"), (None, None), ("no-scheme", None), ("http://", None), ("a/b", None),
])
def test_domain_of(spark, url, domain):
    assert values(spark, [(url,)], "u string", fn.domain_of("u")) == [(domain,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("epoch", [1433920089, 0, -1, 86399, 1709251199, 951782400, 4102444799])
def test_epoch_units_ignore_the_session_zone(spark, zone, epoch):
    at = dt.datetime.fromtimestamp(epoch, dt.timezone.utc)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        words = ["dia", "hora", "minuto", "segundo", "year"]
        columns = [fn.epoch_unit("t", w) for w in words] + [fn.iso_utc("t")]
        rows = values(spark, [(epoch,)], "t bigint", *columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == [(f"{at:%Y-%m-%d}", f"{at:%H}", f"{at:%H:%M}", f"{at:%H:%M:%S}", "1970-01-01",
                     f"{at:%Y-%m-%dT%H:%M:%SZ}")]


def test_missing_epoch(spark):
    columns = [fn.epoch_unit("t", u) for u in ("day", "hour", "minute", "second")]
    assert values(spark, [(None,)], "t bigint", *columns) == [(None,) * 4]


@pytest.mark.parametrize("text, day", [
    ("1433920089", "2015-06-10"), ("", "N/A"), ("()", "N/A"), (None, "N/A"), ("x1", "N/A"),
])
def test_epoch_text(spark, text, day):
    assert values(spark, [(text,)], "t string", fn.epoch_text_unit("t", "dia")) == [(day,)]


def test_epoch_text_unknown_unit(spark):
    rows = values(spark, [("1433920089",), ("",)], "t string", fn.epoch_text_unit("t", "year"))
    assert rows == [("1970-01-01",), ("N/A",)]


@pytest.mark.parametrize("unit, text", [
    ("dia", "2015-06-10"), ("horas", "2015-06-10 07"), ("minutos", "2015-06-10 07:08"),
    ("segundos", "2015-06-10 07:08:09"), ("year", "1970-01-01 00:00:00"),
])
def test_today(spark, unit, text):
    assert values(spark, [(1433920089,)], "t bigint", fn.today_unit(unit, F.col("t"))) == [(text,)]


def test_three_minutes_back_crosses_midnight(spark):
    column = fn.today_unit("segundos", F.col("t"), minutes_back=3)
    assert values(spark, [(1433894460,)], "t bigint", column) == [("2015-06-09 23:58:00",)]


def test_today_is_now(spark):
    day = spark.range(1).select(fn.today_unit("day")).first()[0]
    assert abs((dt.date.fromisoformat(day) - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_labels(spark):
    row = values(spark, [("2015-06-10", "07:08")], "d string, m string", fn.day_label("d"),
                 fn.parse_minute("d", "m"))
    assert row == [("Wed, 10 Jun 2015", dt.datetime(2015, 6, 10, 7, 8))]


def bisected_geohash(lat, lon, precision):
    """Geohash by halving intervals."""
    spans, bits = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}, ""
    for position in range(5 * precision):
        span, value = spans[position % 2], (lon, lat)[position % 2]
        middle = sum(span) / 2
        bits += "1" if value >= middle else "0"
        span[0 if value >= middle else 1] = middle
    alphabet = "0123456789bcdefghjkmnpqrstuvwxyz"
    return "".join(alphabet[int(bits[i:i + 5], 2)] for i in range(0, len(bits), 5))


def test_known_geohashes(spark):
    points = [(57.64911, 10.40744), (57.7072, 11.9668), (90.0, 180.0), (None, None)]
    cells = values(spark, points, "lat double, lon double", fn.geohash(F.col("lat"), F.col("lon")))
    assert cells == [("u4pruyd",), ("u628233",), ("zzzzzzz",), (None,)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-900000, 900000), st.integers(-1800000, 1800000)),
                min_size=1, max_size=200))
def test_geohash_equals_bisection(spark, tenths):
    points = [(lat / 1e4, lon / 1e4) for lat, lon in tenths]
    df = spark.createDataFrame(points, "lat double, lon double")
    for precision in (1, 4, 5):
        for row in df.withColumn("g", fn.geohash(F.col("lat"), F.col("lon"), precision)).collect():
            assert row.g == bisected_geohash(row.lat, row.lon, precision)


@pytest.mark.parametrize("ll, location", [
    ([57.7, 11.9], [11.9, 57.7]), (None, None), ([1.0], None), ([], None),
])
def test_inverted_location(spark, ll, location):
    rows = values(spark, [(ll,)], "ll array<double>", fn.inverted_location("ll"))
    assert rows == [(location,)]


def test_countries(spark):
    codes = [("SE",), ("US",), ("us",), ("ZZ",), ("",), (None,), ("XK",), ("EU",), ("AN",), ("CS",)]
    named = fn.with_country(spark.createDataFrame(codes, "country_code string")).collect()
    assert {row.country_code: row.country for row in named} == {
        "XK": "Kosovo", "EU": "European Union", "AN": "Netherlands Antilles", "CS": "Serbia and Montenegro",
        "SE": "Sweden", "US": "United States", "us": "United States", "ZZ": "ZZ", "": "",
        None: None,
    }


def test_countries_in_another_language(spark):
    df = spark.createDataFrame([("DE",)], "country_code string")
    assert fn.with_country(df, lang="es").first().country == "Alemania"


def test_country_dimension_is_small(spark):
    dim = fn.country_names(spark)
    assert 240 <= dim.count() <= 300
    assert dim.select("code").distinct().count() == dim.count()


def test_sql_functions_equal_column_functions(spark):
    fn.register_functions(spark)
    rows = [(1433920089, "1433920089", "http://u@h.gov:8080/x"), (-1, "-1", ""), (None, "()", "x"),
            (0, "no", None)]
    df = spark.createDataFrame(rows, "t bigint, s string, u string")
    columns, texts = [fn.domain_of("u")], ["getDomain(u)"]
    for unit in ("dia", "hora", "minuto", "segundo", "year"):
        columns += [fn.epoch_unit("t", unit), fn.epoch_text_unit("s", unit)]
        texts += [f"getTimeFromEpoch(t, '{unit}')", f"getTimeFromEpoch2(s, '{unit}')"]
    ours = [tuple(row) for row in df.select(*columns).collect()]
    assert [tuple(row) for row in df.selectExpr(*texts).collect()] == ours


def test_sql_today(spark):
    fn.register_functions(spark)
    row = spark.sql("SELECT getToday('dia') d, getToday('horas') h, getToday('minutos') m, "
                    "getToday('segundos') s, getToday('x') x, getToday2('segundos') b").first()
    assert row.s.startswith(row.m) and row.m.startswith(row.h) and row.h.startswith(row.d)
    assert row.x == "1970-01-01 00:00:00"
    gap = dt.datetime.fromisoformat(row.s) - dt.datetime.fromisoformat(row.b)
    assert gap == dt.timedelta(minutes=3)
