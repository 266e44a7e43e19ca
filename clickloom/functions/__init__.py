"""Column expressions; none of them leaves the JVM."""

from clickloom.functions.clock import (
    bucket_date, bucket_time, day_label, epoch_text_unit, epoch_unit, iso_utc, now_epoch,
    parse_minute, time_bucket, today_unit,
)
from clickloom.functions.country import country_names, with_country
from clickloom.functions.geo import geo_cell, geohash, geohash_of_cell, inverted_location
from clickloom.functions.sqlnames import register_functions
from clickloom.functions.web import domain_of

__all__ = [
    "bucket_date", "bucket_time", "country_names", "day_label", "domain_of", "epoch_text_unit",
    "epoch_unit", "geo_cell", "geohash", "geohash_of_cell", "inverted_location", "iso_utc",
    "now_epoch", "parse_minute", "register_functions", "time_bucket", "today_unit",
    "with_country",
]
