"""Day, hour, minute and second keys of an epoch, always in UTC.

The keys come from integer arithmetic, so they need no formatter per row and do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

# Unit words of the click queries, the answer for an unknown unit, and the
# answer for a missing epoch text.
EPOCH_UNITS = {"dia": "day", "hora": "hour", "minuto": "minute", "segundo": "second"}
TODAY_UNITS = {"dia": "day", "horas": "hour", "minutos": "minute", "segundos": "second"}
UNKNOWN_EPOCH_UNIT = "1970-01-01"
UNKNOWN_TODAY_UNIT = "1970-01-01 00:00:00"
MISSING = "N/A"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _part(epoch: Column, whole: str, part: str) -> Column:
    """How many full ``part`` lie in what is left of the current ``whole``."""
    rest = F.pmod(epoch, F.lit(SECONDS[whole]))
    return _two_digits(F.floor(rest / SECONDS[part]))


def _day(epoch: Column) -> Column:
    days = F.floor(epoch / SECONDS["day"]).try_cast("int")
    return F.date_from_unix_date(days).cast("string")


def _clock(epoch: Column, unit: str) -> Column:
    parts = [_part(epoch, "day", "hour"), _part(epoch, "hour", "minute"),
             _part(epoch, "minute", "second")]
    text = parts[0]
    for part in parts[1 : ["hour", "minute", "second"].index(unit) + 1]:
        text = F.concat(text, F.lit(":"), part)
    return text


def epoch_unit(epoch: Column | str, unit: str) -> Column:
    """The epoch's day (``yyyy-MM-dd``), or its time of day down to hour, minute or second.

    Takes ``day``/``hour``/``minute``/``second`` or the words of :data:`EPOCH_UNITS`; any
    other unit gives ``1970-01-01``. NULL stays NULL.
    """
    epoch = _column(epoch)
    unit = EPOCH_UNITS.get(unit, unit)
    if unit not in SECONDS:
        return F.lit(UNKNOWN_EPOCH_UNIT)
    return _day(epoch) if unit == "day" else _clock(epoch, unit)


def epoch_text_unit(text: Column | str, unit: str) -> Column:
    """:func:`epoch_unit` of an epoch held as text; ``N/A`` where there is none."""
    text = _column(text)
    value = epoch_unit(text.try_cast("bigint"), unit)
    return F.coalesce(F.when(text.isNotNull() & ~text.isin("", "()"), value), F.lit(MISSING))


def iso_utc(epoch: Column | str) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss'Z'``."""
    epoch = _column(epoch)
    return F.concat(_day(epoch), F.lit("T"), epoch_unit(epoch, "second"), F.lit("Z"))


def now_epoch() -> Column:
    """Start of the query as an epoch; Spark folds it to one value per query."""
    return F.unix_seconds(F.current_timestamp())


def today_unit(unit: str, now: Column | None = None, minutes_back: int = 0) -> Column:
    """The run time cut to a unit: ``yyyy-MM-dd``, then with hour, minute or second.

    ``now`` is an epoch column and defaults to the query's start; ``minutes_back=3`` gives
    the lagging variant. An unknown unit gives ``1970-01-01 00:00:00``.
    """
    unit = TODAY_UNITS.get(unit, unit)
    if unit not in SECONDS:
        return F.lit(UNKNOWN_TODAY_UNIT)
    epoch = (now_epoch() if now is None else now) - minutes_back * 60
    if unit == "day":
        return _day(epoch)
    return F.concat(_day(epoch), F.lit(" "), _clock(epoch, unit))


def day_label(day: Column | str) -> Column:
    """``yyyy-MM-dd`` as ``Wed, 10 Jun 2015``."""
    return F.date_format(_column(day).cast("date"), "EEE, d MMM yyyy")


def parse_minute(day: Column | str, time: Column | str) -> Column:
    """A ``yyyy-MM-dd`` day and ``HH:mm`` time as a zone-free timestamp."""
    text = F.concat_ws(" ", _column(day), _column(time))
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm"))


def time_bucket(epoch: Column | str, unit: str) -> Column:
    """Number of the second, minute, hour or day since 1970: a narrow grouping key."""
    return F.floor(_column(epoch) / SECONDS[unit])


def bucket_date(bucket: Column | str, unit: str) -> Column:
    return _day(_column(bucket) * SECONDS[unit])


def bucket_time(bucket: Column | str, unit: str) -> Column:
    return epoch_unit(_column(bucket) * SECONDS[unit], unit)
