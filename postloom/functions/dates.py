"""Posted-date texts to timestamps; "now" is always passed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.fixed_values import NOW_WORDS, POSTED_FORMATS, POSTED_PREFIX, RELATIVE_AGE, WS
from postloom.functions.text import strip

_ZONE = r"(Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?"
_CLOCK = r"([0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?)"
_ISO_DATE = r"([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}|[0-9]{4}-?W[0-9]{2}(?:-?[1-7])?)"
_ISO = f"^{_ISO_DATE}(?:.{_CLOCK}{_ZONE})?$"


def _iso_day(day: Column) -> Column:
    """A calendar, basic or week date as a date."""
    dashed = F.when(day.rlike("^[0-9]{8}$"), F.regexp_replace(day, "^(....)(..)(..)$", "$1-$2-$3")).otherwise(day)
    year = F.substr(day, F.lit(1), F.lit(4))
    week = F.regexp_extract(day, "W([0-9]{2})", 1).try_cast("int")
    weekday = F.coalesce(F.regexp_extract(day, "W[0-9]{2}-?([1-7])$", 1).try_cast("int"), F.lit(1))
    first_monday = F.trunc(F.concat(year, F.lit("-01-04")).try_cast("date"), "week")
    by_week = F.date_add(first_monday, (week - 1) * 7 + weekday - 1)
    return F.when(F.contains(day, F.lit("W")), by_week).otherwise(dashed.try_cast("date"))


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 only; a text without an offset is UTC."""
    day = _iso_day(F.regexp_extract(text, _ISO, 1)).cast("string")
    clock = F.replace(F.regexp_extract(text, _ISO, 2), F.lit(","), F.lit("."))
    clock = F.concat(clock, F.substr(F.lit("00:00:00"), F.least(F.length(clock), F.lit(8)) + 1))
    zone = F.regexp_extract(text, _ISO, 3)
    zone = F.when(zone.isin("", "Z"), F.lit("+00:00")).otherwise(
        F.regexp_replace(F.regexp_replace(zone, "^(...)$", "$1:00"), "^(...)([0-9]{2})", "$1:$2")
    )
    return F.when(text.rlike(_ISO), F.concat(day, F.lit(" "), clock, zone).try_cast("timestamp"))


_UNIT_SECONDS = {"mi": 60, "ho": 3600, "hr": 3600, "da": 86400, "we": 7 * 86400, "mo": 30 * 86400, "ye": 365 * 86400}


def posted_at(value: Column, now: Column) -> Column:
    """ISO, then "today" words, then an age ("3 days ago"), then four written dates; else null."""
    raw = strip(value)
    low = strip(F.regexp_replace(F.lower(raw), POSTED_PREFIX, ""))
    age = RELATIVE_AGE.replace("WS", WS)
    amount = F.regexp_extract(low, age, 1).try_cast("bigint")
    unit = F.left(F.regexp_extract(low, age, 2), F.lit(2))
    seconds = F.coalesce(*[F.when(unit == u, F.lit(s)) for u, s in _UNIT_SECONDS.items()])
    written = F.coalesce(
        *[
            # A written date has no offset; it is UTC whatever the session's zone.
            F.try_to_timestamp(F.concat(raw, F.lit(" +0000")), F.lit(f"{fmt} Z"))
            for fmt in POSTED_FORMATS
        ]
    )
    return F.coalesce(
        iso_timestamp(raw),
        F.when(low.isin(NOW_WORDS), now)
        .when(low == "yesterday", now - F.expr("INTERVAL '1' DAY"))
        .when(amount.isNotNull(), F.timestamp_add("SECOND", -(amount * seconds), now)),
        written,
    )
