"""Calendar columns.  All of them work on zone-less timestamps, so results do
not depend on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def week_label(ts: Column | str) -> Column:
    """``'YYYY-Www'`` of Monday-based weeks of the calendar year.

    Days before the first Monday are week 00, so a week across New Year carries
    two labels.  String order is time order.  (ISO week numbers differ.)
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    week = F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7)
    return F.concat(
        F.lpad(F.year(ts).cast("string"), 4, "0"),
        F.lit("-W"),
        F.lpad(week.cast("string"), 2, "0"),
    )


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp taken as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(ts.cast("date"), F.lit(EPOCH[:10]).cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def from_epoch_seconds(seconds: Column | str) -> Column:
    """Zone-less UTC timestamp of a number of seconds since 1970."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return ntz(EPOCH) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def ntz(value) -> Column:
    """Zone-less timestamp literal from a string, date or datetime."""
    return F.lit(str(value)).cast("timestamp_ntz")


def age_hours(ts: Column | str, as_of: Column) -> Column:
    return (epoch_seconds(as_of) - epoch_seconds(ts)) / F.lit(3600.0)


def utc_timestamp(text: Column | str) -> Column:
    """Zone-less UTC timestamp of an ISO text; an offset is applied, ``Z`` or none means UTC.

    Null if the text is no timestamp.  Independent of the session time zone.
    """
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    zone = r"(?:[Zz]|[+-][0-9]{2}:?[0-9]{2})$"
    offset = F.regexp_extract(text, rf"[T ][0-9:.]+({zone})", 1)
    local = F.regexp_replace(text, rf"(?<=[0-9]){zone}", "")
    at = F.when(offset == "", text).otherwise(local).try_cast("timestamp_ntz")
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    east = F.when(F.startswith(offset, F.lit("-")), -minutes).otherwise(minutes)
    return at - F.make_dt_interval(mins=F.coalesce(east, F.lit(0)))
