"""Instants, lists as text, and the names of states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNTER_MAX = 4294967295


def trimmed_or_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def present(x: Column) -> Column:
    return F.coalesce(F.length(F.trim(x)) > 0, F.lit(False))


def join_list(x: Column) -> Column:
    """A list as comma text; an empty or null list is the empty text."""
    return F.coalesce(F.array_join(x.cast("array<string>"), ","), F.lit(""))


def split_list(x: Column, kind: str = "string") -> Column:
    """Comma text as a list; the empty text is an empty list."""
    return F.when(F.coalesce(x, F.lit("")) == "", F.array().cast(f"array<{kind}>")).otherwise(F.split(x, ",").cast(f"array<{kind}>"))


def utc_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_utc_iso(x: Column) -> Column:
    """A strict ``YYYY-MM-DDTHH:MM:SSZ`` instant; anything else fails the job."""
    strict = x.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.when(strict, F.to_timestamp(x)).when(x.isNotNull(), F.raise_error(F.concat(F.lit("not a UTC instant: "), x)).cast("timestamp"))


def parse_instant(x: Column) -> Column:
    """Unix seconds or an RFC 3339 instant; null if neither."""
    return F.when(x.rlike(r"^\s*\d+\s*$"), F.timestamp_seconds(F.trim(x).try_cast("long"))).otherwise(F.try_to_timestamp(x))


def of_seconds(x: Column) -> Column:
    """Unix seconds with a fraction as a timestamp; what is no number is the epoch."""
    good = x.isNotNull() & ~F.isnan(x)
    return F.when(good, F.timestamp_micros(F.floor(x * 1000000).cast("long"))).otherwise(F.timestamp_seconds(F.lit(0)))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def elapsed_days(first: Column, last: Column) -> Column:
    """Whole 24-hour days between two instants, towards zero. Not a difference of calendar days."""
    micros = F.unix_micros(last) - F.unix_micros(first)
    return (F.signum(micros) * F.floor(F.abs(micros) / 86400000000)).cast("long")


def saturating_sum(a: Column, b: Column) -> Column:
    return F.least(a + b, F.lit(COUNTER_MAX))


def horizon_bucket(lead: Column, contact: Column) -> Column:
    """The lead in days before an announcement as a range."""
    return (
        F.when(~contact | lead.isNull(), "miss").when(lead > 365, ">365").when(lead >= 181, "181-365").when(lead >= 91, "91-180")
        .when(lead >= 31, "31-90").when(lead >= 8, "8-30").when(lead >= 1, "1-7").when(lead == 0, "0").otherwise("post-announce")
    )


def announce_day(notes: Column, window_end: Column) -> Column:
    """The first valid ``announce=YYYY-MM-DD`` word of the notes, else the day the window ends."""
    days = F.transform(
        F.filter(F.split(F.coalesce(notes, F.lit("")), r"\s+"), lambda w: w.rlike(r"^announce=\d{4}-\d{1,2}-\d{1,2}$")),
        lambda w: F.try_to_date(F.substring(w, 10, 20), "yyyy-M-d"),
    )
    return F.coalesce(F.try_element_at(F.filter(days, lambda d: d.isNotNull()), F.lit(1)), F.to_date(window_end))
