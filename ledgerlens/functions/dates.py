"""Calendar expressions. All are zone-free: timestamps are TIMESTAMP_NTZ."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def month_floor(ts: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(ts, "month")


def date_parts(ts: Column | str) -> tuple[Column, Column, Column]:
    return F.year(ts), F.month(ts), F.dayofmonth(ts)


def cohort_index(month: Column | str, cohort_month: Column | str) -> Column:
    """Months since the first one, which counts as 1."""
    years = F.year(month) - F.year(cohort_month)
    months = F.month(month) - F.month(cohort_month)
    return years * 12 + months + 1


def elapsed_days(as_of: dt.datetime, ts: Column | str) -> Column:
    """Whole 24-hour days from ``ts`` to ``as_of``, rounded down.

    Not a calendar ``datediff``: 23:00 to 01:00 is 0 days, and 23 hours into
    the future is -1. EXTRACT truncates towards zero, hence the correction.
    """
    if as_of.tzinfo is not None:
        raise ValueError("as_of must be a naive datetime, like the invoice times")
    ts = F.col(ts) if isinstance(ts, str) else ts
    # As text: a datetime literal would be a zoned timestamp.
    gap = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz") - ts.cast("timestamp_ntz")
    days = F.extract(F.lit("DAY"), gap)
    return (days - F.when(gap < F.make_dt_interval(days), 1).otherwise(0)).cast("long")


def month_label(month: Column | str) -> Column:
    return F.date_format(month, "yyyy-MM")


def parse_timestamp(text: Column | str, fmt: str, on_error: str = "fail") -> Column:
    """Text to TIMESTAMP_NTZ; bad text fails the query or becomes null.

    The only parser that yields null is one of zoned times, so the text is read
    as UTC and counted from the epoch: the session's zone has no part in it.
    """
    text = F.col(text) if isinstance(text, str) else text
    if on_error == "null":
        instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} Z"))
        seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    parsed = F.to_timestamp_ntz(text, F.lit(fmt))
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), text))).otherwise(parsed)
