"""Date parsing and formatting, timezone-independent (UTC wall clock)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MON_YEAR = "d-MMM-yyyy"        # accepts 1- and 2-digit days
DAY_MON_YEAR_OUT = "dd-MMM-yyyy"   # zero-padded, as written by the collectors
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _day_ntz(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def parse_day_mon_year(c, strict: bool = False) -> Column:
    """'4-Oct-2024' -> 2024-10-04 00:00 (UTC wall clock, TIMESTAMP_NTZ)."""
    d = F.try_to_date(_c(c), DAY_MON_YEAR)
    if strict:
        d = F.when(_c(c).isNull() | d.isNotNull(), d).otherwise(
            F.raise_error(F.concat(F.lit("unparseable date: "), _c(c))).cast("date"))
    return _day_ntz(d)


def parse_iso_day(c, strict: bool = False) -> Column:
    """ISO-8601 instant -> its UTC day at midnight (TIMESTAMP_NTZ)."""
    ts = F.try_to_timestamp(_c(c))
    micros = F.unix_micros(ts)
    d = F.date_from_unix_date(F.floor(micros / F.lit(86_400_000_000)).cast("int"))
    if strict:
        d = F.when(_c(c).isNull() | ts.isNotNull(), d).otherwise(
            F.raise_error(F.concat(F.lit("unparseable date: "), _c(c))).cast("date"))
    return _day_ntz(d)


def coerce_two_formats(c, strict: bool = True) -> Column:
    """Try 'd-MMM-yyyy', then ISO with Z; both failing raises (strict) or NULL."""
    d = F.coalesce(F.try_to_date(_c(c), DAY_MON_YEAR),
                   F.try_to_date(_c(c), ISO_Z))
    if strict:
        d = F.when(_c(c).isNull() | d.isNotNull(), d).otherwise(
            F.raise_error(F.concat(F.lit("unparseable date: "), _c(c))).cast("date"))
    return d


def epoch_to_day_text(c) -> Column:
    """Epoch seconds -> 'dd-Mon-yyyy' of the UTC day."""
    d = F.date_from_unix_date(F.floor(_c(c) / F.lit(86_400)).cast("int"))
    return F.date_format(d, DAY_MON_YEAR_OUT)
