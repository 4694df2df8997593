"""Date Column functions.

``run_ts`` is always a parameter (a Column or a ``datetime``), never the
clock, so a rerun of the same batch gives the same rows.  Times are naive
wall-clock values: TIMESTAMP_NTZ throughout.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# The nine input shapes of the date normalizer, tried in order
# (anchored at both ends).
RE_YMD_HMS = r"^\d\d\d\d-\d+-\d+ \d+:\d+:\d+$"
RE_YMD_HM = r"^\d\d\d\d-\d+-\d+ \d+:\d+$"
RE_YMD = r"^\d\d\d\d-\d+-\d+$"
RE_CJK = r"^\d{4}年\d{2}月\d{2}日 \d{2}:\d{2}$"
RE_MD_HM = r"^\d{2}-\d{2} \d{2}:\d{2}$"
RE_ISO_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\+|-)\d{2}:\d{2}$"
MONTHS_FULL = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")
MONTHS_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep",
               "Oct", "Nov", "Dec")
RE_MONTH_FULL = r"(?i)^(" + "|".join(MONTHS_FULL) + r") \d{1,2}, \d{4}$"
RE_MONTH_ABBR = r"(?i)^(" + "|".join(MONTHS_ABBR) + r") \d{1,2}, \d{4}$"

OUT_FMT = "yyyy-MM-dd HH:mm:ss"
LOOSE_FMT = "yyyy-M-d H:m:s"


def as_ts(run_ts) -> Column:
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    if isinstance(run_ts, _dt.datetime):
        return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def parse_loose(s: Column) -> Column:
    """``strptime(s, '%Y-%m-%d %H:%M:%S')``: unpadded parts allowed, NULL if invalid."""
    return F.try_to_timestamp(s, F.lit(LOOSE_FMT)).cast("timestamp_ntz")


def normalize_date(s: Column, run_ts) -> Column:
    """one of nine shapes -> ``yyyy-MM-dd HH:mm:ss`` text (string column).

    An invalid calendar date inside a recognised shape gives NULL (the
    reference raises).
    """
    now = as_ts(run_ts)
    now_str = F.date_format(now, OUT_FMT)
    now_time = F.date_format(now, "HH:mm:ss")
    today = F.to_date(now)
    d3 = F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-M-d")).cast("date")
    cjk = F.try_to_timestamp(s, F.lit("yyyy年MM月dd日 HH:mm"))
    iso = F.try_to_timestamp(F.substring(s, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    full = F.try_to_timestamp(s, F.lit("MMMM d, yyyy"))
    abbr = F.try_to_timestamp(s, F.lit("MMM d, yyyy"))
    return (
        F.when(s.isNull(), now_str)
        .when(s.rlike(RE_YMD_HMS), s)
        .when(s.rlike(RE_YMD_HM), F.concat(s, F.lit(":00")))
        .when(s.rlike(RE_YMD),
              F.when(d3.isNull(), F.lit(None).cast("string"))
              .when(d3 < today, F.concat(F.date_format(d3, "yyyy-MM-dd"), F.lit(" 23:59:00")))
              .otherwise(F.concat(F.date_format(d3, "yyyy-MM-dd"), F.lit(" "), now_time)))
        .when(s.rlike(RE_CJK), F.date_format(cjk, "yyyy-MM-dd HH:mm:00"))
        .when(s.rlike(RE_MD_HM), F.concat(F.date_format(now, "yyyy"), F.lit("-"), s, F.lit(":00")))
        .when(s.rlike(RE_ISO_OFFSET), F.date_format(iso, OUT_FMT))
        .when(s.rlike(RE_MONTH_FULL), F.date_format(full, OUT_FMT))
        .when(s.rlike(RE_MONTH_ABBR), F.date_format(abbr, OUT_FMT))
        .otherwise(now_str)
    )


def news_date(s: Column, run_ts) -> Column:
    """F1, then a value later than ``run_ts`` is moved back one year (once).

    Returns the text; the year-back text may be an invalid date (29 February),
    which ``parse_loose`` turns into NULL.
    """
    now = as_ts(run_ts)

    def year_back(fmt: Column) -> Column:
        ts = parse_loose(fmt)
        back = F.concat(F.lpad((F.year(ts) - 1).cast("string"), 4, "0"), F.date_format(ts, "-MM-dd HH:mm:ss"))
        return F.when(ts > now, back).otherwise(fmt)

    return let(normalize_date(s, run_ts), year_back)


def batch_id(run_ts) -> Column:
    """``yyyyMMddHHmmss`` as bigint."""
    return F.date_format(as_ts(run_ts), "yyyyMMddHHmmss").cast("bigint")


def day_start(run_ts) -> Column:
    """``yyyy-MM-dd 00:00:00`` text of the run day."""
    return F.date_format(as_ts(run_ts), "yyyy-MM-dd 00:00:00")


def lookback_hours(hours: Column) -> Column:
    """C3 rule: missing or 0 hours means 1."""
    return F.when(F.coalesce(hours, F.lit(0)) == 0, F.lit(1)).otherwise(hours)


def end_time(run_ts, hours: Column) -> Column:
    """``run_ts - hours``."""
    return as_ts(run_ts) - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                           lookback_hours(hours).cast("int"))


def end_time_epoch(run_ts, hours: Column) -> Column:
    """C4: the same bound as epoch seconds (wall time read as UTC)."""
    return F.unix_timestamp(as_ts(run_ts).cast("timestamp")) - lookback_hours(hours).cast("bigint") * 3600
