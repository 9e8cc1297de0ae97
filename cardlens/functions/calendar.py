"""Row-level calendar columns (all built-in expressions, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRX_TIME_FORMAT = "ddMMMyy:HH:mm:ss"   # e.g. 18APR17:01:02:03, month name in any case
PERIOD_FORMAT = "dd/MM/yyyy"
RATE_DATE_FORMAT = "yyyy-MM-dd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_trx_time(s) -> Column:
    """Tolerant parse: NULL on text that does not match."""
    return F.try_to_timestamp(_c(s), F.lit(TRX_TIME_FORMAT)).cast("timestamp_ntz")


def parse_period(s) -> Column:
    return F.try_to_date(_c(s), PERIOD_FORMAT)


def parse_rate_date(s) -> Column:
    return F.try_to_date(_c(s), RATE_DATE_FORMAT)


def epoch_day(ts) -> Column:
    return F.unix_date(F.to_date(_c(ts)))


def epoch_week(ts) -> Column:
    return F.floor(epoch_day(ts) / 7)


def month_index(d) -> Column:
    """Absolute month number year*12 + month."""
    return F.year(_c(d)) * 12 + F.month(_c(d))


def base_month_index(ts, base_year: int) -> Column:
    """month + (year - base_year) * 12."""
    return F.month(_c(ts)) + (F.year(_c(ts)) - base_year) * 12


def day_part(hour) -> Column:
    """0-8 -> 1, 9-18 -> 2, otherwise 0."""
    h = _c(hour)
    return F.when((h >= 0) & (h <= 8), 1).when((h > 8) & (h <= 18), 2).otherwise(0)


def weekday0(ts) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(ts))


def iso_weekday_or_zero(ts) -> Column:
    """1 = Monday ... 7 = Sunday; 0 when the time is missing."""
    return F.coalesce(F.weekday(_c(ts)) + 1, F.lit(0))


def quarter0(ts) -> Column:
    return F.quarter(_c(ts)) - 1


def days_since(ts, date: str) -> Column:
    """Whole days from ``date`` (midnight) to ``ts``."""
    return F.datediff(F.to_date(_c(ts)), F.to_date(F.lit(date)))


def channel_code(s) -> Column:
    """Missing channel -> '0'; then the last character as an int."""
    return F.coalesce(F.right(F.coalesce(_c(s), F.lit("0")), F.lit(1)).try_cast("int"), F.lit(0))


def round_flag(amount, divisor: int) -> Column:
    """1 when the amount is a whole multiple of ``divisor`` (NULL -> 0)."""
    return F.coalesce(((_c(amount) % divisor) == 0).cast("int"), F.lit(0))


def period_part(day_number, n: int) -> Column:
    return F.floor((_c(day_number) + 1) / n)


def holiday_flag(ts, holidays) -> Column:
    """1 when the calendar day is in the (fixed, small) holiday list."""
    days = [F.lit(h).cast("date") for h in holidays]
    return F.coalesce(F.to_date(_c(ts)).isin(*days).cast("int"), F.lit(0)) if days else F.lit(0)
