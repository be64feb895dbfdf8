"""Scalar date/time expressions (survey 2B).  All are JVM built-ins, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day names indexed by weekday (Mon = 0).
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_range_filter(col, start: str, end: str) -> Column:
    """``date(col) BETWEEN start AND end`` written as a half-open range
    on the raw timestamp, so parquet row-group pruning still applies."""
    c = _c(col)
    lo = F.lit(start).cast("date").cast("timestamp_ntz")
    hi = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


def day_diff(start, end) -> Column:
    """Calendar days from ``start`` to ``end`` (day boundaries crossed)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("long")


def day_diff_nonneg(start, end) -> Column:
    """Day difference, negative values become NULL."""
    d = day_diff(start, end)
    return F.when(d < 0, F.lit(None).cast("long")).otherwise(d)


def parse_ts19(col, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse the first 19 characters; malformed text becomes NULL."""
    return F.try_to_timestamp(F.substring(_c(col).cast("string"), 1, 19), F.lit(fmt)) \
        .cast("timestamp_ntz")


def hour_of(col) -> Column:
    return F.hour(_c(col)).cast("int")


def day_of_month(col) -> Column:
    return F.dayofmonth(_c(col)).cast("int")


def weekday_mon0(col) -> Column:
    """Day of week with Monday = 0 (pandas convention)."""
    return F.weekday(_c(col)).cast("int")


def month_of(col) -> Column:
    return F.month(_c(col)).cast("int")


def weekday_name(col) -> Column:
    """``Mon`` .. ``Sun``."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, weekday_mon0(col) + 1)


def age_years(bday, as_of: str) -> Column:
    """Completed years at ``as_of`` (a parameter, never 'today')."""
    return F.floor(F.months_between(F.lit(as_of).cast("date"), _c(bday)) / 12).cast("long")


def age_days_365(bday, as_of: str) -> Column:
    """``round(days / 365, 1)``."""
    return F.round(F.datediff(F.lit(as_of).cast("date"), _c(bday)) / F.lit(365.0), 1)


def pay_date(joined, gap) -> Column:
    """Join date + ceil(gap) days."""
    return F.date_add(F.to_date(_c(joined)), F.ceil(_c(gap)).cast("int"))


def round_half_up(col, digits: int = 2) -> Column:
    """``round(x, d)`` as ``floor(x·10^d + 0.5) / 10^d`` in plain IEEE
    arithmetic, so the result does not depend on the engine's decimal
    rounding mode (the SQL oracle uses the same expression)."""
    scale = float(10 ** digits)
    return F.floor(_c(col) * scale + 0.5) / scale


def tenths(col) -> Column:
    """Seconds with one decimal as an exact integer count of tenths."""
    return F.round(_c(col) * 10).cast("long")


def minutes_2dp(sum_tenths) -> Column:
    """``round(seconds / 60, 2)`` computed exactly from a sum of tenths of a
    second: ``floor((t + 3) / 6) / 100`` (half-up).  An exact integer sum
    makes the result independent of the order in which partitions add up."""
    return F.floor((_c(sum_tenths) + 3) / 6) / 100.0
