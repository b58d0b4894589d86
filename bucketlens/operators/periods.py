"""Reporting periods and the month-by-month trend."""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketlens import schema as S

FREQUENCIES = ["daily", "weekly", "monthly", "quarterly"]
TREND_MONTHS = 5


def period_bounds(day: Column, frequency: str) -> tuple[Column, Column]:
    """First and last day of the whole period before the one ``day`` lies in."""
    if frequency == "daily":
        return F.date_sub(day, 1), F.date_sub(day, 1)
    if frequency == "weekly":
        monday = F.trunc(day, "week")
        return F.date_sub(monday, 7), F.date_sub(monday, 1)
    if frequency == "monthly":
        month = F.trunc(day, "month")
        return F.add_months(month, -1), F.date_sub(month, 1)
    if frequency == "quarterly":
        quarter = F.trunc(day, "quarter")
        return F.add_months(quarter, -3), F.date_sub(quarter, 1)
    raise ValueError(f"frequency must be one of {', '.join(FREQUENCIES)}: {frequency}")


def period_window(reference_dates: DataFrame, column: str, frequency: str) -> DataFrame:
    """Window of each reference date as ``yyyy/MM/dd`` texts."""
    start, end = period_bounds(F.col(column), frequency)
    return reference_dates.select(
        F.col(column),
        F.lit(frequency).alias("frequency"),
        F.date_format(start, S.DAY_FORMAT).alias("window_start"),
        F.date_format(end, S.DAY_FORMAT).alias("window_end"),
    )


def window_of(frequency: str | None = None, today: date | None = None, custom: tuple[str, str] | None = None) -> tuple[str, str]:
    """The window of one run, for a scan: a custom ``YYYY-MM-DD`` pair, or by frequency."""
    if custom:
        start, end = (datetime.strptime(text, "%Y-%m-%d").date() for text in custom)
        if start > end:
            raise ValueError(f"window starts after it ends: {start} > {end}")
    else:
        start, end = _previous_period(today or date.today(), frequency or "monthly")
    return f"{start:%Y/%m/%d}", f"{end:%Y/%m/%d}"


def _previous_period(today: date, frequency: str) -> tuple[date, date]:
    one = timedelta(days=1)
    if frequency == "daily":
        return today - one, today - one
    if frequency == "weekly":
        monday = today - timedelta(days=today.weekday())
        return monday - timedelta(days=7), monday - one
    if frequency not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {', '.join(FREQUENCIES)}: {frequency}")
    months = 1 if frequency == "monthly" else 3
    current = date(today.year, (today.month - 1) // months * months + 1, 1)
    last = current - one
    return date(last.year, last.month - months + 1, 1), last


def previous_months(periods: DataFrame, column: str = "period_start", months: int = TREND_MONTHS) -> DataFrame:
    """The calendar months before each period start: ``age`` 1 is the newest."""
    start = F.expr(f"add_months(trunc(`{column}`, 'month'), -age)")
    aged = periods.withColumn("age", F.explode(F.sequence(F.lit(1), F.lit(months))))
    return aged.select(
        *periods.columns,
        "age",
        start.alias("month_start"),
        F.last_day(start).alias("month_end"),
    )


def with_history(periods: DataFrame, history: DataFrame) -> DataFrame:
    """Stored metrics of each period; NULL where none are stored.

    ``periods`` names its period ``month_start``, ``month_end``.
    """
    stored = history.withColumnsRenamed({"period_start": "month_start", "period_end": "month_end"})
    return periods.join(stored, ["month_start", "month_end"], "left")


def usage_trend(current: DataFrame, history: DataFrame, months: int = TREND_MONTHS) -> DataFrame:
    """Downloads and unique users of the months before each period, and of the period.

    ``current`` holds period_start, period_end and the two metrics. One row per
    period; a month without stored metrics has NULL metrics.
    """
    downloads, users = S.REPORT_METRICS["downloads_count"], S.REPORT_METRICS["unique_users"]
    period = ["period_start", "period_end"]
    earlier = with_history(previous_months(current.select(*period), months=months), history)
    now = current.select(
        *period,
        F.lit(0).alias("age"),
        F.col("period_start").alias("month_start"),
        F.col("period_end").alias("month_end"),
        downloads,
        users,
    )
    return now.unionByName(earlier.select(*now.columns))
