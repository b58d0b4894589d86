"""Log directories as tables of the catalogue, for users of SQL.

Days are partitions that are computed from a range, not listed, so a filter on the day
in SQL text reads just the directories of those days.
"""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from bucketlens import schema as S
from bucketlens.sources.log_text import _as_date, check_window, parse_access_log

# Partitions added by one statement.
AT_ONCE = 500


def _days(start: date, end: date) -> list[str]:
    return [f"{start + timedelta(days=n):%Y/%m/%d}" for n in range((end - start).days + 1)]


def register_log_lines(spark: SparkSession, base: str, table: str, start: str, end: str) -> None:
    """External table of text lines with one partition per day of the window; more days may be added later.

    Days without a directory are partitions without rows.
    """
    check_window(start, end)
    column = f"`{S.PARTITION_COLUMN}`"
    base = base.rstrip("/")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (value STRING, {column} STRING) USING text PARTITIONED BY ({column}) LOCATION '{base}'")
    days = _days(_as_date(start), _as_date(end))
    for at in range(0, len(days), AT_ONCE):
        places = " ".join(f"PARTITION ({column}='{day}') LOCATION '{base}/{day}'" for day in days[at : at + AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {places}")


def register_access_log(spark: SparkSession, table: str, view: str) -> DataFrame:
    """The parsed requests of such a table as a view; its filters on the day reach the partitions."""
    logs = parse_access_log(spark.table(table))
    logs.createOrReplaceTempView(view)
    return logs
