"""Projections and filters on the access log."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.sources.log_text import check_window


def filter_object_requests(logs: DataFrame) -> DataFrame:
    """Requests that name an object; a NULL key is dropped too."""
    return logs.where(R.is_object_request(F.col("key")))


def filter_day_window(logs: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose day text lies in the window, both ends included."""
    check_window(start, end)
    return logs.where(F.col(S.PARTITION_COLUMN).between(start, end))


def exclude_meta_files(logs: DataFrame) -> DataFrame:
    return logs.where(~R.is_meta_file(F.col("key")))


def filter_folder(prepared: DataFrame, folder: str) -> DataFrame:
    return prepared.where(F.col("top_level_key") == folder)


def select_usage_columns(logs: DataFrame) -> DataFrame:
    """The default projection: ten log columns and the key's first four parts."""
    parts = [R.key_part(F.col("key"), i).alias(n) for i, n in enumerate(S.KEY_PART_COLUMNS)]
    return logs.select(*S.USAGE_COLUMNS[:2], *parts, *S.USAGE_COLUMNS[2:])


def select_all_logs(logs: DataFrame) -> DataFrame:
    return logs.select(*(n for n, _ in S.ACCESS_LOG_COLUMNS), S.PARTITION_COLUMN)


def logs_in_period(logs: DataFrame, start: str, end: str, select_all: bool = False) -> DataFrame:
    """Object requests of the window in the default (or full) projection."""
    rows = filter_day_window(filter_object_requests(logs), start, end)
    return select_all_logs(rows) if select_all else select_usage_columns(rows)


def classify_requests(prepared: DataFrame) -> DataFrame:
    """Add the three request classes; they overlap (a download is an interaction)."""
    return prepared.withColumns(
        {
            "is_interaction": R.is_interaction(F.col("method")),
            "is_download": R.is_download(F.col("method")),
            "is_upload": R.is_upload(F.col("method")),
        }
    )


def report_sections(prepared: DataFrame) -> DataFrame:
    """Folders that get a section in the report."""
    return prepared.select("top_level_key").distinct().where(R.has_section(F.col("top_level_key")))


def sample_logs(logs: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows."""
    return logs.limit(n)
