"""From logged text to the columns the metrics use."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.operators.geo import GeoTable, with_country
from bucketlens.operators.selection import exclude_meta_files


def derive_columns(logs: DataFrame, lenient: bool = False) -> DataFrame:
    """Request time, sizes, method, folder, referrer host and day; no country."""
    return logs.select(
        R.request_time(F.col("requestdatetime"), lenient).alias("request_ts"),
        R.byte_count(F.col("bytessent")).alias("bytessent"),
        R.byte_count(F.col("objectsize")).alias("objectsize"),
        R.method(F.col("operation")).alias("method"),
        R.top_level_key(F.col("key")).alias("top_level_key"),
        F.col("key"),
        F.col("remoteip"),
        R.referrer_host(F.col("referrer")).alias("referrer"),
        F.col(S.PARTITION_COLUMN).alias("day"),
    )


def check_times(logs: DataFrame, lenient: bool = False, bad_times: Observation | None = None) -> DataFrame:
    """Requests whose time is checked in the pass that reads them.

    A time that doesn't parse fails the job, whether the job uses times or not. If
    ``lenient`` it passes; ``bad_times`` then counts such rows as ``bad_times``. A
    missing time isn't bad.
    """
    text = F.col("requestdatetime")
    bad = text.isNotNull() & R.request_time(text, lenient=True).isNull()
    if bad_times is not None:
        return logs.observe(bad_times, F.count_if(bad).alias("bad_times"))
    if lenient:
        return logs
    return logs.where(F.when(bad, F.raise_error(F.concat(F.lit("no request time: "), text)).cast("boolean")).otherwise(True))


def prepare(
    logs: DataFrame, geo: GeoTable | None = None, lenient: bool = False, bad_times: Observation | None = None
) -> DataFrame:
    """Derived columns without the meta files; with ``geo``, the country as well.

    Times are checked as in ``check_times``; giving ``bad_times`` means ``lenient``.

    The metrics need the country per address, not per request: they take the
    frame without it and look addresses up after counting.
    """
    lenient = lenient or bad_times is not None
    prepared = derive_columns(check_times(exclude_meta_files(logs), lenient, bad_times), lenient)
    return prepared if geo is None else with_country(prepared, geo)


def derive_key_components(prepared: DataFrame) -> DataFrame:
    key = F.col("key")
    return prepared.withColumns({"project": R.project(key), "feature": R.feature(key), "fileformat": R.file_format(key)})
