"""Daily metrics: per day the whole service, every folder, and all downloaded files."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.operators.geo import GeoTable
from bucketlens.operators.metrics import ADDRESS, KEY, REFERRER
from bucketlens.operators.periods import window_of
from bucketlens.operators.prepare import prepare
from bucketlens.operators.selection import filter_object_requests
from bucketlens.plans.sections import (
    FOLDER,
    Value,
    count_for_sections,
    locate_counts,
    sum_sections,
)
from bucketlens.session import check_zone, job_folder, staged
from bucketlens.sinks.metrics import DOCUMENT_SCHEMA, as_json_documents
from bucketlens.sinks.published import Pointer, newest, read_store, replace_days
from bucketlens.sources.log_text import scan_access_log

# Log columns the metrics are made of.
NEEDED_COLUMNS = ["requestdatetime", "remoteip", "operation", "key", "bytessent", "objectsize", "referrer"]

VALUE_METRICS = ["locations", "referrers", "meta_downloads"]

# Long form of the daily metrics; ``folder`` is NULL for the whole service.
DAILY_ROWS_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("scope", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("sub_key", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)


def count_days(prepared: DataFrame) -> DataFrame:
    """Requests per day and distinct value: counts of disjoint logs may be added up."""
    return count_for_sections(prepared, ["day"])


def daily_metrics_from_counts(counted: DataFrame, geo: GeoTable, written: bool = False) -> DataFrame:
    """Long form of the daily metrics: date, scope, folder, metric, sub_key, value.

    ``written``: see ``sum_sections``.
    """
    locations = Value("locations", "country", "requests")
    referrers = Value("referrers", REFERRER, "requests")
    files = Value("meta_downloads", KEY, "downloads")
    folder = {KEY: [], ADDRESS: [locations], REFERRER: [referrers]}
    whole = {**folder, KEY: [files]}
    entries = sum_sections(locate_counts(counted, geo, ["day"]), ["day"], S.DAILY_METRICS, whole, folder, written)
    return entries.select(
        R.partition_day(F.col("day")).alias("date"),
        "scope",
        F.col(FOLDER).alias("folder"),
        "metric",
        "sub_key",
        F.col("n").alias("value"),
    )


def daily_metrics(prepared: DataFrame, geo: GeoTable, written: bool = False) -> DataFrame:
    return daily_metrics_from_counts(count_days(prepared), geo, written)


def daily_summaries(rows: DataFrame) -> DataFrame:
    """One row per date for the whole service, and one per date and folder.

    Columns: date, scope, folder (NULL for the whole), and the scalar metrics. The
    values of a section have no upper number; they stay rows, see ``daily_values``.
    """
    plain = rows.where(~F.col("metric").isin(VALUE_METRICS))
    metrics = (F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in S.DAILY_METRICS)
    return plain.groupBy("date", "scope", "folder").agg(*metrics)


def daily_values(rows: DataFrame) -> DataFrame:
    """One row per date, section, metric and value: locations, referrers, downloaded files."""
    return rows.where(F.col("metric").isin(VALUE_METRICS))


def document_rows(summaries: DataFrame, values: DataFrame) -> DataFrame:
    """Both back in long form, each metric and value once."""
    entries = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("sub_key"), F.col(m).alias("value")) for m in S.DAILY_METRICS))
    return summaries.select("date", "scope", "folder", F.inline(entries)).unionByName(values.select(*DAILY_ROWS_SCHEMA.names))


def store_days(rows: DataFrame, out: str) -> None:
    """Insert or replace the days' summaries, values and JSON documents, all in one step."""
    stores = {"values": daily_values(rows), "summaries": daily_summaries(rows), "documents": as_json_documents(rows)}
    replace_days(rows.sparkSession, out, stores)


def read_summaries(spark: SparkSession, out: str, pointer: Pointer | None = None) -> DataFrame:
    kinds = {"date": T.DateType(), "scope": T.StringType(), "folder": T.StringType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in [*kinds, *S.DAILY_METRICS]])
    return read_store(spark, out, "summaries", schema, pointer)


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """The stored days as JSON documents: date, part, summary, folders, meta_downloads."""
    return read_store(spark, out, "documents", DOCUMENT_SCHEMA)


def read_days(spark: SparkSession, out: str) -> DataFrame:
    """The stored days in long form, both stores as one run left them."""
    pointer = newest(spark, out)
    return document_rows(read_summaries(spark, out, pointer), read_store(spark, out, "values", DAILY_ROWS_SCHEMA, pointer))


def daily_job(
    spark: SparkSession, logs: DataFrame, geo: GeoTable, out: str, lenient: bool = False, bad_times: Observation | None = None
) -> DataFrame:
    """Compute the daily metrics of ``logs`` and store them by date; gives back the store.

    A request time that doesn't parse fails the job before anything is stored, unless
    ``lenient``; ``bad_times`` counts such rows.
    """
    with job_folder(spark, "daily-job"):
        rows = daily_metrics(prepare(filter_object_requests(logs), lenient=lenient, bad_times=bad_times), geo, written=True)
        # Stored in three shapes, computed once.
        store_days(staged(rows, "daily-rows"), out)
    return read_days(spark, out)


def run_daily_job(
    spark: SparkSession,
    base: str,
    start: str | None,
    end: str | None,
    geo: GeoTable,
    out: str,
    frequency: str | None = None,
    custom: tuple[str, str] | None = None,
    bad_times: Observation | None = None,
) -> DataFrame:
    """The daily job on the log directories of a window.

    Without ``start`` and ``end`` (``yyyy/MM/dd``) the window follows from ``frequency``
    or ``custom``, as in ``window_of``.
    """
    check_zone(spark)
    if start is None or end is None:
        start, end = window_of(frequency, custom=custom)
    return daily_job(spark, scan_access_log(spark, base, start, end, NEEDED_COLUMNS), geo, out, bad_times=bad_times)
