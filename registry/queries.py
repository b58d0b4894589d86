"""One query per operator: (spark, table folder) -> DataFrame."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.functions.text import size_text
from bucketlens.operators import metrics as M
from bucketlens.operators import periods as P
from bucketlens.operators import ranking as K
from bucketlens.operators import selection as Q
from bucketlens.operators.geo import resolve_addresses, with_country
from bucketlens.operators.locations import location_histogram
from bucketlens.operators.prepare import derive_key_components, exclude_meta_files
from bucketlens.plans import daily_job as D
from bucketlens.plans import rankings as N
from bucketlens.plans import rollups as V
from bucketlens.plans import usage_report as U
from bucketlens.session import staged, work_dir
from bucketlens.sinks import compaction as Z
from bucketlens.sinks import extracts as X
from bucketlens.sinks import metrics as W
from bucketlens.sources import catalog as C
from bucketlens.sources import log_text as L
from bucketlens.sources import rejects as J
from bucketlens.sources import results as SR
from bucketlens.streaming import incremental as I
from registry import log_files
from registry.windows import WINDOWS
from registry.tables import (
    WINDOW_END,
    WINDOW_START,
    access_log,
    geo,
    monthly_usage,
    object_requests,
    order_days,
    prepared,
)

Query = Callable[[SparkSession, str], DataFrame]
DAY, FOLDER = "day", "top_level_key"
DAY_FOLDER = [DAY, FOLDER]


def window_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.logs_in_period(access_log(spark, sf_dir), WINDOW_START, WINDOW_END)


def usage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.select_usage_columns(access_log(spark, sf_dir))


def request_text(df: DataFrame) -> DataFrame:
    """Request time as text, for comparing."""
    return df.withColumn("request_ts", F.date_format("request_ts", "yyyy-MM-dd HH:mm:ss"))


def _dates_as_text(df: DataFrame) -> DataFrame:
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


# Scans and sources


def parse_access_log(spark, sf_dir):
    return L.parse_access_log(L.render_access_log(access_log(spark, sf_dir)))


def scan_day_partitions(spark, sf_dir):
    base = log_files.write_log_tree(access_log(spark, sf_dir))
    logs = L.scan_access_log(spark, base, WINDOW_START, WINDOW_END, ["requestid", "bytessent"])
    return logs.groupBy(S.PARTITION_COLUMN).agg(
        F.count("requestid").alias("requests"), F.coalesce(F.sum("bytessent"), F.lit(0)).cast("bigint").alias("bytes")
    )


def spoiled_lines(spark, sf_dir):
    """The log as text, five in forty lines no longer what they should be."""
    number = F.pmod(F.substring("requestid", 2, 20).cast("bigint"), F.lit(40))
    logs = access_log(spark, sf_dir)
    kept = L.render_access_log(logs.withColumn("hostid", F.concat(F.lit("n"), number.cast("string"))))
    which = F.regexp_extract("value", " n([0-9]+) ", 1).cast("int")
    spoiled = (
        F.when(which == 0, " ").when(which == 1, "garbage").when(which == 2, F.translate("value", "[", "("))
        .when(which == 3, F.regexp_replace("value", '"agent[^"]*"', "agent")).when(which == 4, F.regexp_replace("value", '" (200|403) ', '" OK '))
    )
    return kept.withColumn("value", F.coalesce(spoiled, F.col("value")))


def rejected_lines(spark, sf_dir):
    requests, rejected = J.split_lines(spoiled_lines(spark, sf_dir), work_dir(spark, "lines"), ["key", "operation"])
    return J.count_lines(requests, rejected)


def sql_day_filter(spark, sf_dir):
    """A filter on the day in SQL text, on a table whose days were computed from a range."""
    base = log_files.write_log_tree(access_log(spark, sf_dir))
    table, view = f"lines_{uuid.uuid4().hex}", f"logs_{uuid.uuid4().hex}"
    C.register_log_lines(spark, base, table, "2023/12/25", "2024/02/05")
    C.register_access_log(spark, table, view)
    return spark.sql(
        f"""SELECT `timestamp`, count(requestid) AS requests, CAST(coalesce(sum(bytessent), 0) AS BIGINT) AS bytes
        FROM {view} WHERE `timestamp` BETWEEN '{WINDOW_START}' AND '{WINDOW_END}' GROUP BY `timestamp`"""
    )


def compacted_logs(spark, sf_dir):
    base, out = log_files.write_log_tree(access_log(spark, sf_dir)), work_dir(spark, "compacted")
    Z.compact_days(spark, base, WINDOW_START, WINDOW_END, out)
    return Z.read_compacted(spark, out).drop("date")


def read_result_files(spark, sf_dir):
    path, manifest = work_dir(spark, "result"), work_dir(spark, "manifest")
    stored = X.write_query_result(usage_logs(spark, sf_dir), path)
    X.write_manifest(spark, path, manifest)
    return SR.read_files(spark, manifest, stored.schema)


def register_result_table(spark, sf_dir):
    path = work_dir(spark, "result")
    X.write_query_result(usage_logs(spark, sf_dir), path)
    SR.register_result(spark, path, "logs")
    return spark.sql("SELECT * FROM logs")


def _stored_history(spark, sf_dir):
    path = work_dir(spark, "history")
    W.write_period_metrics(monthly_usage(spark, sf_dir), path)
    return SR.load_metrics_history(spark, path)


def load_metrics_history(spark, sf_dir):
    return _dates_as_text(_stored_history(spark, sf_dir))


# Projections and filters


def select_all_logs(spark, sf_dir):
    return Q.logs_in_period(access_log(spark, sf_dir), WINDOW_START, WINDOW_END, select_all=True)


def select_usage_columns(spark, sf_dir):
    return Q.select_usage_columns(access_log(spark, sf_dir))


def filter_object_requests(spark, sf_dir):
    return object_requests(spark, sf_dir).select("requestid", "key")


def filter_day_window(spark, sf_dir):
    return Q.filter_day_window(access_log(spark, sf_dir), WINDOW_START, WINDOW_END).select("requestid", "timestamp")


def exclude_meta(spark, sf_dir):
    return exclude_meta_files(object_requests(spark, sf_dir)).select("requestid", "key")


def classify_requests(spark, sf_dir):
    logs = object_requests(spark, sf_dir).select("requestid", R.method(F.col("operation")).alias("method"))
    return Q.classify_requests(logs)


def filter_folder(spark, sf_dir):
    return request_text(Q.filter_folder(prepared(spark, sf_dir), "TM"))


def report_sections(spark, sf_dir):
    return Q.report_sections(prepared(spark, sf_dir))


def sample_logs(spark, sf_dir):
    return Q.sample_logs(access_log(spark, sf_dir), 500).agg(F.count(F.lit(1)).alias("sampled"))


# Column derivations


def _derived(spark, sf_dir, **columns):
    return object_requests(spark, sf_dir).select("requestid", *(c.alias(n) for n, c in columns.items()))


def derive_request_time(spark, sf_dir):
    return request_text(_derived(spark, sf_dir, request_ts=R.request_time(F.col("requestdatetime"))))


def derive_sizes(spark, sf_dir):
    return _derived(spark, sf_dir, bytessent=R.byte_count(F.col("bytessent")), objectsize=R.byte_count(F.col("objectsize")))


def derive_method(spark, sf_dir):
    return _derived(spark, sf_dir, method=R.method(F.col("operation")))


def derive_top_level_key(spark, sf_dir):
    return _derived(spark, sf_dir, top_level_key=R.top_level_key(F.col("key")))


def derive_referrer_host(spark, sf_dir):
    return _derived(spark, sf_dir, referrer=R.referrer_host(F.col("referrer")))


def derive_country(spark, sf_dir):
    return with_country(object_requests(spark, sf_dir).select("requestid", "remoteip"), geo(spark, sf_dir))


def derive_components(spark, sf_dir):
    return derive_key_components(object_requests(spark, sf_dir).select("requestid", "key")).drop("fileformat")


def derive_file_format(spark, sf_dir):
    return _derived(spark, sf_dir, fileformat=R.file_format(F.col("key")))


def derive_day(spark, sf_dir):
    return _derived(spark, sf_dir, day=F.date_format(R.partition_day(F.col("timestamp")), "yyyy-MM-dd"))


def format_byte_sizes(spark, sf_dir):
    sizes = M.summarize(prepared(spark, sf_dir), DAY_FOLDER).select(*DAY_FOLDER, "download_size", "upload_size")
    return sizes.withColumns({"download_text": size_text(F.col("download_size")), "upload_text": size_text(F.col("upload_size"))})


def prepare_logs(spark, sf_dir):
    return request_text(with_country(prepared(spark, sf_dir), geo(spark, sf_dir)))


# Joins


def geo_range_join(spark, sf_dir):
    """Every user's address, with the ranges of all nations."""
    users = access_log(spark, sf_dir).groupBy("remoteip").agg(F.count(F.lit(1)).alias("requests"))
    return resolve_addresses(users, geo(spark, sf_dir), ["remoteip"], F.col("remoteip"))


def history_join(spark, sf_dir):
    """The month after each month with orders; the newest has no stored metrics."""
    month = F.add_months(F.trunc("reference_date", "month"), 1)
    periods = order_days(spark, sf_dir).select(month.alias("month_start")).distinct()
    periods = periods.withColumn("month_end", F.last_day("month_start"))
    return _dates_as_text(P.with_history(periods, monthly_usage(spark, sf_dir)))


# Aggregations


def _metric(function, by):
    return lambda spark, sf_dir: function(prepared(spark, sf_dir), by)


def overall_summary(spark, sf_dir):
    return M.summarize(prepared(spark, sf_dir))


def folder_summary(spark, sf_dir):
    return M.summarize(prepared(spark, sf_dir), [FOLDER])


def daily_summary(spark, sf_dir):
    return M.summarize(prepared(spark, sf_dir), [DAY]).drop("unique_users_by_download")


def daily_folder_summary(spark, sf_dir):
    return M.summarize(prepared(spark, sf_dir), DAY_FOLDER).drop("unique_users_by_download")


def daily_and_folder_summary(spark, sf_dir):
    return M.summarize_days_and_folders(prepared(spark, sf_dir)).drop("unique_users_by_download")


def daily_location_histogram(spark, sf_dir):
    return location_histogram(prepared(spark, sf_dir), geo(spark, sf_dir), [DAY])


def folder_location_histogram(spark, sf_dir):
    return location_histogram(prepared(spark, sf_dir), geo(spark, sf_dir), DAY_FOLDER)


def daily_downloads_by_file(spark, sf_dir):
    return M.daily_downloads_by_file(prepared(spark, sf_dir))


def daily_metrics_document(spark, sf_dir):
    rows = staged(D.daily_metrics(prepared(spark, sf_dir), geo(spark, sf_dir), written=True), "daily-rows")
    return _dates_as_text(D.document_rows(D.daily_summaries(rows), D.daily_values(rows)))


def request_time_span(spark, sf_dir):
    span = M.request_time_span(prepared(spark, sf_dir))
    return span.select(*(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in span.columns))


# Rankings


def _top(column, k, by_interaction):
    return lambda spark, sf_dir: K.top_values(prepared(spark, sf_dir), column, k, by_interaction)


def _top_locations(by_interaction):
    return lambda spark, sf_dir: K.top_locations(
        prepared(spark, sf_dir), geo(spark, sf_dir), by_interaction=by_interaction
    )


def _components(column, by_interaction=False):
    return lambda spark, sf_dir: K.top_components_by_folder(
        prepared(spark, sf_dir), column, by_interaction=by_interaction
    )


def top_files_by_folder(spark, sf_dir):
    return K.top_values_by_folder(prepared(spark, sf_dir), "key", S.TOP_FILES)


def top_referrers_by_folder(spark, sf_dir):
    return K.top_values_by_folder(prepared(spark, sf_dir), "referrer", S.TOP_OTHERS)


def top_locations_by_folder(spark, sf_dir):
    return K.top_locations_by_folder(prepared(spark, sf_dir), geo(spark, sf_dir))


def interaction_differs(spark, sf_dir):
    return U.interaction_differs(prepared(spark, sf_dir), geo(spark, sf_dir))


# Periods


def period_window(spark, sf_dir):
    days = order_days(spark, sf_dir)
    windows = [P.period_window(days, "reference_date", f) for f in P.FREQUENCIES]
    merged = windows[0]
    for window in windows[1:]:
        merged = merged.unionByName(window)
    return _dates_as_text(merged)


def previous_months(spark, sf_dir):
    months = order_days(spark, sf_dir).select(F.trunc("reference_date", "month").alias("period_start")).distinct()
    return _dates_as_text(P.previous_months(months))


def usage_trend(spark, sf_dir):
    """Trend of every month with orders, from the stored months before it."""
    return _dates_as_text(P.usage_trend(monthly_usage(spark, sf_dir), _stored_history(spark, sf_dir)))


# Sinks


def write_query_result(spark, sf_dir):
    return X.write_query_result(usage_logs(spark, sf_dir), work_dir(spark, "result"))


def export_parquet(spark, sf_dir):
    path = X.export_parquet(window_logs(spark, sf_dir), work_dir(spark, "extracts"), WINDOW_START, WINDOW_END)
    return spark.read.parquet(path)


def export_csv_gz(spark, sf_dir):
    logs = window_logs(spark, sf_dir)
    path = X.export_csv_gz(logs, work_dir(spark, "extracts"), WINDOW_START, WINDOW_END)
    return X.read_csv_gz(spark, path, logs.schema)


def upsert_daily_metrics(spark, sf_dir):
    """First stores every day's counts as 0, then replaces the days of the window."""
    path = work_dir(spark, "daily")
    rows = M.summarize(prepared(spark, sf_dir), DAY_FOLDER).withColumn("date", R.partition_day(F.col("day")))
    rows = staged(rows, "daily-rows").select(*DAY_FOLDER, "downloads_count", "unique_users", "date")
    zero = F.lit(0).cast("bigint")
    W.upsert_daily_metrics(rows.withColumns({"downloads_count": zero, "unique_users": zero}), path)
    W.upsert_daily_metrics(rows.where(F.col(DAY).between(WINDOW_START, WINDOW_END)), path)
    return _dates_as_text(W.read_daily_metrics(spark, path, rows.schema))


def write_period_metrics(spark, sf_dir):
    """The whole service's metrics stored as a document, and what the history reads of it."""
    path = work_dir(spark, "history")
    top = U.top_of_sections(U.section_counts(prepared(spark, sf_dir), geo(spark, sf_dir), written=True))
    W.write_period_metrics(U.overall_document(top, "2024/01/01", "2024/01/31"), path)
    return _dates_as_text(SR.load_metrics_history(spark, path))


def report_rows(spark, sf_dir):
    return U.report_rows(U.top_of_sections(U.section_counts(prepared(spark, sf_dir), geo(spark, sf_dir), written=True)))


def report_rows_with_interactions(spark, sf_dir):
    counts = U.section_counts(prepared(spark, sf_dir), geo(spark, sf_dir), interactions=True, written=True)
    return U.report_rows(staged(U.top_of_sections(counts), "report-sections"), interactions=True)


def summary_sentences(spark, sf_dir):
    return U.summary_sentences(M.summarize(prepared(spark, sf_dir), [FOLDER]), FOLDER)


def yearly_extract(spark, sf_dir):
    """Two overlapping windows merged into the yearly dataset."""
    path = work_dir(spark, "yearly")
    logs = access_log(spark, sf_dir)
    X.merge_yearly_extract(Q.logs_in_period(logs, WINDOW_START, "2024/01/12"), path)
    X.merge_yearly_extract(Q.logs_in_period(logs, "2024/01/10", WINDOW_END), path)
    return _dates_as_text(spark.read.parquet(path))


# Jobs


def incremental_daily_metrics(spark, sf_dir):
    """Two runs: half of the requests' files, then the other half, which touches the same days."""
    logs, base, state = access_log(spark, sf_dir), work_dir(spark, "logs"), work_dir(spark, "incremental")
    number = F.substring("requestid", 2, 20).cast("bigint")
    for half in (0, 1):
        log_files.write_log_tree(logs.where(F.pmod(number, F.lit(2)) == half), base)
        store = I.run_incremental(spark, base, geo(spark, sf_dir), state)
    return _dates_as_text(store)


def settled_daily_metrics(spark, sf_dir):
    """Five runs of a fifth of the requests' files each: levels are merged, then all days closed."""
    logs, base, state = access_log(spark, sf_dir), work_dir(spark, "logs"), work_dir(spark, "incremental")
    lookup = geo(spark, sf_dir)
    for part in range(5):
        log_files.write_log_tree(logs.where(F.pmod(F.xxhash64("requestid"), F.lit(5)) == part), base)
        I.run_incremental(spark, base, lookup, state)
    I.settle_days(spark, lookup, state)
    return _dates_as_text(I.read_metrics(spark, lookup, state))


def _rolled_up(spark, sf_dir):
    """Roll-ups of all days, stored in two runs, and of the months in them."""
    path, requests = work_dir(spark, "rollups"), prepared(spark, sf_dir)
    for part in (requests.where(F.col(DAY) < WINDOW_START), requests.where(F.col(DAY) >= WINDOW_START)):
        V.store_days(spark, part, path)
    V.store_months(spark, path)
    return path


def _of_windows(windows):
    """The rows of every window, with its two ends."""
    named = [rows.select(F.lit(start).alias("window_start"), F.lit(end).alias("window_end"), *rows.columns) for (start, end), rows in windows]
    merged = named[0]
    for rows in named[1:]:
        merged = merged.unionByName(rows)
    return merged


def window_metrics_from_days(spark, sf_dir):
    path = _rolled_up(spark, sf_dir)
    return _of_windows([(w, V.window_metrics(spark, path, *w)) for w in WINDOWS])


def window_metrics_by_folder_from_days(spark, sf_dir):
    path = _rolled_up(spark, sf_dir)
    return _of_windows([(w, V.window_metrics(spark, path, *w, by_folder=True)) for w in WINDOWS])


def window_distinct_estimates(spark, sf_dir):
    """Exact distinct counts of every window, and whether the estimate is within its tolerance."""
    path = _rolled_up(spark, sf_dir)
    judged = []
    for window in WINDOWS:
        exact = V.window_metrics(spark, path, *window, by_folder=True)
        listed = exact.select(FOLDER, F.stack(F.lit(len(V.DISTINCT)), *(x for m in V.DISTINCT for x in (F.lit(m), F.col(m)))).alias("metric", "n"))
        estimates = V.window_estimates(spark, path, *window, by_folder=True)
        found = listed.where("n > 0").join(estimates, [FOLDER, "metric"], "left")
        within = F.coalesce(F.abs(F.col("estimate") - F.col("n")) <= F.col("tolerance"), F.lit(False))
        judged.append((window, found.select(FOLDER, "metric", "n", within.alias("within_tolerance"))))
    return _of_windows(judged)


def _rankings(spark, sf_dir):
    """Rankings of all days, stored in two runs."""
    path, requests = work_dir(spark, "rankings"), prepared(spark, sf_dir)
    for part in (requests.where(F.col(DAY) < WINDOW_START), requests.where(F.col(DAY) >= WINDOW_START)):
        N.store_rankings(spark, part, path)
    return path


def window_top_files_by_folder(spark, sf_dir):
    path = _rankings(spark, sf_dir)
    ranked = [(w, N.window_ranking(spark, path, *w, "key", S.TOP_FILES, by_folder=True).rows) for w in WINDOWS]
    return _of_windows([(w, r.select(F.col("group").alias(FOLDER), F.col("value").alias("key"), F.col("cnt").alias("downloads"), "rank")) for w, r in ranked])


def window_top_referrers(spark, sf_dir):
    path = _rankings(spark, sf_dir)
    ranked = [(w, N.window_ranking(spark, path, *w, "referrer", S.TOP_OTHERS, by_interaction=True).rows) for w in WINDOWS]
    return _of_windows([(w, r.select(F.col("value").alias("referrer"), F.col("cnt").alias("interactions"))) for w, r in ranked])


def usage_report(spark, sf_dir):
    base = log_files.write_log_tree(access_log(spark, sf_dir))
    report = U.usage_report(spark, base, WINDOW_START, WINDOW_END, geo(spark, sf_dir), work_dir(spark, "report"))
    return report["rows"]


def daily_job(spark, sf_dir):
    store = D.daily_job(spark, access_log(spark, sf_dir), geo(spark, sf_dir), work_dir(spark, "daily"))
    return _dates_as_text(store)


def daily_documents(spark, sf_dir):
    """The JSON documents that the daily job stores, read back entry by entry."""
    path = work_dir(spark, "daily")
    D.daily_job(spark, access_log(spark, sf_dir), geo(spark, sf_dir), path)
    return _dates_as_text(W.document_entries(D.read_documents(spark, path)))


QUERIES: dict[str, Query] = {
    "parse_access_log": parse_access_log,
    "scan_day_partitions": scan_day_partitions,
    "rejected_lines": rejected_lines,
    "sql_day_filter": sql_day_filter,
    "compacted_logs": compacted_logs,
    "read_result_files": read_result_files,
    "register_result_table": register_result_table,
    "load_metrics_history": load_metrics_history,
    "select_all_logs": select_all_logs,
    "select_usage_columns": select_usage_columns,
    "filter_object_requests": filter_object_requests,
    "filter_day_window": filter_day_window,
    "exclude_meta_files": exclude_meta,
    "classify_requests": classify_requests,
    "filter_folder": filter_folder,
    "report_sections": report_sections,
    "sample_logs": sample_logs,
    "derive_request_time": derive_request_time,
    "derive_sizes": derive_sizes,
    "derive_method": derive_method,
    "derive_top_level_key": derive_top_level_key,
    "derive_referrer_host": derive_referrer_host,
    "derive_country": derive_country,
    "derive_key_components": derive_components,
    "derive_file_format": derive_file_format,
    "derive_day": derive_day,
    "format_byte_sizes": format_byte_sizes,
    "prepare_logs": prepare_logs,
    "geo_range_join": geo_range_join,
    "history_join": history_join,
    "interactions_count": _metric(M.interactions_count, DAY_FOLDER),
    "downloads_count": _metric(M.downloads_count, DAY_FOLDER),
    "unique_files_downloaded": _metric(M.unique_files_downloaded, DAY_FOLDER),
    "unique_files_uploaded": _metric(M.unique_files_uploaded, DAY_FOLDER),
    "download_bytes": _metric(M.download_bytes, DAY_FOLDER),
    "upload_bytes": _metric(M.upload_bytes, DAY_FOLDER),
    "unique_users": _metric(M.unique_users, DAY_FOLDER),
    "unique_users_by_download": _metric(M.unique_users_by_download, DAY_FOLDER),
    "overall_summary": overall_summary,
    "folder_summary": folder_summary,
    "daily_summary": daily_summary,
    "daily_folder_summary": daily_folder_summary,
    "daily_and_folder_summary": daily_and_folder_summary,
    "location_histogram": daily_location_histogram,
    "location_histogram_by_folder": folder_location_histogram,
    "referrer_histogram": lambda spark, sf_dir: M.value_histogram(prepared(spark, sf_dir), [DAY], "referrer"),
    "referrer_histogram_by_folder": lambda spark, sf_dir: M.value_histogram(prepared(spark, sf_dir), DAY_FOLDER, "referrer"),
    "daily_downloads_by_file": daily_downloads_by_file,
    "daily_metrics_document": daily_metrics_document,
    "request_time_span": request_time_span,
    "top_files_by_download": _top("key", S.TOP_FILES, False),
    "top_locations_by_download": _top_locations(False),
    "top_referrers_by_download": _top("referrer", S.TOP_OTHERS, False),
    "top_files_by_interaction": _top("key", S.TOP_FILES, True),
    "top_locations_by_interaction": _top_locations(True),
    "top_referrers_by_interaction": _top("referrer", S.TOP_OTHERS, True),
    "top_projects_by_folder": _components("project"),
    "top_features_by_folder": _components("feature"),
    "top_formats_by_folder": _components("fileformat"),
    "top_projects_by_interaction": _components("project", True),
    "top_features_by_interaction": _components("feature", True),
    "top_formats_by_interaction": _components("fileformat", True),
    "top_files_by_folder": top_files_by_folder,
    "top_referrers_by_folder": top_referrers_by_folder,
    "top_locations_by_folder": top_locations_by_folder,
    "interaction_differs": interaction_differs,
    "period_window": period_window,
    "logs_in_period": window_logs,
    "previous_months": previous_months,
    "usage_trend": usage_trend,
    "write_query_result": write_query_result,
    "export_parquet": export_parquet,
    "export_csv_gz": export_csv_gz,
    "upsert_daily_metrics": upsert_daily_metrics,
    "write_period_metrics": write_period_metrics,
    "report_rows": report_rows,
    "report_rows_with_interactions": report_rows_with_interactions,
    "summary_sentences": summary_sentences,
    "yearly_extract": yearly_extract,
    "incremental_daily_metrics": incremental_daily_metrics,
    "settled_daily_metrics": settled_daily_metrics,
    "window_metrics_from_days": window_metrics_from_days,
    "window_metrics_by_folder_from_days": window_metrics_by_folder_from_days,
    "window_distinct_estimates": window_distinct_estimates,
    "window_top_files_by_folder": window_top_files_by_folder,
    "window_top_referrers": window_top_referrers,
    "usage_report": usage_report,
    "daily_job": daily_job,
    "daily_documents": daily_documents,
}
