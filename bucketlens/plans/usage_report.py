"""The usage report of a window: sections, rankings, sentences, trend, extracts."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.functions.text import grouped_digits, size_text
from bucketlens.operators.geo import GeoTable
from bucketlens.operators.metrics import ADDRESS, KEY, REFERRER, SUMMARY_METRICS, request_time_span
from bucketlens.operators.periods import usage_trend, window_of
from bucketlens.operators.prepare import prepare
from bucketlens.operators.ranking import rank_within, rankings_differ
from bucketlens.operators.selection import logs_in_period
from bucketlens.plans.sections import (
    FOLDER,
    FOLDER_SCOPE,
    WHOLE_SCOPE,
    Value,
    count_for_sections,
    locate_counts,
    sum_sections,
)
from bucketlens.session import check_zone, staged
from bucketlens.sinks.extracts import export_csv_gz, export_parquet
from bucketlens.sinks.metrics import write_period_metrics
from bucketlens.sources.log_text import scan_access_log
from bucketlens.sources.results import load_metrics_history

OVERALL = "overall"
SIZE_METRICS = ["download_size", "upload_size"]


def section_counts(prepared: DataFrame, geo: GeoTable, interactions: bool = False, written: bool = False) -> DataFrame:
    """All metrics and value counts of the report's sections, rankings not yet cut.

    Columns: scope, section, metric, sub_key, n. A ranked value's metric is its
    dimension, with ``_by_interaction`` for counts over interactions. ``written``: see
    ``sum_sections``.
    """
    key, folder = F.col(KEY), F.col(FOLDER)
    located = locate_counts(count_for_sections(prepared, []), geo, [])
    located = located.withColumns(
        {
            "has_section": R.has_section(folder),
            "has_components": R.has_section(folder) & R.has_components(folder),
            "project": R.project(key),
            "feature": R.feature(key),
            "fileformat": R.file_format(key),
        }
    )

    def ranked(dimension: str, value: str, condition: str) -> list[Value]:
        values = [Value(dimension, value, "downloads", condition)]
        if interactions:
            values.append(Value(f"{dimension}_by_interaction", value, "interactions", condition))
        return values

    def dimensions(condition: str) -> dict[str, list[Value]]:
        columns = {KEY: ("file", KEY), ADDRESS: ("location", "country"), REFERRER: ("referrer", REFERRER)}
        return {column: ranked(*dimension, condition) for column, dimension in columns.items()}

    whole, by_folder = dimensions("true"), dimensions("has_section")
    by_folder[KEY] += [v for name in ("project", "feature", "fileformat") for v in ranked(name, name, "has_components")]
    counts = sum_sections(located, [], list(S.REPORT_METRICS), whole, by_folder, written)
    shown = (F.col("scope") != FOLDER_SCOPE) | R.has_section(folder)
    return counts.where(shown).select(
        "scope", F.coalesce(FOLDER, F.lit(OVERALL)).alias("section"), "metric", "sub_key", "n"
    )


def top_of_sections(counts: DataFrame) -> DataFrame:
    """Cut the rankings; metrics without values have one row and pass through."""
    longest = rank_within(counts, ["scope", "section", "metric"], "n", "sub_key", S.TOP_FILES)
    is_file = F.col("metric").isin("file", "file_by_interaction")
    return longest.where(is_file | (F.col("rank") <= S.TOP_OTHERS))


def interaction_differs(prepared: DataFrame, geo: GeoTable) -> DataFrame:
    """Per section and dimension: does the ranking by interaction differ from that by download?"""
    # Read twice, so counted and ranked once, into a small table.
    return _differs(staged(top_of_sections(section_counts(prepared, geo, interactions=True, written=True)), "interaction-rankings"))


def _differs(top: DataFrame) -> DataFrame:
    dimension = F.regexp_replace("metric", "_by_interaction$", "")
    ranked = top.where(F.col("sub_key").isNotNull()).select(
        "scope", "section", dimension.alias("dimension"), F.col("sub_key").alias("value"), F.col("n").alias("cnt"),
        F.col("metric").endswith("_by_interaction").alias("by_interaction"),
    )
    by = ["scope", "section", "dimension"]
    return rankings_differ(ranked.where("NOT by_interaction"), ranked.where("by_interaction"), by)


def report_rows(top: DataFrame, interactions: bool = False) -> DataFrame:
    """The report as rows: scope, section, metric, sub_key, value (text).

    Rankings by interaction are shown on request, and then only where they differ
    from those by download.
    """
    by_interaction = F.col("metric").endswith("_by_interaction") & F.col("sub_key").isNotNull()
    shown = top.where(~by_interaction)
    if interactions:
        differing = _differs(top).where("differs").select(
            "scope", "section", F.concat("dimension", F.lit("_by_interaction")).alias("metric")
        )
        shown = shown.unionByName(top.where(by_interaction).join(differing, ["scope", "section", "metric"], "left_semi"))
    return shown.select("scope", "section", _metric_name(), "sub_key", _value_text())


def section_summaries(top: DataFrame) -> DataFrame:
    """The eight summary metrics as columns, one row per section."""
    metrics = [F.max(F.when(F.col("metric") == m, F.col("n"))).alias(m) for m in SUMMARY_METRICS]
    return top.where(F.col("sub_key").isNull()).groupBy("scope", "section").agg(*metrics)


def overall_document(top: DataFrame, start: str, end: str) -> DataFrame:
    """The whole service's metrics of a window as one row, rankings as maps.

    ``period_start`` and ``period_end`` name the window; one without logs has counts of
    0 and empty rankings.
    """

    def plain(metric: str) -> Column:
        value = F.coalesce(F.max(F.when((F.col("metric") == metric) & F.col("sub_key").isNull(), F.col("n"))), F.lit(0))
        return (size_text(value) if metric in SIZE_METRICS else value).alias(S.REPORT_METRICS[metric])

    def ranking(dimension: str) -> Column:
        ranked = F.collect_list(F.when(F.col("metric") == dimension, F.struct("rank", "sub_key", "n")))
        pairs = F.transform(F.array_sort(ranked), lambda r: F.struct(r["sub_key"], r["n"]))
        return F.map_from_entries(pairs).alias(S.DOWNLOAD_RANKINGS[dimension])

    metrics = [*map(plain, S.REPORT_METRICS), *map(ranking, ("file", "location", "referrer"))]
    period = [F.to_date(F.lit(day), S.DAY_FORMAT).alias(name) for name, day in (("period_start", start), ("period_end", end))]
    return top.where(F.col("scope") == WHOLE_SCOPE).agg(*metrics).select(*period, "*")


def _metric_name() -> Column:
    by_interaction = {f"{d}_by_interaction": name for d, name in S.INTERACTION_RANKINGS.items()}
    names = {**S.REPORT_METRICS, **S.DOWNLOAD_RANKINGS, **by_interaction}
    cases = " ".join(f"WHEN '{metric}' THEN '{name}'" for metric, name in names.items())
    return F.expr(f"CASE metric {cases} END").alias("metric")


def _value_text() -> Column:
    is_size = F.col("metric").isin(SIZE_METRICS)
    return F.when(is_size, size_text(F.col("n"))).otherwise(F.col("n").cast("string")).alias("value")


def summary_sentences(summaries: DataFrame, section: str = "section") -> DataFrame:
    """One sentence per section from its summary metrics."""

    def count(name: str) -> Column:
        return grouped_digits(F.col(name))

    sentence = F.concat(
        F.col(section), F.lit(": "),
        count("unique_users"), F.lit(" users ("), count("unique_users_by_download"), F.lit(" with downloads); "),
        F.lit("downloads: "), size_text(F.col("download_size")), F.lit(" in "), count("downloads_count"),
        F.lit(" requests for "), count("unique_downloads"), F.lit(" files; "),
        F.lit("uploads: "), size_text(F.col("upload_size")), F.lit(" in "), count("uploads_count"), F.lit(" files; "),
        F.lit("all interactions: "), count("interactions_count"), F.lit("."),
    )
    return summaries.select(section, sentence.alias("sentence"))


def usage_report(
    spark: SparkSession,
    base: str,
    start: str | None,
    end: str | None,
    geo: GeoTable,
    results: str,
    select_all: bool = False,
    interactions: bool = False,
    frequency: str | None = None,
    custom: tuple[str, str] | None = None,
    bad_times: Observation | None = None,
) -> dict[str, DataFrame]:
    """Report on the log directories of a window.

    Without ``start`` and ``end`` (``yyyy/MM/dd``) the window follows from ``frequency``
    or ``custom``, as in ``window_of``. A request time that doesn't parse fails the
    report; with ``bad_times`` given, it is NULL and counted there as ``bad_times``.

    Writes the extract (parquet, gzipped CSV) and the window's overall metrics
    under ``results``. Everything after the extract reads the extract, and it is read
    once for all metrics, rankings and sentences.
    """
    check_zone(spark)
    if start is None or end is None:
        start, end = window_of(frequency, custom=custom)
    columns = None if select_all else S.USAGE_COLUMNS
    scanned = scan_access_log(spark, base, start, end, columns)
    extract = logs_in_period(scanned, start, end, select_all)
    path = export_parquet(extract, f"{results}/extracts", start, end)
    logs = spark.read.schema(extract.schema).parquet(path)
    export_csv_gz(logs, f"{results}/extracts", start, end)

    prepared = prepare(logs, bad_times=bad_times)
    # A few rows per section, read by all that follows.
    top = staged(top_of_sections(section_counts(prepared, geo, interactions, written=True)), "report-sections")
    current = overall_document(top, start, end)
    history_path = f"{results}/history"
    write_period_metrics(current, history_path)
    return {
        "rows": report_rows(top, interactions),
        "sentences": summary_sentences(section_summaries(top)),
        "trend": usage_trend(current, load_metrics_history(spark, history_path)),
        "span": request_time_span(prepare(logs, lenient=bad_times is not None)),
    }
