import json
import os
from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from bucketlens.operators.metrics import SUMMARY_METRICS, summarize
from bucketlens.plans import daily_job as D
from bucketlens.plans import usage_report as U
from bucketlens.session import staged, work_dir
from bucketlens.sinks import extracts as X
from bucketlens.sinks import metrics as W
from bucketlens.sources import results as SR
from bucketlens.sources.log_text import scan_access_log
from bucketlens.streaming import incremental as I
from helpers import physical_plan, rows, values
from registry.log_files import write_log_tree
from registry.tables import access_log


@pytest.fixture(scope="module")
def logs(spark, tables):
    return staged(access_log(spark, tables), "test-logs")


@pytest.fixture(scope="module")
def log_tree(logs):
    return write_log_tree(logs)


@pytest.fixture(scope="module")
def daily_rows(prepared, geo):
    return staged(D.daily_metrics(prepared, geo), "test-daily")


def scalar_rows(df, names):
    return df.select("day", F.stack(F.lit(len(names)), *(x for n in names for x in (F.lit(n), F.col(n)))).alias("metric", "value"))


def test_daily_rows_hold_the_summaries(prepared, daily_rows):
    names = [n for n in SUMMARY_METRICS if n != "unique_users_by_download"]
    expected = scalar_rows(summarize(prepared, ["day"]), names)
    whole = daily_rows.where("scope = 'whole' AND sub_key IS NULL")
    assert rows(whole.select(F.date_format("date", "yyyy/MM/dd"), "metric", "value")) == rows(expected)


def test_daily_metrics_scan_the_requests_once(prepared, geo):
    plan = physical_plan(D.daily_metrics(prepared, geo))
    assert plan.count("FileScan parquet [bytessent") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_documents_hold_every_entry_once(daily_rows):
    summaries, entries = D.daily_summaries(daily_rows), D.daily_values(daily_rows)
    assert rows(D.document_rows(summaries, entries)) == rows(daily_rows)
    assert summaries.count() == summaries.select("date", "scope", "folder").distinct().count()
    keys = ["date", "scope", "folder", "metric", "sub_key"]
    assert entries.count() == entries.select(*keys).distinct().count()
    whole = summaries.where("scope = 'whole'")
    assert whole.count() == daily_rows.select("date").distinct().count()


def merged(documents):
    """The parts of JSON documents put together, by date."""
    out = {}
    for row in documents:
        held = out.setdefault(str(row.date), {"summary": {}, "folders": {}, "meta_downloads": {}})
        for column, given in held.items():
            todo = [(given, json.loads(row[column]))]
            while todo:
                into, found = todo.pop()
                for key, value in found.items():
                    if isinstance(value, dict):
                        todo.append((into.setdefault(key, {}), value))
                    else:
                        assert key not in into
                        into[key] = value
    return out


@pytest.mark.parametrize("entries", [W.DOCUMENT_ENTRIES, 20])
def test_documents_as_json(daily_rows, entries):
    """One row per day, or several small ones, with every entry in one of them."""
    expected = {}
    for r in daily_rows.collect():
        day = expected.setdefault(str(r.date), {"summary": {"locations": {}, "referrers": {}}, "folders": {}, "meta_downloads": {}})
        if r.metric == "meta_downloads":
            into = day["meta_downloads"]
        else:
            section = day["summary"] if r.scope == "whole" else day["folders"].setdefault(r.folder, {"locations": {}, "referrers": {}})
            into = section if r.sub_key is None else section[r.metric]
        into[r.metric if r.sub_key is None else r.sub_key] = r.value
    documents = W.as_json_documents(daily_rows, entries)
    found = documents.collect()
    assert merged(found) == expected
    assert len(found) == len(expected) if entries > 20 else len(found) > 3 * len(expected)
    assert rows(W.document_entries(documents)) == rows(daily_rows)


@pytest.fixture(scope="module")
def spoiled(logs):
    return logs.withColumn("requestdatetime", F.when(F.col("requestid") == "R3", "not a time").otherwise(F.col("requestdatetime")))


def test_a_bad_request_time_fails_the_jobs(spark, spoiled, geo):
    out = work_dir(spark, "test-daily")
    with pytest.raises(Exception, match="no request time"):
        D.daily_job(spark, spoiled, geo, out)
    tree = write_log_tree(spoiled)
    with pytest.raises(Exception, match="no request time"):
        U.usage_report(spark, tree, "2024/01/01", "2024/01/30", geo, work_dir(spark, "test-report"))
    with pytest.raises(Exception, match="no request time"):
        I.run_incremental(spark, tree, geo, work_dir(spark, "test-inc"))


def test_bad_request_times_are_counted(spark, spoiled, geo, daily_rows):
    bad = Observation()
    assert rows(D.daily_job(spark, spoiled, geo, work_dir(spark, "test-daily"), bad_times=bad)) == rows(daily_rows)
    assert bad.get == {"bad_times": 1}
    tree, state, counted = write_log_tree(spoiled), work_dir(spark, "test-inc"), {}
    assert rows(I.run_incremental(spark, tree, geo, state, bad_times=counted)) == rows(daily_rows)
    assert counted == {"bad_times": 1}
    write_log_tree(spoiled.where("requestid = 'R3'"), tree)
    write_log_tree(spoiled.where("requestid = 'R4'"), tree)
    for expected in (1, 0):
        I.run_incremental(spark, tree, geo, state, max_files=1, bad_times=counted)
        assert counted == {"bad_times": expected}
    assert rows(I.run_incremental(spark, tree, geo, work_dir(spark, "test-inc"), lenient=True).limit(1)) != []


def test_jobs_by_frequency(spark, log_tree, geo, daily_rows):
    out = work_dir(spark, "test-daily")
    stored = D.run_daily_job(spark, log_tree, None, None, geo, out, custom=("2024-01-05", "2024-01-06"))
    assert rows(stored) == rows(daily_rows.where("date IN ('2024-01-05', '2024-01-06')"))
    assert D.run_daily_job(spark, log_tree, None, None, geo, work_dir(spark, "test-daily"), frequency="daily").count() == 0


def test_interaction_differs_counts_once(prepared, geo):
    plan = physical_plan(U.interaction_differs(prepared, geo))
    assert "Expand" not in plan and "remoteip" not in plan


def test_csv_keeps_values(spark, tmp_path):
    values_ = [" a ", "", None, 'q"uote', "a,b", "line\nbreak", "\\", "  ", "\ttab"]
    given = spark.createDataFrame([(v, n) for n, v in enumerate(values_)], "a string, b bigint")
    path = X.export_csv_gz(given.coalesce(1), str(tmp_path), "2024/01/01", "2024/01/02")
    single = given.where("a IS NULL OR a NOT LIKE '%\n%'")
    assert rows(X.read_csv_gz(spark, path, given.schema).where("b <> 5")) == rows(single)


def test_upsert_replaces_its_dates_and_no_others(spark):
    path = work_dir(spark, "test-upsert")
    kinds = "date date, value bigint"
    one, two, three = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    W.upsert_daily_metrics(spark.createDataFrame([(one, 1), (two, 1), (two, 2)], kinds), path)
    update = spark.createDataFrame([(two, 9), (three, 9)], kinds)
    for _ in range(2):
        W.upsert_daily_metrics(update, path)
        assert rows(W.read_daily_metrics(spark, path, update.schema)) == [(one, 1), (two, 9), (three, 9)]


def test_daily_job_run_twice(spark, logs, geo, daily_rows):
    out = work_dir(spark, "test-daily")
    for _ in range(2):
        assert rows(D.daily_job(spark, logs, geo, out)) == rows(daily_rows)


def test_daily_job_on_a_window_of_log_files(spark, log_tree, geo, daily_rows):
    out = work_dir(spark, "test-daily")
    stored = D.run_daily_job(spark, log_tree, "2024/01/05", "2024/01/06", geo, out)
    assert rows(stored) == rows(daily_rows.where("date IN ('2024-01-05', '2024-01-06')"))


def test_incremental_equals_batch(spark, log_tree, geo, daily_rows):
    assert rows(I.run_incremental(spark, log_tree, geo, work_dir(spark, "test-inc"), max_files=13)) == rows(daily_rows)


def test_late_files_and_second_runs(spark, logs, geo, daily_rows, tmp_path):
    """Half of every day's requests arrive after the first run."""
    base, state = str(tmp_path / "logs"), work_dir(spark, "test-inc")
    long_ago = 1_000_000_000
    number = F.substring("requestid", 2, 20).cast("bigint")
    for half in (0, 1):
        tree = write_log_tree(logs.where(number % 2 == half))
        for source in spark.read.text(f"{tree}/*/*/*").inputFiles():
            source = source.removeprefix("file:").replace("///", "/")
            day, name = source.split("/")[-4:-1], source.split("/")[-1]
            target = tmp_path.joinpath("logs", *day)
            target.mkdir(parents=True, exist_ok=True)
            (target / f"{half}-{name}").write_text(open(source).read())
            if half and day[-1] != "05":
                os.utime(target / f"{half}-{name}", (long_ago, long_ago))
        stored = I.run_incremental(spark, base, geo, state)
    assert rows(stored) == rows(daily_rows)
    assert rows(I.run_incremental(spark, base, geo, state)) == rows(daily_rows)


def test_batch_that_runs_again(spark, logs, geo, daily_rows, log_tree):
    state = work_dir(spark, "test-inc")
    lines = spark.read.text(f"{log_tree}/*/*/*").select("value", F.regexp_extract("_metadata.file_path", I.DAY_IN_PATH, 1).alias("timestamp"))
    for _ in range(2):
        I.store_batch(lines, 0, state)
    assert rows(I.read_metrics(spark, geo, state)) == rows(daily_rows)
    I.settle_days(spark, geo, state)
    I.store_batch(lines, 0, state)
    assert rows(I.read_metrics(spark, geo, state)) == rows(daily_rows)


def test_usage_report(spark, log_tree, geo, prepared):
    results = work_dir(spark, "test-report")
    report = U.usage_report(spark, log_tree, "2024/01/01", "2024/01/30", geo, results)
    expected = U.report_rows(U.top_of_sections(U.section_counts(prepared, geo)))
    assert rows(report["rows"]) == rows(expected)
    sections = set(values(report["sentences"], "section"))
    assert sections == {"overall", "ISO3", "TM", "default", "FAVICON.ICO"}
    trend = report["trend"].orderBy("age").collect()
    (overall,) = summarize(prepared).collect()
    assert [r.total_files_downloads_count for r in trend] == [overall.downloads_count, None, None, None, None, None]
    extract = spark.read.parquet(X.extract_path(f"{results}/extracts", "2024/01/01", "2024/01/30", "parquet"))
    csv = X.read_csv_gz(spark, X.extract_path(f"{results}/extracts", "2024/01/01", "2024/01/30", "csv.gz"), extract.schema)
    assert rows(csv) == rows(extract) and extract.count() == 950


def test_usage_report_of_all_columns(spark, log_tree, geo, prepared):
    results = work_dir(spark, "test-report")
    report = U.usage_report(spark, log_tree, "2024/01/01", "2024/01/30", geo, results, select_all=True)
    assert rows(report["rows"]) == rows(U.report_rows(U.top_of_sections(U.section_counts(prepared, geo))))
    extract = spark.read.parquet(X.extract_path(f"{results}/extracts", "2024/01/01", "2024/01/30", "parquet"))
    assert len(extract.columns) == 27


def test_period_document(spark, prepared, geo):
    path = work_dir(spark, "test-history")
    top = staged(U.top_of_sections(U.section_counts(prepared, geo)), "test-top")
    for _ in range(2):
        W.write_period_metrics(U.overall_document(top, "2024/01/01", "2024/01/31"), path)
    (text,) = values(spark.read.text(f"{path}/*/*"), "value")
    document = json.loads(text)
    (overall,) = summarize(prepared).collect()
    assert document["total_overall_interactions_count"] == overall.interactions_count
    assert document["total_dataset_downloaded_size"].endswith("B")
    ranked = top.where("scope = 'whole' AND metric = 'file'").orderBy("rank")
    assert list(document["popular_files_by_download"].items()) == [(r.sub_key, r.n) for r in ranked.collect()]


def test_usage_report_of_a_window_without_logs(spark, log_tree, geo):
    report = U.usage_report(spark, log_tree, "2030/01/01", "2030/01/31", geo, work_dir(spark, "test-report"))
    assert set(values(report["rows"], "section")) <= {"overall"}
    assert rows(report["span"]) == [(None, None)]
    assert [(r.age, r.total_files_downloads_count) for r in report["trend"].orderBy("age").collect()] == [
        (0, 0), *((age, None) for age in range(1, 6))
    ]


def test_trend_uses_stored_periods(spark, log_tree, geo):
    results = work_dir(spark, "test-report")
    kinds = "period_start date, period_end date, total_files_downloads_count bigint, unique_users_overall bigint"
    W.write_period_metrics(spark.createDataFrame([(date(2023, 12, 1), date(2023, 12, 31), 77, 7)], kinds), f"{results}/history")
    trend = U.usage_report(spark, log_tree, "2024/01/01", "2024/01/30", geo, results)["trend"]
    assert [r.unique_users_overall for r in trend.where("age = 1").collect()] == [7]


def test_report_shows_interactions_only_where_they_differ(prepared, geo):
    top = staged(U.top_of_sections(U.section_counts(prepared, geo, interactions=True)), "test-top")
    plain, more = U.report_rows(top), U.report_rows(top, interactions=True)
    added = more.exceptAll(plain)
    differing = {(r.section, r.dimension) for r in U._differs(top).where("differs").collect()}
    from bucketlens.schema import INTERACTION_RANKINGS as names

    shown = {(r.section, r.metric) for r in added.select("section", "metric").distinct().collect()}
    assert shown == {(section, names[dimension]) for section, dimension in differing}


def test_result_folder_must_be_new(spark):
    path = work_dir(spark, "test-result")
    X.write_query_result(spark.range(3), path)
    with pytest.raises(Exception):
        X.write_query_result(spark.range(3), path)


def test_manifest_and_view(spark):
    path, manifest = work_dir(spark, "test-result"), work_dir(spark, "test-manifest")
    X.write_query_result(spark.range(0, 100, 1, 3), path)
    X.write_manifest(spark, path, manifest)
    assert rows(SR.read_files(spark, manifest)) == [(i,) for i in sorted(range(100), key=lambda i: repr((i,)))]
    SR.register_result(spark, path, "test_result")
    assert spark.sql("SELECT count(*) FROM test_result").first()[0] == 100


def test_no_history_yet(spark):
    assert SR.load_metrics_history(spark, work_dir(spark, "test-nothing")).count() == 0


def test_yearly_extract_merges_windows(spark):
    path = work_dir(spark, "test-yearly")

    def logs(*pairs):
        return spark.createDataFrame(list(pairs), "requestid string, timestamp string")

    X.merge_yearly_extract(logs(("a", "2023/12/31"), ("b", "2024/01/01")), path)
    X.merge_yearly_extract(logs(("c", "2024/01/01"), ("d", "2024/01/02")), path)
    stored = spark.read.parquet(path)
    assert rows(stored.select("requestid", "year")) == [("a", 2023), ("c", 2024), ("d", 2024)]


def test_scan_and_prepare_read_seven_of_26_fields(spark, log_tree):
    logs = scan_access_log(spark, log_tree, "2024/01/05", "2024/01/06", D.NEEDED_COLUMNS)
    assert set(logs.columns) == {*D.NEEDED_COLUMNS, "timestamp"}
