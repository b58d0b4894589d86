import random

import pytest
from pyspark.sql import functions as F

from bucketlens.operators import metrics as M
from bucketlens.operators import ranking as K
from helpers import physical_plan, rows

PREPARED = "method string, top_level_key string, key string, remoteip string, referrer string, bytessent bigint, objectsize bigint, day string"


def random_requests(spark, count=3000, seed=11):
    """Requests with a hot key and a hot address, NULLs, and every method."""
    g = random.Random(seed)
    data = []
    for _ in range(count):
        key = "A/hot" if g.random() < 0.34 else f"{g.choice('AB')}/{g.randrange(40)}"
        ip = "10.0.0.1" if g.random() < 0.34 else (None if g.random() < 0.1 else f"10.0.0.{g.randrange(50)}")
        data.append(
            (
                g.choice(["GET", "HEAD", "PUT", "POST", "DELETE", None, "OTHER"]),
                key.split("/")[0],
                key,
                ip,
                g.choice(["a.org", "b.org", "Direct or N/A"]),
                g.randrange(10**6),
                g.randrange(10**6),
                f"2024/01/0{g.randrange(1, 5)}",
            )
        )
    return spark.createDataFrame(data, PREPARED)


@pytest.mark.parametrize("by", [[], ["day"], ["top_level_key"], ["day", "top_level_key"]])
def test_two_steps_equal_plain_distinct_aggregates(spark, prepared, by):
    for requests in (prepared, random_requests(spark)):
        assert rows(M.summarize(requests, by)) == rows(M.summarize_plain(requests, by).select(*by, *M.SUMMARY_METRICS))


def test_days_and_folders_in_one_pass(spark, prepared):
    for requests in (prepared, random_requests(spark)):
        both = M.summarize_days_and_folders(requests)
        days = both.where("level = 'day'").select("day", *M.SUMMARY_METRICS)
        folders = both.where("level = 'folder'").select("day", "top_level_key", *M.SUMMARY_METRICS)
        assert rows(days) == rows(M.summarize(requests, ["day"]))
        assert rows(folders) == rows(M.summarize(requests, ["day", "top_level_key"]))


def test_folder_metrics_add_up_to_the_day(prepared):
    folders = M.summarize(prepared, ["day", "top_level_key"])
    days = {r.day: r for r in M.summarize(prepared, ["day"]).collect()}
    additive = ["interactions_count", "downloads_count", "download_size", "upload_size", "unique_downloads", "uploads_count"]
    sums = folders.groupBy("day").agg(
        *(F.sum(c).alias(c) for c in additive), F.max("unique_users").alias("most"), F.sum("unique_users").alias("all")
    )
    for r in sums.collect():
        assert [r[c] for c in additive] == [days[r.day][c] for c in additive]
        assert r["most"] <= days[r.day].unique_users <= r["all"]


def test_no_requests(spark):
    none = random_requests(spark).where("false")
    (overall,) = M.summarize(none).collect()
    assert set(overall.asDict().values()) == {0}
    assert M.summarize(none, ["day"]).count() == 0


def test_summary_copies_each_request_twice_only(prepared):
    """One copy per kind of distinct value, and nothing but counts is shuffled on."""
    plan = physical_plan(M.summarize(prepared, ["day"]))
    (expand,) = [line for line in plan.splitlines() if "Expand" in line]
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("FileScan") == 1


def test_single_metrics_agree_with_the_summary(spark):
    requests = random_requests(spark)
    summary = M.summarize(requests, ["day"])
    singles = {
        "interactions_count": M.interactions_count,
        "downloads_count": M.downloads_count,
        "unique_downloads": M.unique_files_downloaded,
        "uploads_count": M.unique_files_uploaded,
        "download_size": M.download_bytes,
        "upload_size": M.upload_bytes,
        "unique_users": M.unique_users,
        "unique_users_by_download": M.unique_users_by_download,
    }
    for name, function in singles.items():
        assert rows(function(requests, ["day"])) == rows(summary.select("day", name)), name


def test_single_metric_reads_only_its_columns(prepared):
    plan = physical_plan(M.unique_users(prepared, ["day"]))
    assert "ReadSchema: struct<remoteip:string,day:string>" in plan


def test_ranking_order_of_equal_counts(spark):
    data = [("GET", "A", k, None, None, 0, 0, "d") for k in ["c", "c", "b", "b", "a", "d"]]
    requests = spark.createDataFrame(data, PREPARED)
    assert [tuple(r) for r in K.top_values(requests, "key", 3).collect()] == [("b", 2), ("c", 2), ("a", 1)]
    by_folder = K.top_values_by_folder(requests, "key", 3)
    assert rows(by_folder.select("rank", "key", "downloads")) == [(1, "b", 2), (2, "c", 2), (3, "a", 1)]


def test_null_values_are_not_ranked(spark):
    requests = random_requests(spark).withColumn("referrer", F.lit(None).cast("string"))
    assert K.top_values(requests, "referrer", 5).count() == 0
    assert M.value_histogram(requests, ["day"], "referrer").count() == 0


def test_folder_ranking_is_cut_before_the_shuffle(prepared):
    plan = physical_plan(K.top_values_by_folder(prepared, "key", 10))
    partial = plan.index("row_number(), 10, Partial")
    assert plan.index("row_number(), 10, Final") < plan.index("Exchange hashpartitioning(top_level_key") < partial


def test_components_only_for_folders_that_have_them(prepared):
    folders = {r.top_level_key for r in K.top_components_by_folder(prepared, "project").collect()}
    assert folders and not folders & {"default", "athena", "FAVICON.ICO", "TEST-OBJECT"}


def test_rankings_differ_by_value_or_count(spark):
    def ranking(data):
        return spark.createDataFrame(data, "section string, value string, cnt bigint")

    downloads = ranking([("same", "a", 2), ("same", "b", 1), ("count", "a", 2), ("value", "a", 2)])
    interactions = ranking([("same", "b", 1), ("same", "a", 2), ("count", "a", 3), ("value", "b", 2), ("only", "a", 1)])
    differs = K.rankings_differ(downloads, interactions, ["section"])
    assert rows(differs) == [("count", True), ("only", True), ("same", False), ("value", True)]
