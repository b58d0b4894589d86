"""Rankings of windows from stored rankings of days against the requests themselves."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bucketlens.operators.geo import geo_table
from bucketlens.operators.ranking import top_locations, top_values, top_values_by_folder
from bucketlens.plans import rankings as U
from bucketlens.session import staged, work_dir
from helpers import rows

WINDOWS = [("2023-12-25", "2024-01-20"), ("2024-01-03", "2024-01-03"), ("2030-01-01", "2030-02-01")]


@pytest.fixture(scope="module")
def requests(spark):
    """Files asked for with a steep fall, many of them equally often; folders short and long."""
    draw = random.Random(5)
    given = []
    for n in range(12_000):
        day = date(2023, 12, 28) + timedelta(days=draw.randrange(12))
        folder = draw.choice(["a", "a", "a", "b", "", None])
        number = int(draw.paretovariate(0.7)) if folder == "a" else draw.randrange(6)
        key = None if n % 97 == 0 else f"{folder}/{number % 4_000}"
        given.append(
            (day.strftime("%Y/%m/%d"), folder, key, f"10.0.{draw.randrange(3)}.{draw.randrange(90)}", f"h{draw.randrange(30)}" if n % 5 else None,
             draw.choice(["GET", "GET", "PUT", "HEAD", None]), 1, 1)
        )
    kinds = "day string, top_level_key string, key string, remoteip string, referrer string, method string, bytessent bigint, objectsize bigint"
    return staged(spark.createDataFrame(given, kinds), "test-requests")


@pytest.fixture(scope="module")
def geo(spark):
    return geo_table(networks=spark.createDataFrame([("10.0.0.0/24", "AA"), ("10.0.1.0/25", "BB")], "network string, iso_code string"))


@pytest.fixture(scope="module", params=[1, 8])
def out(spark, requests, geo, request):
    """Stored in two runs, the second of which replaces a day; heads of a few sizes."""
    out = work_dir(spark, "test-rankings")
    U.store_rankings(spark, requests.where("day <= '2024/01/03' AND method = 'GET'"), out, geo, head=request.param)
    U.store_rankings(spark, requests, out, geo, head=request.param)
    return out


def work_folder(spark):
    return Path(work_dir(spark, "any").removeprefix("file:")).parent


def of_window(requests, window):
    return requests.where(F.col("day").between(*(d.replace("-", "/") for d in window)))


@pytest.mark.parametrize("window", WINDOWS)
@pytest.mark.parametrize("k", [1, 10])
def test_rankings_equal_the_requests(spark, requests, out, window, k):
    inside = of_window(requests, window)
    found = U.window_ranking(spark, out, *window, "key", k, by_folder=True).rows
    expected = top_values_by_folder(inside, "key", k).select("top_level_key", "key", "downloads", "rank")
    assert rows(found.select("group", "value", "cnt", "rank")) == rows(expected)
    found = U.window_ranking(spark, out, *window, "referrer", k, by_interaction=True).rows
    assert rows(found.select("value", "cnt")) == rows(top_values(inside, "referrer", k, True).select("referrer", "interactions"))


def test_rankings_of_countries(spark, requests, out, geo):
    found = U.window_ranking(spark, out, *WINDOWS[0], "country", 5).rows
    assert rows(found.select("value", "cnt")) == rows(top_locations(of_window(requests, WINDOWS[0]), geo, 5).select("country", "downloads"))


def test_few_entries_are_read(spark, requests):
    """Beside the heads a ranking reads a small part of what a window's lists hold."""
    out = work_dir(spark, "test-rankings")
    U.store_rankings(spark, requests, out, head=10)
    (read,) = U.window_ranking(spark, out, *WINDOWS[0], "key", 3, by_folder=True).read.where("group = 'a'").collect()
    assert read.stored > 400 and read.heads == 120
    assert read.opened + read.looked_up < read.stored / 5


def test_depth_reaches_the_scan(spark, requests, monkeypatch):
    """The depth is a filter on the stored bands, so parts of files below it are skipped."""
    out, plans, stage = work_dir(spark, "test-rankings"), {}, U.staged

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    U.store_rankings(spark, requests, out, head=10)
    monkeypatch.setattr(U, "staged", noted)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2_000)
    try:
        U.window_ranking(spark, out, *WINDOWS[0], "key", 3)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(band," in plans["ranking-found"] and "LessThanOrEqual(band," in plans["ranking-looked-up"]
    assert "CartesianProduct" not in "".join(plans.values())


def test_no_requests(spark, requests):
    out = work_dir(spark, "test-rankings")
    U.store_rankings(spark, requests.where("false"), out)
    ranking = U.window_ranking(spark, out, *WINDOWS[0], "key", 3)
    assert rows(ranking.rows) == [] and rows(ranking.read) == []
    with pytest.raises(ValueError, match="after its end"):
        U.window_ranking(spark, out, "2024-01-02", "2024-01-01", "key", 3)


def test_jobs_remove_what_they_staged(spark, requests, geo, tmp_path, monkeypatch):
    """Also if they fail after staging."""
    folders = {f.name for f in work_folder(spark).iterdir()}
    out = str(tmp_path / "out")
    U.store_rankings(spark, requests, out, geo)
    monkeypatch.setattr(U, "write_run_as_is", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        U.store_rankings(spark, requests, out, geo)
    assert {f.name for f in work_folder(spark).iterdir()} == folders
    assert staged(requests.limit(1), "test-after").count() == 1
    assert {f.name.split("-")[1] for f in work_folder(spark).iterdir() if f.name not in folders} == {"after"}
