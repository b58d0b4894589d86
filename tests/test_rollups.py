"""Windows from roll-ups of days and months against the requests themselves."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from bucketlens.operators.metrics import summarize
from bucketlens.plans import rollups as U
from bucketlens.session import staged, work_dir
from bucketlens.sinks import published as P
from helpers import physical_plan, rows

NAMES = [*U.SUMS, *U.DISTINCT]
WINDOWS = [("2023-11-20", "2024-03-09"), ("2023-12-01", "2024-02-29"), ("2024-01-05", "2024-01-05"), ("2024-02-01", "2024-02-10"), ("2030-01-01", "2030-02-01")]


@pytest.fixture(scope="module")
def requests(spark):
    """Requests of four months: hot and missing values, folders that come and go."""
    draw = random.Random(2)
    given = []
    for n in range(3_000):
        day = date(2023, 11, 25) + timedelta(days=draw.randrange(100))
        folder = draw.choice(["a", "b", "", "c" if day.month == 1 else "a"])
        key = None if n % 97 == 0 else f"{folder}/{draw.randrange(400) if n % 3 else 0}"
        given.append(
            (day.strftime("%Y/%m/%d"), folder, key, None if n % 89 == 0 else f"10.0.{draw.randrange(3)}.{draw.randrange(90)}",
             draw.choice(["GET", "PUT", "POST", "HEAD", "DELETE", None]), draw.randrange(1_000), draw.randrange(1_000))
        )
    kinds = "day string, top_level_key string, key string, remoteip string, method string, bytessent bigint, objectsize bigint"
    return staged(spark.createDataFrame(given, kinds), "test-requests")


@pytest.fixture(scope="module")
def out(spark, requests):
    """Stored in three runs; the last replaces days of the first."""
    out = work_dir(spark, "test-rollups")
    U.store_days(spark, requests.where("day < '2024/01/10' AND bytessent % 2 = 0"), out)
    U.store_days(spark, requests.where("day >= '2024/01/10'"), out)
    U.store_months(spark, out)
    U.store_days(spark, requests.where("day < '2024/01/10'"), out)
    return out


def of_window(requests, window):
    return requests.where(F.col("day").between(*(d.replace("-", "/") for d in window)))


@pytest.mark.parametrize("window", WINDOWS)
@pytest.mark.parametrize("months", [False, True])
def test_windows_equal_the_requests(spark, requests, out, window, months):
    if months:
        U.store_months(spark, out)
    expected = summarize(of_window(requests, window))
    assert rows(U.window_metrics(spark, out, *window).select(*NAMES)) == rows(expected.select(*NAMES))
    by_folder = summarize(of_window(requests, window), ["top_level_key"]).select("top_level_key", *NAMES)
    assert rows(U.window_metrics(spark, out, *window, by_folder=True)) == rows(by_folder)


def test_a_quarter_reads_three_months(spark, out):
    U.store_months(spark, out)
    assert U.store_months(spark, out) == []
    pointer = P.newest(spark, out)
    assert U.cover(pointer, "2023-12-01", "2024-02-29") == (["2023-12-01", "2024-01-01", "2024-02-01"], [])
    files = U.read_window(spark, out, U.DAY_SUMS, "2023-12-01", "2024-02-29").inputFiles()
    assert len({f.split("date=")[1].split("/")[0] for f in files}) == 3 and all("month-sums" in f for f in files)
    months, days = U.cover(pointer, "2023-12-02", "2024-02-29")
    assert months == ["2024-01-01", "2024-02-01"] and all("2023-12-02" <= d <= "2023-12-31" for d in days)
    with pytest.raises(ValueError):
        U.cover(pointer, "2024-02-01", "2024-01-01")


def test_a_changed_day_puts_its_month_out_of_date(spark, requests, out):
    U.store_months(spark, out)
    U.store_days(spark, requests.where("day = '2024/01/20'"), out)
    assert U.cover(P.newest(spark, out), "2024-01-01", "2024-01-31")[0] == []
    assert U.store_months(spark, out) == ["2024-01-01"]


def test_numbers_are_stable_and_dense(spark, requests, out):
    numbers = P.read_store(spark, out, U.NUMBERS, U.SCHEMAS[U.NUMBERS]).collect()
    for kind, column in (("key", "key"), ("remoteip", "remoteip")):
        own = [r for r in numbers if r.kind == kind]
        assert {r.value for r in own} == {r[0] for r in requests.select(column).distinct().collect()} - {None}
        assert sorted(r.number for r in own) == list(range(1, len(own) + 1))
    U.store_days(spark, requests.where("day = '2024/01/21'"), out)
    assert rows(P.read_store(spark, out, U.NUMBERS, U.SCHEMAS[U.NUMBERS])) == sorted(map(tuple, numbers), key=repr)


def test_many_blocks_of_new_values(spark, requests, monkeypatch):
    monkeypatch.setattr(U, "NUMBERED", 10)
    out = work_dir(spark, "test-rollups")
    U.store_days(spark, requests, out)
    expected = summarize(requests).select(*NAMES)
    assert rows(U.window_metrics(spark, out, "2020-01-01", "2030-01-01").select(*NAMES)) == rows(expected)


def test_another_run_that_numbers_values(spark, requests, monkeypatch):
    out, write, nested = work_dir(spark, "test-rollups"), U.write_run, []

    def late(*given):
        if not nested:
            nested.append(1)
            U.store_days(spark, requests.where("day = '2024/01/21'"), out)
        return write(*given)

    monkeypatch.setattr(U, "write_run", late)
    with pytest.raises(RuntimeError, match="run again"):
        U.store_days(spark, requests.where("day = '2024/01/22'"), out)


def test_estimates_are_within_their_tolerance(spark, requests, out):
    for window in WINDOWS[:4]:
        (exact,) = U.window_metrics(spark, out, *window).collect()
        for r in U.window_estimates(spark, out, *window).collect():
            assert abs(r.estimate - exact[r.metric]) <= r.tolerance


def test_error_of_sketches_that_are_full(spark):
    many = spark.range(0, 1_000_000, 1, 8).withColumn("part", F.col("id") % 50)
    made = many.groupBy("part").agg(F.hll_sketch_agg(F.col("id").cast("string"), F.lit(U.SKETCH_BITS)).alias("sketch"))
    (estimate,) = made.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).first()
    assert abs(estimate - 1_000_000) <= 3 * U.SKETCH_ERROR * 1_000_000


def test_nothing_stored(spark, requests):
    out = work_dir(spark, "test-rollups")
    U.store_days(spark, requests.where("false"), out)
    assert [tuple(r) for r in U.window_metrics(spark, out, "2024-01-01", "2024-01-02").collect()] == [(0,) * 8]
    assert U.window_estimates(spark, out, "2024-01-01", "2024-01-02").collect() == [] and U.store_months(spark, out) == []


def test_windows_read_no_logs_and_join_nothing_large(spark, out):
    plan = physical_plan(U.window_metrics(spark, out, "2023-11-20", "2024-03-09"))
    assert "Expand" not in plan and "SortMergeJoin" not in plan
