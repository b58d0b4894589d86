"""Levels of the incremental job: cost of runs, merging, closing, late files."""

import pytest
from pyspark.sql import functions as F

from bucketlens.plans import daily_job as D
from bucketlens.session import staged, work_dir
from bucketlens.sinks import published as P
from bucketlens.streaming import incremental as I
from helpers import rows
from registry.log_files import write_log_tree
from registry.tables import access_log

DAYS = ["2024/01/01", "2024/01/02", "2024/01/03"]


@pytest.fixture(scope="module")
def logs(spark, tables):
    few = access_log(spark, tables).where(F.col("timestamp").isin(DAYS))
    return staged(few.withColumn("number", F.substring("requestid", 2, 20).cast("bigint")), "test-logs")


@pytest.fixture(scope="module")
def expected(prepared, geo):
    return rows(D.daily_metrics(prepared.where(F.col("day").isin(DAYS)), geo))


def held(spark, state):
    pointer = P.newest(spark, state)
    return pointer.stores.get(I.LEVELS, {}), pointer.notes.get("days", {})


def test_the_cost_of_a_run_follows_its_new_rows(spark, logs, geo, expected, monkeypatch):
    """Ten runs bring a tenth of every day each: what they write stays level, and no day is put together."""
    base, state = work_dir(spark, "logs"), work_dir(spark, "test-inc")
    written, write = [], I.write_run

    def counting(df, out, store, run):
        dates = write(df, out, store, run)
        n = spark.read.parquet(f"{out}/{store}/run={run}").count()
        written.append((store, run.startswith("batch"), n))
        return dates

    monkeypatch.setattr(I, "write_run", counting)
    per_run = []
    for part in range(10):
        write_log_tree(logs.where(F.pmod(F.xxhash64("requestid"), F.lit(10)) == part).drop("number"), base)
        I.run_incremental(spark, base, geo, state)
        per_run.append([w for w in written])
        written.clear()
    appended = [sum(n for store, batch, n in run if batch) for run in per_run]
    merged = [sum(n for store, batch, n in run if store == I.LEVELS and not batch) for run in per_run]
    assert max(appended) < 4 * min(appended)
    # Every row is merged once in this size class; only closed days are put together.
    assert sum(merged) <= sum(appended) * 2 and sum(n > 0 for n in merged) <= 3
    assert not any(store == I.METRICS for run in per_run for store, *_ in run)
    levels, _ = held(spark, state)
    assert set(levels) == {d.replace("/", "-") for d in DAYS} and max(map(len, levels.values())) < I.FANOUT + 1
    assert rows(I.read_metrics(spark, geo, state)) == expected
    assert rows(I.read_metrics(spark, geo, state, ["2024-01-02"])) == [r for r in expected if str(r[0]) == "2024-01-02"]


def test_days_close_and_open_again(spark, logs, geo, expected):
    base, state = work_dir(spark, "logs"), work_dir(spark, "test-inc")
    first = logs.where("timestamp = '2024/01/01' AND number % 50 <> 0")
    write_log_tree(first.drop("number"), base)
    I.run_incremental(spark, base, geo, state)
    assert held(spark, state)[1]["2024-01-01"]["settled"] is None
    write_log_tree(logs.where("timestamp > '2024/01/01'").drop("number"), base)
    I.run_incremental(spark, base, geo, state)
    # The first day brought nothing and is older than the newest; the second brought rows.
    notes = held(spark, state)[1]
    assert [day for day, n in notes.items() if n["settled"] is not None] == ["2024-01-01"]
    settled = notes["2024-01-01"]["settled"]
    assert settled == notes["2024-01-01"]["added"]
    late = logs.where("timestamp = '2024/01/01' AND number % 50 = 0").drop("number")
    write_log_tree(late, base)
    assert rows(I.run_incremental(spark, base, geo, state)) == expected
    notes = held(spark, state)[1]
    assert notes["2024-01-01"]["settled"] == settled < notes["2024-01-01"]["added"]
    assert notes["2024-01-02"]["settled"] == notes["2024-01-02"]["added"]
    I.settle_days(spark, geo, state)
    notes = held(spark, state)[1]
    assert all(n["settled"] == n["added"] for n in notes.values())
    plan = I.read_metrics(spark, geo, state)
    assert all("/metrics/" in name for name in plan.inputFiles()) and rows(plan) == expected


def test_few_late_rows_wait_and_many_are_stored():
    days = {"2024-01-01": {"added": 105, "settled": 100, "batch": 3}, "2024-01-02": {"added": 111, "settled": 100, "batch": 3},
            "2024-01-03": {"added": 9, "settled": None, "batch": 2}, "2024-01-04": {"added": 9, "settled": None, "batch": 4},
            "2024-01-05": {"added": 9, "settled": None, "batch": 1}}
    pointer = P.Pointer(notes={"days": days})
    assert I.days_to_settle(pointer, 4, 1) == ["2024-01-02", "2024-01-03"]
    assert I.days_to_settle(pointer, 4, 3) == ["2024-01-02"]
    assert I.days_to_settle(P.Pointer(), 0, 1) == []


def test_levels_of_one_size_are_merged():
    mb = 1 << 20
    assert I.levels_to_merge({"a": 10, "b": 20, "c": 30}) == []
    assert I.levels_to_merge({"a": 10, "b": 20, "c": 30, "d": 40, "e": 9 * mb}) == ["a", "b", "c", "d"]
    assert I.levels_to_merge({"a": 2 * mb, "b": 3 * mb, "c": 3 * mb, "d": 2 * mb, "e": 1}) == ["a", "b", "c", "d"]
    assert I.levels_to_merge({}) == []


def test_a_merge_that_another_job_overtook(spark, logs, geo, expected, monkeypatch):
    base, state = work_dir(spark, "logs"), work_dir(spark, "test-inc")
    for part in range(4):
        write_log_tree(logs.where(logs.number % 4 == part).drop("number"), base)
    I.run_incremental(spark, base, geo, state, max_files=10_000)
    monkeypatch.setattr(I, "FANOUT", 1)
    publish, calls = I.publish, []

    def late(*given):
        if not calls:
            calls.append(1)
            I.merge_levels(spark, state)
        return publish(*given)

    monkeypatch.setattr(I, "publish", late)
    I.merge_levels(spark, state)
    assert rows(I.read_metrics(spark, geo, state)) == expected
    P.remove_unpublished(spark, state, keep=1, age=-60)
    assert rows(I.read_metrics(spark, geo, state)) == expected


def test_a_lost_checkpoint_is_refused(spark, logs, geo):
    base, state = write_log_tree(logs.drop("number")), work_dir(spark, "test-inc")
    I.run_incremental(spark, base, geo, state)
    from bucketlens.session import remove

    remove(spark, f"{state}/checkpoint")
    with pytest.raises(ValueError, match="checkpoint"):
        I.run_incremental(spark, base, geo, state)
