"""Daily stores that change together: crashes between writes, two jobs at once, old runs."""

from datetime import date

import pytest

from bucketlens.plans import daily_job as D
from bucketlens.session import staged, work_dir
from bucketlens.sinks import published as P
from helpers import rows

KINDS = "date date, value bigint"
ONE, TWO, THREE = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def frame(spark, *given):
    return spark.createDataFrame(list(given), KINDS)


def stored(spark, out, store, **chosen):
    return rows(P.read_store(spark, out, store, frame(spark).schema, **chosen))


@pytest.fixture
def out(spark):
    """Two stores that hold two days."""
    out = work_dir(spark, "test-published")
    P.replace_days(spark, out, {"a": frame(spark, (ONE, 1), (TWO, 1)), "b": frame(spark, (ONE, 10), (TWO, 10), (TWO, 11))})
    return out


def test_days_are_replaced_in_all_stores(spark, out):
    P.replace_days(spark, out, {"a": frame(spark, (TWO, 2), (THREE, 2)), "b": frame(spark, (THREE, 20))})
    assert stored(spark, out, "a") == [(ONE, 1), (TWO, 2), (THREE, 2)]
    # The newer run has no row of the second day in the other store: nothing of the old one is left.
    assert stored(spark, out, "b") == [(ONE, 10), (THREE, 20)]
    P.replace_days(spark, out, {"a": frame(spark), "b": frame(spark)}, dates=["2024-01-03"])
    assert stored(spark, out, "a") == [(ONE, 1), (TWO, 2)] and stored(spark, out, "b") == [(ONE, 10)]


def test_only_the_asked_days_are_read(spark, out):
    read = P.read_store(spark, out, "a", frame(spark).schema, dates=["2024-01-02", "2024-05-05"])
    assert rows(read) == [(TWO, 1)]
    assert all("date=2024-01-02" in name for name in read.inputFiles())
    assert stored(spark, out, "nothing") == [] and stored(spark, work_dir(spark, "test-nothing"), "a") == []


@pytest.mark.parametrize("dies_in", ["first write", "second write", "pointer"])
def test_a_job_that_dies_changes_nothing(spark, out, monkeypatch, dies_in):
    before = stored(spark, out, "a"), stored(spark, out, "b")
    write, calls = P.write_run, []

    def dying(rows_, path, store, run):
        calls.append(store)
        if dies_in == "first write" or dies_in == "second write" and len(calls) == 2:
            raise RuntimeError("killed")
        return write(rows_, path, store, run)

    def killed(*_):
        raise RuntimeError("killed")

    update = {"a": frame(spark, (TWO, 5)), "b": frame(spark, (TWO, 50))}
    monkeypatch.setattr(P, "write_run", dying)
    if dies_in == "pointer":
        monkeypatch.setattr(P._Storage, "write_new", killed)
    with pytest.raises(RuntimeError):
        P.replace_days(spark, out, update)
    assert (stored(spark, out, "a"), stored(spark, out, "b")) == before
    monkeypatch.undo()
    P.replace_days(spark, out, update)
    assert stored(spark, out, "a") == [(ONE, 1), (TWO, 5)] and stored(spark, out, "b") == [(ONE, 10), (TWO, 50)]


def test_a_task_that_fails_changes_nothing(spark, out):
    failing = frame(spark, (TWO, 5)).selectExpr("date", "CAST(raise_error('killed') AS BIGINT) AS value")
    with pytest.raises(Exception, match="killed"):
        P.replace_days(spark, out, {"a": frame(spark, (TWO, 5)), "b": failing})
    assert stored(spark, out, "a") == [(ONE, 1), (TWO, 1)] and len(stored(spark, out, "b")) == 3


def test_two_jobs_at_once(spark, out, monkeypatch):
    """Both start from the same pointer; the slower one keeps what the faster one did."""
    write_new, nested = P._Storage.write_new, []

    def late(self, name, text):
        if not nested:
            nested.append(name)
            P.replace_days(spark, out, {"a": frame(spark, (THREE, 3)), "b": frame(spark, (THREE, 30))})
        return write_new(self, name, text)

    monkeypatch.setattr(P._Storage, "write_new", late)
    pointer = P.replace_days(spark, out, {"a": frame(spark, (ONE, 9)), "b": frame(spark, (ONE, 90))})
    assert pointer.number == 2 and nested == [P._name(1)]
    assert stored(spark, out, "a") == [(ONE, 9), (TWO, 1), (THREE, 3)]
    assert P.publish(spark, out, lambda p: False).number == 2


def test_a_reader_keeps_its_pointer(spark, out):
    pointer = P.newest(spark, out)
    P.replace_days(spark, out, {"a": frame(spark, (TWO, 5)), "b": frame(spark, (TWO, 50))})
    assert stored(spark, out, "a", pointer=pointer) == [(ONE, 1), (TWO, 1)]


def test_old_runs_are_removed(spark, out):
    for value in (5, 6):
        P.replace_days(spark, out, {"a": frame(spark, (TWO, value)), "b": frame(spark, (TWO, value))})
    P.write_run(frame(spark, (THREE, 1)), out, "a", "at-work")
    P.replace_days(spark, out, {"a": frame(spark, (ONE, 7)), "b": frame(spark, (ONE, 7))})
    before = stored(spark, out, "a"), stored(spark, out, "b")
    assert len(P.remove_unpublished(spark, out, keep=1)) == 4
    assert (stored(spark, out, "a"), stored(spark, out, "b")) == before == ([(ONE, 7), (TWO, 6)], [(ONE, 7), (TWO, 6)])
    assert P.remove_unpublished(spark, out, keep=1, age=-60) == ["a/run=at-work"]
    assert P.remove_unpublished(spark, out, keep=5, age=-60) == []


def test_a_killed_daily_job_leaves_the_old_day_whole(spark, prepared, geo, monkeypatch):
    """The stores of the daily job change together."""
    out = work_dir(spark, "test-daily")
    daily = staged(D.daily_metrics(prepared, geo), "test-daily")
    D.store_days(daily, out)
    before = rows(D.read_days(spark, out)), rows(D.read_documents(spark, out))
    doubled = staged(daily.selectExpr("date", "scope", "folder", "metric", "sub_key", "value * 2 AS value"), "test-daily")
    write = P.write_run

    def dying(rows_, path, store, run):
        if store == "documents":
            raise RuntimeError("killed")
        return write(rows_, path, store, run)

    monkeypatch.setattr(P, "write_run", dying)
    with pytest.raises(RuntimeError):
        D.store_days(doubled, out)
    assert (rows(D.read_days(spark, out)), rows(D.read_documents(spark, out))) == before
    monkeypatch.undo()
    D.store_days(doubled, out)
    assert rows(D.read_days(spark, out)) == rows(doubled)
