"""Daily metrics kept up to date from newly arrived log files.

Distinct counts of separate batches do not add up, but counts per distinct value do.
They are kept as levels. Every batch writes its own counts per day and value as a new
level of the days it touches, and publishes it (see ``published``): that is all its cost,
however large those days are. Levels of a day are merged by size: once ``FANOUT`` of
about the same size are there, they become one, so a row is rewritten once per order of
magnitude and a day has few levels.

A day's metrics are made of all its levels. For open days that happens when they are
read. A day closes by rule: the first run that brings it nothing and knows a day
``open_days`` later stores its metrics. A late file, however old, is a level like any
other. It opens its day again until new rows make up ``SETTLE_SHARE`` of what the
stored metrics hold, so storing costs a bounded multiple of the new rows.
"""

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.operators.geo import GeoTable
from bucketlens.operators.metrics import MEASURES, set_columns
from bucketlens.operators.prepare import prepare
from bucketlens.operators.selection import filter_object_requests
from bucketlens.plans.daily_job import DAILY_ROWS_SCHEMA, NEEDED_COLUMNS, count_days, daily_metrics_from_counts
from bucketlens.plans.sections import grouping_sets
from bucketlens.session import check_zone
from bucketlens.sinks.published import Pointer, folder_sizes, new_run, newest, publish, read_store, write_run
from bucketlens.sources.log_text import DAY_IN_PATH, parse_access_log

# Days are directories base/yyyy/MM/dd.
ALL_DAYS = "[0-9][0-9][0-9][0-9]/[0-1][0-9]/[0-3][0-9]"
# The file source passes over files this much older than the newest one it has seen.
NEVER_TOO_OLD = "36500d"

LEVELS, METRICS = "levels", "metrics"
# So many levels of one size class are merged; each class is so many times larger than the one before.
FANOUT = 4
SMALLEST_CLASS = 1 << 20
SETTLE_SHARE = 0.1
OPEN_DAYS = 1


def stream_log_lines(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """New lines of the day directories, with the day read off the path."""
    reader = spark.readStream.option("maxFileAge", NEVER_TOO_OLD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(f"{base.rstrip('/')}/{ALL_DAYS}")
    day = F.regexp_extract("_metadata.file_path", DAY_IN_PATH, 1)
    return lines.select("value", day.alias(S.PARTITION_COLUMN))


def _grouping_columns() -> list[str]:
    return [*set_columns(grouping_sets(["day"])), "grouping"]


def _counts_schema() -> T.StructType:
    """What a level stores: the grouping columns, their marker, the measures, the date."""
    texts = [T.StructField(c, T.StringType()) for c in _grouping_columns()[:-1]]
    numbers = [T.StructField(c, T.LongType()) for c in ["grouping", *MEASURES]]
    return T.StructType([*texts, *numbers, T.StructField("date", T.DateType())])


def store_batch(lines: DataFrame, batch_id: int, state: str, lenient: bool = False, count_bad_times: bool = False) -> None:
    """Add the counts of one batch as a level of the days it touches.

    A batch that runs again after a failure replaces what it wrote, and does nothing if
    that was published already.
    """
    spark = lines.sparkSession
    if newest(spark, state).notes.get("batch", -1) >= batch_id:
        return
    bad = Observation() if count_bad_times else None
    logs = filter_object_requests(parse_access_log(lines, NEEDED_COLUMNS))
    counted = count_days(prepare(logs, lenient=lenient, bad_times=bad))
    run = f"batch-{batch_id:09d}"
    write_run(counted.withColumn("date", R.partition_day(F.col("day"))), state, LEVELS, run)
    sizes = folder_sizes(spark, state, f"{LEVELS}/run={run}")
    found = bad.get["bad_times"] if bad else 0

    def add(pointer: Pointer) -> bool:
        notes = pointer.notes
        if notes.get("batch", -1) >= batch_id:
            return False
        for day, size in sizes.items():
            pointer.stores.setdefault(LEVELS, {}).setdefault(day, {})[run] = size
            note = notes.setdefault("days", {}).setdefault(day, {"added": 0, "settled": None})
            note.update(added=note["added"] + size, batch=batch_id)
        notes.update(batch=batch_id, bad_times=notes.get("bad_times", 0) + found)
        return True

    publish(spark, state, add)


def _size_class(size: int) -> int:
    level = 0
    while size >= SMALLEST_CLASS * FANOUT**level:
        level += 1
    return level


def levels_to_merge(levels: dict[str, int]) -> list[str]:
    """The levels of a day that become one: those of the smallest size class that is full."""
    classes: dict[int, list[str]] = {}
    for run, size in levels.items():
        classes.setdefault(_size_class(size), []).append(run)
    full = [runs for _, runs in sorted(classes.items()) if len(runs) >= FANOUT]
    return sorted(full[0]) if full else []


def _summed(levels: DataFrame) -> DataFrame:
    return levels.groupBy("date", *_grouping_columns()).agg(*(F.sum(m).alias(m) for m in MEASURES))


def merge_levels(spark: SparkSession, state: str) -> dict[str, list[str]]:
    """Merge levels of like size, of all days at once; gives the merged levels by date."""
    pointer = newest(spark, state)
    chosen = {day: runs for day, levels in pointer.stores.get(LEVELS, {}).items() if (runs := levels_to_merge(levels))}
    if not chosen:
        return {}
    part = Pointer(stores={LEVELS: {day: dict.fromkeys(runs) for day, runs in chosen.items()}})
    run = new_run()
    write_run(_summed(read_store(spark, state, LEVELS, _counts_schema(), part)), state, LEVELS, run)
    sizes = folder_sizes(spark, state, f"{LEVELS}/run={run}")

    def swap(pointer: Pointer) -> bool:
        held = pointer.stores[LEVELS]
        if not all(r in held.get(day, {}) for day, runs in chosen.items() for r in runs):
            return False
        for day, runs in chosen.items():
            for r in runs:
                del held[day][r]
            held[day][run] = sizes[day]
        return True

    publish(spark, state, swap)
    return chosen


def _metrics_of(spark: SparkSession, geo: GeoTable, state: str, pointer: Pointer, days: list[str], written: bool) -> DataFrame:
    levels = read_store(spark, state, LEVELS, _counts_schema(), pointer, days)
    if any(len(pointer.stores[LEVELS][day]) > 1 for day in days):
        levels = _summed(levels)
    return daily_metrics_from_counts(levels.drop("date"), geo, written)


def days_to_settle(pointer: Pointer, first_batch: int, open_days: int) -> list[str]:
    """Closed days whose metrics are not stored, or lack too much: see above."""
    days = pointer.notes.get("days", {})
    last = max(days, default=None)
    due = []
    for day, note in days.items():
        old = (date.fromisoformat(last) - date.fromisoformat(day)).days >= open_days
        settled = note["settled"]
        pending = note["added"] - (settled or 0)
        if old and note["batch"] < first_batch and (settled is None or pending > 0 and pending >= SETTLE_SHARE * settled):
            due.append(day)
    return sorted(due)


def settle_days(spark: SparkSession, geo: GeoTable, state: str, days: list[str] | None = None) -> None:
    """Store the metrics of ``days``, or of all days that are open or opened again."""
    pointer = newest(spark, state)
    notes = pointer.notes.get("days", {})
    if days is None:
        days = sorted(day for day, note in notes.items() if note["settled"] != note["added"])
    if not days:
        return
    run = new_run()
    found = write_run(_metrics_of(spark, geo, state, pointer, days, written=True), state, METRICS, run)

    def settle(newer: Pointer) -> None:
        store = newer.stores.setdefault(METRICS, {})
        for day in days:
            store.pop(day, None)
            newer.notes["days"][day]["settled"] = notes[day]["added"]
        store.update({day: {run: None} for day in found})

    publish(spark, state, settle)


def read_metrics(spark: SparkSession, geo: GeoTable, state: str, dates: list[str] | None = None) -> DataFrame:
    """The daily metrics as of the newest pointer: stored ones of settled days, the others from their levels."""
    pointer = newest(spark, state)
    days = {day: n for day, n in pointer.notes.get("days", {}).items() if dates is None or day in dates}
    settled = [day for day, note in days.items() if note["settled"] == note["added"]]
    stored = read_store(spark, state, METRICS, DAILY_ROWS_SCHEMA, pointer, settled)
    others = sorted(set(days) - set(settled))
    if not others:
        return stored
    made = _metrics_of(spark, geo, state, pointer, others, written=False)
    return stored.unionByName(made) if settled else made


def run_incremental(
    spark: SparkSession,
    base: str,
    geo: GeoTable,
    state: str,
    max_files: int | None = None,
    lenient: bool = False,
    bad_times: dict[str, int] | None = None,
    open_days: int = OPEN_DAYS,
) -> DataFrame:
    """Process the files not seen before and stop; gives back the daily metrics.

    ``state`` holds the stream's checkpoint, the levels and the stored metrics. A request
    time that doesn't parse fails the run, unless ``lenient``; a dictionary given as
    ``bad_times`` means ``lenient`` and receives the number of such rows of this run.
    """
    check_zone(spark)
    before = newest(spark, state).notes
    first_batch = before.get("batch", -1) + 1
    if first_batch and not checkpoint_exists(spark, state):
        raise ValueError(f"the checkpoint of the stream that made {state} is gone: all files would count twice")
    store = partial(store_batch, state=state, lenient=lenient or bad_times is not None, count_bad_times=bad_times is not None)
    query = (
        stream_log_lines(spark, base, max_files)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    merge_levels(spark, state)
    pointer = newest(spark, state)
    settle_days(spark, geo, state, days_to_settle(pointer, first_batch, open_days))
    if bad_times is not None:
        bad_times["bad_times"] = pointer.notes.get("bad_times", 0) - before.get("bad_times", 0)
    return read_metrics(spark, geo, state)


def checkpoint_exists(spark: SparkSession, state: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/checkpoint/metadata")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
