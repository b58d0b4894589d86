"""Daily stores that change together: written first, then published by one pointer.

A run writes its rows into folders of its own, which nobody reads yet. Then one small
file, the pointer, names for every store and date the runs that hold it. Pointers are
numbered and never changed. A reader takes the newest, so it sees all of a run or
nothing of it, across all stores. A job that dies before its pointer leaves folders
that no pointer names; running it again is safe.

Two jobs at once: the pointer's number is taken by a rename that does not overwrite.
Whoever comes second reads the newer pointer and sets its own dates on top of that.
Storage has to refuse such a rename where the name is taken, as HDFS does.
"""

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bucketlens.session import remove
from bucketlens.sinks.extracts import replace_partitions

POINTERS = "_published"
DAY = 24 * 3600


@dataclass
class Pointer:
    """What is published. ``stores``: store, date, then the runs that hold it with their number of rows (NULL: not counted).

    ``notes`` is for the job that publishes: small facts that change with its rows.
    """

    number: int = -1
    stores: dict[str, dict[str, dict[str, int | None]]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def dates(self, store: str) -> list[str]:
        return sorted(self.stores.get(store, {}))

    def runs(self) -> set[tuple[str, str]]:
        return {(store, run) for store, dates in self.stores.items() for runs in dates.values() for run in runs}


class _Storage:
    """The few calls on the shared storage that Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession, out: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.base = out.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, name: str) -> dict[str, int]:
        """What a folder holds, with the time of change in seconds."""
        if not self.fs.exists(self.path(name)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in self.fs.listStatus(self.path(name))}

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Put a file in place whole; False if there is one of that name."""
        draft = self.path(f"{POINTERS}/.draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        none = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            files.rename(draft, self.path(name), none)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
        else:
            return True
        self.fs.delete(draft, False)
        return False


def folder_sizes(spark: SparkSession, out: str, folder: str) -> dict[str, int]:
    """Bytes of every ``date`` in a run's folder."""
    storage = _Storage(spark, out)
    dated = [n for n in storage.names(folder) if n.startswith("date=")]
    return {n.removeprefix("date="): storage.fs.getContentSummary(storage.path(f"{folder}/{n}")).getLength() for n in dated}


def _name(number: int) -> str:
    return f"{POINTERS}/{number:012d}.json"


def _numbers(storage: _Storage) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in storage.names(POINTERS) if n.endswith(".json") and not n.startswith("."))


def _load(storage: _Storage, number: int) -> Pointer:
    return Pointer(number, **json.loads(storage.read(_name(number))))


def newest(spark: SparkSession, out: str) -> Pointer:
    """The pointer in force; an empty one where nothing is published."""
    storage = _Storage(spark, out)
    numbers = _numbers(storage)
    return _load(storage, numbers[-1]) if numbers else Pointer()


def publish(spark: SparkSession, out: str, change: Callable[[Pointer], bool | None]) -> Pointer:
    """Put the next pointer in force: ``change`` is given the newest and alters it.

    It is called again, on the newer pointer, if another job was faster. If it returns
    False, nothing is published.
    """
    storage = _Storage(spark, out)
    while True:
        pointer = newest(spark, out)
        if change(pointer) is False:
            return pointer
        pointer.number += 1
        text = json.dumps({"stores": pointer.stores, "notes": pointer.notes}, sort_keys=True)
        if storage.write_new(_name(pointer.number), text):
            return pointer


def new_run() -> str:
    return uuid.uuid4().hex


def write_run(rows: DataFrame, out: str, store: str, run: str) -> list[str]:
    """Write a run's rows of a store by ``date``, unseen as yet; gives their dates.

    A run that is written again replaces what it wrote before.
    """
    spark = rows.sparkSession
    path = f"{out.rstrip('/')}/{store}/run={run}"
    remove(spark, path)
    replace_partitions(rows, path, ["date"])
    return sorted(n.removeprefix("date=") for n in _Storage(spark, out).names(f"{store}/run={run}") if n.startswith("date="))


def write_run_as_is(rows: DataFrame, out: str, store: str, run: str) -> list[str]:
    """``write_run`` for rows that are dealt and sorted as their files should be."""
    spark = rows.sparkSession
    path = f"{out.rstrip('/')}/{store}/run={run}"
    rows.write.mode("overwrite").partitionBy("date").parquet(path)
    return sorted(n.removeprefix("date=") for n in _Storage(spark, out).names(f"{store}/run={run}") if n.startswith("date="))


def replace_days(spark: SparkSession, out: str, stores: dict[str, DataFrame], dates: Iterable[str] = ()) -> Pointer:
    """Insert or replace days in all ``stores`` in one step.

    A date found in any of the frames (or listed in ``dates``) is replaced in all of
    them: a store whose frame lacks the date holds nothing of it afterwards.
    """
    run = new_run()
    written = {store: write_run(rows, out, store, run) for store, rows in stores.items()}
    replaced = {date for found in written.values() for date in found} | set(dates)

    def change(pointer: Pointer) -> bool:
        for store, found in written.items():
            days = pointer.stores.setdefault(store, {})
            for date in replaced:
                days.pop(date, None)
            days.update({date: {run: None} for date in found})
        return bool(replaced)

    return publish(spark, out, change)


def read_store(
    spark: SparkSession, out: str, store: str, schema: T.StructType, pointer: Pointer | None = None, dates: Iterable[str] | None = None
) -> DataFrame:
    """The published rows of a store, of the given dates only if there are any given.

    Just the folders of those days are listed and read. ``schema`` includes ``date``.
    """
    pointer = pointer or newest(spark, out)
    held = pointer.stores.get(store, {})
    chosen = held if dates is None else [d for d in dates if d in held]
    base = f"{out.rstrip('/')}/{store}"
    paths = [f"{base}/run={run}/date={date}" for date in sorted(chosen) for run in sorted(held[date])]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def remove_unpublished(spark: SparkSession, out: str, keep: int = 2, age: int = 7 * DAY) -> list[str]:
    """Remove old pointers but the last ``keep``, and runs that none of those names; gives the removed folders.

    A run that no pointer has named yet may be a job at work: it goes only when it is
    older than ``age`` seconds. Readers of a pointer that goes must have ended.
    """
    storage = _Storage(spark, out)
    numbers = _numbers(storage)
    kept = numbers[len(numbers) - keep :] if keep < len(numbers) else numbers
    named = set().union(*(_load(storage, n).runs() for n in kept)) if kept else set()
    gone = [n for n in numbers if n not in kept]
    once_named = set().union(*(_load(storage, n).runs() for n in gone)) if gone else set()
    # Pointers first: a reader finds none whose rows are missing.
    for number in gone:
        remove(spark, f"{storage.base}/{_name(number)}")
    removed = []
    for store in sorted(n for n in storage.names("") if not n.startswith((".", "_"))):
        for folder, changed in storage.names(store).items():
            run = folder.removeprefix("run=")
            if folder.startswith("run=") and (store, run) not in named:
                if (store, run) in once_named or changed < time.time() - age:
                    remove(spark, f"{storage.base}/{store}/{folder}")
                    removed.append(f"{store}/{folder}")
    return removed
