"""Many small log files into few parquet files of even size, day by day.

A day that fills one file or less goes to one task whole. Rows of larger days are dealt
by ranges of day and key, so a file holds neighbouring keys: the key's least and greatest
values in a file's footer rule out most files of a day for a lookup. A key with more rows
than a file should have fills several files.

What a task sorts is the text of one file, or of some small days: lines move and are
sorted as one text each, next to day and key, and become columns as they are written.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.sinks.published import new_run, publish, read_store, write_run_as_is
from bucketlens.sources.log_text import captured_fields, scan_log_lines, split_fields, typed_columns

LOGS = "logs"
TARGET_BYTES = 256 << 20
# Parquet takes about this share of the text.
SHRINKING = 0.25
# Small days share a task up to so many bytes of text.
SHARED_BYTES = 64 << 20


def deal_lines(lines: DataFrame, target: int, shared: int = SHARED_BYTES) -> DataFrame:
    """captured, date, key and the day of each line, a partition for each file of ``target`` bytes or for some small days."""
    day = S.PARTITION_COLUMN
    text = dict(lines.groupBy(day).agg(F.coalesce(F.sum(F.octet_length("value").cast("bigint")), F.lit(0))).collect())
    files = {d: max(1, -(-int(size * SHRINKING) // target)) for d, size in text.items()}
    large = [d for d, n in files.items() if n > 1]
    tasks, filled = [], shared
    for d in sorted(text.keys() - set(large)):
        new = not tasks or filled + text[d] > shared
        tasks.append((d, (tasks[-1][1] if tasks else -1) + new))
        filled = text[d] if new else filled + text[d]

    def keyed(some: DataFrame) -> DataFrame:
        kept = [c for c in some.columns if c != "value"]
        split = some.select(*kept, F.explode(F.array(captured_fields())).alias("captured")).withColumn("_fields", split_fields(F.col("captured")))
        columns = {n: c for (n, _), c in zip(S.ACCESS_LOG_COLUMNS, typed_columns("_fields"))}
        return split.select("captured", R.partition_day(F.col(day)).alias("date"), columns["key"], *kept)

    parts = []
    if large:
        salt = F.xxhash64("captured")
        parts.append(keyed(lines.where(F.col(day).isin(large))).repartitionByRange(sum(files[d] for d in large), "date", "key", salt))
    if tasks or not large:
        numbers = lines.sparkSession.createDataFrame(tasks, f"`{day}` STRING, task INT")
        placed = keyed(lines.join(F.broadcast(numbers), day))
        parts.append(placed.repartitionById(tasks[-1][1] + 1 if tasks else 1, "task").drop("task"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact_days(spark: SparkSession, base: str, start: str, end: str, out: str, target: int = TARGET_BYTES) -> list[str]:
    """Store the requests of a window's days as parquet of about ``target`` bytes a file; gives the days.

    A day stored before is replaced, all days at once.
    """
    dealt = deal_lines(scan_log_lines(spark, base, start, end), target).sortWithinPartitions("date", "key")
    # No generator here: the writer has to see that rows come by date, or it sorts them again.
    fields = dealt.select(split_fields(F.col("captured")).alias("_fields"), S.PARTITION_COLUMN, "date")
    logs = fields.select(*typed_columns("_fields"), S.PARTITION_COLUMN, "date")
    run = new_run()
    days = write_run_as_is(logs, out, LOGS, run)

    def replace(pointer) -> bool:
        pointer.stores.setdefault(LOGS, {}).update({day: {run: None} for day in days})
        return bool(days)

    publish(spark, out, replace)
    return days


def read_compacted(spark: SparkSession, out: str, dates: list[str] | None = None) -> DataFrame:
    """The stored requests, of the given days (``yyyy-MM-dd``) only if there are any given."""
    schema = S.access_log_schema().add("date", "date")
    return read_store(spark, out, LOGS, schema, dates=dates)
