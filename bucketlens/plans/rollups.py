"""Daily roll-ups that add up to any window: sums, exact distinct counts, estimates.

Sums of days give the sum of a window, distinct counts don't. So every file and
address gets a number, for good (the dictionary), and a day stores, per folder and
distinct count, which numbers it saw: bitmaps of 32,768 numbers each. A window's
distinct count is the number of bits of its days' bitmaps put together, exactly; over
folders it is the same. Sketches of the same values, a few KB per day and folder, give
estimates where those do.

Months are put together from their days once. A window reads the whole months inside
it, as far as they are up to date, and single days for the rest; never the logs.
"""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens.functions import requests as R
from bucketlens.operators.metrics import ADDRESS, KEY, MEASURES, count_values, in_set, set_columns
from bucketlens.plans.sections import FOLDER
from bucketlens.session import job_folder, staged
from bucketlens.sinks.published import Pointer, new_run, newest, publish, read_store, write_run

SUMS = ["interactions_count", "downloads_count", "download_size", "upload_size"]
_SUM_OF = {"interactions_count": "interactions", "downloads_count": "downloads", "download_size": "download_bytes", "upload_size": "upload_bytes"}
# Distinct counts: the kind of value, and when a value of a day counts.
DISTINCT = {
    "unique_downloads": (KEY, "downloads > 0"),
    "uploads_count": (KEY, "uploads > 0"),
    "unique_users": (ADDRESS, "true"),
    "unique_users_by_download": (ADDRESS, "downloads > 0"),
}
# Registers of a sketch as a power of two, and the standard error that goes with them.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
# New values are numbered in blocks of about this many.
NUMBERED = 1 << 20

DAY_SUMS, DAY_BITS, DAY_SKETCHES = "day-sums", "day-bitmaps", "day-sketches"
MONTH_SUMS, MONTH_BITS, MONTH_SKETCHES = "month-sums", "month-bitmaps", "month-sketches"
MONTHLY = {DAY_SUMS: MONTH_SUMS, DAY_BITS: MONTH_BITS, DAY_SKETCHES: MONTH_SKETCHES}
NUMBERS = "numbers"


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


SCHEMAS = {
    DAY_SUMS: _fields(**{FOLDER: T.StringType()}, **dict.fromkeys(SUMS, T.LongType()), date=T.DateType()),
    DAY_BITS: _fields(**{FOLDER: T.StringType()}, metric=T.StringType(), bucket=T.LongType(), bitmap=T.BinaryType(), date=T.DateType()),
    DAY_SKETCHES: _fields(**{FOLDER: T.StringType()}, metric=T.StringType(), sketch=T.BinaryType(), date=T.DateType()),
    NUMBERS: _fields(kind=T.StringType(), value=T.StringType(), number=T.LongType(), date=T.DateType()),
}
SCHEMAS |= {month: SCHEMAS[day] for day, month in MONTHLY.items()}


def count_days(prepared: DataFrame) -> DataFrame:
    """Measures per day, folder and file or address: ``kind`` names which, ``value`` has it."""
    sets = [["day", FOLDER, KEY], ["day", FOLDER, ADDRESS]]
    counted, columns = count_values(prepared, sets), set_columns(sets)
    is_key = in_set(columns, sets[0])
    return counted.select(
        R.partition_day(F.col("day")).alias("date"), FOLDER, F.when(is_key, KEY).otherwise(ADDRESS).alias("kind"),
        F.when(is_key, F.col(KEY)).otherwise(F.col(ADDRESS)).alias("value"), *MEASURES,
    )


def _number_new(values: DataFrame, known: DataFrame, following: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """kind, value, number of the values not yet numbered, and the next free numbers.

    Values are dealt into blocks by their hash and numbered inside their block, so no
    task sees them all. One row per block comes to the driver.
    """
    new = staged(values.join(known.select("kind", "value"), ["kind", "value"], "left_anti"), "new-values")
    sizes = {r.kind: r.n for r in new.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = 1 + max(sizes.values(), default=0) // NUMBERED
    dealt = new.withColumn("block", F.pmod(F.xxhash64("value"), F.lit(blocks)))
    counted = sorted(dealt.groupBy("kind", "block").agg(F.count(F.lit(1)).alias("n")).collect())
    following, first = dict(following), []
    for kind, block, n in counted:
        first.append((kind, block, following.get(kind, 1)))
        following[kind] = following.get(kind, 1) + n
    firsts = values.sparkSession.createDataFrame(first, "kind STRING, block BIGINT, first BIGINT")
    rank = F.row_number().over(Window.partitionBy("kind", "block").orderBy("value"))
    numbered = dealt.withColumn("rank", rank).join(F.broadcast(firsts), ["kind", "block"])
    return numbered.select("kind", "value", (F.col("first") + F.col("rank") - 1).alias("number")), following


def _conditions() -> Column:
    """The distinct counts that a row of counts bears on."""
    named = [F.when((F.col("kind") == kind) & F.expr(when), F.lit(m)) for m, (kind, when) in DISTINCT.items()]
    return F.explode(F.filter(F.array(*named), lambda m: m.isNotNull()))


def store_days(spark: SparkSession, prepared: DataFrame, out: str) -> None:
    """Roll up the days of ``prepared``, replacing stored ones, and number what is new to the dictionary.

    All stores change in one step. Two runs at a time can't both number values: the
    later one fails and may be run again.
    """
    with job_folder(spark, "rollups"):
        _store_days(spark, prepared, out)


def _store_days(spark: SparkSession, prepared: DataFrame, out: str) -> None:
    pointer = newest(spark, out)
    counts = staged(count_days(prepared), "rollup-counts")
    known = read_store(spark, out, NUMBERS, SCHEMAS[NUMBERS], pointer)
    values = counts.where("value IS NOT NULL").select("kind", "value").distinct()
    free = pointer.notes.get("next", {})
    new, following = _number_new(values, known, free)
    run = new_run()
    first_day = counts.agg(F.min("date")).first()[0]
    if first_day is None:
        return
    found = {NUMBERS: write_run(new.withColumn("date", F.lit(first_day)), out, NUMBERS, run)}
    own = Pointer(stores={NUMBERS: {d: {run: None} for d in found[NUMBERS]}})
    added = read_store(spark, out, NUMBERS, SCHEMAS[NUMBERS], own)
    numbers = known.unionByName(added).select("kind", "value", "number")

    total = [F.coalesce(F.sum(F.when(F.col("kind") == KEY, F.col(_SUM_OF[m]))), F.lit(0)).cast("bigint").alias(m) for m in SUMS]
    sums = counts.groupBy("date", FOLDER).agg(*total)
    seen = counts.where("value IS NOT NULL").select("date", FOLDER, "kind", "value", _conditions().alias("metric"))
    number = F.col("number")
    bits = seen.join(numbers, ["kind", "value"]).groupBy("date", FOLDER, "metric", F.bitmap_bucket_number(number).alias("bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
    sketches = seen.groupBy("date", FOLDER, "metric").agg(F.hll_sketch_agg("value", F.lit(SKETCH_BITS)).alias("sketch"))
    for store, rows in ((DAY_SUMS, sums), (DAY_BITS, bits), (DAY_SKETCHES, sketches)):
        found[store] = write_run(rows, out, store, run)

    def replace(newer: Pointer) -> None:
        if newer.notes.get("next", {}) != free:
            raise RuntimeError("another run has numbered values in the meantime; run again")
        newer.notes["next"] = following
        for d in found[NUMBERS]:
            newer.stores.setdefault(NUMBERS, {}).setdefault(d, {})[run] = None
        for store in MONTHLY:
            held = newer.stores.setdefault(store, {})
            for d in found[DAY_SUMS]:
                held.pop(d, None)
            held.update({d: {run: None} for d in found[store]})

    publish(spark, out, replace)


def _month(day: str) -> str:
    return f"{day[:7]}-01"


def _days_of_month(pointer: Pointer, month: str) -> dict[str, list[str]]:
    return {d: sorted(runs) for d, runs in pointer.stores.get(DAY_SUMS, {}).items() if _month(d) == month}


def _combine(store: str, rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a store put together per ``by``."""
    if store in (DAY_SUMS, MONTH_SUMS):
        return rows.groupBy(*by).agg(*(F.sum(m).alias(m) for m in SUMS))
    if store in (DAY_BITS, MONTH_BITS):
        return rows.groupBy(*by, "metric", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return rows.groupBy(*by, "metric").agg(F.hll_union_agg("sketch").alias("sketch"))


def store_months(spark: SparkSession, out: str, months: list[str] | None = None) -> list[str]:
    """Put months together from their stored days; gives those it made.

    Without ``months`` (first days, ``yyyy-MM-dd``) all that are missing or whose days
    have changed since.
    """
    pointer = newest(spark, out)
    if months is None:
        stored = sorted({_month(d) for d in pointer.dates(DAY_SUMS)})
        months = [m for m in stored if pointer.notes.get("months", {}).get(m) != _days_of_month(pointer, m)]
    if not months:
        return []
    days = [d for d in pointer.dates(DAY_SUMS) if _month(d) in months]
    run, found = new_run(), {}
    for store, monthly in MONTHLY.items():
        rows = read_store(spark, out, store, SCHEMAS[store], pointer, days).withColumn("date", F.trunc("date", "month"))
        found[monthly] = write_run(_combine(store, rows, ["date", FOLDER]), out, monthly, run)

    def replace(newer: Pointer) -> None:
        made_of = newer.notes.setdefault("months", {})
        for store, dates in found.items():
            held = newer.stores.setdefault(store, {})
            for m in months:
                held.pop(m, None)
            held.update({m: {run: None} for m in dates})
        # If a day was replaced meanwhile, the month is told to be out of date by this.
        made_of.update({m: _days_of_month(pointer, m) for m in months})

    publish(spark, out, replace)
    return months


def cover(pointer: Pointer, start: str, end: str) -> tuple[list[str], list[str]]:
    """The fewest stored months and days that make up a window (``yyyy-MM-dd``, both ends count).

    A month is used if the window holds all of it and it is up to date.
    """
    if start > end:
        raise ValueError(f"window starts after its end: {start} > {end}")
    months = []
    for month in pointer.dates(MONTH_SUMS):
        first = date.fromisoformat(month)
        last = (first + timedelta(days=31)).replace(day=1) - timedelta(days=1)
        fresh = pointer.notes.get("months", {}).get(month) == _days_of_month(pointer, month)
        if start <= month and last.isoformat() <= end and fresh:
            months.append(month)
    days = [d for d in pointer.dates(DAY_SUMS) if start <= d <= end and _month(d) not in months]
    return months, days


def read_window(spark: SparkSession, out: str, store: str, start: str, end: str, pointer: Pointer | None = None) -> DataFrame:
    """A daily store's rows of a window, whole months already put together."""
    pointer = pointer or newest(spark, out)
    months, days = cover(pointer, start, end)
    by_month = read_store(spark, out, MONTHLY[store], SCHEMAS[store], pointer, months)
    by_day = read_store(spark, out, store, SCHEMAS[store], pointer, days)
    return by_month.unionByName(by_day) if months and days else by_month if months else by_day


def window_metrics(spark: SparkSession, out: str, start: str, end: str, by_folder: bool = False) -> DataFrame:
    """The eight summary metrics of a window, overall (one row) or per folder, from the roll-ups."""
    pointer, by = newest(spark, out), [FOLDER] if by_folder else []
    sums = _combine(DAY_SUMS, read_window(spark, out, DAY_SUMS, start, end, pointer), by)
    bits = _combine(DAY_BITS, read_window(spark, out, DAY_BITS, start, end, pointer), by)
    n = F.bitmap_count("bitmap")
    counts = [F.coalesce(F.sum(F.when(F.col("metric") == m, n)), F.lit(0)).cast("bigint").alias(m) for m in DISTINCT]
    distinct = bits.groupBy(*by).agg(*counts)
    both = sums.unionByName(distinct, allowMissingColumns=True).groupBy(*by)
    return both.agg(*(F.coalesce(F.max(m), F.lit(0)).cast("bigint").alias(m) for m in [*SUMS, *DISTINCT]))


def window_estimates(spark: SparkSession, out: str, start: str, end: str, by_folder: bool = False) -> DataFrame:
    """Estimated distinct counts of a window from the sketches: metric, estimate, tolerance.

    ``tolerance`` is three standard errors of the estimate, rounded up.
    """
    by = [FOLDER] if by_folder else []
    sketches = _combine(DAY_SKETCHES, read_window(spark, out, DAY_SKETCHES, start, end), by)
    estimate = F.hll_sketch_estimate("sketch")
    return sketches.select(*by, "metric", estimate.alias("estimate"), F.ceil(3 * SKETCH_ERROR * estimate).alias("tolerance"))

