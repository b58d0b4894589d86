"""First k values of any window from the rankings of its days.

A day stores, per folder, how often each file, referrer (and country, given a geo
table) was asked for. A list is what one day and folder hold of one kind. Short lists
and the first entries of long ones are the heads; the other store has long lists
whole, the largest counts first.

A window's ranking opens long lists only as deep as they can matter, in three steps
of the uniform threshold method. Sums over the heads bound the k-th total from below;
a value with that total or more reaches the bound divided by the number of long lists
in one of them at least, so entries below that make no new candidate. What the
candidates may have below it decides which of them are left, and only these are
looked up there. Totals are exact, ties included.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens.functions import requests as R
from bucketlens.operators.geo import GeoTable
from bucketlens.operators.locations import count_by_country
from bucketlens.operators.metrics import KEY, REFERRER, in_set, request_measures, set_columns
from bucketlens.operators.ranking import rank_within
from bucketlens.plans.sections import FOLDER
from bucketlens.session import job_folder, staged
from bucketlens.sinks.published import Pointer, new_run, newest, publish, read_store, write_run, write_run_as_is

HEADS, ENTRIES = "ranking-heads", "ranking-entries"
# A list of at most this many entries is short: its head is all of it.
HEAD = 100
COUNTRY = "country"
BY = ["downloads", "interactions"]
_LIST = ["date", FOLDER, "kind", "by"]


def _schema(**more: T.DataType) -> T.StructType:
    text, number = T.StringType(), T.LongType()
    kinds = {FOLDER: text, "kind": text, "by": text, "value": text, "cnt": number, **more, "date": T.DateType()}
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


SCHEMAS = {HEADS: _schema(entries=T.LongType(), rank=T.IntegerType(), long=T.BooleanType()), ENTRIES: _schema(band=T.IntegerType())}


class Ranking(NamedTuple):
    """``rows``: the group, ``value``, ``cnt`` and ``rank``. ``read``: per group the entries stored, opened and looked up."""

    rows: DataFrame
    read: DataFrame


def _band(count: Column) -> Column:
    """The power of two a count (1 or more) has reached."""
    return F.length(F.bin(count)) - 1


def count_lists(prepared: DataFrame, geo: GeoTable | None = None) -> DataFrame:
    """The entries of all lists: date, folder, kind, by (what is counted), value, cnt."""
    sets = [["day", FOLDER, KEY], ["day", FOLDER, REFERRER]]
    columns = set_columns(sets)
    counted = prepared.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("grouping"), *request_measures()[1:3]
    )
    is_key = in_set(columns, sets[0])
    named = counted.select(
        "day", FOLDER, F.when(is_key, KEY).otherwise(REFERRER).alias("kind"), F.when(is_key, F.col(KEY)).otherwise(F.col(REFERRER)).alias("value"), *BY
    )
    measured = F.stack(F.lit(len(BY)), *(x for b in BY for x in (F.lit(b), F.col(b)))).alias("by", "cnt")
    listed = named.select("day", FOLDER, "kind", "value", measured)
    for by, wanted in zip(BY, (R.is_download, R.is_interaction)) if geo else ():
        located = count_by_country(prepared.where(wanted(F.col("method"))), geo, ["day", FOLDER])
        listed = listed.unionByName(
            located.select("day", FOLDER, F.lit(COUNTRY).alias("kind"), F.col("country").alias("value"), F.lit(by).alias("by"), F.col("requests").alias("cnt"))
        )
    kept = listed.where("value IS NOT NULL AND cnt > 0")
    return kept.select(R.partition_day(F.col("day")).alias("date"), FOLDER, "kind", "by", "value", F.col("cnt").cast("bigint").alias("cnt"))


def store_rankings(spark: SparkSession, prepared: DataFrame, out: str, geo: GeoTable | None = None, head: int = HEAD) -> None:
    """Store the lists of the days of ``prepared``, replacing days stored before, in one step."""
    with job_folder(spark, "rankings"):
        _store(spark, staged(count_lists(prepared, geo), "ranking-counts"), out, head)


def _store(spark: SparkSession, counts: DataFrame, out: str, head: int) -> None:
    sizes = counts.groupBy(*_LIST).agg(F.count(F.lit(1)).alias("entries"))
    sizes = sizes.select(F.struct(*_LIST).alias("_list"), "entries")
    sized = counts.join(sizes, F.struct(*_LIST).eqNullSafe(F.col("_list"))).drop("_list")
    run = new_run()
    sized = sized.withColumn("long", F.col("entries") > head)
    heads = rank_within(sized, _LIST, "cnt", "value", head)
    long = sized.where("long").drop("entries", "long").withColumn("band", _band(F.col("cnt")))
    # Side by side: what a window opens of a kind, and within it the values looked up.
    order = ["date", "kind", "by", F.desc("band"), "value"]
    long = long.repartitionByRange(*order).sortWithinPartitions(*order)
    found = {HEADS: write_run(heads, out, HEADS, run), ENTRIES: write_run_as_is(long, out, ENTRIES, run)}

    def replace(pointer: Pointer) -> bool:
        for store, dates in found.items():
            held = pointer.stores.setdefault(store, {})
            for day in found[HEADS]:
                held.pop(day, None)
            held.update({day: {run: None} for day in dates})
        return bool(found[HEADS])

    publish(spark, out, replace)


def _kth(sums: DataFrame, k: int, name: str) -> DataFrame:
    """Per group the k-th largest ``low``; no row for groups of fewer values."""
    best = rank_within(sums, ["group"], "low", "value", k)
    return best.where(F.col("rank") == k).select(F.col("group").alias("_of"), F.col("low").alias(name))


def window_ranking(
    spark: SparkSession, out: str, start: str, end: str, kind: str, k: int, by_folder: bool = False, by_interaction: bool = False
) -> Ranking:
    """The ``k`` most frequent values of a window (``yyyy-MM-dd``, both ends count), overall or per folder.

    Equal counts are ordered by value. ``group`` is the folder, or NULL for the one
    group there is overall.
    """
    if start > end:
        raise ValueError(f"window starts after its end: {start} > {end}")
    pointer = newest(spark, out)
    of = (F.col("kind") == kind) & (F.col("by") == BY[by_interaction])
    group = (F.col(FOLDER) if by_folder else F.lit(None).cast("string")).alias("group")

    def of_window(store: str, *columns: str) -> DataFrame:
        days = [d for d in pointer.dates(store) if start <= d <= end]
        return read_store(spark, out, store, SCHEMAS[store], pointer, days).where(of).select(group, "value", "cnt", *columns)

    in_group = F.col("group").eqNullSafe(F.col("_of"))
    heads = of_window(HEADS, "entries", "rank", "long")

    # Step 1. Long lists of a group, and the depth to which they are opened: an entry below
    # it can't belong to a value that reaches the k-th sum of heads by such entries alone.
    first = F.col("rank") == 1
    lists = heads.groupBy("group").agg(
        F.count_if(first & F.col("long")).alias("lists"), F.sum(F.when(first, F.col("entries"))).alias("stored"), F.count(F.lit(1)).alias("heads")
    )
    bound = _kth(heads.groupBy("group", "value").agg(F.sum("cnt").alias("low")), k, "bound")
    depth = F.when(F.col("lists") > 0, F.greatest(F.lit(1), F.coalesce(F.ceil(F.col("bound") / F.col("lists")), F.lit(1)))).cast("bigint")
    limits = lists.join(bound, in_group, "left").select(F.col("group").alias("_of"), "lists", "stored", "heads", depth.alias("depth"))
    limits = staged(limits, "ranking-limits")
    shallow, deep = limits.agg(F.min("depth"), F.max("depth")).first()

    # Step 2. Everything at or above the depth.
    limit = limits.select("_of", "lists", "depth")
    entries = of_window(ENTRIES, "band")
    above = entries.where(F.col("band") >= (shallow or 1).bit_length() - 1).join(limit, in_group & (F.col("cnt") >= F.col("depth")))
    opened = heads.where("NOT long").select("group", "value", "cnt", F.lit(0).alias("_long"))
    opened = opened.unionByName(above.select("group", "value", "cnt", F.lit(1).alias("_long")))
    found = opened.groupBy("group", "value").agg(F.sum("cnt").alias("low"), F.sum("_long").alias("seen"))
    found = staged(found, "ranking-found")

    # Step 3. Values whose unseen lists could still lift them to the k-th sum: looked up below.
    unseen = F.col("lists") - F.col("seen")
    # Groups without long lists have no depth, and nothing that is unseen.
    high = F.coalesce(F.col("low") + unseen * (F.col("depth") - 1), F.col("low"))
    reach = found.join(limit, in_group).select("group", "value", "low", (unseen > 0).alias("open"), high.alias("high"))
    left = reach.join(_kth(found, k, "bound"), in_group, "left").where("bound IS NULL OR high >= bound").select("group", "value", "low", "open")
    left = staged(left, "ranking-left")
    asked = left.where("open").select(F.col("group").alias("_g"), F.col("value").alias("_v")).join(limit, F.col("_g").eqNullSafe(F.col("_of")))
    rest = entries.where((F.col("band") <= max((deep or 1) - 1, 1).bit_length() - 1) & F.lit((deep or 1) > 1))
    rest = rest.join(asked, F.col("group").eqNullSafe(F.col("_g")) & (F.col("value") == F.col("_v")) & (F.col("cnt") < F.col("depth")))
    looked_up = rest.groupBy("group", "value").agg(F.sum("cnt").alias("low"), F.count(F.lit(1)).alias("n"))
    looked_up = staged(looked_up, "ranking-looked-up")
    totals = left.select("group", "value", "low").unionByName(looked_up.drop("n")).groupBy("group", "value").agg(F.sum("low").alias("cnt"))

    parts = [
        limits.select(F.col("_of").alias("group"), "stored", "heads"),
        found.groupBy("group").agg(F.sum("seen").alias("opened")),
        looked_up.groupBy("group").agg(F.sum("n").alias("looked_up")),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    read = merged.groupBy("group").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("stored", "heads", "opened", "looked_up")))
    return Ranking(rank_within(totals, ["group"], "cnt", "value", k), read)
