"""Daily metrics and period metrics, stored so that a re-run replaces its own period."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens import schema as S
from bucketlens.sinks.extracts import replace_partitions
from bucketlens.sinks.published import read_store, replace_days

ROWS = "rows"

# A document holds some so many entries; a day with more has several.
DOCUMENT_ENTRIES = 200_000
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("part", T.LongType()),
        T.StructField("summary", T.StringType()),
        T.StructField("folders", T.StringType()),
        T.StructField("meta_downloads", T.StringType()),
    ]
)
SECTION_JSON = ", ".join([*(f"{m} BIGINT" for m in S.DAILY_METRICS), "locations MAP<STRING, BIGINT>", "referrers MAP<STRING, BIGINT>"])


def upsert_daily_metrics(rows: DataFrame, path: str) -> None:
    """Insert or replace by ``date``: the dates in ``rows`` replace stored ones, all at once."""
    replace_days(rows.sparkSession, path, {ROWS: rows})


def read_daily_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored daily metrics in the given columns; no rows where none are stored."""
    return read_store(spark, path, ROWS, schema)


def as_json_documents(rows: DataFrame, entries: int = DOCUMENT_ENTRIES) -> DataFrame:
    """Daily metrics in long form as JSON text: date, part, summary, folders, meta_downloads.

    ``summary`` has the metrics of the whole service with its locations and referrers,
    ``folders`` the same by folder, ``meta_downloads`` the downloads by file. A day has
    one part per ``entries`` of its entries, and every entry is in just one of them:
    one part is the whole document for all but very large days, whose parts put together
    key by key are. No task holds more than one part.
    """
    parts = rows.groupBy(F.col("date").alias("_date")).agg(F.ceil(F.count(F.lit(1)) / entries).cast("bigint").alias("_parts"))
    entry = F.xxhash64("scope", "folder", "metric", "sub_key")
    dealt = rows.join(parts, F.col("date") == F.col("_date")).withColumn("part", F.pmod(entry, F.col("_parts")))

    def values(metric: str) -> Column:
        found = F.collect_list(F.when(F.col("metric") == metric, F.struct("sub_key", "value")))
        return F.map_from_entries(F.array_sort(found)).alias(metric)

    scalars = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in S.DAILY_METRICS]
    sections = dealt.groupBy("date", "part", "scope", "folder").agg(*scalars, *map(values, ("locations", "referrers", "meta_downloads")))
    section = F.struct(*S.DAILY_METRICS, "locations", "referrers")
    whole = F.col("scope") == "whole"

    def of_whole(column: Column) -> Column:
        return F.coalesce(F.to_json(F.any_value(F.when(whole, column), ignoreNulls=True)), F.lit("{}"))

    by_folder = F.map_from_entries(F.collect_list(F.when(~whole, F.struct("folder", section.alias("section")))))
    return sections.groupBy("date", "part").agg(
        of_whole(section).alias("summary"), F.to_json(by_folder).alias("folders"), of_whole(F.col("meta_downloads")).alias("meta_downloads")
    )


def document_entries(documents: DataFrame) -> DataFrame:
    """The entries of JSON documents in long form: date, scope, folder, metric, sub_key, value."""

    def listed(values: Column, metric: str) -> Column:
        return F.transform(F.map_entries(values), lambda e: F.struct(F.lit(metric).alias("metric"), e["key"].alias("sub_key"), e["value"].alias("value")))

    def entries(section: Column) -> Column:
        nothing = F.lit(None).cast("string").alias("sub_key")
        scalars = F.array(*(F.struct(F.lit(m).alias("metric"), nothing, section[m].alias("value")) for m in S.DAILY_METRICS))
        lists = [F.coalesce(listed(section[m], m), F.array().cast("array<struct<metric: string, sub_key: string, value: bigint>>")) for m in ("locations", "referrers")]
        return F.concat(scalars, *lists)

    read = documents.select(
        "date", F.from_json("summary", SECTION_JSON).alias("summary"),
        F.from_json("folders", f"MAP<STRING, STRUCT<{SECTION_JSON}>>").alias("folders"),
        F.from_json("meta_downloads", "MAP<STRING, BIGINT>").alias("files"),
    )
    no_folder = F.lit(None).cast("string").alias("folder")
    whole = read.select("date", F.lit("whole").alias("scope"), no_folder, F.inline(F.concat(entries(F.col("summary")), listed(F.col("files"), "meta_downloads"))))
    folders = read.select("date", F.explode("folders").alias("folder", "section"))
    by_folder = folders.select("date", F.lit("folder").alias("scope"), "folder", F.inline(entries(F.col("section"))))
    return whole.unionByName(by_folder).where("value IS NOT NULL")


def write_period_metrics(metrics: DataFrame, path: str) -> None:
    """Overall metrics as one JSON document per period (period_start, period_end)."""
    replace_partitions(metrics, path, ["period_start", "period_end"], "json")
