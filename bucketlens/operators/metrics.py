"""Usage metrics, exact, at any grouping.

Distinct counts are taken in two steps. Requests are first counted per distinct
value (key, address, referrer) within the group, all kinds of value in one pass
with grouping sets; map-side combining shrinks hot values before the shuffle. The
group's metrics are then sums and counts over distinct values.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketlens.functions import requests as R

KEY, ADDRESS, REFERRER = "key", "remoteip", "referrer"
VALUE_COLUMNS = [KEY, ADDRESS, REFERRER]

SUMMARY_METRICS = [
    "interactions_count",
    "downloads_count",
    "unique_downloads",
    "uploads_count",
    "download_size",
    "upload_size",
    "unique_users",
    "unique_users_by_download",
]


def request_measures() -> list[Column]:
    """Additive measures of a set of requests."""
    method = F.col("method")
    download, upload = R.is_download(method), R.is_upload(method)
    return [
        F.count(F.lit(1)).alias("requests"),
        F.count_if(R.is_interaction(method)).alias("interactions"),
        F.count_if(download).alias("downloads"),
        F.count_if(upload).alias("uploads"),
        F.sum(F.when(download, F.col("bytessent")).otherwise(0)).alias("download_bytes"),
        F.sum(F.when(upload, F.col("objectsize")).otherwise(0)).alias("upload_bytes"),
    ]


MEASURES = ["requests", "interactions", "downloads", "uploads", "download_bytes", "upload_bytes"]


def count_values(prepared: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Measures per distinct value: one row per group of each grouping set.

    Columns: the grouping columns, ``grouping`` (which of them a row is grouped by)
    and the measures. Every set should end in exactly one value column.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return prepared.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("grouping"), *request_measures()
    )


def in_set(columns: list[str], grouping_set: list[str]) -> Column:
    """Whether a row of ``count_values`` belongs to this grouping set."""
    bits = "".join("0" if c in grouping_set else "1" for c in columns)
    return F.col("grouping") == int(bits, 2)


def set_columns(sets: list[list[str]]) -> list[str]:
    return list(dict.fromkeys(c for s in sets for c in s))


def combine(by_key: Column, by_address: Column) -> list[Column]:
    """The eight summary metrics from rows per distinct key and per distinct address."""
    key_seen = by_key & F.col(KEY).isNotNull()
    address_seen = by_address & F.col(ADDRESS).isNotNull()

    def total(measure: str) -> Column:
        return F.coalesce(F.sum(F.when(by_key, F.col(measure))), F.lit(0).cast("bigint"))

    return [
        total("interactions").alias("interactions_count"),
        total("downloads").alias("downloads_count"),
        F.count_if(key_seen & (F.col("downloads") > 0)).alias("unique_downloads"),
        F.count_if(key_seen & (F.col("uploads") > 0)).alias("uploads_count"),
        total("download_bytes").alias("download_size"),
        total("upload_bytes").alias("upload_size"),
        F.count_if(address_seen).alias("unique_users"),
        F.count_if(address_seen & (F.col("downloads") > 0)).alias("unique_users_by_download"),
    ]


def summarize(prepared: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The summary metrics per group of ``by``, or of everything (one row)."""
    by = by or []
    sets = [[*by, KEY], [*by, ADDRESS]]
    columns = set_columns(sets)
    counted = count_values(prepared, sets)
    return counted.groupBy(*by).agg(*combine(in_set(columns, sets[0]), in_set(columns, sets[1])))


def summarize_days_and_folders(prepared: DataFrame) -> DataFrame:
    """Per day (``top_level_key`` NULL, ``level`` "day") and per day and folder, in one pass.

    A key lies in one folder, so rows per key serve both levels; addresses are
    counted once per level.
    """
    day, folder = "day", "top_level_key"
    sets = [[day, folder, KEY], [day, folder, ADDRESS], [day, ADDRESS]]
    columns = set_columns(sets)
    counted = count_values(prepared, sets)
    by_key = in_set(columns, sets[0])
    marked = counted.select(
        day, folder, KEY, ADDRESS, *MEASURES,
        by_key.alias("by_key"),
        in_set(columns, sets[1]).alias("by_folder_address"),
        in_set(columns, sets[2]).alias("by_day_address"),
    )
    # Rows per address are of use on one level only.
    levels = F.when(F.col("by_day_address"), F.array(F.lit("day"))).when(
        F.col("by_folder_address"), F.array(F.lit("folder"))
    ).otherwise(F.array(F.lit("day"), F.lit("folder")))
    leveled = marked.withColumn("level", F.explode(levels))
    by_address = F.col("by_day_address") | F.col("by_folder_address")
    return (
        leveled.groupBy("level", day, F.when(F.col("level") == "folder", F.col(folder)).alias(folder))
        .agg(*combine(F.col("by_key"), by_address))
    )


def summarize_plain(prepared: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same metrics with Spark's own distinct aggregates.

    Copies every request once per distinct aggregate; kept as the yardstick the
    two-step form is tested against.
    """
    method = F.col("method")
    download, upload = R.is_download(method), R.is_upload(method)

    def total(size: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(size))), F.lit(0).cast("bigint"))

    return prepared.groupBy(*(by or [])).agg(
        F.count_if(R.is_interaction(method)).alias("interactions_count"),
        F.count_if(download).alias("downloads_count"),
        F.count_distinct(F.when(download, F.col("key"))).alias("unique_downloads"),
        F.count_distinct(F.when(upload, F.col("key"))).alias("uploads_count"),
        total("bytessent", download).alias("download_size"),
        total("objectsize", upload).alias("upload_size"),
        F.count_distinct("remoteip").alias("unique_users"),
        F.count_distinct(F.when(download, F.col("remoteip"))).alias("unique_users_by_download"),
    )


# Single metrics: they read only the columns they need.


def interactions_count(prepared: DataFrame, by: list[str]) -> DataFrame:
    return prepared.groupBy(*by).agg(F.count_if(R.is_interaction(F.col("method"))).alias("interactions_count"))


def downloads_count(prepared: DataFrame, by: list[str]) -> DataFrame:
    return prepared.groupBy(*by).agg(F.count_if(R.is_download(F.col("method"))).alias("downloads_count"))


def unique_files_downloaded(prepared: DataFrame, by: list[str]) -> DataFrame:
    key = F.when(R.is_download(F.col("method")), F.col("key"))
    return prepared.groupBy(*by).agg(F.count_distinct(key).alias("unique_downloads"))


def unique_files_uploaded(prepared: DataFrame, by: list[str]) -> DataFrame:
    key = F.when(R.is_upload(F.col("method")), F.col("key"))
    return prepared.groupBy(*by).agg(F.count_distinct(key).alias("uploads_count"))


def download_bytes(prepared: DataFrame, by: list[str]) -> DataFrame:
    size = F.when(R.is_download(F.col("method")), F.col("bytessent")).otherwise(0)
    return prepared.groupBy(*by).agg(F.coalesce(F.sum(size), F.lit(0).cast("bigint")).alias("download_size"))


def upload_bytes(prepared: DataFrame, by: list[str]) -> DataFrame:
    size = F.when(R.is_upload(F.col("method")), F.col("objectsize")).otherwise(0)
    return prepared.groupBy(*by).agg(F.coalesce(F.sum(size), F.lit(0).cast("bigint")).alias("upload_size"))


def unique_users(prepared: DataFrame, by: list[str]) -> DataFrame:
    return prepared.groupBy(*by).agg(F.count_distinct("remoteip").alias("unique_users"))


def unique_users_by_download(prepared: DataFrame, by: list[str]) -> DataFrame:
    ip = F.when(R.is_download(F.col("method")), F.col("remoteip"))
    return prepared.groupBy(*by).agg(F.count_distinct(ip).alias("unique_users_by_download"))


def value_histogram(prepared: DataFrame, by: list[str], column: str) -> DataFrame:
    """All values of a column with their number of requests, NULL left out."""
    return prepared.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("cnt"))


def daily_downloads_by_file(prepared: DataFrame) -> DataFrame:
    downloads = prepared.where(R.is_download(F.col("method")) & F.col("key").isNotNull())
    return downloads.groupBy("day", "key").agg(F.count(F.lit(1)).alias("downloads"))


def request_time_span(prepared: DataFrame) -> DataFrame:
    return prepared.agg(F.min("request_ts").alias("first_request"), F.max("request_ts").alias("last_request"))
