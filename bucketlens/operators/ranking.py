"""Most frequent values, overall and per folder.

Equal counts are ordered by value, so a ranking does not depend on the run.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import requests as R
from bucketlens.operators.geo import GeoTable
from bucketlens.operators.locations import count_by_country


def _requests_of(prepared: DataFrame, by_interaction: bool) -> DataFrame:
    wanted = R.is_interaction if by_interaction else R.is_download
    return prepared.where(wanted(F.col("method")))


def _count_name(by_interaction: bool) -> str:
    return "interactions" if by_interaction else "downloads"


def top_values(prepared: DataFrame, column: str, k: int, by_interaction: bool = False) -> DataFrame:
    """The ``k`` most frequent values of a column among downloads (or interactions)."""
    name = _count_name(by_interaction)
    counts = (
        _requests_of(prepared, by_interaction)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
    )
    return counts.orderBy(F.col(name).desc(), F.col(column)).limit(k)


def top_locations(prepared: DataFrame, geo: GeoTable, k: int = S.TOP_OTHERS, by_interaction: bool = False) -> DataFrame:
    name = _count_name(by_interaction)
    counts = count_by_country(_requests_of(prepared, by_interaction), geo).select("country", F.col("requests").alias(name))
    return counts.orderBy(F.col(name).desc(), F.col("country")).limit(k)


def rank_within(counts: DataFrame, by: list[str], count: str, value: str, k: int) -> DataFrame:
    """Rows of the ``k`` largest counts per group, with their ``rank``.

    Each task keeps its own first ``k`` rows per group before the shuffle, so a
    group of any size sends ``k`` rows per task.
    """
    order = Window.partitionBy(*by).orderBy(F.col(count).desc(), F.col(value))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_values_by_folder(
    prepared: DataFrame, column: str, k: int, by_interaction: bool = False, value: Column | None = None
) -> DataFrame:
    """The ``k`` most frequent values of a column (or expression) in each folder."""
    name = _count_name(by_interaction)
    counts = (
        _requests_of(prepared, by_interaction)
        .select("top_level_key", (F.col(column) if value is None else value).alias(column))
        .where(F.col(column).isNotNull())
        .groupBy("top_level_key", column)
        .agg(F.count(F.lit(1)).alias(name))
    )
    return rank_within(counts, ["top_level_key"], name, column, k)


def top_locations_by_folder(
    prepared: DataFrame, geo: GeoTable, k: int = S.TOP_OTHERS, by_interaction: bool = False
) -> DataFrame:
    name = _count_name(by_interaction)
    counts = count_by_country(_requests_of(prepared, by_interaction), geo, ["top_level_key"])
    counts = counts.select("top_level_key", "country", F.col("requests").alias(name))
    return rank_within(counts, ["top_level_key"], name, "country", k)


def top_components_by_folder(
    prepared: DataFrame, column: str, k: int = S.TOP_OTHERS, by_interaction: bool = False
) -> DataFrame:
    """Projects, features or file formats per folder, for the folders that have them.

    They follow from the key, so requests are counted per key before the key is
    taken apart.
    """
    name = _count_name(by_interaction)
    component = {"project": R.project, "feature": R.feature, "fileformat": R.file_format}[column]
    per_key = (
        _requests_of(prepared, by_interaction)
        .where(R.has_components(F.col("top_level_key")))
        .groupBy("top_level_key", "key")
        .agg(F.count(F.lit(1)).alias(name))
    )
    counts = (
        per_key.withColumn(column, component(F.col("key")))
        .groupBy("top_level_key", column)
        .agg(F.sum(name).alias(name))
    )
    return rank_within(counts, ["top_level_key"], name, column, k)


def rankings_differ(downloads: DataFrame, interactions: DataFrame, by: list[str]) -> DataFrame:
    """Per group: whether the two rankings differ as sets of value and count.

    Both frames hold ``by``, ``value`` and ``cnt``; order does not matter.
    """
    both = downloads.select(*by, "value", F.col("cnt").alias("_d")).join(
        interactions.select(*by, "value", F.col("cnt").alias("_i")), [*by, "value"], "full"
    )
    return both.groupBy(*by).agg(F.bool_or(~F.col("_d").eqNullSafe(F.col("_i"))).alias("differs"))
