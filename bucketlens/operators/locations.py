"""Requests by country, looked up per address after counting."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketlens.operators.geo import GeoTable, resolve_addresses
from bucketlens.operators.metrics import request_measures


def count_by_country(prepared: DataFrame, geo: GeoTable, by: list[str] | None = None) -> DataFrame:
    """Measures per group and country.

    Requests are counted per address first, so the lookup meets each address once
    per group instead of once per request; rows without an address are ``N/A``.
    """
    by = by or []
    keys = [*by, "remoteip"]
    per_address = prepared.groupBy(*keys).agg(*request_measures())
    located = resolve_addresses(per_address, geo, keys, F.col("remoteip"))
    sums = [F.sum(c).alias(c) for c in per_address.columns if c not in keys]
    return located.groupBy(*by, "country").agg(*sums)


def location_histogram(prepared: DataFrame, geo: GeoTable, by: list[str]) -> DataFrame:
    """All countries with their number of requests."""
    return count_by_country(prepared, geo, by).select(*by, "country", F.col("requests").alias("cnt"))
