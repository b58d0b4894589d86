"""Access logs, address ranges and history derived from the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.operators.geo import GeoTable, geo_table
from bucketlens.operators.prepare import prepare
from bucketlens.operators.selection import filter_object_requests
from bucketlens.session import configure

# The window of the queries whose feature is a window.
WINDOW_START, WINDOW_END = "2024/01/05", "2024/01/20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


QUOTED_DASH = "'-'"

# How an event becomes a request; ``k`` is the number in the event's properties.
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
GIVEN = {
    "bucketowner": "'owner'",
    "bucket_name": "'exports'",
    "requestdatetime": "concat(date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000')",
    "remoteip": "concat_ws('.', 10, user_id % 32, user_id % 7, user_id % 256)",
    "requestid": "concat('R', event_id)",
    "operation": """CASE WHEN event_type IN ('view', 'signup') THEN 'REST.GET.OBJECT'
        WHEN event_type = 'click' THEN 'REST.HEAD.OBJECT'
        WHEN event_type = 'purchase' THEN 'REST.PUT.OBJECT'
        ELSE element_at(array('REST.POST.OBJECT', 'BATCH.DELETE.OBJECT', 'LEGACYOP'), k % 3 + 1) END""",
    "key": """CASE WHEN event_id % 20 <= 7 THEN concat('ISO3/N', user_id % 25, '/f', k % 4, '/lines/hot_n', k % 5, '_',
            element_at(array('geojson', 'shp', 'gpkg'), k % 3 + 1), '.zip')
        WHEN event_id % 20 <= 12 THEN concat('TM/project_', k, '/roads/p_', k % 7, '_fgb.zip')
        WHEN event_id % 20 <= 14 THEN concat('default/u', k, '/x.zip')
        WHEN event_id % 20 = 15 THEN 'FAVICON.ICO'
        WHEN event_id % 20 = 16 THEN 'log2024/a.txt'
        WHEN event_id % 20 = 17 THEN '-'
        WHEN event_id % 20 = 18 THEN concat('TM/project_', k, '/meta.json')
        ELSE 'TEST-OBJECT' END""",
    "request_uri": "'\"GET /x HTTP/1.1\"'",
    "httpstatus": "CASE WHEN event_type = 'error' THEN '403' ELSE '200' END",
    "bytessent": "CASE WHEN event_type IN ('view', 'signup') THEN CAST(round(value * 1000) AS BIGINT) END",
    "objectsize": "CASE WHEN event_type IN ('view', 'purchase') THEN CAST(round(value * 2000) AS BIGINT) END",
    "referrer": """CASE event_id % 4 WHEN 0 THEN '-' WHEN 1 THEN concat('"', url, '"')
        WHEN 2 THEN '"https://maps.example.com:8443/v"' ELSE '"www.example.com/x"' END""",
    "useragent": "'\"agent/1.0 (x; y)\"'",
}


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged request per event."""
    pages = table(spark, sf_dir, "pages")
    # A generated column, which filters on the key do not copy the regular expression into.
    events = table(spark, sf_dir, "events").select("*", F.explode(F.array(F.expr(K))).alias("k"))
    numbered = events.withColumn("page_id", F.col("event_id") % pages.agg(F.count(F.lit(1))).scalar())
    joined = numbered.join(pages.select("page_id", "url"), "page_id", "left")
    day = f"date_format(ts, '{S.DAY_FORMAT}') AS `{S.PARTITION_COLUMN}`"
    return joined.selectExpr(*(f"{GIVEN.get(n, QUOTED_DASH)} AS {n}" for n, _ in S.ACCESS_LOG_COLUMNS), day)


def object_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_object_requests(access_log(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str, lenient: bool = False) -> DataFrame:
    """Requests ready for the metrics, without the country."""
    return prepare(object_requests(spark, sf_dir), lenient=lenient)


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range per nation, and a narrower one inside it (every fifth without a country)."""
    inner = "10L * 16777216 + n * 65536 + n % 7 * 256"
    short = "CASE WHEN n % 5 <> 0 THEN upper(substring(n_name, 1, 2)) END"
    return (
        table(spark, sf_dir, "nation")
        .selectExpr("CAST(n_nationkey AS BIGINT) AS n", "n_name")
        .selectExpr(
            f"""stack(2, 10L * 16777216 + n * 65536, 10L * 16777216 + n * 65536 + 65535, n_name,
                {inner}, {inner} + 127, {short}) AS (range_start, range_end, iso_code)"""
        )
    )


def geo(spark: SparkSession, sf_dir: str) -> GeoTable:
    return geo_table(geo_ranges(spark, sf_dir))


def monthly_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a long history: downloads and users per calendar month."""
    month = F.trunc("o_orderdate", "month")
    by_month = table(spark, sf_dir, "orders").groupBy(month.alias("period_start")).agg(
        F.count(F.lit(1)).alias(S.REPORT_METRICS["downloads_count"]),
        F.count_distinct("o_custkey").alias(S.REPORT_METRICS["unique_users"]),
    )
    return by_month.withColumn("period_end", F.last_day("period_start"))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day with orders, as reference dates."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("reference_date")).distinct()
