"""Query results kept as parquet files, and the metrics of earlier periods."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bucketlens import schema as S

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("period_start", T.DateType()),
        T.StructField("period_end", T.DateType()),
        T.StructField(S.REPORT_METRICS["downloads_count"], T.LongType()),
        T.StructField(S.REPORT_METRICS["unique_users"], T.LongType()),
    ]
)


def read_files(spark: SparkSession, manifest: str, schema: T.StructType | None = None) -> DataFrame:
    """Result read from the parquet files a manifest lists, one path per line.

    The list comes to the driver, as every file list does; the files do not.
    """
    paths = [row.value for row in spark.read.text(manifest).toLocalIterator() if row.value.strip()]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if not paths:
        if schema is None:
            raise ValueError(f"manifest lists no files: {manifest}")
        return spark.createDataFrame([], schema)
    return reader.parquet(*paths)


def register_result(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Make a stored result queryable by SQL under ``name``."""
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


def load_metrics_history(spark: SparkSession, path: str) -> DataFrame:
    """Stored overall metrics, one row per period; none stored gives no rows.

    ``path`` holds the JSON documents the metrics sink writes. Metrics a document
    lacks are NULL.
    """
    return read_if_stored(spark, path, HISTORY_SCHEMA, "json")


def read_if_stored(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    """A stored dataset, or an empty frame where nothing is stored yet."""
    try:
        return spark.read.schema(schema).format(file_format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
