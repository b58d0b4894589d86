"""Query results and extracts as files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens import schema as S
from bucketlens.functions import requests as R

CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
EMPTY_SIGN = "\u0001"


def write_query_result(df: DataFrame, path: str, compression: str = "gzip") -> DataFrame:
    """Materialize a query as parquet in a folder that must not exist; gives it back."""
    df.write.mode("errorifexists").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_manifest(spark: SparkSession, path: str, manifest: str) -> None:
    """List the data files of a stored result, one path per line."""
    # The listing has the names; no row is read.
    files = spark.createDataFrame([(name,) for name in spark.read.parquet(path).inputFiles()], "value STRING")
    files.write.mode("errorifexists").text(manifest)


def extract_path(base: str, start: str, end: str, suffix: str) -> str:
    """``base/2024/2024_01_05-2024_01_20.suffix``, filed under the year of the start."""
    return f"{base.rstrip('/')}/{start[:4]}/{start.replace('/', '_')}-{end.replace('/', '_')}.{suffix}"


def export_parquet(df: DataFrame, base: str, start: str, end: str) -> str:
    path = extract_path(base, start, end, "parquet")
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv_gz(df: DataFrame, base: str, start: str, end: str) -> str:
    """Gzipped CSV with header; quotes inside a value are doubled.

    Values stay as they are, blanks at their ends included. NULL is written as
    nothing, empty text as two quotes.
    """
    path = extract_path(base, start, end, "csv.gz")
    df.write.mode("overwrite").option("compression", "gzip").options(**CSV).csv(path)
    return path


def read_csv_gz(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # The reader takes empty text and nothing for the same, unless empty text has a sign of its own.
    stored = spark.read.schema(schema).options(**CSV).option("emptyValue", EMPTY_SIGN).csv(path)
    texts = [f.name for f in schema if f.dataType == T.StringType()]
    return stored.withColumns({c: F.when(F.col(f"`{c}`") == EMPTY_SIGN, "").otherwise(F.col(f"`{c}`")) for c in texts})


def merge_yearly_extract(df: DataFrame, path: str) -> None:
    """Merge a window of logs into one dataset per year; its days replace stored ones."""
    day = R.partition_day(F.col(S.PARTITION_COLUMN))
    dated = df.withColumns({"year": F.year(day), "day": day})
    replace_partitions(dated, path, ["year", "day"])


def replace_partitions(df: DataFrame, path: str, columns: list[str], file_format: str = "parquet") -> None:
    """Write partitions, replacing the stored ones of the same values and no others.

    Rows are rebalanced by partition: small partitions share a task and large
    ones are split, so a day of any size makes files of even size.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .format(file_format)
        .save(path)
    )
