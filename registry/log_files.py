"""Log text in day directories, for the queries that scan files."""

import uuid

from pyspark.sql import DataFrame

from bucketlens import schema as S
from bucketlens.session import work_dir
from bucketlens.sources.log_text import render_access_log


def write_log_tree(logs: DataFrame, base: str | None = None) -> str:
    """Add requests as text under ``base/yyyy/MM/dd``, all days in one job.

    A catalog table with one location per day does the routing; the table is
    dropped again, its files stay.
    """
    spark = logs.sparkSession
    base = base or work_dir(spark, "logs")
    table = f"log_tree_{uuid.uuid4().hex}"
    column = f"`{S.PARTITION_COLUMN}`"
    lines = render_access_log(logs)
    days = [row[0] for row in logs.select(S.PARTITION_COLUMN).distinct().collect()]
    spark.sql(f"CREATE TABLE {table} (value STRING, {column} STRING) USING text PARTITIONED BY ({column}) LOCATION '{base}'")
    try:
        places = " ".join(f"PARTITION ({column}='{day}') LOCATION '{base}/{day}'" for day in days)
        spark.sql(f"ALTER TABLE {table} ADD {places}")
        lines.hint("rebalance", S.PARTITION_COLUMN).write.insertInto(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
    return base
