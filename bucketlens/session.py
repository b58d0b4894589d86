"""Session settings and the shared working folder."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

APP_FOLDER = "bucketlens"
_job: ContextVar[str | None] = ContextVar("job", default=None)


# The JVM does not compile methods beyond this many bytes of bytecode. A stage whose
# generated code is longer runs faster as separate operators.
JIT_METHOD_LIMIT = 8000


def configure(spark: SparkSession) -> SparkSession:
    """Settings the jobs want: days and request times in UTC, code the JVM compiles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_LIMIT))
    return spark


def check_zone(spark: SparkSession) -> None:
    """Days and request times are in UTC; ``configure`` sets it."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError(f"the session's time zone is {zone}: call configure(spark) first")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in a folder that driver and executors share.

    That is the folder named by ``spark.checkpoint.dir``; where it is unset, the
    warehouse folder, which has to be shared for saved tables anyway.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{base.rstrip('/')}/{APP_FOLDER}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    job = _job.get()
    path = f"{job}/{name}-{uuid.uuid4().hex}" if job else work_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, wherever the storage is; none there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def job_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """What is staged inside goes to one folder, removed at the end, also of a failed job.

    For jobs that store their result elsewhere: nothing staged may be read afterwards.
    """
    path = work_dir(spark, name)
    token = _job.set(path)
    try:
        yield
    finally:
        _job.reset(token)
        remove(spark, path)
