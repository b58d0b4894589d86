"""Log lines that don't parse, set aside: counted by cause, some kept to look at."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens import schema as S
from bucketlens.sources.log_text import LINE_PATTERN, parse_access_log

EMPTY_LINE = "empty line"
ACCEPTED = "accepted"
# The column every line that parses has a value in.
FIRST = S.ACCESS_LOG_COLUMNS[0][0]


def _cause() -> Column:
    """Why a line that doesn't parse doesn't: the first of its 18 fields that is missing or odd."""
    fields, names = [], [n for n, _ in S.ACCESS_LOG_COLUMNS[: S.OPTIONAL_TAIL_START]]
    # Fields of the pattern are parted by single blanks outside of brackets and quotes.
    pattern, depth, begin = LINE_PATTERN.split("(?:( )", 1)[0], 0, 0
    for place, sign in enumerate(pattern):
        depth += sign in "([" and pattern[place - 1] != "\\"
        depth -= sign in ")]" and pattern[place - 1] != "\\"
        if sign == " " and not depth:
            fields.append(pattern[begin:place])
            begin = place + 1
    fields.append(pattern[begin:])
    text = F.col("value")
    cases = F.when(text.rlike(r"^\s*\z"), EMPTY_LINE)
    for n, name in enumerate(names, start=1):
        cases = cases.when(~text.rlike(f"^{' '.join(fields[:n])}(?: |$)"), name)
    return cases.otherwise("later fields")


def split_lines(lines: DataFrame, path: str, columns: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Requests, and the lines that are none, from one pass over ``lines`` (value, timestamp).

    Both are written to ``path``, a new folder. Requests have the parsed ``columns`` (all
    if not given), rejected lines the text, the day and the cause; every line is in one of
    the two.
    """
    wanted = [n for n, _ in S.ACCESS_LOG_COLUMNS if columns is None or n in set(columns)]
    parsed = parse_access_log(lines.withColumn("_line", F.col("value")), {*wanted, FIRST})
    rejected = F.col(FIRST).isNull()
    marked = parsed.select(*parsed.columns, rejected.alias("rejected")).withColumn("value", F.when(F.col("rejected"), F.col("_line")))
    told = marked.withColumn("cause", F.when(F.col("rejected"), _cause()))
    kept = [*wanted, S.PARTITION_COLUMN]
    stored = told.select(*kept, "value", "cause", "rejected")
    stored.write.mode("errorifexists").partitionBy("rejected").parquet(path)
    schema = T.StructType([*stored.schema.fields[:-1], T.StructField("rejected", T.BooleanType())])
    read = lines.sparkSession.read.schema(schema).parquet(path)
    return read.where("NOT rejected").select(*kept), read.where("rejected").select(S.PARTITION_COLUMN, "cause", "value")


def count_lines(requests: DataFrame, rejected: DataFrame) -> DataFrame:
    """timestamp, cause, lines: rejected lines by cause, requests as ``accepted``."""
    named = [requests.select(S.PARTITION_COLUMN, F.lit(ACCEPTED).alias("cause")), rejected.select(S.PARTITION_COLUMN, "cause")]
    counted = [df.groupBy(S.PARTITION_COLUMN, "cause").agg(F.count(F.lit(1)).alias("lines")) for df in named]
    return reduce(DataFrame.unionByName, counted)


def sample_rejected(rejected: DataFrame, n: int = 5) -> DataFrame:
    """At most ``n`` different lines of each day and cause, the first in order."""
    by_text = Window.partitionBy(S.PARTITION_COLUMN, "cause").orderBy("value")
    return rejected.distinct().withColumn("rank", F.row_number().over(by_text)).where(F.col("rank") <= n)
