"""Access-log lines to columns, and the day directories they lie in."""

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens import schema as S

# Fixed value: the line pattern. Eighteen fields, eight more in later versions of
# the format, then anything. The blank in front of the later eight is a group of
# its own, which tells "fields missing" from "fields empty".
LINE_PATTERN = (
    r'([^ ]*) ([^ ]*) \[(.*?)\] ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ("[^"]*"|-) (-|[0-9]*) '
    r'([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ("[^"]*"|-) ([^ ]*)'
    r"(?:( )([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*) ([^ ]*))?.*$"
)

# A line of a text file cannot hold a line feed, so it separates fields safely.
FIELD_SEPARATOR = "\n"

DAY_IN_PATH = r"/(\d{4}/\d{2}/\d{2})/[^/]+$"


def captured_fields(columns: Iterable[str] | None = None) -> Column:
    """A text line ``value`` rewritten into its captured fields, as one text.

    One regular-expression pass per line; only the fields asked for are written out.
    A line that does not match stays as it is.
    """
    wanted = _wanted(columns)
    numbers = {n: i for i, (n, _) in enumerate(S.ACCESS_LOG_COLUMNS)}

    def group_of(index: int) -> int:
        return index + 1 if index < S.OPTIONAL_TAIL_START else index + 2

    groups = [S.OPTIONAL_TAIL_START + 1, *(group_of(numbers[n]) for n in wanted)]
    return F.regexp_replace("value", f"^{LINE_PATTERN}", FIELD_SEPARATOR.join(f"${g}" for g in groups))


def split_fields(captured: Column) -> Column:
    """What ``captured_fields`` wrote, as the array that ``typed_columns`` reads."""
    return F.split(captured, FIELD_SEPARATOR, -1)


def typed_columns(fields: str, columns: Iterable[str] | None = None) -> list[Column]:
    """The typed columns of the access log from an array of captured fields; NULL if the line did not match."""
    wanted = _wanted(columns)
    numbers = {n: i for i, (n, _) in enumerate(S.ACCESS_LOG_COLUMNS)}
    types = dict(S.ACCESS_LOG_COLUMNS)
    matched = F.size(fields) == len(wanted) + 1

    def column(position: int, name: str) -> Column:
        present = matched
        if numbers[name] >= S.OPTIONAL_TAIL_START:
            present = matched & (F.get(fields, F.lit(0)) == " ")
        field = F.get(fields, F.lit(position))
        if types[name] == "bigint":
            # Most sizes that are no number are "-"; a failing cast costs far more than the test.
            return F.when(present & (field != S.NO_VALUE), field.try_cast("bigint")).alias(name)
        return F.when(present, field).alias(name)

    return [column(i, n) for i, n in enumerate(wanted, start=1)]


def _wanted(columns: Iterable[str] | None) -> list[str]:
    chosen = None if columns is None else set(columns)
    return [n for n, _ in S.ACCESS_LOG_COLUMNS if chosen is None or n in chosen]


def parse_access_log(lines: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``value`` text lines to the typed columns of the access log.

    One regular-expression pass per line rewrites it into its captured fields;
    only the fields asked for are written out. A line that does not match gives
    NULL in every field. Other columns of ``lines`` are kept.

    The rewrite sits inside a generator (one output row per line), because the
    optimizer would otherwise copy it into every filter on a parsed column.
    """
    wanted = _wanted(columns)
    fields = split_fields(captured_fields(wanted))
    kept = [c for c in lines.columns if c != "value"]
    split_lines = lines.select(*kept, F.explode(F.array(fields)).alias("_fields"))
    return split_lines.select(*typed_columns("_fields", wanted), *kept)


def render_access_log(logs: DataFrame) -> DataFrame:
    """The reverse of parsing: one text ``value`` per request, NULL written as ``-``."""

    def field(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit("-"))
        return F.concat(F.lit("["), text, F.lit("]")) if name == "requestdatetime" else text

    line = F.concat_ws(" ", *(field(n) for n, _ in S.ACCESS_LOG_COLUMNS))
    return logs.select(line.alias("value"), F.col(S.PARTITION_COLUMN))


def day_globs(start: date, end: date) -> list[str]:
    """Directory patterns covering the days from ``start`` to ``end``.

    Whole months and years become one pattern each, so the listing done by the
    driver stays short for long windows.
    """
    patterns, day = [], start
    while day <= end:
        year_end = date(day.year, 12, 31)
        month_end = (day.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)
        if day.month == day.day == 1 and year_end <= end:
            patterns.append(f"{day:%Y}/[0-1][0-9]/[0-3][0-9]")
            day = year_end
        elif day.day == 1 and month_end <= end:
            patterns.append(f"{day:%Y/%m}/[0-3][0-9]")
            day = month_end
        else:
            patterns.append(f"{day:%Y/%m/%d}")
        day += timedelta(days=1)
    return patterns


def scan_log_lines(spark: SparkSession, base: str, start: str, end: str) -> DataFrame:
    """Lines of the day directories ``base/yyyy/MM/dd`` within the window.

    Only the directories of the window are listed; days without a directory are
    skipped, and a window without any gives an empty frame. The day is read off
    each file's path.
    """
    check_window(start, end)
    globs = day_globs(_as_date(start), _as_date(end))
    try:
        files = spark.read.text(f"{base.rstrip('/')}/{{{','.join(globs)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = T.StructType(
            [T.StructField("value", T.StringType()), T.StructField(S.PARTITION_COLUMN, T.StringType())]
        )
        return spark.createDataFrame([], schema)
    day = F.regexp_extract("_metadata.file_path", DAY_IN_PATH, 1)
    return files.select("value", day.alias(S.PARTITION_COLUMN))


def scan_access_log(
    spark: SparkSession, base: str, start: str, end: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Parsed requests of the window."""
    return parse_access_log(scan_log_lines(spark, base, start, end), columns)


def check_window(start: str, end: str) -> None:
    """Windows are ``yyyy/MM/dd`` texts, both ends included."""
    if start > end:
        raise ValueError(f"window starts after it ends: {start} > {end}")


def _as_date(day_text: str) -> date:
    return date(*map(int, day_text.split("/")))
