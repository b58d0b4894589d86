"""Rejected lines, log tables of the catalogue, compacted logs, the zone check."""

import random
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bucketlens.plans import daily_job as D
from bucketlens.plans import usage_report as U
from bucketlens.session import work_dir
from bucketlens.sinks import compaction as Z
from bucketlens.sources import catalog as C
from bucketlens.sources import log_text as L
from bucketlens.sources import rejects as J
from bucketlens.streaming import incremental as I
from helpers import physical_plan, rows
from registry.log_files import write_log_tree
from registry.tables import access_log
from test_log_text import FULL, SHORT

# A line, and why it is no request (None: it is one).
LINES = [
    (FULL, None), (SHORT, None), (FULL + " more", None), ("", J.EMPTY_LINE), ("  \t", J.EMPTY_LINE), ("word", "bucket_name"),
    ("owner bucket", "requestdatetime"), (FULL.replace("[", ""), "requestdatetime"), (FULL.replace("]", ""), "requestdatetime"),
    (FULL.split('"GET')[0].strip(), "request_uri"), (FULL.replace('"GET /x HTTP/1.1"', '"GET /x'), "request_uri"),
    (FULL.replace(" 200 ", " OK "), "httpstatus"), (FULL.replace('"agent/1.0 (x; y)"', "agent"), "useragent"),
    (" ".join(SHORT.split(" ")[:-1]), "versionid"), ("Ünïcode [x", "requestdatetime"),
]


def test_every_line_is_a_request_or_rejected(spark):
    given = [(line, f"2024/01/0{k % 3 + 1}") for k, (line, _) in enumerate(LINES)]
    lines = spark.createDataFrame(given, "value string, timestamp string")
    requests, rejected = J.split_lines(lines, work_dir(spark, "test-lines"))
    assert requests.columns == [n.name for n in L.parse_access_log(lines).schema]
    assert rows(requests) == rows(L.parse_access_log(lines.where("value LIKE 'owner bucket [06/Feb%'").where(
        F.col("value").isin([line for line, cause in LINES if cause is None])
    )))
    assert rows(rejected.select("value", "cause")) == sorted(((v, c) for v, c in LINES if c), key=repr)
    counted = J.count_lines(requests, rejected).groupBy("timestamp").agg(F.sum("lines"))
    assert rows(counted) == rows(lines.groupBy("timestamp").count())


def test_samples_of_rejected_lines(spark):
    given = [(f"{k % 9} x", "2024/01/01") for k in range(90)] + [("", "2024/01/02")] * 20
    _, rejected = J.split_lines(spark.createDataFrame(given, "value string, timestamp string"), work_dir(spark, "test-lines"), ["key"])
    found = J.sample_rejected(rejected, 4)
    assert rows(found.select("timestamp", "value", "rank")) == [*((f"2024/01/01", f"{k} x", k + 1) for k in range(4)), ("2024/01/02", "", 1)]


def test_lines_are_read_once(spark, tables):
    base = write_log_tree(access_log(spark, tables))
    lines = L.scan_log_lines(spark, base, "2024/01/05", "2024/01/06")
    requests, rejected = J.split_lines(lines, work_dir(spark, "test-lines"), ["key"])
    assert rejected.isEmpty() and requests.count() == lines.count()
    assert all("/logs-" not in name for name in requests.inputFiles())


def test_a_filter_in_sql_reads_its_days_only(spark, tables):
    base = write_log_tree(access_log(spark, tables))
    table, view = f"lines_{uuid.uuid4().hex}", f"logs_{uuid.uuid4().hex}"
    for window in (("2024/01/03", "2024/01/20"), ("2023/06/01", "2025/12/31")):
        C.register_log_lines(spark, base, table, *window)
    C.register_access_log(spark, table, view)
    asked = spark.sql(f"SELECT requestid FROM {view} WHERE `timestamp` BETWEEN '2024/01/05' AND '2024/01/06' AND key <> '-'")
    plan = physical_plan(asked)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024/01/05" in filters and "2024/01/06" in filters
    expected = access_log(spark, tables).where("`timestamp` BETWEEN '2024/01/05' AND '2024/01/06' AND key <> '-'")
    assert rows(asked) == rows(expected.select("requestid"))
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == access_log(spark, tables).count()
    assert spark.sql(f"SELECT count(*) FROM {view} WHERE `timestamp` = '2025/12/31'").first()[0] == 0
    spark.sql(f"DROP TABLE {table}")
    with pytest.raises(ValueError):
        C.register_log_lines(spark, base, table, "2024/02/01", "2024/01/01")


@pytest.fixture(scope="module")
def skewed(spark, tables):
    """One day with nine tenths of the rows, one key with a third of them, in many small files."""
    draw = random.Random(3)
    given = [
        (f"R{n}", "2024/01/02" if n % 10 else "2024/01/03", "hot/key" if n % 3 == 0 else f"k/{draw.randrange(10**6):06d}", "x" * draw.randrange(200))
        for n in range(12_000)
    ]
    named = spark.createDataFrame(given, "requestid string, timestamp string, key string, hostid string").repartition(40)
    empty = access_log(spark, tables).where("false")
    return write_log_tree(named.selectExpr(*(
        f"{n}" if n in ("requestid", "timestamp", "key", "hostid") else f"CAST('-' AS {t}) AS {n}" if t == "string" else f"CAST(7 AS {t}) AS {n}"
        for n, t in empty.dtypes
    )))


def test_compacted_files_are_even_and_a_key_is_in_few(spark, skewed):
    out = work_dir(spark, "test-compacted")
    target = 100_000
    assert Z.compact_days(spark, skewed, "2024/01/01", "2024/01/31", out, target) == ["2024-01-02", "2024-01-03"]
    logs = L.scan_access_log(spark, skewed, "2024/01/01", "2024/01/31")
    stored = Z.read_compacted(spark, out)
    assert rows(stored.drop("date")) == rows(logs)
    files = [name.removeprefix("file://").removeprefix("file:") for name in stored.inputFiles()]
    sizes = [n for (n,) in spark.read.format("binaryFile").load(files).select("length").collect()]
    assert len(sizes) > 4 and max(sizes) < target
    keys = stored.schema.names.index("key")

    def may_hold(key):
        footers = [pq.ParquetFile(name).metadata for name in files]
        column = next(k for k in range(footers[0].num_columns) if footers[0].schema.column(k).name == "key")
        found = [f.row_group(g).column(column).statistics for f in footers for g in range(f.num_row_groups)]
        return sum(s.min <= key <= s.max for s in found)

    assert keys >= 0 and may_hold("k/500000") <= 4
    assert rows(stored.where("key = 'k/none'")) == []


def test_compacted_days_are_replaced(spark, skewed):
    out = work_dir(spark, "test-compacted")
    Z.compact_days(spark, skewed, "2024/01/01", "2024/01/31", out)
    before = Z.read_compacted(spark, out, ["2024-01-03"]).count()
    Z.compact_days(spark, skewed, "2024/01/03", "2024/01/03", out)
    assert Z.read_compacted(spark, out, ["2024-01-03"]).count() == before == 1_200
    assert Z.read_compacted(spark, out).count() == 12_000
    assert Z.compact_days(spark, skewed, "2030/01/01", "2030/01/01", out) == []


def _log_of(spark, days):
    """A log folder of ``days``: day, its lines."""
    base = work_dir(spark, "test-logs")
    for day, lines in days.items():
        spark.createDataFrame([(line,) for line in lines], "value string").repartition(3).write.text(f"{base}/{day}")
    return base


def _line(key, number):
    return FULL.replace(FULL.split(" ")[8], key).replace("[06/Feb", f"[{number % 9 + 1:02d}/Feb")


def test_compacted_days_that_fit_a_file_have_one(spark):
    """Borders between files of one size fell into the middle of days."""
    share = {"2024/01/02": 450, "2024/01/03": 350, "2024/01/04": 200}
    base = _log_of(spark, {day: [_line(f"k/{n * 7919 % 1000:04d}", n) for n in range(many)] for day, many in share.items()})
    sizes = {day: sum(len(r[0]) for r in L.scan_log_lines(spark, base, day, day).select("value").collect()) for day in share}
    out = work_dir(spark, "test-compacted")
    Z.compact_days(spark, base, "2024/01/01", "2024/01/31", out, int(max(sizes.values()) * Z.SHRINKING))
    stored = Z.read_compacted(spark, out)
    assert rows(stored.drop("date")) == rows(L.scan_access_log(spark, base, "2024/01/01", "2024/01/31"))
    assert len(stored.inputFiles()) == 3
    keys = [r[0] for r in spark.read.parquet(stored.inputFiles()[0]).select("key").collect()]
    assert len(set(keys)) > 100 and keys == sorted(keys)


def test_a_task_sorts_one_file_or_some_small_days(spark):
    """All of a window's text went to one task up to the size of a file."""
    days = {f"2024/01/{d:02d}": [_line(f"k/{n:04d}", n) for n in range(100)] for d in range(1, 13)}
    days["2024/01/20"] = [_line(f"k/{n:04d}", n) for n in range(2_000)] + ["garbage", ""] + [FULL] * 40 + [SHORT]
    base = _log_of(spark, days)
    lines = L.scan_log_lines(spark, base, "2024/01/01", "2024/01/31")
    day_size = sum(map(len, days["2024/01/01"]))
    target = int(5 * day_size * Z.SHRINKING)
    dealt = Z.deal_lines(lines, target, shared=3 * day_size)
    size = F.sum(F.length("captured"))
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.sort_array(F.collect_set("timestamp")), size).collect()
    assert sorted(days for _, days, _ in tasks if len(days) > 1) == [sorted(days_) for days_ in (
        [f"2024/01/{d:02d}" for d in range(k, k + 3)] for k in (1, 4, 7, 10)
    )]
    assert sum(days == ["2024/01/20"] for _, days, _ in tasks) == 5 and max(n for _, _, n in tasks) < 8 * day_size
    out = work_dir(spark, "test-compacted")
    Z.compact_days(spark, base, "2024/01/01", "2024/01/31", out, target)
    assert rows(Z.read_compacted(spark, out).drop("date")) == rows(L.parse_access_log(lines))


def test_lines_are_sorted_once_and_not_as_columns(spark, skewed, monkeypatch):
    plans = []
    monkeypatch.setattr(Z, "write_run_as_is", lambda logs, *_: plans.append(physical_plan(logs)) or [])
    Z.compact_days(spark, skewed, "2024/01/01", "2024/01/31", work_dir(spark, "test-compacted"))
    (plan,) = plans
    assert plan.count("Sort [") == 1
    assert "hostid" not in plan.split("Sort [")[1]


def test_jobs_refuse_another_zone(spark, geo):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        for job in (
            lambda: D.run_daily_job(spark, "nowhere", "2024/01/01", "2024/01/02", geo, "nowhere"),
            lambda: U.usage_report(spark, "nowhere", "2024/01/01", "2024/01/02", geo, "nowhere"),
            lambda: I.run_incremental(spark, "nowhere", geo, "nowhere"),
        ):
            with pytest.raises(ValueError, match="time zone"):
                job()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
