from datetime import date

import pytest
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.sources import log_text as L
from helpers import physical_plan, rows

FULL = (
    'owner bucket [06/Feb/2024:00:00:38 +0000] 192.0.2.3 - ABC REST.GET.OBJECT TM/project_1/a_b.zip "GET /x HTTP/1.1" '
    '200 - 113 2662992 7 6 "https://a.org/x" "agent/1.0 (x; y)" - host= SigV4 ECDHE AuthHeader e.example.com TLSv1.2 arn Yes'
)
SHORT = " ".join(FULL.split(" ")[:-8])
NAMES = [n for n, _ in S.ACCESS_LOG_COLUMNS]


def parse(spark, *lines, columns=None):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    return [r.asDict() for r in L.parse_access_log(df, columns).orderBy("i").collect()]


def test_full_line(spark):
    (row,) = parse(spark, FULL)
    assert [row[n] for n in NAMES] == [
        "owner", "bucket", "06/Feb/2024:00:00:38 +0000", "192.0.2.3", "-", "ABC", "REST.GET.OBJECT",
        "TM/project_1/a_b.zip", '"GET /x HTTP/1.1"', "200", "-", 113, 2662992, "7", "6", '"https://a.org/x"',
        '"agent/1.0 (x; y)"', "-", "host=", "SigV4", "ECDHE", "AuthHeader", "e.example.com", "TLSv1.2", "arn", "Yes",
    ]


def test_line_without_the_later_fields(spark):
    (row,) = parse(spark, SHORT)
    assert row["versionid"] == "-"
    assert [row[n] for n in NAMES[18:]] == [None] * 8


def test_fewer_later_fields_than_eight_are_ignored(spark):
    (row,) = parse(spark, SHORT + " a b c")
    assert row["versionid"] == "-"
    assert [row[n] for n in NAMES[18:]] == [None] * 8


def test_empty_field_is_not_a_missing_field(spark):
    (row,) = parse(spark, SHORT + " a  c d e f g h")
    assert (row["hostid"], row["sigv"], row["ciphersuite"]) == ("a", "", "c")


def test_more_fields_than_known(spark):
    (row,) = parse(spark, FULL + " more fields")
    assert row["aclrequired"] == "Yes"


@pytest.mark.parametrize(
    "line",
    ["", "garbage", FULL.replace("https://a.org/x", "https://a.org/ x"), FULL.replace("[", "")],
    ids=["empty", "garbage", "blank in referrer", "no bracket"],
)
def test_line_that_does_not_match(spark, line):
    (row,) = parse(spark, line)
    assert [row[n] for n in NAMES] == [None] * 26


def test_sizes_that_are_no_numbers(spark):
    (row,) = parse(spark, FULL.replace(" 113 2662992 ", " - x "))
    assert (row["bytessent"], row["objectsize"]) == (None, None)


def test_control_characters_stay_in_their_field(spark):
    (row,) = parse(spark, FULL.replace("agent/1.0", "a\x01b\x02$1\\"))
    assert row["useragent"] == '"a\x01b\x02$1\\ (x; y)"'


def test_only_wanted_columns(spark):
    (row,) = parse(spark, FULL, columns=["key", "objectsize", "aclrequired"])
    assert row == {"i": 0, "key": "TM/project_1/a_b.zip", "objectsize": 2662992, "aclrequired": "Yes"}


def test_pattern_runs_once_per_line(spark):
    lines = spark.createDataFrame([(FULL,)], "value string")
    parsed = L.parse_access_log(lines).where("key <> '-' AND bytessent > 1").select("key", "referrer")
    assert physical_plan(parsed).count("regexp_replace") == 1


def test_day_globs_cover_exactly_the_window():
    assert L.day_globs(date(2024, 1, 30), date(2024, 2, 2)) == ["2024/01/30", "2024/01/31", "2024/02/01", "2024/02/02"]
    assert L.day_globs(date(2024, 1, 31), date(2024, 3, 1)) == ["2024/01/31", "2024/02/[0-3][0-9]", "2024/03/01"]
    whole_years = L.day_globs(date(2023, 12, 31), date(2026, 1, 1))
    assert whole_years[0] == "2023/12/31" and whole_years[-1] == "2026/01/01" and len(whole_years) == 4


@pytest.fixture(scope="module")
def log_tree(tmp_path_factory):
    base = tmp_path_factory.mktemp("logs")
    for day in ("2024/01/05", "2024/01/06", "2024/01/09", "2024/02/01"):
        folder = base / day
        folder.mkdir(parents=True)
        (folder / f"{day.replace('/', '-')}-00-00-00-A").write_text(FULL + "\n" + SHORT + "\n")
    return str(base)


def test_scan_reads_the_days_of_the_window(spark, log_tree):
    lines = L.scan_log_lines(spark, log_tree, "2024/01/06", "2024/01/31")
    assert rows(lines.groupBy("timestamp").count()) == [("2024/01/06", 2), ("2024/01/09", 2)]
    assert {p.split("/")[-2] for p in lines.inputFiles()} == {"06", "09"}


def test_scan_of_a_window_without_logs(spark, log_tree):
    logs = L.scan_access_log(spark, log_tree, "2025/01/01", "2025/12/31")
    assert logs.count() == 0
    assert set(logs.columns) == {*NAMES, "timestamp"}


def test_window_that_ends_before_it_starts(spark, log_tree):
    with pytest.raises(ValueError):
        L.scan_log_lines(spark, log_tree, "2024/01/06", "2024/01/05")


def test_render_and_parse(spark, tables):
    from registry.tables import access_log

    logs = access_log(spark, tables)
    parsed = L.parse_access_log(L.render_access_log(logs))
    assert parsed.schema.simpleString() == S.access_log_schema().simpleString()
    assert rows(parsed.select(F.xxhash64(*parsed.columns))) == rows(logs.select(F.xxhash64(*parsed.columns)))
