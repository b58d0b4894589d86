import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from bucketlens.functions import requests as R
from bucketlens.functions import text as X


def evaluate(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


KEYS = {
    "ISO3/NPL/roads/lines/hot_npl_roads_lines_geojson.zip": ("ISO3", "NPL", "roads", "geojson"),
    "TM/project_12/roads": ("TM", "project_12", "roads", "Other"),
    "a.b/c": ("a.b", "c", "NA", "NA"),
    "file.txt": ("file.txt", "NA", "NA", "NA"),
    "x_y/z.zip": ("x_y", "z.zip", "NA", "Other"),
    "a_b.c/d": ("a_b.c", "d", "NA", "b"),
    "a_": ("a_", "NA", "NA", ""),
    "a/b": ("a", "b", "NA", "Other"),
    "/x": ("", "x", "NA", "Other"),
    "a//b_c": ("a", "", "b_c", "c"),
}


@pytest.mark.parametrize("index, function", list(enumerate([R.top_level_key, R.project, R.feature, R.file_format])))
def test_key_parts(spark, index, function):
    assert evaluate(spark, function, list(KEYS)) == [v[index] for v in KEYS.values()]


REFERRERS = {
    '"https://a.org/x"': "a.org",
    '"http://u:p@H.org:80/z"': "u:p@H.org:80",
    "//foo/x": "foo",
    "www.foo.com/x": None,
    "-": None,
    '"-"': None,
    None: None,
    "mailto:a@b": None,
    '"https:///x"': None,
    "1ab://h/x": None,
    "https://a|b.org/x y": "a|b.org",
    " https://blank.org": "blank.org",
    '""https://q.org?x=1""': "q.org",
    "https://f.org#top": "f.org",
    "ht\ttps:/\t/tab.org/x": "tab.org",
    "": None,
}


def test_referrer_host(spark):
    expected = [host or "Direct or N/A" for host in REFERRERS.values()]
    assert evaluate(spark, R.referrer_host, list(REFERRERS)) == expected


def test_method(spark):
    given = ["REST.GET.OBJECT", "BATCH.DELETE.OBJECT", "LEGACYOP", "A.", ".B", None]
    assert evaluate(spark, R.method, given) == ["GET", "DELETE", "LEGACYOP", "", "B", None]


def test_request_classes_of_a_missing_method(spark):
    given = ["GET", "HEAD", "PUT", "POST", "DELETE", None, "get"]
    assert evaluate(spark, R.is_interaction, given) == [True, True, False, False, False, True, True]
    assert evaluate(spark, R.is_download, given) == [True, False, False, False, False, False, False]
    assert evaluate(spark, R.is_upload, given) == [False, False, True, True, False, False, False]


def test_request_time(spark):
    given = ["06/Feb/2024:00:00:38 +0000", "06/Feb/2024:00:00:38 +0200"]
    times = evaluate(spark, lambda c: F.unix_timestamp(R.request_time(c)), given)
    midnight = datetime(2024, 2, 6, 0, 0, 38, tzinfo=timezone.utc).timestamp()
    assert times == [midnight, midnight - 7200]
    assert evaluate(spark, lambda c: R.request_time(c, lenient=True), ["bad", None]) == [None, None]
    with pytest.raises(Exception):
        evaluate(spark, R.request_time, ["bad"])


def test_byte_count(spark):
    assert evaluate(spark, R.byte_count, ["12", "-", "", None, "1x", "0"]) == [12, 0, 0, 0, 0, 0]


def test_meta_pattern_is_a_pattern(spark):
    assert evaluate(spark, R.is_meta_file, ["a/meta.json", "metaXjson/b", "meta", "x"]) == [True, True, False, False]


def test_sections_of_folders(spark):
    folders = ["TM", "default", "logs", "log2024", "Log", "athena", "TEST-OBJECT", "FAVICON.ICO"]
    assert evaluate(spark, R.has_section, folders) == [True, True, False, False, True, False, False, True]
    assert evaluate(spark, R.has_components, folders) == [True, False, True, True, True, False, False, False]


def python_size(size):
    """The rule in Python's own arithmetic: one decimal of the double quotient."""
    if size == 1:
        return "1 Byte"
    if size < 1000:
        return f"{size} Bytes"
    suffixes = ["kB", "MB", "GB", "TB", "PB", "EB"]
    power = 1
    while power < 6 and size >= 1000 ** (power + 1):
        power += 1
    return f"{size / 1000**power:.1f} {suffixes[power - 1]}"


def test_size_text(spark):
    fixed = [0, 1, 2, 999, 1000, 1049, 1050, 1051, 999949, 999950, 10**6, 10**9, 3400000000, 10**18, 2**62]
    halves = [(2 * t + 1) * unit // 20 for unit in (10**3, 10**6, 10**9, 10**12) for t in range(10, 9999, 7)]
    generator = random.Random(7)
    anywhere = [generator.randrange(10 ** generator.randrange(1, 16)) for _ in range(2000)]
    sizes = fixed + halves + anywhere
    assert evaluate(spark, X.size_text, sizes, "bigint") == [python_size(s) for s in sizes]


def test_grouped_digits(spark):
    assert evaluate(spark, X.grouped_digits, [0, 999, 1000, 1234567], "bigint") == ["0", "999", "1,000", "1,234,567"]
