from datetime import date

import pytest

from bucketlens.operators import periods as P
from helpers import rows

EXPECTED = {
    date(2024, 3, 15): ("2024/03/14", "2024/03/14", "2024/03/04", "2024/03/10", "2024/02/01", "2024/02/29", "2023/10/01", "2023/12/31"),
    date(2024, 3, 11): ("2024/03/10", "2024/03/10", "2024/03/04", "2024/03/10", "2024/02/01", "2024/02/29", "2023/10/01", "2023/12/31"),
    date(2024, 1, 1): ("2023/12/31", "2023/12/31", "2023/12/25", "2023/12/31", "2023/12/01", "2023/12/31", "2023/10/01", "2023/12/31"),
    date(2024, 3, 31): ("2024/03/30", "2024/03/30", "2024/03/18", "2024/03/24", "2024/02/01", "2024/02/29", "2023/10/01", "2023/12/31"),
    date(2024, 12, 31): ("2024/12/30", "2024/12/30", "2024/12/23", "2024/12/29", "2024/11/01", "2024/11/30", "2024/07/01", "2024/09/30"),
}


@pytest.mark.parametrize("index, frequency", list(enumerate(P.FREQUENCIES)))
def test_windows(spark, index, frequency):
    days = spark.createDataFrame([(d,) for d in EXPECTED], "d date")
    found = {r.d: (r.window_start, r.window_end) for r in P.period_window(days, "d", frequency).collect()}
    assert found == {d: texts[2 * index : 2 * index + 2] for d, texts in EXPECTED.items()}
    assert found == {d: P.window_of(frequency, d) for d in EXPECTED}


def test_window_of_one_run():
    assert P.window_of(custom=("2024-01-05", "2024-01-20")) == ("2024/01/05", "2024/01/20")
    assert P.window_of(today=date(2024, 3, 15)) == ("2024/02/01", "2024/02/29")
    with pytest.raises(ValueError):
        P.window_of("hourly", date(2024, 1, 1))
    with pytest.raises(ValueError):
        P.window_of(custom=("2024-01-20", "2024-01-05"))


def test_previous_months(spark):
    periods = spark.createDataFrame([(date(2024, 3, 17),)], "period_start date")
    found = P.previous_months(periods).select("age", "month_start", "month_end")
    assert rows(found) == [
        (1, date(2024, 2, 1), date(2024, 2, 29)),
        (2, date(2024, 1, 1), date(2024, 1, 31)),
        (3, date(2023, 12, 1), date(2023, 12, 31)),
        (4, date(2023, 11, 1), date(2023, 11, 30)),
        (5, date(2023, 10, 1), date(2023, 10, 31)),
    ]


def test_trend_has_one_row_per_period(spark):
    kinds = "period_start date, period_end date, total_files_downloads_count bigint, unique_users_overall bigint"
    current = spark.createDataFrame([(date(2024, 3, 1), date(2024, 3, 31), 9, 3)], kinds)
    history = spark.createDataFrame(
        [(date(2024, 2, 1), date(2024, 2, 29), 8, 2), (date(2023, 11, 1), date(2023, 11, 30), 5, 1),
         (date(2024, 2, 5), date(2024, 2, 11), 1, 1), (date(2023, 9, 1), date(2023, 9, 30), 4, 1)],
        kinds,
    )
    trend = P.usage_trend(current, history)
    assert [r.total_files_downloads_count for r in trend.orderBy("age").collect()] == [9, 8, None, None, 5, None]
