from datetime import datetime, timedelta

import pytest
from conftest import column, rows

from tidemart.operators import monitoring

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def requests(spark):
    data = [(at(1), "/a", "200", 0.5), (at(59), "/a", "500", 1.5), (at(60), "/a", "200", 4.0),
            (at(2), "/b", "404", None), (at(3), "/b", "5000", 1.0), (at(4), "/b", "45", 1.0)]
    return spark.createDataFrame(
        data, "ts timestamp, handler string, status string, duration double")


def by_key(df, value):
    return {(r["handler"], r["window_start"]): r[value] for r in rows(df)}


def test_request_rate(requests):
    got = by_key(monitoring.request_rate(requests), "per_second")
    assert got == {("/a", START): 0.033333, ("/a", at(60)): 0.016667, ("/b", START): 0.05}


def test_sliding_windows_cover_each_request_four_times(requests):
    sliding = monitoring.request_rate(requests, slide=monitoring.SCRAPE_INTERVAL)
    assert sum(column(sliding, "requests")) == 4 * requests.count()
    assert by_key(sliding, "requests")["/a", at(15)] == 2


def test_mean_duration_ignores_missing_ones(requests):
    got = by_key(monitoring.mean_duration(requests), "mean_duration")
    assert got["/a", START] == 1.0 and got["/b", START] == 1.0
    only_null = monitoring.mean_duration(requests.filter("duration is null"))
    assert column(only_null, "mean_duration") == [None]


def test_error_classes_match_the_whole_status(requests):
    assert by_key(monitoring.error_rate(requests, 5), "requests") == {("/a", START): 1}
    assert by_key(monitoring.error_rate(requests, 4), "requests") == {("/b", START): 1}


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_counter_reset_counts_the_new_value(spark, hot_rows):
    data = [("/a", "i1", at(15 * i), v) for i, v in enumerate([5, 9, 9, 2, 7])]
    data += [("/a", "i2", at(15 * i), v) for i, v in enumerate([0, 100])]
    df = spark.createDataFrame(data, "handler string, instance string, ts timestamp, value long")
    series = ["handler", "instance"]
    got = monitoring.counter_increase(df, series, hot_rows=hot_rows)
    one = got.filter("instance = 'i1'").orderBy("ts")
    assert column(one, "increase") == [None, 4, 0, 2, 5]
    rate = monitoring.counter_rate(df, series, hot_rows=hot_rows)
    assert by_key(rate, "increase") == {("/a", START): 106, ("/a", at(60)): 5}


def test_rate_of_a_first_sample_is_unknown(spark):
    df = spark.createDataFrame([("/a", START, 3)], "handler string, ts timestamp, value long")
    assert column(monitoring.counter_rate(df, ["handler"]), "per_second") == [None]


def test_rates_are_partial_sums(requests):
    shown = monitoring.request_rate(requests)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in shown
