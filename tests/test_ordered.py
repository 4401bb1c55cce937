"""Hot-key order operators against plain windows and brute force."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators import ordered
from tidemart.operators.ordered import (
    any_hot, drop_listed_repeats, drop_repeats, keep_first, previous_values, repeated_keys,
)
from tidemart.plans.derived import running_count


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; times are unique per key, one row has none."""
    random.seed(5)
    start = datetime(2024, 1, 1)
    data = []
    for key, n in [("hot", 400), ("warm", 40), ("cold", 3), ("single", 1)]:
        seconds = random.sample(range(40_000), n)
        data += [(key, start + timedelta(seconds=s), random.randrange(1000)) for s in seconds]
    data.append(("hot", None, 7))
    data.append(("cold", start + timedelta(days=9), None))
    return spark.createDataFrame(data, "k string, at timestamp, v int")


@pytest.mark.parametrize("hot_rows", [2, 100, 10_000])
@pytest.mark.parametrize("minutes", [1, 60])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_previous_values_equals_plain_lag(skewed, hot_rows, minutes, kind):
    skewed = skewed.withColumn("at", F.col("at").cast(kind))
    w = Window.partitionBy("k").orderBy("at")
    plain = skewed.withColumns({"pv": F.lag("v").over(w), "pat": F.lag("at").over(w)})
    ours = previous_values(
        skewed, ["k"], "at", {"pv": "v", "pat": "at"}, hot_rows=hot_rows, minutes=minutes
    )
    assert ours.columns == ["k", "at", "v", "pv", "pat"]
    assert rows(ours) == rows(plain)


def test_null_key_is_split_like_any_other(spark, skewed):
    """A third of the rows have no key; they are lagged together, in chunks."""
    start = datetime(2024, 1, 1)
    more = spark.createDataFrame(
        [(None, start + timedelta(seconds=97 * i), i % 13) for i in range(300)]
        + [(None, None, 5)], skewed.schema)
    both = skewed.unionByName(more)
    w = Window.partitionBy("k").orderBy("at")
    plain = both.withColumns({"pv": F.lag("v").over(w), "pat": F.lag("at").over(w)})
    ours = previous_values(both, ["k"], "at", {"pv": "v", "pat": "at"}, hot_rows=100, minutes=1)
    assert ours.columns == plain.columns and rows(ours) == rows(plain)
    marked, only_hot = ordered.split_hot(both, ["k"], "at", ordered._as_is, 100, 1)
    assert {r.k for r in only_hot.select("k").collect()} == {"hot", None}
    assert marked.groupBy("k", "__chunk").count().agg(F.max("count")).first()[0] <= 40


@pytest.mark.parametrize("hot_rows", [2, 10_000])
def test_running_count_equals_row_number(skewed, hot_rows):
    w = Window.partitionBy("k").orderBy("at", "v")
    plain = skewed.withColumn("n", F.row_number().over(w).cast("bigint"))
    ours = running_count(skewed, ["k"], "at", ["v"], "n", hot_rows=hot_rows)
    assert rows(ours.withColumn("n", F.col("n").cast("bigint"))) == rows(plain)


def test_no_hot_key_in_one_window_group(skewed):
    """With a low threshold the hot key's rows spread over many chunks."""
    marked, only_hot = ordered.split_hot(skewed, ["k"], "at", ordered._as_is, 100, 1)
    assert {r.k for r in only_hot.select("k").collect()} == {"hot"}
    largest = marked.groupBy("k", "__chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 40


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_clock_changes_do_not_reorder(spark, kind):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # Across the missing and the repeated hour of the zone.
        start = ["2024-03-31 00:30:00", "2024-10-26 23:30:00"]
        df = spark.createDataFrame([(s,) for s in start], "s string").selectExpr(
            "1 as k", "explode(transform(sequence(0, 20), i -> dateadd(minute, 11 * i, "
            f"cast(s as {kind})))) as at")
        df = df.withColumn("v", F.col("at").cast("string"))
        plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("at")))
        ours = previous_values(df, ["k"], "at", {"p": "v"}, hot_rows=1, minutes=30)
        assert rows(ours.drop("at")) == rows(plain.drop("at"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_number_of_hot_keys_is_bounded(skewed, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_HOT_KEYS", 3)
    assert [r.k for r in ordered._hot_keys(skewed, ["k"], 1).collect()] == ["hot"]


def test_drop_repeats_is_deterministic_and_total(spark):
    data = [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 1.0), (2, None, 5.0), (2, "z", 4.0)]
    expected = [{"k": 1, "s": "a", "x": 1.0}, {"k": 2, "s": None, "x": 5.0}]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, s string, x double").repartition(3)
        assert rows(drop_repeats(df, ["k"])) == expected


def test_drop_repeats_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k int, v int")
    assert rows(drop_repeats(df, ["k"])) == [{"k": 3, "v": 3}, {"k": None, "v": 1}]


def test_drop_repeats_skips_unordered_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1})], "k int, m map<string,int>")
    assert drop_repeats(df, ["k"]).count() == 1


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    kept = keep_first(df, ["k"], [F.desc("id")], 2)
    assert plan(kept).count("WindowGroupLimit") == 2
    assert sorted(r.id for r in kept.collect()) == [94, 95, 96, 97, 98, 99]


def test_listed_repeats_leave_other_rows_where_they_are(spark):
    data = [(1, 5, "a"), (1, 5, "b"), (1, 6, "c"), (None, 5, "e"), (None, 5, "d"),
            (None, None, "f"), (None, None, "f"), (2, None, "g")]
    df = spark.createDataFrame(data, "k long, at int, v string")
    repeated = repeated_keys(df, ["k", "at"])
    assert rows(repeated) == rows(spark.createDataFrame(
        [(1, 5), (None, 5), (None, None)], "k long, at int"))
    ours = drop_listed_repeats(df, ["k", "at"], repeated.localCheckpoint())
    assert plan(ours).count("Exchange hashpartitioning") == 1  # of the repeats alone
    assert rows(ours) == rows(drop_repeats(df, ["k", "at"]))


def test_rows_dealt_by_key_need_no_shuffle_when_no_key_is_hot(spark, skewed):
    assert any_hot(skewed, ["k"], 100) and not any_hot(skewed, ["k"], 1000)
    dealt = skewed.repartitionByRange("k")
    ours = previous_values(dealt, ["k"], "at", {"pv": "v"}, hot_rows=None)
    assert "hashpartitioning" not in plan(ours)
    assert rows(ours) == rows(previous_values(skewed, ["k"], "at", {"pv": "v"}))
