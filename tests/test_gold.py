from datetime import date, datetime, timedelta

import pytest
from conftest import column, plan, rows
from pyspark.sql import functions as F

from tidemart.operators import history, metrics
from tidemart.operators.sentiment import lexicon_scorer, score_sentiment
from tidemart.plans import gold_tables
from tidemart.plans.tables import Tables
from tidemart.sources.keyed import KeyedTable

NOW = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def reviews(spark):
    data = [(1, 10, 5), (2, 10, 4), (3, 10, 4), (None, 10, 1), (5, 20, 3), (6, 99, 5)]
    return spark.createDataFrame(data, "review_id long, product_id long, rating int")


def test_review_aggregate_counts_only_reviews_with_id(reviews):
    found = {r["product_id"]: r for r in rows(metrics.review_aggregate(reviews))}
    assert found[10]["total_reviews"] == 3 and found[10]["avg_rating"] == 3.5
    assert [found[10][f"star_{s}_count"] for s in (5, 4, 3, 2, 1)] == [1, 2, 0, 0, 1]


def test_five_star_share(reviews):
    shares = metrics.with_five_star_share(metrics.review_aggregate(reviews))
    found = {r["product_id"]: r["star_5_percentage"] for r in rows(shares)}
    assert found == {10: 33.33, 20: 0.0, 99: 100.0}


def test_share_of_no_reviews_is_null_not_an_error(spark):
    df = spark.createDataFrame([(None, 1, 5)], "review_id long, product_id long, rating int")
    assert column(metrics.with_five_star_share(metrics.review_aggregate(df)),
                  "star_5_percentage") == [None]


@pytest.fixture(scope="module")
def products(spark):
    data = [
        (10, "old", datetime(2024, 1, 1), 100), (10, "new", datetime(2024, 1, 3), 50),
        (20, "undated", None, 7), (20, "dated", datetime(2023, 1, 1), 8),
        (30, "tie b", datetime(2024, 1, 1), 1), (30, "tie a", datetime(2024, 1, 1), 2),
    ]
    return spark.createDataFrame(
        data, "product_id long, name string, scraped_at timestamp, price int"
    )


def test_latest_snapshot(products):
    latest = metrics.latest_snapshot(products)
    assert sorted(column(latest, "name")) == ["dated", "new", "tie a"]
    assert metrics.latest_snapshot(products.drop("scraped_at")).count() == 3


def test_metrics_keep_unreviewed_products_and_fill_them(products, reviews):
    built = metrics.product_metrics(products, reviews, F.lit(NOW))
    found = {r["product_id"]: r for r in rows(built)}
    assert set(found) == {10, 20, 30}
    assert found[30]["total_reviews"] == 0 and found[30]["avg_rating"] == 0.0
    assert found[30]["star_5_percentage"] == 0.0 and found[30]["star_1_count"] == 0
    assert found[10]["name"] == "new" and found[10]["gold_processed_at"] == NOW


def test_fill_tolerates_absent_metrics(spark):
    df = spark.createDataFrame([(1, None)], "product_id long, total_reviews long")
    assert column(metrics.fill_unreviewed(df), "total_reviews") == [0]


PRICES = [
    (1, datetime(2024, 1, 1, 23), 100_000), (1, datetime(2024, 1, 2, 1), 80_000),
    (1, datetime(2024, 1, 2, 1), 80_000), (1, datetime(2024, 1, 9), 80_000),
    (1, datetime(2024, 2, 1), 70_001), (1, datetime(2024, 2, 2), 50_000),
    (2, datetime(2024, 1, 1), 5),
]


@pytest.mark.parametrize("few_repeats", [False, True])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_price_history(spark, hot_rows, few_repeats):
    df = spark.createDataFrame(PRICES, "product_id long, scraped_at timestamp, price int")
    built = history.price_history(df, run_ts=F.lit(NOW), hot_rows=hot_rows,
                                  few_repeats=few_repeats)
    one = [r for r in built.orderBy("scraped_at").collect() if r.product_id == 1]
    assert [r.previous_price for r in one] == [None, 100_000, 80_000, 80_000, 70_001]
    assert [r.price_change_abs for r in one] == [None, -20_000, 0, -9_999, -20_001]
    assert [r.price_change_pct for r in one] == [None, -20.0, 0.0, -12.5, -28.57]
    assert [r.days_since_last_seen for r in one] == [None, 1, 7, 23, 1]
    assert [r.is_price_increased for r in one] == [None, False, False, False, False]
    assert [r.is_price_decreased for r in one] == [None, True, False, True, True]
    assert [r.is_discount_suspicious for r in one] == [False, True, False, False, True]
    assert one[0].scraped_date == date(2024, 1, 1)
    assert built.columns == [c for c in history.HISTORY_COLUMNS if c in built.columns]


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_both_ways_to_drop_repeats_agree(spark, hot_rows):
    at = datetime(2024, 1, 1)
    data = [(1, at, 5, "b"), (1, at, 5, "a"), (1, at, 4, "z"), (1, None, 3, "n"),
            (1, None, 2, "n"), (1, datetime(2024, 1, 2), 9, "c"), (2, None, 1, "only")]
    df = spark.createDataFrame(
        data, "product_id long, scraped_at timestamp, price int, name string")
    ways = [rows(history.price_history(df, run_ts=F.lit(NOW), hot_rows=hot_rows,
                                       few_repeats=few)) for few in (False, True)]
    assert ways[0] == ways[1] and len(ways[0]) == 4


def test_few_repeats_need_one_shuffle_of_the_table(spark, tmp_path):
    df = spark.createDataFrame(PRICES, "product_id long, scraped_at timestamp, price int")
    df.withColumn("name", F.lit("x")).write.parquet(f"{tmp_path}/p")
    built = history.price_history(spark.read.parquet(f"{tmp_path}/p"), few_repeats=True)
    wide = [line for line in plan(built).split("\n") if "FileScan" in line and "name" in line]
    before = plan(built).split("FileScan")[0]
    assert len(wide) == 2 and before.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_written_history_is_dealt_once(spark, tmp_path, hot_rows):
    """The same rows with and without a hot product; files do not overlap, no draft is left."""
    day = datetime(2024, 1, 1)
    data = [(p, datetime(2024, 1, 1 + i), 100 + 7 * i * p, f"n{i}") for p in range(40)
            for i in range(1 + p % 5)] + [(None, day, 5, "x"), (3, None, 9, "y"), (3, None, 8, "y")]
    df = spark.createDataFrame(
        data, "product_id long, scraped_at timestamp, price int, name string")
    path = f"{tmp_path}/h"
    gold_tables.write_history(df, path, F.lit(NOW), hot_rows=hot_rows)
    table = KeyedTable(spark, path)
    want = history.price_history(df, run_ts=F.lit(NOW), few_repeats=True)
    assert table.read().columns == want.columns and rows(table.read()) == rows(want)
    assert all(a[2] <= b[1] for a, b in zip(table.files, table.files[1:]))
    assert {f.name for f in tmp_path.iterdir() if not f.name.startswith(".")} == {"h"}
    assert table.near(7).filter("product_id = 7").count() == 3


def test_written_sentiments_are_scored_after_dealing(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, i % 3, "good" if i % 2 else None) for i in range(20)],
        "review_id long, product_id long, review_text string")
    scorer = lexicon_scorer(["good"], ["bad"])
    gold_tables.write_sentiments(df, f"{tmp_path}/s", scorer)
    assert rows(KeyedTable(spark, f"{tmp_path}/s").read()) == rows(score_sentiment(df, scorer))


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame(PRICES, "product_id long, scraped_at timestamp, price int")
    strict = history.price_history(df, drop_pct=-25, min_abs=20_001)
    assert strict.filter("is_discount_suspicious").count() == 1


def test_history_needs_times(spark):
    with pytest.raises(ValueError):
        history.price_history(spark.createDataFrame([(1, 2)], "product_id long, price int"))


def test_first_price_zero_has_no_percentage(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), 0), (1, datetime(2024, 1, 2), 9)],
        "product_id long, scraped_at timestamp, price int",
    )
    assert column(history.price_history(df), "price_change_pct") == [None, None]


def test_price_trends(spark):
    df = spark.createDataFrame(
        [(1, 3, date(2024, 1, 1), 10), (2, 3, date(2024, 1, 1), 20), (1, 4, date(2024, 1, 1), 1),
         (1, 3, date(2024, 1, 5), 30)],
        "product_id long, category_id long, scraped_date date, price int",
    )
    got = rows(history.price_trends(df, 3, "2024-01-01", "2024-01-04"))
    assert got == [{
        "category_id": 3, "scraped_date": date(2024, 1, 1), "avg_price": 15.0,
        "min_price": 10, "max_price": 20, "total_products": 2,
    }]


@pytest.fixture
def shop(spark, tmp_path):
    """A folder of test tables with a repeated snapshot and a repeated document."""
    line = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
            "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz")
    day = datetime(2024, 1, 1)
    lines = [(i, 1, i % 3, i % 2, 10.0, 100.0 + i, 0.1, day + timedelta(days=i // 9))
             for i in range(1, 41)]
    frames = {
        "lineitem": spark.createDataFrame(lines, line),
        "part": spark.createDataFrame(
            [(i, f"part {i}", "brand", 5) for i in range(3)],
            "p_partkey long, p_name string, p_brand string, p_size int"),
        "supplier": spark.createDataFrame([(0, 0), (1, 0)], "s_suppkey long, s_nationkey long"),
        "nation": spark.createDataFrame([(0, "N")], "n_nationkey long, n_name string"),
        "documents": spark.createDataFrame(
            [(1, "the cat"), (2, "der was"), (2, "a was"), (None, None), (None, "x"), (4, "the")],
            "doc_id long, text string"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


def test_silver_products_are_made_of_written_bronze(shop):
    listed = shop.listed_products()
    assert not [f for f in listed.inputFiles() if "lineitem" in f or "part.parquet" in f]
    assert rows(listed) == rows(shop.clean_products())


def test_sentiments_read_whole_are_not_dealt(shop, monkeypatch):
    monkeypatch.setattr("tidemart.plans.tables.gold_tables.write_sentiments", None)
    scored = shop.sentiments()
    monkeypatch.undo()
    want = rows(score_sentiment(shop.clean_texts(), shop.scorer()))
    assert len(want) == 4 and [r["review_id"] for r in rows(scored)] == [
        r["review_id"] for r in want]
    assert rows(scored) == rows(shop.sentiments_table().read()) == rows(shop.sentiments())
