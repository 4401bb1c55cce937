import pytest
from conftest import column, rows
from pyspark.sql import functions as F

from tidemart.operators import dashboard, serving


def test_price_buckets_overlap_at_their_bounds(spark):
    df = spark.createDataFrame([(50_000,), (100_000,), (500_000,), (900_000,), (None,)],
                               "price int")
    got = {r["bucket"]: r["products"] for r in rows(dashboard.price_bucket_counts(df))}
    assert got == {"all": 5, "under_100k": 2, "100k_500k": 2, "over_500k": 2}
    for bucket, expected in got.items():
        assert dashboard.in_price_bucket(df, bucket).count() == expected
    assert dashboard.in_price_bucket(df, "unknown").count() == 5


def test_star_filter_rounds_halves_up(spark):
    df = spark.createDataFrame(
        [(1, 2.5), (2, 3.4), (3, 3.5), (4, None)], "id int, avg_rating double")
    order = [F.col("id")]
    assert column(dashboard.with_star(df, 3, order), "id") == [1, 2]
    assert column(dashboard.with_star(df, None, order, k=2), "id") == [1, 2]


def test_scatter_drops_null_and_zero(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0, 1), ("b", 0, 1.0, 1), ("c", 1, None, 1), ("d", 1, 1.0, 0)],
        "name string, price int, avg_rating double, total_reviews long")
    assert column(dashboard.scatter_points(df), "name") == ["a"]


@pytest.mark.parametrize("reviews, products, expected", [(15, 2, 8), (0, 0, 0), (None, 3, 0)])
def test_reviews_per_product(spark, reviews, products, expected):
    df = spark.createDataFrame([(reviews, products)], "total_reviews long, total_products long")
    assert column(dashboard.reviews_per_product(df), "reviews_per_product") == [expected]


def test_topic_bars(spark):
    df = spark.createDataFrame([("a", 8), ("b", 3), ("c", 0)], "topic string, count long")
    assert sorted(column(dashboard.topic_bars(df), "share_pct")) == [0, 38, 100]


def test_keyword_bars_are_relative_to_the_keyword(spark):
    df = spark.createDataFrame([("k", 4, 1), ("z", 0, 0)],
                               "keyword string, star_5_count long, star_1_count long")
    bars = rows(dashboard.keyword_star_bars(serving.get_keyword_stats(df)))
    got = {(r["keyword"], r["star"]): r["share_pct"] for r in bars}
    assert got["k", 5] == 100.0 and got["k", 1] == 25.0 and got["z", 3] == 0.0
    assert len(got) == 10


def test_sentiment_slices_drop_zero(spark):
    df = spark.createDataFrame([(2, 0, 1, 3)],
                               "positive long, negative long, neutral long, total long")
    got = {r["label"]: r["share_pct"] for r in rows(dashboard.sentiment_slices(df))}
    assert got == {"positive": 66.7, "neutral": 33.3}


@pytest.mark.parametrize("name, shown", [
    ("x" * 22, "x" * 22), ("x" * 23, "x" * 22 + "…"), (None, ""),
])
def test_short_name(spark, name, shown):
    df = spark.createDataFrame([(name,)], "n string")
    assert column(df.select(dashboard.short_name(F.col("n")).alias("s")), "s") == [shown]


def test_chosen_keywords(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "keyword string")
    assert column(dashboard.chosen_keywords(df, ["b", "z"]), "keyword") == ["b", "b"]
    assert dashboard.chosen_keywords(df, []).count() == 0
    wanted = spark.createDataFrame([("b",), ("b",)], "keyword string")
    assert column(dashboard.chosen_keywords(df, wanted), "keyword") == ["b", "b"]


def test_star_share_without_reviews(spark):
    df = spark.createDataFrame(
        [(1, 3, 1, 2, 0, 0, 0), (2, None, None, None, 0, 0, 0), (3, 0, 0, 0, 0, 0, 0)],
        "product_id long, total_reviews long, star_5_count long, star_4_count long,"
        "star_3_count long, star_2_count long, star_1_count long")
    got = {(r["product_id"], r["star"]): r["share_pct"]
           for r in rows(dashboard.product_star_share(df))}
    assert got[1, 5] == 33 and got[1, 4] == 67 and got[2, 5] == 0 and got[3, 1] == 0
    assert len(got) == 15


def test_position_continues_over_pages(spark):
    page = spark.createDataFrame([("b",), ("a",)], "name string")
    numbered = dashboard.with_position(page, 3, [F.col("name")])
    assert {r["name"]: r["position"] for r in rows(numbered)} == {"a": 31, "b": 32}


def test_review_display_falls_through_empty_values(spark):
    df = spark.createDataFrame(
        [(1, "", "u1", 0, 3, "", "c1", "", "2024-01-01"),
         (2, "n2", "u2", 5, 3, "t2", "c2", "2023-01-01", "2024-01-01"),
         (3, None, "", None, 0, None, "", None, None)],
        "review_id long, author_name string, username string, rating_star int, rating int,"
        "review_text string, comment string, created_at string, review_time string")
    got = rows(dashboard.review_display(df))
    assert [tuple(r.values()) for r in got] == [
        (1, "u1", 3, "c1", "2024-01-01"), (2, "n2", 5, "t2", "2023-01-01"),
        (3, "Ẩn danh", 0, "", None)]


def test_review_display_tolerates_missing_columns(spark):
    df = spark.createDataFrame([(1, "hey")], "review_id long, comment string")
    assert rows(dashboard.review_display(df)) == [
        {"review_id": 1, "author": "Ẩn danh", "rating": None, "text": "hey", "date": None}]
    only_star = spark.createDataFrame([(0,)], "rating_star int")
    assert column(dashboard.review_display(only_star), "rating") == [None]


@pytest.mark.parametrize("pct, suspicious, label, warning", [
    (12.34, True, "+12.3%", "Sale ảo"), (-12.34, False, "-12.3%", "Bình thường"),
    (None, None, "0.0%", "Bình thường"), (0.0, False, "0.0%", "Bình thường"),
    (-0.01, False, "-0.0%", "Bình thường"),
])
def test_price_move_labels(spark, pct, suspicious, label, warning):
    df = spark.createDataFrame([(pct, suspicious)],
                               "price_change_pct double, is_discount_suspicious boolean")
    got = rows(dashboard.price_move_labels(df))[0]
    assert (got["change_label"], got["warning_label"]) == (label, warning)
