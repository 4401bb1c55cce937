from datetime import datetime

import pytest
from conftest import column, plan, rows
from pyspark.sql import functions as F

from tidemart.operators import cleansing, quality


def test_products_are_keyed_by_id_and_time(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", 5.0), (1, "2024-01-01", 4.0), (1, "2024-01-02", 3.0)],
        "product_id long, scraped_at string, price double",
    )
    assert sorted(column(cleansing.dedup_products(df), "price")) == [3.0, 4.0]
    assert column(cleansing.dedup_products(df.drop("scraped_at")), "price") == [3.0]


@pytest.mark.parametrize("value, expected", [
    (12.9, 12), (-12.9, -12), (None, None), (3e9, 3_000_000_000), (1e30, None),
    (float("nan"), None),
])
def test_price_truncates_and_never_raises(spark, value, expected):
    df = spark.createDataFrame([(1, value)], "product_id long, price double")
    assert column(cleansing.type_products(df), "price") == [expected]


def test_text_price_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("x",), ("17",)], "price string")
    assert column(cleansing.type_products(df), "price") == [None, 17]


def test_discount_default_only_with_the_column(spark):
    df = spark.createDataFrame([(None,), ("5%",)], "discount string")
    assert column(cleansing.type_products(df), "discount") == ["0%", "5%"]
    assert "discount" not in cleansing.type_products(spark.range(1)).columns


def test_bad_times_become_null(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05.123456",), ("soon",), (None,)], "scraped_at string"
    )
    assert column(cleansing.type_products(df), "scraped_at") == [
        datetime(2024, 1, 2, 3, 4, 5, 123456), None, None,
    ]


def test_newlines_collapse_to_one_blank(spark):
    df = spark.createDataFrame([("a\r\n\n b\nc",), (None,)], "review_text string")
    assert column(cleansing.type_reviews(df), "review_text") == ["a  b c", None]


def test_run_time_is_a_parameter(spark):
    stamped = cleansing.clean_reviews(
        spark.createDataFrame([(1,)], "review_id long"), F.lit(datetime(2024, 1, 1))
    )
    assert column(stamped, "processed_at") == [datetime(2024, 1, 1)]


PRODUCTS = [
    (1, "ok", 10, 4.0), (2, "no rating", 10, None), (3, "   ", 10, 4.0), (4, None, 10, 4.0),
    (5, "free", 0, 4.0), (6, "no price", None, 4.0), (7, "odd", 10, 5.1),
    (8, "low", 10, -0.1), (9, "nan", 10, float("nan")), (None, "", -1, 9.0), (11, "\t", 10, 0.0),
]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        PRODUCTS, "product_id long, name string, price int, rating double"
    )


def test_product_gate(products):
    gate = quality.product_gate(products)
    # Only blanks count as an empty name: a tab passes.
    assert sorted(column(gate.valid, "product_id")) == [1, 2, 11]
    report = rows(gate.report)[0]
    assert report == {
        "entity": "products", "input_rows": 11, "valid_rows": 3, "rejected_rows": 8,
        "invalid_price": 3, "missing_product_id": 1, "missing_name": 3, "invalid_rating": 4,
    }
    reasons = sorted((r.reason, r.product_id or 0) for r in gate.rejected.collect())
    assert reasons == sorted([
        ("invalid_price", 5), ("invalid_price", 6), ("invalid_price", 0),
        ("missing_product_id", 0), ("missing_name", 3), ("missing_name", 4),
        ("missing_name", 0), ("invalid_rating", 7), ("invalid_rating", 8),
        ("invalid_rating", 9), ("invalid_rating", 0),
    ])


@pytest.mark.parametrize("absent, reason", [
    ("name", "missing_name"), ("price", "invalid_price"), ("product_id", "missing_product_id"),
])
def test_absent_required_column_rejects_everything(products, absent, reason):
    gate = quality.product_gate(products.drop(absent))
    assert gate.valid.count() == 0
    assert gate.valid.columns == [c for c in products.columns if c != absent]
    assert rows(gate.report)[0][reason] == 11


def test_absent_rating_rejects_nothing(products):
    assert rows(quality.product_gate(products.drop("rating")).report)[0]["invalid_rating"] == 0


def test_review_gate_keeps_reviews_without_text(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, "good"), (2, 1, 3, " "), (3, 1, 0, "x"), (4, 1, None, None),
         (None, 1, 5, "x"), (6, None, 5, "x")],
        "review_id long, product_id long, rating int, review_text string",
    )
    gate = quality.review_gate(df)
    assert sorted(column(gate.valid, "review_id")) == [1, 2]
    assert rows(gate.report)[0] == {
        "entity": "reviews", "input_rows": 6, "valid_rows": 2, "rejected_rows": 4,
        "missing_review_id": 1, "missing_product_id": 1, "invalid_rating": 2,
        "missing_text": 2,
    }
    no_text = rows(quality.review_gate(df.drop("review_text")).report)[0]
    assert no_text["missing_text"] == 6 and no_text["valid_rows"] == 2
    assert quality.review_gate(df.drop("rating")).valid.count() == 0


def test_empty_input_reports_zeros(products):
    report = rows(quality.product_gate(products.limit(0)).report)[0]
    assert report["input_rows"] == 0 and report["rejected_rows"] == 0


def test_report_is_one_pass_without_shuffled_rows(products):
    shown = plan(quality.product_gate(products).report)
    assert shown.count("Exchange") == 1 and "SinglePartition" in shown
