"""Serving queries on a two-product fixture with exact values, and their edges."""

import pytest
from conftest import column, plan, rows
from pyspark.sql import functions as F

from tidemart.operators import serving
from tidemart.sources import keyed


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame(
        [("P001", "Test Product A", 100000, 4.5, 10, "Shop A", 5, 3, 1, 1, 0),
         ("P002", "Test Product B", 200000, 3.8, 5, "Shop B", 2, 1, 1, 0, 1)],
        "product_id string, name string, price long, avg_rating double, total_reviews long,"
        "shop_name string, star_5_count long, star_4_count long, star_3_count long,"
        "star_2_count long, star_1_count long",
    )


@pytest.fixture(scope="module")
def sentiments(spark):
    return spark.createDataFrame(
        [("R1", "P001", "Tốt lắm", 5, "positive", 1.0),
         ("R2", "P001", "Bình thường", 3, "neutral", 0.0)],
        "review_id string, product_id string, review_text string, rating long,"
        "sentiment_label string, sentiment_score double",
    )


def test_overview(metrics):
    got = rows(serving.get_overview(metrics))[0]
    assert got == {"total_products": 2, "avg_price": 150000.0, "avg_rating": 4.15,
                   "total_reviews": 15, "total_keywords": 0}


def test_overview_of_nothing_is_zero(metrics):
    got = rows(serving.get_overview(metrics, min_price=10 ** 9))[0]
    assert set(got.values()) == {0}


def test_paging(metrics):
    page = serving.list_products(metrics, page=1, page_size=1)
    assert column(page, "product_id") == ["P001"]
    assert column(serving.list_products(metrics, page=2, page_size=1), "product_id") == ["P002"]
    assert serving.list_products(metrics, page=3, page_size=1).count() == 0
    assert rows(serving.count_products(metrics, 1)) == [{"total": 2, "total_pages": 2}]
    none = serving.count_products(metrics, 1, search="zzz")
    assert rows(none) == [{"total": 0, "total_pages": 0}]


@pytest.mark.parametrize("options", [
    {"page": 0}, {"page_size": 0}, {"page_size": 101}, {"min_price": -1}, {"max_price": -1},
])
def test_invalid_parameters_are_refused(metrics, options):
    with pytest.raises(ValueError):
        serving.list_products(metrics, **options)


def test_search(metrics, spark):
    found = serving.list_products(metrics, search="Product A")
    assert column(found, "name") == ["Test Product A"]
    assert serving.list_products(metrics, search="product [ab]").count() == 2
    assert serving.search_names(metrics, "product [ab]", literal=True).count() == 0
    names = spark.createDataFrame([("ĐỒNG HỒ",), (None,)], "name string")
    assert column(serving.search_names(names, "đồng"), "name") == ["ĐỒNG HỒ"]


def test_lookup(metrics):
    assert column(serving.get_product_by_id(metrics, "P001"), "name") == ["Test Product A"]
    assert serving.get_product_by_id(metrics, "NONEXISTENT").count() == 0


def test_numeric_ids_compare_as_text_and_reach_the_scan(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "product_id").write.parquet(f"{tmp_path}/p")
    df = spark.read.parquet(f"{tmp_path}/p")
    assert column(serving.get_product_by_id(df, "17"), "product_id") == [17]
    for other in ("017", "17.0", "x", "", "-", str(2 ** 70), "٣"):
        assert serving.get_product_by_id(df, other).count() == 0
    assert "EqualTo(product_id,17)" in plan(serving.get_product_by_id(df, 17))


def test_top_products(metrics):
    assert column(serving.get_top_products(metrics, "avg_rating", 1), "product_id") == ["P001"]
    assert column(serving.get_top_products(metrics, "price", 1), "product_id") == ["P002"]
    assert column(serving.get_top_products(metrics, "nope", 1), "product_id") == ["P001"]
    with pytest.raises(ValueError):
        serving.get_top_products(metrics, limit=51)


def test_unreviewed_products_do_not_rank(spark):
    df = spark.createDataFrame([(1, 5.0, 0), (2, 1.0, 1)],
                               "product_id long, avg_rating double, total_reviews long")
    assert column(serving.get_top_products(df), "product_id") == [2]


def test_top_k_never_sorts_everything(metrics):
    assert "TakeOrderedAndProject" in plan(serving.get_top_products(metrics))
    assert "TakeOrderedAndProject" in plan(serving.list_products(metrics, page=3))


@pytest.mark.parametrize("direction, expected", [
    ("asc", [1, 2, 3]), ("desc", [2, 1, 3]), ("DESC", [2, 1, 3]), ("ASC", [1, 2, 3]),
    ("sideways", [2, 1, 3]),
])
def test_nulls_sort_last_both_ways(spark, direction, expected):
    df = spark.createDataFrame([(3, None), (1, 1), (2, 2)], "product_id long, v int")
    got = serving.list_products(df, sort_by="v", sort_order=direction)
    assert column(got, "product_id") == expected


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "Mug", 10.0), (2, "mug", 20.0), (3, "hat", 20.0), (4, None, 5.0)],
        "product_id long, keyword string, price double")
    assert column(serving.apply_filters(df, "MUG"), "product_id") == [1, 2]
    assert column(serving.apply_filters(df, min_price=10, max_price=20), "product_id") == [1, 2, 3]
    assert column(serving.apply_filters(df, "", 0), "product_id") == [1, 2, 3, 4]
    assert serving.apply_filters(df.drop("keyword"), "mug").count() == 4
    assert rows(serving.get_overview(df))[0]["total_keywords"] == 3


def test_keyword_stats(spark):
    df = spark.createDataFrame(
        [("mug", 10, 4.0, 2, 1, 1), ("mug", 21, 0.0, 0, 0, 0), ("hat", 5, 3.0, 1, 0, 1),
         (" ", 1, 1.0, 1, 1, 1), (None, 1, 1.0, 1, 1, 1)],
        "keyword string, price int, avg_rating double, total_reviews long,"
        "star_5_count long, star_1_count long")
    got = [r.asDict(recursive=True) for r in serving.get_keyword_stats(df).collect()]
    assert [r["keyword"] for r in got] == ["mug", "hat"]
    assert got[0]["avg_price"] == 16.0 and got[0]["avg_rating"] == 2.0
    assert got[0]["rating_distribution"] == {
        "star_1": 1, "star_2": 0, "star_3": 0, "star_4": 0, "star_5": 1, "total": 2}


def test_reviews_by_product(sentiments):
    got = serving.get_reviews_by_product(sentiments, "P001")
    assert got.count() == 2 and "sentiment_label" in got.columns
    renamed = sentiments.withColumnRenamed("product_id", "itemid")
    assert rows(serving.count_reviews_by_product(renamed, "P001")) == [
        {"product_id": "P001", "total": 2}]
    assert serving.get_reviews_by_product(sentiments.drop("product_id"), "P001").count() == 0


def test_sentiment_overview(sentiments, spark):
    got = rows(serving.get_sentiment_overview(sentiments))[0]
    assert (got["total"], got["positive"], got["neutral"], got["negative"]) == (2, 1, 1, 0)
    assert got["positive_pct"] == 50.0 and got["negative_pct"] == 0.0
    empty = rows(serving.get_sentiment_overview(sentiments.limit(0)))[0]
    assert set(empty.values()) == {0}
    unlabelled = rows(serving.get_sentiment_overview(spark.range(3)))[0]
    assert unlabelled == {"positive": 0, "negative": 0, "neutral": 0, "total": 0}


def test_rating_distribution(metrics):
    got = rows(serving.get_rating_distribution(metrics))[0]
    assert got == {"star_1": 1, "star_2": 1, "star_3": 2, "star_4": 4, "star_5": 7, "total": 15}
    partial = rows(serving.get_rating_distribution(metrics.drop("star_4_count")))[0]
    assert partial["star_4"] == 0 and partial["total"] == 11


def test_volatility(spark):
    df = spark.createDataFrame(
        [(1, 5.0, False), (2, -30.0, True), (3, None, False), (4, 30.0, False)],
        "product_id long, price_change_pct double, is_discount_suspicious boolean")
    assert column(serving.price_volatility(df), "product_id") == [2, 4, 1]
    assert column(serving.price_volatility(df, 1), "product_id") == [2]
    assert column(serving.price_volatility(df, suspicious_only=True), "product_id") == [2]


@pytest.mark.parametrize("sort_by, sort_order", [
    ("price", "desc"), ("price", "asc"), ("unknown", "asc"), ("product_id", "desc")])
def test_pages_after_a_row_equal_numbered_pages(spark, sort_by, sort_order):
    df = spark.createDataFrame(
        [(i, f"p{i}", None if i % 5 == 0 else i * 7 % 4) for i in range(23)] + [(None, "x", 2)],
        "product_id long, name string, price long")
    last, page, seen = None, 1, 0
    while True:
        want = serving.list_products(
            df, page=page, page_size=4, sort_by=sort_by, sort_order=sort_order).collect()
        if last is not None:
            got = serving.products_after(df, last, 4, sort_by, sort_order).collect()
            assert got == want
        if not want:
            break
        last, page, seen = want[-1].asDict(), page + 1, seen + len(want)
    assert seen == 24


def test_lookup_opens_the_files_of_its_key_only(spark, tmp_path):
    """Files in narrow ranges; a key with very many rows is spread, a missing one opens none."""
    rows_in = spark.range(4000).select(
        F.when(F.col("id") < 1500, 77).when(F.col("id") < 1510, None).otherwise(
            F.col("id") % 500 * 2).cast("long").alias("product_id"),
        F.col("id").alias("n"), F.lit("x" * 50).alias("text"))
    path, small = f"{tmp_path}/t", {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                                    "spark.sql.shuffle.partitions": "16"}
    old = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        for _ in range(2):  # the second one replaces the first
            keyed.write_keyed(rows_in, path)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    table = keyed.KeyedTable(spark, path)
    assert len(table.files) >= 8 and table.read().count() == 4000
    assert len(table.near("700").inputFiles()) == 1 and len(table.files_of(77)) >= 3
    for key in ("0", "700", "77", "998", "78"):
        want = rows(rows_in.filter(F.col("product_id") == int(key)))
        assert rows(serving.get_reviews_by_product(table.near(key), key)) == want
    for key in ("701", "1000", "-1", "x", "07", ""):
        assert serving.get_reviews_by_product(table.near(key), key).count() == 0
    assert table.files_of("1000") == table.files_of("x") == []
    keyed.write_keyed(rows_in.limit(0), path)
    assert keyed.KeyedTable(spark, path).near(5).count() == 0


@pytest.mark.parametrize("sort_by, direction", [
    ("price", "asc"), ("price", "desc"), ("same", "desc"), ("scraped_at", "asc"), ("none", "asc")])
def test_deep_page_equals_offset(spark, monkeypatch, sort_by, direction):
    monkeypatch.setattr(serving, "DEEP_OFFSET", 40)
    monkeypatch.setattr(serving, "RANGES", 5)
    whole = spark.range(1, 1500).select(
        F.when(F.col("id") % 9 > 0, F.col("id") * 7919 % 700).alias("product_id"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 31 % 13).alias("price"), F.lit(1).alias("same"),
        F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.col("id") * 17 % 997)).alias(
            "scraped_at"))
    order = serving.ordering(whole, sort_by, direction)
    names = ["same", "product_id", "scraped_at", *([sort_by] if sort_by != "none" else [])]
    every = [tuple(r) for r in whole.orderBy(*order).select(*names).collect()]
    for page in (6, 30, 75, 76):
        got = serving.list_products(whole, page, 20, sort_by=sort_by, sort_order=direction)
        assert [tuple(r) for r in got.select(*names).collect()] == every[
            (page - 1) * 20:page * 20]
    skipped = serving._narrowed(whole, 600, 20, sort_by, direction)
    assert skipped[0].count() < 400 and skipped[1] > 300
