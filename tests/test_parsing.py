import json
from datetime import datetime

import pytest
from conftest import SF, column, plan, rows
from pyspark.sql import functions as F

from tidemart.operators import parsing
from tidemart.plans.catalog import REGISTRY

SEARCH = "https://host/api/v4/search_items?x=1"
RATINGS = "https://host/api/v2/get_ratings?x=1"
RUN = "2024-01-02T03:04:05"

ITEM = {
    "itemid": 7, "shopid": 8, "name": "Red mug", "price": 2_500_000_000,
    "price_before_discount": 5_000_000_000, "catid": 3, "shop_location": "Hue",
    "item_rating": {"rating_star": 4.5}, "cmt_count": 2, "historical_sold": 9,
    "liked_count": 1, "stock": 5, "image": "abc",
}


def search(spark, *items, url=SEARCH, status=200, keyword="mug"):
    body = json.dumps({"items": list(items)})
    return spark.createDataFrame(
        [(url, status, body, keyword)], "url string, status int, body string, keyword string"
    )


def products(spark, *items, **options):
    return parsing.parse_products(search(spark, *items, **options), F.lit(RUN))


def one(df):
    found = rows(df)
    assert len(found) == 1
    return found[0]


def test_product_fields(spark):
    got = one(products(spark, {"item_basic": ITEM}))
    assert got["product_id"] == 7 and got["shop_id"] == 8 and got["category_id"] == 3
    assert got["price"] == 25_000.0 and got["original_price"] == 50_000.0
    assert got["discount_pct"] == 50.0
    assert got["image_url"] == "https://cf.shopee.vn/file/abc"
    assert got["url"] == "https://shopee.vn/Red-mug-i.8.7"
    assert (got["currency"], got["platform"], got["scraped_at"]) == ("VND", "shopee", RUN)
    assert got["keyword"] == "mug" and got["violations"] == []


def test_flat_item_equals_nested_item(spark):
    assert rows(products(spark, ITEM)) == rows(products(spark, {"item_basic": ITEM}))


def test_only_successful_search_responses_count(spark):
    assert products(spark, ITEM, status=403).count() == 0
    assert products(spark, ITEM, url=RATINGS).count() == 0
    broken = search(spark, ITEM).withColumn("body", F.lit("<html>"))
    assert parsing.parse_products(broken, F.lit(RUN)).count() == 0
    assert products(spark).count() == 0


@pytest.mark.parametrize("sent, shown", [
    (1_000_000, 1_000_000.0), (1_000_001, 10.00001), (999, 999.0),
])
def test_price_is_rescaled_only_above_the_threshold(spark, sent, shown):
    assert one(products(spark, {**ITEM, "price": sent}))["price"] == shown


@pytest.mark.parametrize("price, original, expected", [
    (200, 300, 33.3), (300, 300, None), (300, 200, None), (300, 0, None), (300, None, None),
])
def test_discount(spark, price, original, expected):
    item = {**ITEM, "price": price, "price_before_discount": original}
    assert one(products(spark, item))["discount_pct"] == expected


def test_missing_fields_take_defaults(spark):
    got = one(products(spark, {"itemid": 1, "name": "x", "price": 5}))
    assert got["violations"] == []
    assert got["shop_id"] == 0 and got["review_count"] == 0 and got["stock"] == 0
    assert got["rating"] is None and got["image_url"] is None and got["original_price"] is None


@pytest.mark.parametrize("change, reason", [
    ({"name": ""}, "name"), ({"name": "x" * 1001}, "name"), ({"price": 0}, "price"),
    ({"price": -1}, "price"), ({"price_before_discount": -1}, "original_price"),
    ({"item_rating": {"rating_star": 5.1}}, "rating"), ({"cmt_count": -1}, "review_count"),
    ({"historical_sold": -2}, "sold_count"), ({"liked_count": -2}, "liked_count"),
    ({"stock": -2}, "stock"), ({"cmt_count": None}, "review_count"),
    ({"price": None}, "price"),
])
def test_constraint_violations(spark, change, reason):
    parsed = products(spark, {**ITEM, **change}, ITEM)
    assert sorted(map(tuple, column(parsed, "violations"))) == [(), (reason,)]
    assert parsing.accepted(parsed).count() == 1
    assert column(parsing.skipped(parsed), "violations") == [[reason]]


def test_long_names_within_the_limit_pass(spark):
    assert one(products(spark, {**ITEM, "name": "x" * 1000}))["violations"] == []


def test_rating_info_of_another_type_is_no_rating(spark):
    assert one(products(spark, {**ITEM, "item_rating": "n/a"}))["rating"] is None


def reviews(spark, *ratings, url=RATINGS, status=200):
    body = json.dumps({"data": {"ratings": list(ratings)}})
    df = spark.createDataFrame(
        [(url, status, body, 7, 8)],
        "url string, status int, body string, product_id long, shop_id long",
    )
    return parsing.parse_reviews(df, F.lit(RUN))


def test_review_fields(spark):
    got = one(reviews(spark, {
        "cmtid": 5, "rating_star": 4, "comment": "ok", "author_username": "u",
        "images": ["a", 3, None, "b"], "like_count": 2, "ctime": 1_700_000_000,
        "videos": [{"url": "v1"}, {"url": ""}, "text", {}, {"url": "v2"}],
    }))
    assert got["review_id"] == 5 and got["product_id"] == 7 and got["shop_id"] == 8
    assert got["images"] == ["https://cf.shopee.vn/file/a", "https://cf.shopee.vn/file/b"]
    assert got["videos"] == ["v1", "v2"]
    assert got["created_at"] == datetime(2023, 11, 14, 22, 13, 20)
    assert got["platform"] == "shopee" and got["scraped_at"] == RUN
    assert got["violations"] == []


def test_review_defaults(spark):
    got = one(reviews(spark, {"cmtid": 5}))
    assert got["rating"] == 5 and got["review_text"] == "" and got["like_count"] == 0
    assert got["images"] == [] and got["videos"] == [] and got["created_at"] is None


@pytest.mark.parametrize("change, reason", [
    ({"rating_star": 0}, "rating"), ({"rating_star": 6}, "rating"),
    ({"rating_star": None}, "rating"), ({"like_count": -1}, "like_count"),
])
def test_review_violations(spark, change, reason):
    assert one(reviews(spark, {"cmtid": 5, **change}))["violations"] == [reason]


def test_cap_per_key_and_rows(spark):
    df = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 9)], "k int, i int")
    capped = parsing.cap_per_key(df, "k", [F.col("i")], 3)
    assert sorted(map(tuple, capped.collect())) == [(1, 0), (1, 1), (1, 2), (2, 9)]
    assert column(parsing.cap_rows(df, [F.col("i")], 2), "i") == [0, 1]


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3)], "id int, b int")
    assert rows(parsing.union_keywords([a, b])) == [
        {"id": 1, "a": "x", "b": None}, {"id": 2, "a": None, "b": 3},
    ]


@pytest.mark.parametrize("errors, status", [
    ([None, None], "completed"), ([None, "blocked"], "partial"), (["x", "y"], "failed"),
])
def test_crawl_report(spark, errors, status):
    attempts = spark.createDataFrame(
        [("mug", errors[0], 1.26), ("hat", errors[1], 2.0)],
        "keyword string, error string, duration_seconds double",
    )
    found = spark.createDataFrame([("mug",), ("mug",), ("hat",)], "keyword string")
    texts = parsing.tag_review_keyword(found.filter("keyword = 'mug'"), F.col("keyword"))
    assert column(texts, "keyword") == ["mug_reviews", "mug_reviews"]
    report = parsing.crawl_report(attempts, found, texts)
    by_key = {r["keyword"]: r for r in rows(report)}
    ok = errors[0] is None
    assert by_key["mug"]["products"] == (2 if ok else 0)
    assert by_key["mug"]["reviews"] == (2 if ok else 0)
    assert by_key["mug"]["duration_seconds"] == 1.3
    summary = one(parsing.crawl_summary(report))
    assert summary["status"] == status and summary["keywords_total"] == 2
    assert summary["total_products"] == 2 * ok + (errors[1] is None)


def test_discount_query_decodes_only_its_fields(spark):
    query = REGISTRY["p4_discount_pct"]
    assert "liked_count" not in plan(query(spark, SF))


def test_whole_number_check_reads_the_object_once(spark):
    bodies = ['{"items":[{"itemid":1,"cmt_count":2.5},{"itemid":2,"cmt_count":2},'
              '{"itemid":3,"stock":"1.5"},{"itemid":4,"stock":null},{"itemid":[5]},7]}']
    responses = spark.createDataFrame([(b,) for b in bodies], "body string")
    item = F.explode(F.try_variant_get(
        F.try_parse_json("body"), "$.items", "array<variant>")).alias("raw")
    fits = responses.select(item).select(
        parsing._fits(F.col("raw"), parsing.WHOLE_PRODUCT).alias("fits"))
    assert plan(fits).split("== Initial")[0].count("variant_get(raw") == 1
    assert [r[0] for r in fits.collect()] == [False, True, False, True, True, True]
