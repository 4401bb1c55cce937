"""Parsing of search and ratings responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import parsing
from tidemart.plans import derived
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.registry import query


def _products(t):
    return parsing.parse_products(t.search_responses(), F.lit("2024-06-01T12:30:45"))


def _reviews(t):
    return parsing.parse_reviews(t.rating_responses(), F.lit("2024-06-01T12:30:45"))


@query("p1_search_explode", with_views("select product_id, keyword from search_items"))
def _(t):
    b = F.coalesce(F.try_variant_get("item", "$.item_basic", "variant"), F.col("item"))
    return parsing.search_items(t.search_responses()).select(
        F.try_variant_get(b, "$.itemid", "bigint").alias("product_id"), "keyword"
    )


@query("p2_product_flatten", with_views("""
    select product_id, shop_id, name, category_id, shop_location, rating,
      cast(l_linenumber as bigint) as review_count, sold_count,
      cast(0 as bigint) as liked_count, cast(0 as bigint) as stock
    from parsed_products"""))
def _(t):
    return parsing.flatten_products(t.search_responses()).select(
        "product_id", "shop_id", "name", "category_id", "shop_location", "rating",
        "review_count", "sold_count", "liked_count", "stock",
    )


@query("p3_price_rescale", with_views(f"""
    select product_id, {rnd("shown_price", 4)} as price,
      {rnd("shown_original", 4)} as original_price
    from parsed_products"""))
def _(t):
    flat = parsing.flatten_products(
        t.search_responses(), ["product_id", "price", "original_price"])
    return flat.select(
        "product_id", F.round("price", 4).alias("price"),
        F.round("original_price", 4).alias("original_price"),
    )


@query("p4_discount_pct", with_views(f"""
    select product_id, case when shown_original > 0 and shown_price < shown_original
      then {rnd("(1 - shown_price / shown_original) * 100", 1)} end as discount_pct
    from parsed_products"""))
def _(t):
    flat = parsing.flatten_products(
        t.search_responses(), ["product_id", "price", "original_price"])
    return parsing.with_discount(flat).select("product_id", "discount_pct")


@query("p5_urls", with_views("""
    select 'https://cf.shopee.vn/file/img' || product_id as image_url,
      'https://shopee.vn/' || replace(name, ' ', '-') || '-i.' || shop_id || '.' || product_id
        as url
    from parsed_products"""))
def _(t):
    return _products(t).select("image_url", "url")


@query("p6_product_constraints", with_views("""
    select product_id, slot_price as price_ok, rating_ok, count(*) as rows from (
      select product_id, coalesce(shown_price > 0, false)::int as slot_price,
        coalesce(rating <= 5, true)::int as rating_ok
      from parsed_products)
    group by all"""))
def _(t):
    def passed(name):
        return (~F.array_contains("violations", name)).cast("int")

    return _products(t).groupBy(
        "product_id", passed("price").alias("price_ok"), passed("rating").alias("rating_ok")
    ).agg(F.count(F.lit(1)).alias("rows"))


_CONSTRAINTS = {
    "product_id": "true", "shop_id": "true", "name": "length(name) between 1 and 1000",
    "price": "coalesce(shown_price > 0, false)", "original_price": "true",
    "rating": "coalesce(rating <= 5, true)", "review_count": "true", "sold_count": "true",
    "liked_count": "true", "stock": "true",
}


@query("p6_all_constraints", with_views("select product_id, " + ", ".join(
    f"({sql})::int as {name}_ok" for name, sql in _CONSTRAINTS.items()) + " from parsed_products"))
def _(t):
    return _products(t).select("product_id", *[
        (~F.array_contains("violations", name)).cast("int").alias(f"{name}_ok")
        for name in _CONSTRAINTS])


# What each kind of broken payload must be rejected for, by order number.
_BROKEN = ["", "name", "name", "price", "original_price", "rating", "rating", "review_count",
           "sold_count", "liked_count", "stock", "product_id", "shop_id", "name", "price", "stock"]


@query("p6_broken_constraints", with_views(f"""
    select kind, [{", ".join(f"'{n}'" for n in _BROKEN)}][kind + 1] as violations,
      count(*) as rows
    from (select cast(l_orderkey % {len(_BROKEN)} as integer) as kind from raw_products)
    group by kind"""))
def _(t):
    parsed = parsing.parse_products(
        derived.broken_responses(t.spark, t.sf_dir, len(_BROKEN)), F.lit("2024-06-01T12:30:45"))
    return parsed.groupBy("kind", F.array_join("violations", ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("rows"))


@query("p6_accepted_products", with_views(f"""
    select product_id, name, {rnd("shown_price", 4)} as price, rating from parsed_products
    where shown_price > 0 and (rating is null or rating <= 5)"""))
def _(t):
    return parsing.accepted(_products(t)).select(
        "product_id", "name", F.round("price", 4).alias("price"), "rating"
    )


@query("p7_defaults", with_views("""
    select product_id, 'VND' as currency, 'shopee' as platform,
      '2024-06-01T12:30:45' as scraped_at
    from parsed_products"""))
def _(t):
    return _products(t).select("product_id", "currency", "platform", "scraped_at")


@query("p8_ratings_explode", with_views(
    "select review_id, product_id, shop_id from rating_items"))
def _(t):
    return parsing.rating_items(t.rating_responses()).select(
        F.try_variant_get("item", "$.cmtid", "bigint").alias("review_id"),
        "product_id", "shop_id",
    )


@query("p9_review_flatten", with_views("""
    select review_id, product_id, shop_id, coalesce(rating, 5) as rating, review_text,
      'user' || review_id as author_username, '' as author_portrait,
      review_id % 7 as like_count
    from rating_items"""))
def _(t):
    return parsing.flatten_reviews(t.rating_responses()).select(
        "review_id", "product_id", "shop_id", "rating", "review_text", "author_username",
        "author_portrait", "like_count",
    )


@query("p9_fraction_refused", with_views("""
    select review_id, (review_id % 5 <> 0 or rating is null)::int as whole
    from rating_items"""))
def _(t):
    # One rating in five has half a star: it is refused, not cut.
    responses = t.rating_responses()
    halves = F.regexp_replace("body", '"rating_star":([0-9]+)', '"rating_star":$1.5')
    fifth = F.regexp_extract("body", '"cmtid":([0-9]+)', 1).cast("bigint") % 5 == 0
    sent = responses.withColumn("body", F.when(fifth, halves).otherwise(F.col("body")))
    found = parsing.parse_reviews(sent, F.lit("2024-06-01T12:30:45"))
    return found.select("review_id", (~F.array_contains("violations", "whole_number"))
                        .cast("int").alias("whole"))


@query("p12_time_range", with_views("""
    select review_id, (review_id % 3 <> 0)::int as dated,
      case when review_id % 3 <> 0 then date_trunc('second', created_at) end as created_at
    from rating_items"""))
def _(t):
    # One rating in three has a time far beyond the year 9999.
    responses = t.rating_responses()
    far = F.regexp_replace("body", '"ctime":', '"ctime":99999')
    third = F.regexp_extract("body", '"cmtid":([0-9]+)', 1).cast("bigint") % 3 == 0
    sent = responses.withColumn("body", F.when(third, far).otherwise(F.col("body")))
    found = parsing.parse_reviews(sent, F.lit("2024-06-01T12:30:45"))
    return found.select(
        "review_id", (~F.array_contains("violations", "created_at")).cast("int").alias("dated"),
        F.date_trunc("second", "created_at").cast("timestamp_ntz").alias("created_at"))


@query("p10_image_list", with_views("""
    select review_id, 'https://cf.shopee.vn/file/i' || review_id
      || ' https://cf.shopee.vn/file/second' as images
    from rating_items"""))
def _(t):
    return _reviews(t).select("review_id", F.array_join("images", " ").alias("images"))


@query("p11_video_list", with_views(
    "select review_id, 'v' || review_id as videos from rating_items"))
def _(t):
    return _reviews(t).select("review_id", F.array_join("videos", " ").alias("videos"))


@query("p12_unix_time", with_views("""
    select review_id, date_trunc('second', created_at) as created_at from rating_items"""))
def _(t):
    return _reviews(t).select(
        "review_id", F.col("created_at").cast("timestamp_ntz").alias("created_at")
    )


@query("p13_review_constraints", with_views("""
    select review_id, case when rating = 0 then 'rating' else '' end as violations
    from rating_items"""))
def _(t):
    return _reviews(t).select(
        "review_id", F.array_join("violations", " ").alias("violations")
    )


@query("p14_review_cap", with_views("""
    select product_id, review_id from raw_reviews
    qualify row_number() over (partition by product_id order by created_at, review_id) <= 3"""))
def _(t):
    order = [F.col("created_at"), F.col("review_id")]
    capped = parsing.cap_per_key(t.raw_reviews(), "product_id", order, n=3)
    return capped.select("product_id", "review_id")


@query("p15_row_cap", with_views("""
    select product_id, scraped_at, l_orderkey, l_linenumber, shop_id from raw_products
    order by scraped_at, l_orderkey, l_linenumber, product_id, shop_id limit 100"""))
def _(t):
    names = ["scraped_at", "l_orderkey", "l_linenumber", "product_id", "shop_id"]
    rows = t.raw_products().select(*names)
    return parsing.cap_rows(rows, [F.col(n) for n in names], 100)


@query("p16_keyword_union", with_views("""
    select review_id, product_id, rating, review_text, created_at from raw_reviews
    union all
    select review_id, product_id, null, review_text, null from review_texts"""))
def _(t):
    return parsing.union_keywords([t.raw_reviews(), t.review_texts()]).select(
        "review_id", "product_id", "rating", "review_text", "created_at"
    )


@query("p17_review_keyword", with_views("""
    select review_id, review_text || '_reviews' as keyword from raw_reviews"""))
def _(t):
    tagged = parsing.tag_review_keyword(t.raw_reviews(), F.col("review_text"))
    return tagged.select("review_id", "keyword")


CRAWL_SQL = f"""
    select a.keyword, case when error is null then 'completed' else 'failed' end as outcome,
      case when error is null then coalesce(p.n, 0) else 0 end as products,
      case when error is null then coalesce(r.n, 0) else 0 end as reviews,
      {rnd("duration_seconds", 1)} as duration_seconds
    from (select p_brand as keyword, case when p_brand like '%7' then 'blocked' end as error,
            min(p_retailprice) / 7 as duration_seconds from part group by 1, 2) a
    left join (select keyword, count(*) as n from raw_products group by 1) p
      on a.keyword = p.keyword
    left join (select p_brand as keyword, count(*) as n
               from raw_reviews join part on product_id = p_partkey group by 1) r
      on a.keyword = r.keyword"""


def _crawl(t):
    part = t.source("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("keyword"),
        "p_retailprice",
    )
    attempts = part.groupBy("keyword").agg(
        (F.min("p_retailprice") / 7).alias("duration_seconds")
    ).withColumn("error", F.when(F.endswith(F.col("keyword"), F.lit("7")), "blocked"))
    keyed = t.raw_reviews().join(part.select("product_id", "keyword"), "product_id")
    reviews = parsing.tag_review_keyword(keyed, F.col("keyword"))
    return parsing.crawl_report(attempts, t.raw_products(), reviews)


@query("p18_crawl_report", with_views(CRAWL_SQL))
def _(t):
    return _crawl(t).select("keyword", "outcome", "products", "reviews", "duration_seconds")


@query("p18_crawl_summary", with_views(f"""
    select count(*) as keywords_total,
      count(*) filter (where outcome = 'completed') as keywords_completed,
      count(*) filter (where outcome = 'failed') as keywords_failed,
      cast(sum(products) as bigint) as total_products,
      cast(sum(reviews) as bigint) as total_reviews,
      case when count(*) filter (where outcome = 'failed') = 0 then 'completed'
           when count(*) filter (where outcome = 'completed') > 0 then 'partial'
           else 'failed' end as status
    from ({CRAWL_SQL})"""))
def _(t):
    return parsing.crawl_summary(_crawl(t))
