"""Deduplication, cleansing and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import cleansing, quality
from tidemart.plans import derived
from tidemart.plans.catalog.sources import REJECTED_SQL
from tidemart.plans.check_sql import with_views
from tidemart.plans.registry import query


@query("d1_product_dedup", with_views("""
    select product_id, scraped_at, l_orderkey, l_linenumber, shop_id, price
    from single_products"""))
def _(t):
    return cleansing.dedup_products(t.raw_products(), derived.snapshot_ties()).select(
        "product_id", "scraped_at", "l_orderkey", "l_linenumber", "shop_id", "price"
    )


@query("d2_review_dedup", with_views("""
    select review_id, product_id, rating, created_at from raw_reviews"""))
def _(t):
    # A second crawl brings every review again, a day later.
    first = t.raw_reviews()
    again = first.withColumn("created_at", F.col("created_at") + F.expr("interval 1 day"))
    whole = first.unionByName(again)
    return cleansing.dedup_reviews(whole, [F.col("created_at")]).select(
        "review_id", "product_id", "rating", "created_at"
    )


@query("d3_price_to_int", with_views("""
    select l_orderkey, l_linenumber, product_id, shop_id,
      cast(cast(trunc(price) as bigint) as double) as price from raw_products"""))
def _(t):
    return cleansing.type_products(t.raw_products()).select(
        "l_orderkey", "l_linenumber", "product_id", "shop_id",
        F.col("price").cast("double").alias("price"),
    )


@query("d3_large_price", with_views("""
    select l_orderkey, l_linenumber, product_id, shop_id,
      cast(trunc(price * 100000) as bigint) as price
    from raw_products where price * 100000 > 0"""))
def _(t):
    # Prices beyond 32 bits stay whole and pass the gate.
    large = t.raw_products().withColumn("price", F.col("price") * 100000)
    typed = cleansing.type_products(large)
    return typed.where(F.col("price") > 0).select(
        "l_orderkey", "l_linenumber", "product_id", "shop_id", "price"
    )


@query("d4_default_discount", with_views("""
    select product_id, l_orderkey, case when rating is null then '0%'
      else sold_count || '%' end as discount from raw_products"""))
def _(t):
    shown = F.when(F.col("rating").isNotNull(),
                   F.concat(F.col("sold_count").cast("string"), F.lit("%")))
    return cleansing.type_products(t.raw_products().withColumn("discount", shown)).select(
        "product_id", "l_orderkey", "discount"
    )


@query("d5_timestamp_parse", with_views("""
    select review_id, case when review_id % 31 <> 0 then created_at end as created_at
    from raw_reviews"""))
def _(t):
    text = F.when(F.col("review_id") % 31 == 0, "not a time") \
        .otherwise(F.col("created_at").cast("string"))
    return cleansing.type_reviews(t.raw_reviews().withColumn("created_at", text)).select(
        "review_id", F.col("created_at").cast("timestamp_ntz").alias("created_at")
    )


@query("d6_newline_collapse", with_views("select review_id, review_text from clean_texts"))
def _(t):
    return cleansing.type_reviews(t.review_texts()).select("review_id", "review_text")


@query("d7_lineage_stamp", with_views("""
    select review_id, timestamp '2024-06-01 12:30:45' as processed_at from raw_reviews"""))
def _(t):
    return cleansing.type_reviews(t.raw_reviews(), t.run_ts).select(
        "review_id", F.col("processed_at").cast("timestamp_ntz").alias("processed_at")
    )


@query("d8_product_gate", with_views("""
    select product_id, scraped_at, name, price, rating from silver_products"""))
def _(t):
    return quality.product_gate(t.clean_products()).valid.select(
        "product_id", "scraped_at", "name", "price", "rating"
    )


@query("d9_product_rejects", with_views(REJECTED_SQL))
def _(t):
    return quality.product_gate(t.clean_products()).rejected.select(
        "entity", "reason", "product_id", "l_orderkey"
    )


@query("d10_missing_required", with_views("""
    select 'valid' as kind, cast(0 as bigint) as rows
    union all select 'missing_name', count(*) from clean_products"""))
def _(t):
    # Without its name column a table has no valid row and every row is rejected for it.
    gate = quality.product_gate(t.clean_products().drop("name"))
    valid = gate.valid.agg(F.lit("valid").alias("kind"), F.count(F.lit(1)).alias("rows"))
    named = gate.rejected.filter(F.col("reason") == "missing_name")
    return valid.unionByName(named.agg(
        F.lit("missing_name").alias("kind"), F.count(F.lit(1)).alias("rows")))


@query("d11_product_report", with_views("""
    select 'products' as entity, count(*) as input_rows,
      (select count(*) from silver_products) as valid_rows,
      count(*) - (select count(*) from silver_products) as rejected_rows,
      count(*) filter (where price is null or price <= 0) as invalid_price,
      count(*) filter (where product_id is null) as missing_product_id,
      count(*) filter (where name is null or length(trim(name, ' ')) = 0) as missing_name,
      count(*) filter (where rating < 0 or rating > 5) as invalid_rating
    from clean_products"""))
def _(t):
    return quality.product_gate(t.clean_products()).report


@query("d12_review_gate", with_views(
    "select review_id, product_id, rating from silver_reviews"))
def _(t):
    return quality.review_gate(t.clean_reviews()).valid.select(
        "review_id", "product_id", "rating"
    )


# Texts of one event type are blanked so that the warning rule has rows.
_BLANKED = """(select * replace (case when review_text = 'view' then ' ' else review_text end
    as review_text) from raw_reviews)"""


def _blanked(t):
    text = F.when(F.col("review_text") == "view", " ").otherwise(F.col("review_text"))
    return t.clean_reviews().withColumn("review_text", text)


@query("d13_review_rejects", with_views(f"""
    select 'invalid_rating' as reason, review_id from {_BLANKED}
    where rating is null or rating not between 1 and 5
    union all
    select 'missing_text', review_id from {_BLANKED} where length(trim(review_text, ' ')) = 0"""))
def _(t):
    return quality.review_gate(_blanked(t)).rejected.select("reason", "review_id")


@query("d14_review_report", with_views(f"""
    select 'reviews' as entity, count(*) as input_rows,
      count(*) filter (where rating between 1 and 5) as valid_rows,
      count(*) filter (where rating is null or rating not between 1 and 5) as rejected_rows,
      cast(0 as bigint) as missing_review_id, cast(0 as bigint) as missing_product_id,
      count(*) filter (where rating is null or rating not between 1 and 5) as invalid_rating,
      count(*) filter (where length(trim(review_text, ' ')) = 0) as missing_text
    from {_BLANKED}"""))
def _(t):
    return quality.review_gate(_blanked(t)).report
