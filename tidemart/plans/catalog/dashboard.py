"""What the dashboard computes from serving results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import dashboard, serving
from tidemart.plans.catalog.serving import _STATS
from tidemart.plans.catalog.sources import ranking
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.registry import query



@query("u1_price_buckets", with_views("""
    select 'all' as bucket, count(*) as products from product_metrics
    union all select 'under_100k', count(*) from product_metrics where price <= 100000
    union all select '100k_500k', count(*) from product_metrics
      where price between 100000 and 500000
    union all select 'over_500k', count(*) from product_metrics where price >= 500000"""))
def _(t):
    # An empty bucket has no row, so start from a zero row for each.
    names = t.spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in dashboard.PRICE_BUCKETS])).alias("bucket")
    )
    counts = dashboard.price_bucket_counts(t.metrics())
    return names.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("products", F.lit(0)).alias("products")
    )


@query("u1_price_bucket_rows", with_views(
    "select product_id, price from product_metrics where price <= 100000"))
def _(t):
    return dashboard.in_price_bucket(t.metrics(), "under_100k").select("product_id", "price")


@query("u2_star_filter", with_views("""
    select product_id, name, avg_rating from product_metrics
    where total_reviews > 0 and floor(avg_rating + 0.5) = 3
    order by avg_rating desc, product_id, scraped_at limit 5"""))
def _(t):
    reviewed = t.metrics().filter("total_reviews > 0")
    return dashboard.with_star(reviewed, 3, ranking()).select(
        "product_id", "name", "avg_rating"
    )


@query("u3_scatter_points", with_views("""
    select name, price, avg_rating as rating, total_reviews as reviews from product_metrics
    where price <> 0 and avg_rating <> 0 and total_reviews <> 0"""))
def _(t):
    return dashboard.scatter_points(t.metrics())


@query("u4_reviews_per_product", with_views("""
    select cast(floor(sum(total_reviews) / greatest(count(*), 1) + 0.5) as bigint)
      as reviews_per_product from product_metrics"""))
def _(t):
    return dashboard.reviews_per_product(serving.get_overview(t.metrics()))


@query("u5_topic_bars", with_views("""
    select topic, count, cast(floor(count / greatest(max(count) over (), 1) * 100 + 0.5)
      as bigint) as share_pct from negative_topics"""))
def _(t):
    return dashboard.topic_bars(serving.get_negative_topics(t.topics()))


@query("u5_keyword_star_bars", with_views(" union all ".join(
    f"""select keyword, {s} as star, star_{s} as reviews,
        star_{s} / greatest(star_1, star_2, star_3, star_4, star_5, 1) * 100 as share_pct
        from ({_STATS})""" for s in range(1, 6))))
def _(t):
    return dashboard.keyword_star_bars(serving.get_keyword_stats(t.metrics()))


@query("u6_sentiment_slices", with_views(f"""
    select sentiment_label as label, count(*) as reviews,
      {rnd("count(*) / (select count(*) from sentiments) * 100", 1)} as share_pct
    from sentiments group by 1"""))
def _(t):
    return dashboard.sentiment_slices(serving.get_sentiment_overview(t.sentiments()))


@query("u7_short_names", with_views(f"""
    select product_id, case when length(long_name) > 22
        then substring(long_name, 1, 22) || '…' else long_name end as short_name,
      {rnd("avg_rating", 1)} as avg_rating
    from (select *, name || ' of ' || shop_location as long_name from product_metrics)"""))
def _(t):
    named = t.metrics().withColumn(
        "name", F.concat("name", F.lit(" of "), "shop_location")
    )
    return dashboard.rating_bars(named)


@query("u8_chosen_keywords", with_views(f"""
    select keyword, total_products from ({_STATS}) where keyword in ('Brand#1', 'Brand#22')"""))
def _(t):
    stats = serving.get_keyword_stats(t.metrics())
    return dashboard.chosen_keywords(stats, ["Brand#1", "Brand#22", "none"]).select(
        "keyword", "total_products"
    )


@query("u8_keyword_table", with_views("""
    select product_id, keyword from product_metrics
    where keyword in (select p_brand from part where p_size > 45)"""))
def _(t):
    wanted = t.source("part").filter("p_size > 45").select(F.col("p_brand").alias("keyword"))
    return dashboard.chosen_keywords(t.metrics(), wanted).select("product_id", "keyword")


@query("u9_star_rows", with_views(" union all ".join(
    f"select {s} as star, cast(sum(star_{s}_count) as bigint) as reviews from product_metrics"
    for s in range(1, 6))))
def _(t):
    return dashboard.star_rows(serving.get_rating_distribution(t.metrics()))


@query("u10_product_star_share", with_views(" union all ".join(
    f"""select product_id, {s} as star, star_{s}_count as reviews,
        cast(floor(star_{s}_count / coalesce(nullif(total_reviews, 0), 1) * 100 + 0.5)
          as bigint) as share_pct from product_metrics""" for s in range(5, 0, -1))))
def _(t):
    return dashboard.product_star_share(t.metrics())


@query("u11_row_position", with_views("""
    select product_id, cast(row_number() over (order by avg_rating desc, product_id,
      scraped_at) as int) as position from product_metrics order by position
    limit 15 offset 30"""))
def _(t):
    page = serving.list_products(t.metrics(), page=3, page_size=15)
    return dashboard.with_position(page, 3, ranking()).select("product_id", "position")


@query("u12_review_display", with_views("""
    select review_id, product_id, 'Ẩn danh' as author,
      coalesce(cast(nullif(rating, 0) as double), 4) as rating,
      case when review_text = 'view' then 'no comment' else review_text end as text,
      strftime(created_at, '%Y-%m-%d') as date
    from raw_reviews"""))
def _(t):
    shown = t.raw_reviews().withColumns({
        "rating_star": F.col("rating").cast("double"), "rating": F.lit(4.0),
        "review_text": F.when(F.col("review_text") == "view", "")
        .otherwise(F.col("review_text")),
        "comment": F.lit("no comment"),
        "username": F.lit(""),
        "review_time": F.to_date("created_at").cast("string"),
        "created_at": F.lit(""),
    })
    return dashboard.review_display(shown)


@query("u13_price_move_labels", with_views(f"""
    select product_id, scraped_at,
      case when change > 0 then '+' when change < 0 then '-' else '' end
        || printf('%.1f', {rnd("abs(change)", 1)}) || '%' as change_label,
      case when is_discount_suspicious then 'Sale ảo' else 'Bình thường' end as warning_label
    from (select *, coalesce(price_change_pct, 0) as change from price_history)"""))
def _(t):
    return dashboard.price_move_labels(t.history()).select(
        "product_id", "scraped_at", "change_label", "warning_label"
    )
