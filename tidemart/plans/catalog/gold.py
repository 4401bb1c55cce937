"""Product metrics and price history."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import history, metrics
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.registry import query

_METRICS = """product_id, shop_id, name, keyword, price, rating, sold_count, scraped_at,
    total_reviews, avg_rating, star_5_count, star_4_count, star_3_count, star_2_count,
    star_1_count, star_5_percentage"""
_METRIC_COLUMNS = [c.strip() for c in _METRICS.split(",")]


@query("g1_review_aggregate", with_views("""
    select product_id, total_reviews, avg_rating, star_5_count, star_4_count, star_3_count,
      star_2_count, star_1_count from review_aggregate"""))
def _(t):
    return metrics.review_aggregate(t.silver_reviews())


@query("g2_five_star_share", with_views(f"""
    select product_id, {rnd("star_5_count / total_reviews * 100", 2)} as star_5_percentage
    from review_aggregate"""))
def _(t):
    shares = metrics.with_five_star_share(metrics.review_aggregate(t.silver_reviews()))
    return shares.select("product_id", "star_5_percentage")


@query("g3_latest_snapshot", with_views("""
    select product_id, scraped_at, price, name, shop_id from latest_snapshot"""))
def _(t):
    return metrics.latest_snapshot(t.silver_products()).select(
        "product_id", "scraped_at", "price", "name", "shop_id"
    )


@query("g4_left_join", with_views("""
    select p.product_id, p.price, cast(r.total_reviews as double) as total_reviews,
      r.avg_rating
    from latest_snapshot p left join review_aggregate r on p.product_id = r.product_id"""))
def _(t):
    joined = metrics.join_reviews(
        metrics.latest_snapshot(t.silver_products()),
        metrics.review_aggregate(t.silver_reviews()),
    )
    return joined.select(
        "product_id", "price", F.col("total_reviews").cast("double").alias("total_reviews"),
        "avg_rating",
    )


@query("g5_null_fill", with_views("""
    select product_id, total_reviews, avg_rating, star_5_count, star_1_count
    from product_metrics"""))
def _(t):
    joined = metrics.join_reviews(
        metrics.latest_snapshot(t.silver_products()),
        metrics.review_aggregate(t.silver_reviews()),
    )
    return metrics.fill_unreviewed(joined).select(
        "product_id", "total_reviews", "avg_rating", "star_5_count", "star_1_count"
    )


@query("g6_product_metrics", with_views(f"select {_METRICS} from product_metrics"))
def _(t):
    built = metrics.product_metrics(t.silver_products(), t.silver_reviews(), t.run_ts)
    return built.select(*_METRIC_COLUMNS)


@query("g7_snapshot_prep", with_views("""
    select product_id, scraped_at, strftime(scraped_at, '%Y-%m-%d') as scraped_date, price
    from silver_products"""))
def _(t):
    return history.snapshots(t.silver_products()).select(
        "product_id", "scraped_at", F.col("scraped_date").cast("string"), "price"
    )


@query("g8_lag_features", with_views("""
    select product_id, scraped_at, price, cast(previous_price as double) as previous_price,
      previous_scraped_at from lagged"""))
def _(t):
    return history.with_previous(t.silver_products()).select(
        "product_id", "scraped_at", "price",
        F.col("previous_price").cast("double").alias("previous_price"),
        "previous_scraped_at",
    )


# Low enough that test products count as hot, so the chunked way is checked as well.
_HOT = 25


def _changes(t):
    snaps = t.silver_products()
    return history.with_changes(history.with_previous(snaps, hot_rows=_HOT))


@query("g9_absolute_change", with_views("""
    select product_id, scraped_at, cast(price_change_abs as double) as price_change_abs
    from price_history"""))
def _(t):
    change = F.col("price_change_abs").cast("double").alias("price_change_abs")
    return _changes(t).select("product_id", "scraped_at", change)


@query("g10_percent_change", with_views(
    "select product_id, scraped_at, price_change_pct from price_history"))
def _(t):
    return _changes(t).select("product_id", "scraped_at", "price_change_pct")


@query("g11_days_since_seen", with_views("""
    select product_id, scraped_at, cast(days_since_last_seen as double)
      as days_since_last_seen from price_history"""))
def _(t):
    days = F.col("days_since_last_seen").cast("double").alias("days_since_last_seen")
    return _changes(t).select("product_id", "scraped_at", days)


@query("g12_direction_flags", with_views("""
    select product_id, scraped_at, cast(is_price_increased as varchar) as is_price_increased,
      cast(is_price_decreased as varchar) as is_price_decreased from price_history"""))
def _(t):
    return _changes(t).select(
        "product_id", "scraped_at", F.col("is_price_increased").cast("string"),
        F.col("is_price_decreased").cast("string"),
    )


@query("g13_suspicious_discount", with_views(
    "select product_id, scraped_at, is_discount_suspicious from price_history"))
def _(t):
    return _changes(t).select("product_id", "scraped_at", "is_discount_suspicious")


@query("g14_available_columns", with_views("""
    select product_id, price, cast(previous_price as double) as previous_price, scraped_at,
      price_change_pct from price_history"""))
def _(t):
    # Only what a narrow table offers survives, in the fixed order.
    narrow = t.silver_products().select("product_id", "price", "scraped_at")
    built = history.price_history(narrow)
    return built.select(
        "product_id", "price", F.col("previous_price").cast("double").alias("previous_price"),
        "scraped_at", "price_change_pct",
    )


@query("g15_price_history", with_views("""
    select product_id, shop_id, name, keyword, price, original_price,
      cast(previous_price as double) as previous_price,
      cast(price_change_abs as double) as price_change_abs, price_change_pct,
      cast(is_price_increased as varchar) as is_price_increased,
      cast(is_price_decreased as varchar) as is_price_decreased, is_discount_suspicious,
      rating, sold_count, scraped_at, strftime(scraped_at, '%Y-%m-%d') as scraped_date,
      cast(days_since_last_seen as double) as days_since_last_seen
    from price_history"""))
def _(t):
    built = history.price_history(t.silver_products(), run_ts=t.run_ts, few_repeats=True)
    as_double = ("previous_price", "price_change_abs", "days_since_last_seen")
    as_string = ("is_price_increased", "is_price_decreased", "scraped_date")
    return built.drop("gold_processed_at").withColumns({
        **{c: F.col(c).cast("double") for c in as_double},
        **{c: F.col(c).cast("string") for c in as_string},
    })


@query("price_trends", with_views(f"""
    select category_id, strftime(scraped_at, '%Y-%m-%d') as scraped_date,
      {rnd("avg(price)", 2)} as avg_price, min(price) as min_price, max(price) as max_price,
      count(distinct product_id) as total_products
    from silver_products
    where category_id = 11 and scraped_at >= timestamp '1996-01-01'
      and scraped_at < timestamp '1999-01-01'
    group by 1, 2"""))
def _(t):
    snaps = t.silver_products().withColumn("scraped_date", F.to_date("scraped_at"))
    trends = history.price_trends(snaps, 11, "1996-01-01", "1998-12-31")
    return trends.withColumn("scraped_date", F.col("scraped_date").cast("string"))
