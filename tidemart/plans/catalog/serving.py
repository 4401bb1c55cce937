"""Serving queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators import name_index, serving, summaries
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.registry import query
from tidemart.sources import tables
from tidemart.sources.files import Folder

_CARD = ["product_id", "name", "keyword", "price", "avg_rating", "total_reviews", "sold_count"]
_CARD_SQL = ", ".join(_CARD)


@query("a1_shared_filter", with_views(f"""
    select {_CARD_SQL} from product_metrics
    where lower(keyword) = 'brand#12' and price >= 20000 and price <= 80000"""))
def _(t):
    return serving.apply_filters(t.metrics(), "BRAND#12", 20000, 80000).select(*_CARD)


@query("a2_name_search", with_views(f"""
    select {_CARD_SQL} from product_metrics where regexp_matches(name, '(?i)^RED .*(ring|nut)')
    """))
def _(t):
    return serving.search_names(t.metrics(), "^RED .*(ring|nut)").select(*_CARD)


@query("a2_indexed_search", with_views(f"""
    select {_CARD_SQL}, 'pattern' as search from product_metrics
      where regexp_matches(name, '(?i)d.* gizmo$')
    union all select {_CARD_SQL}, 'literal' as search from product_metrics
      where contains(lower(name), 'red bo')"""))
def _(t):
    def found(pattern, literal, label):
        rows = name_index.search(t.metrics_table(), t.names_table(), pattern, literal)
        return rows.select(*_CARD, F.lit(label).alias("search"))

    return found("d.* gizmo$", False, "pattern").unionByName(
        found("RED Bo", True, "literal"))


@query("a3_sorted_products", with_views(f"""
    select {_CARD_SQL}, cast(row_number() over (order by rating asc nulls last, product_id,
      scraped_at) as bigint) as position
    from product_metrics order by position limit 50"""))
def _(t):
    page = serving.list_products(t.metrics(), page_size=50, sort_by="rating",
                                 sort_order="asc")
    return _numbered(page, serving.ordering(page, "rating", "asc"), 0)


def _numbered(page, order, offset):
    at = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)) + F.lit(offset)
    return page.select(*_CARD, at.cast("bigint").alias("position"))


@query("a4_product_page", with_views(f"""
    select {_CARD_SQL} from product_metrics
    where regexp_matches(name, '(?i)old') and price >= 10000
    order by total_reviews desc, product_id, scraped_at limit 20 offset 40"""))
def _(t):
    return serving.list_products(
        t.metrics(), page=3, page_size=20, search="old", sort_by="total_reviews",
        min_price=10000,
    ).select(*_CARD)


@query("a4_page_total", with_views("""
    select count(*) as total, cast(ceil(count(*) / 20) as bigint) as total_pages
    from product_metrics where regexp_matches(name, '(?i)old') and price >= 10000"""))
def _(t):
    return serving.count_products(t.metrics(), 20, search="old", min_price=10000)


@query("a5_product_lookup", with_views(f"""
    select {_CARD_SQL} from product_metrics where cast(product_id as varchar) = '17'"""))
def _(t):
    return serving.get_product_by_id(t.metrics_table().near("17"), "17").select(*_CARD)


_KPIS = f"""count(*) as total_products, coalesce({rnd("avg(price)", 0)}, 0) as avg_price,
    coalesce({rnd("avg(avg_rating)", 2)}, 0) as avg_rating,
    coalesce(cast(sum(total_reviews) as bigint), 0) as total_reviews"""


@query("a6_overview", with_views(f"""
    select {_KPIS}, count(distinct keyword) as total_keywords from product_metrics"""))
def _(t):
    return serving.get_overview(t.metrics())


@query("a6_filtered_overview", with_views(f"""
    select {_KPIS}, count(distinct keyword) as total_keywords from product_metrics
    where lower(keyword) = 'brand#7' and price >= 30000"""))
def _(t):
    return serving.get_overview(t.metrics(), keyword="brand#7", min_price=30000)


_STATS = f"""
    select keyword, {_KPIS},
      {", ".join(f"cast(sum(star_{s}_count) as bigint) as star_{s}" for s in range(1, 6))},
      cast(sum(star_1_count + star_2_count + star_3_count + star_4_count + star_5_count)
        as bigint) as total
    from product_metrics where trim(keyword) <> '' group by keyword"""


@query("a7_keyword_stats", with_views(_STATS))
def _(t):
    return serving.get_keyword_stats(t.metrics()).select(
        "keyword", "total_products", "avg_price", "avg_rating", "total_reviews",
        "rating_distribution.*",
    )


@query("a6_overview_states", with_views(f"""
    select {_KPIS}, count(distinct keyword) as total_keywords from product_metrics"""))
def _(t):
    return summaries.overview(t.keyword_states(), t.metrics())


@query("a6_keyword_overview_states", with_views(f"""
    select {_KPIS}, count(distinct keyword) as total_keywords from product_metrics
    where lower(keyword) = 'brand#7'"""))
def _(t):
    return summaries.overview(t.keyword_states(), t.metrics(), keyword="Brand#7")


@query("a7_keyword_stats_states", with_views(_STATS))
def _(t):
    return summaries.keyword_stats(t.keyword_states()).select(
        "keyword", "total_products", "avg_price", "avg_rating", "total_reviews",
        "rating_distribution.*",
    )


def _top_sql(metric, limit, where="true"):
    return with_views(f"""
        select {_CARD_SQL} from product_metrics where total_reviews > 0 and {where}
        order by {metric} desc nulls last, product_id, scraped_at limit {limit}""")


@query("a8_top_products", _top_sql("avg_rating", 10))
def _(t):
    return serving.get_top_products(t.metrics()).select(*_CARD)


@query("a8_top_products_states", _top_sql("total_reviews", 50))
def _(t):
    return summaries.top_products(
        t.top_states(), t.metrics(), "total_reviews", 50).select(*_CARD)


@query("a8_top_by_sold", _top_sql("sold_count", 50, "lower(keyword) = 'brand#3'"))
def _(t):
    return serving.get_top_products(
        t.metrics(), metric="sold_count", limit=50, keyword="Brand#3"
    ).select(*_CARD)


@query("a8_unknown_metric", _top_sql("avg_rating", 5, "price <= 50000"))
def _(t):
    return serving.get_top_products(
        t.metrics(), metric="no_such_metric", limit=5, max_price=50000
    ).select(*_CARD)


@query("a9_product_reviews", with_views("""
    select review_id, review_text, sentiment_label, sentiment_score from sentiments
    where cast(product_id as varchar) = '42'"""))
def _(t):
    return serving.get_reviews_by_product(t.sentiments_table().near("42"), "42").select(
        "review_id", "review_text", "sentiment_label", "sentiment_score"
    )


@query("a9_review_count", with_views("""
    select '42' as product_id, count(*) as total from silver_reviews where product_id = 42"""))
def _(t):
    renamed = t.silver_reviews().withColumnRenamed("product_id", "itemid")
    return serving.count_reviews_by_product(renamed, 42)


_SENTIMENT = ", ".join(
    f"count(*) filter (where sentiment_label = '{n}') as {n}"
    for n in ("positive", "negative", "neutral")
) + ", count(*) as total"


_SENTIMENT_SQL = with_views(f"""
    select {_SENTIMENT}, {", ".join(
        rnd(f"count(*) filter (where sentiment_label = '{n}') / count(*) * 100", 1)
        + f" as {n}_pct" for n in ("positive", "negative", "neutral"))}
    from sentiments""")


@query("a10_sentiment_overview", _SENTIMENT_SQL)
def _(t):
    return serving.get_sentiment_overview(t.sentiments())


@query("a10_sentiment_states", _SENTIMENT_SQL)
def _(t):
    return summaries.sentiment_overview(t.label_states())


@query("a11_rating_distribution", with_views(f"""
    select {", ".join(f"cast(sum(star_{s}_count) as bigint) as star_{s}"
                      for s in range(1, 6))},
      cast(sum(star_1_count + star_2_count + star_3_count + star_4_count + star_5_count)
        as bigint) as total
    from product_metrics"""))
def _(t):
    return serving.get_rating_distribution(t.metrics())


@query("a12_negative_topics", with_views("select topic, count from negative_topics"))
def _(t):
    return serving.get_negative_topics(t.topics())


_MOVE = ["product_id", "name", "price", "previous_price", "price_change_pct",
         "is_discount_suspicious", "scraped_at"]


def _moves(df):
    return df.select(*_MOVE).withColumn("previous_price", F.col("previous_price").cast("double"))


_MOVE_SQL = """product_id, name, price, cast(previous_price as double) as previous_price,
    price_change_pct, is_discount_suspicious, scraped_at"""


@query("a13_product_price_history", with_views(f"""
    select {_MOVE_SQL} from price_history where product_id = 42 order by scraped_at"""))
def _(t):
    return _moves(serving.get_price_history_by_product(t.history_table().near("42"), "42"))


@query("a14_price_volatility", with_views(f"""
    select {_MOVE_SQL} from price_history where price_change_pct is not null
    order by abs(price_change_pct) desc, product_id, scraped_at limit 20"""))
def _(t):
    return _moves(serving.price_volatility(t.history()))


@query("a14_suspicious_only", with_views(f"""
    select {_MOVE_SQL} from price_history
    where price_change_pct is not null and is_discount_suspicious
    order by abs(price_change_pct) desc, product_id, scraped_at limit 100"""))
def _(t):
    return _moves(serving.price_volatility(t.history(), 100, suspicious_only=True))


def _moves_sql(limit, where="true"):
    return with_views(f"""
        select {_MOVE_SQL} from price_history where price_change_pct is not null and {where}
        order by abs(price_change_pct) desc, product_id, scraped_at limit {limit}""")


@query("a14_volatility_states", _moves_sql(20))
def _(t):
    return _moves(summaries.volatility(t.move_states()))


@query("a14_suspicious_states", _moves_sql(100, "is_discount_suspicious"))
def _(t):
    return _moves(summaries.volatility(t.move_states(), 100, suspicious_only=True))


@query("a4_page_after", with_views("""
    select product_id, name, price from product_metrics
    order by price desc nulls last, product_id limit 20 offset 20"""))
def _(t):
    # The second page, from the last row of the first.
    first = serving.list_products(t.metrics(), page_size=20, sort_by="price")
    last = first.select("product_id", "scraped_at", "price").collect()[-1].asDict()
    return serving.products_after(t.metrics(), last, 20, sort_by="price").select(
        "product_id", "name", "price")


@query("a15_reload", with_views("""
    select 'reloaded' as status, count(*) as total_products from product_metrics"""))
def _(t):
    base = t.path("a15")
    t.metrics().limit(0).write.mode("overwrite").parquet(f"{base}/table")
    served = t.spark.read.schema(t.metrics().schema).parquet(f"{base}/table").cache()
    served.count()
    # The folders change places on the file system, of which Spark knows nothing: without the
    # reload the cached frame stays empty.
    t.metrics().write.mode("overwrite").parquet(f"{base}/next")
    folder = Folder(t.spark, base)
    folder.remove("table")
    folder.rename("next", "table")
    tables.reload_tables(t.spark, [f"{base}/table"])
    return served.agg(
        F.lit("reloaded").alias("status"), F.count(F.lit(1)).alias("total_products")
    )
