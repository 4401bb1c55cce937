"""Profiles, funnel, status and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import profiling, serving
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.registry import query

_BRONZE = ["product_id", "shop_id", "name", "keyword", "price", "original_price", "rating",
           "sold_count", "category_id", "shop_location", "scraped_at"]
# With the columns that only the raw table has.
_ALL_BRONZE = [*_BRONZE, "l_orderkey", "l_linenumber", "l_quantity"]


def _bronze(t):
    return t.bronze_products()


@query("q1_row_column_count", with_views("""
    select 'Bronze.Products' as layer, count(*) as row_count,
      cast(14 as bigint) as column_count from raw_products"""))
def _(t):
    return profiling.profile_table(_bronze(t), "Bronze.Products").select(
        "layer", "row_count", "column_count"
    )


_NULLS = " union all ".join(
    f"""select 'Bronze.Products' as layer, '{c}' as "column",
        {rnd(f"(count(*) - count({c})) / count(*) * 100", 2)} as null_pct from raw_products"""
    for c in _ALL_BRONZE
)


@query("q2_null_rates", with_views(_NULLS))
def _(t):
    return profiling.null_rates(_bronze(t), "Bronze.Products")


def _sparse(t):
    """A price only on low-quantity rows, so that the null rate is high."""
    return _bronze(t).withColumn(
        "price", F.when(F.col("sold_count") <= 30, F.col("price"))
    )


@query("q3_high_null_issue", with_views(f"""
    select 'null_rate:price:' || {rnd("(count(*) - count(p)) / count(*) * 100", 2)} as issue
    from (select case when sold_count <= 30 then price end as p from raw_products)"""))
def _(t):
    found = profiling.profile_table(_sparse(t), "Bronze.Products")
    issues = found.select(F.explode("issues").alias("issue"))
    return issues.filter(F.startswith(F.col("issue"), F.lit("null_rate")))


@query("q4_profile_key", with_views("""
    select 'product_id,scraped_at' as "column", count(*) as rows from raw_reviews
    group by 1"""))
def _(t):
    # A review table with scrape times is keyed by product and time, not by review.
    reviews = t.bronze_reviews().withColumn("scraped_at", F.col("created_at"))
    long = profiling.measures(reviews, "Bronze.Reviews")
    key = F.max(F.when(F.col("measure") == "repeats", F.col("column")))
    rows = F.max(F.when(F.col("measure") == "rows", F.col("value")))
    return long.agg(key.alias("column"), rows.alias("rows"))


_DUPLICATES = f"""
    select 'Bronze.Products' as layer, sum(n - 1)::bigint as duplicate_count,
      {rnd("sum(n - 1) / sum(n) * 100", 2)} as duplicate_rate
    from (select count(*) as n from raw_products group by product_id, scraped_at)"""


@query("q5_duplicate_rate", with_views(_DUPLICATES))
def _(t):
    return profiling.profile_table(_bronze(t), "Bronze.Products").select(
        "layer", "duplicate_count", "duplicate_rate"
    )


@query("q6_price_sanity", with_views("""
    select 'Bronze.Products' as layer, count(*) filter (where price <= 0) as bad_price_count
    from raw_products"""))
def _(t):
    return profiling.profile_table(_bronze(t), "Bronze.Products").select(
        "layer", "bad_price_count"
    )


_STATUS = """
    select 'Bronze.Products' as layer, 'warning' as status from raw_products
    group by 1 having count(*) filter (where price <= 0) > 0
    union all
    select 'Gold.Metrics', case when count(*) = count(distinct product_id)
      and count(*) filter (where price <= 0) = 0 then 'ok' else 'warning' end
    from product_metrics
    union all select 'Gold.Absent', 'missing'"""


@query("q7_status", with_views(_STATUS))
def _(t):
    metrics = t.metrics().drop("rating", "scraped_at")
    long = profiling.measures(_bronze(t), "Bronze.Products").unionByName(
        profiling.measures(metrics, "Gold.Metrics")
    ).unionByName(profiling.absent_measures(t.spark, "Gold.Absent"))
    return profiling.profile(long).select("layer", "status")


def _layers(t):
    return {
        "Bronze.Products": _bronze(t),
        "Bronze.Reviews": t.bronze_reviews(),
        "Silver.Products": t.silver_products(),
        "Silver.Reviews": t.silver_reviews(),
        "Gold.Metrics": t.metrics(),
        "Gold.PriceHistory": t.history(),
        "Gold.Sentiment": t.sentiments(),
        "Gold.Topics": t.topics(),
    }


def _all_measures(t):
    known = {"Bronze.Products": t.bronze_product_repeats()}
    parts = [profiling.measures(df, label, known.get(label)) for label, df in _layers(t).items()]
    return profiling.union_measures(parts)


def _layer_sql(label, view, columns, key, nulls=(), price=False):
    repeats = f"(select count(*) from (select distinct {key} from {view}))" if key else "n"
    bad = "count(*) filter (where price <= 0)" if price else "0"
    high = " + ".join(
        f"((count(*) - count({c})) / count(*) * 100 > 30)::int" for c in nulls) or "0"
    return f"""
        select '{label}' as layer, n as row_count, cast({columns} as bigint) as column_count,
          n - {repeats} as duplicate_count, bad as bad_price_count,
          high + (n > {repeats})::int + (bad > 0)::int as issue_count
        from (select count(*) as n, {bad} as bad, {high} as high from {view})"""


_PROFILE = " union all ".join([
    _layer_sql("Bronze.Products", "raw_products", 14, "product_id, scraped_at", _ALL_BRONZE, True),
    _layer_sql("Bronze.Reviews", "raw_reviews", 5, "product_id", ["rating"]),
    _layer_sql("Silver.Products", "silver_products", 15, "product_id, scraped_at", _BRONZE,
               True),
    _layer_sql("Silver.Reviews", "silver_reviews", 6, "product_id"),
    _layer_sql("Gold.Metrics", "product_metrics", 24, "product_id, scraped_at", _BRONZE, True),
    _layer_sql("Gold.PriceHistory", "price_history", 18, "product_id, scraped_at",
               ["previous_price", "price_change_pct"], True),
    _layer_sql("Gold.Sentiment", "sentiments", 6, "product_id"),
    _layer_sql("Gold.Topics", "negative_topics", 2, None),
])


@query("q8_layer_profile", with_views(_PROFILE))
def _(t):
    return profiling.profile(_all_measures(t)).select(
        "layer", "row_count", "column_count", "duplicate_count", "bad_price_count",
        F.size("issues").cast("bigint").alias("issue_count"),
    )


@query("q9_layer_funnel", with_views(f"""
    select s.layer as src, d.layer as dst, s.rows as src_rows, d.rows as dst_rows,
      {rnd("(s.rows - d.rows) / s.rows * 100", 1)} as drop_pct,
      ({rnd("(s.rows - d.rows) / s.rows * 100", 1)} > 20)::int as is_high
    from (values ('Bronze.Products', 'Silver.Products'), ('Silver.Products', 'Gold.Metrics'),
      ('Bronze.Reviews', 'Silver.Reviews'), ('Silver.Reviews', 'Gold.Sentiment')) p(src, dst)
    join layer_tables s on s.layer = p.src join layer_tables d on d.layer = p.dst
    where s.rows > 0"""))
def _(t):
    counts = profiling.count_rows(_layers(t))
    return profiling.funnel(counts).withColumn("is_high", F.col("is_high").cast("int"))


@query("q10_roll_up", with_views(f"""
    select cast(sum(issue_count) as bigint) as total_issues,
      case when sum(issue_count) = 0 then 'ok' else 'warning' end as overall_status
    from ({_PROFILE})"""))
def _(t):
    return profiling.roll_up(profiling.profile(_all_measures(t)))


@query("q11_gold_check", with_views("""
    select product_id, name, price, total_reviews, avg_rating, star_5_percentage
    from product_metrics order by total_reviews desc, product_id limit 5"""))
def _(t):
    return serving.verify_gold(t.metrics())


@query("q12_dataset_status", with_views("""
    select 'product_metrics' as dataset, (select count(*) from product_metrics) as rows,
      'true' as available
    union all select 'sentiment', (select count(*) from sentiments), 'true'
    union all select 'negative_topics', (select count(*) from negative_topics), 'true'
    union all select 'price_history', (select count(*) from price_history), 'true'"""))
def _(t):
    status = profiling.dataset_status({
        "product_metrics": t.metrics(), "sentiment": t.sentiments(),
        "negative_topics": t.topics(), "price_history": t.history(),
    })
    return status.select("dataset", "rows", F.col("available").cast("string"))


@query("q13_health", with_views("""
    select 'healthy' as status, (select count(*) from product_metrics) as total_products,
      (select count(*) from sentiments) as total_reviews"""))
def _(t):
    return profiling.health(t.metrics(), t.sentiments())
