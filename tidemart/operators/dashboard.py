"""What the dashboard derives from serving results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import present
from tidemart.functions.numeric import nearest, or_zero, percent
from tidemart.operators.serving import apply_filters

# Price buckets (inclusive bounds), labels, name length, rows per page.
PRICE_BUCKETS = {
    "all": (None, None),
    "under_100k": (None, 100_000),
    "100k_500k": (100_000, 500_000),
    "over_500k": (500_000, None),
}
NAME_WIDTH = 22
ROWS_PER_PAGE = 15
ANONYMOUS = "Ẩn danh"
SUSPICIOUS_LABEL = "Sale ảo"
NORMAL_LABEL = "Bình thường"


def in_price_bucket(df: DataFrame, bucket: str) -> DataFrame:
    """Rows of a bucket; a price on a bound is in both buckets, unknown buckets are all."""
    low, high = PRICE_BUCKETS.get(bucket, PRICE_BUCKETS["all"])
    return apply_filters(df, min_price=low, max_price=high)


def price_bucket_counts(df: DataFrame) -> DataFrame:
    """`(bucket, products)` for all buckets in one pass."""
    price = F.col("price")

    def inside(low, high):
        above = F.lit(True) if low is None else price >= low
        below = F.lit(True) if high is None else price <= high
        return above & below

    buckets = F.array_compact(F.array(*[
        F.when(inside(*bounds), F.lit(name)) for name, bounds in PRICE_BUCKETS.items()
    ]))
    return df.select(F.explode(buckets).alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("products")
    )


def with_star(top: DataFrame, star: int | None, order: list[Column], k: int = 5) -> DataFrame:
    """First rows whose mean rating rounds to the star; no star keeps all."""
    chosen = top if not star else top.filter(nearest(or_zero(F.col("avg_rating"))) == star)
    return chosen.orderBy(*order).limit(k)


def scatter_points(products: DataFrame) -> DataFrame:
    names = {"price": "price", "avg_rating": "rating", "total_reviews": "reviews"}
    filled = products
    for source in names:
        filled = filled.filter(F.col(source) != 0)
    return filled.select("name", *[F.col(s).alias(n) for s, n in names.items()])


def reviews_per_product(overview: DataFrame) -> DataFrame:
    ratio = or_zero(F.col("total_reviews")) / F.greatest(F.col("total_products"), F.lit(1))
    return overview.select(nearest(ratio).alias("reviews_per_product"))


def topic_bars(topics: DataFrame) -> DataFrame:
    """Width of each topic relative to the largest; input is the top-k topic list."""
    largest = F.greatest(F.max("count").over(Window.partitionBy(F.lit(1))), F.lit(1))
    return topics.withColumn("share_pct", nearest(F.col("count") / largest * 100))


def keyword_star_bars(stats: DataFrame) -> DataFrame:
    """Each keyword's stars relative to its own largest star."""
    stars = [F.col(f"rating_distribution.star_{s}") for s in range(1, 6)]
    largest = F.greatest(*stars, F.lit(1))
    bars = F.array(*[
        F.struct(F.lit(s).alias("star"), c.alias("reviews"),
                 (c / largest * 100).alias("share_pct"))
        for s, c in enumerate(stars, start=1)
    ])
    return stats.select("keyword", F.inline(bars))


def sentiment_slices(overview: DataFrame) -> DataFrame:
    """Labels with at least one review and their share."""
    parts = F.array(*[
        F.struct(F.lit(n).alias("label"), F.col(n).alias("reviews"),
                 percent(F.col(n), F.col("total"), 1).alias("share_pct"))
        for n in ("positive", "negative", "neutral")
    ])
    return overview.select(F.inline(parts)).filter("reviews > 0")


def short_name(name: Column) -> Column:
    text = F.coalesce(name, F.lit(""))
    cut = F.concat(F.substring(text, 1, NAME_WIDTH), F.lit("…"))
    return F.when(F.length(text) > NAME_WIDTH, cut).otherwise(text)


def rating_bars(top: DataFrame) -> DataFrame:
    """Short name and mean rating to one decimal, for the rating bar chart."""
    return top.select(
        "product_id", short_name(F.col("name")).alias("short_name"),
        F.round(or_zero(F.col("avg_rating")), 1).alias("avg_rating"),
    )


def chosen_keywords(stats: DataFrame, keywords: list[str] | DataFrame) -> DataFrame:
    """Rows of the chosen keywords, given as a list or as a table with a keyword column."""
    if isinstance(keywords, DataFrame):
        return stats.join(keywords.select("keyword"), "keyword", "left_semi")
    return stats.filter(F.col("keyword").isin(keywords))


def star_rows(distribution: DataFrame) -> DataFrame:
    """Five `(star, reviews)` rows from the distribution's columns."""
    stars = F.array(*[
        F.struct(F.lit(s).alias("star"), or_zero(F.col(f"star_{s}")).alias("reviews"))
        for s in range(1, 6)
    ])
    return distribution.select(F.inline(stars))


def product_star_share(products: DataFrame) -> DataFrame:
    """Share of each star per product; a missing or zero total counts as one."""
    total = F.coalesce(F.nullif(F.col("total_reviews"), F.lit(0)), F.lit(1))
    stars = F.array(*[
        F.struct(
            F.lit(s).alias("star"),
            or_zero(F.col(f"star_{s}_count")).alias("reviews"),
            nearest(or_zero(F.col(f"star_{s}_count")) / total * 100).alias("share_pct"),
        )
        for s in (5, 4, 3, 2, 1)
    ])
    return products.select("product_id", F.inline(stars))


def with_position(
    page_rows: DataFrame, page: int, order: list[Column], per_page: int = ROWS_PER_PAGE
) -> DataFrame:
    """Number the rows of one page, continuing over pages. Input is a single page."""
    within = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    return page_rows.withColumn("position", within + F.lit((page - 1) * per_page))


def _or_next(df: DataFrame, names: list[str], empty, nothing: Column) -> Column:
    """First column with a value other than `empty`; the last one is taken as it is."""
    have = present(df, names)
    candidates = [
        F.col(n) if n == names[-1] else F.nullif(F.col(n), F.lit(empty)) for n in have
    ]
    return F.coalesce(*candidates, nothing)


def review_display(reviews: DataFrame) -> DataFrame:
    """Author, rating, text and date as shown, from whichever columns exist."""
    no_text = F.lit(None).cast("string")
    names = [F.nullif(F.col(n), F.lit("")) for n in present(reviews, ["author_name", "username"])]
    dates = [
        F.nullif(F.col(n).cast("string"), F.lit(""))
        for n in present(reviews, ["created_at", "review_time"])
    ]
    return reviews.select(
        *present(reviews, ["review_id", "product_id"]),
        F.coalesce(*names, F.lit(ANONYMOUS)).alias("author"),
        _or_next(reviews, ["rating_star", "rating"], 0, F.lit(None).cast("int")).alias("rating"),
        _or_next(reviews, ["review_text", "comment"], "", no_text).alias("text"),
        F.coalesce(*dates, no_text).alias("date"),
    )


def price_move_labels(history: DataFrame) -> DataFrame:
    """Signed percentage to one decimal, and the warning label."""
    change = F.coalesce("price_change_pct", F.lit(0.0))
    # A tiny drop shows as -0.0%, as a fixed-point rendering of a negative number does.
    sign = F.when(change > 0, "+").when(change < 0, "-").otherwise("")
    text = F.concat(sign, F.format_string("%.1f%%", F.abs(change)))
    suspicious = F.coalesce("is_discount_suspicious", F.lit(False))
    return history.withColumns({
        "change_label": text,
        "warning_label": F.when(suspicious, SUSPICIOUS_LABEL).otherwise(NORMAL_LABEL),
    })
