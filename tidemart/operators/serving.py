"""Serving queries over the gold tables. Every function is lazy and returns a DataFrame.

Optional columns are tolerated: a filter on an absent column does nothing and a KPI of an
absent column is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.columns import PRODUCT_ID_COLUMNS, first_present
from tidemart.functions.numeric import percent, rounded
from tidemart.functions.text import is_blank

# Paging defaults and limits of the API.
DEFAULT_PAGE_SIZE = 20
MAX_PAGE_SIZE = 100
MAX_TOP_PRODUCTS = 50
MAX_VOLATILITY = 100

# Pages that begin beyond so many rows are found by counting; bounds of one counting pass.
DEEP_OFFSET = 100_000
RANGES = 32

LABELS = ("positive", "negative", "neutral")
STARS = (1, 2, 3, 4, 5)


def _check(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


def apply_filters(
    df: DataFrame,
    keyword: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """Keyword equality ignoring case and an inclusive price range, each optional."""
    if keyword and "keyword" in df.columns:
        df = df.filter(F.lower("keyword") == F.lower(F.lit(keyword)))
    if "price" in df.columns:
        if min_price is not None:
            df = df.filter(F.col("price") >= min_price)
        if max_price is not None:
            df = df.filter(F.col("price") <= max_price)
    return df


def search_names(df: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """Names matching a pattern, ignoring case; null names never match."""
    if literal:
        return df.filter(F.contains(F.lower("name"), F.lower(F.lit(pattern))))
    return df.filter(F.col("name").rlike(f"(?iu){pattern}"))


def ordering(df: DataFrame, sort_by: str, direction: str) -> list[Column]:
    """Nulls last in both directions, ties by the remaining columns; an unknown column
    leaves only the tie-break."""
    tie = [F.col(c) for c in ("product_id", "scraped_at") if c in df.columns and c != sort_by]
    if sort_by not in df.columns:
        return tie
    column = F.col(sort_by)
    ascending = direction.lower() == "asc"
    return [column.asc_nulls_last() if ascending else column.desc_nulls_last(), *tie]


def matching_products(
    metrics: DataFrame,
    search: str | None = None,
    keyword: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    _check(min_price is None or min_price >= 0, "min_price must not be negative")
    _check(max_price is None or max_price >= 0, "max_price must not be negative")
    found = apply_filters(metrics, keyword, min_price, max_price)
    return search_names(found, search) if search else found


def _order_names(df: DataFrame, sort_by: str) -> list[str]:
    names = [sort_by] if sort_by in df.columns else []
    return names + [c for c in ("product_id", "scraped_at") if c in df.columns and c != sort_by]


def _placed(
    df: DataFrame, sort_by: str, sort_order: str, values: dict
) -> tuple[Column, Column]:
    """Whether a row sorts after the given sort values, and whether it has just these."""
    beyond, same = F.lit(False), F.lit(True)
    for name in _order_names(df, sort_by):
        column, value = F.col(name), values[name]
        if name == sort_by:  # nulls come last
            falls = sort_order.lower() != "asc"
            later = F.lit(False) if value is None else (
                (column < value if falls else column > value) | column.isNull())
        else:  # nulls come first
            later = column.isNotNull() if value is None else column > value
        beyond = beyond | (same & F.coalesce(later, F.lit(False)))
        same = same & column.eqNullSafe(F.lit(value))
    return beyond, same


def _narrowed(
    found: DataFrame, offset: int, rows: int, sort_by: str, sort_order: str
) -> tuple[DataFrame, int]:
    """Rows of a narrow range of the order that holds places `offset` to `offset + rows`, and how
    many come before the range.

    Each pass takes bounds from a sample and counts, without a shuffle, the rows from each bound
    on; the range between two bounds is then treated in the same way, until it is short or its
    rows all sort alike.
    """
    order = ordering(found, sort_by, sort_order)
    part, before, total = found, 0, found.count()
    while total > DEEP_OFFSET:
        share = min(1.0, 40 * RANGES / total)
        some = part.select(*_order_names(found, sort_by)).sample(share, 7).orderBy(*order)
        picked = [r.asDict() for r in some.limit(80 * RANGES).collect()]
        step = max(1, len(picked) // RANGES)
        bounds = list({tuple(v.values()): v for v in picked[step::step]}.values())
        places = [_placed(found, sort_by, sort_order, v) for v in bounds]
        if not bounds:
            break
        counts = part.agg(*[F.count_if(beyond | same).alias(str(i))
                            for i, (beyond, same) in enumerate(places)]).first()
        starts = [total - n for n in counts]  # rows of `part` before each bound
        wanted, low, high = offset - before, None, None
        for i, start in enumerate(starts):
            if start <= wanted:
                low = i
            elif start >= wanted + rows and high is None:
                high = i
        first = starts[low] if low is not None else 0
        last = starts[high] if high is not None else total
        if last - first >= total:
            break
        if low is not None:
            part = part.filter(places[low][0] | places[low][1])
        if high is not None:
            part = part.filter(~(places[high][0] | places[high][1]))
        before, total = before + first, last - first
    return part, before


def list_products(
    metrics: DataFrame,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    search: str | None = None,
    sort_by: str = "avg_rating",
    sort_order: str = "desc",
    keyword: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """One page of products.

    Offset and limit sit on the sort, so tasks keep only the rows up to the page's end. For a
    page that begins beyond `DEEP_OFFSET` rows, counting passes run first and find a narrow range
    of the order that holds it, so that no task gets the rows before it.
    """
    _check(page >= 1, "page starts at 1")
    _check(1 <= page_size <= MAX_PAGE_SIZE, f"page_size must be in 1..{MAX_PAGE_SIZE}")
    found = matching_products(metrics, search, keyword, min_price, max_price)
    order = ordering(found, sort_by, sort_order)
    offset = (page - 1) * page_size
    if order and offset > DEEP_OFFSET:
        found, before = _narrowed(found, offset, page_size, sort_by, sort_order)
        offset -= before
    ordered = found.orderBy(*order) if order else found
    return ordered.offset(offset).limit(page_size)


def products_after(
    metrics: DataFrame,
    last: dict,
    page_size: int = DEFAULT_PAGE_SIZE,
    sort_by: str = "avg_rating",
    sort_order: str = "desc",
    **filters,
) -> DataFrame:
    """The page that follows a row: `last` has that row's values of the sort columns.

    A deep page is found by a filter and a short limit, so no task holds the skipped rows.
    """
    _check(1 <= page_size <= MAX_PAGE_SIZE, f"page_size must be in 1..{MAX_PAGE_SIZE}")
    found = matching_products(metrics, **filters)
    beyond, _ = _placed(found, sort_by, sort_order, last)
    return found.filter(beyond).orderBy(*ordering(found, sort_by, sort_order)).limit(page_size)


def count_products(
    metrics: DataFrame, page_size: int = DEFAULT_PAGE_SIZE, **filters
) -> DataFrame:
    """One row: matches before paging, and the number of pages."""
    total = F.count(F.lit(1))
    return matching_products(metrics, **filters).agg(
        total.alias("total"),
        F.ceil(total / F.lit(page_size)).alias("total_pages"),
    )


def _id_equals(df: DataFrame, column: str, wanted) -> Column:
    """Ids compare as text. For whole-number ids the literal is converted instead, which
    keeps the comparison pushable to the file scan."""
    text = str(wanted)
    if isinstance(df.schema[column].dataType, T.IntegralType):
        canonical = text.lstrip("-").isdecimal() and str(int(text)) == text
        if not canonical or abs(int(text)) >= 2 ** 63:
            return F.lit(False)
        return F.col(column) == F.lit(int(text))
    return F.col(column).cast("string") == text


def get_product_by_id(metrics: DataFrame, product_id) -> DataFrame:
    """The product's row, or none."""
    return metrics.filter(_id_equals(metrics, "product_id", product_id)).limit(1)


def _mean(df: DataFrame, name: str, digits: int) -> Column:
    if name not in df.columns:
        return F.lit(0.0)
    return F.coalesce(rounded(F.avg(name), digits), F.lit(0.0))


def _total(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(0)
    return F.coalesce(F.sum(name), F.lit(0))


def _kpis(df: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_products"),
        _mean(df, "price", 0).alias("avg_price"),
        _mean(df, "avg_rating", 2).alias("avg_rating"),
        _total(df, "total_reviews").alias("total_reviews"),
    ]


def get_overview(
    metrics: DataFrame,
    keyword: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """KPIs in one row. Means include unreviewed products with their zero rating.

    Rows are first summed per keyword, so distinct keywords cost no extra shuffle of rows.
    """
    found = apply_filters(metrics, keyword, min_price, max_price)
    if "keyword" not in found.columns:
        return found.agg(*_kpis(found), F.lit(0).cast("bigint").alias("total_keywords"))
    return found.agg(*_kpis(found), F.count_distinct("keyword").alias("total_keywords"))


def get_keyword_stats(metrics: DataFrame) -> DataFrame:
    """KPIs and star distribution per non-blank keyword, most products first."""
    stars = [_total(metrics, f"star_{s}_count").alias(f"star_{s}") for s in STARS]
    grouped = metrics.filter(~is_blank(F.col("keyword"))).groupBy("keyword").agg(
        *_kpis(metrics), *stars
    )
    names = [f"star_{s}" for s in STARS]
    whole = sum((F.col(n) for n in names[1:]), F.col(names[0])).alias("total")
    return (
        grouped
        .withColumn("rating_distribution", F.struct(*names, whole))
        .drop(*names)
        .orderBy(F.desc("total_products"), "keyword")
    )


def get_top_products(
    metrics: DataFrame,
    metric: str = "avg_rating",
    limit: int = 10,
    keyword: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """Best reviewed products by a metric; an unknown metric means `avg_rating`."""
    _check(1 <= limit <= MAX_TOP_PRODUCTS, f"limit must be in 1..{MAX_TOP_PRODUCTS}")
    found = apply_filters(metrics, keyword, min_price, max_price)
    if "total_reviews" in found.columns:
        found = found.filter(F.col("total_reviews") > 0)
    by = metric if metric in found.columns else "avg_rating"
    return found.orderBy(*ordering(found, by, "desc")).limit(limit)


def get_reviews_by_product(reviews: DataFrame, product_id) -> DataFrame:
    """All reviews of a product, whatever its id column is called."""
    column = first_present(reviews, PRODUCT_ID_COLUMNS)
    if column is None:
        return reviews.filter(F.lit(False))
    return reviews.filter(_id_equals(reviews, column, product_id))


def count_reviews_by_product(reviews: DataFrame, product_id) -> DataFrame:
    return get_reviews_by_product(reviews, product_id).agg(
        F.lit(str(product_id)).alias("product_id"), F.count(F.lit(1)).alias("total")
    )


def get_sentiment_overview(sentiments: DataFrame) -> DataFrame:
    """Counts and shares of the labels over all rows, unlabelled ones included."""
    total = F.count(F.lit(1))
    if "sentiment_label" not in sentiments.columns:
        return sentiments.limit(0).agg(
            *[F.count(F.lit(1)).alias(n) for n in (*LABELS, "total")]
        )
    counts = {n: F.count_if(F.col("sentiment_label") == n) for n in LABELS}
    return sentiments.agg(
        *[c.alias(n) for n, c in counts.items()],
        total.alias("total"),
        *[F.coalesce(percent(c, total, 1), F.lit(0.0)).alias(f"{n}_pct")
          for n, c in counts.items()],
    )


def get_rating_distribution(metrics: DataFrame) -> DataFrame:
    stars = {f"star_{s}": _total(metrics, f"star_{s}_count") for s in STARS}
    return metrics.agg(*[c.alias(n) for n, c in stars.items()]).withColumn(
        "total", sum((F.col(n) for n in stars), F.lit(0))
    )


def get_negative_topics(topics: DataFrame, k: int = 20) -> DataFrame:
    return topics.orderBy(F.desc("count"), "topic").limit(k)


def get_price_history_by_product(history: DataFrame, product_id) -> DataFrame:
    found = history.filter(_id_equals(history, "product_id", product_id))
    return found.orderBy("scraped_at") if "scraped_at" in found.columns else found


def price_volatility(
    history: DataFrame, limit: int = 20, suspicious_only: bool = False
) -> DataFrame:
    """Snapshots with the largest relative change in either direction."""
    _check(1 <= limit <= MAX_VOLATILITY, f"limit must be in 1..{MAX_VOLATILITY}")
    found = history.filter(F.col("price_change_pct").isNotNull())
    if suspicious_only and "is_discount_suspicious" in found.columns:
        found = found.filter("is_discount_suspicious")
    ties = [F.col(c) for c in ("product_id", "scraped_at") if c in found.columns]
    return found.orderBy(F.abs("price_change_pct").desc(), *ties).limit(limit)


def verify_gold(metrics: DataFrame, k: int = 5) -> DataFrame:
    """Spot check: the most reviewed products."""
    return metrics.orderBy(F.desc("total_reviews"), "product_id").select(
        "product_id", "name", "price", "total_reviews", "avg_rating", "star_5_percentage"
    ).limit(k)
