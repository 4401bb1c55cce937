"""Gold price history: change features between consecutive snapshots of a product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import present, sortable
from tidemart.functions.pricing import change_percent
from tidemart.operators.ordered import HOT_ROWS, drop_repeats, previous_values

# Thresholds of a suspicious discount, and the table's columns in order.
SUSPICIOUS_DROP_PCT = -15
SUSPICIOUS_MIN_CHANGE = 20000
HISTORY_COLUMNS = [
    "product_id", "shop_id", "name", "keyword", "price", "original_price", "discount_pct",
    "previous_price", "price_change_abs", "price_change_pct", "is_price_increased",
    "is_price_decreased", "is_discount_suspicious", "rating", "sold_count", "review_count",
    "scraped_at", "scraped_date", "days_since_last_seen", "gold_processed_at",
]


def dated(products: DataFrame) -> DataFrame:
    if "scraped_at" not in products.columns:
        raise ValueError("price history needs a scraped_at column")
    return products.withColumn("scraped_date", F.to_date("scraped_at"))


def snapshots(products: DataFrame, tie_break: list[Column] | None = None) -> DataFrame:
    """One row per product and scrape time, with its calendar date."""
    return drop_repeats(dated(products), ["product_id", "scraped_at"], tie_break)


def with_previous(
    products: DataFrame,
    tie_break: list[Column] | None = None,
    hot_rows: int | None = HOT_ROWS,
    few_repeats: bool = False,
) -> DataFrame:
    """Snapshots with price and time of the product's preceding snapshot.

    Repeats are dropped before the rows are shuffled by product, so any number of copies is
    fine. `few_repeats` says that a product has only a few rows per time, as in silver,
    where copies are gone and only one time spelled in two ways is left; they are then
    dropped within the shuffled rows, which saves a shuffle of the whole table.
    """
    names = [c for c in sortable(products) if c not in ("product_id", "scraped_at")]
    ties = tie_break or [F.col(c).asc_nulls_first() for c in names]
    return previous_values(
        products, ["product_id"], "scraped_at",
        {"previous_price": "price", "previous_scraped_at": "scraped_at"},
        prepare=dated if few_repeats else lambda rows: snapshots(rows, tie_break),
        hot_rows=hot_rows,
        repeat_order=ties if few_repeats else None,
    )


def with_changes(
    lagged: DataFrame,
    drop_pct: float = SUSPICIOUS_DROP_PCT,
    min_abs: float = SUSPICIOUS_MIN_CHANGE,
) -> DataFrame:
    """Change amounts, direction flags (null on the first snapshot) and the suspicious-
    discount flag (false when undecided)."""
    price, previous = F.col("price"), F.col("previous_price")
    change = lagged.withColumns({
        "price_change_abs": price - previous,
        "price_change_pct": change_percent(price, previous),
        "days_since_last_seen": F.datediff("scraped_at", "previous_scraped_at"),
    })
    amount = F.col("price_change_abs")
    deep = (F.col("price_change_pct") <= drop_pct) & (F.abs(amount) >= min_abs)
    return change.withColumns({
        "is_price_increased": amount > 0,
        "is_price_decreased": amount < 0,
        "is_discount_suspicious": F.coalesce(deep, F.lit(False)),
    })


def price_history(
    products: DataFrame,
    drop_pct: float = SUSPICIOUS_DROP_PCT,
    min_abs: float = SUSPICIOUS_MIN_CHANGE,
    run_ts: Column | None = None,
    tie_break: list[Column] | None = None,
    hot_rows: int | None = HOT_ROWS,
    few_repeats: bool = False,
) -> DataFrame:
    # Prune before the window so its shuffles carry only columns of the result.
    wanted = products if tie_break else products.select(*present(products, HISTORY_COLUMNS))
    lagged = with_previous(wanted, tie_break, hot_rows, few_repeats)
    changed = with_changes(lagged, drop_pct, min_abs)
    stamp = F.current_timestamp() if run_ts is None else run_ts
    stamped = changed.withColumn("gold_processed_at", stamp)
    return stamped.select(*present(stamped, HISTORY_COLUMNS))


def price_trends(
    snapshots: DataFrame, category: int | None = None,
    start: str | None = None, end: str | None = None,
) -> DataFrame:
    """Mean, lowest and highest price and product count by platform, category and day."""
    keys = present(snapshots, ["platform", "category_id", "scraped_date"])
    found = snapshots
    if category is not None:
        found = found.filter(F.col("category_id") == category)
    if start is not None:
        found = found.filter(F.col("scraped_date") >= F.lit(start).cast("date"))
    if end is not None:
        found = found.filter(F.col("scraped_date") <= F.lit(end).cast("date"))
    return found.groupBy(*keys).agg(
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count_distinct("product_id").alias("total_products"),
    )
