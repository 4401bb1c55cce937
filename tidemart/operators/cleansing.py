"""Bronze to silver: deduplicate, type and stamp. Quality gates come after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import as_timestamp, present
from tidemart.functions.text import collapse_newlines
from tidemart.operators.ordered import drop_listed_repeats, drop_repeats


def snapshot_keys(df: DataFrame) -> list[str]:
    return present(df, ["product_id", "scraped_at"])


def _dedup(
    df: DataFrame, keys: list[str], tie_break: list[Column] | None, repeated: DataFrame | None
) -> DataFrame:
    if repeated is None:
        return drop_repeats(df, keys, tie_break)
    return drop_listed_repeats(df, keys, repeated, tie_break)


def dedup_products(
    df: DataFrame, tie_break: list[Column] | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """One row per snapshot; `repeated` lists the keys that repeat, if they are known."""
    return _dedup(df, snapshot_keys(df), tie_break, repeated)


def dedup_reviews(
    df: DataFrame, tie_break: list[Column] | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    return _dedup(df, ["review_id"], tie_break, repeated)


def _stamp(df: DataFrame, run_ts: Column | None) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp() if run_ts is None else run_ts)


def type_products(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Whole-number price (64 bits, cut towards zero), default discount, parsed times."""
    changes: dict[str, Column] = {}
    if "price" in df.columns:
        changes["price"] = F.col("price").try_cast("bigint")
    if "discount" in df.columns:
        changes["discount"] = F.coalesce("discount", F.lit("0%"))
    if "scraped_at" in df.columns:
        changes["scraped_at"] = as_timestamp(df, "scraped_at")
    return _stamp(df.withColumns(changes), run_ts)


def type_reviews(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    changes: dict[str, Column] = {}
    if "review_text" in df.columns:
        changes["review_text"] = collapse_newlines(F.col("review_text"))
    for name in present(df, ["created_at", "scraped_at"]):
        changes[name] = as_timestamp(df, name)
    return _stamp(df.withColumns(changes), run_ts)


def clean_products(
    df: DataFrame, run_ts: Column | None = None, tie_break: list[Column] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    return type_products(dedup_products(df, tie_break, repeated), run_ts)


def clean_reviews(
    df: DataFrame, run_ts: Column | None = None, tie_break: list[Column] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    return type_reviews(dedup_reviews(df, tie_break, repeated), run_ts)
