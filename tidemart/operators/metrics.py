"""Gold product metrics: review aggregates joined to each product's latest snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import present, sortable
from tidemart.functions.numeric import percent
from tidemart.operators.ordered import drop_repeats, keep_first

STARS = (5, 4, 3, 2, 1)

# Values of a product nobody has reviewed.
UNREVIEWED = {
    "total_reviews": 0,
    "avg_rating": 0.0,
    **{f"star_{s}_count": 0 for s in STARS},
    "star_5_percentage": 0.0,
}


def review_aggregate(reviews: DataFrame) -> DataFrame:
    """Count, mean rating and stars per product. Only partial sums are shuffled."""
    return reviews.groupBy("product_id").agg(
        F.count("review_id").alias("total_reviews"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        *[F.count_if(F.col("rating") == s).alias(f"star_{s}_count") for s in STARS],
    )


def with_five_star_share(aggregate: DataFrame) -> DataFrame:
    share = percent(F.col("star_5_count"), F.col("total_reviews"), 2)
    return aggregate.withColumn("star_5_percentage", share)


def latest_snapshot(products: DataFrame) -> DataFrame:
    """The most recent row per product; without scrape times, any one row per product."""
    if "scraped_at" not in products.columns:
        return drop_repeats(products, ["product_id"])
    ties = [F.col(c).asc_nulls_first()
            for c in sortable(products, exclude=["product_id", "scraped_at"])]
    return keep_first(products, ["product_id"], [F.col("scraped_at").desc_nulls_last(), *ties])


def join_reviews(latest: DataFrame, aggregate: DataFrame) -> DataFrame:
    """Keep every product. Both sides have one row per product, so no key is hot."""
    return latest.join(aggregate, "product_id", "left")


def fill_unreviewed(joined: DataFrame) -> DataFrame:
    return joined.fillna({c: UNREVIEWED[c] for c in present(joined, UNREVIEWED)})


def product_metrics(
    products: DataFrame, reviews: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    aggregate = with_five_star_share(review_aggregate(reviews))
    filled = fill_unreviewed(join_reviews(latest_snapshot(products), aggregate))
    stamp = F.current_timestamp() if run_ts is None else run_ts
    return filled.withColumn("gold_processed_at", stamp)
