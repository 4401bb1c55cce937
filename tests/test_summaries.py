"""Overview queries from partial states: equal to the whole table, merged from parts, edges."""

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from tidemart.operators import serving, summaries
from tidemart.plans.tables import Tables


@pytest.fixture(scope="module")
def lake(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def halves(lake):
    """Two uneven parts of the product table; keywords occur in both, a few are null or blank."""
    word = F.when(F.col("product_id") % 11 == 0, F.lit(None)).when(
        F.col("product_id") % 13 == 0, F.lit("  ")).otherwise(F.col("keyword"))
    whole = lake.metrics().withColumn("keyword", word)
    part = F.col("product_id") % 3 == 0
    return whole, whole.filter(part), whole.filter(~part)


def test_keyword_states_of_parts_merge(halves):
    whole, one, two = halves
    states = summaries.keyword_states(one).unionByName(summaries.keyword_states(two))
    assert rows(summaries.overview(states, whole)) == rows(serving.get_overview(whole))
    assert rows(summaries.overview(states, whole, keyword="BRAND#7")) == rows(
        serving.get_overview(whole, keyword="brand#7"))
    assert rows(summaries.keyword_stats(states)) == rows(serving.get_keyword_stats(whole))
    assert rows(summaries.rating_distribution(states)) == rows(
        serving.get_rating_distribution(whole))


def test_price_ranges_are_counted_in_the_table(halves):
    whole, one, _ = halves
    stale = summaries.keyword_states(one)
    assert rows(summaries.overview(stale, whole, min_price=20000)) == rows(
        serving.get_overview(whole, min_price=20000))


def test_top_states_of_parts_merge(halves):
    whole, one, two = halves
    states = summaries.top_states(one).unionByName(summaries.top_states(two))
    for metric in (*summaries.TOP_METRICS, "price", "no_such_metric"):
        assert summaries.top_products(states, whole, metric, 50).collect() == \
            serving.get_top_products(whole, metric, 50).collect()
    assert summaries.top_products(states, whole, limit=5, keyword="brand#3").collect() == \
        serving.get_top_products(whole, limit=5, keyword="brand#3").collect()
    with pytest.raises(ValueError):
        summaries.top_products(states, whole, limit=51)


def test_move_states_of_parts_merge(lake):
    whole = lake.history()
    part = F.col("product_id") % 3 == 0
    states = summaries.move_states(whole.filter(part)).unionByName(
        summaries.move_states(whole.filter(~part)))
    for limit, only in ((1, False), (100, False), (100, True)):
        assert summaries.volatility(states, limit, only).collect() == \
            serving.price_volatility(whole, limit, only).collect()


def test_label_states_of_parts_merge(spark):
    data = [(i, label) for i, label in enumerate(
        ["positive"] * 5 + ["negative"] * 3 + [None, "odd", "neutral"])]
    whole = spark.createDataFrame(data, "review_id long, sentiment_label string")
    states = summaries.label_states(whole.filter("review_id < 6")).unionByName(
        summaries.label_states(whole.filter("review_id >= 6")))
    assert rows(summaries.sentiment_overview(states)) == rows(
        serving.get_sentiment_overview(whole))
    none = whole.limit(0)
    assert rows(summaries.sentiment_overview(summaries.label_states(none))) == rows(
        serving.get_sentiment_overview(none))


def test_tables_without_rows_or_optional_columns(spark):
    bare = spark.createDataFrame([(1, 4.0), (2, None)], "product_id long, avg_rating double")
    for frame in (bare, bare.limit(0)):
        states = summaries.keyword_states(frame)
        assert rows(summaries.overview(states, frame, keyword="x")) == rows(
            serving.get_overview(frame, keyword="x"))
    assert summaries.top_states(bare.drop("avg_rating")).count() == 0
