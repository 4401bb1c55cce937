"""Partial states of the overview queries, kept in small tables beside the gold tables.

A state is counts and sums by keyword or label, or the best rows of a ranking. States of several
parts of a table merge by standing in one table: every reader here sums them, or ranks them again.
The tables grow with the number of keywords and parts, not with the rows they summarize.

Readers answer as their namesakes in `serving` do on the whole table. What the states do not know
(a price range, a ranking that was not kept) is answered from the whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import or_zero, percent, rounded
from tidemart.functions.text import is_blank
from tidemart.operators import serving
from tidemart.operators.serving import LABELS, MAX_TOP_PRODUCTS, MAX_VOLATILITY, STARS

# Rankings that are kept.
TOP_METRICS = ("avg_rating", "total_reviews", "sold_count")

_TOTALS = ["total_reviews", *[f"star_{s}_count" for s in STARS]]
_MEANS = ["price", "avg_rating"]


def keyword_states(metrics: DataFrame) -> DataFrame:
    """Rows, sums and the counts behind means, by keyword; without keywords, of all rows."""
    states = [F.count(F.lit(1)).alias("n")]
    for name in _MEANS:
        value = F.col(name) if name in metrics.columns else F.lit(None)
        states += [F.count(value).alias(f"n_{name}"),
                   or_zero(F.sum(value.cast("double"))).alias(f"sum_{name}")]
    for name in _TOTALS:
        value = F.col(name) if name in metrics.columns else F.lit(None)
        states.append(or_zero(F.sum(value.cast("long"))).alias(name))
    if "keyword" in metrics.columns:
        return metrics.groupBy("keyword").agg(*states)
    return metrics.agg(*states)


def _mean(name: str, digits: int) -> Column:
    whole = F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))
    return F.coalesce(rounded(whole, digits), F.lit(0.0)).alias(
        "avg_price" if name == "price" else name)


def _kpis() -> list[Column]:
    return [or_zero(F.sum("n")).alias("total_products"), _mean("price", 0),
            _mean("avg_rating", 2), or_zero(F.sum("total_reviews")).alias("total_reviews")]


def overview(
    states: DataFrame,
    metrics: DataFrame,
    keyword: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """KPIs in one row; a price range is counted in `metrics` itself."""
    if min_price is not None or max_price is not None:
        return serving.get_overview(metrics, keyword, min_price, max_price)
    found = serving.apply_filters(states, keyword)
    words = F.count_distinct("keyword") if "keyword" in found.columns \
        else F.lit(0).cast("bigint")
    return found.agg(*_kpis(), words.alias("total_keywords"))


def _stars() -> list[Column]:
    sums = {s: or_zero(F.sum(f"star_{s}_count")) for s in STARS}
    return [*[c.alias(f"star_{s}") for s, c in sums.items()],
            sum(sums.values(), F.lit(0)).alias("total")]


def keyword_stats(states: DataFrame) -> DataFrame:
    """KPIs and star distribution per non-blank keyword, most products first."""
    return states.filter(~is_blank(F.col("keyword"))).groupBy("keyword").agg(
        *_kpis(), F.struct(*_stars()).alias("rating_distribution")
    ).orderBy(F.desc("total_products"), "keyword")


def rating_distribution(states: DataFrame) -> DataFrame:
    return states.agg(*_stars())


def label_states(sentiments: DataFrame) -> DataFrame:
    """Rows by sentiment label, unlabelled ones included."""
    return sentiments.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))


def sentiment_overview(states: DataFrame) -> DataFrame:
    """Counts and shares of the labels over all rows, unlabelled ones included."""
    total = or_zero(F.sum("n"))
    counts = {n: or_zero(F.sum(F.when(F.col("sentiment_label") == n, F.col("n"))))
              for n in LABELS}
    return states.agg(
        *[c.alias(n) for n, c in counts.items()], total.alias("total"),
        *[F.coalesce(percent(c, total, 1), F.lit(0.0)).alias(f"{n}_pct")
          for n, c in counts.items()])


def top_states(metrics: DataFrame, kept: tuple[str, ...] = TOP_METRICS) -> DataFrame:
    """The longest list of best products that may be asked for, by each metric."""
    parts = [serving.get_top_products(metrics, name, MAX_TOP_PRODUCTS).withColumn(
        "__ranked_by", F.lit(name)) for name in kept if name in metrics.columns]
    if not parts:
        return metrics.limit(0).withColumn("__ranked_by", F.lit(""))
    return reduce(DataFrame.unionByName, parts)


def top_products(
    states: DataFrame,
    metrics: DataFrame,
    metric: str = "avg_rating",
    limit: int = 10,
    kept: tuple[str, ...] = TOP_METRICS,
    **filters,
) -> DataFrame:
    """Best reviewed products by a metric. A filter, or a metric that was not kept, is answered
    from `metrics`."""
    by = metric if metric in metrics.columns else "avg_rating"
    if by not in kept or any(v is not None for v in filters.values()):
        return serving.get_top_products(metrics, metric, limit, **filters)
    ranked = states.filter(F.col("__ranked_by") == by).drop("__ranked_by")
    return serving.get_top_products(ranked, by, limit)


def move_states(history: DataFrame) -> DataFrame:
    """The longest lists of largest price moves that may be asked for, all and suspicious ones."""
    parts = [serving.price_volatility(history, MAX_VOLATILITY, only).withColumn(
        "__suspicious_only", F.lit(only)) for only in (False, True)]
    return parts[0].unionByName(parts[1])


def volatility(states: DataFrame, limit: int = 20, suspicious_only: bool = False) -> DataFrame:
    """Snapshots with the largest relative change in either direction."""
    ranked = states.filter(F.col("__suspicious_only") == suspicious_only)
    return serving.price_volatility(ranked.drop("__suspicious_only"), limit)
