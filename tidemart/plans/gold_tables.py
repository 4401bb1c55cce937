"""Large gold tables, dealt to ranges of the product before their rows are made.

Silver rows are dealt once, and the windows and scores of the table are computed on the dealt rows,
so that neither a draft of the table nor a second shuffle of it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemart.functions.columns import present
from tidemart.operators.history import HISTORY_COLUMNS, price_history
from tidemart.operators.ordered import HOT_ROWS, any_hot
from tidemart.operators.sentiment import Scorer, score_sentiment
from tidemart.sources.keyed import write_keyed


def write_history(
    silver: DataFrame, path: str, run_ts: Column | None = None, hot_rows: int = HOT_ROWS
) -> None:
    """The price history of all products. Where a product is hot, its rows are cut into chunks
    first, and the finished table is dealt."""
    if any_hot(silver, ["product_id"], hot_rows):
        write_keyed(price_history(silver, run_ts=run_ts, few_repeats=True, hot_rows=hot_rows), path)
        return
    write_keyed(
        silver.select(*present(silver, HISTORY_COLUMNS)), path, whole_keys=True,
        then=lambda dealt: price_history(dealt, run_ts=run_ts, few_repeats=True, hot_rows=None))


def write_sentiments(reviews: DataFrame, path: str, scorer: Scorer) -> None:
    write_keyed(reviews, path, then=lambda dealt: score_sentiment(dealt, scorer))
