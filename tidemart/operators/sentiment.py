"""Sentiment labels for review text.

The scorer is pluggable: a function from the text column to a raw label column. The
default counts lexicon words natively; `model_scorer` runs any Python model in Arrow
batches, loading it once per worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import text_column
from tidemart.functions.numeric import percent
from tidemart.functions.text import is_blank, tokens
from tidemart.session import ship_code

Scorer = Callable[[Column], Column]

# Score of each label.
SCORES = {"positive": 1.0, "negative": -1.0, "neutral": 0.0}


def lexicon_scorer(positive: list[str], negative: list[str]) -> Scorer:
    """Positive if more tokens are positive words than negative ones, and vice versa.

    The lexicon becomes part of the expression, so it should stay a word list; anything
    that learns from data belongs in `model_scorer`.
    """

    def score(text: Column) -> Column:
        weights = F.transform(
            tokens(text),
            lambda w: F.when(w.isin(positive), F.lit(1)).when(w.isin(negative), F.lit(-1))
            .otherwise(F.lit(0)),
        )
        balance = F.aggregate(weights, F.lit(0), lambda total, w: total + w)
        # Index by sign, so the tokens are counted once.
        by_sign = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
        return F.element_at(by_sign, F.signum(balance).cast("int") + 2)

    return score


FAILED = "failed"
_models: dict[str, Callable[[pd.Series], pd.Series]] = {}


def _batch_labels(predict: Callable[[pd.Series], pd.Series], texts: pd.Series) -> pd.Series:
    """Labels of a batch; if it fails, of its halves, so that only failing rows are marked."""
    try:
        return pd.Series(predict(texts), index=texts.index).astype("object")
    except Exception:
        if len(texts) <= 1:
            return pd.Series([FAILED] * len(texts), index=texts.index, dtype="object")
        half = len(texts) // 2
        return pd.concat([_batch_labels(predict, part)
                          for part in (texts.iloc[:half], texts.iloc[half:])])


def _loaded(key: str, load: Callable[[], Callable]) -> Callable[[pd.Series], pd.Series]:
    """The model of this worker process."""
    if key not in _models:
        _models[key] = load()
    return _models[key]


def _labels(predict: Callable[[pd.Series], pd.Series], batch: pd.Series) -> pd.Series:
    labels = pd.Series(["neutral"] * len(batch), index=batch.index, dtype="object")
    filled = batch[batch.notna() & (batch != "")]
    if len(filled):
        labels[filled.index] = _batch_labels(predict, filled).astype(str)
    return labels


def model_scorer(
    load: Callable[[], Callable[[pd.Series], pd.Series]], name: str | None = None
) -> Scorer:
    """Wrap a model. `load` returns the function batch of texts -> raw labels; it runs once per
    worker process for each `name`. Rows that the model fails on have the raw label `failed`,
    which counts as neutral; `failed_rows` counts them."""
    key = name or uuid.uuid4().hex
    ship_code(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = _loaded(key, load)
        for batch in batches:
            yield _labels(predict, batch)

    return run


def failed_rows(df: DataFrame, scorer: Scorer, text_col: str | None = None) -> DataFrame:
    """One row: texts that are not blank, and those the model failed on."""
    text = F.col(text_column(df, text_col))
    raw = df.select(F.when(~is_blank(text), scorer(text)).alias("raw"))
    return raw.agg(F.count("raw").alias("scored"),
                   F.count_if(F.col("raw") == FAILED).alias("failed"))


def normal_label(raw: Column) -> Column:
    """Map a model's raw label to one of the three labels by what it contains."""
    low = F.lower(raw)
    return (
        F.when(F.contains(low, F.lit("positive")), "positive")
        .when(F.contains(low, F.lit("negative")), "negative")
        .otherwise("neutral")
    )


def label_score(label: Column) -> Column:
    pairs = [F.lit(x) for pair in SCORES.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), label), F.lit(0.0))


def score_sentiment(df: DataFrame, scorer: Scorer, text_col: str | None = None) -> DataFrame:
    """Add `sentiment_label` and `sentiment_score`; null or blank text is neutral."""
    text = F.col(text_column(df, text_col))
    raw = df.withColumn("__raw", F.when(~is_blank(text), scorer(text)))
    labelled = raw.withColumn("sentiment_label", normal_label(F.col("__raw"))).drop("__raw")
    return labelled.withColumn("sentiment_score", label_score(F.col("sentiment_label")))


def sentiment_distribution(df: DataFrame) -> DataFrame:
    """Rows and share per label. The total is taken over the three label rows."""
    counts = df.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("reviews"))
    total = F.sum("reviews").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share_pct", percent(F.col("reviews"), total, 1)).orderBy(
        F.desc("reviews"), "sentiment_label"
    )
