import re
from collections import Counter

import pytest
from conftest import column, rows
from pyspark.sql import functions as F

from tidemart.functions import text as tx
from tidemart.functions.columns import text_column
from tidemart.operators import sentiment, topics

SCORER = sentiment.lexicon_scorer(["tốt", "great"], ["tệ", "bad"])


def texts(spark, *values, name="review_text"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("value, label", [
    ("", "neutral"), (None, "neutral"), (" \t\n ", "neutral"), ("Rất TỐT", "positive"),
    ("tệ quá, bad", "negative"), ("great but bad", "neutral"), ("badly", "neutral"),
])
def test_lexicon_labels(spark, value, label):
    got = rows(sentiment.score_sentiment(texts(spark, value), SCORER))[0]
    assert got["sentiment_label"] == label
    assert got["sentiment_score"] == {"positive": 1.0, "negative": -1.0, "neutral": 0.0}[label]


@pytest.mark.parametrize("raw, label", [
    ("positive", "positive"), (" NEGATIVE ", "negative"), ("label:Positive (0.9)", "positive"),
    ("general#negative", "negative"), ("mixed", "neutral"), (None, "neutral"),
    ("positive and negative", "positive"),
])
def test_raw_labels_map_by_content(spark, raw, label):
    df = texts(spark, raw).select(sentiment.normal_label(F.col("review_text")).alias("x"))
    assert column(df, "x") == [label]


def test_model_scorer_survives_failing_rows(spark):
    def load():
        def predict(batch):
            if batch.str.contains("boom").any():
                raise RuntimeError("boom")
            return batch.map(lambda text: "negative" if "bad" in text else "positive")
        return predict

    df = texts(spark, "bad", "good", "boom", "", None)
    got = sentiment.score_sentiment(df, sentiment.model_scorer(load))
    assert column(got, "sentiment_label") == [
        "negative", "positive", "neutral", "neutral", "neutral"]
    counts = sentiment.failed_rows(df, sentiment.model_scorer(load)).first()
    assert (counts.scored, counts.failed) == (3, 1)


def test_text_column_preference(spark):
    df = spark.createDataFrame([("a", "b", "c")], "text string, content string, comment string")
    assert text_column(df) == "comment"
    assert text_column(df, "text") == "text"
    with pytest.raises(ValueError):
        text_column(spark.range(1))


def test_distribution(spark):
    df = texts(spark, "bad", "bad", "x", name="review_text")
    got = sentiment.sentiment_distribution(sentiment.score_sentiment(df, SCORER)).collect()
    assert [tuple(r) for r in got] == [("negative", 2, 66.7), ("neutral", 1, 33.3)]


def test_strip_and_blank(spark):
    df = texts(spark, "\t a b\n", " ", None)
    assert column(df.select(tx.strip_all(F.col("review_text")).alias("x")), "x") == [
        "a b", "", None]
    assert column(df.select(tx.is_blank(F.col("review_text")).alias("x")), "x") == [
        False, True, True]


DOCS = [
    "Hàng giao chậm lắm, giao chậm quá", "giao chậm và hỏng", "Chất lượng kém kém kém",
    "a b c", "", "chất lượng KÉM", "pin yếu. Pin yếu! pin yếu",
]


def brute_force(docs, stopwords, min_df, k):
    counts, documents = Counter(), Counter()
    for doc in docs:
        words = [w for w in re.findall(r"\b\w\w+\b", doc.lower()) if w not in stopwords]
        grams = [" ".join(words[i:i + n]) for n in (2, 3) for i in range(len(words) - n + 1)]
        counts.update(grams)
        documents.update(set(grams))
    kept = [(t, c) for t, c in counts.items() if documents[t] >= min_df]
    return sorted(kept, key=lambda e: (-e[1], e[0]))[:k]


@pytest.mark.parametrize("stopwords, min_df", [
    (topics.VIETNAMESE_STOPWORDS, 2), (topics.VIETNAMESE_STOPWORDS, 1), ([], 2), (["chậm"], 1),
])
def test_top_ngrams_equal_brute_force(spark, stopwords, min_df):
    got = topics.top_ngrams(texts(spark, *DOCS, None), stopwords=stopwords, min_df=min_df)
    assert [tuple(r) for r in got.collect()] == brute_force(DOCS, stopwords, min_df, 20)


def test_phrases_bridge_removed_words(spark):
    got = topics.top_ngrams(texts(spark, "pin rất yếu"), min_df=1)
    assert [tuple(r) for r in got.collect()] == [("pin yếu", 1)]


def test_document_frequency_counts_documents_not_occurrences(spark):
    df = texts(spark, "aa bb aa bb aa bb", "cc dd", "cc dd")
    assert [tuple(r) for r in topics.top_ngrams(df, stopwords=[]).collect()] == [("cc dd", 2)]


def test_limits(spark):
    df = texts(spark, *DOCS)
    assert topics.top_ngrams(df, min_df=1, k=3).count() == 3
    assert topics.top_ngrams(df, min_df=1, max_features=2, k=3).count() == 2


def test_stopword_list():
    assert len(topics.VIETNAMESE_STOPWORDS) == len(set(topics.VIETNAMESE_STOPWORDS)) == 62


def test_only_negative_reviews_make_topics(spark):
    df = spark.createDataFrame(
        [("pin yếu", "negative"), ("pin yếu", "negative"), ("rẻ đẹp", "positive"),
         ("rẻ đẹp", "positive")], "review_text string, sentiment_label string")
    assert [tuple(r) for r in topics.negative_topics(df).collect()] == [("pin yếu", 2)]
    none = topics.negative_topics(df.filter("sentiment_label = 'positive'"))
    assert none.collect() == []
