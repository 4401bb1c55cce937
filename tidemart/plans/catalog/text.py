"""Sentiment and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.columns import text_column
from tidemart.operators import sentiment, topics
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.derived import TOPIC_STOPWORDS
from tidemart.plans.registry import query


@query("n1_text_column", with_views("select review_id, review_text as text from review_texts"))
def _(t):
    renamed = t.review_texts().withColumnRenamed("review_text", "comment")
    return renamed.select("review_id", F.col(text_column(renamed)).alias("text"))


@query("n2_sentiment_label", with_views(
    "select review_id, sentiment_label, sentiment_score from sentiments"))
def _(t):
    scored = sentiment.score_sentiment(t.clean_texts(), t.scorer())
    return scored.select("review_id", "sentiment_label", "sentiment_score")


@query("n2_model_scorer", with_views(r"""
    select review_id,
      case when regexp_matches(review_text, '[!?]') then 'negative' else 'neutral' end
        as sentiment_label
    from clean_texts"""))
def _(t):
    scored = sentiment.score_sentiment(t.clean_texts(), sentiment.model_scorer(_load_model))
    return scored.select("review_id", "sentiment_label")


def _load_model():
    def predict(texts):
        asks = texts.str.contains("[!?]")
        return asks.map({True: "NEGATIVE (0.9)", False: "other"})

    return predict


@query("n2_failed_rows", with_views(r"""
    select count(*) as scored, count(*) filter (regexp_matches(review_text, '[!?]')) as failed
    from clean_texts where regexp_matches(review_text, '\S')"""))
def _(t):
    def load():
        def predict(texts):
            if texts.str.contains("[!?]").any():
                raise ValueError("no label for this text")
            return texts.map(lambda _: "positive")

        return predict

    return sentiment.failed_rows(t.clean_texts(), sentiment.model_scorer(load))


@query("n3_sentiment_table", with_views("""
    select review_id, product_id, review_text, sentiment_label, sentiment_score
    from sentiments"""))
def _(t):
    return sentiment.score_sentiment(t.clean_texts(), t.scorer()).drop("processed_at")


@query("n4_label_distribution", with_views(f"""
    select sentiment_label, count(*) as reviews,
      {rnd("count(*) / (select count(*) from sentiments) * 100", 1)} as share_pct
    from sentiments group by 1"""))
def _(t):
    return sentiment.sentiment_distribution(t.sentiments())


@query("n5_negative_filter", with_views("""
    select review_id, sentiment_score from sentiments where sentiment_label = 'negative'"""))
def _(t):
    return topics.negative_reviews(t.sentiments()).select("review_id", "sentiment_score")


@query("n6_normal_text", with_views(r"""
    select regexp_replace(lower(review_text), '^\s+|\s+$', '', 'g') as text
    from clean_texts"""))
def _(t):
    return topics.normal_text(t.clean_texts())


@query("n7_document_tokens", with_views("""
    select array_to_string(toks, ' ') as words from negative_words"""))
def _(t):
    texts = topics.normal_text(topics.negative_reviews(t.sentiments()))
    tokens = topics.document_tokens(texts, TOPIC_STOPWORDS)
    return tokens.select(F.array_join("words", " ").alias("words"))


def _phrases(t):
    texts = topics.normal_text(topics.negative_reviews(t.sentiments()))
    return topics.document_phrases(topics.document_tokens(texts, TOPIC_STOPWORDS))


@query("n8_ngrams", with_views("""
    select topic, count(*) as count from negative_phrases group by topic"""))
def _(t):
    phrases = _phrases(t).select(F.explode("phrases").alias("topic"))
    return phrases.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))


@query("n9_document_frequency", with_views("""
    select topic, count, documents from phrase_counts where documents >= 2"""))
def _(t):
    return topics.frequent_phrases(topics.phrase_counts(_phrases(t)))


@query("n10_top_phrases", with_views("select topic, count from negative_topics"))
def _(t):
    counts = topics.frequent_phrases(topics.phrase_counts(_phrases(t)))
    return topics.top_phrases(counts)


@query("n11_negative_topics", with_views("select topic, count from negative_topics"))
def _(t):
    return topics.negative_topics(t.sentiments(), stopwords=TOPIC_STOPWORDS)
