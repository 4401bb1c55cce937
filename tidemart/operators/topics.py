"""Most frequent phrases of negative reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import text_column
from tidemart.functions.text import ngrams, strip_all, tokens, without

# Words left out before phrases are formed.
VIETNAMESE_STOPWORDS = """
    là thì mà có không rất quá nhưng và của cho
    những các một như với được bị sẽ đã đang cũng
    còn nên ra lại này kia đó đây ấy vậy rồi
    nữa hơi lắm thế nào mới thấy hàng sản_phẩm shop mua
    giao nhận sp người khi trong ngoài về làm nhé nha ạ
    mình bạn tôi em anh chị
""".split()

MIN_DOCUMENTS = 2
MAX_VOCABULARY = 100
TOP_TOPICS = 20


def negative_reviews(sentiments: DataFrame) -> DataFrame:
    return sentiments.filter(F.col("sentiment_label") == "negative")


def normal_text(df: DataFrame, text_col: str | None = None) -> DataFrame:
    """Only the review text: nulls dropped, lower-cased, stripped."""
    text = F.col(text_column(df, text_col))
    return df.filter(text.isNotNull()).select(strip_all(F.lower(text)).alias("text"))


def document_tokens(texts: DataFrame, stopwords: list[str]) -> DataFrame:
    return texts.select(without(tokens(F.col("text")), stopwords).alias("words"))


def document_phrases(words: DataFrame, sizes: tuple[int, int] = (2, 3)) -> DataFrame:
    """One sorted phrase array per document."""
    each = [ngrams(F.col("words"), n) for n in range(sizes[0], sizes[1] + 1)]
    return words.select(F.sort_array(F.concat(*each)).alias("phrases"))


def phrase_counts(phrases: DataFrame) -> DataFrame:
    """`(topic, count, documents)`: occurrences, and documents that hold the phrase.

    Phrases are sorted within a document, so the last of each run marks the document once.
    Both counts are then plain sums by phrase: one shuffle of partial sums, never a
    (phrase, document) pair.
    """
    following = F.slice("phrases", 2, F.greatest(F.size("phrases"), F.lit(0)))
    marked = F.zip_with(
        F.col("phrases"), following,
        lambda p, nxt: F.struct(
            p.alias("topic"), (nxt.isNull() | (p != nxt)).cast("int").alias("ends_run")
        ),
    )
    return phrases.select(F.inline(marked)).groupBy("topic").agg(
        F.count(F.lit(1)).alias("count"), F.sum("ends_run").alias("documents")
    )


def frequent_phrases(counts: DataFrame, min_df: int = MIN_DOCUMENTS) -> DataFrame:
    return counts.filter(F.col("documents") >= min_df)


def top_phrases(
    counts: DataFrame, max_features: int = MAX_VOCABULARY, k: int = TOP_TOPICS
) -> DataFrame:
    """The `k` most frequent. The vocabulary cap keeps the most frequent phrases too, so
    only the smaller of the two limits matters."""
    return (
        counts.select("topic", "count")
        .orderBy(F.desc("count"), "topic")
        .limit(min(max_features, k))
    )


def top_ngrams(
    df: DataFrame,
    text_col: str | None = None,
    stopwords: list[str] | None = None,
    n: tuple[int, int] = (2, 3),
    min_df: int = MIN_DOCUMENTS,
    max_features: int = MAX_VOCABULARY,
    k: int = TOP_TOPICS,
) -> DataFrame:
    words = VIETNAMESE_STOPWORDS if stopwords is None else stopwords
    phrases = document_phrases(document_tokens(normal_text(df, text_col), words), n)
    return top_phrases(frequent_phrases(phrase_counts(phrases), min_df), max_features, k)


def negative_topics(sentiments: DataFrame, **options) -> DataFrame:
    return top_ngrams(negative_reviews(sentiments), **options)
