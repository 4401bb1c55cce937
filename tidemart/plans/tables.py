"""Lake tables over one test-data folder, written once per session and then read."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators import name_index, summaries
from tidemart.operators.cleansing import clean_products, clean_reviews, snapshot_keys
from tidemart.operators.metrics import product_metrics
from tidemart.operators.ordered import repeated_keys
from tidemart.operators.quality import PRODUCT_RULES, REVIEW_RULES, valid_rows
from tidemart.operators.sentiment import lexicon_scorer, score_sentiment
from tidemart.operators.topics import negative_topics
from tidemart.plans import derived, gold_tables
from tidemart.session import shared_dir
from tidemart.sources.keyed import KeyedTable, write_keyed
from tidemart.sources.tables import write_summary

# Up to this many repeated keys (some 100 bytes each) are sent to every executor; with more, all
# rows are shuffled. Both ways give the same rows.
MAX_LISTED = 3_000_000

RUN_TS = datetime(2024, 6, 1, 12, 30, 45)

_written: set[str] = set()
_opened: dict[str, KeyedTable] = {}
_schemas: dict[str, T.StructType] = {}


class Tables:
    """Raw views are lazy; silver and gold come from written tables, as in a daily run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.run_ts = F.lit(str(RUN_TS)).cast("timestamp")

    @property
    def base(self) -> str:
        app = self.spark.sparkContext.applicationId
        source = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:8]
        return f"{shared_dir(self.spark)}/tidemart/{app}/{source}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def once(self, name: str, write: Callable[[str], object]) -> str:
        """Run `write` for this path the first time only; returns the path."""
        path = self.path(name)
        if path not in _written:
            write(path)
            _written.add(path)
        return path

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = self.once(name, lambda p: build().write.mode("overwrite").option(
            "compression", "zstd").parquet(p))
        return self.spark.read.parquet(path)

    def keyed(
        self, name: str, build: Callable[[], DataFrame], key: str = "product_id"
    ) -> KeyedTable:
        """A table in ranges of the key, opened once for each session."""
        return self.opened(name, lambda p: write_keyed(build(), p, key))

    def opened(self, name: str, write: Callable[[str], None]) -> KeyedTable:
        path = self.once(name, write)
        if path not in _opened:
            _opened[path] = KeyedTable(self.spark, path)
        return _opened[path]

    def source(self, name: str) -> DataFrame:
        return derived.table(self.spark, self.sf_dir, name)

    # Raw views

    def raw_products(self) -> DataFrame:
        return derived.raw_products(self.spark, self.sf_dir)

    def raw_reviews(self) -> DataFrame:
        return derived.raw_reviews(self.spark, self.sf_dir)

    def review_texts(self) -> DataFrame:
        return derived.review_texts(self.spark, self.sf_dir)

    def search_responses(self) -> DataFrame:
        return derived.search_responses(self.spark, self.sf_dir)

    def rating_responses(self) -> DataFrame:
        return derived.rating_responses(self.spark, self.sf_dir)

    def http_requests(self) -> DataFrame:
        return derived.http_requests(self.spark, self.sf_dir)

    def http_counters(self) -> DataFrame:
        return self.stored(
            "http_counters", lambda: derived.http_counters(self.spark, self.sf_dir)
        )

    # Cleaned, not gated

    def clean_products(self) -> DataFrame:
        return clean_products(self.raw_products(), self.run_ts, derived.snapshot_ties())

    def clean_reviews(self) -> DataFrame:
        return clean_reviews(self.raw_reviews(), self.run_ts)

    def clean_texts(self) -> DataFrame:
        return clean_reviews(self.review_texts(), self.run_ts)

    # Lake

    def repeats(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame | None:
        """The keys of `rows` that repeat; None if they are too many to send around."""
        found = self.counted_repeats(name, rows, keys).select(*keys)
        return found if found.count() <= MAX_LISTED else None

    def counted_repeats(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        """The keys of `rows` that repeat, with the number `n` of their rows."""
        return self.stored(
            f"silver/{name}_repeated", lambda: repeated_keys(rows, keys, counts="n"))

    def bronze_product_repeats(self) -> DataFrame:
        """The list that silver is made with, for the profile of bronze."""
        raw = self.bronze_products()
        return self.counted_repeats("products", raw, snapshot_keys(raw))

    def listed_products(self) -> DataFrame:
        """As `clean_products`, shuffling only rows of repeated keys. It reads the written bronze
        rows, so that the joins that make them, which shuffle all rows of large tables, run once."""
        raw = self.bronze_products()
        repeated = self.repeats("products", raw, snapshot_keys(raw))
        return clean_products(raw, self.run_ts, derived.snapshot_ties(), repeated)

    def listed_reviews(self, name: str, raw: DataFrame) -> DataFrame:
        return clean_reviews(raw, self.run_ts, None, self.repeats(name, raw, ["review_id"]))

    def bronze_products(self) -> DataFrame:
        return self.stored("bronze/products", self.raw_products)

    def bronze_reviews(self) -> DataFrame:
        return self.stored("bronze/reviews", self.raw_reviews)

    def silver_products(self) -> DataFrame:
        return self.stored(
            "silver/products", lambda: valid_rows(self.listed_products(), PRODUCT_RULES)
        )

    def silver_reviews(self) -> DataFrame:
        return self.stored(
            "silver/reviews", lambda: valid_rows(
                self.listed_reviews("reviews", self.raw_reviews()), REVIEW_RULES)
        )

    def metrics_table(self) -> KeyedTable:
        return self.keyed("gold/product_metrics", lambda: product_metrics(
            self.silver_products(), self.silver_reviews(), self.run_ts
        ))

    def metrics(self) -> DataFrame:
        return self.metrics_table().read()

    def names_table(self) -> KeyedTable:
        return self.keyed("index/names", lambda: name_index.postings(self.metrics()), "gram")

    def history_table(self) -> KeyedTable:
        return self.opened("gold/price_history", lambda p: gold_tables.write_history(
            self.silver_products(), p, self.run_ts
        ))

    def history(self) -> DataFrame:
        return self.history_table().read()

    def scorer(self):
        return lexicon_scorer(derived.POSITIVE_WORDS, derived.NEGATIVE_WORDS)

    def _text_rows(self) -> DataFrame:
        return self.listed_reviews("texts", self.review_texts())

    def sentiments_table(self) -> KeyedTable:
        """The sentiments dealt to ranges of the product, for lookups."""
        return self.opened("gold/reviews_sentiment", lambda p: gold_tables.write_sentiments(
            self._text_rows(), p, self.scorer()
        ))

    def sentiments(self) -> DataFrame:
        """The sentiments for reads of all rows: unless the dealt table is there, they are
        written as the reviews come, so that no text is shuffled."""
        if self.path("gold/reviews_sentiment") in _written:
            return self.sentiments_table().read()
        return self.stored("gold/sentiments", lambda: score_sentiment(
            self._text_rows(), self.scorer()))

    def topics(self) -> DataFrame:
        return self.stored("gold/negative_topics", lambda: negative_topics(
            self.sentiments(), stopwords=derived.TOPIC_STOPWORDS
        ))

    # States of the overview queries

    def summary(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A small table in one file, with the schema remembered, so opening it runs no job."""
        path = self.once(f"summary/{name}", lambda p: write_summary(build(), p))
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def keyword_states(self) -> DataFrame:
        return self.summary("keywords", lambda: summaries.keyword_states(self.metrics()))

    def label_states(self) -> DataFrame:
        return self.summary("labels", lambda: summaries.label_states(self.sentiments()))

    def top_states(self) -> DataFrame:
        return self.summary("top", lambda: summaries.top_states(self.metrics()))

    def move_states(self) -> DataFrame:
        return self.summary("moves", lambda: summaries.move_states(self.history()))
