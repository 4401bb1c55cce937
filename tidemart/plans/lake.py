"""The daily run: landing -> bronze -> silver -> gold -> text tables, in that order.

Each step reads written tables and writes one table, so a lost executor recomputes at
most one step and no step depends on cached blocks.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators import (
    cleansing, history, metrics, name_index, profiling, quality, summaries,
)
from tidemart.operators.sentiment import Scorer, score_sentiment
from tidemart.operators.topics import negative_topics
from tidemart.plans import incremental
from tidemart.schemas import NEGATIVE_TOPIC, RAW_PRODUCT, RAW_REVIEW
from tidemart.sources import jsonl, keyed, reports, tables


@dataclass(frozen=True)
class Lake:
    """Where the tables are and in which format."""

    spark: SparkSession
    base: str
    fmt: str = tables.DEFAULT_FORMAT

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def read(self, name: str, hidden: bool = False) -> DataFrame:
        """A table; columns that only place its rows in folders are left out unless `hidden`."""
        found = tables.read_table(self.spark, self.path(name), self.fmt)
        return found if hidden else found.drop(*[c for c in found.columns if c.startswith("__")])

    def write(self, df: DataFrame, name: str) -> None:
        if name.startswith("gold/") and self.fmt == tables.DEFAULT_FORMAT:
            keyed.write_keyed(df, self.path(name))
        else:
            tables.write_table(df, self.path(name), self.fmt)

    def keyed(self, name: str) -> keyed.KeyedTable:
        """A gold table or index with its files' ranges, for lookups of one key."""
        return keyed.KeyedTable(self.spark, self.path(name))


def land_to_bronze(
    lake: Lake,
    landing: str,
    schemas: dict[str, T.StructType] | None = None,
) -> None:
    """Overwrite bronze with everything landed so far, corrupt lines included: they have
    no ids, so the silver gates reject them."""
    wanted = schemas or {"products": RAW_PRODUCT, "reviews": RAW_REVIEW}
    landed = {
        name: jsonl.read_jsonl(lake.spark, f"{landing}/{name}", schema)
        for name, schema in wanted.items()
    }
    tables.write_bronze(landed, lake.path("bronze"), lake.fmt)


def _silver(
    lake: Lake, entity: str, cleaned: DataFrame, rules: list[quality.Rule], run_ts: datetime
) -> dict:
    """Write the cleaned rows once, then split that table: valid rows to silver, rejected
    ones to quarantine, counts to the report. The counts ride on the silver write."""
    lake.write(cleaned, f"staging/{entity}")
    staged = lake.read(f"staging/{entity}")
    counts = Observation(f"{entity}_quality")
    observed = staged.observe(counts, *quality.report_columns(staged, rules))
    lake.write(quality.valid_rows(observed, rules).drop(jsonl.CORRUPT), f"silver/{entity}")
    return _file_rejects(lake, entity, rules, run_ts, counts.get)


def _file_rejects(
    lake: Lake, entity: str, rules: list[quality.Rule], run_ts: datetime, counts: dict
) -> dict:
    """Rejected rows of the staged table to quarantine, and the report."""
    staged = lake.read(f"staging/{entity}")
    reports.write_rejected(
        quality.rejected_rows(staged, entity, rules),
        lake.path("quality/rejected"), run_ts.strftime("%Y-%m-%d"),
    )
    report = {"entity": entity, "run_at": run_ts.isoformat(), **counts}
    row = lake.spark.range(1).select(*[F.lit(v).alias(k) for k, v in report.items()])
    reports.write_report(row, lake.path("quality/reports"), entity,
                         run_ts.strftime("%Y%m%d_%H%M%S"))
    return report


def silver_incremental(
    lake: Lake, entity: incremental.Entity, landing: str, run_ts: datetime,
    tie_break: list[Column] | None = None,
) -> dict | None:
    """Files landed since the last run to bronze and silver. The report counts the cleaned
    records of the touched keys; without new files there is none."""
    found: list[dict] = []

    def after() -> None:
        staged = lake.read(f"staging/{entity.name}")
        counts = staged.agg(*quality.report_columns(staged, entity.rules)).first().asDict()
        found.append(_file_rejects(lake, entity.name, entity.rules, run_ts, counts))

    incremental.land(lake, entity, landing, run_ts, after, tie_break)
    return found[-1] if found else None


def write_file_ledger(lake: Lake, landing: str, entities: list[str], run_id: str) -> None:
    """What became of every landed file; unreadable ones are listed by path."""
    for name in entities:
        ledger = jsonl.file_ledger(lake.spark, f"{landing}/{name}").withColumn(
            "entity", F.lit(name))
        ledger.coalesce(1).write.mode("overwrite").parquet(
            lake.path(f"quality/files/run={run_id}/of={name}"))


def silver_products(
    lake: Lake, run_ts: datetime, tie_break: list[Column] | None = None
) -> dict:
    cleaned = cleansing.clean_products(lake.read("bronze/products"), F.lit(run_ts), tie_break)
    return _silver(lake, "products", cleaned, quality.PRODUCT_RULES, run_ts)


def silver_reviews(
    lake: Lake, run_ts: datetime, tie_break: list[Column] | None = None
) -> dict:
    cleaned = cleansing.clean_reviews(lake.read("bronze/reviews"), F.lit(run_ts), tie_break)
    return _silver(lake, "reviews", cleaned, quality.REVIEW_RULES, run_ts)


def gold_metrics(lake: Lake, run_ts: datetime) -> None:
    built = metrics.product_metrics(
        lake.read("silver/products"), lake.read("silver/reviews"), F.lit(run_ts)
    )
    lake.write(built, "gold/product_metrics")


def gold_history(lake: Lake, run_ts: datetime) -> None:
    built = history.price_history(
        lake.read("silver/products"), run_ts=F.lit(run_ts), few_repeats=True
    )
    lake.write(built, "gold/price_history")


def gold_sentiment(lake: Lake, scorer: Scorer) -> None:
    lake.write(score_sentiment(lake.read("silver/reviews"), scorer), "gold/reviews_sentiment")


def gold_topics(lake: Lake, stopwords: list[str] | None = None) -> None:
    """No negative review, no table content: the topics table is then empty."""
    built = negative_topics(lake.read("gold/reviews_sentiment"), stopwords=stopwords)
    lake.write(built.select(*NEGATIVE_TOPIC.fieldNames()), "gold/negative_topics")


def gold_summaries(lake: Lake) -> None:
    """States of the overview queries, from the gold tables just written."""
    products = lake.read("gold/product_metrics")
    built = {
        "keywords": summaries.keyword_states(products),
        "labels": summaries.label_states(lake.read("gold/reviews_sentiment")),
        "top": summaries.top_states(products),
        "moves": summaries.move_states(lake.read("gold/price_history")),
    }
    for name, df in built.items():
        tables.write_summary(df, lake.path(f"summary/{name}"), lake.fmt)


def gold_name_index(lake: Lake) -> None:
    """Trigrams of the product names, for `name_index.search`."""
    products = lake.read("gold/product_metrics")
    if lake.fmt == tables.DEFAULT_FORMAT and "name" in products.columns:
        keyed.write_keyed(name_index.postings(products), lake.path("index/names"), "gram")


# Layer labels.
PROFILED = {
    "Bronze.Products": "bronze/products",
    "Bronze.Reviews": "bronze/reviews",
    "Silver.Products": "silver/products",
    "Silver.Reviews": "silver/reviews",
    "Gold.Metrics": "gold/product_metrics",
    "Gold.PriceHistory": "gold/price_history",
    "Gold.Sentiment": "gold/reviews_sentiment",
    "Gold.Topics": "gold/negative_topics",
}


def layer_measures(
    lake: Lake, layers: dict[str, str] | None = None, run_id: str = "latest"
) -> DataFrame:
    """Measures of all layers; one not written yet or unreadable is reported as such.

    Each layer is counted and its few measure rows are written on their own, so a corrupt part
    file stops its own layer only.
    """
    parts = []
    for label, name in (layers or PROFILED).items():
        path = f"{lake.path('reports')}/measures/{run_id}/{label}"
        try:
            df = tables.read_parquet_dir(lake.spark, lake.path(name)) \
                if lake.fmt == "parquet" else lake.read(name)
            found = profiling.measures(df, label) if df.columns \
                else profiling.absent_measures(lake.spark, label)
            found.coalesce(1).write.mode("overwrite").parquet(path)
            parts.append(lake.spark.read.schema(found.schema).parquet(path))
        except Exception:
            parts.append(profiling.absent_measures(lake.spark, label, "error"))
    return profiling.union_measures(parts)


def quality_check(lake: Lake, run_ts: datetime) -> DataFrame:
    """Write profile, funnel and roll-up reports and one document with all of them; returns the
    profile."""
    started = time.monotonic()
    run_id = run_ts.strftime("%Y%m%d_%H%M%S")
    reports_dir = lake.path("reports")
    long = layer_measures(lake, run_id=run_id)
    profiles = profiling.profile(long)
    reports.write_report(profiles, reports_dir, "profile", run_id)
    written = reports.read_report(lake.spark, profiles.schema, reports_dir, "profile", run_id)
    counts = written.select(F.col("layer").alias("name"), F.col("row_count").alias("rows"))
    steps = profiling.funnel(counts)
    reports.write_report(steps, reports_dir, "funnel", run_id)
    reports.write_report(profiling.roll_up(written), reports_dir, "summary", run_id)
    paths = F.create_map(*[F.lit(x) for label, name in PROFILED.items()
                           for x in (label, lake.path(name))])
    reports.write_report(
        profiling.report_document(written, steps, paths, run_ts.isoformat(),
                                  round(time.monotonic() - started, 1)),
        reports_dir, "document", run_id)
    return written


GOLD = ["gold/product_metrics", "gold/reviews_sentiment", "gold/negative_topics",
        "gold/price_history"]
SUMMARIES = ["summary/keywords", "summary/labels", "summary/top", "summary/moves"]


def run_day(
    lake: Lake,
    landing: str,
    scorer: Scorer,
    run_ts: datetime,
    stopwords: list[str] | None = None,
    only_new: bool = False,
) -> dict[str, dict]:
    """The whole run in order; returns the quality reports of both entities.

    With `only_new`, bronze and silver are brought forward by the files landed since the last such
    run, instead of being rebuilt from all; a lake keeps to one of the two ways.
    """
    write_file_ledger(lake, landing, ["products", "reviews"], run_ts.strftime("%Y%m%d_%H%M%S"))
    if only_new:
        found = {e.name: silver_incremental(lake, e, landing, run_ts)
                 for e in (incremental.PRODUCTS, incremental.REVIEWS)}
    else:
        land_to_bronze(lake, landing)
        found = {
            "products": silver_products(lake, run_ts),
            "reviews": silver_reviews(lake, run_ts),
        }
    gold_metrics(lake, run_ts)
    gold_history(lake, run_ts)
    gold_sentiment(lake, scorer)
    gold_topics(lake, stopwords)
    gold_summaries(lake)
    gold_name_index(lake)
    quality_check(lake, run_ts)
    tables.reload_tables(lake.spark, [lake.path(name) for name in GOLD + SUMMARIES])
    return found
