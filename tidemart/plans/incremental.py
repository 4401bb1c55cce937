"""Landed files to silver without reading earlier days again.

A stream over the landing folder brings the files not seen yet. Their records are added to bronze,
in folders of snapshot day and run. Only keys among them can change in silver: all bronze records
of these keys are cleaned anew, from the days that hold any, and silver is rewritten for those
days alone: its other rows of the days, and the new survivors. Other days keep their files. The
result is what a rebuild from all files gives.

A run that breaks off and starts again replaces what it wrote: its folders in bronze have its name,
and silver follows from bronze.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.columns import as_timestamp
from tidemart.operators import cleansing, quality
from tidemart.schemas import RAW_PRODUCT, RAW_REVIEW
from tidemart.sources import tables
from tidemart.sources.epochs import stream_id
from tidemart.sources.files import Folder
from tidemart.streaming import ingest

DAY, RUN = "__day", "__run"
NO_DAY = "none"


@dataclass(frozen=True)
class Entity:
    """`keys` tell records apart; `time` gives the day that a record is filed under."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    time: str
    clean: Callable[..., DataFrame]
    rules: list[quality.Rule]


PRODUCTS = Entity("products", RAW_PRODUCT, ("product_id", "scraped_at"), "scraped_at",
                  cleansing.clean_products, quality.PRODUCT_RULES)
REVIEWS = Entity("reviews", RAW_REVIEW, ("review_id",), "created_at",
                 cleansing.clean_reviews, quality.REVIEW_RULES)


def _with_day(rows: DataFrame, entity: Entity) -> DataFrame:
    at = as_timestamp(rows, entity.time) if entity.time in rows.columns else F.lit(None)
    return rows.withColumn(DAY, F.coalesce(
        F.date_format(at.cast("timestamp"), "yyyy-MM-dd"), F.lit(NO_DAY)))


def _key(rows: DataFrame, name: str) -> Column:
    """A key as silver has it, so that two spellings of one time are the same key."""
    return as_timestamp(rows, name) if name == "scraped_at" else rows[name]


def _of_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    same = [_key(rows, c).eqNullSafe(keys[f"__{c}"])
            for c in (k.removeprefix("__") for k in keys.columns)]
    return rows.join(keys, reduce(Column.__and__, same), how)


def merge(lake, entity: Entity, batch: DataFrame, run: str, run_ts: datetime,
          tie_break: list[Column] | None = None) -> list[str]:
    """Add a run's records to bronze and silver; returns the days of silver it rewrote.

    The cleaned records of the touched keys stay in `staging/<entity>` for quarantine and report.
    """
    spark, name = lake.spark, entity.name
    lake.write(batch, f"staging/{name}_landed")
    new = lake.read(f"staging/{name}_landed")
    tables.replace_partitions(_with_day(new, entity).withColumn(RUN, F.lit(run)),
                              lake.path(f"bronze/{name}"), [DAY, RUN])
    bronze_schema = T.StructType([*new.schema.fields, T.StructField(DAY, T.StringType()),
                                  T.StructField(RUN, T.StringType())])
    bronze = spark.read.schema(bronze_schema).parquet(lake.path(f"bronze/{name}"))
    keys = new.select(*[_key(new, c).alias(f"__{c}") for c in entity.keys]).distinct()
    days = [r[DAY] for r in _of_keys(bronze.select(*entity.keys, DAY), keys, "left_semi")
            .select(DAY).distinct().collect()]  # as many as the calendar has
    touched = _of_keys(bronze.filter(F.col(DAY).isin(days)), keys, "left_semi").drop(RUN)
    lake.write(entity.clean(touched, F.lit(run_ts), tie_break), f"staging/{name}")
    staged = lake.read(f"staging/{name}", hidden=True)
    valid = quality.valid_rows(staged, entity.rules).drop(ingest.CORRUPT)
    silver = lake.path(f"silver/{name}")
    before = set(Folder(spark, silver).partitions(DAY))
    if before & set(days):
        held = spark.read.schema(valid.schema).parquet(silver).filter(F.col(DAY).isin(days))
        valid = valid.unionByName(_of_keys(held, keys, "left_anti"))
    lake.write(valid, f"staging/{name}_merged")
    merged = lake.read(f"staging/{name}_merged", hidden=True)
    tables.replace_partitions(merged, silver, [DAY])
    left = {r[DAY] for r in merged.select(DAY).distinct().collect()}
    for day in (before & set(days)) - left:
        Folder(spark, silver).remove(f"{DAY}={day}")
    return sorted(days)


def land(lake, entity: Entity, landing: str, run_ts: datetime,
         after: Callable[[], None] | None = None,
         tie_break: list[Column] | None = None) -> int:
    """Bring all files landed since the last call to bronze and silver; returns how many batches
    there were. `after` runs after each of them."""
    spark = lake.spark
    path, checkpoint = f"{landing}/{entity.name}", lake.path(f"checkpoints/{entity.name}")
    if not Folder(spark, path).names():
        return 0
    done = []

    def each(batch: DataFrame, epoch: int) -> None:
        run = f"{stream_id(spark, checkpoint)[:8]}-{epoch}"
        merge(lake, entity, batch, run, run_ts, tie_break)
        if after:
            after()
        done.append(run)

    rows = ingest.landed_stream(spark, path, entity.schema)
    ingest.run_to_end(ingest.each_available(rows, checkpoint, each))
    return len(done)
