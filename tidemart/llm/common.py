"""Helpers shared by the operators: written intermediates and joins that check a size first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import ship_code, shared_dir  # noqa: F401

# Id lists up to this many rows (16 bytes each) are sent to every executor; longer ones are
# joined by a shuffle. Both ways give the same rows.
BROADCAST_IDS = 500_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sized_ids(ids: DataFrame) -> DataFrame:
    """`ids` (already written), marked for broadcast if a count shows that it is short."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Names like the stems that no column of `df` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return [stem + "_" * next(i for i in range(1, len(taken) + 2)
                              if (stem + "_" * i).lower() not in taken) for stem in stems]
