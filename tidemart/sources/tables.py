"""Lake tables. Parquet by default; any installed Spark format by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.sources.jsonl import load_or_empty

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_parquet_dir(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """The folder's Parquet files as one table; an absent folder is an empty table."""
    reader = spark.read.schema(schema) if schema else spark.read
    return load_or_empty(spark, lambda: reader.parquet(path), schema)


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace a table. Never pass a frame that reads the same path."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_summary(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace a table of few rows by one file, whatever partitions the rows come from."""
    write_table(df.repartition(1), path, fmt)


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace the partitions that `df` has rows of; others keep their files."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_bronze(entities: dict[str, DataFrame], base: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Overwrite each entity's bronze table.

    Empty input writes nothing, and a failing entity does not stop the others; failures
    are raised together at the end.
    """
    failures = []
    for name, df in entities.items():
        try:
            if not df.isEmpty():
                write_table(df, f"{base}/{name}", fmt)
        except Exception as error:
            failures.append(RuntimeError(f"bronze {name}: {error}"))
    if failures:
        raise ExceptionGroup("bronze ingestion", failures)


def reload_tables(spark: SparkSession, paths: list[str]) -> None:
    """Forget cached file listings and data, so the next read sees a finished run."""
    for path in paths:
        spark.catalog.refreshByPath(path)
