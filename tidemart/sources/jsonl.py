"""JSON-lines landing zone: day-partitioned sink and recursive scan."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import ship_code

# Landed files end in .jsonl; part files written by this module end in .json.gz.
LANDED_FILES = "*.{jsonl,json,jsonl.gz,json.gz}"
# A compressed file is one task's work when it is read, so it holds a bounded number of records.
RECORDS_PER_FILE = 1_000_000
CORRUPT = "_corrupt_record"

# Conditions Spark reports for an absent folder, and for one without matching files.
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_or_empty(
    spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType | None
) -> DataFrame:
    """The loaded table, or an empty one if there is nothing to load."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
        return spark.createDataFrame([], schema or T.StructType())


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    pattern: str = LANDED_FILES,
) -> DataFrame:
    """All records below `path`. Executors list, read and parse the files.

    Lines that are no JSON come back with only the corrupt-record column set and blank lines
    not at all; of an unreadable file the rest is skipped (`file_ledger` names it), a missing folder
    is an empty table. Without a schema Spark infers one from the files, which costs an extra pass.
    """
    reader = (
        spark.read
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("ignoreCorruptFiles", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if schema is not None:
        if CORRUPT not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    return load_or_empty(spark, lambda: reader.json(path), schema)


@F.pandas_udf(T.LongType())
def _unpacked_bytes(contents: pd.Series) -> pd.Series:
    """Bytes that gzip files hold, of all their members; null if one is broken or cut off."""
    def size(content: bytes) -> int | None:
        total, rest = 0, content
        while rest:
            member = zlib.decompressobj(wbits=31)
            while not member.eof:
                try:
                    part = member.decompress(rest, 1 << 20)
                except zlib.error:
                    return None
                rest = member.unconsumed_tail or member.unused_data
                if not part and not rest and not member.eof:
                    return None
                total += len(part)
        return total

    return pd.Series([size(c) for c in contents], dtype="Int64")


def file_ledger(spark: SparkSession, path: str, pattern: str = LANDED_FILES) -> DataFrame:
    """file_path, bytes, read_bytes, lines, status of every landed file.

    A file is `read` if its lines account for all of its bytes, and `unreadable` if the scan lost
    the rest of it; an empty file has no row. Files are listed from their metadata alone and read once,
    as plain lines. `bytes` of a compressed file (.gz) are those it holds; it is read a second time
    to count them, and where it is broken `bytes` is its own size.
    """
    ship_code(spark)

    def found(reader):
        return reader.option("recursiveFileLookup", True).option(
            "pathGlobFilter", pattern).option("ignoreCorruptFiles", True)

    meta, schema = F.col("_metadata"), T.StructType([
        T.StructField("file_path", T.StringType()), T.StructField("bytes", T.LongType())])
    files = load_or_empty(spark, lambda: found(spark.read.format("binaryFile")).load(path).select(
        meta["file_path"].alias("file_path"), meta["file_size"].alias("bytes")), schema)
    lines = load_or_empty(spark, lambda: found(spark.read.option("lineSep", "\n")).text(
        path).select(meta["file_path"].alias("file_path"), F.octet_length("value").alias("size")),
        T.StructType([T.StructField("file_path", T.StringType()),
                      T.StructField("size", T.IntegerType())]))
    read = lines.groupBy("file_path").agg(
        F.sum(F.col("size").cast("long") + 1).alias("read_bytes"),
        F.count(F.lit(1)).alias("lines"))
    packed = load_or_empty(spark, lambda: found(spark.read.format("binaryFile")).load(path).where(
        F.endswith(F.lower("path"), F.lit(".gz"))).select(
        meta["file_path"].alias("file_path"), _unpacked_bytes("content").alias("held")),
        T.StructType([T.StructField("file_path", T.StringType()),
                      T.StructField("held", T.LongType())]))
    counted = files.join(read, "file_path", "left").fillna(0, ["read_bytes", "lines"]).join(
        packed, "file_path", "left")
    sound = ~F.endswith(F.lower("file_path"), F.lit(".gz")) | F.col("held").isNotNull()
    counted = counted.withColumns({"bytes": F.coalesce("held", "bytes"), "sound": sound})
    # The last line may have no line end.
    whole = F.col("sound") & F.col("read_bytes").isin(F.col("bytes"), F.col("bytes") + 1)
    counted = counted.drop("held")
    return counted.withColumn("status", F.when(whole, "read").otherwise("unreadable")).drop("sound")


def unreadable_files(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == "unreadable")


def good_records(bronze: DataFrame) -> DataFrame:
    """Rows of a written bronze table that were read whole.

    Not for the raw scan: there Spark parses only the columns a query needs, so which
    lines count as corrupt would depend on the query.
    """
    if CORRUPT not in bronze.columns:
        return bronze
    return bronze.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_records(bronze: DataFrame) -> DataFrame:
    """Rows of a written bronze table that could not be read whole."""
    if CORRUPT not in bronze.columns:
        return bronze.limit(0)
    return bronze.filter(F.col(CORRUPT).isNotNull())


def landing_path(base: str, data_type: str, run_ts: datetime) -> str:
    day, time = run_ts.strftime("%Y-%m-%d"), run_ts.strftime("%H%M%S")
    return f"{base.rstrip('/')}/{data_type}/{day}/{data_type}_{time}.jsonl"


def with_keyword(df: DataFrame, keyword: str | Column | None) -> DataFrame:
    """Add the keyword only to records that have no such field."""
    if keyword is None or "keyword" in df.columns:
        return df
    return df.withColumn("keyword", F.lit(keyword))


def write_jsonl(
    df: DataFrame,
    base: str,
    data_type: str,
    run_ts: datetime,
    keyword: str | None = None,
) -> str | None:
    """Append one run's records as a folder of compressed JSON-lines parts; returns its path.

    Nothing is written for an empty input. Times become ISO text.
    """
    if df.isEmpty():
        return None
    path = landing_path(base, data_type, run_ts)
    (
        with_keyword(df, keyword).write.mode("append")
        .option("ignoreNullFields", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .json(path)
    )
    return path


def write_keyword_results(
    df: DataFrame, base: str, data_type: str, run_ts: datetime
) -> str | None:
    """Write the results of many keywords in one job, one folder per keyword.

    Records keep their keyword, so the recursive scan needs no folder names. The rebalance
    keeps files large and splits a keyword that holds most rows.
    """
    if df.isEmpty():
        return None
    path = landing_path(base, data_type, run_ts)
    (
        df.withColumn("for_keyword", F.col("keyword"))
        .hint("rebalance", "for_keyword")
        .write.mode("append").partitionBy("for_keyword")
        .option("ignoreNullFields", False).json(path)
    )
    return path
