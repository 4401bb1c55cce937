"""Tables in ranges of a key, with the bounds of every file, for lookups that open few files.

Rows are dealt to files by ranges of the key and, within one key, of a hash of the row, so that a
key with very many rows is spread over several files. The bounds of the files are kept beside
them in one small record, which a lookup reads instead of the files' footers.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.columns import sortable
from tidemart.sources.files import Folder

_RECORD, _NAME = "_bounds", "files.json"


def write_keyed(
    df: DataFrame, path: str, key: str = "product_id",
    then: Callable[[DataFrame], DataFrame] | None = None, whole_keys: bool = False,
) -> None:
    """Replace a table by the rows of `df`, in ranges of `key`; without that column, as they come.

    The rows are written once before they are dealt to ranges, as finding the ranges reads them
    twice. With `then`, `df` is cheap to read twice: its rows are dealt at once, and `then` makes
    the table's rows of the dealt ones, without another shuffle. `whole_keys` leaves all rows of a
    key together for it, which must not be too many for one task. Never pass a frame that reads
    the same path.
    """
    spark, path, draft = df.sparkSession, path.rstrip("/"), None
    build = then or (lambda rows: rows)
    if key not in df.columns:
        build(df).write.mode("overwrite").parquet(path)
        return
    rows = df
    if not then:
        draft = f"{path}_draft"
        df.write.mode("overwrite").option("compression", "zstd").parquet(draft)
        rows = spark.read.schema(df.schema).parquet(draft)
    within = [] if whole_keys else [F.xxhash64(*sortable(rows))]
    made = build(rows.repartitionByRange(key, *within)).sortWithinPartitions(key)
    made.write.mode("overwrite").option("compression", "zstd").parquet(path)
    bounds = spark.read.schema(made.schema).parquet(path).select(
        F.col("_metadata.file_name").alias("name"), key).groupBy("name").agg(
        F.min(key).alias("low"), F.max(key).alias("high")).collect()  # a row for each file
    files = sorted(([r["name"], r["low"], r["high"]] for r in bounds if r["low"] is not None),
                   key=lambda f: (f[1], f[2]))
    Folder(spark, f"{path}/{_RECORD}").put(_NAME, json.dumps(
        {"key": key, "schema": made.schema.json(), "files": files}))
    if draft:
        parent, _, name = draft.rpartition("/")
        Folder(spark, parent).remove(name)


class KeyedTable:
    """A table written by `write_keyed`, as it is when this object is made."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        record = json.loads(Folder(spark, f"{self.path}/{_RECORD}").read(_NAME))
        self.key, self.files = record["key"], record["files"]
        self.schema = T.StructType.fromJson(json.loads(record["schema"]))
        self._lows = [f[1] for f in self.files]

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def files_of(self, value) -> list[str]:
        """Files whose range holds a key, given as the key's own type or as text."""
        if isinstance(self.schema[self.key].dataType, T.IntegralType):
            text = str(value)
            if not (text.lstrip("-").isdecimal() and str(int(text)) == text):
                return []
            value = int(text)
        else:
            value = str(value)
        # Lows and, but for files of one key, highs rise from file to file.
        found, at = [], bisect_right(self._lows, value)
        while at and self.files[at - 1][2] >= value:
            at -= 1
            found.append(f"{self.path}/{self.files[at][0]}")
        return found

    def near(self, value) -> DataFrame:
        """Rows of the files that can hold a key; no other file is opened."""
        paths = self.files_of(value)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)
