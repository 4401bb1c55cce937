"""Tables that streams write in epochs, with a record of every commit.

Each commit writes one folder of rows and then one small record: the folders that are live, and
for each writer the last of its epochs that is in them. A writer is named by the id that Spark
keeps in the stream's checkpoint, and folders are numbered by the table, so a new checkpoint on an
existing table adds to it. An epoch that is repeated after its commit is skipped; one that broke
off before it left no record, and its folder is written again. Readers see recorded folders only.

When `FAN` folders of one level are live, they are folded into one of the next level. Thus the
number of live folders grows as the logarithm of the commits, and every row is rewritten as often.
Folded folders stay on disk for readers that still use them; they can be deleted at any quiet time
(`unused`). A table takes one writer at a time. A commit may leave a note in the record, which later
ones keep.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.files import Folder

EPOCH = "epoch"
FAN = 20
_EMPTY = {"number": -1, "live": [], "writers": {}, "schema": None}


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it made the checkpoint."""
    return json.loads(Folder(spark, checkpoint).read("metadata"))["id"]


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the highest epoch of every key; null keys are equal."""
    values = [c for c in rows.columns if c not in (*keys, EPOCH)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), EPOCH).alias("__last"))
    return last.select(*keys, *[F.col("__last")[c].alias(c) for c in values])


class EpochTable:
    """`fold` turns the rows of several epochs, with the epoch as a column, into one epoch's."""

    def __init__(
        self, spark: SparkSession, path: str, partition_by: Sequence[str] = (),
        fold: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)
        self._fold = fold or (lambda rows: rows.drop(EPOCH))
        self._records = Folder(spark, f"{self.path}/commits")

    def state(self) -> dict:
        names = self._records.names()
        return json.loads(self._records.read(names[-1])) if names else dict(_EMPTY)

    def last_epoch(self, writer: str) -> int:
        """The writer's last committed epoch, -1 if there is none."""
        return self.state()["writers"].get(writer, -1)

    def unused(self) -> list[str]:
        """Folders of rows that no reader who starts now will read."""
        live = {f"{EPOCH}={n}" for n, _ in self.state()["live"]}
        rows = Folder(self.spark, f"{self.path}/rows")
        return [f"{self.path}/rows/{n}" for n in rows.names() if n not in live]

    def _bytes(self, state: dict, number: int) -> int:
        """Bytes of a folder; records of earlier versions do not hold them."""
        known = state.get("bytes", {}).get(str(number))
        return known if known is not None else Folder(
            self.spark, f"{self.path}/rows").size(f"{EPOCH}={number}")

    def size(self) -> int:
        """Bytes of all live folders."""
        state = self.state()
        return sum(self._bytes(state, n) for n, _ in state["live"])

    def _frame(self, state: dict, numbers: list[int]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"])).add(EPOCH, T.LongType())
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(
            *[f"{self.path}/rows/{EPOCH}={n}" for n in numbers])

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Rows of all live folders, with their epoch; `schema` is that of an unused table."""
        state = self.state()
        if state["schema"] is None:
            return self.spark.createDataFrame([], T.StructType(
                [*(schema or T.StructType()).fields, T.StructField(EPOCH, T.LongType())]))
        return self._frame(state, [n for n, _ in state["live"]])

    def _write(self, rows: DataFrame, state: dict, live: list, writers: dict) -> dict:
        number = state["number"] + 1
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        writer = rows.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/rows/{EPOCH}={number}")
        live = [[number if n is None else n, k] for n, k in live]
        new = {"number": number, "live": live, "writers": writers,
               "schema": state["schema"] or rows.schema.json(), "note": state.get("note"),
               "bytes": {str(n): self._bytes(state, n) for n, _ in live}}
        self._records.put(f"{number:012d}.json", json.dumps(new))
        return new

    def commit(self, writer: str, epoch: int, rows: DataFrame, note: object = None) -> bool:
        """Add the rows of a writer's epoch; False if that epoch is in the table already."""
        state = self.state()
        if state["writers"].get(writer, -1) >= epoch:
            return False
        if note is not None:
            state["note"] = note
        state = self._write(rows, state, [*state["live"], [None, 0]],
                            {**state["writers"], writer: epoch})
        while True:
            level = state["live"][-1][1]
            same = [n for n, k in state["live"] if k == level]
            if len(same) < FAN:
                return True
            state = self._write(self._fold(self._frame(state, same)), state,
                                [*state["live"][:-len(same)], [None, level + 1]],
                                state["writers"])
