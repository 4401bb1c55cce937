"""Incremental bronze and streaming deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.ordered import drop_repeats
from tidemart.sources.epochs import EPOCH, EpochTable, latest, stream_id
from tidemart.sources.jsonl import CORRUPT, LANDED_FILES

MONTH = "__month"
NO_MONTH = "none"
MAX_MONTHS = 1000  # months of one micro-batch that are listed to prune the lookup


def landed_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Records of files not seen yet below the landing folder. Lines that are no JSON keep
    their text in the corrupt-record column, and of an unreadable file the rest is skipped, as in
    the batch scan; `sources.jsonl.file_ledger` names such files for both.

    `max_files_per_trigger` bounds a micro-batch, and with it all state work per batch.
    """
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.readStream.schema(wanted)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", LANDED_FILES)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing)


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of Parquet files as they are added to a folder."""
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def with_event_time(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermarked rows. Watermarks need an instant, so zone-less times are read in the
    session zone."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _with_month(rows: DataFrame, ts: str) -> DataFrame:
    """Month of each row's time, as the folders of `append_new_keys` name it."""
    return rows.withColumn(MONTH, F.coalesce(
        F.date_format(F.col(ts).cast("timestamp"), "yyyy-MM"), F.lit(NO_MONTH)))


def keyed_table(spark: SparkSession, path: str) -> EpochTable:
    """The table that `append_new_keys` writes, in folders of months."""
    return EpochTable(spark, path, [MONTH])


def new_keys(
    batch: DataFrame, table: EpochTable, keys: list[str], ts: str,
    tie_break: list[Column] | None = None,
) -> DataFrame:
    """Rows of a micro-batch whose key the table does not hold, one per key.

    `ts` must be one of the keys: equal keys then lie in the same month, so only the folders of
    the batch's months are read. A null key equals a null key.
    """
    months = [r[MONTH] for r in _with_month(batch, ts).select(MONTH).distinct().limit(
        MAX_MONTHS + 1).collect()]
    rows = _with_month(drop_repeats(batch, keys, tie_break), ts)
    known = table.read(rows.schema)
    if len(months) <= MAX_MONTHS:
        known = known.filter(F.col(MONTH).isin(months))
    seen = known.select(*[F.col(k).alias(f"__{k}") for k in [*keys, MONTH]])
    same = [rows[k].eqNullSafe(seen[f"__{k}"]) for k in [*keys, MONTH]]
    return rows.join(seen, same, "left_anti")


def append_new_keys(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], ts: str,
    tie_break: list[Column] | None = None,
) -> StreamingQuery:
    """Append the first arrival of every key to a table, however late it comes.

    Keys already written are looked up in the table itself, in the months of the batch, so
    no state expires and no row is lost, and a stream with a new checkpoint adds to the table.
    `read_new_keys` gives the rows.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        table, writer = keyed_table(spark, path), stream_id(spark, checkpoint)
        if table.last_epoch(writer) < epoch:
            table.commit(writer, epoch, new_keys(batch, table, keys, ts, tie_break))

    return each_available(rows, checkpoint, each)


def read_new_keys(spark: SparkSession, path: str) -> DataFrame:
    """The rows written by `append_new_keys`."""
    return keyed_table(spark, path).read().drop(EPOCH, MONTH)


def each_available(
    rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> StreamingQuery:
    """Give everything available now to `each(batch, epoch)` and stop."""
    return (
        rows.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def updated_table(spark: SparkSession, path: str, keys: list[str]) -> EpochTable:
    return EpochTable(spark, path, fold=lambda rows: latest(rows, keys))


def update_available(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str]
) -> StreamingQuery:
    """Write every changed aggregate row of everything available now, one folder per epoch,
    and stop. Windows that are still open are written too; old epochs are folded to the last row
    of each key."""

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        updated_table(spark, path, keys).commit(stream_id(spark, checkpoint), epoch, batch)

    return each_available(rows, checkpoint, each, "update")


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last written row of every key from the epochs of `update_available`."""
    return latest(updated_table(spark, path, keys).read(), keys)


def append_available(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Append everything available now to a table and stop. Restarting with the same
    checkpoint continues exactly after the last finished batch."""
    return (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query; raises what the query raised."""
    query.awaitTermination()
