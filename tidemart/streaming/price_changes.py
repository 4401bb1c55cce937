"""Price changes over a stream of snapshots, repaired where late snapshots arrive.

The results hold a row for each snapshot, in folders of product bucket and month. Next to them an
index holds, for each product and month, its first and last snapshot with their prices. A new
snapshot needs the one before it, and becomes the one before the next. Both come from the index,
unless it falls between the first and the last snapshot that are known of its month: then the
rows of that bucket and month are read, and no others. So a late or undated snapshot (undated ones
come before all others) adds its own row and writes the row after it again, whatever the size of
the results; of a row written more than once the latest epoch holds. Of several rows of one
snapshot the first that arrived stays.

Where a batch is not small beside the results (`SWEEP_BYTES`), as in a first load or a delivery of
all times, looking neighbours up takes many joins of as many rows. Such a batch is put among all known
snapshots instead, in one shuffle by product and one sort, which gives the same rows of results
and index.

Results and index are tables of `sources.epochs`: a stream with a new checkpoint continues the
same history, and a repeated epoch is skipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.history import with_changes
from tidemart.operators.ordered import HOT_ROWS, drop_repeats, most_rows, previous_values
from tidemart.sources.epochs import EPOCH, EpochTable, latest, stream_id

BUCKETS = 4  # fixed for the life of a table; raise it where a month has very many products
MAX_PLACES = 1000  # buckets and months that are looked up by name; beyond, all are scanned
# Bytes of results that are read again for each row of a batch rather than looking it up.
SWEEP_BYTES = 500
BUCKET, MONTH, NO_MONTH = "__bucket", "__month", "none"
RESULT = [
    "product_id", "scraped_at", "price", "previous_price", "price_change_abs",
    "price_change_pct", "days_since_last_seen", "is_price_increased", "is_price_decreased",
    "is_discount_suspicious",
]
SNAPSHOT = ["product_id", "scraped_at", "price"]
PLACE = ["product_id", BUCKET, MONTH]


def results_table(spark: SparkSession, out_dir: str) -> EpochTable:
    keys = ["product_id", "scraped_at", BUCKET, MONTH]
    return EpochTable(spark, out_dir, [BUCKET, MONTH], lambda rows: latest(rows, keys))


def index_table(spark: SparkSession, state_dir: str) -> EpochTable:
    return EpochTable(spark, state_dir, [BUCKET], lambda rows: latest(rows, PLACE))


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        BUCKET: F.pmod(F.xxhash64("product_id"), F.lit(BUCKETS)).cast("int"),
        MONTH: F.coalesce(F.date_format("scraped_at", "yyyy-MM"), F.lit(NO_MONTH)),
    })


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(Column.__and__, [left[n].eqNullSafe(right[n]) for n in names])


def _ends(places: DataFrame, wanted: list[str]) -> DataFrame:
    """First and last snapshots of the index as rows."""
    return places.select(*[c for c in PLACE if c in wanted], F.explode(
        F.array_distinct(F.array("first", "last"))).alias("end")).select(
        *[c for c in PLACE if c in wanted], "end.scraped_at", "end.price")


def _indexed(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Index rows of the places of `rows`: of one snapshot the known price stays."""
    points = rows.select(*PLACE, "scraped_at", F.lit(1).alias("turn"), "price").unionByName(
        _ends(places.join(rows.select(*PLACE).distinct().alias("own"), _same(
            places, rows, PLACE), "left_semi"), PLACE).withColumn("turn", F.lit(0)))
    first = F.min(F.struct("scraped_at", "turn", "price"))
    last = F.max(F.struct("scraped_at", (-F.col("turn")).alias("turn"), "price"))
    return points.groupBy(*PLACE).agg(first.alias("first"), last.alias("last")).select(
        *PLACE, *[F.struct(f"{c}.scraped_at", f"{c}.price").alias(c) for c in ("first", "last")])


def lookup(results: EpochTable, inside: DataFrame) -> DataFrame:
    """Known snapshots of the products, buckets and months in `inside`; other folders are left
    out of the scan."""
    found = results.read(results_schema(inside))
    near = inside.select(MONTH, BUCKET).distinct().limit(MAX_PLACES + 1).collect()
    if len(near) <= MAX_PLACES:
        found = found.filter(F.col(MONTH).isin({r[MONTH] for r in near})
                             & F.col(BUCKET).isin({r[BUCKET] for r in near}))
    places = inside.select(*PLACE).distinct()
    known = found.select(*SNAPSHOT, BUCKET, MONTH, EPOCH).join(
        places, _same(found, places, PLACE), "left_semi")
    return latest(known, ["product_id", "scraped_at"])


def results_schema(rows: DataFrame):
    return _changes(rows.limit(0).withColumns({
        "previous_price": F.col("price"), "previous_scraped_at": F.col("scraped_at")})).schema


def _changes(lagged: DataFrame) -> DataFrame:
    return _placed(with_changes(lagged).select(*RESULT))


def _written(rows: DataFrame, path: str) -> DataFrame:
    """Rows that several steps of a batch use. They are written, not cached: a cached shuffle
    keeps all of its partitions, however few rows they have, in every step that reads it."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _around(
    rows: DataFrame, places: DataFrame, results: EpochTable, path: str
) -> DataFrame:
    """The new snapshots and the known ones that can be their neighbours, marked by `is_new`;
    written below `path`."""
    at = F.col("scraped_at")
    inside = rows.join(places, _same(rows, places, PLACE)).filter(
        (at > F.col("first.scraped_at")) & (at < F.col("last.scraped_at"))).select(
        *[rows[c] for c in rows.columns])
    known = lookup(results, inside).select(*SNAPSHOT).unionByName(_ends(places, ["product_id"]))
    known = _written(known.dropDuplicates(["product_id", "scraped_at"]), f"{path}/known")
    fresh = rows.select(*SNAPSHOT).join(
        known, _same(rows, known, ["product_id", "scraped_at"]), "left_anti")
    both = fresh.withColumn("is_new", F.lit(True)).unionByName(
        known.withColumn("is_new", F.lit(False)))
    return _written(both, f"{path}/around")


def _bound(most: int, results: EpochTable) -> int | None:
    """A bound on the rows of any product once a batch with at most `most` of them is in: the
    table's note is the sum for the batches before. None if the table has no note."""
    state = results.state()
    note = state.get("note") if state["live"] else 0
    return None if note is None else note + most


def _swept(batch: DataFrame, known: DataFrame, path: str) -> DataFrame:
    """New snapshots and those after them as `changed`, with the preceding ones; and the last
    snapshots of the months that got any, with the `first` of the month. Written to `path`."""
    both = batch.withColumn("is_new", F.lit(True)).unionByName(
        known.select(*SNAPSHOT, F.lit(False).alias("is_new")))
    month = F.coalesce(F.year("scraped_at") * 12 + F.month("scraped_at"), F.lit(-1))
    lagged = previous_values(both.withColumn("month", month), ["product_id"], "scraped_at", {
        "previous_price": "price", "previous_scraped_at": "scraped_at",
        "previous_is_new": "is_new", "previous_month": "month"}, hot_rows=None,
        repeat_order=[F.col("is_new"), F.col("price").asc_nulls_first()])
    inside = Window.partitionBy("product_id").orderBy(F.col("scraped_at").asc_nulls_first())
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = ~F.col("month").eqNullSafe(F.col("previous_month"))
    points = lagged.withColumns({
        "next_month": F.lead("month").over(inside),
        "first": F.last(F.when(begins, F.struct("scraped_at", "price")), True).over(so_far),
        "touched": F.last(F.when(F.col("is_new"), F.col("month")), True).over(so_far),
    })
    ends = (~F.col("month").eqNullSafe(F.col("next_month"))
            & F.col("month").eqNullSafe(F.col("touched")))
    changed = F.expr("is_new or coalesce(previous_is_new, false)")
    found = points.select(
        *SNAPSHOT, "previous_price", "previous_scraped_at", changed.alias("changed"),
        F.when(ends, F.col("first")).alias("first"))
    return _written(found.filter("changed or first is not null"), path)


def process_batch(
    batch: DataFrame, epoch: int, out_dir: str, state_dir: str, writer: str = "direct"
) -> None:
    spark = batch.sparkSession
    results, index = results_table(spark, out_dir), index_table(spark, state_dir)
    if index.last_epoch(writer) >= epoch:
        return
    work = f"{state_dir.rstrip('/')}/work"
    batch = batch.select(*SNAPSHOT)
    count, most = most_rows(batch, ["product_id"])
    bound = _bound(most, results)
    if results.last_epoch(writer) < epoch and count * SWEEP_BYTES >= results.size():
        known = results.read(results_schema(_placed(batch)))
        if bound is None or bound > HOT_ROWS:  # snapshots that came again count in each batch
            bound = most + most_rows(known, ["product_id"])[1]
        # No product may be so large that one task should not sort it.
        if bound <= HOT_ROWS:
            swept = _swept(batch, known, f"{work}/swept")
            results.commit(writer, epoch, _changes(swept.filter("changed")), bound)
            index.commit(writer, epoch, _placed(swept).filter("first is not null").select(
                *PLACE, "first", F.struct("scraped_at", "price").alias("last")))
            return
    rows = _written(_placed(drop_repeats(batch, ["product_id", "scraped_at"])),
                    f"{work}/rows")
    points = T_POINT.format(*[rows.schema[c].dataType.simpleString()
                              for c in ("scraped_at", "price")])
    empty = rows.limit(0).select(*PLACE, *[
        F.lit(None).cast(points).alias(c) for c in ("first", "last")])
    held = latest(index.read(empty.schema), PLACE)
    products = rows.select("product_id").distinct()
    places = _written(held.join(products, _same(held, products, ["product_id"]), "left_semi"),
                      f"{work}/places")
    if results.last_epoch(writer) < epoch:
        around = _around(rows, places, results, work)
        lagged = previous_values(around, ["product_id"], "scraped_at", {
            "previous_price": "price", "previous_scraped_at": "scraped_at",
            "previous_is_new": "is_new"})
        changed = lagged.filter("is_new or coalesce(previous_is_new, false)")
        results.commit(writer, epoch, _changes(changed), bound)
    index.commit(writer, epoch, _indexed(rows, places))


T_POINT = "struct<scraped_at:{},price:{}>"


def start(
    snapshots: DataFrame, out_dir: str, state_dir: str, checkpoint: str
) -> StreamingQuery:
    """Process everything available now and stop; later runs continue."""

    def each(batch: DataFrame, epoch: int) -> None:
        process_batch(batch, epoch, out_dir, state_dir,
                      stream_id(batch.sparkSession, checkpoint))

    return (
        snapshots.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_changes(spark: SparkSession, out_dir: str) -> DataFrame:
    """Each snapshot's row of the latest epoch. A row number or an aggregate would also sort the
    rows before they are shuffled, where hardly any snapshot is met twice."""
    written = results_table(spark, out_dir).read()
    later = F.lag(EPOCH).over(
        Window.partitionBy("product_id", "scraped_at").orderBy(F.col(EPOCH).desc()))
    return written.withColumn("__later", later).filter("__later is null").select(*RESULT)
