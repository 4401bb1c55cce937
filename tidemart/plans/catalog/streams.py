"""Streaming counterparts, run over everything available and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.functions.columns import as_timestamp
from tidemart.operators import monitoring
from tidemart.plans.catalog import monitoring as _panels  # noqa: F401  registers the SQL used here
from tidemart.plans.catalog.sources import PRODUCT, PRODUCT_SQL, landed_products
from tidemart.plans.check_sql import with_views
from tidemart.plans.registry import REGISTRY, query
from tidemart.schemas import RAW_PRODUCT
from tidemart.streaming import ingest, price_changes, rates


def _land(t, path):
    rows = ingest.landed_stream(t.spark, landed_products(t), RAW_PRODUCT)
    ingest.run_to_end(ingest.append_available(rows, path, t.path("checkpoints/x1")))


@query("x1_incremental_bronze", with_views(f"select {PRODUCT_SQL}, scraped_at from raw_products"))
def _(t):
    bronze = t.spark.read.parquet(t.once("x1/bronze", lambda p: _land(t, p)))
    at = as_timestamp(bronze, "scraped_at").cast("timestamp_ntz")
    return bronze.select(*PRODUCT, at.alias("scraped_at"))


# Five deliveries, shuffled: snapshots of all times in each, the first two bring rows again.
_SHARES = 5


def _share(df, k):
    """Share k by a fixed rule of the key; share 1 also brings share 0 again."""
    part = F.pmod(F.col("product_id") * 7 + F.dayofyear("scraped_at"), F.lit(_SHARES))
    return df.filter(part.isin([k, 0]) if k == 1 else part == k)


@query("x2_streaming_dedup", with_views("""
    select distinct product_id, case when product_id % 50 <> 0 then scraped_at end as scraped_at
    from raw_products"""))
def _(t):
    # Some products have no time; new keys come years after later ones. The last two deliveries
    # are read by a stream with a checkpoint of its own, which brings all earlier ones again.
    undated = F.when(F.col("product_id") % 50 != 0, F.col("scraped_at"))

    def run(path):
        bronze = t.bronze_products()
        landing = t.path("x2/landing")
        for k in range(_SHARES):
            _share(bronze, k).withColumn("scraped_at", undated).write.mode("append").parquet(
                landing)
            rows = ingest.table_stream(t.spark, landing, bronze.schema)
            ingest.run_to_end(ingest.append_new_keys(
                rows, path, t.path(f"checkpoints/x2_{k // 3}"), ["product_id", "scraped_at"],
                "scraped_at"))

    return ingest.read_new_keys(t.spark, t.once("x2/single", run)).select(
        "product_id", F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at")
    )


_SLICES = 5


def _land_events(t, path):
    """The events in five files by time, cut inside windows, so that a window which one batch
    leaves open is completed by the next."""
    events = t.source("events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / _SLICES
    for k in range(_SLICES):
        part = events.filter(F.col("ts") >= first + k * step) if k else events
        part = part.filter(F.col("ts") < first + (k + 1) * step) if k < _SLICES - 1 else part
        part.coalesce(1).write.mode("append").parquet(path)


def _requests(t):
    """The events table as a stream of requests, one file a batch."""
    landing = t.once("x3/landing", lambda p: _land_events(t, p))
    rows = ingest.table_stream(t.spark, landing, t.source("events").schema,
                               max_files_per_trigger=1)
    kind = F.col("event_type")
    return rows.select(
        "ts", kind.alias("handler"), F.col("value").alias("duration"),
        F.when(kind == "error", "500").when(kind == "signup", "404").otherwise("200")
        .alias("status"),
    )


_WINDOW = ["window_start", "window_end", "handler"]


def _panel(t, name, build):
    def run(path):
        rows = build(_requests(t))
        ingest.run_to_end(ingest.update_available(
            rows, path, t.path(f"checkpoints/{name}"), _WINDOW))

    path = t.once(name, run)
    found = ingest.latest_rows(t.spark, path, _WINDOW)
    return found.withColumns({
        c: found[c].cast("timestamp_ntz") for c in ("window_start", "window_end")
    })


@query("x3_request_rate", REGISTRY["m1_request_rate"].sql)
def _(t):
    return _panel(t, "x3_rate", lambda rows: rates.request_rate(rows, "10 minutes"))


@query("x3_sliding_request_rate", REGISTRY["m1_sliding_request_rate"].sql)
def _(t):
    return _panel(t, "x3_sliding", lambda rows: rates.request_rate(
        rows, "10 minutes", slide=monitoring.SCRAPE_INTERVAL))


@query("x3_mean_duration", REGISTRY["m2_mean_duration"].sql)
def _(t):
    return _panel(t, "x3_duration", lambda rows: rates.mean_duration(rows, "10 minutes"))


@query("x3_server_error_rate", REGISTRY["m3_server_error_rate"].sql)
def _(t):
    return _panel(t, "x3_errors", lambda rows: rates.error_rate(rows, 5, "10 minutes"))


@query("x3_client_error_rate", REGISTRY["m4_client_error_rate"].sql)
def _(t):
    return _panel(t, "x3_client_errors", lambda rows: rates.error_rate(rows, 4, "10 minutes"))


def _deliver(t, path):
    """All snapshots in five shuffled deliveries; most are late, some undated. The last is read
    with a new checkpoint, which brings all others again."""
    snapshots = _some_undated(t.silver_products().select("product_id", "scraped_at", "price"))
    landing = t.path("x4/landing")
    schema = snapshots.drop("at").schema
    for k in range(_SHARES):
        part = F.pmod(F.col("product_id") * 7 + F.dayofyear("at"), F.lit(_SHARES))
        snapshots.filter(part == k).drop("at").write.mode("append").parquet(landing)
        rows = ingest.table_stream(t.spark, landing, schema)
        ingest.run_to_end(price_changes.start(
            rows, path, t.path("x4/state"), t.path(f"checkpoints/x4_{k // 4}")
        ))


def _some_undated(rows):
    """One product in fifty loses the time of its first snapshot, the earliest in its history.
    Only the rows of such products are shuffled. `at` keeps the time."""
    rows = rows.withColumn("at", F.col("scraped_at"))
    dated = F.coalesce(F.col("product_id") % 50 != 0, F.lit(False))
    first = F.min("at").over(Window.partitionBy("product_id"))
    some = rows.filter(~dated).withColumn("scraped_at", F.when(F.col("at") != first, F.col("at")))
    return rows.filter(dated).unionByName(some)


@query("x4_streaming_price_changes", with_views("""
    select product_id, case when product_id % 50 <> 0 or previous_price is not null
        or scraped_at <> min(scraped_at) over (partition by product_id) then scraped_at end
        as scraped_at, price, cast(previous_price as double) as previous_price,
      price_change_pct, is_discount_suspicious from price_history"""))
def _(t):
    path = t.once("x4/changes", lambda p: _deliver(t, p))
    return price_changes.read_changes(t.spark, path).select(
        "product_id", "scraped_at", "price",
        F.col("previous_price").cast("double").alias("previous_price"),
        "price_change_pct", "is_discount_suspicious",
    )
