"""Every streaming operator must give what its batch counterpart gives."""

from datetime import datetime, timedelta

import pytest
from conftest import SF, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators import history, monitoring
from tidemart.plans import derived
from tidemart.plans.catalog import streams
from tidemart.schemas import RAW_PRODUCT
from tidemart.sources import epochs, jsonl
from tidemart.streaming import ingest, price_changes, rates

RUN = datetime(2024, 1, 15, 14, 30, 22)


def raw(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").alias("product_id"), F.lit("x").alias("name"),
        F.lit("2024-01-01T00:00:00").alias("scraped_at"),
    )


def test_incremental_bronze_reads_each_file_once(spark, tmp_path):
    landing, bronze, state = (f"{tmp_path}/{n}" for n in ("landing", "bronze", "state"))

    def run():
        stream = ingest.landed_stream(spark, landing, RAW_PRODUCT, max_files_per_trigger=1)
        ingest.run_to_end(ingest.append_available(stream, bronze, state))
        return spark.read.parquet(bronze)

    jsonl.write_jsonl(raw(spark, 10), landing, "products", RUN)
    assert run().count() == 10
    assert run().count() == 10
    jsonl.write_jsonl(raw(spark, 5, 10), landing, "products", RUN + timedelta(days=1))
    with open(f"{landing}/products/bad.jsonl", "w") as f:
        f.write("not json\n")
    found = run()
    assert sorted(r.product_id for r in jsonl.good_records(found).collect()) == list(range(15))
    assert [r[jsonl.CORRUPT] for r in jsonl.corrupt_records(found).collect()] == ["not json"]
    batch = jsonl.read_jsonl(spark, landing, RAW_PRODUCT)
    assert rows(found.select(batch.columns)) == rows(batch)


def test_streaming_dedup_across_batches(spark, tmp_path):
    source, out = (f"{tmp_path}/{n}" for n in ("source", "out"))
    at = datetime(2024, 1, 1)
    schema = "k long, at timestamp"

    def run(*data, state=f"{tmp_path}/state"):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        stream = ingest.table_stream(spark, source, spark.read.parquet(source).schema)
        ingest.run_to_end(ingest.append_new_keys(stream, out, state, ["k", "at"], "at"))
        return sorted(((r.k, r.at) for r in ingest.read_new_keys(spark, out).collect()), key=repr)

    late = at - timedelta(days=5)
    assert run((1, at), (1, at), (2, at)) == [(1, at), (2, at)]
    # A key that was never seen comes out however late it is, one without a time as well.
    found = run((1, at), (3, late), (4, None), (4, None))
    assert found == sorted([(1, at), (2, at), (3, late), (4, None)], key=repr)
    assert run((3, late), (4, None)) == found
    # A new checkpoint brings all files again, from epoch 0; what is written stays.
    again = run((5, at), (2, at), state=f"{tmp_path}/state2")
    assert again == sorted([*found, (5, at)], key=repr)
    assert run((6, late)) == sorted([*again, (6, late)], key=repr)


def test_epochs_are_committed_once_and_folded(spark, tmp_path, monkeypatch):
    """Live folders stay few over many epochs; broken and repeated epochs leave nothing."""
    monkeypatch.setattr(epochs, "FAN", 3)
    table = ingest.updated_table(spark, f"{tmp_path}/t", ["k"])
    assert table.read().columns == ["epoch"] and table.last_epoch("a") == -1
    want = {}
    for epoch in range(14):
        data = [(epoch % 4, epoch), (None, -epoch), (100 + epoch, epoch)]
        want.update(dict(data))
        frame = spark.createDataFrame(data, "k long, v long").coalesce(1)
        writer = "a" if epoch < 9 else "b"
        if epoch == 5:  # a crash in the middle of an epoch leaves a folder without a record
            frame.limit(1).write.parquet(f"{table.path}/rows/epoch={table.state()['number'] + 1}")
        assert table.commit(writer, epoch % 9, frame)
        assert not table.commit(writer, epoch % 9, frame)
    live = table.state()["live"]
    assert len(live) <= 2 * 3 and [k for _, k in live] == sorted((k for _, k in live), reverse=True)
    got = ingest.latest_rows(spark, table.path, ["k"]).collect()
    assert {r.k: r.v for r in got} == want and len(got) == len(want)
    assert len(table.unused()) == table.state()["number"] + 1 - len(live)
    assert table.state()["writers"] == {"a": 8, "b": 4}


@pytest.mark.parametrize("build, batch", [
    (lambda r: rates.request_rate(r, "1 hour"), monitoring.request_rate),
    (lambda r: rates.request_rate(r, "1 hour", slide="15 seconds"),
     lambda r: monitoring.request_rate(r, slide="15 seconds")),
    (lambda r: rates.mean_duration(r, "1 hour"), monitoring.mean_duration),
    (lambda r: rates.error_rate(r, 5, "1 hour"), lambda r: monitoring.error_rate(r, 5)),
])
def test_all_windows_equal_batch(spark, tmp_path, build, batch):
    requests = derived.http_requests(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    requests.write.parquet(f"{tmp_path}/requests")
    stream = ingest.table_stream(spark, f"{tmp_path}/requests", requests.schema)
    out = f"{tmp_path}/out"
    keys = ["window_start", "window_end", "handler"]
    ingest.run_to_end(ingest.update_available(build(stream), out, f"{tmp_path}/c", keys))
    expected = batch(requests)
    got = ingest.latest_rows(spark, out, keys)
    assert rows(got.select(expected.columns)) == rows(expected)


def _snapshots(spark):
    at = datetime(2024, 1, 1)
    data = [
        (p, at + timedelta(hours=7 * i + p), 1000 * ((p * 31 + i * 17) % 23) + 1)
        for p in range(1, 6) for i in range(12)
    ]
    return spark.createDataFrame(data, "product_id long, scraped_at timestamp, price int")


@pytest.mark.parametrize("fan", [2, 100])
def test_price_changes_equal_batch(spark, tmp_path, monkeypatch, fan):
    monkeypatch.setattr(epochs, "FAN", fan)
    whole = _snapshots(spark).cache()
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    times = [r.t for r in whole.selectExpr("percentile(unix_seconds(scraped_at), "
                                           "array(0, .2, .4, .6, .8)) t").collect()][0]
    bounds = [*times[1:], None]
    low = None
    for epoch, high in enumerate(bounds):
        seconds = F.unix_seconds("scraped_at")
        part = whole.filter((seconds > low) if low else F.lit(True))
        part = part.filter(seconds <= high) if high else part
        # Product 5 is absent from every batch but the first and the last.
        part = part if epoch in (0, 4) else part.filter("product_id <> 5")
        price_changes.process_batch(part, epoch, out, state)
        if epoch == 2:
            price_changes.process_batch(part, epoch, out, state)
        low = high
    seen = price_changes.read_changes(spark, out).select("product_id", "scraped_at")
    expected = history.price_history(whole.join(seen, ["product_id", "scraped_at"], "left_semi"))
    got = price_changes.read_changes(spark, out)
    assert rows(got) == rows(expected.select(price_changes.RESULT))
    whole.unpersist()


def test_late_and_undated_snapshots_equal_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(epochs, "FAN", 2)
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    schema = "product_id long, scraped_at timestamp, price int"
    day = lambda d: datetime(2024, 1, d)
    batches = [
        [(1, day(5), 10), (1, day(5), 10), (3, None, 5)],
        [(1, day(4), 99), (1, day(5), 98), (1, day(6), 20), (2, day(1), 7)],
        [(1, None, 3), (2, day(2), 8), (3, day(1), 6)],
        [(1, day(3), 50), (2, None, 1), (3, None, 9), (4, day(9), 4)],
        [(1, day(7), 30), (4, day(9), 5), (4, day(8), 6)],
    ]
    for epoch, data in enumerate(batches):
        frame = spark.createDataFrame(data, schema)
        price_changes.process_batch(frame, epoch, out, state)
    first = {}
    for product, at, price in (r for data in batches for r in data):
        first.setdefault((product, at), price)
    whole = spark.createDataFrame([(*k, v) for k, v in first.items()], schema)
    expected = history.price_history(whole).select(price_changes.RESULT)
    assert rows(price_changes.read_changes(spark, out)) == rows(expected)


def test_late_row_reads_and_writes_its_neighbours_only(spark, tmp_path, monkeypatch):
    """All other files of the results are made unreadable; the repair still finds what it needs."""
    import glob
    import os

    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    schema = "product_id long, scraped_at timestamp, price int"
    months = [(p, datetime(2023, m, d), 100 * m + d + p) for p in range(40) for m in range(1, 13)
              for d in (3, 13, 23)]
    price_changes.process_batch(spark.createDataFrame(months, schema), 0, out, state)
    late = [(7, datetime(2023, 5, 20), 1), (7, datetime(2023, 8, 1), 2), (8, None, 3),
            (9, datetime(2024, 2, 1), 4), (7, datetime(2023, 5, 13), 5)]
    bucket = spark.createDataFrame(late, schema).filter("product_id = 7").select(
        F.pmod(F.xxhash64("product_id"), F.lit(price_changes.BUCKETS))).first()[0]
    parts = glob.glob(f"{out}/rows/epoch=0/*/*/*.parquet")
    needed = f"__bucket={bucket}/__month=2023-05"  # the other new rows lie at the ends of months
    kept = {}
    for part in parts:
        if needed not in part:
            kept[part] = open(part, "rb").read()
            for name in (part, f"{os.path.dirname(part)}/.{os.path.basename(part)}.crc"):
                with open(name, "wb") as f:
                    f.write(b"junk")
    assert 0 < len(parts) - len(kept) <= 2 < 40 < len(parts)
    price_changes.process_batch(spark.createDataFrame(late, schema), 1, out, state)
    for part, data in kept.items():
        with open(part, "wb") as f:
            f.write(data)
        os.remove(f"{os.path.dirname(part)}/.{os.path.basename(part)}.crc")
    table = price_changes.results_table(spark, out)
    assert table.read().filter("epoch = 1").count() == 7  # four new rows and three after them
    whole = spark.createDataFrame([*months, *late[:4]], schema)
    expected = history.price_history(whole).select(price_changes.RESULT)
    assert rows(price_changes.read_changes(spark, out)) == rows(expected)
    # A stream with another checkpoint continues the same history.
    more = [(7, datetime(2023, 8, 2), 9), (41, None, 1)]
    price_changes.process_batch(spark.createDataFrame(more, schema), 0, out, state, "other")
    whole = spark.createDataFrame([*months, *late[:4], *more], schema)
    assert rows(price_changes.read_changes(spark, out)) == rows(
        history.price_history(whole).select(price_changes.RESULT))


def test_months_are_listed_before_repeats_are_dropped(spark, tmp_path, monkeypatch):
    """to list the months of a batch, its whole rows were shuffled a second time."""
    batch = spark.createDataFrame(
        [(1, datetime(2024, 1, 5)), (1, datetime(2024, 1, 5)), (2, None)],
        "product_id long, scraped_at timestamp")
    # Fails in any job that drops repeats.
    monkeypatch.setattr(ingest, "drop_repeats", lambda rows, *args: rows.withColumn(
        "scraped_at", F.expr("raise_error('shuffled')").cast("timestamp")))
    ingest.new_keys(batch, ingest.keyed_table(spark, f"{tmp_path}/t"),
                    ["product_id", "scraped_at"], "scraped_at")


def test_price_changes_cache_nothing(spark, tmp_path):
    """F8: cached shuffles kept all their partitions in every later step."""
    batch = spark.createDataFrame(
        [(1, datetime(2024, 1, 5), 10.0), (1, datetime(2024, 1, 7), 20.0)],
        "product_id long, scraped_at timestamp, price double")
    path, state = f"{tmp_path}/out", f"{tmp_path}/state"
    price_changes.process_batch(batch, 0, path, state)
    late = spark.createDataFrame([(1, datetime(2024, 1, 6), 40.0)], batch.schema)
    price_changes.process_batch(late, 1, path, state)
    found = price_changes.read_changes(spark, path).orderBy("scraped_at").collect()
    assert [r.previous_price for r in found] == [None, 10.0, 40.0]
    for name in ("rows", "places", "known", "around"):
        assert spark.read.parquet(f"{state}/work/{name}").count()


def _tables(spark, batches, schema, path, sweep_bytes, monkeypatch):
    """Rows of results and index after the batches."""
    monkeypatch.setattr(price_changes, "SWEEP_BYTES", sweep_bytes)
    for epoch, data in enumerate(batches):
        frame = spark.createDataFrame(data, schema)
        price_changes.process_batch(frame, epoch, f"{path}/out", f"{path}/state")
    index = price_changes.index_table(spark, f"{path}/state").read()
    return (rows(price_changes.read_changes(spark, f"{path}/out")),
            rows(epochs.latest(index, price_changes.PLACE)))


def test_large_batches_are_swept(spark, tmp_path, monkeypatch):
    """every row of a large batch was looked up, by a dozen joins; now it is put among all known
    rows at once, with the same results and index."""
    schema = "product_id long, scraped_at timestamp, price int"
    day = lambda m, d: datetime(2024, m, d)
    batches = [
        [(1, day(1, 5), 10), (1, day(1, 5), 9), (3, None, 5), (None, day(2, 1), 4)],
        [(1, day(1, 4), 99), (1, day(1, 5), 98), (1, day(3, 6), 20), (2, day(1, 1), 7)],
        [(1, None, 3), (2, day(2, 2), None), (3, day(1, 1), 6), (None, day(2, 3), 40000)],
        [(1, day(1, 3), 50), (2, None, 1), (3, None, 9), (4, day(1, 9), 4), (1, day(3, 6), 1)],
        [(1, day(2, 7), 30000), (4, day(1, 9), 5), (4, day(1, 8), 6), (1, day(3, 5), 6),
         (2, day(2, 9), 2), (None, None, 8)],
    ]
    looked_up = _tables(spark, batches, schema, f"{tmp_path}/a", -1, monkeypatch)
    first = {}
    for product, at, price in (r for data in batches for r in sorted(
            data, key=lambda r: (r[2] is not None, r[2]))):
        first.setdefault((product, at), price)
    whole = spark.createDataFrame([(*k, v) for k, v in first.items()], schema)
    assert looked_up[0] == rows(history.price_history(whole).select(price_changes.RESULT))

    monkeypatch.setattr(price_changes, "lookup", None)
    assert _tables(spark, batches, schema, f"{tmp_path}/b", 1 << 30, monkeypatch) == looked_up


def test_large_products_are_not_swept(spark, tmp_path, monkeypatch):
    """The bound on a product's rows grows with every batch, those that are looked up as well."""
    schema = "product_id long, scraped_at timestamp, price int"
    batches = [[(1, datetime(2024, 1, 4 * k + d), k + d) for d in (1, 3, 2)] for k in range(4)]
    path, found = f"{tmp_path}/a", []
    monkeypatch.setattr(price_changes, "HOT_ROWS", 10)
    swept = price_changes._swept
    monkeypatch.setattr(price_changes, "_swept", lambda *args: found.append(epoch) or swept(*args))
    for epoch, (data, size) in enumerate(zip(batches, (1 << 30, -1, 1 << 30, 1 << 30))):
        monkeypatch.setattr(price_changes, "SWEEP_BYTES", size)
        price_changes.process_batch(
            spark.createDataFrame(data, schema), epoch, f"{path}/out", f"{path}/state")
    assert found == [0, 2]
    table = price_changes.results_table(spark, f"{path}/out")
    assert table.state()["note"] >= 12 and table.size() > 0
    whole = spark.createDataFrame([r for data in batches for r in data], schema)
    assert rows(price_changes.read_changes(spark, f"{path}/out")) == rows(
        history.price_history(whole).select(price_changes.RESULT))


def test_records_without_note_and_bytes_are_read(spark, tmp_path):
    """Tables of earlier versions go on, and are swept too."""
    import json

    schema = "product_id long, scraped_at timestamp, price int"
    data = [(1, datetime(2024, 1, d), d) for d in (1, 9)]
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    price_changes.process_batch(spark.createDataFrame(data, schema), 0, out, state)
    table = price_changes.results_table(spark, out)
    size, old = table.size(), table.state()
    assert old.pop("note") == 2 and sum(old.pop("bytes").values()) == size > 0
    table._records.put("000000000001.json", json.dumps({**old, "number": 1}))
    assert table.size() == size
    more = [(1, datetime(2024, 1, 2 + d % 7), d) for d in range(100)]
    price_changes.process_batch(spark.createDataFrame(more, schema), 1, out, state)
    assert table.state()["note"] == 102 and table.read().filter("epoch = 2").count() == 8


def test_products_that_lose_a_time_alone_are_shuffled(spark):
    """all snapshots were shuffled and sorted for each delivery."""
    at = F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 9 + 1).cast("int"),
                              F.lit(0), F.lit(0), F.lit(0))
    whole = spark.range(1000).select(
        F.when(F.col("id") != 7, F.col("id") % 120).alias("product_id"),
        F.when(F.col("id") % 11 != 0, at).alias("scraped_at"), F.col("id").alias("price"))
    first = F.min("scraped_at").over(Window.partitionBy("product_id"))
    want = whole.withColumn("at", F.col("scraped_at")).withColumn("scraped_at", F.when(
        (F.col("product_id") % 50 != 0) | (F.col("scraped_at") != first), F.col("scraped_at")))
    got = streams._some_undated(whole)
    assert rows(got) == rows(want)
    shuffled = got._jdf.queryExecution().optimizedPlan().toString().split("Window", 1)[1]
    assert "% 50" in shuffled
