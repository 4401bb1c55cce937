import json
import os
from datetime import datetime

import pytest
from conftest import column, rows

from tidemart.operators import serving
from tidemart.schemas import RAW_PRODUCT, schema_of
from tidemart.sources import jsonl, reports, tables
from tidemart.sources.files import Folder
from tidemart.streaming import ingest

RUN = datetime(2024, 1, 15, 14, 30, 22)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_scan_is_recursive_and_tolerant(spark, tmp_path):
    put(f"{tmp_path}/2024-01-01/a.jsonl", '{"product_id": 1}\n\n   \n{"product_id": 2}\n')
    put(f"{tmp_path}/2024-01-02/deep/b.jsonl", 'not json\n{"product_id": 3, "extra": 1}\n')
    put(f"{tmp_path}/2024-01-02/notes.txt", '{"product_id": 9}\n')
    landed = jsonl.read_jsonl(spark, str(tmp_path), RAW_PRODUCT)
    assert landed.columns == [*RAW_PRODUCT.fieldNames(), jsonl.CORRUPT]
    tables.write_bronze({"products": landed}, f"{tmp_path}/bronze")
    bronze = tables.read_table(spark, f"{tmp_path}/bronze/products")
    assert sorted(column(jsonl.good_records(bronze), "product_id")) == [1, 2, 3]
    assert column(jsonl.corrupt_records(bronze), jsonl.CORRUPT) == ["not json"]
    inferred = jsonl.read_jsonl(spark, str(tmp_path))
    assert set(inferred.columns) == {"product_id", "extra", jsonl.CORRUPT}


def test_missing_or_empty_folder_is_an_empty_table(spark, tmp_path):
    assert jsonl.read_jsonl(spark, f"{tmp_path}/none", RAW_PRODUCT).count() == 0
    assert jsonl.read_jsonl(spark, f"{tmp_path}/none").count() == 0
    os.makedirs(f"{tmp_path}/empty")
    assert jsonl.read_jsonl(spark, f"{tmp_path}/empty").count() == 0
    schema = schema_of(a="long")
    assert tables.read_parquet_dir(spark, f"{tmp_path}/none", schema).columns == ["a"]


def test_sink_layout_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "ấm", RUN), (2, None, None)], "id long, name string, at timestamp")
    path = jsonl.write_jsonl(df, str(tmp_path), "products", RUN, keyword="mug")
    assert path == f"{tmp_path}/products/2024-01-15/products_143022.jsonl"
    back = rows(jsonl.read_jsonl(spark, str(tmp_path)))
    got = [(r["id"], r["name"], r["keyword"]) for r in back]
    assert got == [(1, "ấm", "mug"), (2, None, "mug")]
    assert back[0]["at"].startswith("2024-01-15T14:30:22")


def test_sink_keeps_an_existing_keyword(spark, tmp_path):
    df = spark.createDataFrame([(1, "own"), (2, None)], "id long, keyword string")
    jsonl.write_jsonl(df, str(tmp_path), "products", RUN, keyword="mug")
    back = rows(jsonl.read_jsonl(spark, str(tmp_path)))
    assert [r["keyword"] for r in back] == ["own", None]


def test_empty_input_writes_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "id long, keyword string")
    assert jsonl.write_jsonl(df, str(tmp_path), "products", RUN) is None
    assert jsonl.write_keyword_results(df, str(tmp_path), "products", RUN) is None
    tables.write_bronze({"products": df}, str(tmp_path))
    assert os.listdir(tmp_path) == []


def test_keyword_results(spark, tmp_path):
    df = spark.createDataFrame([(1, "mug"), (2, "12"), (3, "mug")], "id long, keyword string")
    path = jsonl.write_keyword_results(df, str(tmp_path), "products", RUN)
    folders = sorted(d for d in os.listdir(path) if "=" in d)
    assert folders == ["for_keyword=12", "for_keyword=mug"]
    back = jsonl.read_jsonl(spark, str(tmp_path), df.schema)
    assert rows(back.drop(jsonl.CORRUPT)) == rows(df)


def test_bronze_attempts_every_entity(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "id long")
    bad = good.selectExpr("raise_error('broken') as id")
    with pytest.raises(ExceptionGroup) as caught:
        tables.write_bronze({"bad": bad, "good": good}, str(tmp_path))
    assert len(caught.value.exceptions) == 1
    assert tables.read_table(spark, f"{tmp_path}/good").count() == 1


def test_quarantine_layout(spark, tmp_path):
    df = spark.createDataFrame([("products", "bad", 1), ("products", "worse", 1)],
                               "entity string, reason string, id long")
    for _ in range(2):
        reports.write_rejected(df, str(tmp_path), "2024-01-15")
    reports.write_rejected(df.filter("reason = 'bad'"), str(tmp_path), "2024-01-16")
    assert sorted(os.listdir(f"{tmp_path}/entity=products")) == ["reason=bad", "reason=worse"]
    assert spark.read.parquet(str(tmp_path)).count() == 3


def test_report_is_one_json_record(spark, tmp_path):
    df = spark.createDataFrame([("products", None, 3)], "entity string, note string, n long")
    path = reports.write_report(df, str(tmp_path), "products", "20240115")
    part = next(f for f in os.listdir(path) if f.endswith(".json"))
    assert json.loads(open(f"{path}/{part}").read()) == {"entity": "products", "note": None, "n": 3}


def test_csv_export(spark, tmp_path):
    top = spark.createDataFrame(
        [(1, 'Say "hi", you', "mug", 100, 4.5, 10, None, "http://x"),
         (2, None, None, None, None, 0, 3, None)],
        "product_id long, name string, keyword string, price int, avg_rating double,"
        "total_reviews long, sold_count long, url string")
    lines = reports.export_lines(top, serving.ordering(top, "product_id", "asc"))
    reports.write_export(lines, f"{tmp_path}/out")
    part = next(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".txt"))
    assert open(f"{tmp_path}/out/{part}", encoding="utf-8").read() == (
        "﻿Tên sản phẩm,Từ khóa,Giá (VNĐ),Rating TB,Tổng đánh giá,Đã bán,URL\n"
        '"Say ""hi"", you","mug",100,4.50,10,0,"http://x"\n'
        '"","",0,0.00,0,3,""\n'
    )
    table = reports.table_export_lines(top, serving.ordering(top, "product_id", "asc"))
    assert [r.value for r in table.orderBy("line").collect()][1:] == [
        '"Say ""hi"", you","",100,4.5,10', '"","",0,0,0']


def test_keyword_list(spark, tmp_path):
    put(f"{tmp_path}/keys.txt", "  chuột máy tính \n\n# comment\n   # indented\n\t\nmug # 2\n")
    assert column(reports.read_keywords(spark, f"{tmp_path}/keys.txt"), "keyword") == [
        "chuột máy tính", "mug # 2"]


def test_reload_sees_a_replaced_table(spark, tmp_path):
    """Another program replaces the files; only the reload makes a cached frame see them."""
    tables.write_table(spark.range(3), f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").cache()
    assert df.count() == 3
    tables.write_table(spark.range(5), f"{tmp_path}/next")
    folder = Folder(spark, str(tmp_path))
    folder.remove("t")
    folder.rename("next", "t")
    assert df.count() == 3
    tables.reload_tables(spark, [f"{tmp_path}/t"])
    assert df.count() == 5


def test_unreadable_files_are_listed(spark, tmp_path):
    """Batch and stream both skip what cannot be read, and the ledger names it."""
    put(f"{tmp_path}/in/a.jsonl", '{"product_id": 1}\n\n  \r\n{"product_id": 2}')
    put(f"{tmp_path}/in/deep/b.jsonl", "é not json\n" * 3)
    put(f"{tmp_path}/in/empty.jsonl", "")
    put(f"{tmp_path}/in/notes.txt", "not a landed file\n")
    spark.range(5000).selectExpr("id as product_id").coalesce(1).write.json(f"{tmp_path}/in/c")
    part = next(n for n in os.listdir(f"{tmp_path}/in/c") if n.startswith("part"))
    with open(f"{tmp_path}/in/c/{part}", "r+b") as f:  # no longer what its checksum says
        f.seek(60_000)
        f.write(b"?")
    ledger = jsonl.file_ledger(spark, f"{tmp_path}/in")
    found = {os.path.basename(r.file_path): r for r in ledger.collect()}
    assert set(found) == {"a.jsonl", "b.jsonl", part}
    assert [os.path.basename(r.file_path) for r in jsonl.unreadable_files(ledger).collect()] == [
        part]
    assert found["a.jsonl"].lines == 4 and found["b.jsonl"].lines == 3
    assert found[part].read_bytes < found[part].bytes
    batch = jsonl.read_jsonl(spark, f"{tmp_path}/in", RAW_PRODUCT)
    stream = ingest.landed_stream(spark, f"{tmp_path}/in", RAW_PRODUCT)
    ingest.run_to_end(ingest.append_available(stream, f"{tmp_path}/out", f"{tmp_path}/cp"))
    ids = [sorted(i for i in column(df, "product_id") if i is not None)
           for df in (batch, spark.read.parquet(f"{tmp_path}/out"))]
    assert ids[0] == ids[1] and {1, 2} <= set(ids[0]) and len(ids[0]) < 5002
    assert jsonl.file_ledger(spark, f"{tmp_path}/none").count() == 0


def test_landed_parts_are_compressed_and_accounted_for(spark, tmp_path):
    """plain JSON lines were six times the bytes; the ledger must still find lost ones."""
    df = spark.range(5000).selectExpr("id as product_id", "'a name' as name").coalesce(1)
    path = jsonl.write_jsonl(df, str(tmp_path), "products", RUN)
    part = next(f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-"))
    with open(part, "rb") as f:
        packed = f.read()
    assert part.endswith(".json.gz") and len(packed) < 5000 * 35 / 4
    assert jsonl.read_jsonl(spark, path, RAW_PRODUCT).count() == 5000
    for name, content in (("two", packed * 2), ("cut", packed[:len(packed) // 2])):
        with open(f"{path}/{name}.jsonl.gz", "wb") as f:
            f.write(content)
    found = {os.path.basename(r.file_path): r for r in jsonl.file_ledger(spark, path).collect()}
    two, cut, own = (found[n] for n in ("two.jsonl.gz", "cut.jsonl.gz", os.path.basename(part)))
    assert (own.status, own.lines, two.status, two.lines) == ("read", 5000, "read", 10000)
    assert two.bytes == 2 * own.bytes and cut.status == "unreadable"
