"""The whole run on small landed files, and the registry."""

import importlib
import os
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.operators import name_index, profiling, serving, summaries
from tidemart.operators.sentiment import lexicon_scorer
from tidemart.plans.lake import GOLD, PROFILED, Lake, layer_measures, run_day
from tidemart.session import shared_dir
from tidemart.sources import jsonl

RUN = datetime(2024, 1, 15, 14, 30, 22)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    landing = f"{base}/raw"
    products = spark.createDataFrame(
        [(1, "Mug", 100_000.0, 4.0, "2024-01-01T00:00:00", "mug"),
         (1, "Mug", 100_000.0, 4.0, "2024-01-01T00:00:00", "mug"),
         (1, "Mug", 70_000.9, 4.0, "2024-01-03T00:00:00", "mug"),
         (2, "Hat", 50.0, None, "2024-01-01T00:00:00", "hat"),
         (3, "  ", -5.0, 4.0, "2024-01-01T00:00:00", "hat")],
        "product_id long, name string, price double, rating double, scraped_at string,"
        "keyword string")
    reviews = spark.createDataFrame(
        [(1, 1, 5, "great\nmug"), (2, 1, 1, "bad handle broke"), (3, 1, 1, "bad handle broke"),
         (3, 1, 1, "bad handle broke"), (4, 2, 9, "x"), (5, 2, 3, "")],
        "review_id long, product_id long, rating int, review_text string")
    jsonl.write_jsonl(products, landing, "products", RUN)
    jsonl.write_jsonl(reviews, landing, "reviews", RUN, keyword="mug_reviews")
    with open(f"{landing}/products/broken.jsonl", "w") as f:
        f.write("not json\n{\n")
    made = Lake(spark, f"{base}/data")
    made_reports = run_day(made, landing, lexicon_scorer(["great"], ["bad"]), RUN)
    return made, made_reports


def test_quality_reports(lake):
    _, found = lake
    # Corrupt lines have neither id nor time, so they count as repeats of one another.
    assert found["products"]["input_rows"] == 5 and found["products"]["valid_rows"] == 3
    assert found["products"]["invalid_price"] == 2 and found["products"]["missing_name"] == 2
    assert found["products"]["missing_product_id"] == 1
    assert found["reviews"]["input_rows"] == 5 and found["reviews"]["invalid_rating"] == 1
    assert found["reviews"]["missing_text"] == 1 and found["reviews"]["valid_rows"] == 4


def test_gold_tables(lake, spark):
    made, _ = lake
    metrics = {r["product_id"]: r for r in rows(made.read("gold/product_metrics"))}
    assert metrics[1]["price"] == 70_000 and metrics[1]["total_reviews"] == 3
    assert metrics[1]["avg_rating"] == 2.33 and metrics[2]["total_reviews"] == 1
    history = made.read("gold/price_history")
    assert history.filter("is_discount_suspicious").count() == 1
    topics = serving.get_negative_topics(made.read("gold/negative_topics")).collect()
    assert [tuple(r) for r in topics] == [
        ("bad handle", 2), ("bad handle broke", 2), ("handle broke", 2)]
    overview = rows(serving.get_sentiment_overview(made.read("gold/reviews_sentiment")))[0]
    assert (overview["positive"], overview["negative"], overview["neutral"]) == (1, 2, 1)


def test_summaries_follow_the_gold_tables(lake):
    made, _ = lake
    gold = made.read("gold/product_metrics")
    found = name_index.search(made.keyed("gold/product_metrics"), made.keyed("index/names"), "mug")
    assert found.count() == serving.search_names(gold, "mug").count() == 1
    assert rows(summaries.overview(made.read("summary/keywords"), gold)) == rows(
        serving.get_overview(gold))
    assert rows(summaries.sentiment_overview(made.read("summary/labels"))) == rows(
        serving.get_sentiment_overview(made.read("gold/reviews_sentiment")))
    assert summaries.top_products(made.read("summary/top"), gold).collect() == \
        serving.get_top_products(gold).collect()
    assert summaries.volatility(made.read("summary/moves")).collect() == \
        serving.price_volatility(made.read("gold/price_history")).collect()


def test_quarantine_and_reports_on_disk(lake, spark):
    made, _ = lake
    rejected = spark.read.parquet(made.path("quality/rejected"))
    got = {(r.entity, r.reason): r.n for r in
           rejected.groupBy("entity", "reason").agg(F.count("*").alias("n")).collect()}
    assert got == {("products", "invalid_price"): 2, ("products", "missing_name"): 2,
                   ("products", "missing_product_id"): 1,
                   ("reviews", "invalid_rating"): 1, ("reviews", "missing_text"): 1}
    names = os.listdir(made.path("reports"))
    assert {n.split("_")[0] for n in names} == {
        "profile", "funnel", "summary", "document", "measures"}


def test_missing_layers_are_reported(lake, spark):
    made, _ = lake
    nowhere = Lake(spark, made.path("nowhere"))
    long = layer_measures(nowhere, {"A": "bronze/a"}).unionByName(layer_measures(made))
    status = {r["layer"]: r["status"] for r in rows(profiling.profile(long))}
    assert status["A"] == "missing" and set(PROFILED) < set(status)
    os.makedirs(made.path("odd"))
    with open(made.path("odd/part.parquet"), "w") as f:
        f.write("no parquet")
    odd = profiling.profile(layer_measures(made, {"Odd": "odd"}))
    assert [(r["status"], r["issues"]) for r in rows(odd)] == [("error", ["error"])]
    assert len(GOLD) == 4


def test_a_corrupt_part_stops_its_own_layer_only(lake, spark, tmp_path):
    made, _ = lake
    copy = Lake(spark, f"{tmp_path}/copy")
    whole = made.read("silver/products")
    whole.unionByName(whole).repartition(4).write.parquet(copy.path("bronze/products"))
    whole.write.parquet(copy.path("silver/products"))
    parts = sorted(n for n in os.listdir(copy.path("bronze/products")) if n.endswith("parquet"))
    for name in (parts[1], f".{parts[1]}.crc"):
        with open(f"{copy.path('bronze/products')}/{name}", "wb") as out:
            out.write(b"junk" * 50)
    long = layer_measures(copy, {"A": "bronze/products", "B": "silver/products", "C": "none"})
    status = {r.layer: (r.status, r.row_count) for r in profiling.profile(long).collect()}
    assert status["A"] == ("error", 0) and status["C"][0] == "missing"
    assert status["B"][1] == whole.count()


def test_rerun_gives_the_same_tables(lake, spark):
    made, before = lake
    metrics = rows(made.read("gold/product_metrics"))
    again = run_day(made, made.path("../raw"), lexicon_scorer(["great"], ["bad"]), RUN)
    assert again == before and rows(made.read("gold/product_metrics")) == metrics


def _landed(spark, landing, day, products, reviews):
    at = datetime(2024, 1, day, 9)
    jsonl.write_jsonl(spark.createDataFrame(
        products, "product_id long, name string, price double, rating double, scraped_at string,"
        "keyword string"), landing, "products", at)
    jsonl.write_jsonl(spark.createDataFrame(
        reviews, "review_id long, product_id long, rating int, review_text string,"
        "created_at string"), landing, "reviews", at)


def _files(made, name):
    found = {}
    for folder, _, names in os.walk(made.path(name)):
        for n in names:
            if n.endswith(".parquet"):
                found[f"{folder}/{n}"] = os.stat(f"{folder}/{n}").st_mtime_ns
    return found


def test_days_in_sequence_equal_a_rebuild(spark, tmp_path):
    """Late, repeated, moved and newly rejected records, day by day and all at once."""
    landing, step = f"{tmp_path}/raw", Lake(spark, f"{tmp_path}/step")
    whole, scorer = Lake(spark, f"{tmp_path}/whole"), lexicon_scorer(["great"], ["bad"])
    days = [
        ([(1, "Mug", 9.5, 4.0, "2024-01-01T00:00:00", "mug"),
          (2, "Hat", 50.0, None, "2024-01-02T00:00:00", "hat"),
          (3, "Cup", 7.0, 4.0, "2024-01-03T00:00:00", "mug"),
          (4, "Pen", 8.0, 4.0, None, "pen")],
         [(1, 1, 5, "great", "2024-01-01T00:00:00"), (2, 1, 1, "bad", "2024-01-02T00:00:00"),
          (3, 2, 3, "so", "2024-01-05T00:00:00")]),
        ([(2, "Hat", 40.0, None, "2024-01-02 00:00:00", "hat"),   # one time, spelled anew
          (3, " ", 6.0, 4.0, "2024-01-03T00:00:00", "mug"),       # replaces a valid row
          (5, "Bag", 5.0, 4.0, "2024-01-09T00:00:00", "bag")],
         [(2, 1, 1, "bad", "2023-12-30T00:00:00"), (4, 5, 5, "great", None)]),
        ([(1, "Mug", 8.5, 4.0, "2024-01-08T00:00:00", "mug"),
          (1, "Mug", 8.5, 4.0, "2024-01-08T00:00:00", "mug"), (None, "No", 1.0, 1.0, None, "x")],
         [(5, 1, 4, "fine", "2024-01-08T00:00:00")]),
    ]
    for i, (products, reviews) in enumerate(days):
        _landed(spark, landing, i + 1, products, reviews)
        before = _files(step, "silver/products")
        run_day(step, landing, scorer, RUN, only_new=True)
        if i:
            after = _files(step, "silver/products")
            kept = [f for f in before if "__day=2024-01-01" in f]
            assert kept and all(after[f] == before[f] for f in kept)
    run_day(whole, landing, scorer, RUN)
    for name in ("bronze/products", "bronze/reviews", "silver/products", "silver/reviews",
                 "gold/price_history", "gold/reviews_sentiment", "gold/negative_topics"):
        ours, theirs = step.read(name), whole.read(name)
        assert set(ours.columns) == set(theirs.columns)
        assert rows(ours.select(theirs.columns)) == rows(theirs), name
    assert not os.path.exists(step.path("silver/products/__day=2024-01-03"))
    # Without new files nothing is rewritten.
    before = _files(step, "silver/products")
    assert run_day(step, landing, scorer, RUN, only_new=True) == {"products": None, "reviews": None}
    assert _files(step, "silver/products") == before


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert shared_dir(spark) == shared_dir(spark)
        assert os.path.isdir(shared_dir(spark))


def test_registry():
    entry = importlib.import_module("__spark_entry__")
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 130
    families = {"s": 12, "p": 18, "d": 14, "q": 13, "g": 15, "n": 11, "a": 15, "u": 13, "m": 5,
                "x": 4}
    for letter, last in families.items():
        for i in range(1, last + 1):
            assert any(n.startswith(f"{letter}{i}_") for n in queries), f"{letter}{i}"


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    top = entry.entry(spark).collect()
    assert len(top) == 20 and all(r.total_reviews > 0 for r in top)
