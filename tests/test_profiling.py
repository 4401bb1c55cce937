import pytest
from conftest import plan, rows

from tidemart.operators import profiling
from tidemart.operators.ordered import repeated_keys


def test_key_choice():
    assert profiling.profile_keys(["a", "scraped_at", "product_id", "review_id"]) == [
        "product_id", "scraped_at"]
    assert profiling.profile_keys(["product_id", "review_id"]) == ["product_id"]
    assert profiling.profile_keys(["review_id"]) == ["review_id"]
    assert profiling.profile_keys(["topic"]) == []


@pytest.fixture(scope="module")
def table(spark):
    data = [
        (1, None, 0, 1.0), (1, None, 5, float("nan")), (2, "t", -3, None), (2, "t", 4, 2.0),
        (None, "t", 4, 2.0), (None, "t", 4, 2.0), (3, "u", 4, 2.0),
    ]
    return spark.createDataFrame(
        data, "product_id long, scraped_at string, price int, score double"
    )


def report(df, label="T"):
    return rows(profiling.profile_table(df, label))[0]


def test_profile(table):
    got = report(table)
    assert got["row_count"] == 7 and got["column_count"] == 4
    assert got["null_rates"] == {
        "product_id": 28.57, "scraped_at": 28.57, "price": 0.0, "score": 28.57}
    # Null keys are equal to each other.
    assert got["duplicate_count"] == 3 and got["duplicate_rate"] == 42.86
    assert got["bad_price_count"] == 2 and got["status"] == "warning"
    assert got["issues"] == ["duplicates:3:42.86", "non_positive_price:2"]


def test_high_null_rate_is_an_issue(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "a int, b int")
    assert report(df)["issues"] == ["null_rate:a:66.67"]


def test_clean_and_empty_tables_are_ok(spark, table):
    assert report(spark.createDataFrame([(1,)], "product_id long"))["status"] == "ok"
    empty = report(table.limit(0))
    assert empty["row_count"] == 0 and empty["duplicate_rate"] == 0.0


def test_missing_layer_and_roll_up(spark, table):
    long = profiling.union_measures([
        profiling.measures(table, "T"), profiling.absent_measures(spark, "Gone"),
        profiling.measures(spark.createDataFrame([(1,)], "topic int"), "Fine"),
    ])
    profiles = profiling.profile(long)
    assert {r["layer"]: r["status"] for r in rows(profiles)} == {
        "T": "warning", "Gone": "missing", "Fine": "ok"}
    assert rows(profiling.roll_up(profiles)) == [
        {"total_issues": 3, "overall_status": "warning"}]
    fine = profiling.profile(long.filter("layer = 'Fine'"))
    assert rows(profiling.roll_up(fine))[0]["overall_status"] == "ok"


def test_funnel(spark):
    counts = spark.createDataFrame(
        [("a", 100), ("b", 70), ("c", 140), ("zero", 0)], "name string, rows long"
    )
    pairs = [("a", "b"), ("b", "c"), ("zero", "a"), ("a", "absent")]
    got = {(r["src"], r["dst"]): r for r in rows(profiling.funnel(counts, pairs))}
    assert set(got) == {("a", "b"), ("b", "c"), ("a", "absent")}
    assert got["a", "b"]["drop_pct"] == 30.0 and got["a", "b"]["is_high"]
    assert got["b", "c"]["drop_pct"] == -100.0 and not got["b", "c"]["is_high"]
    assert got["a", "absent"]["dst_rows"] == 0 and got["a", "absent"]["drop_pct"] == 100.0


def test_status_and_health(spark, table):
    status = {r["dataset"]: (r["rows"], r["available"]) for r in rows(
        profiling.dataset_status({"full": table, "none": table.limit(0)}))}
    assert status == {"full": (7, True), "none": (0, False)}
    assert rows(profiling.health(table, table.limit(0))) == [
        {"status": "healthy", "total_products": 7, "total_reviews": 0}]


def test_known_repeats_are_not_counted_again(table):
    listed = repeated_keys(table, ["product_id", "scraped_at"], counts="n")
    assert {(r["product_id"], r["n"]) for r in rows(listed)} == {(1, 2), (2, 2), (None, 2)}
    ours = profiling.measures(table, "T", listed.localCheckpoint())
    assert rows(ours) == rows(profiling.measures(table, "T"))
    assert "hashpartitioning" not in plan(ours)
    empty = profiling.measures(table, "T", listed.limit(0)).filter("measure = 'repeats'")
    assert rows(empty)[0]["value"] == 0
