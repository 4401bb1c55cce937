"""Table profiles, layer funnel and data status.

Counts, null rates and price checks come from one aggregate that never shuffles rows;
duplicates need a shuffle of the key columns only, so they run as a second aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.numeric import percent
from tidemart.schemas import schema_of

# Limits in percent, and source and target of each step whose row loss is
# watched.
HIGH_NULL_PCT = 30
HIGH_DROP_PCT = 20
FUNNEL_PAIRS = [
    ("Bronze.Products", "Silver.Products"),
    ("Silver.Products", "Gold.Metrics"),
    ("Bronze.Reviews", "Silver.Reviews"),
    ("Silver.Reviews", "Gold.Sentiment"),
]

_MEASURE = schema_of(layer="string", measure="string", column="string", value="long")


def profile_keys(columns: list[str]) -> list[str]:
    """Key by which repeats are counted; empty when the table has no known key."""
    for keys in (["product_id", "scraped_at"], ["product_id"], ["review_id"]):
        if set(keys) <= set(columns):
            return keys
    return []


def _is_missing(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def repeated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row `(rows, repeats)`: rows beyond the first of each key, null equal to null."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"),
    )


def measures(df: DataFrame, label: str, repeated: DataFrame | None = None) -> DataFrame:
    """Long form `(layer, measure, column, value)` of everything a profile counts.

    `repeated` holds the profile's keys that repeat in `df`, with the number `n` of their rows, if
    they are known; the keys of all rows are then not shuffled again.
    """
    aggregates = {("rows", None): F.count(F.lit(1))}
    for field in df.schema.fields:
        aggregates[("nulls", field.name)] = F.count_if(_is_missing(field))
    if "price" in df.columns:
        aggregates[("bad_price", "price")] = F.count_if(F.col("price") <= 0)
    one = df.agg(*[agg.alias(f"m{i}") for i, agg in enumerate(aggregates.values())])
    entries = [
        F.struct(
            F.lit(label).alias("layer"), F.lit(kind).alias("measure"),
            F.lit(column).cast("string").alias("column"),
            F.col(f"m{i}").cast("bigint").alias("value"),
        )
        for i, (kind, column) in enumerate(aggregates)
    ]
    counted = one.select(F.inline(F.array(*entries)))
    keys = profile_keys(df.columns)
    if not keys:
        return counted
    if repeated is None:
        found = repeated_rows(df, keys)
    else:
        found = repeated.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"))
    repeats = found.select(
        F.lit(label).alias("layer"), F.lit("repeats").alias("measure"),
        F.lit(",".join(keys)).alias("column"), F.col("repeats").alias("value"),
    )
    return counted.unionByName(repeats)


def union_measures(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def absent_measures(spark: SparkSession, label: str, why: str = "missing") -> DataFrame:
    """Stands in for a table that does not exist, or cannot be read (`why="error"`)."""
    return spark.createDataFrame([(label, why, None, 1)], _MEASURE)


def null_rates(df: DataFrame, label: str) -> DataFrame:
    """`(layer, column, null_pct)` per column."""
    m = measures(df, label).filter(F.col("measure").isin("rows", "nulls"))
    rates = _profile(m).select("layer", F.explode("null_rates").alias("column", "null_pct"))
    return rates


def _value(kind: str) -> Column:
    return F.max(F.when(F.col("measure") == kind, F.col("value")))


def _profile(long: DataFrame) -> DataFrame:
    """Assemble one row per layer. Rows per layer are its columns plus three."""
    nulls = F.collect_list(F.when(F.col("measure") == "nulls", F.struct("column", "value")))
    wide = long.groupBy("layer").agg(
        F.coalesce(_value("rows"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("measure") == "nulls").alias("column_count"),
        nulls.alias("nulls"),
        F.coalesce(_value("repeats"), F.lit(0)).alias("duplicate_count"),
        F.coalesce(_value("bad_price"), F.lit(0)).alias("bad_price_count"),
        F.max(F.when(F.col("measure").isin("missing", "error"), F.col("measure")))
        .alias("absence"),
    )
    rows = F.col("row_count")
    rated = F.transform(
        F.array_sort("nulls"),
        lambda e: F.struct(e["column"].alias("k"), percent(e["value"], rows, 2).alias("v")),
    )
    return wide.withColumns({
        "null_rates": F.map_from_entries(rated),
        "duplicate_rate": F.coalesce(
            percent(F.col("duplicate_count"), rows, 2), F.lit(0.0)
        ),
    }).drop("nulls")


def profile(long: DataFrame) -> DataFrame:
    """One report row per layer from the union of the layers' `measures`.

    `issues` lists columns with a high null rate, repeats and non-positive prices.
    """
    base = _profile(long)
    high = F.filter(F.map_entries("null_rates"), lambda e: e["value"] > HIGH_NULL_PCT)
    null_issues = F.transform(
        high, lambda e: F.concat(F.lit("null_rate:"), e["key"], F.lit(":"), e["value"])
    )

    def issue(condition: Column, *parts: Column) -> Column:
        return F.when(condition, F.concat_ws(":", *parts))

    single = F.array_compact(F.array(
        F.col("absence"),
        issue(F.col("duplicate_count") > 0, F.lit("duplicates"),
              F.col("duplicate_count").cast("string"), F.col("duplicate_rate").cast("string")),
        issue(F.col("bad_price_count") > 0, F.lit("non_positive_price"),
              F.col("bad_price_count").cast("string")),
    ))
    issues = F.concat(null_issues, single)
    return base.withColumn("issues", issues).select(
        "layer",
        F.coalesce(F.col("absence"), F.when(F.size("issues") == 0, "ok"), F.lit("warning"))
        .alias("status"),
        "row_count", "column_count", "null_rates", "duplicate_count", "duplicate_rate",
        "bad_price_count", "issues",
    )


def profile_table(df: DataFrame, label: str) -> DataFrame:
    """The report row of one table."""
    return profile(measures(df, label))


def roll_up(profiles: DataFrame) -> DataFrame:
    """Total issues and overall status over all layers."""
    total = F.coalesce(F.sum(F.size("issues")), F.lit(0))
    return profiles.agg(
        total.alias("total_issues"),
        F.when(total == 0, "ok").otherwise("warning").alias("overall_status"),
    )


def report_document(
    profiles: DataFrame, steps: DataFrame, paths: Column, generated_at: str, seconds: float
) -> DataFrame:
    """One row: when and how long, all layers with their paths, the funnel and the roll-up.

    `profiles` has a row per layer and `steps` a row per watched step, so both lists are short.
    """
    layers = profiles.withColumn("path", F.element_at(paths, F.col("layer"))).agg(
        F.array_sort(F.collect_list(F.struct("layer", "path", "status", "row_count",
                                             "column_count", "duplicate_count",
                                             "duplicate_rate", "bad_price_count", "issues")))
        .alias("layers"))
    funnels = steps.agg(F.array_sort(F.collect_list(F.struct(
        "src", "dst", "src_rows", "dst_rows", "drop_pct", "is_high"))).alias("funnel"))
    total = F.aggregate("layers", F.lit(0), lambda n, x: n + F.size(x["issues"]))
    return layers.join(F.broadcast(funnels), F.lit(True)).select(
        F.lit(generated_at).alias("generated_at"), F.lit(seconds).alias("duration_seconds"),
        "layers", "funnel", total.alias("total_issues"),
        F.when(total == 0, "ok").otherwise("warning").alias("overall_status"))


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """`(name, rows)` per table."""
    return union_measures([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, df in tables.items()
    ])


def funnel(counts: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Row loss per step from `(name, rows)`; steps without source rows are left out."""
    listed = F.array(*[
        F.struct(F.lit(s).alias("src"), F.lit(d).alias("dst"))
        for s, d in (pairs or FUNNEL_PAIRS)
    ])
    steps = counts.select("name", "rows", F.inline(listed))

    def rows_of(side):
        return F.coalesce(
            F.max(F.when(F.col("name") == F.col(side), F.col("rows"))), F.lit(0)
        )

    return (
        steps.groupBy("src", "dst")
        .agg(rows_of("src").alias("src_rows"), rows_of("dst").alias("dst_rows"))
        .filter("src_rows > 0")
        .withColumn(
            "drop_pct", percent(F.col("src_rows") - F.col("dst_rows"), F.col("src_rows"), 1)
        )
        .withColumn("is_high", F.col("drop_pct") > HIGH_DROP_PCT)
    )


def dataset_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and availability per dataset, stamped with the read time."""
    return count_rows(tables).select(
        F.col("name").alias("dataset"), "rows", (F.col("rows") > 0).alias("available"),
        F.current_timestamp().alias("loaded_at"),
    )


def health(products: DataFrame, reviews: DataFrame) -> DataFrame:
    counts = count_rows({"products": products, "reviews": reviews})
    return counts.agg(
        F.lit("healthy").alias("status"),
        F.max(F.when(F.col("name") == "products", F.col("rows"))).alias("total_products"),
        F.max(F.when(F.col("name") == "reviews", F.col("rows"))).alias("total_reviews"),
    )
