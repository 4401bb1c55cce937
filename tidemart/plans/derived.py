"""Marketplace-shaped views derived from the star-schema test tables.

Dirt (bad prices, blank names, impossible ratings, counter restarts) follows fixed rules,
so every rule of the lake has rows to work on at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.operators.ordered import CHUNK, split_hot


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for row-wise work on a table of very few splits, such as one small
    file. A table with a split per core is left alone, so nothing large is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def snapshot_ties() -> list[Column]:
    """Total order among the repeats of a snapshot."""
    names = ("l_orderkey", "l_linenumber", "shop_id", "price", "l_quantity")
    return [F.col(n).asc_nulls_first() for n in names]


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price snapshots with bad prices, blank names and impossible ratings."""
    t = lambda name: table(spark, sf_dir, name)
    joined = (
        spread(t("lineitem"), "l_orderkey")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    price = F.col("l_extendedprice")
    return joined.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("shop_id"),
        F.when(_every("l_orderkey", 89), "   ").otherwise(F.col("p_name")).alias("name"),
        F.col("p_brand").alias("keyword"),
        F.when(_every("l_orderkey", 97), -price)
        .when(_every("l_orderkey", 101), None).otherwise(price).alias("price"),
        (price / (1 - F.col("l_discount"))).alias("original_price"),
        F.when(_every("l_orderkey", 83), 6.0)
        .when(_every("l_orderkey", 79), None)
        .otherwise(F.col("l_quantity") / 10).alias("rating"),
        F.col("l_quantity").cast("bigint").alias("sold_count"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.col("n_name").alias("shop_location"),
        F.col("l_shipdate").alias("scraped_at"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )


def part_count(spark: SparkSession, sf_dir: str) -> Column:
    """Number of products, as a scalar subquery."""
    return table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star ratings spread over four of five products, some out of range or missing."""
    event = F.col("event_id")
    product = (event * 7919) % part_count(spark, sf_dir)
    star = (1 + F.floor("value").cast("bigint") % 5).cast("int")
    return (
        table(spark, sf_dir, "events")
        .withColumn("product_id", product)
        .filter(F.col("product_id") % 5 != 0)
        .select(
            event.alias("review_id"),
            "product_id",
            F.when(event % 53 == 0, 0).when(event % 59 == 0, None).otherwise(star)
            .alias("rating"),
            F.col("event_type").alias("review_text"),
            F.col("ts").alias("created_at"),
        )
    )


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews with free text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spread(documents, "doc_id").select(
        F.col("doc_id").alias("review_id"),
        (F.col("doc_id") % part_count(spark, sf_dir)).alias("product_id"),
        F.col("text").alias("review_text"),
    )


def http_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", kind.alias("handler"), F.col("value").alias("duration"),
        F.when(kind == "error", "500").when(kind == "signup", "404").otherwise("200")
        .alias("status"),
    )


def running_count(
    source: DataFrame,
    keys: list[str],
    time: str,
    order: list[str],
    out: str,
    hot_rows: int,
) -> DataFrame:
    """Number each key's rows from 1 by `time`, then `order`; the order must be total."""
    marked, only_hot = split_hot(source, keys, time, lambda rows: rows, hot_rows, 1)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(time, *order)
    local = marked.withColumn("__position", F.row_number().over(inside))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    in_chunk = only_hot.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = in_chunk.select(*keys, CHUNK, F.sum("__rows").over(before).alias("__before"))
    position = F.coalesce("__before", F.lit(0)) + F.col("__position")
    return local.join(offsets, [*keys, CHUNK], "left").select(
        *source.columns, position.alias(out)
    )


# Every handler has a large share of the events, so even small test data takes the way of
# hot keys.
HOT_HANDLER_ROWS = 100


def http_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running request counter per handler that restarts every 500 requests; of several
    requests at one instant, the last is sampled."""
    requests = http_requests(spark, sf_dir).select("event_id", "ts", "handler")
    counted = running_count(
        requests, ["handler"], "ts", ["event_id"], "n", hot_rows=HOT_HANDLER_ROWS
    )
    sampled = counted.groupBy("handler", "ts").agg(F.max("n").alias("n"))
    return sampled.select("handler", "ts", ((F.col("n") - 1) % 500 + 1).alias("value"))


# Sentiment words for the invented prose of the test documents.
POSITIVE_WORDS = ["the", "und"]
NEGATIVE_WORDS = ["was", "der", "les"]
TOPIC_STOPWORDS = ["the", "of", "de", "and"]

_BODY = "to_json(named_struct('items', array({items})))"
_FIELDS = """named_struct(
    'itemid', product_id, 'shopid', shop_id, 'name', name, 'price', {price},
    'price_before_discount', original_price * 100000, 'catid', category_id,
    'shop_location', shop_location,
    'item_rating', named_struct('rating_star', rating),
    'cmt_count', cast(l_linenumber as bigint), 'historical_sold', sold_count,
    'image', concat('img', cast(product_id as string)))"""


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses of two items each: one nested with a scaled price, one flat with
    the price as it is. Some responses failed, some are for another address."""
    nested = f"named_struct('item_basic', {_FIELDS.format(price='price * 100000')})"
    flat = _FIELDS.format(price="price")
    items = f"to_json({nested}), to_json({flat})"
    return raw_products(spark, sf_dir).select(
        F.when(F.col("l_orderkey") % 17 == 0, "https://host/api/recommend")
        .otherwise("https://host/api/search_items?page=1").alias("url"),
        F.when(F.col("l_orderkey") % 13 == 0, 403).otherwise(200).alias("status"),
        F.expr(f"""concat('{{"items":[', concat_ws(',', {items}), ']}}')""").alias("body"),
        "keyword",
    )


def broken_responses(spark: SparkSession, sf_dir: str, kinds: int) -> DataFrame:
    """A sound item for each raw product, with one field broken as its `kind` says: too short or
    too long, below or above its range, or an explicit null."""
    kind = f"l_orderkey % {kinds}"

    def field(sound, **broken):
        cases = " ".join(f"when {k[1:]} then {v}" for k, v in broken.items())
        return f"case {kind} {cases} else {sound} end" if broken else sound

    item = f"""named_struct(
        'itemid', {field("product_id", _11="null")}, 'shopid', {field("shop_id", _12="null")},
        'name', {field("'Mug'", _1="''", _2="repeat('x', 1001)", _13="null")},
        'price', {field("100.0D", _3="0.0D", _14="null")},
        'price_before_discount', {field("200.0D", _4="-1.0D")},
        'item_rating', named_struct('rating_star', {field("4.0D", _5="5.5D", _6="-0.5D")}),
        'cmt_count', {field("3", _7="-1")}, 'historical_sold', {field("0", _8="-2")},
        'liked_count', {field("1", _9="-3")}, 'stock', {field("7", _10="-4", _15="null")})"""
    return raw_products(spark, sf_dir).select(
        F.lit("https://host/api/search_items").alias("url"), F.lit(200).alias("status"),
        F.expr(f"""concat('{{"items":[', to_json({item}, map('ignoreNullFields', 'false')),
            ']}}')""").alias("body"),
        F.expr(f"cast({kind} as int)").alias("kind"))


def rating_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings responses of one rating each, with mixed media lists."""
    rating = """named_struct(
        'cmtid', review_id, 'rating_star', rating, 'comment', review_text,
        'author_username', concat('user', cast(review_id as string)),
        'images', array(concat('i', cast(review_id as string)), 'second'),
        'like_count', review_id % 7, 'ctime', unix_seconds(cast(created_at as timestamp)))"""
    videos = """',"videos":[{"url":"v', cast(review_id as string), '"},{"url":""},3]'"""
    return raw_reviews(spark, sf_dir).select(
        F.when(F.col("review_id") % 19 == 0, "https://host/api/other")
        .otherwise("https://host/api/get_ratings?limit=50").alias("url"),
        F.when(F.col("review_id") % 23 == 0, 500).otherwise(200).alias("status"),
        F.expr(f"""concat('{{"data":{{"ratings":[', rtrim('}}', to_json({rating})), {videos},
            '}}]}}}}')""").alias("body"),
        "product_id",
        (F.col("review_id") % 100).alias("shop_id"),
    )
