"""Turn intercepted HTTP responses into product and review rows.

A response is `(url, status, body, keyword)`, ratings responses also carry `product_id`
and `shop_id`. Bodies are read as VARIANT because two rules depend on what a fixed schema
hides: a missing field takes its default while an explicit null does not, and media lists
keep elements by their JSON type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.pricing import discount_percent, rescale
from tidemart.operators.ordered import keep_first

# Response markers, media and product addresses, and metadata defaults.
SEARCH_MARKER = "search_items"
RATINGS_MARKER = "get_ratings"
MEDIA_BASE = "https://cf.shopee.vn/file/"
PRODUCT_BASE = "https://shopee.vn/"
CURRENCY = "VND"
PLATFORM = "shopee"
NAME_MAX = 1000
MAX_REVIEWS = 100
# Fields that must be whole, and the Unix seconds of the years 1 to 9999.
WHOLE_PRODUCT = ["itemid", "shopid", "catid", "cmt_count", "historical_sold", "liked_count",
                 "stock"]
WHOLE_REVIEW = ["cmtid", "rating_star", "like_count"]
TIME_RANGE = (-62135596800, 253402300799)


# Types of the payload fields that are read.
_ITEM = {
    "itemid": "bigint", "shopid": "bigint", "name": "string", "price": "double",
    "price_before_discount": "double", "catid": "bigint", "shop_location": "string",
    "item_rating": "struct<rating_star: double>", "cmt_count": "bigint",
    "historical_sold": "bigint", "liked_count": "bigint", "stock": "bigint", "image": "string",
}
_RATING = """struct<cmtid: bigint, rating_star: int, comment: string,
    author_username: string, author_portrait: string, images: array<variant>,
    videos: array<variant>, like_count: bigint, ctime: double>"""


def _read(raw: Column, kind: str) -> Column:
    """The raw object next to its typed fields, read in one go; a field that does not fit
    its type is null."""
    return F.struct(raw.alias("raw"), F.try_variant_get(raw, "$", kind).alias("typed"))


def _fits(raw: Column, names: list[str]) -> Column:
    """False if any of the named fields holds a number with a fraction. The object is read once,
    for all of them."""
    kind = ", ".join(f"{name}: double" for name in names)

    def fits(read: Column) -> Column:
        whole = [F.coalesce(read[name] == F.floor(read[name]), F.lit(True)) for name in names]
        return reduce(Column.__and__, whole)

    return F.forall(F.array(F.try_variant_get(raw, "$", f"struct<{kind}>")), fits)


def _or_default(name: str, default) -> Column:
    """A typed field; the default if the object has no such key, null if it is null."""
    absent = F.try_variant_get("raw", f"$.{name}", "variant").isNull()
    return F.coalesce(F.col(f"typed.{name}"), F.when(absent, F.lit(default)))


def _responses(responses: DataFrame, marker: str) -> DataFrame:
    """Successful responses of one address."""
    wanted = F.contains(F.col("url"), F.lit(marker)) & (F.col("status") == 200)
    return responses.filter(wanted)


def _listed(path: str) -> Column:
    return F.try_variant_get(F.try_parse_json("body"), path, "array<variant>")


def _context(responses: DataFrame) -> list[str]:
    """Columns that travel with every element of a response."""
    return [c for c in responses.columns if c not in ("url", "status", "body")]


def search_items(responses: DataFrame) -> DataFrame:
    """One row per item of every successful search response."""
    found = _responses(responses, SEARCH_MARKER)
    return found.select(*_context(responses), F.explode(_listed("$.items")).alias("item"))


def rating_items(responses: DataFrame) -> DataFrame:
    """One row per rating of every successful ratings response."""
    found = _responses(responses, RATINGS_MARKER)
    return found.select(
        *_context(responses), F.explode(_listed("$.data.ratings")).alias("item")
    )


def media_url(image: Column) -> Column:
    return F.when(F.length(image) > 0, F.concat(F.lit(MEDIA_BASE), image))


def product_url(name: Column, shop_id: Column, product_id: Column) -> Column:
    slug = F.replace(name, F.lit(" "), F.lit("-"))
    return F.concat(
        F.lit(PRODUCT_BASE), slug, F.lit("-i."),
        shop_id.cast("string"), F.lit("."), product_id.cast("string"),
    )


def _field(name: str) -> Column:
    return F.col(f"typed.{name}")


# Each product column: the payload field it is read from, and how.
_PRODUCT = {
    "product_id": ("itemid", lambda n: _or_default(n, 0)),
    "shop_id": ("shopid", lambda n: _or_default(n, 0)),
    "name": ("name", lambda n: _or_default(n, "")),
    "price": ("price", lambda n: rescale(_or_default(n, 0.0))),
    "original_price": ("price_before_discount", lambda n: rescale(_field(n))),
    "category_id": ("catid", _field),
    "shop_location": ("shop_location", _field),
    "rating": ("item_rating", lambda n: _field(f"{n}.rating_star")),
    "review_count": ("cmt_count", lambda n: _or_default(n, 0)),
    "sold_count": ("historical_sold", lambda n: _or_default(n, 0)),
    "liked_count": ("liked_count", lambda n: _or_default(n, 0)),
    "stock": ("stock", lambda n: _or_default(n, 0)),
    "image_url": ("image", lambda n: media_url(_field(n))),
}


def flatten_products(responses: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rename and type the fields of each item, nested under `item_basic` or not.

    Objects are read inside the generator, so once however often filters use their fields. With
    `columns` only the payload fields of these are decoded; otherwise all of them, and `whole`
    marks items whose whole-number fields have no fraction.
    """
    def basic(item):
        return F.coalesce(F.try_variant_get(item, "$.item_basic", "variant"), item)

    wanted = {c: _PRODUCT[c] for c in columns or _PRODUCT}
    kind = ", ".join(f"{n}: {_ITEM[n]}" for n in dict.fromkeys(n for n, _ in wanted.values()))
    basics = F.transform(_listed("$.items"), basic)
    read = _responses(responses, SEARCH_MARKER).select(
        *_context(responses), F.inline(F.transform(basics, lambda b: _read(b, f"struct<{kind}>")))
    )
    whole = [] if columns else [_fits(F.col("raw"), WHOLE_PRODUCT).alias("whole")]
    return read.select(
        *[build(field).alias(c) for c, (field, build) in wanted.items()],
        *whole, *_context(responses),
    )


def with_metadata(df: DataFrame, run_ts: Column, currency: bool) -> DataFrame:
    """Platform, currency and scrape time where the rows do not bring their own."""
    wanted = {"platform": F.lit(PLATFORM), "scraped_at": run_ts}
    if currency:
        wanted["currency"] = F.lit(CURRENCY)
    return df.withColumns({
        name: F.coalesce(F.col(name), value) if name in df.columns else value
        for name, value in wanted.items()
    })


def _violations(checks: dict[str, Column]) -> Column:
    """Names of the failed checks. A check that cannot be decided has failed."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(passed, F.lit(False)), F.lit(name))
        for name, passed in checks.items()
    ]))


def _flagged(df: DataFrame, name: str, column: str) -> dict[str, Column]:
    return {name: F.col(column)} if column in df.columns else {}


def check_products(df: DataFrame) -> DataFrame:
    """Add the names of the failed checks; `whole` marks fields with a fraction."""
    def optional(name, passed):
        return F.col(name).isNull() | passed

    counters = ("review_count", "sold_count", "liked_count", "stock")
    checks = {
        "product_id": F.col("product_id").isNotNull(),
        "shop_id": F.col("shop_id").isNotNull(),
        "name": F.length("name").between(1, NAME_MAX),
        "price": F.col("price") > 0,
        "original_price": optional("original_price", F.col("original_price") >= 0),
        "rating": optional("rating", F.col("rating").between(0, 5)),
        **{c: F.col(c) >= 0 for c in counters},
        **_flagged(df, "whole_number", "whole"),
    }
    return df.withColumn("violations", _violations(checks)).drop("whole")


def with_discount(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "discount_pct", discount_percent(F.col("price"), F.col("original_price")))


def parse_products(responses: DataFrame, run_ts: Column) -> DataFrame:
    """All items of the search responses as product rows with a `violations` array."""
    flat = with_metadata(flatten_products(responses), run_ts, currency=True)
    return check_products(with_discount(flat.withColumn(
        "url", product_url(F.col("name"), F.col("shop_id"), F.col("product_id")))))


def image_urls(images: Column) -> Column:
    """Addresses of the text elements; other elements are dropped."""
    texts = F.filter(images, lambda v: F.schema_of_variant(v) == "STRING")
    urls = F.transform(
        texts, lambda v: F.concat(F.lit(MEDIA_BASE), F.try_variant_get(v, "$", "string"))
    )
    return F.coalesce(urls, F.array().cast("array<string>"))


def video_urls(videos: Column) -> Column:
    """Non-empty `url` of the object elements; other elements are dropped."""
    urls = F.transform(videos, lambda v: F.try_variant_get(v, "$.url", "string"))
    kept = F.filter(urls, lambda u: F.length(u) > 0)
    return F.coalesce(kept, F.array().cast("array<string>"))


def unix_time(seconds: Column) -> Column:
    """Unix seconds as an instant."""
    return F.timestamp_seconds(seconds)


def flatten_reviews(responses: DataFrame) -> DataFrame:
    """Rename and type the fields of each rating."""
    objects = F.transform(_listed("$.data.ratings"), lambda r: _read(r, _RATING))
    read = _responses(responses, RATINGS_MARKER).select(
        *_context(responses), F.inline(objects)
    )
    return read.select(
        _or_default("cmtid", 0).alias("review_id"),
        _or_default("rating_star", 5).alias("rating"),
        _or_default("comment", "").alias("review_text"),
        _or_default("author_username", "").alias("author_username"),
        _or_default("author_portrait", "").alias("author_portrait"),
        image_urls(F.col("typed.images")).alias("images"),
        video_urls(F.col("typed.videos")).alias("videos"),
        _or_default("like_count", 0).alias("like_count"),
        F.when(F.col("typed.ctime").between(*TIME_RANGE), unix_time(F.col("typed.ctime")))
        .alias("created_at"),
        F.lit(None).cast("double").alias("sentiment_score"),
        F.lit(None).cast("string").alias("sentiment_label"),
        _fits(F.col("raw"), WHOLE_REVIEW).alias("whole"),
        F.coalesce(F.col("typed.ctime").between(*TIME_RANGE), F.lit(True)).alias("dated"),
        *_context(responses),
    )


def check_reviews(df: DataFrame) -> DataFrame:
    score = F.col("sentiment_score")
    return df.withColumn("violations", _violations({
        "review_id": F.col("review_id").isNotNull(),
        "product_id": F.col("product_id").isNotNull(),
        "shop_id": F.col("shop_id").isNotNull(),
        "rating": F.col("rating").between(1, 5),
        "like_count": F.col("like_count") >= 0,
        "sentiment_score": score.isNull() | score.between(-1, 1),
        **_flagged(df, "whole_number", "whole"),
        **_flagged(df, "created_at", "dated"),
    })).drop("whole", "dated")


def parse_reviews(responses: DataFrame, run_ts: Column) -> DataFrame:
    """All ratings of the ratings responses as review rows with a `violations` array."""
    flat = flatten_reviews(responses)
    return check_reviews(with_metadata(flat, run_ts, currency=False))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size("violations") == 0).drop("violations")


def skipped(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size("violations") > 0)


def cap_per_key(
    df: DataFrame, key: str, order: list[Column], n: int = MAX_REVIEWS
) -> DataFrame:
    """At most `n` rows per key, the first by arrival."""
    return keep_first(df, [key], order, n)


def cap_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_keywords(results: list[DataFrame]) -> DataFrame:
    """Concatenate per-keyword results; absent columns become null."""
    whole = results[0]
    for part in results[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def tag_review_keyword(reviews: DataFrame, keyword: Column) -> DataFrame:
    """Reviews are filed under the keyword with a suffix, never the bare keyword."""
    return reviews.withColumn("keyword", F.concat(keyword, F.lit("_reviews")))


def crawl_report(attempts: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per attempted keyword with its yield and outcome.

    `attempts` is `(keyword, error, duration_seconds)`. Products carry the bare keyword,
    reviews the suffixed one. A failed keyword counts nothing.
    """
    bare = F.regexp_replace("keyword", "_reviews$", "")
    per_product = products.groupBy("keyword").agg(F.count(F.lit(1)).alias("products"))
    per_review = reviews.groupBy(bare.alias("keyword")).agg(F.count(F.lit(1)).alias("reviews"))
    ok = F.col("error").isNull()

    def counted(name):
        return F.when(ok, F.coalesce(F.col(name), F.lit(0))).otherwise(F.lit(0)).alias(name)

    return (
        attempts
        .join(per_product, "keyword", "left")
        .join(per_review, "keyword", "left")
        .select(
            "keyword",
            F.when(ok, "completed").otherwise("failed").alias("outcome"),
            "error",
            counted("products"),
            counted("reviews"),
            F.round("duration_seconds", 1).alias("duration_seconds"),
        )
    )


def crawl_summary(report: DataFrame) -> DataFrame:
    """Totals and overall status of a crawl report."""
    failed = F.count_if(F.col("outcome") == "failed")
    completed = F.count_if(F.col("outcome") == "completed")
    return report.agg(
        F.count(F.lit(1)).alias("keywords_total"),
        completed.alias("keywords_completed"),
        failed.alias("keywords_failed"),
        F.coalesce(F.sum("products"), F.lit(0)).alias("total_products"),
        F.coalesce(F.sum("reviews"), F.lit(0)).alias("total_reviews"),
        F.when(failed == 0, "completed").when(completed > 0, "partial")
        .otherwise("failed").alias("status"),
    )
