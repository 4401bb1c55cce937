"""Canonical schemas of the lake's tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())


def schema_of(**fields: str | T.DataType) -> T.StructType:
    made = T.StructType()
    for name, kind in fields.items():
        made = made.add(name, kind)
    return made


RAW_PRODUCT = schema_of(
    product_id="long", shop_id="long", name="string", price="double",
    original_price="double", currency="string", category_id="long",
    category_name="string", shop_location="string", rating="double", review_count="long",
    sold_count="long", liked_count="long", stock="long", image_url="string", url="string",
    platform="string", scraped_at="string", keyword="string", discount_pct="double",
)

RAW_REVIEW = schema_of(
    review_id="long", product_id="long", shop_id="long", rating="integer",
    review_text="string", author_username="string", author_portrait="string",
    images=_STRINGS, videos=_STRINGS, like_count="long", created_at="string",
    platform="string", scraped_at="string", sentiment_score="double",
    sentiment_label="string", keyword="string",
)

# Intercepted HTTP responses: one row per response, body as text.
RAW_RESPONSE = schema_of(url="string", status="integer", body="string", keyword="string")

NEGATIVE_TOPIC = schema_of(topic="string", count="long")
