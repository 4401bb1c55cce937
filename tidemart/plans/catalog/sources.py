"""Sources and sinks: write to the shared folder, read back, compare with the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.columns import as_timestamp
from tidemart.operators import metrics, quality, serving
from tidemart.plans.check_sql import with_views
from tidemart.plans.registry import query
from tidemart.plans.tables import RUN_TS
from tidemart.schemas import RAW_PRODUCT, RAW_REVIEW
from tidemart.sources import jsonl, reports, tables

PRODUCT = ["product_id", "shop_id", "name", "keyword", "price", "rating", "sold_count"]
PRODUCT_SQL = "product_id, shop_id, name, keyword, price, rating, sold_count"


def landed_products(t):
    """The raw products as landed JSON lines; returns the landing folder."""
    return t.once("landing/products", lambda p: jsonl.write_jsonl(
        t.raw_products().drop("l_orderkey", "l_linenumber", "l_quantity"),
        t.path("landing"), "products", RUN_TS,
    ))


@query("s1_jsonl_scan", with_views(f"select {PRODUCT_SQL}, scraped_at from raw_products"))
def _(t):
    landed = jsonl.read_jsonl(t.spark, landed_products(t), RAW_PRODUCT)
    at = as_timestamp(landed, "scraped_at").cast("timestamp_ntz")
    return landed.select(*PRODUCT, at.alias("scraped_at"))


@query("s1_file_ledger", with_views(
    "select 'read' as status, count(*) as lines from raw_products"))
def _(t):
    ledger = jsonl.file_ledger(t.spark, landed_products(t))
    return ledger.groupBy("status").agg(F.sum("lines").alias("lines"))


@query("s2_bronze_write", with_views("""
    select 'products' as entity, product_id, count(*) as rows from raw_products group by 1, 2
    union all
    select 'reviews', product_id, count(*) from raw_reviews group by 1, 2"""))
def _(t):
    base = t.once("s2", lambda p: tables.write_bronze(
        {"products": t.raw_products(), "reviews": t.raw_reviews()}, p
    ))
    sides = [
        tables.read_table(t.spark, f"{base}/{name}").groupBy("product_id").agg(
            F.count(F.lit(1)).alias("rows")
        ).select(F.lit(name).alias("entity"), "product_id", "rows")
        for name in ("products", "reviews")
    ]
    return sides[0].unionByName(sides[1])


@query("s3_table_scan", with_views(
    "select product_id, scraped_at, price, name from silver_products"))
def _(t):
    t.silver_products()
    return tables.read_table(t.spark, t.path("silver/products")).select(
        "product_id", "scraped_at", "price", "name"
    )


@query("s4_parquet_dir_scan", with_views(
    "select review_id, product_id, rating from silver_reviews"))
def _(t):
    t.silver_reviews()
    found = tables.read_parquet_dir(t.spark, t.path("silver/reviews"))
    absent = tables.read_parquet_dir(t.spark, t.path("nowhere"), found.schema)
    return found.unionByName(absent).select("review_id", "product_id", "rating")


@query("s5_gold_sink", with_views("""
    select product_id, price, total_reviews, avg_rating, star_5_percentage
    from product_metrics"""))
def _(t):
    path = t.once("s5", lambda p: tables.write_table(
        metrics.product_metrics(t.silver_products(), t.silver_reviews(), t.run_ts), p
    ))
    return tables.read_table(t.spark, path).select(
        "product_id", "price", "total_reviews", "avg_rating", "star_5_percentage"
    )


REJECTED_SQL = """
    select 'products' as entity, 'invalid_price' as reason, product_id, l_orderkey
    from clean_products where price is null or price <= 0
    union all select 'products', 'missing_product_id', product_id, l_orderkey
    from clean_products where product_id is null
    union all select 'products', 'missing_name', product_id, l_orderkey
    from clean_products where name is null or length(trim(name, ' ')) = 0
    union all select 'products', 'invalid_rating', product_id, l_orderkey
    from clean_products where rating < 0 or rating > 5"""


@query("s6_quarantine_sink", with_views(
    f"select *, '2024-06-01' as run_date from ({REJECTED_SQL})"))
def _(t):
    path = t.once("s6", lambda p: reports.write_rejected(
        quality.product_gate(t.clean_products()).rejected, p, "2024-06-01"
    ))
    return t.spark.read.parquet(path).select(
        "entity", "reason", "product_id", "l_orderkey",
        F.col("run_date").cast("string").alias("run_date"),
    )


@query("s7_day_partitioned_sink", with_views("""
    select review_id, product_id, rating, review_text, 'phone' as keyword from raw_reviews"""))
def _(t):
    path = t.once("s7/reviews", lambda p: jsonl.write_jsonl(
        t.raw_reviews(), t.path("s7"), "reviews", RUN_TS, keyword="phone"
    ))
    day = f"{path}/{RUN_TS:%Y-%m-%d}"
    return jsonl.read_jsonl(t.spark, day, RAW_REVIEW).select(
        "review_id", "product_id", "rating", "review_text", "keyword"
    )


@query("s8_multi_keyword_sink", with_views(f"select {PRODUCT_SQL} from raw_products"))
def _(t):
    rows = t.raw_products().select(*PRODUCT)
    t.once("s8/products", lambda p: jsonl.write_keyword_results(
        rows, t.path("s8"), "products", RUN_TS
    ))
    return jsonl.read_jsonl(t.spark, t.path("s8/products"), rows.schema).select(*PRODUCT)


@query("s9_jsonl_read_back", with_views("""
    select keyword, count(*) as rows, cast(sum(sold_count) as bigint) as sold,
      count(price) as priced from raw_products group by keyword"""))
def _(t):
    landed = jsonl.read_jsonl(t.spark, landed_products(t))
    return landed.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sold_count").alias("sold"),
        F.count("price").alias("priced"),
    )


@query("s10_report_sink", with_views("""
    select 'reviews' as entity, count(*) as input_rows,
      count(*) filter (where rating between 1 and 5) as valid_rows,
      count(*) filter (where rating is null or rating not between 1 and 5) as rejected_rows
    from raw_reviews"""))
def _(t):
    report = quality.review_gate(t.clean_reviews()).report
    path = t.once("s10", lambda p: reports.write_report(report, p, "reviews", "run"))
    return reports.read_report(t.spark, report.schema, path, "reviews", "run").select(
        "entity", "input_rows", "valid_rows", "rejected_rows"
    )


TOP_SQL = """
    select *, row_number() over (order by avg_rating desc, product_id, scraped_at) as line
    from product_metrics where total_reviews > 0
    order by line limit 30"""


def ranking():
    return [F.desc("avg_rating"), F.col("product_id"), F.col("scraped_at")]


@query("s11_csv_export", with_views(f"""
    select 0 as line, chr(65279) ||
      'Tên sản phẩm,Từ khóa,Giá (VNĐ),Rating TB,Tổng đánh giá,Đã bán,URL' as value
    union all
    select line, '"' || replace(name, '"', '""') || '","' || replace(keyword, '"', '""')
      || '",' || price || ',' || printf('%.2f', avg_rating) || ',' || total_reviews || ','
      || sold_count || ',""'
    from ({TOP_SQL})"""))
def _(t):
    top = serving.get_top_products(t.metrics(), limit=30)
    return reports.export_lines(top, ranking())


@query("s11_table_export", with_views(f"""
    select 'Tên sản phẩm,Shop,Giá,Rating,Đánh giá' as value
    union all
    select '"' || replace(name, '"', '""') || '","",' || price || ','
      || regexp_replace(cast(avg_rating as varchar), '\\.0$', '') || ',' || total_reviews
    from ({TOP_SQL})"""))
def _(t):
    top = serving.get_top_products(t.metrics(), limit=30)
    path = t.once("s11", lambda p: reports.write_export(
        reports.table_export_lines(top, ranking()), p
    ))
    # The text reader takes the byte-order mark off again.
    return t.spark.read.text(path)


@query("s12_keyword_list", "select distinct p_brand as keyword from part")
def _(t):
    def write(path):
        brands = t.source("part").select("p_brand").distinct()
        noise = F.array(
            F.concat(F.lit("\t  "), "p_brand", F.lit("  ")), F.lit("   "),
            F.concat(F.lit("  # not "), "p_brand"),
        )
        brands.select(F.explode(noise)).write.mode("overwrite").text(path)

    return reports.read_keywords(t.spark, t.once("s12", write))
