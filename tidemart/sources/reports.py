"""Sinks for rejected rows, audit reports and CSV exports, and the keyword-list source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.text import strip_all

# Export headers and the byte-order mark that starts an export.
BOM = "\ufeff"
EXPORT_HEADER = [
    "Tên sản phẩm", "Từ khóa", "Giá (VNĐ)", "Rating TB", "Tổng đánh giá", "Đã bán", "URL",
]
TABLE_EXPORT_HEADER = ["Tên sản phẩm", "Shop", "Giá", "Rating", "Đánh giá"]


def write_rejected(rejected: DataFrame, base: str, run_date: str) -> None:
    """File rejected rows under entity, reason and date, all reasons in one job.

    Reasons without rows leave no folder. A rerun replaces the partitions it writes. The
    rebalance gives each reason few files and splits a reason that holds most rows.
    """
    (
        rejected.withColumn("run_date", F.lit(run_date))
        .hint("rebalance", "entity", "reason")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("entity", "reason", "run_date")
        .parquet(base)
    )


def _report_path(base: str, entity: str, run_id: str) -> str:
    return f"{base}/{entity}_dq_report_{run_id}"


def write_report(report: DataFrame, base: str, entity: str, run_id: str) -> str:
    """Write a small report table as JSON under its entity and run."""
    path = _report_path(base, entity, run_id)
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def read_report(
    spark: SparkSession, schema: T.StructType, base: str, entity: str, run_id: str
) -> DataFrame:
    return spark.read.schema(schema).json(_report_path(base, entity, run_id))


def _quoted(df: DataFrame, name: str) -> Column:
    value = F.col(name) if name in df.columns else F.lit("")
    doubled = F.replace(F.coalesce(value, F.lit("")), F.lit('"'), F.lit('""'))
    return F.concat(F.lit('"'), doubled, F.lit('"'))


def _plain(df: DataFrame, name: str) -> Column:
    """Number as text, without a trailing `.0`; null is 0."""
    value = F.col(name) if name in df.columns else F.lit(0)
    return F.regexp_replace(F.coalesce(value, F.lit(0)).cast("string"), r"\.0$", "")


def _fixed2(df: DataFrame, name: str) -> Column:
    value = F.col(name) if name in df.columns else F.lit(0.0)
    return F.format_string("%.2f", F.coalesce(value, F.lit(0.0)).cast("double"))


def export_lines(top: DataFrame, order: list[Column]) -> DataFrame:
    """Seven-column export of a top list: `(line, value)`, the header is line 0."""
    row = F.concat_ws(
        ",", _quoted(top, "name"), _quoted(top, "keyword"), _plain(top, "price"),
        _fixed2(top, "avg_rating"), _plain(top, "total_reviews"), _plain(top, "sold_count"),
        _quoted(top, "url"),
    )
    return _lines(top, row, EXPORT_HEADER, order)


def table_export_lines(top: DataFrame, order: list[Column]) -> DataFrame:
    """Five-column export of the top table."""
    row = F.concat_ws(
        ",", _quoted(top, "name"), _quoted(top, "shop_name"), _plain(top, "price"),
        _plain(top, "avg_rating"), _plain(top, "total_reviews"),
    )
    return _lines(top, row, TABLE_EXPORT_HEADER, order)


def _lines(top: DataFrame, row: Column, header: list[str], order: list[Column]) -> DataFrame:
    # The input is a top-k list, so one ordered group is small by definition.
    number = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    body = top.select(number.alias("line"), row.alias("value"))
    head = top.sparkSession.range(1).select(
        F.lit(0).alias("line"), F.lit(BOM + ",".join(header)).alias("value")
    )
    return head.unionByName(body)


def write_export(lines: DataFrame, path: str) -> None:
    """Write export lines in order as one text file."""
    ordered = lines.repartition(1).sortWithinPartitions("line")
    ordered.select("value").write.mode("overwrite").text(path)


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """One keyword per line; blank lines and `#` comments are left out."""
    lines = spark.read.text(path).select(strip_all(F.col("value")).alias("keyword"))
    return lines.filter((F.length("keyword") > 0) & ~F.startswith(F.col("keyword"), F.lit("#")))
