"""Page and document profiles: projections over pages, and one aggregation a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio

SCANNED_CHARS, GARBLED, IMAGE_AREA, TABLES = 150, 0.05, 0.30, 2
GARBLE = "[\\uFFFD\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]"


def garble_rate(text: Column) -> Column:
    """Share of replacement and control characters; 0 unless above GARBLED."""
    n = F.char_length(text)
    bad = n - F.char_length(F.regexp_replace(text, GARBLE, ""))
    r = F.when(n == 0, 0.0).otherwise(bad.cast("double") / n)
    return F.when(r > GARBLED, F.round(r, 6)).otherwise(0.0)


def vision_tokens(width: Column, height: Column, dpi: int = 100) -> Column:
    """Tokens of a page image of so many points: 85, and 170 for each tile of 512 pixels."""
    tiles = lambda x: F.ceil(x * dpi / 72 / 512)
    return (85 + 170 * tiles(width) * tiles(height)).cast("bigint")


def flagged(p: DataFrame) -> DataFrame:
    """p (chars, images, image_area, tables, text) with garble rate and the three kinds of page."""
    p = p.withColumn("garble", garble_rate(F.col("text")))
    p = p.withColumn("is_scanned", (F.col("chars") < SCANNED_CHARS) | (F.col("garble") > GARBLED))
    p = p.withColumn("is_image_heavy", (F.col("image_area") > IMAGE_AREA) | ((F.col("images") > 0) & F.col("is_scanned")))
    return p.withColumn("is_table_heavy", F.col("tables") >= TABLES)


def needs_vision(p: DataFrame) -> Column:
    return (p["chars"] < SCANNED_CHARS) | (p["images"] > 0) | (p["garble"] > GARBLED)


def expected_blank(p: DataFrame) -> Column:
    return (F.col("chars") < 20) & (F.col("images") == 0) & (F.col("tables") == 0)


def documents(p: DataFrame) -> DataFrame:
    """One row a document from flagged pages."""
    agg = p.groupBy("source").agg(
        F.count("*").alias("pages"), F.count_if("is_scanned").alias("scanned"), F.count_if("is_image_heavy").alias("image_heavy"), F.count_if("is_table_heavy").alias("table_heavy"),
        F.sum("chars").alias("sum_chars"), F.sum("tokens").alias("sum_tokens"),
    )
    n = F.col("pages")
    return agg.select("source", "pages", "scanned", "image_heavy", "table_heavy", ratio(F.col("sum_chars"), n).alias("avg_chars"), ratio(F.col("sum_tokens"), n).alias("avg_tokens"), F.expr("sum_chars * 12 div 10").alias("output_chars"))


def fonts(spans: DataFrame, key: str, size: str) -> DataFrame:
    """Largest and smallest size a page, and its three most common rounded ones, descending (ties: the larger first)."""
    s = spans.select(key, F.round(size).cast("bigint").alias("s"))
    counts = s.groupBy(key, "s").agg(F.count("*").alias("n"))
    top = counts.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), F.desc("s"))))
    return top.groupBy(key).agg(F.max("s").alias("max_size"), F.min("s").alias("min_size"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("rn") <= 3, F.col("s"))), asc=False).cast("array<string>"), ",").alias("common"))


def document_fonts(pages: DataFrame) -> DataFrame:
    """pages (doc, page, max_size): the largest size, and the two most frequent among the largest third of pages."""
    w = Window.partitionBy("doc").orderBy(F.desc("max_size"), "page")
    x = pages.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("doc")))
    x = x.where(F.col("rn") <= F.greatest(F.lit(1), F.expr("n div 3")))
    c = x.groupBy("doc", "max_size").agg(F.count("*").alias("c"), F.min("rn").alias("first"))
    c = c.withColumn("k", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("c"), "first")))
    return c.groupBy("doc").agg(F.max("max_size").alias("max_font"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= 2, F.struct("k", "max_size")))), lambda v: v["max_size"].cast("string")), ",").alias("common"))


def routing(p: DataFrame) -> DataFrame:
    """Pages a document sends to each branch, as ordered lists."""
    p = p.withColumn("vision", needs_vision(p))
    return p.groupBy("source").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("vision"), F.col("page")))).cast("array<string>"), ",").alias("vision_pages"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("vision"), F.col("page")))).cast("array<string>"), ",").alias("native_pages"),
    )


