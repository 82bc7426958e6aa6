"""Sinks: manifest, index, sections, text and JSON outputs under a root that the engine owns."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ordered

#: The only names that writing or cleaning touches; anything else under a root stays.
OWNED = ("manifest", "index", "sections", "output", "raw_blocks")


def _at(root: str, name: str) -> str:
    if name not in OWNED:
        raise ValueError(f"{name!r} isn't one of the engine's outputs")
    return posixpath.join(root, name)


def manifest(secs: DataFrame, toc: DataFrame | None = None, repeated: DataFrame | None = None, gaps: DataFrame | None = None) -> DataFrame:
    """One JSON document a source: its sections in order, pages and deepest level; where given, its table of contents (title, level, page),
    the texts of headers and footers that are left out (texts), and gaps of the printed page numbers (after, before, kind)."""
    s = secs.groupBy("source").agg(F.max("page_end").alias("total_pages"), F.max("level").alias("max_heading_level"), ordered("sec", "filename", "title", "level", "parent_path", "pages").alias("sections"))
    more = []
    if toc is not None:
        s = s.join(toc.groupBy("source").agg(ordered("page", "title", "level").alias("toc")), "source", "left")
        more.append(F.coalesce("toc", F.array()).alias("toc"))
    if repeated is not None:
        s = s.join(repeated.select("source", F.col("texts").alias("suppressed_texts")), "source", "left")
        more.append(F.struct(F.coalesce("suppressed_texts", F.array()).alias("suppressed_texts"), F.lit("repeated on 3+ pages verbatim").alias("reason")).alias("header_footer_policy"))
    if gaps is not None:
        s = s.join(gaps.groupBy("source").agg(ordered("after", "before", "kind").alias("gaps")), "source", "left")
        more.append(F.struct(F.coalesce("gaps", F.array()).alias("gaps")).alias("page_numbering_audit"))
    return s.select("source", F.to_json(F.struct("source", "total_pages", "max_heading_level", *more, "sections")).alias("value"))


def index(secs: DataFrame) -> DataFrame:
    """Markdown of each source's contents: a link a section, indented by level."""
    line = F.concat(F.repeat(F.lit("  "), (F.col("level") - 1).cast("int")), F.lit("- ["), "title", F.lit("]("), "filename", F.lit(") "), "pages")
    return secs.withColumn("line", line).groupBy("source").agg(F.array_join(F.transform(ordered("sec", "line"), lambda x: x["line"]), "\n").alias("value"))


def save_json(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("overwrite").json(_at(root, name))


def save_text(df: DataFrame, root: str, name: str, column: str = "value", by: tuple[str, ...] = ("source",)) -> None:
    """One file set of a text column, in a folder for each source (and other key). What was there goes, stale files too."""
    df.select(*by, F.col(column).alias("value")).write.mode("overwrite").partitionBy(*by).text(_at(root, name))


def clean(spark, root: str) -> list[str]:
    """Removes the engine's outputs under root through Spark's file system; unknown files stay. Returns what was there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = []
    for name in OWNED:
        path = hadoop.Path(_at(root, name))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path) and fs.delete(path, True):
            gone.append(name)
    return gone
