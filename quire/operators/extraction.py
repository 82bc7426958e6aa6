"""Reading provider answers and semi-structured content: JSON, Markdown tables, layout and element lists, HTML, files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import strip

#: One block of a provider's answer.
BLOCK = "struct<block_id:string,block_type:string,content:string,page_number:string,heading_level:string,confidence:string,is_truncated:boolean,is_continuation:boolean>"
ANSWER = f"struct<blocks:array<{BLOCK}>>"
#: Fixed map of file endings to media types; any other is a JPEG.
MEDIA = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "pdf": "application/pdf"}
MAGIC = [("89504E47", "png"), ("FFD8FF", "jpeg"), ("47494638", "gif"), ("52494646", "webp")]
ROUTES = [("pdf", "pdf"), ("docx,pptx", "office"), ("xlsx", "sheet"), ("png,jpg,jpeg,gif,webp,tif,tiff,bmp", "image"), ("html,htm,md,txt,csv,json,xml", "text")]


def parsed_answer(raw: Column) -> Column:
    """Blocks of an answer: the whole text as JSON, else its widest braces, else a fenced block; an object without blocks, or
    nothing readable, gives none."""
    fence = F.regexp_extract(raw, "(?s)```(?:json)?\\s*(.*?)```", 1)
    braces = F.regexp_extract(raw, "(?s)\\{.*\\}", 0)
    valid = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    text = F.coalesce(valid(raw), valid(F.nullif(braces, F.lit(""))), valid(F.nullif(fence, F.lit(""))))
    return F.coalesce(F.from_json(text, ANSWER)["blocks"], F.array().cast(f"array<{BLOCK}>"))


def located(blocks: DataFrame, key: list[str]) -> DataFrame:
    """blocks (key, ord, page_number, targets): the page if it is a target, else the last valid one where none is given, else unlocated (0)."""
    w = Window.partitionBy(*key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    n = F.col("page_number").try_cast("int")
    ok = F.array_contains("targets", n)
    carried = F.last(F.when(ok, n), True).over(w)
    page = F.when(ok, n).when(n.isNull(), F.coalesce(carried, F.lit(0))).otherwise(0)
    return blocks.withColumn("page", page).withColumn("inferred", n.isNull() & carried.isNotNull())


def element_markdown(elements: Column) -> Column:
    """elements (array of id, type, content): by id, headings and titles marked, page furniture left out."""
    kept = F.filter(F.array_sort(elements), lambda e: ~e["type"].isin("page_footer", "page_number", "page_header"))
    line = lambda e: F.when(e["type"] == "title", F.concat(F.lit("# "), e["content"])).when(e["type"] == "section_header", F.concat(F.lit("## "), e["content"])).when(e["type"] == "list_item", F.concat(F.lit("- "), e["content"])).when(e["type"] == "caption", F.concat(F.lit("*"), e["content"], F.lit("*"))).otherwise(e["content"])
    return F.array_join(F.transform(kept, line), "\n\n")


def under_headings(blocks: DataFrame, key: str) -> DataFrame:
    """blocks (key, pos, block_type, content): sections by running count of headings, their text joined; text before the first is left out."""
    w = Window.partitionBy(key).orderBy("pos")
    x = blocks.withColumn("sec", F.sum((F.col("block_type") == "heading").cast("int")).over(w)).where("sec > 0")
    text = F.array_sort(F.collect_list(F.when(F.col("block_type") != "heading", F.struct("pos", "content"))))
    return x.groupBy(key, F.col("sec").cast("bigint").alias("sec")).agg(F.min_by("content", "pos").alias("title"), F.array_join(F.transform(text, lambda v: v["content"]), "\n").alias("content"))


def key_values(lines: DataFrame) -> DataFrame:
    """lines (..., line): key and value around the first colon, of bounded lengths."""
    at = F.instr("line", ":")
    key, value = strip(F.substring("line", F.lit(1), at - 1)), strip(F.substring("line", at + 1, F.char_length("line")))
    x = lines.where(at > 0).withColumn("key", key).withColumn("value", value)
    return x.where(F.char_length("key").between(1, 59) & F.char_length("value").between(1, 299)).drop("line")


def markdown_rows(md: Column) -> Column:
    """Rows of a Markdown table: rules and empty rows left out, cells stripped."""
    lines = F.filter(F.split(md, "\n"), lambda x: ~x.rlike("^[|\\s:-]*$"))
    cells = F.transform(lines, lambda x: F.transform(F.split(F.regexp_replace(F.trim(x), "^\\||\\|$", ""), "\\|"), lambda c: F.trim(c)))
    return F.filter(cells, lambda r: F.exists(r, lambda c: c != ""))


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, "\\.([A-Za-z0-9]+)$", 1))


def route(ext: Column) -> Column:
    out = None
    for names, kind in ROUTES:
        cond = ext.isin(*names.split(","))
        out = F.when(cond, kind) if out is None else out.when(cond, kind)
    return out.otherwise("text")


def media_type(ext: Column) -> Column:
    out = None
    for e, m in MEDIA.items():
        out = F.when(ext == e, m) if out is None else out.when(ext == e, m)
    return out.otherwise("image/jpeg")


def sniffed(content: Column) -> Column:
    """Image type by the first bytes; png if none fits."""
    head = F.hex(F.substring(content, 1, 4))
    out = None
    for magic, kind in MAGIC:
        cond = F.startswith(head, F.lit(magic))
        out = F.when(cond, kind) if out is None else out.when(cond, kind)
    return out.otherwise("png")


def render_dpi(width: Column, height: Column, most: int = 4 * 1024 * 1024) -> Column:
    """The first of 100, 72 and 50 dpi whose raw image (a byte a pixel) is small enough, else 50."""
    options = F.array(F.lit(100), F.lit(72), F.lit(50))
    fit = F.filter(options, lambda d: (width * d / 72) * (height * d / 72) <= most)
    return F.coalesce(F.get(fit, F.lit(0)), F.lit(50))
