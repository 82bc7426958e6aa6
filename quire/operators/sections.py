"""Heading levels, Markdown, and the section model: closed forms over windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ordered_join, ordered_values, slug

SECTION_LEVEL, CONTEXT_PAGES = 3, 3
BARE = ("header", "footer")


def normal_title(x: Column) -> Column:
    """Lower case, without dotted leaders, page numbers and punctuation."""
    x = F.regexp_replace(F.lower(x), "\\.{2,}\\s*[0-9]+\\s*$", "")
    x = F.regexp_replace(x, "\\s+[0-9]+\\s*$", "")
    x = F.regexp_replace(x, "[^\\p{L}\\p{N}_\\s]", " ")
    return F.trim(F.regexp_replace(x, "\\s+", " "))


def toc_levels(headings: DataFrame, toc: DataFrame) -> DataFrame:
    """headings (content, level) with the deepest level that the table of contents (title, level) has for their title."""
    known = toc.select(normal_title(F.col("title")).alias("t"), "level").groupBy("t").agg(F.max("level").alias("toc_level"))
    x = headings.withColumn("t", normal_title(F.col("content"))).join(known, "t", "left")
    return x.withColumn("level_out", F.coalesce("toc_level", "level")).drop("t", "toc_level")


def levelled(blocks: DataFrame, toc: DataFrame | None = None) -> DataFrame:
    """blocks with heading_level filled: the table of contents' (source, title, level) for its titles, else the block's own; levels of
    a document without a table of contents are numbered 1, 2, ... in order if there are two or more, and none counts as 2."""
    x = blocks.withColumn("__t", F.when(F.col("block_type") == "heading", normal_title(F.col("content"))))
    if toc is not None:
        known = toc.select("source", normal_title(F.col("title")).alias("__t"), F.col("level").cast("bigint").alias("__l")).groupBy("source", "__t").agg(F.max("__l").alias("__toc"))
        x = x.join(known, ["source", "__t"], "left").join(toc.select("source").distinct().withColumn("__has", F.lit(True)), "source", "left")
    else:
        x = x.withColumn("__toc", F.lit(None).cast("bigint")).withColumn("__has", F.lit(None).cast("boolean"))
    own = F.when(F.coalesce("heading_level", F.lit(0)) == 0, 2).otherwise(F.col("heading_level")).cast("bigint")
    x = x.withColumn("__l", F.when(F.col("__t").isNotNull(), F.coalesce("__toc", own)))
    w = Window.partitionBy("source")
    seen = x.where("__l is not null and __has is null").select("source", "__l").distinct()  # a few rows a document
    ranks = seen.withColumn("__r", F.dense_rank().over(w.orderBy("__l")).cast("bigint")).withColumn("__k", F.count("*").over(w)).where("__k > 1").drop("__k")
    x = x.join(ranks, ["source", "__l"], "left").withColumn("heading_level", F.coalesce("__r", "__l"))
    return x.select(*blocks.columns)


def compact_levels(headings: DataFrame) -> DataFrame:
    """Levels of a document numbered 1, 2, ... in order, if it has two or more; none counts as 2."""
    w = Window.partitionBy("source")
    x = headings.withColumn("l", F.when(F.coalesce("heading_level", F.lit(0)) == 0, 2).otherwise(F.col("heading_level")))
    x = x.withColumn("r", F.dense_rank().over(w.orderBy("l"))).withColumn("k", F.max("r").over(w))
    return x.withColumn("level_out", F.when(F.col("k") > 1, F.col("r")).otherwise(F.col("l")).cast("bigint")).drop("l", "r", "k")


def clamped(headings: DataFrame, key: list[str]) -> DataFrame:
    """Levels that go at most one deeper than the heading before: e_i = min(l_i, e_(i-1) + 1), as a running minimum of l - i, plus i."""
    w = Window.partitionBy(*key).orderBy("ord")
    x = headings.withColumn("rn", F.row_number().over(w))
    return x.withColumn("level_out", (F.min(F.col("heading_level") - F.col("rn")).over(w) + F.col("rn")).cast("bigint")).drop("rn")


def markdown(blocks: DataFrame) -> DataFrame:
    """md of each block: headings by level, tables whose content is rows as pipes (else as it is), list items behind two blanks for
    each level of indent (if there is such a column), decorations in italics unless repeated, null where nothing is shown."""
    t, c = F.col("block_type"), F.col("content")
    hashes = F.repeat(F.lit("#"), F.col("level").cast("int"))
    inset = F.repeat(F.lit("  "), F.coalesce("indent", F.lit(0)).cast("int")) if "indent" in blocks.columns else F.lit("")
    md = F.when(t == "heading", F.concat(hashes, F.lit(" "), c)).when(t.isin(*BARE), F.when(~F.col("is_repeated"), F.concat(F.lit("*"), c, F.lit("*")))).when(t == "list_item", F.concat(inset, F.lit("- "), c)).when(t == "table", F.coalesce(gfm(table_rows(c)), c)).when(t == "figure", F.concat(F.lit("> **[Figure]** "), c)).when(t == "code", F.concat(F.lit("```\n"), c, F.lit("\n```"))).when(t == "unlocated", F.lit(None)).otherwise(c)
    return blocks.withColumn("md", md)


def page_breaks(blocks: DataFrame) -> DataFrame:
    w = Window.partitionBy("source").orderBy("ord")
    return blocks.withColumn("breaks", F.coalesce(F.lag("page").over(w) != F.col("page"), F.lit(False)))


def document_text(rendered: DataFrame) -> DataFrame:
    """The whole Markdown of a document: blocks in order, a rule where the page changes."""
    x = rendered.withColumn("piece", F.concat_ws("\n\n", F.when(F.col("breaks"), "---"), "md")).where("piece <> ''")
    return x.groupBy("source").agg(ordered_join("ord", "piece", "\n\n").alias("md"))


def table_rows(x: Column) -> Column:
    """The rows of a table's content: JSON first, else a literal in single quotes with None, True and False, else null."""
    kind = "array<array<string>>"
    literal = F.regexp_replace(F.regexp_replace(x, "(?<=[\\[,] {0,4})None(?= {0,4}[,\\]])", "null"), "(?<=[\\[,] {0,4})(True|False)(?= {0,4}[,\\]])", '"$1"')
    whole = lambda rows: F.when(F.size(rows) > 0, F.when(F.forall(rows, lambda r: r.isNotNull()), rows))
    return F.when(x.rlike(r"(?s)^\s*\[.*\]\s*$"), F.coalesce(whole(F.from_json(x, kind, {"allowSingleQuotes": "false"})), whole(F.from_json(literal, kind))))


def gfm(rows: Column) -> Column:
    """A table (array of rows of strings, the first the header) in Markdown."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda c: F.trim(F.coalesce(c, F.lit("None")))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(rows[0])))
    body = F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), line)
    return F.when(F.size(rows) == 0, "").otherwise(F.array_join(F.concat(F.array(line(rows[0]), rule), body), "\n"))


def valid_gfm(md: Column) -> Column:
    lines = F.split(md, "\n")
    piped = F.filter(lines, lambda x: F.startswith(F.trim(x), F.lit("|")))
    rules = F.filter(piped, lambda x: x.rlike("^[|\\s:-]*-[|\\s:-]*$"))
    return (F.size(piped) >= 2) & (F.size(rules) >= 1)


def cut(blocks: DataFrame) -> DataFrame:
    """blocks with sec: headings of level up to SECTION_LEVEL open sections; what stands before the first belongs to it. A document
    without such headings is one section."""
    w = Window.partitionBy("source").orderBy("ord")
    opens = (F.col("block_type") == "heading") & (F.col("heading_level") <= SECTION_LEVEL)
    return blocks.withColumn("opens", opens).withColumn("sec", F.greatest(F.sum(opens.cast("int")).over(w), F.lit(1)).cast("bigint"))


def sections(cutted: DataFrame) -> DataFrame:
    """One row a section: title and level of its first opening heading, pages, blocks."""
    first = F.min_by("content", F.when(F.col("opens"), F.col("ord")))
    level = F.min_by("heading_level", F.when(F.col("opens"), F.col("ord")))
    s = cutted.groupBy("source", "sec").agg(
        first.alias("title"), level.alias("level"), F.min("ord").alias("a"), F.max("ord").alias("b"), F.count("*").alias("n_blocks"),
        F.min(F.when(F.col("page") > 0, F.col("page"))).alias("page_start"), F.max(F.when(F.col("page") > 0, F.col("page"))).alias("page_end"),
        F.sum(F.char_length("content")).alias("chars"), F.count_if(F.col("opens")).alias("n_open"),
    )
    return s.withColumn("title", F.when(F.col("n_open") > 0, F.col("title")).otherwise("Document")).withColumn("level", F.when(F.col("n_open") > 0, F.col("level")).otherwise(1)).drop("n_open")


def parents(secs: DataFrame) -> DataFrame:
    """parent_path: the titles of the open levels above. A level closes what is as deep or deeper."""
    w = Window.partitionBy("source").orderBy("sec")
    up = w.rowsBetween(Window.unboundedPreceding, -1)
    x = secs.withColumn("p1", F.last(F.when(F.col("level") == 1, F.struct("sec", "title")), True).over(up)).withColumn("p2", F.last(F.when(F.col("level") == 2, F.struct("sec", "title")), True).over(up))
    p2 = F.when((F.col("level") > 2) & (F.col("p1").isNull() | (F.col("p2.sec") > F.col("p1.sec"))), F.col("p2.title"))
    return x.withColumn("parent_path", F.concat_ws(" > ", F.when(F.col("level") > 1, F.col("p1.title")), p2)).drop("p1", "p2")


def named(secs: DataFrame) -> DataFrame:
    """secs with filename NNN_[parent__]leaf.md and page label."""
    leaf = slug(F.col("title"))
    parent = slug(F.element_at(F.split("parent_path", " > "), -1))
    stem = F.when(F.col("parent_path") != "", F.concat(parent, F.lit("__"), leaf)).otherwise(leaf)
    label = F.when(F.col("page_start") == F.col("page_end"), F.concat(F.lit("p"), F.col("page_start"))).otherwise(F.concat(F.lit("p"), F.col("page_start"), F.lit("–"), F.col("page_end")))
    return secs.withColumn("filename", F.concat(F.format_string("%03d", "sec"), F.lit("_"), F.substring(stem, 1, 113), F.lit(".md"))).withColumn("pages", label)


def context_ids(secs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks within CONTEXT_PAGES pages before and after each section, as ordered lists of ord."""
    b = blocks.select("source", "ord", "page")
    s = secs.select("source", "sec", "a", "b", "page_start", "page_end")
    # only the pages next to either end can hold context: an equal join on these few pages instead of a range join
    ends = F.array_union(F.sequence(F.col("page_start") - CONTEXT_PAGES, "page_start"), F.sequence(F.col("page_end"), F.col("page_end") + CONTEXT_PAGES))
    near = ((F.col("ord") < F.col("a")) & (F.col("page") <= F.col("page_start"))) | ((F.col("ord") > F.col("b")) & (F.col("page") >= F.col("page_end")))
    x = s.withColumn("page", F.explode(ends)).join(b, ["source", "page"]).where(near)
    side = lambda cond: F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("ord")))).cast("array<string>"), ",")
    got = x.groupBy("source", "sec").agg(side(F.col("ord") < F.col("a")).alias("before"), side(F.col("ord") > F.col("b")).alias("after"))
    return s.select("source", "sec").join(got, ["source", "sec"], "left").na.fill("", ["before", "after"])


def yaml_value(x: Column) -> Column:
    return F.when(x.rlike("[:#\"']"), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x)


def front_matter(secs: DataFrame) -> Column:
    parent = F.when(F.col("parent_path") != "", F.concat(F.lit("parent_path: "), yaml_value(F.col("parent_path")), F.lit("\n"))).otherwise("")
    return F.concat(F.lit("---\ntitle: "), yaml_value(F.col("title")), F.lit("\nheading_level: "), F.col("level").cast("string"), F.lit("\npages: "), F.col("pages"), F.lit("\n"), parent, F.lit("---\n"))


def bodies(cutted: DataFrame) -> DataFrame:
    """Markdown of each section."""
    x = cutted.where("md is not null")
    return x.groupBy("source", "sec").agg(ordered_join("ord", "md", "\n\n").alias("body"), F.array_join(ordered_values("ord", "ord").cast("array<string>"), ",").alias("block_ids"))


def title_case(x: Column) -> Column:
    """Every run of letters with its first in upper case and the others in lower (also behind digits and apostrophes)."""
    runs = F.regexp_extract_all(F.regexp_replace(x, "[_-]", " "), F.lit("\\p{L}+|[^\\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1_000_000)))), "")
