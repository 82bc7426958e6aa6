"""Reconciliation of block sequences across pages and chunks: window functions over (document, order), one exchange by document."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ordered

#: Fixed order of block types within a page; any other type counts as 6.
TYPE_RANK = {"header": 0, "heading": 1, "paragraph": 2, "list_item": 3, "figure": 4, "code": 5, "table": 6, "footer": 7}
REPEATED, SIMILAR = 3, 0.9
SPLIT_LEAST, SPLIT_MOST = 3, 40


def type_rank(t: Column) -> Column:
    out = None
    for k, v in TYPE_RANK.items():
        out = F.when(t == k, v) if out is None else out.when(t == k, v)
    return out.otherwise(6)


def canonical(blocks: DataFrame) -> DataFrame:
    """blocks (source, page, block_type, seq) with ord: by page, type, then input order."""
    w = Window.partitionBy("source").orderBy("page", type_rank(F.col("block_type")), "seq")
    return blocks.withColumn("ord", F.row_number().over(w).cast("bigint") - 1)


def drop_adjacent_duplicates(blocks: DataFrame) -> DataFrame:
    """Without blocks equal to the one before (same page, type and content)."""
    w = Window.partitionBy("source").orderBy("ord")
    same = F.lit(True)
    for c in ("page", "block_type", "content"):
        same &= F.col(c).eqNullSafe(F.lag(c).over(w))
    return blocks.withColumn("__same", same & (F.col("ord") > F.min("ord").over(w))).where("not __same").drop("__same")


def mark_repeated(blocks: DataFrame) -> DataFrame:
    """is_repeated: header or footer text that REPEATED or more such blocks of the document have. Counted by a grouped
    aggregation and joined, so that one very common text isn't one window."""
    edge = F.col("block_type").isin("header", "footer")
    often = blocks.where(edge).groupBy("source", "content").agg(F.count("*").alias("__n")).where(F.col("__n") >= REPEATED)
    x = blocks.join(often, ["source", "content"], "left")
    return x.withColumn("is_repeated", edge & F.col("__n").isNotNull()).drop("__n")


def suppressed(marked: DataFrame) -> DataFrame:
    return marked.where("is_repeated").groupBy("source").agg(F.array_sort(F.collect_set("content")).alias("texts"))


def seams(blocks: DataFrame) -> DataFrame:
    """The live composition: canonical order, adjacent duplicates, repeated headers and footers."""
    return mark_repeated(drop_adjacent_duplicates(canonical(blocks)))


def full(blocks: DataFrame) -> DataFrame:
    """The whole composition for blocks (source, page, block_type, content, chunk, seq, is_truncated, is_continuation): seams, then list
    items linked to what they continue (continued_from), headings that end a chunk moved to the next, and risk: whether a block is
    cut off, or the next one goes on, where chunks meet. No block but adjacent duplicates goes."""
    x = seams(blocks)
    w = Window.partitionBy("source").orderBy("ord")
    links = F.lag("is_truncated").over(w) & F.col("is_continuation") & (F.col("block_type") == "list_item") & (F.lag("block_type").over(w) == "list_item")
    x = x.withColumn("continued_from", F.when(links, F.lag("ord").over(w)))
    x = orphaned_headings(x).drop("chunk").withColumnRenamed("new_chunk", "chunk")
    cut = (F.lead("chunk").over(w) != F.col("chunk")) & (F.col("is_truncated") | F.lead("is_continuation").over(w))
    return x.withColumn("risk", F.coalesce(cut, F.lit(False)))


def decided(answer: Column) -> Column:
    """The decision in a model's answer about a seam: its JSON field, else the first of the known words, else independent."""
    known = "merge_table|continue_section|independent"
    own = F.lower(F.coalesce(F.get_json_object(answer, "$.decision"), answer))
    word = F.regexp_extract(own, known, 0)
    return F.when(word == "", "independent").otherwise(word)


def arbitrated(edges: DataFrame, answers: DataFrame) -> DataFrame:
    """risks (source, ord, ...) with the decisions of answers (source, ord, answer): resolved where there is one; how, by what."""
    x = edges.join(answers.select("source", "ord", decided(F.col("answer")).alias("decision")), ["source", "ord"], "left")
    return x.withColumn("resolved", F.col("decision").isNotNull()).withColumn("resolution", F.when(F.col("decision").isin("merge_table", "continue_section"), "llm_decision").otherwise("unresolved"))


def similar_candidates(blocks: DataFrame) -> DataFrame:
    """Adjacent blocks of different chunks whose lengths allow a ratio above SIMILAR (2 * shorter / both)."""
    w = Window.partitionBy("source").orderBy("ord")
    x = blocks.select("source", "ord", "page", "chunk", "content", *(F.lead(c).over(w).alias(f"next_{c}") for c in ("page", "chunk", "content")))
    a, b = F.char_length("content"), F.char_length("next_content")
    return x.where((F.col("chunk") != F.col("next_chunk")) & (2.0 * F.least(a, b) / (a + b) > SIMILAR))


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def similar(blocks: DataFrame) -> DataFrame:
    """Near-duplicate neighbours; only candidates reach Python."""
    x = similar_candidates(blocks).withColumn("similarity", F.pandas_udf(_ratios, "double")("content", "next_content")).where(F.col("similarity") > SIMILAR)
    return x.select("source", "ord", "page", F.round("similarity", 6).alias("similarity"), (F.col("next_page") - F.col("page")).alias("page_distance"))


def duplicate_context(blocks: DataFrame, near: int = 5, pages: int = 3) -> DataFrame:
    """For each block, up to `near` blocks on either side within `pages` pages (from two behind), as ordered lists of ord: window
    frames of fixed length, so the work is linear in the blocks."""
    w = Window.partitionBy("source").orderBy("ord")
    frame = lambda a, b: F.collect_list(F.struct("ord", "page")).over(w.rowsBetween(a, b))
    told = lambda xs, keep: F.array_join(F.transform(F.array_sort(F.filter(xs, keep)), lambda x: x["ord"].cast("string")), ",")
    x = blocks.select("source", "ord", "page", frame(-near, -1).alias("b"), frame(2, 1 + near).alias("a"))
    return x.select("source", "ord", told(F.col("b"), lambda v: v["page"] >= F.col("page") - pages).alias("before"), told(F.col("a"), lambda v: v["page"] <= F.col("page") + pages).alias("after"))


def pair_links(tables: DataFrame) -> DataFrame:
    """tables (doc, page, is_truncated, is_continuation): page pairs that merge. A run of linked tables pairs up from
    its start (first with second, third with fourth): merging doesn't chain."""
    w = Window.partitionBy("doc").orderBy("page")
    x = tables.withColumn("link", F.coalesce(F.lag("is_truncated").over(w) & F.col("is_continuation"), F.lit(False)))
    x = x.withColumn("island", F.sum(F.when(F.col("link"), 0).otherwise(1)).over(w))
    x = x.withColumn("k", F.row_number().over(Window.partitionBy("doc", "island").orderBy("page")) - 1)
    return x.withColumn("grp", F.expr("k div 2")).drop("link", "k")


def pair_merged(tables: DataFrame) -> DataFrame:
    """Merged tables: place of the first, truncation of the last, all rows in order less a repeated seam row."""
    g = pair_links(tables)
    w = Window.partitionBy("doc", "island", "grp").orderBy("page")
    g = g.withColumn("drop_first", F.coalesce(F.element_at(F.lag("rows").over(w), -1) == F.col("rows")[0], F.lit(False)))
    g = g.withColumn("own", F.when(F.col("drop_first"), F.slice("rows", 2, F.size("rows"))).otherwise(F.col("rows")))
    out = g.groupBy("doc", "island", "grp").agg(F.min("page").alias("page"), F.count("*").alias("n_tables"), F.max_by("is_truncated", "page").alias("is_truncated"), ordered("page", "own").alias("parts"))
    return out.select("doc", "page", "n_tables", "is_truncated", F.flatten(F.transform("parts", lambda p: p["own"])).alias("rows"))


def header_chains(tables: DataFrame) -> DataFrame:
    """tables (doc, page, header, rows): neighbours on later pages with an equal header merge in chains; their header rows are
    kept once. Only chains of two or more count as merged."""
    w = Window.partitionBy("doc").orderBy("page")
    link = F.coalesce((F.lag("header").over(w) == F.col("header")) & (F.lag("page").over(w) < F.col("page")), F.lit(False))
    x = tables.withColumn("island", F.sum(F.when(link, 0).otherwise(1)).over(w))
    out = x.groupBy("doc", "island").agg(F.min("page").alias("page"), F.max("page").alias("page_end"), F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"))
    return out.withColumn("merged_cross_page", F.col("n_tables") > 1).drop("island")


def list_links(items: DataFrame, key: str) -> DataFrame:
    """items (key, ord, is_truncated, is_continuation, indent): the item that each continues."""
    w = Window.partitionBy(key).orderBy("ord")
    ok = F.lag("is_truncated").over(w) & F.col("is_continuation") & F.lag("indent").over(w).eqNullSafe(F.col("indent"))
    return items.withColumn("continued_from", F.when(ok, F.lag("ord").over(w)))


def orphaned_headings(blocks: DataFrame) -> DataFrame:
    """A heading that ends its chunk before a paragraph that begins the next moves to that chunk."""
    w = Window.partitionBy("source").orderBy("ord")
    moves = (F.col("block_type") == "heading") & (F.lead("chunk").over(w) != F.col("chunk")) & (F.lead("block_type").over(w) == "paragraph") & ~F.lead("is_continuation").over(w)
    return blocks.withColumn("new_chunk", F.when(moves, F.lead("chunk").over(w)).otherwise(F.col("chunk")))


def numbering_gaps(footers: DataFrame) -> DataFrame:
    """footers (source, page, num): jumps of the printed number, by whether pages are missing too."""
    g = footers.groupBy("source", "num").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    w = Window.partitionBy("source").orderBy("num")
    x = g.withColumn("next_num", F.lead("num").over(w)).withColumn("next_page", F.lead("first_page").over(w))
    gap = F.col("next_page") - F.col("last_page") - 1
    return x.where(F.col("next_num") - F.col("num") > 1).select(
        "source", F.col("num").alias("after"), F.col("next_num").alias("before"), (F.col("next_num") - F.col("num") - 1).alias("n_missing"),
        F.when(gap == 0, "document_numbering_skip").otherwise("extraction_gap").alias("kind"),
    )


def dominant_offset(footers: DataFrame) -> DataFrame:
    """The most frequent page - num of a document; of equals, the one met first."""
    c = footers.groupBy("source", (F.col("page") - F.col("num")).alias("offset")).agg(F.count("*").alias("n"), F.min("page").alias("first"))
    best = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "first", "offset"))
    return c.withColumn("k", best).where("k = 1").select("source", "offset")


def absent_pages(pages: DataFrame, footers: DataFrame) -> DataFrame:
    """Placeholders for pages between a document's first and last that have no row, numbered by the dominant offset."""
    span = pages.groupBy("source").agg(F.min("page").alias("a"), F.max("page").alias("b"))
    every = span.select("source", F.explode(F.sequence("a", "b")).alias("page"))
    gone = every.join(pages.select("source", "page").distinct(), ["source", "page"], "left_anti")
    x = gone.join(dominant_offset(footers), "source")
    return x.withColumn("inferred", F.col("page") - F.col("offset")).where("inferred > 0").drop("offset")


def split_over_hollow(tables: DataFrame, hollow: DataFrame) -> DataFrame:
    """tables (doc, page, n_rows), hollow (doc, page): a table followed by P - 1 hollow pages is dealt over P pages evenly, the first ones
    getting one row more, if 3 P <= rows <= 40 P."""
    w = Window.partitionBy("doc").orderBy("page")
    run = hollow.withColumn("g", F.col("page") - F.row_number().over(w)).groupBy("doc", "g").agg(F.min("page").alias("h"), F.count("*").alias("len")).select("doc", (F.col("h") - 1).alias("page"), "len")
    x = tables.join(run, ["doc", "page"]).withColumn("parts", F.col("len") + 1)
    x = x.where(F.col("n_rows").between(SPLIT_LEAST * F.col("parts"), SPLIT_MOST * F.col("parts")))
    x = x.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    size = F.expr("n_rows div parts") + F.when(F.col("part") < F.col("n_rows") % F.col("parts"), 1).otherwise(0)
    return x.select("doc", "page", (F.col("page") + F.col("part")).alias("to_page"), "part", "parts", size.alias("n"), (F.col("part") == 0).alias("has_header"))


def risks(blocks: DataFrame) -> DataFrame:
    """Neighbours of different chunks where one is cut off or goes on."""
    w = Window.partitionBy("source").orderBy("ord")
    x = blocks.select("source", "ord", "chunk", "is_truncated", F.lead("ord").over(w).alias("next_ord"), F.lead("chunk").over(w).alias("next_chunk"), F.lead("is_continuation").over(w).alias("next_continues"))
    return x.where((F.col("chunk") != F.col("next_chunk")) & (F.col("is_truncated") | F.col("next_continues")))


def sides(blocks: DataFrame, n: int = 3, most: int = 80) -> DataFrame:
    """Previews of the last n blocks of a chunk and the first n of the next, for arbitration."""
    w = Window.partitionBy("source", "chunk")
    x = blocks.withColumn("up", F.row_number().over(w.orderBy("ord"))).withColumn("down", F.row_number().over(w.orderBy(F.desc("ord"))))
    text = F.substring("content", 1, most)
    join = lambda k, cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("ord", text.alias("t"))))), lambda v: v["t"]), " | ")
    return x.groupBy("source", "chunk").agg(join("up", F.col("up") <= n).alias("head"), join("down", F.col("down") <= n).alias("tail"))


def spliced(blocks: DataFrame, again: DataFrame) -> DataFrame:
    """blocks with the chunks of `again` (same columns) put in place of the old ones."""
    return blocks.join(again.select("source", "chunk").distinct(), ["source", "chunk"], "left_anti").unionByName(again.select(blocks.columns))
