"""Queries over stored forms: block and manifest JSON, section files, element lists, and checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extraction, reconcile, sections
from ..sources import schemas, sinks, tables
from ..sources.tables import with_beds
from .reconciling import FT, MD, NM, RP, SO, _footers, _named, _rendered, _seams, _sorted
from .registry import query
from .sourcing import _files

BL, HB, CA = with_beds("bl"), with_beds("hb"), with_beds("ca")


@query("SELECT doc_id, 'file_' || doc_id || '.' || ['png', 'jpeg', 'webp'][CASE doc_id % 10 WHEN 4 THEN 1 WHEN 5 THEN 2 ELSE 3 END] AS name, CAST(1 AS BIGINT) AS page FROM documents WHERE doc_id % 10 IN (4, 5, 8)")
def src05_image_page(spark, sf_dir):
    f = _files(spark, sf_dir)
    return f.where(extraction.route(extraction.extension(F.col("name"))) == "image").select("doc_id", "name", F.lit(1).cast("bigint").alias("page"))


@query(BL + " SELECT source AS source_file, printf('%s_p%d_b%04d', source, page, ln) AS block_id, block_type, content, page AS page_number, CAST(1.0 AS DOUBLE) AS confidence, heading_level FROM bl")
def src18_raw_blocks(spark, sf_dir):
    """Blocks to JSON and back through the stored schema; a missing confidence gets its default."""
    b = tables.blocks(spark, sf_dir)
    raw = F.to_json(F.struct(F.format_string("%s_p%d_b%04d", "source", "page", "ln").alias("block_id"), "block_type", "content", F.col("page").alias("page_number"), F.col("source").alias("source_file"), "heading_level"))
    x = b.select(F.from_json(raw, schemas.BLOCK).alias("b")).select("b.*")
    return x.select("source_file", "block_id", "block_type", "content", F.col("page_number").cast("bigint").alias("page_number"), F.coalesce("confidence", F.lit(1.0)).alias("confidence"), F.col("heading_level").cast("bigint").alias("heading_level"))


@query(NM + " SELECT source, sec, filename, title, level, parent_path, pages FROM nm")
def src19_manifest(spark, sf_dir):
    """Manifests written as JSON and read back as section rows."""
    m = sinks.manifest(_named(spark, sf_dir)).select(F.from_json("value", schemas.MANIFEST).alias("m"))
    return m.select("m.source", F.explode("m.sections").alias("s")).select("source", "s.sec", "s.filename", "s.title", "s.level", "s.parent_path", "s.pages")


@query(HB + " SELECT page_id, count(*) AS n_elements, string_agg(CASE block_type WHEN 'heading' THEN '## ' || content WHEN 'list_item' THEN '- ' || content ELSE content END, chr(10) || chr(10) ORDER BY pos) AS md FROM hb GROUP BY page_id")
def src20_elements(spark, sf_dir):
    """A warehouse parser's JSON answer to Markdown."""
    h = tables.html_blocks(spark, sf_dir)
    kind = F.when(F.col("block_type") == "heading", "section_header").otherwise(F.col("block_type"))
    e = h.groupBy("page_id").agg(F.to_json(F.struct(F.struct(F.collect_list(F.struct(F.col("pos").alias("id"), kind.alias("type"), "content")).alias("elements")).alias("document"))).alias("raw"))
    d = e.select("page_id", F.from_json("raw", schemas.ELEMENTS)["document"]["elements"].alias("e"))
    return d.select("page_id", F.size("e").cast("bigint").alias("n_elements"), extraction.element_markdown(F.col("e")).alias("md"))


@query(NM + MD[MD.index(", hl AS") :] + """, bo AS (SELECT source, CAST(sec AS BIGINT) AS sec, string_agg(md, chr(10) || chr(10) ORDER BY ord) AS body FROM md WHERE md IS NOT NULL GROUP BY 1, 2)
SELECT n.source || '/' || n.filename AS path, '---' || chr(10) || 'title: ' || CASE WHEN regexp_matches(title, '[:#"'']') THEN '"' || title || '"' ELSE title END || chr(10) || 'heading_level: ' || level || chr(10) || 'pages: ' || pages || chr(10)
|| CASE WHEN parent_path <> '' THEN 'parent_path: ' || CASE WHEN regexp_matches(parent_path, '[:#"'']') THEN '"' || parent_path || '"' ELSE parent_path END || chr(10) ELSE '' END || '---' || chr(10) || chr(10) || coalesce(body, '') AS content FROM nm n LEFT JOIN bo USING (source, sec)""")
def snk03_sections(spark, sf_dir):
    """Section files: path and content."""
    n = _named(spark, sf_dir)
    x = n.join(sections.bodies(_rendered(spark, sf_dir)).select("source", "sec", "body"), ["source", "sec"], "left")
    return x.select(F.concat("source", F.lit("/"), "filename").alias("path"), F.concat(sections.front_matter(x), F.lit("\n"), F.coalesce("body", F.lit(""))).alias("content"))


@query(BL + " SELECT source, CAST(sum(length(content)) AS BIGINT) AS chars, count(*) AS n FROM bl GROUP BY source")
def snk05_blocks_json(spark, sf_dir):
    """What a JSON sink of blocks holds, by document."""
    raw = tables.blocks(spark, sf_dir).select(F.to_json(F.struct("source", "content")).alias("j"))
    x = raw.select(F.from_json("j", "source string, content string").alias("b")).select("b.*")
    return x.groupBy("source").agg(F.sum(F.char_length("content")).alias("chars"), F.count("*").alias("n"))


@query(CA + """ SELECT '{"method":"' || method || '","calls":' || count(*) || ',"in_tok":' || CAST(sum(in_tok) AS BIGINT) || '}' AS value FROM ca GROUP BY method""")
def snk08_results(spark, sf_dir):
    g = tables.calls(spark, sf_dir).groupBy("method").agg(F.count("*").alias("calls"), F.sum("in_tok").alias("in_tok"))
    return g.select(F.to_json(F.struct("method", "calls", "in_tok")).alias("value"))


@query(FT + """, g AS (SELECT source, num, min(page) AS f, max(page) AS l FROM ft GROUP BY 1, 2), n AS (SELECT *, lead(num) OVER w AS nn, lead(f) OVER w AS nf FROM g WINDOW w AS (PARTITION BY source ORDER BY num))
SELECT source, count(*) FILTER (WHERE nf - l - 1 = 0) AS n_skips, count(*) FILTER (WHERE nf - l - 1 <> 0) AS n_gaps, CAST(sum(nn - num - 1) AS BIGINT) AS n_missing FROM n WHERE nn - num > 1 GROUP BY source""")
def dq14_audit(spark, sf_dir):
    g = reconcile.numbering_gaps(_footers(spark, sf_dir))
    return g.groupBy("source").agg(F.count_if(F.col("kind") == "document_numbering_skip").alias("n_skips"), F.count_if(F.col("kind") == "extraction_gap").alias("n_gaps"), F.sum("n_missing").alias("n_missing"))


@query(SO + """, n AS (SELECT source, ord, ord - min(ord) OVER (PARTITION BY source) AS nb, max(ord) OVER (PARTITION BY source) - ord - 1 AS na FROM so)
SELECT source, count(*) AS n, count(*) FILTER (WHERE nb < 1 OR na < 1) AS n_alone FROM n GROUP BY source""")
def dq16_context(spark, sf_dir):
    """Blocks without any neighbour to show on one side: the ends of a document only, if contexts are complete (no page limit here)."""
    c = reconcile.duplicate_context(_sorted(spark, sf_dir), pages=10**6)
    return c.groupBy("source").agg(F.count("*").alias("n"), F.count_if((F.col("before") == "") | (F.col("after") == "")).alias("n_alone"))


@query(RP + " SELECT source, count(*) AS n_blocks, count(*) FILTER (WHERE content IS NULL OR page IS NULL OR block_type IS NULL) AS n_lacking FROM rp GROUP BY source")
def dq21_required(spark, sf_dir):
    lacking = F.col("content").isNull() | F.col("page").isNull() | F.col("block_type").isNull()
    return _seams(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_blocks"), F.count_if(lacking).alias("n_lacking"))
