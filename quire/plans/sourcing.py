"""Queries over sources, formats and provider answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import ordered_join
from ..operators import extraction
from ..sources import tables
from ..sources.tables import with_beds
from .registry import query

HB, BP, BL, CA = with_beds("hb"), with_beds("bp"), with_beds("bl"), with_beds("ca")
#: Documents as files: the ending goes by doc_id.
_EXT = ["pdf", "docx", "pptx", "xlsx", "png", "jpeg", "txt", "html", "webp", "odd"]
_NAME = "'file_' || doc_id || '.' || ['" + "', '".join(_EXT) + "'][CAST(doc_id % 10 AS INTEGER) + 1]"


def _files(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents").select("doc_id", "source", "text", "n_chars")
    name = F.concat(F.lit("file_"), F.col("doc_id").cast("string"), F.lit("."), F.element_at(F.array(*map(F.lit, _EXT)), (F.col("doc_id") % 10).cast("int") + 1))
    return d.withColumn("name", name)


@query(f"""WITH f AS (SELECT doc_id, {_NAME} AS name FROM documents) SELECT doc_id, name, CASE WHEN e = 'pdf' THEN 'pdf' WHEN e IN ('docx', 'pptx') THEN 'office' WHEN e = 'xlsx' THEN 'sheet' WHEN e IN ('png', 'jpeg', 'webp') THEN 'image' ELSE 'text' END AS route
FROM (SELECT *, lower(regexp_extract(name, '\\.([A-Za-z0-9]+)$', 1)) AS e FROM f)""")
def src01_dispatch(spark, sf_dir):
    return _files(spark, sf_dir).select("doc_id", "name", extraction.route(extraction.extension(F.col("name"))).alias("route"))


@query("""SELECT p_partkey, '<tr><td>' || array_to_string([p_name, p_brand, CASE WHEN p_size % 10 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END], '</td><td>') || '</td></tr>' AS html FROM part""")
def src04_blank_cells(spark, sf_dir):
    """Falsy cells (sizes that end in 0 count as 0) are blank."""
    size = F.when(F.col("p_size") % 10 == 0, "").otherwise(F.col("p_size").cast("string"))
    return tables.table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", "p_name", "p_brand", size), F.lit("</td></tr>")).alias("html"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)
SELECT doc_id, CAST((k - 1) // 40 + 1 AS BIGINT) AS page, string_agg(line, chr(10) ORDER BY k) AS text FROM l GROUP BY 1, 2""")
def src06_text_pages(spark, sf_dir):
    """Plain text as pages of 40 lines."""
    d = tables.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.decode(F.encode("text", "UTF-8"), "UTF-8"), "\n")).alias("k", "line"))
    return d.groupBy("doc_id", F.expr("k div 40 + 1").cast("bigint").alias("page")).agg(ordered_join("k", "line", "\n").alias("text"))


@query(HB + " SELECT page_id, pos, block_type, content FROM hb")
def src07_html_blocks(spark, sf_dir):
    return tables.html_blocks(spark, sf_dir)


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'png' WHEN 1 THEN 'jpeg' WHEN 2 THEN 'gif' WHEN 3 THEN 'webp' ELSE 'png' END AS kind FROM documents""")
def src09_sniff(spark, sf_dir):
    heads = F.array(*(F.lit(h) for h in ("89504E470D0A", "FFD8FFE0", "474946383961", "524946460000", "00000000")))
    d = tables.table(spark, sf_dir, "documents").select("doc_id", F.unhex(F.element_at(heads, (F.col("doc_id") % 5).cast("int") + 1)).alias("content"))
    return d.select("doc_id", extraction.sniffed(F.col("content")).alias("kind"))


@query(f"""SELECT doc_id, CASE e WHEN 'png' THEN 'image/png' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'webp' THEN 'image/webp' WHEN 'pdf' THEN 'application/pdf' ELSE 'image/jpeg' END AS media_type
FROM (SELECT doc_id, lower(regexp_extract({_NAME}, '\\.([A-Za-z0-9]+)$', 1)) AS e FROM documents)""")
def src10_media_type(spark, sf_dir):
    return _files(spark, sf_dir).select("doc_id", extraction.media_type(extraction.extension(F.col("name"))).alias("media_type"))


@query("""SELECT p_partkey, CAST(CASE WHEN (w * 100 / 72) * (h * 100 / 72) <= 4194304 THEN 100 WHEN (w * 72 / 72) * (h * 72 / 72) <= 4194304 THEN 72 ELSE 50 END AS BIGINT) AS dpi FROM (SELECT p_partkey, 600.0 + 40 * p_size AS w, 800.0 + 50 * p_size AS h FROM part)""")
def src11_dpi(spark, sf_dir):
    s = F.col("p_size")
    return tables.table(spark, sf_dir, "part").select("p_partkey", extraction.render_dpi(600.0 + 40 * s, 800.0 + 50 * s).cast("bigint").alias("dpi"))


@query(r"""SELECT regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS folder, url FROM pages WHERE regexp_matches(url, '\.html$')""")
def src13_discover(spark, sf_dir):
    p = tables.table(spark, sf_dir, "pages").where(F.col("url").rlike("\\.html$"))
    return p.select(F.regexp_extract("url", "^[a-z]+://([^/]*)", 1).alias("folder"), "url")


_WANTED = ["SRC1", "rc9", "nothing", "src19"]


@query("""WITH w AS (SELECT * FROM (VALUES (1, 'SRC1'), (2, 'rc9'), (3, 'nothing'), (4, 'src19')) AS w(k, wanted)), m AS (SELECT w.*, s.source, row_number() OVER (PARTITION BY k ORDER BY s.source) AS rn FROM w LEFT JOIN (SELECT DISTINCT source FROM documents) s ON contains(lower(s.source), lower(w.wanted)))
SELECT wanted, source, source IS NOT NULL AS found FROM m WHERE rn = 1""")
def src14_select(spark, sf_dir):
    """The first source that contains each wanted name; the wanted list is short and given."""
    w = F.broadcast(spark.createDataFrame(list(enumerate(_WANTED)), "k int, wanted string"))
    s = tables.table(spark, sf_dir, "documents").select("source").distinct()
    hit = s.join(w, F.contains(F.lower(s["source"]), F.lower(w["wanted"]))).groupBy("k").agg(F.min("source").alias("source"))
    return w.join(hit, "k", "left").select("wanted", "source", F.col("source").isNotNull().alias("found"))


@query("SELECT source, count(*) AS n_pages FROM documents GROUP BY source")
def src15_page_count(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n_pages"))


@query(BP + " SELECT source, page, doc_id FROM bp WHERE page <= 10")
def src16_sample(spark, sf_dir):
    return tables.pages(spark, sf_dir).where("page <= 10").select("source", "page", "doc_id")


@query(BP + """ SELECT source, CAST((page - 1) // 12 AS BIGINT) AS part, min(page) AS page_start, max(page) AS page_end, '## Pages ' || min(page) || '-' || max(page) AS label FROM bp GROUP BY 1, 2""")
def src17_partition(spark, sf_dir):
    p = tables.pages(spark, sf_dir).groupBy("source", F.expr("(page - 1) div 12").cast("bigint").alias("part")).agg(F.min("page").alias("page_start"), F.max("page").alias("page_end"))
    return p.withColumn("label", F.format_string("## Pages %d-%d", "page_start", "page_end"))


@query("""SELECT p_partkey, CASE WHEN 1000 + 15 * p_size > 1500 OR 1300 + 12 * p_size > 2000 THEN 'scan' ELSE 'digital' END AS kind, CAST(CASE WHEN 1000 + 15 * p_size > 1500 OR 1300 + 12 * p_size > 2000 THEN 150 ELSE 300 END AS BIGINT) AS dpi FROM part""")
def src21_kind(spark, sf_dir):
    scan = (1000 + 15 * F.col("p_size") > 1500) | (1300 + 12 * F.col("p_size") > 2000)
    return tables.table(spark, sf_dir, "part").select("p_partkey", F.when(scan, "scan").otherwise("digital").alias("kind"), F.when(scan, 150).otherwise(300).cast("bigint").alias("dpi"))


@query("""SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_items, round(sum(l_quantity * 2), 6) AS width, string_agg('t' || l_partkey, ' ' ORDER BY l_partkey) AS text FROM lineitem GROUP BY 1""")
def src22_layout(spark, sf_dir):
    """Layout JSON written from rows and read back: items of the first page."""
    li = tables.table(spark, sf_dir, "lineitem")
    item = F.struct(F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("text"), F.col("l_partkey").alias("x"), (F.col("l_quantity") * 2).alias("width"))
    raw = li.groupBy("l_orderkey").agg(F.to_json(F.struct(F.array(F.struct(F.lit(1).alias("page"), F.collect_list(item).alias("textItems"))).alias("pages"))).alias("raw"))
    doc = raw.select("l_orderkey", F.from_json("raw", "pages array<struct<page:int,textItems:array<struct<text:string,x:bigint,width:double>>>>").alias("d"))
    it = doc.select("l_orderkey", F.explode(F.col("d.pages")[0]["textItems"]).alias("i")).select("l_orderkey", "i.*")
    return it.groupBy("l_orderkey").agg(F.count("*").alias("n_items"), F.round(F.sum("width"), 6).alias("width"), ordered_join("x", "text", " ").alias("text"))


@query("""SELECT event_id, event_type, COALESCE(value, 0.0) AS value, CAST(612 AS DOUBLE) AS page_width_pts FROM events""")
def src24_serde(spark, sf_dir):
    """Rows to JSON and back with a schema that has a later field; it gets its default."""
    e = tables.table(spark, sf_dir, "events")
    back = F.from_json(F.to_json(F.struct("event_id", "event_type", "value")), "event_id bigint, event_type string, value double, page_width_pts double")
    return e.select(back.alias("b")).select("b.event_id", "b.event_type", F.coalesce("b.value", F.lit(0.0)).alias("value"), F.coalesce("b.page_width_pts", F.lit(612.0)).alias("page_width_pts"))


#: Answers in five shapes, by event_id.
def _answers(spark, sf_dir):
    e = tables.table(spark, sf_dir, "events").select("event_id", "event_type")
    body = F.concat(F.lit('{"blocks": [{"block_type": "paragraph", "content": "'), "event_type", F.lit('", "page_number": '), (F.col("event_id") % 9).cast("string"), F.lit("}]}"))
    k = F.col("event_id") % 5
    raw = F.when(k == 0, body).when(k == 1, F.concat(F.lit("Here it is: "), body, F.lit(" - done"))).when(k == 2, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 3, F.lit('{"other": 1}')).otherwise(F.lit("nothing to read"))
    return e.select("event_id", raw.alias("raw"))


@query("SELECT event_id, CAST(CASE WHEN event_id % 5 <= 2 THEN 1 ELSE 0 END AS BIGINT) AS n_blocks, CASE WHEN event_id % 5 <= 2 THEN event_type END AS content, CASE WHEN event_id % 5 <= 2 THEN CAST(event_id % 9 AS VARCHAR) END AS page_number FROM events")
def ext05_parse(spark, sf_dir):
    x = _answers(spark, sf_dir).withColumn("b", extraction.parsed_answer(F.col("raw")))
    first = F.get("b", F.lit(0))
    return x.select("event_id", F.size("b").cast("bigint").alias("n_blocks"), first["content"].alias("content"), first["page_number"].alias("page_number"))


@query(HB + """ SELECT page_id, string_agg(CASE block_type WHEN 'heading' THEN '# ' || content WHEN 'list_item' THEN '- ' || content ELSE content END, chr(10) || chr(10) ORDER BY pos) AS md FROM hb GROUP BY page_id""")
def ext19_elements(spark, sf_dir):
    h = tables.html_blocks(spark, sf_dir)
    kind = F.when(F.col("block_type") == "heading", "title").otherwise(F.col("block_type"))
    furniture = F.array(F.struct(F.lit(-1).cast("bigint").alias("id"), F.lit("page_number").alias("type"), F.lit("9").alias("content")))
    e = h.groupBy("page_id").agg(F.concat(F.collect_list(F.struct(F.col("pos").alias("id"), kind.alias("type"), "content")), furniture).alias("e"))
    return e.select("page_id", extraction.element_markdown(F.col("e")).alias("md"))


@query(HB + """, s AS (SELECT *, sum(CASE WHEN block_type = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY pos) AS sec FROM hb)
SELECT page_id, CAST(sec AS BIGINT) AS sec, arg_min(content, pos) AS title, COALESCE(string_agg(content, chr(10) ORDER BY pos) FILTER (WHERE block_type <> 'heading'), '') AS content FROM s WHERE sec > 0 GROUP BY 1, 2""")
def ext20_sections(spark, sf_dir):
    return extraction.under_headings(tables.html_blocks(spark, sf_dir), "page_id")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(replace(text, ', ', ': '), chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
k AS (SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, regexp_replace(regexp_replace(left(line, strpos(line, ':') - 1), '^\s+', ''), '\s+$', '') AS key, regexp_replace(regexp_replace(substr(line, strpos(line, ':') + 1), '^\s+', ''), '\s+$', '') AS value FROM l WHERE strpos(line, ':') > 0)
SELECT * FROM k WHERE length(key) BETWEEN 1 AND 59 AND length(value) BETWEEN 1 AND 299""")
def ext21_kvp(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.replace("text", F.lit(", "), F.lit(": ")), "\n")).alias("line_no", "line"))
    return extraction.key_values(d.withColumn("line_no", F.col("line_no").cast("bigint")))


@query("""SELECT p_brand, count(*) + 1 AS n_rows, string_agg(p_name || '/' || p_size, ';' ORDER BY p_partkey) AS body FROM part GROUP BY p_brand""")
def ext22_md_table(spark, sf_dir):
    line = F.concat(F.lit("| "), "p_name", F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |"))
    md = tables.table(spark, sf_dir, "part").withColumn("line", line).groupBy("p_brand").agg(F.concat(F.lit("| name | size |\n| --- | --- |\n"), ordered_join("p_partkey", "line", "\n"), F.lit("\n|  |  |")).alias("md"))
    x = md.withColumn("r", extraction.markdown_rows(F.col("md")))
    return x.select("p_brand", F.size("r").cast("bigint").alias("n_rows"), F.array_join(F.transform(F.slice("r", 2, F.size("r")), lambda c: F.array_join(c, "/")), ";").alias("body"))


@query(HB + " SELECT page_id, pos, block_type, left(content, 200) AS text_preview FROM hb")
def ext23_preview(spark, sf_dir):
    return tables.html_blocks(spark, sf_dir).select("page_id", "pos", "block_type", F.substring("content", 1, 200).alias("text_preview"))


@query("""WITH t AS (SELECT conv_id, turn, text, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations WHERE text IS NOT NULL AND text <> '')
SELECT conv_id, string_agg(CASE WHEN n > 1 THEN '--- Page ' || turn || ' ---' || chr(10) || text ELSE text END, chr(10) || chr(10) ORDER BY k) AS text FROM t GROUP BY conv_id""")
def ext24_pages(spark, sf_dir):
    c = tables.table(spark, sf_dir, "conversations").where("text is not null and text <> ''")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    one = F.transform("t", lambda x: F.when(F.size("t") > 1, F.concat(F.lit("--- Page "), x["turn"].cast("string"), F.lit(" ---\n"), x["text"])).otherwise(x["text"]))
    return g.select("conv_id", F.array_join(one, "\n\n").alias("text"))


@query(BL + """ SELECT source, chunk, count(*) AS n, count(DISTINCT page) AS n_pages, bool_and(block_type IN ('header', 'heading', 'paragraph', 'footer')) AS types_ok, bool_and(heading_level IS NULL OR heading_level BETWEEN 1 AND 6) AS levels_ok FROM bl GROUP BY 1, 2""")
def ext28_contract(spark, sf_dir):
    """Post-conditions of the provider's blocks."""
    b = tables.blocks(spark, sf_dir)
    return b.groupBy("source", "chunk").agg(F.count("*").alias("n"), F.countDistinct("page").alias("n_pages"), F.bool_and(F.col("block_type").isin("header", "heading", "paragraph", "footer")).alias("types_ok"), F.bool_and(F.col("heading_level").isNull() | F.col("heading_level").between(1, 6)).alias("levels_ok"))


@query()
def ext04_provider(spark, sf_dir):
    """Chunks through the registered native-text provider."""
    from ..sources import providers

    p = tables.pages(spark, sf_dir).select(F.col("source").alias("doc"), F.expr("(page - 1) div 4").cast("bigint").alias("chunk"), "page", "text")
    return providers.run(providers.get("native"), p).groupBy("doc", "chunk").agg(F.count("*").alias("n_blocks"), F.countDistinct("page").alias("n_pages"), F.max("in_tok").alias("in_tok"))


