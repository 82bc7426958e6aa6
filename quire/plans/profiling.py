"""Queries over page profiles, chunk plans and extraction control."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import strip
from ..operators import chunking, profile
from ..sources import tables
from ..sources.tables import with_beds
from .registry import query

PF, BL, CA, BP = with_beds("pf"), with_beds("bl"), with_beds("ca"), with_beds("bp")
_G = r"""CASE WHEN length(text) > 0 AND CAST(length(text) - length(regexp_replace(text, '[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) AS DOUBLE) / length(text) > 0.05
 THEN round(CAST(length(text) - length(regexp_replace(text, '[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) AS DOUBLE) / length(text), 6) ELSE 0.0 END"""
#: Flagged pages, behind the view pf.
FG = PF + f""", fg0 AS (SELECT *, {_G} AS garble FROM pf), fg1 AS (SELECT *, chars < 150 OR garble > 0.05 AS is_scanned FROM fg0),
fg AS (SELECT *, image_area > 0.30 OR (images > 0 AND is_scanned) AS is_image_heavy, tables >= 2 AS is_table_heavy FROM fg1)"""
#: Greedy chunks, behind fg: a recursion over each document's pages.
CK = FG + """, pk0 AS (SELECT source, page, tokens, CASE WHEN is_table_heavy THEN 8000 ELSE 20000 END AS budget FROM fg),
pk AS (SELECT source, page, tokens, CAST(0 AS BIGINT) AS chunk, tokens AS acc, CAST(1 AS BIGINT) AS n FROM pk0 WHERE page = 1
 UNION ALL SELECT p.source, p.page, p.tokens, CASE WHEN k.acc + p.tokens > p.budget OR k.n >= 20 THEN k.chunk + 1 ELSE k.chunk END,
 CASE WHEN k.acc + p.tokens > p.budget OR k.n >= 20 THEN p.tokens ELSE k.acc + p.tokens END, CASE WHEN k.acc + p.tokens > p.budget OR k.n >= 20 THEN 1 ELSE k.n + 1 END
 FROM pk k JOIN pk0 p ON p.source = k.source AND p.page = k.page + 1)"""


def _flagged(spark, sf_dir):
    return profile.flagged(tables.profiles(spark, sf_dir))


def _chunks(spark, sf_dir):
    p = _flagged(spark, sf_dir)
    return chunking.greedy_chunks(p.select("source", "page", "tokens", chunking.budget(F.col("is_table_heavy")).alias("budget")))


@query(PF + " SELECT source, page, chars, tokens FROM pf")
def prf01_profile(spark, sf_dir):
    return tables.profiles(spark, sf_dir).select("source", "page", "chars", "tokens")


#: Garbled text doesn't occur in documents: a third of the pages get control and replacement characters by rule.
@query(BP + r""", x AS (SELECT source, page, CASE WHEN doc_id % 3 = 0 THEN repeat(chr(1) || chr(65533), 40) || left(text, 100 + CAST(doc_id AS INTEGER)) ELSE text END AS text FROM bp)
SELECT source, page, """ + _G + " AS garble FROM x")  # fmt: skip
def prf02_garble(spark, sf_dir):
    p = tables.pages(spark, sf_dir)
    bad = F.concat(F.repeat(F.lit("\x01�"), 40), F.substring("text", F.lit(1), 100 + F.col("doc_id").cast("int")))
    t = F.when(F.col("doc_id") % 3 == 0, bad).otherwise(F.col("text"))
    return p.select("source", "page", profile.garble_rate(t).alias("garble"))


@query("""SELECT p_partkey, CAST(85 + 170 * ceil((300 + 10 * p_size) * 100.0 / 72 / 512) * ceil((400 + 12 * p_size) * 100.0 / 72 / 512) AS BIGINT) AS tokens FROM part""")
def prf03_tokens(spark, sf_dir):
    size = F.col("p_size")
    return tables.table(spark, sf_dir, "part").select("p_partkey", profile.vision_tokens((300 + 10 * size).cast("double"), (400 + 12 * size).cast("double")).alias("tokens"))


@query("""SELECT l_orderkey AS page, count(*) AS n_images, round(sum(least(l_quantity, 50) * (1 + l_linenumber)) / 5000.0, 6) AS image_area FROM lineitem GROUP BY l_orderkey""")
def prf04_images(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("page")).agg(F.count("*").alias("n_images"), F.round(F.sum(F.least("l_quantity", F.lit(50.0)) * (1 + F.col("l_linenumber"))) / 5000.0, 6).alias("image_area"))


@query("""SELECT page_id, CAST(len(regexp_extract_all(html, '<(?:ul|table)[ >]')) AS BIGINT) AS n_tables FROM pages""")
def prf05_tables(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").select("page_id", F.regexp_count("html", F.lit("<(?:ul|table)[ >]")).cast("bigint").alias("n_tables"))


@query(FG + " SELECT source, page, garble, is_scanned, is_image_heavy, is_table_heavy FROM fg")
def prf06_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select("source", "page", "garble", "is_scanned", "is_image_heavy", "is_table_heavy")


@query(FG + " SELECT source, page, images, image_area FROM fg WHERE is_image_heavy")
def prf07_image_heavy(spark, sf_dir):
    return _flagged(spark, sf_dir).where("is_image_heavy").select("source", "page", "images", "image_area")


@query(FG + " SELECT source, page, tables FROM fg WHERE is_table_heavy")
def prf08_table_heavy(spark, sf_dir):
    return _flagged(spark, sf_dir).where("is_table_heavy").select("source", "page", "tables")


@query("""WITH s AS (SELECT l_orderkey AS page, CAST(round(l_quantity) AS BIGINT) AS s, count(*) AS n FROM lineitem GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n DESC, s DESC) AS rn FROM s)
SELECT page, max(s) AS max_size, min(s) AS min_size, string_agg(CAST(s AS VARCHAR), ',' ORDER BY s DESC) FILTER (WHERE rn <= 3) AS common FROM t GROUP BY page""")
def prf09_fonts(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "page")
    return profile.fonts(li, "page", "l_quantity")


@query(with_beds("hb") + " SELECT page_id, CAST(1 AS BIGINT) AS level, content AS title, pos FROM hb WHERE block_type = 'heading'")
def prf10_toc(spark, sf_dir):
    b = tables.html_blocks(spark, sf_dir).where("block_type = 'heading'")
    return b.select("page_id", F.lit(1).cast("bigint").alias("level"), F.col("content").alias("title"), "pos")


@query(FG + """ SELECT source, count(*) AS pages, count(*) FILTER (WHERE is_scanned) AS scanned, count(*) FILTER (WHERE is_image_heavy) AS image_heavy, count(*) FILTER (WHERE is_table_heavy) AS table_heavy,
round(sum(chars) / count(*), 6) AS avg_chars, round(sum(tokens) / count(*), 6) AS avg_tokens FROM fg GROUP BY source""")
def prf11_doc(spark, sf_dir):
    return profile.documents(_flagged(spark, sf_dir)).drop("output_chars")


@query(PF + " SELECT source, CAST(sum(chars) * 12 // 10 AS BIGINT) AS output_chars FROM pf GROUP BY source")
def prf12_output_chars(spark, sf_dir):
    return profile.documents(_flagged(spark, sf_dir)).select("source", "output_chars")


@query("""WITH m AS (SELECT l_suppkey AS doc, l_orderkey AS page, max(CAST(round(l_quantity) AS BIGINT)) AS s FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY s DESC, page) AS rn, count(*) OVER (PARTITION BY doc) AS n FROM m),
c AS (SELECT doc, s, count(*) AS c, min(rn) AS f FROM r WHERE rn <= greatest(1, n // 3) GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY c DESC, f) AS k FROM c)
SELECT doc, max(s) AS max_font, string_agg(CAST(s AS VARCHAR), ',' ORDER BY k) FILTER (WHERE k <= 2) AS common FROM k GROUP BY doc""")
def prf13_doc_fonts(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    m = li.groupBy(F.col("l_suppkey").alias("doc"), F.col("l_orderkey").alias("page")).agg(F.max(F.round("l_quantity").cast("bigint")).alias("max_size"))
    return profile.document_fonts(m)


@query(PF + " SELECT source, page, chars < 20 AND images = 0 AND tables = 0 AS is_blank FROM pf")
def prf14_blank(spark, sf_dir):
    p = tables.profiles(spark, sf_dir)
    return p.select("source", "page", profile.expected_blank(p).alias("is_blank"))


@query(FG + " SELECT source, page, chars < 150 OR images > 0 OR garble > 0.05 AS vision FROM fg")
def prf15_route(spark, sf_dir):
    p = _flagged(spark, sf_dir)
    return p.select("source", "page", profile.needs_vision(p).alias("vision"))


@query(FG + """ SELECT source, COALESCE(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (WHERE v), '') AS vision_pages, COALESCE(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (WHERE NOT v), '') AS native_pages
FROM (SELECT *, chars < 150 OR images > 0 OR garble > 0.05 AS v FROM fg) GROUP BY source""")
def prf16_routing(spark, sf_dir):
    return profile.routing(_flagged(spark, sf_dir))


@query(FG + " SELECT source, page, CAST(CASE WHEN is_table_heavy THEN 8000 ELSE 20000 END AS BIGINT) AS budget FROM fg")
def chk01_budget(spark, sf_dir):
    return _flagged(spark, sf_dir).select("source", "page", chunking.budget(F.col("is_table_heavy")).alias("budget"))


@query(CK + " SELECT source, page, tokens, chunk FROM pk")
def chk02_greedy_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query(CK + " SELECT source, chunk, count(*) AS n_pages, min(page) AS page_min, max(page) AS page_max, CAST(sum(tokens) AS BIGINT) AS tokens, printf('%s_chunk%03d', source, chunk) AS chunk_id FROM pk GROUP BY source, chunk")
def chk03_chunk_summary(spark, sf_dir):
    return chunking.chunk_summary(_chunks(spark, sf_dir))


@query(CK + """, s AS (SELECT source, chunk, min(page) AS a, max(page) AS b FROM pk GROUP BY 1, 2)
SELECT source, chunk, lag(b) OVER (PARTITION BY source ORDER BY chunk) AS context_before, lead(a) OVER (PARTITION BY source ORDER BY chunk) AS context_after FROM s""")
def chk04_context(spark, sf_dir):
    return chunking.with_context(_chunks(spark, sf_dir))


@query(BL + " SELECT source, chunk, seq, block_type FROM (SELECT *, dense_rank() OVER (PARTITION BY source, chunk ORDER BY page DESC) AS back FROM bl) WHERE back <= 3")
def ext01_tail(spark, sf_dir):
    return chunking.tail(tables.blocks(spark, sf_dir)).select("source", "chunk", "seq", "block_type")


@query(BL + """, t AS (SELECT source, chunk, count(*) AS n_tail, min(seq) AS first_seq, max(seq) AS last_seq FROM (SELECT *, dense_rank() OVER (PARTITION BY source, chunk ORDER BY page DESC) AS back FROM bl) WHERE back <= 3 GROUP BY 1, 2)
SELECT c.source, c.chunk, COALESCE(t.n_tail, 0) AS n_tail, t.first_seq, t.last_seq FROM (SELECT DISTINCT source, chunk FROM bl) c LEFT JOIN t ON t.source = c.source AND t.chunk = c.chunk - 1""")
def ext02_prev_tail(spark, sf_dir):
    b = tables.blocks(spark, sf_dir)
    t = chunking.tail(b).groupBy("source", (F.col("chunk") + 1).alias("chunk")).agg(F.count("*").alias("n_tail"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    return b.select("source", "chunk").distinct().join(t, ["source", "chunk"], "left").na.fill(0, ["n_tail"])


@query(BL + " SELECT source, seq, CASE WHEN block_type = 'heading' THEN content ELSE left(content, 200) END AS preview FROM (SELECT *, dense_rank() OVER (PARTITION BY source, chunk ORDER BY page DESC) AS back FROM bl) WHERE back <= 3")
def ext03_tail_preview(spark, sf_dir):
    t = chunking.tail(tables.blocks(spark, sf_dir))
    return t.select("source", "seq", F.when(F.col("block_type") == "heading", F.col("content")).otherwise(F.substring("content", 1, 200)).alias("preview"))


#: Pages without a paragraph count as not found.
@query(BL + """, f AS (SELECT source, chunk, count(DISTINCT page) AS n, count(DISTINCT page) FILTER (WHERE block_type = 'paragraph') AS k FROM bl GROUP BY 1, 2)
SELECT source, chunk, n AS n_target, n - k AS n_missing, n > 1 AND 4 * (n - k) >= n AS failed FROM f""")
def ext06_coverage(spark, sf_dir):
    b = tables.blocks(spark, sf_dir)
    x = b.groupBy("source", "chunk").agg(F.countDistinct("page").alias("n"), F.countDistinct(F.when(F.col("block_type") == "paragraph", F.col("page"))).alias("k"))
    return x.select("source", "chunk", F.col("n").alias("n_target"), (F.col("n") - F.col("k")).alias("n_missing"), ((F.col("n") > 1) & (4 * (F.col("n") - F.col("k")) >= F.col("n"))).alias("failed"))


#: events as noisy page numbers: every third has none, every seventh one outside the targets 1 to 20.
_PAGE = "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 99 ELSE 1 + event_id % 20 END"


@query(f"""WITH e AS (SELECT user_id, event_id, {_PAGE} AS p FROM events), c AS (SELECT *, last_value(CASE WHEN p BETWEEN 1 AND 20 THEN p END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS carried FROM e)
SELECT user_id, event_id, CAST(CASE WHEN p BETWEEN 1 AND 20 THEN p WHEN p IS NULL THEN COALESCE(carried, 0) ELSE 0 END AS BIGINT) AS page, p IS NULL AND carried IS NOT NULL AS inferred,
 CASE WHEN p BETWEEN 1 AND 20 OR (p IS NULL AND carried IS NOT NULL) THEN 'located' ELSE 'unlocated' END AS state FROM c""")
def ext07_page_resolve(spark, sf_dir):
    e = tables.table(spark, sf_dir, "events").select("user_id", "event_id", F.expr(_PAGE).alias("p"))
    ok = F.col("p").between(1, 20)
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    x = e.withColumn("carried", F.last(F.when(ok, F.col("p")), ignorenulls=True).over(w))
    inferred = F.col("p").isNull() & F.col("carried").isNotNull()
    page = F.when(ok, F.col("p")).when(F.col("p").isNull(), F.coalesce("carried", F.lit(0))).otherwise(0)
    return x.select("user_id", "event_id", page.cast("bigint").alias("page"), inferred.alias("inferred"), F.when(F.coalesce(ok, F.lit(False)) | inferred, "located").otherwise("unlocated").alias("state"))


@query("SELECT event_id, COALESCE(event_type, 'paragraph') AS block_type, COALESCE(TRY_CAST(value AS DOUBLE), 1.0) AS confidence, event_type IS NULL AS defaulted FROM events")
def ext08_defaults(spark, sf_dir):
    e = tables.table(spark, sf_dir, "events")
    return e.select("event_id", F.coalesce("event_type", F.lit("paragraph")).alias("block_type"), F.coalesce(F.col("value").try_cast("double"), F.lit(1.0)).alias("confidence"), F.col("event_type").isNull().alias("defaulted"))


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 1 AND value IS NOT NULL THEN round(value * 4, 6) END AS box_sum FROM events""")
def ext09_bbox(spark, sf_dir):
    """Boxes of four numbers; rule-made: every fourth has three, and null values spoil a box."""
    e = tables.table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 4 == 1, F.array_repeat(F.col("value").cast("string"), 3)).otherwise(F.array_repeat(F.col("value").cast("string"), 4))
    nums = F.transform(raw, lambda x: x.try_cast("double"))
    box = F.when((F.size(nums) == 4) & ~F.exists(nums, lambda x: x.isNull()), nums)
    return e.select("event_id", F.round(F.aggregate(box, F.lit(0.0), lambda a, x: a + x), 6).alias("box_sum"))


@query(BP + " SELECT source, page, printf('pages/p%04d.png', page) AS image FROM bp")
def ext10_image_path(spark, sf_dir):
    return tables.pages(spark, sf_dir).select("source", "page", F.format_string("pages/p%04d.png", "page").alias("image"))


@query("""WITH a AS (SELECT user_id, event_id, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events)
SELECT user_id, min(k) FILTER (WHERE ok) AS first_success, CAST(sum(CASE WHEN NOT ok AND k <= 4 THEN 2 ** k ELSE 0 END) AS BIGINT) AS waited FROM a GROUP BY user_id""")
def ext11_retries(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    a = tables.table(spark, sf_dir, "events").select("user_id", (F.col("event_type") != "error").alias("ok"), F.row_number().over(w).cast("bigint").alias("k"))
    return a.groupBy("user_id").agg(F.min(F.when(F.col("ok"), F.col("k"))).alias("first_success"), F.sum(F.when(~F.col("ok") & (F.col("k") <= 4), F.pow(F.lit(2), F.col("k"))).otherwise(0)).cast("bigint").alias("waited"))


@query("SELECT event_id, regexp_matches(lower(event_type || props), 'overload|rate|429|too_many') AS limited FROM events")
def ext12_rate_class(spark, sf_dir):
    return tables.table(spark, sf_dir, "events").select("event_id", F.lower(F.concat("event_type", "props")).rlike("overload|rate|429|too_many").alias("limited"))


@query(CA + """, o AS (SELECT run, call, sec, in_tok AS tok, row_number() OVER (PARTITION BY run ORDER BY sec, call) AS k FROM ca),
r AS (SELECT run, call, sec, k, sec AS st, tok AS used, sec AS now FROM o WHERE k = 1
 UNION ALL SELECT run, call, sec, k, CASE WHEN full_ THEN st + 60 ELSE st END, CASE WHEN full_ THEN tok ELSE used + tok END, now + CASE WHEN full_ THEN st + 60 - now ELSE 0 END FROM (
  SELECT *, used > 0 AND used + tok > 8000 AS full_ FROM (SELECT o.run, o.call, o.sec, o.tok, o.k, greatest(r.now, o.sec) AS now, CASE WHEN greatest(r.now, o.sec) - r.st >= 60 THEN greatest(r.now, o.sec) ELSE r.st END AS st,
  CASE WHEN greatest(r.now, o.sec) - r.st >= 60 THEN 0 ELSE r.used END AS used FROM r JOIN o ON o.run = r.run AND o.k = r.k + 1)))
SELECT run, call, now - sec AS wait FROM r""")
def ext13_limiter(spark, sf_dir):
    c = tables.calls(spark, sf_dir).select("run", "call", "sec", F.col("in_tok").alias("tok"))
    return chunking.limited(c, 8000)


@query(BP + """, s AS (SELECT source, CAST(1 AS BIGINT) AS lo, max(page) AS hi FROM bp GROUP BY source),
h AS (SELECT * FROM s UNION ALL SELECT source, CASE WHEN side = 0 THEN lo ELSE lo + (hi - lo + 1) // 2 END, CASE WHEN side = 0 THEN lo + (hi - lo + 1) // 2 - 1 ELSE hi END
 FROM h, (SELECT unnest([0, 1]) AS side) WHERE hi - lo + 1 > 3) SELECT source, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM h WHERE hi - lo + 1 <= 3""")
def ext14_halving(spark, sf_dir):
    r = tables.pages(spark, sf_dir).groupBy("source").agg(F.lit(1).cast("bigint").alias("lo"), F.max("page").alias("hi"))
    return chunking.halved(r)


#: Extraction that lost every page whose doc_id ends in 3.
@query(PF + " SELECT source, page, printf('%s_p%d_b0000', source, page) AS block_id, 'extraction_failure' AS block_type FROM pf WHERE doc_id % 10 = 3")
def ext15_placeholders(spark, sf_dir):
    p = tables.profiles(spark, sf_dir)
    gone = chunking.missing_pages(p, p.where("doc_id % 10 <> 3"))
    return gone.select("source", "page", F.format_string("%s_p%d_b0000", "source", "page").alias("block_id"), F.lit("extraction_failure").alias("block_type"))


@query(PF + " SELECT source, page, chars FROM pf WHERE doc_id % 10 = 3 AND NOT (chars < 20 AND images = 0 AND tables = 0)")
def ext16_missing(spark, sf_dir):
    p = tables.profiles(spark, sf_dir)
    gone = chunking.missing_pages(p, p.where("doc_id % 10 <> 3"))
    return gone.where(~profile.expected_blank(gone)).select("source", "page", "chars")


@query(f"""SELECT user_id, count(*) AS n, printf('%d unlocated', count(*)) AS warning FROM events WHERE {_PAGE} = 99 GROUP BY user_id""")
def ext17_unlocated(spark, sf_dir):
    e = tables.table(spark, sf_dir, "events").where(F.expr(_PAGE) == 99).groupBy("user_id").agg(F.count("*").alias("n"))
    return e.withColumn("warning", F.format_string("%d unlocated", "n"))


@query(BL + " SELECT source, page, ln, row_number() OVER (PARTITION BY source ORDER BY chunk, page, ln) - 1 AS seq FROM bl")
def ext18_sequence(spark, sf_dir):
    w = Window.partitionBy("source").orderBy("chunk", "page", "ln")
    return tables.blocks(spark, sf_dir).select("source", "page", "ln", (F.row_number().over(w) - 1).cast("bigint").alias("seq"))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(len(string_split_regex(text, '\\s+')) AS BIGINT) AS words FROM documents".replace("\\\\", "\\"))
def ext27_probe(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").select("doc_id", F.char_length("text").cast("bigint").alias("chars"), F.size(F.split("text", "\\s+")).cast("bigint").alias("words"))


@query(r"""SELECT doc_id, sum(length(l)) AS chars FROM (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', ''), chr(10))) AS l FROM documents) GROUP BY doc_id""")
def prf17_line_chars(spark, sf_dir):
    x = tables.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(strip(F.col("text")), "\n")).alias("l"))
    return x.groupBy("doc_id").agg(F.sum(F.char_length("l")).alias("chars"))
