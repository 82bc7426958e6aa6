"""Queries over block sequences: reconciliation, headings, Markdown and sections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import ordered_join, ordered_values
from ..operators import reconcile, sections
from ..sources import tables
from ..sources.tables import with_beds
from .registry import query

BL, OT, HB = with_beds("bl"), with_beds("ot"), with_beds("hb")
_RANK = "CASE block_type WHEN 'header' THEN 0 WHEN 'heading' THEN 1 WHEN 'paragraph' THEN 2 WHEN 'footer' THEN 7 ELSE 6 END"
#: Canonical order and adjacent duplicates, behind bl.
SO = BL + f", so AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY page, {_RANK}, seq) - 1 AS ord FROM bl)"
DD = SO + """, dd0 AS (SELECT *, lag(page) OVER w AS pp, lag(block_type) OVER w AS pt, lag(content) OVER w AS pc FROM so WINDOW w AS (PARTITION BY source ORDER BY ord)),
dd AS (SELECT * EXCLUDE (pp, pt, pc) FROM dd0 WHERE NOT (pp IS NOT DISTINCT FROM page AND pt IS NOT DISTINCT FROM block_type AND pc IS NOT DISTINCT FROM content))"""
RP = DD + """, often AS (SELECT source, content FROM dd WHERE block_type IN ('header', 'footer') GROUP BY 1, 2 HAVING count(*) >= 3),
rp AS (SELECT d.*, d.block_type IN ('header', 'footer') AND o.content IS NOT NULL AS is_repeated FROM dd d LEFT JOIN often o USING (source, content))"""
#: Sections, behind rp.
CU = RP + """, cu AS (SELECT *, block_type = 'heading' AND heading_level <= 3 AS opens, greatest(sum(CASE WHEN block_type = 'heading' AND heading_level <= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ord ROWS UNBOUNDED PRECEDING), 1) AS sec FROM rp)"""
SE = CU + """, se0 AS (SELECT source, CAST(sec AS BIGINT) AS sec, arg_min(content, ord) FILTER (WHERE opens) AS t, arg_min(heading_level, ord) FILTER (WHERE opens) AS l, min(ord) AS a, max(ord) AS b, count(*) AS n_blocks,
min(page) AS page_start, max(page) AS page_end, sum(length(content)) AS chars FROM cu GROUP BY 1, 2), se AS (SELECT * EXCLUDE (t, l), COALESCE(t, 'Document') AS title, COALESCE(l, 1) AS level FROM se0),
pa0 AS (SELECT *, max(CASE WHEN level = 1 THEN sec END) OVER u AS s1, max(CASE WHEN level = 2 THEN sec END) OVER u AS s2 FROM se WINDOW u AS (PARTITION BY source ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pa AS (SELECT p.* EXCLUDE (s1, s2), concat_ws(' > ', CASE WHEN p.level > 1 THEN x.title END, CASE WHEN p.level > 2 AND (p.s1 IS NULL OR p.s2 > p.s1) THEN y.title END) AS parent_path
 FROM pa0 p LEFT JOIN se x ON x.source = p.source AND x.sec = p.s1 LEFT JOIN se y ON y.source = p.source AND y.sec = p.s2)"""
_SLUG = "trim(left(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_'), 40), '_')"
NM = SE + f""", nm0 AS (SELECT *, CASE WHEN parent_path <> '' THEN {_SLUG.format("string_split(parent_path, ' > ')[-1]")} || '__' || {_SLUG.format("title")} ELSE {_SLUG.format("title")} END AS stem FROM pa),
nm AS (SELECT * EXCLUDE (stem), printf('%03d', sec) || '_' || left(stem, 113) || '.md' AS filename, CASE WHEN page_start = page_end THEN 'p' || page_start ELSE 'p' || page_start || '–' || page_end END AS pages FROM nm0)"""
_EFF = "min(heading_level - rn) OVER (PARTITION BY source, sec ORDER BY ord ROWS UNBOUNDED PRECEDING) + rn"
MD = CU + f""", hl AS (SELECT source, ord, {_EFF} AS level FROM (SELECT *, row_number() OVER (PARTITION BY source, sec ORDER BY ord) AS rn FROM cu WHERE block_type = 'heading')),
md AS (SELECT c.*, h.level, CASE block_type WHEN 'heading' THEN repeat('#', CAST(h.level AS INTEGER)) || ' ' || content WHEN 'paragraph' THEN content ELSE CASE WHEN NOT is_repeated THEN '*' || content || '*' END END AS md FROM cu c LEFT JOIN hl h USING (source, ord))"""


def _sorted(spark, sf_dir):
    return reconcile.canonical(tables.blocks(spark, sf_dir))


def _seams(spark, sf_dir):
    return reconcile.seams(tables.blocks(spark, sf_dir))


def _cut(spark, sf_dir):
    return sections.cut(_seams(spark, sf_dir))


def _named(spark, sf_dir):
    return sections.named(sections.parents(sections.sections(_cut(spark, sf_dir))))


def _rendered(spark, sf_dir):
    c = _cut(spark, sf_dir)
    h = sections.clamped(c.where("block_type = 'heading'"), ["source", "sec"]).select("source", "ord", F.col("level_out").alias("level"))
    return sections.markdown(c.join(h, ["source", "ord"], "left"))


@query(SO + " SELECT source, ord, page, seq, block_type FROM so")
def rec01_sort(spark, sf_dir):
    return _sorted(spark, sf_dir).select("source", "ord", "page", "seq", "block_type")


@query(DD + " SELECT source, ord, page, block_type, content FROM dd")
def rec02_dedup(spark, sf_dir):
    return reconcile.drop_adjacent_duplicates(_sorted(spark, sf_dir)).select("source", "ord", "page", "block_type", "content")


@query(RP + " SELECT source, ord, is_repeated FROM rp WHERE block_type IN ('header', 'footer')")
def rec03_repeat(spark, sf_dir):
    return _seams(spark, sf_dir).where("block_type in ('header', 'footer')").select("source", "ord", "is_repeated")


@query(RP + " SELECT source, string_agg(DISTINCT content, ' / ' ORDER BY content) AS texts FROM rp WHERE is_repeated GROUP BY source")
def rec04_suppressed(spark, sf_dir):
    return reconcile.suppressed(_seams(spark, sf_dir)).select("source", F.array_join("texts", " / ").alias("texts"))


#: Every block a chunk of its own, so that neighbours qualify.
@query(SO + """ SELECT source, ord, page FROM (SELECT *, lead(content) OVER (PARTITION BY source ORDER BY ord) AS nc FROM so)
WHERE 2.0 * least(length(content), length(nc)) / (length(content) + length(nc)) > 0.9""")  # fmt: skip
def rec05_prefilter(spark, sf_dir):
    return reconcile.similar_candidates(_sorted(spark, sf_dir).withColumn("chunk", F.col("ord"))).select("source", "ord", "page")


@query()
def rec05_similar(spark, sf_dir):
    return reconcile.similar(_sorted(spark, sf_dir).withColumn("chunk", F.col("ord")))


@query(SO + """, x AS (SELECT a.source, a.ord, b.ord AS o FROM so a LEFT JOIN so b ON a.source = b.source AND
((b.ord < a.ord AND b.ord >= a.ord - 5 AND b.page >= a.page - 3) OR (b.ord >= a.ord + 2 AND b.ord < a.ord + 7 AND b.page <= a.page + 3)))
SELECT source, ord, COALESCE(string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) FILTER (WHERE o < ord), '') AS before, COALESCE(string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) FILTER (WHERE o > ord), '') AS after FROM x GROUP BY 1, 2""")
def rec06_context(spark, sf_dir):
    return reconcile.duplicate_context(_sorted(spark, sf_dir))


def _tables(spark, sf_dir):
    """Orders as tables of up to three rows a page; a page that is full is cut off, all but the first go on."""
    x = tables.order_rows(spark, sf_dir)
    t = x.groupBy("doc", "page").agg(ordered_values("ord", "item").alias("rows"), F.count("*").alias("n_rows"), F.min_by("flag", "ord").alias("header"))
    return t.withColumn("is_truncated", F.col("n_rows") == 3).withColumn("is_continuation", F.col("page") > 1)


TB = OT + ", tb AS (SELECT doc, page, list(item ORDER BY ord) AS rows, count(*) AS n_rows, arg_min(flag, ord) AS header, count(*) = 3 AS is_truncated, page > 1 AS is_continuation FROM ot GROUP BY 1, 2)"


@query(OT + " SELECT doc, count(*) AS n_rows, CAST(arg_min(item, ord) AS VARCHAR) AS first_cell FROM ot GROUP BY doc")
def rec07_table_rows(spark, sf_dir):
    """Cells written as a Python list literal, parsed back."""
    t = tables.order_rows(spark, sf_dir).withColumn("cell", F.concat(F.lit("['"), F.col("item").cast("string"), F.lit("', '"), F.col("flag"), F.lit("']")))
    raw = t.groupBy("doc").agg(ordered_join("ord", "cell", ", ").alias("r")).select("doc", F.concat(F.lit("["), "r", F.lit("]")).alias("raw"))
    return raw.select("doc", F.from_json("raw", "array<array<string>>").alias("rows")).select("doc", F.size("rows").cast("bigint").alias("n_rows"), F.col("rows")[0][0].alias("first_cell"))


@query(TB + """, l AS (SELECT *, COALESCE(lag(is_truncated) OVER (PARTITION BY doc ORDER BY page) AND is_continuation, false) AS link FROM tb),
i AS (SELECT *, sum(CASE WHEN link THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY page) AS island FROM l), k AS (SELECT *, (row_number() OVER (PARTITION BY doc, island ORDER BY page) - 1) // 2 AS grp FROM i),
d AS (SELECT *, COALESCE(lag(rows[-1]) OVER (PARTITION BY doc, island, grp ORDER BY page) = rows[1], false) AS cut FROM k)
SELECT doc, min(page) AS page, count(*) AS n_tables, arg_max(is_truncated, page) AS is_truncated, string_agg(array_to_string(CASE WHEN cut THEN rows[2:] ELSE rows END, ','), ',' ORDER BY page) FILTER (WHERE NOT (cut AND len(rows) = 1)) AS rows FROM d GROUP BY doc, island, grp""")
def rec08_pair_merge(spark, sf_dir):
    m = reconcile.pair_merged(_tables(spark, sf_dir))
    return m.withColumn("rows", F.array_join(F.col("rows").cast("array<string>"), ","))


@query(TB + """, l AS (SELECT *, COALESCE(lag(header) OVER (PARTITION BY doc ORDER BY page) = header, false) AS link FROM tb), i AS (SELECT *, sum(CASE WHEN link THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY page) AS island FROM l)
SELECT doc, min(page) AS page, max(page) AS page_end, count(*) AS n_tables, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) > 1 AS merged_cross_page FROM i GROUP BY doc, island""")
def rec09_header_merge(spark, sf_dir):
    return reconcile.header_chains(_tables(spark, sf_dir))


@query(HB + r""", li AS (SELECT page_id, pos AS ord, NOT regexp_matches(content, '[.!?]$') AS is_truncated, regexp_matches(content, '^\p{Ll}') AS is_continuation, length(content) % 2 AS indent FROM hb WHERE block_type = 'list_item')
SELECT page_id, ord, CASE WHEN lag(is_truncated) OVER w AND is_continuation AND lag(indent) OVER w IS NOT DISTINCT FROM indent THEN lag(ord) OVER w END AS continued_from FROM li WINDOW w AS (PARTITION BY page_id ORDER BY ord)""")
def rec10_list_link(spark, sf_dir):
    h = tables.html_blocks(spark, sf_dir).where("block_type = 'list_item'")
    c = F.col("content")
    x = h.select("page_id", F.col("pos").alias("ord"), (~c.rlike("[.!?]$")).alias("is_truncated"), c.rlike("^\\p{Ll}").alias("is_continuation"), (F.char_length(c) % 2).alias("indent"))
    return reconcile.list_links(x, "page_id").select("page_id", "ord", "continued_from")


@query(SO + """ SELECT source, ord, new_chunk FROM (SELECT source, ord, chunk, CASE WHEN block_type = 'heading' AND lead(chunk) OVER w <> chunk AND lead(block_type) OVER w = 'paragraph' AND NOT lead(is_continuation) OVER w THEN lead(chunk) OVER w ELSE chunk END AS new_chunk
FROM (SELECT * REPLACE (CAST(ord // 7 AS BIGINT) AS chunk) FROM so) WINDOW w AS (PARTITION BY source ORDER BY ord)) WHERE new_chunk <> chunk""")
def rec11_orphan(spark, sf_dir):
    """Chunks of seven blocks, so that headings end some of them."""
    s = _sorted(spark, sf_dir).withColumn("chunk", F.expr("ord div 7").cast("bigint"))
    return reconcile.orphaned_headings(s).where("new_chunk <> chunk").select("source", "ord", "new_chunk")


#: Footers by rule: pages (every ninth is lost) print page + 3, from page 20 on page + 5.
_FOOT = "SELECT source, page, CAST(page + CASE WHEN page >= 20 THEN 5 ELSE 3 END AS BIGINT) AS num FROM {0} WHERE page % 9 <> 4"


def _footers(spark, sf_dir):
    p = tables.pages(spark, sf_dir).where("page % 9 <> 4")
    return p.select("source", "page", (F.col("page") + F.when(F.col("page") >= 20, 5).otherwise(3)).cast("bigint").alias("num"))


FT = with_beds("bp") + ", ft AS (" + _FOOT.format("bp") + ")"


@query(FT + """, g AS (SELECT source, num, min(page) AS f, max(page) AS l FROM ft GROUP BY 1, 2), n AS (SELECT *, lead(num) OVER w AS nn, lead(f) OVER w AS nf FROM g WINDOW w AS (PARTITION BY source ORDER BY num))
SELECT source, num AS after, nn AS before, nn - num - 1 AS n_missing, CASE WHEN nf - l - 1 = 0 THEN 'document_numbering_skip' ELSE 'extraction_gap' END AS kind FROM n WHERE nn - num > 1""")
def rec12_audit(spark, sf_dir):
    return reconcile.numbering_gaps(_footers(spark, sf_dir))


OFFSET = FT + """, ofc AS (SELECT source, page - num AS o, count(*) AS n, min(page) AS f FROM ft GROUP BY 1, 2), ofs AS (SELECT source, o FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f, o) AS k FROM ofc) WHERE k = 1)"""


@query(OFFSET + """, s AS (SELECT source, min(page) AS a, max(page) AS b FROM ft GROUP BY 1), e AS (SELECT source, unnest(generate_series(a, b)) AS page FROM s)
SELECT e.source, e.page, e.page - o AS inferred FROM e JOIN ofs USING (source) WHERE NOT EXISTS (SELECT 1 FROM ft WHERE ft.source = e.source AND ft.page = e.page) AND e.page - o > 0""")
def rec13_absent(spark, sf_dir):
    f = _footers(spark, sf_dir)
    return reconcile.absent_pages(f, f)


#: A supplier's rows as one table on page 1 before 1 + l_suppkey % 9 hollow pages.
@query("""WITH t AS (SELECT l_suppkey AS doc, count(*) % 150 + 1 AS n_rows, l_suppkey % 9 + 2 AS parts FROM lineitem GROUP BY l_suppkey), p AS (SELECT *, unnest(generate_series(0, parts - 1)) AS part FROM t WHERE n_rows BETWEEN 3 * parts AND 40 * parts)
SELECT CAST(doc AS BIGINT) AS doc, CAST(1 AS BIGINT) AS page, CAST(1 + part AS BIGINT) AS to_page, CAST(part AS BIGINT) AS part, CAST(parts AS BIGINT) AS parts, CAST(n_rows // parts + CASE WHEN part < n_rows % parts THEN 1 ELSE 0 END AS BIGINT) AS n, part = 0 AS has_header FROM p""")
def rec14_split(spark, sf_dir):
    t = tables.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("bigint").alias("doc")).agg((F.count("*") % 150 + 1).alias("n_rows"))
    hollow = t.select("doc", F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("doc") % 9 + 2)).alias("page"))
    return reconcile.split_over_hollow(t.withColumn("page", F.lit(1).cast("bigint")), hollow)


@query(OFFSET + " SELECT b.source, b.page, b.page - o AS inferred, 0.7 AS confidence FROM bp b JOIN ofs USING (source) WHERE NOT EXISTS (SELECT 1 FROM ft WHERE ft.source = b.source AND ft.page = b.page) AND b.page - o > 0".replace("0.7", "CAST(0.7 AS DOUBLE)"))
def rec15_footer(spark, sf_dir):
    f = _footers(spark, sf_dir)
    lacking = tables.pages(spark, sf_dir).select("source", "page").join(f, ["source", "page"], "left_anti")
    x = lacking.join(reconcile.dominant_offset(f), "source").withColumn("inferred", F.col("page") - F.col("offset")).where("inferred > 0")
    return x.select("source", "page", "inferred", F.lit(0.7).alias("confidence"))


@query(SO + """ SELECT source, ord, next_ord, next_chunk FROM (SELECT source, ord, chunk, is_truncated, lead(ord) OVER w AS next_ord, lead(chunk) OVER w AS next_chunk, lead(is_continuation) OVER w AS nc FROM so WINDOW w AS (PARTITION BY source ORDER BY ord))
WHERE chunk <> next_chunk AND (is_truncated OR nc)""")
def rec16_risk(spark, sf_dir):
    return reconcile.risks(_sorted(spark, sf_dir)).select("source", "ord", "next_ord", "next_chunk")


@query(SO + """, n AS (SELECT *, row_number() OVER (PARTITION BY source, chunk ORDER BY ord) AS up, row_number() OVER (PARTITION BY source, chunk ORDER BY ord DESC) AS down FROM so)
SELECT source, chunk, string_agg(left(content, 80), ' | ' ORDER BY ord) FILTER (WHERE up <= 3) AS head, string_agg(left(content, 80), ' | ' ORDER BY ord) FILTER (WHERE down <= 3) AS tail FROM n GROUP BY 1, 2""")
def rec17_sides(spark, sf_dir):
    return reconcile.sides(_sorted(spark, sf_dir))


@query(RP + """, mv AS (SELECT *, CASE WHEN block_type = 'heading' AND lead(chunk) OVER w <> chunk AND lead(block_type) OVER w = 'paragraph' AND NOT lead(is_continuation) OVER w THEN lead(chunk) OVER w ELSE chunk END AS nc
FROM rp WINDOW w AS (PARTITION BY source ORDER BY ord))
SELECT source, ord, block_type, nc AS chunk, is_repeated, CAST(NULL AS BIGINT) AS continued_from, coalesce(lead(nc) OVER v <> nc AND (is_truncated OR lead(is_continuation) OVER v), false) AS risk FROM mv WINDOW v AS (PARTITION BY source ORDER BY ord)""")
def rec18_full(spark, sf_dir):
    """The whole composition; this bed has no list items, so none is continued (tests have them)."""
    return reconcile.full(tables.blocks(spark, sf_dir)).select("source", "ord", "block_type", "chunk", "is_repeated", "continued_from", "risk")


@query(SO + """, n AS (SELECT source, ord, chunk, is_truncated, content, lead(chunk) OVER w AS nc, lead(is_continuation) OVER w AS nx FROM so WINDOW w AS (PARTITION BY source ORDER BY ord)),
r AS (SELECT source, ord, length(content) % 4 AS k FROM n WHERE chunk <> nc AND (is_truncated OR nx))
SELECT source, ord, CASE k WHEN 0 THEN 'merge_table' WHEN 1 THEN 'continue_section' WHEN 2 THEN 'independent' END AS decision, k < 3 AS resolved, CASE WHEN k < 2 THEN 'llm_decision' ELSE 'unresolved' END AS resolution FROM r""")
def rec17_decisions(spark, sf_dir):
    """Answers of four kinds, made from the length of the content before the seam: JSON, a sentence, neither, none."""
    b = _sorted(spark, sf_dir)
    k = F.char_length("content") % 4
    said = F.when(k == 0, '{"decision": "merge_table", "why": "independent"}').when(k == 1, "I would Continue_Section here").when(k == 2, "cannot say")
    answers = b.select("source", "ord", said.alias("answer")).where("answer is not null")
    return reconcile.arbitrated(reconcile.risks(b), answers).select("source", "ord", "decision", "resolved", "resolution")


@query(RP + " SELECT source, ord, block_type, is_repeated, length(content) AS n FROM rp")
def rec19_seams(spark, sf_dir):
    return _seams(spark, sf_dir).select("source", "ord", "block_type", "is_repeated", F.char_length("content").cast("bigint").alias("n"))


@query(BL + " SELECT source, chunk, seq, CASE WHEN chunk = 1 THEN reverse(content) ELSE content END AS content FROM bl")
def rec20_splice(spark, sf_dir):
    b = tables.blocks(spark, sf_dir).select("source", "chunk", "seq", "content")
    return reconcile.spliced(b, b.where("chunk = 1").withColumn("content", F.reverse("content")))


_NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}), '\.{{2,}}\s*[0-9]+\s*$', ''), '\s+[0-9]+\s*$', ''), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'), ' ')"


@query(BL + ", h AS (SELECT source, seq, content || CASE seq % 3 WHEN 0 THEN ' ..... 12' WHEN 1 THEN '  7 ' ELSE ' (x)' END AS t FROM bl WHERE block_type = 'heading') SELECT source, seq, " + _NORM.format("t") + " AS title FROM h")
def hdg01_norm(spark, sf_dir):
    h = tables.blocks(spark, sf_dir).where("block_type = 'heading'")
    t = F.concat("content", F.when(F.col("seq") % 3 == 0, " ..... 12").when(F.col("seq") % 3 == 1, "  7 ").otherwise(" (x)"))
    return h.select("source", "seq", sections.normal_title(t).alias("title"))


@query(BL + f""", h AS (SELECT source, seq, content, heading_level AS level FROM bl WHERE block_type = 'heading'), t AS (SELECT {_NORM.format("content")} AS t, max(level + 1) AS toc_level FROM h WHERE seq % 2 = 0 GROUP BY 1)
SELECT source, seq, level, COALESCE(toc_level, level) AS level_out FROM h LEFT JOIN t ON t.t = {_NORM.format("h.content")}""")
def hdg02_toc(spark, sf_dir):
    h = tables.blocks(spark, sf_dir).where("block_type = 'heading'").select("source", "seq", "content", F.col("heading_level").alias("level"))
    toc = h.where("seq % 2 = 0").select(F.col("content").alias("title"), (F.col("level") + 1).alias("level"))
    return sections.toc_levels(h, toc).drop("content")


@query(BL + """, h AS (SELECT source, seq, CASE WHEN COALESCE(heading_level, 0) = 0 THEN 2 ELSE heading_level END AS l FROM bl WHERE block_type = 'heading' AND heading_level <> 2), r AS (SELECT *, dense_rank() OVER (PARTITION BY source ORDER BY l) AS r FROM h)
SELECT source, seq, CASE WHEN max(r) OVER (PARTITION BY source) > 1 THEN r ELSE l END AS level_out FROM r""")
def hdg03_compact(spark, sf_dir):
    h = tables.blocks(spark, sf_dir).where("block_type = 'heading' and heading_level <> 2")
    return sections.compact_levels(h).select("source", "seq", "level_out")


@query(SO + """ SELECT source, ord, heading_level AS level_in, min(heading_level - rn) OVER (PARTITION BY source ORDER BY ord ROWS UNBOUNDED PRECEDING) + rn AS level_out FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ord) AS rn FROM so WHERE block_type = 'heading')""")
def rnd01_clamp(spark, sf_dir):
    h = _sorted(spark, sf_dir).where("block_type = 'heading'")
    return sections.clamped(h, ["source"]).select("source", "ord", F.col("heading_level").alias("level_in"), "level_out")


@query(MD + " SELECT source, ord, md FROM md")
def rnd02_markdown(spark, sf_dir):
    return _rendered(spark, sf_dir).select("source", "ord", "md")


@query(BL + """ SELECT source, seq, CASE (page + ln) % 5 WHEN 0 THEN '| len | ln |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || length(content) || ' | ' || CASE WHEN page % 2 = 0 THEN CAST(ln AS VARCHAR) ELSE 'None' END || ' |'
WHEN 1 THEN repeat('  ', ln % 3) || '- ' || content WHEN 2 THEN '```' || chr(10) || content || chr(10) || '```' WHEN 3 THEN '> **[Figure]** ' || content ELSE content END AS md FROM bl""")
def rnd02_kinds(spark, sf_dir):
    """Tables (JSON rows on even pages, literals with None on odd ones), indented list items, code and figures in place of the bed's blocks."""
    k = (F.col("page") + F.col("ln")) % 5
    n = F.char_length("content").cast("string")
    even = F.concat(F.lit('[["len", "ln"], ["'), n, F.lit('", '), F.col("ln").cast("string"), F.lit("]]"))
    table = F.when(F.col("page") % 2 == 0, even).otherwise(F.concat(F.lit("[['len', 'ln'], ['"), n, F.lit("', None]]")))
    kind = F.when(k == 0, "table").when(k == 1, "list_item").when(k == 2, "code").when(k == 3, "figure").otherwise("paragraph")
    x = tables.blocks(spark, sf_dir).withColumn("content", F.when(k == 0, table).otherwise(F.col("content"))).withColumn("block_type", kind)
    x = x.withColumn("indent", F.col("ln") % 3).withColumn("level", F.lit(1)).withColumn("is_repeated", F.lit(False))
    return sections.markdown(x).select("source", "seq", "md")


@query("SELECT CAST(o_orderkey AS BIGINT) AS sec, printf('%03d', o_orderkey) || '_t.md' AS filename FROM orders")
def sec04_many(spark, sf_dir):
    """File names of sections far beyond 999: orders as sections."""
    s = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("sec"), F.lit("T").alias("title"), F.lit("").alias("parent_path"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"))
    return sections.named(s).select("sec", "filename")


@query(RP + " SELECT source, ord, COALESCE(lag(page) OVER (PARTITION BY source ORDER BY ord) <> page, false) AS breaks FROM rp")
def rnd03_breaks(spark, sf_dir):
    return sections.page_breaks(_seams(spark, sf_dir)).select("source", "ord", "breaks")


DOC = MD + """, pb AS (SELECT *, COALESCE(lag(page) OVER (PARTITION BY source ORDER BY ord) <> page, false) AS breaks FROM md), pc AS (SELECT source, ord, concat_ws(chr(10) || chr(10), CASE WHEN breaks THEN '---' END, md) AS piece FROM pb)"""


@query(DOC + " SELECT source, string_agg(piece, chr(10) || chr(10) ORDER BY ord) AS md FROM pc WHERE piece <> '' GROUP BY source")
def rnd04_doc(spark, sf_dir):
    return sections.document_text(sections.page_breaks(_rendered(spark, sf_dir)))


GF = OT + """, gf AS (SELECT doc, '| item | qty | flag |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || item || ' | ' || qty || ' | ' || flag || ' |', chr(10) ORDER BY ord) AS md FROM ot GROUP BY doc)"""


def _gfm(spark, sf_dir):
    x = tables.order_rows(spark, sf_dir).withColumn("cells", F.array(F.col("item").cast("string"), F.col("qty").cast("string"), F.col("flag")))
    t = x.groupBy("doc").agg(ordered_values("ord", "cells").alias("rows"))
    return t.select("doc", sections.gfm(F.concat(F.array(F.array(F.lit("item"), F.lit("qty"), F.lit("flag"))), "rows")).alias("md"))


@query(GF + " SELECT doc, md FROM gf")
def rnd05_gfm(spark, sf_dir):
    return _gfm(spark, sf_dir)


@query(GF + " SELECT doc, true AS valid FROM gf")
def rnd06_valid(spark, sf_dir):
    return _gfm(spark, sf_dir).select("doc", sections.valid_gfm(F.col("md")).alias("valid"))


@query(CU + " SELECT source, ord, CAST(sec AS BIGINT) AS sec, opens FROM cu")
def sec01_cut(spark, sf_dir):
    return _cut(spark, sf_dir).select("source", "ord", "sec", "opens")


#: Pages as documents: most have no section heading.
@query(BL + " SELECT source, page, count(*) FILTER (WHERE block_type = 'heading' AND heading_level <= 3) = 0 AS single, CASE WHEN count(*) FILTER (WHERE block_type = 'heading' AND heading_level <= 3) = 0 THEN '001_document.md' END AS filename FROM bl GROUP BY 1, 2")
def sec02_fallback(spark, sf_dir):
    n = F.count_if((F.col("block_type") == "heading") & (F.col("heading_level") <= 3))
    x = tables.blocks(spark, sf_dir).groupBy("source", "page").agg(n.alias("n"))
    return x.select("source", "page", (F.col("n") == 0).alias("single"), F.when(F.col("n") == 0, "001_document.md").alias("filename"))


@query(SE + " SELECT source, sec, title, level, parent_path FROM pa")
def sec03_parent(spark, sf_dir):
    return _named(spark, sf_dir).select("source", "sec", "title", "level", "parent_path")


@query(NM + " SELECT source, sec, filename FROM nm")
def sec04_filename(spark, sf_dir):
    return _named(spark, sf_dir).select("source", "sec", "filename")


@query(NM + " SELECT source, sec, page_start, page_end, pages FROM nm")
def sec05_range(spark, sf_dir):
    return _named(spark, sf_dir).select("source", "sec", "page_start", "page_end", "pages")


@query(SE + """, x AS (SELECT s.source, s.sec, s.a, b.ord FROM se s JOIN cu b ON b.source = s.source AND ((b.ord < s.a AND b.page >= s.page_start - 3) OR (b.ord > s.b AND b.page <= s.page_end + 3)))
SELECT s.source, s.sec, COALESCE(string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) FILTER (WHERE ord < s.a), '') AS before, COALESCE(string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) FILTER (WHERE ord > s.a), '') AS after FROM se s LEFT JOIN x USING (source, sec) GROUP BY 1, 2""")
def sec06_context(spark, sf_dir):
    c = _cut(spark, sf_dir)
    return sections.context_ids(sections.sections(c), c)


@query(NM + """ SELECT source, sec, '---' || chr(10) || 'title: ' || CASE WHEN regexp_matches(title, '[:#"'']') THEN '"' || title || '"' ELSE title END || chr(10) || 'heading_level: ' || level || chr(10) || 'pages: ' || pages || chr(10)
|| CASE WHEN parent_path <> '' THEN 'parent_path: ' || CASE WHEN regexp_matches(parent_path, '[:#"'']') THEN '"' || parent_path || '"' ELSE parent_path END || chr(10) ELSE '' END || '---' || chr(10) AS yaml FROM nm""")
def sec07_yaml(spark, sf_dir):
    n = _named(spark, sf_dir)
    return n.select("source", "sec", sections.front_matter(n).alias("yaml"))


@query(MD + " SELECT source, CAST(sec AS BIGINT) AS sec, string_agg(md, chr(10) || chr(10) ORDER BY ord) AS body FROM md WHERE md IS NOT NULL GROUP BY 1, 2")
def sec08_body(spark, sf_dir):
    return sections.bodies(_rendered(spark, sf_dir)).select("source", "sec", "body")


@query(MD + " SELECT source, CAST(sec AS BIGINT) AS sec, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS block_ids FROM md WHERE md IS NOT NULL GROUP BY 1, 2")
def sec09_ids(spark, sf_dir):
    return sections.bodies(_rendered(spark, sf_dir)).select("source", "sec", "block_ids")


@query(r"""WITH x AS (SELECT DISTINCT source, source || '_50page-report_of' || source || '.a.b' AS stem FROM documents) SELECT source, array_to_string(list_transform(regexp_extract_all(regexp_replace(stem, '[_-]', ' ', 'g'), '\p{L}+|[^\p{L}]+'), lambda r: upper(r[1]) || lower(r[2:])), '') AS title FROM x""")
def sec10_title(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents").select("source").distinct()
    return d.select("source", sections.title_case(F.concat("source", F.lit("_50page-report_of"), "source", F.lit(".a.b"))).alias("title"))


@query(DOC + " SELECT source, '# ' || source || chr(10) || chr(10) || string_agg(piece, chr(10) || chr(10) ORDER BY ord) AS md FROM pc WHERE piece <> '' GROUP BY source")
def sec11_whole(spark, sf_dir):
    d = sections.document_text(sections.page_breaks(_rendered(spark, sf_dir)))
    return d.select("source", F.concat(F.lit("# "), "source", F.lit("\n\n"), "md").alias("md"))


@query(NM + """, h AS (SELECT source, count(*) AS n_headings, max(heading_level) AS max_heading_level FROM rp WHERE block_type = 'heading' GROUP BY 1)
SELECT n.source, count(*) AS n_sections, max(n.page_end) AS total_pages, CAST(sum(n.n_blocks) AS BIGINT) AS n_blocks, min(h.max_heading_level) AS max_heading_level FROM nm n JOIN h USING (source) GROUP BY 1""")
def snk01_manifest(spark, sf_dir):
    h = _seams(spark, sf_dir).where("block_type = 'heading'").groupBy("source").agg(F.max("heading_level").alias("max_heading_level"))
    m = _named(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_sections"), F.max("page_end").alias("total_pages"), F.sum("n_blocks").alias("n_blocks"))
    return m.join(h, "source")


@query(NM + " SELECT source, string_agg(repeat('  ', CAST(level - 1 AS INTEGER)) || '- [' || title || '](' || filename || ') ' || pages, chr(10) ORDER BY sec) AS index_md FROM nm GROUP BY source")
def snk02_index(spark, sf_dir):
    n = _named(spark, sf_dir)
    line = F.concat(F.repeat(F.lit("  "), (F.col("level") - 1).cast("int")), F.lit("- ["), "title", F.lit("]("), "filename", F.lit(") "), "pages")
    return n.withColumn("line", line).groupBy("source").agg(ordered_join("sec", "line", "\n").alias("index_md"))


@query("""WITH r AS (SELECT p_brand, p_name, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
SELECT p_brand, '| name | size |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || replace(p_name, '|', '\\|') || ' | ' || p_size || ' |', chr(10) ORDER BY k) FILTER (WHERE k <= 30) || CASE WHEN max(n) > 30 THEN chr(10) || '(' || (max(n) - 30) || ' more rows)' ELSE '' END AS report FROM r GROUP BY p_brand""".replace("\\\\|", "\\|"))
def snk07_report(spark, sf_dir):
    w = Window.partitionBy("p_brand")
    r = tables.table(spark, sf_dir, "part").withColumn("k", F.row_number().over(w.orderBy("p_partkey"))).withColumn("n", F.count("*").over(w))
    line = F.concat(F.lit("| "), F.replace("p_name", F.lit("|"), F.lit("\\|")), F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |"))
    x = r.where("k <= 30").withColumn("line", line).groupBy("p_brand").agg(ordered_join("k", "line", "\n").alias("rows"), F.max("n").alias("n"))
    more = F.when(F.col("n") > 30, F.concat(F.lit("\n("), (F.col("n") - 30).cast("string"), F.lit(" more rows)"))).otherwise("")
    return x.select("p_brand", F.concat(F.lit("| name | size |\n| --- | --- |\n"), "rows", more).alias("report"))
