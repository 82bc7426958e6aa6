"""Queries over sections: retrieval, costs, comparison and data quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import ordered_join, ratio
from ..operators import costs, retrieval, sections
from ..sources import tables
from ..sources.tables import with_beds
from .reconciling import CU, DD, MD, NM, RP, _cut, _named, _rendered, _seams
from .registry import query

CA, BL, BP = with_beds("ca"), with_beds("bl"), with_beds("bp")
TERMS = ["the", "and", "schen"]


@query(NM + " SELECT source, sec, level, title, pages FROM nm")
def qry01_toc(spark, sf_dir):
    return _named(spark, sf_dir).select("source", "sec", "level", "title", "pages")


@query(NM + " SELECT source, sec, filename FROM nm WHERE contains(lower(filename), 'er')")
def qry02_section(spark, sf_dir):
    return _named(spark, sf_dir).where(F.contains(F.lower("filename"), F.lit("er"))).select("source", "sec", "filename")


@query(CU + """ SELECT source, CAST(sec AS BIGINT) AS sec, rn, left(trim(content, ' '), 100) AS line FROM (SELECT *, row_number() OVER (PARTITION BY source, sec ORDER BY ord) AS rn FROM cu WHERE contains(lower(content), 'the')) WHERE rn <= 5""")
def qry03_search(spark, sf_dir):
    return retrieval.search(_cut(spark, sf_dir), "the")


_SC = "max(CASE WHEN contains(lower(content), '{0}') THEN CASE WHEN block_type = 'heading' THEN 2 ELSE 1 END ELSE 0 END)"
SC = CU + ", sc AS (SELECT source, CAST(sec AS BIGINT) AS sec, CAST(least(2 * (" + " + ".join(_SC.format(t) for t in TERMS) + "), 10) AS BIGINT) AS score FROM cu GROUP BY 1, 2), rk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, sec) AS rank FROM sc) WHERE rank <= 3 AND score >= 5)"


@query(SC + " SELECT source, sec, score, rank FROM rk")
def qry04_rank(spark, sf_dir):
    return retrieval.ranked(retrieval.lexical_scores(_cut(spark, sf_dir), TERMS))


@query("""SELECT doc_id, CAST(doc_id % 3 AS BIGINT) AS n, CASE WHEN doc_id % 3 > 0 THEN '001_a' || doc_id || '.md' END AS first_file FROM documents""")
def qry04_parse(spark, sf_dir):
    """Scores read from an answer's text."""
    one = F.concat(F.lit("1. 001_a"), F.col("doc_id").cast("string"), F.lit(".md (7/10) fits\n"))
    d = tables.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Ranking:\n"), F.repeat(one, (F.col("doc_id") % 3).cast("int"))).alias("answer"))
    x = d.withColumn("p", retrieval.parsed_answer(F.col("answer")))
    return x.select("doc_id", F.size("p").cast("bigint").alias("n"), F.get("p", F.lit(0))["filename"].alias("first_file"))


@query(NM + """, w AS (SELECT DISTINCT filename FROM nm WHERE sec % 7 = 0 UNION SELECT '999_' || source || '.md' FROM nm) SELECT filename, filename IN (SELECT filename FROM nm) AS found FROM w""")
def qry05_load(spark, sf_dir):
    n = _named(spark, sf_dir)
    wanted = n.where("sec % 7 = 0").select("filename").union(n.select(F.concat(F.lit("999_"), "source", F.lit(".md")))).distinct()
    return retrieval.loaded(wanted, n)


_FUZZY = ["er", "the_document_about_on", "zzz"]


@query(NM + """, w AS (SELECT * FROM (VALUES ('er'), ('the_document_about_on'), ('zzz')) AS w(wanted)) SELECT source, sec, wanted FROM nm JOIN w ON contains(regexp_replace(lower(filename), '\\.md$', ''), wanted) OR contains(wanted, regexp_replace(lower(filename), '\\.md$', ''))""".replace("\\\\", "\\"))
def qry06_fuzzy(spark, sf_dir):
    w = spark.createDataFrame([(x,) for x in _FUZZY], "wanted string")
    return retrieval.fuzzy(w, _named(spark, sf_dir)).select("source", "sec", "wanted")


@query(BL + " SELECT source, page, ln, content FROM bl WHERE contains(lower(content), 'the') OR contains(lower(content), 'schen') OR contains(lower(content), 'queda') ORDER BY source, page, ln LIMIT 100")
def qry07_grep(spark, sf_dir):
    """The first 100 lines with any of a question's first three words: a report with a limit by its nature."""
    return retrieval.grep_words(tables.blocks(spark, sf_dir), "the schen queda and more")


@query(MD + """, bo AS (SELECT source, CAST(sec AS BIGINT) AS sec, string_agg(md, chr(10) || chr(10) ORDER BY ord) AS body FROM md WHERE md IS NOT NULL GROUP BY 1, 2),
sc AS (SELECT source, CAST(sec AS BIGINT) AS sec, CAST(least(2 * (""" + " + ".join(_SC.format(t) for t in TERMS) + """), 10) AS BIGINT) AS score FROM cu GROUP BY 1, 2), rk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, sec) AS rank FROM sc) WHERE rank <= 3 AND score >= 5)
SELECT source, string_agg('[' || sec || ']' || chr(10) || body, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context FROM rk JOIN bo USING (source, sec) GROUP BY source""")
def qry08_context(spark, sf_dir):
    top = retrieval.ranked(retrieval.lexical_scores(_cut(spark, sf_dir), TERMS))
    b = sections.bodies(_rendered(spark, sf_dir))
    x = top.join(b, ["source", "sec"]).withColumn("filename", F.col("sec").cast("string"))
    return retrieval.assembled(x)


@query()
def qry09_answer(spark, sf_dir):
    """Extractive answers: the best lines of the ranked sections with their citation."""
    c = _cut(spark, sf_dir)
    top = retrieval.ranked(retrieval.lexical_scores(c, TERMS))
    hit = retrieval.search(c, TERMS[0], most=2).join(top, ["source", "sec"])
    return hit.select("source", "rank", "rn", F.concat("line", F.lit(" ["), F.col("sec").cast("string"), F.lit("]")).alias("line"))


@query(RP + " SELECT source, ord, block_type, left(content, 200) AS preview FROM rp WHERE page = 3")
def qry10_page(spark, sf_dir):
    return _seams(spark, sf_dir).where("page = 3").select("source", "ord", "block_type", F.substring("content", 1, 200).alias("preview"))


@query(NM + " SELECT source, count(*) AS n_sections, round(sum(strlen(filename) + strlen(title)) / 1024.0, 6) AS index_kb FROM nm GROUP BY source")
def qry11_list(spark, sf_dir):
    n = _named(spark, sf_dir)
    return n.groupBy("source").agg(F.count("*").alias("n_sections"), F.round(F.sum(F.octet_length("filename") + F.octet_length("title")) / 1024.0, 6).alias("index_kb"))


@query(NM + " SELECT source, true AS has_sections, true AS has_blocks FROM nm GROUP BY source")
def qry12_bundle(spark, sf_dir):
    """Documents whose parts are all there."""
    n, b = _named(spark, sf_dir).select("source").distinct(), tables.blocks(spark, sf_dir).select("source").distinct()
    d = tables.pages(spark, sf_dir).select("source").distinct()
    return d.join(n.withColumn("s", F.lit(True)), "source", "left").join(b.withColumn("b", F.lit(True)), "source", "left").select("source", F.coalesce("s", F.lit(False)).alias("has_sections"), F.coalesce("b", F.lit(False)).alias("has_blocks"))


#: Models by method.
_MODEL = "CASE method WHEN 'view' THEN 'some-sonnet' WHEN 'click' THEN 'big-OPUS' WHEN 'purchase' THEN 'haiku-sonnet' ELSE 'other' END"
_PRICE = "CASE WHEN contains(lower(model), 'sonnet') THEN {0} WHEN contains(lower(model), 'opus') THEN {1} WHEN contains(lower(model), 'haiku') THEN {2} ELSE {0} END"
PR = CA + f", pr AS (SELECT *, {_PRICE.format('3.0', '15.0', '0.8')} AS p_in, {_PRICE.format('15.0', '75.0', '4.0')} AS p_out FROM (SELECT *, {_MODEL} AS model FROM ca)), co AS (SELECT *, in_tok / 1e6 * p_in + out_tok / 1e6 * p_out AS cost FROM pr)"


def _priced(spark, sf_dir):
    c = tables.calls(spark, sf_dir).withColumn("model", F.expr(_MODEL))
    c = c.withColumn("p", costs.price(F.col("model")))
    return c.withColumn("cost", costs.cost(F.col("in_tok"), F.col("out_tok"), F.col("p")))


@query(PR + " SELECT DISTINCT model, CAST(p_in AS DOUBLE) AS p_in, CAST(p_out AS DOUBLE) AS p_out FROM pr")
def cst01_price(spark, sf_dir):
    return _priced(spark, sf_dir).select("model", "p.p_in", "p.p_out").distinct()


@query(PR + " SELECT run, round(sum(CAST(cost AS DOUBLE)), 6) AS cost, CAST(sum(in_tok) AS BIGINT) AS in_tok, CAST(sum(out_tok) AS BIGINT) AS out_tok FROM co GROUP BY run")
def cst02_cost(spark, sf_dir):
    return _priced(spark, sf_dir).groupBy("run").agg(F.round(F.sum("cost"), 6).alias("cost"), F.sum("in_tok").alias("in_tok"), F.sum("out_tok").alias("out_tok"))


@query("SELECT k AS call, printf('$%.3f', k * 0.0137 + 0.00003) AS shown FROM (SELECT CAST(event_id AS BIGINT) AS k FROM events)")
def cst03_format(spark, sf_dir):
    e = tables.table(spark, sf_dir, "events").select(F.col("event_id").cast("bigint").alias("call"))
    return e.select("call", F.format_string("$%.3f", F.col("call") * 0.0137 + 0.00003).alias("shown"))


@query(CA + """, n AS (SELECT CASE method WHEN 'view' THEN 'landing_ai' WHEN 'click' THEN 'llamaparse' ELSE method END AS method, count(*) AS n_pages FROM ca GROUP BY 1)
SELECT method, n_pages, round(CASE method WHEN 'landing_ai' THEN 0.01 WHEN 'llamaparse' THEN 0.003 ELSE 0.0 END * CAST(n_pages AS DOUBLE), 6) AS cost FROM n""")
def cst04_page_cost(spark, sf_dir):
    m = F.when(F.col("method") == "view", "landing_ai").when(F.col("method") == "click", "llamaparse").otherwise(F.col("method"))
    n = tables.calls(spark, sf_dir).groupBy(m.alias("method")).agg(F.count("*").alias("n_pages"))
    return costs.page_cost(n).select("method", "n_pages", "cost")


@query("SELECT d.source, m.method FROM (SELECT DISTINCT source FROM documents) d, (SELECT DISTINCT event_type AS method FROM events) m")
def ben01_cross(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents").select("source").distinct()
    m = tables.table(spark, sf_dir, "events").select(F.col("event_type").alias("method")).distinct()
    return costs.combinations(d, m)


@query("SELECT event_id, NOT (event_type = 'error' OR event_id % 11 = 0) AND COALESCE(value, 0) > 0 AS succeeded FROM events")
def ben02_success(spark, sf_dir):
    e = tables.table(spark, sf_dir, "events")
    w = F.array_compact(F.array(F.when(F.col("event_type") == "error", F.lit("Some ERROR")), F.when(F.col("event_id") % 11 == 0, F.lit("API key not set"))))
    return e.select("event_id", costs.succeeded(w, F.coalesce("value", F.lit(0.0))).alias("succeeded"))


@query(PR + " SELECT run, round(sum(CASE WHEN call % 10 = 0 THEN CAST(cost AS DOUBLE) END) / count(*) FILTER (WHERE call % 10 = 0) * count(*), 6) AS estimate FROM co GROUP BY run HAVING count(*) FILTER (WHERE call % 10 = 0) > 0")
def ben03_extrapolate(spark, sf_dir):
    """A run's cost from a tenth of its calls: the sampling is the feature."""
    s = F.col("call") % 10 == 0
    x = _priced(spark, sf_dir).groupBy("run").agg(F.sum(F.when(s, F.col("cost"))).alias("c"), F.count_if(s).alias("n"), F.count("*").alias("all"))
    return x.where("n > 0").select("run", F.round(F.col("c") / F.col("n") * F.col("all"), 6).alias("estimate"))


_METHODS = ["view", "click", "purchase", "signup", "error"]


@query(CA + " SELECT run AS file, " + ", ".join(f"COALESCE(max(in_tok) FILTER (WHERE method = '{m}'), -1) AS {m}" for m in _METHODS) + " FROM ca GROUP BY run")
def ben04_pivot(spark, sf_dir):
    c = tables.calls(spark, sf_dir).select(F.col("run").alias("file"), "method", F.col("in_tok").alias("value"))
    return costs.matrix(c, _METHODS)


@query(r"""SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) AS BIGINT) AS n_lines, CAST(len(list_filter(string_split(text, chr(10)), lambda x: contains(x, ' | '))) AS BIGINT) AS n_tables FROM documents""")
def ben05_summary(spark, sf_dir):
    lines = F.split("text", "\n")
    return tables.table(spark, sf_dir, "documents").select("doc_id", F.char_length("text").cast("bigint").alias("chars"), F.size(F.filter(lines, lambda x: F.trim(x) != "")).cast("bigint").alias("n_lines"), F.size(F.filter(lines, lambda x: F.contains(x, F.lit(" | ")))).cast("bigint").alias("n_tables"))


@query(PR + """, g AS (SELECT run AS file, sum(in_tok + out_tok) FILTER (WHERE method = 'view') AS ta, sum(in_tok + out_tok) FILTER (WHERE method = 'click') AS tb, sum(CAST(cost AS DOUBLE)) FILTER (WHERE method = 'view') AS ca_, sum(CAST(cost AS DOUBLE)) FILTER (WHERE method = 'click') AS cb FROM co GROUP BY 1)
SELECT file, CAST(ta AS BIGINT) AS tokens_a, CAST(tb AS BIGINT) AS tokens_b, CAST(tb - ta AS BIGINT) AS delta, round(CASE WHEN ca_ = 0 THEN 0 ELSE (ca_ - cb) / ca_ * 100 END, 4) AS saving_pct FROM g WHERE ta IS NOT NULL AND tb IS NOT NULL""")
def ben06_paired(spark, sf_dir):
    c = _priced(spark, sf_dir).select(F.col("run").alias("file"), "method", (F.col("in_tok") + F.col("out_tok")).alias("tokens"), "cost")
    return costs.paired(c, "view", "click").select("file", "tokens_a", "tokens_b", "delta", "saving_pct")


@query(PR + " SELECT round(sum(CAST(cost AS DOUBLE)) FILTER (WHERE method = 'view'), 4) AS cost_a, round(sum(CAST(cost AS DOUBLE)) FILTER (WHERE method = 'click'), 4) AS cost_b, CAST(sum(in_tok) AS BIGINT) AS in_tok FROM co")
def ben07_totals(spark, sf_dir):
    one = lambda m: F.round(F.sum(F.when(F.col("method") == m, F.col("cost"))), 4)
    return _priced(spark, sf_dir).agg(one("view").alias("cost_a"), one("click").alias("cost_b"), F.sum("in_tok").alias("in_tok"))


@query(PR + " SELECT method, count(*) AS n, count(*) FILTER (WHERE in_tok > 600) AS succeeded, round(sum(CAST(cost AS DOUBLE)), 6) AS cost FROM co GROUP BY method")
def ben08_batch(spark, sf_dir):
    return _priced(spark, sf_dir).groupBy("method").agg(F.count("*").alias("n"), F.count_if(F.col("in_tok") > 600).alias("succeeded"), F.round(F.sum("cost"), 6).alias("cost"))


@query(BP + " SELECT a.source, a.page, CAST(a.n_chars - b.n_chars AS BIGINT) AS delta FROM bp a JOIN bp b ON a.source = b.source AND a.page = b.page + 1")
def ben09_old_new(spark, sf_dir):
    """Sizes of two versions: each page against the one before."""
    w = Window.partitionBy("source").orderBy("page")
    p = tables.pages(spark, sf_dir).withColumn("delta", F.col("n_chars") - F.lag("n_chars").over(w))
    return p.where("delta is not null").select("source", "page", "delta")


# ---------------------------------------------------------------- data quality


@query(NM + " SELECT left(filename, 3) AS prefix, count(*) AS n FROM nm GROUP BY 1 HAVING count(*) > 1")
def dq01_prefixes(spark, sf_dir):
    return _named(spark, sf_dir).groupBy(F.substring("filename", 1, 3).alias("prefix")).agg(F.count("*").alias("n")).where("n > 1")


@query(NM + " SELECT source, count(*) AS n, max(sec) = count(*) AND min(sec) = 1 AS sequential FROM nm GROUP BY source")
def dq02_sequential(spark, sf_dir):
    g = _named(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("sec")).alias("s"))
    return g.select("source", "n", (F.col("s") == F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("sequential"))


@query(NM + """, h AS (SELECT source, content AS title FROM rp WHERE block_type = 'heading' AND heading_level <= 3) SELECT h.source, count(*) AS n_headings, count(*) FILTER (WHERE s.title IS NOT NULL) AS n_with_section
FROM h LEFT JOIN (SELECT DISTINCT source, title FROM nm) s USING (source, title) GROUP BY 1""")
def dq03_consistency(spark, sf_dir):
    h = _seams(spark, sf_dir).where("block_type = 'heading' and heading_level <= 3").select("source", F.col("content").alias("title"))
    s = _named(spark, sf_dir).select("source", "title").distinct().withColumn("f", F.lit(True))
    return h.join(s, ["source", "title"], "left").groupBy("source").agg(F.count("*").alias("n_headings"), F.count("f").alias("n_with_section"))


@query(MD + """, bo AS (SELECT source, sec, string_agg(md, chr(10) ORDER BY ord) AS body FROM md WHERE md IS NOT NULL GROUP BY 1, 2) SELECT source, count(*) AS n, count(*) FILTER (WHERE starts_with(body, '#')) AS n_hash, count(*) FILTER (WHERE body = '') AS n_empty FROM bo GROUP BY source""")
def dq04_nonempty(spark, sf_dir):
    b = sections.bodies(_rendered(spark, sf_dir))
    return b.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.startswith("body", F.lit("#"))).alias("n_hash"), F.count_if(F.col("body") == "").alias("n_empty"))


@query(MD + r""", t AS (SELECT source, string_agg(md, chr(10) || chr(10) ORDER BY ord) AS md, count(*) FILTER (WHERE block_type = 'heading') AS n_headings FROM md WHERE md IS NOT NULL GROUP BY 1)
SELECT source, n_headings, CAST(len(regexp_extract_all(md, '(?m)^#{1,6} ')) AS BIGINT) AS n_found, abs(len(regexp_extract_all(md, '(?m)^#{1,6} ')) - n_headings) <= greatest(5, n_headings * 0.05) AS accounted FROM t""")
def dq05_accounting(spark, sf_dir):
    r = _rendered(spark, sf_dir).where("md is not null")
    t = r.groupBy("source").agg(ordered_join("ord", "md", "\n\n").alias("md"), F.count_if(F.col("block_type") == "heading").alias("n_headings"))
    found = F.regexp_count("md", F.lit("(?m)^#{1,6} ")).cast("bigint")
    return t.select("source", "n_headings", found.alias("n_found"), (F.abs(found - F.col("n_headings")) <= F.greatest(F.lit(5.0), F.col("n_headings") * 0.05)).alias("accounted"))


@query(CU + " SELECT source, CAST(sec AS BIGINT) AS sec, count(*) AS n FROM cu WHERE block_type <> 'heading' AND regexp_matches(content, '(?i)licen[sc]e') GROUP BY 1, 2")
def dq06_forbidden(spark, sf_dir):
    c = _cut(spark, sf_dir).where((F.col("block_type") != "heading") & F.col("content").rlike("(?i)licen[sc]e"))
    return c.groupBy("source", "sec").agg(F.count("*").alias("n"))


@query(RP + " SELECT source, count(*) FILTER (WHERE is_repeated) AS n_repeated, count(DISTINCT page) AS n_pages, count(*) FILTER (WHERE is_repeated) <= 3 * count(DISTINCT page) AS ok FROM rp GROUP BY source")
def dq07_repeated(spark, sf_dir):
    g = _seams(spark, sf_dir).groupBy("source").agg(F.count_if("is_repeated").alias("n_repeated"), F.countDistinct("page").alias("n_pages"))
    return g.withColumn("ok", F.col("n_repeated") <= 3 * F.col("n_pages"))


@query(NM + " SELECT source, count(*) FILTER (WHERE contains(filename, '__')) AS n_nested, count(*) FILTER (WHERE contains(filename, '__') AND parent_path = '') AS n_missing FROM nm GROUP BY source")
def dq08_parents(spark, sf_dir):
    nested = F.contains("filename", F.lit("__"))
    return _named(spark, sf_dir).groupBy("source").agg(F.count_if(nested).alias("n_nested"), F.count_if(nested & (F.col("parent_path") == "")).alias("n_missing"))


@query(NM + " SELECT source, level, count(*) AS n FROM nm GROUP BY 1, 2")
def dq09_levels(spark, sf_dir):
    return _named(spark, sf_dir).groupBy("source", "level").agg(F.count("*").alias("n"))


@query(NM + " SELECT source, arg_max(sec, (chars, -sec)) AS largest, round(CAST(max(chars) AS DOUBLE) / sum(chars), 6) AS share, CAST(max(chars) AS DOUBLE) / sum(chars) <= 0.3 AS ok FROM nm GROUP BY source")
def dq10_share(spark, sf_dir):
    g = _named(spark, sf_dir).groupBy("source").agg(F.max_by("sec", F.struct("chars", -F.col("sec"))).alias("largest"), F.max("chars").alias("m"), F.sum("chars").alias("s"))
    return g.select("source", "largest", ratio(F.col("m"), F.col("s")).alias("share"), (F.col("m").cast("double") / F.col("s") <= 0.3).alias("ok"))


@query(with_beds("ot") + " SELECT n_pages, count(*) AS n FROM (SELECT doc, count(DISTINCT page) AS n_pages FROM ot GROUP BY doc HAVING count(DISTINCT page) > 1) GROUP BY 1")
def dq11_spans(spark, sf_dir):
    t = tables.order_rows(spark, sf_dir).groupBy("doc").agg(F.countDistinct("page").alias("n_pages")).where("n_pages > 1")
    return t.groupBy("n_pages").agg(F.count("*").alias("n"))


@query(CU + " SELECT source, count(*) AS n, count(*) FILTER (WHERE heading_level IS NULL) AS n_lost FROM cu WHERE block_type = 'heading' GROUP BY source")
def dq12_levels_kept(spark, sf_dir):
    return _cut(spark, sf_dir).where("block_type = 'heading'").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("heading_level").isNull()).alias("n_lost"))


@query(DD + ", c AS (SELECT block_type, count(*) AS n FROM dd GROUP BY 1), a AS (SELECT block_type, count(*) AS n_all FROM so GROUP BY 1) SELECT block_type, n, n_all - n AS n_dropped FROM c JOIN a USING (block_type)")
def dq13_histogram(spark, sf_dir):
    a = tables.blocks(spark, sf_dir).groupBy("block_type").agg(F.count("*").alias("n_all"))
    c = _seams(spark, sf_dir).groupBy("block_type").agg(F.count("*").alias("n"))
    return c.join(a, "block_type").select("block_type", "n", (F.col("n_all") - F.col("n")).alias("n_dropped"))


@query(RP + " SELECT source, page, count(*) AS n_blocks FROM rp r WHERE NOT EXISTS (SELECT 1 FROM rp h WHERE h.source = r.source AND h.page = r.page AND h.block_type = 'heading') GROUP BY 1, 2")
def dq15_no_heading(spark, sf_dir):
    s = _seams(spark, sf_dir)
    return s.join(s.where("block_type = 'heading'").select("source", "page").distinct(), ["source", "page"], "left_anti").groupBy("source", "page").agg(F.count("*").alias("n_blocks"))


@query(CU + " SELECT source, count(DISTINCT sec) AS n_sections, count(DISTINCT sec) >= 3 AS enough FROM cu WHERE contains(lower(content), 'the') OR contains(lower(content), 'schen') GROUP BY source")
def dq17_keywords(spark, sf_dir):
    c = _cut(spark, sf_dir).where(F.contains(F.lower("content"), F.lit("the")) | F.contains(F.lower("content"), F.lit("schen")))
    return c.groupBy("source").agg(F.countDistinct("sec").alias("n_sections")).withColumn("enough", F.col("n_sections") >= 3)


@query(NM + ", t AS (SELECT DISTINCT source, page FROM bp WHERE contains(text, ' | ')) SELECT t.source, t.page, count(n.sec) AS n_sections FROM t LEFT JOIN nm n ON n.source = t.source AND t.page BETWEEN n.page_start AND n.page_end GROUP BY 1, 2")
def dq18_covering(spark, sf_dir):
    """Sections whose pages cover each page with a table. Sections follow one another, so their page ranges unfold to about as many
    rows as there are pages, and the interval join becomes an equal join."""
    t = tables.pages(spark, sf_dir).where(F.contains("text", F.lit(" | "))).select("source", "page")
    n = _named(spark, sf_dir).select("source", "sec", F.explode(F.sequence("page_start", "page_end")).alias("page"))
    return t.join(n, ["source", "page"], "left").groupBy("source", "page").agg(F.count("sec").alias("n_sections"))


@query(BL + """ SELECT source, count(*) AS n_blocks, count(DISTINCT page) AS n_pages, round(CAST(count(*) AS DOUBLE) / count(DISTINCT page), 6) AS per_page, max(page) - min(page) + 1 - count(DISTINCT page) AS n_missing, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM bl GROUP BY source""")
def dq19_distribution(spark, sf_dir):
    g = tables.blocks(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_blocks"), F.countDistinct("page").alias("n_pages"), F.max("page").alias("b"), F.min("page").alias("a"))
    total = g.agg(F.sum("n_blocks").alias("t"))
    x = g.crossJoin(F.broadcast(total))  # one row
    return x.select("source", "n_blocks", "n_pages", ratio(F.col("n_blocks"), F.col("n_pages")).alias("per_page"), (F.col("b") - F.col("a") + 1 - F.col("n_pages")).alias("n_missing"), F.round(100.0 * F.col("n_blocks") / F.col("t"), 4).alias("pct"))


@query(BL + " SELECT phrase, count(*) AS n_lines, count(DISTINCT source) AS n_sources FROM bl JOIN (SELECT unnest(['the', 'schen', 'License']) AS phrase) p ON contains(content, phrase) GROUP BY phrase")
def dq20_phrases(spark, sf_dir):
    b = tables.blocks(spark, sf_dir)
    ph = F.filter(F.array(F.lit("the"), F.lit("schen"), F.lit("License")), lambda p: F.contains(F.col("content"), p))
    return b.select("source", F.explode(ph).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("n_lines"), F.countDistinct("source").alias("n_sources"))
