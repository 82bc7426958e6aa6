"""Driver tables, and the page, block, table and call views ("beds") that the document operators run on.

Each view exists twice: as a DataFrame here and as SQL text (for the oracles) in BEDS. A source's rows of SPAN successive ids count as
a document, in order of doc_id as its pages, their lines as blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import strip


#: Ids of a source that make one document.
SPAN = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark, sf_dir) -> DataFrame:
    """source, page, doc_id, text, n_chars. A source's next SPAN ids are one document, so that documents grow in number with the
    table and not in length, and windows by document never hold a share of all rows."""
    own = F.concat_ws("-", "source", F.expr(f"doc_id div {SPAN}").cast("string")).alias("source")
    d = table(spark, sf_dir, "documents").select(own, "doc_id", "text", "n_chars")
    return d.withColumn("page", F.row_number().over(Window.partitionBy("source").orderBy("doc_id")).cast("bigint"))


def profiles(spark, sf_dir) -> DataFrame:
    """Per page: measured characters and rule-derived counts of tokens, tables and images."""
    p = pages(spark, sf_dir)
    return p.select(
        "source", "page", "doc_id", F.char_length(strip(F.col("text"))).cast("bigint").alias("chars"),
        (F.lit(85) + 170 * (1 + F.expr("n_chars div 512"))).cast("bigint").alias("tokens"),
        F.when(F.col("doc_id") % 5 == 0, 2).otherwise(0).cast("bigint").alias("tables"),
        F.when(F.col("doc_id") % 7 == 0, 1).otherwise(0).cast("bigint").alias("images"),
        (F.col("doc_id") % 10 / 20.0).cast("double").alias("image_area"),
        F.col("text").alias("text"),
    )


def blocks(spark, sf_dir) -> DataFrame:
    """source, page, ln, block_type, content, heading_level, is_continuation, is_truncated, chunk, seq, ord."""
    lines = pages(spark, sf_dir).select("source", "page", "doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    x = lines.select("source", "page", "doc_id", F.col("ln").cast("bigint").alias("ln"), F.trim("line").alias("content")).where("content <> ''")
    own = Window.partitionBy("source", "page")
    x = x.withColumn("first", F.min("ln").over(own)).withColumn("last", F.max("ln").over(own))
    n = F.char_length("content")
    kind = F.when((F.col("ln") == F.col("first")) & (n <= 60), "header").when((F.col("ln") == F.col("last")) & (F.col("last") > F.col("first")), "footer").when(n <= 24, "heading").otherwise("paragraph")
    x = x.withColumn("block_type", kind)
    x = x.withColumn("heading_level", F.when(F.col("block_type") == "heading", 1 + n % 4).cast("bigint"))
    x = x.withColumn("is_continuation", F.col("content").rlike("^\\p{Ll}")).withColumn("is_truncated", ~F.col("content").rlike("[.!?]$"))
    x = x.withColumn("chunk", F.expr("(page - 1) div 4").cast("bigint"))
    x = x.withColumn("seq", F.row_number().over(Window.partitionBy("source").orderBy("page", "ln")).cast("bigint") - 1)
    return x.drop("first", "last")


def html_blocks(spark, sf_dir) -> DataFrame:
    """page_id, pos, block_type, content of h1, p and li elements of pages."""
    found = F.regexp_extract_all(F.col("html"), F.lit("(?s)<(?:h1|p|li)[^>]*>.*?</(?:h1|p|li)>"), F.lit(0))
    x = table(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("pos", "raw"))
    tag = F.regexp_extract("raw", "^<(h1|p|li)", 1)
    kind = F.when(tag == "h1", "heading").when(tag == "li", "list_item").otherwise("paragraph")
    text = F.trim(F.regexp_replace(F.regexp_replace("raw", "<[^>]*>", ""), "[ \\t\\r\\n]+", " "))
    return x.select("page_id", F.col("pos").cast("bigint").alias("pos"), kind.alias("block_type"), text.alias("content"))


def order_rows(spark, sf_dir) -> DataFrame:
    """Lines of orders as rows of tables, three a page: doc (order), ord, page, item, qty, flag."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax")
    x = li.withColumn("ord", F.row_number().over(w).cast("bigint"))
    return x.select(F.col("l_orderkey").alias("doc"), "ord", F.expr("1 + (ord - 1) div 3").cast("bigint").alias("page"), F.col("l_partkey").cast("bigint").alias("item"), F.col("l_quantity").cast("bigint").alias("qty"), F.col("l_returnflag").alias("flag"))


def calls(spark, sf_dir) -> DataFrame:
    """events as provider calls: run (user), method, call order, seconds, tokens."""
    e = table(spark, sf_dir, "events")
    n = F.coalesce(F.floor(F.abs("value") * 100), F.lit(0)).cast("bigint")
    return e.select(F.col("user_id").cast("bigint").alias("run"), F.col("event_type").alias("method"), F.col("event_id").cast("bigint").alias("call"), F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts AS TIMESTAMP_NTZ))").alias("sec"), (n % 5000 + 500).alias("in_tok"), (n % 900 + 100).alias("out_tok"))


#: The same views as DuckDB SQL, each with the views that it needs.
BEDS = {
    "bp": f"bp AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page, doc_id, text, n_chars FROM (SELECT source || '-' || CAST(doc_id // {SPAN} AS VARCHAR) AS source, doc_id, text, n_chars FROM documents))",
    "pf": r"""pf AS (SELECT source, page, doc_id, CAST(length(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')) AS BIGINT) AS chars,
        CAST(85 + 170 * (1 + n_chars // 512) AS BIGINT) AS tokens, CAST(CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS tables,
        CAST(CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS images, CAST((doc_id % 10) / 20.0 AS DOUBLE) AS image_area, text FROM bp)""",
    "bl": r"""ln0 AS (SELECT source, page, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln FROM bp),
        ln1 AS (SELECT source, page, doc_id, CAST(ln AS BIGINT) AS ln, trim(line, ' ') AS content FROM ln0 WHERE trim(line, ' ') <> ''),
        ln2 AS (SELECT *, min(ln) OVER (PARTITION BY source, page) AS f, max(ln) OVER (PARTITION BY source, page) AS l FROM ln1),
        ln3 AS (SELECT *, CASE WHEN ln = f AND length(content) <= 60 THEN 'header' WHEN ln = l AND l > f THEN 'footer' WHEN length(content) <= 24 THEN 'heading' ELSE 'paragraph' END AS block_type FROM ln2),
        bl AS (SELECT source, page, doc_id, ln, content, block_type, CAST(CASE WHEN block_type = 'heading' THEN 1 + length(content) % 4 END AS BIGINT) AS heading_level,
        regexp_matches(content, '^\p{Ll}') AS is_continuation, NOT regexp_matches(content, '[.!?]$') AS is_truncated, CAST((page - 1) // 4 AS BIGINT) AS chunk,
        row_number() OVER (PARTITION BY source ORDER BY page, ln) - 1 AS seq FROM ln3)""",
    "hb": r"""hb0 AS (SELECT page_id, regexp_extract_all(html, '(?s)<(?:h1|p|li)[^>]*>.*?</(?:h1|p|li)>') AS a FROM pages),
        hb1 AS (SELECT page_id, unnest(a) AS raw, generate_subscripts(a, 1) - 1 AS pos FROM hb0),
        hb AS (SELECT page_id, CAST(pos AS BIGINT) AS pos, CASE regexp_extract(raw, '^<(h1|p|li)', 1) WHEN 'h1' THEN 'heading' WHEN 'li' THEN 'list_item' ELSE 'paragraph' END AS block_type,
        trim(regexp_replace(regexp_replace(raw, '<[^>]*>', '', 'g'), '[ \t\r\n]+', ' ', 'g'), ' ') AS content FROM hb1)""",
    "ot": """ot AS (SELECT doc, ord, CAST(1 + (ord - 1) // 3 AS BIGINT) AS page, item, qty, flag FROM (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS ord, CAST(l_partkey AS BIGINT) AS item, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS flag FROM lineitem))""",
    "ca": """ca AS (SELECT CAST(user_id AS BIGINT) AS run, event_type AS method, CAST(event_id AS BIGINT) AS call, CAST(floor(epoch(ts)) AS BIGINT) AS sec, n % 5000 + 500 AS in_tok, n % 900 + 100 AS out_tok
        FROM (SELECT *, COALESCE(CAST(floor(abs(value) * 100) AS BIGINT), 0) AS n FROM events))""",
}
_NEEDS = {"pf": ["bp"], "bl": ["bp"]}


def with_beds(*names: str) -> str:
    """WITH ... of the named views; ends so that a query or further views (after a comma) can follow."""
    order = list(dict.fromkeys(x for n in names for x in [*_NEEDS.get(n, []), n]))
    return "WITH RECURSIVE " + ",\n".join(BEDS[x] for x in order)
