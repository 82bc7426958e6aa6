"""Retrieval over sections, blocks and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ordered_join


#: Names that one question may want.
MOST_NAMES = 1000


def section_lines(blocks: DataFrame) -> DataFrame:
    """blocks with sec: line number of each block in its section."""
    w = Window.partitionBy("source", "sec").orderBy("ord")
    return blocks.select("source", "sec", "ord", "content", F.row_number().over(w).cast("bigint").alias("line_no"))


def search(blocks: DataFrame, term: str, most: int = 5, preview: int = 100) -> DataFrame:
    """The first `most` lines of each section that contain the term, case aside."""
    hit = blocks.where(F.contains(F.lower("content"), F.lit(term.lower())))
    w = Window.partitionBy("source", "sec").orderBy("ord")
    x = hit.withColumn("rn", F.row_number().over(w).cast("bigint")).where(F.col("rn") <= most)
    return x.select("source", "sec", "rn", F.substring(F.trim("content"), 1, preview).alias("line"))


def lexical_scores(blocks: DataFrame, terms: list[str]) -> DataFrame:
    """Score 0 to 10 of each section: two for each term it has in a heading, one for each in other text, up to 10."""
    low = F.lower("content")
    cols = [F.max(F.when(F.contains(low, F.lit(t)), F.when(F.col("block_type") == "heading", 2).otherwise(1)).otherwise(0)).alias(f"t{i}") for i, t in enumerate(terms)]
    s = blocks.groupBy("source", "sec").agg(*cols)
    total = sum((F.col(f"t{i}") for i in range(1, len(terms))), F.col("t0"))
    return s.select("source", "sec", F.least(total * 2, F.lit(10)).cast("bigint").alias("score"))


def ranked(scores: DataFrame, top: int = 3, least: int = 5) -> DataFrame:
    """The `top` sections of a document, those below `least` left out."""
    w = Window.partitionBy("source").orderBy(F.desc("score"), "sec")
    return scores.withColumn("rank", F.row_number().over(w).cast("bigint")).where((F.col("rank") <= top) & (F.col("score") >= least))


def parsed_answer(answer: Column) -> Column:
    """File names and scores of lines like 003_name.md (7/10)."""
    m = F.regexp_extract_all(answer, F.lit("([0-9]{3}_[a-z0-9_]+\\.md)\\s*\\(([0-9]+)/10\\)"), F.lit(0))
    return F.transform(m, lambda x: F.struct(F.regexp_extract(x, "^[0-9]{3}_[a-z0-9_]+\\.md", 0).alias("filename"), F.regexp_extract(x, "\\(([0-9]+)/", 1).cast("int").alias("score")))


def loaded(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """wanted (filename) against files (filename, ...): found or not."""
    return wanted.join(files.select("filename").distinct().withColumn("found", F.lit(True)), "filename", "left").na.fill(False, ["found"])


def fuzzy(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Pairs where one name contains the other. wanted comes from one question: MOST_NAMES names at most, so it is the broadcast side."""
    n = wanted.count()
    if n > MOST_NAMES:
        raise ValueError(f"{n} names are wanted; a question has {MOST_NAMES} at most")
    few = F.broadcast(wanted)
    stem = lambda c: F.regexp_replace(F.lower(c), "\\.md$", "")
    return files.join(few, F.contains(stem(files["filename"]), stem(few["wanted"])) | F.contains(stem(few["wanted"]), stem(files["filename"])))


def grep_words(lines: DataFrame, question: str, words: int = 3, most: int = 100) -> DataFrame:
    """Lines (key columns source, page, ln, content) that contain any of the question's first words: a top-k report."""
    ws = [w.lower() for w in question.split()[:words]]
    cond = F.lit(False)
    for w in ws:
        cond |= F.contains(F.lower("content"), F.lit(w))
    return lines.where(cond).orderBy("source", "page", "ln").limit(most).select("source", "page", "ln", "content")


def assembled(secs: DataFrame) -> DataFrame:
    """secs (source, rank, filename, body): one context text a document, by rank."""
    x = secs.withColumn("piece", F.concat(F.lit("["), "filename", F.lit("]\n"), "body"))
    return x.groupBy("source").agg(ordered_join("rank", "piece", "\n\n---\n\n").alias("context"))
