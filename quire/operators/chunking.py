"""Packing pages into budgeted chunks, and splitting, retrying and limiting the calls for them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, TABLE_BUDGET, MOST_PAGES = 20_000, 8_000, 20


def budget(table_heavy: Column) -> Column:
    return F.when(table_heavy, TABLE_BUDGET).otherwise(BUDGET).cast("bigint")


def _folded(df: DataFrame, key: str, order: list[str], values: list[str], fold, out: str) -> DataFrame:
    """A recurrence over each key's ordered rows as one pass over sorted partitions: one row's state at a time, whatever the
    number of rows of a key. fold() gives a new state, a function from a row's values to the output values."""
    kind = df.schema[key].dataType.simpleString()
    names = [x.split()[0] for x in out.split(", ")]

    def run(batches):
        last, step = None, None
        for b in batches:
            rows = []
            for k, *v in zip(*(b.column(c).to_pylist() for c in range(b.num_columns))):
                if step is None or k != last:
                    last, step = k, fold()
                rows.append(step(*v))
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [key, *names])

    cols = df.select(key, *(F.col(c).cast("bigint").alias(c) for c in values), *(c for c in order if c not in values))
    return cols.repartition(key).sortWithinPartitions(key, *order).select(key, *values).mapInArrow(run, f"{key} {kind}, {out}")


def greedy_chunks(pages: DataFrame) -> DataFrame:
    """pages (source, page, tokens, budget) with chunk: a page opens a new chunk if the current one has pages and
    either MOST_PAGES of them or no room for it within this page's budget."""

    def fold():
        chunk = used = n = 0

        def step(page, tokens, most):
            nonlocal chunk, used, n
            if n and (used + tokens > most or n >= MOST_PAGES):
                chunk, used, n = chunk + 1, 0, 0
            used, n = used + tokens, n + 1
            return page, tokens, chunk

        return step

    return _folded(pages, "source", ["page", "tokens", "budget"], ["page", "tokens", "budget"], fold, "page bigint, tokens bigint, chunk bigint")


def chunk_summary(chunks: DataFrame) -> DataFrame:
    s = chunks.groupBy("source", "chunk").agg(F.count("*").alias("n_pages"), F.min("page").alias("page_min"), F.max("page").alias("page_max"), F.sum("tokens").alias("tokens"))
    return s.withColumn("chunk_id", F.format_string("%s_chunk%03d", "source", "chunk"))


def with_context(chunks: DataFrame) -> DataFrame:
    """The page before and behind each chunk."""
    s = chunks.groupBy("source", "chunk").agg(F.min("page").alias("a"), F.max("page").alias("b"))
    w = Window.partitionBy("source").orderBy("chunk")
    return s.select("source", "chunk", F.lag("b").over(w).alias("context_before"), F.lead("a").over(w).alias("context_after"))


def halved(ranges: DataFrame, most: int = 3, rounds: int = 40) -> DataFrame:
    """ranges (source, lo, hi): each cut in halves until none has more than `most` pages. The cuts of a range depend on its length
    alone, so each range is unfolded by itself; no driver loop over rows."""
    start = F.array(F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi")))
    kind = "array<struct<lo:bigint,hi:bigint>>"

    def cut(r):
        mid = r["lo"] + F.floor((r["hi"] - r["lo"] + 1) / 2)
        two = F.array(F.struct(r["lo"].alias("lo"), (mid - 1).cast("bigint").alias("hi")), F.struct(mid.cast("bigint").alias("lo"), r["hi"].alias("hi")))
        return F.when(r["hi"] - r["lo"] + 1 > most, two).otherwise(F.array(F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"))))

    # as many rounds as the longest range needs: log2 of its length
    need = F.ceil(F.log2(F.greatest(F.col("hi") - F.col("lo") + 1, F.lit(1)).cast("double"))).cast("int")
    folded = F.aggregate(F.sequence(F.lit(0), F.least(need, F.lit(rounds))), start.cast(kind), lambda acc, _: F.flatten(F.transform(acc, cut)).cast(kind))
    return ranges.select("source", F.inline(folded))


def limited(calls: DataFrame, limit: int, window: int = 60) -> DataFrame:
    """calls (run, call, sec, tok): seconds that each call waits under a limiter of `limit` tokens in windows of `window` seconds.
    A window begins with the first call at least `window` seconds behind its start; a call that doesn't fit waits for the next."""

    def fold():
        at = now = None
        used = 0

        def step(sec, call, tok):
            nonlocal at, now, used
            now = max(sec if now is None else now, sec)
            if at is None or now - at >= window:
                at, used = now, 0
            if used and used + tok > limit:
                at = now = at + window
                used = tok
            else:
                used += tok
            return call, now - sec

        return step

    return _folded(calls, "run", ["sec", "call", "tok"], ["sec", "call", "tok"], fold, "call bigint, wait bigint")


def tail(blocks: DataFrame, pages: int = 3) -> DataFrame:
    """Blocks on the last `pages` distinct pages of each chunk."""
    w = Window.partitionBy("source", "chunk").orderBy(F.desc("page"))
    return blocks.withColumn("back", F.dense_rank().over(w)).where(F.col("back") <= pages).drop("back")


def missing_pages(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pages that no block came from."""
    return pages.join(blocks.select("source", "page").distinct(), ["source", "page"], "left_anti")
