"""Benchmark decontamination by winnowing.

Words are runs of other than ASCII punctuation, white space and controls, A-Z lower-cased. Of the hashes of all GRAM
successive words, each window of GRAM such hashes keeps its smallest; every span of WINDOW = 2 * GRAM - 1 words that a document
shares with an item therefore has a fingerprint in common. Documents whose fingerprints meet the benchmark's are extended: all
their windows of WINDOW words are looked up among the items' windows, and words inside any such occurrence are hit. Items of
fewer words (but some) are one window of their own length, looked up directly.

The benchmark goes to the executors in blocks of at most BLOCK_WORDS words, the only thing that is broadcast. One block is looked up
in one pass over the texts. A larger benchmark takes a pass for each block, in which a task holds that block alone; a pass gives out
the hit runs and items of the documents that it hits, and these (not the texts) are then merged by document. So a benchmark of any size
works in bounded memory and no text is shuffled. Null or empty texts have no words and aren't contaminated. Items with one id count
as one item; items without id aren't listed (together they count as one), their words still hit. Repeated rows are judged alike, rows without
doc_id too. Empty tables: without documents no rows, without items no hits. Columns besides those named are left aside.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, blocks, bounded_batches, buffers, grams, own_text, ranges, words

GRAM = 7
WINDOW = 2 * GRAM - 1
#: 10 words a window at the least hash 8 bytes each: a block's index stays under 100 MB.
BLOCK_WORDS = 2_000_000


def winnowed(g: np.ndarray, w: int = GRAM) -> np.ndarray:
    """Which hashes are the smallest of a window of w successive ones (ties all)."""
    if len(g) < w:
        return np.zeros(len(g), bool)
    n = len(g) - w + 1
    low = g[:n].copy()
    for j in range(1, w):
        np.minimum(low, g[j : j + n], out=low)
    best = np.zeros(len(g), np.uint64)
    for j in range(w):
        np.maximum(best[j : j + n], low, out=best[j : j + n])
    return best == g


class Index:
    """Fingerprints and windows of a block of items."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.names = [i for i, _ in items]
        data, offs = buffers(pa.array([t for _, t in items], pa.string()))
        h, at, _ = words(data, offs, ALNUM)
        n = np.diff(at)
        prints, wins = [], {}
        for d in range(len(items)):
            own = h[at[d] : at[d + 1]]
            if n[d] >= WINDOW:
                g = grams(own, GRAM)
                prints.append(g[winnowed(g)])
                wins.setdefault(WINDOW, []).append((grams(own, WINDOW), d))
            elif n[d]:
                wins.setdefault(int(n[d]), []).append((grams(own, int(n[d])), d))
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.windows = {}
        for m, got in wins.items():
            g = np.concatenate([x for x, _ in got])
            item = np.concatenate([np.full(len(x), d) for x, d in got])
            order = np.lexsort((item, g))
            g, item = g[order], item[order]
            keys, first = np.unique(g, return_index=True)
            self.windows[m] = (keys, np.append(first, len(g)), item)

    def hits(self, h: np.ndarray, at: np.ndarray):
        """(text, first word, length, item) arrays of all windows in texts whose words begin at at[...] in h."""
        n = np.diff(at)
        out = []
        for m, (keys, first, item) in self.windows.items():
            rows = np.flatnonzero(n >= m)
            if m == WINDOW and len(rows):
                g = grams(h, GRAM)
                if not len(g):
                    continue
                p = np.flatnonzero(winnowed(g))
                p = p[_in(g[p], self.prints)]
                rows = np.intersect1d(rows, np.unique(np.searchsorted(at, p, side="right") - 1))
            if not len(rows):
                continue
            lens = n[rows] - m + 1
            p = ranges(at[rows], lens)
            g = grams(h, m)[p]
            ok = _in(g, keys)
            p, g, row = p[ok], g[ok], np.repeat(rows, lens)[ok]
            k = np.searchsorted(keys, g)
            times = first[k + 1] - first[k]
            out.append((np.repeat(row, times), np.repeat(p - at[row], times), np.full(int(times.sum()), m), item[ranges(first[k], times)]))
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def _in(x: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


_RESULT = "struct<n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string>"
_FIELDS = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string())]


def _met(text: pa.Array, index: Index):
    """Of each block of texts: word counts, and for each hit text its runs of hit words (begin, end) and its items' names."""
    data, offs = buffers(text)
    for i, j in blocks(offs):
        h, at, _ = words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], ALNUM)
        row, p, m, item = index.hits(h, at)
        edge = np.zeros(len(h) + 1, np.int64)  # +1 where a hit window begins, -1 behind its end
        np.add.at(edge, at[row] + p, 1)
        np.add.at(edge, at[row] + p + m, -1)
        inside = np.cumsum(edge)[:-1] > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1] | np.isin(np.arange(1, len(h)), at)
        s = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | np.isin(np.arange(1, len(h)), at)
        e = np.flatnonzero(last) + 1
        text_of = np.searchsorted(at, s, side="right") - 1
        runs: dict[int, list] = {}
        for d, a, b in zip(text_of.tolist(), (s - at[text_of]).tolist(), (e - at[text_of]).tolist()):
            runs.setdefault(d, []).append((a, b))
        names: dict[int, set] = {}
        for r, x in np.unique(np.stack([row, item]), axis=1).T.tolist():
            names.setdefault(r, set()).add(index.names[x])
        yield i, np.diff(at).tolist(), runs, names


_NOTHING = hashlib.sha256(b"").hexdigest()


def _told(names) -> str:
    own = sorted(x for x in names if x is not None)
    return hashlib.sha256(",".join(own).encode()).hexdigest() if own else _NOTHING


def _judged(text: pa.Array, index: Index) -> pa.Array:
    cols: list[list] = [[], [], [], []]
    for _, n_words, runs, names in _met(text, index):
        for d, n in enumerate(n_words):
            own = names.get(d, ())
            for c, v in zip(cols, (n, sum(b - a for a, b in runs.get(d, ())), len(own), _told(own) if own else _NOTHING)):
                c.append(v)
    return pa.StructArray.from_arrays([pa.array(x, t) for x, (_, t) in zip(cols, _FIELDS)], [k for k, _ in _FIELDS])


def item_blocks(benchmark: DataFrame):
    """Broadcast indexes of blocks of items. One block's texts and index are on the driver at a time."""
    sc = benchmark.sparkSession.sparkContext
    part, n, made = [], 0, 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).orderBy("i", "t").toLocalIterator():
        part.append((r["i"], r["t"]))
        n += len(r["t"] or "") // 4
        if n >= BLOCK_WORDS:
            yield sc.broadcast(Index(part))
            part, n, made = [], 0, made + 1
    if part or not made:
        yield sc.broadcast(Index(part))


def _passed(batches, shared):
    """Of rows (doc_id, key, text): those that a block of items hits, with runs and names."""
    for b in batches:
        for i, _, runs, names in _met(b.column(2), shared.value):
            hit = sorted(names)
            at = pa.array([i + d for d in hit], pa.int64())
            pairs = [[{"a": a, "b": z} for a, z in runs[d]] for d in hit]
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(pairs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array([list(names[d]) for d in hit], pa.list_(pa.string()))], ["doc_id", "key", "runs", "names"])


def _merged(docs: DataFrame, shared: list, spark) -> DataFrame:
    """(doc_id, key, n_hit, n_items, items_sha256) of the texts that any block of items hits; key is the text's sha256."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(own_text("text"), 256).alias("key"), own_text("text").alias("text"))
    parts = None
    for x in shared:
        part = rows.mapInArrow(lambda it, x=x: _passed(it, x), "doc_id bigint, key string, runs array<struct<a:bigint,b:bigint>>, names array<string>")
        parts = part if parts is None else parts.unionByName(part)
    all_of = parts.groupBy("doc_id", "key").agg(F.array_sort(F.flatten(F.collect_set("runs"))).alias("runs"), F.array_distinct(F.flatten(F.collect_set("names"))).alias("names"))
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    union = F.aggregate("runs", none, lambda acc, r: F.struct((acc["n"] + F.greatest(F.lit(0), r["b"] - F.greatest(r["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], r["b"]).alias("end")))
    return all_of.select("doc_id", "key", union["n"].alias("n_hit"), F.size("names").cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.array_compact("names")), ",").cast("binary"), 256).alias("items_sha256"))


def judged(docs: DataFrame, benchmark: DataFrame, own: str) -> DataFrame:
    """docs and a column own: a struct of n_words, n_hit, n_items and items_sha256."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = list(item_blocks(benchmark))  # handles; the blocks themselves are in Spark's care
    one = shared[0] if len(shared) == 1 else spark.sparkContext.broadcast(Index([]))
    x = docs.withColumn(own, F.arrow_udf(lambda text: _judged(text, one.value), _RESULT)(F.col("text").cast("string")))
    if len(shared) == 1:
        return x
    hits = _merged(docs, shared, spark).toDF("__doc", "__key", "__hit", "__items", "__sha")
    x = x.join(hits, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")) & (F.sha2(own_text("text"), 256) == F.col("__key")), "left")
    w = F.col(own)
    both = F.struct(w["n_words"].alias("n_words"), *(F.coalesce(F.col(b), w[k]).alias(k) for k, b in (("n_hit", "__hit"), ("n_items", "__items"), ("items_sha256", "__sha"))))
    return x.withColumn(own, both).select(*docs.columns, own)


def contaminated(x):
    return (x["n_hit"] > 0) & (20 * x["n_hit"] >= x["n_words"])


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of docs."""
    x = judged(docs.select("doc_id", "text"), benchmark, "__own")
    return x.select("doc_id", "__own.*", contaminated(F.col("__own")).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that aren't contaminated, all columns."""
    own = "__contamination"
    return judged(docs, benchmark, own).where(~contaminated(F.col(own))).drop(own)
