"""Document fingerprints by a randomised edit embedding.

All texts share one random walk: at step j, on character c, a random bit of (j, c) tells whether to go on to the next character.
The characters seen at the steps form the embedding; texts at a small edit distance fall into step again soon after an edit, so
their embeddings differ at few places. A fingerprint samples the embedding at fixed random steps, SLOTS in
each stratum [2^k, 2^(k+1)), four bits each; strata go on as far as the longest text, so all of a text counts. Likeness weighs
each stratum's agreement by its share of the walk, corrected for chance: an estimate of 1 - Hamming distance of the embeddings.

Bands (hashes of BAND slots sampled over the strata) find pairs of like fingerprints, which the likeness and then the edit
distance verify (near_pairs).

The stay at each character is one table look-up (all bits up to the first 1), so a text takes one step a character, and all
texts of a block walk together. A null text counts as empty; two empty texts are alike (1), an empty and another not (0). Equal texts
have equal fingerprints. Rows without doc_id come last in descending order; rows of one doc_id go by a hash of the text.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound, keys, mix, partitions, settle, spread_join

PERIOD, CLASSES = 4096, 64
SLOTS, LOWEST = 32, 16
BAND, BANDS = 4, 32
BLOCK_CHARS = 2_000_000
#: Rows of one salted group of a band.
CELL = 500
#: Rows that walk together; a block of texts takes as many steps as its longest has characters.
SLICE = 8192


def _dwell() -> np.ndarray:
    """How many steps a walk that arrives at step j (of PERIOD) stays at a character of each class."""
    bits = (keys(31, PERIOD * CLASSES).reshape(PERIOD, CLASSES) >> np.uint64(63)).astype(bool)
    bits = np.concatenate([bits, bits])
    out = np.full((2 * PERIOD, CLASSES), 32, np.int32)
    wait = np.full(CLASSES, 32, np.int32)
    for j in range(2 * PERIOD - 1, -1, -1):
        wait = np.where(bits[j], 1, np.minimum(wait + 1, 32))
        out[j] = wait
    return np.ascontiguousarray(out[:PERIOD]).ravel()


_STAY = _dwell()


def steps_to(end: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Sampled steps, their strata and the strata's bounds, as far as step end; a longer walk has the same ones first."""
    return _grid(max(0, (max(end, 1) - 1) // LOWEST).bit_length() + 1)


@functools.lru_cache(64)
def _grid(n: int):
    bounds = [(0, LOWEST)]
    while len(bounds) < n:
        bounds.append((bounds[-1][1], 2 * bounds[-1][1]))
    at = [np.sort(a + (keys(40 + k, SLOTS) % np.uint64(b - a)).astype(np.int64)) for k, (a, b) in enumerate(bounds)]
    return np.concatenate(at), np.repeat(np.arange(len(bounds)), SLOTS), bounds


def embed(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """Of each text: the number of steps of its walk, and four bits for each sampled step before that."""
    lens = np.array([len(t) for t in texts])
    out: list = [(0, np.zeros(0, np.uint8))] * len(texts)
    order = np.argsort(-lens, kind="stable")
    order = order[lens[order] > 0]
    i = 0
    while i < len(order):
        total, j = 0, i
        while j < len(order) and (j == i or total + lens[order[j]] <= BLOCK_CHARS):
            total += lens[order[j]]
            j += 1
        own = order[i:j]
        cps = np.frombuffer("".join(texts[d] for d in own).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = lens[own]
        first = np.cumsum(n) - n
        kind = ((cps * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.int32)
        arrive = np.empty(len(cps), np.int32 if n[0] < 60_000_000 else np.int64)
        step = np.zeros(len(own), arrive.dtype)
        place = first.copy()
        active = np.searchsorted(-n, -np.arange(n[0]), side="left").tolist()  # texts longer than i; n falls
        for a in active:
            p = place[:a]
            s = step[:a]
            arrive[p] = s
            s += _STAY[(s & (PERIOD - 1)) * CLASSES + kind[p]]
            p += 1
        at, _, _ = steps_to(int(step.max()))
        for k, d in enumerate(own):
            end = int(step[k])
            here = at[: np.searchsorted(at, end)]
            c = cps[first[k] + np.searchsorted(arrive[first[k] : first[k] + n[k]], here, side="right") - 1]
            out[d] = (end, (mix(c.astype(np.uint64) + here.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(60)).astype(np.uint8))
        i = j
    return out


_HEX = "0123456789abcdef"


def told(fp: tuple[int, np.ndarray]) -> str:
    return f"{fp[0]:010x}" + fp[1].tobytes().translate(bytes(ord(_HEX[i & 15]) for i in range(256))).decode()


def read(text: str) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(text[10:].encode(), np.uint8)
    return int(text[:10], 16), np.where(raw >= 97, raw - 87, raw - 48).astype(np.uint8)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    end = max(a[0], b[0])
    if not min(a[0], b[0]):
        return float(end == 0)
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0
    at, strata, bounds = steps_to(end)
    n = int(np.searchsorted(at, end))
    same = np.zeros(n)
    m = min(len(a[1]), len(b[1]))
    same[:m] = a[1][:m] == b[1][:m]
    here = np.bincount(strata[:n])
    agree = np.bincount(strata[:n], same) / np.maximum(here, 1)
    share = np.array([min(hi, end) - lo for lo, hi in bounds[: len(here)]]) * (here > 0)
    x = float((agree * share).sum() / share.sum())
    return min(1.0, max(0.0, (x - 1 / 16) * 16 / 15))


def bands(fp: tuple[int, np.ndarray]) -> list[int]:
    """Hashes of BAND slots each, sampled from the last three strata that the walk fills at least half."""
    if not fp[0]:
        return []
    _, strata, bounds = steps_to(fp[0])
    top = max((k for k, (lo, hi) in enumerate(bounds) if fp[0] >= (lo + hi) / 2), default=0)
    out = []
    for last in {top, max(0, top - 1)}:  # a text at a stratum's border is found from both sides
        pool = np.flatnonzero((strata[: len(fp[1])] >= last - 2) & (strata[: len(fp[1])] <= last))
        for k in range(BANDS):
            pick = pool[(keys(60 + k, BAND) % np.uint64(len(pool))).astype(np.int64)]
            out.append(int.from_bytes(hashlib.blake2b(bytes([k, last]) + pick.astype(np.int32).tobytes() + fp[1][pick].tobytes(), digest_size=8).digest(), "big", signed=True))
    return out


_SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, near_id bigint"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


_MOVED = "bucket int, kind int, doc_id bigint, near bigint, h bigint, text binary"
ROW, EDGE, NEAR = 0, 1, -1


def _packed(batches):
    """Texts compressed for the exchange: (bucket, kind, doc_id, near, h, text)."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for b in batches:
        texts = [squeeze.compress(t.as_buffer()) if t.is_valid and len(t.as_buffer()) else b"" for t in b.column(5)]
        yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(texts, pa.binary())], b.schema.names)


def _walked(batches):
    """Rows of sorted buckets: each row with the next one of its bucket, and with the class that a row of kind NEAR before it names."""
    unpack = zstandard.ZstdDecompressor()
    carry = None  # bucket, kind, doc_id, near, text, fingerprint
    near = (None, None)
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            own = []
            for bucket, kind, doc, to, raw in zip(*(part.column(c).to_pylist() for c in (0, 1, 2, 3, 5))):
                if kind == NEAR:
                    near = (doc, to)
                else:
                    own.append((bucket, kind, doc, near[1] if near[0] == doc and doc is not None else doc, unpack.decompress(raw).decode() if raw else ""))
            if not own:
                continue
            texts = [x[4] for x in own]
            if carry is not None:
                own.insert(0, carry[:5])
            edited = []
            for x, y in zip(own, own[1:]):
                h = len(x[4]) // 2
                edited.append(x[4][: len(x[4]) - h] + y[4][:h] if x[0] == y[0] and x[1] == ROW else "")
            got = embed([*texts, *edited])
            fps = ([carry[5]] if carry is not None else []) + got[: len(texts)]
            more = got[len(texts) :]
            cols: list[list] = [[] for _ in _NAMES]
            for k, (x, y) in enumerate(zip(own, own[1:])):
                if x[1] == EDGE or x[0] != y[0]:
                    continue
                for c, v in zip(cols, (x[2], len(x[4]), hashlib.sha256(edited[k].encode("utf-8", "surrogatepass")).hexdigest(), told(fps[k]), told(more[k]), likeness(fps[k], more[k]), likeness(fps[k], fps[k + 1]), x[3])):
                    c.append(v)
            carry = (*own[-1], fps[-1])
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], _NAMES)


def compared(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Fingerprints of each row, of its edited text, and their likenesses (see the module and _SCHEMA); near_id is the row's class in
    classes (doc_id, near_id: those that differ), else its own doc_id.

    Rows are dealt into buckets of doc_id by quantiles and sorted there; the highest row of each bucket is copied behind the
    lowest of the bucket above it (the highest of all behind the lowest of all), so every row meets its next one. A class goes
    to its row's bucket as a row of its own. The texts move once, compressed."""
    spark = docs.sparkSession
    x = bound(docs, {"doc_id": "bigint", "text": "string"})
    n = 2 * partitions(spark)
    cuts = x.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0]
    cuts = sorted(set(cuts or []))
    low = F.array(*(F.lit(c).cast("bigint") for c in cuts)) if cuts else F.array().cast("array<bigint>")
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(low, lambda c: c < F.col("doc_id")))).cast("int")
    x = x.withColumn("bucket", bucket).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    top = F.struct("doc_id", "h")
    heads = x.groupBy("bucket").agg(F.max_by("text", top).alias("text"), F.max(top).alias("m"))
    there = sorted(r["bucket"] for r in heads.select("bucket").collect())  # at most 2 * partitions + 1 numbers
    if not there:
        return spark.createDataFrame([], _SCHEMA)
    to = F.create_map(*(F.lit(v) for b, above in zip(there, [*there[1:], there[0]]) for v in (b, above)))
    none = F.lit(None).cast("bigint")
    edges = heads.select(to[F.col("bucket")].alias("bucket"), F.lit(EDGE).alias("kind"), F.col("m.doc_id").alias("doc_id"), none.alias("near"), F.col("m.h").alias("h"), "text")
    rows = x.select("bucket", F.lit(ROW).alias("kind"), "doc_id", none.alias("near"), "h", "text").unionByName(edges)
    if classes is not None:
        rows = rows.unionByName(classes.select(bucket.alias("bucket"), F.lit(NEAR).alias("kind"), "doc_id", F.col("near_id").alias("near"), none.alias("h"), F.lit(None).cast("string").alias("text")))
    moved = rows.mapInArrow(_packed, _MOVED).repartition(partitions(spark), "bucket")
    moved = moved.sortWithinPartitions("bucket", F.col("kind") == EDGE, F.col("doc_id").desc_nulls_last(), "kind", F.col("h").desc())
    return moved.mapInArrow(_walked, _SCHEMA)


def _banded(batches):
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        for at in range(0, len(texts), SLICE):
            got = embed(texts[at : at + SLICE])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, SLICE), pa.array(list(map(told, got)), pa.string()), pa.array(list(map(bands, got)), pa.list_(pa.int64()))], ["doc_id", "fingerprint", "bands"]
            )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, bands) of each row."""
    return bound(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(_banded, "doc_id bigint, fingerprint string, bands array<bigint>")


def equal_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, same_as) of each row with doc_id: same_as is the smallest doc_id with the very same text (null counts as empty)."""
    rows = bound(docs, {"doc_id": "bigint", "text": "string"}).where("doc_id is not null").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return spread_join(rows, rows.groupBy("text_sha256").agg(F.min("doc_id").alias("same_as")), "text_sha256").select("doc_id", "text_sha256", "same_as")


def _cell_pairs(least):
    """Of one cell of a band: pairs of its two sides (within one side if both are the same) at the first band that the two share."""

    def run(x: pd.DataFrame) -> pd.DataFrame:
        band = int(x["band"].iloc[0])
        rows = [(k, i, read(f), set(map(int, b)), side) for k, i, f, b, side in zip(x["key"], x["doc_id"], x["fingerprint"], x["bands"], x["side"])]
        one, two = [r for r in rows if r[4] == 0], [r for r in rows if r[4] == 1]
        out = []
        pairs = itertools.combinations(one, 2) if x["lo"].iloc[0] == x["hi"].iloc[0] else ((p, q) for p in one for q in two)
        for p, q in pairs:
            if min(p[3] & q[3]) != band:
                continue
            like = likeness(p[2], q[2])
            if like >= least:
                p, q = sorted((p, q), key=lambda r: (r[1], r[0]))
                out.append((p[0], q[0], p[1], q[1], like))
        return pd.DataFrame(out, columns=["ka", "kb", "a", "b", "likeness"])

    return run


def near_pairs(docs: DataFrame, least: float = 0.4, most_edits: int = 200, edit_share: float = 0.1) -> DataFrame:
    """(a, b, likeness, edits): different texts whose fingerprints share a band, verified by likeness and by edit distance, which
    may be most_edits, or edit_share of the longer text if that is more.

    Equal texts meet as one, represented by the smallest doc_id (equal_texts tells which); fingerprints that are equal for different
    texts stay apart. All rows of a band meet: a band is cut into salted groups of about CELL rows, and each two
    groups, and each group with itself, are one cell. The cells of a band are as many as the square of its groups."""
    t = bound(docs, {"doc_id": "bigint", "text": "string"}).where("doc_id is not null").withColumn("text", F.coalesce("text", F.lit("")))
    one = settle(t.groupBy(F.sha2("text", 256).alias("key")).agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text")))
    prints = one.select("key", "doc_id", "text").mapInArrow(_banded_keys, "key string, doc_id bigint, fingerprint string, bands array<bigint>")
    each = settle(prints.select("key", "doc_id", "fingerprint", "bands", F.explode(F.array_distinct("bands")).alias("band")))
    count = each.groupBy("band").agg(F.ceil(F.count("*") / CELL).cast("int").alias("groups"), F.count("*").alias("n")).where("n > 1").drop("n")
    own = spread_join(each, count, "band").withColumn("g", F.pmod(F.xxhash64("key"), F.col("groups")).cast("int"))
    cells = own.withColumn("h", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    cells = cells.select("key", "doc_id", "fingerprint", "bands", "band", F.least("g", "h").alias("lo"), F.greatest("g", "h").alias("hi"), F.when(F.col("g") > F.col("h"), 1).otherwise(0).alias("side"))
    pairs = cells.groupBy("band", "lo", "hi").applyInPandas(_cell_pairs(least), "ka string, kb string, a bigint, b bigint, likeness double")
    texts = one.select("key", "text")
    both = pairs.join(texts.toDF("ka", "ta"), "ka").join(texts.toDF("kb", "tb"), "kb")
    bound_of = F.greatest(F.lit(most_edits), (F.greatest(F.char_length("ta"), F.char_length("tb")) * edit_share).cast("int"))
    return both.withColumn("most", bound_of).withColumn("edits", F.expr("levenshtein(ta, tb, most)")).where("edits >= 0").select("a", "b", "likeness", "edits")


def _banded_keys(batches):
    for b in batches:
        texts = [t or "" for t in b.column(2).to_pylist()]
        for at in range(0, len(texts), SLICE):
            got = embed(texts[at : at + SLICE])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, SLICE), b.column(1).slice(at, SLICE), pa.array(list(map(told, got)), pa.string()), pa.array(list(map(bands, got)), pa.list_(pa.int64()))], ["key", "doc_id", "fingerprint", "bands"]
            )
