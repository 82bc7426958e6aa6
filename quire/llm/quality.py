"""Document quality by supervised subword embeddings.

Features of a text are hashed into 2^BITS buckets: words, pairs of words (with one bucket for a word said twice in a row),
byte 3- and 4-grams, and 4-grams of character classes. A text's vector is the mean of its features' vectors; a
softmax layer tells the label. Vectors and layer are trained by stochastic gradient descent in numpy on the driver, over a
bounded, balanced sample: at most SAMPLE labelled rows (a documented parameter), chosen by a hash of the id. Executors send only
(bucket, count) pairs of these rows. A quarter of the sample calibrates the score (Platt, weighted to the share of labels
over all training rows).

As the layer is linear in the mean, scoring needs one number a bucket: the model that executors get has 2^BITS
floats, whatever the input. Every whole text is scored; an empty or null text gets the calibrated score of a zero vector. A row's
score depends on its text alone, so repeated rows have equal scores. A document with several labels counts with the largest.
Without labels of both kinds, the score is the share of label 1 (0.5 without labels). An empty table gives no rows; labels of
documents that aren't there and rows without doc_id (never held out) teach nothing; columns besides doc_id and text are left aside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, blocks, bound, bounded_batches, buffers, grams, keys, words

BITS, DIM = 18, 8
SAMPLE = 2400
EPOCHS, RATE = 8, 12.0
THRESHOLD = 0.7

_CLASS = np.full(256, 9)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 3
for _i, _c in enumerate(" \n.,!|", 4):
    _CLASS[ord(_c)] = _i if _c != "|" else 10
_GRAMS = [(3, keys(21, 3 * 256).reshape(3, 256)), (4, keys(22, 4 * 256).reshape(4, 256)), (4, keys(23, 4 * 256).reshape(4, 256)[:, _CLASS])]
_REPEAT = np.uint64(0x1234567890ABCDEF)


def _features(data: np.ndarray, offs: np.ndarray):
    """Runs of buckets in text order: for each family, bucket ids, and where each text's begin and end in them."""
    shift = np.uint64(64 - BITS)
    for n, tables in _GRAMS:
        m = len(data) - n + 1
        if m > 0:
            h = tables[0][data[:m]]
            for j in range(1, n):
                h = h + tables[j][data[j : j + m]]
            ends = np.maximum(offs[1:] - n + 1, offs[:-1])
            yield (h >> shift).astype(np.int32), np.minimum(offs[:-1], m), np.minimum(ends, m)
    h, at, _ = words(data, offs, SPACED)
    yield (h >> shift).astype(np.int32), at[:-1], at[1:]
    if len(h) > 1:
        pair = np.where(h[1:] == h[:-1], _REPEAT, grams(h, 2))
        ends = np.maximum(at[1:] - 1, at[:-1])
        yield (pair >> shift).astype(np.int32), np.minimum(at[:-1], len(pair)), np.minimum(ends, len(pair))


def _margins(arr, weights: np.ndarray) -> np.ndarray:
    data, offs = buffers(arr)
    out = np.zeros(len(offs) - 1)
    for i, j in blocks(offs):
        total, count = np.zeros(j - i), np.zeros(j - i)
        for ids, a, b in _features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]):
            some = np.flatnonzero(b > a)
            if len(some):  # each text by itself, so that its sum doesn't depend on what else is in the block
                x = np.append(weights[ids].astype(np.float64), 0.0)
                total[some] += np.add.reduceat(x, np.stack([a[some], b[some]], axis=1).ravel())[::2]
            count += b - a
        out[i:j] = total / np.maximum(count, 1)
    return out


def _bags(batches):
    for b in batches:
        data, offs = buffers(b.column(1))
        for i, j in blocks(offs):
            runs = list(_features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]))
            got = [np.unique(np.concatenate([ids[s[d] : e[d]] for ids, s, e in runs]), return_counts=True) for d in range(j - i)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array([x.astype(np.int32).tobytes() for x, _ in got], pa.binary()), pa.array([c.astype(np.int32).tobytes() for _, c in got], pa.binary())],
                ["doc_id", "label", "ids", "counts"],
            )


class Model:
    """weights: one number a bucket; score = sigmoid(scale * mean + offset)."""

    def __init__(self, weights: np.ndarray, scale: float, offset: float):
        self.weights, self.scale, self.offset = weights, scale, offset

    def scores(self, arr) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * _margins(arr, self.weights) + self.offset, -30, 30)))


def train(bags: list[tuple[np.ndarray, np.ndarray, int]], share: float, seed: int = 5) -> Model:
    """bags: (buckets, counts, label), in a fixed order; share: of label 1 among all training rows."""
    base = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    if len({y for *_, y in bags}) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 1.0, base)
    rng = np.random.default_rng(seed)
    emb = ((rng.random((1 << BITS, DIM)) - 0.5) * 2 / DIM).astype(np.float32)
    layer = np.zeros((2, DIM), np.float32)
    held = [x for i, x in enumerate(bags) if i % 4 == 3]
    own = [x for i, x in enumerate(bags) if i % 4 != 3] if held else bags
    rows = [(ids, (c / max(1, c.sum())).astype(np.float32), y) for ids, c, y in own]
    steps, at = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            ids, share_of, y = rows[k]
            rate = RATE * (1 - at / steps)
            at += 1
            v = share_of @ emb[ids]
            z = layer @ v
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ layer
            layer -= 0.1 * rate * np.outer(p, v)
            emb[ids] -= (rate * share_of)[:, None] * back[None, :]
    weights = emb @ (layer[1] - layer[0])
    x = np.array([float((c / max(1, c.sum())) @ weights[ids]) for ids, c, _ in held or bags])
    y = np.array([l for *_, l in held or bags], float)
    w = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    sd = x.std() or 1.0
    a, b, xs = 1.0, base, (x - x.mean()) / sd
    soft = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(400):
        g = w * (soft - 1 / (1 + np.exp(-(a * xs + b))))
        a, b = a + 0.5 * float((g * xs).mean()), b + 0.5 * float(g.mean())
    return Model(weights.astype(np.float32), a / sd, b - a * float(x.mean()) / sd)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from labels (doc_id, label 0/1) of rows that aren't held out; rows without label or id are left aside."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    pick = None
    for y in (0, 1):
        part = known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(sample // 2)
        pick = part if pick is None else pick.unionByName(part)
    ids = [(r["doc_id"], r["label"]) for r in pick.collect()]  # at most sample rows
    if not ids:
        return Model(np.zeros(1 << BITS, np.float32), 1.0, 0.0)
    spark = docs.sparkSession
    ids = spark.createDataFrame(ids, "doc_id bigint, label int")
    rows = bound(docs, {"doc_id": "bigint", "text": "string"}).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")
    got = rows.mapInArrow(_bags, "doc_id bigint, label int, ids binary, counts binary").orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id", "ids").limit(2 * sample).collect()
    bags = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.int32), r["label"]) for r in got]
    return train(bags, counts.get(1, 0) / n)


def score(model: Model, spark):
    """A column function from text to score."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def scores(text: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(text))

    return F.arrow_udf(scores, "double")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs."""
    f = score(fit(docs, labels), docs.sparkSession)
    x = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), f(F.col("text").cast("string")).alias("score"))
    return x.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier doesn't reject, all columns."""
    f = score(fit(docs, labels), docs.sparkSession)
    own = "__quality"
    return docs.withColumn(own, f(F.col("text").cast("string"))).where(F.col(own) >= THRESHOLD).drop(own)
