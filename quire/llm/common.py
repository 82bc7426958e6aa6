"""Helpers that the operators share: checkpoints, joins behind a size check, byte kernels.

The byte kernels work on Arrow string buffers (UTF-8) with numpy and take sub-batches of a
bounded number of bytes, so that memory doesn't follow the size of an Arrow batch.
"""

from __future__ import annotations

import re
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that may be broadcast as a join side (8 bytes each); beyond it the join shuffles.
MAX_BROADCAST_ROWS = 1_000_000
#: Bytes of text that a kernel expands into numpy arrays at a time (one longer text goes alone).
BLOCK_BYTES = 1 << 20


#: Bytes of an Arrow batch on its way to Python; rows are many or few as their texts are short or long.
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what the context was given. Where neither is set, a
    session that is one process (local[n], as in tests) gets a temporary folder; on a cluster that would be lost with its machine,
    so there it is an error."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if at is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp("quire")
        sc.setCheckpointDir(at)
    return at


def settle(df: DataFrame) -> DataFrame:
    """df, cut off from its lineage by a checkpoint in the folder that all executors share."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession) -> None:
    """From now on this session's Arrow batches end at BATCH_BYTES, unless it already has a smaller bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    had = spark.conf.get(name, None)
    if had is None or not had.isdigit() or not 0 < int(had) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def semi(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of df whose key is in ids (one column, named key): broadcast if ids are few enough, else shuffled."""
    few = ids.count() <= MAX_BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids, key, how)


def spread_join(big: DataFrame, keyed: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side that has one row a key. The round-robin exchange takes away the aggregate's
    partitioning, so that both sides get a plain exchange and adaptive execution can split hot keys."""
    return big.join(keyed.repartition(partitions(big.sparkSession)), on, how)


def bound(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the named columns of df, cast, on their way to Python in bounded batches; other columns can't clash with a kernel's own."""
    bounded_batches(df.sparkSession)
    return df.select(*(F.col(k).cast(v).alias(k) for k, v in names.items()))


def own_text(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


# ---------------------------------------------------------------- Arrow and numpy


def buffers(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its len + 1 offsets; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = arr.cast(pa.large_string()).fill_null("")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, most: int = BLOCK_BYTES):
    """(first, last + 1) row ranges of at most so many bytes, one row at least."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (public splitmix constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed) * np.uint64(0xD1342543DE82EF95))


_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: A value for each byte; A-Z count as a-z.
BYTE_KEYS = keys(1, 256)[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = np.arange(256)
#: Bytes of words: all but ASCII white space; ASCII letters and digits and all other characters.
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (case of A-Z aside), where the words of each text begin in that list, the words' first bytes."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64), np.zeros(0, np.int64)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offs[:-1][offs[:-1] < len(data)]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64), starts
    at = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    power = np.full(int(at.max()) + 1, _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    value = np.where(inside[starts[0] :], BYTE_KEYS[data[starts[0] :]] * power[at], np.uint64(0))
    return mix(np.add.reduceat(value, starts - starts[0], dtype=np.uint64)), np.searchsorted(starts, offs), starts


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k successive words (across texts too: the caller leaves those out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = keys(7, k) | np.uint64(1)
    out = hashes[:n] * factor[0]
    for j in range(1, k):
        out += hashes[j : j + n] * factor[j]
    return mix(out)


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of many runs, one after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


def code_points(raw: bytes, at) -> list[int]:
    """Byte offsets of one UTF-8 text as offsets in code points."""
    seen = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [int(seen[x - 1]) if x else 0 for x in at]


def joined_spans(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
