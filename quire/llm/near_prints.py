"""Classes of like fingerprints: bit-sampled banding of the edit embedding and verification.

Two texts are linked if they are equal, or if their fingerprints agree in a band and their likeness is at least `least`. A band is
BAND slots of four bits, sampled evenly over the walk as far as the middle of a stratum; each text has BANDS bands that end in the
last stratum that its walk fills half, and BANDS that end one lower, so texts at a stratum's border meet. A slot of like texts agrees
with probability 0.9 + 0.1 / 16 at a likeness of 0.9, so a pair there shares none of BANDS bands with probability 3e-3 (computed for
independent slots); slots of unlike texts agree about once in eight, so a band of 5e10 texts gives less than one row by chance.

1. Equal texts meet by hash, and only one row of each goes on, so a group of copies is one row.
2. Bands are sorted (a range exchange by band and id: a hot band spreads over tasks). In a run of one band each row meets the
   row before it; likenesses of these pairs give components. This is done for the FIRST bands of either end alone, then for all
   bands; there only rows of different components meet, so a group of near copies, whose rows share all of their bands, is given out by few of these.
3. Runs that may hold more links (three rows or more of several components, or at a task's border) and still lie in several
   components are finished in cells of bounded size: each row outside the largest component meets all rows of the run. No link of a band is lost.

Null counts as empty; empty texts are equal to each other. A text of fewer than LOWEST / 2 steps has no band and is linked with
equal ones only. A repeated doc_id is one node with all its texts' links; rows without doc_id have no class. An empty table gives no rows; columns besides
doc_id and text are left aside.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound, keys, mix, partitions, settle, spread_join
from .fingerprints import LOWEST, SLICE, SLOTS, embed, likeness, steps_to
from .near_dedup import components, dense_links

BAND, BANDS = 12, 16
#: Bands of either end whose rows meet before those of all bands.
FIRST = 2
#: Likeness from which two fingerprints are linked.
LEAST = 0.9
#: Band rows of a sorted run in one task.
RUN_ROWS = 400_000

_PRINTS = "doc_id bigint, hi bigint, lo bigint, steps bigint, slots binary"
_PAIRS = "dense boolean, a bigint, b bigint"


def _printed(batches):
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            texts = [t or "" for t in part.column(1).to_pylist()]
            got = embed(texts)
            sums = np.frombuffer(b"".join(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()[:16] for t in texts), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array([e for e, _ in got], pa.int64()), pa.array([_dense(s) for _, s in got], pa.binary())],
                ["doc_id", "hi", "lo", "steps", "slots"],
            )


def _dense(slots: np.ndarray) -> bytes:
    """Two slots a byte; an odd last one is followed by 0."""
    even = np.append(slots, np.uint8(0)) if len(slots) % 2 else slots
    return (even[::2] << 4 | even[1::2]).astype(np.uint8).tobytes()


def _print(steps: int, raw: bytes) -> tuple[int, np.ndarray]:
    two = np.frombuffer(raw, np.uint8)
    at, _, _ = steps_to(steps)
    return steps, np.stack([two >> 4, two & 15], axis=1).ravel()[: np.searchsorted(at, steps)]


@functools.lru_cache(128)
def _picks(last: int) -> np.ndarray:
    """Slots of each band that ends in the middle of stratum `last`: for steps drawn evenly from the walk before that, the slots next to them."""
    at, _, bounds = steps_to(LOWEST << last)
    pool = at[at < sum(bounds[last]) // 2]
    drawn = (keys(200 + last, BANDS * BAND) % np.uint64(sum(bounds[last]) // 2)).astype(np.int64)
    return np.minimum(np.searchsorted(pool, drawn), len(pool) - 1).reshape(BANDS, BAND)


def wide_bands(fp: tuple[int, np.ndarray]) -> np.ndarray:
    """The bands of a fingerprint, none if its walk is too short."""
    end, slots = fp
    if end < LOWEST // 2:
        return np.zeros(0, np.int64)
    _, _, bounds = steps_to(end)
    top = max(k for k, (lo, hi) in enumerate(bounds) if end >= (lo + hi) // 2)
    out = []
    for last in sorted({top, max(0, top - 1)}):
        value = (slots[_picks(last)].astype(np.uint64) << (np.uint64(4) * np.arange(BAND, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
        out.append(mix(value ^ keys(300 + last, BANDS)))
    return np.concatenate(out).view(np.int64)


def _bands(first: bool):
    """(band, doc_id, root) of each text, of the FIRST bands or of all."""

    def run(batches):
        for b in batches:
            ids, roots = b.column(0), b.column(1)
            each = [wide_bands(_print(e, s)) for e, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            if first:
                each = [x.reshape(-1, BANDS)[:, :FIRST].ravel() for x in each]
            if each:
                row = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(each)), ids.take(row), roots.take(row)], ["band", "doc_id", "root"])

    return run


def _runs(batches):
    """Of one sorted run of (band, doc_id, root): pairs of different roots (each row with the one before it), and the rows of bands that
    need cells."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    band, ids = t["band"].to_numpy(), t["doc_id"].to_numpy()
    root = pc.coalesce(t["root"], t["doc_id"]).to_numpy()
    new = np.append(True, band[1:] != band[:-1])
    run = np.cumsum(new) - 1
    at = np.flatnonzero(~new)
    at = at[root[at - 1] != root[at]]
    a, b = at - 1, at
    pairs = np.unique(np.stack([np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])], axis=1), axis=0)
    several = np.zeros(run[-1] + 1, bool)
    several[run[b]] = True
    d = np.flatnonzero(several[run] & (np.bincount(run)[run] > 2) | (run == 0) | (run == run[-1]))
    for dense, x, y in ((False, pairs[:, 0], pairs[:, 1]), (True, band[d], ids[d])):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), dense)), pa.array(x), pa.array(y)], ["dense", "a", "b"])


def _verified(least):
    def run(batches):
        for b in batches:
            c = [x.to_pylist() for x in b.columns]
            ok = [likeness(_print(ea, sa), _print(eb, sb)) >= least for ea, sa, eb, sb in zip(*c[2:])]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


def _matrix(steps, raws):
    """Fingerprints as one array, filled up with 255, and their numbers of steps."""
    fps = [_print(int(e), r) for e, r in zip(steps, raws)]
    ends = np.array([e for e, _ in fps], np.int64)
    at, _, _ = steps_to(int(ends.max()))
    out = np.full((len(fps), len(at)), 255, np.uint8)
    for k, (_, s) in enumerate(fps):
        out[k, : len(s)] = s
    return ends, out


def _all_alike(end: int, slots: np.ndarray, ends: np.ndarray, many: np.ndarray) -> np.ndarray:
    """likeness of one fingerprint to each of many (slots are filled up with 254, many with 255 to the same width)."""
    at, _, bounds = steps_to(int(max(end, ends.max())))
    top = np.maximum(end, ends)
    lo, hi = np.array(bounds).T
    agree = (many[:, : len(at)] == slots[: len(at)]).reshape(len(many), -1, SLOTS).sum(axis=2)
    below = np.searchsorted(at, top)
    here = np.clip(below[:, None] - np.arange(len(bounds)) * SLOTS, 0, SLOTS)
    share = np.clip(np.minimum(hi, top[:, None]) - lo, 0, None) * (here > 0)
    x = (agree / np.maximum(here, 1) * share).sum(axis=1) / share.sum(axis=1)
    return np.clip((x - 1 / 16) * 16 / 15, 0, 1)


def _cell_links(least):
    """Of one cell: a link from each row to each other component among the odd rows that it is like."""

    def run(odd: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(odd) and len(rows):
            both = pd.concat([odd, rows])
            ends, slots = _matrix(both["steps"], both["slots"])
            n = len(odd)
            ids, roots = odd["doc_id"].to_numpy(), odd["root"].to_numpy()
            for doc, root, end, own in zip(rows["doc_id"], rows["root"], ends[n:], slots[n:]):
                like = _all_alike(int(end), np.where(own == 255, 254, own), ends[:n], slots[:n])
                # the plain likeness decides where rounding might
                hit = [k for k in np.flatnonzero((like >= least - 1e-9) & (roots != root)) if like[k] >= least + 1e-9 or likeness((int(end), own[own < 16]), (int(ends[k]), slots[k][slots[k] < 16])) >= least]
                _, one = np.unique(roots[hit], return_index=True)
                out += [(doc, ids[hit[k]]) for k in one]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def near_classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, near_id) of each doc_id whose class has a smaller one: near_id is the smallest doc_id that links reach."""
    spark = docs.sparkSession
    prints = settle(bound(docs, {"doc_id": "bigint", "text": "string"}).where("doc_id is not null").mapInArrow(_printed, _PRINTS))
    top = F.struct("steps", "slots")
    one = settle(prints.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"), F.first(top).alias("p")).select("hi", "lo", "doc_id", "p.*"))
    fp = one.select("doc_id", "steps", "slots")
    rows = one.count()

    def met(first, comp):
        """What _runs gives for the FIRST bands or all, with the components of comp."""
        own = fp.withColumn("root", F.lit(None).cast("bigint")) if comp is None else spread_join(fp, comp.where("node <> root").toDF("doc_id", "root"), "doc_id", "left")
        n = max(partitions(spark), rows * 2 * (FIRST if first else BANDS) // RUN_ROWS + 1)
        bands = own.select("doc_id", "root", "steps", "slots").mapInArrow(_bands(first), "band bigint, doc_id bigint, root bigint")
        return settle(bands.repartitionByRange(n, "band", "doc_id").sortWithinPartitions("band", "doc_id").mapInArrow(_runs, _PAIRS))

    def linked(found):
        pairs = found.where("not dense").select("a", "b").distinct()
        both = pairs.join(fp.toDF("a", "ea", "sa"), "a").join(fp.toDF("b", "eb", "sb"), "b").select("a", "b", "ea", "sa", "eb", "sb")
        return both.mapInArrow(_verified(least), "a bigint, b bigint")

    edges = settle(linked(met(True, None)))
    found = met(False, components(edges))
    edges = edges.unionByName(linked(found))
    # a repeated id ties its texts together
    several = prints.groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("m"), F.max(F.struct("hi", "lo")).alias("x")).where("m <> x").select("doc_id")
    key = one.select("hi", "lo", F.col("doc_id").alias("b"))
    tied = spread_join(prints.join(several, "doc_id").select(F.col("doc_id").alias("a"), "hi", "lo"), key, ["hi", "lo"]).select("a", "b")
    edges = settle(edges.unionByName(tied))
    comp = settle(components(edges))
    more = dense_links(found.where("dense").select(F.col("a").alias("region"), F.col("b").alias("doc_id")), comp, lambda ids: fp.join(ids, "doc_id"), _cell_links(least))
    if more is not None:
        comp = settle(components(settle(edges.unionByName(more))))
    root = spread_join(key, comp.toDF("b", "root"), "b", "left").select("hi", "lo", F.coalesce("root", "b").alias("near_id"))
    out = spread_join(prints.select("doc_id", "hi", "lo"), root, ["hi", "lo"])
    return out.groupBy("doc_id").agg(F.min("near_id").alias("near_id")).where("near_id < doc_id")
