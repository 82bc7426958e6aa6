"""Near duplicates by an LSH forest over MinHash signatures.

A text's set: the distinct shingles of five words (white-space words, A-Z lower-cased); with fewer
words, the whole sequence as one shingle; without words (or null), empty and linked with nothing.

1. One pass over the texts gives each row its set's size, a 128-bit digest and a signature of TREES * BASE
   minima. Rows with equal sets meet by digest, and only the smallest doc_id of each goes on.
2. Each tree sorts all signatures in an order of its own (a range exchange by tree, label, id: ties of a label
   spread over tasks). In a sorted run the candidates are rows that share a prefix; its depth adapts to the
   region: the smallest depth of DEPTHS at which at most REGION rows share it. Rows that still are more at full depth are
   compared with their nearest neighbours. Regions of more than REGION rows at depth EXACT, and those at a task's border, are kept
   for step 4.
3. Candidates pass a 128-bit sketch (agreement far below what the threshold allows is dropped: six standard
   deviations), then links are confirmed on the full sets. First the best partner of each row, then every candidate
   pair whose ends aren't yet in one component.
4. Kept regions that hold rows of several components: each row outside the largest component meets all others there in cells of
   bounded size that compare full sets and give out confirmed links only. This is exact for rows that share a prefix of depth EXACT.

Two sets at a similarity of 0.85 share a prefix of depth 4 in none of 24 trees with probability 2e-8, one of depth 6 with 1e-5; at 0.8
with 3e-6 and 7e-4. Regions of more than REGION rows at depth 4 thus lose such a pair with 1e-5 (7e-4) at most, whatever their size, and
only if no chain of other links joins the two. Repeated rows count as equal sets; a repeated doc_id with
different texts is one node with all its sets' links. Rows without doc_id link with nothing and get no component. Null counts as empty;
an empty table gives no rows; columns besides doc_id and text are left aside.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, blocks, bound, buffers, grams, keys, mix, partitions, ranges, semi, settle, spread_join, words

SHINGLE = 5
TREES, BASE = 24, 4
DEPTHS = (4, 6, 8, 10)
REGION = 16
#: Rows of regions that are dense at this depth meet exactly in step 4.
EXACT = 6
#: Bits of two sketches that agree at least (of 128). At similarity s a bit agrees with probability (1 + s) / 2.
SKETCH = 128
#: Rows of a sorted run in one task.
RUN_ROWS = 400_000
#: Edges that one task contracts.
LOCAL_EDGES = 500_000


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE):
    """The sorted distinct shingle hashes of each text, one after another, and their counts."""
    hashes, at, _ = words(data, offs, SPACED)
    n = np.diff(at)
    full = grams(hashes, k)
    out, sizes = [], np.zeros(len(n), np.int64)
    factor = keys(7, k) | np.uint64(1)
    for d in range(len(n)):
        if n[d] >= k:
            x = np.unique(full[at[d] : at[d + 1] - k + 1])
        elif n[d]:
            x = mix((hashes[at[d] : at[d + 1]] * factor[: n[d]]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n[d]))
        else:
            continue
        sizes[d] = len(x)
        out.append(x)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def _signatures(batches, k):
    multiply = (keys(11, max(TREES * BASE, SKETCH)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    for b in batches:
        data, offs = buffers(b.column(1))
        for i, j in blocks(offs):
            sets, sizes = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
            some = np.flatnonzero(sizes)
            hi = np.zeros(j - i, np.int64)
            lo = np.zeros(j - i, np.int64)
            sig = [None] * (j - i)
            if len(some):
                first = np.cumsum(sizes[some]) - sizes[some]
                half = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
                low = np.empty((len(some), len(multiply)), np.uint32)
                buf = np.empty_like(half)
                for m, a in enumerate(multiply):
                    np.multiply(half, a, out=buf)
                    low[:, m] = np.minimum.reduceat(buf, first)
                hi[some] = mix(np.add.reduceat(mix(sets), first, dtype=np.uint64) + sizes[some].astype(np.uint64)).view(np.int64)
                lo[some] = mix(np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), first, dtype=np.uint64)).view(np.int64)
                for d, row in zip(some, low):
                    sig[d] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), pa.array(sizes), pa.array(hi), pa.array(lo), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "hi", "lo", "sig"],
            )


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, sig) of each row; the empty set has no signature."""
    return bound(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(lambda it: _signatures(it, shingle), "doc_id bigint, n_shingles bigint, hi bigint, lo bigint, sig binary")


def _labels(batches):
    order = np.array([[(t * BASE + j) % (TREES * BASE) if j < BASE else int(x) for j, x in enumerate([*range(BASE), *(keys(100 + t, DEPTHS[-1] - BASE) % np.uint64(TREES * BASE))])] for t in range(TREES)])
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(n, -1)
        # 16 bits a level, big-endian, so that the order of the bytes is the order of the levels
        short = (mix(sig.astype(np.uint64)) & np.uint64(0xFFFF)).astype(">u2")
        bits = np.packbits((mix(sig[:, :SKETCH].astype(np.uint64) ^ np.uint64(0xA5A5)) & np.uint64(1)).astype(np.uint8), axis=1)
        sketch = np.ascontiguousarray(bits).view(np.int64)
        for t in range(TREES):
            label = np.ascontiguousarray(short[:, order[t]]).view(f"S{2 * DEPTHS[-1]}").ravel()
            raw = label.tobytes()
            w = 2 * DEPTHS[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, t, np.int8)), pa.array([raw[w * i : w * i + w] for i in range(n)], pa.binary()), b.column(0), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])],
                ["tree", "label", "doc_id", "s0", "s1"],
            )


def _agree(a0, a1, b0, b1):
    return SKETCH - np.bitwise_count((a0 ^ b0).view(np.uint64)).astype(np.int64) - np.bitwise_count((a1 ^ b1).view(np.uint64))


def least_agreement(percent: int) -> int:
    """Six standard deviations below the agreement that the threshold lets expect."""
    p = (1 + percent / 100) / 2
    return int(SKETCH * p - 6 * (SKETCH * p * (1 - p)) ** 0.5)


def _neighbours(batches, least):
    """Of one sorted run: candidate pairs, and the rows of regions that are dense at full depth."""
    empty = pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())], ["dense", "a", "b", "x", "y"])
    got = [b for b in batches if b.num_rows]
    if not got:
        yield empty
        return
    t = pa.Table.from_batches(got)
    tree = t["tree"].to_numpy()
    ids, s0, s1 = (t[c].to_numpy() for c in ("doc_id", "s0", "s1"))
    n = len(ids)
    lab = np.frombuffer(b"".join(t["label"].to_pylist()), ">u2").reshape(n, DEPTHS[-1])
    del t, got
    same = (lab[1:] == lab[:-1]) & (tree[1:] == tree[:-1])[:, None]
    lcp = np.where(same.all(axis=1), DEPTHS[-1], np.argmin(same, axis=1)) if n > 1 else np.zeros(0, np.int64)
    pick = np.full(n, -1)  # which of DEPTHS; -1: dense at the last
    run_of = []
    for k, d in enumerate(DEPTHS):
        run = np.concatenate([[0], np.cumsum(lcp < d)])
        size = np.bincount(run)[run]
        pick = np.where((pick < 0) & (size <= REGION), k, pick)
        run_of.append(run)
    pairs = []
    for o in range(1, REGION):
        if o >= n:
            break
        ok = np.zeros(n - o, bool)
        for k in range(len(DEPTHS)):
            ok |= (pick[:-o] == k) & (pick[o:] == k) & (run_of[k][:-o] == run_of[k][o:])
        if o == 1:
            ok |= lcp >= DEPTHS[0]
        elif o == 2:
            ok |= (pick[:-o] < 0) & (run_of[-1][:-o] == run_of[-1][o:])
        i = np.flatnonzero(ok)
        agree = _agree(s0[i], s1[i], s0[i + o], s1[i + o])
        keep = (agree >= least) & (ids[i] != ids[i + o])
        i, agree = i[keep], agree[keep]
        pairs.append((np.minimum(ids[i], ids[i + o]), np.maximum(ids[i], ids[i + o]), agree))
    if pairs:
        a, b, g = (np.concatenate(x) for x in zip(*pairs))
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a), bool)), pa.array(a), pa.array(b), pa.array(g), pa.array(np.zeros(len(a), np.int64))], ["dense", "a", "b", "x", "y"])
    run = run_of[DEPTHS.index(EXACT)]
    # a run at the task's border may go on in the next task
    d = np.flatnonzero((np.bincount(run)[run] > REGION) | (run == 0) | (run == run[-1]))
    if len(d):
        # the region's name: a hash of tree and label, equal for its parts in other tasks
        name = np.zeros(len(d), np.uint64)
        for c in range(EXACT):
            name = mix(name + lab[d, c].astype(np.uint64) + np.uint64(1 + c))
        name = mix(name + tree[d].astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(d), bool)), pa.array(name), pa.array(ids[d]), pa.array(s0[d]), pa.array(s1[d])], ["dense", "a", "b", "x", "y"])
    yield empty


def forest(reps: DataFrame, percent: int) -> DataFrame:
    """(dense, a, b, x, y): candidate pairs a < b with x agreeing bits, or (dense) region a, its row b, sketch x, y."""
    spark = reps.sparkSession
    rows = reps.select("doc_id", "sig").mapInArrow(_labels, "tree tinyint, label binary, doc_id bigint, s0 bigint, s1 bigint")
    n = max(partitions(spark), reps.count() * TREES // RUN_ROWS + 1)
    run = rows.repartitionByRange(n, "tree", "label", "doc_id").sortWithinPartitions("tree", "label", "doc_id")
    least = least_agreement(percent)
    return run.mapInArrow(lambda it: _neighbours(it, least), "dense boolean, a bigint, b bigint, x bigint, y bigint")


def _sets(batches, k):
    for b in batches:
        data, offs = buffers(b.column(1))
        for i, j in blocks(offs):
            sets, sizes = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
            arr = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), arr], ["doc_id", "shingles"])


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets satisfy 100 * intersection >= percent * union."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = semi(bound(docs, {"doc_id": "bigint", "text": "string"}), ids, "doc_id")
    sets = texts.mapInArrow(lambda it: _sets(it, shingle), "doc_id bigint, shingles array<bigint>")
    one = pairs.select("a", "b").join(sets.toDF("a", "sa"), "a")
    both = one.join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b").distinct()


def _contracted(batches):
    """Stars of the components of one task's edges: labels fall to the smallest node, with pointer jumping."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    nodes, at = np.unique(np.concatenate([t["u"].to_numpy(), t["v"].to_numpy()]), return_inverse=True)
    a, b = at[: t.num_rows], at[t.num_rows :]
    up = np.arange(len(nodes))
    while True:
        ra, rb = up[a], up[b]
        if (ra == rb).all():
            break
        m = np.minimum(ra, rb)
        np.minimum.at(up, ra, m)
        np.minimum.at(up, rb, m)
        while (up[up] != up).any():
            up = up[up]
    child = np.flatnonzero(up != np.arange(len(nodes)))
    for i in range(0, len(child), 100_000):
        k = child[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[k]), pa.array(nodes[up[k]])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the smallest node that it reaches.

    Tasks of at most about LOCAL_EDGES edges first contract what they hold to stars. If that took more than one task, large and
    small stars in turn join these until nothing changes; every round is checkpointed, and hubs are joined with exchanges
    that adaptive execution can split."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    parts = e.count() // LOCAL_EDGES + 1
    e = settle(e.repartition(parts).mapInArrow(_contracted, "u bigint, v bigint"))
    return _starred(e if parts == 1 else _joined_stars(e))


def _starred(e: DataFrame) -> DataFrame:
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _joined_stars(e: DataFrame) -> DataFrame:
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = spread_join(both.where("v > u"), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        e = settle(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return e


def _rooted(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs with the roots ra and rb of their ends."""
    x = spread_join(pairs, comp.toDF("a", "ra"), "a", "left")
    x = spread_join(x, comp.toDF("b", "rb"), "b", "left")
    return x.withColumn("ra", F.coalesce("ra", "a")).withColumn("rb", F.coalesce("rb", "b"))


def near_dedup(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs (doc_id, text); other columns are left aside."""
    sig = settle(signatures(docs, shingle))
    some = sig.where("sig is not null and doc_id is not null")
    groups = some.groupBy("hi", "lo").agg(F.min_by(F.struct("doc_id", "sig"), "doc_id").alias("r")).select("hi", "lo", "r.*")
    groups = settle(groups)
    found = settle(forest(groups, percent))
    pairs = settle(found.where("not dense").groupBy("a", "b").agg(F.max("x").alias("x")))
    best = settle(pairs.groupBy("b").agg(F.max_by("a", F.struct("x", -F.col("a"))).alias("a")).select("a", "b"))
    edges = settle(confirmed(docs, best, percent, shingle))
    comp = components(edges)
    rest = settle(_rooted(pairs, comp).where("ra <> rb").select("a", "b"))
    if rest.take(1):
        edges = settle(edges.unionByName(confirmed(docs, rest, percent, shingle)))
        comp = components(edges)

    def full(ids):
        texts = semi(bound(docs, {"doc_id": "bigint", "text": "string"}), ids, "doc_id")
        return texts.mapInArrow(lambda it: _sets(it, shingle), "doc_id bigint, shingles array<bigint>").dropDuplicates(["doc_id"])

    more = dense_links(found.where("dense").select(F.col("a").alias("region"), F.col("b").alias("doc_id")), comp, full, _cell_links(percent))
    # a repeated id with several sets ties these together
    repeated = settle(some.groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("m"), F.max(F.struct("hi", "lo")).alias("x")).where("m <> x").select("doc_id"))
    if repeated.take(1):
        reps = groups.select("hi", "lo", F.col("doc_id").alias("b"))
        tied = spread_join(semi(some.select("doc_id", "hi", "lo"), repeated, "doc_id"), reps, ["hi", "lo"]).select(F.col("doc_id").alias("a"), "b")
        more = tied if more is None else more.unionByName(tied)
    if more is not None:
        comp = components(settle(edges.unionByName(more)))
    comp = settle(comp)
    top = spread_join(groups.select("hi", "lo", "doc_id"), comp.toDF("doc_id", "root"), "doc_id", "left").select("hi", "lo", F.coalesce("root", "doc_id").alias("component_id"))
    out = spread_join(sig.drop("sig"), top, ["hi", "lo"], "left")
    alone = F.col("n_shingles") == 0
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint")).when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


#: Rows of one cell of step 4, on either side.
CELL_ODD, CELL_ROWS = 2000, 500


def _cell_links(percent):
    """Of one cell: a link from each row to each other component among the odd rows that it is similar to, by counting common shingles exactly."""

    def run(odd: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(odd) and len(rows):
            sizes = odd["shingles"].map(len).to_numpy()
            flat = np.concatenate(odd["shingles"].to_numpy())
            owner = np.repeat(np.arange(len(odd)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            ids, roots = odd["doc_id"].to_numpy(), odd["root"].to_numpy()
            for doc, root, own in zip(rows["doc_id"], rows["root"], rows["shingles"]):
                a, b = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                common = np.bincount(owner[ranges(a, b - a)], minlength=len(odd))
                hit = np.flatnonzero((100 * common >= percent * (sizes + len(own) - common)) & (roots != root))
                _, one = np.unique(roots[hit], return_index=True)
                out += [(doc, x) for x in ids[hit[one]]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def dense_links(rows, comp, full, links):
    """Step 4: links (a, b) between components inside regions of rows (region, doc_id), or None without such regions. Regions with the same largest component form
    a group; the rows outside that component meet all rows of the group in cells of bounded size. full(ids) gives what links(odd rows, rows) compares
    in a cell, by doc_id; only confirmed links come out."""
    if not rows.take(1):
        return None
    rows = settle(spread_join(rows.select("region", "doc_id").distinct(), comp.toDF("doc_id", "root"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id")))
    parts = rows.groupBy("region", "root").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("region").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("region", "main")
    own = settle(spread_join(rows, mixed, "region").select("main", "doc_id", "root").distinct())
    odd = own.where("root <> main")
    count = own.groupBy("main").agg(F.ceil(F.count("*") / CELL_ROWS).cast("bigint").alias("nr"), F.ceil(F.count_if(F.col("root") != F.col("main")) / CELL_ODD).cast("bigint").alias("no")).where("no > 0")
    count = settle(count)
    if not count.take(1):
        return None
    ids = own.select("doc_id").distinct()
    sets = settle(full(settle(ids)))
    place = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n))
    left = spread_join(odd, count, "main").select("main", "doc_id", "root", place("no").alias("o"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nr") - 1)).alias("r")).join(sets, "doc_id")
    right = spread_join(own, count, "main").select("main", "doc_id", "root", place("nr").alias("r"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("no") - 1)).alias("o")).join(sets, "doc_id")
    cell = ["main", "o", "r"]
    both = left.withColumn("odd", F.lit(True)).unionByName(right.withColumn("odd", F.lit(False)))
    return both.groupBy(*cell).applyInPandas(lambda x: links(x[x["odd"]], x[~x["odd"]]), "a bigint, b bigint")


def kept_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, all columns: one of each component. Rows without an id or without words stay; of rows with words
    that repeat the id that stays, the one with the smallest text stays."""
    told = near_dedup(docs, percent).where("doc_id is not null").groupBy("doc_id").agg(F.bool_or(~F.col("kept")).alias("gone"), F.count_if(F.col("n_shingles") > 0).alias("n"))
    told = settle(told.where("gone or n > 1"))
    out = semi(docs, told.select("doc_id"), "doc_id", "left_anti")
    again = settle(told.where("not gone").select("doc_id"))
    if not again.take(1):
        return out
    rows = semi(docs, again, "doc_id")
    some = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = rows.where(some).groupBy("doc_id").agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), "text").alias("__row")).select("__row.*")
    return out.unionByName(one.select(*docs.columns)).unionByName(rows.where(~some).select(*docs.columns))
