"""Sampled segmentation of texts into the pieces of a public SentencePiece vocabulary, and lossless decoding.

Each text is a lattice of pieces. The vocabulary is a ranked BPE list, so a piece's probability follows its rank (Zipf); a
character without a piece falls back to its bytes. Forward filtering sums the probabilities of all ways to each place;
backward sampling then draws the last piece, the one before it, and so on. Draws come from a hash of the row's key, the place and the
step: a row gets the same pieces on any machine, in any order and any batch.

No piece goes on from other characters to a blank (models that have such pieces, or no byte pieces, are refused), so the lattice
falls into units (blanks and the word behind them), and filtering runs once for each distinct unit, all new units of a block at
once in numpy; a worker keeps the lattices of the first units that it meets, up to STORE_NODES places. Shares are cumulated place by place,
so nothing of a draw depends on what else is in the block. A blank is U+2581 in pieces; a literal U+2581 is
encoded by its bytes, so decoding gives back every text exactly. Null text gives null; an empty text gives no pieces, an empty table no rows.
Rows without a key are drawn as if their key were 0. Equal keys with equal texts (repeated rows) get equal pieces. Other columns are left aside.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, buffers, keys, mix, ranges

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK, LITERAL = 0x2581, 0x110000
BLOCK_CHARS = 100_000
#: Places in the lattices that a worker keeps (about 100 bytes each).
STORE_NODES = 600_000
#: Units of more characters are filtered one by one.
LONG = 256
_M = np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(0x2545F4914F6CDD1D)


def _hash1(cp: np.ndarray) -> np.ndarray:
    return mix(cp.astype(np.uint64) + _S)


class Vocabulary:
    """The pieces of a model, with a hash table of all their prefixes."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        is_byte = [sp.is_byte(i) for i in range(n)]
        text = [sp.id_to_piece(i) for i in range(n)]
        raw = [bytes([int(text[i][3:5], 16)]) if is_byte[i] else b"" if special[i] else text[i].replace("▁", " ").encode() for i in range(n)]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.len = np.array([len(x) for x in raw])
        self.at = np.cumsum(self.len) - self.len
        own = [i for i in range(n) if not special[i] and not is_byte[i]]
        bytes_of = {raw[i][0]: i for i in range(n) if is_byte[i]}
        if len(bytes_of) < 256 or any("▁" in text[i].lstrip("▁") for i in own):
            raise ValueError("the model needs a piece for each byte and none that goes on from other characters to a blank")
        self.byte_id = np.array([bytes_of[k] for k in range(256)])
        rank = {i: r for r, i in enumerate(own)}
        logs = -np.log(np.arange(len(own)) + 3.0)
        self.byte = float(logs[-1] - np.log(np.exp(logs).sum()) - 2)
        logs -= np.log(np.exp(logs).sum())
        size = np.array([len(text[i]) for i in own])
        self.longest = int(size.max())
        cps = np.frombuffer("".join(text[i].ljust(self.longest, "\0") for i in own).encode("utf-32-le"), np.uint32).reshape(len(own), -1).astype(np.uint64)
        h, found = _hash1(cps[:, 0]), []
        for k in range(self.longest):  # prefixes of k + 1 characters
            live = np.flatnonzero(size > k)
            if k:
                h[live] = mix(h[live] * _M + cps[live, k])
            found.append((h[live].copy(), np.where(size[live] == k + 1, np.array(own)[live], -1), size[live] > k + 1))
        every, piece, more = (np.concatenate(x) for x in zip(*found))
        self.keys, at = np.unique(every, return_inverse=True)
        self.piece, self.more = np.full(len(self.keys), -1), np.zeros(len(self.keys), bool)
        np.maximum.at(self.piece, at, piece)
        np.logical_or.at(self.more, at, more)
        self.logp = np.full(n, -np.inf)
        for i in own:
            self.logp[i] = logs[rank[i]]
        # the first place in keys of each value of the top 16 bits
        self.top = np.searchsorted(self.keys, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
        self.most = int(np.diff(np.append(self.top, len(self.keys))).max())

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes in keys, -1 where they aren't: a short scan from where the top bits point."""
        out = np.full(len(h), -1)
        p = self.top[(h >> np.uint64(48)).astype(np.int64)]
        left = np.arange(len(h))
        for _ in range(self.most):
            k = np.minimum(p, len(self.keys) - 1)
            seen = self.keys[k]
            hit = seen == h[left]
            out[left[hit]] = k[hit]
            go = seen < h[left]
            left, p = left[go], p[go] + 1
            if not len(left):
                break
        return out


@functools.lru_cache(2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def _utf8_len(cp):
    cp = np.where(cp == LITERAL, BLANK, cp)
    return 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)


def _lattice(v: Vocabulary, cps: np.ndarray, starts: np.ndarray, lens: np.ndarray):
    """Edges into each node of all units, longest first: where a node's edges begin, cumulated shares, pieces and where they come from.

    Node n of unit u (0 <= n <= its length) is starts[u] + u + n; cps is the units' characters, one unit after another."""
    unit = np.repeat(np.arange(len(lens)), lens)
    end = starts[unit] + lens[unit]
    p = np.arange(len(cps))
    h = _hash1(cps)
    src, dst, piece, logp = [], [], [], []
    for k in range(1, v.longest + 1):
        at = v.find(h)
        ok = at >= 0
        here = v.piece[np.maximum(at, 0)]
        hit = ok & (here >= 0)
        node = p[hit] + unit[p[hit]]
        src.append(node)
        dst.append(node + k)
        piece.append(here[hit])
        logp.append(v.logp[here[hit]])
        if k == 1 and not hit.all():
            q = p[~hit]
            src.append(q + unit[q])
            dst.append(q + unit[q] + 1)
            piece.append(-1 - cps[q].astype(np.int64))
            logp.append(v.byte * _utf8_len(cps[q]))
        go = ok & v.more[np.maximum(at, 0)] & (p + k < end[p])
        p, h = p[go], h[go]
        if not len(p):
            break
        h = mix(h * _M + cps[p + k].astype(np.uint64))
    src, dst, piece, logp = (np.concatenate(x) for x in (src, dst, piece, logp))
    # by end, longer pieces (mostly the likelier ones) first; each length's edges are in order already, which a merge sort uses
    order = np.argsort(dst * (v.longest + 1) - (dst - src), kind="stable")
    src, dst, piece, logp = src[order], dst[order], piece[order], logp[order]
    nodes = len(cps) + len(lens)
    first_node = starts + np.arange(len(lens))
    rel = (np.arange(nodes) - np.repeat(first_node, lens + 1))[dst]
    short = lens <= LONG
    rel[~np.repeat(short, lens + 1)[dst]] = LONG + 1
    steps = np.argsort(rel.astype(np.uint16), kind="stable")
    cuts = np.searchsorted(rel[steps], np.arange(1, int(lens[short].max(initial=0)) + 2))
    alpha = np.full(nodes, -np.inf)
    alpha[first_node] = 0
    share = np.empty(len(src))
    for r in range(len(cuts) - 1):
        own = steps[cuts[r] : cuts[r + 1]]
        if not len(own):
            continue
        w = alpha[src[own]] + logp[own]
        d = dst[own]
        lead = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        size = np.diff(np.append(lead, len(own)))
        top = np.maximum.reduceat(w, lead)
        x = np.exp(w - np.repeat(top, size))
        total = np.add.reduceat(x, lead)
        alpha[d[lead]] = top + np.log(total)
        share[own] = x / np.repeat(total, size)
    first = np.searchsorted(dst, np.arange(nodes + 1))
    for u in np.flatnonzero(~short):
        a = first_node[u]
        own = first[a : a + lens[u] + 2]
        share[own[0] : own[-1]] = _shares((src[own[0] : own[-1]] - a).tolist(), logp[own[0] : own[-1]].tolist(), (own - own[0]).tolist())
    size = np.diff(first)
    nth = np.arange(len(dst)) - first[dst]
    within = share
    for k in range(1, int(size.max())):  # each place by itself
        own = np.flatnonzero(nth == k) if k == 1 else own[size[dst[own]] > k] + 1
        within[own] += within[own - 1]
    within[first[1:][size > 0] - 1] = 2.0  # the last edge takes what rounding leaves
    return first[:-1], within, piece, src


def _shares(src: list[int], logp: list[float], first: list[int]) -> list[float]:
    """Shares of the edges into each place of one unit."""
    alpha, out = [0.0] * (len(first) - 1), []
    for d in range(1, len(alpha)):
        w = [alpha[src[e]] + logp[e] for e in range(first[d], first[d + 1])]
        top = max(w)
        x = [math.exp(y - top) for y in w]
        total = sum(x)
        alpha[d] = top + math.log(total)
        out += [y / total for y in x]
    return out


class Lattices:
    """Lattices of units, one after another in growing arrays; those of the first STORE_NODES places stay for the next blocks."""

    def __init__(self, v: Vocabulary):
        self.v, self.nodes, self.edges = v, 0, 0
        self.keys, self.home = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._room(1 << 16, 1 << 18)

    def _room(self, nodes: int, edges: int):
        a, b = self.nodes, self.edges
        old = (self.first[:a], self.within[:b], self.piece[:b], self.src[:b]) if a else None
        self.first, self.within = np.empty(nodes, np.int64), np.empty(edges)
        self.piece, self.src = np.empty(edges, np.int32), np.empty(edges, np.int32 if nodes < 1 << 31 else np.int64)
        if old:
            self.first[:a], self.within[:b], self.piece[:b], self.src[:b] = old

    def homes(self, h: np.ndarray, lens: np.ndarray, chars) -> np.ndarray:
        """The first place of each unit. h: hashes of distinct units; chars(k): the characters of units k, one after another."""
        out = np.empty(len(h), np.int64)
        k = np.minimum(np.searchsorted(self.keys, h), max(len(self.keys) - 1, 0))
        known = self.keys[k] == h if len(self.keys) else np.zeros(len(h), bool)
        out[known] = self.home[k[known]]
        new = np.flatnonzero(~known)
        if not len(new):
            return out
        n = lens[new]
        starts = np.cumsum(n) - n
        first, within, piece, src = _lattice(self.v, chars(new), starts, n)
        a, b = self.nodes, self.edges
        most = max(len(self.first), 1 << 16)
        if a + len(first) > most or b + len(piece) > len(self.piece) or most > 4 * max(STORE_NODES, a + len(first)):
            self._room(a + 2 * len(first), b + 2 * len(piece))
        c, d = a + len(first), b + len(piece)
        self.first[a:c], self.within[b:d], self.piece[b:d], self.src[b:d] = first + b, within, piece, src + a
        out[new] = a + starts + np.arange(len(new))
        if c <= STORE_NODES:
            self.nodes, self.edges = c, d
            own = np.concatenate([self.keys, h[new]])
            order = np.argsort(own)
            self.keys, self.home = own[order], np.concatenate([self.home, out[new]])[order]
        return out


@functools.lru_cache(2)
def _store(model: bytes) -> Lattices:
    return Lattices(vocabulary(model))


def _steps(n: int) -> np.uint64:
    return np.uint64(((n + 1) * int(_S)) & 0xFFFFFFFFFFFFFFFF)


def encode_block(store: Lattices, cps: np.ndarray, offs: np.ndarray, row_keys: np.ndarray):
    """Pieces of texts (code points, blanks as they are) as one array of ids and where each text's begin."""
    n_texts = len(offs) - 1
    lens = np.diff(offs)
    some = lens > 0
    # every text but the empty gets a blank before it
    out = np.empty(int(lens.sum() + some.sum()), np.int64)
    new = np.concatenate([[0], np.cumsum(lens + some)])
    out[ranges(new[:-1] + some, lens)] = cps
    out[new[:-1][some]] = 32
    blank = out == 32
    cp = np.where(blank, BLANK, np.where(out == BLANK, LITERAL, out))
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[new[:-1][some]] = True
    u0 = np.flatnonzero(begins)
    if not len(u0):
        return np.zeros(0, np.int64), np.zeros(n_texts + 1, np.int64)
    ulen = np.diff(np.append(u0, len(cp)))
    at = np.arange(len(cp)) - np.repeat(u0, ulen)
    power = np.full(int(at.max()) + 1, _M, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    h = mix(np.add.reduceat(_hash1(cp) * power[at], u0, dtype=np.uint64) + ulen.astype(np.uint64))
    h, where, kind = np.unique(h, return_index=True, return_inverse=True)
    home = store.homes(h, ulen[where], lambda k: cp[ranges(u0[where[k]], ulen[where[k]])])[kind]
    first, within, piece, src = store.first, store.within, store.piece, store.src
    text_of = np.searchsorted(new, u0, side="right") - 1
    unit_no = np.arange(len(u0)) - np.searchsorted(u0, new[text_of])
    seed = mix(mix(row_keys[text_of]) + unit_no.astype(np.uint64) * _M)
    node = home + ulen
    live = np.arange(len(u0))
    got_unit, got_piece, got_step = [], [], []
    step = 0
    while len(live):
        u = (mix(seed[live] + _steps(step)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        e = first[node]
        left = np.flatnonzero(within[e] <= u)
        while len(left):
            e[left] += 1
            left = left[within[e[left]] <= u[left]]
        got_unit.append(live)
        got_piece.append(piece[e])
        got_step.append(step)
        node = src[e]
        go = node != home[live]
        live, node = live[go], node[go]
        step += 1
    count = np.zeros(len(u0), np.int64)
    for x in got_unit:
        count[x] += 1
    base = np.cumsum(count)
    ids = np.empty(int(base[-1]), np.int64)
    for x, y, s in zip(got_unit, got_piece, got_step):
        ids[base[x] - 1 - s] = y
    ends = np.concatenate([[0], base])[np.searchsorted(u0, new)]
    if (ids < 0).any():  # characters as bytes
        cp = -1 - ids
        cp = np.where(cp == LITERAL, BLANK, cp)
        size = np.where(ids < 0, _utf8_len(np.maximum(cp, 0)), 1)
        to = np.concatenate([[0], np.cumsum(size)])
        wide = np.repeat(ids, size)
        raw = np.frombuffer("".join(map(chr, cp[ids < 0])).encode("utf-8", "surrogatepass"), np.uint8)
        wide[np.repeat(ids < 0, size)] = store.v.byte_id[raw]
        ids, ends = wide, to[ends]
    return ids, ends


def decode_block(v: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The UTF-8 texts of pieces."""
    lens = v.len[ids]
    raw = v.flat[ranges(v.at[ids], lens)]
    at = np.concatenate([[0], np.cumsum(lens)])[ends]
    flat = raw.tobytes()
    return [flat[a + 1 : b] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _char_blocks(data: np.ndarray, offs: np.ndarray):
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + BLOCK_CHARS, side="right")) - 1)
        part = data[offs[i] : offs[j]]
        cps = np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[offs[i : j + 1] - offs[i]]
        yield i, j, part, cps, at
        i = j


def _encoded(batches, model: bytes, seed: int):
    """Of rows (doc_id, key, text): doc_id, pieces, and whether decoding gave the text back; a batch for each block."""
    store = _store(model)
    for b in batches:
        data, offs = buffers(b.column(2))
        null = np.asarray(b.column(2).is_null())
        row_keys = np.asarray(b.column(1).fill_null(0)).astype(np.int64).view(np.uint64) ^ keys(seed, 1)[0]
        for i, j, part, cps, at in _char_blocks(data, offs):
            ids, ends = encode_block(store, cps, at, row_keys[i:j])
            back = decode_block(store.v, ids, ends)
            ids = ids.astype(np.int32)
            own = (offs[i : j + 1] - offs[i]).tolist()
            raw, cut = part.tobytes(), ends.tolist()
            shas = [hashlib.sha256(ids[cut[d] : cut[d + 1]].tobytes()).hexdigest() for d in range(j - i)]
            same = [back[d] == raw[own[d] : own[d + 1]] for d in range(j - i)]
            no = pa.array(null[i:j])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), mask=no)
            cols = [pa.array(np.diff(ends), mask=null[i:j]), lists, pa.array(np.array(shas, object), pa.string(), mask=null[i:j]), pa.array(np.array(same, bool), mask=null[i:j])]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *cols], ["doc_id", "n_ids", "ids", "ids_sha256", "lossless"])


def decoder(model: bytes):
    """A column function from ids to text."""

    def run(ids: pa.Array) -> pa.Array:
        v = vocabulary(model)
        out = []
        for x in ids.to_pylist():
            a = np.array(x or [], np.int64)
            out.append(None if x is None else decode_block(v, a, np.array([0, len(a)]))[0].decode())
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")


def model_bytes(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:  # on the driver; executors get the bytes
        return f.read()


def encode(docs: DataFrame, path: str = MODEL, seed: int = 0) -> DataFrame:
    """(doc_id, n_ids, ids, ids_sha256, lossless) of each row of docs."""
    bounded_batches(docs.sparkSession)
    model = model_bytes(path)
    rows = docs.select("doc_id", F.col("doc_id").try_cast("bigint").alias("key"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _encoded(it, model, seed), f"doc_id {kind}, n_ids bigint, ids array<int>, ids_sha256 string, lossless boolean")
