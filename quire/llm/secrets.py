"""Secrets by a character convolutional network over candidates.

Base findings come from three exact rules (assign, access, hex). Further candidates are runs of LEAST token characters and more that
hold a letter and a digit, or a capital behind a small letter. A network in numpy reads each candidate with its context on both sides,
a long one in several windows: byte embeddings, one convolution, ReLU,
maximum over places, a logistic output. It is trained on labelled findings. Positives: base findings with varied characters, as they
stand, and the same keys written in other alphabets (base 64, capitals) in the ordinary places of their text, so that neither one
alphabet nor a telling word before it is needed. Negatives: placeholders, other numbers and addresses, ordinary places, and runs of
the text's own words joined as names, paths and dates are. At most SAMPLE findings of each label are
taken, those with the smallest hashes (a documented parameter), so the layout of the table doesn't matter. An eighth calibrates the scores
(Platt); another eighth sets the threshold: the highest that still finds RECALL of its positives. Candidates that reach it and don't
overlap base findings are added as kind `likely`.

Only texts with a keyword or a long run are read closely; the rest is passed over by byte tables. Null counts as empty. Empty
texts have no findings, an empty table no rows; without findings of both labels there is no network and nothing is added. Repeated rows,
with or without doc_id, are scored alike; columns besides doc_id and text are left aside.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, bound, bounded_batches, buffers, joined_spans, keys, settle

ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])|.*[a-z].*[A-Z]", re.S)
NUMBER = re.compile(r"[0-9][0-9 .()-]{8,}[0-9]|[a-z0-9._-]+@[a-z0-9.-]+")
BASE = ("assign", "access", "hex")
WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
PLACEHOLDER = re.compile(r"(?i)example|changeme|placeholder|your|xxxx|^(.)\1+$")
SAMPLE, RECALL = 2000, 0.97
BEFORE, AFTER = 24, 56
SIZE, FILTERS, WIDTH, DIM = BEFORE + AFTER, 24, 7, 8
_C = np.arange(256)
_TOKEN = ((_C >= 48) & (_C <= 57)) | ((_C >= 65) & (_C <= 90)) | ((_C >= 97) & (_C <= 122)) | np.isin(_C, [43, 47, 95, 61, 45])
_DIGIT = (_C >= 48) & (_C <= 57)
_CAPITAL = (_C >= 65) & (_C <= 90)
_HEX = _DIGIT | ((_C >= 97) & (_C <= 102))


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    s, e = edge[::2], edge[1::2]
    long = e - s >= least
    return s[long], e[long]


def worth_reading(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which texts may have a candidate. Runs may join over the end of a text; that only reads more."""
    at = []
    s, e = _runs(_TOKEN[data], LEAST)
    if len(s):
        seen = np.concatenate([[0], np.cumsum((_DIGIT | _CAPITAL)[data])])
        at.append(s[seen[e] > seen[s]])
    at.append(_runs(_HEX[data], 24)[0])
    raw = data.tobytes()
    low = raw.lower()
    for w in [*WORDS, b"AKIA"]:
        text = raw if w == b"AKIA" else low
        k = text.find(w)
        while k >= 0:
            at.append(np.array([k]))
            d = int(np.searchsorted(offs, k, side="right"))  # on to the next text
            k = text.find(w, max(k + 1, int(offs[d]))) if d < len(offs) else -1
    out = np.zeros(len(offs) - 1, bool)
    if at:
        p = np.concatenate(at)
        d = np.searchsorted(offs, p, side="right") - 1
        out[d[d < len(out)]] = True
        lo, hi = np.searchsorted(offs, s, side="right") - 1, np.searchsorted(offs, e, side="left")
        for k in np.flatnonzero(hi - lo > 1):  # a run that covers several texts
            out[lo[k] : hi[k]] = True
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], BASE.index(x[0])))


def other_candidates(text: str, spans) -> list[tuple[int, int]]:
    """Runs of token characters, mixed as keys are, that overlap no base finding."""
    out, k = [], 0
    ends = sorted((s, e) for _, s, e in spans)
    for m in RUN.finditer(text):
        s, e = m.span()
        while k < len(ends) and ends[k][1] <= s:
            k += 1
        if not any(a < e and b > s for a, b in ends[k : k + 4]) and MIXED.match(m[0]):
            out.append((s, e))
    return out


def window(text: str, s: int, e: int) -> bytes:
    """The candidate and its surroundings: BEFORE bytes of what stands before, AFTER bytes from its start on."""
    before = text[max(0, s - BEFORE) : s].encode()[-BEFORE:].rjust(BEFORE, b"\0")
    return before + text[s : s + AFTER].encode()[:AFTER].ljust(AFTER, b"\0")


def windows(text: str, s: int, e: int) -> list[bytes]:
    """Windows over a whole candidate and BEFORE characters on both sides; the last one ends there. They overlap, so no place of
    the convolution falls between two."""
    end = e + BEFORE - AFTER
    return [window(text, k, e) for k in ([*range(s, end, AFTER), end] if end > s else [s])]


def _order(w: bytes, y: int) -> int:
    return int.from_bytes(hashlib.blake2b(w, digest_size=7, salt=bytes([y])).digest(), "big")


def _labelled(t: str, spans, close: bool):
    """Windows of a text with their labels; close: whether it may hold findings."""
    h = int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big")
    ordinary = [int(x) for x in keys(h & 0xFFFF, 4) % np.uint64(max(1, len(t)))] if t else []
    for k, s, e in spans:
        m = ASSIGN.match(t, s) if k == "assign" else None
        s = m.start(2) if m else s
        value = t[s:e]
        y = int(len(set(value)) >= 6 and not PLACEHOLDER.search(value))
        yield y, window(t, s, e)
        if y:
            for n, at in enumerate(ordinary):
                key = hashlib.blake2b(value.encode() + bytes([n]), digest_size=18 + 6 * n).digest()
                own = base64.b64encode(key).decode().rstrip("=") if n else key.hex().upper()
                yield 1, window(f"{t[:at]} {own} {t[at:]}", at + 1, at + 1 + len(own))
    if close:
        ends = sorted((s, e) for _, s, e in spans)
        k = 0
        for m in NUMBER.finditer(t):
            while k < len(ends) and ends[k][1] <= m.start():
                k += 1
            if not any(a < m.start() + AFTER and z > m.start() - BEFORE for a, z in ends[max(k - 1, 0) : k + 8]):
                yield 0, window(t, *m.span())
    if close or h % 16 == 0:  # ordinary places also come from one text in 16, told by its hash
        words = re.findall(r"\b[A-Z]?[a-z]{1,12}\b", t)
        open_ = [(a, z) for _, a, z in spans] + other_candidates(t, spans)
        for n, at in enumerate(ordinary):
            if any(a < at + AFTER and z > at - BEFORE for a, z in open_):  # not beside what may be a secret
                continue
            yield 0, window(t, at, at + 8)
            own = [words[(h >> (7 * j)) % len(words)] for j in range(4)] if words else []
            name = [f"{'-'.join(own)}-{h % 2100}", f"/{'/'.join(own)}/{h % 97}", "".join(w.capitalize() for w in own), f"{h % 31}-{h % 12}-20{h % 89 + 10}_{'_'.join(own)}"][(h + 2 * n) % 4]
            yield 0, window(f"{t[:at]} {name} {t[at:]}", at + 1, at + 1 + len(name))


def _findings(batches, sample):
    """Labelled windows of texts, (order, label, window): of each label those with the smallest orders, sample at most."""
    best: dict[int, dict] = {0: {}, 1: {}}
    for b in batches:
        data, offs = buffers(b.column(0))
        for i, j in blocks(offs):
            part, at = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            flags = worth_reading(part, at)
            for d in range(j - i):
                t = part[at[d] : at[d + 1]].tobytes().decode()
                for y, w in _labelled(t, base_spans(t) if flags[d] else [], bool(flags[d])):
                    best[y][_order(w, y)] = w
                for y in best:
                    if len(best[y]) > 4 * sample:
                        best[y] = dict(sorted(best[y].items())[:sample])
    rows = [(o, y, w) for y in best for o, w in sorted(best[y].items())[:sample]]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["ord", "label", "win"])


class Network:
    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.emb = (r.standard_normal((256, DIM)) * 0.5).astype(np.float32)
        self.conv = (r.standard_normal((WIDTH * DIM, FILTERS)) * (2 / (WIDTH * DIM)) ** 0.5).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = (r.standard_normal(FILTERS) * 0.3).astype(np.float32)
        self.off = np.float32(0)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray):
        e = self.emb[x]
        cols = np.concatenate([e[:, k : SIZE - WIDTH + 1 + k] for k in range(WIDTH)], axis=2)
        z = cols @ self.conv + self.bias
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None], axis=1)[:, 0]
        return cols, at, top, np.maximum(top, 0) @ self.out + self.off

    def margins(self, wins: list[bytes]) -> np.ndarray:
        x = np.frombuffer(b"".join(wins), np.uint8).reshape(-1, SIZE)
        return np.concatenate([self._forward(x[i : i + 2048])[3] for i in range(0, len(x), 2048)]) if len(x) else np.zeros(0)

    def scores(self, wins: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margins(wins) + self.shift, -30, 30)))

    def train(self, wins: list[bytes], labels: np.ndarray, epochs: int = 30, rate: float = 0.4, seed: int = 4) -> Network:
        x = np.frombuffer(b"".join(wins), np.uint8).reshape(-1, SIZE)
        rng = np.random.default_rng(seed)
        cal, last = np.arange(len(x)) % 8 == 3, np.arange(len(x)) % 8 == 7
        own = np.flatnonzero(~cal & ~last)
        for ep in range(epochs):
            rng.shuffle(own)
            lr = np.float32(rate * (1 - ep / epochs))
            for i in range(0, len(own), 32):
                k = own[i : i + 32]
                cols, at, top, z = self._forward(x[k])
                g = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - labels[k]).astype(np.float32)
                back = g[:, None] * self.out * (top > 0)
                rows = np.arange(len(k))[:, None]
                picked = cols[rows, at]  # (batch, filters, width * dim)
                grad = np.einsum("bf,bfk->kf", back, picked)
                emb = np.zeros_like(self.emb)
                spread = (back[:, :, None] * self.conv.T[None]).reshape(len(k), FILTERS, WIDTH, DIM)
                place = at[:, :, None] + np.arange(WIDTH)
                np.add.at(emb, x[k][rows[:, :, None], place], spread)
                self.off -= lr * g.mean()
                self.out -= lr * (g[:, None] * np.maximum(top, 0)).mean(axis=0)
                self.conv -= lr * grad / len(k)
                self.bias -= lr * back.mean(axis=0)
                self.emb -= lr * emb / len(k)
        m, y = self.margins([wins[i] for i in np.flatnonzero(cal)]), labels[cal]
        if len(m) and 0 < y.sum() < len(y):
            soft = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
            for _ in range(300):
                g = soft - 1 / (1 + np.exp(-np.clip(self.scale * m + self.shift, -30, 30)))
                self.scale, self.shift = self.scale + 0.05 * float((g * m).mean()), self.shift + 0.2 * float(g.mean())
        p = np.sort(self.scores([wins[i] for i in np.flatnonzero(last & (labels == 1))]))
        if len(p):
            self.threshold = float(p[int(len(p) * (1 - RECALL))])
        return self


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network from the findings of docs; None without findings of both labels."""
    got = settle(bound(docs, {"text": "string"}).mapInArrow(lambda it: _findings(it, sample), "ord bigint, label int, win binary").dropDuplicates(["ord", "label"]))
    # each task of a sorted limit sends its own first rows to the driver; leave only ranges of orders (of 2 ** 16; an order has 56 bits) that hold the first rows of all
    range_of = F.shiftright("ord", 40)
    sizes = got.groupBy("label", range_of.alias("at")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("label").orderBy("at")) - F.col("n")
    last = sizes.select("label", "at", before.alias("before")).where(F.col("before") < sample).groupBy("label").agg(F.max("at").alias("last"))
    near = settle(got.join(F.broadcast(last), "label").where(range_of <= F.col("last")).select("ord", "label", "win"))
    rows = [r for y in (0, 1) for r in near.where(F.col("label") == y).orderBy("ord", "win").limit(sample).collect()]  # at most 2 * sample windows
    rows.sort(key=lambda r: (r["ord"], bytes(r["win"])))
    y = np.array([r["label"] for r in rows], np.float32)
    return Network().train([bytes(r["win"]) for r in rows], y) if 0 < y.sum() < len(y) else None


def found(text: str, net: Network | None) -> tuple[list, list]:
    """Base and all findings of a text, ordered."""
    base = base_spans(text)
    more = other_candidates(text, base) if net is not None else []
    if more:
        each = [windows(text, s, e) for s, e in more]
        first = np.cumsum([0, *map(len, each)])[:-1]
        p = np.maximum.reduceat(net.scores([w for ws in each for w in ws]), first)  # of a candidate's windows the surest tells
        more = [("likely", s, e) for (s, e), x in zip(more, p) if x >= net.threshold]
    return base, sorted([*base, *more], key=lambda x: (x[1], (*BASE, "likely").index(x[0])))


_RESULT = [("n_assign", pa.int64(), "bigint"), ("n_access", pa.int64(), "bigint"), ("n_hex", pa.int64(), "bigint"), ("base_sha256", pa.string(), "string"), ("spans", pa.string(), "string")]
_NONE = hashlib.sha256(b"").hexdigest()


def _each(text: pa.Array, net):
    """(base, all findings, text) of each text; findings and text are empty where there is nothing to read."""
    data, offs = buffers(text)
    for i, j in blocks(offs):
        part, at = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        flags = worth_reading(part, at)
        for d in range(j - i):
            if flags[d]:
                t = part[at[d] : at[d + 1]].tobytes().decode()
                yield *found(t, net), t
            else:
                yield [], [], None


def finder(net: Network | None, spark):
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(net)

    def run(text: pa.Array) -> pa.Array:
        cols: list[list] = [[], [], [], [], []]
        for base, spans, _ in _each(text, shared.value):
            for c, v in zip(cols, (*(sum(x[0] == k for x in base) for k in BASE), hashlib.sha256(joined_spans(base).encode()).hexdigest() if base else _NONE, joined_spans(spans))):
                c.append(v)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(cols, _RESULT)], [n for n, *_ in _RESULT])

    return F.arrow_udf(run, "struct<" + ",".join(f"{n}:{s}" for n, _, s in _RESULT) + ">")


def redactor(net: Network | None, spark, mask: str = "[SECRET]"):
    """A column function from text to the text with every finding masked; null stays null."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(net)

    def run(text: pa.Array) -> pa.Array:
        out = text.cast(pa.string()).to_pylist()
        for n, (_, spans, t) in enumerate(_each(text, shared.value)):
            if spans:
                parts, at = [], 0
                for _, s, e in spans:
                    if e <= at:
                        continue
                    parts += [t[at:s], mask] if s >= at else []
                    at = e
                out[n] = "".join([*parts, t[at:]])
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")


def scan(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each row of docs."""
    f = finder(net or fit(docs), docs.sparkSession)
    return docs.select(F.col("doc_id"), f(F.col("text").cast("string")).alias("__own")).select("doc_id", "__own.*")


def redacted_documents(docs: DataFrame) -> DataFrame:
    """docs with findings masked in text, and n_chars counted anew."""
    f = redactor(fit(docs), docs.sparkSession)
    out = docs.withColumn("text", f(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else out
