"""Plain Python versions of the contracts, from their wording; nothing here imports the operators."""

import hashlib
import re

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def luhn(d):
    x = [int(c) for c in d[::-1]]
    return (sum(x[::2]) + sum(sum(divmod(2 * v, 10)) for v in x[1::2])) % 10 == 0


def pii(text):
    t = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], ("email", "ip", "card", "phone").index(x[0])))


def secrets(text):
    t = text or ""
    out = [("assign", *m.span()) for m in re.finditer(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def licenses(text):
    w = ALNUM.findall((text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        own = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += own
        labels |= {label} if own else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near(docs):
    """docs: (doc_id, text); {doc_id: (size, component)}."""
    sets = [(i, shingles(t)) for i, t in docs]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(k)
    pairs = {(a, b) for v in by.values() for a in v for b in v if a < b}
    for a, b in pairs:
        (i, x), (j, y) = sets[a], sets[b]
        if 100 * len(x & y) >= 85 * len(x | y):
            p, q = find(i), find(j)
            up[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def hits(docs, items):
    """{doc_id: (n_words, n_hit, n_items, sha)}"""
    wins = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = 13 if len(w) >= 13 else len(w)
        for k in range(len(w) - n + 1) if n else ():
            wins.setdefault(tuple(w[k : k + n]), set()).add(i)
    sizes = {len(k) for k in wins}
    out = {}
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = wins.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    ids |= own
        out[d] = (len(w), len(hit), len(ids), sha(",".join(sorted(map(str, ids)))))
    return out


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url(u):
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    host, path = m[1].translate(LOWER), m[2]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def edited(docs):
    """{doc_id: (n_chars, edited text, next doc_id)}"""
    order = sorted(docs, reverse=True)
    out = {}
    for k, (i, t) in enumerate(order):
        j, u = order[(k + 1) % len(order)]
        t, u = t or "", u or ""
        h = len(t) // 2
        out[i] = (len(t), t[: len(t) - h] + u[:h], j)
    return out
