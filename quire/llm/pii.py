"""Personal data by weak supervision, with built-in functions only.

Candidates of each kind come from one regular expression a kind; those of persons and addresses from gazetteers of given names and
of words for streets. The base kinds email, ip, card and phone are kept by
their exact rules; every candidate, base or not, also gets the votes (1, 0, -1) of five labelers:

shape: the kind's own check (Luhn, octets, digit counts, a known ending of the domain)
words: telling words near it (and words that tell against it); near: NEAR characters on either side, up to the next of its kind
known: gazetteers of given names, family names and places, in it or near it
left, right: what stands right before and after it

Votes are counted by pattern in Spark (at most 3^5 patterns a kind and length class, whatever the input), and the driver
runs expectation-maximisation on these counts: it estimates how reliable each labeler is and how likely each pattern is
personal data. A logistic span classifier over kind, votes and length class is then fitted to these likelihoods, and its
weights score every candidate in Spark. Candidates that aren't base spans are added where the score reaches 0.5, unless
their shape is wrong (a failed check of a base kind is never overruled) or they overlap a base span.

Null text counts as empty; empty texts and tables give no spans; repeated rows, with or without doc_id, are scored alike, each by
itself. Of added spans with one start and kind there is one; spans may overlap others of other kinds, but none of the base's. Columns
besides doc_id and text are left aside.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_text, settle
from .native import digits, luhn, placed

BASE = ("email", "ip", "card", "phone")
#: Fixed lists of the gazetteers: given names, family names, places, words for streets.
GIVEN = "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew Kevin Brian George Edward Peter Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Betty Margaret Sandra Ashley Emily Donna Michelle Laura Anna Emma Olivia Sophia Hans Klaus Jürgen Stefan Wolfgang Andreas Ursula Petra Sabine Monika Jean Pierre Michel Philippe Nicolas Marie Nathalie Isabelle Sylvie Claire José Antonio Manuel Francisco Carlos Miguel Carmen María Lucía Isabel Elena Giovanni Marco Luca Giulia Mohammed Ahmed Fatima Wei Yuki Ivan Olga".split()
FAMILY = "Smith Johnson Williams Brown Jones Garcia Miller Davis Rodriguez Martinez Hernandez Lopez Gonzalez Wilson Anderson Thomas Taylor Moore Jackson Martin Lee Thompson White Harris Clark Lewis Robinson Walker Young Allen King Wright Scott Hill Green Adams Nelson Baker Hall Campbell Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann Koch Bauer Richter Klein Bernard Dubois Durand Moreau Laurent Simon Michel Lefebvre Leroy Roux Fernandez Sanchez Perez Gomez Ruiz Diaz Moreno Rossi Russo Ferrari Bianchi Wang Li Zhang Chen Kumar Singh Khan Ali Tanaka Suzuki Kim Nguyen".split()
PLACES = "London Paris Berlin Madrid Rome Vienna Zurich Munich Hamburg Cologne Frankfurt Lyon Marseille Toulouse Barcelona Valencia Seville Milan Amsterdam Brussels Dublin Manchester Boston Chicago Houston Phoenix Philadelphia Dallas Austin Seattle Denver Portland Atlanta Miami Toronto Sydney Melbourne Tokyo Beijing Moscow".split()
STREETS = "Street St Road Rd Avenue Ave Lane Ln Drive Dr Boulevard Blvd Court Square Way Place Terrace".split()


def _any_of(names) -> str:
    """An expression for any of some capitalised names: one look at the first letter passes over most places of a text."""
    by: dict[str, list[str]] = {}
    for x in dict.fromkeys(names):
        by.setdefault(x[0], []).append(x[1:])
    return f"(?=[{''.join(sorted(by))}])(?:{'|'.join(f'{c}(?:{chr(124).join(own)})' for c, own in sorted(by.items()))})"


_GIVEN = _any_of(GIVEN)
#: Possessive forms of the base expressions; they match the same places without backtracking. A chain of digits is taken
#: from its first digit on, so a card's expression only stops at chains of 14 to 19 digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9]|[0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "masked": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._-]{1,63}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}+(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{1,63}+)+",
    "local": r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "mac": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:])",
    "person": rf"(?=\p{{Lu}})(?<![\p{{L}}]){_GIVEN} \p{{Lu}}\p{{Ll}}{{1,20}}+(?![\p{{L}}])",
    "address": rf"(?<![0-9A-Za-z])[0-9]{{1,5}} (?:[A-Z][a-z]{{1,20}}+ ){{1,3}}(?:{'|'.join(STREETS)})(?![A-Za-z])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra)\.? [A-Z][a-z]{2,20}(?: [A-Z][a-z]{2,20})?(?![A-Za-z])",
}
KINDS = tuple(PATTERNS)
#: Any text without one of these characters in these places has no candidate of the kind.
GATES = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][0-9 -]{12}", "phone": "\\+[0-9]", "masked": "[\\[(](?:at|AT)[\\])]", "local": "[0-9]{3}[ .-][0-9]{4}", "ssn": "[0-9]-[0-9]{2}-[0-9]", "iban": "[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "mac": "[0-9A-Fa-f]:[0-9A-Fa-f]{2}:", "person": f"{_GIVEN} \\p{{Lu}}\\p{{Ll}}", "address": f" (?:{'|'.join(STREETS)})(?![A-Za-z])", "name": "(?=[DFHMPS])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra)\\.? [A-Z]"}
_KNOWN = f"(?<!\\p{{L}}){_any_of([*GIVEN, *FAMILY, *PLACES])}(?!\\p{{L}})"
_FAMILY = f" (?:{'|'.join(FAMILY)})$"
#: Fixed word lists of the gazetteer labeler.
TELLING = "mail|contact|write to|phone|tel|call|fax|mobile|card|visa|credit|iban|account|ssn|social security|address|name|reach|correo|kontakt|telefon|appel"
AGAINST = "version|isbn|issn|order|invoice|hash|sha|commit|serial|build|release|page|token|secret"
ENDINGS = "com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|it|nl|ch|at|us|ca|example"
LABELERS = ("shape", "words", "known", "left", "right")
NEAR = 40


def _shape(kind: Column, t: Column) -> Column:
    d = digits(t)
    good = {
        "email": F.lower(t).rlike(rf"\.(?:{ENDINGS})$"),
        "ip": ~F.exists(F.split(t, "\\."), lambda x: x.try_cast("double") > 255),
        "card": luhn(d),
        "phone": F.char_length(d).between(10, 15),
        "local": ~d.rlike("^[01]"),
        "person": t.rlike(_FAMILY),
        "ssn": ~d.rlike("^(?:000|666|9)"),
        "iban": F.char_length(F.replace(t, F.lit(" "), F.lit(""))).between(15, 34),
    }
    out = F.when(kind.isin("masked", "mac", "name", "address"), 0)
    for k, ok in good.items():
        out = out.when(kind == k, F.when(ok, 1).otherwise(0 if k == "person" else -1))
    return out.otherwise(0)


def _of_kind(k: str):
    return lambda x: F.struct(F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["t"].alias("t"), x["l"].alias("l"), x["r"].alias("r"))


def candidates(text: Column) -> Column:
    """All candidates of a text: array of kind, s, e, base, votes and length class."""
    out = []
    for k, pattern in PATTERNS.items():
        m = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        here = F.transform(placed(text, m, pattern, NEAR), _of_kind(k))
        out.append(F.when(text.rlike(GATES[k]), here).otherwise(F.array().cast("array<struct<kind:string,s:int,e:int,t:string,l:string,r:string>>")))

    def voted(x):
        s, e = x["s"], x["e"]
        around = F.concat(x["l"], F.lit("\n"), x["r"])
        near = F.lower(around)
        before, after = F.right(x["l"], F.lit(1)), F.left(x["r"], F.lit(1))
        return F.struct(
            x["kind"].alias("kind"),
            s.alias("s"),
            e.alias("e"),
            _shape(x["kind"], x["t"]).alias("shape"),
            F.when(near.rlike(AGAINST), -1).when(near.rlike(TELLING), 1).otherwise(0).alias("words"),
            F.when(F.concat(around, F.lit("\n"), F.when(x["kind"] == "person", "").otherwise(x["t"])).rlike(_KNOWN) | ((x["kind"] == "person") & x["t"].rlike(_FAMILY)), 1).otherwise(0).alias("known"),
            F.when(before.rlike("[A-Za-z0-9_=\"'/-]"), -1).otherwise(1).alias("left"),
            F.when(after.rlike("[A-Za-z0-9_]"), -1).when(after.rlike("^$|[\\s.,;:!?)]"), 1).otherwise(0).alias("right"),
            F.least((e - s) / 8, F.lit(4)).cast("int").alias("size"),
        )

    return F.transform(F.concat(*out), voted)


def reliabilities(counts: list[tuple], rounds: int = 60) -> dict:
    """Likelihood that each vote pattern is personal data. counts: (votes tuple, number); the prior starts at 0.5 and
    a labeler starts at 0.7 right, so the labels can't change places."""
    labelers = len(counts[0][0]) if counts else 0
    right = {(j, v, y): (0.7 if v == (1 if y else -1) else 0.15) for j in range(labelers) for v in (1, 0, -1) for y in (True, False)}
    prior, like = 0.5, {}
    total = sum(n for _, n in counts) or 1
    for _ in range(rounds):
        for v, _ in counts:
            p, q = prior, 1 - prior
            for j, x in enumerate(v):
                p, q = p * right[j, x, True], q * right[j, x, False]
            like[v] = p / (p + q)
        prior = min(0.99, max(0.01, sum(n * like[v] for v, n in counts) / total))
        for y in (True, False):
            mass = {v: (like[v] if y else 1 - like[v]) for v, _ in counts}
            all_mass = sum(n * mass[v] for v, n in counts)
            for j in range(labelers):
                for x in (1, 0, -1):
                    here = sum(n * mass[v] for v, n in counts if v[j] == x)
                    right[j, x, y] = (here + 1) / (all_mass + 3)
    return like


def fit(groups: list, rounds: int = 300, rate: float = 0.5) -> dict:
    """Weights of the span classifier. groups: rows of kind, votes, size and n; features are one-hot."""
    by_votes: dict[tuple, int] = {}
    for g in groups:
        v = tuple(g[x] for x in LABELERS)
        by_votes[v] = by_votes.get(v, 0) + g["n"]
    like = reliabilities(sorted(by_votes.items()))
    w: dict = {"": 0.0}
    total = sum(g["n"] for g in groups) or 1
    rows = [(["", ("kind", g["kind"]), ("size", g["size"]), *((x, g[x]) for x in LABELERS)], g["n"] / total, like[tuple(g[x] for x in LABELERS)]) for g in groups]
    for names, _, _ in rows:
        w.update({x: 0.0 for x in names})
    for _ in range(rounds):
        grad = dict.fromkeys(w, 0.0)
        for names, n, y in rows:
            z = sum(w[x] for x in names)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            for x in names:
                grad[x] += n * (y - p)
        for x in w:
            w[x] += rate * (grad[x] * 4 - 0.001 * w[x])
    return w


def _score(x: Column, w: dict) -> Column:
    z = F.lit(float(w[""]))
    for name in ("kind", "size", *LABELERS):
        own = {k[1]: v for k, v in w.items() if k and k[0] == name}
        if own:
            table = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in sorted(own.items())))
            z = z + F.coalesce(table[x[name]], F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def _any_gate(text: Column) -> Column:
    """Whether a text may have a candidate at all: the cheap question comes first."""
    return text.rlike("[0-9@]") | text.rlike(GATES["masked"]) | text.rlike(GATES["name"]) | text.rlike(GATES["person"])


def grouped(each: DataFrame) -> list:
    """Candidates counted by kind, length class and votes: a bounded number of rows."""
    return sorted(each.groupBy("kind", "size", *LABELERS).agg(F.count("*").alias("n")).collect(), key=str)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each row; a span: s, kind, e, base, score; ordered by start, then by kind as listed."""
    text = own_text("text")
    found = settle(docs.select(F.col("doc_id").alias("doc_id"), text.alias("text")).select("doc_id", F.when(_any_gate(F.col("text")), candidates(F.col("text"))).alias("found")))
    each = found.where(F.size("found") > 0).select(F.explode("found").alias("x")).select("x.*")
    w = fit(grouped(each))
    rank = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(i)) for i, k in enumerate(KINDS)))
    spans = F.transform(
        F.coalesce("found", F.array().cast(found.schema["found"].dataType)),
        lambda x: F.struct(x["s"].alias("s"), rank[x["kind"]].alias("rank"), x["kind"].alias("kind"), x["e"].alias("e"), (x["kind"].isin(*BASE) & ((x["kind"] == "email") | (x["shape"] == 1))).alias("base"), _score(x, w).alias("score"), x["shape"].alias("shape")),
    )
    base = F.filter(spans, lambda x: x["base"])

    def added(x):
        inside = F.exists(F.col("base"), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        return ~x["base"] & (x["shape"] >= 0) & (x["score"] >= 0.5) & ~inside

    out = found.select("doc_id", spans.alias("spans"), base.alias("base"))
    return out.select("doc_id", F.array_sort(F.concat("base", F.filter("spans", added))).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    def told(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["base"])
    count = lambda k: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == k))).cast("bigint").alias(f"n_{k}")
    return scanned.select("doc_id", *map(count, BASE), F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
