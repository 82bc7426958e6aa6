"""Column helpers for the operators that use built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Matches that one fold takes; what it has gathered is copied with each of them.
CHUNK = 128


def placed(text: Column, matches: Column, pattern: str, near: int = 0) -> Column:
    """Start, end (code points) and text of each of matches = regexp_extract_all(text, pattern, 0), with up to `near` characters of what
    stands between it and its neighbours (l, r).

    The parts between the matches, from split(), give the places, so the text itself isn't scanned again for any match. Places are
    cumulated in chunks and over chunks, so the time is linear for any number of matches that a text of Spark can hold."""
    def both(z):
        n = F.size(z["m"])
        ahead = F.zip_with(z["m"], F.slice(z["p"], 1, n), lambda m, p: F.struct(m.alias("t"), F.char_length(p).alias("skip"), F.right(p, F.lit(near)).alias("l")))
        return F.zip_with(ahead, F.slice(z["p"], 2, n), lambda x, p: F.struct(x["t"].alias("t"), x["skip"].alias("skip"), x["l"].alias("l"), F.left(p, F.lit(near)).alias("r")))

    kind = "array<struct<s:int,e:int,t:string,l:string,r:string>>"
    raw = "array<struct<t:string,skip:int,l:string,r:string>>"

    def step(acc, x):
        s = acc["at"] + x["skip"]
        e = s + F.char_length(x["t"])
        return F.struct(e.alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e"), x["t"].alias("t"), x["l"].alias("l"), x["r"].alias("r"))).alias("out"))

    def whole(xs):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int")), lambda k: F.slice(xs, k * CHUNK + 1, F.lit(CHUNK)))
        total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["skip"] + F.char_length(x["t"]))
        none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,c:{raw}>>").alias("out"))
        based = F.aggregate(chunks, none, lambda a, c: F.struct((a["at"] + total(c)).alias("at"), F.array_append(a["out"], F.struct(a["at"].alias("at"), c.alias("c"))).alias("out")), lambda a: a["out"])
        return F.flatten(F.transform(based, lambda z: F.aggregate(z["c"], F.struct(z["at"].alias("at"), F.array().cast(kind).alias("out")), step, lambda a: a["out"])))

    # each expression stands once, so each is evaluated once
    found = F.transform(F.array(matches), lambda m: F.when(F.size(m) > 0, F.struct(m.alias("m"), F.split(text, pattern, -1).alias("p"))))
    return F.coalesce(F.transform(found, lambda z: F.when(z.isNotNull(), F.transform(F.array(both(z)), whole)[0]))[0], F.array().cast(kind))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.char_length(d)

    def add(acc, i):
        x = F.substring(d, i, F.lit(1)).cast("int")
        return acc + F.when((n - i) % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def lower_ascii(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
