"""URL filter: listed rules first, then association rules that FP-growth mines from labelled URLs.

A URL becomes a set of tokens: labels of its host, words of its path, keys of its query, its scheme and ending; numbers
are left out. FP-growth mines frequent sets of labelled URLs that contain a verdict; rules below MIN_SUPPORT or
MIN_CONFIDENCE go, and so do rules that their rows don't tell from chance: the lower end of the confidence's interval (Wilson,
Z standard deviations) must lie above the share of the verdict among all labelled rows. That end is how sure a rule is, so few
rows can tell if they agree well enough, in a table of any size. A rule that is no surer than one with fewer of its tokens goes too.
What is left matches through an inverted index from a token to the rules that need it: a rule holds if
the URL has all its tokens. Block wins if its best rule is surer than allow's (a tie allows); without any rule the verdict is allow.

Null, or no "://": host and path are empty, no listed rule fits. Empty and repeated rows, with or without page_id, are judged by
themselves; empty tables give no rows and no rules; columns besides the key and url are left aside. The number
of mined rules is bounded by support and by how many tokens a URL has, not by the input.
"""

from __future__ import annotations

import json

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .native import lower_ascii

#: Fixed rules: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MIN_SUPPORT, MIN_CONFIDENCE = 0.001, 0.5
#: Thousands of sets are tried, so a rule by chance should be one in more than that.
Z = 4.0


def _rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.char_length(u))).otherwise("")


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def listed(h: Column, p: Column) -> Column:
    """The longest listed rule that fits, as a struct of rule and verdict; else null."""
    out = None
    for verdict, rh, rp in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((h == rh) | F.endswith(h, F.lit(f".{rh}"))) & F.startswith(p, F.lit(rp))
        one = F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, one) if out is None else out.when(fits, one)
    return out


def tokens(url: Column) -> Column:
    u = lower_ascii(F.coalesce(url, F.lit("")))
    query = F.regexp_extract(_rest(u), "^[^?#]*\\?([^#]*)", 1)
    p = path(u)
    parts = F.concat(
        F.transform(F.split(host(u), "\\."), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.split(p, "[^a-z]+"), lambda x: F.concat(F.lit("p:"), x)),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))),
        F.array(F.concat(F.lit("s:"), F.regexp_extract(u, "^([a-z]+)://", 1)), F.concat(F.lit("e:"), F.regexp_extract(p, "\\.([a-z]+)$", 1))),
    )
    return F.array_distinct(F.filter(parts, lambda x: F.char_length(x) > 2))


def _lower_end(share: Column, n: Column) -> Column:
    """The lower end of Wilson's interval of a share of n rows."""
    z2 = Z * Z
    return (share + z2 / (2 * n) - Z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[dict]:
    """Rules from labelled URLs (url, verdict): tokens, verdict, sure."""
    rows = settle(labelled.where("verdict is not null").select("verdict", tokens(F.col("url")).alias("own")))
    shares = {r["verdict"]: r["n"] for r in rows.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # one row a verdict
    n = sum(shares.values())
    if len(shares) < 2:
        return []
    # a token of every row tells nothing: any set with it has the same rows without it
    held = rows.select(F.explode("own").alias("t")).groupBy("t").agg(F.count("*").alias("n")).where(F.col("n") == n)
    always = F.array(*(F.lit(r["t"]) for r in held.collect())) if held.take(1) else F.array().cast("array<string>")  # at most one URL's tokens
    items = rows.select(F.array_append(F.array_except("own", always), F.concat(F.lit("v:"), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    kept = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit("v:")))
    kept = kept.select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 3, 99).alias("verdict"), F.col("confidence"), F.round(F.col("support") * n / F.col("confidence")).alias("rows"))
    base = F.create_map(*(x for v, k in sorted(shares.items()) for x in (F.lit(v), F.lit(k / n))))
    kept = settle(kept.withColumn("sure", F.round(_lower_end(F.col("confidence"), F.col("rows")), 12)).where(F.col("sure") > base[F.col("verdict")]))
    # dominated: a rule of a part of the tokens is as sure; that part's first token is one of the rule's
    part = kept.select(F.col("tokens").alias("fewer"), "verdict", F.col("sure").alias("as_sure"), F.col("tokens")[0].alias("t"))
    beaten = kept.select("tokens", "verdict", "sure", F.explode("tokens").alias("t")).join(part, ["t", "verdict"])
    beaten = beaten.where((F.size("fewer") < F.size("tokens")) & (F.col("as_sure") >= F.col("sure")) & (F.size(F.array_except("fewer", "tokens")) == 0)).select("tokens", "verdict").distinct()
    got = kept.join(beaten, ["tokens", "verdict"], "left_anti").select("tokens", "verdict", "sure").collect()  # bounded: see the module
    return sorted(({"tokens": list(r["tokens"]), "verdict": r["verdict"], "sure": r["sure"]} for r in got), key=lambda r: (r["tokens"], r["verdict"]))


def judge(pages: DataFrame, mined: list[dict], key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict) of each row of pages (key, url)."""
    index: dict[str, list[int]] = {}
    for i, r in enumerate(mined):
        for t in r["tokens"]:
            index.setdefault(t, []).append(i)
    x = pages.select(F.col(key).alias("key"), F.col("url").alias("url"))
    x = x.select("key", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    x = x.withColumn("listed", listed(F.col("host"), F.col("path")))
    by_token = F.from_json(F.lit(json.dumps(index)), "map<string,array<int>>")
    table = F.from_json(F.lit(json.dumps([r | {"n": len(r["tokens"])} for r in mined])), "array<struct<n:int,verdict:string,sure:double>>")
    if mined:
        met = F.flatten(F.transform(tokens(F.col("url")), lambda t: F.coalesce(by_token[t], F.array().cast("array<int>"))))
        x = x.withColumn("met", F.when(F.col("listed").isNull(), F.array_sort(met)))
        # in the sorted list a rule of n tokens holds if it stands there n times: looked up at its first place, n - 1 places on
        first = lambda i, k: (k == 0) | (F.get("met", k - 1) != i)
        x = x.withColumn("held", F.transform(F.filter("met", lambda i, k: first(i, k) & (F.get("met", k + table[i]["n"] - 1) == i)), lambda i: table[i]))
        sure = lambda v: F.coalesce(F.array_max(F.transform(F.filter("held", lambda r: r["verdict"] == v), lambda r: r["sure"])), F.lit(0.0))
        other = F.when(sure("block") > sure("allow"), "block").otherwise("allow")
    else:
        other = F.lit("allow")
    return x.select(F.col("key").alias(key), "host", "path", F.col("listed.rule").alias("rule"), F.coalesce(F.col("listed.verdict"), other).alias("verdict"))
