"""Sequence operators against plain Python over random sequences, golden tables, and plan shapes."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import chunking, extraction, profile, reconcile, sections

R = random.Random(11)


def test_greedy_chunks(spark):
    rows = [(f"d{d}", p, R.choice([100, 3000, 7000, 9000, 21000]), R.choice([8000, 20000])) for d in range(30) for p in range(1, R.randint(2, 90))]
    want, last = {}, None
    for d, p, t, b in sorted(rows):
        if d != last:
            last, chunk, acc, n = d, 0, 0, 0
        if n and (acc + t > b or n >= 20):
            chunk, acc, n = chunk + 1, 0, 0
        acc, n = acc + t, n + 1
        want[d, p] = chunk
    got = chunking.greedy_chunks(spark.createDataFrame(rows, "source string, page bigint, tokens bigint, budget bigint")).collect()
    assert {(r["source"], r["page"]): r["chunk"] for r in got} == want


def test_limiter(spark):
    rows = [(d, k, sec, R.randint(1, 900)) for d in range(20) for k, sec in enumerate(sorted(R.randint(0, 400) for _ in range(40)))]
    want = {}
    for d in range(20):
        at, used, now = None, 0, None
        for _, k, sec, tok in sorted((x for x in rows if x[0] == d), key=lambda x: (x[2], x[1])):
            now = max(sec if now is None else now, sec)
            if at is None or now - at >= 60:
                at, used = now, 0
            if used and used + tok > 1000:
                now = at = at + 60
                used = 0
            used += tok
            want[d, k] = now - sec
    got = chunking.limited(spark.createDataFrame(rows, "run bigint, call bigint, sec bigint, tok bigint"), 1000).collect()
    assert {(r["run"], r["call"]): r["wait"] for r in got} == want


def test_halving(spark):
    def halves(lo, hi):
        return [(lo, hi)] if hi - lo + 1 <= 3 else halves(lo, lo + (hi - lo + 1) // 2 - 1) + halves(lo + (hi - lo + 1) // 2, hi)

    rows = [(f"d{n}", 1, n) for n in [1, 2, 3, 4, 5, 7, 31, 32, 33, 100, 1000]]
    got = chunking.halved(spark.createDataFrame(rows, "source string, lo bigint, hi bigint")).collect()
    assert sorted((r["source"], r["lo"], r["hi"]) for r in got) == sorted((s, a, b) for s, lo, hi in rows for a, b in halves(lo, hi))


def test_clamp_and_parents(spark):
    rows = [(f"d{d}", k, R.randint(1, 4)) for d in range(20) for k in range(30)]
    got = {(r["source"], r["ord"]): r["level_out"] for r in sections.clamped(spark.createDataFrame(rows, "source string, ord bigint, heading_level bigint"), ["source"]).collect()}
    for d in range(20):
        e = None
        for _, k, level in (x for x in rows if x[0] == f"d{d}"):
            e = level if e is None else min(level, e + 1)
            assert got[f"d{d}", k] == e
    secs = [(s, k, min(level, 3), f"t{k}") for s, k, level in rows]
    got = {(r["source"], r["sec"]): r["parent_path"] for r in sections.parents(spark.createDataFrame(secs, "source string, sec bigint, level bigint, title string")).collect()}
    for d in range(20):
        stack = []
        for s, k, level, title in (x for x in secs if x[0] == f"d{d}"):
            while stack and stack[-1][0] >= level:
                stack.pop()
            assert got[s, k] == " > ".join(t for _, t in stack)
            stack.append((level, title))


def test_pair_merge(spark):
    rows = []
    for d in range(40):
        for p in range(1, R.randint(2, 9)):
            rows.append((d, p, [R.randint(1, 3) for _ in range(R.randint(1, 4))], R.random() < 0.6, R.random() < 0.7))
    want = []
    for d in range(40):
        own = [x for x in rows if x[0] == d]
        i = 0
        while i < len(own):
            _, p, r, t, _ = own[i]
            if i + 1 < len(own) and t and own[i + 1][4]:
                nxt = own[i + 1]
                want.append((d, p, 2, nxt[3], r + (nxt[2][1:] if nxt[2][0] == r[-1] else nxt[2])))
                i += 2
                continue
            want.append((d, p, 1, t, r))
            i += 1
    # a pair uses up its second table, so a link behind it starts anew: runs of links pair from their start
    got = reconcile.pair_merged(spark.createDataFrame(rows, "doc bigint, page bigint, rows array<int>, is_truncated boolean, is_continuation boolean")).collect()
    assert sorted((r["doc"], r["page"], r["n_tables"], r["is_truncated"], r["rows"]) for r in got) == sorted(want)


def test_split_over_hollow(spark):
    t = [(d, 1, R.randint(1, 200)) for d in range(60)]
    hollow = [(d, p) for d in range(60) for p in range(2, 2 + d % 7)] + [(d, 20) for d in range(60)]
    want = []
    for d, p, n in t:
        parts = d % 7 + 1
        if parts > 1 and 3 * parts <= n <= 40 * parts:
            want += [(d, p + k, n // parts + (k < n % parts)) for k in range(parts)]
    got = reconcile.split_over_hollow(spark.createDataFrame(t, "doc bigint, page bigint, n_rows bigint"), spark.createDataFrame(hollow, "doc bigint, page bigint")).collect()
    assert sorted((r["doc"], r["to_page"], r["n"]) for r in got) == sorted(want)


def test_similar(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away"
    texts = [base, base.replace("quick", "quack"), "something else entirely here", base, base + "!"]
    rows = [("d", k, k, k, t) for k, t in enumerate(texts)]
    got = {r["ord"]: r["similarity"] for r in reconcile.similar(spark.createDataFrame(rows, "source string, ord bigint, page bigint, chunk bigint, content string")).collect()}
    want = {k: round(difflib.SequenceMatcher(None, texts[k], texts[k + 1]).ratio(), 6) for k in range(4)}
    assert got == pytest.approx({k: v for k, v in want.items() if v > 0.9})


GOLDEN = [
    ([["a", "b", "c"], ["1", "2", "3"], ["4", "5", "6"]], "| a | b | c |\n| --- | --- | --- |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |"),
    ([["a", "b"], ["", "2"]], "| a | b |\n| --- | --- |\n|  | 2 |"),
    ([["only", "header"]], "| only | header |\n| --- | --- |"),
    ([], ""),
    ([["one"], ["x"], ["y"]], "| one |\n| --- |\n| x |\n| y |"),
    ([["p|q"], [None]], "| p|q |\n| --- |\n| None |"),
]


def test_gfm(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(GOLDEN)], "i int, r array<array<string>>")
    got = {r["i"]: (r["md"], r["ok"]) for r in df.select("i", sections.gfm(F.col("r")).alias("md")).withColumn("ok", sections.valid_gfm(F.col("md"))).collect()}
    for i, (rows, md) in enumerate(GOLDEN):
        assert got[i] == (md, bool(rows))


def test_answers(spark):
    raw = ['{"blocks": [{"content": "x", "page_number": 2}]}', 'a {"blocks": [{"content": "y"}]} b', '```json\n{"blocks": []}\n```', '{"other": 1}', "none", ""]
    got = [r["n"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string").select("i", F.size(extraction.parsed_answer(F.col("x"))).alias("n")).orderBy("i").collect()]
    assert got == [1, 1, 0, 0, 0, 0]


def test_located(spark):
    rows = [("d", 0, "2", [1, 2, 3]), ("d", 1, None, [1, 2, 3]), ("d", 2, "x9", [1, 2, 3]), ("d", 3, "7", [1, 2, 3]), ("d", 4, "3", [1, 2, 3]), ("e", 0, None, [1])]
    got = [(r["source"], r["page"], r["inferred"]) for r in extraction.located(spark.createDataFrame(rows, "source string, ord int, page_number string, targets array<int>"), ["source"]).orderBy("source", "ord").collect()]
    assert [x[1] for x in got] == [2, 2, 2, 0, 3, 0]


def test_vision_tokens(spark):
    assert spark.range(1).select(profile.vision_tokens(F.lit(612.0), F.lit(792.0)).alias("t")).first()["t"] == 1105


def test_windows_share_one_exchange(spark):
    rows = [("d", 1, "paragraph", "x", 0)]
    b = spark.createDataFrame(rows, "source string, page bigint, block_type string, content string, seq bigint").repartition(3)
    plan = reconcile.drop_adjacent_duplicates(reconcile.canonical(b))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(source") == 1


def test_full_composition_links_lists_and_moves_headings(spark):
    rows = [("a", 1, "paragraph", "one", 0, 0, False, False), ("a", 1, "paragraph", "one", 0, 1, False, False), ("a", 2, "heading", "Head", 0, 2, False, False), ("a", 3, "paragraph", "Text", 1, 3, True, False), ("a", 4, "list_item", "x", 1, 4, True, False), ("a", 5, "list_item", "y", 2, 5, False, True)]
    b = spark.createDataFrame(rows, "source string, page bigint, block_type string, content string, chunk bigint, seq bigint, is_truncated boolean, is_continuation boolean")
    got = [(r["content"], r["chunk"], r["continued_from"], r["risk"]) for r in reconcile.full(b).orderBy("ord").collect()]
    assert got == [("one", 0, None, False), ("Head", 1, None, False), ("Text", 1, None, False), ("x", 1, None, True), ("y", 2, 4, False)]


def test_table_rows(spark):
    own = ['[["a", "b"], [1, null]]', "[['a', 'b'], [None, True]]", "no rows", "[]", None, '["a"]', "[['it is None', 'x']]"]
    got = [r[0] for r in spark.createDataFrame([(x, i) for i, x in enumerate(own)], "x string, i int").orderBy("i").select(sections.table_rows(F.col("x"))).collect()]
    assert got == [[["a", "b"], ["1", None]], [["a", "b"], [None, "True"]], None, None, None, None, [["it is None", "x"]]]
