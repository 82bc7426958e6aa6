"""The pipeline's stages on a small corpus, each held against brute force on its own input."""

import random

import brute
import corpus_pipeline
import pytest

from quire.llm import quality

RND = random.Random(21)
WORDS = [RND.choice("bcdfgklmnprst") + RND.choice("aeiou") + RND.choice(["n", "r", "st", ""]) for _ in range(300)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = [], []
    items = [(k, " ".join(RND.choices(WORDS, k=40))) for k in range(5)]
    for k in range(500):
        w = RND.choices(WORDS, k=RND.randint(30, 90))
        bad = k % 5 == 0
        t = " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w) + "."
        if k % 50 == 3:
            t += " " + " ".join(items[k % 5][1].split()[5:30])
        if k % 40 == 7:
            t += ' token = "' + "".join(RND.choices("0123456789abcdef", k=40)) + '"'
        docs.append((k, t, "en", f"src{k % 3}", len(t)))
        if k % 2:
            labels.append((k, int(not bad), 0))
        if k % 10 == 0:
            labels.append((k, int(not bad), 0))
    docs += [(1000 + i, t + " again" if i % 2 else t, lang, src, len(t)) for i, (_, t, lang, src, _) in enumerate(docs[1:60:2])]
    docs += [(2000, None, None, None, None), (2001, "", "en", "src0", 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        if name == "quality":
            labels = spark.read.parquet(f"{corpus}/labels.parquet")
            good = {r["doc_id"] for r in quality.assess(docs, labels).collect() if r["predicted"]}
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r for r in docs.collect()}
        seen[name] = set(after)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "quality":
            assert set(after) == good and not any(i % 5 == 0 and i < 500 for i in good)
            assert sum(i % 5 != 0 for i in good if i < 500) > 390
        elif name == "near_dedup":
            want = brute.near(list(before.items()))
            assert set(after) == {i for i, (_, c) in want.items() if i == c} and len(after) < len(before)
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
            want = brute.hits(list(before.items()), items)
            assert set(after) == {i for i, (n, h, _, _) in want.items() if not (h and 20 * h >= n)} and len(after) < len(before)
        elif name == "secrets":
            assert set(after) == set(before)
            for i, r in after.items():
                spans = brute.secrets(before[i])
                assert (not brute.secrets(r["text"]) and "[SECRET]" in r["text"]) if spans else r["text"] == before[i]
        else:
            assert set(after) == set(before) and all(r["lossless"] for i, r in after.items() if before[i] is not None)


def test_near_dedup_stage_takes_four_fifths(spark, corpus):
    """Near copies of a similarity in [0.80, 0.85) go; a pair below 0.80 stays."""
    w = [f"w{k}" for k in range(104)]
    own = [(1, w), (2, [*w[:50], "x", *w[51:60], "y", *w[61:]]), (3, [f"v{k}" for k in range(104)]), (4, [f"z{k}" if k in (20, 50, 80) else f"v{k}" for k in range(104)])]
    own = [(i, " ".join(x)) for i, x in own]
    for (i, x), (j, y), low, high in ((own[0], own[1], 0.8, 0.85), (own[2], own[3], 0, 0.8)):
        x, y = brute.shingles(x), brute.shingles(y)
        assert low <= len(x & y) / len(x | y) < high
    d = spark.createDataFrame(own, "doc_id bigint, text string")
    assert {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, d, corpus).collect()} == {1, 3, 4}


def test_run(spark, corpus):
    out = corpus_pipeline.run(spark, corpus)
    assert out.count() > 300 and {"doc_id", "ids", "lossless"} <= set(out.columns)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
