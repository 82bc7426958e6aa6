"""The registered queries of this subpackage: thin, over whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, html_text, licenses, near_dedup, near_prints, oracles, pieces, pii, quality, secrets, url_rules


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weak_supervision_pii(spark, sf_dir):
    return pii.digest(pii.scan(_table(spark, sf_dir, "documents")))


def op2_edit_embedding(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return fingerprints.compared(docs, near_prints.near_classes(docs))


def op3_sampled_pieces(spark, sf_dir):
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_dedup(_table(spark, sf_dir, "documents"), 85)


def op5_license_rules(spark, sf_dir):
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_block_rules(spark, sf_dir):
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op7_winnowing(spark, sf_dir):
    return decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_secret_network(spark, sf_dir):
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op9_subword_quality(spark, sf_dir):
    return quality.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def labelled_urls(pages, labels):
    """URLs with a verdict from labels.quality; these pages name their document by the number in the path."""
    number = F.regexp_extract(url_rules.path(F.col("url")), "^/[a-z]+/([0-9]{1,18})", 1).try_cast("bigint")
    verdict = F.when(F.col("quality") == 0, "block").when(F.col("quality") == 1, "allow")
    known = labels.groupBy(F.col("doc_id").alias("number")).agg(F.min(verdict).alias("verdict"))
    return pages.select("url", number.alias("number")).join(known, "number").select("url", "verdict")


def op10_url_rules(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    mined = url_rules.mine(labelled_urls(pages, _table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, mined)


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_weak_supervision_pii, op2_edit_embedding, op3_sampled_pieces, op4_minhash_near_dedup, op5_license_rules, op6_block_rules, op7_winnowing, op8_secret_network, op9_subword_quality, op10_url_rules, pipeline)}
#: The others have parts that SQL can't express (trained models, sampled pieces, walks, block rules); tests hold those against brute force.
ORACLE = {"op4_minhash_near_dedup": oracles.OP4, "op7_winnowing": oracles.OP7}
