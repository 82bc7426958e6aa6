"""The corpus pipeline: STAGES over documents, each written as Parquet and reread as the next one's documents.

For all stages: null text counts as empty and null doc_id is allowed; columns other than doc_id, text and n_chars pass through
untouched, whatever their names; repeated rows are rows of their own (but near copies of each other); an empty table gives an empty
table of the same columns. What a stage does with each of these is said at the stage.
"""

from __future__ import annotations

import posixpath
import uuid

from quire.llm import decontaminate, near_dedup, pieces, quality, secrets
from quire.llm.common import shared_folder

#: SQL can't express the trained stages (quality, secrets) nor the sampled last one; tests hold each against brute force.
ORACLE_SQL = None


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier rejects (score below 0.7) go. Null and empty texts get the calibrated score of a zero vector, and
    stay or go by it; equal texts share a score, whatever their id; a score of exactly 0.7 stays."""
    return quality.kept_documents(docs, _table(spark, sf_dir, "labels"))


def near_dedup_stage(spark, docs, sf_dir):
    """One document of each group of near copies (similarity of 0.8 or more) stays: the one with the smallest doc_id, and one row of
    it if that id is repeated. Documents without words, and rows without doc_id, are near nothing and stay."""
    return near_dedup.kept_documents(docs, 80)


def decontamination_stage(spark, docs, sf_dir):
    """Documents go in which at least a twentieth of the words stand in benchmark windows (exactly a twentieth too). Documents without
    words stay."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def secrets_stage(spark, docs, sf_dir):
    """Secrets are masked and n_chars (where there is such a column) counts what is left; every row stays. Null texts stay null."""
    return secrets.redacted_documents(docs)


def pieces_stage(spark, docs, sf_dir):
    """Pieces of each text, one row each; decoding them gives the text back. Null texts have null pieces, empty ones none; equal
    rows get equal pieces, and rows without doc_id are drawn as if it were 0."""
    return pieces.encode(docs)


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("decontamination", decontamination_stage), ("secrets", secrets_stage), ("pieces", pieces_stage)]


def run(spark, sf_dir):
    """The pieces of what is left after all stages. Each stage's documents are dropped once the next stage is written; the last result
    stays in the shared folder, as the returned frame reads it."""
    folder = posixpath.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs, before = _table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        at = posixpath.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if before is not None:
            gone = spark._jvm.org.apache.hadoop.fs.Path(before)
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
        before = at
    return docs
