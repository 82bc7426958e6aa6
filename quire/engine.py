"""The engine's front: documents in, tables of blocks and sections out, and queries over them.

    engine = Engine(spark, "/shared/library")
    engine.ingest(pages)                    # doc, page, text
    engine.search("budget"), engine.section("intro"), engine.page("report", 3), engine.query("what is the budget")
    engine.rerun_chunk("report", 2, pages)
    engine.export()                         # manifest, index, section files, whole documents, raw blocks

Tables lie under the root as Parquet, partitioned by document: writing a document again replaces its partitions only.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import chunking, reconcile, retrieval, sections
from .sources import providers, sinks


class Engine:
    def __init__(self, spark: SparkSession, root: str, provider: str = "native"):
        self.spark, self.root, self.provider = spark, root, providers.get(provider)

    def _path(self, name: str) -> str:
        return posixpath.join(self.root, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(self._path(name))

    def _blocks(self, pages: DataFrame) -> DataFrame:
        """Blocks of planned chunks (doc, chunk, page, text) from the provider, in the engine's columns."""
        b = providers.run(self.provider, pages)
        c = F.col("content")
        return b.select(
            F.col("doc").alias("source"), "page", "chunk", "ord", "block_type", "content",
            F.when(F.col("block_type") == "heading", F.col("level")).alias("heading_level"),
            c.rlike("^\\p{Ll}").alias("is_continuation"), (~c.rlike("[.!?]$")).alias("is_truncated"), "in_tok", "out_tok", "error",
        ).withColumnRenamed("ord", "seq_in_chunk")

    @staticmethod
    def plan(pages: DataFrame) -> DataFrame:
        """pages (doc, page, text) with chunk."""
        tokens = pages.select(F.col("doc").alias("source"), "page", (85 + 170 * (1 + F.expr("char_length(coalesce(text, '')) div 512"))).cast("bigint").alias("tokens"), chunking.budget(F.lit(False)).alias("budget"))
        chunks = chunking.greedy_chunks(tokens).select(F.col("source").alias("doc"), "page", "chunk")
        return pages.join(chunks, ["doc", "page"])

    def _store(self, raw: DataFrame) -> None:
        seq = F.col("chunk") * F.lit(1_000_000) + F.col("seq_in_chunk")
        marked = sections.cut(reconcile.full(sections.levelled(raw.withColumn("seq", seq), self._stored("toc"))))
        self._write(marked, "blocks")
        stored = self.table("blocks")
        secs = sections.named(sections.parents(sections.sections(stored)))
        levels = sections.clamped(stored.where("block_type = 'heading'"), ["source", "sec"]).select("source", "ord", F.col("level_out").alias("level"))
        md = sections.markdown(stored.join(levels, ["source", "ord"], "left"))
        self._write(secs.join(sections.bodies(md), ["source", "sec"], "left").na.fill("", ["body"]), "sections")

    def _stored(self, name: str) -> DataFrame | None:
        """A table, or None if it was never written."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
        return self.table(name) if at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at) else None

    def ingest(self, pages: DataFrame, toc: DataFrame | None = None) -> None:
        """pages (doc, page, text); toc (doc, title, level, page): the documents' own tables of contents, which then tell heading levels."""
        if toc is not None:
            self._write(toc.select(F.col("doc").alias("source"), "title", F.col("level").cast("bigint").alias("level"), F.col("page").cast("bigint").alias("page")), "toc")
        raw = self._blocks(self.plan(pages))
        self._write(raw, "raw_blocks")
        docs = pages.select(F.col("doc").alias("source")).distinct()
        self._store(self.table("raw_blocks").join(docs, "source", "left_semi"))

    def rerun_chunk(self, doc: str, chunk: int, pages: DataFrame) -> None:
        """Extracts one chunk of a document again and puts it in place of the old one."""
        own = pages.where(F.col("doc") == doc)
        again = self._blocks(self.plan(own).where(F.col("chunk") == chunk))
        old = self.table("raw_blocks").where(F.col("source") == doc).select(again.columns)
        spliced = reconcile.spliced(old, again)
        kept = posixpath.join(self.root, "_rerun")
        spliced.write.mode("overwrite").parquet(kept)  # the old table can't be read while it is written
        self._write(self.spark.read.parquet(kept), "raw_blocks")
        self._store(self.spark.read.parquet(kept))

    def search(self, term: str) -> DataFrame:
        return retrieval.search(self.table("blocks"), term)

    def section(self, fragment: str) -> DataFrame:
        return self.table("sections").where(F.contains(F.lower("filename"), F.lit(fragment.lower()))).orderBy("source", "sec")

    def page(self, doc: str, n: int) -> DataFrame:
        b = self.table("blocks").where((F.col("source") == doc) & (F.col("page") == n))
        return b.orderBy("ord").select("ord", "block_type", F.substring("content", 1, 200).alias("preview"))

    def list(self) -> DataFrame:
        return self.table("sections").groupBy("source").agg(F.count("*").alias("n_sections"), F.max("page_end").alias("pages"))

    def query(self, question: str, top: int = 3, least: int = 2) -> DataFrame:
        """The best sections for a question with their text; lexical scores of all its words, no network."""
        terms = list(dict.fromkeys(w.lower() for w in question.split())) or [""]
        scores = retrieval.lexical_scores(self.table("blocks"), terms)
        return retrieval.ranked(scores, top, least).join(self.table("sections").select("source", "sec", "filename", "body"), ["source", "sec"])

    def toc(self) -> DataFrame:
        return self.table("sections").select("source", "sec", "level", "title", "filename", "pages").orderBy("source", "sec")

    def export(self, root: str | None = None) -> None:
        """Manifest, index, section files with front matter, whole documents and raw blocks under root; files of earlier exports go,
        files that aren't the engine's stay."""
        root = root or self._path("export")
        blocks, secs = self.table("blocks"), self.table("sections")
        number = F.col("content").try_cast("bigint")
        footers = blocks.where((F.col("block_type") == "footer") & number.isNotNull()).select("source", "page", number.alias("num"))
        sinks.save_text(sinks.manifest(secs, self._stored("toc"), reconcile.suppressed(blocks), reconcile.numbering_gaps(footers)), root, "manifest")
        sinks.save_text(sinks.index(secs), root, "index")
        sinks.save_text(secs.withColumn("value", F.concat(sections.front_matter(secs), F.lit("\n"), "body")), root, "sections", by=("source", "filename"))
        levels = sections.clamped(blocks.where("block_type = 'heading'"), ["source"]).select("source", "ord", F.col("level_out").alias("level"))
        whole = sections.document_text(sections.page_breaks(sections.markdown(blocks.join(levels, ["source", "ord"], "left"))))
        sinks.save_text(whole, root, "output", "md")
        sinks.save_json(self.table("raw_blocks"), root, "raw_blocks")
