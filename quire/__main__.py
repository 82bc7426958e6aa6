"""python -m quire ROOT COMMAND ...: ingest FOLDER | list | toc | search WORDS | section NAME | page DOC N | query QUESTION | export"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .engine import Engine
from .sources import office


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="quire", description=__doc__)
    p.add_argument("root")
    p.add_argument("command", choices=["ingest", "list", "toc", "search", "section", "page", "query", "export"])
    p.add_argument("words", nargs="*")
    p.add_argument("--rows", type=int, default=100, help="rows of a printed report")
    a = p.parse_args(argv)
    engine = Engine(spark or SparkSession.builder.getOrCreate(), a.root)
    said = " ".join(a.words)
    if a.command == "ingest":
        engine.ingest(office.pages_of(engine.spark, said).where("error is null").select("doc", "page", "text"))
    elif a.command == "export":
        engine.export()
    else:
        calls = {"list": engine.list, "toc": engine.toc, "search": lambda: engine.search(said), "section": lambda: engine.section(said), "page": lambda: engine.page(a.words[0], int(a.words[1])), "query": lambda: engine.query(said)}
        calls[a.command]().show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
