"""quire: Spark-first analytics over multi-page documents and their typed blocks."""

__version__ = "0.1.0"
