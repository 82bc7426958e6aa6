"""All registered queries of the document engine with their SQL equivalents."""

from __future__ import annotations

from . import profiling, querying, reconciling, sourcing, storing  # noqa: F401
from .registry import ORACLE, QUERIES

#: Keyword search over the sections of reconciled blocks: it runs through the whole engine.
FLAGSHIP = "qry03_search"
__all__ = ["FLAGSHIP", "ORACLE", "QUERIES"]
