"""Block providers: a registry of classes that turn a chunk's pages into blocks.

A provider runs as mapInArrow over pages that are dealt by (document, chunk) and sorted by page, so that a remote one
sees a whole chunk at a time and its concurrency is the number of partitions. Only the native-text provider ships; it
needs no network. Others register themselves: `providers.register("name", MyProvider)`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "doc string, chunk bigint, page bigint, ord bigint, block_type string, content string, level bigint, in_tok bigint, out_tok bigint, error string"
_ARROW = [("doc", pa.string()), ("chunk", pa.int64()), ("page", pa.int64()), ("ord", pa.int64()), ("block_type", pa.string()), ("content", pa.string()), ("level", pa.int64()), ("in_tok", pa.int64()), ("out_tok", pa.int64()), ("error", pa.string())]


class Provider(Protocol):
    """blocks(pages): (page, type, content) of each block of a chunk's (page, text) pairs; a heading's level may be a fourth value."""

    def blocks(self, pages: list[tuple[int, str]]) -> Iterable[tuple]: ...


class NativeText:
    """Lines of a page's text: short ones without a final stop are headings, the others paragraphs. A heading's level is told by its
    marks (## two, 1.2.3 three), else open."""

    def blocks(self, pages):
        for page, text in pages:
            for line in (x.strip() for x in (text or "").split("\n")):
                marks = re.match(r"(#{1,6})\s+(?=\S)|([0-9]+(?:\.[0-9]+)*)\.?\s+(?=\S)", line)
                short = len(line) <= 24 and line[-1:] not in (".", "!", "?")
                if line and (short or marks and marks[1]):
                    yield page, "heading", line[marks.end() :] if marks and marks[1] else line, (len(marks[1]) if marks[1] else marks[2].count(".") + 1) if marks else None
                elif line:
                    yield page, "paragraph", line


_REGISTRY: dict[str, Callable[[], Provider]] = {"native": NativeText}


def register(name: str, make: Callable[[], Provider]) -> None:
    _REGISTRY[name] = make


def get(name: str) -> Provider:
    if name not in _REGISTRY:
        raise ValueError(f"no provider {name!r}; registered: {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name]()


#: Clouds and the settings that each needs before a client is made.
CREDENTIALS = {"anthropic": ("ANTHROPIC_API_KEY",), "bedrock": ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY"), "vertex": ("GOOGLE_CLOUD_PROJECT",), "azure": ("AZURE_API_KEY", "AZURE_ENDPOINT")}
_CLIENTS: dict[str, Callable[[dict[str, str]], object]] = {}


def register_client(cloud: str, make: Callable[[dict[str, str]], object]) -> None:
    """make gets the checked settings. None ships: the engine holds no credentials and calls no network by itself."""
    _CLIENTS[cloud] = make


def client(cloud: str, settings: dict[str, str]):
    """A client for a cloud, after its settings are there."""
    if cloud not in CREDENTIALS:
        raise ValueError(f"no cloud {cloud!r}; known: {', '.join(sorted(CREDENTIALS))}")
    gone = [k for k in CREDENTIALS[cloud] if not settings.get(k)]
    if gone:
        raise ValueError(f"{cloud} needs {', '.join(gone)}: not set")
    if cloud not in _CLIENTS:
        raise ValueError(f"no client for {cloud!r} is registered")
    return _CLIENTS[cloud]({k: settings[k] for k in CREDENTIALS[cloud]})


def attempt(provider: Provider, pages: list[tuple[int, str]], retries: int = 3, wait: Callable[[float], None] | None = None):
    """Blocks and error of a chunk; only errors that tell of a rate limit are tried again, after 2, 4, 8 ... seconds."""
    for k in range(retries + 1):
        try:
            return list(provider.blocks(pages)), None
        except Exception as e:  # noqa: BLE001  a provider's error becomes a row
            error = f"{type(e).__name__}: {e}"
            if k == retries or not any(w in error.lower() for w in ("overload", "rate", "429", "too_many")):
                return [], error
            if wait:
                wait(2.0 ** (k + 1))
    return [], None


def _rows(provider: Provider, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(key, pages):
        blocks, error = attempt(provider, pages)
        used = sum(len(t or "") for _, t in pages) // 4
        made = sum(len(b[2]) for b in blocks) // 4
        rows = [(*key, p, i, kind, content, more[0] if more else None, used, made, None) for i, (p, kind, content, *more) in enumerate(blocks)]
        rows = rows or [(*key, p, i, "extraction_failure", "", None, used, 0, error or "no block") for i, (p, _) in enumerate(pages)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _ARROW)], [n for n, _ in _ARROW])

    key, pages = None, []
    for b in batches:
        for doc, chunk, page, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (doc, chunk) != key and pages:
                yield out(key, pages)
                pages = []
            key = (doc, chunk)
            pages.append((page, text))
    if pages:
        yield out(key, pages)


def run(provider: Provider, pages: DataFrame) -> DataFrame:
    """pages (doc, chunk, page, text) to blocks (SCHEMA)."""
    p = pages.select("doc", "chunk", "page", "text").repartition("doc", "chunk").sortWithinPartitions("doc", "chunk", "page")
    return p.mapInArrow(lambda it: _rows(provider, it), SCHEMA)
