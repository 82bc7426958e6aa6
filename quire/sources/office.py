"""Office files to HTML with the standard library alone (they are zip archives of XML), and pages of files of any readable kind.

Sheets become a heading and a table each; falsy cells (none, 0, false) are blank. Paragraphs of documents become h1 to h3, li or p by
their style's name; slides a heading, their paragraphs, tables, chart series and pictures. Pictures are data URIs whose type is told by
their first bytes. Files that can't be read give an error row, never an exception of the job.
"""

from __future__ import annotations

import base64
import io
import posixpath
import re
import zipfile
from html import escape
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Extensions that are read as text; the office kinds are below, images give one page without text.
TEXT = ("txt", "md", "csv", "html", "htm", "json", "xml", "yaml", "yml")
IMAGES = ("jpg", "jpeg", "png", "gif", "webp")
LINES = 40
_MAGIC = ((b"\x89PNG", "image/png"), (b"\xff\xd8", "image/jpeg"), (b"GIF8", "image/gif"), (b"RIFF", "image/webp"))


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


def _attribute(e, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if k.rpartition("}")[2] == name), None)


def _under(e, name: str):
    return [x for x in e.iter() if _tag(x) == name]


class _Archive:
    def __init__(self, raw: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(raw))

    def xml(self, name: str):
        return ElementTree.fromstring(self.zip.read(name))

    def has(self, name: str) -> bool:
        return name in self.zip.namelist()

    def links(self, name: str) -> dict[str, str]:
        """Targets by id of a part's relations."""
        folder, own = posixpath.split(name)
        rels = posixpath.join(folder, "_rels", f"{own}.rels")
        if not self.has(rels):
            return {}
        return {x.get("Id"): posixpath.normpath(posixpath.join(folder, x.get("Target"))) if not x.get("Target").startswith("/") else x.get("Target")[1:] for x in self.xml(rels)}

    def picture(self, name: str) -> str:
        raw = self.zip.read(name)
        kind = next((k for m, k in _MAGIC if raw.startswith(m)), "image/png")
        return f'<img src="data:{kind};base64,{base64.b64encode(raw).decode()}"/>'


def _table(rows) -> str:
    return "<table>" + "".join("<tr>" + "".join(f"<td>{escape(c)}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def _text(e) -> str:
    return "".join(x.text or "" for x in _under(e, "t"))


def _pictures(a: _Archive, e, links) -> list[str]:
    return [a.picture(links[r]) for x in _under(e, "blip") if (r := _attribute(x, "embed")) in links]


def xlsx_html(raw: bytes) -> str:
    a = _Archive(raw)
    shared = [_text(x) for x in a.xml("xl/sharedStrings.xml")] if a.has("xl/sharedStrings.xml") else []
    links, out = a.links("xl/workbook.xml"), []
    for sheet in _under(a.xml("xl/workbook.xml"), "sheet"):
        rows = []
        for row in _under(a.xml(links[_attribute(sheet, "id")]), "row"):
            cells: dict[int, str] = {}
            for c in _under(row, "c"):
                at = 0
                for ch in re.match("[A-Z]*", c.get("r", ""))[0]:
                    at = 26 * at + ord(ch) - 64
                v = next((x.text or "" for x in _under(c, "v")), "")
                kind = c.get("t", "n")
                own = shared[int(v)] if kind == "s" and v else _text(c) if kind == "inlineStr" else {"1": "True"}.get(v, "") if kind == "b" else v
                cells[at or len(cells) + 1] = "" if kind == "n" and re.fullmatch(r"-?0*\.?0*", own) else own
            rows.append([cells.get(k, "") for k in range(1, max(cells, default=0) + 1)])
        out.append(f"<h2>{escape(sheet.get('name', ''))}</h2>{_table(rows)}")
    return "\n".join(out)


def docx_html(raw: bytes) -> str:
    a = _Archive(raw)
    part = "word/document.xml"
    links, names = a.links(part), {}
    if a.has("word/styles.xml"):
        names = {_attribute(s, "styleId"): _attribute(n, "val") or "" for s in _under(a.xml("word/styles.xml"), "style") for n in s if _tag(n) == "name"}
    out = []
    for e in next(x for x in a.xml(part) if _tag(x) == "body"):
        if _tag(e) == "p":
            style = next((_attribute(x, "val") or "" for x in _under(e, "pStyle")), "")
            style, text = names.get(style, style).lower(), _text(e).strip()
            level = re.search(r"heading ?([1-3])", style)
            tag = f"h{level[1]}" if level else "li" if "list" in style else "p"
            out += [f"<{tag}>{escape(text)}</{tag}>"] if text else []
            out += _pictures(a, e, links)
        elif _tag(e) == "tbl":
            out.append(_table([[_text(c) for c in r if _tag(c) == "tc"] for r in e if _tag(r) == "tr"]))
    return "\n".join(out)


def _chart(a: _Archive, name: str) -> str:
    out = []
    for s in _under(a.xml(name), "ser"):
        told = lambda k, s=s: [v.text or "" for x in s if _tag(x) == k for v in _under(x, "v")]
        out.append(f"<p>{escape(' '.join(told('tx')) or 'series')}: {escape(', '.join(f'{c}={v}' for c, v in zip(told('cat'), told('val'))))}</p>")
    return "\n".join(out)


def pptx_html(raw: bytes) -> str:
    a = _Archive(raw)
    part = "ppt/presentation.xml"
    links, out = a.links(part), []
    for k, s in enumerate(_under(a.xml(part), "sldId"), 1):
        slide = links[_attribute(s, "id") if not (_attribute(s, "id") or "").isdigit() else next(v for n, v in s.attrib.items() if n.endswith("}id"))]
        own = a.links(slide)
        out.append(f"<h2>Slide {k}</h2>")
        tree = next(iter(_under(a.xml(slide), "spTree")))
        for e in tree.iter():
            if _tag(e) == "sp":
                out += [f"<p>{escape(t)}</p>" for p in _under(e, "p") if (t := _text(p).strip())]
            elif _tag(e) == "tbl":
                out.append(_table([[_text(c) for c in r if _tag(c) == "tc"] for r in e if _tag(r) == "tr"]))
            elif _tag(e) == "chart" and _attribute(e, "id") in own:
                out.append(_chart(a, own[_attribute(e, "id")]))
            elif _tag(e) == "pic":
                out += _pictures(a, e, own)
    return "\n".join(out)


OFFICE = {"xlsx": xlsx_html, "docx": docx_html, "pptx": pptx_html}


def made(kind: str, title: str, rows: list[list[str]], lines: list[str]) -> bytes:
    """A small file of a kind (xlsx, docx, pptx) with a title, lines of text and a table: for samples and tests."""
    ns = 'xmlns:w="urn:w" xmlns:a="urn:a" xmlns:r="urn:r" xmlns:p="urn:p"'
    rel = lambda *xs: f"<Relationships>{''.join(f'<Relationship Id={chr(34)}{i}{chr(34)} Target={chr(34)}{t}{chr(34)}/>' for i, t in xs)}</Relationships>"
    if kind == "xlsx":
        cell = lambda v: f'<c t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        sheet = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [*([x] for x in lines), *rows])
        parts = {"xl/workbook.xml": f'<workbook {ns}><sheets><sheet name="{escape(title)}" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": rel(("r1", "worksheets/sheet1.xml")), "xl/worksheets/sheet1.xml": f"<worksheet><sheetData>{sheet}</sheetData></worksheet>"}
    else:
        x = "w" if kind == "docx" else "a"
        run = lambda t: f"<{x}:p><{x}:r><{x}:t>{escape(t)}</{x}:t></{x}:r></{x}:p>"
        table = f"<{x}:tbl>{''.join(f'<{x}:tr>' + ''.join(f'<{x}:tc>{run(c)}</{x}:tc>' for c in r) + f'</{x}:tr>' for r in rows)}</{x}:tbl>"
        if kind == "docx":
            head = f'<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>{escape(title)}</w:t></w:r></w:p>'
            parts = {"word/document.xml": f"<w:document {ns}><w:body>{head}{''.join(map(run, lines))}{table}</w:body></w:document>"}
        else:
            body = f"<p:sp>{''.join(map(run, [title, *lines]))}</p:sp><p:graphicFrame>{table}</p:graphicFrame>"
            parts = {"ppt/presentation.xml": f'<p:presentation {ns}><p:sldIdLst><p:sldId r:id="r1"/></p:sldIdLst></p:presentation>', "ppt/_rels/presentation.xml.rels": rel(("r1", "slides/slide1.xml")), "ppt/slides/slide1.xml": f"<p:sld {ns}><p:cSld><p:spTree>{body}</p:spTree></p:cSld></p:sld>"}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


_ENDS = re.compile(r"(?i)</(?:p|li|h[1-6]|tr|table)>|<br ?/?>")


def lines_of(html: str) -> list[str]:
    """The lines of a converted file's text: one a block or table row, cells apart by a bar."""
    from html import unescape

    x = re.sub("(?i)<img[^>]*>", "", html)
    x = re.sub("(?i)</td><td[^>]*>", " | ", x)
    return [t for raw in _ENDS.split(x) if (t := " ".join(unescape(re.sub("<[^>]*>", " ", raw)).split()))]


def _read(batches):
    for b in batches:
        for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            kind, text, error = path.rpartition(".")[2].lower(), "", None
            try:
                if kind in OFFICE:
                    text = "\n".join(lines_of(OFFICE[kind](raw)))
                elif kind == "pdf":
                    error = "no reader for pdf: register a provider"
                elif kind not in IMAGES:
                    text = raw.decode("utf-8", errors="replace")
            except Exception as e:  # noqa: BLE001  a broken file becomes a row
                error = f"{type(e).__name__}: {e}"
            own = text.split("\n")
            pages = ["\n".join(own[i : i + LINES]) for i in range(0, len(own), LINES)]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(pages)), pa.array([kind] * len(pages)), pa.array(range(1, len(pages) + 1), pa.int64()), pa.array(pages, pa.string()), pa.array([error] * len(pages), pa.string())], ["path", "kind", "page", "text", "error"])


def pages_of(spark: SparkSession, folder: str, kinds: tuple[str, ...] = (*TEXT, *OFFICE, *IMAGES)) -> DataFrame:
    """doc, path, kind, page, text and error of all files of these kinds under a folder of any store that Spark reads; LINES lines
    a page, images one page without text. A folder without such files gives no rows. doc is the file's name without its ending."""
    ends = "*.{" + ",".join(x for k in kinds for x in (k, k.upper())) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", ends).load(folder)
    x = files.select("path", "content").mapInArrow(_read, "path string, kind string, page bigint, text string, error string")
    return x.select(F.regexp_replace(F.substring_index("path", "/", -1), "\\.[^.]*$", "").alias("doc"), "path", "kind", "page", "text", "error")
