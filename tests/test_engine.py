"""The front, sinks, providers and streams."""

import os

import pytest
from pyspark.sql import functions as F

from quire.engine import Engine
from quire.operators import chunking
from quire.sources import providers, sinks
from quire.streaming import usage

PAGES = [("a", 1, "Intro\nThe budget is large.\nMore text here."), ("a", 2, "Plan\nWe plan the budget.\n"), ("b", 1, None), ("b", 2, "Other\nNothing of note.")]


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(spark, str(tmp_path_factory.mktemp("library")))
    e.ingest(spark.createDataFrame(PAGES, "doc string, page bigint, text string"))
    return e


def test_ingest_and_search(engine):
    assert {r["source"] for r in engine.list().collect()} == {"a", "b"}
    assert {r["line"] for r in engine.search("budget").collect()} == {"The budget is large.", "We plan the budget."}
    assert engine.page("a", 1).count() == 3 and engine.section("INTRO").count() >= 1
    assert engine.query("budget plan").count() >= 1


def test_rerun(spark, engine):
    new = [(d, p, "Intro\nThe budget is small." if (d, p) == ("a", 1) else t) for d, p, t in PAGES]
    engine.rerun_chunk("a", 0, spark.createDataFrame(new, "doc string, page bigint, text string"))
    lines = {r["line"] for r in engine.search("budget").collect()}
    assert "The budget is small." in lines and "The budget is large." not in lines and {r["source"] for r in engine.list().collect()} == {"a", "b"}


def test_failures_become_rows(spark):
    class Broken:
        def blocks(self, pages):
            raise RuntimeError("bad input")

    got = providers.run(Broken(), spark.createDataFrame([("a", 0, 1, "x"), ("a", 0, 2, "y")], "doc string, chunk bigint, page bigint, text string")).collect()
    assert [r["block_type"] for r in got] == ["extraction_failure"] * 2 and "bad input" in got[0]["error"]


def test_retries():
    class Busy:
        n = 0

        def blocks(self, pages):
            Busy.n += 1
            if Busy.n < 3:
                raise RuntimeError("429")
            return [(1, "paragraph", "x")]

    waits = []
    assert providers.attempt(Busy(), [(1, "x")], wait=waits.append) == ([(1, "paragraph", "x")], None) and waits == [2.0, 4.0]
    with pytest.raises(ValueError):
        providers.get("none")


def test_clean_keeps_unknown_files(spark, tmp_path):
    root = str(tmp_path)
    sinks.save_json(spark.range(3), root, "raw_blocks")
    (tmp_path / "mine.txt").write_text("x")
    assert sinks.clean(spark, root) == ["raw_blocks"] and os.listdir(root) == ["mine.txt"] and sinks.clean(spark, root) == []
    with pytest.raises(ValueError):
        sinks.save_json(spark.range(1), root, "mine.txt")


def test_streams_equal_batch(spark, tmp_path):
    rows = [(r, k, 7 * k, 100 + 90 * (k % 9)) for r in range(5) for k in range(60)]
    calls = spark.createDataFrame(rows, "run bigint, call bigint, sec bigint, tok bigint")
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    calls.where("call < 30").coalesce(1).write.parquet(src)
    usage.drain(usage.limited(usage.arriving(spark, src, "run bigint, call bigint, sec bigint, tok bigint"), 1000), out, cp)
    calls.where("call >= 30").coalesce(1).write.mode("append").parquet(src)
    usage.drain(usage.limited(usage.arriving(spark, src, "run bigint, call bigint, sec bigint, tok bigint"), 1000), out, cp)
    got = {(r["run"], r["call"]): r["wait"] for r in spark.read.parquet(out).collect()}
    assert got == {(r["run"], r["call"]): r["wait"] for r in chunking.limited(calls, 1000).collect()}


def test_usage_windows(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    d = spark.range(200).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("method"), F.col("id").alias("tokens"))
    d.coalesce(1).write.parquet(src)
    usage.drain(usage.usage(usage.arriving(spark, src, "ts timestamp, method string, tokens bigint")), out, cp)
    got = spark.read.parquet(out)
    batch = d.groupBy(F.window("ts", "10 minutes").start.alias("start"), "method").agg(F.count("*").alias("calls"), F.sum("tokens").alias("tokens"))
    n = got.count()
    assert n > 20 and got.join(batch, ["start", "method", "calls", "tokens"], "left_semi").count() == n


def test_levels_and_export(spark, tmp_path):
    """Levels from the table of contents, else from marks; exports hold all parts, and stale files go while others stay."""
    e = Engine(spark, str(tmp_path / "lib"))
    text = "# Start\nSome text here.\n## 1.2 Deep\nMore text here.\nPlain\nThe end of it."
    e.ingest(spark.createDataFrame([("a", 1, text), ("b", 1, text)], "doc string, page bigint, text string"), spark.createDataFrame([("b", "Start", 3, 1), ("b", "PLAIN ... 7", 1, 1)], "doc string, title string, level int, page int"))
    got = {(r["source"], r["content"]): r["heading_level"] for r in e.table("blocks").where("block_type = 'heading'").collect()}
    assert got == {("a", "Start"): 1, ("a", "1.2 Deep"): 2, ("a", "Plain"): 2, ("b", "Start"): 3, ("b", "1.2 Deep"): 2, ("b", "Plain"): 1}
    out = str(tmp_path / "out")
    os.makedirs(f"{out}/mine")
    for _ in range(2):
        e.export(out)
    import glob
    import json

    told = json.loads(open(glob.glob(f"{out}/manifest/source=b/*.txt")[0]).read())
    assert [x["title"] for x in told["toc"]] == ["PLAIN ... 7", "Start"] and told["page_numbering_audit"] == {"gaps": []} and told["header_footer_policy"]["suppressed_texts"] == []
    assert sorted(os.path.basename(x) for x in glob.glob(f"{out}/sections/source=a/*")) == ["filename=001_start.md", "filename=002_start__1_2_deep.md", "filename=003_start__plain.md"]
    assert "## 1.2 Deep" in open(glob.glob(f"{out}/output/source=a/*.txt")[0]).read()
    e.ingest(spark.createDataFrame([("a", 1, "# Only\nSome text.")], "doc string, page bigint, text string"))
    e.export(out)
    assert [os.path.basename(x) for x in glob.glob(f"{out}/sections/source=a/*")] == ["filename=001_only.md"] and os.path.isdir(f"{out}/mine")


def test_office_files(spark, tmp_path, capsys):
    """Files made here read back, broken ones give errors, and the command line takes a folder to answers."""
    from quire.__main__ import main
    from quire.sources import office

    rows_ = [["name", "n"], ["a & b", "<3>"]]
    d = tmp_path / "in" / "deep"
    d.mkdir(parents=True)
    for kind in office.OFFICE:
        (d / f"f_{kind}.{kind}").write_bytes(office.made(kind, "Budget & plan", rows_, ["First line.", "Second line."]))
    assert office.docx_html(office.made("docx", "T", rows_, ["x"])).startswith("<h1>T</h1>\n<p>x</p>\n<table><tr><td>name</td><td>n</td></tr><tr><td>a &amp; b</td>")
    assert office.pptx_html(office.made("pptx", "T", rows_, ["x"])).startswith("<h2>Slide 1</h2>\n<p>T</p>\n<p>x</p>\n<table>")
    (tmp_path / "in" / "bad.docx").write_bytes(b"no zip")
    (tmp_path / "in" / "long.txt").write_bytes(b"\xff line\n" * 90)
    (tmp_path / "in" / "p.png").write_bytes(b"\x89PNG")
    (tmp_path / "in" / "other.bin").write_bytes(b"x")
    got = {(r["doc"], r["page"]): r for r in office.pages_of(spark, str(tmp_path / "in")).collect()}
    assert sorted(got) == [("bad", 1), ("f_docx", 1), ("f_pptx", 1), ("f_xlsx", 1), ("long", 1), ("long", 2), ("long", 3), ("p", 1)]
    assert "BadZipFile" in got["bad", 1]["error"] and got["f_docx", 1]["text"].split("\n") == ["Budget & plan", "First line.", "Second line.", "name | n", "a & b | <3>"]
    assert got["long", 1]["text"].startswith("� line")
    root = str(tmp_path / "lib")
    main([root, "ingest", str(tmp_path / "in" / "deep")], spark)
    for command in (["list"], ["toc"], ["search", "budget"], ["section", "budget"], ["page", "f_docx", "1"], ["query", "budget plan"], ["export"]):
        main([root, *command], spark)
    assert "Budget & plan" in capsys.readouterr().out


def test_sheet_cells():
    import io
    import zipfile

    from quire.sources import office

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="urn:r"><sheets><sheet name="S" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="x" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>one</t></si></sst>")
        z.writestr("xl/worksheets/s.xml", '<worksheet><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>0</v></c><c r="D1" t="b"><v>1</v></c><c r="E1" t="b"><v>0</v></c><c r="F1"><v>2.5</v></c></row></worksheet>')
    assert office.xlsx_html(out.getvalue()) == "<h2>S</h2><table><tr><td>one</td><td></td><td></td><td>True</td><td></td><td>2.5</td></tr></table>"


def test_clients_need_their_settings():
    with pytest.raises(ValueError, match="AWS_SECRET_ACCESS_KEY"):
        providers.client("bedrock", {"AWS_ACCESS_KEY_ID": "x"})
    with pytest.raises(ValueError, match="known"):
        providers.client("none", {})
    providers.register_client("vertex", lambda s: ("made", s["GOOGLE_CLOUD_PROJECT"]))
    assert providers.client("vertex", {"GOOGLE_CLOUD_PROJECT": "p", "other": "q"}) == ("made", "p")
