"""Readers and writers of corpus tables, and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from corpusflow import __main__ as cli
from corpusflow import schemas as S
from corpusflow.functions import text as X
from corpusflow.operators import assembly, ordered, rendering, semantics
from corpusflow.sources import readers, writers


def page(p, blocks):
    return ("d", p, f"1-{p}", blocks, [("warning", "C", "m", p, None)])


def test_page_tables_round_trip(spark, tmp_path):
    cell = ("x", 0, 0, 2, 1)
    df = spark.createDataFrame([page(1, [("text", "a", [0.0, 0.0, 1.0, 1.0], None), ("table", None, None, [[cell]])]), page(2, [])], S.PAGEIR)
    for r in writers.page_documents(df).collect():
        (tmp_path / "d").mkdir(exist_ok=True)
        (tmp_path / r["path"]).write_text(r["value"])
    old = json.loads((tmp_path / "d" / "page-00001.json").read_text())
    assert "manual_page" not in old["issues"][0]
    back = readers.read_page_ir(spark, str(tmp_path / "d")).orderBy("pdf_page")
    assert [r["blocks"] for r in back.collect()] == [r["blocks"] for r in df.orderBy("pdf_page").collect()]
    old["schema_version"], old["blocks"][1]["rows"] = "0.1", [[{"text": "x", "row": 0, "column": 0}]]
    (tmp_path / "old.json").write_text(json.dumps(old))
    assert readers.read_page_ir(spark, str(tmp_path / "old.json")).first()["blocks"][1]["rows"][0][0]["rowspan"] == 1
    (tmp_path / "new.json").write_text(json.dumps(old | {"schema_version": "9"}))
    with pytest.raises(Exception, match="unknown version"):
        readers.read_page_ir(spark, str(tmp_path / "new.json")).collect()


def test_stale_pages_are_left_out(spark):
    pages = spark.createDataFrame([("d", p, f"f{p}") for p in (1, 2, 3, 4)], "document_id string, pdf_page int, path string")
    state = spark.createDataFrame([("d", 1, "done", "f1", "now"), ("d", 2, "done", "f2", "old"), ("d", 3, "done", "other", "now")], "document_id string, pdf_page int, status string, pageir_path string, source_sha256 string")
    sources = spark.createDataFrame([("d", "now")], "document_id string, source_sha256 string")
    assert sorted(r["pdf_page"] for r in readers.fresh_pages(pages, state, sources).collect()) == [1, 4]


def test_raw_bundles(spark):
    lines = spark.createDataFrame([("d", 1, json.dumps({"result": {"layoutParsingResults": [{"a": 1}, {"a": 2}]}}))], "document_id string, batch_id int, value string")
    layouts = readers.layouts(lines)
    batches = spark.createDataFrame([("d", 1, [7, 8]), ("d", 2, [9])], "document_id string, batch_id int, pdf_pages array<int>")
    assert [(r["pdf_page"], json.loads(r["layout_result"])["a"]) for r in writers.raw_pages(layouts, batches).orderBy("pdf_page").collect()] == [(7, 1), (8, 2)]
    assert [r["batch_id"] for r in writers.bundle_mismatch(layouts, batches).collect()] == [2]


def test_manifest_state_and_texts(spark, tmp_path):
    e = spark.createDataFrame([("d", "k2", "failed", "p/b.md", [(2, None)], None), ("d", "k1", "success", "p/a.md", [(1, None)], "# A\n\ntext")], "document_id string, keyword_id string, status string, markdown_path string, source_pages array<struct<pdf_page:int,manual_page:string>>, markdown string").withColumns({c: F.lit(None).cast("string") for c in ("section_id", "name", "title")})
    assert [(r["keyword_id"], r["markdown_path"]) for r in writers.manifest(e).collect()] == [("k1", "p/a.md"), ("k2", None)]
    writers.write_markdown(e, str(tmp_path / "md"))
    files = [p for p in (tmp_path / "md").rglob("*") if p.is_file()]
    assert files == [tmp_path / "md/p/a.md"] and files[0].read_text() == "# A\n\ntext"
    writers.write_json(e.select("keyword_id", "name"), str(tmp_path / "j"), ["keyword_id"])
    assert [json.loads(x) for f in sorted((tmp_path / "j").glob("part-*")) for x in f.read_text().splitlines()] == [{"keyword_id": "k1"}, {"keyword_id": "k2"}]
    rows = spark.createDataFrame([("d", 1, "done")], "document_id string, pdf_page int, status string")
    for _ in range(2):
        writers.append_state(rows, str(tmp_path / "s"))
    assert readers.read_state(spark, str(tmp_path / "s")).where("updated_at is not null and status = 'done'").count() == 2
    (tmp_path / "b.json").write_text('{"schema_version": "0.1", "n": 3}')
    assert readers.read_baseline(spark, str(tmp_path / "b.json"), "n int").first()["n"] == 3
    pages = spark.createDataFrame([("d", [1, 2]), ("d", [2])], "document_id string, pdf_pages array<int>")
    assert readers.sample_pages(pages).count() == 2


def test_small_parts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(X.literal_newlines(F.lit(r"a\nb\nabla"))) == 1 and one(X.option_token(F.lit("TITLE"))) == "TITLE" and one(X.option_token(F.lit("NONE"))) is None
    assert one(X.redact(F.lit("key=abc"), "abc")) == "key=***" and one(X.alnum_key(F.lit("*a_b-1"))) == "AB1" and one(readers.is_blank(F.lit(" \n")))
    assert one(semantics.summary_is_redundant(F.array(F.lit("A")), F.array(F.lit("A")), F.lit(False)))
    assert one(rendering.variable_table(F.array(F.array(F.lit("A"), F.lit("b"))))).splitlines()[-1] == "| A | b |"
    sections = spark.createDataFrame([("d", "s", [(1, "x"), (2, "x")])], "document_id string, section_id string, pages array<struct<pdf_page:int,manual_page:string>>")
    pagemap = spark.createDataFrame([("d", 1, "1-1", "footer")], "document_id string, pdf_page int, manual_page string, evidence string")
    labelled = assembly.attach_labels(assembly.section_pages(sections), pagemap)
    assert {r["pdf_page"]: r["manual_page"] for r in labelled.collect()} == {1: "1-1", 2: None}
    names = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "")], "i int, v string").withColumn("g", F.lit(1))
    assert [r["v"] for r in ordered.first_occurrence(names, ["g"], ["i"], F.col("v")).orderBy("i").collect()] == ["b", "a", ""]
    blocks = spark.createDataFrame([("s", 1, 0, ("text", "a", None, None)), ("s", 1, 1, ("header", "h", None, None)), ("s", 2, 0, ("math", "$$x$$", None, None))], f"s string, pdf_page int, i int, block {S.BLOCK}")
    assert rendering.render_blocks(blocks, ["s"], ["pdf_page", "i"]).first()["markdown"] == "a\n\n$$\nx\n$$"


def test_command_line(spark, tmp_path, capsys):
    pages = [("d", 1, "*TABLE OF CONTENTS\n*ALPHA ........ 3-1\n1-1 (TABLE OF CONTENTS)"), ("d", 2, "*A\n*ALPHA\nPurpose: x\n3-1 (A)")]
    spark.createDataFrame(pages, "document_id string, pdf_page int, text string").write.parquet(str(tmp_path / "pages"))
    assert cli.main(["inspect", "--pages", str(tmp_path / "pages"), "--out", str(tmp_path / "nav")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "nav" / "sections")).first()["section_id"] == "ALPHA"
    assert cli.main(["plan", "--sections", str(tmp_path / "nav" / "sections"), "--out", str(tmp_path / "plan")], spark) == 0
    assert cli.main(["sample", "--sections", str(tmp_path / "nav" / "sections"), "--out", str(tmp_path / "sample")], spark) == 0
    layout = json.dumps({"prunedResult": {"parsing_res_list": [{"block_label": "text", "block_content": t} for t in ("*ALPHA", "Purpose: x")]}})
    spark.createDataFrame([("d", 2, layout)], "document_id string, pdf_page int, layout_result string").write.parquet(str(tmp_path / "raw"))
    assert cli.main(["adapt", "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "ir")], spark) == 0
    assert cli.main(["reconstruct", "--sections", str(tmp_path / "nav" / "sections"), "--page-ir", str(tmp_path / "ir"), "--out", str(tmp_path / "out")], spark) == 0
    assert "Purpose" in (tmp_path / "out/markdown/d/ALPHA.md").read_text()
    (tmp_path / "c.json").write_text(json.dumps({"release": "R1", "input_dir": str(tmp_path)}))
    assert cli.main(["doctor", "--config", str(tmp_path / "c.json")], spark) in (0, 1) and "input" in capsys.readouterr().out
