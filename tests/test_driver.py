"""A build from page texts to files, with each of its exit codes."""

import json
from pathlib import Path

import pytest
from echo_provider import Lines
from pyspark.sql import functions as F

from corpusflow import __main__ as cli
from corpusflow.operators import quality
from corpusflow.plans import driver
from corpusflow.sources import readers, writers

PAGES = {
    1: "Contents\n*ALPHA ........ 1-1\n*BETA ........ 1-2\n*GAMMA ....... 1-3\n0-1 (Table of Contents)",
    2: "*ALPHA\n*ALPHA\nPurpose: to begin\nRemarks\nnone\n1-1 (ALPHA)",
    3: "*BETA\n*BETA\nPurpose: to go on\n1-2 (BETA)",
    4: "*GAMMA\n*GAMMA\nPurpose: to end\n1-3 (GAMMA)",
}


BETA = """---
document_id: "d"
manual_type: "keyword"
keyword_id: "BETA"
name: "*BETA"
family: "BETA"
legacy_ids: []
options: []
manual_release: "R9"
volume: null
source_pages: 
  - pdf_page: 3
    manual_page: "1-2"
  - pdf_page: 4
    manual_page: "1-3"
---

# *BETA

## Purpose

Purpose: to go on
"""


def shown(page: int) -> str:
    return "\n".join(PAGES[page].split("\n")[1:-1])


def text(pages=None):
    return {("d", p): shown(p) for p in (pages or PAGES)}


@pytest.fixture
def build(spark, tmp_path):
    page_text = spark.createDataFrame([("d", p, t) for p, t in PAGES.items()], "document_id string, pdf_page int, text string")
    sources = spark.createDataFrame([("d", "sha")], "document_id string, source_sha256 string")
    config = readers.BuildConfig(release="r9")
    return lambda provider, **k: driver.run_build(spark, config, page_text, sources, provider, str(tmp_path), **k)


def test_a_build_ends_well_and_gates_what_it_made(spark, build, tmp_path):
    said = []
    result = build(Lines(text()), progress=driver.Progress(said.append))
    assert (result.status, result.exit_code, result.entries, result.failed) == ("success", 0, 3, 0), result
    assert (tmp_path / "corpus/d/BETA/BETA.md").read_text() == BETA
    lines = [json.loads(x) for f in sorted(Path(tmp_path / "corpus/manifest").glob("part-*")) for x in f.read_text().splitlines()]
    assert [(x["section_id"], x["markdown_path"], x["status"]) for x in lines] == [(k, f"d/{k}/{k}.md", "success") for k in ("ALPHA", "BETA", "GAMMA")]
    summary = json.loads((tmp_path / "corpus/summary.json").read_text())
    assert summary["entries"] == {"success": 3} and summary["pages"] == 4 and 'release: "R9"' in (tmp_path / "corpus/corpus.yaml").read_text()
    assert said[0] == "inspect" and any(x.startswith("pages: 3 of 3") for x in said) and said[-1] == "success"
    measures = quality.corpus_measures(spark.read.parquet(f"{tmp_path}/entries"), spark.read.parquet(f"{tmp_path}/issues"))
    base = spark.createDataFrame(measures.collect(), measures.schema)
    states = driver.state_of(spark, f"{tmp_path}/state").count()
    again = build(Lines({}), baseline=base)  # all is stored, so nothing is recognised again
    assert again.gate is True and again.exit_code == 0 and driver.state_of(spark, f"{tmp_path}/state").count() == states
    bad = build(Lines({}), baseline=base.withColumn("entries", base["entries"] + 1))
    assert bad.gate is False and bad.exit_code == 2
    report = json.loads((tmp_path / "corpus/acceptance.json").read_text())
    assert report == {"passes": False, "failures": ["entries: 3 instead of 4"]}


def test_a_build_pauses_and_goes_on(build, tmp_path):
    paused = build(Lines(text(), quota=[("d", 3)]))
    assert (paused.status, paused.exit_code, paused.paused) == ("paused", 3, 1)
    assert build(Lines(text())).exit_code == 0


def test_an_empty_page_is_tried_twice_and_leaves_a_warning(spark, build, tmp_path):
    result = build(Lines(text([2, 4])))
    states = {r["pdf_page"]: (r["status"], r["empty_parse_attempts"]) for r in driver.state_of(spark, f"{tmp_path}/state").collect()}
    assert states == {2: ("done", 0), 3: ("failed", 2), 4: ("done", 0)}
    assert result.exit_code == 1 or result.failed
    codes = {r["code"] for r in spark.read.parquet(f"{tmp_path}/issues").collect()}
    assert {"PAGE_PARSE_FAILED", "SECTION_PAGEIR_MISSING"} <= codes


def test_nothing_recognised_fails(build):
    assert build(Lines({})).exit_code == 2


def test_command_line_builds(spark, tmp_path):
    import echo_provider

    echo_provider.TEXT.update(text())
    (tmp_path / "config.json").write_text(json.dumps({"release": "R9"}))
    spark.createDataFrame([("d", p, t) for p, t in PAGES.items()], "document_id string, pdf_page int, text string").write.parquet(f"{tmp_path}/pages")
    spark.createDataFrame([("d", "sha")], "document_id string, source_sha256 string").write.parquet(f"{tmp_path}/sources")
    args = ["build", "--config", f"{tmp_path}/config.json", "--pages", f"{tmp_path}/pages", "--sources", f"{tmp_path}/sources", "--provider", "echo_provider:Lines", "--out", f"{tmp_path}/out"]
    assert cli.main(args, spark) == 0 and (tmp_path / "out/corpus/d/ALPHA/ALPHA.md").exists()


def test_files_stay_in_their_folder(spark, tmp_path):
    for path in ("../x", "/x", "a/../../x"):
        with pytest.raises(Exception, match="no path inside"):
            writers.write_files(spark.createDataFrame([(path, "v")], "path string, value string"), str(tmp_path))
    assert writers.write_files(spark.createDataFrame([("a/b.txt", "é"), ("c", "")], "path string, value string"), str(tmp_path)) == 2
    assert (tmp_path / "a/b.txt").read_text() == "é" and sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["b.txt", "c"]


def test_a_refusal_aborts_and_what_was_recognised_is_taken_up(spark, build, tmp_path):
    class Refusing(Lines):
        def recognise(self, frames):
            for f in super().recognise(frames):
                f["error"] = ["auth: no such user" if p == 4 else None for p in f["pdf_page"]]
                yield f

    with pytest.raises(driver.Aborted, match="no such user"):
        build(Refusing(text()))
    assert build(Lines(text([4]))).exit_code == 0  # pages 2 and 3 are in the raw table, and not asked for again
    assert {(r["pdf_page"], r["stage"]) for r in spark.read.parquet(f"{tmp_path}/raw").collect()} == {(2, 1), (3, 1), (4, 2)}
    assert {r["status"] for r in driver.state_of(spark, f"{tmp_path}/state").collect()} == {"done"}


TWO = {
    "keyword-volume-1": {
        1: "Contents\n*PART_A ........ 1-1\n*PART_B ........ 1-3\n0-1 (Table of Contents)",
        2: "*PART\n*PART_A\nPurpose: to set it\n1-1 (PART)",
        3: "*PART\nmore of it\n1-2 (PART)",
        4: "*PART\n*PART_B\nPurpose: another\n1-3 (PART)",
    },
    "theory": {
        1: "Contents\n1 Basics of it ........ 1-1\n1.1 Bodies in rest ........ 1-1\n2 Bodies in motion ........ 2-1\n0-1 (Table of Contents)",
        2: "Theory\n1 Basics of it\nwhat it is about\n1.1\nBodies in rest\nthey stay\n1-1 (Basics)",
        3: "Theory\n2 Bodies in motion\nthey go on\n2-1 (Motion)",
    },
}


class Tables(Lines):
    """Gives page 3 of the keywords two tables, and the lines of all other pages."""

    def recognise(self, frames):
        html = ["<table><tr><td>Card 1</td><td>1</td><td>2</td></tr><tr><td>Variable</td><td>PID</td><td>SID</td></tr></table>", "<table><tr><td>VARIABLE</td><td>DESCRIPTION</td></tr><tr><td>PID</td><td>the id</td></tr><tr><td></td><td>of the part</td></tr><tr><td>ODD</td><td>?</td></tr></table>"]
        for f in super().recognise(frames):
            for i in f.index[(f["document_id"] == "keyword-volume-1") & (f["pdf_page"] == 3)]:
                blocks = [{"block_label": "table", "block_content": x} for x in html]
                f.at[i, "layout_result"] = json.dumps({"prunedResult": {"parsing_res_list": blocks}})
            yield f


def test_keywords_and_numbered_sections_become_one_corpus(spark, tmp_path):
    pages = spark.createDataFrame([(d, p, t) for d, of in TWO.items() for p, t in of.items()], "document_id string, pdf_page int, text string")
    sources = spark.createDataFrame([(d, "sha") for d in TWO], "document_id string, source_sha256 string")
    texts = {(d, p): "\n".join(t.split("\n")[1:-1]) for d, of in TWO.items() for p, t in of.items()}
    result = driver.run_build(spark, readers.BuildConfig(release="R9"), pages, sources, Tables(texts), str(tmp_path))
    assert (result.status, result.entries, result.failed) == ("warning", 5, 0)
    files = {str(f.relative_to(tmp_path / "corpus")): f.read_text() for f in (tmp_path / "corpus").rglob("*.md")}
    assert sorted(files) == ["theory/1.1.md", "theory/1.md", "theory/2.md", "volume_1/PART/PART_A.md", "volume_1/PART/PART_B.md"]
    body = {k: v.split("---\n", 2)[2] for k, v in files.items()}
    assert body["volume_1/PART/PART_A.md"] == """
# *PART_A

## Purpose

Purpose: to set it

## Card Definitions

### Card 1

| Card 1 | 1 | 2 |
| --- | --- | --- |
| Variable | PID | SID |

## Variable Descriptions

### PID

| Variable | Description |
| --- | --- |
| PID | the id |
|  | of the part |

| Variable | Description |
| --- | --- |
| ODD | ? |
"""
    assert body["volume_1/PART/PART_B.md"] == "\n# *PART_B\n\n## Purpose\n\nPurpose: another\n"
    assert body["theory/1.md"] == "\n# 1 Basics of it\n\nwhat it is about\n" and body["theory/1.1.md"] == "\n# 1.1 Bodies in rest\n\nthey stay\n" and body["theory/2.md"] == "\n# 2 Bodies in motion\n\nthey go on\n"
    assert 'parent_section_id: "1"' in files["theory/1.1.md"] and "volume: 1" in files["volume_1/PART/PART_A.md"]
    issues = {(r["document_id"], r["section_id"], r["code"]) for r in spark.read.parquet(f"{tmp_path}/issues").collect()}
    assert ("keyword-volume-1", "PART_A", "VARIABLE_DESCRIPTION_UNMATCHED_TITLE") in issues and ("keyword-volume-1", None, "TEXT_LAYER_DIVERGENCE") in issues and ("theory", "1", "THEORY_BOUNDARY_RESOLVED") in issues
    gates = {r["document_id"]: r["passes"] for r in spark.read.parquet(f"{tmp_path}/navigation/gates").collect()}
    assert gates == {"keyword-volume-1": True, "theory": True} and spark.read.parquet(f"{tmp_path}/navigation/contract").count() == 0
    layers = {(r["document_id"], r["pdf_page"]): r["code"] for r in spark.read.parquet(f"{tmp_path}/text_layers").collect()}
    assert layers["keyword-volume-1", 3] == "TEXT_LAYER_DIVERGENCE" and layers["theory", 2] is None
    # what a person should look at, and a matrix whose reviews a later one takes over
    out = str(tmp_path)
    assert cli.main(["detect", "--build", out, "--out", f"{out}/found"], spark) == 0
    summary = {(r["kind"], r["name"]): r["n"] for r in spark.read.parquet(f"{out}/found/summary").collect()}
    assert summary["status", "success"] + summary["status", "warning"] == 5 and summary["issue", "TEXT_LAYER_DIVERGENCE"] == 1
    assert cli.main(["regression", "--build", f"R9={out}", "--out", f"{out}/m1"], spark) == 1
    matrix = spark.read.parquet(f"{out}/m1/matrix")
    rows = {r["document_id"]: r for r in matrix.collect()}
    assert set(rows) == set(TWO) and rows["keyword-volume-1"]["review_pages"] == [1, 2, 3, 4] and "TEXT_LAYER_DIVERGENCE" in rows["keyword-volume-1"]["issue_codes"]
    reviewed = matrix.drop("review").withColumn("review", F.lit("reviewed"))
    reviewed.write.parquet(f"{out}/base")
    assert cli.main(["regression", "--build", f"R9={out}", "--out", f"{out}/m2", "--baseline", f"{out}/base"], spark) == 0
    changed = reviewed.withColumn("source_sha256", F.when(F.col("document_id") == "theory", "other").otherwise(F.col("source_sha256")))
    changed.write.parquet(f"{out}/changed")
    assert cli.main(["regression", "--build", f"R9={out}", "--out", f"{out}/m3", "--baseline", f"{out}/changed"], spark) == 1


def test_a_log_folds_to_the_latest_rows(spark, tmp_path):
    path = f"{tmp_path}/state"
    assert driver.fold_state(spark, path) is False
    for stage in range(1, 6):
        rows = spark.createDataFrame([("d", p, f"s{stage}", stage) for p in range(1, 9) if p % stage == 0], "document_id string, pdf_page int, status string, empty_parse_attempts int")
        driver.log_state(rows.repartition(4), path, stage)
    show = lambda: sorted((r["pdf_page"], r["status"], r["empty_parse_attempts"]) for r in driver.state_of(spark, path).collect())
    before, files = show(), len(list(Path(path).glob("part-*")))
    assert driver.fold_state(spark, path, most_files=files) is False
    assert driver.fold_state(spark, path, most_files=3) is True and show() == before == [(p, f"s{max(k for k in range(1, 6) if p % k == 0)}", max(k for k in range(1, 6) if p % k == 0)) for p in range(1, 9)]
    assert len(list(Path(path).glob("part-*"))) < files and driver.next_stage(spark, path) == 7


def test_preflight_tells_what_is_missing(spark, tmp_path):
    from corpusflow.plans import build as stages

    config = lambda **k: readers.BuildConfig(release="R9", input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), **k)
    told = lambda c: {name: status for name, status, _ in stages.preflight(spark, c)}
    assert told(config())["input"] == "failed" and told(config())["documents"] == "warning"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/manual_vol_i_R9.pdf").write_bytes(b"%PDF")
    good = told(config(api_key="k", job_url="https://x"))
    assert {k: v for k, v in good.items() if k != "checkpoint"} == dict.fromkeys(("release", "pages", "input", "documents", "output", "credentials", "jobs"), "ok")
    bad = told(config(baseline=str(tmp_path / "none")))
    assert (bad["baseline"], bad["credentials"], bad["jobs"]) == ("failed", "warning", "warning")


class Shouting:
    """Another adapter: the layouts' texts in capitals."""

    def __init__(self, version):
        self.version = version

    def identity(self):
        return f"shouting/{self.version}"

    def adapt(self, raw):
        from corpusflow.operators import adapting

        return adapting.page_blocks(raw).withColumn("blocks", F.transform("blocks", lambda b: b.withField("text", F.upper(b["text"]))))


def test_a_new_adapter_has_its_pages_adapted_again_and_no_others(spark, tmp_path):
    from corpusflow.plans import build as stages

    out, quiet = str(tmp_path), driver.Progress(lambda line: None)
    rows = [(d, p, "sha") for d in ("a1", "b1") for p in (1, 2)]
    plan = spark.createDataFrame(rows, "document_id string, pdf_page int, source_sha256 string")
    page_text = plan.select("document_id", "pdf_page", F.lit("some text").alias("text"))
    texts = {(d, p): f"{d} page {p}" for d, p, _ in rows}

    def run(provider, *adapters):
        driver.run_parsing(spark, plan, page_text, provider, out, quiet, adapter=stages.ByDocument(adapters))
        spark.catalog.clearCache()
        pages = spark.read.parquet(f"{out}/page_ir")
        last = {(r["document_id"], r["pdf_page"]): (r["stage"], r["blocks"][0]["text"]) for r in pages.orderBy("stage").collect()}
        assert {r["status"] for r in driver.state_of(spark, f"{out}/state").collect()} == {"done"}
        return pages.count(), last

    n, first = run(Lines(texts))
    assert n == 4 and first["a1", 1][1] == "a1 page 1"
    assert run(Lines({})) == (n, first)
    n, second = run(Lines({}), ("b", Shouting(1)))  # nothing is recognised again
    assert n == 6 and {k: v for k, v in second.items() if k[0] == "a1"} == {k: v for k, v in first.items() if k[0] == "a1"} and second["b1", 2][1] == "B1 PAGE 2"
    assert run(Lines({}), ("b", Shouting(1))) == (n, second)
    n, third = run(Lines({}), ("b", Shouting(2)))
    assert n == 8 and third["b1", 1][0] > second["b1", 1][0] and third["a1", 1] == first["a1", 1]
