"""Adapting, assembling, ownership, meaning, rendering and the stages of a build."""

import json
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.operators import adapting, assembly, catalog, ordered, quality, rendering, sampling, semantics
from corpusflow.plans import build
from corpusflow.sources import readers, writers
from corpusflow.streaming import state


@given(st.lists(st.lists(st.tuples(st.just("x"), st.integers(1, 3), st.integers(1, 3)), max_size=4), max_size=4))
def test_no_two_cells_overlap(rows):
    covered = set()
    for cells in adapting.lay_out(rows):
        for c in cells:
            for i in range(c["rowspan"]):
                for k in range(c["colspan"]):
                    assert (c["row"] + i, c["column"] + k) not in covered
                    covered.add((c["row"] + i, c["column"] + k))


def test_html_tables():
    rows, errors = adapting.parse_table("<table><tr><td rowspan=2>a<td colspan='0'>b<br>c</td></tr><tr><th>d &amp; e</table>")
    assert [[c["text"] for c in r] for r in rows] == [["a", "b\nc"], ["d & e"]] and rows[1][0]["column"] == 1 and errors == ["colspan=0"]


def raw(blocks, markdown=None):
    return json.dumps({"prunedResult": {"parsing_res_list": [{"block_label": k, "block_content": c, "block_bbox": [0, 0, 1, 1]} for k, c in blocks]}, "markdown": {"text": markdown}})


def test_pages_of_layouts(spark):
    rows = [("d", 1, raw([("text", "*ALPHA"), ("formula", "x=1"), ("table", "<tr><td>a<td>b<tr><td>c"), ("seal", "s")])), ("d", 2, raw([], "only text �")), ("d", 3, raw([]))]
    got = {r["pdf_page"]: r for r in adapting.page_blocks(spark.createDataFrame(rows, "document_id string, pdf_page int, layout_result string")).collect()}
    assert [b["type"] for b in got[1]["blocks"]] == ["text", "math", "table", "figure"]
    assert [i["code"] for i in got[1]["issues"]] == ["TABLE_STRUCTURE_UNCERTAIN"]
    assert got[2]["blocks"][0]["text"].startswith("only") and got[2]["issues"][0]["code"] == "READING_ORDER_AMBIGUOUS" and got[3]["blocks"] == []


def test_page_constraints(spark):
    cell = lambda r, c, down=1, across=1: ("t", r, c, down, across)
    table = lambda rows, box=None: ("table", None, box, rows)
    data = [("d", 1, None, [table([[cell(0, 0, 2, 2)], [cell(1, 1)]])], []), ("d", 0, None, [table([[cell(0, -1)], [cell(5, 0, 0)]], [1.0])], [("odd", "c", "m", None, None)]), ("d", 2, None, [table([[cell(0, 0)]])], [])]
    from corpusflow import schemas

    got = {(r["pdf_page"], r["code"]) for r in quality.page_ir_issues(spark.createDataFrame(data, schemas.PAGEIR)).collect()}
    assert {c for p, c in got if p == 1} == {"PAGEIR_TABLE_SPAN_OVERLAP"} and not [c for p, c in got if p == 2]
    assert {c for p, c in got if p == 0} >= {"PAGEIR_INVALID_PDF_PAGE", "PAGEIR_INVALID_BBOX", "PAGEIR_INVALID_TABLE_ROW", "PAGEIR_INVALID_TABLE_COLUMN", "PAGEIR_INVALID_TABLE_SPAN", "PAGEIR_TABLE_SPAN_OUT_OF_BOUNDS", "PAGEIR_INVALID_ISSUE_SEVERITY"}


def test_shared_pages_are_cut_at_anchors_or_kept_whole(spark):
    schema = "document_id string, pdf_page int, section_id string, ord int, first_page int, last_page int, anchor int, n_blocks int"
    rows = [("d", 3, "a", 1, 1, 3, None, 9), ("d", 3, "b", 2, 3, 3, 2, 9), ("d", 3, "c", 3, 3, 5, 6, 9), ("d", 8, "x", 1, 7, 8, None, 4), ("d", 8, "y", 2, 8, 9, None, 4)]
    got = {(r["pdf_page"], r["section_id"]): (r["first_block"], r["end_block"], r["code"][17:]) for r in assembly.boundary_slices(spark.createDataFrame(rows, schema)).collect()}
    assert got[3, "a"][:2] == (0, 2) and got[3, "b"][:2] == (2, 6) and got[3, "c"][:2] == (6, 9)
    assert got[8, "x"] == (0, 4, "AMBIGUOUS") and got[8, "y"] == (0, 4, "AMBIGUOUS")


def test_anchor_choice(spark):
    schema = "s string, p int, type string, text string, rank int"
    rows = [("a", 1, "text", "t", 1), ("a", 2, "text", "T", 2), ("b", 1, "text", "T", 2), ("b", 2, "header", "h", None), ("b", 3, "text", "T", 2), ("c", 1, "text", "T", 2), ("c", 2, "text", "body", None), ("c", 3, "text", "T", 2), ("d", 1, "text", "x", None)]
    got = {r["s"]: r["anchor"]["p"] for r in assembly.title_anchors(spark.createDataFrame(rows, schema), ["s"], ["p"]).collect()}
    assert got == {"a": 2, "b": 1}


def test_theory_blocks_go_to_the_last_title(spark):
    sections = spark.createDataFrame([("d", "s1", "1", "One", 1, 2), ("d", "s2", "1.1", "Two", 2, 3)], "document_id string, section_id string, section_number string, title string, start_page int, end_page int")
    blocks = spark.createDataFrame([("d", 1, 0, "text", "1 One"), ("d", 1, 1, "text", "a"), ("d", 2, 0, "text", "b"), ("d", 2, 1, "text", "1.1 Two"), ("d", 3, 0, "text", "c")], "document_id string, pdf_page int, block_index int, type string, text string")
    got = {(r["pdf_page"], r["block_index"]): r["section_id"] for r in build.theory_entries(sections, blocks).collect()}
    assert got == {(1, 0): "s1", (1, 1): "s1", (2, 0): "s1", (2, 1): "s2", (3, 0): "s2"}
    related = lambda *x: spark.range(1).select(assembly.hierarchy_overlap(F.array(*map(F.lit, x)))).first()[0]
    assert related("2", "2.1", "2.1.3") and not related("2.1", "2.2") and not related("x", "2")


def test_every_block_has_one_bucket(spark):
    texts = ["run head", "*ALPHA", "intro", "Purpose: to test", "more", "Remarks:", "r1", "Purpose: still remarks", "References", "end"]
    rows = [("s", i, "header" if i == 0 else "text", t, t == "*ALPHA") for i, t in enumerate(texts)]
    out = semantics.buckets(spark.createDataFrame(rows, "s string, i int, type string, text string, hit boolean"), ["s"], ["i"], title="hit").orderBy("i").collect()
    assert [r["bucket"] for r in out] == ["ignored", "title", "general", "purpose", "purpose", "remarks_label", "remarks", "remarks", "references_label", "references"]


def test_families(spark):
    names = ["P1", "P2", "P10", "AX", "AY", "AZ", "K11", "K12", "Q"]
    want = {"P[N]": ["P1", "P2", "P10"], "A[X, Y]": ["AX", "AY"], "P2, P10, ...": ["P1", "P2", "P10"], "AX, Q": ["AX", "Q"], "Kij": ["K11", "K12"], "Pi": ["P1", "P2", "P10"]}
    of = lambda held: spark.createDataFrame([(s, i, v) for s, vs in held.items() for i, v in enumerate(vs)], "s string, i int, variable string")
    labels = spark.createDataFrame([("a", x) for x in [*want, "ZZ"]] + [("b", "P[N]")], "s string, label string")
    index = catalog.build_index(of({"a": names, "b": ["Q"]}), ["s"], ["i"])
    assert {(r["s"], r["label"]): r["members"] for r in catalog.families(labels, index, ["s"]).collect()} == {("a", k): v for k, v in want.items()}


def test_variable_tables(spark):
    rows = [("t", 1, "A", "A"), ("t", 2, None, ""), ("t", 3, None, "EQ.1: on"), ("t", 4, None, "unknown"), ("t", 5, None, " "), ("t", 6, "B", "B")]
    got = semantics.variable_ranges(spark.createDataFrame(rows, "t string, row int, variable string, label string"), ["t"], ["row"]).collect()
    assert sorted((r["described"], r["row_start"], r["row_end"]) for r in got) == [("A", 1, 3), ("B", 6, 6)]
    names = semantics.variable_catalog(spark.createDataFrame([("t", 1, "Ab"), ("t", 2, "AB"), ("t", 3, "c"), ("t", 4, " ")], "t string, i int, variable string"), ["t"], ["i"])
    assert [r["variable"] for r in names.orderBy("i").collect()] == ["Ab", "c"]


def test_rendering(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(rendering.pipe_table(F.array(F.array(F.lit("a|b"), F.lit("c")), F.array(F.lit("d\n e"))))) == "| a\\|b | c |\n| --- | --- |\n| d <br> e |  |"
    parts = spark.createDataFrame([("k", 1, "purpose", "why"), ("k", 2, "purpose", "why"), ("k", 3, "general", "g"), ("k", 4, "ignored", "no"), ("m", 1, "general", "g")], "k string, i int, bucket string, md string")
    got = {r["k"]: r["markdown"] for r in rendering.render_body(parts, ["k"], ["i"]).collect()}
    assert got == {"k": "## Purpose\n\nwhy\n\n## Source Material\n\ng", "m": None}
    assert one(rendering.front_matter(F.lit('{"b": "x: y", "a": [1, null], "c": {"d": true}}'))) == '---\nb: "x: y"\na: \n  - 1\n  - null\nc: \n  d: true\n---\n'
    assert one(rendering.markdown_path(F.lit("keyword"), F.lit(2), F.lit("A_B/C"))) == "volume_2/A/A_B_C.md"
    assert one(rendering.theory_titles(F.lit("2.1"), F.lit("Big  Title"), F.lit("2.1"), F.lit("big title"))) == 2


def test_even_indices(spark):
    got = lambda n, k: spark.range(1).select(ordered.even_indices(F.lit(n), k)).first()[0]
    for n in range(1, 12):
        for k in range(0, 6):
            want = list(range(n)) if k <= 0 or n <= k else [0] if k == 1 else sorted({int(i * (n - 1) / (k - 1) + 0.5) for i in range(k)})
            assert got(n, k) == want


def test_samples_supplement_and_summary(spark):
    rng = random.Random(1)
    rows = [("d", f"s{i:03}", rng.choice(["short", "long"]), [f"f{i % 7}"]) for i in range(60)]
    sections = spark.createDataFrame(rows, "doc string, sec string, bucket string, flags array<string>")
    sample = sampling.section_sample(sections, "doc", "bucket", F.col("sec"))
    assert {r["value"]: r["n"] for r in sampling.sample_summary(sample, "doc", "bucket").collect()} == {"d": 6, "short": 3, "long": 3}
    more = sampling.supplement(sections, sample, ["doc", "sec"], "flags").collect()
    have = {f for r in sample.collect() for f in r["flags"]} | {r["feature"] for r in more}
    assert have == {f"f{i}" for i in range(7)}


class Echo:
    name, model = "echo", "1"

    def identity(self):
        return "v1"

    def recognise(self, frames):
        for f in frames:
            f = f[["document_id", "pdf_page"]].copy()
            f["layout_result"] = [raw([("text", f"*ALPHA {p}"), ("text", "Purpose: p")]) if p < 3 else raw([]) for p in f["pdf_page"]]
            f["error"] = ["quota: later" if p == 2 else None for p in f["pdf_page"]]
            yield f


def test_build_stages_resume(spark, tmp_path):
    plan = spark.createDataFrame([("d", p, "sha") for p in (1, 2, 3, 4)], "document_id string, pdf_page int, source_sha256 string")
    state_schema = "document_id string, pdf_page int, status string, provider string, model string, source_sha256 string, semantic_config_hash string, error string"
    none = spark.createDataFrame([], state_schema)
    got, rows = build.raw_stage(plan, none, Echo())
    assert {r["pdf_page"]: r["status"] for r in rows.collect()} == {1: "raw_done", 2: "paused_quota", 3: "raw_done", 4: "raw_done"}
    again, _ = build.raw_stage(plan, rows, Echo())
    assert again.count() == 0 and build.raw_stage(plan, rows, Echo())[1].collect()[0]["pdf_page"] == 2
    text = spark.createDataFrame([("d", 1, "x"), ("d", 3, "x"), ("d", 4, " ")], "document_id string, pdf_page int, text string")
    pages, states = build.page_stage(got, text, spark.createDataFrame([("d", 3, 1)], "document_id string, pdf_page int, empty_parse_attempts int"))
    assert {r["pdf_page"]: (r["status"], r["code"]) for r in states.collect()} == {1: ("done", None), 3: ("failed", "PAGE_PARSE_EMPTY"), 4: ("done", "SOURCE_BLANK_PAGE")}
    sections = spark.createDataFrame([("d", "ALPHA_1", "*ALPHA 1", 1, 2)], "document_id string, section_id string, name string, start_page int, end_page int")
    out = build.reconstruct(sections, pages)
    entry = out["entries"].collect()[0]
    assert entry["status"] == "warning" and entry["markdown"].startswith("## Purpose") and {r["issue"] for r in out["issues"].collect()} == {"SECTION_PAGEIR_MISSING"}
    assert {(r["document_id"], r["status"]) for r in build.build_status(out["entries"]).collect()} == {("d", "warning"), (None, "warning")}


def test_gates(spark):
    a = spark.createDataFrame([(3, None, "x")], "n int, m int, digest string")
    assert quality.acceptance(a, a, ["n", "m"]).first()["passes"]
    bad = quality.acceptance(a, a.withColumn("digest", F.lit("y")), ["n", "digest"]).first()
    assert not bad["passes"] and bad["failures"] == ["digest: x instead of y"]


def test_readers_and_writers(spark, tmp_path):
    for name in ("manual_volume_i_r12.pdf", "manual_vol_III_r12.pdf", "manual_theory_r12.pdf", "other.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    found = readers.discover(readers.source_files(spark, str(tmp_path))).collect()
    assert [r["document_id"] for r in found] == ["keyword-volume-1", "keyword-volume-3", "theory"] and found[0]["release"] == "R12"
    pages = readers.form_feed_pages(spark.createDataFrame([("d", "a\fb\f"), ("e", "")], "document_id string, text string"))
    assert {(r["document_id"], r["pdf_page"], r["text"]) for r in pages.collect()} == {("d", 1, "a"), ("d", 2, "b"), ("e", 1, "")}
    log = tmp_path / "issues.jsonl"
    log.write_text('{"severity": "error", "code": "A"}\nbroken\n\n{"code": "B"}\n')
    assert [r["code"] for r in readers.read_issues(spark, str(log)).collect()] == ["A"]
    pagemap = spark.createDataFrame([("d", 1, "1-1", "footer"), ("d", 2, None, None)], "document_id string, pdf_page int, manual_page string, evidence string")
    sections = spark.createDataFrame([("d", 1, "S", "K", "n", 1, "keyword", None, None, [(1, "1-1"), (2, None)])], "document_id string, ord int, section_id string, keyword_id string, name string, volume int, kind string, parent_section_id string, section_number string, pages array<struct<pdf_page:int,manual_page:string>>")
    maps, lists = writers.navigation_documents(pagemap, sections, "R12")
    for kind, df in (("pagemap", maps), ("sectionmap", lists)):
        (tmp_path / "nav" / "d").mkdir(parents=True, exist_ok=True)
        (tmp_path / "nav" / "d" / f"{kind}.json").write_text(df.drop("document_id").toJSON().collect()[0])
    back, ranges = readers.read_navigation(spark, str(tmp_path / "nav"), "R12")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, pagemap.collect()), key=str)
    assert ranges.first()["pages"][1]["pdf_page"] == 2 and ranges.first()["section_id"] == "S"


def test_config():
    import pytest

    c = readers.BuildConfig.from_dict({"release": " r17", "batch_size": 4})
    assert c.release == "R17" and c.max_batch_pages == 4
    for bad in ({"release": "17"}, {"release": "R1", "x": 1}, {"release": "R1", "batch_size": 1, "max_batch_pages": 1}):
        with pytest.raises(readers.ConfigError):
            readers.BuildConfig.from_dict(bad)


def test_state_stream_keeps_the_latest(spark, tmp_path):
    schema = "k string, at int, status string"
    source = str(tmp_path / "log")
    for at, status in ((1, "failed"), (2, "done")):
        spark.createDataFrame([("a", at, status), (f"b{at}", at, status)], schema).coalesce(1).write.mode("append").parquet(source)
    stream = state.resume_stream(spark, source, schema, files_per_batch=1)
    q = state.keep_latest(stream, str(tmp_path / "t"), str(tmp_path / "c"), ["k"], ["at"], ["status"])
    q.awaitTermination(120)
    got = {r["k"]: r["status"] for r in state.read_latest(spark, str(tmp_path / "t"), schema).collect()}
    assert got == {"a": "done", "b1": "failed", "b2": "done"}
    for at in (3, 4, 5):
        spark.createDataFrame([("a", at, f"s{at}")], schema).coalesce(1).write.mode("append").parquet(source)
        q = state.keep_latest(state.resume_stream(spark, source, schema, files_per_batch=1), str(tmp_path / "t"), str(tmp_path / "c"), ["k"], ["at"], ["status"])
        q.awaitTermination(120)
    got = {r["k"]: r["status"] for r in state.read_latest(spark, str(tmp_path / "t"), schema).collect()}
    assert got == {"a": "s5", "b1": "failed", "b2": "done"}
    versions = state._versions(spark, str(tmp_path / "t"))
    assert max(map(len, versions.values())) == 2 and [3, 4] in versions.values()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert state.event_windows(events).agg(F.sum("n")).first()[0] == events.count()
