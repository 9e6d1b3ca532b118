"""Inspection of a small manual: footers, contents, starts, page map, ranges, plan."""

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import navigation, planning, quality
from corpusflow.plans import build

PAGES = [
    (1, "*TABLE OF CONTENTS\n*ALPHA_BEAM ........ 3-1\n*ALPHA_ROD\n  _LONG ........ 3-2\n*GAMMA ........ 3-4\n1-1 (TABLE OF CONTENTS)"),
    (2, "*ALPHA\n*ALPHA_BEAM_{OPTION}\nbody\n3-1 (ALPHA)"),
    (3, "*ALPHA_BEAM\n*ALPHA_ROD _LONG\ntext\n3-2 (ALPHA)\nlast"),
    (4, "*ALPHA_ROD\nno footer here\n\n"),
    (5, "*GAMMA\n*GAMMA\nx = 1\n3-4 (GAMMA)"),
    (6, ""),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("m", p, t) for p, t in PAGES] + [("empty", 1, None)], "document_id string, pdf_page int, text string")


def test_inspection_of_a_miniature(pages):
    got = navigation.inspect_pages(pages)
    toc = {(r["name"], r["manual_page"], r["indent"]) for r in got["toc"].collect()}
    assert ("*GAMMA", "3-4", 0) in toc and ("*ALPHA_BEAM", "3-1", 0) in toc and any("_LONG" in t[0] for t in toc)
    starts = {r["name"]: r["start_page"] for r in got["starts"].collect()}
    assert starts["*GAMMA"] == 5
    pagemap = {r["pdf_page"]: (r["manual_page"], r["evidence"]) for r in got["pagemap"].where("document_id = 'm'").collect()}
    assert pagemap[2] == ("3-1", "footer") and pagemap[4] == ("3-3", "interpolated") and pagemap[6] == (None, None)
    sections = {r["section_id"]: (r["start_page"], r["end_page"]) for r in got["sections"].collect()}
    assert sections["GAMMA"][0] == 5


def test_footers_out_of_bounds_have_no_second_chance(spark):
    rows = [("d", 1, "3-5 (OK)\n999-1 (BAD)"), ("d", 2, "3-5 (OK)\nplain"), ("d", 3, "3-5 (OK)\na\nb"), ("d", 4, "7-9999 (X)")]
    got = navigation.scan_footers(spark.createDataFrame(rows, "document_id string, pdf_page int, text string")).orderBy("pdf_page").collect()
    assert [r["manual_page"] for r in got] == [None, "3-5", None, None]


def test_cursor_never_falls(spark):
    pages = spark.createDataFrame([("d", i, p, False, lines) for i, p, lines in [(1, "1-1", ["h", "B"]), (2, "1-2", ["h", "A"]), (3, "1-1", ["h", "x"]), (4, "1-9", ["h", "a", "b", "c", "d", "B"])]], "document_id string, pdf_page int, manual_page string, is_toc boolean, lines array<string>")
    specs = spark.createDataFrame([("d", 1, "A", "1-2"), ("d", 2, "B", "1-1"), ("d", 3, "C", "9-9")], "document_id string, ord int, name string, manual_page string")
    got = {r["name"]: r["start_page"] for r in navigation.locate_starts(specs, pages, ["document_id"]).collect()}
    assert got == {"A": 2, "B": 4, "C": None}  # a titled page counts before a footer without the title


def test_ranges(spark):
    s = spark.createDataFrame([("d", 1, 2, 0, "1"), ("d", 2, 4, 2, "1.1"), ("d", 3, 6, 0, "2"), ("d", 4, 6, 2, "2.1")], "d string, ord int, start int, indent int, number string").withColumn("last", F.lit(9))
    ends = lambda df: [r["end_page"] for r in df.orderBy("ord").collect()]
    assert ends(navigation.section_ranges(s, ["d"], ["ord"], "start", "last")) == [4, 6, 6, 9]
    assert ends(navigation.root_ranges(s, ["d"], "ord", "start", "indent", "last"))[0] == 6
    assert ends(navigation.theory_ranges(s, ["d"], "ord", "start", "number", "last")) == [6, 6, 9, 9]


def test_theory_specs_and_aliases(spark):
    toc = spark.createDataFrame([("d", 1, "2 Basics", "2-1", 0), ("d", 2, "2.1 More", "2-2", 2), ("d", 3, "9.1 Lost", "9-1", 2), ("d", 4, "Preface", "1-1", 0)], "document_id string, ord int, name string, manual_page string, indent int")
    got = {r["section_number"]: (r["title"], r["parent_section_id"]) for r in navigation.theory_specs(toc, ["document_id"]).collect()}
    assert got == {"2": ("Basics", None), "2.1": ("More", "2"), "9.1": ("Lost", None)}
    lines = spark.createDataFrame([(" *MAT_001 : *MAT_ELASTIC",), ("*MAT_001: *MAT_OTHER",), ("no",)], "line string")
    assert {(r["alias"], r["keyword_id"]) for r in navigation.alias_map(lines).collect()} == {("MAT_001", "MAT_ELASTIC"), ("MAT_001", "MAT_OTHER")}


def test_stats(pages):
    pagemap = navigation.inspect_pages(pages)["pagemap"]
    got = {r["document_id"]: r for r in navigation.inspection_stats(pagemap, ["document_id"]).collect()}
    assert got["m"]["pages"] == 6 and got["m"]["labelled"] == 5 and not got["m"]["passes"] and got["empty"]["coverage"] == 0


def test_plan_splits_at_gaps_starts_and_size(spark):
    sections = spark.createDataFrame([("d", "a", 1, 3), ("d", "b", 3, 5), ("d", "c", 8, 8)], "document_id string, section_id string, start_page int, end_page int")
    got = planning.batch_table(build.plan(sections, most=2), "document_id", "pdf_page").orderBy("batch_id").collect()
    assert [r["pdf_pages"] for r in got] == [[1, 2], [3, 4], [5], [8]]
    shared = build.plan(sections).where("pdf_page = 3").first()
    assert shared["candidate_sections"] == ["a", "b"]


def test_identity_of_a_plan(spark):
    plan = spark.createDataFrame([(1,), (2,)], "p int")
    state = spark.createDataFrame([(1, "x", None), (2, "x", None)], "p int, provider string, model string")
    assert planning.single_identity(plan, state, ["p"], ["provider", "model"]).first()["identity"]["provider"] == "x"
    assert planning.single_identity(plan, state.where("p = 1"), ["p"], ["provider", "model"]).first()["identity"] is None
    assert planning.pending(plan.selectExpr("p", "'x' provider", "cast(null as string) model"), state.where("p = 1"), ["p"], ["provider", "model"]).collect()[0]["p"] == 2


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    lit = F.lit
    assert one(X.section_id(lit("*Élan vital-2"))) == "ELAN_VITAL_2"
    assert one(X.slug(lit("***"))) == "UNTITLED"
    assert one(X.real_newlines(lit(r"a\nb \neq \nabla c\n"))) == "a\nb \\neq \\nabla c\n"
    assert one(X.theory_title_key(lit("The  $\\mathrm{Straße}$ – a_b"))) == "the strasse - a b"
    assert one(X.alias_tokens(lit("AB/C or D1"))) == ["AB", "C", "D1"] and one(X.alias_tokens(lit("AB or not, that"))) == []
    assert one(X.field_triplet(lit("KID I none")))["default"] == "none" and one(X.field_triplet(lit("KID I none x")))["default"] == "none x" and one(X.field_triplet(lit("KID II none"))) is None
    assert one(X.variable_key(lit("`SF-A`_1 $x$"))) == "SFA1X"
    assert one(X.title_rank(lit("A_B_OPTION"), lit("A_B"))) == 1 and one(X.title_rank(lit("A_B"), lit("A_B"))) == 2 and one(X.title_rank(lit("A_BC"), lit("A_B"))) is None
    c = one(X.conditions(lit("Only if IOPT.EQ.1 or 2, and N.GT. 3.")))
    assert [(x["variable"], x["operator"], x["values"]) for x in c] == [("IOPT", "EQ.", ["1", "2"]), ("N", "GT.", ["3"])]
    assert one(X.keyword_key(X.keyword_surface(lit("## **$\\ast$ALPHA beam-rod**\n")))) is not None
    assert one(X.number_path(lit("22.3.1"))) == [22, 3, 1] and one(X.number_path(lit("A.1"))) == []
    assert one(X.prose(lit("a $x$ b $$y\nz$$ c"))).split() == ["a", "b", "c"]
    assert one(quality.text_layer_verdict(lit(20), lit(2), lit(0.1), lit(0.9))) == "TEXT_LAYER_FORMULA_REPRESENTATION_DIVERGENCE"


def test_starts_of_other_kinds(spark):
    lines = {1: ["toc"], 2: ["head", "APPENDIX A. More"], 3: ["head", "2 Theory of", "many- things", "x"], 4: ["h", "a", "b", "c", "d", "*KEY_OPTION1_{OPTION2}"], 5: ["Appendix A: names", "x"]}
    pages = spark.createDataFrame([("d", p, None, p == 1, x) for p, x in lines.items()], "document_id string, pdf_page int, manual_page string, is_toc boolean, lines array<string>")
    specs = spark.createDataFrame([("d", 1, "Appendix A: Names", "1-1", "document", None, None), ("d", 2, "2 Theory", "1-2", "theory", "2", "Theory of many-things"), ("d", 3, "*KEY", "1-3", "keyword", None, None), ("d", 4, "Appendix A: again", "1-4", "child", None, None)], "document_id string, ord int, name string, manual_page string, kind string, section_number string, title string")
    got = {r["ord"]: (r["start_page"], r["code"]) for r in navigation.locate_starts(specs, pages, ["document_id"]).collect()}
    assert got == {1: (2, None), 2: (3, None), 3: (4, None), 4: (None, "TOC_ENTRY_UNRESOLVED")}
