"""Cards in tables and the reading of sections."""

from pyspark.sql import functions as F

from corpusflow.operators import cards, sections

TABLES = {
    "plain": [["Card 1", "1", "2", ""], ["Variable", "A", "B", ""], ["Type", "I", "F", ""], ["Default", "none", "", ""], ["card 2b.1:", "1"], ["Variable", "C"]],
    "structural": [["Shells", "1", "2"], ["Variable", "D", "E"], ["other", "1", "2"], ["no variables", "x"]],
    "prose": [["Card", "Description"], ["Card 1", "what"]],
    "combined": [["Card 3", "1", "2"], ["Variable\\nType Default", "X1 i none", "Y F 0.5"], ["Variable", "Description"], ["Card 9", "1"]],
    "below": [["Card", "1", "2"], ["Variable Type Default", "P", "Q"], ["I", "F"], ["1", ""], ["Variable", "R", "S"]],
    "bad": [["Card 4", "1", "3"], ["Type", "I", "F"]],
    "inline": [["Card 5", "1", "2"], ["Variable Type", "SF A i/f", "K\nI"]],
    "none": [["Card 6", "", ""]],
}


def rows(spark):
    return spark.createDataFrame([(t, r, cells) for t, grid in TABLES.items() for r, cells in enumerate(grid)], "t string, row int, cells array<string>")


def regions(spark):
    return cards.card_regions(rows(spark), ["t"], structural=F.col("t") != "prose")


def test_card_regions(spark):
    got = {(r["t"], r["label"], r["row_start"], r["row_end"]) for r in regions(spark).collect()}
    want = {("plain", "Card 1", 0, 4), ("plain", "Card 2b.1", 4, 6), ("structural", "Shells", 0, 2), ("combined", "Card 3", 0, 3), ("combined", "Card 9", 3, 4), ("below", "Card", 0, 5), ("bad", "Card 4", 0, 2), ("inline", "Card 5", 0, 2), ("none", "Card 6", 0, 1)}
    assert got == want
    assert all(r["row_end"] - r["row_start"] != 2 or r["t"] != "structural" for r in cards.card_regions(rows(spark), ["t"]).collect())


def test_definition_fields(spark):
    one = regions(spark)
    held = rows(spark).join(one, "t").where("row >= row_start and row < row_end").groupBy("t", "label").agg(F.transform(F.sort_array(F.collect_list(F.struct("row", "cells"))), lambda x: x["cells"]).alias("rows"))
    got = {r["label"]: r for r in cards.definition_fields(held).collect()}
    fields = lambda name: [tuple(f)[1:4] for f in got[name]["fields"]]
    assert fields("Card 1") == [("A", "I", "none"), ("B", "F", None)] and got["Card 1"]["codes"] == []
    assert fields("Card 3") == [("X1", "i", "none"), ("Y", "F", "0.5")]
    assert fields("Card") == [("P", "I", "1"), ("Q", "F", None)] and got["Card"]["codes"] == ["CARD_DEFINITION_ROW_AMBIGUOUS"]
    assert [tuple(f)[4:] for f in got["Card"]["fields"]] == [(1, 1), (1, 2)]
    assert fields("Card 4") == [(None, "I", None), (None, "F", None)] and got["Card 4"]["codes"] == ["CARD_DEFINITION_SLOT_HEADER_INVALID", "CARD_DEFINITION_VARIABLE_ROW_MISSING"]
    assert fields("Card 5") == [("SF A", "i/f", None), ("K", "I", None)]
    assert fields("Card 6") == [] and got["Card 6"]["codes"] == ["CARD_DEFINITION_SLOT_HEADER_INVALID"]


SCHEMA = "s string, page int, i int, name string, type string, text string, grid array<array<string>>, ambiguous boolean"


def frame(spark, blocks, name="*PART_A", s="a", ambiguous=()):
    """Blocks as (type, text or grid); a number between them turns to that page."""
    out, page = [], 1
    for i, b in enumerate(blocks):
        if isinstance(b, int):
            page = b
        else:
            kind, x = b
            out.append((s, page, i, name, kind, "" if kind == "table" else x, x if kind == "table" else None, page in ambiguous))
    return spark.createDataFrame(out, SCHEMA)


def read(spark, blocks, **k):
    found = sections.read(frame(spark, blocks, **k), ["s"], ["page", "i"])
    shown = [(r["bucket"], r["detail"]) for r in found["blocks"].orderBy("page", "i").collect()]
    ranges = [tuple(r)[1:3] + tuple(r)[4:] for r in found["ranges"].orderBy("page", "i", "row_start").collect()]
    return shown, ranges, sorted(r["code"] for r in found["issues"].collect())


def test_a_section_is_read_in_order(spark):
    table = [["Card 1", "1", "2"], ["Variable", "KID", "A1"]]
    blocks = [
        ("text", "before"), ("text", "*PART_A"), ("text", "about"), ("text", "Purpose: to show"), ("text", "more of it"), ("text", "The available options are:"), ("text", "OPT_ONE"), ("text", "BLANK"),
        ("text", "Card Summary"), ("text", "Card 1. if A.EQ.1"), ("table", [["x", "y"]]), ("table", table), ("table", [["Default", "0", "1"]]), ("text", "of the card"),
        ("text", "KID is it"), ("text", "its meaning"), ("table", [["Variable", "Description"], ["A1", "one"], ["", "two"], ["ODD", "three"]]), ("text", "lost"), ("text", "A1 again"), ("math", ""),
        ("text", "Remarks:"), ("text", "Purpose"), ("table", table), ("text", "References"), ("text", "Remarks"), ("text", "end"),
    ]
    got, ranges, codes = read(spark, blocks)
    want = [
        ("unclassified", None), ("title", None), ("description", None), ("purpose", None), ("purpose", None), ("option_intro", None), ("option", "OPT_ONE"), ("option_intro", None),
        ("card_intro", None), ("card_condition", "Card 1"), ("card_summary", "Card 1"), ("card_definition", "Card 1"), ("card_definition", "Card 1"), ("card_intro", None),
        ("variable", "KID"), ("variable", "KID"), ("variable_table", "KID"), ("variable_intro", None), ("variable", "A1"), ("variable", "A1"),
        ("remarks", None), ("remarks", None), ("remarks", None), ("references", None), ("remarks", None), ("remarks", None),
    ]
    assert got == want
    assert ranges == [("A1", ["A1"], 16, 1, 3, False)]
    assert codes == ["VARIABLE_DESCRIPTION_UNMATCHED_TITLE"] * 2


def card(*names):
    return ("table", [["Card 1", *[str(k + 1) for k in range(len(names))]], ["Variable", *names]])


HEAD = ["VARIABLE", "DESCRIPTION"]


def test_a_group_owns_the_text_that_it_begins(spark):
    text = "VEL/AVGVEL/ Velocity and average velocity:\nVORT EQ.0: Is output.\nEQ.1: Is not output."
    got, _, codes = read(spark, [("text", "*OUT"), card("VEL", "AVGVEL", "VORT", "PRE"), ("text", "VARIABLE"), ("text", "DESCRIPTION"), ("text", text), ("text", "and more")], name="*OUT")
    assert got[2:] == [("variable_intro", None), ("variable_intro", None), ("variable", "VEL, AVGVEL, VORT"), ("variable", "VEL, AVGVEL, VORT")] and codes == []
    got, _, _ = read(spark, [card("LX", "LY"), ("text", "LX, LY  coordinates"), ("text", "LY: one alone")])
    assert got[1:] == [("variable", "LX, LY"), ("variable", "LY")]


def test_unnamed_cards_and_aliases_name_variables(spark):
    values = ("table", [["Card", "1", "2", "3"], ["Variable", "VALX", "VALY", "VALZ"], ["Type", "F", "F", "F"]])
    rows = ("table", [HEAD, ["VALX", "x"], ["VALY", "y"], ["VALZ", "z"]])
    got, ranges, codes = read(spark, [card("LID"), ("text", "Value Cards. Include one card for each value."), values, rows])
    assert [r[0] for r in ranges] == ["VALX", "VALY", "VALZ"] and codes == [] and got[2] == ("card_definition", "Card")
    bad = ("table", [["Card 1", "1", "2", "3"], ["Variable", "PID/PSID", "PID/OTHER", "BAD or prose value"]])
    got, ranges, codes = read(spark, [bad, ("table", [HEAD, ["PID", "of two fields"], ["BAD", "no list"], ["PSID", "of one"], ["E", "unknown"]])])
    assert [r[:2] for r in ranges] == [("PSID", ["PID/PSID"])] and codes == ["VARIABLE_DESCRIPTION_UNMATCHED_TITLE"] * 3
    _, ranges, codes = read(spark, [bad, ("table", [HEAD, ["PSID", "of an ambiguous page"]])], ambiguous=(1,))
    assert ranges == [] and codes == ["VARIABLE_DESCRIPTION_UNMATCHED_TITLE"]


def test_descriptions_go_on_over_tables_and_pages(spark):
    blocks = [card("A", "B", "P1", "P2"), ("table", [HEAD, ["A", "first"], ["EQ.1", "on"]]), 2, ("table", [HEAD, ["", "more of A"], ["B", "next"], ["+ ...", "dots"]]), 3, ("table", [["", "more of B"], ["P[N]", "a family"]]), ("text", "and text"), ("table", [["B:", "again"]])]
    got, ranges, codes = read(spark, blocks)
    assert ranges == [("A", ["A"], 1, 1, 3, False), ("A", ["A"], 3, 1, 2, True), ("B", ["B"], 3, 2, 4, False), ("B", ["B"], 5, 0, 1, True), ("P[N]", ["P1", "P2"], 5, 1, 2, False), ("P[N]", ["P1", "P2"], 7, 0, 1, True)]
    assert got[-2:] == [("variable", "P[N]"), ("variable_table", "P[N]")] and codes == []
    found = sections.read(frame(spark, blocks), ["s"], ["page", "i"])["ranges"]
    chains = {(r["variable"], r["page"]): r["chain"] for r in sections.description_chains(found, ["s"], ["page", "i"]).collect()}
    assert chains == {("A", 1): 1, ("A", 2): 1, ("B", 2): 1, ("B", 3): 1, ("P[N]", 3): 1}


def test_rows_without_a_title_find_the_variable_they_speak_of(spark):
    orphan = ("table", [HEAD, ["", "set B to one"], ["", "then"]])
    _, ranges, codes = read(spark, [card("A", "B"), orphan])
    assert ranges == [("B", ["B"], 1, 1, 3, False)] and codes == []
    _, ranges, codes = read(spark, [card("A", "B"), ("table", [HEAD, ["", "set A or B"], ["", "then"]])])
    assert ranges == [] and codes == ["VARIABLE_DESCRIPTION_CONTINUATION_ORPHAN"]
    _, ranges, codes = read(spark, [card("A", "B"), ("table", [HEAD, ["A", "one"], ["ODD", "lost"]]), orphan])
    assert [r[0] for r in ranges] == ["A", "A"] and codes == ["VARIABLE_DESCRIPTION_UNMATCHED_TITLE"]
    _, ranges, codes = read(spark, [("table", [HEAD, ["A", "no card"], ["", "two"], ["B", "three"]])])
    assert [r[0] for r in ranges] == ["A", "B"] and codes == ["VARIABLE_DESCRIPTION_CATALOG_UNAVAILABLE"]
    _, ranges, codes = read(spark, [card("NO5", "B"), ("table", [HEAD, ["N05", "a digit for a letter"]]), ("table", [["B", "Description"], ["x", "y"], ["", "z"]])])
    assert [(r[0], r[3], r[4]) for r in ranges] == [("NO5", 1, 2), ("B", 0, 3)] and codes == ["VARIABLE_IDENTIFIER_CONFUSABLE_MATCH"]


def test_sections_are_read_apart(spark):
    rows = [(k, i, "*K", t, x, None, False) for k in "ab" for i, (t, x) in enumerate([("header", "*K"), ("text", "Remarks"), ("text", "one"), ("footer", "3-1")])]
    both = spark.createDataFrame(rows, "s string, i int, name string, type string, text string, grid array<array<string>>, ambiguous boolean").repartition(3)
    got = sections.read_sections(both, ["s"], ["i"]).orderBy("s", "i").collect()
    assert [(r["bucket"], r["part"]) for r in got] == [("ignored", None), ("remarks", "remarks"), ("remarks", "remarks"), ("ignored", None)] * 2
    assert sections.read_sections(both.limit(0), ["s"], ["i"]).collect() == []
