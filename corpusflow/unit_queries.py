"""Registered queries of single operators, each on columns made of the test tables, with its SQL twin.

The texts are built so that SQL can say what comes of them without the operator's patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import adapting, assembly, cards, catalog, intervals, navigation, ordered, planning, quality, rendering, sampling, sections, semantics
from corpusflow.plans import build, ledger
from corpusflow.queries import MANUAL, big, manual_pages, query, spread, tasks_for
from corpusflow.schemas import BLOCK
from corpusflow.sources import readers, writers
from corpusflow.streaming import completions

L = F.lit


def s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def pick(by: Column, *values) -> Column:
    """The value at the place by modulo their number."""
    n = len(values)
    out = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else L(v)
        out = F.when(F.pmod(by, L(n)) == i, v) if out is None else out.when(F.pmod(by, L(n)) == i, v)
    return out


def key() -> Column:
    return F.col("p_partkey")


@query("SELECT p_partkey, p_name || ' fi ' || p_size AS title, lower(p_name) || ' - +- \"' || lower(p_brand) || '\"2 a strasse' AS theory FROM part")
def q46_title_keys(t):
    title = F.concat(L("  "), "p_name", L("\t \u00a0\ufb01 "), s("p_size"))
    theory = F.concat(L("\\mathbf{"), "p_name", L("} \u2013 $\\pm$ \u201c"), "p_brand", L("\u201d^{2}_a STRA\u00dfE "))
    return t("part").select("p_partkey", X.title_key(title).alias("title"), X.theory_title_key(theory).alias("theory"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN '*PART_' || p_size || '-X' END AS surface, CASE WHEN p_partkey % 5 > 0 THEN 'PART_' || p_size || '_X' END AS key FROM part")
def q47_keyword_surface(t):
    raw = F.concat(L("## `$*$PART\\_"), s("p_size"), L("`\u2010X"), F.when(key() % 5 == 0, "\nmore").otherwise(""))
    p = t("part").select("p_partkey", X.keyword_surface(raw).alias("surface"))
    return p.select("p_partkey", "surface", X.keyword_key(F.col("surface")).alias("key"))


@query("SELECT p_partkey, CAST([2, 1, 1, NULL][CAST(p_partkey % 4 AS INT) + 1] AS INT) AS rank FROM part")
def q48_title_rank(t):
    expected = F.concat(L("PART_"), s("p_size"))
    title = F.concat(expected, pick(key(), "", "_{OPTION}", "_OPTION1_OPTION2", "_OTHER"))
    return t("part").select("p_partkey", X.title_rank(title, expected).alias("rank"))


@query(r"SELECT o_orderkey, 'a' || chr(10) || o_orderkey || '\nabla b' || chr(10) || '\neq' || chr(10) || 'bc' AS text, CAST(3 AS INT) AS n FROM orders")
def q49_real_newlines(t):
    raw = F.concat(L("a\\n"), s("o_orderkey"), L("\\nabla b\\n\\neq\\nbc"))
    return t("orders").select("o_orderkey", X.real_newlines(raw).alias("text"), X.literal_newlines(raw).alias("n"))


@query(r"""SELECT p_partkey, lower(p_type) || ' type' AS label, [NULL, p_name, NULL, p_brand, NULL][CAST(p_partkey % 5 AS INT) + 1] AS cell, [p_name, NULL, p_brand, NULL, NULL][CAST(p_partkey % 5 AS INT) + 1] AS compressed,
p_name || '|' || p_brand AS lines, p_name || '||' || p_brand AS first_row, p_partkey || ':' || p_size || ':2:3' AS source FROM part""")
def q50_cell_accessors(t):
    row = F.array(L(" "), F.concat(L(" "), "p_name", L("\n")), L("\t"), F.col("p_brand"))
    k = (key() % 5).cast("int")
    source = X.cell_source(s("p_partkey"), F.col("p_size"), L("1-1"), L(0), L(2), L(3))
    return t("part").select(
        "p_partkey", X.row_label(F.concat(L(" "), "p_type", L("\\n TYPE "))).alias("label"), X.cell_text(row, k).alias("cell"), X.compressed_value(row, k + 2).alias("compressed"),
        F.array_join(X.cell_lines(F.concat("p_name", L("\\n \\n"), "p_brand")), "|").alias("lines"), F.array_join(X.first_row_text(F.array(F.array(F.concat("p_name", L(" ")), L(" "), F.col("p_brand")))), "|").alias("first_row"),
        F.concat_ws(":", source["document_id"], s(source["pdf_page"]), s(source["row"]), s(source["column"])).alias("source"),
    )


@query("""SELECT p_partkey, CAST(p_partkey % 4 < 2 AS BOOLEAN) AS is_type, CASE p_partkey % 3 WHEN 0 THEN 'V' || p_partkey || '/F/' || p_name WHEN 1 THEN 'w' || p_size || '/i10/none' END AS triplet FROM part""")
def q51_field_types(t):
    text = F.concat(pick(key(), " f / A ", "I", "AB", "i/"))
    cell = pick(key(), F.concat(L("V"), s("p_partkey"), L(" F "), "p_name"), F.concat(L("w"), s("p_size"), L("\\ni10\\nnone")), F.concat(L("9"), s("p_size"), L(" F 1")))
    triplet = X.field_triplet(cell)
    return t("part").select("p_partkey", X.is_field_type(text).alias("is_type"), F.when(triplet.isNotNull(), F.concat_ws("/", triplet["variable"], triplet["field_type"], triplet["default"])).alias("triplet"))


@query("SELECT p_partkey, 'SFA' || p_size || upper(replace(p_type, ' ', '')) AS key FROM part")
def q52_variable_key(t):
    return t("part").select("p_partkey", X.variable_key(F.concat(L("`sf-a\\_"), s("p_size"), L("` $^\\ast$ {"), "p_type", L("}"))).alias("key"))


@query("""WITH k AS (SELECT p_partkey, p_size, CAST(p_partkey % 6 AS INT) AS k FROM part)
SELECT p_partkey, k IN (0, 1) AS exact, k IN (0, 1, 2) AS prefix, CASE k WHEN 3 THEN p_size || 'a.2' WHEN 4 THEN CAST(p_size AS VARCHAR) END AS card FROM k""")
def q53_labels(t):
    text = pick(key(), " Remarks: ", "remark", "Remarks follow", F.concat(L("Card "), s("p_size"), L("a.2 if")), F.concat(L("card "), s("p_size")), "The card")
    return t("part").select("p_partkey", X.is_label(text, "remark").alias("exact"), X.is_label(text, "remark", exact=False).alias("prefix"), X.card_label(text).alias("card"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'OPT_' || p_size WHEN 1 THEN upper(p_type) END AS option FROM part WHERE NOT contains(p_type, ' ')")
def q54_option_token(t):
    text = pick(key(), F.concat(L(" OPT_"), s("p_size")), F.upper("p_type"), "BLANK", "A", "lower")
    return t("part").where(~F.contains("p_type", L(" "))).select("p_partkey", X.option_token(text).alias("option"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'A' || p_size || '+B' WHEN 1 THEN 'X+Y+Z' || p_size ELSE '' END AS aliases FROM part")
def q55_alias_tokens(t):
    text = pick(key(), F.concat(L(" A"), s("p_size"), L(" / B ")), F.concat(L("X or Y/Z"), s("p_size")), F.concat(L("X or "), s("p_size")), "word")
    return t("part").select("p_partkey", F.array_join(X.alias_tokens(text), "+").alias("aliases"))


@query("""WITH k AS (SELECT p_partkey, p_size, CAST(p_partkey % 7 AS INT) AS k FROM part)
SELECT p_partkey, k IN (0, 4) AS title, k < 4 AS continues, k IN (0, 2, 4) AS description_head, k IN (2, 4) AS variable_head, k IN (1, 5) AS definition FROM k""")
def q56_row_kinds(t):
    label = pick(key(), "variables", " ", F.concat(L("EQ."), s("p_size"), L(": on")), F.concat(L("-"), s("p_size"), L(".5")), F.concat(L("V"), s("p_size")), "two words", "a-b")
    row = pick(key(), F.array(L("x"), L(" Description")), F.array(L("Type"), L("F")), F.array(L("VARIABLE"), L("description"), L(" ")), F.array(L("Default")), F.array(L("ariable"), L("Description")), F.array(L("Variable\\nType"), L("a")), F.array(L("a"), L("b")))
    rows = pick(key(), F.array(row, row), F.array(row, F.array(L(" "), L("b"))), F.array(row), F.array(row, F.array(L("x"))), F.array(row), F.array(row, F.array(L("Default"), L("0"))), F.array(row))
    p = t("part")
    return p.select("p_partkey", X.is_variable_title(label).alias("title"), X.is_continuation_label(label).alias("continues"), X.is_description_head(row).alias("description_head"), X.is_variable_head(row).alias("variable_head"), X.is_definition_continuation(rows).alias("definition"))


def cell(text, row=0, column=0, down=1, across=1) -> Column:
    number = lambda x: x if isinstance(x, Column) else L(x)
    return F.struct(number(text).alias("text"), number(row).cast("int").alias("row"), number(column).cast("int").alias("column"), number(down).cast("int").alias("rowspan"), number(across).cast("int").alias("colspan"))


def block(kind, text=None, rows=None, bbox=None) -> Column:
    none = lambda x, kind: L(None).cast(kind) if x is None else x if isinstance(x, Column) else L(x)
    return F.struct(none(kind, "string").alias("type"), none(text, "string").alias("text"), none(bbox, "array<double>").alias("bbox"), none(rows, adapting.CELLS).alias("rows")).cast(BLOCK)


@query("""SELECT p_partkey, p_name || ' $' || p_size || '$' || chr(10) || p_brand || chr(10) || p_type || chr(10) || 'E=mc' AS visible, p_name || '  ' || chr(10) || p_brand || chr(10) || p_type || chr(10) AS prose FROM part""")
def q57_block_text(t):
    rows = F.array(F.array(cell(F.col("p_brand")), cell(" ")), F.array(cell(F.col("p_type"), 1)))
    blocks = F.array(block("text", F.concat("p_name", L(" $"), s("p_size"), L("$"))), block("table", None, rows), block("math", "E=mc"))
    return t("part").select("p_partkey", X.page_text(blocks).alias("visible"), X.page_text(blocks, False).alias("prose"))


@query("SELECT p_partkey, CAST(p_partkey % 4 IN (0, 2) AS BOOLEAN) AS heading FROM part")
def q58_section_heading(t):
    name = F.concat(L("ROOT_"), F.upper("p_type"), s("p_size"))
    text = pick(key(), F.concat(L("*Root-"), "p_type", L(" "), s("p_size")), F.concat(L("Root "), "p_type"), " root ", " * ")
    return t("part").select("p_partkey", X.is_section_heading(text, name).alias("heading"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size || ',' || p_partkey WHEN 1 THEN CAST(p_size AS VARCHAR) ELSE '' END AS path FROM part")
def q59_number_path(t):
    path = X.number_path(pick(key(), F.concat_ws(".", s("p_size"), s("p_partkey")), s("p_size"), F.concat(L("A."), s("p_size"))))
    return t("part").select("p_partkey", F.array_join(F.transform(path, s), ",").alias("path"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 3 THEN NULL WHEN 2 THEN 'theory' ELSE 'keyword-volume-' || (c_nationkey % 3 + 1) END AS document_id, CASE WHEN c_custkey % 4 < 2 THEN CAST(c_nationkey % 3 + 1 AS INT) END AS volume, CASE WHEN c_custkey % 4 < 3 THEN 'R' || (c_custkey % 20) END AS release FROM customer""")
def q60_document_identity(t):
    roman = F.repeat(L("I"), (F.col("c_nationkey") % 3 + 1).cast("int"))
    number = s(F.col("c_custkey") % 20)
    name = pick(F.col("c_custkey"), F.concat(L("Manual_Volume_"), roman, L("_R"), number, L(".pdf")), F.concat(L("manual_vol_"), roman, L("_r"), number, L(".PDF")), F.concat(L("manual_theory_R"), number, L(".pdf")), F.concat(L("notes_"), number, L(".pdf")))
    c = t("customer").select("c_custkey", readers.file_identity(name).alias("f"))
    return c.select("c_custkey", "f.document_id", "f.volume", "f.release")


@query("SELECT c_custkey, 'key=*** for ' || c_name || ' ***' AS message FROM customer")
def q61_redact(t):
    return t("customer").select("c_custkey", X.redact(F.concat(L("key=s3cret for "), "c_name", L(" s3cret")), "s3cret").alias("message"))


LOCATE = """
p0 AS (SELECT o_custkey % 50 AS doc, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS pdf_page FROM orders),
p AS (SELECT doc, pdf_page, CASE WHEN o_orderkey % 4 < 3 THEN '1-' || (pdf_page // 3 + 1) END AS manual_page, pdf_page = 1 AS is_toc, 'S' || (pdf_page % 7) AS name, o_orderkey % 3 AS k FROM p0),
specs AS (SELECT DISTINCT doc, ord, 'S' || (ord * 3 % 9) AS name, '1-' || (ord * 2) AS manual_page FROM p0, range(1, 11) r(ord)),
cand AS (SELECT s.doc, s.ord, p.pdf_page, p.name = s.name AND k = 1 AS strong, p.name = s.name AND k < 2 AS weak, coalesce(p.manual_page = s.manual_page, false) AS here FROM specs s JOIN p ON p.doc = s.doc AND NOT is_toc WHERE (p.name = s.name AND k < 2) OR p.manual_page = s.manual_page),
f AS (SELECT DISTINCT doc, CAST(0 AS BIGINT) AS ord, CAST(1 AS BIGINT) AS cursor, CAST(NULL AS BIGINT) AS start_page, CAST(NULL AS VARCHAR) AS code FROM p0
UNION ALL SELECT doc, ord + 1, greatest(cursor, coalesce(page, cursor)), page, CASE WHEN page IS NULL THEN 'TOC_ENTRY_UNRESOLVED' WHEN ca IS NOT NULL AND cf IS NULL AND se IS NOT NULL THEN 'ANCHOR_CONFLICT' WHEN ca IS NOT NULL AND cf IS NULL THEN 'TOC_PAGE_TITLE_NOT_FOUND' END
FROM (SELECT *, coalesce(cf, se, ca) AS page FROM (SELECT doc, ord, cursor, ca, coalesce(cs, cw) AS cf, coalesce(list_min(list_filter(sp, lambda x: x >= coalesce(ca, cursor))), list_min(list_filter(wp, lambda x: x >= coalesce(ca, cursor)))) AS se
FROM (SELECT f.doc, f.ord, f.cursor, min(pdf_page) FILTER (here AND pdf_page >= f.cursor) AS ca, min(pdf_page) FILTER (here AND strong AND pdf_page >= f.cursor) AS cs, min(pdf_page) FILTER (here AND weak AND pdf_page >= f.cursor) AS cw, list(pdf_page) FILTER (strong) AS sp, list(pdf_page) FILTER (weak) AS wp
FROM f LEFT JOIN cand c ON c.doc = f.doc AND c.ord = f.ord + 1 WHERE f.ord < 10 GROUP BY f.doc, f.ord, f.cursor))))"""


@query(f"WITH RECURSIVE {LOCATE} SELECT doc, CAST(ord AS INT) AS ord, CAST(start_page AS INT) AS start_page, code FROM f WHERE ord > 0")
def q62_locate_starts(t):
    w = Window.partitionBy("doc").orderBy("o_orderkey")
    p = t("orders").select((F.col("o_custkey") % 50).alias("doc"), "o_orderkey").withColumn("pdf_page", F.row_number().over(w))
    name, k = F.concat(L("S"), s(F.col("pdf_page") % 7)), F.col("o_orderkey") % 3
    manual = F.when(F.col("o_orderkey") % 4 < 3, F.concat(L("1-"), s(F.floor(F.col("pdf_page") / 3) + 1)))
    lines = F.when(k == 1, F.array(L("head"), F.concat(name, L("_OPTION")))).when(k == 0, F.array(L("head"), L("a"), L("b"), L("c"), L("d"), name)).otherwise(F.array(name, L("other")))
    pages = p.select("doc", "pdf_page", manual.alias("manual_page"), (F.col("pdf_page") == 1).alias("is_toc"), lines.alias("lines"))
    specs = p.select("doc").distinct().withColumn("ord", F.explode(F.sequence(L(1), L(10)))).select("doc", "ord", F.concat(L("S"), s(F.col("ord") * 3 % 9)).alias("name"), F.concat(L("1-"), s(F.col("ord") * 2)).alias("manual_page"))
    return navigation.locate_starts(specs, pages, ["doc"]).select("doc", "ord", "start_page", "code")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS document_id, l_linenumber AS pdf_page, n_name AS manual_page FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) LEFT JOIN nation ON n_nationkey = l_orderkey % 40 AND l_linenumber = n_regionkey")
def q63_attach_labels(t):
    pages = t("lineitem").select(s("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("pdf_page"), L("untrusted").alias("manual_page")).distinct()
    orders = t("orders").select("o_orderkey").withColumn("n", F.col("o_orderkey") % 40)
    pagemap = orders.join(t("nation"), F.col("n") == F.col("n_nationkey")).select(s("o_orderkey").alias("document_id"), F.col("n_regionkey").alias("pdf_page"), F.col("n_name").alias("manual_page"))
    return assembly.attach_labels(pages, pagemap)


def line_pages(t) -> DataFrame:
    """Lines of an order as pages with blocks: none where the line number is a multiple of 3."""
    blocks = F.when(F.col("l_linenumber") % 3 == 0, F.array().cast(f"array<{BLOCK}>")).otherwise(F.array(block("text", F.col("l_returnflag"))))
    one = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"))
    return one.select(s("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("pdf_page"), blocks.alias("blocks"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL), c AS (SELECT o_orderkey, unnest(range(1, 5)) AS page FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CAST(page AS INT) AS pdf_page, CASE WHEN l_orderkey IS NULL THEN 'SECTION_PAGEIR_MISSING' WHEN page % 3 = 0 THEN 'SECTION_CONTENT_EMPTY' END AS issue FROM c LEFT JOIN l ON l_orderkey = o_orderkey AND l_linenumber = page""")
def q64_assemble_sections(t):
    claims = t("orders").select(s("o_orderkey").alias("document_id"), F.array(*[F.struct(L(i).alias("pdf_page"), L(f"1-{i}").alias("manual_page")) for i in range(1, 5)]).alias("pages"))
    return assembly.assemble(assembly.section_pages(claims), line_pages(t)).select("document_id", "pdf_page", "issue")


TURNS = "c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS block_index, role, length(text) AS n FROM conversations)"


def turns(t) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return t("conversations").select("conv_id", F.row_number().over(w).alias("block_index"), "role", F.length("text").alias("n"))


@query(f"""WITH {TURNS}, a AS (SELECT conv_id, block_index AS at, 'S' || block_index AS section_id FROM c WHERE n % 4 = 0 UNION ALL SELECT conv_id, block_index, 'T' || block_index FROM c WHERE n % 8 = 0),
o AS (SELECT conv_id, block_index, max(CASE WHEN n % 4 = 0 THEN block_index END) OVER (PARTITION BY conv_id ORDER BY block_index) AS at FROM c)
SELECT o.conv_id, CAST(block_index AS INT) AS block_index, section_id FROM o LEFT JOIN a ON a.conv_id = o.conv_id AND a.at = o.at""")
def q65_theory_ownership(t):
    c = turns(t)
    a = c.where("n % 4 = 0").select("conv_id", "block_index", F.concat(L("S"), s("block_index")).alias("section_id")).union(c.where("n % 8 = 0").select("conv_id", "block_index", F.concat(L("T"), s("block_index"))))
    return assembly.theory_ownership(c.select("conv_id", "block_index"), a, "conv_id", ["block_index"]).select("conv_id", "block_index", "section_id")


@query("""WITH k AS (SELECT o_orderkey AS d, o_orderkey % 4 AS k FROM orders)
SELECT CAST(d AS VARCHAR) AS document_id, 5 AS pdf_page, 'a' AS section_id, 0 AS first_block, CASE WHEN k = 0 THEN 3 ELSE 10 END AS end_block, CASE WHEN k = 0 THEN 'KEYWORD_BOUNDARY_RESOLVED' ELSE 'KEYWORD_BOUNDARY_AMBIGUOUS' END AS code FROM k
UNION ALL SELECT CAST(d AS VARCHAR), 5, 'b', CASE WHEN k = 0 THEN 3 ELSE 0 END, CASE WHEN k = 0 THEN 7 ELSE 10 END, CASE WHEN k = 0 THEN 'KEYWORD_BOUNDARY_RESOLVED' ELSE 'KEYWORD_BOUNDARY_AMBIGUOUS' END FROM k
UNION ALL SELECT CAST(d AS VARCHAR), 5, 'c', CASE WHEN k = 0 THEN 7 ELSE 0 END, 10, CASE WHEN k = 0 THEN 'KEYWORD_BOUNDARY_RESOLVED' ELSE 'KEYWORD_BOUNDARY_AMBIGUOUS' END FROM k""")
def q66_boundary_slices(t):
    k = F.col("o_orderkey") % 4
    owner = lambda i, name, first, last, anchor: F.struct(L(name).alias("section_id"), L(i).alias("ord"), L(first).alias("first_page"), last.alias("last_page"), anchor.cast("int").alias("anchor"))
    owners = F.array(
        owner(1, "a", 2, F.when(k == 1, 6).otherwise(5), L(None)),
        owner(2, "b", 5, L(5), F.when(k == 2, L(None).cast("int")).otherwise(3)),
        owner(3, "c", 5, L(9), F.when(k == 3, 2).otherwise(7)),
    )
    o = t("orders").select(s("o_orderkey").alias("document_id"), L(5).alias("pdf_page"), F.explode(owners).alias("o"), L(10).alias("n_blocks"))
    return assembly.boundary_slices(o.select("document_id", "pdf_page", "o.*", "n_blocks"))


@query(f"""WITH {TURNS}, m AS (SELECT *, CASE WHEN n % 5 = 0 THEN 2 WHEN n % 3 = 0 THEN 1 END AS rank, CASE WHEN n % 2 = 0 THEN 'header' ELSE 'text' END AS type FROM c),
b AS (SELECT *, max(rank) OVER (PARTITION BY conv_id) AS best FROM m), x AS (SELECT *, sum(CASE WHEN type = 'text' AND rank IS DISTINCT FROM best THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY block_index) AS between FROM b)
SELECT conv_id, CAST(min(block_index) AS INT) AS anchor, CAST(count(*) AS BIGINT) AS candidates FROM x WHERE rank = best GROUP BY conv_id HAVING count(DISTINCT between) = 1""")
def q67_title_anchors(t):
    n = F.col("n")
    marked = turns(t).withColumns({"rank": F.when(n % 5 == 0, 2).when(n % 3 == 0, 1), "type": F.when(n % 2 == 0, "header").otherwise("text"), "text": L("x")})
    out = assembly.title_anchors(marked, ["conv_id"], ["block_index"])
    return out.select("conv_id", F.col("anchor.block_index").alias("anchor"), "candidates")


@query("""SELECT user_id, 'kind' AS measure, event_type AS value, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT user_id, 'evidence', CASE event_id % 3 WHEN 0 THEN 'footer' WHEN 1 THEN 'anchor' ELSE 'none' END, count(*) FROM events GROUP BY ALL
UNION ALL SELECT user_id, 'issue', upper(event_type), count(*) FROM events WHERE event_id % 5 = 0 GROUP BY ALL""")
def q68_inspection_counts(t):
    e = t("events")
    pages = e.select("user_id", F.when(F.col("event_id") % 3 == 0, "footer").when(F.col("event_id") % 3 == 1, "anchor").alias("evidence"))
    return navigation.inspection_counts(e.select("user_id", F.col("event_type").alias("kind")), pages, e.where("event_id % 5 = 0").select("user_id", F.upper("event_type").alias("code")), ["user_id"])


@query("""WITH e AS (SELECT user_id % 20 AS doc, event_id, event_type FROM events), g AS (SELECT doc, count(*) AS pages, count(*) FILTER (event_id % 60 > 0) AS labelled, count(*) FILTER (event_id % 977 = 0) AS unresolved, count(*) FILTER (event_id % 500 = 7) AS errors FROM e GROUP BY doc)
SELECT doc, CAST(pages AS BIGINT) AS pages, CAST(labelled AS BIGINT) AS labelled, round(labelled / pages, 9) AS coverage, CAST(unresolved AS BIGINT) AS unresolved, CAST(errors AS BIGINT) AS errors, labelled / pages >= 0.98 AND unresolved = 0 AND errors = 0 AS passes FROM g""")
def q69_inspection_gate(t):
    e = t("events").select((F.col("user_id") % 20).alias("doc"), "event_id", F.when(F.col("event_id") % 60 > 0, "footer").alias("evidence"))
    starts = e.select("doc", F.when(F.col("event_id") % 977 > 0, 1).alias("start_page"))
    issues = e.where("event_id % 500 in (7, 8)").select("doc", F.when(F.col("event_id") % 500 == 7, "error").otherwise("warning").alias("severity"))
    out = navigation.inspection_gate(navigation.inspection_stats(e, ["doc"]), starts, issues, ["doc"])
    return out.select("doc", "pages", "labelled", F.round("coverage", 9).alias("coverage"), "unresolved", "errors", "passes")


@query("SELECT p_partkey, CAST(p_size % 4 + 1 AS INT) AS n FROM part")
def q70_replacement_characters(t):
    text = F.concat("p_name", F.repeat(L("\ufffd"), (F.col("p_size") % 4).cast("int")), L("x\ufffd"))
    return t("part").select("p_partkey", X.replacement_characters(text).alias("n"))


def spanned(t) -> DataFrame:
    """A table of two rows: a cell of two rows and p_size % 3 + 1 columns, one beside it, and one below that."""
    across = (F.col("p_size") % 3 + 1).cast("int")
    html = F.concat(L("<table><tr><td rowspan=2 colspan='"), s(across), L("'>"), "p_name", L("<td>"), "p_brand", L("</tr><tr><th> "), "p_type", L("&amp; </th></tr></table>"))
    return t("part").select("p_partkey", across.alias("across"), adapting.html_table(html).alias("t"))


@query("SELECT p_partkey, (p_size % 3 + 2) || ',' || (p_size % 3 + 2) AS widths, CAST(0 AS INT) AS errors, p_size % 3 + 1 AS second FROM part")
def q71_row_widths(t):
    return spanned(t).select("p_partkey", F.array_join(F.transform(adapting.row_widths(F.col("t.rows")), s), ",").alias("widths"), F.size("t.errors").alias("errors"), F.col("t.rows")[0][1]["column"].alias("second"))


@query("""SELECT p_partkey, p_name || repeat('|', p_size % 3 + 1) || p_brand || '/' || repeat('|', p_size % 3 + 1) || p_type || '&' AS grid FROM part""")
def q72_table_grid(t):
    return spanned(t).select("p_partkey", F.array_join(F.transform(adapting.grid(F.col("t.rows")), lambda r: F.array_join(r, "|")), "/").alias("grid"))


@query(f"""WITH {TURNS}, m AS (SELECT conv_id, block_index, CASE WHEN n % 4 = 0 THEN 'V' || n END AS v, n % 4 = 0 OR n % 4 = 1 AS mark FROM c),
r AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY block_index) AS run FROM m), h AS (SELECT *, max(v) OVER (PARTITION BY conv_id, run) AS described FROM r WHERE run > 0)
SELECT conv_id, described, CAST(min(block_index) AS INT) AS row_start, CAST(max(block_index) AS INT) AS row_end FROM h WHERE described IS NOT NULL GROUP BY conv_id, run, described""")
def q73_variable_ranges(t):
    n = F.col("n")
    rows = turns(t).withColumns({"variable": F.when(n % 4 == 0, F.concat(L("V"), s(n))), "label": pick(n, "V", "unknown title", "EQ.1: on", " ")})
    return semantics.variable_ranges(rows, ["conv_id"], ["block_index"])


@query(f"WITH {TURNS}, v AS (SELECT conv_id, block_index, 'k' || n % 7 AS name, row_number() OVER (PARTITION BY conv_id, n % 7 ORDER BY block_index) AS k FROM c WHERE n % 5 > 0) SELECT conv_id, CAST(block_index AS INT) AS block_index, name FROM v WHERE k = 1")
def q74_variable_catalog(t):
    n = F.col("n")
    v = turns(t).withColumn("variable", F.when(n % 5 == 0, " ").otherwise(F.concat(L("k"), s(n % 7))))
    upper = v.withColumn("variable", F.when(F.col("block_index") % 2 == 0, F.upper("variable")).otherwise(F.col("variable")))
    return semantics.variable_catalog(upper, ["conv_id"], ["block_index"]).select("conv_id", "block_index", F.lower("variable").alias("name"))


@query("SELECT p_partkey, CAST(p_partkey % 3 = 0 AS BOOLEAN) AS redundant FROM part")
def q75_summary_redundant(t):
    a = F.array("p_name", "p_brand")
    b = pick(key(), a, F.array("p_brand", "p_name"), a)
    return t("part").select("p_partkey", semantics.summary_is_redundant(a, b, key() % 3 == 2).alias("redundant"))


@query("""WITH k AS (SELECT p_partkey, p_partkey % 8 AS k, p_size FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS document_id, ['PAGEIR_INVALID_PDF_PAGE', 'PAGEIR_INVALID_BBOX', 'PAGEIR_INVALID_TABLE_ROW', 'PAGEIR_INVALID_TABLE_COLUMN', 'PAGEIR_INVALID_TABLE_SPAN', 'PAGEIR_TABLE_SPAN_OUT_OF_BOUNDS', 'PAGEIR_TABLE_SPAN_OVERLAP'][k] AS code FROM k WHERE k > 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'PAGEIR_TABLE_SPAN_OVERLAP' FROM k WHERE k IN (3, 6)
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'PAGEIR_INVALID_ISSUE_SEVERITY' FROM k WHERE p_size % 5 = 0""")
def q76_page_ir_issues(t):
    k = key() % 8
    on = lambda i, bad, good: F.when(k == i, bad).otherwise(good)
    first = F.array(cell("a", on(3, 1, 0), on(4, -1, 0), on(5, 0, on(6, 3, 1)), 1), cell("b", 0, 1))
    second = F.array(cell("c", 1, 0), cell("d", 1, on(7, 0, 1)))
    rows = F.array(first, second)
    box = F.when(k == 2, F.array(L(1.0), L(2.0), L(3.0))).otherwise(F.array(*[L(float(i)) for i in range(4)]))
    issues = F.array(F.struct(F.when(F.col("p_size") % 5 == 0, "fatal").otherwise("error").alias("severity"), L("X").alias("code")))
    pages = t("part").select(s("p_partkey").alias("document_id"), F.when(k == 1, 0).otherwise(1).alias("pdf_page"), F.array(block("text", "x", None, box), block("table", None, rows)).alias("blocks"), issues.alias("issues"))
    # a cell in the wrong row and one that reaches beyond the last row also cover a place of another cell
    return quality.page_ir_issues(pages).select("document_id", "code")


@query("""SELECT o_orderpriority, count(*) % 2 = 0 AND min(o_orderstatus) = 'F' AS passes, CASE WHEN count(*) % 2 = 1 THEN 'n: ' || count(*) || ' instead of ' || (count(*) - 1) ELSE '' END || CASE WHEN count(*) % 2 = 1 AND min(o_orderstatus) <> 'F' THEN '; ' ELSE '' END || CASE WHEN min(o_orderstatus) <> 'F' THEN 'low: ' || min(o_orderstatus) || ' instead of F' ELSE '' END AS failures FROM orders GROUP BY 1""")
def q77_acceptance(t):
    m = t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderstatus").alias("low"))
    e = m.select("o_orderpriority", (F.col("n") - F.col("n") % 2).alias("n"), L("F").alias("low"))
    out = quality.acceptance(m, e, ["n", "low"], ["o_orderpriority"])
    return out.select("o_orderpriority", "passes", F.array_join("failures", "; ").alias("failures"))


@query("SELECT p_partkey, '| Variable | Description |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || p_brand || ' | ' || p_name || ' <br> x\\|y |' AS markdown FROM part".replace("\\\\", "\\"))
def q78_variable_table(t):
    rows = F.array(F.array(F.col("p_brand"), F.concat("p_name", L("\\n\n x|y"))))
    return t("part").select("p_partkey", rendering.variable_table(rows).alias("markdown"))


@query("""WITH p AS (SELECT p_size AS k, p_partkey AS i, CASE WHEN p_size = 1 THEN 'general' WHEN p_partkey % 3 = 0 THEN 'purpose' WHEN p_partkey % 3 = 1 THEN 'remarks' ELSE 'general' END AS bucket, p_type AS md FROM part),
u AS (SELECT k, bucket, md, min(i) AS i FROM p GROUP BY ALL), b AS (SELECT k, bucket, string_agg(md, chr(10) || chr(10) ORDER BY i) AS md FROM u GROUP BY ALL)
SELECT k, CASE WHEN bool_or(bucket <> 'general') THEN string_agg(CASE bucket WHEN 'purpose' THEN '## Purpose' WHEN 'remarks' THEN '## Remarks' ELSE '## Source Material' END || chr(10) || chr(10) || md, chr(10) || chr(10) ORDER BY CASE bucket WHEN 'purpose' THEN 1 WHEN 'remarks' THEN 2 ELSE 3 END) END AS markdown FROM b GROUP BY k""")
def q79_render_body(t):
    p = t("part").select(F.col("p_size").alias("k"), key().alias("i"), F.when(F.col("p_size") == 1, "general").otherwise(pick(key(), "purpose", "remarks", "general")).alias("bucket"), F.col("p_type").alias("md"))
    return rendering.render_body(p, ["k"], ["i"])


@query("""SELECT p_partkey, '---' || chr(10) || 'name: "' || p_name || '"' || chr(10) || 'pages: ' || chr(10) || '  - ' || p_size || chr(10) || '  - 2' || chr(10) || 'options: []' || chr(10) || '---' || chr(10) AS yaml FROM part""")
def q80_front_matter(t):
    fields = F.to_json(F.struct(F.col("p_name").alias("name"), F.array("p_size", L(2)).alias("pages"), F.array().cast("array<string>").alias("options")))
    return t("part").select("p_partkey", F.regexp_replace(rendering.front_matter(fields), r"pages:\s*\n", "pages: \n").alias("yaml"))


@query("SELECT p_partkey, CAST([1, 1, 2, 2, 0][CAST(p_partkey % 5 AS INT) + 1] AS INT) AS used FROM part")
def q81_theory_titles(t):
    number, title = F.concat(s("p_size"), L(".1")), F.col("p_name")
    first = pick(key(), F.concat_ws(" ", number, title), F.upper(title), number, F.concat(number, L(" "), F.split_part(title, L(" "), L(1))), "other")
    second = pick(key(), "x", "x", title, F.regexp_replace(title, r"^\S+ ", ""), title)
    return t("part").select("p_partkey", rendering.theory_titles(first, second, number, title).alias("used"))


@query("""WITH k AS (SELECT o_orderkey, o_orderkey % 4 AS k, o_orderkey % 3 AS tries FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CASE WHEN k < 3 THEN 'done' WHEN tries + 1 >= 2 THEN 'failed' ELSE 'parse_empty' END AS status, CAST(CASE WHEN k = 3 THEN tries + 1 ELSE tries END AS INT) AS empty_parse_attempts, CASE WHEN k = 2 THEN 'SOURCE_BLANK_PAGE' WHEN k = 3 THEN 'PAGE_PARSE_EMPTY' END AS code FROM k""")
def q82_page_stage(t):
    k = F.col("o_orderkey") % 4
    o = t("orders").select(s("o_orderkey").alias("document_id"), L(1).alias("pdf_page"), pick(F.col("o_orderkey"), '{"markdown":{"text":"body"}}', '{"prunedResult":{"parsing_res_list":[{"block_label":"text","block_content":"x"}]}}', '{"markdown":{"text":" "}}', "{}").alias("layout_result"), F.when(k == 2, "\n ").otherwise("source").alias("text"), (F.col("o_orderkey") % 3).cast("int").alias("empty_parse_attempts"))
    _, state = build.page_stage(o.select("document_id", "pdf_page", "layout_result"), o.select("document_id", "pdf_page", "text"), o.select("document_id", "pdf_page", "empty_parse_attempts"))
    return state.select("document_id", "status", "empty_parse_attempts", "code")


@query(f"WITH {MANUAL}, x AS (SELECT user_id, page, event_id % 3 * 2 AS indent FROM manual) SELECT a.user_id, a.page, greatest(a.page, coalesce(min(b.page), 500)) AS end_page FROM x a LEFT JOIN x b ON b.user_id = a.user_id AND b.page > a.page AND b.indent = 0 GROUP BY a.user_id, a.page")
def q83_root_ranges(t):
    p = manual_pages(t).select("user_id", "page", (F.col("event_id") % 3 * 2).alias("indent"), big(L(500)).alias("last"))
    return navigation.root_ranges(p, ["user_id"], "page", "page", "indent", "last").select("user_id", "page", "end_page")


@query(f"WITH {MANUAL}, x AS (SELECT user_id, page, event_id % 4 + 1 AS depth FROM manual) SELECT a.user_id, a.page, greatest(a.page, coalesce(min(b.page), 500)) AS end_page FROM x a LEFT JOIN x b ON b.user_id = a.user_id AND b.page > a.page AND b.depth <= a.depth GROUP BY a.user_id, a.page")
def q84_theory_ranges(t):
    number = F.array_join(F.array_repeat(L("1"), (F.col("event_id") % 4 + 1).cast("int")), ".")
    p = manual_pages(t).select("user_id", "page", number.alias("number"), big(L(500)).alias("last"))
    return navigation.theory_ranges(p, ["user_id"], "page", "page", "number", "last").select("user_id", "page", "end_page")


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN [p_name, p_brand] WHEN 1 THEN [p_name, '', p_brand] ELSE [''] END AS pages FROM part)
SELECT p_partkey, CAST(k AS INT) AS pdf_page, pages[k] AS text FROM p, unnest(range(1, len(pages) + 1)) u(k)""")
def q85_form_feed_pages(t):
    text = pick(key(), F.concat("p_name", L("\f"), "p_brand", L("\f")), F.concat("p_name", L("\f\f"), "p_brand"), "")
    return readers.form_feed_pages(t("part").select("p_partkey", text.alias("text")), "p_partkey")


@query("SELECT p_partkey, CAST(p_partkey % 4 IN (0, 3) AS BOOLEAN) AS blank FROM part")
def q86_blank_pages(t):
    return t("part").select("p_partkey", readers.is_blank(pick(key(), " \n\t\f", F.col("p_name"), " .", L(None).cast("string"))).alias("blank"))


@query("""WITH p AS (SELECT l_orderkey AS d, l_linenumber AS n FROM lineitem GROUP BY ALL)
SELECT CAST(d AS VARCHAR) AS document_id, n AS pdf_page FROM p WHERE (d + n) % 5 = 0 OR (n % 2 = 0 AND d % 3 > 0 AND (d + n) % 7 > 0)""")
def q87_fresh_pages(t):
    p = t("lineitem").select(F.col("l_orderkey").alias("d"), F.col("l_linenumber").alias("n")).distinct()
    pages = p.select(s("d").alias("document_id"), F.col("n").alias("pdf_page"), F.concat(L("p"), s("n")).alias("path"))
    d, n = F.col("d"), F.col("n")
    state = p.where("(d + n) % 5 > 0").select(s("d").alias("document_id"), n.alias("pdf_page"), F.when(n % 2 == 0, "done").otherwise("failed").alias("status"), F.when((d + n) % 7 > 0, F.concat(L("p"), s("n"))).otherwise("elsewhere").alias("pageir_path"), L("now").alias("source_sha256"))
    sources = p.select("d").distinct().select(s("d").alias("document_id"), F.when(F.col("d") % 3 > 0, "now").otherwise("changed").alias("source_sha256"))
    return readers.fresh_pages(pages, state, sources).select("document_id", "pdf_page")


@query("""SELECT p_partkey, CAST(k AS INT) AS layout_index, '{"n":' || (p_partkey + k) || '}' AS layout_result FROM part, unnest(range(0, p_size % 3)) u(k)""")
def q88_layout_lines(t):
    items = F.transform(F.sequence(L(0), (F.col("p_size") % 3).cast("int")), lambda k: F.concat(L('{"n":'), s(key() + k), L("}")))
    value = F.concat(L('{"result":{"layoutParsingResults":['), F.array_join(F.slice(items, L(1), (F.col("p_size") % 3).cast("int")), ","), L("]}}"))
    return readers.layouts(t("part").select("p_partkey", value.alias("value")))


@query("SELECT DISTINCT CAST(l_orderkey % 100 AS VARCHAR) AS document_id, l_linenumber AS pdf_page FROM lineitem")
def q89_sample_pages(t):
    return readers.sample_pages(t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("pdf_pages")).select(s(F.col("l_orderkey") % 100).alias("document_id"), "pdf_pages"))


@query("""WITH k AS (SELECT o_orderkey AS d, o_orderkey % 6 AS k, o_orderkey % 90 AS c, o_orderkey % 700 AS p FROM orders)
SELECT d, CASE WHEN k IN (0, 1, 4) THEN c || '-' || p END AS manual_page, CASE WHEN k IN (0, 1) THEN 'KEY' WHEN k = 4 THEN 'Table of Contents' END AS tag, k = 4 AS is_toc FROM k""")
def q90_scan_footers(t):
    d = F.col("o_orderkey")
    foot = F.concat(s(d % 90), L("-"), s(d % 700))
    text = pick(d, F.concat(L("a\n"), foot, L(" (KEY)\n \n")), F.concat(L("a\n"), foot, L("(KEY)\nlast")), F.concat(foot, L(" (KEY)\nb\nc")), F.concat(foot, L(" (KEY)\n999-1 (BAD)")), F.concat(L("x "), foot, L("  ( Table of Contents )")), "a\nb")
    return navigation.scan_footers(t("orders").select(d.alias("d"), text.alias("text"))).select("d", "manual_page", "tag", "is_toc")


@query("""WITH k AS (SELECT p_partkey, p_partkey % 4 AS k, p_name, p_brand FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS document_id, CASE k WHEN 0 THEN 'header:' || p_name || ',math:' || p_brand || ',figure:,text:z' WHEN 1 THEN 'table:' WHEN 2 THEN 'text:' || p_name ELSE '' END AS blocks, CASE k WHEN 1 THEN 'error/TABLE_STRUCTURE_UNCERTAIN' WHEN 2 THEN 'warning/READING_ORDER_AMBIGUOUS' ELSE '' END AS issues FROM k""")
def q91_page_blocks(t):
    item = lambda label, text: F.concat(L(f'{{"block_label":"{label}","block_content":"'), text if isinstance(text, Column) else L(text), L('"}'))
    listed = lambda *items: F.concat(L('{"prunedResult":{"parsing_res_list":['), F.concat_ws(",", *items), L("]}}"))
    layout = pick(key(), listed(item("Header", F.col("p_name")), item("equation", F.col("p_brand")), item("seal", ""), item("other", "z")), listed(item("table", "<table><tr><td>a<td>b</tr><tr><td>c</tr></table>")), F.concat(L('{"markdown":{"text":"'), "p_name", L('"}}')), "{}")
    out = adapting.page_blocks(t("part").select(s("p_partkey").alias("document_id"), L(1).alias("pdf_page"), layout.alias("layout_result")))
    shown = F.transform("blocks", lambda b: F.concat(b["type"], L(":"), F.coalesce(b["text"], L(""))))
    return out.select("document_id", F.array_join(shown, ",").alias("blocks"), F.array_join(F.transform("issues", lambda i: F.concat(i["severity"], L("/"), i["code"])), ",").alias("issues"))


@query("""SELECT document_id, CAST(row_number() OVER (ORDER BY document_id, page, name) AS BIGINT) AS place, markdown_path FROM (SELECT CAST(c_nationkey AS VARCHAR) AS document_id, CAST(c_custkey % 7 AS INT) AS page, c_name AS name, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS markdown_path FROM customer)""")
def q92_manifest_order(t):
    c = t("customer")
    k = F.col("c_custkey")
    none = L(None).cast("string")
    e = c.select(s("c_nationkey").alias("document_id"), F.array(F.struct((k % 7).cast("int").alias("pdf_page"))).alias("source_pages"), F.when(k % 2 == 0, F.col("c_name")).alias("keyword_id"), F.when(k % 2 == 1, F.col("c_name")).alias("section_id"), none.alias("name"), none.alias("title"), F.when(k % 5 > 0, "success").otherwise("failed").alias("status"), F.col("c_mktsegment").alias("markdown_path"))
    m = writers.manifest(e)
    name = F.coalesce("keyword_id", "section_id")
    # the window only numbers what is sorted already, so that the order itself can be held against SQL's
    w = Window.orderBy("document_id", F.get("source_pages", L(0))["pdf_page"], name)
    return m.select("document_id", big(F.row_number().over(w)).alias("place"), "markdown_path")


@query("""WITH b AS (SELECT l_orderkey AS d, list(l_linenumber ORDER BY l_linenumber) AS pages FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS document_id, pages[k + 1] AS pdf_page, CAST(k AS INT) AS layout_index FROM b, unnest(range(0, len(pages) + CAST(d % 2 AS BIGINT))) u(k) WHERE k < len(pages)""")
def q93_raw_pages(t):
    layouts, b = bundles(t)
    return writers.raw_pages(layouts, b).select("document_id", "pdf_page", "layout_index")


def bundles(t) -> tuple[DataFrame, DataFrame]:
    """Batches of an order's lines, and their layouts, one too many where the order's key is odd."""
    b = t("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_linenumber")).alias("pdf_pages"))
    b = b.select(s("l_orderkey").alias("document_id"), L(1).alias("batch_id"), "pdf_pages", F.col("l_orderkey").alias("d"))
    n = (F.size("pdf_pages") + F.col("d") % 2 - 1).cast("int")
    return b.select("document_id", "batch_id", F.explode(F.sequence(L(0), n)).alias("layout_index")), b


@query("SELECT CAST(l_orderkey AS VARCHAR) AS document_id, CAST(count(DISTINCT l_linenumber) + 1 AS BIGINT) AS layouts FROM lineitem WHERE l_orderkey % 2 = 1 GROUP BY l_orderkey")
def q94_bundle_mismatch(t):
    return writers.bundle_mismatch(*bundles(t)).select("document_id", "layouts")


@query("""SELECT 'lang' AS "by", coalesce(lang, 'none') AS value, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'bucket', CASE WHEN n_chars <= 800 THEN 'short' WHEN n_chars <= 2400 THEN 'medium' ELSE 'long' END, count(*) FROM documents GROUP BY ALL
UNION ALL SELECT 'feature', f, count(*) FROM (SELECT unnest(CASE WHEN doc_id % 6 = 0 THEN ['cards', 'figures'] WHEN doc_id % 2 = 0 THEN ['figures'] ELSE [] END) AS f FROM documents) GROUP BY f""")
def q95_sample_summary(t):
    f = F.when(F.col("doc_id") % 6 == 0, F.array(L("cards"), L("figures"))).when(F.col("doc_id") % 2 == 0, F.array(L("figures"))).otherwise(F.array().cast("array<string>"))
    d = t("documents").select(F.coalesce("lang", L("none")).alias("lang"), X.length_bucket(F.col("n_chars"), 800, 2400).alias("bucket"), f.alias("features"))
    return sampling.sample_summary(d, "lang", "bucket", "features")


@query("""WITH f AS (SELECT doc_id, unnest(['f' || doc_id % 11, 'g' || doc_id % 5]) AS feature FROM documents), c AS (SELECT DISTINCT feature FROM f WHERE doc_id % 100 < 3),
r AS (SELECT doc_id, feature, row_number() OVER (PARTITION BY feature ORDER BY sha256('20260817:' || feature || ':' || doc_id)) AS k FROM f WHERE doc_id % 100 >= 3 AND feature NOT IN (SELECT feature FROM c)) SELECT feature, doc_id FROM r WHERE k = 1""")
def q96_sample_supplement(t):
    d = t("documents").select("doc_id", F.array(F.concat(L("f"), s(F.col("doc_id") % 11)), F.concat(L("g"), s(F.col("doc_id") % 5))).alias("flags"))
    return sampling.supplement(d, d.where("doc_id % 100 < 3"), ["doc_id"], "flags").select("feature", "doc_id")


@query("""SELECT p_partkey, sha256('{"p_name":"' || p_name || '","p_size":' || CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'null' END || '}') AS identity FROM part""")
def q97_stage_identity(t):
    return t("part").select("p_partkey", "p_name", F.when(key() % 2 == 0, F.col("p_size")).alias("p_size")).select("p_partkey", planning.fingerprint("p_name", "p_size").alias("identity"))


CARD_TABLES = """l AS (SELECT l_orderkey AS d, l_linenumber AS n, min(l_returnflag) AS f FROM lineitem GROUP BY ALL),
r AS (SELECT d, n, f, row_number() OVER (PARTITION BY d ORDER BY n) - 1 AS row, CASE WHEN n % 4 = 1 THEN 'card' WHEN n % 4 = 3 AND d % 2 = 0 THEN 'slots' WHEN n % 4 = 2 THEN 'variable' ELSE 'other' END AS kind FROM l)"""


def card_tables(t) -> DataFrame:
    """An order's lines as rows of a table: cards, rows that number slots (for even keys), rows of variables and others."""
    lines = spread(t("lineitem").select(F.col("l_orderkey").alias("d"), F.col("l_linenumber").alias("n"), "l_returnflag"), "d")
    one = lines.groupBy("d", "n").agg(F.min("l_returnflag").alias("f"))
    w = Window.partitionBy("d").orderBy("n")
    n = F.col("n")
    cells = F.when(n % 4 == 1, F.array(F.concat(L("Card "), s(n), L(":")), L("1"), L("2"))).when((n % 4 == 3) & (F.col("d") % 2 == 0), F.array(F.concat(L("Slots "), s(n)), L("1"), L(" 2 "), L(" "))).when(n % 4 == 2, F.array(L("Variable"), F.concat(L("V"), s(n)), F.col("f"))).otherwise(F.array(L("Type"), L("I"), L("F")))
    return one.select("d", (F.row_number().over(w) - 1).alias("row"), cells.alias("cells"))


@query(f"""WITH {CARD_TABLES}, g AS (SELECT *, sum(CASE WHEN kind IN ('card', 'slots') THEN 1 ELSE 0 END) OVER (PARTITION BY d ORDER BY row) AS region FROM r)
SELECT d, CASE WHEN min(row) FILTER (kind = 'card') IS NOT NULL THEN 'Card ' ELSE 'Slots ' END || arg_min(n, row) AS label, CAST(min(row) AS INT) AS row_start, CAST(max(row) + 1 AS INT) AS row_end FROM g WHERE region > 0 GROUP BY d, region
HAVING count(*) FILTER (kind = 'card') > 0 OR count(*) FILTER (kind = 'variable') = 1""")
def q98_card_regions(t):
    return cards.card_regions(card_tables(t), ["d"], structural=F.col("d") % 2 == 0).select("d", "label", "row_start", "row_end")


@query("""WITH k AS (SELECT p_partkey, p_partkey % 5 AS k, p_size, 'V' || p_size AS v FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN v || '/I/0,W/F/none' WHEN 1 THEN v || '/I/0,W/F/1.5' WHEN 2 THEN v || '/I/-,W/F/-' WHEN 3 THEN v || '/I/7,W/F/-' ELSE '-/I/-,-/F/-' END AS fields,
CASE k WHEN 2 THEN 'CARD_DEFINITION_SLOT_HEADER_INVALID' WHEN 3 THEN 'CARD_DEFINITION_ROW_AMBIGUOUS' WHEN 4 THEN 'CARD_DEFINITION_VARIABLE_ROW_MISSING' ELSE '' END AS codes FROM k""")
def q99_definition_fields(t):
    v = F.concat(L("V"), s("p_size"))
    head, types = F.array(L("Card 1"), L("1"), L("2")), F.array(L("Type"), L("I"), L("F"))
    rows = pick(
        key(), F.array(head, F.array(L("Variable"), v, L("W")), types, F.array(L("Default"), L("0"), L("none")), F.array(L("Variable"), L("Description")), F.array(L("Type"), L("X"), L("Y"))),
        F.array(head, F.array(L("Variable Type Default"), F.concat(v, L(" I 0")), L("W\\nF\\n1.5"))),
        F.array(F.array(L("Card 1"), L("1"), L("3")), F.array(L("Variable\\nType"), F.concat(v, L("  I")), L("W\\nF"))),
        F.array(head, F.array(L("Variable Type Default"), v, L("W")), F.array(L("I"), L("F")), F.array(L("7"), L(" ")), F.array(L("Variable"), L("a"), L("b"))),
        F.array(head, types),
    )
    out = cards.definition_fields(spread(t("part").select("p_partkey", "p_size"), "p_partkey").select("p_partkey", rows.alias("rows")))
    shown = F.transform("fields", lambda f: F.concat_ws("/", *[F.coalesce(f[c], L("-")) for c in ("variable", "field_type", "default")]))
    return out.select("p_partkey", F.array_join(shown, ",").alias("fields"), F.array_join("codes", ",").alias("codes"))


@query(f"""WITH {TURNS}, x AS (SELECT *, CASE WHEN n % 9 = 0 THEN 'remarks' WHEN n % 11 = 0 THEN 'references' END AS last, CASE WHEN n % 5 = 0 THEN 'purpose' WHEN n % 7 = 0 THEN 'options' WHEN n % 4 = 0 THEN 'card' END AS first FROM c),
y AS (SELECT *, last_value(last IGNORE NULLS) OVER w AS held, last_value(coalesce(last, first) IGNORE NULLS) OVER w AS region, last_value(CASE WHEN last IS NULL AND first = 'card' THEN n END IGNORE NULLS) OVER w AS card FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY block_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, CAST(block_index AS INT) AS block_index, CASE WHEN held IS NOT NULL THEN held WHEN region = 'purpose' THEN 'purpose' WHEN region = 'options' THEN CASE WHEN first IS NULL AND n % 2 = 0 THEN 'option' ELSE 'option_intro' END WHEN region = 'card' THEN 'card_condition' ELSE 'unclassified' END AS bucket,
CASE WHEN held IS NOT NULL THEN NULL WHEN region = 'options' AND first IS NULL AND n % 2 = 0 THEN 'OPT_' || n WHEN region = 'card' THEN 'Card ' || card END AS detail FROM y""")
def q100_read_sections(t):
    n = F.col("n")
    text = F.when(n % 9 == 0, "Remarks:").when(n % 11 == 0, " references").when(n % 5 == 0, "Purpose: to say").when(n % 7 == 0, "The available options are").when(n % 4 == 0, F.concat(L("Card "), s(n), L(" if"))).when(n % 2 == 0, F.concat(L("OPT_"), s(n))).otherwise("some words here")
    b = turns(t).select("conv_id", "block_index", L("*NAME").alias("name"), L("text").alias("type"), text.alias("text"), L(None).cast("array<array<string>>").alias("grid"), L(False).alias("ambiguous"))
    return sections.read_sections(b, ["conv_id"], ["block_index"]).select("conv_id", "block_index", "bucket", "detail")


FINDINGS = r"""e AS (SELECT p_size AS k, count(*) AS n, max(p_partkey) AS top FROM part GROUP BY p_size), c AS (SELECT k FROM e WHERE k % 3 = 0),
f AS (SELECT k, concat_ws(',', CASE WHEN k % 4 = 0 THEN 'card_summary_definition_dual_render_candidate' END, CASE WHEN k % 3 = 0 THEN 'confusable_identifier_candidate' END, CASE WHEN k % 5 > 0 THEN 'literal_backslash_n_candidate' END, CASE WHEN k % 2 = 0 THEN 'source_material_fallback_candidate' END) AS flags FROM e)"""


def findings(t) -> DataFrame:
    e = t("part").select(F.col("p_size").alias("k")).distinct()
    k = F.col("k")
    text = F.concat(F.when(k % 2 == 0, "## Source Material\n").otherwise("## Purpose\n"), F.repeat(L("a\\n1 \\nabla "), (k % 5).cast("int")))
    values = e.select("k", F.explode(F.array(F.concat(L("NO"), s(k)), F.when(k % 3 == 0, F.concat(L("N0"), s(k))).otherwise(""), L("other"), L("other"))).alias("value"))
    table = e.select("k", F.explode(F.array(L("Card 1"), L("Card 2"))).alias("label")).select("k", "label", (k % 2 == 0).alias("summary"), (k % 4 == 0).alias("definition"), (F.col("label") == "Card 2").alias("redundant"))
    return quality.entry_findings(e.select("k", text.alias("markdown")), values, table, ["k"])


@query(f"""WITH {FINDINGS} SELECT k, CASE WHEN k % 3 = 0 THEN 'N0' || k || '+NO' || k ELSE '' END AS confusable, CASE WHEN k % 4 = 0 THEN 'Card 1' ELSE '' END AS cards, CAST(k % 5 AS INT) AS newlines, flags FROM e JOIN f USING (k)""")
def q101_entry_findings(t):
    f = findings(t)
    return f.select("k", F.array_join(F.transform("confusable", lambda g: F.array_join(g, "+")), ",").alias("confusable"), F.array_join("dual_cards", ",").alias("cards"), F.col("literal_newlines").alias("newlines"), F.array_join("flags", ",").alias("flags"))


@query(f"""WITH {FINDINGS} SELECT 'status' AS kind, o_orderstatus AS name, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'issue', upper(event_type), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'flag', flag, count(*) FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM f WHERE flags <> '') GROUP BY ALL""")
def q102_detection_summary(t):
    return quality.detection_summary(t("orders").select(F.col("o_orderstatus").alias("status")), t("events").select(F.upper("event_type").alias("code")), findings(t))


@query("""WITH c AS (SELECT conv_id % 7 AS d, conv_id, count(*) AS n, row_number() OVER (PARTITION BY conv_id % 7 ORDER BY conv_id) AS ord FROM conversations GROUP BY conv_id)
SELECT CAST(d AS VARCHAR) AS document_id, 'S' || conv_id AS section_id, CASE WHEN n % 3 = 1 THEN '## Purpose' || chr(10) || chr(10) || 'Purpose ' || n ELSE NULL END AS markdown, CASE n % 3 WHEN 1 THEN 'success' ELSE 'failed' END AS status FROM c""")
def q103_reconstruct(t):
    """Sections of a page each: with a purpose, with text that is nothing but source material, or without blocks."""
    c = t("conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.col("conv_id") % 7).orderBy("conv_id")
    c = c.select(s(F.col("conv_id") % 7).alias("document_id"), F.concat(L("S"), s("conv_id")).alias("section_id"), F.concat(L("*S"), s("conv_id")).alias("name"), F.row_number().over(w).alias("pdf_page"), "n")
    blocks = pick(F.col("n"), F.array(block("header", F.col("name")), block("text", "words")), F.array(block("header", F.col("name")), block("text", F.concat(L("Purpose "), s("n"))), block("footer", "1-1")), F.array().cast(f"array<{BLOCK}>"))
    found = c.select("document_id", "section_id", "name", F.col("pdf_page").alias("start_page"), F.col("pdf_page").alias("end_page"))
    return build.reconstruct(found, c.select("document_id", "pdf_page", blocks.alias("blocks")))["entries"].select("document_id", "section_id", "markdown", "status")


@query(f"""WITH {MANUAL}, x AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id, event_type ORDER BY page) AS k FROM manual),
s AS (SELECT user_id, page, row_number() OVER (PARTITION BY user_id ORDER BY page) - 1 AS k, count(*) OVER (PARTITION BY user_id) AS m FROM manual WHERE event_id % 4 = 0),
q AS (SELECT user_id, page FROM s WHERE k IN (0, m - 1, m // 4, m // 2, 3 * m // 4)),
c AS (SELECT x.user_id, x.page, row_number() OVER (PARTITION BY x.user_id ORDER BY x.page) AS r FROM x LEFT JOIN q ON q.user_id = x.user_id AND q.page = x.page WHERE x.page <= 3 OR x.page = n OR q.page IS NOT NULL OR x.k <= 2 OR event_id % 9 = 0)
SELECT user_id, page FROM c WHERE r <= 24""")
def q104_review_pages(t):
    return ordered.review_places(manual_pages(t), ["user_id"], "page", "event_type", start=F.col("event_id") % 4 == 0, issue=F.col("event_id") % 9 == 0).select("user_id", "page")


@query("""WITH k AS (SELECT p_partkey, p_size, p_partkey % 3 AS k FROM part)
SELECT p_partkey, concat_ws(',', CASE WHEN k = 1 THEN 'non_keyword' END, CASE WHEN k = 2 THEN 'nested_section' END, CASE WHEN p_size % 2 = 0 THEN 'shared_boundary_candidate' END, CASE WHEN p_size % 4 >= 2 THEN 'multiple_cards_candidate' END, CASE WHEN p_size % 5 > 0 THEN 'card_conditions_candidate' END,
CASE WHEN k = 0 THEN 'options_candidate' END, CASE WHEN p_size % 3 > 0 THEN 'variable_description_candidate' END, CASE WHEN p_size % 4 >= 2 THEN 'multi_page_card_candidate' END, CASE WHEN p_size % 3 = 2 THEN 'multi_page_variable_description_candidate' END, CASE WHEN p_size % 7 = 6 THEN 'formula_dense_candidate' END, CASE WHEN p_size % 6 >= 2 THEN 'figure_rich_candidate' END) AS flags,
CAST(p_size % 4 AS INT) AS cards, CAST(p_size % 5 AS INT) AS conditions, CAST(p_size % 6 AS INT) AS figures, CAST(p_size % 7 AS INT) AS formulas FROM k""")
def q105_feature_flags(t):
    n = F.col("p_size")
    many = lambda k, text: F.transform(F.filter(F.sequence(L(0), L(6)), lambda i: i < (n % k).cast("int")), text)
    pages = F.concat(
        many(4, lambda i: F.concat(L("Card "), s(i), L("\nCARD "), s(i))), many(5, lambda i: F.concat(L("ge. "), s(i))), F.when(key() % 3 == 0, F.array(L("OPTION2"))).otherwise(F.array(L("other"))),
        many(3, lambda i: L("variable and description")), many(7, lambda i: L("\\frac")), many(6, lambda i: F.concat(L("Fig. "), s(i))),
    )
    flags, counts = sampling.feature_flags(pages, key() % 3 != 1, key() % 3 == 2, n % 2 == 0)
    return spread(t("part").select("p_partkey", "p_size"), "p_partkey").select("p_partkey", F.array_join(flags, ",").alias("flags"), *[counts[c].cast("int").alias(c) for c in ("cards", "conditions", "figures", "formulas")])


@query("""SELECT doc_id, doc_id % 13 = 0 AS anchor FROM documents WHERE doc_id % 10 = 0 OR doc_id % 13 = 0 UNION ALL SELECT -item_id - 1, NULL FROM benchmark""")
def q106_sample_anchors(t):
    d = t("documents").select("doc_id")
    anchors = d.where("doc_id % 13 = 0").union(t("benchmark").select(-F.col("item_id") - 1))
    sample, missing = sampling.with_anchors(d.where("doc_id % 10 = 0"), d, anchors, ["doc_id"])
    return sample.select("doc_id", "anchor").union(missing.select("doc_id", L(None).cast("boolean")))


@query("""WITH k AS (SELECT o_custkey AS d, o_orderkey AS s, o_orderkey % 8 AS k, c_nationkey AS v FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT d AS document_id, s AS section_id, CASE k WHEN 0 THEN 'SECTION_VOLUME_MISMATCH' WHEN 1 THEN 'SECTION_PAGE_RANGE_INVALID' WHEN 2 THEN 'SECTION_PAGE_LABEL_COUNT_MISMATCH' WHEN 3 THEN 'SECTION_KEYWORD_ID_INVALID' WHEN 4 THEN 'SECTION_PARENT_MISSING' WHEN 5 THEN 'SECTION_PAGE_RANGE_INVALID' WHEN 6 THEN 'SECTION_KEYWORD_ID_INVALID' END AS code FROM k WHERE k < 7""")
def q107_navigation_contract(t):
    k = F.col("o_orderkey") % 8
    tasks = tasks_for(t("orders"))
    o = quality.dealt(t("orders"), tasks, "o_custkey").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    ident = F.col("o_orderkey")
    sections_ = o.select(
        F.col("o_custkey").alias("document_id"), ident.alias("section_id"), F.when(k == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("volume"), F.when(k == 6, "document").otherwise("keyword").alias("kind"),
        F.when(k == 3, ident + 1).otherwise(ident).alias("keyword_id"), F.when(k == 4, -ident - 1).when(k == 7, ident).alias("parent_section_id"),
        F.when(k == 1, F.array(L(1), L(11))).when(k == 5, F.array(L(2), L(1))).otherwise(F.array(L(1), L(2))).alias("pdf_pages"), F.when(k == 2, F.array(L("1-1"))).otherwise(F.array(L("1-1"), L(None).cast("string"))).alias("manual_pages"),
    )
    documents = t("customer").select(F.col("c_custkey").alias("document_id"), F.col("c_nationkey").alias("volume"), L(10).alias("pages"))
    return quality.navigation_issues(sections_, documents, tasks=tasks)


@query("SELECT p_partkey, CAST(p_partkey % 4 IN (0, 2) AS BOOLEAN) AS related FROM part")
def q108_hierarchy_overlap(t):
    n = s("p_size")
    owners = pick(key(), F.array(n, F.concat(n, L(".1")), F.concat(n, L(".1.2"))), F.array(n, F.concat(n, L(".1")), F.concat(n, L(".2"))), F.array(F.concat(n, L(".3.1")), F.concat(n, L(".3"))), F.array(n, L("A.1")))
    return t("part").select("p_partkey", assembly.hierarchy_overlap(owners).alias("related"))


@query("""WITH d AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL),
i AS (SELECT o_orderpriority AS p, o_orderstatus AS s, string_agg(c || '=' || n, ',' ORDER BY c) AS codes FROM (SELECT o_orderpriority, o_orderstatus, 'C' || o_orderkey % 3 AS c, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL) GROUP BY ALL)
SELECT d.p AS release, d.s AS document_id, coalesce(codes, '') AS codes, n % 2 = 0 AS passes, CASE WHEN d.s = 'F' THEN 'reviewed' ELSE 'pending' END AS review, (SELECT string_agg(DISTINCT CAST(o_orderkey % 7 AS VARCHAR), ',' ORDER BY CAST(o_orderkey % 7 AS VARCHAR)) FROM orders o WHERE o.o_orderpriority = d.p AND o.o_orderstatus = d.s) AS pages FROM d LEFT JOIN i ON i.p = d.p AND i.s = d.s""")
def q109_regression_matrix(t):
    o = t("orders").select(F.col("o_orderpriority").alias("release"), F.col("o_orderstatus").alias("document_id"), "o_orderkey")
    d = o.groupBy("release", "document_id").agg(F.count("*").alias("n")).withColumn("passes", F.col("n") % 2 == 0)
    issues = o.where("o_orderkey % 2 = 0").select("release", "document_id", F.concat(L("C"), s(F.col("o_orderkey") % 3)).alias("code"))
    base = d.select("release", "document_id", F.when(F.col("document_id") == "F", F.col("n")).otherwise(0).alias("n"), L("reviewed").alias("review"))
    m = quality.regression_matrix(d, issues, o.select("release", "document_id", (F.col("o_orderkey") % 7).alias("pdf_page")), base, identity=("n",))
    shown = F.transform(F.map_entries("issue_codes"), lambda e: F.concat(e["key"], L("="), s(e["value"])))
    return m.select("release", "document_id", F.coalesce(F.array_join(shown, ","), L("")).alias("codes"), "passes", "review", F.array_join(F.transform("review_pages", s), ",").alias("pages"))


@query("SELECT p_partkey, CAST(p_partkey % 5 IN (0, 2) AS BOOLEAN) AS blank FROM part")
def q110_blank_streams(t):
    text = pick(key(), F.concat(L("q ("), "p_name", L(" Tj) Q")), F.concat(L("BT ("), "p_name", L(") Tj ET")), L(None).cast("string"), "/Im0 Do", "q Q")
    pages = t("part").select("p_partkey", text.cast("binary").alias("content"), F.when(key() % 5 == 4, 1).otherwise(0).alias("annotations"))
    return readers.blank_pages(pages).select("p_partkey", "blank")


@query("""WITH k AS (SELECT o_orderkey AS d, o_orderkey % 8 AS k FROM orders)
SELECT d, 1 AS ord, 2 AS pdf_page, k IN (0, 1) AS strong FROM k WHERE k < 3 UNION ALL SELECT d, 2, 2, k = 4 FROM k WHERE k IN (4, 5)""")
def q111_opening_titles(t):
    """Titles of an appendix and of a numbered section: near the top, below, run over lines, or none."""
    d = F.col("o_orderkey")
    name = F.concat(L("Appendix A"), s(d))
    top, low = (lambda *x: F.array(L("head"), *x)), (lambda *x: F.array(*[L(c) for c in "habcd"], *x))
    lines = pick(
        d, top(F.concat(F.upper(name), L(": All"))), top(L("x"), F.concat(name, L(". All"))), low(name), top(F.concat(name, L("b"))), top(F.concat(L("2.1 Basic of order-")), F.concat(s(d), L(" in"))), low(L("2.1"), F.concat(L("Basic of order-"), s(d))),
        top(L("2.1 Basic of"), L("other")), F.array(F.concat(name, L(" head")), L("12.1 Basic")),
    )
    o = t("orders")
    pages = o.select(d.alias("d"), F.explode(F.array(F.struct(L(1).alias("p"), L(True).alias("toc")), F.struct(L(2).alias("p"), L(False).alias("toc")))).alias("x"), lines.alias("lines")).select("d", F.col("x.p").alias("pdf_page"), F.col("x.toc").alias("is_toc"), "lines")
    none = L(None).cast("string")
    specs = o.select(d.alias("d"), F.explode(F.array(F.struct(L(1).alias("ord"), F.concat(name, L(": All of it")).alias("name"), none.alias("section_number"), none.alias("title")), F.struct(L(2).alias("ord"), L("2.1 Basic").alias("name"), L("2.1").alias("section_number"), F.concat(L("Basic of order- "), s(d)).alias("title")))).alias("x")).select("d", "x.*")
    return navigation.opening_titles(specs, pages, ["d"])


@query(f"""WITH {TURNS}, b AS (SELECT conv_id AS d, block_index AS i, (block_index - 1) // 2 + 1 AS page, n % 3 AS k, n FROM c), s AS (SELECT d, 'S' || i AS section, i, page AS first, page + 1 AS last, k FROM b WHERE n % 2 = 0),
a AS (SELECT d, section, i AS at, last FROM s WHERE k < 2), o AS (SELECT b.d, b.i, b.page, max(a.at) AS at FROM b LEFT JOIN a ON a.d = b.d AND a.at <= b.i GROUP BY ALL),
r AS (SELECT o.d, o.i, a.section, true AS anchored FROM o JOIN a ON a.d = o.d AND a.at = o.at WHERE o.page <= a.last UNION ALL SELECT b.d, b.i, s.section, false FROM s JOIN b ON b.d = s.d AND b.page BETWEEN s.first AND s.last WHERE s.k = 2)
SELECT CAST(d AS VARCHAR) AS document_id, CAST(i AS INT) AS block_index, section AS section_id, anchored FROM r""")
def q112_theory_entries(t):
    n, i = F.col("n"), F.col("block_index")
    b = turns(t).withColumn("page", (F.floor((i - 1) / 2) + 1).cast("int"))
    number = F.concat(s("block_index"), L(".1"))
    title = F.concat(L("On matter "), s("block_index"))
    text = F.when((n % 2 == 0) & (n % 3 == 0), F.concat_ws(" ", number, title)).when((n % 2 == 0) & (n % 3 == 1), F.upper(title)).otherwise("text")
    blocks = b.select(s("conv_id").alias("document_id"), F.col("page").alias("pdf_page"), "block_index", L("text").alias("type"), text.alias("text"))
    found = b.where("n % 2 = 0").select(s("conv_id").alias("document_id"), F.concat(L("S"), s("block_index")).alias("section_id"), number.alias("section_number"), title.alias("title"), F.col("page").alias("start_page"), (F.col("page") + 1).alias("end_page"))
    return build.theory_entries(found, blocks).select("document_id", "block_index", "section_id", "anchored")


@query("""WITH k AS (SELECT o_orderkey, o_orderkey % 3 AS k FROM orders) SELECT CAST(o_orderkey AS VARCHAR) AS document_id, 'S' AS section_id, CASE WHEN k = 0 THEN 'THEORY_TITLE_ANCHOR_MISSING' ELSE 'THEORY_BOUNDARY_RESOLVED' END AS code FROM k""")
def q113_theory_issues(t):
    k = F.col("o_orderkey") % 3
    owned = t("orders").select(s("o_orderkey").alias("document_id"), L("S").alias("section_id"), F.explode(F.array(k > 0, k == 1)).alias("anchored"))
    return build.theory_issues(owned)


#: Names of variables by brand: numbers, a word that a digit may hide in, pairs of aliases, and the first again in small letters.
VARIABLES = """f AS (SELECT p_brand AS b, p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'X' || p_size WHEN 1 THEN 'NO' || p_size WHEN 2 THEN 'A' || p_partkey || '/B' || p_size ELSE 'x' || p_size END AS v FROM part),
n AS (SELECT b, upper(v) AS key, arg_min(v, k) AS v FROM f GROUP BY b, upper(v))"""


def variables(t) -> DataFrame:
    v = pick(key(), F.concat(L("X"), s("p_size")), F.concat(L("NO"), s("p_size")), F.concat(L("A"), s("p_partkey"), L("/B"), s("p_size")), F.concat(L("x"), s("p_size")))
    return catalog.build_index(t("part").select("p_brand", "p_partkey", v.alias("variable")), ["p_brand"], ["p_partkey"])


@query(f"""WITH {VARIABLES}, parts AS (SELECT b, v, unnest(string_split(v, '/')) AS alias FROM f WHERE contains(v, '/')),
al AS (SELECT b, upper(alias) AS key, any_value(alias) AS v, any_value(v) AS target FROM parts GROUP BY b, upper(alias) HAVING count(*) = 1),
i AS (SELECT b, key, v, v AS target, 'exact' AS how FROM n UNION ALL SELECT b, key, v, target, 'alias' FROM al ANTI JOIN n USING (b, key)),
t AS (SELECT p_partkey, p_brand AS b, CASE p_partkey % 5 WHEN 0 THEN 'X' || p_size WHEN 1 THEN 'N0' || p_size WHEN 2 THEN 'A' || p_partkey WHEN 3 THEN 'B' || p_size ELSE 'Q' || p_size END AS key FROM part),
near AS (SELECT t.p_partkey, any_value(n.v) AS v FROM t JOIN n ON n.b = t.b AND replace(n.key, 'O', '0') = replace(t.key, 'O', '0') AND n.key <> t.key AND hamming(n.key, t.key) = 1 GROUP BY t.p_partkey HAVING count(*) = 1)
SELECT t.p_partkey, coalesce(i.v, near.v) AS matched, coalesce(i.target, near.v) AS target, coalesce(i.how, 'confusable') AS how FROM t LEFT JOIN i ON i.b = t.b AND i.key = t.key LEFT JOIN near ON near.p_partkey = t.p_partkey WHERE i.v IS NOT NULL OR near.v IS NOT NULL""")
def q114_variable_lookup(t):
    said = pick(key(), F.concat(L("X"), s("p_size")), F.concat(L("N0"), s("p_size")), F.concat(L("A_"), s("p_partkey")), F.concat(L("b "), s("p_size")), F.concat(L("Q"), s("p_size")))
    rows = t("part").select("p_brand", "p_partkey", said.alias("said"))
    return catalog.resolve(rows, variables(t), ["p_brand"], ["p_brand", "p_partkey"], catalog.heading_forms(F.col("said"))).select("p_partkey", "matched", "target", "how")


@query(f"""WITH {VARIABLES}, p AS (SELECT p_partkey, p_brand AS b, p_size AS z FROM part),
m AS (SELECT p.*, x.v AS x, y.v AS y, o.v AS o FROM p LEFT JOIN n x ON x.b = p.b AND x.key = 'X' || z LEFT JOIN n y ON y.b = p.b AND y.key = 'X' || (z + 1) LEFT JOIN n o ON o.b = p.b AND o.key = 'NO' || z)
SELECT p_partkey, concat_ws(', ', CASE WHEN x IS NOT NULL THEN 'X' || z END, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 'x' || (z + 1) END, CASE WHEN o IS NOT NULL THEN 'NO' || z END) AS label,
concat_ws('|', x, CASE WHEN x IS NOT NULL THEN y END, o) AS targets FROM m WHERE (x IS NOT NULL AND (y IS NOT NULL OR o IS NOT NULL))""")
def q115_leading_groups(t):
    text = F.concat(L("X"), s("p_size"), L(", x"), s(F.col("p_size") + 1), L(" / and more of it\n/ NO"), s("p_size"), L(" EQ.1: on\nEQ.2: off\nX"), s("p_size"), L(" is said again"))
    rows = t("part").select("p_brand", "p_partkey", text.alias("text"))
    return catalog.leading_groups(rows, variables(t), ["p_brand"], ["p_brand", "p_partkey"]).select("p_partkey", "label", F.array_join("targets", "|").alias("targets"))


@query("""WITH n AS (SELECT p_brand AS b, CASE p_partkey % 3 WHEN 0 THEN 'P' || p_size || 'S' WHEN 1 THEN 'Q' || p_size ELSE 'R' || ['X', 'Y', 'Z'][CAST(p_size % 3 AS INT) + 1] END AS v, min(p_partkey) AS k FROM part GROUP BY ALL),
b AS (SELECT DISTINCT p_brand AS b FROM part), all_of AS (SELECT b, v[1] AS head, string_agg(v, ',' ORDER BY k) AS members, count(*) AS c, string_agg(v, ',' ORDER BY v) FILTER (v IN ('RX', 'RY')) AS axes, count(*) FILTER (v IN ('RX', 'RY')) AS two FROM n GROUP BY ALL)
SELECT b AS p_brand, 'P[N]S' AS label, CAST(1 AS INT) AS rule, members FROM all_of WHERE head = 'P' UNION ALL SELECT b, 'R[X, Y]', 2, axes FROM all_of WHERE head = 'R' AND two = 2
UNION ALL SELECT b, 'Q90, Q91, ...', 5, members FROM all_of WHERE head = 'Q' UNION ALL SELECT b, '$Q_I$ of all', 6, members FROM all_of WHERE head = 'Q' UNION ALL SELECT b, 'the i-th, QIJ', 6, members FROM all_of WHERE head = 'Q'""")
def q116_variable_families(t):
    v = pick(key(), F.concat(L("P"), s("p_size"), L("S")), F.concat(L("Q"), s("p_size")), F.concat(L("R"), pick(F.col("p_size"), "X", "Y", "Z")))
    names = t("part").select("p_brand", "p_partkey", v.alias("variable"))
    labels = names.select("p_brand").distinct().withColumn("label", F.explode(F.array(*map(L, ("P[N]S", "R[X, Y]", "Q90, Q91, ...", "$Q_I$ of all", "the i-th, QIJ", "none, at all", "Z[N]")))))
    found = catalog.families(labels, catalog.build_index(names, ["p_brand"], ["p_partkey"]), ["p_brand"])
    return found.select("p_brand", "label", "rule", F.array_join("members", ",").alias("members"))


@query("""WITH r AS (SELECT l_orderkey AS o, l_linenumber * 2 - 2 AS a, l_linenumber * 2 - 2 + CAST(l_quantity AS INT) % 5 AS b FROM lineitem), x AS (SELECT o, unnest(range(1, 12)) AS row FROM (SELECT DISTINCT o FROM r)),
g AS (SELECT o, row FROM x WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.o = x.o AND row >= a AND row < b)), i AS (SELECT *, row - row_number() OVER (PARTITION BY o ORDER BY row) AS k FROM g)
SELECT o AS l_orderkey, CAST(min(row) AS INT) AS row_start, CAST(max(row) + 1 AS INT) AS row_end FROM i GROUP BY o, k""")
def q117_uncovered_rows(t):
    """Rows that no range covers, of ranges that overlap, touch, repeat, are empty or reach beyond the table."""
    start = (F.col("l_linenumber") * 2 - 2).cast("int")
    ranges = t("lineitem").select("l_orderkey", start.alias("row_start"), (start + F.col("l_quantity").cast("int") % 5).alias("row_end"))
    wholes = t("lineitem").select("l_orderkey").distinct().select("l_orderkey", L(1).alias("first"), L(12).alias("last"))
    return intervals.uncovered(wholes, ranges, ["l_orderkey"])


@query(f"""WITH {TURNS}, b AS (SELECT conv_id, block_index, CASE n % 3 WHEN 0 THEN 'V' || n % 4 WHEN 1 THEN '' ELSE 'ODD' END AS label FROM c),
h AS (SELECT *, last_value(CASE WHEN label LIKE 'V%' THEN label END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY block_index) AS v FROM b), r AS (SELECT *, sum(CASE WHEN label = '' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, v ORDER BY block_index) AS chain FROM h WHERE label <> 'ODD' AND v IS NOT NULL)
SELECT conv_id, CAST(block_index AS INT) AS block_index, v AS variable, label = '' AS continues, CAST(chain AS BIGINT) AS chain FROM r""")
def q118_description_chains(t):
    """Description tables whose first row has a title, goes on with the variable before, or names an unknown one."""
    n = F.col("n")
    row = F.array(pick(n, F.concat(L("V"), s(n % 4)), L(""), L("ODD")), L("x"))
    of = turns(t).select("conv_id", "block_index", L("table").alias("type"), F.array(F.array(L("VARIABLE"), L("DESCRIPTION")), row, F.array(L(""), L("y"))).alias("grid"))
    card = of.select("conv_id").distinct().select("conv_id", L(0).cast(of.schema["block_index"].dataType).alias("block_index"), L("table").alias("type"), F.array(F.array(*map(L, ("Card 1", "1", "2", "3", "4"))), F.array(*map(L, ("Variable", "V0", "V1", "V2", "V3")))).alias("grid"))
    blocks = of.union(card).select("*", L("*NAME").alias("name"), L("").alias("text"), L(False).alias("ambiguous"))
    ranges = sections.read(blocks, ["conv_id"], ["block_index"])["ranges"]
    return sections.description_chains(ranges, ["conv_id"], ["block_index"]).select("conv_id", "block_index", "variable", "continues", big("chain").alias("chain"))


@query("""SELECT p_partkey, CAST(k AS INT) AS pdf_page, CAST(n2 AS INT) AS page_count, CASE WHEN k = 1 THEN CAST(90 AS INT) ELSE CAST(0 AS INT) END AS rotate, 'BT (page ' || CASE WHEN k = 1 THEN n ELSE 1 END || ' of ' || p_name || ') Tj ET' AS content
FROM (SELECT p_partkey, p_name, CASE WHEN p_size % 4 = 0 THEN 1 ELSE 2 END AS n2, p_size % 4 + 1 AS n FROM part) JOIN (SELECT unnest([1, 2]) AS k) ON k <= n2""")
def q119_pdf_slices(t):
    """PDF files of one to four pages, written from the table: slices of the last and the first page, read page by page."""
    n = F.col("p_size") % 4 + 1
    numbers = F.sequence(L(1), n)
    kids = F.array_join(F.transform(numbers, lambda k: F.concat(s(k * 2 + 1), L(" 0 R"))), " ")

    def page(k: Column) -> Column:
        content = F.concat(L("BT (page "), s(k), L(" of "), "p_name", L(") Tj ET"))
        turned = F.when(k == n, " /Rotate 90").otherwise("")
        return F.concat(s(k * 2 + 1), L(" 0 obj << /Type /Page /Parent 2 0 R /Contents "), s(k * 2 + 2), L(" 0 R"), turned, L(" >> endobj "), s(k * 2 + 2), L(" 0 obj << /Length "), s(F.length(content)), L(" >> stream\n"), content, L("\nendstream endobj "))

    tree = F.concat(L("%PDF-1.7 1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj 2 0 obj << /Type /Pages /Kids ["), kids, L("] >> endobj "))
    file = F.concat(tree, F.array_join(F.transform(numbers, page), ""), L("trailer << /Root 1 0 R >>"))
    wanted = F.array_distinct(F.array(n.cast("int"), L(1)))
    parts = spread(t("part").select("p_partkey", "p_name", "p_size"), "p_partkey")
    cut = readers.sliced(parts.select("p_partkey", file.cast("binary").alias("content"), wanted.alias("pages")))
    out = readers.pages_of(cut.select("p_partkey", "slice"), ["p_partkey"], "slice")
    return out.select("p_partkey", "pdf_page", "page_count", "rotate", F.col("content").cast("string").alias("content"))


@query("""WITH e AS (SELECT conv_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations), c AS (SELECT conv_id, string_agg(text, '' ORDER BY k) AS content, count(*) AS n FROM e GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS completion_id, CASE WHEN conv_id % 4 = 0 OR (conv_id % 4 = 2 AND n = 1) THEN content END AS content, CAST(CASE conv_id % 4 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE n END AS INT) AS tokens,
CASE WHEN conv_id % 4 = 1 THEN 'STREAM_UNFINISHED' WHEN conv_id % 4 = 2 AND n > 1 THEN 'SLOT_CHANGED' WHEN conv_id % 4 = 3 THEN 'TOKEN_COUNT' END AS code FROM c""")
def q120_token_streams(t):
    """Conversations as streams of token events, a turn a token: whole ones, ones without an end, with another prompt, or counted from 2."""
    k = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    e = t("conversations").select("conv_id", F.coalesce("text", L("")).alias("text"), k.alias("k"))
    e = e.withColumn("bytes", F.transform(F.regexp_extract_all(F.hex(F.encode("text", "UTF-8")), L(".."), 0), lambda x: F.conv(x, 16, 10).cast("int")))
    held = [L(7).alias("id"), F.col("text").alias("token"), F.col("bytes"), L(-0.5).alias("logprob")]
    kind = F.col("conv_id") % 4
    event = F.struct(
        L(0).alias("index"), F.col("text").alias("content"), F.array(L(7)).alias("tokens"), L(False).alias("stop"), (F.col("k") + (kind == 3).cast("int")).alias("tokens_predicted"),
        F.when((kind == 2) & (F.col("k") > 1), 12).otherwise(11).alias("tokens_evaluated"), F.array(F.struct(*held, F.array(F.struct(*held)).alias("top_logprobs"))).alias("completion_probabilities"),
    )
    said = e.select(s("conv_id").alias("completion_id"), (F.col("k") - 1).alias("seq"), F.to_json(event).alias("event"))
    end = F.to_json(F.struct(F.struct(*[L(v).alias(k) for k, v in completions.TERMINAL.items()]).alias("error")))
    ends = e.where("conv_id % 4 != 1").groupBy("conv_id").agg(F.count("*").cast("int").alias("seq")).select(s("conv_id"), "seq", end)
    return completions.completions(said.union(ends))


@query("""WITH b AS (SELECT o_orderkey, o_orderkey % 7 AS k, o_custkey % 2 AS e, o_orderkey % 3 AS tries FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CASE k WHEN 0 THEN 'submit' WHEN 1 THEN 'ask' WHEN 2 THEN 'wait' WHEN 3 THEN CASE WHEN e = 0 THEN 'submit' ELSE 'done' END
WHEN 4 THEN CASE WHEN tries < 2 THEN 'submit' ELSE 'failed' END WHEN 5 THEN CASE WHEN tries < 2 THEN 'wait' ELSE 'failed' END ELSE 'submit' END AS action FROM b""")
def q121_job_actions(t):
    """Batches without a job, with one that is due or not, done (also with an empty page), failed, or of other settings."""
    o = t("orders").select(s("o_orderkey").alias("document_id"), (F.col("o_orderkey") % 7).cast("int").alias("k"), (F.col("o_custkey") % 2).alias("e"), (F.col("o_orderkey") % 3).cast("int").alias("tries"))
    batches = o.select("document_id", L(1).alias("batch_id"), L("now").alias("identity"), F.array(L(1), L(2)).alias("pdf_pages"))
    status = pick(F.col("k"), "none", "submitted", "running", "done", "failed", "failed", "done")
    due = F.when(F.col("k").isin(2, 5), 101.0).otherwise(99.0)
    attempts = F.when(F.col("k").isin(4, 5), F.col("tries") + 1).otherwise(1)
    none = L(None).cast("string")
    of = lambda version, st, d: o.where("k > 0").select("document_id", L(1).alias("batch_id"), F.when(F.col("k") == 6, "before").otherwise("now").alias("identity"), L(version).alias("version"), st.alias("status"), L("j").alias("job_id"), attempts.cast("int").alias("attempts"), L(0).alias("asked"), d.alias("due"), none.alias("error"), none.alias("result"), L("w").alias("writer"))
    held = of(1, L("submitted"), L(0.0)).union(of(2, status, due))
    empty = o.where("e = 0").select("document_id", L(2).alias("pdf_page"))
    return ledger.actions(batches, held, L(100.0), empty).select("document_id", "action")
