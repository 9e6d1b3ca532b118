"""From page texts to a page map and section ranges: footers, tables of contents, starts, interpolation."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X

#: Notation of footers, of contents lines and of alias lines, and the footers' bounds (fixed values).
FOOTER = r"(\d+)-(\d+)\s*\(([^)]+)\)"
TOC_DOTTED = r"^(\s*)(\S.*?)\s*\.{3,}\s*(\d+-\d+)\s*$"
TOC_BARE = r"^(\s*)(\*?[A-Za-z][A-Za-z0-9_()/ ]*?)\s*$"
ALIAS_LINE = r"^\s*\*(MAT_\d+[A-Z_]*)\s*:\s+\*([A-Z][A-Z0-9_]*)"
VERSION_LIKE = r"^(?:\d{2,}|R\d|9\d)"
MOST_CHAPTER, MOST_PAGE, MOST_TAG = 200, 3000, 200
TOC_TAG = "table of contents"
#: Shares of pages with a printed label that a document must reach (fixed values).
LEAST_COVERAGE = {"keyword": 0.98, "theory": 0.95}


def page_lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages with line_no (from 1) and line: the non-blank lines of each page, right-trimmed."""
    lines = pages.select("*", F.posexplode(X.logical_lines(F.col(text))).alias("line_no", "line"))
    return lines.withColumn("line_no", F.col("line_no") + 1).drop(text)


def edge_match(lines: Column, pattern: str) -> Column:
    """The last line that matches, looked for in the last and then the second-last one, else null."""
    n = F.size(lines)
    last, before = F.get(lines, n - 1), F.get(lines, n - 2)
    return F.when(F.coalesce(last.rlike(pattern), F.lit(False)), last).when(before.rlike(pattern), before)


def scan_footers(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages with chapter, page, manual_page, tag and is_toc; an edge line out of bounds gives no second chance."""
    line = edge_match(X.logical_lines(F.col(text)), FOOTER)
    out = pages.withColumn("_edge", line)
    for name, k in (("chapter", 1), ("page", 2)):
        out = out.withColumn(name, F.regexp_extract("_edge", FOOTER, k).try_cast("int"))
    out = out.withColumn("tag", F.trim(F.regexp_extract("_edge", FOOTER, 3)))
    good = (F.col("chapter") <= MOST_CHAPTER) & (F.col("page") <= MOST_PAGE) & F.length("tag").between(1, MOST_TAG)
    for name in ("chapter", "page", "tag"):
        out = out.withColumn(name, F.when(F.col("_good"), F.col(name))) if name != "chapter" else out.withColumn("_good", good).withColumn(name, F.when(F.col("_good"), F.col(name)))
    out = out.withColumn("manual_page", F.when(F.col("_good"), F.concat_ws("-", F.col("chapter").cast("string"), F.col("page").cast("string"))))
    return out.withColumn("is_toc", F.coalesce(F.lower("tag") == TOC_TAG, F.lit(False))).drop("_edge", "_good")


def parse_toc(lines: DataFrame, partition: list[str], order: list[str], line: str = "line", dotted: str = TOC_DOTTED, bare: str = TOC_BARE) -> DataFrame:
    """Contents entries: rows whose line has dotted leaders, with name, manual_page and indent.

    A bare name line is held and put before the next dotted line's name; a later bare line replaces it.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    is_dotted = F.coalesce(F.col(line).rlike(dotted), F.lit(False))
    name = F.when(~is_dotted & F.col(line).rlike(bare), F.trim(F.regexp_extract(line, bare, 2)))
    out = lines.withColumns({"_dotted": is_dotted, "_bare": name})
    out = out.withColumn("_entry", F.sum(F.col("_dotted").cast("int")).over(w) - F.col("_dotted").cast("int"))
    inside = Window.partitionBy(*partition, "_entry").orderBy(*order)
    out = out.withColumn("_held", F.last("_bare", ignorenulls=True).over(inside)).where("_dotted")
    own = F.trim(F.regexp_extract(line, dotted, 2))
    return out.select(
        *partition, *order, F.concat_ws(" ", "_held", own).alias("name"),
        F.regexp_extract(line, dotted, 3).alias("manual_page"), F.length(F.regexp_extract(line, dotted, 1)).alias("indent"),
    )


def select_specs(toc: DataFrame, partition: list[str], order: str = "ord") -> DataFrame:
    """Contents entries that name sections, with section_id, root_id and kind.

    `*` entries are keywords, kept at their first id. Entries at indent 0 open a document section and are
    the root of the nested ones after them; a `*` entry, a version-like or a repeated name leaves no root,
    and entries nested under none go.
    """
    w = Window.partitionBy(*partition).orderBy(order)
    star = F.startswith("name", F.lit("*"))
    ident = X.section_id(F.regexp_replace("name", r"^\*", ""))
    out = toc.withColumns({"_star": star, "section_id": ident})
    first = F.row_number().over(Window.partitionBy(*partition, "_star", "section_id", (F.col("indent") == 0) | F.col("_star")).orderBy(order)) == 1
    out = out.withColumn("_first", first)
    reset = F.col("_star") | (F.col("indent") == 0)
    opens = reset & ~F.col("_star") & F.col("_first") & ~F.col("name").rlike(VERSION_LIKE)
    root = F.last(F.when(reset, F.struct(F.when(opens, F.col("section_id")).alias("id"))), ignorenulls=True).over(w)
    out = out.withColumns({"_opens": opens, "_root": root["id"]})
    nested = ~reset & F.col("_root").isNotNull() & ~F.col("name").rlike(VERSION_LIKE)
    kind = F.when(F.col("_star") & F.col("_first"), "keyword").when(F.col("_opens"), "document").when(nested, "child")
    ident = F.when(nested, F.concat_ws("__", "_root", "section_id")).otherwise(F.col("section_id"))
    return out.withColumns({"kind": kind, "section_id": ident, "parent_section_id": F.when(nested, F.col("_root"))}).where("kind is not null").drop("_star", "_first", "_opens", "_root")


def theory_specs(toc: DataFrame, partition: list[str], order: str = "ord") -> DataFrame:
    """Numbered entries with section_number, title and the parent's number where that came earlier."""
    number = F.nullif(F.regexp_extract("name", r"^(\d+(?:\.\d+)*)\s+(.+)$", 1), F.lit(""))
    out = toc.withColumns({"section_number": number, "title": F.regexp_extract("name", r"^(\d+(?:\.\d+)*)\s+(.+)$", 2)}).where("section_number is not null")
    out = out.withColumn("parent_number", F.nullif(F.regexp_extract("section_number", r"^(.*)\.\d+$", 1), F.lit("")))
    first = out.groupBy(*partition, F.col("section_number").alias("_number")).agg(F.min(order).alias("_at"))
    joined = out.join(first.withColumnRenamed("_number", "parent_number"), [*partition, "parent_number"], "left")
    return joined.withColumn("parent_section_id", F.when(F.col("_at") < F.col(order), F.col("parent_number"))).drop("_at", "parent_number")


#: What may follow a name in its title line: options in braces or not, more names, an ellipsis (fixed values).
TITLE_OPTIONS = r"(?:_(?:[A-Z][A-Z0-9]*_)?(?:OPTION[A-Z0-9]*|\{OPTION[A-Z0-9]*\})(?:_(?:[A-Z][A-Z0-9]*|\{OPTION[A-Z0-9]*\}))*(?:_\.\.\.(?:_(?:[A-Z][A-Z0-9]*|\{OPTION[A-Z0-9]*\}))*)*)$"


def title_lines(pages: DataFrame, partition: list[str]) -> DataFrame:
    """(partition, pdf_page, _key, strong): each line that may be a title, as it is and without its options, a page's
    first line (the running header) left out; strong: among lines 2 to 5. Contents pages have none."""
    lines = pages.where(~F.col("is_toc")).select(*partition, "pdf_page", F.posexplode("lines").alias("_at", "_line")).where("_at > 0")
    line = X.title_key(F.col("_line"))
    keys = lines.withColumn("_line", line).withColumn("_key", F.explode(F.array_distinct(F.array("_line", F.regexp_replace("_line", TITLE_OPTIONS, "")))))
    return keys.groupBy(*partition, "pdf_page", "_key").agg(F.max(F.col("_at") <= 4).alias("strong"))


def _first_word(text: Column) -> Column:
    return F.regexp_extract(text, r"^[^\s.:]*", 0)


def opening_titles(specs: DataFrame, pages: DataFrame, partition: list[str]) -> DataFrame:
    """(partition, ord, pdf_page, strong) of lines that open with the name of an entry that is no keyword.

    A document's entry is met by a line that begins with its name up to a colon, whatever the case, at the end of a word. A numbered entry
    (section_number) is met where its number opens a line and number and title begin the next lines, up to four, a hyphen at a
    line's end closing up. Lines and entries meet by their first word, so that no page is held against all entries. Both sides grow with the
    documents, and many entries can come of small files: the joins are hinted, so that no side is sent to all tasks."""
    numbered = F.col("section_number").isNotNull()
    short = lambda c: F.regexp_replace(c, r"-\s+", "-")
    name = X.title_key(F.col("name"))
    head = X.title_key(F.split_part("name", F.lit(":"), F.lit(1)))
    title = F.when(numbered, short(F.concat_ws(" ", "section_number", X.title_key(F.col("title"))))).otherwise(F.lower(F.when(head == "", name).otherwise(head)))
    wanted = specs.select(*partition, "ord", numbered.alias("_numbered"), title.alias("_title"), F.when(numbered, F.col("section_number")).otherwise(_first_word(title)).alias("_word"))
    own = pages.where(~F.col("is_toc")).select(*partition, "pdf_page", "lines", F.posexplode("lines").alias("_at", "_line")).where("_at > 0")
    line = X.title_key(F.col("_line"))
    seen = own.withColumns({"_line": line, "_word": F.split_part(line, F.lit(" "), F.lit(1))})
    run = lambda last: short(F.array_join(F.transform(F.slice("lines", F.col("_at") + 1, F.greatest(last, F.lit(1))), X.collapse), " "))
    opens = lambda text: (text == F.col("_title")) | F.startswith(text, F.concat("_title", F.lit(" ")))
    by_number = seen.select(*partition, "pdf_page", "_at", "_word", run(F.lit(4)).alias("_run"), run(F.least(F.lit(4), F.lit(5) - F.col("_at"))).alias("_top")).join(wanted.where("_numbered").hint("merge"), [*partition, "_word"])
    found = by_number.where(opens(F.col("_run"))).select(*partition, "ord", "pdf_page", (opens(F.col("_top")) & (F.col("_at") <= 4)).alias("strong"))
    low = seen.select(*partition, "pdf_page", "_at", F.lower("_line").alias("_line")).withColumn("_word", _first_word(F.col("_line"))).join(wanted.where("not _numbered").hint("merge"), [*partition, "_word"])
    after = F.substring(F.col("_line"), F.length("_title") + 1, F.lit(1))
    fits = F.startswith("_line", F.col("_title")) & ((after == "") | after.rlike(r"[\s.:]"))
    return found.union(low.where(fits).select(*partition, "ord", "pdf_page", F.col("_at") <= 4))


def locate_starts(specs: DataFrame, pages: DataFrame, partition: list[str]) -> DataFrame:
    """specs (ord, name, manual_page) with start_page and code: the contents in order, with a cursor that never falls.

    Candidates are the pages whose footer bears the entry's printed page. The first at or after the cursor with a
    strong title is taken, else with a weak one; without a titled candidate, the first page from there on that is no
    contents page and has a strong title, else a weak one (ANCHOR_CONFLICT if there was a candidate); else the first
    candidate (TOC_PAGE_TITLE_NOT_FOUND), else none (TOC_ENTRY_UNRESOLVED). pages: pdf_page, manual_page, is_toc, lines.
    Titles and printed pages are met by equal keys; a document's candidates are gone through in one task, in sorted lists. Entries of another kind than
    keyword, where specs have a kind, are titled as opening_titles says.
    """
    named = specs.select(*partition, "ord", X.title_key(F.col("name")).alias("_key"), "manual_page")
    keyed = named.join(specs.where("kind = 'keyword'").select(*partition, "ord"), [*partition, "ord"], "left_semi") if "kind" in specs.columns else named
    titles = keyed.join(title_lines(pages, partition), [*partition, "_key"]).select(*partition, "ord", "pdf_page", "strong")
    if "kind" in specs.columns:
        full = specs.withColumns({c: F.lit(None).cast("string") for c in ("section_number", "title") if c not in specs.columns})
        titles = titles.union(opening_titles(full.where("kind != 'keyword'"), pages, partition))
    titled = titles.select("*", F.lit(True).alias("weak"), F.lit(False).alias("here"))
    printed = named.join(pages.where(~F.col("is_toc")).select(*partition, "pdf_page", "manual_page"), [*partition, "manual_page"]).select(*partition, "ord", "pdf_page", F.lit(False), F.lit(False), F.lit(True))
    met = titled.union(printed).groupBy(*partition, "ord", "pdf_page").agg(F.max("strong").alias("strong"), F.max("weak").alias("weak"), F.max("here").alias("here"))
    all_of = specs.select(*partition, "ord").join(met, [*partition, "ord"], "left")
    kinds = ", ".join(f"{c} {specs.schema[c].dataType.simpleString()}" for c in [*partition, "ord"])
    starts = all_of.groupBy(*partition).applyInArrow(_locate, f"{kinds}, start_page int, code string")
    return specs.join(starts, [*partition, "ord"], "left")


def _from(pages: list[int], least: int) -> int | None:
    """The first of sorted pages (which count from 1) that is not before `least`."""
    k = bisect_left(pages, least)
    return pages[k] if k < len(pages) else None


def _locate(key: tuple[pa.Scalar, ...], met: pa.Table) -> pa.Table:
    """A document's entries in order, each against its sorted candidates: the cursor is found in them by halving."""
    met = met.sort_by([("ord", "ascending"), ("pdf_page", "ascending")])
    flags = [met[c].to_pylist() for c in ("ord", "pdf_page", "strong", "weak", "here")]
    lists: dict[int, tuple[list[int], ...]] = {}
    for at, page, strong, weak, here in zip(*flags):
        held = lists.setdefault(at, ([], [], [], [], []))
        if page is not None:
            for wanted, pages in zip((here, here and strong, here and weak, strong, weak), held):
                if wanted:
                    pages.append(page)
    cursor, out = 1, []
    for at, held in lists.items():
        candidate, confirmed = _from(held[0], cursor), _from(held[1], cursor) or _from(held[2], cursor)
        onward = candidate or cursor
        searched = _from(held[3], onward) or _from(held[4], onward)
        page = confirmed or searched or candidate
        code = "TOC_ENTRY_UNRESOLVED" if page is None else None if confirmed or not candidate else "ANCHOR_CONFLICT" if searched else "TOC_PAGE_TITLE_NOT_FOUND"
        out.append((at, page, code))
        cursor = max(cursor, page or cursor)
    ords, pages, codes = zip(*out)
    names = [c for c in met.column_names if c not in ("ord", "pdf_page", "strong", "weak", "here")]
    of_key = {c: pa.array([k.as_py()] * len(out), k.type) for c, k in zip(names, key)}
    return pa.table({**of_key, "ord": pa.array(ords, met.schema.field("ord").type), "start_page": pa.array(pages, pa.int32()), "code": pa.array(codes, pa.string())})


def interpolate(pages: DataFrame, partition: list[str], order: str = "pdf_page", known: str = "known", chapter: str | None = None, evidence: str | None = None) -> DataFrame:
    """pages with filled and evidence: a page between two known ones of one chapter, as far apart in print
    as in place, gets its number by counting. known: the printed number or null."""
    w = Window.partitionBy(*partition).orderBy(order)
    # the next known page is the last one in falling order: a frame that grows, where one that shrinks is gone over again for each row
    back, ahead = (x.rowsBetween(Window.unboundedPreceding, Window.currentRow) for x in (w, Window.partitionBy(*partition).orderBy(F.desc(order))))
    chapter_of = F.col(chapter) if chapter else F.lit(0)
    at = F.when(F.col(known).isNotNull(), F.struct(F.col(order).alias("p"), F.col(known).alias("k"), chapter_of.alias("c")))
    out = pages.withColumns({"_prev": F.last(at, True).over(back), "_next": F.last(at, True).over(ahead)})
    fits = (F.col("_prev.c") == F.col("_next.c")) & (F.col("_next.p") - F.col("_prev.p") == F.col("_next.k") - F.col("_prev.k"))
    filled = F.when(F.col(known).isNotNull(), F.col(known)).when(fits, F.col("_prev.k") + F.col(order) - F.col("_prev.p"))
    given = F.col(evidence) if evidence else F.lit("footer")
    kind = F.when(F.col(known).isNotNull(), given).when(fits, F.lit("interpolated"))
    return out.withColumns({"filled": filled, "evidence": kind}).drop("_prev", "_next")


def monotone_breaks(pages: DataFrame, partition: list[str], order: str = "pdf_page", label: str = "filled", start: str = "is_start") -> DataFrame:
    """Neighbouring labelled pages whose label does not rise, unless either is a section start."""
    w = Window.partitionBy(*partition).orderBy(order)
    seen = pages.where(F.col(label).isNotNull())
    pair = seen.withColumns({"previous_page": F.lag(order).over(w), "previous_label": F.lag(label).over(w), "_start": F.lag(start).over(w)})
    return pair.where((F.col("previous_label") >= F.col(label)) & ~F.col(start) & ~F.col("_start")).drop("_start")


def section_ranges(starts: DataFrame, partition: list[str], order: list[str], start: str, end_of_content: str) -> DataFrame:
    """starts with end_page: the next start, included, as neighbours share a page; the last ends with the content."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return starts.withColumn("end_page", F.greatest(F.col(start), F.coalesce(F.lead(start).over(w), F.col(end_of_content))))


def root_ranges(starts: DataFrame, partition: list[str], order: str, start: str, indent: str, end_of_content: str) -> DataFrame:
    """Like section_ranges for document roots: the end is the next start at indent 0."""
    w = Window.partitionBy(*partition).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(F.col(indent) == 0, F.col(start)), ignorenulls=True).over(w)
    return starts.withColumn("end_page", F.greatest(F.col(start), F.coalesce(following, F.col(end_of_content))))


def theory_ranges(starts: DataFrame, partition: list[str], order: str, start: str, number: str, end_of_content: str) -> DataFrame:
    """The end of a numbered section is the next start of its depth or less.

    One column for each depth that occurs (a number's parts) holds the next start of that depth or less; all share
    one window, gone through once from the end."""
    w = Window.partitionBy(*partition).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    out = starts.withColumn("_depth", F.size(X.number_path(F.col(number))))
    deepest = out.agg(F.max("_depth")).first()[0] or 0  # one number
    following = [F.last(F.when(F.col("_depth") <= d, F.col(start)), ignorenulls=True).over(w) for d in range(deepest + 1)]
    out = out.withColumns({f"_next{d}": c for d, c in enumerate(following)})
    found = F.coalesce(*[F.when(F.col("_depth") == d, F.col(f"_next{d}")) for d in range(deepest + 1)])
    out = out.withColumn("end_page", F.greatest(F.col(start), F.coalesce(found, F.col(end_of_content))))
    return out.drop("_depth", *[f"_next{d}" for d in range(deepest + 1)])


def content_end(pages: DataFrame, partition: list[str], profile: str = "keyword") -> DataFrame:
    """Per document the last page of content: headed by `*` and a letter, or with a footer in the theory profile."""
    good = F.get("lines", F.lit(0)).rlike(r"^\*[A-Za-z]") if profile == "keyword" else F.col("manual_page").isNotNull()
    return pages.groupBy(*partition).agg(F.coalesce(F.max(F.when(good, F.col("pdf_page"))), F.lit(1)).alias("content_end"))


def alias_map(lines: DataFrame, line: str = "line") -> DataFrame:
    """(alias, keyword_id) of the alias lines."""
    found = lines.where(F.col(line).rlike(ALIAS_LINE))
    return found.select(F.regexp_extract(line, ALIAS_LINE, 1).alias("alias"), X.slug(F.regexp_extract(line, ALIAS_LINE, 2)).alias("keyword_id")).distinct()


def invert_aliases(by_alias: DataFrame, alias: str = "alias", ids: str = "ids", name: str = "keyword_id") -> DataFrame:
    """(name, aliases): of each id all aliases that stand for it, sorted. by_alias: alias and its array of ids."""
    pairs = by_alias.select(F.col(alias).alias("_alias"), F.explode(ids).alias(name))
    return pairs.groupBy(name).agg(F.sort_array(F.collect_set("_alias")).alias("aliases"))


def inspection_counts(starts: DataFrame, pagemap: DataFrame, issues: DataFrame, partition: list[str]) -> DataFrame:
    """(partition, measure, value, n): entries by kind, pages by evidence and issues by code, long."""
    by = lambda df, column, name: df.groupBy(*partition, F.lit(name).alias("measure"), F.coalesce(F.col(column), F.lit("none")).alias("value")).agg(F.count("*").alias("n"))
    return by(starts, "kind", "kind").union(by(pagemap, "evidence", "evidence")).union(by(issues, "code", "issue"))


def inspection_gate(stats: DataFrame, starts: DataFrame, issues: DataFrame, partition: list[str]) -> DataFrame:
    """stats (of inspection_stats) with unresolved entries and error issues; passes asks for coverage and none of both."""
    lost = starts.groupBy(*partition).agg(F.count(F.when(F.col("start_page").isNull(), 1)).alias("unresolved"))
    bad = issues.groupBy(*partition).agg(F.count(F.when(F.col("severity") == "error", 1)).alias("errors"))
    out = stats.join(lost, partition, "left").join(bad, partition, "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("unresolved", "errors")})
    return out.withColumn("passes", F.col("passes") & (F.col("unresolved") == 0) & (F.col("errors") == 0))


def inspection_stats(pagemap: DataFrame, partition: list[str], profile: str = "keyword") -> DataFrame:
    """Per document: pages, pages by evidence, coverage and whether it reaches the profile's least."""
    counts = pagemap.groupBy(*partition, "evidence").agg(F.count("*").alias("n"))
    per = counts.groupBy(*partition).agg(
        F.sum("n").alias("pages"), F.sum(F.when(F.col("evidence").isNotNull(), F.col("n")).otherwise(0)).alias("labelled"),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("evidence").isNotNull(), F.struct("evidence", "n"))))).alias("by_evidence"),
    )
    coverage = F.col("labelled") / F.col("pages")
    return per.withColumns({"coverage": coverage, "passes": coverage >= LEAST_COVERAGE[profile]})


def page_map(scanned: DataFrame, starts: DataFrame, part: list[str]) -> DataFrame:
    """(part, pdf_page, manual_page, evidence) of each page: its footer's number, an entry's that starts there, or one counted between."""
    anchors = starts.where("start_page is not null").groupBy(*part, F.col("start_page").alias("pdf_page")).agg(F.min("manual_page").alias("anchor"))
    labelled = scanned.join(anchors, [*part, "pdf_page"], "left")
    c1, p1 = X.chapter_and_page(F.col("anchor"))
    known = labelled.withColumns({"known": F.coalesce("page", p1), "chapter": F.coalesce("chapter", c1), "given": F.when(F.col("page").isNotNull(), "footer").otherwise("anchor")})
    filled = interpolate(known.drop("evidence"), part, chapter="chapter", evidence="given")
    up = Window.partitionBy(*part).orderBy("pdf_page").rowsBetween(Window.unboundedPreceding, 0)
    chapter = F.coalesce("chapter", F.last("chapter", True).over(up))
    return filled.select(*part, "pdf_page", F.when(F.col("filled").isNotNull(), F.concat_ws("-", chapter.cast("string"), F.col("filled").cast("string"))).alias("manual_page"), "evidence")


def inspect_pages(page_text: DataFrame, partition: list[str] | None = None, store: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """The whole inspection of page texts (document_id, pdf_page, text): footers, contents, specs, sections, page map.

    store may write a table and give it back as read, so that the tables made of it do not make it again."""
    part = partition or ["document_id"]
    scanned = store("footers", scan_footers(page_text.withColumn("lines", X.logical_lines(F.col("text")))).drop("text"))
    lines = scanned.where("is_toc").select(*part, "pdf_page", F.posexplode("lines").alias("line_no", "line")).where("line_no > 0")
    toc = store("toc", parse_toc(lines, part, ["pdf_page", "line_no"]).withColumn("ord", F.row_number().over(Window.partitionBy(*part).orderBy("pdf_page", "line_no"))).drop("pdf_page", "line_no"))
    specs = store("specs", select_specs(toc, part))
    starts = store("starts", locate_starts(specs, scanned, part))
    sections = section_ranges(starts.where("start_page is not null").join(content_end(scanned, part), part), part, ["start_page", "ord"], "start_page", "content_end")
    pagemap = page_map(scanned, starts, part)
    return {"toc": toc, "specs": specs, "starts": starts, "sections": store("sections", sections), "pagemap": store("pagemap", pagemap)}
