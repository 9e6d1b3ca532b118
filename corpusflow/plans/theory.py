"""Documents of numbered sections: their contents, ranges and entries. A section owns what stands from its title to the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import navigation, quality, rendering
from corpusflow.plans import build
from corpusflow.sources.writers import as_is

KEYS, ORDER = ["document_id", "section_id"], ["pdf_page", "block_index"]


def is_theory(document: Column) -> Column:
    return F.startswith(document, F.lit("theory"))


def inspect(page_text: DataFrame, store: build.Store = as_is) -> dict[str, DataFrame]:
    """Contents, sections and page map of page texts (document_id, pdf_page, text) of numbered documents.

    Sections lie in each other as their numbers do: one ends where the next of its depth or less starts."""
    part = ["document_id"]
    scanned = store("theory_footers", navigation.scan_footers(page_text.withColumn("lines", X.logical_lines(F.col("text")))).drop("text"))
    lines = scanned.where("is_toc").select(*part, "pdf_page", F.posexplode("lines").alias("line_no", "line")).where("line_no > 0")
    toc = navigation.parse_toc(lines, part, ["pdf_page", "line_no"]).withColumn("ord", F.row_number().over(Window.partitionBy(*part).orderBy("pdf_page", "line_no"))).drop("pdf_page", "line_no")
    specs = store("theory_specs", navigation.theory_specs(toc, part).withColumns({"kind": F.lit("theory"), "section_id": F.col("section_number")}))
    starts = store("theory_starts", navigation.locate_starts(specs, scanned, part))
    placed = starts.where("start_page is not null").join(navigation.content_end(scanned, part, "theory"), part)
    sections = store("theory_sections", navigation.theory_ranges(placed, part, "ord", "start_page", "section_number", "content_end"))
    return {"specs": specs, "starts": starts, "sections": sections, "pagemap": store("theory_pagemap", navigation.page_map(scanned, starts, part))}


def reconstruct(sections: DataFrame, page_ir: DataFrame, store: build.Store = as_is) -> dict[str, DataFrame]:
    """blocks (with the section that owns them), entries (markdown without the title's blocks, status) and issues."""
    listed = page_ir.select("document_id", "pdf_page", F.posexplode("blocks").alias("block_index", "block"))
    blocks = store("theory_source", listed.withColumns({"type": F.col("block.type"), "text": F.coalesce("block.text", F.lit(""))}))
    owned = store("theory_blocks", build.theory_entries(sections, blocks))
    shown = owned.where("type not in ('header', 'footer')").join(sections.select(*KEYS, "section_number", "title"), KEYS)
    at = Window.partitionBy(*KEYS).orderBy(*ORDER)
    first = lambda k: F.first(F.when(F.col("_nth") == k, F.col("text")), True).over(Window.partitionBy(*KEYS))
    shown = shown.withColumn("_nth", F.row_number().over(at)).withColumns({"_one": first(1), "_two": first(2)})
    used = F.when(F.col("anchored"), rendering.theory_titles(F.coalesce("_one", F.lit("")), F.coalesce("_two", F.lit("")), F.col("section_number"), F.col("title"))).otherwise(0)
    body = rendering.render_blocks(shown.where(F.col("_nth") > used), KEYS, ORDER)
    pages = sections.withColumn("pdf_page", F.explode(F.sequence("start_page", "end_page"))).select(*KEYS, "pdf_page")
    lost = pages.join(page_ir.select("document_id", "pdf_page"), ["document_id", "pdf_page"], "left_anti").select(*KEYS, "pdf_page", F.lit("SECTION_PAGEIR_MISSING").alias("issue"))
    found = build.theory_issues(owned).join(sections.select(*KEYS, "start_page"), KEYS).select(*KEYS, F.col("start_page").alias("pdf_page"), F.col("code").alias("issue"))
    issues = store("theory_section_issues", lost.union(found))
    marked = issues.where(~F.col("issue").isin(*build.INFO_CODES)).select(*KEYS).distinct().withColumn("_marked", F.lit(True))
    # a section that is nothing but its title and sections of its own has content all the same
    there = owned.groupBy(*KEYS).agg(F.count("*").alias("_n"))
    entries = sections.join(body, KEYS, "left").join(there, KEYS, "left").join(marked, KEYS, "left")
    entries = entries.withColumn("markdown", F.coalesce("markdown", F.when(F.col("_n") > 0, F.lit(""))))
    entries = entries.withColumn("status", quality.entry_status(F.col("markdown").isNotNull(), F.coalesce("_marked", F.lit(False))))
    return {"blocks": owned, "entries": entries.drop("_n", "_marked"), "issues": issues}
