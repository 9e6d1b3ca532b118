"""Sections joined with their pages' blocks, shared pages, title anchors and ownership of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X


def section_pages(sections: DataFrame) -> DataFrame:
    """sections exploded to their pages (array of pdf_page and manual_page)."""
    return sections.select("*", F.explode("pages").alias("_p")).select("*", "_p.pdf_page", "_p.manual_page").drop("_p", "pages")


def attach_labels(pages: DataFrame, pagemap: DataFrame) -> DataFrame:
    """pages with the printed label of the page map, which alone is trusted."""
    return pages.drop("manual_page").join(pagemap.select("document_id", "pdf_page", "manual_page"), ["document_id", "pdf_page"], "left")


def assemble(claims: DataFrame, page_ir: DataFrame) -> DataFrame:
    """Section pages with blocks, and the issue of a page that is missing or empty."""
    joined = claims.join(page_ir.select("document_id", "pdf_page", "blocks", F.lit(True).alias("_there")), ["document_id", "pdf_page"], "left")
    code = F.when(F.col("_there").isNull(), "SECTION_PAGEIR_MISSING").when(F.size("blocks") == 0, "SECTION_CONTENT_EMPTY")
    return joined.withColumn("issue", code).drop("_there")


def shared_pages(claims: DataFrame, document: str = "document_id", page: str = "pdf_page", section: str = "section_id") -> DataFrame:
    """(document, page, owners) of pages that several sections claim."""
    per = claims.groupBy(document, page).agg(F.sort_array(F.collect_set(section)).alias("owners"))
    return per.where(F.size("owners") > 1)


def hierarchy_overlap(owners: Column) -> Column:
    """Whether of each two owners (numbers like 22.3) one is the other's ancestor: then the overlap is no doubt."""
    path = lambda x: X.number_path(x)

    def related(a: Column, b: Column) -> Column:
        n = F.least(F.size(path(a)), F.size(path(b)))
        return (n > 0) & (F.slice(path(a), F.lit(1), F.greatest(n, F.lit(1))) == F.slice(path(b), F.lit(1), F.greatest(n, F.lit(1))))

    return F.forall(owners, lambda a: F.forall(owners, lambda b: related(a, b)))


def title_anchors(blocks: DataFrame, section: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """One anchor per section: of the blocks of the best title rank the only one, or the first of several that only
    header, footer or blank blocks part; none otherwise. blocks: all blocks with type, text, rank (null: no title)."""
    w = Window.partitionBy(*section).orderBy(*order)
    solid = ~F.col("type").isin("header", "footer") & (X.strip(F.coalesce("text", F.lit(""))) != "")
    best = F.max(rank).over(Window.partitionBy(*section))
    marked = blocks.withColumns({"_best": F.coalesce(F.col(rank) == best, F.lit(False))})
    marked = marked.withColumn("_between", F.sum((solid & ~F.col("_best")).cast("int")).over(w)).where("_best")
    per = marked.groupBy(*section).agg(F.min(F.struct(*order)).alias("anchor"), F.count_distinct("_between").alias("runs"), F.count("*").alias("candidates"))
    return per.where("runs = 1").select(*section, "anchor", "candidates")


def theory_ownership(blocks: DataFrame, anchors: DataFrame, document: str, order: list[str]) -> DataFrame:
    """Blocks (document, order columns) with the section whose anchor is the nearest at or before them.

    Anchors at one place give several owners. anchors: document, section, and the order columns."""
    at = F.struct(*order)
    marks = anchors.select(document, at.alias("_at"), "section_id")
    spots = marks.select(document, "_at").distinct().withColumn("_mark", F.lit(True))
    joined = blocks.withColumn("_at", at).join(spots, [document, "_at"], "left")
    w = Window.partitionBy(document).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    held = joined.withColumn("_owner_at", F.last(F.when(F.col("_mark"), F.col("_at")), ignorenulls=True).over(w)).drop("_mark", "_at")
    return held.join(marks.withColumnRenamed("_at", "_owner_at"), [document, "_owner_at"], "left").drop("_owner_at")


def boundary_slices(owners: DataFrame) -> DataFrame:
    """Which blocks of a shared page each owner keeps.

    owners: document_id, pdf_page, section_id, ord, first_page, last_page, anchor (block of a confirmed title, or null), n_blocks.
    The page is cut where the first owner ends there, the last starts there, those between are of this one page, and
    the later owners' anchors rise; otherwise all keep the whole page, with a warning.
    """
    per = owners.groupBy("document_id", "pdf_page").agg(F.sort_array(F.collect_list(F.struct("ord", "section_id", "first_page", "last_page", "anchor", "n_blocks"))).alias("o"))
    per = per.where(F.size("o") > 1)
    later = F.slice("o", F.lit(2), F.size("o") - 1)
    inner = F.when(F.size("o") > 2, F.slice("o", F.lit(2), F.size("o") - 2)).otherwise(F.array().cast(per.schema["o"].dataType))
    marks = F.transform(later, lambda x: x["anchor"])
    chain = (
        (F.get("o", F.lit(0))["last_page"] == F.col("pdf_page")) & (F.element_at("o", -1)["first_page"] == F.col("pdf_page"))
        & F.forall(inner, lambda x: (x["first_page"] == F.col("pdf_page")) & (x["last_page"] == F.col("pdf_page")))
        & F.forall(marks, lambda m: m.isNotNull()) & (F.array_sort(F.array_distinct(marks)) == marks)
    )
    cut = F.transform("o", lambda x, i: F.struct(x["section_id"].alias("section_id"), F.when(chain, F.when(i == 0, 0).otherwise(x["anchor"])).otherwise(0).alias("first_block"), F.when(chain, F.coalesce(F.get("o", i + 1)["anchor"], x["n_blocks"])).otherwise(x["n_blocks"]).alias("end_block")))
    out = per.withColumns({"_chain": F.coalesce(chain, F.lit(False)), "_cut": F.explode(cut)})
    issue = F.when(F.col("_chain"), "KEYWORD_BOUNDARY_RESOLVED").otherwise("KEYWORD_BOUNDARY_AMBIGUOUS")
    return out.select("document_id", "pdf_page", "_cut.section_id", "_cut.first_block", "_cut.end_block", issue.alias("code"))
