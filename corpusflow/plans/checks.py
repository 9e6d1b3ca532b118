"""Checks that a build makes on what it has: pages against their text layers, page tables, contents and page maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import navigation, quality

PAGE = ["document_id", "pdf_page"]


def text_layers(page_text: DataFrame, page_ir: DataFrame, least_tokens: int = 8, least_recall: float = 0.65) -> DataFrame:
    """(document_id, pdf_page, tokens, layer_tokens, overlap, recall, prose_recall, code) of every recognised page: which of its
    tokens its text layer has, with and without formulas; code null where enough of them are there.

    One count of tokens by page over the three texts, which tell their own by a column."""
    seen = page_ir.select(*PAGE, F.lit("seen").alias("kind"), X.page_text(F.col("blocks")).alias("text"))
    prose = page_ir.select(*PAGE, F.lit("prose"), X.page_text(F.col("blocks"), formulas=False))
    layer = page_text.join(page_ir.select(*PAGE), PAGE, "left_semi").select(*PAGE, F.lit("layer"), F.coalesce("text", F.lit("")))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    per = quality.token_table(seen.union(prose).union(layer), [*PAGE, "kind"], "text").groupBy(*PAGE, "token").agg(of("seen").alias("seen"), of("prose").alias("prose"), of("layer").alias("layer"))
    sums = per.groupBy(*PAGE).agg(*[F.sum(c).alias(c) for c in ("seen", "prose", "layer")], F.sum(F.least("seen", "layer")).alias("overlap"), F.sum(F.least("prose", "layer")).alias("prose_overlap"))
    all_of = page_ir.select(*PAGE).join(sums, PAGE, "left").fillna(0)
    recall = lambda part, whole: F.col(part) / F.nullif(whole, F.lit(0))
    out = all_of.withColumns({"recall": recall("overlap", "seen"), "prose_recall": recall("prose_overlap", "prose")})
    code = quality.text_layer_verdict(F.col("seen"), F.col("prose"), F.coalesce("recall", F.lit(0.0)), F.coalesce("prose_recall", F.lit(0.0)), least_tokens, least_recall)
    return out.select(*PAGE, F.col("seen").alias("tokens"), F.col("layer").alias("layer_tokens"), "overlap", "recall", "prose_recall", code.alias("code"))


def inspection_gates(pagemap: DataFrame, starts: DataFrame, issues: DataFrame) -> DataFrame:
    """(document_id, profile, pages, labelled, coverage, unresolved, errors, passes) of each document, by its profile's least coverage."""
    out = None
    for profile, least in navigation.LEAST_COVERAGE.items():
        mine = pagemap.where(F.startswith("document_id", F.lit("theory")) == F.lit(profile == "theory"))
        gate = navigation.inspection_gate(navigation.inspection_stats(mine, ["document_id"], profile), starts, issues, ["document_id"])
        gate = gate.select("document_id", F.lit(profile).alias("profile"), "pages", "labelled", "coverage", F.lit(least).alias("least"), "unresolved", "errors", "passes")
        out = gate if out is None else out.union(gate)
    return out


def contract_issues(sections: DataFrame, pagemap: DataFrame, claims: DataFrame) -> DataFrame:
    """(document_id, section_id, code) of what the contract of contents and page maps finds; section_id null where it is the document.

    claims: document_id, section_id, pdf_page of each section's pages."""
    numbered = claims.join(pagemap.select(*PAGE, "manual_page"), PAGE, "left")
    pages = numbered.groupBy("document_id", "section_id").agg(F.sort_array(F.collect_list(F.struct("pdf_page", "manual_page"))).alias("_p"))
    volume = F.regexp_extract("document_id", r"volume-(\\d+)", 1).try_cast("int")
    held = sections.join(pages, ["document_id", "section_id"], "left").withColumns({"pdf_pages": F.col("_p.pdf_page"), "manual_pages": F.col("_p.manual_page"), "volume": volume, "keyword_id": F.when(F.col("kind") == "keyword", F.col("section_id"))})
    documents = pagemap.groupBy("document_id").agg(F.max("pdf_page").alias("pages")).withColumn("volume", volume)
    whole = quality.pagemap_issues(pagemap, ["document_id"]).union(quality.sequence_issues(pagemap, ["document_id"]))
    return quality.navigation_issues(held, documents).union(whole.select("document_id", F.lit(None).cast("string"), "code"))
