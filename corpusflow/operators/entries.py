"""Entries of sections as Markdown: what is read in a section, part by part, each grid row shown once.

Parts come in a fixed order under their headings. Cards and variables have headings of their own, in the order in which they
first occur; tables that go on with one before are joined to it; rows of description tables that no variable owns are shown
after the variables, and blocks that are part of nothing as source material.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import intervals, rendering
from corpusflow.operators.sections import description_chains

#: Headings of an entry in their order, and texts that a heading makes superfluous (fixed values of the notation).
HEADINGS = ("Description", "Purpose", "Options", "Card Definitions", "Variable Descriptions", "Remarks", "References", "Source Material")
LABELS = ("card summary", "card summary:", "data card definitions", "data card definitions:", "remarks", "references")
VARIABLE_HEADS = ("variable", "description", "variable:", "description:")
PLACES = {"description": 0, "purpose": 1, "card_intro": 3, "remarks": 5, "references": 6, "unclassified": 7}


def _rows(grid: Column, start: Column, end: Column) -> Column:
    return F.slice(grid, start + 1, F.greatest(end - start, F.lit(0)))


def parts(blocks: DataFrame, ranges: DataFrame, fields: DataFrame, section: list[str], order: list[str]) -> DataFrame:
    """(section, rank, owner, sub, at, md): pieces of Markdown in the order of (rank, owner, sub, at).

    blocks: section, order, name, block, text, type, grid, bucket, detail; ranges and fields as sections.read gives them."""
    ids, at = [*section, *order], F.struct(*order, F.lit(0).alias("row"))
    page = F.col(order[0])
    b = blocks.withColumns({"_at": at, "_text": X.strip(F.coalesce("text", F.lit(""))), "_md": rendering.render_block(F.col("block"), page)})
    low = F.lower("_text")
    owner = lambda k, x=None: F.struct(F.lit(k).alias("k"), (x if x is not None else F.lit(None).cast(b.schema["_at"].dataType)).alias("first"))
    row = lambda df, rank, own, sub, place, md: df.select(*section, F.lit(rank).cast("int").alias("rank") if isinstance(rank, int) else rank.cast("int").alias("rank"), own.alias("owner"), F.lit(sub).alias("sub"), place.alias("at"), md.alias("md"))
    out = []
    # blocks that stand for themselves
    plain = b.where(F.col("bucket").isin(*PLACES)).where(~low.isin(*LABELS) & ~X.is_section_heading(F.col("_text"), F.regexp_replace("name", r"^\*", "")))
    place = F.coalesce(*[F.when(F.col("bucket") == k, F.lit(v)) for k, v in PLACES.items()])
    out.append(row(plain.where("_md is not null"), place, owner(0), 0, F.col("_at"), F.col("_md")))
    # options
    w = lambda *by: Window.partitionBy(*section, *by)
    chosen = b.where("bucket = 'option'").withColumn("_first", F.min("_at").over(w("detail")))
    out.append(row(chosen.where("_at = _first"), 2, owner(1, F.col("_first")), 0, F.col("_at"), F.concat(F.lit("- "), F.col("detail"))))
    # cards: their headings, conditions and tables
    of_field = fields.join(b.where("bucket = 'card_definition'").select(*ids, "_at", "grid"), ids).select(*section, F.col("label").alias("card"), F.col("_at").withField("row", F.col("row_start")).alias("_at"), F.lit(False).alias("_more"), _rows(F.col("grid"), F.col("row_start"), F.col("row_end")).alias("_grid"))
    whole = b.where("type = 'table' and bucket in ('card_summary', 'card_definition')").join(fields.select(*ids).distinct(), ids, "left_anti")
    whole = whole.select(*section, F.col("detail").alias("card"), "_at", (F.col("bucket") == "card_definition").alias("_more"), F.col("grid").alias("_grid"))
    tables = of_field.union(whole).where("card is not null")
    said = b.where("bucket = 'card_condition'").withColumn("_conditions", X.conditions(F.col("_text")))
    first = tables.select(*section, "card", "_at").union(said.select(*section, F.col("detail"), "_at")).where("card is not null").groupBy(*section, "card").agg(F.min("_at").alias("_first"))
    own = owner(1, F.col("_first"))
    out.append(row(first, 3, own, 0, F.col("_first"), F.concat(F.lit("### "), F.col("card"))))
    said = said.withColumnRenamed("detail", "card").join(first, [*section, "card"])
    with_any = said.where("size(_conditions) > 0")
    out.append(row(with_any.groupBy(*section, "_first").agg(F.min("_at").alias("_at")), 3, own, 1, F.col("_at"), F.lit("#### Conditions")))
    one = F.concat(F.lit("- `"), F.col("c.variable"), F.lit(" "), F.col("c.operator"), F.lit(" "), F.array_join("c.values", " or "), F.lit("` — "), X.collapse(F.col("_text")))
    listed = with_any.select(*section, "_first", "_at", "_text", F.posexplode("_conditions").alias("_k", "c")).withColumn("_place", F.col("_at").withField("row", F.col("_k")))
    out.append(row(listed, 3, own, 2, F.col("_place"), one))
    out.append(row(said.where("size(_conditions) = 0 and _md is not null"), 3, own, 3, F.col("_at"), F.col("_md")))
    go_on = Window.partitionBy(*section, "card").orderBy("_at")
    tables = tables.withColumn("_chain", F.sum((~F.col("_more")).cast("int")).over(go_on))
    joined = tables.groupBy(*section, "card", "_chain").agg(F.min("_at").alias("_at"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_grid"))), lambda x: x["_grid"])).alias("_grid")).join(first, [*section, "card"])
    out.append(row(joined, 3, own, 4, F.col("_at"), rendering.pipe_table(F.col("_grid"))))
    # variables: their headings, texts and rows
    described = b.where("bucket = 'variable'").withColumnRenamed("detail", "variable")
    chains = description_chains(ranges, section, order).join(b.select(*ids, "_at", "grid"), ids)
    chains = chains.withColumns({"_at": F.col("_at").withField("row", F.col("row_start")), "_grid": _rows(F.col("grid"), F.col("row_start"), F.col("row_end"))})
    nothing = F.lit(None).cast("array<string>")
    seen = described.select(*section, "variable", F.col("targets") if "targets" in described.columns else nothing.alias("targets"), "_at").union(chains.select(*section, "variable", "targets", "_at"))
    key = F.lower("variable").alias("_key")
    first = seen.groupBy(*section, key).agg(F.min("_at").alias("_first"), F.min_by("variable", "_at").alias("_label"), F.min_by("targets", F.when(F.col("targets").isNotNull(), F.col("_at"))).alias("_targets"))
    out.append(row(first, 4, own, 0, F.col("_first"), F.concat(F.lit("### "), F.col("_label"))))
    applies = F.concat(F.lit("Applies to: "), F.array_join(F.transform("_targets", lambda x: F.concat(F.lit("`"), x, F.lit("`"))), ", "))
    out.append(row(first.where("_targets is not null and _targets != array(_label)"), 4, own, 1, F.col("_first"), applies))
    texts = described.where("_md is not null").where(low != F.lower("variable")).select(*section, key, "_at", "_md", F.when(F.col("type") == "text", X.collapse(F.col("_text"))).alias("_sig"))
    texts = texts.withColumn("_nth", F.when(F.col("_sig").isNotNull(), F.row_number().over(Window.partitionBy(*section, "_key", "_sig").orderBy("_at"))).otherwise(1)).where("_nth = 1").join(first, [*section, "_key"])
    out.append(row(texts, 4, own, 2, F.col("_at"), F.col("_md")))
    once = chains.withColumn("_key", key).withColumn("_nth", F.row_number().over(Window.partitionBy(*section, "_key", "_grid").orderBy("_at"))).where("_nth = 1")
    once = once.groupBy(*section, "_key", "chain").agg(F.min("_at").alias("_at"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_grid"))), lambda x: x["_grid"])).alias("_grid")).join(first, [*section, "_key"])
    out.append(row(once, 4, own, 3, F.col("_at"), rendering.variable_table(F.col("_grid"))))
    # rows that no variable owns
    in_tables = b.where("bucket = 'variable_table'").withColumns({"first": F.coalesce(X.is_variable_head(F.get("grid", F.lit(0))), F.lit(False)).cast("int"), "last": F.size("grid")})
    gaps = intervals.uncovered(in_tables, ranges, ids).join(in_tables.select(*ids, "_at", "grid", "first", "last"), ids)
    bare = (F.col("first") == 0) & (F.col("row_start") == 0) & (F.col("row_end") == F.col("last"))
    gap = _rows(F.col("grid"), F.col("row_start"), F.col("row_end"))
    out.append(row(gaps, 4, owner(2), 0, F.col("_at").withField("row", F.col("row_start")), F.when(bare, rendering.pipe_table(F.col("grid"))).otherwise(rendering.variable_table(gap))))
    loose = b.where("bucket = 'variable_intro' and _md is not null").where(~low.isin(*VARIABLE_HEADS) & ~X.is_section_heading(F.col("_text"), F.regexp_replace("name", r"^\*", "")))
    out.append(row(loose, 7, owner(0), 0, F.col("_at"), F.col("_md")))
    return reduce(DataFrame.union, out).where(X.strip("md") != "")


def render(pieces: DataFrame, section: list[str]) -> DataFrame:
    """(section, markdown) of entries; null where there is nothing but source material."""
    head = F.coalesce(*[F.when(F.col("rank") == i, F.lit(f"## {h}")) for i, h in enumerate(HEADINGS)])
    per = pieces.groupBy(*section, "rank").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("owner", "sub", "at", "md"))), lambda x: x["md"]), "\n\n").alias("_md"))
    body = per.groupBy(*section).agg(F.sort_array(F.collect_list(F.struct("rank", F.concat(head, F.lit("\n\n"), "_md").alias("md")))).alias("_p"))
    text = F.array_join(F.transform("_p", lambda x: x["md"]), "\n\n")
    return body.select(*section, F.when(F.exists("_p", lambda x: x["rank"] < len(HEADINGS) - 1), text).alias("markdown"))
