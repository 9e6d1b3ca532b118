"""Cards in tables: the regions of a table's rows, and the fields that a definition region holds.

Tables come as rows of their grid: a column `cells` of trimmed or raw texts, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X

#: A row that opens a card, and the labels of rows that name variables (fixed values of the notation).
CARD_ROW = r"(?i)^Cards?(?:\s+([0-9]+[A-Za-z]?(?:\.[0-9]+[A-Za-z]?)*))?\s*:?$"
VARIABLE_ROWS = ("variable", "variable type", "variable type default")
INLINE_TYPE = r"(?i)^(.+?)\s+([A-Z](?:\s*/\s*[A-Z])?)$"
FIELD = "array<struct<slot:int,variable:string,field_type:string,default:string,row:int,column:int>>"


def last_slot(cells: Column) -> Column:
    """The place (from 0) of a row's last text after its label; 0 where there is none."""
    places = F.filter(F.sequence(F.lit(0), F.size(cells)), lambda k: (k > 0) & X.cell_text(cells, k).isNotNull())
    return F.coalesce(F.array_max(places), F.lit(0))


def is_slot_head(cells: Column) -> Column:
    """Whether the texts after the label are 1, 2, 3 and so on."""
    n = last_slot(cells)
    numbers = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: k.cast("string"))
    return (n > 0) & (F.transform(F.slice(cells, F.lit(2), F.greatest(n, F.lit(1))), X.strip) == numbers)


def card_regions(rows: DataFrame, table: list[str], row: str = "row", cells: str = "cells", structural: Column | bool = False) -> DataFrame:
    """(table, label, row_start, row_end) of the cards in each table, the end not included.

    A row labelled `Card` or `Card N` opens a region up to the next opening row. structural: rows under another label whose
    cells number the slots open one too, kept if it has just one row of variables. A table headed Card and Description is prose and has none.
    """
    w = Window.partitionBy(*table).orderBy(row)
    head = F.first(F.col(cells)).over(w)
    label = X.strip(F.coalesce(F.get(cells, F.lit(0)), F.lit("")))
    prose = F.coalesce((X.row_label(F.get(head, F.lit(0))) == "card") & (X.row_label(F.get(head, F.lit(1))) == "description"), F.lit(False))
    allowed = structural if isinstance(structural, Column) else F.lit(structural)
    out = rows.withColumns({"_label": label, "_prose": prose, "_named": label.rlike(CARD_ROW), "_slots": allowed & (label != "") & is_slot_head(F.col(cells))})
    opens = ~F.col("_prose") & (F.col("_named") | F.col("_slots"))
    out = out.withColumns({"_opens": opens, "_variables": X.row_label(label).isin(*VARIABLE_ROWS)})
    out = out.withColumn("_region", F.sum(F.col("_opens").cast("int")).over(w)).where("_region > 0")
    number = F.nullif(F.regexp_extract("_label", CARD_ROW, 1), F.lit(""))
    name = F.when(F.col("_named"), F.concat_ws(" ", F.lit("Card"), number)).otherwise(F.col("_label"))
    per = out.groupBy(*table, "_region").agg(
        F.min_by(name, F.col(row)).alias("label"), F.min_by("_named", F.col(row)).alias("_named"), F.min(row).alias("row_start"), (F.max(row) + 1).alias("row_end"),
        F.count(F.when(F.col("_variables") & ~F.col("_opens"), 1)).alias("_n"),
    )
    return per.where("_named or _n = 1").drop("_region", "_named", "_n")


def definition_fields(regions: DataFrame, rows: str = "rows") -> DataFrame:
    """regions (rows: array<array<string>>, the opening row first) with fields and codes.

    One field a slot: its variable, type and default from the rows so labelled, or, where one row holds several of them, from
    the parts of its cells or the unlabelled rows below it. codes: CARD_DEFINITION_SLOT_HEADER_INVALID, CARD_DEFINITION_ROW_AMBIGUOUS
    (the first row counts), CARD_DEFINITION_VARIABLE_ROW_MISSING. row and column say where a field is from, row counted from the opening one.
    """
    col = F.col
    at = lambda i: F.get(col("_rows"), i)
    label = lambda r: X.row_label(F.coalesce(F.get(r, F.lit(0)), F.lit("")))
    heads = F.filter(F.sequence(F.lit(0), F.size(rows)), lambda i: (i > 0) & X.is_variable_head(F.get(rows, i)))
    out = regions.withColumn("_rows", F.slice(rows, F.lit(1), F.coalesce(F.get(heads, F.lit(0)), F.size(rows))))
    out = out.withColumns({"_slots": F.coalesce(F.array_max(F.transform("_rows", last_slot)), F.lit(0)), "_labels": F.transform("_rows", label), "_n": F.size("_rows")})
    places = lambda names: F.filter(F.sequence(F.lit(0), col("_n")), lambda i: (i > 0) & F.coalesce(F.get("_labels", i).isin(*names), F.lit(False)))
    out = out.withColumns({"_vs": places(VARIABLE_ROWS), "_ts": places(("type",)), "_ds": places(("default",))})
    out = out.withColumns({"_v": F.get("_vs", F.lit(0)), "_t": F.get("_ts", F.lit(0)), "_d": F.get("_ds", F.lit(0))})
    out = out.withColumn("_parts", F.array_sort(F.array_distinct(F.split(F.coalesce(F.get("_labels", col("_v")), F.lit("")), " "))))
    typed = col("_t").isNull() & F.array_contains("_parts", "type") & (col("_v") + 1 < col("_n")) & (F.size(at(col("_v") + 1)) <= col("_slots"))
    typed = typed & F.forall(at(col("_v") + 1), lambda c: (X.strip(c) == "") | X.is_field_type(X.strip(c)))
    out = out.withColumn("_tc", F.when(typed, col("_v") + 1))
    below = F.coalesce(col("_tc"), col("_v")) + 1
    given = col("_d").isNull() & F.array_contains("_parts", "default") & (below < col("_n")) & (F.size(at(below)) <= col("_slots"))
    out = out.withColumn("_dc", F.when(given, below))

    def split(slot: Column) -> Column:
        """struct(variable, field_type, default) that the variable row's cell holds together, null parts where it does not."""
        raw = X.cell_text(at(col("_v")), slot)
        lines = X.cell_lines(raw)
        none = F.lit(None).cast("string")
        three = F.when(col("_parts") == F.array(F.lit("default"), F.lit("type"), F.lit("variable")), X.field_triplet(raw))
        two = (F.size(lines) == 2) & X.is_field_type(F.get(lines, F.lit(1)))
        inline = F.array_contains("_parts", "type") & raw.rlike(INLINE_TYPE)
        pair = lambda a, b: F.struct(a.alias("variable"), b.alias("field_type"), none.alias("default"))
        return F.coalesce(three, F.when(two, pair(F.get(lines, F.lit(0)), F.get(lines, F.lit(1)))).when(inline, pair(X.strip(F.regexp_extract(raw, INLINE_TYPE, 1)), F.regexp_extract(raw, INLINE_TYPE, 2))), pair(none, none))

    slots = F.when(col("_slots") > 0, F.sequence(F.lit(1), col("_slots"))).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("_split", F.transform(slots, lambda k: F.struct(k.alias("slot"), split(k).alias("p"))))

    def one(x: Column) -> Column:
        k, p = x["slot"], x["p"]
        text = lambda r, c: F.when(col(r).isNotNull(), X.cell_text(at(col(r)), c))
        sources = [("_v", k), ("_t", k), ("_tc", k - 1), ("_d", k), ("_dc", k - 1)]
        there = [F.when(col(r).isNotNull() & (c < F.size(at(col(r)))), F.struct(col(r).alias("row"), c.alias("column"))) for r, c in sources]
        place = F.coalesce(*there, F.struct(F.lit(0).alias("row"), k.alias("column")))
        return F.struct(
            k.alias("slot"), F.coalesce(p["variable"], text("_v", k)).alias("variable"), F.coalesce(text("_t", k), p["field_type"], text("_tc", k - 1)).alias("field_type"),
            F.coalesce(text("_d", k), p["default"], text("_dc", k - 1)).alias("default"), place["row"].alias("row"), place["column"].alias("column"),
        )

    codes = F.array(
        F.when((col("_slots") == 0) | ~is_slot_head(F.concat(F.slice(at(F.lit(0)), F.lit(1), col("_slots") + 1), F.array().cast("array<string>"))) | (last_slot(at(F.lit(0))) < col("_slots")), F.lit("CARD_DEFINITION_SLOT_HEADER_INVALID")),
        F.when((col("_slots") > 0) & ((F.size("_vs") > 1) | (F.size("_ts") > 1) | (F.size("_ds") > 1)), F.lit("CARD_DEFINITION_ROW_AMBIGUOUS")),
        F.when((col("_slots") > 0) & col("_v").isNull(), F.lit("CARD_DEFINITION_VARIABLE_ROW_MISSING")),
    )
    out = out.withColumns({"fields": F.transform("_split", one).cast(FIELD), "codes": F.filter(codes, lambda c: c.isNotNull())})
    return out.drop("_rows", "_slots", "_labels", "_n", "_vs", "_ts", "_ds", "_v", "_t", "_d", "_parts", "_tc", "_dc", "_split")
