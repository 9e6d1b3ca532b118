"""Meaning of a section's blocks: buckets, cards and their fields, variables; their families are in catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X

#: Region labels in the order in which a block's text is held against them (fixed values).
REGIONS = (("references", "reference"), ("remarks", "remark"), ("purpose", "purpose"), ("options", "option"), ("cards", "card"), ("variables", "variable"))
ABSORBING = ("references", "remarks")


def region_label(text: Column) -> Column:
    """The region that a block's text opens by its label, else null."""
    out = F.lit(None).cast("string")
    for region, label in reversed(REGIONS):
        exact = region in ABSORBING
        out = F.when(X.is_label(text, label, exact=exact), region).otherwise(out)
    return out


def buckets(blocks: DataFrame, section: list[str], order: list[str], text: str = "text", kind: str = "type", title: str | None = None) -> DataFrame:
    """Every block with exactly one bucket.

    Headers and footers are ignored, the first title block is the title, a block that is nothing but a label is the
    region's label, and all else belongs to the region of the last label; after Remarks or References only these switch.
    """
    w = Window.partitionBy(*section).orderBy(*order)
    label = F.when(~F.col(kind).isin("header", "footer", "table"), region_label(F.col(text)))
    out = blocks.withColumn("_label", label)
    held = F.last(F.when(F.col("_label").isin(*ABSORBING), F.col("_label")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = out.withColumn("region", F.coalesce(held, F.last("_label", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit("general")))
    is_title = F.lit(False)
    if title:
        hit = F.coalesce(F.col(title), F.lit(False)) & ~F.col(kind).isin("header", "footer")
        is_title = hit & (F.sum(hit.cast("int")).over(w) == 1)
    opens = F.col("_label").isNotNull() & (F.col("_label") == F.col("region"))
    bucket = F.when(F.col(kind).isin("header", "footer"), "ignored").when(is_title, "title").when(opens & F.col(text).rlike(r"(?i)^\W*\w+\W*$"), F.concat("region", F.lit("_label"))).otherwise(F.col("region"))
    return out.withColumn("bucket", bucket).drop("_label")


def slot_fields(cells: DataFrame, card: list[str], slot: str = "slot", label: str = "label", value: str = "value") -> DataFrame:
    """One record per slot: the cells of the Variable, Type and Default rows side by side; slots empty in all rows
    at a card's end go. cells: card columns, slot, label (of the row) and value (trimmed or null)."""
    pick = lambda name: F.first(F.when(X.row_label(F.col(label)) == name, F.col(value)), ignorenulls=True)
    per = cells.groupBy(*card, slot).agg(pick("variable").alias("variable"), pick("type").alias("field_type"), pick("default").alias("default"))
    filled = F.coalesce("variable", "field_type", "default").isNotNull()
    last = F.max(F.when(filled, F.col(slot))).over(Window.partitionBy(*card))
    return per.withColumn("_last", last).where(F.col(slot) <= F.col("_last")).drop("_last")


def merge_fields(definition: DataFrame, more: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Slots of both tables; what the definition lacks comes from the other, and nothing is overwritten."""
    other = more.select(*keys, *[F.col(c).alias(f"_{c}") for c in fields])
    both = definition.join(other, keys, "full")
    return both.select(*keys, *[F.coalesce(c, f"_{c}").alias(c) for c in fields], *[(F.col(c).isNull() & F.col(f"_{c}").isNotNull()).alias(f"{c}_added") for c in fields])


def summary_is_redundant(definition: Column, summary: Column, supplied: Column) -> Column:
    """Whether a one-row summary repeats the definition's variables slot by slot and supplied none."""
    return (definition == summary) & ~F.coalesce(supplied, F.lit(False))


def variable_catalog(variables: DataFrame, section: list[str], order: list[str], name: str = "variable") -> DataFrame:
    """Variables in the order of their first occurrence, whatever the case."""
    w = Window.partitionBy(*section, F.lower(name)).orderBy(*order)
    return variables.where(X.strip(name) != "").withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def match_variables(titles: DataFrame, catalog: DataFrame, title: str, name: str, scope: list[str] | None = None) -> DataFrame:
    """titles with matched and how: the equal name, else the only name that differs in one letter O against a digit 0."""
    keys = scope or []
    c = catalog.select(*keys, F.col(name).alias("matched")).distinct()
    t = titles.withColumn("_key", F.col(title))
    fold = lambda col: F.translate(col, "O", "0")
    near = t.select(*keys, "_key").distinct().withColumn("_fold", fold(F.col("_key"))).join(c.withColumn("_fold", fold(F.col("matched"))), [*keys, "_fold"])
    near = near.where(F.levenshtein("_key", "matched") <= 1).withColumn("_exact", F.col("_key") == F.col("matched"))
    per = near.groupBy(*keys, "_key").agg(F.max("_exact").alias("_has"), F.count("*").alias("_n"), F.min(F.when(~F.col("_exact"), F.col("matched"))).alias("_other"))
    joined = t.join(per, [*keys, "_key"], "left")
    matched = F.when(F.col("_has"), F.col("_key")).when(F.col("_n") == 1, F.col("_other"))
    how = F.when(F.col("_has"), "exact").when(F.col("_n") == 1, "confusable")
    return joined.withColumns({"matched": matched, "how": how}).drop("_key", "_has", "_n", "_other")


def numbered_family(labels: DataFrame, catalog: DataFrame, prefix: str, name: str) -> DataFrame:
    """(label, members): the catalog's names that are the prefix and a number, in the order of the numbers."""
    number = r"^(.*?)(\d+)$"
    c = catalog.select(F.col(name).alias("member"), F.regexp_extract(name, number, 1).alias(prefix), F.regexp_extract(name, number, 2).try_cast("int").alias("_no")).where("_no is not null").distinct()
    met = labels.join(c, prefix)
    return met.groupBy(prefix).agg(F.transform(F.sort_array(F.collect_set(F.struct("_no", "member"))), lambda x: x["member"]).alias("members"))


def variable_ranges(rows: DataFrame, table: list[str], order: list[str], variable: str = "variable", label: str = "label") -> DataFrame:
    """Rows of description tables by the variable they describe: (table, variable, row_start, row_end) of each run.

    A row with a variable opens its range, and blank or continuation labels extend it; a row with another label closes it.
    """
    w = Window.partitionBy(*table).orderBy(*order)
    blank = X.is_continuation_label(F.coalesce(F.col(label), F.lit("")))
    mark = F.when(F.col(variable).isNotNull() | ~blank, F.struct(F.col(variable).alias("v")))
    out = rows.withColumn("_mark", mark)
    out = out.withColumns({"_held": F.last("_mark", ignorenulls=True).over(w)["v"], "_run": F.sum(F.col("_mark").isNotNull().cast("int")).over(w)})
    return out.where("_held is not null").groupBy(*table, "_run", F.col("_held").alias("described")).agg(F.min(order[-1]).alias("row_start"), F.max(order[-1]).alias("row_end")).drop("_run")
