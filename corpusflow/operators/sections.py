"""What each block of a section is, read in order: windows over the blocks of a section.

Blocks are first told by themselves: labels, headings, titles, card tables, and the variables that texts and rows name, found
by the catalogue's index. Some open a region whatever came before (`hard`); between two of these, the first text that names a
variable, in a region of cards, or the first table of descriptions opens the variables. What is held from block to block (the
region, the card that waits for its table, the variable described) is the last one over a window, so a section streams
through sorted windows and is never gathered.

Descriptions are read row by row: a row or text that names variables opens a range, one that names an unknown one closes it, and
rows in between go with it, also over tables and pages; a range that a table begins without a title is linked to the last one of
its variable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import cards, catalog
from corpusflow.sources.writers import settled

#: Headings that open a region, in the order in which they are tried: pattern, region, bucket (fixed values of the notation).
HEADINGS = (
    (r"(?is)^purpose\b.*$", "purpose", "purpose"),
    (r"(?i)^(?:for\s+\S+\s+)?(?:the\s+)?available\s+options?\s+(?:are|is|include|includes)\s*:?\s*$", "options", "option_intro"),
    (r"(?i)^card\s+summary\s*:?\s*$", "cards", "card_intro"),
    (r"(?i)^data\s+card\s+definitions\s*:?\s*$", "cards", "card_intro"),
)
#: Labels of the last regions, and of cards (fixed values of the notation).
LAST = (("references", r"(?i)^references\s*:?$"), ("remarks", r"(?i)^remarks\s*:?$"))
CARD = r"(?i)^card\s+(\d+[a-z]?(?:\.\d+[a-z]?)*)\b"
NAMED_CARD = r"(?is)^.+\s+card\.\s+.*$"
#: A text of this form that names no variable is reported (fixed value).
TITLE_TEXT = r"^[A-Za-z][A-Za-z0-9_]{1,31}$"
#: Buckets by the part of an entry that shows them (fixed values).
PARTS = {
    "purpose": "purpose", "option_intro": "options", "option": "options", "card_intro": "cards", "card_condition": "cards", "card_definition": "cards", "card_summary": "cards",
    "variable_intro": "variables", "variable": "variables", "variable_table": "variables", "remarks": "remarks", "references": "references", "description": "general", "unclassified": "general",
}
IN_CARDS = ("cards", "card", "defined")
TARGETS = "array<string>"


def card_fields(rows: DataFrame, table: list[str], row: str = "row", structural: Column | bool = True) -> DataFrame:
    """(table, label, row_start, row_end, fields, codes) of each card that a table defines; rows: table, row, cells."""
    regions = cards.card_regions(rows, table, row, structural=structural)
    inside = rows.select(*table, row, "cells").join(regions, table).where((F.col(row) >= F.col("row_start")) & (F.col(row) < F.col("row_end")))
    held = inside.groupBy(*table, "label", "row_start", "row_end").agg(F.transform(F.sort_array(F.collect_list(F.struct(row, "cells"))), lambda x: x["cells"]).alias("rows"))
    return cards.definition_fields(held).drop("rows")


def _strong_title(text: Column, name: Column) -> Column:
    return F.regexp_replace(text, r"^[#` ]+", "").startswith("*") & (X.keyword_key(X.keyword_surface(text)) == X.keyword_key(name))


def _named(rows: DataFrame, index: DataFrame, section: list[str], ids: list[str], forms: Column, label: str, grouped: Column) -> DataFrame:
    """(ids, _label, _targets, _how) of texts and row labels that name variables: a group (where `grouped`), else a name, else a family.

    An alias stands for the field that it is from; a group and a family go under their own spelling."""
    text = rows.where(F.col(label) != "")
    one = catalog.resolve(text, index, section, ids, forms)
    found = one.select(*ids, F.lit(2).alias("_rank"), F.col("matched").alias("_label"), F.array("target").alias("_targets"), F.col("how").alias("_how"))
    many = catalog.leading_groups(text.where(grouped), index, section, ids, label)
    found = found.union(many.select(*ids, F.lit(1), "label", "targets", F.lit("group")))
    kinds = text.select(*ids, F.col(label).alias("_text"))
    kin = catalog.families(kinds, index, section, "_text")
    family = kinds.join(kin, [*section, "_text"]).select(*ids, F.lit(3), X.strip("_text"), "members", F.lit("family"))
    return found.union(family).groupBy(*ids).agg(F.min_by(F.struct("_label", "_targets", "_how"), "_rank").alias("_n")).select(*ids, "_n.*")


def read(blocks: DataFrame, section: list[str], order: list[str], name: str = "name") -> dict[str, DataFrame]:
    """All that is read in sections. blocks: section, order, name, type, text, grid (array<array<string>>), ambiguous.

    Gives `blocks` (section, order, bucket, detail, part, issue), `ranges` (section, variable, targets, order, row_start, row_end,
    continues: whether it goes on with the range before), `fields` (section, order, label, row_start, row_end, fields, codes),
    `issues` (section, order, code). Headers and footers are ignored."""
    ids = [*section, *order]
    text = X.strip(F.coalesce("text", F.lit("")))
    base = blocks.select(*ids, F.col(name).alias("_name"), "type", F.when(F.col("type") == "math", "").otherwise(text).alias("text"), text.alias("_math"), "grid", F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"))
    tables = base.where("type = 'table' and size(grid) > 0")
    rows = tables.select(*ids, "ambiguous", F.posexplode("grid").alias("row", "cells"))
    fields = settled(card_fields(rows, ids, structural=~F.col("ambiguous")))
    defined = fields.groupBy(*ids).agg(F.transform(F.sort_array(F.collect_list(F.struct("row_start", "label"))), lambda x: x["label"]).alias("_cards"))

    # the catalogue: fields of cards, and the rows of variables of tables that only go on with a card
    of_card = fields.select(*ids, "row_start", F.explode("fields").alias("f")).where("f.variable is not null")
    of_card = of_card.select(*ids, (F.col("row_start") + F.col("f.row")).alias("row"), F.col("f.column").alias("column"), F.col("f.variable").alias("variable"))
    more = tables.where(X.is_definition_continuation(F.col("grid"))).join(defined.select(*ids), ids, "left_anti").select(*ids, F.posexplode("grid").alias("row", "cells"))
    more = more.where(X.row_label(F.get("cells", F.lit(0))).isin(*cards.VARIABLE_ROWS)).select(*ids, "row", F.posexplode("cells").alias("column", "variable")).where("column > 0")
    named = of_card.unionByName(more.where(X.strip("variable") != "")).join(base.select(*ids, "ambiguous"), ids)
    index = settled(catalog.build_index(named.withColumn("_origin_key", F.struct(*order, "row", "column")), section, [*order, "row", "column"], origin="_origin_key", ambiguous="ambiguous"))

    # what texts (row -1) and the labels of rows name
    texts = base.where("type not in ('header', 'footer', 'table')").select(*ids, F.lit(-1).alias("row"), F.when(F.col("type") == "math", F.concat(F.lit("$"), F.regexp_replace("_math", r"^\$+|\$+$", ""), F.lit("$"))).otherwise(F.col("text")).alias("_said"))
    labels = rows.select(*ids, "row", X.strip(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))).alias("_said"))
    is_text = F.col("row") < 0
    forms = F.concat(catalog.heading_forms(F.col("_said")), F.when(is_text, catalog.leading_forms(F.col("_said"))).otherwise(F.array().cast("array<string>")))
    known = settled(_named(texts.union(labels), index, section, [*ids, "row"], forms, "_said", is_text))
    said, titled = known.where("row < 0").drop("row"), known.where("row >= 0")

    # each block by itself
    line = base.join(defined, ids, "left").join(said, ids, "left")
    t, is_table = F.col("text"), F.col("type") == "table"
    last = F.coalesce(*[F.when(t.rlike(p), F.lit(r)) for r, p in LAST])
    up = Window.partitionBy(*section).orderBy(*order)
    so_far = up.rowsBetween(Window.unboundedPreceding, 0)
    line = line.where("type not in ('header', 'footer')").withColumn("_last", F.last(last, True).over(so_far))
    opening = F.coalesce(*[F.when(t.rlike(p), F.struct(F.lit(r).alias("kind"), F.lit(b).alias("bucket"), F.lit(None).cast("string").alias("card"))) for p, r, b in HEADINGS])
    struct = lambda kind, bucket, card: F.struct(F.lit(kind).alias("kind"), F.lit(bucket).alias("bucket"), card.cast("string").alias("card"))
    hard = F.coalesce(
        opening, F.when(t.rlike(CARD), struct("card", "card_condition", F.concat(F.lit("Card "), F.regexp_extract(t, CARD, 1)))), F.when(t.rlike(NAMED_CARD), struct("cards", "card_intro", F.lit(None))),
        F.when(F.col("_cards").isNotNull(), struct("defined", "card_definition", F.element_at("_cards", -1))),
        F.when(~is_table & F.regexp_replace(X.row_label(t), r"[: ]+$", "").isin("variable", "description"), struct("label", "variable_intro", F.lit(None))),
    )
    live = line.where("_last is null")
    hit = F.coalesce((F.col("type") == "text") & _strong_title(t, F.col("_name")), F.lit(False))
    live = live.withColumn("_title", hit & (F.sum(hit.cast("int")).over(so_far) == 1))
    live = live.withColumn("_hard", F.when(~F.col("_title"), hard))
    live = live.withColumns({"_seg": F.sum(F.col("_hard").isNotNull().cast("int")).over(so_far), "_at": F.row_number().over(up), "_titled": F.max("_title").over(so_far)})
    seg = Window.partitionBy(*section, "_seg")
    kind = F.first(F.when(F.col("_hard").isNotNull(), F.col("_hard")), True).over(seg)
    live = live.withColumns({"_kind": F.coalesce(kind["kind"], F.lit("general")), "_card": kind["card"]})
    loose, in_cards = F.col("_hard").isNull() & ~F.col("_title"), F.col("_kind").isin(*IN_CARDS)
    names_one = loose & in_cards & ~is_table & (t != "") & F.col("_label").isNotNull() & (F.col("_how") != "family")
    live = live.withColumns({"_match": F.min(F.when(names_one, F.col("_at"))).over(seg), "_table": F.min(F.when(loose & is_table, F.col("_at"))).over(seg)})
    waits = F.col("_kind") == "card"
    live = live.withColumn("_summary", F.when(waits & (F.col("_table") < F.coalesce("_match", F.lit(1 << 30))), F.col("_table")))
    head = F.coalesce(X.is_variable_head(F.get("grid", F.lit(0))), F.lit(False))
    open_table = F.min(F.when(loose & is_table & head & ~F.coalesce(F.col("_at") == F.col("_summary"), F.lit(False)), F.col("_at"))).over(seg)
    live = live.withColumn("_open", F.least("_match", open_table))
    inside = (F.col("_kind") == "label") | F.coalesce(F.col("_at") >= F.col("_open"), F.lit(False))
    live = live.withColumn("_inside", inside)
    waiting = waits & (F.col("_at") < F.least(F.coalesce("_table", F.lit(1 << 30)), F.coalesce("_open", F.lit(1 << 30))))
    repeat = (t != "") & (X.title_key(t) == X.title_key(F.regexp_replace(F.split_part("_name", F.lit("_"), F.lit(1)), r"^\*", "")))
    bucket = (
        F.when(F.col("_title"), "title").when(F.col("_hard").isNotNull(), F.col("_hard.bucket")).when(F.col("_at") == F.col("_summary"), "card_summary")
        .when(F.col("_inside") & is_table, "variable_table").when(F.col("_inside") & repeat, "variable_intro").when(F.col("_inside"), "variable")
        .when((F.col("_kind") == "defined") & is_table & X.is_definition_continuation(F.col("grid")), "card_definition")
        .when(F.col("_kind") == "purpose", "purpose").when((F.col("_kind") == "options") & ~is_table & X.option_token(t).isNotNull(), "option").when(F.col("_kind") == "options", "option_intro")
        .when(waiting, "card_condition").when(in_cards, "card_intro").when(F.col("_titled"), "description").otherwise("unclassified")
    )
    live = live.withColumn("bucket", bucket)

    # descriptions: steps are texts (row -1) and rows of tables; marks set or clear the variable that later steps go with
    mark = lambda label, targets: F.struct(label.cast("string").alias("label"), targets.cast(TARGETS).alias("targets"))
    clear = mark(F.lit(None), F.lit(None))
    before = F.lag("_inside", 1, False).over(up)
    clears = F.col("_hard").isNotNull() & ((F.col("_kind") != "label") | ~before)
    live = settled(live.withColumn("_mark", F.when(clears, clear).when((F.col("bucket") == "variable") & F.col("_label").isNotNull(), mark(F.col("_label"), F.col("_targets")))))
    has_names = index.select(*section).distinct().withColumn("_known", F.lit(True))
    in_table = live.where("bucket = 'variable_table'").select(*ids, "grid", head.alias("_head"), (~head & X.is_description_head(F.get("grid", F.lit(0)))).alias("_described"))
    cell = X.strip(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    steps = in_table.select(*ids, "_head", "_described", F.posexplode("grid").alias("row", "cells")).withColumn("_cell", cell).join(titled, [*ids, "row"], "left").join(has_names, section, "left")
    whole = F.max(F.col("_described") & (F.col("row") == 0) & F.col("_label").isNotNull()).over(Window.partitionBy(*ids))
    steps = steps.withColumn("_whole", whole).where("row > 0 or not _head")
    names, title = F.col("_label").isNotNull(), X.is_variable_title(F.col("_cell"))
    guessed = ~names & F.col("_head") & F.col("_known").isNull() & title
    carries = X.is_continuation_label(F.col("_cell"))
    row_mark = F.when(F.col("_whole") & (F.col("row") > 0), F.lit(None)).when(names, mark(F.col("_label"), F.col("_targets"))).when(guessed, mark(F.col("_cell"), F.array("_cell"))).when(~carries & title, clear)
    steps = steps.withColumns({"_mark": row_mark, "_guessed": guessed & ~F.coalesce(F.col("_whole"), F.lit(False)), "_carries": carries, "_odd": ~names & ~guessed & ~carries & ~F.col("_whole")})
    steps = settled(steps)
    first_row = F.min("row").over(Window.partitionBy(*ids)) == F.col("row")
    # a table that begins with rows of an untitled variable, where none is held: the variable named last, else the only one its first row speaks of
    words = steps.where("_carries").select(*ids, "row", F.explode(F.regexp_extract_all(F.array_join(F.slice("cells", 2, 1 << 30), " "), F.lit("[A-Za-z][A-Za-z0-9_]*"), 0)).alias("_word")).withColumn("key", X.variable_key(F.col("_word")))
    spoken = words.join(catalog.lookup(words, index, section).where("how != 'confusable'"), [*section, "key"]).groupBy(*ids, "row").agg(F.collect_set(F.struct("matched", "target")).alias("_m")).where("size(_m) = 1")
    spoken = spoken.select(*ids, "row", F.get("_m", F.lit(0)).alias("_spoken"))
    flow = live.where("_mark is not null or bucket in ('variable', 'variable_intro')").select(*ids, F.lit(-1).alias("row"), "_mark", F.lit(False).alias("_first"), F.lit(False).alias("_carries"))
    flow = flow.union(steps.select(*ids, "row", "_mark", first_row.alias("_first"), "_carries")).join(spoken, [*ids, "row"], "left")
    walk = Window.partitionBy(*section).orderBy(*order, "row")
    past, now = walk.rowsBetween(Window.unboundedPreceding, -1), walk.rowsBetween(Window.unboundedPreceding, 0)
    flow = flow.withColumns({"_held": F.last("_mark", True).over(past), "_named": F.last(F.when(F.col("_mark.label").isNotNull(), F.col("_mark")), True).over(past)})
    implied = F.when(F.col("_first") & F.col("_carries") & F.col("_mark").isNull() & F.col("_held.label").isNull(), F.coalesce(F.col("_named"), F.when(F.col("_spoken").isNotNull(), mark(F.col("_spoken.matched"), F.array(F.col("_spoken.target"))))))
    flow = flow.withColumn("_implied", implied).withColumn("_set", F.coalesce("_mark", "_implied"))
    flow = flow.withColumns({"_active": F.last("_set", True).over(now), "_run": F.sum(F.col("_mark").isNotNull().cast("int")).over(now)})
    flow = settled(flow.select(*ids, "row", "_mark", "_active", "_run", "_held"))

    in_rows = flow.where("row >= 0 and _active.label is not null")
    ranges = in_rows.groupBy(*ids, "_run").agg(F.min("row").alias("row_start"), (F.max("row") + 1).alias("row_end"), F.max(F.col("_mark").isNotNull()).alias("_titled"), F.first("_active").alias("_a"))
    same = Window.partitionBy(*section, F.lower("_a.label")).orderBy(*order, "row_start")
    ranges = ranges.withColumn("continues", ~F.col("_titled") & (F.row_number().over(same) > 1))
    ranges = ranges.select(*section, F.col("_a.label").alias("variable"), F.col("_a.targets").alias("targets"), *order, "row_start", "row_end", "continues")

    # issues of descriptions
    judged = steps.join(flow.select(*ids, "row", "_active", "_held"), [*ids, "row"])
    lost = F.col("_active.label").isNull()
    codes = F.array(
        F.when(F.col("_odd") & (title | lost), "VARIABLE_DESCRIPTION_UNMATCHED_TITLE"), F.when(F.col("_guessed"), "VARIABLE_DESCRIPTION_CATALOG_UNAVAILABLE"),
        F.when(F.col("_carries") & ~names & lost, "VARIABLE_DESCRIPTION_CONTINUATION_ORPHAN"), F.when(F.col("_how") == "confusable", "VARIABLE_IDENTIFIER_CONFUSABLE_MATCH"),
    )
    in_rows = judged.select(*ids, F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code"), "row")
    once = in_rows.where("code != 'VARIABLE_DESCRIPTION_UNMATCHED_TITLE'").select(*ids, "code").distinct().union(in_rows.where("code = 'VARIABLE_DESCRIPTION_UNMATCHED_TITLE'").select(*ids, "code"))
    at_text = flow.where("row = -1").select(*ids, F.col("_active.label").alias("_variable"))
    per_table = flow.where("row >= 0").groupBy(*ids).agg(F.min_by("_held.label", "row").alias("_held_label"), F.min_by("_active.label", F.when(F.col("_active.label").isNotNull(), F.col("row"))).alias("_first_label"))
    live = live.join(at_text, ids, "left").join(per_table, ids, "left")
    none_held = (F.col("bucket") == "variable") & F.col("_variable").isNull()
    live = live.withColumn("_lost", none_held).withColumn("bucket", F.when(F.col("_lost"), "variable_intro").otherwise(F.col("bucket")))
    said_codes = F.array(F.when(F.col("_lost") & t.rlike(TITLE_TEXT), "VARIABLE_DESCRIPTION_UNMATCHED_TITLE"), F.when((F.col("bucket") == "variable") & F.col("_mark").isNotNull() & (F.col("_how") == "confusable"), "VARIABLE_IDENTIFIER_CONFUSABLE_MATCH"))
    field_codes = fields.join(live.where("bucket = 'card_definition'").select(*ids), ids, "left_semi").select(*ids, F.explode("codes").alias("code"))
    issues = once.union(live.select(*ids, F.explode(F.filter(said_codes, lambda c: c.isNotNull())).alias("code"))).union(field_codes)
    detail = (
        F.when(F.col("_cards").isNotNull() & (F.col("bucket") == "card_definition"), F.array_join("_cards", ",")).when(F.col("bucket").isin("card_definition", "card_condition", "card_summary"), F.col("_card"))
        .when(F.col("bucket") == "option", X.option_token(t)).when(F.col("bucket") == "variable", F.col("_variable")).when(F.col("bucket") == "variable_table", F.coalesce("_held_label", "_first_label"))
    )
    first_issue = issues.where("code != 'VARIABLE_IDENTIFIER_CONFUSABLE_MATCH'").groupBy(*ids).agg(F.max("code").alias("issue"))
    out = live.select(*ids, "bucket", detail.alias("detail")).union(line.where("_last is not null").select(*ids, "_last", F.lit(None)))
    out = out.union(base.where("type in ('header', 'footer')").select(*ids, F.lit("ignored"), F.lit(None))).join(first_issue, ids, "left")
    part = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(p)) for b, p in PARTS.items()])
    return {"blocks": out.withColumn("part", part), "ranges": ranges, "fields": fields, "issues": issues}


def read_sections(blocks: DataFrame, section: list[str], order: list[str], name: str = "name") -> DataFrame:
    """blocks (section, order, name, type, text, grid: array<array<string>>, ambiguous) with bucket, detail, part and issue."""
    found = read(blocks, section, order, name)["blocks"]
    return blocks.drop("bucket", "detail", "issue", "part").join(found, [*section, *order])


def description_chains(ranges: DataFrame, section: list[str], order: list[str]) -> DataFrame:
    """ranges with chain: the parts of one variable's description, each after the first marked as continuing, have one number."""
    w = Window.partitionBy(*section, F.lower("variable")).orderBy(*order, "row_start")
    return ranges.withColumn("chain", F.sum((~F.col("continues")).cast("int")).over(w))
