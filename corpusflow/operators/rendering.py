"""Blocks, tables and sections as Markdown."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import text as X
from corpusflow.operators.adapting import grid

#: Buckets in the order in which an entry shows them, with their headings (fixed values).
BODY = (("purpose", "Purpose"), ("options", "Options"), ("cards", "Card Definition"), ("variables", "Variable Descriptions"), ("remarks", "Remarks"), ("references", "References"), ("general", "Source Material"))


def pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, X.escape_cell), " | "), F.lit(" |"))


def pipe_table(rows: Column) -> Column:
    """array<array<string>> as a pipe table; the first row is the head, short rows are filled up."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    full = F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))))
    lines = F.transform(full, pipe_row)
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), width))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.when(F.size(lines) > 1, F.slice(lines, F.lit(2), F.size(lines))).otherwise(F.array().cast("array<string>"))), "\n"))


def render_block(block: Column, page: Column) -> Column:
    """One block (type, text, rows) as Markdown, null where it shows nothing."""
    text = X.strip(X.real_newlines(F.coalesce(block["text"], F.lit(""))))
    bare = X.strip(F.regexp_replace(text, r"^\$\$|\$\$$", ""))
    out = (
        F.when(block["type"].isin("header", "footer"), F.lit(None).cast("string"))
        .when(block["type"] == "table", pipe_table(grid(block["rows"])))
        .when(block["type"] == "math", F.concat(F.lit("$$\n"), bare, F.lit("\n$$")))
        .when(block["type"] == "figure", F.concat(F.lit("[Figure, source page "), page.cast("string"), F.lit("]")))
        .otherwise(text)
    )
    return F.when(out != "", out)


def render_blocks(blocks: DataFrame, keys: list[str], order: list[str], block: str = "block", page: str = "pdf_page") -> DataFrame:
    """(keys, markdown): the blocks of each key in order, parted by blank lines."""
    per = blocks.select(*keys, *order, render_block(F.col(block), F.col(page)).alias("md")).where("md is not null")
    return per.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "md"))), lambda x: x["md"]), "\n\n").alias("markdown"))


def render_body(parts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, markdown) of entries: buckets under their headings in the fixed order, repeats of a text in a bucket hidden,
    null where no bucket but the general one has content. parts: keys, order, bucket, md."""
    rank = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(i)) for i, (b, _) in enumerate(BODY)])
    head = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(f"## {h}")) for b, h in BODY])
    p = parts.withColumns({"_rank": rank, "_head": head}).where("_rank is not null").where(X.strip("md") != "")
    sig = X.collapse(F.col("md"))
    p = p.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys, "bucket", sig).orderBy(*order))).where("_nth = 1")
    per = p.groupBy(*keys, "_rank", "_head").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "md"))), lambda x: x["md"]), "\n\n").alias("_md"))
    last = len(BODY) - 1
    body = per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_rank", F.concat("_head", F.lit("\n\n"), "_md").alias("md")))).alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda x: x["md"]), "\n\n")
    return body.select(*keys, F.when(F.exists("_parts", lambda x: x["_rank"] < last), text).alias("markdown"))


def variable_table(rows: Column) -> Column:
    """Description rows under the fixed head."""
    return pipe_table(F.concat(F.array(F.array(F.lit("Variable"), F.lit("Description"))), rows))


def theory_titles(first: Column, second: Column, number: Column, title: Column) -> Column:
    """How many leading blocks (0, 1, 2) a theory heading uses up."""
    a, b = X.theory_title_key(first), X.theory_title_key(second)
    whole = X.theory_title_key(F.concat_ws(" ", number, title))
    return F.when(a == whole, 1).when(X.theory_title_key(title) == a, 1).when((a == X.theory_title_key(number)) & (b == X.theory_title_key(title)), 2).when(F.concat_ws(" ", a, b) == whole, 2).otherwise(0)


def markdown_path(kind: Column, volume: Column, identifier: Column) -> Column:
    keyword = F.concat_ws("/", F.concat(F.lit("volume_"), volume.cast("string")), X.safe_component(X.family(identifier)), F.concat(X.safe_component(identifier), F.lit(".md")))
    return F.when(kind == "theory", F.concat(F.lit("theory/"), X.safe_component(identifier), F.lit(".md"))).otherwise(keyword)


def _yaml(v, indent: str = "") -> str:
    if isinstance(v, list):
        return "[]" if not v else "".join(f"\n{indent}- {_yaml(x, indent + '  ').lstrip()}" for x in v)
    if isinstance(v, dict):
        return "".join(f"\n{indent}{k}: {_yaml(x, indent + '  ')}" for k, x in v.items())
    return json.dumps(v, ensure_ascii=False)


def front_matter(fields: Column) -> Column:
    """YAML of a JSON object, its keys in the order given; strings are quoted as JSON quotes them, which YAML reads."""
    return X.vectorized(lambda s: f"---{_yaml(json.loads(s))}\n---\n", T.StringType())(fields)
