"""Scalar functions over text columns. All are native expressions but for the two Unicode ones."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Line ends of the source texts (fixed values).
LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029]"
TOKEN = r"[a-z0-9]+(?:[._-][a-z0-9]+)*"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"


def vectorized(function, kind):
    """A pandas UDF of a function of one value; nulls stay null."""

    def run(s: pd.Series) -> pd.Series:
        known = s.notna()
        return s.where(~known, s[known].map(function)) if known.any() else s

    return F.pandas_udf(run, kind)


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def nfkd(text: Column) -> Column:
    """Only values beyond ASCII go to Python; the others are their own form."""
    return F.coalesce(vectorized(lambda x: unicodedata.normalize("NFKD", x), T.StringType())(F.when(~is_ascii(text), text)), text)


def casefold(text: Column) -> Column:
    return F.coalesce(vectorized(str.casefold, T.StringType())(F.when(~is_ascii(text), text)), F.lower(text))


def logical_lines(text: Column) -> Column:
    """Lines that hold more than white space, without the white space at their ends, in order."""
    lines = F.transform(F.split(text, LINE_END), lambda x: F.regexp_replace(x, r"\s+$", ""))
    return F.filter(lines, lambda x: x != "")


def strip(text: Column | str) -> Column:
    """Without white space of any kind at both ends; trim() only takes blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def title_key(text: Column) -> Column:
    """A title for comparison: compatibility form, one blank for any white space."""
    return collapse(nfkd(text))


def theory_title_key(text: Column) -> Column:
    """As title_key, without markup: dashes and quotes are plain, $, braces and font macros go, case is folded."""
    plain = F.translate(nfkd(text), DASHES + "\u2018\u2019\u201c\u201d", "-" * len(DASHES) + "''\"\"")
    plain = F.regexp_replace(plain, r"\\(?:mathrm|mathbf|mathit|text|textbf|textit)\b", "")
    plain = F.regexp_replace(plain, r"\\pm\b", "+-")
    plain = F.regexp_replace(plain, r"[_^]\{([^}]*)\}", "$1")
    plain = F.translate(plain, "${}\\", "")
    return casefold(collapse(F.translate(plain, "_", " ")))


def keyword_surface(text: Column) -> Column:
    """A keyword heading without markup, or null when there is more than one line."""
    lines = logical_lines(text)
    x = nfkd(F.get(lines, F.lit(0)))
    x = F.regexp_replace(x, r"^\s*#+\s*", "")
    x = F.translate(F.regexp_replace(x, "`|\\*\\*(?=\\S)", ""), DASHES, "-" * len(DASHES))
    x = F.regexp_replace(x, r"\\(?:ast|star)\b\s*|\$\s*\*\s*\$", "*")
    x = F.regexp_replace(x, r"\\(?:mathrm|mathbf|mathit|text|textbf|textit)\s*\{([^{}]*)\}", "$1")
    x = F.regexp_replace(x, r"^\$(.*)\$$", "$1")
    x = F.regexp_replace(x, r"\\([_*{}&%#-])", "$1")
    return F.when(F.size(lines) == 1, collapse(x))


def keyword_key(surface: Column) -> Column:
    x = F.regexp_replace(surface, r"\*", "")
    return F.upper(F.regexp_replace(strip(x), r"[\s_\-]+", "_"))


def title_rank(key: Column, expected: Column) -> Column:
    """2 for the expected key, 1 when only OPTION placeholders follow it, else null."""
    rest = F.substring(key, F.length(expected) + 1, F.length(key))
    placeholders = rest.rlike(r"^(?:_?[{<\[(]?OPTION\d*[}>\])]?)+$")
    return F.when(key == expected, 2).when(F.startswith(key, expected) & placeholders, 1)


def ascii_fold(text: Column) -> Column:
    return F.regexp_replace(nfkd(text), r"[^\x00-\x7F]", "")


def slug(text: Column, default: str = "UNTITLED") -> Column:
    """Upper-case identifier: runs of anything but ASCII letters and digits are one underscore."""
    x = F.upper(F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", ""))
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit(default)).otherwise(x)


def section_id(text: Column) -> Column:
    return slug(ascii_fold(text))


def safe_component(text: Column) -> Column:
    """A path component: letters, digits, dot, hyphen and underscore."""
    x = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(x == "", F.lit("UNTITLED")).otherwise(x)


def family(identifier: Column) -> Column:
    return F.split_part(identifier, F.lit("_"), F.lit(1))


def chapter_and_page(printed: Column) -> tuple[Column, Column]:
    """The two numbers of a printed page `c-p`."""
    return F.regexp_extract(printed, r"^(\d+)-(\d+)$", 1).try_cast("int"), F.regexp_extract(printed, r"^(\d+)-(\d+)$", 2).try_cast("int")


#: A backslash and n that begin no macro (fixed values).
LITERAL_NEWLINE = r"\\n(?!(?:abla|atural|e|eq|eg|ewcommand|ewline|i|obreak|olimits|ot|u|umber)\b)"


def real_newlines(text: Column) -> Column:
    return F.regexp_replace(text, LITERAL_NEWLINE, "\n")


def literal_newlines(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LITERAL_NEWLINE))


def row_label(text: Column) -> Column:
    """A row's label for comparison: real newlines, one blank for white space, lower case."""
    return F.lower(collapse(real_newlines(text)))


def cell_text(row: Column, column: Column) -> Column:
    """The trimmed text at a place (from 0) of an array of texts; null where there is none or it is blank."""
    return F.nullif(strip(F.get(row, column)), F.lit(""))


def compressed_value(row: Column, slot: Column) -> Column:
    """The value of a slot (from 1) in a row that has no label cell."""
    return cell_text(row, slot - 1)


def cell_lines(text: Column) -> Column:
    """The non-blank lines of a cell, trimmed."""
    lines = F.transform(F.split(real_newlines(text), LINE_END), strip)
    return F.filter(lines, lambda x: x != "")


def first_row_text(rows: Column) -> Column:
    """The trimmed texts of a table's first row (array<array<string>>); none of an empty table."""
    return F.transform(F.coalesce(F.get(rows, F.lit(0)), F.array().cast("array<string>")), strip)


def cell_source(document: Column, page: Column, label: Column, block: Column, row: Column, column: Column) -> Column:
    """Where a cell comes from."""
    return F.struct(document.alias("document_id"), page.alias("pdf_page"), label.alias("manual_page"), block.alias("block_index"), row.alias("row"), column.alias("column"))


def is_field_type(text: Column) -> Column:
    return F.upper(strip(text)).rlike(r"^[A-Z](?:\s*/\s*[A-Z])?$")


def field_triplet(text: Column) -> Column:
    """struct(variable, field_type, default) of a cell of three lines, or of one line of three parts, else null."""
    lines = cell_lines(text)
    parts = F.when(F.size(lines) == 1, F.split(lines[0], r"\s+", 3)).otherwise(lines)
    part = lambda k: F.get(parts, F.lit(k))
    fits = (F.size(parts) == 3) & part(0).rlike(r"^[A-Za-z][A-Za-z0-9_]*$") & F.upper(part(1)).rlike(r"^[A-Z](?:\d+(?:\.\d+)?)?$") & (part(2) != "")
    return F.when(fits, F.struct(part(0).alias("variable"), part(1).alias("field_type"), part(2).alias("default")))


#: Labels of rows that go on with a variable's description, and of rows that go on with a card's definition (fixed values).
CONTINUATION_LABELS = ("variable", "variables", "description", "attribute", "attributes", "operation", "default", "type")
DEFINITION_LABELS = ("variable", "variable type", "variable type default", "type", "default")


def is_variable_title(text: Column) -> Column:
    return strip(text).rlike(r"^[A-Za-z][A-Za-z0-9_]{0,31}$")


def is_description_head(row: Column) -> Column:
    """Whether the second cell of a row is Description."""
    return F.coalesce(row_label(F.get(row, F.lit(1))) == "description", F.lit(False))


def is_variable_head(row: Column) -> Column:
    """Whether a row's only texts are Variable (its first letter may be lost) and Description."""
    labels = F.filter(F.transform(row, row_label), lambda x: x != "")
    return F.coalesce((F.size(labels) == 2) & F.get(labels, F.lit(0)).isin("variable", "ariable") & (F.get(labels, F.lit(1)) == "description"), F.lit(False))


def is_continuation_label(text: Column) -> Column:
    """Whether a row so labelled goes on with the variable above it: blank, a head, a condition or a number."""
    x = strip(text)
    return (x == "") | row_label(x).isin(*CONTINUATION_LABELS) | x.rlike(r"(?i)^(?:EQ|NE|GE|GT|LE|LT)\.") | x.rlike(r"^[-+]?\d+(?:\.\d+)?$") | x.rlike(r"^(?:[<>]=?|[=\u2260])\s*[-+]?\d")


def is_definition_continuation(rows: Column) -> Column:
    """Whether a table (array<array<string>>) only goes on with a card: all its row labels are of a definition."""
    labels = F.filter(F.transform(rows, lambda r: row_label(F.coalesce(F.get(r, F.lit(0)), F.lit("")))), lambda x: x != "")
    known = F.forall(labels, lambda x: x.isin(*DEFINITION_LABELS))
    return (F.size(labels) > 0) & known & ~is_variable_head(F.get(rows, F.lit(0)))


def variable_key(text: Column) -> Column:
    x = F.regexp_replace(text, r"`|\$|[{}]|\^?\\(?:ast|star)\b|\\(?=_)", "")
    x = F.regexp_replace(x, r"(?<=[A-Za-z])-(?=[A-Za-z])|_(?=\d)|\s+", "")
    return F.upper(x)


def is_label(text: Column, label: str, exact: bool = True) -> Column:
    return strip(text).rlike(r"(?i)^" + re.escape(label) + (r"s?\s*:?$" if exact else r"s?\b"))


def card_label(text: Column) -> Column:
    return F.nullif(F.regexp_extract(strip(text), r"(?i)^card\s+(\d+[a-z]?(?:\.\d+)?)", 1), F.lit(""))


def option_token(text: Column) -> Column:
    x = F.regexp_extract(strip(text), r"^([A-Z][A-Z0-9_]{1,63})$", 1)
    return F.when((x != "") & ~x.isin("BLANK", "NONE"), x)


#: A condition: variable, operator, values (fixed values of the notation).
CONDITION = r"(?i)([A-Za-z][A-Za-z0-9_]*)\s*(?:\.\s*)?(EQ\.|NE\.|GE\.|GT\.|LE\.|LT\.|=)\s*([-+A-Za-z0-9_.]+(?:\s+or\s+[-+A-Za-z0-9_.]+)*)"


def conditions(text: Column) -> Column:
    """array<struct(variable, operator, values, raw)> of each `VAR OP VALUE [or VALUE]*`, in order."""

    def one(raw: Column) -> Column:
        part = lambda k: F.regexp_extract(raw, CONDITION, k)
        values = F.transform(F.split(part(3), r"\s+or\s+"), lambda v: F.regexp_replace(v, r"[.,;]+$", ""))
        return F.struct(part(1).alias("variable"), part(2).alias("operator"), values.alias("values"), F.regexp_replace(raw, r"[.,;]+$", "").alias("raw"))

    return F.transform(F.regexp_extract_all(text, F.lit(CONDITION), 0), one)


def alias_tokens(text: Column) -> Column:
    """The identifiers of `A/B` or `A or B` when the text is nothing but such a list, else an empty array."""
    x = strip(text)
    name = r"[A-Za-z][A-Za-z0-9_]*"
    return F.when(x.rlike(rf"(?i)^{name}(?:\s*(?:/|\bor\b)\s*{name})+$"), F.split(x, r"(?i)\s*(?:/|\bor\b)\s*")).otherwise(F.array().cast("array<string>"))


def length_bucket(n: Column, short: int = 2, medium: int = 6) -> Column:
    return F.when(n <= short, "short").when(n <= medium, "medium").otherwise("long")


def ascii_lower(text: Column) -> Column:
    """Lower case, with the letters that fold to ASCII ones where lower case does not: sharp s, long s and ligatures.

    With the tokens' pattern, which only takes ASCII, this is case folding."""
    x = F.translate(F.lower(text), "\u017f", "s")
    for letter, folded in (("\u00df", "ss"), ("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"), ("\ufb05", "st"), ("\ufb06", "st"), ("\u0149", "\u02bcn"), ("\u01f0", "j\u030c")):
        x = F.replace(x, F.lit(letter), F.lit(folded))
    return x


def tokens(text: Column) -> Column:
    """Case-folded ASCII tokens, a multiset in order of appearance."""
    return F.regexp_extract_all(ascii_lower(F.replace(text, F.lit("\\n"), F.lit(" "))), F.lit(TOKEN), 0)


def block_text(block: Column, formulas: bool = True) -> Column:
    """The visible text of a block (type, text, rows): a table's cells row by row; without formulas, mathematics and figures go."""
    cells = F.array_join(F.filter(F.transform(F.flatten(block["rows"]), lambda c: strip(c["text"])), lambda x: x != ""), "\n")
    text = F.coalesce(block["text"], F.lit(""))
    out = F.when(block["type"] == "table", F.coalesce(cells, F.lit(""))).otherwise(text)
    return out if formulas else F.when(block["type"].isin("math", "figure"), "").otherwise(prose(out))


def page_text(blocks: Column, formulas: bool = True) -> Column:
    """The visible text of a page's blocks in order."""
    return F.array_join(F.transform(blocks, lambda b: block_text(b, formulas)), "\n")


def is_section_heading(text: Column, name: Column) -> Column:
    """Whether a header repeats a section's name, or the root of it, in letters and digits."""
    key = alnum_key(text)
    return F.coalesce((key != "") & ((key == alnum_key(name)) | (key == alnum_key(F.split_part(name, F.lit("_"), F.lit(1))))), F.lit(False))


def prose(text: Column) -> Column:
    """Text without inline and display mathematics."""
    return F.regexp_replace(text, r"(?s)\$\$.*?\$\$|\$.*?\$", " ")


def redact(text: Column, secret: str | None) -> Column:
    return F.replace(text, F.lit(secret), F.lit("***")) if secret else text


def escape_cell(text: Column) -> Column:
    lines = F.filter(F.transform(F.split(real_newlines(text), LINE_END), lambda x: strip(x)), lambda x: x != "")
    return F.replace(F.array_join(lines, " <br> "), F.lit("|"), F.lit("\\|"))


def alnum_key(text: Column) -> Column:
    return F.upper(F.regexp_replace(text, r"[^A-Za-z0-9]+", ""))


def number_path(number: Column) -> Column:
    """`22.3.1` as [22, 3, 1]; anything else as an empty array."""
    return F.when(number.rlike(r"^\d+(?:\.\d+)*$"), F.transform(F.split(number, r"\."), lambda x: x.cast("int"))).otherwise(F.array().cast("array<int>"))


def replacement_characters(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))


def fold_confusable(text: Column) -> Column:
    """The letter o and the digit 0 as one."""
    return F.replace(F.lower(text), F.lit("o"), F.lit("0"))
