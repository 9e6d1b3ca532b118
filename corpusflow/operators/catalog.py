"""The catalogue of a scope's variables as an index: names, aliases, near names, groups and families by equal keys.

An index has a row for each name that can be looked up: its key, what it stands for, its fold (letter O as digit 0) and, for
names that end in a number or have one inside, what stands before and after it. So a text finds its variable by its key or fold, a
family its members by (head, tail), whatever the size of the catalogue; no text is held against all names.

Scopes (a section, say) are columns given by name, one at least. Ties go to what comes first in the catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X

#: Forms of the notation (fixed values): names, operators that end the names at a line's start, labels of families with any number, with
#: axes and with an index in words, and the words for values behind a heading.
NAME = r"[A-Za-z][A-Za-z0-9_-]*"
OPERATOR = r"(?i)\b(?:EQ|NE|GE|GT|LE|LT)\."
BRACKET = r"(?i)^([A-Za-z_]+)\[N\]([A-Za-z_]*)$"
AXES = r"(?i)^([A-Za-z][A-Za-z_-]*?)(?:\[)?([XYZ](?:\s*,\s*[XYZ])+)\]$"
INDEXED = r"(?is)\bi\s*(?:\^\s*\{?\s*th\s*\}?|th)[^\n]*\bparameters?\b"
VALUE_WORDS = r"(?i)\s+(?:values?|attributes?)\s*$"
#: A key with a number in it: what stands before, the number, what stands behind.
NUMBERED = r"^([^0-9]+)([0-9]+)([^0-9]*)$"


def fold(key: Column) -> Column:
    return F.translate(key, "O", "0")


def build_index(fields: DataFrame, scope: list[str], order: list[str], variable: str = "variable", origin: str | None = None, ambiguous: str | None = None) -> DataFrame:
    """(scope, key, variable, target, exact_only, fold, head, number, tail, place) of each name in fields.

    A name is there once whatever its case, at its first place in `order`. Parts of `A/B` and `A or B` are aliases: found by their
    exact key only, and only if one field (origin) has them, no name has their key, and the field's page is not ambiguous."""
    named = fields.where(X.strip(variable) != "").select(*scope, F.struct(*order).alias("_at"), X.strip(variable).alias("variable"), *([F.col(origin).alias("_origin")] if origin else []), (F.coalesce(F.col(ambiguous), F.lit(False)) if ambiguous else F.lit(False)).alias("_ambiguous"))
    if not origin:
        named = named.withColumn("_origin", F.col("_at"))
    key = X.variable_key(F.col("variable"))
    first = named.where(key != "").groupBy(*scope, key.alias("key")).agg(F.min(F.struct("_at", "variable")).alias("_f"))
    names = first.select(*scope, "key", F.col("_f.variable").alias("variable"), F.col("_f.variable").alias("target"), F.lit(False).alias("exact_only"), F.col("_f._at").alias("place"))
    fields_once = named.where("not _ambiguous").groupBy(*scope, "_origin").agg(F.max_by(F.struct("variable", "_at"), "_at").alias("_f")).select(*scope, "_origin", "_f.*")
    parts = fields_once.select(*scope, "_at", "variable", F.explode(X.alias_tokens(F.col("variable"))).alias("alias"))
    parts = parts.withColumn("key", X.variable_key(F.col("alias"))).where("key != ''")
    single = parts.groupBy(*scope, "key").agg(F.count("*").alias("_n"), F.first("alias").alias("alias"), F.first("variable").alias("target"), F.first("_at").alias("place")).where("_n = 1")
    aliases = single.join(names.select(*scope, "key"), [*scope, "key"], "left_anti").select(*scope, "key", F.col("alias").alias("variable"), "target", F.lit(True).alias("exact_only"), "place")
    both = names.unionByName(aliases)
    part = lambda k: F.when(~F.col("exact_only"), F.nullif(F.regexp_extract("key", NUMBERED, k), F.lit("")))
    return both.withColumns({"fold": fold(F.col("key")), "head": part(1), "number": part(2), "tail": F.when(part(1).isNotNull(), F.coalesce(part(3), F.lit("")))})


def lookup(keys: DataFrame, index: DataFrame, scope: list[str], key: str = "key") -> DataFrame:
    """(scope, key, matched, target, how) of the distinct keys that name a variable: the equal key (exact, alias), else the only
    name that differs in one letter O against a digit 0 (confusable)."""
    wanted = keys.select(*scope, F.col(key).alias("key")).where("key != ''").distinct()
    near = wanted.withColumn("fold", fold(F.col("key"))).join(index.select(*scope, "fold", F.col("key").alias("_key"), "variable", "target", "exact_only"), [*scope, "fold"])
    same = F.col("key") == F.col("_key")
    near = near.where(same | ~F.col("exact_only") & (F.levenshtein("key", "_key") == 1))
    hit = F.struct("variable", "target", "exact_only")
    per = near.groupBy(*scope, "key").agg(F.max(F.when(same, hit)).alias("_same"), F.count(F.when(~same, 1)).alias("_n"), F.max(F.when(~same, hit)).alias("_near"))
    found = per.where("_same is not null or _n = 1").withColumn("_hit", F.coalesce("_same", "_near"))
    how = F.when(F.col("_same").isNull(), "confusable").when(F.col("_hit.exact_only"), "alias").otherwise("exact")
    return found.select(*scope, "key", F.col("_hit.variable").alias("matched"), F.col("_hit.target").alias("target"), how.alias("how"))


def heading_forms(text: Column) -> Column:
    """The texts that a heading of a description may mean, in the order in which they are looked up: itself, a name set as a
    formula, and itself without a remark in brackets or a word for values behind it."""
    bare = X.strip(text)
    formula = bare.rlike(r"(?s)^\$.*\$$") & ~bare.rlike(r"=|\+|/|\\(?:times|frac|left|right)\b")
    inner = F.regexp_replace(X.strip(F.regexp_replace(bare, r"^\$+|\$+$", "")), r"[,;:]+$", "")
    inner = F.regexp_replace(F.regexp_replace(inner, r"\\(?:mathrm|rm)\b", ""), r"[{}_^\s]", "")
    short = F.regexp_replace(F.regexp_replace(text, r"\s*\([^)]*\)\s*$", ""), VALUE_WORDS, "")
    return F.filter(F.array(text, F.when(formula & inner.rlike(r"^[A-Za-z][A-Za-z0-9]*$"), inner), short), lambda x: x.isNotNull())


def leading_forms(text: Column) -> Column:
    """The texts at the start of a description that may name its variable, in the order in which they are looked up."""
    lines = F.filter(F.transform(F.split(text, X.LINE_END), X.strip), lambda x: x != "")
    first, second = F.get(lines, F.lit(0)), F.get(lines, F.lit(1))
    token = F.nullif(F.regexp_extract(first, r"^([^\s:]+)(?:\s+|:\s*)", 1), F.lit(""))
    spaced = F.nullif(F.regexp_replace(F.regexp_extract(first, r"^((?:[A-Za-z]\s+){1,15}[A-Za-z])\s+\S", 1), r"\s+", ""), F.lit(""))
    headed = F.when(first.rlike(r"(?i)^VARIABLE\s*:?\s*$"), second)
    same_line = F.nullif(X.strip(F.regexp_extract(first, r"(?i)^VARIABLE\s+(.+)$", 1)), F.lit(""))
    tried = F.filter(F.array(headed, same_line, token, F.coalesce(spaced, F.when(F.size(lines) > 1, first))), lambda x: x.isNotNull())
    return F.flatten(F.transform(tried, heading_forms))


def resolve(rows: DataFrame, index: DataFrame, scope: list[str], ids: list[str], forms: Column) -> DataFrame:
    """(ids, matched, target, how, form): the first of a row's forms that names a variable; rows without one are not there."""
    tried = rows.select(*scope, *[c for c in ids if c not in scope], F.posexplode(forms).alias("_at", "form")).withColumn("key", X.variable_key(F.col("form")))
    met = tried.join(lookup(tried, index, scope), [*scope, "key"])
    per = met.groupBy(*ids).agg(F.min_by(F.struct("matched", "target", "how", "form"), "_at").alias("_m"))
    return per.select(*ids, "_m.*")


def leading_groups(rows: DataFrame, index: DataFrame, scope: list[str], ids: list[str], text: str = "text") -> DataFrame:
    """(ids, label, targets) of texts whose lines begin with names parted by commas or slashes, two variables at least.

    A line's names end at its first condition (`EQ.` and the like) and at the first that is no variable; a line after the first may
    begin with a slash. One name alone counts if a comma, a slash, a condition or the line's end follows it."""
    lines = rows.select(*scope, *[c for c in ids if c not in scope], F.posexplode(F.split(F.col(text), X.LINE_END)).alias("_line", "_raw"))
    before = X.strip(F.get(F.split("_raw", OPERATOR, 2), F.lit(0)))
    value = F.when((F.col("_line") > 0) & F.startswith(before, F.lit("/")), F.regexp_replace(before, r"^/\s*", "")).otherwise(before)
    run = F.regexp_extract("_value", rf"^{NAME}(?:\s*[,/]\s*{NAME})*", 0)
    lines = lines.withColumns({"_value": value, "_condition": F.col("_raw").rlike(OPERATOR)})
    lines = lines.withColumn("_alone", F.col("_condition") | F.regexp_replace("_value", rf"^{NAME}\s*", "").rlike(r"^(?:[,/]|$)"))
    names = lines.select(*scope, *[c for c in ids if c not in scope], "_line", "_alone", F.posexplode(F.regexp_extract_all(run, F.lit(NAME), 0)).alias("_at", "_name"))
    names = names.withColumn("key", X.variable_key(F.col("_name")))
    met = names.join(lookup(names, index, scope), [*scope, "key"], "left")
    line = Window.partitionBy(*ids, "_line").orderBy("_at")
    met = met.withColumn("_broken", F.max(F.col("matched").isNull()).over(line)).where("not _broken")
    met = met.withColumn("_n", F.count("*").over(Window.partitionBy(*ids, "_line"))).where("_n > 1 or _alone")
    first = met.groupBy(*ids, "matched").agg(F.min(F.struct("_line", "_at", "_name")).alias("_f"))
    per = first.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("_f", "matched"))).alias("_g")).where("size(_g) > 1")
    return per.select(*ids, F.array_join(F.transform("_g", lambda g: g["_f"]["_name"]), ", ").alias("label"), F.transform("_g", lambda g: g["matched"]).alias("targets"))


def _tokens_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), X.strip), lambda x: (x != "") & (x != "..."))


def families(labels: DataFrame, index: DataFrame, scope: list[str], label: str = "label") -> DataFrame:
    """(scope, label, rule, members): the variables that a label stands for, in the catalogue's order, by the first rule that finds any.

    1 `P[N]S`, any number; 2 `P[X,Y]`, these axes, all known; 3 the i-th parameter, where the scope has one numbered family;
    4 names in a list, all known, and with dots the whole family of their common head; 5 with dots, the family of numbered names of
    one head; 6 names that end in the index I, N or IJ. A family is found by what stands before and after its number."""
    text = X.strip(label)
    wanted = labels.where(F.col(label).isNotNull()).select(*scope, F.col(label)).distinct()
    head = lambda p, k: X.variable_key(F.regexp_extract(text, p, k))
    dots = F.contains(F.col(label), F.lit("..."))
    listed = _tokens_of(F.col(label))
    keys = F.transform(listed, X.variable_key)
    heads = F.array_distinct(F.transform(keys, lambda k: F.regexp_extract(k, r"^([A-Z_]+)\d+$", 1)))
    words = F.split(X.strip(F.upper(F.regexp_replace(F.col(label), r"[^A-Za-z0-9, ]+", ""))), "[, ]+")
    index_head = lambda w: F.when(w.rlike(r"^[A-Z]+IJ$"), F.regexp_replace(w, "IJ$", "")).when(w.rlike(r"^[A-Z]+[IN]$"), F.regexp_replace(w, "[IN]$", ""))
    ends = F.array_distinct(F.filter(F.transform(words, index_head), lambda x: x.isNotNull() & (x != "")))
    family = lambda rule, h, t: F.struct(F.lit(rule).alias("rule"), h.alias("head"), t.alias("tail"))
    none = F.array().cast("array<struct<rule:int,head:string,tail:string>>")
    of_head = F.concat(
        F.when(text.rlike(BRACKET), F.array(family(1, head(BRACKET, 1), head(BRACKET, 2)))).otherwise(none),
        F.when(dots & (F.size(listed) >= 2) & (F.size(heads) == 1) & (F.get(heads, F.lit(0)) != ""), F.array(family(5, F.get(heads, F.lit(0)), F.lit("")))).otherwise(none),
        F.transform(ends, lambda h: family(6, h, F.lit(""))),
    )
    member = F.struct("place", "variable")
    members = index.where("head is not null").select(*scope, "head", "tail", member.alias("member"))
    by_head = wanted.select(*scope, label, F.explode(of_head).alias("_w")).select(*scope, label, "_w.*").join(members, [*scope, "head", "tail"]).select(*scope, label, "rule", "member")
    # rule 3: the only family of two or more
    several = members.where("tail = ''").where(F.col("head").rlike("^[A-Z_]+$")).groupBy(*scope, "head", "tail").agg(F.count("*").alias("_n")).where("_n > 1")
    only = several.groupBy(*scope).agg(F.count("*").alias("_k"), F.first("head").alias("head")).where("_k = 1").select(*scope, "head", F.lit("").alias("tail"))
    indexed = wanted.where(F.col(label).rlike(INDEXED))
    third = indexed.join(only, scope).join(members, [*scope, "head", "tail"]).select(*scope, label, F.lit(3).alias("rule"), "member")
    # rules 2 and 4: names that are all looked up
    ax = F.regexp_extract_all(F.regexp_extract(text, AXES, 2), F.lit("(?i)[XYZ]"), 0)
    named = lambda rule, tokens: F.struct(F.lit(rule).alias("rule"), tokens.alias("tokens"))
    lists = F.filter(F.array(F.when(text.rlike(AXES), named(2, F.transform(ax, lambda a: F.concat(F.regexp_extract(text, AXES, 1), a)))), F.when(F.size(listed) >= 2, named(4, listed))), lambda x: x.isNotNull())
    tokens = wanted.select(*scope, label, dots.alias("_dots"), F.explode(lists).alias("_l")).select(*scope, label, "_dots", "_l.rule", F.posexplode("_l.tokens").alias("_at", "_token"))
    tokens = tokens.withColumn("key", X.variable_key(F.col("_token")))
    met = tokens.join(lookup(tokens, index, scope), [*scope, "key"], "left")
    met = met.groupBy(*scope, label, "rule", "_dots").agg(F.min(F.col("matched").isNotNull()).alias("_all"), F.collect_list(F.struct("_at", "matched")).alias("_m")).where("_all")
    names = met.select(*scope, label, "rule", "_dots", F.array_distinct(F.transform(F.sort_array("_m"), lambda m: m["matched"])).alias("members"))
    common = F.array_distinct(F.filter(F.transform("members", lambda v: F.regexp_extract(X.variable_key(v), r"^([A-Z_]+)\d+$", 1)), lambda h: h != ""))
    names = names.withColumn("head", F.when((F.col("rule") == 4) & F.col("_dots") & (F.size(common) == 1), F.get(common, F.lit(0))))
    whole = names.where("head is not null").withColumn("tail", F.lit("")).drop("members").join(members, [*scope, "head", "tail"]).select(*scope, label, "rule", "member")
    grouped = by_head.union(third).union(whole).distinct().groupBy(*scope, label, "rule").agg(F.transform(F.sort_array(F.collect_list("member")), lambda m: m["variable"]).alias("members"))
    found = grouped.union(names.where("head is null").select(*scope, label, "rule", "members"))
    return found.groupBy(*scope, label).agg(F.min(F.struct("rule", "members")).alias("_b")).select(*scope, label, "_b.rule", "_b.members")
