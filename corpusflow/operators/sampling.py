"""Feature flags of sections and the samples that cover them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import ordered

#: Signals of features, and the sample's targets and limits (fixed values).
CARD = r"(?i)\bCard\s+\d+[A-Za-z]?\b"
CONDITION = r"(?i)\b(?:EQ|NE|GE|GT|LE|LT)\.\s*-?(?:\d+(?:\.\d*)?|\.\d+)|included\s+if|if\s+and\s+only\s+if"
VARIABLE_FAMILY = r"\b(?:Aij|Ai\s*,\s*Bi|[A-Z]ij|[A-Z]i)\b"
OPTION = r"(?i)available\s+options?|\bkeyword\s+options?\b|\bOPTION[A-Z0-9_]*\b"
VARIABLE_DESCRIPTION = r"(?is)\bVARIABLE\s+DESCRIPTION\b|\bVARIABLE\b.{0,30}\bDESCRIPTION\b"
FIGURE = r"(?i)\b(?:Figure|Fig\.)\s*\d+"
#: The named features of a section, in order (fixed values).
FEATURES = (
    "non_keyword", "nested_section", "shared_boundary_candidate", "multiple_cards_candidate", "card_conditions_candidate", "options_candidate",
    "variable_description_candidate", "variable_family_candidate", "multi_page_card_candidate", "multi_page_variable_description_candidate", "formula_dense_candidate", "figure_rich_candidate",
)
TARGETS = {"short": 3, "medium": 4, "long": 3}
MOST_PAGES, SEED, HOLDOUT_SEED = 40, 20260817, 20260818


def signals(text: Column, pages: Column | None = None) -> dict[str, Column]:
    """Counters of a section's text; pages: its page texts, where hits are counted by page."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    plain = lambda s: (F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))) / len(s)
    out = {
        "cards": F.size(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(CARD), 0), F.lower))),
        "conditions": count(CONDITION),
        "figures": count(FIGURE),
        "formulas": (plain("=") + plain("\\frac") + plain("∑")).cast("int"),
    }
    if pages is not None:
        out |= {"card_pages": F.size(F.filter(pages, lambda p: p.rlike(CARD))), "variable_pages": F.size(F.filter(pages, lambda p: p.rlike(VARIABLE_DESCRIPTION)))}
    return out


def flags(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in the order given."""
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]), lambda x: x.isNotNull())


def feature_flags(pages: Column, keyword: Column, nested: Column, shared: Column) -> tuple[Column, dict[str, Column]]:
    """The names of the features that a section's page texts (an array) show, and the counts behind them."""
    text = F.array_join(pages, "\n")
    n = signals(text, pages)
    has = lambda pattern: text.rlike(pattern)
    shown = (
        ~keyword, nested, shared, n["cards"] >= 2, n["conditions"] > 0, has(OPTION), has(VARIABLE_DESCRIPTION), has(VARIABLE_FAMILY),
        n["card_pages"] >= 2, n["variable_pages"] >= 2, n["formulas"] >= 6, n["figures"] >= 2,
    )
    return flags(dict(zip(FEATURES, shown))), n


def with_anchors(sample: DataFrame, sections: DataFrame, anchors: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(sample with the sections that are named, anchors that are no section); anchor tells the named rows."""
    named = anchors.select(*keys).distinct().withColumn("anchor", F.lit(True))
    marked = sample.join(named, keys, "left").withColumn("anchor", F.coalesce("anchor", F.lit(False)))
    more = sections.join(named, keys).join(sample.select(*keys), keys, "left_anti")
    return marked.unionByName(more, allowMissingColumns=True), named.drop("anchor").join(sections.select(*keys), keys, "left_anti")


def section_sample(sections: DataFrame, document: str, bucket: str, key: Column, seed: int = SEED, targets: dict[str, int] = TARGETS) -> DataFrame:
    """Sections picked in seeded order, by document and length bucket."""
    target = F.coalesce(*[F.when(F.col(bucket) == b, F.lit(n)) for b, n in targets.items()], F.lit(0))
    return ordered.stratified_sample(sections, [document, bucket], key, target, seed)


def supplement(sections: DataFrame, sample: DataFrame, keys: list[str], flag: str, seed: int = SEED) -> DataFrame:
    """One more section for each feature that no sampled section has: the first in seeded order. sections: keys and flag (array)."""
    covered = sample.select(*keys).join(sections.select(*keys, flag), keys).select(F.explode(flag).alias("feature")).distinct()
    rare = sections.join(sample.select(*keys), keys, "left_anti").withColumn("feature", F.explode(flag)).join(covered, "feature", "left_anti")
    w = Window.partitionBy("feature").orderBy(ordered.seeded_order(seed, F.col("feature"), F.concat_ws(":", *keys)))
    return rare.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def holdout(sections: DataFrame, frozen: DataFrame, keys: list[str]) -> DataFrame:
    return sections.join(frozen.select(*keys).distinct(), keys, "left_anti")


def sample_summary(sample: DataFrame, document: str, bucket: str, features: str | None = None) -> DataFrame:
    """Counts by document, by bucket and, where the array column is given, by feature."""
    by = lambda df, c: df.groupBy(F.lit(c).alias("by"), F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n"))
    out = by(sample, document).union(by(sample, bucket))
    return out.union(by(sample.select(F.explode(features).alias("feature")), "feature")) if features else out


def bucketed(sections: DataFrame, pages: str) -> DataFrame:
    return sections.withColumn("bucket", X.length_bucket(F.col(pages))).where((F.col(pages) > 0) & (F.col(pages) <= MOST_PAGES))
