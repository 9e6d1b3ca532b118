"""URL filters: suffix rules first, gradient-boosted trees on lexical features for the rest.

The trees are fitted on the driver from a bounded sample of labelled URLs and compiled into one
column expression, so every URL is judged inside code generation, without a join or a shuffle.

Cases: null urls and urls without `://` have an empty host and path and are judged on their (empty)
features; very long urls are judged whole; with no labelled URL, or one class only, the trees are a constant; repeated rows are judged
alike; an empty table gives no rows; columns of the input are kept unless they bear a result's name.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import packed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host and path prefix) of the registered query.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Distinct labelled URLs that the trees see, about.
SAMPLE_ROWS = 4_000


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n
    chars = F.array_distinct(F.filter(F.split(url, ""), lambda c: c != ""))
    count = lambda s, pattern: (F.length(s) - F.length(F.regexp_replace(s, pattern, ""))).cast("double")
    return {
        "length": F.length(url).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": count(path, "/"),
        "digit_ratio": count(url, "[0-9]") / n,
        "entropy": F.aggregate(chars, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))),
        "params": count(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "="),
        "labels": count(host, r"\."),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "https": F.startswith(url, F.lit("https:")).cast("double"),
    }


@dataclass
class Trees:
    """base + sum of trees over named features; a node is (feature, threshold, left, right) or a number."""

    names: list[str]
    base: float = 0.0
    trees: list = field(default_factory=list)
    suffixes: dict[str, float] = field(default_factory=dict)

    def column(self, values: dict[str, Column]) -> Column:
        def node(t):
            if not isinstance(t, tuple):
                return F.lit(float(t))
            return F.when(values[t[0]] <= t[1], node(t[2])).otherwise(node(t[3]))

        return reduce(lambda a, t: a + node(t), self.trees, F.lit(float(self.base)))


def fit_trees(x: np.ndarray, y: np.ndarray, names: list[str], rounds: int = 20, depth: int = 3, rate: float = 0.3, least: int = 20) -> Trees:
    """Second-order boosting of the logistic loss with exact splits at up to 32 quantiles a feature."""
    out = Trees(names)
    if not len(y):
        return out
    p = (y.sum() + 1.0) / (len(y) + 2.0)
    out.base = float(np.log(p / (1 - p)))
    if y.min() == y.max():
        return out
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
    score = np.full(len(y), out.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        step = np.zeros(len(y))

        def grow(rows: np.ndarray, left: int):
            total_g, total_h = g[rows].sum(), h[rows].sum()
            best = (1e-6, None, 0.0)
            for j in range(x.shape[1]) if left and len(rows) >= 2 * least else ():
                at = np.searchsorted(cuts[j], x[rows, j], side="left")
                gs, hs, ns = (np.bincount(at, weights=w, minlength=len(cuts[j]) + 1).cumsum() for w in (g[rows], h[rows], np.ones(len(rows))))
                for k, c in enumerate(cuts[j]):
                    if least <= ns[k] <= len(rows) - least:
                        gain = gs[k] ** 2 / (hs[k] + 1) + (total_g - gs[k]) ** 2 / (total_h - hs[k] + 1) - total_g**2 / (total_h + 1)
                        if gain > best[0]:
                            best = (gain, j, float(c))
            if best[1] is None:
                step[rows] = value = rate * total_g / (total_h + 1)
                return float(value)
            low = x[rows, best[1]] <= best[2]
            return (names[best[1]], best[2], grow(rows[low], left - 1), grow(rows[~low], left - 1))

        out.trees.append(grow(np.arange(len(y)), depth))
        score += step
    return out


def train(labelled: DataFrame, url: str = "url", label: str = "block", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on distinct rows of (url, block: 0 or 1), a hash sample of about sample_rows of them."""
    labelled = labelled.select(F.col(url), F.col(label).cast("int").alias("y")).where("y is not null").distinct()
    n = labelled.count()
    unit = F.pmod(F.xxhash64(F.col(url)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    labelled = labelled.where(unit < sample_rows / max(n, 1))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    values = features(F.col(url), host, path)
    names = list(values)
    rows = labelled.select("y", F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"), *[v.alias(k) for k, v in values.items()]).collect()
    rows.sort(key=lambda r: tuple(r))
    y = np.array([r["y"] for r in rows], dtype=float)
    counts: dict[str, list[float]] = {}
    for r in rows:
        c = counts.setdefault(r["suffix"], [0.0, 0.0])
        c[r["y"]] += 1
    odds = {s: float(np.log((c[1] + 1) / (c[0] + 1))) for s, c in counts.items()}
    x = np.array([[r[k] for k in names] + [odds.get(r["suffix"], 0.0)] for r in rows], dtype=float).reshape(len(rows), len(names) + 1)
    model = fit_trees(x, y, [*names, "suffix_odds"])
    model.suffixes = odds
    return model


def judge(pages: DataFrame, rules=RULES, model: Trees | None = None, url: str = "url", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """pages with host, path, rule, verdict and block_score (the trees' log-odds of block), which replace columns so named; all
    other columns are handed on, whatever their names.

    Without a model, the trees are trained from the URLs that the rules label.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    if model is None:
        ruled = pages.select(F.col(url).alias("url"), rule_of(host, path, rules)["verdict"].alias("v")).where("v is not null")
        model = train(ruled.select("url", (F.col("v") == "block").cast("int").alias("block")), sample_rows=sample_rows)
    values = features(F.col("_url"), F.col("host"), F.col("path"))
    suffix = F.regexp_extract("host", r"([^.]*)$", 1)
    odds = F.lit(0.0)
    if model.suffixes:
        odds = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in model.suffixes.items() for x in kv]), suffix), F.lit(0.0))
    values["suffix_odds"] = odds
    made = ("host", "path", "rule", "verdict", "block_score")
    kept = [c for c in pages.columns if c.lower() not in made]
    with_host = pages.select(packed(pages), F.col(url).alias("_url"), host.alias("host"), path.alias("path"))
    ruled = with_host.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).withColumns({f"_f_{k}": v for k, v in values.items()})
    scored = ruled.withColumn("block_score", model.column({k: F.col(f"_f_{k}") for k in values}))
    verdict = F.coalesce(F.col("_rule")["verdict"], F.when(F.col("block_score") > 0, "block").otherwise("allow"))
    return scored.select(*[F.col("row")[c].alias(c) for c in kept], "host", "path", "block_score", F.col("_rule")["rule"].alias("rule"), verdict.alias("verdict"))
