"""How far the term use of each source differs from that of the other sources of its language.

Terms are counted within tasks, whose partial counts are summed to postings: (lang, term, source) with its count. Every
group (lang, source), and each language as a whole, gives each of the language's V kept terms the probability
p = 1 + floor(PARTS * (count + 1) / (N + V)), N its count of kept terms; terms that a group lacks all have the same p.
The divergence of p from q at a term is f = floor((p - q)^2 / q).

Upper-bound search (`top_terms`): a group's terms fall into buckets by the bit lengths of their count and of their language's
count. In a bucket the largest p and the smallest q bound f. Buckets are evaluated best bound first: as many as hold the wanted
number of terms, whose worst is a first k-th value; then those whose bound is not strictly below it. Terms of all other buckets
are never evaluated.

Pairs (`pair_divergence`) come from postings: with p0, q0 the probabilities of lacking terms, the sum over all kept terms is
V f(p0, q0), and for each count of either group the number of its terms with it, times what f changes when that group has
the term and the other lacks it; only for terms that both have, a task that holds whole postings adds what is left,
f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). So the work is that of postings, not of terms times pairs of sources; a task sums
over its terms and sends a row for each pair.

Scale: a language or group may hold most rows: tasks hold a hash part of a language's terms, of PART_POSTINGS postings or about
as many, with whole posting lists (as long as the language's sources), and a group's buckets are joined, not gathered.

Exact: p is made in decimals; f, its sums and their parts fit a long, as a group's p sum to PARTS + V at most (V below 10^9).

Cases: null text, lang and source are ''; groups without any term, and languages without kept terms (V = 0), have pairs with
value 0 and no terms; very long texts are read in slices; repeated rows count each; an empty table gives no rows; a language of
one source gives terms only; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import arrow_schema, save

#: A term in UTF-8: ASCII letters and everything beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
LEAST_DOCS, TOP, PARTS = 3, 200, 1_000_000_000
#: Entries that a task counts before it sends them on, terms of a text counted at once, postings of a part.
HELD, SLICE, PART_POSTINGS = 300_000, 200_000, 1 << 17


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term binary, n, docs): each task's counts of occurrences and of documents, to be summed; a row of the
    empty term for every group."""
    schema = "lang string, source string, term binary, n long, docs long"
    fields = arrow_schema(schema)

    def rows(held: dict[tuple, tuple[Counter, Counter]]):
        for (lang, source), (n, seen) in held.items():
            terms = list(n)
            for k in range(0, len(terms), 50_000):
                part = terms[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()), pa.array([n[t] for t in part], pa.int64()), pa.array([seen[t] for t in part], pa.int64())], schema=fields)

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                n, seen = held.setdefault((lang, source), (Counter({b"": 0}), Counter()))
                text, before, mine = text.lower(), len(n), None  # (bytes: only A-Z changes)
                if len(text) <= 8 * SLICE:
                    terms = TERM.findall(text)
                    n.update(terms)
                    mine = set(terms)
                else:
                    found = (m.group() for m in TERM.finditer(text))
                    mine = set()
                    while part := list(islice(found, SLICE)):
                        n.update(part)
                        mine.update(part)
                seen.update(mine)
                size += len(n) - before
                if size > HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    wanted = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return wanted.mapInArrow(run, schema)


def postings(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(lang, term, source, c, lang_c) of every kept term, and (lang, source, n, v, lang_n) of every group."""
    summed = count_terms(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("c"), F.sum("docs").alias("docs"))
    summed = save(summed, "term-counts", tidy=True)
    of_term = summed.where("term != X''").groupBy("lang", "term").agg(F.sum("c").alias("lang_c"), F.sum("docs").alias("df")).where(F.col("df") >= least_docs).drop("df")
    of_term = save(of_term, "kept-terms", tidy=True)
    posts = save(summed.drop("docs").join(of_term, ["lang", "term"]).select("lang", F.col("term").cast("string").alias("term"), "source", "c", "lang_c"), "postings", tidy=True)
    of_lang = of_term.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_c").alias("lang_n"))
    sizes = posts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = summed.where("term = X''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0)
    return posts, save(groups, "groups", tidy=True)


def probability(count: Column | str, n: Column | str, v: Column | str) -> Column:
    """1 + floor(PARTS * (count + 1) / (n + v)), exactly; null where v is 0."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")
    above, below = F.lit(PARTS).cast("decimal(10,0)") * (wide(count) + 1), wide(n) + wide(v)
    return 1 + F.call_function("div", above, F.when(below > 0, below))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) in longs."""
    return F.call_function("div", (p - q) * (p - q), q)


def top_terms(posts: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank) of each group's `top` terms with p > q, q the language's."""
    group = ["lang", "source"]
    rows = posts.join(groups, group).select(*group, "term", "c", "lang_c", probability("c", "n", "v").alias("p"), probability("lang_c", "lang_n", "v").alias("q")).where("p > q")
    rows = rows.withColumn("bucket", F.length(F.bin("c")) * 64 + F.length(F.bin("lang_c")))
    rows = save(rows.select(*group, "term", "bucket", "p", "q"), "rising-terms", tidy=True)
    # p and q of a bucket bound f: it rises with p and falls with q
    buckets = rows.groupBy(*group, "bucket").agg(F.max("p").alias("p"), F.min("q").alias("q"), F.count("*").alias("size"))
    buckets = buckets.withColumn("bound", divergence(F.col("p"), F.col("q"))).drop("p", "q")
    best = Window.partitionBy(*group).orderBy(F.col("bound").desc(), "bucket")
    before = F.coalesce(F.sum("size").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = save(buckets.withColumn("first", before < top), "term-buckets", tidy=True)
    order = Window.partitionBy(*group).orderBy(F.col("value").desc(), "item")

    def evaluated(wanted: DataFrame) -> DataFrame:
        held = rows.join(wanted.select(*group, "bucket"), [*group, "bucket"])
        held = held.select(*group, F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        return held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    first = save(evaluated(buckets.where("first")), "first-terms", tidy=True)
    kth = first.where(F.col("rank") == top).select(*group, F.col("value").alias("kth"))
    rest = buckets.where("not first").join(kth, group).where("bound >= kth")
    both = first.drop("rank").union(evaluated(rest).drop("rank"))
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _both(key: tuple, t: pa.Table) -> pa.Table:
    """For each two sources what f of the terms that both have adds to what each adds alone; t: whole posting lists."""
    terms = t["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    names = t["source"].combine_chunks().dictionary_encode()
    source, p, p0 = names.indices.to_numpy().astype(np.int64), t["p"].to_numpy(), t["p0"].to_numpy()
    order = np.argsort(terms, kind="stable")
    terms, source, p, p0 = terms[order], source[order], p[order], p0[order]
    start = np.searchsorted(terms, np.arange(int(terms[-1]) + 2))
    size, k = np.diff(start), len(names.dictionary)
    f = lambda a, b: (a - b) * (a - b) // b
    by_source = np.argsort(source, kind="stable")
    cuts, step = np.searchsorted(source[by_source], np.arange(k + 1)), 1 + PART_POSTINGS // int(size.max())
    out: list[tuple[np.ndarray, ...]] = []
    for other in range(k):
        total, met = np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
        for cut in range(cuts[other], cuts[other + 1], step):
            at = by_source[cut : min(cut + step, cuts[other + 1])]
            n = size[terms[at]]
            left = np.repeat(start[terms[at]] - (np.cumsum(n) - n), n) + np.arange(n.sum())  # the lists that hold `other`
            q, q0 = np.repeat(p[at], n), np.repeat(p0[at], n)
            np.add.at(total, source[left], f(p[left], q) - f(p[left], q0) - f(p0[left], q) + f(p0[left], q0))
            met += np.bincount(source[left], minlength=k)
        met[other] = 0
        i = np.flatnonzero(met)
        out.append((i, np.full(len(i), other), total[i]))
    i, j, value = map(np.concatenate, zip(*out))
    names = names.dictionary
    return pa.table({"lang": pa.array([key[0].as_py()] * len(i), pa.string()), "source": names.take(pa.array(i)), "item": names.take(pa.array(j)), "value": pa.array(value, pa.int64())})


def pair_divergence(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): for each group every other source of its language and the divergence of the group
    from it, summed over all kept terms."""
    g = groups.select("lang", "source", "v", "n", probability(F.lit(0), "n", "v").alias("p0"))
    h = g.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    counts = posts.groupBy("lang", "source", "c").agg(F.count("*").alias("terms")).join(g, ["lang", "source"])
    counts = counts.select("lang", "source", "terms", "p0", probability("c", "n", "v").alias("p")).join(h, "lang").where("source != item")
    p, p0, q0, terms = map(F.col, ("p", "p0", "q0", "terms"))
    mine = F.struct("source", "item", (terms * (divergence(p, q0) - divergence(p0, q0))).alias("value"))
    theirs = F.struct(F.col("item").alias("source"), F.col("source").alias("item"), (terms * (divergence(q0, p) - divergence(q0, p0))).alias("value"))
    alone = counts.select("lang", F.explode(F.array(mine, theirs)).alias("x")).select("lang", "x.*")
    none = g.join(h, "lang").where("source != item").select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * divergence(p0, q0)).otherwise(0).alias("value"))
    n_parts = -(-posts.count() // PART_POSTINGS)
    dealt = posts.join(g, ["lang", "source"])
    dealt = dealt.select("lang", F.pmod(F.xxhash64("term"), F.lit(max(1, n_parts))).cast("int").alias("part"), "term", "source", probability("c", "n", "v").alias("p"), "p0")
    both = dealt.groupBy("lang", "part").applyInArrow(_both, "lang string, source string, item string, value long")
    value = none.union(alone).union(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return value.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value long, rank int): each group's pairs and top terms."""
    posts, groups = postings(docs, least_docs)
    out = None
    for part, df in (("pair", pair_divergence(posts, groups)), ("term", top_terms(posts, groups, top))):
        df = df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int"))
        out = df if out is None else out.union(df)
    return out
