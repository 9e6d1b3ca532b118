"""Collocations, divergence of sources and top-k search against plain versions, on whole small tables and odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import divergence, phrases, topk


def plain_phrases(rows, least, cover, top, longest):
    pieces, out = {}, []
    for text, lang in rows:
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        pieces.setdefault("und" if lang is None else lang, []).extend(re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", text))
    for lang, held in pieces.items():
        f = Counter(tuple(p[i : i + k]) for p in held for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        n, found = sum(map(len, held)), []
        longer = {}
        for g, a in f.items():
            for k in range(1, len(g)):
                for i in range(len(g) - k + 1):
                    longer[g[i : i + k]] = max(longer.get(g[i : i + k], 0), a if a >= least else 0)
        for g, a in f.items():
            if len(g) > 1 and a >= least and not 100 * longer.get(g, -1) >= cover * a:
                score, _, l, r = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


PHRASE_ROWS = [("New York is big. new\tYork, new york! a a a a a", None)] * 7 + [("the new york times; of x y z", None)] * 4 + [("a a a a a a a a a a a a", "und"), ("", None), (None, "en"), (" \t.,", "en")] + [("a b c\rd é É x ü", "en")] * 12


@pytest.mark.parametrize("longest,segment,buckets", [(3, 50_000, None), (3, 3, 5), (4, 2, 1), (2, 50_000, 3)])
def test_collocations_equal_a_plain_count(spark, longest, segment, buckets):
    df = spark.createDataFrame(PHRASE_ROWS, "text string, lang string").withColumns({c: F.lit("x") for c in ("piece", "gram", "bucket", "times", "f", "part")})
    got = phrases.collocations(df, longest=longest, segment=segment, n_buckets=buckets)
    assert sorted(map(tuple, got.collect())) == plain_phrases(PHRASE_ROWS, 10, 50, 2000, longest)
    got = phrases.collocations(df, longest=longest, least=3, cover_percent=90, top=4)
    assert sorted(map(tuple, got.collect())) == plain_phrases(PHRASE_ROWS, 3, 90, 4, longest)
    assert phrases.collocations(df.limit(0)).collect() == []


def test_a_very_long_text_and_copies_of_it_count_whole(spark):
    words = [f"w{i % 7}" if i % 3 else "the" for i in range(120_000)]
    rows = [(" ".join(words), "en")] * 2 + [(" ".join(words[:50]), "en")]
    got = phrases.collocations(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 10, 50, 2000, 3)


def plain_audit(rows, top=200):
    rows = [[x or "" for x in r] for r in rows]
    cut = lambda t: [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
    out = []
    for lang in {r[1] for r in rows}:
        docs = [(s, Counter(cut(t))) for t, la, s in rows if la == lang]
        df = Counter(w for _, c in docs for w in c)
        kept, of = sorted(w for w in df if df[w] >= 3), {}
        for s, c in docs:
            of.setdefault(s, Counter()).update({w: n for w, n in c.items() if df[w] >= 3})
        total = sum(of.values(), Counter())
        p = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        q = p(total)
        for s in of:
            mine = p(of[s])
            pairs = sorted((-sum((mine[w] - o) ** 2 // o for w, o in p(of[h]).items()), h.encode()) for h in of if h != s)
            terms = sorted((-((mine[w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if of[s][w] and mine[w] > q[w])[:top]
            out += [(lang, s, part, x.decode(), -v, i + 1) for part, found in (("pair", pairs), ("term", terms)) for i, (v, x) in enumerate(found)]
    return sorted(out)


AUDIT_ROWS = [
    ("A b, ab AB ab é x-ray", "en", "s1"), ("ab É é a", None, None), ("ab", "en", "s2"), ("ab b é", None, "s"), (None, "fr", "x"), ("", "fr", "y"), ("zz zz zz", "de", "only"),
    ("ab é", None, "s"), ("é b ab x ray b b b", "en", "s1"), ("ab ab b", "en", "s3"), ("?", "en", "empty"), ("b b ray x", "en", None), ("b b ray x", "en", None), ("q " * 50, "en", "q"), ("q", "en", "s2"), ("q a", "en", "s1"),
]


def test_divergence_equals_plain_sums(spark, monkeypatch):
    schema = "text string, lang string, source string"
    df = spark.createDataFrame(AUDIT_ROWS, schema).withColumns({c: F.lit(1) for c in ("term", "n", "v", "c", "p", "item")})
    assert sorted(map(tuple, divergence.audit(df).collect())) == plain_audit(AUDIT_ROWS)
    assert divergence.audit(df.limit(0)).collect() == []
    rng = np.random.RandomState(0)
    rows = [(" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in rng.zipf(1.3, 60) % 500), f"l{i % 2}", f"s{rng.randint(6) % 5}") for i in range(200)]
    for top in (1, 7, 200):
        assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, schema), top=top).collect())) == plain_audit(rows, top)
    monkeypatch.setattr(divergence, "PART_POSTINGS", 40)  # many parts, whose sums meet
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, schema)).collect())) == plain_audit(rows)


def test_bounds_leave_most_terms_unevaluated(spark):
    rng = np.random.RandomState(1)
    rows = [(" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in rng.zipf(1.2, 400) % 9000), "l", f"s{i % 3}") for i in range(60)]
    posts, groups = divergence.postings(spark.createDataFrame(rows, "text string, lang string, source string"))
    found = divergence.top_terms(posts, groups, 5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 15 and "bound" in plan and "kth" in plan


def plain_top(rows, k=5):
    v = [(i, r[0], [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, a, q in v:
        if a is not None and a % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(q, e)), b is None, b or 0, j, b) for j, b, e in v if j != i and len(e) == len(q))[:k]
            out += [(a, n + 1, x[4], max(-(2**63), min(2**63 - 1, -x[0]))) for n, x in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("n,shard_values", [(300, 1 << 20), (500, 1500)])
def test_top_k_equals_brute_force_on_odd_rows(spark, n, shard_values):
    rng = np.random.RandomState(1)
    rows = [(i, [float(x) for x in rng.randn(8) * 0.3]) for i in range(n)]
    rows += [(i, rows[3][1]) for i in range(1000, 1200)]  # copies
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] * 8), (2150, [1e30] * 8), (2151, [-1e30, 1e30] + [0.0] * 6), (2152, [2.0**40] * 8), (2200, []), (2201, []), (2250, [1.0, 2.0]), (2300, [0.0] * 8), (None, [0.1] * 8), (50, [5.0] * 8), (50, [5.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("rid", "id", "body", "qid", "dim", "mine")})
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, shard_values=shard_values)
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(df, F.lit(False)).collect() == []


def test_bounds_leave_out_far_blocks_and_lose_nothing():
    rng = np.random.RandomState(2)
    centres = rng.randn(40, 16)
    x = np.floor(256 * (centres[rng.randint(40, size=4000)] + 0.05 * rng.randn(4000, 16))).astype("f8")
    x = x[topk._neighbours(x, 64)]
    cuts = list(range(0, 4000, 64))
    start = np.array([*cuts, 4000])
    most, least = (np.stack([f(x[c : c + 64], axis=0) for c in cuts]) for f in (np.max, np.min))
    q = x[::100]
    row, col, score, looked = topk.block_search(q, [None] * len(q), most, least, x, start, np.arange(4000), 5)
    assert looked < 0.35 * len(q) * len(cuts)
    want = [(i, -s, j) for i in range(len(q)) for s, j in sorted((-int(s), j) for j, s in enumerate(x @ q[i]))[:5]]
    assert list(zip(row.tolist(), [int(s) for s in score], col.tolist())) == want


def test_chunks_of_any_size_and_odd_languages_count_alike(spark, monkeypatch):
    rows = [(f"{w} the cat sat on the mat. a b, the cat", lang) for i in range(40) for w, lang in ((f"w{i % 3}", ""), (f"v{i}", "a b"), ("x", "zz"), ("y", None))]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    monkeypatch.setattr(phrases, "make_chunks", lambda d, order, text: phrases_chunks(d, order, text, 200))
    assert sorted(map(tuple, phrases.collocations(df, least=5).collect())) == plain_phrases(rows, 5, 50, 2000, 3)


phrases_chunks = phrases.make_chunks


def test_equal_hashes_of_unequal_ngrams_are_told_apart(monkeypatch):
    import pyarrow as pa

    from corpusflow.llm.chunks import to_body

    texts, langs, times = ["a b c d", "x y", "a b", "c d c d", "zz"], ["en", "en", "de", "en", "de"], [1, 2, 3, 1, 5]
    body = to_body(pa.table({"lang": langs, "piece": pa.array([x.encode() for x in texts], pa.binary()), "starts": pa.array([len(x.split()) for x in texts], pa.int32()), "times": pa.array(times, pa.int64())}))
    want = Counter()
    for lang, words, n in zip(langs, map(str.split, texts), times):
        want.update({(lang, k, " ".join(words[i : i + k])): 0 for k in (1, 2, 3) for i in range(len(words) - k + 1)})
        for k in (1, 2, 3):
            for i in range(len(words) - k + 1):
                want[lang, k, " ".join(words[i : i + k])] += n

    def counted():
        g, out = phrases._Grams(body, 3), Counter()
        for k, lang, first, weight in g.counts(np.ones(len(g.distinct), dtype=bool)):
            for f, n in zip(first, weight):
                out[g.langs.dictionary.to_pylist()[lang], k, g.data.tobytes()[g.start[f] : g.end[f + k - 1]].decode()] += int(n)
        return out

    assert counted() == want
    hashes = phrases._Grams.hashes
    monkeypatch.setattr(phrases._Grams, "hashes", lambda self, k, seed: hashes(self, k, seed) if seed else hashes(self, k, seed) & np.uint64(3))
    assert counted() == want
