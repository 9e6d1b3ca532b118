"""Plain versions that share no code with the library."""

import math
import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def tf_idf(texts, size=5):
    """Per text its shingles' weights, with idf = 1 + ln(N / df) / ln(N)."""
    grams = []
    for t in texts:
        words = WORDS.findall(t or "")
        grams.append(Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter())
    df, n = Counter(g for c in grams for g in c), len(texts)
    return [{g: k * (1 + math.log(n / df[g]) / math.log(n) if n > 1 else 1) for g, k in c.items()} for c in grams]


def jaccard(a, b):
    both = sum(min(w, b[g]) for g, w in a.items() if g in b)
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def similar_pairs(texts, threshold=0.8, queries=None):
    """Pairs (i, j), i > j, of texts that are that similar; queries: only pairs with one of these."""
    weights = tf_idf(texts)
    having = {}
    for i, w in enumerate(weights):
        for g in w:
            having.setdefault(g, []).append(i)
    out = set()
    for i in range(len(texts)) if queries is None else queries:
        for j in {j for g in weights[i] for j in having[g]} - {i}:
            if jaccard(weights[i], weights[j]) >= threshold:
                out.add((max(i, j), min(i, j)))
    return sorted(out)
