"""Similarity joins and model scores against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import plain
from corpusflow.llm import components, embeddings, lmscore, neardup


def union(pairs, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == union(pairs, {x for p in pairs for x in p})
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for label in (1, 1, 1, 2, None):
        center = rng.normal(size=8)
        for _ in range(60):
            rows.append((rng.normal(size=8) * rng.choice([0.15, 0.4]) + center, label))
    rows += [(rows[0][0], 1)] * 3 + [(rows[0][0] * 1e200, 1), (np.zeros(8), 1), (np.array([np.nan] * 8), 1), (np.array([np.inf] + [1.0] * 7), 1), (np.ones(3), 1), (None, 2)]
    return [(i, None if v is None else [float(x) for x in v], label) for i, (v, label) in enumerate(rows)] + [(900, [1.0] * 7 + [None], 1)]


@pytest.mark.parametrize("cell_rows,block_rows", [(3, 7), (10, 4096), (40, 16), (4096, 4096), (4096, 50)])
def test_range_join_equals_brute_force(spark, cell_rows, block_rows):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, space string, pid int").repartition(3)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(frame, cell_rows=cell_rows, block_rows=block_rows).collect()}
    pairs = brute_links(rows)
    links, component = Counter(i for p in pairs for i in p), union([(rows[i][0], rows[j][0]) for i, j in pairs], [r[0] for r in rows])
    assert len(pairs) > 1000 and len(got) == len(rows)
    for i, r in enumerate(rows):
        r = got[r[0]]
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], component[rows[i][0]], component[rows[i][0]] == rows[i][0])


def brute_links(rows):
    """Pairs of places of rows (vec_id, vector, label) that link."""
    pairs = []
    for i, (a, v, x) in enumerate(rows):
        for j, (b, w, y) in enumerate(rows[:i]):
            if a is not None and b is not None and x is not None and x == y and v and w and len(v) == len(w) and None not in v + w and np.isfinite(v + w).all() and any(v) and any(w):
                v1, w1 = (np.array(z) / np.abs(z).max() for z in (v, w))
                if v1 @ w1 / np.sqrt((v1 @ v1) * (w1 @ w1)) >= 0.93:
                    pairs.append((j, i))
    return pairs


def test_range_join_of_repeated_ids_and_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (None, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (3, [0.1, 1.0], 1), (4, [0.0, 1.0], 2), (2, None, 1), (5, None, 1), (3, [1.0, 0.0], 2)]
    same = spark.createDataFrame(rows, schema)
    ids = [r[0] for r in rows]
    pairs = brute_links(rows)
    links = Counter(i for p in pairs for i in p)
    component = union([(ids[i], ids[j]) for i, j in pairs], [i for i in ids if i is not None]) | {None: None}
    got = embeddings.near_vectors(same, cell_rows=1).collect()
    assert Counter(map(tuple, got)) == Counter((v, links[i], component[v], v is None or component[v] == v) for i, v in enumerate(ids))
    assert component[3] == component[2] == 1 and links[2] == 2
    assert embeddings.near_vectors(same.limit(0)).collect() == []


def test_pivots_partition_and_the_inequality_sets_the_boundaries(spark):
    """Points lie once in the cell of their nearest pivot; far cells never meet, and no near pair is lost between cells."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1000, 16)) * 0.06 + np.repeat(rng.normal(size=(40, 16)), 25, axis=0)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    points = embeddings._pack(frame, "label").selectExpr("space", "digest", "vec_id as pid", "vec_id as rep", "1L as weight", "body").where("digest is not null")
    e = math.sqrt(2 - 2 * embeddings.THRESHOLD)
    located = {r["pid"]: (r["cell"], set(r["visits"])) for r in embeddings.locate(points, e, root=0.8).collect()}
    cells = {c for c, _ in located.values()}
    assert sorted(located) == list(range(1000)) and len(cells) > 20
    assert sum(1 + len(v) for _, v in located.values()) < 3 * len(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(0, 2 - 2 * unit @ unit.T))
    crossing = 0
    for i, j in np.argwhere(np.triu(d <= e, 1)).tolist():
        (a, va), (b, vb) = located[i], located[j]
        assert a == b or a in vb or b in va
        crossing += a != b
    assert crossing > 0
    # a point stays away from a cell all of whose points are further than its radius and e allow
    of = {c: [i for i in located if located[i][0] == c] for c in cells}
    met = {(min(a, c), max(a, c)) for a, v in located.values() for c in v}
    far = [(a, c) for a in cells for c in cells if a < c and d[np.ix_(of[a], of[c])].min() > 2 * e + 2 * max(d[np.ix_(of[a], of[a])].max(), d[np.ix_(of[c], of[c])].max())]
    assert far and not met & set(far)


@pytest.mark.parametrize("root,block_rows,wave", [(0.5, 60, 0.3), (1.0, 40, 5.0), (16.0, 70, 1.0)])
def test_cells_blocks_and_waves_count_each_pair_once(spark, root, block_rows, wave, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 8)), rng.normal(size=(150, 8)) * 0.12 + 1, rng.normal(size=(150, 8)) * 0.3 - 1])
    labels = [int(i % 7 == 0) for i in range(len(x))]
    frame = spark.createDataFrame([(i, v.tolist(), k) for (i, v), k in zip(enumerate(x), labels)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embeddings, "WAVE", wave)
    links = embeddings.cell_links
    monkeypatch.setattr(embeddings, "cell_links", lambda p, t, c, b: links(p, t, c, b, wave))
    got = {r["vec_id"]: r for r in embeddings.near_vectors(frame, cell_rows=20, block_rows=block_rows, root=root).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [p for p in np.argwhere(np.triu(unit @ unit.T >= embeddings.THRESHOLD, 1)).tolist() if labels[p[0]] == labels[p[1]]]
    n, component = Counter(i for p in pairs for i in p), union(pairs, range(len(x)))
    assert len(pairs) > 2000 and {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {i: (n[i], component[i]) for i in range(len(x))}


def test_vectors_without_structure_are_stored_about_once(spark):
    """What the join writes does not grow with its cells; groups meet once, and heads and margins lose no link."""
    from pathlib import Path

    from corpusflow.llm.common import collected

    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 64))
    x[1000:1250] = x[:250] + rng.normal(size=(250, 64)) * rng.choice([0.1, 0.4], size=(250, 1))
    x[1250:1300] = x[0] + rng.normal(size=(50, 64)) * 0.2
    x[1300:1310] = x[1]
    x = x.astype("<f4")
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(3)
    with collected() as paths:
        got = {r["vec_id"]: r for r in embeddings.near_vectors(frame, cell_rows=50, block_rows=400).collect()}
        written = sum(f.stat().st_size for p in paths for f in Path(p.removeprefix("file://")).rglob("*.parquet") if f.stat().st_size > 20_000)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    pairs = np.argwhere(np.triu(unit @ unit.T >= embeddings.THRESHOLD, 1)).tolist()
    links, component = Counter(i for p in pairs for i in p), union(pairs, range(len(x)))
    assert len(pairs) > 300 and {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {i: (links[i], component[i]) for i in range(len(x))}
    assert written < 1.5 * x.nbytes, written / x.nbytes


def texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    out = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 40, 200]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    hub = [word() for _ in range(120)]
    for i in range(60):  # many copies, none close to every other
        copy = list(hub)
        for k in range(4):
            copy[(i * 7 + 30 * k) % 120] = word()
        out.append("  ".join(copy))
    out += [out[0], out[0], None, None, "", " \n", "two words", "two words", "two  words", "other words"]
    return list(enumerate(out))


def plain_classes(rows):
    return union([(rows[i][0], rows[j][0]) for i, j in plain.similar_pairs([t for _, t in rows])], [r[0] for r in rows])


@pytest.mark.parametrize("chunk_bytes", [2_000, 1 << 20])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, chunk_bytes):
    rows = texts()
    frame = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, digest string").repartition(3)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    want = plain_classes(rows)
    got = neardup.near_duplicates(frame, chunk_bytes=chunk_bytes).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    sizes = Counter(want.values())
    for r in got:
        assert r["kept"] == (r["doc_id"] == r["class_id"]) and r["n_copies"] == sizes[r["class_id"]]
    assert neardup.near_duplicates(frame.limit(0)).collect() == []


def test_near_duplicates_find_nine_of_ten_copies(spark):
    """All links of a whole table by exhaustive comparison; exact copies do not count."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.collect())
    every = plain.similar_pairs([r["text"] for r in rows])
    classes = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    pairs = [(rows[i]["doc_id"], rows[j]["doc_id"]) for i, j in every if rows[i]["text"] != rows[j]["text"]]
    assert len(pairs) >= 10 and sum(classes[a] == classes[b] for a, b in pairs) >= 0.9 * len(pairs)
    whole = union([(rows[i]["doc_id"], rows[j]["doc_id"]) for i, j in every], [r["doc_id"] for r in rows])
    assert all(whole[i] == whole[c] for i, c in classes.items())


def test_near_duplicates_without_ids_and_with_repeats(spark):
    text = " ".join(map(str, range(40)))
    rows = [(None, text), (None, text), (1, text), (1, text), (1, text + " x"), (2, "other words"), (3, None), (3, None), (4, " ")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == {(None, None): 2, (1, 1): 3, (2, 2): 1, (3, 3): 2, (4, 4): 1}
    assert sum(r["kept"] for r in got if r["doc_id"] == 1) in (1, 2)
    assert neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == 7


def weighted(texts):
    import pyarrow as pa

    x = neardup.Shingles(pa.array(texts))
    return x.weighted(x.df[x.key], len(texts))


def test_similarity_is_weighted_jaccard():
    texts = ["a b c d e f g a b c d e", "a b c d e f x", "x y", "a b c d e"]
    x, y = weighted(texts), plain.tf_idf(texts)
    for i in range(4):
        assert np.allclose(sorted(x[i][1]), sorted(y[i].values()))
        for j in range(4):
            assert neardup.similarity(x[i], x[j]) == pytest.approx(plain.jaccard(y[i], y[j]))


def test_bands_meet_as_often_as_similarity_says():
    rng = random.Random(1)
    base = [str(rng.random()) for _ in range(300)]
    changed = base[:270] + [str(rng.random()) for _ in range(30)]
    a, b = weighted([" ".join(base), " ".join(changed)])
    s = neardup.similarity(a, b)
    keys = neardup.band_keys(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, len(a[0])]), bands=600)
    assert np.mean(keys[0] == keys[1]) == pytest.approx(s**3, abs=0.08)


def test_links_within_are_those_across_classes():
    rng = random.Random(3)
    base = [str(rng.random()) for _ in range(60)]
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(60)] = str(rng.random())
        texts.append(" ".join(copy))
    w, pairs = weighted(texts), plain.similar_pairs(texts)
    for classes in (list(range(40)), [i // 4 for i in range(40)]):
        found = neardup.links_within(list(range(40)), w, classes, 0.8)
        inside = [(i, j) for i in range(40) for j in range(i) if classes[i] == classes[j]]
        assert set(found) <= set(pairs) and union(found + inside, range(40)) == union(pairs + inside, range(40))
        found = neardup.links_within(list(range(40)), w, classes, 0.8, 10)
        across = [(i, j) for i, j in pairs if (i < 10) != (j < 10)]
        assert union(found + inside, range(40)) == union(across + inside, range(40))


def test_cross_entropy_equals_plain_counts(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("a b c dd ee ff".split()) for _ in range(rng.randint(0, 30)))) for i in range(40)] + [(50, None), (51, "")]
    target = {i for i in range(0, 40, 3)}
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in lmscore.cross_entropy(frame, spark.createDataFrame([(i,) for i in [*target, 0, 99, None]], "doc_id long"), chunk_bytes=300, weights=np.full((2, lmscore.CLASSES), 0.6)).collect()}
    assert len(got) == len(rows)
    words, context, pair, n = (defaultdict(Counter) for _ in range(4))
    for i, t in rows:
        before = "^"
        for w in (t or "").split():
            for m in ("b", "t") if i in target else ("b",):
                words[m][w] += 1
                context[m][before] += 1
                pair[m][before, w] += 1
                n[m][""] += 1
            before = w
    vocabulary = len(words["b"])

    def mean_loss(t, m, own):
        before, total = "^", 0.0
        for w in t:
            unigram = (words[m][w] - own + 0.5) / (n[m][""] - own + 0.5 * vocabulary)
            seen = context[m][before] - own
            weight = 0.6 if seen > 0 else 0
            total -= math.log2(weight * (pair[m][before, w] - own) / max(seen, 1) + (1 - weight) * unigram)
            before = w
        return total / len(t)

    for i, t in rows:
        r, t = got[i], (t or "").split()
        assert r["n_words"] == len(t) and r["in_target"] == (i in target)
        if t:
            want = mean_loss(t, "t", i in target), mean_loss(t, "b", True)
            assert (r["target_loss"], r["background_loss"]) == pytest.approx(want) and r["score"] == pytest.approx(want[0] - want[1])
        else:
            assert r["score"] is None
    assert lmscore.cross_entropy(frame.limit(0), frame.select("doc_id")).collect() == []
