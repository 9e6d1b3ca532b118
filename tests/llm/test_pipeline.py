"""The corpus pipeline against plain versions of its stages."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import plain  # noqa: E402

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    passage = [word() for _ in range(60)]
    out = []
    for i in range(40):
        words = [word() for _ in range(rng.choice([3, 60, 300]))]
        if i % 4 == 0:
            words[len(words) // 2 : len(words) // 2] = passage
        out.append((i, rng.choice([" ", "\n"]).join(words), rng.choice(["xx", "yy"]), rng.choice(["s1", "s1", "s2", None]), 1))
    for i in range(8):
        words = out[4 * i][1].split()
        words[len(words) // 3] = word()
        out.append((100 + i, " ".join(words), "xx", "s1", 1))
    out += [(200, out[1][1], "xx", "s3", 1), (201, None, "xx", "s1", 0), (202, "12 34", "xx", "s1", 5), (203, "", None, None, 0), (204, "long " + " ".join(word() for _ in range(3000)), "yy", "s2", 9)]
    return out


def plain_run(docs):
    docs = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    parent = {d[0]: d[0] for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in plain.similar_pairs([d[1] for d in docs]):
        a, b = root(docs[i][0]), root(docs[j][0])
        parent[max(a, b)] = min(a, b)
    docs = sorted(d for d in docs if root(d[0]) == d[0])
    first, kept = {}, []
    for d in docs:
        words = WORDS.findall(d[1])
        for i in range(len(words) - 19):
            first.setdefault(tuple(words[i : i + 20]), (d[0], i))
    for d in docs:
        words = WORDS.findall(d[1])
        gone = np.zeros(len(words), dtype=bool)
        for i in range(len(words) - 19):
            if first[tuple(words[i : i + 20])] != (d[0], i):
                gone[i : i + 20] = True
        if not gone.all():
            kept.append((d[0], d[1] if not gone.any() else " ".join(w for w, g in zip(words, gone) if not g), d[3]))
    size = {d[0]: len(WORDS.findall(d[1])) for d in kept}
    total = defaultdict(int)
    for d in kept:
        total[d[2]] += size[d[0]]
    weight = dict(zip(sorted(total, key=lambda s: (s is None, s or "")), [3, 1, 2] * 9))
    left, target = set(total), {}
    while left:
        level = (1.5 * sum(total.values()) - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > 2 * total[s]}
        target |= {s: 2.0 * total[s] for s in over} if over else {s: level * weight[s] for s in left}
        left = left - over if over else set()
    mixed = []
    for s in total:
        budget = int(np.floor(target[s] + 0.5))
        of = sorted((d for d in kept if d[2] == s), key=lambda d: hashlib.md5(f"mix:{d[0]}".encode()).hexdigest())
        epochs, rest = divmod(budget, total[s])
        for d in of:
            mixed += [(d[0], d[1])] * epochs
            part = max(0, min(size[d[0]], rest))
            rest -= part
            if part:
                mixed.append((d[0], d[1] if part == size[d[0]] else " ".join(WORDS.findall(d[1])[:part])))
    return mixed


def pieces(mixed):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for d, text in mixed:
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        out.update((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    return out


def test_run_equals_plain_stages(spark, tmp_path):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(tuple(r)[:5] for r in got) == pieces(plain_run(rows()))
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_keep_the_columns_and_nothing_comes_of_nothing(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "substring_dedup", "mix_sources", "best_fit_packing"]
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes) and out.collect() == [], name
