"""Operators on documents against plain versions, on rows that hold every odd case."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from corpusflow.llm import language, media, mixing, packing, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fixture_rows(n=60, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 12)))
    passages = [[word() for _ in range(25)] for _ in range(4)]
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            k = rng.randint(0, len(words))
            words[k:k] = rng.choice(passages)
        rows.append((rng.randint(0, 10**12), rng.choice(["\n", " ", "  ", "\t"]).join(words), rng.choice(["xx", "yy", None]), rng.choice(["s1", "s2", "s3", None]), 0))
    rows += [(rows[0][0], rows[0][1], "xx", "s1", 1), rows[1], (5, None, "xx", "s1", None), (6, "", None, None, 0), (7, " \n ", "yy", "s2", 3), (None, "lone words without an id", "xx", "s9", 4)]
    rows.append((8, " ".join(word() for _ in range(30_000)), "xx", "s1", 2))
    rows.append((9, "12 34 ! ?", "xx", "s1", 2))
    rows.append((10, "same " * 100, "yy", "s2", 2))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_words long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_repeats(rows, size):
    """Removed words of each row; rows of one id are told apart by their text's order of appearance."""
    split = [(r[0], WORDS.findall(r[1] or "")) for r in rows]
    first = {}
    for d, words in split:
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            first[key] = min(first.get(key, (10**20, 0)), (-1 if d is None else d, i))
    out = defaultdict(list)
    for d, words in split:
        gone = np.zeros(len(words), dtype=bool)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] != (-1 if d is None else d, i):
                gone[i : i + size] = True
        out[d].append((len(words), int(gone.sum()), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


@pytest.mark.parametrize("chunk_bytes", [400, 1 << 20])
def test_substrings_equal_brute_force(docs, chunk_bytes):
    unique = list({r[0]: r for r in fixture_rows()}.values())
    frame = docs.sparkSession.createDataFrame(unique, SCHEMA).repartition(3)
    got = substrings.remove_repeats(frame, chunk_bytes=chunk_bytes).collect()
    want = brute_repeats(unique, 20)
    assert len(got) == len(unique)
    for r in got:
        n, gone, kept = want[r["doc_id"]][0]
        assert (r["n_words"], r["n_removed"]) == (n, gone)
        assert r["text"] == (None if r["text"] is None else kept)
    assert any(r["n_removed"] for r in got)


def test_substrings_repeated_rows_and_empty(docs, empty):
    rows = [(1, " ".join(map(str, range(30))), "a", "b", 0)] * 3
    got = substrings.remove_repeats(docs.sparkSession.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 30, 30]
    assert substrings.remove_repeats(empty).collect() == []


def test_packing_places_every_piece(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(docs).collect()
    want = defaultdict(int)
    for r in fixture_rows():
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))] += 1
    have = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        have[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(k[3] * n for k, n in want.items()) // 1024) + 2
    assert packing.pack(empty).collect() == []


def test_plan_is_gapless_and_close_to_the_bound():
    rng = random.Random(5)
    for capacity in (7, 30, 100):
        counts = defaultdict(int)
        for _ in range(300):
            counts[rng.randint(1, capacity)] += 1
        runs, n = packing.plan_sequences(dict(counts), capacity)
        filled = defaultdict(int)
        for s, rs in runs.items():
            ranks = 0
            for k, (rank, first, each, _) in enumerate(rs):
                stop = rs[k + 1][0] if k + 1 < len(rs) else counts[s]
                for i in range(stop - rank):
                    filled[first + i // each] += s
                ranks += stop - rank
            assert ranks == counts[s]
        assert len(filled) == n and max(filled.values()) <= capacity
        large = sum(c for s, c in counts.items() if 2 * s > capacity)
        assert n <= max(large, sum(s * c for s, c in counts.items()) / capacity) * 1.1 + 1


def test_language_learns_and_marks_und(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    hold = language.held_out(docs["doc_id"])
    model = language.train(docs.where(~hold))
    got = language.predict(docs.where(hold), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "12 !", 3), (4, "é", 3), (5, "the and " * 200_000, 3)], "doc_id long, text string, score int")
    pred = {r["doc_id"]: r["lang_pred"] for r in language.predict(odd, model).collect()}
    assert [pred[i] for i in (1, 2, 3)] == ["und"] * 3 and pred[4] != "und" and pred[5] == "en"
    assert language.predict(empty, model).collect() == []
    nothing = language.train(empty)
    assert {r["lang_pred"] for r in language.predict(odd, nothing).collect()} == {"und"}


def test_language_costs_equal_a_plain_tree():
    texts = {"a": [b"abracadabra", b"abra"], "b": [b"banana band", "\u043f\u0440\u0438\u0432\u0435\u0442 \u4e2d\u6587".encode()]}
    model = language.fit(texts)

    def cost(lang, text):
        counts = [defaultdict(lambda: defaultdict(int)) for _ in range(4)]
        for t in texts[lang]:
            s = [0] * 3 + list(t)
            for i in range(3, len(s)):
                for k in range(4):
                    counts[k][tuple(s[i - k : i])][s[i]] += 1

        def p(k, context, x):
            seen = counts[k].get(tuple(context[3 - k :]), {})
            n, d = sum(seen.values()), len(seen)
            if k == 0:
                return (seen.get(x, 0) + 0.5) / (n + 0.5 * 256)
            lower = p(k - 1, context, x)
            return lower if not n else seen[x] / (n + d) if x in seen else d / (n + d) * lower

        s, total = [0] * 3 + list(text), 0.0
        for i in range(3, len(s)):
            total -= np.log2(p(3, s[i - 3 : i], s[i]))
        return total

    import pyarrow as pa

    for block in (3, 1 << 19):
        language.BLOCK, old = block, language.BLOCK
        some = ["abba", "", "banana", "zz", "\u043f\u0440\u0438\u4e2d"]
        got, _ = language.code_lengths(model, pa.array(some))
        language.BLOCK = old
        for i, t in enumerate(some):
            assert np.allclose(got[i], [cost("a", t.encode()), cost("b", t.encode())], rtol=1e-5)


def test_language_knows_every_label_and_alphabet(spark):
    """More languages than any cap of old, in several scripts, each learned and told apart."""
    rng = random.Random(4)
    rows = []
    for lang in range(90):
        base = [0x61, 0x430, 0x3B1, 0x4E00, 0xAC00][lang % 5]
        own = [chr(base + x) for x in rng.sample(range(300 if base > 0x4000 else 24), 9)]
        rows += [(90 * k + lang, " ".join("".join(rng.choice(own) for _ in range(5)) for _ in range(60)), f"l{lang:02d}") for k in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.train(frame.where("doc_id < 450"))
    assert model.languages == [f"l{i:02d}" for i in range(90)]
    got = language.predict(frame.where("doc_id >= 450"), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    small = language.train(frame.where("doc_id < 450"), fit_bytes=1, fit_total=90)
    assert small.languages == model.languages


def test_mix_takes_each_budget(docs, empty):
    got = mixing.mix_plan(docs).collect()
    assert len(got) == len(fixture_rows())
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [3, 1, 2] * 9))
    left, total, want = set(sizes), 1.5 * sum(sizes.values()), {}
    while left:
        level = (total - sum(want.values())) / sum(weights[s] for s in left)
        over = {s for s in left if level * weights[s] > 2 * sizes[s]}
        if not over:
            want |= {s: level * weights[s] for s in left}
            break
        want |= {s: 2.0 * sizes[s] for s in over}
        left -= over
    for s in sizes:
        assert targets[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 0.5
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_plan(docs.repartition(2)).collect()), key=str)
    assert mixing.mix_plan(empty).collect() == []


def test_mix_repeats_and_cuts_texts(docs):
    plan = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix_plan(docs).collect()}
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    words = sum(len(WORDS.findall(r["text"] or "")) for r in got.collect())
    per_row = [plan[(r[0], len(WORDS.findall(r[1] or "")))] for r in fixture_rows()]
    assert abs(words - sum(per_row)) <= 0.01 * words


def test_media_round_trip(docs, empty):
    from pyspark.sql import functions as F

    payload = docs.select("doc_id", "text", F.col("n_words").alias("media"), F.coalesce("text", F.lit("")).alias("payload"))
    got = media.media_features(media.add_media(payload, "payload"), keep=("text",)).collect()
    for r in got:
        raw = (r["text"] or "").encode()
        raw += bytes((-len(raw)) % 64 or (0 if raw else 64))
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]))
        stored = media.encode_wav((r["text"] or "").encode())
        assert media.decode_wav(stored)[0] == raw and r["media_sha256"] == hashlib.sha256(stored).hexdigest()
    assert media.add_media(empty, "text").collect() == []
    bad = docs.sparkSession.createDataFrame([(b"noise",), (None,)], "media binary")
    assert {r["payload_bytes"] for r in media.media_features(bad).collect()} == {None}


def test_fingerprint_finds_a_tone():
    t = np.arange(256 * 6)
    tone = (128 + 100 * np.sin(2 * np.pi * 32 * t / 256)).astype(np.uint8)
    codes = media.fingerprints(tone)
    assert len(codes) and {(int(c) >> 16) & 0xFFFF for c in codes} == {32}
