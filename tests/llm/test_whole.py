"""Cases in which an operator once did less than the whole job."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from corpusflow.llm import language, lmscore, media, mixing, neardup, packing, warc


def test_cross_entropy_counts_each_of_many_pairs(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.3)), 3000)}" for _ in range(200))) for i in range(150)]
    target = {i for i, _ in rows if i % 4 == 0}
    got = lmscore.cross_entropy(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i,) for i in target], "doc_id long"), chunk_bytes=20_000, weights=np.full((2, lmscore.CLASSES), lmscore.BIGRAM)).collect()
    words, context, pairs = ({"b": Counter(), "t": Counter()} for _ in range(3))
    for i, text in rows:
        split = text.split()
        for m in ("b", "t") if i in target else ("b",):
            words[m].update(split)
            context[m].update(["^", *split[:-1]])
            pairs[m].update(zip(["^", *split[:-1]], split))
    assert len(pairs["b"]) > 10_000 and len(got) == len(rows)
    texts, vocabulary = dict(rows), len(words["b"])
    for r in got:
        split, want = texts[r["doc_id"]].split(), []
        for m, own in ("t", r["in_target"]), ("b", True):
            n = sum(words[m].values())
            unigram = [(words[m][w] - own + lmscore.ADD) / (n - own + lmscore.ADD * vocabulary) for w in split]
            seen = [context[m][c] - own for c in ["^", *split[:-1]]]
            ratio = [(pairs[m][p] - own) / max(s, 1) for p, s in zip(zip(["^", *split[:-1]], split), seen)]
            want.append(np.mean([-math.log2(lmscore.BIGRAM * x + (1 - lmscore.BIGRAM) * u if s > 0 else u) for x, u, s in zip(ratio, unigram, seen)]))
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(tuple(want))


def test_near_duplicates_of_an_id_whose_hash_is_zero(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(neardup, "FILTER_BITS", 64)
    spot = F.pmod(F.xxhash64("id"), F.lit(64))
    zero = spark.range(10_000).where(spot == 0).first()["id"]
    last = spark.range(10_000).where(spot == 63).first()["id"]
    words = [f"w{i}" for i in range(200)]
    rows = [(zero, " ".join(words)), (last, " ".join([*words[:-1], "other"])), (20_000, "a text of its own " * 9)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_copies"]) for r in got} == {zero: (min(zero, last), 2), last: (min(zero, last), 2), 20_000: (20_000, 1)}


def test_tokens_of_texts_that_hold_a_special_token():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, got = Tokenizer.from_file(path), packing.Tokens(path)
    assert got.fast is not None
    texts = ["one", "a <|endoftext|> b", "<|endoftext|>", "", "<|endoftext|><|endoftext|>\n\nna\u00efve", "<|endoftext", "two words"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(want[2]) == 1
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got.encode(texts)] == want


def test_pages_of_filedesc_urls_are_pages(spark):
    same = "same payload " * 100
    rows = [(1, "filedesc://a", "x"), (2, "filedesc:b", same), (3, "http://h/", same), (4, "http://h/4", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r["key"]: r for r in warc.read_archives(warc.archive_pages(pages)).where("record_type != 'warcinfo'").collect()}
    assert {k: (r["record_type"], r["target_uri"], r["refers_to_key"]) for k, r in got.items()} == {
        "1": ("response", "filedesc://a", None),
        "2": ("revisit", "filedesc:b", "3"),
        "3": ("response", "http://h/", None),
        "4": ("response", "http://h/4", None),
    }


def test_fingerprints_of_a_passage_shifted_by_half_a_frame():
    rng = np.random.default_rng(2)
    passage, before = (rng.integers(0, 256, n, dtype=np.uint8) for n in (256 * 40, 128))
    here, there = media.fingerprints(passage) & 0xFFFFFFFF, media.fingerprints(np.concatenate([before, passage])) & 0xFFFFFFFF
    assert np.mean(np.isin(here, there)) > 0.99


def test_fingerprints_pair_both_of_two_tones():
    t = np.arange(256 * 6)
    tones = (128 + 60 * np.sin(2 * np.pi * 32 * t / 256) + 40 * np.sin(2 * np.pi * 80 * t / 256)).astype(np.uint8)
    codes = media.fingerprints(tones)
    assert {((int(c) >> 16) & 0xFFFF, (int(c) >> 4) & 0xFFF) for c in codes} == {(a, b) for a in (32, 80) for b in (32, 80)}


def test_language_learns_from_long_texts(spark):
    rng = random.Random(4)
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [("short", text("abc d\n", 500)) for _ in range(5)] + [("long", text("xéz \n", 100_000))]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["long", "short"]
    odd = spark.createDataFrame([(1, "zéx xz"), (2, "ab cad")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.predict(odd, model).collect()} == {1: "long", 2: "short"}


def test_merges_of_the_file_follow_ranks(tmp_path):
    import json

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.merges_by_rank(path) and not packing.merges_by_rank(public_tokenizers.path("word_bpe_49k.json"))
    file = json.load(open(path, encoding="utf-8"))
    merges = file["model"]["merges"]
    file["model"]["merges"] = [merges[1], merges[0], *merges[2:]]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file), encoding="utf-8")
    assert not packing.merges_by_rank(str(other))
    assert packing.Tokens(path, fast=False).encode(["It's a naïve <|endoftext|> 12"]) == packing.Tokens(path).encode(["It's a naïve <|endoftext|> 12"])


def test_mix_of_repeated_rows_keeps_each_budget(spark):
    rows = [(i // 5, "one two three four", "s" if i % 2 else None) for i in range(40)] + [(None, "a b", "s")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    plan = {r["source"]: r for r in mixing.mix_plan(docs).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    got = Counter()
    for r in mixing.mix(docs).collect():
        got[r["source"]] += len(r["text"].split())
    assert got == {s: r["sum(taken)"] for s, r in plan.items()} and all(abs(r["sum(taken)"] - r["max(target)"]) <= 0.5 for r in plan.values())


def plain_peaks(samples):
    """The two strongest local maxima of each frame's spectrum, by sums over the definition of the transform."""
    n, hop = 256, 128
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / (n - 1)) for i in range(n)]
    waves = np.exp(-2j * np.pi * np.outer(np.arange(1, n // 2 + 1), np.arange(n)) / n)
    out = []
    for at in range(0, max(0, len(samples) - n + hop - 1) // hop * hop + 1, hop):
        frame = list(samples[at : at + n]) + [0] * max(0, n - len(samples[at : at + n]))
        mean = sum(frame) / n
        power = np.abs(waves @ np.array([(x - mean) * w for x, w in zip(frame, window)]))
        around = [0.0, *power, 0.0]
        tops = [(-power[k], k) for k in range(len(power)) if power[k] > around[k] and power[k] >= around[k + 2] and power[k] > power.mean() * 1.0001 + 1e-3]
        out.append([k + 1 for _, k in sorted(tops)[:2]])
    return out


def test_fingerprints_are_pairs_of_plain_peaks():
    rng = np.random.default_rng(5)
    tones = [128 + 60 * np.sin(2 * np.pi * a * np.arange(1200) / 256) + 40 * np.sin(2 * np.pi * b * np.arange(1200) / 256) for a, b in ((20, 70), (33, 90), (5, 110))]
    samples = np.concatenate([*tones, rng.integers(0, 256, 900)]).astype(np.uint8)
    peaks = plain_peaks(samples.tolist())
    want = {(t << 32) | (a << 16) | (b << 4) | gap for t, here in enumerate(peaks) for gap in range(1, 7) if t + gap < len(peaks) for a in here for b in peaks[t + gap]}
    got = set(media.fingerprints(samples).tolist())
    assert len(want) > 500 and len(got ^ want) <= 0.02 * len(want)


def test_cross_entropy_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b a b c", 0.5), (1, "a b a b c", 0.5), (None, "a b x", 0.1), (2, None, 0.2), (3, "word " * 50_000, 0.3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = lmscore.cross_entropy(frame, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["in_target"]) for r in got) == [("1", 5, True), ("1", 5, True), ("2", 0, False), ("3", 50_000, False), ("None", 3, False)]
    first, second = [r for r in got if r["doc_id"] == 1]
    assert first == second and all((r["score"] is None) == (r["doc_id"] == 2) for r in got)


def test_substrings_ask_for_integer_ids(spark):
    from corpusflow.llm import substrings

    with pytest.raises(TypeError, match="doc_id is an integer"):
        substrings.remove_repeats(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
    empty = substrings.remove_repeats(spark.createDataFrame([(None, "x " * 40), (None, "x " * 40), (7, None)], "doc_id int, text string")).collect()
    assert sorted(r["n_removed"] for r in empty) == [0, 39, 40]


def test_chunks_and_shards_grow_with_the_square_root():
    from corpusflow.llm import chunks

    assert chunks.shard_bits(1 << 27) == (29, 6) and chunks.shard_bits(1 << 31)[1] == 9 and chunks.shard_bits(1 << 35)[1] == 12


def test_bigram_weights_are_fitted_on_held_out_words(spark):
    """The fitted weights beat the fixed one; the next test holds them against a plain loop's."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    after = {w: rng.sample(vocabulary, 3) for w in [*vocabulary, "^"]}
    rows = []
    for i in range(200):
        words, last = [], "^"
        for _ in range(rng.randint(5, 60)):
            last = rng.choice(after[last]) if rng.random() < (0.9 if i % 3 else 0.5) else rng.choice(vocabulary)
            words.append(last)
        rows.append((i, " ".join(words)))
    docs, target = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i,) for i in range(0, 200, 3)], "doc_id long")
    fitted = {r["doc_id"]: r for r in lmscore.cross_entropy(docs, target).collect()}
    fixed = {r["doc_id"]: r for r in lmscore.cross_entropy(docs, target, weights=np.full((2, lmscore.CLASSES), lmscore.BIGRAM)).collect()}
    bits = lambda rows, c, of: sum(rows[i][c] * rows[i]["n_words"] for i in of)
    assert bits(fitted, "background_loss", range(200)) < bits(fixed, "background_loss", range(200))
    assert bits(fitted, "target_loss", range(0, 200, 3)) < bits(fixed, "target_loss", range(0, 200, 3))


def test_bigram_weights_are_fitted_on_all_words(spark, monkeypatch):
    """However many words there are, the weights are those that a plain loop over every word finds."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    after = {w: rng.sample(vocabulary, 3) for w in [*vocabulary, "^"]}
    rows = []
    for i in range(200):
        words, last = [], "^"
        for _ in range(rng.randint(5, 60)):
            last = rng.choice(after[last]) if rng.random() < (0.9 if i % 3 else 0.5) else rng.choice(vocabulary)
            words.append(last)
        rows.append((i, " ".join(words)))
    got, fit = [], lmscore.held_out_weights
    monkeypatch.setattr(lmscore, "held_out_weights", lambda *a: got.append(fit(*a)) or got[-1])
    docs, target = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i,) for i in range(0, 200, 3)], "doc_id long")
    assert lmscore.cross_entropy(docs, target, chunk_bytes=5_000).count() == 200
    for model, kept in enumerate((range(0, 200, 3), range(200))):
        texts = [["^", *rows[i][1].split()] for i in kept]
        words, contexts = Counter(w for t in texts for w in t[1:]), Counter(w for t in texts for w in t[:-1])
        pairs = Counter(p for t in texts for p in zip(t, t[1:]))
        seen = [(pairs[a, b] - 1, contexts[a] - 1, (words[b] - 1) / sum(words.values())) for t in texts for a, b in zip(t, t[1:])]
        of = {}
        for p, c, u in seen:
            if c and u:
                of.setdefault(min(int(math.log2(c)), lmscore.CLASSES - 1), []).append((p / c, u))

        def climb(held):
            w = lmscore.BIGRAM
            for _ in range(40):
                w = sum(w * r / (w * r + (1 - w) * u) for r, u in held) / len(held)
            return min(max(w, 0.001), 0.999)

        whole = climb([x for xs in of.values() for x in xs])
        want = [climb(of[k]) if len(of.get(k, ())) >= 50 else whole for k in range(lmscore.CLASSES)]
        assert len({round(x, 3) for x in want}) > 2 and np.allclose(got[0][model], want, rtol=0, atol=1e-5), (got[0][model], want)
