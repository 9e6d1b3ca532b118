"""Cross-entropy difference of two matched n-gram models.

Target and background are interpolated bigram models of the same order, smoothing and vocabulary: the
words of the background, which is all texts. A document's score is the mean over its words of the
target's loss less the background's, so low means close to the target. Counts are gathered by chunks
from all texts (see chunks.py), by 64-bit hashes of words and word pairs; each word is scored without
its own occurrence, in the background, and in the target where the document belongs to it, so no text
is scored by what it brought itself.

The weight of the bigram depends on how often its context occurs, by powers of two. It is fitted for each model on
all of its words, each held out: under counts of all texts that leave out its own occurrence; a word that occurs nowhere else
says nothing of the weight. A word matters to the fit only by its class and by the quotient of its two
probabilities, so every word is counted in a bin of that quotient, 1 / BINS_AN_OCTAVE octaves wide, and a bin stands for the mean of its words' logarithms: that moves the share of the bigram in a bin's words by less than 0.000002.

Cases: null and empty texts have no words and null losses; a document labelled more than once is
of the target if any label says so; without a target document the target's model is uniform over the
vocabulary; repeated rows count and are scored each; a null doc_id is scored and never of the target; very long texts are
whole, in chunks of their own; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import chunks as C
from corpusflow.llm.common import arrow_schema, save
from corpusflow.llm.hashing import GOLDEN, U64, join_blobs, mix, pack_bits, pack_ints, pack_sorted, split_blobs, unpack_bits, unpack_ints, unpack_sorted, word_hashes

#: The bigram's weight before it is fitted and where there is nothing to fit it on, what is added to a word's count, and the classes of contexts by count.
BIGRAM, ADD, CLASSES = 0.6, 0.5, 12
#: Bins of words by the quotient of their two probabilities: octaves to both sides of 1, bins an octave, and parts of a bin.
OCTAVES, BINS_AN_OCTAVE, BIN_PARTS = 44, 64, 1 << 20
#: Bins of a class: the first is for words whose pair occurs nowhere else.
BINS = 2 * OCTAVES * BINS_AN_OCTAVE + 1


class _Grams:
    """Keys of a chunk: 64-bit hashes of its words and word pairs, in one hash space. The start of a text is a
    word before its first, counted once a text but no word of the vocabulary."""

    def __init__(self, table: pa.Table, in_target: np.ndarray):
        words, self.at = word_hashes(table["text"])
        n = np.diff(self.at)
        self.n, self.in_target = n, in_target
        self.target = np.repeat(in_target, n)
        opens = self.at[:-1][n > 0]
        before = np.empty_like(words)
        before[:1], before[1:] = 0, words[:-1]
        before[opens] = 0
        word = mix(words + GOLDEN)
        context = mix(before + GOLDEN)
        pair = mix(mix(before ^ U64(2)) * GOLDEN + words)
        start = np.full(len(opens), mix(np.zeros(1, dtype=U64) + GOLDEN)[0])
        # contexts are words or starts, so they only need a place among the keys
        self.keys, inverse = np.unique(np.concatenate([word, pair, start]), return_inverse=True)
        self.word, self.pair = inverse[: len(words)], inverse[len(words) : 2 * len(words)]
        self.context = np.searchsorted(self.keys, context)
        self.is_word = np.zeros(len(self.keys), dtype=bool)
        self.is_word[self.word] = True
        self.background = np.bincount(inverse, minlength=len(self.keys))
        of_target = np.concatenate([self.target, self.target, in_target[n > 0]])
        self.of_target = np.bincount(inverse, weights=of_target, minlength=len(self.keys)).astype(np.int64)
        # a word that ends a text opens no pair there
        last = self.word[self.at[1:][n > 0] - 1]
        self.ends = np.bincount(last, minlength=len(self.keys))
        self.ends_of_target = np.bincount(last, weights=in_target[n > 0], minlength=len(self.keys)).astype(np.int64)


def context_class(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), CLASSES - 1)


def fit_quotients(quotient: np.ndarray, times: np.ndarray, classes: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The weights, by class of context, under which words are likeliest that have these quotients of bigram and unigram so
    many times, by expectation maximisation; classes of under 50 words have the weight of all classes together."""

    def climb(q, n):
        w = BIGRAM
        for _ in range(rounds if len(q) else 0):
            w = float(np.sum(n * (w * q / (w * q + (1 - w)))) / np.sum(n))
        return min(max(w, 0.001), 0.999)

    whole = climb(quotient, times)
    return np.array([climb(quotient[classes == k], times[classes == k]) if times[classes == k].sum() >= 50 else whole for k in range(CLASSES)])


def bin_words(pair: np.ndarray, word: np.ndarray, context: np.ndarray, n: int) -> np.ndarray:
    """(words, parts of a bin beyond its start) x class x bin, of words with these counts."""
    kept = (context > 0) & (word > 0)
    pair, word, context = pair[kept], word[kept], context[kept]
    with np.errstate(divide="ignore"):
        place = np.clip((np.log2(pair * (n / word) / context) + OCTAVES) * BINS_AN_OCTAVE, 0, BINS - 1.5)
    whole = np.floor(place)
    at = context_class(context) * BINS + np.where(pair > 0, whole.astype(np.int64) + 1, 0)
    parts = np.where(pair > 0, np.floor((place - whole) * BIN_PARTS), 0)
    counts = [np.bincount(at, minlength=CLASSES * BINS), np.bincount(at, weights=parts, minlength=CLASSES * BINS)]
    return np.array(counts).astype(np.int64).reshape(2, CLASSES, BINS)


def fit_bins(sums: np.ndarray) -> np.ndarray:
    """The weights of words that bin_words() has counted."""
    classes, at = np.nonzero(sums[0])
    times, parts = sums[0][classes, at], sums[1][classes, at]
    quotient = np.where(at > 0, 2.0 ** ((at - 1 + parts / times / BIN_PARTS) / BINS_AN_OCTAVE - OCTAVES), 0.0)
    return fit_quotients(quotient, times, classes)


def held_out_weights(counted: DataFrame, counts_of: Callable[[dict], tuple], total: int) -> np.ndarray:
    """Weights (target, background) x class, fitted on all words of the chunks; counts_of: as in cross_entropy."""

    def count(batches):
        """The bins of all chunks of a task, by how often the words' pairs, the words and their contexts occur elsewhere."""
        sums = np.zeros((2, 2, CLASSES, BINS), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("chunk", "body", "targets", "counts")}
                _, g, c, _, target_words = counts_of(row)
                for model, of, n in ((1, g.target, target_words), (0, slice(None), total)):
                    opens = c[model] - c[model + 2]
                    pair, word, context = (np.maximum(x - 1, 0) for x in (c[model][g.pair[of]], c[model][g.word[of]], opens[g.context[of]]))
                    sums[1 - model] += bin_words(pair, word, context, max(1, n))
        for model in (0, 1):
            parts = [(k, pack_ints(x.astype(U64))) for k, x in enumerate(np.array_split(sums[model].reshape(-1), 8))]
            yield pa.RecordBatch.from_arrays([pa.array([model] * 8, pa.int32()), pa.array([k for k, _ in parts], pa.int64()), pa.array([x for _, x in parts], pa.binary())], names=["model", "part", "counts"])

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [int(key[0])], "part": [int(key[1])], "counts": [pack_ints(sum(unpack_ints(x) for x in frame["counts"]))]})

    found = counted.mapInArrow(count, "model int, part long, counts binary").groupBy("model", "part").applyInPandas(merge, "model int, part long, counts binary")
    rows = sorted(save(found, "held-out", tidy=True).collect(), key=lambda x: (x["model"], x["part"]))  # 16 rows
    out = []
    for model in (0, 1):
        blobs = [unpack_ints(bytes(x["counts"])) for x in rows if x["model"] == model]
        sums = np.concatenate(blobs).astype(np.int64) if blobs else np.zeros(2 * CLASSES * BINS, dtype=np.int64)
        out.append(fit_bins(sums.reshape(2, CLASSES, BINS)))
    return np.array(out)


def cross_entropy(docs: DataFrame, target: DataFrame, chunk_bytes: int | None = None, weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_words, in_target, target_loss, background_loss, score) for each row of docs (doc_id, text).

    target: the doc_ids (one column, doc_id) of the documents that the target model learns from.
    Losses are mean bits a word; score = target_loss - background_loss. weights: (target, background) x CLASSES, fitted if None.
    """
    ids = target.select("doc_id").where("doc_id is not null").distinct()
    chunks = C.make_chunks(docs.select("doc_id", "text"), chunk_bytes=chunk_bytes)
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    _, shard_bits = C.shard_bits(2 * total)
    edges = np.arange(1, 1 << shard_bits, dtype=U64) << U64(64 - shard_bits)
    places = chunks.select("chunk", F.posexplode("ids").alias("place", "doc_id")).join(ids, "doc_id", "left_semi")
    targets = save(places.groupBy("chunk").agg(F.sort_array(F.collect_list("place")).alias("targets")), "targets")
    bodies = chunks.select("chunk", "body").join(targets, "chunk", "left")

    def load(row: dict) -> tuple[pa.Table, _Grams, list[tuple[int, slice]]]:
        table = C.from_body(row["body"])
        in_target = np.zeros(len(table), dtype=bool)
        in_target[np.array(row["targets"] or [], dtype=np.int64)] = True
        g = _Grams(table, in_target)
        cuts = np.concatenate([[0], np.searchsorted(g.keys, edges), [len(g.keys)]])
        return table, g, [(s, slice(a, b)) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]

    def send(row: dict):
        """To every shard, as each tells its share of the vocabulary; the number of target words goes along."""
        _, g, parts = load(row)
        words = int(g.n[g.in_target].sum()).to_bytes(8, "little")
        for s, p in parts:
            base = U64(s << (64 - shard_bits))
            counts = [pack_ints(c[p].astype(U64)) for c in (g.background, g.of_target, g.ends, g.ends_of_target)]
            yield s, join_blobs([pack_sorted(g.keys[p] - base), pack_bits(g.is_word[p]), words, *counts])

    def reply(shard: int, blobs: list[bytes], _) -> list[bytes]:
        keys, is_word, counts, words = [], [], [[] for _ in range(4)], 0
        for blob in blobs:
            k, w, n, *some = split_blobs(blob)
            keys.append(unpack_sorted(k))
            is_word.append(unpack_bits(w, len(keys[-1])))
            for all_of, c in zip(counts, some):
                all_of.append(unpack_ints(c))
            words += int.from_bytes(n, "little")
        sizes = np.cumsum([len(k) for k in keys])[:-1]
        keys, is_word = np.concatenate(keys), np.concatenate(is_word)
        order = np.argsort(keys, kind="stable")  # runs that are sorted
        ordered = keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first, rank = np.flatnonzero(new), np.empty(len(keys), dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        ranks = np.split(rank, sizes)
        sums = [np.add.reduceat(np.concatenate(c)[order], first) if len(first) else np.empty(0, dtype=U64) for c in counts]
        is_word = np.logical_or.reduceat(is_word[order], first) if len(first) else is_word
        told = int(is_word.sum()).to_bytes(8, "little") + words.to_bytes(8, "little")
        return [join_blobs([told, *[pack_ints(c[r]) for c in sums]]) for r in ranks]

    def counts_of(row: dict) -> tuple[pa.Table, _Grams, np.ndarray, int, int]:
        """A chunk's rows and keys; of the keys, over all texts, counts and ends in the background, the target; the vocabulary, the target's words."""
        table, g, parts = load(row)
        got = {x["shard"]: split_blobs(x["blob"]) for x in row["counts"]}
        vocabulary = sum(int.from_bytes(x[0][:8], "little") for x in got.values())
        target_words = int.from_bytes(next(iter(got.values()))[0][8:], "little")
        c = np.zeros((4, len(g.keys)))
        for s, p in parts:
            for k in range(4):
                c[k, p] = unpack_ints(got[s][1 + k])
        return table, g, c, vocabulary, target_words

    # the messages, most of the disk, go before the replies are read twice
    replies = save(C.exchange(bodies, send, reply), "replies", tidy=True)
    counted = C.with_replies(bodies, counts=replies).select("chunk", "body", "targets", "counts")
    weights = held_out_weights(counted, counts_of, total) if weights is None else np.asarray(weights)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, in_target boolean, target_loss double, background_loss double"
    fields = arrow_schema(schema)

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("body", "targets", "counts")}
                table, g, c, vocabulary, target_words = counts_of(row)
                b, t, b_opens, t_opens = c[0], c[1], c[0] - c[2], c[1] - c[3]
                background = word_loss(b[g.pair], b_opens[g.context], b[g.word], total, vocabulary, 1, weights[1])
                in_target = word_loss(t[g.pair], t_opens[g.context], t[g.word], target_words, vocabulary, g.target.astype(np.int64), weights[0])
                sums = [np.diff(np.concatenate([[0.0], np.cumsum(x)])[g.at]) / np.maximum(g.n, 1) for x in (in_target, background)]
                cols = [table["doc_id"].combine_chunks(), pa.array(g.n), pa.array(g.in_target), *[pa.array(x, mask=g.n == 0) for x in sums]]
                yield from pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, fields)], schema=fields).to_batches(max_chunksize=5000)

    scored = counted.select("body", "targets", "counts").mapInArrow(score, schema)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def word_loss(pair, context, word, n: int, vocabulary: int, own, weights: np.ndarray) -> np.ndarray:
    """Bits of each word under counts that leave out its own occurrence (own: 1 where it has one); weights: by class of context."""
    unigram = (np.maximum(word - own, 0) + ADD) / (np.maximum(n - own, 0) + ADD * max(vocabulary, 1))
    seen = np.maximum(context - own, 0)
    ratio = np.maximum(pair - own, 0) / np.maximum(seen, 1)
    weight = np.where(seen > 0, weights[context_class(seen)], 0.0)
    return -np.log2(weight * ratio + (1 - weight) * unigram)
