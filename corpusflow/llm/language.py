"""Language identification by prediction by partial matching.

Each language has a byte context tree up to order 3 with frozen counts and escapes of method C:
a byte seen after a context costs -log2 n(byte) / (n + distinct), any other the escape
-log2 distinct / (n + distinct) and its cost after the context one byte shorter. Every lang value has a tree of
its own, of all contexts and bytes that its sample holds. A text's four-byte strings are looked up once each, and its
cost is the sum over them.

The model is bounded by the bytes that it is fitted on: FIT_BYTES for each language, and FIT_TOTAL shared alike
where there are more languages than that allows. Each byte of them adds at most one entry to each order.

Cases: null texts and texts without a letter are `und` with score 0, as is every text when there is
nothing to learn from; a tie goes to the language that sorts first; repeated rows are scored alike, and learned
from once; an empty table gives no rows; very long texts are learned from by slices and scored in blocks; columns that bear a
result's name are replaced, others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.hashing import utf8

#: Bounds of the fit: bytes of text a language (about), of all languages, and of a slice of text.
FIT_BYTES, FIT_TOTAL, FIT_TEXT_BYTES = 1_500_000, 64_000_000, 65_536
BLOCK, EVIDENCE = 1 << 19, 100


@dataclass
class Tree:
    """Frozen probabilities of one language. A string of k + 1 bytes is an integer, the byte predicted last.

    order1: 65536 probabilities of a byte after one byte. seen[k], chance[k]: the strings of order k that
    occurred and the probabilities of their last bytes; contexts[k], escape[k]: the contexts of order k and the
    probabilities of a byte not seen after them.
    """

    order1: np.ndarray
    seen: dict[int, np.ndarray]
    chance: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    escape: dict[int, np.ndarray]

    def bits(self, strings: np.ndarray) -> np.ndarray:
        """Code lengths of the last bytes of four-byte strings."""
        p = self.order1[strings & 0xFFFF]
        for k in (2, 3):
            string = strings & ((1 << 8 * (k + 1)) - 1)
            context = string >> 8
            at, known = _find(self.contexts[k], context)
            p = np.where(known, self.escape[k][at] * p, p)
            at, known = _find(self.seen[k], string)
            p = np.where(known, self.chance[k][at], p)
        return -np.log2(p)


@dataclass
class Model:
    trees: dict[str, Tree] = field(default_factory=dict)  # by language, sorted

    @property
    def languages(self) -> list[str]:
        return list(self.trees)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted among sorted keys, of which there is one at least, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _strings(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """At each byte the string of it and the three before it in its text, zeros before the text's start."""
    padded = np.concatenate([np.zeros(3, dtype=np.int64), data])
    before = [padded[2:-1].copy(), padded[1:-2].copy(), padded[:-3].copy()]
    for back in range(3):
        for k in range(back + 1):
            p = starts + k
            before[back][p[(p >= 0) & (p < len(data))]] = 0
    return (before[2] << 24) | (before[1] << 16) | (before[0] << 8) | data


def fit_tree(strings: np.ndarray) -> Tree:
    """The tree of a language whose texts have these four-byte strings."""
    seen, counts = np.unique(strings, return_counts=True)
    orders = {3: (seen, counts)}
    for k in (2, 1):
        last = seen & ((1 << 8 * (k + 1)) - 1)
        seen, inverse = np.unique(last, return_inverse=True)
        counts = np.bincount(inverse, weights=counts).astype(np.int64)
        orders[k] = seen, counts
    order0 = np.bincount(orders[1][0] & 0xFF, weights=orders[1][1], minlength=256)
    lower = np.tile((order0 + 0.5) / (order0.sum() + 128), 256)
    tree = Tree(lower, {}, {}, {}, {})
    for k in (1, 2, 3):
        seen, counts = orders[k]
        contexts, start = np.unique(seen >> 8, return_index=True)
        n, distinct = np.add.reduceat(counts, start), np.diff(start, append=len(seen))
        chance = counts / np.repeat(n + distinct, distinct)
        escape = distinct / (n + distinct)
        if k == 1:
            full = np.ones(256)
            full[contexts] = escape
            tree.order1 = (lower.reshape(256, 256) * full[:, None]).reshape(-1)
            tree.order1[seen] = chance
        else:
            tree.seen[k], tree.chance[k], tree.contexts[k], tree.escape[k] = seen.astype(np.uint32), chance.astype(np.float32), contexts.astype(np.uint32), escape.astype(np.float32)
    tree.order1 = tree.order1.astype(np.float32)
    return tree


def fit(texts: dict[str, list[bytes]]) -> Model:
    """The model of a few texts for each language."""
    trees = {}
    for lang in sorted(texts):
        data = np.frombuffer(b"".join(texts[lang]), dtype=np.uint8).astype(np.int64)
        starts = np.cumsum([0] + [len(x) for x in texts[lang]])[:-1]
        if len(data):
            trees[lang] = fit_tree(_strings(data, starts))
    return Model(trees)


def code_lengths(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each text under each language, and the texts' lengths in bytes."""
    data, at = utf8(texts)
    out = np.zeros((len(at) - 1, len(model.trees)))
    size = int(at[-1])
    for a in range(0, size, BLOCK):
        b, lead = min(size, a + BLOCK), min(3, a)
        starts = at[np.searchsorted(at, a - 2) : np.searchsorted(at, b)] - (a - lead)
        strings = _strings(data[a - lead : b].astype(np.int64), starts)[lead:]
        distinct, inverse = np.unique(strings.astype(np.uint32), return_inverse=True)
        first = int(np.searchsorted(at, a, side="right")) - 1
        last = int(np.searchsorted(at, b, side="left"))
        cuts = np.maximum(at[first:last], a) - a
        full = np.diff(np.append(cuts, b - a)) > 0
        rows = np.arange(first, last)[full]
        for j, tree in enumerate(model.trees.values()):
            out[rows, j] += np.add.reduceat(tree.bits(distinct)[inverse], cuts[full], dtype=np.float64)
    return out, np.diff(at)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def has_letters(texts: pa.Array) -> np.ndarray:
    data, at = utf8(texts)
    seen = np.concatenate([[0], np.cumsum(_LETTER[data[: at[-1]]], dtype=np.int64)])
    out = seen[at[1:]] > seen[at[:-1]]
    for i in np.flatnonzero(~out & (at[1:] > at[:-1])):
        out[i] = any(c.isalpha() for c in texts[i].as_py())
    return out


def train(docs: DataFrame, fit_bytes: int = FIT_BYTES, fit_total: int = FIT_TOTAL) -> Model:
    """Fit on a hash sample of about fit_bytes a language (fewer where the languages' samples would exceed fit_total), of
    distinct texts with a lang; texts over FIT_TEXT_BYTES are sampled by slices of at most as many.

    Only text and lang are learned from; the caller leaves out the rows that are held out."""
    size = F.octet_length("text")
    usable = docs.select("lang", "text").where(F.col("lang").isNotNull() & (size > 0))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.sum(size.cast("long")).alias("n")).collect()}
    if not counts:
        return Model()
    each = min(fit_bytes, fit_total // len(counts))
    slices = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{FIT_TEXT_BYTES // 4}}}"), F.lit(0))  # a character has at most 4 bytes
    sliced = usable.select("lang", F.explode(F.when(size <= FIT_TEXT_BYTES, F.array("text")).otherwise(slices)).alias("text"))
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, each / n)]), F.col("lang"))
    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    texts: dict[str, list[bytes]] = {lang: [] for lang in counts}
    for r in sliced.where(unit < share).distinct().collect():
        texts[r["lang"]].append(r["text"].encode())
    bare = [lang for lang, t in texts.items() if not t]  # no hash fell into the sample: the least hash then stands for it
    if bare:
        for r in sliced.where(F.col("lang").isin(bare)).groupBy("lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).collect():
            texts[r["lang"]].append(r["text"].encode())
    for t in texts.values():
        t.sort()
    return fit(texts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and bits_per_byte of the best language."""
    added = T.StructType.fromDDL("lang_pred string, score double, bits_per_byte double").fields
    plain = docs.drop(*[f.name for f in added])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slice_rows = 512

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, "und"], dtype=object)
        for whole in batches:
            for k in range(0, whole.num_rows, slice_rows):
                b = whole.slice(k, slice_rows)
                texts = b.column("text")
                known = has_letters(texts)
                best, score, per_byte = np.full(len(texts), len(m.languages)), np.zeros(len(texts)), np.zeros(len(texts))
                if m.languages:
                    bits, size = code_lengths(m, texts)
                    size = np.maximum(size, 1)
                    pick = bits.argmin(axis=1)
                    nats = (bits - bits.min(axis=1, keepdims=True)) * np.log(2) * np.minimum(1, EVIDENCE / size)[:, None]
                    best = np.where(known, pick, best)
                    score = np.where(known, 1 / np.exp(-nats).sum(axis=1), 0.0)
                    per_byte = bits.min(axis=1) / size
                cols = [pa.array(names[best], pa.string()), pa.array(score), pa.array(per_byte)]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *[f.name for f in added]])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added]))
