"""Best-fit packing of token pieces into sequences, planned on the histogram of lengths.

A length is at most the capacity, so the whole packing problem is a histogram of `capacity` counts.
The plan pairs pieces above a third of the capacity, the longest with the longest that still fits,
and then lays shorter ones, long before short, into the smallest gap that takes them. It speaks of
runs of equal sequences; a piece finds its place from its rank among the pieces of its length, which
is its rank in its part of the table plus the count in earlier parts.

Cases: null and empty texts are the end token alone; rows that repeat a doc_id are packed each; ties in
length are ranked by part and place; an empty table gives no rows; other columns are ignored, whatever
their names; a very long text is encoded whole, alone in its worker's memory, and cut into pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import save

CAPACITY, END_ID = 1_024, 2
#: Documents of a part.
PART_ROWS = 2_000

_TOKENS: dict[tuple[str, bool], "Tokens"] = {}


class Tokens:
    """Ids of texts as little-endian 32-bit bytes, by a byte-level tokenizer file.

    The file's vocabulary and pattern run in tiktoken's encoder, which gives the same ids several times faster, if
    the file is one that merges_by_rank() holds for; else tokenizers encodes itself.
    Texts that hold one of the file's added tokens, such as <|endoftext|>, always go to tokenizers.
    """

    def __init__(self, path: str, fast: bool = True):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in self.tokenizer.get_vocab().items() if t not in added}
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if fast else None

    def encode(self, texts: list[str]) -> list[bytes]:
        slow = [t for t in texts if self.fast is None or self.added.search(t)]
        others = iter(self.tokenizer.encode_batch_fast(slow, add_special_tokens=False))
        ids = [next(others).ids if self.fast is None or self.added.search(t) else self.fast.encode_ordinary(t) for t in texts]
        return [np.array(x, dtype="<u4").tobytes() for x in ids]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if printable in Latin-1, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def tokens(path: str, fast: bool = True) -> Tokens:
    if (path, fast) not in _TOKENS:
        _TOKENS[path, fast] = Tokens(path, fast)
    return _TOKENS[path, fast]


def merges_by_rank(path: str) -> bool:
    """Whether merging by rank, whatever the pair, gives the ids of the file's own merges.

    So it does if the file is a plain byte-level one, every token of several bytes has one merge, ids follow the order
    of merges, and each token's bytes alone, merged by rank, come to just the pair of its merge: then any
    neighbours that spell a token are that pair.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or file.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids, letters = model["vocab"], byte_letters()
    made = {a + b: (a, b) for a, b in pairs}
    order = [ids.get(a + b, -1) for a, b in pairs]
    if len(made) != len(pairs) or any(x >= y for x, y in zip(order, order[1:])) or {t for t in ids if len(t) > 1} - {t["content"] for t in file["added_tokens"]} != set(made) or not set(letters) <= set(ids):
        return False
    for token, pair in made.items():
        parts, limit = list(token), ids[token]
        while len(parts) > 2:
            rank, k = min((ids.get(a + b, limit), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= limit:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if tuple(parts) != pair:
            return False
    return True


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, piece, start, length, ids_crc32, place): place is the rank among the part's pieces of that length."""
    end, fast = int(end_id).to_bytes(4, "little"), merges_by_rank(path)

    def run(batches):
        base, n = TaskContext.get().partitionId() << 24, 0
        encoder = tokens(path, fast)
        for whole in batches:
            for k in range(0, whole.num_rows, PART_ROWS):
                b = whole.slice(k, PART_ROWS)
                seen: dict[int, int] = {}
                out = []
                ids_of, texts = b.column("doc_id").to_pylist(), b.column("text")
                for j in range(0, len(texts), 256):
                    for doc, ids in zip(ids_of[j : j + 256], encoder.encode([t or "" for t in texts.slice(j, 256).to_pylist()])):
                        ids += end
                        size = len(ids) // 4
                        first = size % capacity or capacity
                        cuts = [0, *range(first, size + 1, capacity)]
                        for piece, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                            rank = seen.get(y - x, 0)
                            seen[y - x] = rank + 1
                            out.append((base + n, doc, piece, x, y - x, zlib.crc32(ids[4 * x : 4 * y]), rank))
                n += 1
                types = (pa.int64(), b.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["part", "doc_id", "piece", "start", "length", "ids_crc32", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"part long, doc_id {kind}, piece int, start long, length long, ids_crc32 long, place long")


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Per length its runs (first rank, first sequence, pieces a sequence, offset of the first), and the number of sequences."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {s: [] for s in counts}
    used = dict.fromkeys(counts, 0)
    left = {s: n for s, n in counts.items() if n}
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, sequences), sorted
    n = 0

    def lay(s: int, first: int, sequences: int, each: int, offset: int) -> None:
        runs[s].append((used[s], first, each, offset))
        used[s] += sequences * each
        left[s] -= sequences * each

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        k = bisect_left(large, capacity - a + 1) - 1
        b = large[k] if k >= 0 else 0
        if not b:
            m = left[a]
            lay(a, n, m, 1, 0)
        elif b == a:
            m = left[a] // 2
            if m:
                lay(a, n, m, 2, 0)
            else:
                lay(a, n, m := 1, 1, 0)
                b = 0 if k == 0 else large[k - 1]
                if b:
                    lay(b, n, 1, 1, a)
        else:
            m = min(left[a], left[b])
            lay(a, n, m, 1, 0)
            lay(b, n, m, 1, a)
        gap = capacity - a - b
        if gap:
            insort(gaps, (gap, n, m))
        n += m
        large = [s for s in large if left[s]]
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            k = bisect_left(gaps, (s, -1, -1))
            if k < len(gaps):
                gap, first, m = gaps.pop(k)
            else:
                gap, first, m = capacity, n, -(-left[s] // (capacity // s))
                n += m
            each = gap // s
            full = min(m, left[s] // each)
            if full:
                lay(s, first, full, each, capacity - gap)
                if gap > each * s:
                    insort(gaps, (gap - each * s, first, full))
            if full < m:
                rest = left[s]  # fewer than `each`
                if rest:
                    lay(s, first + full, 1, rest, capacity - gap)
                    insort(gaps, (gap - rest * s, first + full, 1))
                if m - full - bool(rest):
                    insort(gaps, (gap, first + full + bool(rest), m - full - bool(rest)))
    return runs, n


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = save(token_pieces(docs, path, capacity, end_id), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = save(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("first")), "piece-starts")
    totals = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = plan_sequences(totals, capacity)
    plan = docs.sparkSession.sparkContext.broadcast({s: np.array(r, dtype=np.int64) for s, r in runs.items()})
    kind = docs.schema["doc_id"].dataType.simpleString()

    def place(part: pa.Table, first: pa.Table) -> pa.Table:
        base = dict(zip(first["length"].to_pylist(), first["first"].to_pylist()))
        sequence, offset = np.empty(len(part), dtype=np.int64), np.empty(len(part), dtype=np.int64)
        length, places = part["length"].to_numpy(), part["place"].to_numpy()
        for s in np.unique(length):
            at = np.flatnonzero(length == s)
            r = plan.value[int(s)]
            rank = places[at] + base[s]
            k = np.searchsorted(r[:, 0], rank, side="right") - 1
            inner = rank - r[k, 0]
            sequence[at] = r[k, 1] + inner // r[k, 2]
            offset[at] = r[k, 3] + inner % r[k, 2] * s
        return part.drop_columns(["part", "place"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return pieces.groupBy("part").cogroup(starts.groupBy("part")).applyInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
