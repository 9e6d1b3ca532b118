"""Removal of repeated passages: windows of words that also start earlier in the corpus.

First each chunk sends count-min rows (cells of window hashes, counted up to two) that the shards
merge; a cell estimated to be repeated in every row makes its windows candidates, and as the estimate
never falls short, no repeated window is lost. Then only candidates are grouped exactly, by 96 bits of
hash, and each chunk learns which of its windows have their first start elsewhere.

Cases: null and empty texts have no words; a text of fewer words than a window keeps them all; rows
that repeat a doc_id are ordered by their chunk and place, the first counting as earlier; null doc_ids
sort first; an empty table gives no rows; other columns pass through unchanged, but for n_words and n_removed, which are
replaced; very long texts are whole, in chunks of their own. doc_id is an integer, as its order says which window is the earlier:
a column of another type raises TypeError.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import chunks as C
from corpusflow.llm.hashing import GOLDEN, U64, inside, join_blobs, mix, pack_bits, pack_ints, pack_sorted, split_blobs, unpack_bits, unpack_ints, unpack_sorted, windows, word_hashes

WINDOW, ROWS = 20, 2


class _Windows:
    """The windows of one chunk: places, two hashes, and the sorted cells of each count-min row."""

    def __init__(self, table: pa.Table, size: int, cell_bits: int):
        words, self.at = word_hashes(table["text"])
        self.place = np.flatnonzero(inside(self.at, size))
        self.h1 = windows(words, size)[self.place]
        self.words, self.size, self.cell_bits = words, size, cell_bits

    def cells(self, row: int) -> np.ndarray:
        seed = U64(int(GOLDEN) * (2 * row + 1) & 0xFFFFFFFFFFFFFFFF)
        return mix(self.h1 ^ seed) >> U64(64 - self.cell_bits)

    def keep(self, mask: np.ndarray) -> None:
        self.place, self.h1 = self.place[mask], self.h1[mask]

    def candidates(self, replies: list[bytes] | None, rows: int) -> None:
        """Drop the windows that some row has counted once; replies: per row its cells' flags, shard after shard."""
        for row in range(rows):
            cells = self.cells(row)
            order = np.argsort(cells)
            ordered = cells[order]
            new = np.diff(ordered, prepend=ordered[:1] ^ U64(1)) != 0 if len(ordered) else np.empty(0, dtype=bool)
            rank = np.cumsum(new) - 1
            flags = np.empty(len(cells), dtype=bool)
            flags[order] = self.flags(replies, row, ordered[new])[rank] if len(cells) else False
            self.keep(flags)

    def flags(self, replies, row: int, distinct: np.ndarray) -> np.ndarray:
        """The flags of the distinct cells left, among all that were sent for the row."""
        sent, flags = replies[row]
        return flags[np.searchsorted(sent, distinct)]

    def exact(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Order by (h1, h2, place); the start of each group in it; the groups' h1 and h2."""
        h2 = (windows(self.words, self.size, 1)[self.place] >> U64(32)).astype(np.uint32)
        order = np.lexsort((h2, self.h1))
        a, b = self.h1[order], h2[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        return order, first, a[first], b[first]


def _sliced(keys: np.ndarray, bits: int, shard_bits: int):
    """(shard, slice) of sorted keys of so many bits, for shards that have any."""
    edges = np.searchsorted(keys, np.arange(1, 1 << shard_bits, dtype=U64) << U64(bits - shard_bits))
    edges = np.concatenate([[0], edges, [len(keys)]])
    return [(s, slice(a, b)) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]


def remove_repeats(docs: DataFrame, size: int = WINDOW, rows: int = ROWS, chunk_bytes: int | None = None, as_is: bool = False) -> DataFrame:
    """docs with `text` reduced to the words outside of repeated windows, joined by single spaces
    (null where it was null), and the columns n_words and n_removed. as_is: texts that lose nothing keep
    their white space."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError(f"doc_id is an integer, not {docs.schema['doc_id'].dataType.simpleString()}")
    clash = [c for c in ("n_words", "n_removed") if c in docs.columns]
    docs = docs.drop(*clash)
    chunks = C.make_chunks(docs, chunk_bytes=chunk_bytes)
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    cell_bits, shard_bits = C.shard_bits(total)
    chunks = chunks.select("chunk", "body")  # alike in both joins below, so that they share one exchange of the texts

    def load(row: dict) -> tuple[pa.Table, _Windows]:
        table = C.from_body(row["body"])
        return table, _Windows(table, size, cell_bits)

    def counted(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = np.sort(cells)
        new = np.ones(len(cells), dtype=bool)
        new[1:] = cells[1:] != cells[:-1]
        first = np.flatnonzero(new)
        return cells[first], np.diff(first, append=len(cells)) > 1

    def send_counts(row: dict):
        _, w = load(row)
        for r in range(rows):
            cells, twice = counted(w.cells(r))
            for shard, part in _sliced(cells, cell_bits, shard_bits):
                base = U64(shard << (cell_bits - shard_bits))
                yield (r << shard_bits) + shard, join_blobs([pack_sorted(cells[part] - base), pack_bits(twice[part])])

    def merge_counts(shard: int, blobs: list[bytes], _) -> list[bytes]:
        count = np.zeros(1 << (cell_bits - shard_bits), dtype=np.uint8)
        for blob in blobs:
            cells, twice = split_blobs(blob)
            cells = unpack_sorted(cells)
            count[cells] = np.minimum(2, count[cells] + 1 + unpack_bits(twice, len(cells)))
        return [pack_bits(count[unpack_sorted(split_blobs(blob)[0])] > 1) for blob in blobs]

    counts = C.exchange(chunks, send_counts, merge_counts)

    def candidates(row: dict) -> tuple[pa.Table, _Windows]:
        table, w = load(row)
        known = {}
        replies = {x["shard"]: x["blob"] for x in row["counts"] or ()}
        for r in range(rows):
            cells, _ = counted(w.cells(r))
            flags = np.zeros(len(cells), dtype=bool)
            for shard, part in _sliced(cells, cell_bits, shard_bits):
                flags[part] = unpack_bits(replies[(r << shard_bits) + shard], part.stop - part.start)
            known[r] = (cells, flags)
        w.candidates(known, rows)
        return table, w

    def owners(table: pa.Table, w: _Windows, order: np.ndarray, first: np.ndarray) -> np.ndarray:
        doc = np.searchsorted(w.at, w.place[order[first]], side="right") - 1
        ids = table["doc_id"].cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()
        return ids[doc]

    def send_exact(row: dict):
        table, w = candidates(row)
        order, first, a, b = w.exact()
        own = owners(table, w, order, first)
        for shard, part in _sliced(a, 64, shard_bits):
            base = own[part].min()
            yield shard, join_blobs([pack_sorted(a[part] - U64(shard << (64 - shard_bits))), b[part].tobytes(), int(base).to_bytes(8, "little", signed=True), pack_ints((own[part] - base).astype(np.uint64))])

    def merge_exact(shard: int, blobs: list[bytes], _) -> list[bytes]:
        parts = []
        for blob in blobs:
            a, b, base, own = split_blobs(blob)
            parts.append((unpack_sorted(a), np.frombuffer(b, dtype=np.uint32), unpack_ints(own).astype(np.int64) + int.from_bytes(base, "little", signed=True)))
        sizes = [len(p[0]) for p in parts]
        a, b, own = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((own, b, a))  # stable: ties go to the earlier chunk
        x, y = a[order], b[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        here = np.zeros(len(order), dtype=bool)
        here[order[new]] = True
        return [pack_bits(x) for x in np.split(here, np.cumsum(sizes)[:-1])]

    first_here = C.exchange(C.with_replies(chunks, counts=counts), send_exact, merge_exact)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("body", "counts", "first_here")}
                yield from cut(row)

    def cut(row: dict):
        table, w = candidates(row)
        order, first, a, _ = w.exact()
        here = np.zeros(len(first), dtype=bool)
        replies = {x["shard"]: x["blob"] for x in row["first_here"] or ()}
        for shard, part in _sliced(a, 64, shard_bits):
            here[part] = unpack_bits(replies[shard], part.stop - part.start)
        later = np.ones(len(order), dtype=bool)
        later[first[here]] = False
        edge = np.zeros(len(w.words) + 1, dtype=np.int32)
        starts = w.place[order[later]]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + size, -1)
        gone = np.cumsum(edge[:-1]) > 0
        at = w.at
        lost = np.add.reduceat(np.append(gone, False).astype(np.int64), at[:-1]) if len(at) > 1 else np.empty(0, dtype=np.int64)
        lost[at[1:] == at[:-1]] = 0
        texts = []
        for d, text in enumerate(table["text"].cast(pa.large_binary()).to_pylist()):
            if text is None:
                texts.append(None)
                continue
            if as_is and not lost[d]:
                texts.append(text.decode())
                continue
            words = text.split()
            texts.append(b" ".join(compress(words, ~gone[at[d] : at[d + 1]]) if lost[d] else words).decode())
        text_type = table.schema.field("text").type
        out = table.set_column(table.schema.get_field_index("text"), "text", pa.array(texts, text_type))
        out = out.append_column("n_words", pa.array(np.diff(at), pa.int64())).append_column("n_removed", pa.array(lost, pa.int64()))
        yield from out.to_batches(max_chunksize=2000)

    return C.with_replies(chunks, counts=counts, first_here=first_here).select("body", "counts", "first_here").mapInArrow(finish, schema)
