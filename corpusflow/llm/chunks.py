"""Chunks of documents and their exchange with shards of a hash space.

A chunk is one row that holds a few megabytes of documents, compressed. It sends each shard of the
hash space one message with its sorted keys of that shard; the shard meets the messages of all chunks
and replies to each with a value for every key it sent, in the order sent. So a corpus-wide question
about hashed things (is it repeated, how often, who has it first) costs a few bits a key, no key is
hot (a chunk sends a key once, however often it has it), and no task holds more than a chunk or a shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import arrow_schema, save
from corpusflow.llm.hashing import word_hashes

#: Bytes of text in a chunk, for inputs of up to SMALL_INPUT bytes; beyond, chunks grow with the input's square root up to the largest.
CHUNK_BYTES, MOST_CHUNK_BYTES, SMALL_INPUT = 6 << 20, 24 << 20, 2 << 30
#: A shard's part of the hash space, in cells, for up to SMALL_KEYS keys, and what it may grow to; at least this many shards, so that all cores have some.
SHARD_CELLS, MOST_SHARD_CELLS, SMALL_KEYS, LEAST_SHARDS = 1 << 23, 1 << 25, 1 << 29, 16


def to_body(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def from_body(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def chunk_size(docs: DataFrame) -> int:
    """Bytes of text a chunk for these rows: messages number chunks times shards, so both grow with the square root of the input.

    It goes by the optimizer's estimate of the input's size, and only how the work is cut depends on it."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = size if size < 1 << 62 else 0  # the estimate of rows of which nothing is known
    return min(MOST_CHUNK_BYTES, int(CHUNK_BYTES * max(1.0, size / SMALL_INPUT) ** 0.5))


def make_chunks(docs: DataFrame, order: str = "doc_id", text: str = "text", chunk_bytes: int | None = None) -> DataFrame:
    """(chunk long, n_docs long, n_words long, body binary, ids array: `order` of its rows), written to the shared folder.

    Rows stay in the partition that held them; within a chunk they are sorted by `order`, nulls first.
    A single document larger than chunk_bytes (chunk_size() where none is given) is a chunk of its own.
    """
    chunk_bytes = chunk_bytes or chunk_size(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, held, size = TaskContext.get().partitionId() << 24, 0, [], 0

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            t = t.take(pa.compute.sort_indices(t, sort_keys=[(order, "ascending")], null_placement="at_start")).combine_chunks()
            words = len(word_hashes(t[text])[0])
            return pa.RecordBatch.from_arrays([pa.array([base + n], pa.int64()), pa.array([len(t)], pa.int64()), pa.array([words], pa.int64()), pa.array([to_body(t)], pa.binary()), pa.array([t[order].to_pylist()], pa.list_(t.schema.field(order).type))], names=["chunk", "n_docs", "n_words", "body", "ids"])

        for b in batches:
            lengths, start = pa.compute.binary_length(b.column(text)).fill_null(0).to_pylist(), 0
            for i, k in enumerate(lengths):
                if size and size + k > chunk_bytes:
                    if i > start:
                        held.append(b.slice(start, i - start))
                    yield out()
                    n, held, size, start = n + 1, [], 0, i
                size += k + 64
            if start < len(lengths):
                held.append(b.slice(start))
        if held:
            yield out()

    kind = docs.schema[order].dataType.simpleString()
    return save(docs.mapInArrow(run, f"chunk long, n_docs long, n_words long, body binary, ids array<{kind}>"), "chunks")


def shard_bits(n_keys: int, spread: int = 4) -> tuple[int, int]:
    """(bits of a cell, bits of a shard) for n_keys keys over at least `spread` cells a key."""
    cell = max(12, (max(1, n_keys) * spread - 1).bit_length())
    cells = min(MOST_SHARD_CELLS, int(SHARD_CELLS * max(1.0, n_keys / SMALL_KEYS) ** 0.5))
    shards = max(LEAST_SHARDS, (1 << cell) // cells)
    return cell, (shards - 1).bit_length()


def map_chunks(chunks: DataFrame, function: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that function makes of each chunk row (given as a dict of its columns)."""

    fields = arrow_schema(schema)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(j)[i].as_py() for j, name in enumerate(b.schema.names)}
                rows = list(function(row))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return chunks.mapInArrow(run, schema)


def exchange(chunks: DataFrame, send: Callable[[dict], Iterator[tuple[int, bytes]]], reply: Callable[[int, list[bytes], list[int]], list[bytes]]) -> DataFrame:
    """Per chunk: (chunk, replies), where replies is an array of (shard, blob) sorted by shard.

    send(chunk row) yields (shard, message); reply(shard, messages, chunks) gives one blob a message.
    """
    sent = map_chunks(chunks, lambda row: ((row["chunk"], shard, blob) for shard, blob in send(row)), "chunk long, shard int, blob binary")

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk", kind="stable")
        blobs = reply(int(key[0]), list(frame["blob"]), [int(x) for x in frame["chunk"]])
        return pd.DataFrame({"chunk": frame["chunk"].to_numpy(), "shard": frame["shard"].to_numpy(), "blob": blobs})

    answered = sent.groupBy("shard").applyInPandas(answer, "chunk long, shard int, blob binary")
    return answered.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "blob"))).alias("replies"))


def with_replies(chunks: DataFrame, **replies: DataFrame) -> DataFrame:
    """The chunks with one array of replies for each exchange, by its name; a chunk that sent nothing has null."""
    for name, r in replies.items():
        chunks = chunks.join(r.select("chunk", F.col("replies").alias(name)), "chunk", "left")
    return chunks
