"""Vectorised words, word hashes and window hashes over Arrow string arrays, and compact forms of sorted keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
#: The bytes 0x09-0x0D and 0x20 part words.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Finalizer constants of splitmix64 (fixed values).
MIX_A, MIX_B, GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def mix(z: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, elementwise."""
    z = (z ^ (z >> U64(30))) * MIX_A
    z = (z ^ (z >> U64(27))) * MIX_B
    return z ^ (z >> U64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string (or binary) array, padded by 8, and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.zeros(int(offsets[-1] - offsets[0]) + 8, dtype=np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, row after row, and the n + 1 word offsets of the rows."""
    data, offsets = utf8(texts)
    inner = IS_WORD[data]
    inner[-8:] = False
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(inner), dtype=bool)
    before[0], before[1:] = False, inner[:-1]
    starts = np.flatnonzero(inner & (~before | edge[:-1]))
    after = np.empty(len(inner), dtype=bool)
    after[-1], after[:-1] = False, inner[1:]
    length = np.flatnonzero(inner & (~after | edge[1:])) + 1 - starts
    at = np.searchsorted(starts, offsets)
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,))
    h = length.astype(U64) * GOLDEN
    part, live = 0, np.arange(len(starts))
    while len(live):
        left = length[live] - 8 * part
        keep = (U64(64) - U64(8) * np.minimum(left, 8).astype(U64)) & U64(63)
        value = (eight[starts[live] + 8 * part] << keep) >> keep
        h[live] = mix((h[live] ^ value) + GOLDEN)
        live, part = live[left > 8], part + 1
    return h, at


def windows(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of `size` consecutive entries of words from each start, len(words) - size + 1 of them at most."""
    if len(words) < size:
        return np.empty(0, dtype=U64)
    step = U64((2 * seed + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    power, width, out, done = mix(words + U64(seed)), 1, None, 0
    while True:
        if size & width:
            out = power if out is None else mix(out[: len(power) - done] * step + power[done:])
            done += width
        width *= 2
        if width > size:
            return out[: len(words) - size + 1]
        power = mix(power[: len(power) - width // 2] * step + power[width // 2 :] + U64(width))


def inside(at: np.ndarray, size: int) -> np.ndarray:
    """For each window start whether the window ends in the row where it starts; at: word offsets of the rows."""
    n = int(at[-1])
    ends = np.repeat(at[1:], np.diff(at))
    return np.arange(max(0, n - size + 1)) + size <= ends[: max(0, n - size + 1)]


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, compressed: short when the values are mostly small."""
    v = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, -(-int(v.max()).bit_length() // 8)) if len(v) else 1
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ints(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=np.uint8).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : blob[0]] = planes.T
    return out.view("<u8").reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted unsigned keys by their gaps."""
    return pack_ints(np.diff(keys, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(blob), dtype=U64)


def pack_bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8), count=n).astype(bool)


def join_blobs(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def split_blobs(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(blob[at + 4 : at + 4 + n])
        at += 4 + n
    return out
