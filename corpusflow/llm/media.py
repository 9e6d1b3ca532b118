"""Media columns: WAV through the wave module, short-time Fourier transforms and fingerprints of
pairs of spectral peaks, kept as arrays of time-coded integers.

Cases: a null payload stores as an empty one, padded to one unit; an unreadable or null media value
has null features; very long payloads are transformed in blocks of frames; repeated rows give equal
values; an empty table gives no rows; other columns of the input pass through.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import packed

#: Payloads are padded to whole units; a frame of the transform holds FRAME samples and starts HOP after the last.
UNIT, FRAME, HOP, RATE = 64, 256, 128, 8_000
#: Peaks that a frame may contribute and hops that a pair may span.
PEAKS, SPAN = 2, 6
BLOCK = 2_048


def encode_wav(payload: bytes, rate: int = RATE) -> bytes:
    """One channel of unsigned 8-bit samples, padded with zero bytes to a positive multiple of UNIT."""
    padded = payload + bytes((-len(payload)) % UNIT or (0 if payload else UNIT))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(padded)
    return out.getvalue()


def decode_wav(media: bytes) -> tuple[bytes, int]:
    """The samples' bytes and the frame rate."""
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes()), r.getframerate()


def spectral_peaks(samples: np.ndarray) -> np.ndarray:
    """Per frame the PEAKS strongest local maxima above the frame's mean, -1 where there is none."""
    n = max(1, -(-(len(samples) - FRAME) // HOP) + 1)
    out = np.full((n, PEAKS), -1, dtype=np.int16)
    window = np.hanning(FRAME).astype(np.float32)
    for at in range(0, n, BLOCK):
        part = np.zeros((min(BLOCK, n - at) - 1) * HOP + FRAME, dtype=np.float32)
        held = samples[at * HOP : at * HOP + len(part)]
        part[: len(held)] = held
        frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP]
        frames = frames - frames.mean(axis=1, keepdims=True)
        power = np.abs(np.fft.rfft(frames * window, axis=1))[:, 1:]
        mean = power.mean(axis=1, keepdims=True)
        around = np.pad(power, ((0, 0), (1, 1)))
        power = np.where((power > around[:, :-2]) & (power >= around[:, 2:]), power, 0)
        best = np.argsort(-power, axis=1, kind="stable")[:, :PEAKS]
        strong = np.take_along_axis(power, best, axis=1) > 1e-3 + mean
        out[at : at + len(frames)] = np.where(strong, best + 1, -1)
    return out


def fingerprints(samples: np.ndarray) -> np.ndarray:
    """Sorted int64 codes: frame << 32 | bin << 16 | later bin << 4 | frames between."""
    peaks = spectral_peaks(samples).astype(np.int64)
    n, codes = len(peaks), []
    for gap in range(1, SPAN + 1):
        if n > gap:
            t = np.arange(n - gap, dtype=np.int64)
            for i, j in product(range(PEAKS), repeat=2):
                a, b = peaks[:-gap, i], peaks[gap:, j]
                ok = (a > 0) & (b > 0)
                codes.append((t[ok] << 32) | (a[ok] << 16) | (b[ok] << 4) | gap)
    if not codes:
        codes = [np.empty(0, dtype=np.int64)]
    return np.sort(np.concatenate(codes))


def add_media(df: DataFrame, payload: str, media: str = "media") -> DataFrame:
    """df with a binary column: the WAV form of the (binary or UTF-8 text) column payload. A column of df named as `media` says
    is replaced; all others stay, whatever their names."""
    others = [c for c in df.columns if c.lower() != media.lower()]
    plain = df.select(*([packed(df.select(*[f"`{c}`" for c in others]))] if others else []), F.col(payload).cast("binary").alias("payload"))

    def run(batches):
        for b in batches:
            col = pa.array([encode_wav(x or b"") for x in b.column("payload").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], col], names=[*b.schema.names[:-1], "media"])

    out = plain.mapInArrow(run, T.StructType([*plain.schema.fields[:-1], T.StructField("media", T.BinaryType())]))
    return out.select(*[F.col("row")[c].alias(c) for c in others], F.col("media").alias(media))


MEDIA_FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, rate int, fingerprint array<long>"


def media_features(df: DataFrame, media: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """For the columns `keep` of df: what the stored bytes hold when they are read back."""
    schema = T.StructType([*[df.schema[k] for k in keep], *T.StructType.fromDDL(MEDIA_FEATURES).fields])
    arrow = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("rate", pa.int32()), ("fingerprint", pa.list_(pa.int64()))]

    def one(x):
        if x is None:
            return (None,) * len(arrow)
        sha = hashlib.sha256(x).hexdigest()
        try:
            payload, rate = decode_wav(x)
        except (wave.Error, EOFError):
            return (None, None, None, len(x), sha, None, None)
        prints = fingerprints(np.frombuffer(payload, dtype=np.uint8))
        return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(x), sha, rate, prints)

    def run(batches):
        for b in batches:
            rows = [one(x.as_py()) for x in b.column(media)]
            cols = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], *cols], names=[*keep, *[n for n, _ in arrow]])

    return df.select(*keep, media).mapInArrow(run, schema)
