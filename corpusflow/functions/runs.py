"""Runs of tokens in batches of texts: where they lie and hashes of them, by numpy, as text.tokens makes them."""

from __future__ import annotations

import numpy as np

#: Bytes of folded text that are looked at together (longer texts alone).
PIECE = 1 << 20
U64 = np.uint64
#: What text.ascii_lower folds to ASCII letters, in UTF-8, besides A-Z: also what lower case makes k, i and sharp s.
FOLDED = tuple(
    (a.encode(), b.encode())
    for a, b in (
        ("\u212a", "k"), ("\u0130", "i\u0307"), ("\u1e9e", "ss"), ("\u017f", "s"), ("\u00df", "ss"), ("\ufb00", "ff"), ("\ufb01", "fi"),
        ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"), ("\ufb05", "st"), ("\ufb06", "st"), ("\u0149", "\u02bcn"), ("\u01f0", "j\u030c"),
    )
)
ALNUM, JOINS = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
ALNUM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
JOINS[list(b"._-")] = True
VALUES = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=U64)
BASE = 0x9E3779B97F4A7C15
POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def folded(text: bytes) -> bytes:
    """UTF-8 whose tokens are those of text.tokens; other letters stay as they are."""
    out = text.replace(b"\\n", b" ").lower()
    if not out.isascii():
        for a, b in FOLDED:
            out = out.replace(a, b)
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse modulo 2^64, n at least; those of a piece are kept."""
    if n > 2 * PIECE or not POWERS:
        made = tuple(np.cumprod(np.full(max(n, 2 * PIECE), b, dtype=U64)) for b in (BASE, pow(BASE, -1, 1 << 64)))
        if n > 2 * PIECE:
            return made
        POWERS[0] = made
    return POWERS[0]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def pieces(texts: list[bytes | None]):
    """(numbers of texts, folded texts) of about PIECE bytes."""
    at, held, size = [], [], 0
    for i, text in enumerate(texts):
        if text:
            x = folded(text)
            if held and size + len(x) > PIECE:
                yield at, held
                at, held, size = [], [], 0
            at.append(i)
            held.append(x)
            size += len(x) + 1
    if held:
        yield at, held


def runs(texts: list[bytes], size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of folded texts: all bytes, the starts and ends of tokens in them, each run's first token, text and 64-bit hash.

    A joining character is part of a token between two letters or digits, so tokens are the longest stretches of both."""
    whole = b"\n" + b"\n".join(texts) + b"\n"
    b = np.frombuffer(whole, dtype=np.uint8)
    alnum = ALNUM[b]
    word = alnum.copy()
    word[1:-1] |= JOINS[b[1:-1]] & alnum[:-2] & alnum[2:]
    turns = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    none = np.empty(0, dtype=np.int64)
    if len(starts) < size:
        return whole, starts, ends, none, none, none.astype(U64)
    up, down = powers(len(b))
    sums = np.cumsum(VALUES[b] * up[: len(b)])
    tokens = mixed((sums[ends - 1] - sums[starts - 1]) * down[starts])
    begins = np.cumsum([1] + [len(x) + 1 for x in texts[:-1]])
    of = np.searchsorted(begins, starts, side="right") - 1
    n = len(starts) - size + 1
    first = np.flatnonzero(of[:n] == of[size - 1 :])
    h = np.zeros(n, dtype=U64)
    for k in range(size):
        h = h * U64(BASE) + tokens[k : k + n]
    return whole, starts, ends, first, of[first], mixed(h[first])
