"""Words of a text and hashes of runs of words, without a loop over the words."""

from __future__ import annotations

import hashlib

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted
_MASK = (1 << 64) - 1
#: A text is cut at white space into blocks of about this many bytes, which bounds the tables of powers.
BLOCK = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, np.uint64(base))
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(values: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """Hash of every ``size`` consecutive values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * powers(base, len(values)), dtype=np.uint64)])
        inverse = powers(pow(base, -1, 1 << 64), n)
        return mix((total[size:] - total[:n]) * inverse)


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal spans have equal hashes wherever they stand."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * powers(base, max(1, len(values)))[: len(values)], dtype=np.uint64)])
        inverse = powers(pow(base, -1, 1 << 64), len(values) + 1)
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words (runs without blank, \\t, \\n, \\v, \\f, \\r) start and end."""
    inside = np.concatenate([[False], ~_BLANK[np.frombuffer(raw, dtype=np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """Hash of every word of a UTF-8 text."""
    out, at = [], 0
    while at < len(raw):
        end = len(raw)
        if end - at > BLOCK:
            tail = np.flatnonzero(_BLANK[np.frombuffer(raw, dtype=np.uint8, count=end - at - BLOCK, offset=at + BLOCK)])
            end = at + BLOCK + int(tail[0]) if len(tail) else end
        part = raw[at:end]
        starts, ends = word_places(part)
        if len(starts):
            out.append(spans(np.frombuffer(part, dtype=np.uint8).astype(np.uint64) + np.uint64(1), starts, ends))
        at = end
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def words(raw: bytes) -> list[bytes]:
    """The words themselves. bytes.split() parts at the same six characters."""
    return raw.split()


def text_key(raw: bytes) -> bytes:
    """16 bytes that name a sequence of words."""
    return hashlib.blake2b(b" ".join(raw.split()), digest_size=16).digest()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
