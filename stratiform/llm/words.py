"""Words of a text as 64-bit numbers, and hashes of runs of words, with numpy inside tasks.

Words are what lies between white space (space, tab to carriage return) of the UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 18  # bytes hashed at once: bounds the memory for long texts

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def random_words(seed: str, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    return np.frombuffer(hashlib.shake_128(seed.encode()).digest(8 * n), "<u8").copy()


_OF_BYTE = random_words("bytes", 256)
_BASE = int(random_words("base", 1)[0]) | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blocks(data: bytes) -> Iterator[bytes]:
    """Parts of about BLOCK bytes that end where a word ends."""
    at = 0
    while len(data) - at > BLOCK:
        part = data[at : at + BLOCK]
        cut = max(part.rfind(c) for c in b" \t\n\r\v\f")
        if cut <= 0:  # one word longer than a block
            after = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, offset=at + 1)])
            cut = int(after[0]) + 1 if len(after) else len(data) - at
        yield data[at : at + cut]
        at += cut
    yield data[at:]


def _hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~_SPACE[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    # by the word's own length alone, so that it has one hash wherever it stands
    long_ = np.flatnonzero(ends - starts >= BLOCK // 4)
    if len(raw) > BLOCK:  # one word, with white space before it
        out = np.zeros(len(starts), np.uint64)
    else:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[raw] * _UP[: len(raw)], dtype=np.uint64)))
        out = mix((sums[ends] - sums[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64))
    for i in long_:
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def word_hashes(data: bytes) -> np.ndarray:
    """One number for each word, in order; equal words have equal numbers wherever they stand."""
    if len(data) <= BLOCK:
        return _hashes(data)
    return np.concatenate([_hashes(part) for part in _blocks(data)])


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of ``length`` consecutive words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return out


def shingles(text: str, length: int) -> np.ndarray:
    """The distinct runs of ``length`` words, A-Z lower-cased, sorted; fewer words are one run; none without words."""
    words = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    return np.unique(runs(words, min(length, len(words)))) if len(words) else np.zeros(0, np.uint64)
