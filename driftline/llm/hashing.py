"""Vectorised hashes of words and runs of words, the same in every process."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of text hashed at once; memory is about 40 times as much.
STEP = 1 << 18
_U = np.uint64
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_PLACES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A good 64-bit mixing of each number."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    #: A random number for each byte at each place of a word.
    _TABLE = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _hash_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in a buffer of bytes, where each begins)."""
    full = ~_GAP[buf]
    edge = np.diff(full.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    at = np.flatnonzero(full)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        value = _TABLE[(place % _PLACES) * 256 + buf[at]]
        if lengths.max() > _PLACES:
            value = value * (_U(2) * mix((place // _PLACES).astype(np.uint64)) + _U(1))
        return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64)), starts


def word_hashes(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words (sums of random numbers by byte and place, mixed)."""
    part, total = [], 0
    for t in texts:
        if part and total + len(t) >= STEP:
            yield from _hash_texts(part)
            part, total = [], 0
        part.append(t)
        total += len(t) + 1
    yield from _hash_texts(part)


def _hash_texts(texts: list[bytes]) -> Iterator[np.ndarray]:
    hashes, starts = _hash_words(np.frombuffer(b"\n".join(texts), np.uint8))
    cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    for a, b in zip([0, *cuts[:-1]], cuts, strict=True) if texts else ():
        yield hashes[a:b]


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, from those of half as many."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, size, level, have = None, 0, hashes, 1
    with np.errstate(over="ignore"):
        while size < k:
            if k & have:
                out = level[:n] if out is None else mix(out * _U(5) + level[size : size + n] + _U(have))
                size += have
            if size < k:
                level = mix(level[:-have] * _U(3) + level[have:] + _U(have))
                have *= 2
    return out
