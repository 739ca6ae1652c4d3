"""Vectorised words and word shingles of whole texts.

A word is a run of bytes other than space and 0x09-0x0D after A-Z has been
lower-cased; texts are taken whole.  Texts are concatenated slice by slice, so
memory follows ``SLICE_BYTES`` and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all input bits over all output bits (64-bit finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 2 * SLICE_BYTES)
        for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverses


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of an Arrow column as bytes, a null as empty: (first position, texts)."""
    if not len(texts):
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    place = (np.cumsum(sizes + 1) - sizes - 1) // SLICE_BYTES
    cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
    for lo, hi in zip(cuts, cuts[1:]):
        yield int(lo), [b or b"" for b in texts.slice(int(lo), int(hi - lo)).cast(pa.binary()).to_pylist()]


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, 64-bit hash) of every word, in order."""
    data = b" " + b" ".join(texts).lower() + b" "
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[raw]
    first = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    after = np.flatnonzero(~space[:-1] & space[1:]) + 1
    powers, inverses = _tables(len(raw))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[: len(raw)], out=total[1:])
    hashes = mix((total[after] - total[first]) * inverses[first] + (after - first).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts]) + 1
    return np.searchsorted(ends, first, side="right"), hashes


def shingle_sets(texts: Sequence[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of ``width`` words per text.

    A text with fewer words gives one shingle, the whole sequence; a text
    without words gives none.
    """
    doc, words = word_hashes(texts)
    steps = np.resize(_STEPS, width) + (np.arange(width, dtype=np.uint64) // len(_STEPS) * 2).astype(np.uint64)
    n = len(words) - width + 1
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint64)] * len(texts)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        rolled += mix(words[k : k + n] ^ steps[k]) * steps[k]
    rolled = mix(rolled)
    for i in range(len(texts)):
        lo, hi = bounds[i], bounds[i + 1]
        if hi - lo >= width:
            out[i] = np.unique(rolled[lo : hi - width + 1])
        elif hi > lo:
            own, short = np.uint64(hi - lo), np.zeros(1, dtype=np.uint64)
            for w in words[lo:hi]:
                short = mix(short * _STEPS[0] + w + own)
            out[i] = short
    return out
