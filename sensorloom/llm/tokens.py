"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D, with A-Z lower-cased; on UTF-8
this is the same as working on code points. Equal words have equal hashes everywhere; different words share one
with a chance of 2^-64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2^64
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes hashed at once: bounds the scratch arrays whatever the length of a text.
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits after which all bits depend on all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=_U) * _STEP + _U(seed)) | _U(1)


@dataclass
class Words:
    """hashes, byte starts and ends of all words; offsets[i]:offsets[i+1] are those of text i.

    Byte positions count from the start of ``data``; bytes[i] is where text i starts there."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    bytes: np.ndarray
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts (one more: the end). Null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[at[0] : at[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


#: Bytes between words: ASCII white space, and every ASCII character but letters and digits.
SPACES = (32, *range(9, 14))
NO_LETTERS = tuple(b for b in range(128) if not chr(b).isalnum())


def words(texts: pa.Array, between: tuple[int, ...] = SPACES) -> Words:
    """Split and hash all words of the texts, which are runs of bytes other than those ``between`` them."""
    data, at = raw_bytes(texts)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    data = lower[data]
    blank = np.zeros(256, bool)
    blank[list(between)] = True
    space = blank[data]
    n = len(data)
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(_hashed(data, starts, ends), starts, ends, np.searchsorted(starts, at), at, data)


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), _U)
    value = constants(256, 7)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(starts, low + _BLOCK)))
        piece = data[low : ends[last - 1]]
        n = len(piece) + 1
        up, down = np.full(n, _STEP), np.full(n, _BACK)
        up[0] = down[0] = _U(1)
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        total = np.zeros(n, _U)
        np.cumsum(value[piece] * up[:-1], out=total[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((total[b] - total[a]) * down[a] + (b - a).astype(_U) * _U(0xD6E8FEB86659FD93))
        first = last
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n words in a row, whatever text they are from; shorter than the input by n - 1."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    total = np.zeros(m, _U)
    for j, c in enumerate(constants(n, 11)):
        total += hashes[j : j + m] * c
    return mix(total)


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text, sorted, and the offsets of the texts.

    A text of 1 to n-1 words has the whole sequence as its one shingle; one without words has none."""
    count = w.counts()
    have = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(have)])
    out = np.empty(at[-1], _U)
    long = np.flatnonzero(count >= n)
    if len(long):
        every = grams(w.hashes, n)
        from_ = np.repeat(w.offsets[long] - at[long], have[long])
        to = np.repeat(at[long], have[long]) + _ramp(have[long])
        out[to] = every[to + from_]
    for i in np.flatnonzero((count > 0) & (count < n)):
        part = w.hashes[w.offsets[i] : w.offsets[i + 1]]
        out[at[i]] = mix((part * constants(len(part), 13)).sum(dtype=_U, keepdims=True) + _U(len(part)))[0]
    for i in range(len(count)):
        out[at[i] : at[i + 1]].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[at[:-1][have > 0]] = True
    return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[at]


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for every length in turn."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def ramp(lengths: np.ndarray) -> np.ndarray:
    return _ramp(lengths)
