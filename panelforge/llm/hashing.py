"""Hashes of words and of word windows, whole batches at once.

A word's hash takes its bytes eight at a time, each step a bijection of 64 bits that
mixes them non-linearly, so no pattern of letters makes different words agree.  A
window's hash is Rabin and Karp's: a polynomial in the words' hashes modulo the
Mersenne prime 2^61 - 1.  Of any range it is a difference of two prefix sums times a
power of the base's inverse, so all windows of a fixed length take a few vector
operations whatever the length; two different windows of n words agree under a base
with probability below n / 2^61, whatever the words.

Byte grams (``grams``) are polynomials modulo 2^64: cheap keys to meet by, never
proof that bytes are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_RNG = np.random.Generator(np.random.Philox(20240229))
#: Values of the bytes and an odd base, for grams.
_VALUES = _RNG.integers(0, 1 << 63, size=256, dtype=np.uint64) * U64(2) + U64(1)
_GRAM_BASE = int(_RNG.integers(1 << 61, 1 << 63, dtype=np.uint64)) | 1
#: Starting values of the two word hashes.
_SEEDS = _RNG.integers(0, 1 << 63, size=2, dtype=np.uint64)
#: Bytes up to which a word is hashed by lanes of eight.
SHORT = 256

#: The modulus of the windows, and their bases.
PRIME = (1 << 61) - 1
_BASES = [int(b) for b in _RNG.integers(1 << 32, PRIME, size=4, dtype=np.uint64)]
_P, _LOW30, _LOW31, _S30, _S31, _S61 = U64(PRIME), U64((1 << 30) - 1), U64((1 << 31) - 1), U64(30), U64(31), U64(61)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}

BREAK = np.zeros(256, bool)
BREAK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Masks of a lane's first 0 to 8 bytes.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def folded(x: np.ndarray) -> np.ndarray:
    """Any 64 bits as a number of the same residue, at most the prime + 7."""
    return (x & _P) + (x >> _S61)


def shifted(x: np.ndarray) -> np.ndarray:
    """A folded number times 2^31, below 2^62."""
    return (x >> _S30) + ((x & _LOW30) << _S31)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Folded products of folded numbers: by halves of 30 and 31 bits, as 2^61 is 1."""
    ah, al, bh, bl = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    return folded((ah * bh << U64(1)) + shifted(ah * bl + al * bh) + al * bl)


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base^0 ... base^(n-1) modulo the prime, or of its inverse."""
    known = _POWERS.get((base, inverse))
    if known is None or len(known) < n:
        step = pow(_BASES[base], -1, PRIME) if inverse else _BASES[base]
        known = np.ones(1, U64)
        while len(known) < max(n, 1 << 12):
            known = np.concatenate((known, times(known, np.full(1, pow(step, len(known), PRIME), U64))))
        if len(known) <= 1 << 22:
            _POWERS[base, inverse] = known
    return known[:n]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Folded sums of the values times the base's powers, before each place."""
    terms = times(folded(values), powers(base, len(values)))
    out = np.zeros(len(values) + 1, U64)
    # sums of halves stay below 2^64 for 2^33 values
    out[1:] = folded(shifted(folded(np.cumsum(terms >> _S31))) + folded(np.cumsum(terms & _LOW31)))
    return out


def windows(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hashes of all windows of ``length`` consecutive values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    sums = prefix(values, base)
    hashes = times(folded(sums[length:] + (U64(2 * PRIME) - sums[:-length])), powers(base, n, inverse=True))
    return mixed(np.where(hashes >= _P, hashes - _P, hashes))


def grams(raw: np.ndarray, length: int) -> np.ndarray:
    """Keys of all strings of ``length`` bytes: equal for equal strings, seldom else."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    up, down = _gram_powers(len(raw))
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum(_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * down[:n])


_GRAM_POWERS: list[np.ndarray] = []


def _gram_powers(n: int) -> list[np.ndarray]:
    if not _GRAM_POWERS or len(_GRAM_POWERS[0]) < n:
        out = []
        for step in (_GRAM_BASE, pow(_GRAM_BASE, -1, 1 << 64)):
            row = np.full(max(n, 1 << 16), step, U64)
            row[0] = 1
            out.append(np.cumprod(row, dtype=U64))
        if n > 1 << 23:
            return out
        _GRAM_POWERS[:] = out
    return _GRAM_POWERS


def sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    """Minimum of every ``length`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= length:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = length - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary array, nulls empty, and the n + 1 offsets."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of all words, and each document's first word (n + 1)."""
    inside = ~BREAK[raw]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[edges] = inside[edges]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[edges - 1] = inside[edges - 1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, zeros behind the end."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    return np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))


def first_bytes(lane: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Lanes of which only the first ``n`` (0 to 8) bytes count."""
    return lane & _MASKS[n]


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, which: int = 0, lower: bool = False) -> np.ndarray:
    raw = LOWER[raw] if lower else raw
    size, lane = ends - begins, lanes(raw)
    out = mixed(_SEEDS[which] ^ size.astype(U64))
    at = np.flatnonzero(size <= SHORT)
    done = 0
    while len(at := at[size[at] > done]):
        out[at] = mixed(out[at] ^ first_bytes(lane[begins[at] + done], np.minimum(size[at] - done, 8)))
        done += 8
    for i in np.flatnonzero(size > SHORT).tolist():
        digest = hashlib.blake2b(raw[begins[i] : ends[i]].tobytes(), digest_size=8, salt=b"word%d" % which)
        out[i] = int.from_bytes(digest.digest(), "little")
    return out
