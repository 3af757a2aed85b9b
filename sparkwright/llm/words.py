"""Words and word n-grams of Arrow text columns as 64-bit hashes, in whole-array steps.

Texts are never cut: long columns are worked through in pieces that end between words,
so the memory beside the text is a few bytes per word. Hashes are polynomials over random
byte values, finished by a bit mixer; two different words or n-grams get the same value
with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BYTE_BASE = U(0x9E3779B97F4A7C15)
WORD_BASE = U(0xD1342543DE82EF95)
WORD_BASE_2 = U(0xAF251AF3B0F025B5)
PIECE = 1 << 18


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


# Separators: ASCII white space; or every ASCII character but digits and letters.
SPACE = _flags((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = _flags((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


# A random value for each byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


# The longest tables so far of each base; shorter ones are their beginnings.
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, or more."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) < n:
        size = 1 << max(12, int(n).bit_length())
        inverse = pow(int(base), -1, 1 << 64)
        out = []
        for b in (int(base), inverse):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U))
        known = _POWERS[int(base)] = (out[0], out[1])
    return known


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (one more offset at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=width)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each text's first word
    (one more at the end)."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = ~separators[data]
    start = inside[:-1].copy()
    start[1:] &= ~inside[:-2]
    cuts = offsets[offsets < len(data)]
    start[cuts] = inside[:-1][cuts]
    last = inside[:-1] & ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] = inside[before]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word, byte pieces at a time."""
    out = np.empty(len(starts), dtype=U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = powers(BYTE_BASE, hi - lo)
        sums = np.zeros(hi - lo + 1, dtype=U)
        np.cumsum(BYTE_VALUE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s])
        i = j
    return out


def words_of(
    texts: pa.Array | pa.ChunkedArray, lower: bool = False, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the index of each text's first word. Texts
    are worked through some rows at a time; a longer text is alone."""
    data, offsets = text_bytes(texts)
    hashes, first, n = [], [np.zeros(1, dtype=np.int64)], 0
    for lo, hi in spans_of_rows(offsets, PIECE):
        part = data[offsets[lo] : offsets[hi]]
        if lower:
            part = LOWER[part]
        starts, ends, at = word_bounds(part, offsets[lo : hi + 1] - offsets[lo], separators)
        hashes.append(hash_words(part, starts, ends))
        first.append(at[1:] + n)
        n += len(starts)
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=U), np.concatenate(first)


def grams(hashes: np.ndarray, k: int, base: np.uint64 = WORD_BASE) -> np.ndarray:
    """Hashes of all runs of k words; runs that cross two texts are included."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    up, down = powers(base, len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * down[:n])


def spans_of_rows(first: np.ndarray, limit: int = 1 << 18):
    """Row ranges of at most ``limit`` words each (a longer single text is alone)."""
    lo, n = 0, len(first) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values."""
    return pa.ListArray.from_arrays(
        pa.array(np.asarray(offsets, dtype=np.int32)), pa.array(values, type=kind)
    )
