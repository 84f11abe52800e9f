"""Words, lines and shingles of whole Arrow batches as numpy arrays.

Texts are handled as UTF-8 bytes.  The separators (space, tab, LF, VT, FF, CR)
are single bytes, so cutting bytes equals cutting code points.  All words of a
batch are hashed together, eight bytes of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20   # bytes of text handled at once (a longer text is its own chunk)
LANES = 4         # steps of eight bytes that all ranges take together
SPACE = b" \t\n\x0b\x0c\r"

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=_U) + _U(seed * 1_000_003)) * _U(0x9E3779B97F4A7C15))


class Hashing(NamedTuple):
    """A hash function: its seed, and what each byte counts as (None: itself)."""
    seed: int
    counts_as: np.ndarray | None


def byte_values(seed: int, lower: bool) -> Hashing:
    """The hash function of a seed; with ``lower``, A-Z count as a-z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] = t[97:123]
    return Hashing(int(seeds(1, seed)[0]), t if lower else None)


def is_space() -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(SPACE)] = True
    return t


def hash_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, how: Hashing) -> np.ndarray:
    """64-bit hashes of the byte ranges ``buf[start:end]``.

    Eight bytes at a time enter a state that is mixed after each; ranges of one
    length up to eight bytes never collide.  Ranges over ``LANES`` steps are
    hashed by XXH3.
    """
    import xxhash

    if how.counts_as is not None:
        buf = how.counts_as[buf]
    size, seed = ends - starts, _U(how.seed)
    out = mix64(size.astype(_U) * _U(0x9E3779B97F4A7C15) + seed)
    short = size <= 8 * LANES
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))   # the eight bytes from each place on
    on = np.flatnonzero(short & (size > 0))
    for step in range(0, 8 * LANES, 8):
        on = on[size[on] > step]
        if not len(on):
            break
        unused = 8 * (8 - np.minimum(size[on] - step, 8))
        lane = eight[starts[on] + step] & (~_U(0) >> unused.astype(_U))
        out[on] = mix64((out[on] ^ lane * _U(0xD1342543DE82EF95)) * _U(0xA0761D6478BD642F) + seed)
    if not short.all():
        raw = buf.tobytes()
        for i in np.flatnonzero(~short).tolist():
            out[i] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]], how.seed)
    return out


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, row offsets into the bytes); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if texts.null_count:  # bytes below a null, if any, are not text
        texts = pa.array(["" if x is None else x for x in texts.to_pylist()], texts.type)
        yield from chunks(texts)
        return
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(off, off[a] + CHUNK, "right")) - 1))
        yield a, b, buf[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_ranges(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per row the index of its first word (with the end)."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = ~is_space()[buf]
    first = np.zeros(n + 1, bool)
    first[off] = True
    begin = w.copy()
    begin[1:] &= ~w[:-1] | first[1:n]
    stop = w.copy()
    stop[:-1] &= ~w[1:] | first[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, off)


def shingles(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each row, and the row offsets.

    A row with fewer words (but one at least) has its whole sequence as one shingle.
    """
    n = np.diff(row)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    off = np.concatenate([[0], np.cumsum(count)])
    idx = np.repeat(row[:-1] - off[:-1], count) + np.arange(off[-1])
    width = np.repeat(np.minimum(n, k), count)
    s = width.astype(_U) * _U(0xA0761D6478BD642F)
    short = bool((width < k).any())
    for j in range(k):
        if short:
            on = width > j
            s[on] = s[on] * _U(0xE7037ED1A0B428DB) + h[idx[on] + j]
        else:
            s = s * _U(0xE7037ED1A0B428DB) + h[idx + j]
    return mix64(s), off


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased."""
    how = byte_values(1, lower=True)
    for _, _, buf, off in chunks(texts):
        starts, ends, row = word_ranges(buf, off)
        s, at = shingles(hash_ranges(buf, starts, ends, how), row, k)
        for i in range(len(off) - 1):
            yield np.unique(s[at[i]:at[i + 1]])
