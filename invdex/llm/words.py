"""Vectorised word scanning over Arrow string data: word boundaries, 64-bit
word hashes and rolling n-gram hashes, computed over whole slices of a batch
with numpy. Hashes only select candidates or count features; where a contract
asks for exact matches the caller verifies the bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20


def _class(chars: bytes, inside: bool) -> np.ndarray:
    t = np.full(256, not inside)
    t[list(chars)] = inside
    return t


# Byte classes: bytes from 0x80 up belong to non-ASCII characters and are word
# bytes in both classes, so a word never splits a character.
NOT_SPACE = _class(bytes([0x20, *range(0x09, 0x0E)]), False)
ALNUM = _class(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]), True)
AS_IS = np.arange(256, dtype=np.uint8)
FOLD = AS_IS.copy()
FOLD[0x41:0x5B] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1024
_POW = np.cumprod(np.full(CHUNK, np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64), dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def slices(text: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole rows of about
    ``max_bytes`` (one longer row makes a slice of its own)."""
    text = text.cast(pa.large_string())
    _, off_buf, data_buf = text.buffers()
    n = len(text)
    if n == 0:
        return
    off = np.frombuffer(off_buf, np.int64)[text.offset:text.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def spans(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every word; words never cross rows."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(w & (edge[:-1] | ~np.concatenate(([False], w[:-1]))))
    ends = np.flatnonzero(w & (edge[1:] | ~np.concatenate((w[1:], [False])))) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray,
                most: int | None = None, block: int = 1 << 19) -> np.ndarray:
    """One 64-bit hash per word, over blocks of about ``block`` bytes. Words are read
    whole: longer ones in chunks of 1,024 bytes, chained in their order.

    ``most``: hash only the first so many bytes (word prefixes)."""
    lens = ends - starts
    if most is not None:
        lens = np.minimum(lens, most)
    if not len(starts):
        return np.empty(0, np.uint64)
    chunks = np.maximum(-(-lens // CHUNK), 1)
    first = np.cumsum(chunks) - chunks
    within = (np.arange(int(chunks.sum())) - np.repeat(first, chunks)) * CHUNK
    at, size = np.repeat(starts, chunks) + within, np.minimum(np.repeat(lens, chunks) - within, CHUNK)
    sums = np.empty(len(at), np.uint64)
    cum = np.concatenate(([0], np.cumsum(size)))
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(cum, cum[a] + block, "right")) - 1)
        cs = cum[a:b] - cum[a]
        pos = np.arange(int(cum[b] - cum[a])) - np.repeat(cs, size[a:b])
        sums[a:b] = np.add.reduceat(_BYTE[fold[buf[np.repeat(at[a:b], size[a:b]) + pos]]] * _POW[pos], cs)
        a = b
    out = sums[first]
    long = np.flatnonzero(chunks > 1)
    k = 1
    while len(long):
        out[long] = mix(out[long] * _M1 + np.uint64(k)) + sums[first[long] + k]
        k += 1
        long = long[chunks[long] > k]
    return mix(out + lens.astype(np.uint64) * _M2)


def same_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """Do the words number ``a`` and ``b`` have the same bytes, pair by pair?"""
    lens = ends - starts
    ok = lens[a] == lens[b]
    todo = np.flatnonzero(ok & (a != b))
    cum = np.concatenate(([0], np.cumsum(lens[a[todo]])))
    i = 0
    while i < len(todo):
        j = max(i + 1, int(np.searchsorted(cum, cum[i] + block, "right")) - 1)
        one = todo[i:j]
        size, cs = lens[a[one]], cum[i:j] - cum[i]
        pos = np.arange(int(cum[j] - cum[i])) - np.repeat(cs, size)
        ok[one] = np.logical_and.reduceat(buf[np.repeat(starts[a[one]], size) + pos] == buf[np.repeat(starts[b[one]], size) + pos], cs)
        i = j
    return ok


def chain(acc: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Extend n-gram hashes by one more word."""
    return mix(acc * _M1 + nxt)


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word index) of every n-word window inside one row."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = mix(h[:len(h) - n + 1])
    for k in range(1, n):
        acc = chain(acc, h[k:len(h) - n + 1 + k])
    at = np.flatnonzero(row[:len(h) - n + 1] == row[n - 1:])
    return acc[at], at
