"""Words, n-grams and byte copies of whole Arrow text columns, as numpy arrays.

A batch of texts is one byte buffer and the offsets of its rows. Words are found by byte class and
hashed from prefix sums, so no Python object is made per word. Everything here is a pure function of
one batch; Spark deals out the batches.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a single longer text is taken whole.
SLICE_BYTES = 1 << 20

_U = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: For terms: every ASCII byte but letters and digits parts words.
_PUNCTUATION = np.ones(256, bool)
_PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: For bytes.translate: terms in lower case, all else blanks.
NORMAL_BYTES = np.where(_PUNCTUATION, np.uint8(32), LOWER).tobytes()
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
#: Words of up to so many bytes (an even number) are hashed two bytes at a time.
_COMMON = 32


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of text, which bounds what numpy holds at once. Worker processes run many
    tasks: what this one freed is given back to the system."""
    try:
        for batch in batches:
            _, offsets = text_bytes(batch.column(column))
            at = 0
            while at < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
                end = min(max(end, at + 1), batch.num_rows)
                yield batch.slice(at, end - at)
                at = end
    finally:
        give_back()


def give_back() -> None:
    """Memory that Arrow and the C library hold free goes back to the system, where the library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and n + 1 offsets. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of text_bytes, without a copy."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def longs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """64-bit integers as binaries: row i has values[ends[i]:ends[i + 1]]."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def mix(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers, stirred one to one."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _segments(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, the same wherever the segment stands. Segments are not empty, follow
    each other, and values between them are 0."""
    if not len(starts):
        return np.zeros(0, _U)
    begin, values = (starts - starts[0]).astype(np.int32), values[starts[0] : ends[-1]]
    sizes = np.diff(np.append(begin, len(values)))
    place = np.arange(len(values), dtype=np.int32)
    place -= np.repeat(begin, sizes)
    powers = np.full(int(sizes.max()), base, _U)
    powers[0] = 1
    out = powers.cumprod(dtype=_U)[place]
    out *= values
    return np.add.reduceat(out, begin)


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a batch, or its terms: bytes starts[i] to ends[i]; text d has words first[d] to first[d+1].

    lower: hash A-Z as a-z. terms: words end at ASCII punctuation, too.
    """

    def __init__(self, column: pa.Array, lower: bool = False, terms: bool = False):
        self.data, self.offsets = text_bytes(column)
        n = len(self.data)
        inside = ~(_PUNCTUATION if terms else _SEPARATOR)[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        begins = inside & (edge[:n] | np.concatenate([[True], ~inside[:-1]]) if n else inside)
        ends = inside & (edge[1:] | np.concatenate([~inside[1:], [True]]) if n else inside)
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self._lower, self._terms = lower, terms

    def hashes(self) -> np.ndarray:
        """64 bits for each word; equal words, equal hashes."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, _U)
        values = (LOWER if self._lower else np.arange(256)).astype(_U) + _U(1)
        values[_PUNCTUATION if self._terms else _SEPARATOR] = 0
        length = self.ends - self.starts
        powers = np.full(max(_COMMON, int(length.max())) + 1, _BYTE_BASE, _U)
        powers[0] = 1
        powers = powers.cumprod(dtype=_U)
        # longest words first: those with a byte at a place lead; two bytes are one entry of a table
        two = (values + (values * powers[1])[:, None]).reshape(-1)
        data = np.append(self.data, np.uint8(32))
        both = data[1:].astype(np.uint16) << np.uint16(8) | data[:-1]
        size = np.minimum(length, _COMMON + 1).astype(np.uint8)
        order = np.argsort(np.uint8(_COMMON + 1) - size, kind="stable")
        at_least = np.cumsum(np.bincount(size, minlength=_COMMON + 2)[::-1])[::-1]
        long = at_least[_COMMON + 1]
        at, h, out = self.starts[order[long:]], np.zeros(n - long, _U), np.zeros(n, _U)
        for place in range(0, _COMMON, 2):
            m = at_least[place + 1] - long
            if not m:
                break
            h[:m] += two.take(both.take(at[:m] + place)) * powers[place]
        out[order[long:]] = h
        # a word of an odd length took the byte behind it along, which counts where another text begins with it
        behind = np.flatnonzero((length & 1 > 0) & (length <= _COMMON))
        extra = values[data[self.ends[behind]]]
        out[behind] -= extra * powers[length[behind]]
        if long:
            own = order[:long]
            size = length[own]
            places = ranges(np.zeros(long, np.int64), size)
            out[own] = np.add.reduceat(values[self.data[ranges(self.starts[own], size)]] * powers[places], np.cumsum(size) - size)
        return mix(out ^ (length.astype(_U) * _U(0xA24BAED4963EE407)))

    def text(self, word: int) -> str:
        return bytes(self.data[self.starts[word] : self.ends[word]]).decode("utf-8", "replace")


def windows(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each n consecutive values; entry i is that of h[i:i+n]."""
    if len(h) < n:
        return np.zeros(0, _U)
    # hashes of 1, 2, 4, ... values side by side give those of n
    total, covered, part, size = None, 0, h, 1
    while True:
        if n & size:
            own = part[covered : covered + len(h) - n + 1] * _U(pow(_WORD_BASE, covered, 1 << 64))
            total, covered = own if total is None else total + own, covered + size
        if covered == n:
            break
        part = part[:-size] + part[size:] * _U(pow(_WORD_BASE, size, 1 << 64))
        size *= 2
    return mix(total + _U((salt * 0x9FB21C651E98DF25 + n) & (1 << 64) - 1))


def spans(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of h[start:end] for each pair; spans of another length get other hashes."""
    return mix(_segments(h, starts, ends, _WORD_BASE) + (ends - starts).astype(_U) * _U(0x8EBC6AF09C88C6E3))


def whole(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all n-windows that lie in one document, and the document of each."""
    count = np.maximum(np.diff(first) - n + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    return np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count), doc


def shingles(column: pa.Array, n: int, lower: bool = True) -> list[np.ndarray]:
    """For each text its sorted distinct n-word shingles as 64-bit hashes; a text of fewer words, but some, is one shingle."""
    words = Words(column, lower)
    h = words.hashes()
    grams, out = windows(h, n), []
    for d, count in enumerate(words.counts):
        lo, hi = words.first[d], words.first[d + 1]
        if count >= n:
            out.append(np.unique(grams[lo : hi - n + 1]))
        elif count:
            out.append(spans(h, np.array([lo]), np.array([hi])))
        else:
            out.append(np.zeros(0, _U))
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of [start, start + length) for each pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    at = np.cumsum(lengths) - lengths
    out[at] = starts
    out[at[1:]] -= starts[:-1] + lengths[:-1] - 1
    return np.cumsum(out)


def signed(h: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's long."""
    return pa.array(h.view(np.int64) if h.dtype == _U else h, pa.int64())


def root(parent: np.ndarray, i: int) -> int:
    """The set of i, in a union-find forest; paths are halved on the way."""
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = int(parent[i])
    return i
