"""Byte-level BPE, encoding and decoding, over columns of whole texts.

Distinct pieces of a batch are laid out in matrices by length. In each round every row merges its leftmost pair of
least rank; pairs are looked up in an open-addressing hash table, and rows without a pair left leave the matrix.
Ranks come from a public vocabulary file (base64 token, blank, rank), which is broadcast: its size does not depend
on the data.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from varlake.llm.arrays import ranges, slices

_NONE = np.int32(2**31 - 1)
#: Bytes of a piece beyond which a heap merges it; a matrix would take a round for each of its merges.
LONG = 512
#: Pieces that a task remembers at most; then it forgets all.
REMEMBERED = 100_000


class Vocabulary:
    def __init__(self, lines: bytes):
        tokens = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines.splitlines() if x.strip())}
        size = max(tokens.values()) + 1
        by_id = [b""] * size
        for t, r in tokens.items():
            by_id[r] = t
        lengths = np.array([len(t) for t in by_id], np.int64)
        self.bytes, self.starts, self.lengths = np.frombuffer(b"".join(by_id), np.uint8), np.append(0, np.cumsum(lengths)[:-1]), lengths
        self.single = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        digits = [b"%d," % i for i in range(size)]
        lengths = np.array([len(d) for d in digits], np.int64)
        self.digits, self.digit_starts, self.digit_lengths = np.frombuffer(b"".join(digits), np.uint8), np.append(0, np.cumsum(lengths)[:-1]), lengths
        pairs = {(tokens[t[:k]] << 32) + tokens[t[k:]]: r for t, r in tokens.items() for k in range(1, len(t)) if t[:k] in tokens and t[k:] in tokens}
        self._place(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _place(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(4 * len(keys)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, (1 << 64) - 1, np.uint64), np.full(1 << bits, _NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):  # those that find their slot taken go on to the next
            free = self._keys[slot] == np.uint64((1 << 64) - 1)
            _, first = np.unique(slot, return_index=True)
            put = np.zeros(len(keys), bool)
            put[first] = True
            put &= free
            self._keys[slot[put]], self._values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self._mask

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id (and so rank) of each merged pair, _NONE where there is no such token."""
        key = (left.astype(np.uint64) << np.uint64(32)) + right.astype(np.uint64)
        slot, out, open_ = self._slot(key), np.full(len(key), _NONE, np.int32), np.arange(len(key))
        while len(open_):
            at = slot[open_]
            found = self._keys[at] == key[open_]
            out[open_[found]] = self._values[at[found]]
            open_ = open_[~found & (self._keys[at] != np.uint64((1 << 64) - 1))]
            slot[open_] = (slot[open_] + 1) & self._mask
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        length = np.array([len(p) for p in pieces], np.int64)
        for i in np.flatnonzero(length > LONG):
            out[i] = self._merge_long(pieces[i])
        lower = 0
        while lower < LONG:
            upper = max(2, lower * 2)
            rows = np.flatnonzero((length > lower) & (length <= upper))
            for lo in range(0, len(rows), step := max(1, (1 << 20) // upper)):
                self._merge_matrix([pieces[i] for i in rows[lo : lo + step]], rows[lo : lo + step], length, upper, out)
            lower = upper
        for i in np.flatnonzero(length == 0):
            out[i] = np.zeros(0, np.int32)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: np.ndarray, length: np.ndarray, width: int, out: list) -> None:
        size = length[rows].copy()
        filled = np.arange(width) < size[:, None]
        ids = np.zeros((len(rows), width), np.int32)
        ids[filled] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((len(rows), width), _NONE, np.int32)  # of the pair that begins there
        pair = np.arange(width) < (size - 1)[:, None]
        r, c = np.nonzero(pair)
        rank[r, c] = self.merged(ids[r, c], ids[r, c + 1])
        column = np.arange(width - 1)
        while len(rows):
            at = rank.argmin(1)
            every = np.arange(len(rows))
            low = rank[every, at]
            done = low == _NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = ids[k, : size[k]].copy()
                keep = ~done
                rows, ids, rank, size, at, low = rows[keep], ids[keep], rank[keep], size[keep], at[keep], low[keep]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            ids[every, at] = low
            after = column > at[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(after, rank[:, 1:], rank[:, :-1])
            rank[:, -1] = _NONE
            size -= 1
            rank[every, at] = _NONE
            k = np.flatnonzero(at + 1 < size)
            rank[k, at[k]] = self.merged(ids[k, at[k]], ids[k, at[k] + 1])
            k = np.flatnonzero(at > 0)
            rank[k, at[k] - 1] = self.merged(ids[k, at[k] - 1], ids[k, at[k]])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, by a heap of (rank, place) over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        first = self.merged(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                pair = (ids[i], ids[j])
                if pair not in known:
                    known[pair] = int(self.merged(np.array(pair[:1]), np.array(pair[1:]))[0])
                if known[pair] != _NONE:
                    heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([t for t, a in zip(ids, alive) if a], np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids, one after another."""
        return self.bytes[ranges(self.starts[ids], self.lengths[ids])]


class Encoder:
    """Encodes texts piece by piece and remembers pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 offsets of the texts in them."""
        if len(self.number) > REMEMBERED:
            self._forget()
        pieces = [self.find(t or "") for t in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(pieces)) if p not in self.number]
        if new:
            found = self.vocabulary.encode_pieces([p.encode() for p in new])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            lengths = np.array([len(f) for f in found], np.int64)
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
            self.lengths = np.append(self.lengths, lengths)
            self.ids = np.concatenate([self.ids, *found])
        code = np.fromiter(map(self.number.__getitem__, chain.from_iterable(pieces)), np.int64)
        lengths = self.lengths[code]
        ends = np.append(0, np.cumsum(lengths))
        return self.ids[ranges(self.starts[code], lengths)], ends[np.append(0, np.cumsum([len(p) for p in pieces]).astype(int))]


def _shared(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


#: The last vocabulary used.
_loaded: dict[tuple[int, int], Vocabulary] = {}


def _vocabulary(lines: bytes) -> Vocabulary:
    """One for each worker process, however many tasks it runs."""
    key = (len(lines), hash(lines))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(lines)
    return _loaded[key]


def _kept(documents: DataFrame, keep: list[str] | None, names: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    keep = [c for c in (documents.columns if keep is None else keep) if c not in names]
    return documents.select(*keep, documents["text"].alias("__text")), keep


def encode(documents: DataFrame, vocabulary: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """The columns named in keep (all, if None) with tokens array<int> and n_tokens long: each match of pattern in the whole
    text is encoded by itself, without special tokens. vocabulary is the path of a rank file, read by the driver. Null
    and empty texts have no tokens. Columns of the input called tokens or n_tokens give way."""
    source, keep = _kept(documents, keep, ("tokens", "n_tokens"))
    schema = T.StructType([*source.drop("__text").schema.fields, T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])
    lines = _shared(documents, vocabulary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(lines.value), pattern)
        for batch in slices(batches, "__text"):
            ids, ends = encoder.encode(batch.column("__text").to_pylist())
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), tokens, pa.array(np.diff(ends))], names=[f.name for f in schema])

    return source.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """All columns with decoded binary: the bytes of tokens. Null tokens decode to no bytes."""
    schema = T.StructType([*encoded.drop("decoded").schema.fields, T.StructField("decoded", T.BinaryType())])
    lines = _shared(encoded, vocabulary)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(lines.value)
        for batch in batches:
            data = [v.decode(np.array(ids, np.int64)).tobytes() for ids in (x or [] for x in batch.column("tokens").to_pylist())]
            yield pa.record_batch([*(batch.column(n) for n in batch.schema.names if n != "decoded"), pa.array(data, pa.binary())], names=[f.name for f in schema])

    return encoded.drop("decoded").mapInArrow(decoded, schema)


def round_trip(documents: DataFrame, vocabulary: str, pattern: str, keep: list[str]) -> DataFrame:
    """The columns named in keep with n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 (of the
    decoded bytes), in lowercase hex: encode and decode in one pass, without the tokens in between."""
    source, keep = _kept(documents, keep, ("n_tokens", "ids_sha256", "decoded_sha256"))
    schema = T.StructType([*source.drop("__text").schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    lines = _shared(documents, vocabulary)

    def digests(data: np.ndarray, size: np.ndarray, ends: np.ndarray, spare: int) -> list[str]:
        at = np.append(0, np.cumsum(size))[ends]
        view = memoryview(np.ascontiguousarray(data))
        return [hashlib.sha256(view[lo : max(lo, hi - spare)]).hexdigest() for lo, hi in zip(at[:-1], at[1:])]

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(lines.value)
        encoder = Encoder(v, pattern)
        for batch in slices(batches, "__text"):
            ids, ends = encoder.encode(batch.column("__text").to_pylist())
            decimal = v.digits[ranges(v.digit_starts[ids], v.digit_lengths[ids])]
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), pa.array(np.diff(ends)), pa.array(digests(decimal, v.digit_lengths[ids], ends, 1)), pa.array(digests(v.decode(ids), v.lengths[ids], ends, 0))], names=[f.name for f in schema])

    return source.mapInArrow(checked, schema)
