"""Passages of a benchmark in training documents, by spaced seeds.

Fixed masks leave out some positions of a window of terms, so that a window still hits where words at those positions
were replaced. Hashes of all windows of the documents are joined with those of the benchmark's items. Around each
hit, document and item are laid on each other and compared term by term: the longest stretch with at least
`similarity` equal terms counts if it is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.arrays import Words, mix, slices
from varlake.llm.common import stage

#: Fixed values. 1: the position must agree; 0: it is ignored. Weight 6. Wherever at most a fifth of 9 or more terms in a
#: row is replaced, at least one of the masks still hits.
MASKS = ("111011001", "110100111", "101110011", "111111", "11101011", "1011111", "11100111")
#: Seeds of the benchmark that are broadcast at once; a larger benchmark is taken in several blocks of items.
MAX_SEEDS = 2_000_000
#: Items of fewer terms count only where they are a whole line of a document: elsewhere they are common phrases.
LEAST_TERMS = 4
#: Terms of the shortest stretch that counts; of a shorter item, all of it.
MIN_WORDS = 13
SIMILARITY = 0.8

_NULL = -(1 << 63)
_OFFSETS = [np.flatnonzero([c == "1" for c in m]) for m in MASKS]
_SPAN = [len(m) for m in MASKS]


@dataclass
class Seeds:
    keys: np.ndarray  # sorted
    item: np.ndarray
    at: np.ndarray
    quick: np.ndarray  # by the keys' lowest bits: whether any key has them
    items: list[np.ndarray]  # term hashes
    ids: list


def _masked(h: np.ndarray, mask: int) -> np.ndarray:
    """Hash of the terms that the mask keeps, for each window."""
    n = len(h) - _SPAN[mask] + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, mask + 1, np.uint64)
    for k, o in enumerate(_OFFSETS[mask]):
        total += h[o : o + n] * np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64))
    return mix(total)


def _short(h: np.ndarray, n: int, similarity: float) -> list[np.ndarray]:
    """Hashes of all windows of n terms, each without as many of its terms as may be replaced, for every choice of them."""
    if len(h) < n:
        return []
    rest = n - int(n * (1 - similarity) + 1e-9)
    out = []
    for salt, kept in enumerate(combinations(range(n), rest)):
        total = np.full(len(h) - n + 1, n * 1000 + salt, np.uint64)
        for k, o in enumerate(kept):
            total += h[o : o + len(total)] * np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64))
        out.append(mix(total))
    return out


def _seeds(rows: list, similarity: float) -> Seeds:
    items, ids, keys, item, at = [], [], [], [], []
    for r in rows:
        h = Words(pa.array([r.text or ""], pa.string()), lower=True, terms=True).hashes()
        if not len(h):
            continue
        found = [_masked(h, m) for m in range(len(MASKS))] if len(h) >= max(_SPAN) else _short(h, len(h), similarity)
        for f in found:
            keys.append(f)
            item.append(np.full(len(f), len(items)))
            at.append(np.arange(len(f)))
        items.append(h)
        ids.append(r.item_id)
    keys, item, at = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (item, int), (at, int)))
    order = np.argsort(keys, kind="stable")
    quick = np.zeros(1 << 22, bool)
    quick[keys & np.uint64(len(quick) - 1)] = True
    return Seeds(keys[order], item[order], at[order], quick, items, ids)


def _longest(equal: np.ndarray, similarity: float) -> tuple[int, int]:
    """Start and end of the longest stretch of whose terms at least the share `similarity` is equal, the leftmost of equally long
    ones. An equal term adds 1 - similarity and another takes similarity, in whole millionths: the sum is 0 at least."""
    other = round(similarity * 1_000_000)
    total = np.append(0, np.cumsum(np.where(equal, 1_000_000 - other, -other)))
    start = np.searchsorted(-np.minimum.accumulate(total), -total)  # the first place where the sum was no higher
    end = int(np.argmax(np.arange(len(total)) - start))
    return int(start[end]), end


def _found(h: np.ndarray, seeds: Seeds, shorter: list[int], similarity: float, min_words: int, lines: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(item, start, terms, equal terms) of the overlaps in a document with term hashes h; lines: numbers of the terms that begin one."""
    borders = {0, len(h), *(lines.tolist() if lines is not None else ())}
    hits = set()
    for found in [*(_masked(h, m) for m in range(len(MASKS))), *(f for n in shorter for f in _short(h, n, similarity))]:
        maybe = np.flatnonzero(seeds.quick[found & np.uint64(len(seeds.quick) - 1)])
        lo, hi = np.searchsorted(seeds.keys, found[maybe], "left"), np.searchsorted(seeds.keys, found[maybe], "right")
        for p, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            hits.update((int(seeds.item[k]), p - int(seeds.at[k])) for k in range(a, b))
    out = []
    for item, shift in sorted(hits):
        own = seeds.items[item]
        if len(own) < LEAST_TERMS and not (shift in borders and shift + len(own) in borders):
            continue
        lo, hi = max(0, shift), min(len(h), shift + len(own))
        equal = h[lo:hi] == own[lo - shift : hi - shift]
        a, b = _longest(equal, similarity)
        if b - a >= min(min_words, len(own)):
            out.append((item, lo + a, b - a, int(equal[a:b].sum())))
    return out


OVERLAPS = "doc_id long, copy long, item_id long, start long, n_words long, n_equal long, item_words long"


def overlaps(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each stretch of a document (doc_id long, text) that an item of benchmark (item_id long, text) covers:
    doc_id, copy (a hash of the text), item_id, start (number of the first term), n_words, n_equal, item_words. Terms are lower-cased
    (A-Z) and end at ASCII punctuation; whole texts are searched. Null and empty texts have none, nor do items without
    terms; items shorter than the masks are sought as a whole, with as many terms replaced as similarity lets, those of
    fewer than LEAST_TERMS terms only as whole lines. Repeated rows are found each by itself."""
    spark = documents.sparkSession
    size = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size * len(MASKS) // (2 * MAX_SEEDS)))  # a term takes two characters at least
    out = None
    for block in range(blocks):
        rows = benchmark.select("item_id", "text").where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # of MAX_SEEDS seeds or so
        shared = spark.sparkContext.broadcast(_seeds(sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0, r.text or "")), similarity))

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds = shared.value
            shorter = sorted({len(x) for x in seeds.items if len(x) < max(_SPAN)})
            for batch in slices(batches, "text"):
                words = Words(batch.column("text"), lower=True, terms=True)
                h, ids, copies, rows = words.hashes(), batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist(), []
                lines = np.searchsorted(words.starts, np.flatnonzero(words.data == 10))  # the first term after each line end
                cuts = np.searchsorted(lines, words.first)
                for d, (lo, hi) in enumerate(zip(words.first[:-1], words.first[1:])):
                    found = _found(h[lo:hi], seeds, shorter, similarity, min_words, lines[cuts[d] : cuts[d + 1]] - lo)
                    rows += [(ids[d], copies[d], seeds.ids[i], s, n, e, len(seeds.items[i])) for i, s, n, e in found]
                columns = list(zip(*rows)) or [[]] * 7
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "copy", "item_id", "start", "n_words", "n_equal", "item_words"])

        part = documents.select("doc_id", F.xxhash64("text").alias("copy"), "text").mapInArrow(searched, OVERLAPS)
        out = part if out is None else out.union(part)
    return out


def contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """For each document that an item overlaps: doc_id, copy, items (their ids, sorted), n_overlaps, longest (terms of the longest overlap).
    Rows equal in doc_id and text are one document; rows of one doc_id, or of none, with other texts are others."""
    found = overlaps(documents, benchmark, similarity, min_words)
    return found.groupBy("doc_id", "copy").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.count("*").alias("n_overlaps"), F.max("n_words").alias("longest"))


def without_leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """documents less the rows that hold a passage of the benchmark, whatever their doc_id; null texts stay."""
    leaks = contaminated(documents, benchmark, similarity, min_words).select(F.coalesce("doc_id", F.lit(_NULL)).alias("__doc"), F.col("copy").alias("__copy"))
    rows = documents.withColumns({"__doc": F.coalesce("doc_id", F.lit(_NULL)), "__copy": F.xxhash64("text")})
    return rows.join(stage(leaks, "leaks"), ["__doc", "__copy"], "left_anti").select(*documents.columns)
