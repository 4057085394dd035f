"""Removal of passages that occur earlier in the corpus, by level-wise doubling.

A passage is a window of n consecutive words. The first level looks at windows of n / 4 words, and only at one for each
n-window: the one with the least hash in it, which equal windows have at the same place. Windows that are repeated at
one length alone are extended to twice that length; at length n those that survived are sorted under their hashes, and
each but the first occurrence marks its words. What a level keeps for the next is a bitmap of fixed size: it never
loses a repeated window, and where it is too small it only lets more candidates through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.arrays import Words, signed, slices, whole, windows
from varlake.llm.common import bitmap, in_bitmap, stage

#: Bits of a level's bitmap, at most (16 MB); it has 16 for each repeated window up to that.
MAX_BITS = 1 << 27
#: A window whose first-level part has more than this share of all such parts is dealt out over SALTS tasks.
HOT_SHARE, SALTS = 1e-4, 64
_NULL = -(1 << 63)


class Candidates:
    """n-windows of a batch: their starts and documents, the first-level part of each (place and hash)."""

    def __init__(self, column: pa.Array, n: int):
        self.words, self.n, self.base = Words(column), n, max(1, n // 4)
        self.h = self.words.hashes()
        self.starts, self.document = whole(self.words.first, n)
        self.short = windows(self.h, self.base)
        self.part = self._least()[self.starts] if len(self.starts) else np.zeros(0, int)

    def _least(self) -> np.ndarray:
        """For each place the leftmost least of the n - base + 1 hashes from there on."""
        width = self.n - self.base + 1
        value, at = self.short, np.arange(len(self.short))
        step = 1
        while step * 2 <= width:
            value, at = _lesser(value, at, step)
            step *= 2
        return _lesser(value, at, width - step)[1] if width > step else at

    def survivors(self, levels: list[np.ndarray]) -> np.ndarray:
        """Numbers of the windows that all levels so far let through."""
        keep = np.arange(len(self.starts))
        if levels:
            keep = keep[in_bitmap(levels[0], self.short[self.part].view(np.int64))]
        if len(levels) > 1:
            double = windows(self.h, 2 * self.base).view(np.int64)
            keep = keep[in_bitmap(levels[1], double[self.extended(keep)])]
        return keep

    def extended(self, keep: np.ndarray) -> np.ndarray:
        """Start of the second-level window of each n-window: it holds the first-level part and lies in the n-window."""
        place = self.part[keep]
        return np.where(place - self.starts[keep] <= self.n - 2 * self.base, place, place - self.base)


def _lesser(value: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    right = value[step:] < value[: len(value) - step]
    return np.where(right, value[step:], value[: len(value) - step]), np.where(right, at[step:], at[: len(at) - step])


def _repeated(parts: DataFrame) -> tuple[np.ndarray | None, list[int]]:
    """Bitmap of the values (part long) that occur more than once, None if there are none; and the few that are very frequent."""
    counted = stage(parts.groupBy("part").agg(F.sum("n").alias("n")).where("n > 1"), "level")
    kept, total = counted.agg(F.count("*"), F.sum("n")).first()
    if not kept:
        return None, []
    bits = min(MAX_BITS, max(1 << 16, 1 << int(16 * kept - 1).bit_length()))
    hot = counted.where(F.col("n") > max(10_000, total * HOT_SHARE)).select("part").collect()  # 1 / HOT_SHARE rows at most
    return bitmap(counted, "part", bits), [r.part for r in hot]


def repeated_windows(documents: DataFrame, n: int = 20) -> DataFrame | None:
    """(doc_id, copy, place): starts of the n-windows whose words also start earlier, in a document of a smaller doc_id or earlier
    in the same; copy is a hash of the row's text. None where a level has no candidates left."""
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc_id"), "text", F.xxhash64("text").alias("copy"))
    levels: list[np.ndarray] = []
    hot: list[int] = []
    for level in range(2):
        shared = context.broadcast(levels)

        def parts(batches: Iterator[pa.RecordBatch], shared=shared, level=level) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                c = Candidates(batch.column("text"), n)
                keep = c.survivors(shared.value)
                place = np.unique(c.extended(keep) if level else c.part[keep])
                found, count = np.unique((windows(c.h, 2 * c.base) if level else c.short)[place], return_counts=True)
                yield pa.record_batch([signed(found), pa.array(count, pa.int64())], names=["part", "n"])

        kept, frequent = _repeated(rows.select("text").mapInArrow(parts, "part long, n long"))
        if kept is None:
            return None
        levels.append(kept)
        hot = hot or frequent
    shared = context.broadcast((levels, np.sort(np.array(hot, np.int64))))

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, hot = shared.value
        for batch in slices(batches, "text"):
            c = Candidates(batch.column("text"), n)
            keep = c.survivors(levels)
            start, document = c.starts[keep], c.document[keep]
            first, second = windows(c.h, n)[start], windows(c.h, n, 1)[start].view(np.uint32)[::2].view(np.int32)
            ids = batch.column("doc_id").to_numpy()[document]
            salt = np.where(np.isin(c.short[c.part[keep]].view(np.int64), hot), ids % SALTS, -1)
            place = start - c.words.first[document]
            yield pa.record_batch([signed(first), pa.array(second, pa.int32()), pa.array(salt, pa.int32()), pa.array(ids, pa.int64()), pa.array(place, pa.int32()), batch.column("copy").take(pa.array(document))], names=order)

    order = ["first", "second", "salt", "doc_id", "place", "copy"]
    found = rows.mapInArrow(survivors, "first long, second int, salt int, doc_id long, place int, copy long")

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that follow one of the same window at another place; of windows that are dealt out over tasks the first rows, too,
        marked. Rows of the first one's doc_id and place are first as well; equal rows are one."""
        last = head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, salt, ids, place, copy = (batch.column(k).to_numpy() for k in order)
            same, equal = np.zeros(len(a), bool), np.zeros(len(a), bool)
            same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (salt[1:] == salt[:-1])
            same[0] = last is not None and last[:3] == (a[0], b[0], salt[0])
            equal[1:] = same[1:] & (ids[1:] == ids[:-1]) & (place[1:] == place[:-1]) & (copy[1:] == copy[:-1])
            equal[0] = last == (a[0], b[0], salt[0], ids[0], place[0], copy[0])
            at = np.maximum.accumulate(np.where(same, -1, np.arange(len(a))))
            id_, place_ = head or (ids[0], place[0])
            opens = (ids == np.where(at < 0, id_, ids[at])) & (place == np.where(at < 0, place_, place[at]))
            last = (a[-1], b[-1], salt[-1], ids[-1], place[-1], copy[-1])
            head = (ids[at[-1]], place[at[-1]]) if at[-1] >= 0 else head
            out = batch.select(["first", "second", "doc_id", "copy", "place"]).append_column("open", pa.array(opens))
            yield out.filter(pa.array(~equal & (~opens | (salt >= 0))))

    sorted_ = found.repartition("first", "second", "salt").sortWithinPartitions(*order)
    marked = sorted_.mapInArrow(later, "first long, second int, doc_id long, copy long, place int, open boolean")
    if not hot:
        return marked.select("doc_id", "copy", "place")
    marked = stage(marked, "marked")
    # the first rows of each task: all but those at the first place of all are later ones
    opens = marked.where("open").selectExpr("doc_id", "copy", "place", "rank() OVER (PARTITION BY first, second ORDER BY doc_id, place) AS nth")
    return marked.where("NOT open").select("doc_id", "copy", "place").union(opens.where("nth > 1").select("doc_id", "copy", "place"))


def dedup_substrings(documents: DataFrame, n: int = 20) -> DataFrame:
    """For each row of documents (doc_id long, text): doc_id, n_words, n_removed and kept, the words that stay joined by one
    space. A word goes if a window of n words over it starts earlier in the corpus, too; windows are judged on the input.

    Words are [^\\x20\\x09-\\x0D]+, unchanged; null texts have none, texts of fewer than n words keep all. A null doc_id comes
    first in the order. Rows that repeat a doc_id (or have none) count as one document: equal windows at equal
    places are no repeats of each other; each row loses only words of its own repeats."""
    found = repeated_windows(documents, n)
    rows = documents.select("doc_id", "text").withColumn("__id", F.coalesce("doc_id", F.lit(_NULL))).withColumn("__copy", F.xxhash64("text"))
    if found is None:
        rows = rows.select("doc_id", "text", F.array().cast("array<int>").alias("places"))
    else:
        found = found.groupBy(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy")).agg(F.collect_set("place").alias("places"))
        rows = rows.join(found, ["__id", "__copy"], "left").select("doc_id", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            total, places = len(words.starts), batch.column("places")
            lengths = np.array(places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), int)
            at = places.flatten().to_numpy() + np.repeat(words.first[:-1], lengths)
            end = np.repeat(words.first[1:], lengths)
            at, end = at[at < end], end[at < end]
            cover = np.bincount(at, minlength=total + 1)[: total + 1] - np.bincount(np.minimum(at + n, end), minlength=total + 1)[: total + 1]
            gone = np.cumsum(cover)[:total] > 0
            kept, removed = [], np.append(0, np.cumsum(gone))[words.first]
            data, starts, ends = words.data.tobytes(), words.starts, words.ends
            for lo, hi in zip(words.first[:-1], words.first[1:]):
                stay = np.flatnonzero(~gone[lo:hi]) + lo
                kept.append(b" ".join([data[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())]).decode("utf-8", "replace"))
            yield pa.record_batch([batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(np.diff(removed), pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
