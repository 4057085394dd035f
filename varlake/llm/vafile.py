"""Clustering round centroids by a VA-file (vector approximation file).

Every vector is written twice: whole, to flat files in the shared folder, and as cells of few bits a dimension, to a
table that names the vector's place. A round reads the cells. Two lookup tables for each centroid, by dimension and cell,
add up to the least and the most squared distance that a vector of these cells can have. Where one centroid's most is
below all others' least, that is the nearest; only where these intervals overlap is the vector itself fetched, by coalesced
reads of byte ranges. The sums of clusters change by the vectors that go from one to another, which are fetched, too.

All numbers are integers, so sums do not depend on their order.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import shared_folder, stage
from varlake.llm.warc import coalesced

#: Buckets of a dimension from which its cells are made up; vectors of a batch; components beyond which a vector is left out.
BUCKETS, BATCH, MOST = 1024, 8192, 1 << 27


def kept(embeddings: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v array<int>: floor(scale * x) of each component x, as double. Vectors that are null, have not exactly size components, or
    hold one that is null, not finite or (scaled) above 2^27 (squared distances may not fit in a long) are left out."""
    rows = embeddings.where(F.size("embedding") == size).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("wide"))
    rows = rows.where(F.forall("wide", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) <= MOST)))
    # the planner may ask for v of rows that are left out
    return rows.select("vec_id", F.transform("wide", lambda x: F.floor(x * scale).try_cast("int")).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def cells(histogram: np.ndarray, low: int, width: int, count: int) -> np.ndarray:
    """Lower borders of at most count cells over buckets low, low + width, ...: neighbours are joined, where that adds least
    to the sum over vectors of the squared width of their cells. As many values as cells: a cell for each."""
    used = np.flatnonzero(histogram)
    start, end, weight = used.tolist(), (used + 1).tolist(), histogram[used].astype(float).tolist()
    after, alive = list(range(1, len(used) + 1)), [True] * len(used)
    cost = lambda i, j: (weight[i] + weight[j]) * (end[j] - start[i]) ** 2 - weight[i] * (end[i] - start[i]) ** 2 - weight[j] * (end[j] - start[j]) ** 2
    heap = [(cost(i, i + 1), i, i + 1, end[i], end[i + 1]) for i in range(len(used) - 1)]
    heapify(heap)
    left = len(used)
    before = list(range(-1, len(used) - 1))
    while left > count:
        _, i, j, end_i, end_j = heappop(heap)
        if not (alive[i] and alive[j] and after[i] == j and end[i] == end_i and end[j] == end_j):
            continue
        weight[i], end[i], after[i], alive[j] = weight[i] + weight[j], end[j], after[j], False
        left -= 1
        if after[i] < len(used):
            before[after[i]] = i
            heappush(heap, (cost(i, after[i]), i, after[i], end[i], end[after[i]]))
        if before[i] >= 0:
            heappush(heap, (cost(before[i], i), before[i], i, end[before[i]], end[i]))
    return np.array([low + start[i] * width for i in range(len(used)) if alive[i]], np.int64)


class Grid:
    """The cells of each dimension: borders, least and most value of each."""

    def __init__(self, borders: list[np.ndarray], low: np.ndarray, high: np.ndarray, bits: int):
        self.borders, self.bits = borders, bits
        n = 1 << bits
        self.low, self.high = np.zeros((len(borders), n), np.int64), np.zeros((len(borders), n), np.int64)
        for d, b in enumerate(borders):
            self.low[d, : len(b)] = np.maximum(b, low[d])
            self.high[d, : len(b)] = np.append(b[1:] - 1, high[d])

    def pack(self, v: np.ndarray) -> np.ndarray:
        """Cells of vectors (rows), bits of each dimension after another, as bytes."""
        own = np.stack([np.searchsorted(b, v[:, d], side="right") - 1 for d, b in enumerate(self.borders)], 1).astype(np.uint16)
        bits = (own[:, :, None] >> np.arange(self.bits, dtype=np.uint16)) & 1
        return np.packbits(bits.reshape(len(v), -1).astype(np.uint8), axis=1, bitorder="little")

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(packed, axis=1, count=len(self.borders) * self.bits, bitorder="little").reshape(len(packed), len(self.borders), self.bits)
        return (bits.astype(np.uint16) << np.arange(self.bits, dtype=np.uint16)).sum(2)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most squared distance by dimension, cell and centroid."""
        c = centroids.T[:, None, :]
        low, high = self.low[:, :, None], self.high[:, :, None]
        least = np.maximum(np.maximum(low - c, c - high), 0)
        return least**2, np.maximum(np.abs(low - c), np.abs(high - c)) ** 2

    def nearest(self, own: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid by the intervals of distance, and where they overlap (then it is not known)."""
        least, most = (sum(t[d][own[:, d]] for d in range(own.shape[1])) for t in tables)
        best = most.min(1, keepdims=True)
        may = least <= best
        # of several that may be nearest the first is, if all their distances are known
        known = (may.sum(1) == 1) | (~may | (least == most)).all(1)
        return may.argmax(1), ~known


def grid(vectors: DataFrame, bits: int, size: int) -> Grid | None:
    """Cells by the counts of values of each dimension over all vectors, in at most BUCKETS buckets. Each task returns counts of
    that many buckets a dimension at most. No vectors: none."""
    bounds = vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("d").collect()
    if not bounds:
        return None
    low, high = np.array([b.low for b in bounds], np.int64), np.array([b.high for b in bounds], np.int64)
    width = (high - low) // BUCKETS + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * BUCKETS, np.int64)
        for batch in batches:
            if batch.num_rows:
                at = (matrix(batch.column("v")) - low) // width + np.arange(size) * BUCKETS
                total += np.bincount(at.ravel(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])

    counts = vectors.select("v").mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    histogram = np.zeros(size * BUCKETS, np.int64)
    histogram[counts.column("at").to_numpy()] = counts.column("n").to_numpy()
    parts = histogram.reshape(size, BUCKETS)
    return Grid([cells(parts[d], int(low[d]), int(width[d]), 1 << bits) for d in range(size)], low, high, bits)


def write(vectors: DataFrame, own: Grid) -> DataFrame:
    """The VA-file of vectors: vec_id, path and place (number in its file) of the whole vector, cells binary. A task that runs again
    writes another file; only those of the attempt that Spark committed are named."""
    folder = f"{shared_folder(vectors.sparkSession)}/vectors-{uuid.uuid4().hex}"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at = None, "", 0
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, BATCH):
                    part = batch.slice(lo, BATCH)
                    v = matrix(part.column("v"))
                    if out is None:
                        store, root = _store(folder)
                        store.create_dir(root, recursive=True)
                        path = f"{folder}/part-{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}.int32"
                        out = store.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
                    out.write(v.astype("<i4").tobytes())
                    packed = own.pack(v)
                    place = np.arange(at, at + len(v))
                    at += len(v)
                    whole = pa.FixedSizeBinaryArray.from_buffers(pa.binary(packed.shape[1]), len(v), [None, pa.py_buffer(np.ascontiguousarray(packed))])
                    yield pa.record_batch([part.column("vec_id"), pa.array([path] * len(v), pa.string()), pa.array(place, pa.int64()), whole.cast(pa.binary())], names=["vec_id", "path", "place", "cells"])
        finally:
            if out is not None:
                out.close()

    return stage(vectors.mapInArrow(written, "vec_id long, path string, place long, cells binary"), "cells")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class _Files:
    """Vectors by path and place. Reads near each other are one read; the last file stays open."""

    def __init__(self, size: int):
        self.size, self.path, self.source = size, None, None

    def fetch(self, paths: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rows for paths and places, which come sorted as they were written."""
        out = np.empty((len(paths), self.size), np.int64)
        starts = np.flatnonzero(np.append(True, paths[1:] != paths[:-1])) if len(paths) else []
        for lo, hi in zip(starts, np.append(starts, len(paths))[1:]):
            if self.path != paths[lo]:
                self.close()
                store, name = _store(paths[lo])
                self.path, self.source = paths[lo], store.open_input_file(name)
            wide = 4 * self.size
            offset, length = places[lo:hi] * wide, np.full(hi - lo, wide)
            for a, b in coalesced(offset, length):
                data = self.source.read_at(int(offset[b - 1] + wide - offset[a]), int(offset[a]))
                whole = np.frombuffer(data, "<i4").reshape(-1, self.size)
                out[lo + a : lo + b] = whole[places[lo + a : lo + b] - places[lo + a]]
        return out

    def close(self) -> None:
        if self.source is not None:
            self.source.close()
        self.path = self.source = None


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of vectors (rows) to centroids, exact."""
    return np.stack([((v - c) ** 2).sum(1) for c in centroids], 1)


def _decoded(batches: Iterator[pa.RecordBatch], own: Grid) -> Iterator[tuple]:
    """Parts of at most BATCH rows, with their cells."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BATCH):
            part = batch.slice(lo, BATCH)
            column = part.column("cells")
            offsets, data = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64), column.buffers()[2]
            begin, end = offsets[column.offset], offsets[column.offset + len(column)]
            packed = np.frombuffer(data, np.uint8)[begin:end].reshape(len(column), -1)
            yield part, own.unpack(packed), np.array(part.column("path").to_pylist(), object), part.column("place").to_numpy()


def moves(file: DataFrame, own: Grid, before: np.ndarray | None, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """How sums (centroid x dimension) and counts change between the clusters of before (None: no clusters) and of after; the number of vectors
    fetched. Each task returns one row a cluster."""
    size = after.shape[1]

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [None if c is None else own.tables(c) for c in (before, after)]
        files, sums, counts, fetched = _Files(size), np.zeros((len(after), size), np.int64), np.zeros(len(after), np.int64), 0
        try:
            for part, own_cells, paths, places in _decoded(batches, own):
                now, open_now = own.nearest(own_cells, tables[1])
                if before is None:
                    old, want = np.full(len(now), -1), np.ones(len(now), bool)
                else:
                    old, open_old = own.nearest(own_cells, tables[0])
                    want = open_now | open_old | (now != old)
                at = np.flatnonzero(want)
                v = files.fetch(paths[at], places[at])
                fetched += len(at)
                now = _settled(now[at], open_now[at], v, after)
                if before is None:
                    old = old[at]
                else:
                    old = _settled(old[at], open_old[at], v, before)
                    np.subtract.at(sums, old[now != old], v[now != old])
                    np.subtract.at(counts, old[now != old], 1)
                np.add.at(sums, now[now != old], v[now != old])
                np.add.at(counts, now[now != old], 1)
        finally:
            files.close()
        yield pa.record_batch([pa.array(range(len(after)), pa.int32()), pa.array(counts, pa.int64()), pa.array(list(sums), pa.list_(pa.int64())), pa.array([fetched, *[0] * (len(after) - 1)], pa.int64())], names=["cluster", "n", "sums", "fetched"])

    rows = file.select("path", "place", "cells").mapInArrow(changed, "cluster int, n long, sums array<long>, fetched long")
    total = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).cast("string").alias(f"d{d}") for d in range(size)]
    sums, counts, fetched = np.zeros(after.shape, object), np.zeros(len(after), object), 0
    for r in rows.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("fetched").alias("fetched"), *total).collect():  # a row a cluster
        counts[r.cluster], sums[r.cluster], fetched = r.n, [int(r[f"d{d}"]) for d in range(size)], fetched + r.fetched
    return sums, counts, fetched


def _settled(cluster: np.ndarray, unknown: np.ndarray, v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = cluster.copy()
    if unknown.any():
        out[unknown] = distances(v[unknown], centroids).argmin(1)
    return out


def assign(file: DataFrame, own: Grid, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster int and distance long (squared) of every vector; all are fetched, for the distance."""

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, files = own.tables(centroids), _Files(centroids.shape[1])
        try:
            for part, own_cells, paths, places in _decoded(batches, own):
                now, unknown = own.nearest(own_cells, tables)
                v = files.fetch(paths, places)
                now = _settled(now, unknown, v, centroids)
                yield pa.record_batch([part.column("vec_id"), pa.array(now, pa.int32()), pa.array(((v - centroids[now]) ** 2).sum(1), pa.int64())], names=["vec_id", "cluster", "distance"])
        finally:
            files.close()

    return file.mapInArrow(assigned, "vec_id long, cluster int, distance long")


def first_centroids(vectors: DataFrame, count: int) -> np.ndarray:
    """The count vectors with the smallest lowercase-hex sha256 of `1:<vec_id>`, in that order; of one id the smaller vector first, a
    null id is an empty text. Fewer vectors: fewer centroids."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.v for r in vectors.orderBy(key, "v").limit(count).collect()], np.int64)


def cluster(embeddings: DataFrame, count: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, bits: int = 6) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Lloyd's rounds over the vectors that kept() keeps: (vec_id, cluster, distance) of each after the last, the final
    centroids, and how many vectors each round fetched.

    Each round gives every vector to the nearest centroid (ties: the smaller number), then sets each that has vectors to their componentwise exact
    floor(sum / count). bits: of a cell; results do not depend on it. Repeated rows and null ids are rows of their own;
    further columns are left out. An empty table, or one of which nothing is kept, gives no rows."""
    vectors = kept(embeddings, size, scale)
    after = first_centroids(vectors, count)
    own = grid(vectors, bits, size)
    if own is None:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), np.zeros((0, size), np.int64), []
    file = write(vectors, own)
    before, sums, counts, fetched = None, np.zeros(after.shape, object), np.zeros(len(after), object), []
    for _ in range(rounds):
        more, members, n = moves(file, own, before, after)
        sums, counts, before = sums + more, counts + members, after
        after = np.array([sums[k] // counts[k] if counts[k] else before[k] for k in range(len(after))], dtype=np.int64)
        fetched.append(n)
    return assign(file, own, after), after, fetched


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """assigned (vec_id, cluster, distance) with cluster_inertia and inertia (distances summed over the cluster and over all, longs) and
    centroid_sha256 (of the final centroid's components, joined by commas)."""
    spark = assigned.sparkSession
    assigned = stage(assigned, "assigned")
    digests = spark.createDataFrame([(k, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    own = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(digests, "cluster")
    total = own.agg(F.sum("cluster_inertia")).first()[0]
    # a row a centroid
    return assigned.join(F.broadcast(own), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")
