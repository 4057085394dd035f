"""Exact search of the highest inner products, by branch and bound over columns.

Candidates stand in vertical layout: one row of a matrix for each dimension. Scores grow block of dimensions by
block; after each, what is still to come is at most the product of the remaining lengths of query and candidate
(Cauchy and Schwarz). Candidates that cannot reach a query's k-th score any more are left out, the rest is compacted.
A lower bound of the k-th score is known before: that among a bounded sample of the candidates, then that of what a task has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import stage

#: Dimensions of a block, candidates that stand together, queries whose first blocks are multiplied together.
BLOCK, COLUMNS, TOGETHER = 16, 4096, 256
#: Candidates of which the first bound of each query is taken. They change what is pruned, not what is found.
SEEDS = 2048
#: Components of queries that go to all tasks at once; more queries take more scans of the candidates.
QUERY_NUMBERS = 4 << 20
#: Share of candidates left at which single queries are compacted.
SPARSE = 0.25
#: Squared lengths up to this are exact in doubles; above the next a score may not fit in a long.
_DOUBLE, _LONG = 2.0**52, 2.0**62
_LEAST = np.iinfo(np.int64).min


def scaled(embeddings: DataFrame, scale: int, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id_column long and v array<long>: floor(scale * x) of each component x, as double. Vectors that are null, or hold a null or
    non-finite component, or of which the scaled squared length is above 2^62 (scores may not fit in a long), are left out. Further columns are left out."""
    wide = F.col(column).cast("array<double>")
    rows = embeddings.where(F.col(column).isNotNull()).select(F.col(id_column).cast("long"), wide.alias("wide"))
    rows = rows.where(F.forall("wide", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    square = F.aggregate("wide", F.lit(0.0), lambda a, x: a + F.floor(x * scale).cast("double") * F.floor(x * scale).cast("double"))
    return rows.where(square <= _LONG).select(id_column, F.transform("wide", lambda x: F.floor(x * scale)).alias("v"))


def dense(column: pa.Array, width: int) -> np.ndarray:
    """Lists as a matrix of width rows and a column for each list; shorter ones end in zeros, longer ones are cut (what
    they are multiplied with has no more)."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    size = np.minimum(np.diff(offsets), width)
    if width and len(size) and (size == width).all() and (np.diff(offsets) == width).all():
        return np.ascontiguousarray(values[offsets[0] : offsets[-1]].reshape(-1, width).T)
    out = np.zeros((width, len(size)), np.int64)
    for d in range(width):
        has = size > d
        out[d, has] = values[offsets[:-1][has] + d]
    return out


class Queries:
    """Queries as a matrix, with the ids and scores of the best candidates so far, of which the last is the bound."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, bound: np.ndarray | None = None):
        # dimensions with most of the queries' mass first
        self.order = np.argsort(-(vectors.astype(float) ** 2).sum(0), kind="stable")
        self.ids, self.k, self.width = ids, k, vectors.shape[1]
        self.vectors = vectors[:, self.order]
        self.top = float((self.vectors.astype(float) ** 2).sum(1).max(initial=0))
        self.rest = self._rest(self.vectors.T)
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        self.found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        self.bound = np.full(len(ids), _LEAST) if bound is None else bound.copy()
        self.multiplied = 0

    def _cuts(self) -> range:
        return range(0, max(self.width, 1), BLOCK)

    def _rest(self, columns: np.ndarray) -> np.ndarray:
        """Lengths of columns from each block of dimensions on."""
        square = columns.astype(float) ** 2
        return np.sqrt(np.array([square[c:].sum(0) for c in [*self._cuts(), self.width]]))

    def _may(self, so_far: np.ndarray, most: np.ndarray, bound) -> np.ndarray:
        """Whether a score can still reach bound; a little more is allowed for, as lengths are rounded."""
        return so_far + most + 1e-9 * (np.abs(so_far) + most) + 1e-3 >= bound

    def meet(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """Takes candidates (one column each) into account. ids: the largest long is a null."""
        for lo in range(0, len(ids), COLUMNS):
            self._meet(ids[lo : lo + COLUMNS], columns[:, lo : lo + COLUMNS][self.order])

    def _meet(self, ids: np.ndarray, columns: np.ndarray) -> None:
        rest = self._rest(columns)
        exact = np.float64 if self.top <= _DOUBLE and float(rest[0].max(initial=0)) ** 2 <= _DOUBLE else np.int64
        columns, cuts = columns.astype(exact), [*self._cuts(), self.width]
        for lo in range(0, len(self.ids), TOGETHER):
            hi = min(lo + TOGETHER, len(self.ids))
            vectors, bound = self.vectors[lo:hi].astype(exact), self.bound[lo:hi, None].astype(float)
            scores, b, alive = np.zeros((hi - lo, len(ids)), exact), 0, np.ones((hi - lo, len(ids)), bool)
            while b < len(cuts) - 1:  # blocks for all candidates, as long as many are left
                scores += vectors[:, cuts[b] : cuts[b + 1]] @ columns[cuts[b] : cuts[b + 1]]
                self.multiplied += scores.size * (cuts[b + 1] - cuts[b])
                b += 1
                alive = self._may(scores, self.rest[b, lo:hi, None] * rest[b], bound)
                if alive.mean() <= SPARSE:
                    break
            for i in range(hi - lo):
                at = np.flatnonzero(alive[i])
                own = scores[i, at]
                for c in range(b, len(cuts) - 1):  # then for those left of each query
                    if not len(at):
                        break
                    own = own + vectors[i, cuts[c] : cuts[c + 1]] @ columns[cuts[c] : cuts[c + 1]][:, at]
                    self.multiplied += len(at) * (cuts[c + 1] - cuts[c])
                    left = self._may(own, self.rest[c + 1, lo + i] * rest[c + 1, at], float(self.bound[lo + i]))
                    at, own = at[left], own[left]
                self._take(lo + i, ids[at], own.astype(np.int64))

    def _take(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = (ids != self.ids[i]) & (scores >= self.bound[i])
        if not keep.any():
            return
        ids, scores = np.append(self.found[i], ids[keep]), np.append(self.scores[i], scores[keep])
        best = np.lexsort((ids, -scores))[: self.k]
        self.found[i], self.scores[i] = ids[best], scores[best]
        if len(best) == self.k:
            self.bound[i] = max(self.bound[i], scores[best[-1]])


_NULL = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NULL).to_numpy()


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, scale: int = 256, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """For each row of queries the k rows of candidates with the highest inner product: query_id, rank (from 1), vec_id, score (longs,
    rank int). Components are floor(scale * x). Ties go to the smaller id, a null id last. All candidates, if there are fewer than k.

    Left out are vectors that scaled() leaves out, and candidates with the query's own id. Components that one of two
    vectors lacks count as 0 (an empty vector scores 0 with all). Repeated queries (id and vector equal) and queries of a null id count once; repeated candidates are
    rows of their own. Empty tables give no rows.

    Queries go to all tasks in blocks of QUERY_NUMBERS components, each with one scan of the candidates; a task
    returns k rows a query at most, and no candidate is shuffled.
    """
    spark = candidates.sparkSession
    asked = scaled(queries, scale, id_column, column).dropDuplicates([id_column, "v"])
    rows = scaled(candidates, scale, id_column, column)
    seeds = rows.orderBy(F.xxhash64(id_column), id_column).limit(SEEDS).toArrow()

    def first_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = _ids(seeds.column(0).combine_chunks())
        for batch in batches:
            width = int(max(np.diff(batch.column("v").offsets.to_numpy()), default=0))
            own = Queries(_ids(batch.column(id_column)), dense(batch.column("v"), width).T, k)
            own.meet(sample, dense(seeds.column("v"), width))
            yield pa.record_batch([batch.column(id_column), batch.column("v"), pa.array(own.bound, pa.int64())], names=["query_id", "v", "bound"])

    asked = stage(asked.mapInArrow(first_bounds, "query_id long, v array<long>, bound long"), "queries")
    numbers = asked.agg(F.coalesce(F.sum(F.size("v") + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-numbers // QUERY_NUMBERS))
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)) == block)
        best = _best(rows, spark.sparkContext.broadcast(own.toArrow()), block << 32, k, id_column)
        found = best if found is None else found.unionByName(best)
    ranked = found.select("*", F.expr("row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id ASC NULLS LAST)").alias("rank"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(rows: DataFrame, block, first: int, k: int, id_column: str) -> DataFrame:
    """The k best of each task for each query of a block; its queries are numbered from first on."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = block.value
        width = int(max((np.diff(c.offsets.to_numpy()).max(initial=0) for c in asked.column("v").chunks), default=0))
        own = Queries(_ids(asked.column("query_id").combine_chunks()), dense(asked.column("v"), width).T, k, asked.column("bound").to_numpy())
        for batch in batches:
            own.meet(_ids(batch.column(id_column)), dense(batch.column("v"), width))
        for lo in range(0, len(own.ids), 4096):
            part = range(lo, min(lo + 4096, len(own.ids)))
            size = [len(own.found[i]) for i in part]
            if not sum(size):
                continue
            ids, scores = np.concatenate([own.found[i] for i in part]), np.concatenate([own.scores[i] for i in part])
            query = np.repeat(own.ids[lo : lo + 4096], size)
            # queries of one id, but other vectors, are told apart
            number = first + np.repeat(np.arange(lo, lo + len(size)), size)
            yield pa.record_batch([pa.array(number, pa.int64()), pa.array(query, pa.int64()), pa.array(ids, pa.int64(), mask=ids == _NULL), pa.array(scores, pa.int64())], names=["number", "query_id", "vec_id", "score"])

    best = rows.mapInArrow(searched, "number long, query_id long, vec_id long, score long")
    return best.select(F.struct("query_id", "number").alias("query"), "query_id", "vec_id", "score")
