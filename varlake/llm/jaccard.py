"""Exact Jaccard join of word-shingle sets: signature trees over groups that a pigeonhole rule deals out.

1. Equal sets are one class; from here on classes are joined, not documents.
2. Sets whose Jaccard similarity is at least t differ in at most (1 - t) / (1 + t) of the sum of their sizes. With
   the hash space cut into more parts than that, two such sets agree in a whole part. Each set is dealt out under the
   hashes of its parts.
   Only groups of sets with an equal part are looked at further, each group of the same sets once.
3. In each group a signature tree is built over the sets' token bitmaps: nodes hold the OR of their sets' bitmaps and the
   range of sizes. The tree is walked against itself; a pair of nodes whose largest possible overlap is too small is
   not descended. Pairs of sets that may overlap enough are candidates, as many as span their group.
4. Components of the candidates hold every link. In each the same walk over the sets themselves counts the surviving
   pairs exactly.
5. Neither groups nor components are taken whole by a task: chunks of bounded size are compared with themselves, then
   one set of each part found with those of other chunks, then only sets of different parts.
6. Components of the links are the result. Links that join nothing new within a task are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varlake.llm.arrays import mix, shingles, signed, slices
from varlake.llm.common import bitmap, component_links, components, in_bitmap, runs, stage

#: Sets in a chunk: a task holds two chunks at most.
CHUNK = 512
#: Children of a node of a signature tree.
FANOUT = 8
_M = (1 << 64) - 1


def set_class(hashes: np.ndarray) -> int:
    """64 bits that stand for a set: sums do not depend on the order, the size is mixed in. 0 is left for the empty set."""
    if not len(hashes):
        return 0
    total = np.array([int(mix(hashes).sum(dtype=np.uint64)) + len(hashes) * 0x9E3779B97F4A7C15 & _M], np.uint64)
    return int(mix(total).view(np.int64)[0]) or 1


class Bands:
    """Size bands and their schemes for a threshold num / den. A set in band b is dealt out under schemes b and b + 1:
    linked sets lie in one band or in neighbours, so they meet in the scheme of the larger."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.last = num, den, [0]
        self.parts: list[tuple[int, int]] = []

    def band(self, size: int) -> int:
        while self.last[-1] < size:
            self.last.append((self.last[-1] + 1) * self.den // self.num)
        return int(np.searchsorted(self.last, size))

    def scheme(self, band: int) -> tuple[int, int]:
        """Number of parts, and how many of them may differ."""
        while len(self.parts) <= band:
            self.band(self.last[min(len(self.parts), len(self.last) - 1)] + 1)
            differ = (self.den - self.num) * 2 * self.last[len(self.parts)] // (self.den + self.num)
            # more parts than must be: so many that a set seldom leaves all spare ones empty
            self.parts.append((differ + 4 + differ // 25 if differ else 1, differ))
        return self.parts[band]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Keys of a sorted set under both schemes. Of two linked sets, one with more filled parts than may differ agrees
        with the other in a filled part. Only sets with fewer also get keys for their empty parts."""
        out = []
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
        own = self.band(len(hashes))
        for band in (own, own + 1):
            parts, differ = self.scheme(band)
            edges = np.minimum(np.arange(parts + 1).astype(object) * (1 << 64) // parts, _M).astype(np.uint64) if parts > 1 else np.array([0, _M], np.uint64)
            at = np.searchsorted(hashes, edges)
            at[-1] = len(hashes)
            count = np.diff(at)
            key = mix(total[at[1:]] - total[at[:-1]] + mix(np.arange(parts, dtype=np.uint64) + np.uint64((band << 32) + 1)) + count.astype(np.uint64))
            filled = count > 0
            out.append(key[filled] if filled.sum() > differ else key)
        return np.concatenate(out)


def token_bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bitmap of a set, of about as many bits as it has tokens (64 to 65536); tokens are marked by their lowest bits."""
    bits = min(max(64, 1 << (len(hashes) * 2 - 1).bit_length()), 1 << 16)
    out = np.zeros(bits // 64, np.uint64)
    at = hashes & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(int), np.uint64(1) << (at & np.uint64(63)))
    return out


def _folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of one width: wider ones are folded upon themselves, which drops a bit of each token's place."""
    width = min(map(len, maps))
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, width), axis=0) for m in maps])


class SignatureTree:
    """A tree over sets, from their bitmaps and sizes. Level 0 has a node per set, in order of size and first bits, so that like
    sets stand together; each node above covers FANOUT nodes below. A node has the OR of its sets' bitmaps, the
    range of their sizes and the most bits that one of its sets lost to collisions."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, names: np.ndarray):
        order = np.lexsort((maps[:, 0], sizes))
        self.sets = names[order]  # the set of each leaf
        maps, size = maps[order], sizes[order]
        lost = size - np.bitwise_count(maps).sum(1).astype(int)
        self.levels = [(maps, size, size, lost)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, lost = self.levels[-1]
            cut = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(lost, cut)))


def _below(level: int, node: int, down: bool, tree: SignatureTree) -> tuple[int, int, int]:
    """Level and range of a node's children, or of the node itself."""
    return (level - 1, node * FANOUT, min((node + 1) * FANOUT, len(tree.levels[level - 1][0]))) if down and level else (level, node, node + 1)


def walk(a: SignatureTree, b: SignatureTree, num: int, den: int, labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of sets that may reach num / den, from walking both trees at once; of one tree with itself, each pair once. Sets are
    numbered as labels are, which tell those that are joined (the caller joins while this runs): pairs of nodes whose
    sets are all joined are not descended. The children of two nodes are compared in one go, FANOUT x FANOUT at most."""
    same = a is b
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        own, other = labels[a.sets[i * FANOUT**la : (i + 1) * FANOUT**la]], labels[b.sets[j * FANOUT**lb : (j + 1) * FANOUT**lb]]
        if own[0] == other[0] and (own == own[0]).all() and (other == own[0]).all():
            continue
        (p, x, x_end), (q, y, y_end) = _below(la, i, la >= lb, a), _below(lb, j, lb >= la, b)
        ma, low_a, high_a, lost_a = (v[x:x_end] for v in a.levels[p])
        mb, low_b, high_b, lost_b = (v[y:y_end] for v in b.levels[q])
        low_a, high_a, lost_a = low_a[:, None], high_a[:, None], lost_a[:, None]
        near = (high_a * den >= low_b * num) & (high_b * den >= low_a * num)  # sizes not too far apart
        overlap = np.bitwise_count(ma[:, None] & mb).sum(2, dtype=np.int64) + np.minimum(lost_a, lost_b)
        overlap = np.minimum(overlap, np.minimum(high_a, high_b))
        near &= overlap * (den + num) >= num * (low_a + low_b)  # the largest possible overlap is large enough
        if same:  # each pair of nodes from one side, no set with itself
            near &= np.arange(x, x_end)[:, None] < np.arange(y, y_end) + (p > 0)
        left = [(p, x + int(k), q, y + int(m)) for k, m in zip(*np.nonzero(near))]
        if p or q:
            stack += left[::-1]
            continue
        for _, k, _, m in left:
            if labels[a.sets[k]] != labels[b.sets[m]]:
                yield int(a.sets[k]), int(b.sets[m])


def links(maps: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray, labels: np.ndarray, num: int, den: int, sets: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Pairs that span the components: all pairs if sides has one value, else pairs across the two sides. Items with the same
    label are known to be joined. With sets a pair counts if its similarity is num / den or more; without, if it may be."""
    folded, labels = _folded(maps), np.array(labels)
    groups = [np.flatnonzero(sides == s) for s in np.unique(sides)]
    trees = [SignatureTree(folded[g], sizes[g], g) for g in groups]
    out = []
    for x, y in walk(trees[0], trees[-1], num, den, labels):
        if sets is not None:
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if den * both < num * (len(sets[x]) + len(sets[y]) - both) or not both:
                continue
        labels[labels == labels[y]] = labels[x]
        out.append((x, y))
    return out


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    flat, at = column.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(column.value_lengths().to_numpy()))
    return [flat[lo:hi] for lo, hi in zip(at[:-1], at[1:])]


def tree_links(members: DataFrame, deal: list[str], num: int, den: int, payload: str) -> DataFrame:
    """Links (src, dst) between the nodes of each group that deal names: members has these columns, side, label, node, size and
    payload: hashes (whole sets, counted exactly) or bits (their bitmaps, which can only rule pairs out)."""
    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in runs(batches, deal):
            src, dst = [], []
            own, side, label, size = (rows.column(c).to_numpy() for c in ("node", "side", "label", "size"))
            values = _lists(rows.column(payload))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 1:
                    sets = values[lo:hi] if payload == "hashes" else None
                    maps = [token_bitmap(x) for x in values[lo:hi]] if payload == "hashes" else values[lo:hi]
                    for x, y in links(maps, size[lo:hi].astype(int), side[lo:hi], label[lo:hi], num, den, sets):
                        src.append(own[lo + x])
                        dst.append(own[lo + y])
            yield pa.record_batch([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return members.select(*deal, "side", "label", "node", "size", payload).repartition(*deal).sortWithinPartitions(*deal).mapInArrow(walked, "src long, dst long")


#: Stands for a null doc_id where rows are looked up by it.
_NULL = -(1 << 63)
#: Classes that a task remembers having dealt out; then it forgets all.
REMEMBERED = 200_000


def carried(documents: DataFrame, bearers: DataFrame, n: int, lower: bool, payload: str) -> DataFrame:
    """class, size and payload (hashes or bits) of the classes that bearers (class, doc_id) name, one row each. A bitmap of
    the wanted ids keeps other documents out of the shuffle."""
    wanted = documents.sparkSession.sparkContext.broadcast(bitmap(bearers, "doc_id"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            batch = batch.filter(pa.array(in_bitmap(wanted.value, ids)))
            for part in slices(iter([batch]), "text") if batch.num_rows else ():
                own = shingles(part.column("text"), n, lower)
                values = [(s if payload == "hashes" else token_bitmap(s)).view(np.int64) for s in own]
                yield pa.record_batch([part.column("doc_id"), pa.array([set_class(s) for s in own], pa.int64()), pa.array([len(s) for s in own], pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=["doc_id", "class", "size", payload])

    rows = documents.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc_id"), "text").mapInArrow(read, f"doc_id long, class long, size long, {payload} array<long>")
    return rows.join(bearers, ["doc_id", "class"], "left_semi").dropDuplicates(["class"]).drop("doc_id")


def shingle_sets(documents: DataFrame, n: int, lower: bool) -> DataFrame:
    """doc_id, copy (a hash of the text), n_shingles and class (0: the empty set) of each document."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(batch.column("text"), n, lower)
            yield pa.record_batch([batch.column("doc_id"), batch.column("copy"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_class(s) for s in sets], pa.int64())], names=["doc_id", "copy", "n_shingles", "class"])

    return documents.select("doc_id", F.xxhash64("text").alias("copy"), "text").mapInArrow(counted, "doc_id long, copy long, n_shingles long, class long")


def near_duplicates(documents: DataFrame, n: int = 5, threshold: tuple[int, int] = (80, 100), lower: bool = True) -> DataFrame:
    """For each row of documents (doc_id long, text): doc_id, n_shingles, component_id, the smallest doc_id reachable over links, component
    (one number for each component; null for empty sets) and copy (a hash of the text). Sets are the distinct n-word shingles of the whole text (A-Z lower-cased if lower); a text of fewer words is
    one shingle. Sets link when intersection / union >= threshold, a ratio of integers.

    Null and empty texts link with nothing: their component_id is their doc_id. Equal texts are linked, rows that repeat
    a doc_id come back as often. A null doc_id takes part, but is no component_id while its component has another.
    An empty table gives no rows. Sets are compared by 64-bit hashes of shingles.
    """
    num, den = threshold
    sets = stage(shingle_sets(documents, n, lower), "sets")
    # min leaves nulls out: a class has the null id only where it has no other
    classes = stage(sets.where("class <> 0").groupBy("class").agg(F.min("doc_id").alias("doc_id")), "classes")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(num, den), set()
        for batch in slices(batches, "text"):
            keys, owner = [], []
            for own in shingles(batch.column("text"), n, lower):
                name = set_class(own)
                if name and name not in seen:  # copies of a text are dealt out once by a task
                    seen.add(name)
                    keys.append(bands.keys(own))
                    owner.append(np.full(len(keys[-1]), name))
            if len(seen) > REMEMBERED:
                seen.clear()
            if keys:
                yield pa.record_batch([signed(np.concatenate(keys)), signed(np.concatenate(owner))], names=["key", "class"])

    keys = documents.select("text").mapInArrow(dealt, "key long, class long")
    # groups of different sets with an equal key; of groups of the same sets one
    by_key = W.partitionBy("key")
    once = keys.withColumn("before", F.lag("class").over(by_key.orderBy("class"))).where("NOT (class <=> before)")
    stamp = F.struct(F.count("*").over(by_key).alias("n"), F.sum(F.xxhash64("class") % (1 << 40)).over(by_key).alias("a"), F.sum(F.hash("class").cast("long")).over(by_key).alias("b"))
    dealt_groups = stage(once.withColumn("stamp", stamp).where("stamp.n > 1").select("key", "class", F.xxhash64("stamp").alias("group")), "dealt")
    first = dealt_groups.groupBy("group").agg(F.min("key").alias("key"))
    members = dealt_groups.join(first, ["group", "key"]).select(F.col("group").alias("component"), "class")
    members = stage(members, "groups")

    def bearers(wanted: DataFrame) -> DataFrame:
        """A document that brings each class's set."""
        return stage(classes.join(wanted, "class", "left_semi").select("class", F.coalesce("doc_id", F.lit(_NULL)).alias("doc_id")), "bearers")

    named, sets_of = members.withColumnRenamed("class", "node"), carried(documents, bearers(members.select("class")), n, lower, "bits").withColumnRenamed("class", "node")
    candidates = component_links(named, lambda rows, deal: tree_links(rows, deal, num, den, "bits"), CHUNK, num, den, carried=sets_of)
    candidates = stage(components(candidates), "candidates")
    sets_of = carried(documents, bearers(candidates.select(F.col("node").alias("class"))), n, lower, "hashes").withColumnRenamed("class", "node")
    found = component_links(candidates, lambda rows, deal: tree_links(rows, deal, num, den, "hashes"), CHUNK, num, den, carried=sets_of)
    groups = components(found).withColumnRenamed("node", "class")
    named = classes.join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("class", "component_id", "component")
    return sets.join(named, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "component", "copy")


def representatives(documents: DataFrame, n: int = 5, threshold: tuple[int, int] = (80, 100), lower: bool = True) -> DataFrame:
    """documents less all but one row of each component of near_duplicates: the one with the smallest doc_id stays (null counts as the
    largest; of rows of one id that whose text has the smallest hash), once if it is repeated. Rows with empty sets all stay."""
    groups = stage(near_duplicates(documents, n, threshold, lower).where("component IS NOT NULL").select("doc_id", "copy", "component"), "near")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")
    first = groups.groupBy("component").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = groups.join(first, "component").where("NOT (doc_id <=> first.doc_id AND copy = first.copy)").select(F.coalesce("doc_id", F.lit(_NULL)).alias("__doc"), F.col("copy").alias("__copy")).distinct()
    rows = documents.withColumns({"__doc": F.coalesce("doc_id", F.lit(_NULL)), "__copy": F.xxhash64("text")})
    rows = rows.join(stage(gone, "gone"), ["__doc", "__copy"], "left_anti")
    again = groups.groupBy(F.coalesce("doc_id", F.lit(_NULL)).alias("__doc"), F.col("copy").alias("__copy")).agg(F.count("*").alias("n")).where("n > 1").select("__doc", "__copy")
    again = stage(again, "again")
    if not again.isEmpty():  # only rows that are repeated go through a shuffle
        rows = rows.join(again, ["__doc", "__copy"], "left_anti").unionByName(rows.join(again, ["__doc", "__copy"], "left_semi").dropDuplicates(["__doc", "__copy"]))
    return rows.select(*documents.columns)
