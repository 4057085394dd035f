"""Tables, shared-folder stages and connected components for the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.llm.arrays import root


#: Spark drops the shuffle files of a write at its end, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of the batches that go to Python workers. Spark's default (64 MB) counts for each task of an executor, in both processes.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Sets the session's Arrow batches to BATCH_BYTES: rows are whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset (a test on one machine), one is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read again: later uses neither recompute it nor depend on an executor. The shuffle
    files of the write go at its end; the session's setting is as before."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Edges (16 bytes each) of a graph that one task joins.
SMALL = 500_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (src long, dst long), as (node, component): the smallest node reachable.

    Large-star and small-star rounds (Kiveris et al., 2014): every round is a minimum, pre-aggregated before its
    shuffle, and an equi-join that Spark can split where one node has very many edges. Each round is written to the
    shared folder. A graph of at most SMALL edges, counted first, is joined in one task instead of in rounds.
    Nodes without an edge to another node are not returned. No edges: no rows.
    """

    def stamp(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("src", "dst")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("src", "dst") % 1000003), F.lit(0))).first()
        return tuple(row)

    def in_one_task(batches):
        table_ = pa.Table.from_batches(batches, schema=pa.schema([("src", pa.int64()), ("dst", pa.int64())]))
        nodes, at = np.unique(np.concatenate([table_.column("src").to_numpy(), table_.column("dst").to_numpy()]), return_inverse=True)
        parent = np.arange(len(nodes))
        for i, j in zip(at[: table_.num_rows].tolist(), at[table_.num_rows :].tolist()):
            a, b = root(parent, i), root(parent, j)
            parent[max(a, b)] = min(a, b)
        low = np.array([root(parent, i) for i in range(len(nodes))], int)
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(nodes[low], pa.int64())], names=["node", "component"])

    # src > dst in every state
    state = stage(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
    before = stamp(state)
    if 0 < before[0] <= SMALL:
        return stage(state.coalesce(1).mapInArrow(in_one_task, "node long, component long"), "components")
    for _ in range(rounds):
        if not before[0]:
            break
        both = state.union(state.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        large = both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        joined = large.join(low, "src")
        small = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).union(low.select("src", F.col("low").alias("dst"))).where("src <> dst").distinct()
        state = stage(small, "edges")
        after = stamp(state)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = state.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.union(state.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())


def runs(batches, keys: list[str]):
    """Whole groups from Arrow batches that are sorted by keys: (table, starts), where group g is rows starts[g] to
    starts[g + 1]. A group that goes over the end of a batch is held back until it is complete."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        cuts = _cuts(held, keys)
        if len(cuts) > 2:
            yield held.slice(0, cuts[-2]).combine_chunks(), cuts[:-1]
            held = held.slice(cuts[-2])
    if held is not None and held.num_rows:
        yield held.combine_chunks(), _cuts(held, keys)


def pooled(groups, size: int = 1 << 24):
    """What runs returns, with more groups at once: about so many bytes of rows."""
    held = []
    for rows, cuts in groups:
        held.append((rows, cuts))
        if sum(r.nbytes for r, _ in held) >= size:
            yield _joined(held)
            held = []
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[pa.Table, np.ndarray]:
    before = np.cumsum([0] + [rows.num_rows for rows, _ in held])
    cuts = [cuts[:-1] + at for (_, cuts), at in zip(held, before)]
    return pa.concat_tables([rows for rows, _ in held]).combine_chunks(), np.concatenate([*cuts, before[-1:]])


def _cuts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(rows.num_rows, bool)
    if rows.num_rows:
        change[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), rows.num_rows)


def bitmap(df: DataFrame, column: str, bits: int = 1 << 23) -> np.ndarray:
    """A filter of fixed size (bits) with the hash of each value of a long column set: at most bits / 64 rows come to the driver.
    It keeps rows that cannot match out of a shuffle; where too many values fill it, it only saves less."""
    at = F.pmod(F.col(column), F.lit(bits))
    words = df.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy()
    return out


def in_bitmap(filter_: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.mod(values.astype(np.int64), len(filter_) * 64)
    return (filter_[at // 64] >> (at % 64)) & 1 == 1


def component_links(members: DataFrame, compare, chunk: int, num: int, den: int, carried: DataFrame | None = None) -> DataFrame:
    """Links (src, dst) that span the true components within each candidate component, without a task that takes a whole one.

    members has component, node, size and what compare needs. compare(rows, deal) links nodes within each group that the
    columns deal name: rows have side (one value: all pairs of the group count; two: only pairs across) and label (nodes
    of one label are known to be joined). Nodes can only be linked if size / other size >= num / den. carried: node, size and
    what is large (sets, texts), a row a node, where members lack them; a node of many components is written once.

    1. Components are cut into chunks, each compared with itself. 2. One node of each group found is compared with those
    of the component's other chunks. 3. Only nodes of different groups can still have unknown links: pairs of chunks that
    hold such nodes are compared, large groups in chunks of their own, small ones pooled.
    """
    zero = F.lit(0).cast("long")
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / chunk).alias("chunks"))
    members = stage(members.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks")), "members")
    carried = carried if carried is None else stage(carried, "carried")
    whole = members if carried is None else members.join(carried, "node")
    found = stage(compare(whole.select("*", zero.alias("side"), F.col("node").alias("label")), ["component", "chunk"]), "links")
    large = members.where("chunks > 1")
    if large.isEmpty():
        return found
    bare = members.drop("component", "chunk", "chunks").dropDuplicates(["node"])  # a node may be in several components
    bare = bare if carried is None else bare.join(carried, "node")

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(components(found).withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))

    heads = labelled(large.select("component", "chunk", "node")).groupBy("component", "chunk", "label").agg(F.min("node").alias("node")).select("component", "node")
    again = heads.join(heads.groupBy("component").agg(F.ceil(F.count("*") / chunk).alias("parts")), "component")
    again = again.withColumn("part", F.pmod(F.xxhash64("node", "component"), "parts")).join(bare, "node")
    found = stage(found.union(compare(again.select("*", zero.alias("side"), F.col("node").alias("label")), ["component", "part"])), "links")

    sized = large if carried is None else large.join(carried.select("node", "size"), "node")
    apart = labelled(sized.select("component", "node", "size"))
    counts = apart.groupBy("component", "label").agg(F.count("*").alias("own"))
    several = counts.groupBy("component").agg(F.count("*").alias("labels"), F.sum(F.when(F.col("own") < chunk, F.col("own"))).alias("pool")).where("labels > 1")
    apart = apart.join(counts.join(several, "component"), ["component", "label"])
    apart = apart.withColumn("side", F.expr(f"if(own < {chunk}, 0, label)")).withColumn("k", F.expr(f"pmod(xxhash64(node), ceil(if(own < {chunk}, pool, own) / {chunk}))"))
    apart = stage(apart.select("component", "side", "k", "label", "node", "size"), "apart")
    chunks = apart.groupBy("component", "side", "k").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    other = chunks.select("component", *(F.col(c).alias(f"{c}2") for c in ("side", "k", "low", "high")))
    pairs = chunks.join(other, "component").where(f"(side, k) <= (side2, k2) AND (side <> side2 OR side = 0) AND high * {den} >= low2 * {num} AND high2 * {den} >= low * {num}")
    pairs = pairs.select("component", F.xxhash64("side", "k", "side2", "k2").alias("pair"), F.array_distinct(F.array(F.struct("side", "k"), F.struct(F.col("side2").alias("side"), F.col("k2").alias("k")))).alias("both"))
    pairs = pairs.select("component", "pair", F.explode("both").alias("own")).select("component", "pair", "own.side", "own.k")
    dealt = apart.join(pairs, ["component", "side", "k"]).select("component", "pair", F.xxhash64("side", "k").alias("side"), "label", "node")
    return found.union(compare(dealt.join(bare, "node"), ["component", "pair"]))
