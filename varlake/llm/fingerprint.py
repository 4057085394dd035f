"""Document fingerprints: a homomorphic multiset hash, with DataFrame functions only.

A paragraph (texts are parted by \\n) is hashed to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors modulo powers of two. So it does not depend on the order of paragraphs, and paragraphs are inserted or
deleted by adding or subtracting their vectors. A vector has two parts:

- DIGEST lanes modulo 2**32, cut from the paragraph's SHA-512: equal sums mean equal multisets of paragraphs;
- SKETCH lanes modulo 2**16, in which each different pair of neighbouring words of the paragraph (a lone word by itself) adds 1 or
  -1 in a lane that its hash names: the squared distance of two sketches estimates how many pairs two texts do not
  share. A word ends at white space, and after WORD characters: a text without blanks has words, too.

The string form has 8 hex digits for each digest lane and 4 for each sketch lane.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varlake.llm.common import stage

DIGEST, SKETCH = 16, 120
WORD = 12


def _digest(text: str) -> Column:
    return F.expr(f"""aggregate(
        transform(split({text}, '\\n', -1), p -> sha2(CAST(p AS BINARY), 512)),
        array_repeat(0L, {DIGEST}),
        (acc, h) -> zip_with(acc, sequence(0, {DIGEST - 1}), (a, i) -> (a + CAST(conv(substr(h, i * 8 + 1, 8), 16, 10) AS BIGINT)) & 4294967295L))""")


def _sketch(text: str) -> Column:
    # a pair's lane is a character: lanes of a long text are then counted by lengths of strings
    pairs = "if(size(w) < 2, transform(w, x -> xxhash64(x)), array_distinct(transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1]))))"
    hashes = f"""flatten(transform(transform(split({text}, '\\n', -1), p -> regexp_extract_all(p, '\\\\S{{1,{WORD}}}', 0)), w -> {pairs}))"""
    marks = [f"array_join(transform(filter(h, x -> x {sign} 0), x -> chr(1 + pmod(x, {SKETCH}))), '')" for sign in (">=", "<")]
    count = "(length(m.{0}) - length(replace(m.{0}, chr(1 + i), '')))"
    return F.expr(f"""element_at(transform(transform(array({hashes}), h -> named_struct('up', {marks[0]}, 'down', {marks[1]})),
        m -> transform(sequence(0, {SKETCH - 1}), i -> CAST({count.format('up')} - {count.format('down')} AS BIGINT) & 65535L)), 1)""")


def vector(text: str = "text") -> Column:
    """The fingerprint of a string column as array<long>: DIGEST lanes, then SKETCH lanes. A null text is an empty one, which
    is one empty paragraph."""
    text = f"coalesce({text}, '')"
    return F.concat(_digest(text), _sketch(text))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both: insertion."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x, i: (x["a"] + x["b"]).bitwiseAND(_mask(i)))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint of a's paragraphs less b's: deletion."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x, i: (x["a"] - x["b"]).bitwiseAND(_mask(i)))


def _mask(lane: Column) -> Column:
    return F.when(lane < DIGEST, F.lit((1 << 32) - 1)).otherwise(F.lit((1 << 16) - 1))


def to_string(vector_: str) -> Column:
    return F.expr(f"array_join(transform({vector_}, (x, i) -> lpad(lower(hex(x)), if(i < {DIGEST}, 8, 4), '0')), '')")


def from_string(text: str) -> Column:
    """The vector of a string form."""
    return F.expr(f"""transform(sequence(0, {DIGEST + SKETCH - 1}), i -> CAST(conv(
        if(i < {DIGEST}, substr({text}, i * 8 + 1, 8), substr({text}, {DIGEST * 8 + 1} + (i - {DIGEST}) * 4, 4)), 16, 10) AS BIGINT))""")


def likeness(a: str, b: str) -> Column:
    """From two vectors, 0 to 1: 1 for equal multisets of paragraphs, else an estimate of twice the word pairs shared over all
    word pairs of both. Its standard error is about 1 / sqrt(SKETCH), 0.09."""
    signed = "(({0} + 32768L) & 65535L) - 32768L"
    both = f"zip_with(slice({a}, {DIGEST + 1}, {SKETCH}), slice({b}, {DIGEST + 1}, {SKETCH}), (x, y) -> named_struct('x', {signed.format('x')}, 'd', {signed.format('x - y')}, 'y', {signed.format('y')}))"
    sums = f"aggregate({both}, named_struct('d', 0L, 'all', 0L), (s, v) -> named_struct('d', s.d + v.d * v.d, 'all', s.all + v.x * v.x + v.y * v.y), s -> if(s.all = 0, 0D, greatest(0D, 1D - s.d / s.all)))"
    return F.expr(f"if(slice({a}, 1, {DIGEST}) = slice({b}, 1, {DIGEST}), 1D, {sums})")


def fingerprints(documents: DataFrame) -> DataFrame:
    """All columns of documents with fingerprint string (and its vector as lanes). Columns with these names give way."""
    return documents.withColumn("lanes", vector("text")).withColumn("fingerprint", to_string("lanes"))


#: Stands for a null doc_id in keys, so that joins need no null-safe form.
_NULL = -(1 << 63)


def successors(documents: DataFrame) -> DataFrame:
    """The next document of each, in the order of (doc, hash): doc, hash, n_chars, copies, next_doc, next_hash; after the last
    comes the first. Ids are dealt out by range and looked up within parts; what stands at the borders is one row
    for each part."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = documents.groupBy("doc", "hash").agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.count("*").alias("copies"))
    ids = stage(ids.repartitionByRange(parts, "doc", "hash").withColumn("part", F.spark_partition_id()), "ids")
    firsts = ids.groupBy("part").agg(F.min(F.struct("doc", "hash")).alias("own"))
    # as many rows as parts
    order = W.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("own").over(order), F.first("own").over(order)).alias("border"))
    within = W.partitionBy("part").orderBy("doc", "hash")
    after = ids.withColumn("after", F.lead(F.struct("doc", "hash")).over(within)).join(F.broadcast(firsts), "part")
    return after.select("doc", "hash", "n_chars", "copies", F.coalesce("after", "border").alias("next")).select("doc", "hash", "n_chars", "copies", F.col("next.doc").alias("next_doc"), F.col("next.hash").alias("next_hash"))


def edits(documents: DataFrame) -> DataFrame:
    """For each row of documents (doc_id long, text): its fingerprint, that of its edited text (the last floor(n_chars / 2) code
    points replaced by the first as many of the next document), and how like they and the next document's are.

    The order is that of doc_id, of texts' hashes where a doc_id is repeated; a null doc_id comes first, a null text is an
    empty one. Rows equal in doc_id and text are one document and come back as often. A single document is its own next."""
    rows = documents.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    order = stage(successors(rows), "successors")
    printed = rows.withColumn("lanes", vector("text"))
    own = printed.join(order, ["doc", "hash"])
    takes = order.select(F.col("doc").alias("to_doc"), F.col("hash").alias("to_hash"), F.expr("CAST(n_chars div 2 AS int)").alias("half"), F.col("next_doc").alias("doc"), F.col("next_hash").alias("hash"))
    gives = printed.join(takes, ["doc", "hash"]).select("to_doc", "to_hash", F.expr("substr(text, 1, half)").alias("piece"), F.col("lanes").alias("next_lanes"))
    if not order.where("copies > 1").isEmpty():
        gives = gives.dropDuplicates(["to_doc", "to_hash"])  # equal rows give once
    gives = gives.withColumnRenamed("to_doc", "doc").withColumnRenamed("to_hash", "hash")
    both = own.join(gives, ["doc", "hash"]).withColumn("edited", F.expr("concat(substr(text, 1, CAST(n_chars - n_chars div 2 AS int)), piece)"))
    both = both.withColumn("edited_lanes", vector("edited"))
    return both.select(
        F.when(F.col("doc") != _NULL, F.col("doc")).alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        to_string("lanes").alias("fingerprint"), to_string("edited_lanes").alias("edited_fingerprint"),
        likeness("lanes", "edited_lanes").alias("near_edited"), likeness("lanes", "next_lanes").alias("near_next"),
    )
