"""FASTA files as tiles: a contig of any length is many rows, and no task or value holds one whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_PLACE = ["block", "line"]


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of FASTA files with their place: file, block and line (order within a file: the block that Spark reads, then the line in it), header
    (1 for a > line) and value without blanks at its end. Empty lines are left out. Files are split as Spark splits text; gzip files are not."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), F.rtrim(F.rtrim("value"), F.lit("\r \t")).alias("value"))
    return rows.where("value <> ''").select("file", *_PLACE, F.startswith("value", F.lit(">")).cast("int").alias("header"), "value")


def fasta_tiles(spark: SparkSession, path: str, size: int) -> DataFrame:
    """Tiles (contig, tile, seq) of size bases, from 0, of the contigs of FASTA files; the last of a contig may be shorter. contig is the first word of
    the header. Letters stay as they are.

    Which contig a line belongs to, and where in it the line begins, are running sums within the blocks that Spark reads (a gzip file is one), to which
    what the blocks before add up to is added; lines are then cut at the borders of tiles and each tile is put together by itself. Lines go
    through two shuffles, whole contigs through none. Lines before the first header of a file belong to no contig; a contig without bases has no tile. A name
    that stands twice gives its tiles twice. A line is one value, so a file should have lines of usual length.
    """
    name = F.substring_index(F.ltrim(F.substring("value", 2, 1 << 30)), " ", 1)
    lines = fasta_lines(spark, path).withColumns({"bases": F.when(F.col("header") == 0, F.length("value")).otherwise(0), "contig": F.when(F.col("header") == 1, name)})
    upto = W.partitionBy("file", "block").orderBy("line").rowsBetween(W.unboundedPreceding, 0)

    def inside(rows: DataFrame) -> DataFrame:
        """number, to and start of each line as its block alone tells them: headers, bases, and bases before the last header."""
        rows = rows.withColumns({"number": F.sum("header").over(upto), "to": F.sum("bases").over(upto)})
        return rows.withColumn("start", F.max(F.when(F.col("header") == 1, F.col("to"))).over(upto))

    blocks = inside(lines.select("file", *_PLACE, "header", "bases", "contig")).groupBy("file", "block").agg(F.max("number").alias("headers"), F.max("to").alias("length"), F.max("start").alias("last"), F.max_by("contig", F.when(F.col("header") == 1, F.col("line"))).alias("name"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumns({"b_number": F.coalesce(F.sum("headers").over(earlier), F.lit(0)), "b_to": F.coalesce(F.sum("length").over(earlier), F.lit(0)), "b_contig": F.last("name", ignorenulls=True).over(earlier)})
    blocks = blocks.withColumn("b_start", F.max(F.col("b_to") + F.col("last")).over(earlier))
    # a row for each block of a file
    rows = inside(lines).withColumn("own", F.last("contig", ignorenulls=True).over(upto)).join(F.broadcast(blocks.select("file", "block", "b_number", "b_to", "b_contig", "b_start")), ["file", "block"])
    number, start = F.col("b_number") + F.col("number"), F.coalesce(F.col("b_to") + F.col("start"), "b_start")
    placed = rows.where("header = 0").select("file", number.alias("number"), F.coalesce("own", "b_contig").alias("contig"), "value", (F.col("b_to") + F.col("to") - start).alias("to"), "bases").where("number > 0")
    placed = placed.withColumn("from", F.col("to") - F.col("bases"))
    cut = placed.select("file", "number", "contig", "from", "value", F.explode(F.sequence(F.floor(F.col("from") / size), F.floor((F.col("to") - 1) / size))).alias("tile"))
    first = F.greatest(F.col("tile") * size - F.col("from"), F.lit(0))
    last = F.least((F.col("tile") + 1) * size - F.col("from"), F.length("value"))
    pieces = cut.select("file", "number", "contig", "tile", "from", F.substr("value", (first + 1).cast("int"), (last - first).cast("int")).alias("piece"))
    tiles = pieces.groupBy("file", "number", "contig", "tile").agg(F.array_sort(F.collect_list(F.struct("from", "piece"))).alias("pieces"))
    return tiles.select("contig", "tile", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("seq"))


def write_fasta(sequences: DataFrame, path: str, width: int = 60) -> None:
    """Sequences (contig, seq) as FASTA files with lines of width bases; a contig is in one file."""
    lines = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("seq") / width).cast("int") - 1, F.lit(0))), lambda i: F.substr("seq", i * width + 1, F.lit(width)))
    body = F.when(F.length("seq") > 0, lines).otherwise(F.array().cast("array<string>"))
    sequences.select(F.explode(F.concat(F.array(F.concat(F.lit(">"), F.col("contig").cast("string"))), body)).alias("value")).write.text(path)
