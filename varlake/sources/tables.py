"""Scans of whole tables: by extension, with the kinds of their columns, many files with their origin, chains, traces, stamps."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varlake.functions.values import duration_ms, size_bytes
from varlake.sources.scans import whole_file_kinds

# Names by which columns of an input table are recognised, in order of preference.
CDNA = ("cdna", "nombre_adn", "hgvs", "hgvs_cdna", "variant_cdna", "variant")
CHROM, POS = ("chrom", "chromosome", "chr"), ("pos", "position", "start")
REF, ALT = ("ref", "reference"), ("alt", "alternate")
LOCUS = ("locus", "variant_id", "variant_key", "pos_hg38", "variant_id_hg38")

_KINDS = {"bool": "boolean", "int": "long", "float": "double"}
_STAMP = "provenance"


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names; on one machine, where it is unset, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder}/{uuid.uuid4().hex}"


def scan_table(spark: SparkSession, path: str, kinds: bool = True) -> DataFrame:
    """A table by its extension: parquet or pq; tsv (gzipped, too) with . for no value; csv or txt, by tabs if the header has one and no
    comma. Text columns become bool, int or float where all their values are (kinds); one pass tells."""
    name = path.lower().removesuffix(".gz").rstrip("/")
    kind = name.rsplit(".", 1)[-1]
    if kind in ("parquet", "pq"):
        return spark.read.parquet(path)
    if kind not in ("tsv", "csv", "txt"):
        raise ValueError(f"no scan for .{kind}")
    head = spark.read.text(path).first()
    header = head.value if head else ""
    tabs = kind == "tsv" or ("\t" in header and "," not in header)
    df = spark.read.csv(path, sep="\t" if tabs else ",", header=True, nullValue="." if tabs else "")
    return typed(df) if kinds and df.columns else df


def typed(df: DataFrame) -> DataFrame:
    """Text columns cast to the narrowest kind that holds all their values."""
    found = {r.column: r.kind for r in whole_file_kinds(df).collect()}  # a row for each column
    return df.select(*(F.col(f"`{c}`").cast(_KINDS[found[c]]).alias(c) if found[c] in _KINDS else F.col(f"`{c}`") for c in df.columns))


def find_columns(columns: list[str]) -> dict[str, str | list[str] | None]:
    """Which columns name the variant: cdna, or else ids: CHROM, POS, REF and ALT, or else a locus. Names count in any case."""
    low = {c.lower(): c for c in reversed(columns)}
    cdna = next((c for c in columns if c.lower() in CDNA), None)
    if cdna:
        return {"cdna": cdna, "ids": None}
    parts = [next((low[n] for n in names if n in low), None) for names in (CHROM, POS, REF, ALT)]
    locus = next((c for c in columns if c.lower() in LOCUS), None)
    return {"cdna": None, "ids": parts if all(parts) else [locus] if locus else None}


def union_with_origin(spark: SparkSession, paths: list[str] | str, column: str = "Gene_Dataset") -> DataFrame:
    """Many Parquet tables as one, columns by name; column has the table's file name up to its first dot."""
    df = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
    return df.withColumn(column, F.regexp_extract(F.input_file_name(), r"/([^/.]+)[^/]*\.(?:parquet|pq)(?:/|$)", 1))


def read_chains(spark: SparkSession, path: str) -> DataFrame:
    """Chains of a file (value): blank lines part them."""
    return spark.read.text(path, lineSep="\n\n").where("trim(value) <> ''")


def chain_blocks(chains: DataFrame) -> DataFrame:
    """Blocks (src, src_start, src_end, dst, dst_start, strand) of chains (value: header and lines `size gap_in_source gap_in_target`).
    Starts are 0-based; on the minus strand dst_start counts from the target's beginning, too. A chain's lines are few."""
    rows = chains.select(F.monotonically_increasing_id().alias("chain"), F.split(F.trim("value"), "\n").alias("lines"))
    rows = rows.select("chain", F.split(F.trim(F.element_at("lines", 1)), "\\s+").alias("h"), F.posexplode(F.slice("lines", 2, F.size("lines"))).alias("n", "line"))
    rows = rows.where(F.element_at("h", 1) == "chain").withColumn("p", F.split(F.trim("line"), "\\s+"))

    def part(i: int) -> Column:
        return F.coalesce(F.get("p", F.lit(i)).try_cast("long"), F.lit(0))

    def header(i: int) -> Column:
        return F.get("h", F.lit(i))

    before = W.partitionBy("chain").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    source, target = (F.coalesce(F.sum(part(0) + part(i)).over(before), F.lit(0)) for i in (1, 2))
    rows = rows.select(
        header(2).alias("src"), (header(5).cast("long") + source).alias("src_start"), part(0).alias("size"), header(7).alias("dst"),
        header(8).cast("long").alias("length"), header(9).alias("strand"), (header(10).cast("long") + target).alias("at"),
    )
    start = F.when(F.col("strand") == "-", F.col("length") - F.col("at") - F.col("size")).otherwise(F.col("at"))
    return rows.select("src", "src_start", (F.col("src_start") + F.col("size")).alias("src_end"), "dst", start.alias("dst_start"), "strand")


def run_trace(trace: DataFrame) -> DataFrame:
    """Rows of a run's trace table: durations in ms, sizes in bytes, - is no host; columns that are not there are null."""
    def cell(name: str) -> Column:
        return F.col(name).cast("string") if name in trace.columns else F.lit(None).cast("string")

    host = F.trim(cell("hostname"))
    realtime = F.when(F.coalesce(cell("realtime"), F.lit("")) != "", cell("realtime")).otherwise(cell("duration"))
    return trace.select(
        cell("name").alias("name"), F.trim(F.regexp_replace(cell("name"), r"\s*\(.*\)\s*$", "")).alias("process"), cell("status").alias("status"),
        cell("exit").alias("exit"), cell("attempt").try_cast("int").alias("attempt"), duration_ms(realtime).alias("duration_ms"),
        size_bytes(cell("memory")).alias("requested_bytes"), size_bytes(cell("peak_rss")).alias("peak_rss_bytes"),
        F.when(~host.isin("", "-"), host).alias("host"), cell("workdir").alias("workdir"),
    )


def with_stamp(df: DataFrame, stamp: dict | None) -> DataFrame:
    """The stamp (run, code, parameters) as compact JSON in the metadata of every column, which Parquet keeps."""
    if stamp is None:
        return df
    text = json.dumps(stamp, separators=(",", ":"), sort_keys=True)
    return df.select(*(F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, _STAMP: text}) for f in df.schema))


def read_stamp(df: DataFrame) -> dict | None:
    """The stamp of a table, if its columns have one and the same."""
    found = {f.metadata.get(_STAMP) for f in df.schema}
    text = found.pop() if len(found) == 1 else None
    return json.loads(text) if text else None
