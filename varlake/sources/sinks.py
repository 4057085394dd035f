"""Sinks: tables by extension, one schema over parts, rejected rows, VCF and BED lines, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.operators.rows import clean_text_cells


def save_table(df: DataFrame, path: str) -> None:
    """tsv, csv or parquet by extension; an existing path or another extension is an error."""
    kind = path.rsplit(".", 1)[-1]
    if kind not in ("tsv", "csv", "parquet", "pq"):
        raise ValueError(f"no writer for .{kind}")
    writer = df.write.mode("errorifexists")
    writer.parquet(path) if kind in ("parquet", "pq") else writer.csv(path, sep="\t" if kind == "tsv" else ",", header=True)


def unify_parts(parts: list[DataFrame]) -> DataFrame:
    """Parts as one table: missing columns are typed nulls, int and double become double, all-null columns take the others' type.
    Parts whose common columns stand in another order are refused."""
    order: list[str] = []
    for p in parts:
        common = [c for c in p.columns if c in order]
        if common != [c for c in order if c in p.columns]:
            raise ValueError("columns stand in another order")
        order += [c for c in p.columns if c not in order]
    kinds: dict[str, T.DataType] = {}
    for c in order:
        found = {p.schema[c].dataType for p in parts if c in p.columns} - {T.NullType()}
        numeric = all(isinstance(k, T.NumericType) for k in found)
        kinds[c] = next(iter(found)) if len(found) == 1 else T.StringType() if not found or not numeric else T.DoubleType() if any(isinstance(k, T.FractionalType) for k in found) else T.LongType()
    out = [p.select(*((F.col(c) if c in p.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in order)) for p in parts]
    for p in out[1:]:
        out[0] = out[0].unionByName(p)
    return out[0]


def vcf_lines(df: DataFrame, info: list[str]) -> DataFrame:
    """Tab lines of a VCF body, INFO packed k=v;."""
    packed = F.concat_ws(";", *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), clean_text_cells(F.col(c)))) for c in info))
    return df.select(F.concat_ws("\t", "CHROM", F.col("POS").cast("string"), F.lit("."), "REF", "ALT", F.lit("."), F.lit("."), F.when(packed == "", ".").otherwise(packed)).alias("value"))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a table with a reason column."""
    return df.where("reason IS NULL").drop("reason"), df.where("reason IS NOT NULL")


def append_segment(df: DataFrame, folder: str, version: str, segment: str) -> None:
    """A segment of the score cache; its manifest row (count, checksum) is written last and makes it valid."""
    path = f"{folder}/version={version}/segment={segment}"
    df.write.mode("errorifexists").parquet(path)
    stamp = checksum(df.sparkSession.read.parquet(path)).withColumns({"version": F.lit(version), "segment": F.lit(segment)})
    stamp.write.mode("append").parquet(f"{folder}/manifest")


def checksum(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_records"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0)).alias("checksum"))


def valid_segments(df: DataFrame, manifest: DataFrame, by: str = "segment") -> DataFrame:
    """Rows of the segments whose count and checksum agree with the manifest."""
    values = [c for c in df.columns if c != by]
    found = df.groupBy(by).agg(F.count("*").alias("n_records"), F.bit_xor(F.xxhash64(*values)).alias("checksum"))
    good = found.join(manifest, [by, "n_records", "checksum"], "left_semi").select(by)
    # a row a segment; dealt out by segment, one task would get all rows of one
    return df.join(F.broadcast(good), by, "left_semi")
