"""Scans of variant, annotation and log files as DataFrames. Each parser takes lines (value string), so that a file, a table or
a test can feed it; read_* read the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.functions.values import attribute, bare_chrom, once

BASE = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER")


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Lines of text files; gzip streams cannot be split, so they are dealt out after reading."""
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def vcf_records(lines: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """Records of a VCF: base columns, info and formats as maps for each sample (samples map<name, map<key, value>>)."""
    p = F.split("value", "\t")
    cells = {n: F.get(p, F.lit(i)) for i, n in enumerate(BASE)}
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select("value", *(F.when(v != ".", v).alias(n) for n, v in cells.items()), F.get(p, F.lit(7)).alias("INFO"))
    rows = rows.withColumns({"POS": F.col("POS").cast("long"), "QUAL": F.col("QUAL").try_cast("double")})
    if samples:
        keys = F.split(F.get(p, F.lit(8)), ":")
        rows = rows.withColumns({f"FORMAT_{s}": F.map_from_entries(F.arrays_zip(keys, F.slice(F.concat(F.split(F.get(p, F.lit(9 + i)), ":"), F.transform(keys, lambda k: F.lit("."))), 1, F.size(keys)))) for i, s in enumerate(samples)})
    return rows.drop("value")


def split_multiallelic(df: DataFrame) -> DataFrame:
    """One record for each ALT allele; allele is its number."""
    return df.select("*", F.posexplode(F.split("ALT", ",")).alias("allele", "__alt")).withColumns({"ALT": F.col("__alt"), "allele": F.col("allele") + 1}).drop("__alt")


def info_value(info: Column, key: str) -> Column:
    """Value of an INFO key; a flag without a value is null."""
    found = F.regexp_extract(info, f"(?:^|;){key}=([^;]*)", 1)
    return F.when(found != "", found)


def flatten_info(df: DataFrame, keys: list[str], skip: tuple[str, ...] = ("CSQ",)) -> DataFrame:
    """INFO keys as columns; lists are joined by &."""
    return df.withColumns({k: F.replace(info_value(F.col("INFO"), k), F.lit(","), F.lit("&")) for k in keys if k not in skip})


def csq_fields(header: str) -> list[str]:
    """Names of the consequence fields from the header's Format text."""
    return header.split("Format: ")[1].split('"')[0].strip().split("|")


def match_columns(fields: list[str], wanted: list[str]) -> list[str]:
    """Wanted names as they are, with a _ before them or a .N after them."""
    return [f for f in fields if any(f == w or f == f"_{w}" or (f.startswith(f"{w}.") and f[len(w) + 1 :].isdigit()) for w in wanted)]


def explode_csq(df: DataFrame, fields: list[str], genes: DataFrame | None = None, wanted: list[str] | None = None) -> DataFrame:
    """One row for each consequence entry; a record without entries keeps one row, unless genes (name) are asked for."""
    entries = F.split(info_value(F.col("INFO"), "CSQ"), ",")
    rows = df.select("*", F.explode_outer(entries).alias("__e")).withColumn("__p", F.split("__e", "\\|"))
    chosen = match_columns(fields, wanted) if wanted else fields
    rows = rows.withColumns({f: F.when(F.get("__p", F.lit(fields.index(f))) != "", F.get("__p", F.lit(fields.index(f)))) for f in {*chosen, *([] if genes is None else ["SYMBOL", "Feature"])}}).drop("__e", "__p")
    if genes is None:
        return rows
    from varlake.operators.reports import with_any_name

    return with_any_name(rows, [F.col("SYMBOL"), F.col("Feature")], genes)


def sample_format_columns(df: DataFrame, samples: list[str], keys: tuple[str, ...] = ("GT", "GQ", "DP", "AD")) -> DataFrame:
    """GT_, GQ_, DP_, AD_ columns of the chosen samples; records in which none has allele 1 go."""
    made = [f"FORMAT_{s}" for s in samples]
    # each map is made once, not again for each key and in the filter
    rows = once(df, {f"__{m}": F.col(m) for m in made}, drop=made).withColumnsRenamed({f"__{m}": m for m in made})
    rows = rows.withColumns({f"{k}_{s}": F.try_element_at(F.col(f"FORMAT_{s}"), F.lit(k)) for s in samples for k in keys})
    return rows.where(F.exists(F.array(*(F.col(f"GT_{s}") for s in samples)), lambda g: F.coalesce(F.contains(g, F.lit("1")), F.lit(False))))


def choose_samples(there: list[str], asked: list[str]) -> list[str]:
    """Exact names, else names that contain one asked for, else all."""
    return [s for s in there if s in asked] or [s for s in there if any(a in s for a in asked)] or there


def extract_genotypes(df: DataFrame, samples: list[str]) -> DataFrame:
    """The long table: a row for each record and sample, reference and missing calls included; nulls never become 0."""
    cells = F.explode(F.array(*(F.struct(F.lit(s).alias("sample_id"), F.col(f"FORMAT_{s}").alias("f")) for s in samples)))
    rows = df.select("CHROM", "POS", "REF", "ALT", cells.alias("c"))

    def get(k: str) -> Column:
        value = F.try_element_at(F.col("c.f"), F.lit(k))
        return F.when(~value.isin(".", ""), value)

    return rows.select("CHROM", "POS", "REF", "ALT", "c.sample_id", F.try_element_at(F.col("c.f"), F.lit("GT")).alias("gt_raw"), get("GQ").try_cast("int").alias("gq"), get("DP").try_cast("int").alias("dp"), get("AD").alias("ad"))


def gtf_features(lines: DataFrame, feature: str) -> DataFrame:
    """Features of a GTF with gene_id, gene_name, transcript_id."""
    p = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).where(F.get(p, F.lit(2)) == feature)
    return rows.select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(3)).cast("long").alias("start"), F.get(p, F.lit(4)).cast("long").alias("end"), F.get(p, F.lit(6)).alias("strand"), *(attribute(F.get(p, F.lit(8)), a).alias(a) for a in ("gene_id", "gene_name", "transcript_id")))


def primary_gene(genes: DataFrame) -> DataFrame:
    """One place for each gene name: a primary contig before others."""
    primary = bare_chrom(F.col("chrom")).rlike("^([0-9]{1,2}|X|Y|MT)$")
    return genes.groupBy("gene_name").agg(F.min(F.struct((~primary).alias("other"), "chrom", "start", "end", "strand")).alias("g")).select("gene_name", "g.chrom", "g.start", "g.end", "g.strand")


def exon_array(starts: Column, sizes: Column) -> Column:
    """BED12-like comma lists as a sorted array of (start, end)."""
    a, b = (F.filter(F.split(c, ","), lambda x: x != "") for c in (starts, sizes))
    return F.array_sort(F.zip_with(a, b, lambda s, n: F.struct(s.cast("long").alias("start"), (s.cast("long") + n.cast("long")).alias("end"))))


def alias_edges(df: DataFrame) -> DataFrame:
    """(symbol, ensg, tier) from approved, previous and alias symbols: tier 0 is the approved one."""
    other = F.explode(F.filter(F.concat(F.split("prev_symbol", "\\|"), F.split("alias_symbol", "\\|")), lambda s: s != ""))
    return df.select("symbol", F.col("ensembl_gene_id").alias("ensg"), F.lit(0).alias("tier")).union(df.select(other.alias("symbol"), "ensembl_gene_id", F.lit(1))).where("ensg IS NOT NULL AND ensg <> ''").distinct()


def run_log(lines: DataFrame, order: str) -> DataFrame:
    """Task rows from log lines such as `[x] process > NAME (tag) status`: name, status, attempt."""
    from varlake.operators.aggregates import running_number

    rows = lines.select("*", F.regexp_extract("value", r"process > (\S+ \([^)]*\))", 1).alias("name"), F.regexp_extract("value", r"status: (\w+)", 1).alias("status")).where("name <> ''")
    return running_number(rows, ["name"], [order])


def bed_regions(lines: DataFrame) -> DataFrame:
    p = F.split("value", "\t")
    return lines.where(~F.col("value").rlike("^(#|track|browser)")).select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).cast("long").alias("start"), F.get(p, F.lit(2)).cast("long").alias("end"), F.get(p, F.lit(3)).alias("name"))


def sequence_tiles(sequences: DataFrame, size: int) -> DataFrame:
    """Tiles (contig, tile, seq) of sequences (contig, seq)."""
    n = F.expr(f"greatest(1, ceil(length(seq) / {size}))")
    return sequences.select("contig", "seq", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("tile")).select("contig", "tile", F.expr(f"substr(seq, CAST(tile * {size} + 1 AS int), {size})").alias("seq"))


#: What a text must look like that a cast can read: whole numbers; for double also decimal ones, hexadecimal ones, inf, infinity and nan. What stands
#: around them (blanks, control characters) is left to the cast.
_MAY = {
    "long": r"^[^0-9A-Za-z.]*+[0-9]++[^0-9A-Za-z.]*$",
    "double": r"^[^0-9A-Za-z.]*+(?:(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?[fFdD]?|0[xX].*|(?i:nan|inf|infinity))[^0-9A-Za-z.]*$",
}


def whole_file_kinds(df: DataFrame) -> DataFrame:
    """For each text column the narrowest kind that holds all its values: bool, int, float, str or empty."""
    def kind(c: str) -> Column:
        v = F.when(F.col(c) != ".", F.col(c))
        # a cast throws an exception inside for each text that it can't read, so most of these are told by their look first
        every = lambda k: F.bool_and(F.when(v.isNotNull(), F.when(v.rlike(_MAY[k]), v.try_cast(k)).isNotNull()))
        yes = F.bool_and(F.when(v.isNotNull(), F.lower(v).isin("true", "false")))
        return F.when(F.count(v) == 0, "empty").when(yes, "bool").when(every("long"), "int").when(every("double"), "float").otherwise("str")

    one = df.agg(*(kind(c).alias(c) for c in df.columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("kind")) for c in df.columns))).alias("x")).select("x.*")
