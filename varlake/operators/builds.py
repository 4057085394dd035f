"""Genome builds: chain blocks, liftover, reference checks; names of contigs and genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.values import bare_chrom, by_value, once, reverse_complement
from varlake.operators.joins import interval_join


def liftover(df: DataFrame, blocks: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Rows (chrom, pos, ref, alt) through chain blocks (src, src_start, src_end; half-open, dst, dst_start, strand): lifted chrom, pos, ref, alt and
    reason (null, unmapped, ambiguous, minus_strand_indel). On the minus strand single bases are complemented."""
    rows = df.withColumn("__stop", F.col("pos") + 1)
    pairs = interval_join(rows, blocks, bin_size, ("chrom", "src"), ("pos", "__stop"), ("src_start", "src_end"))
    offset = F.col("pos") - F.col("src_start")
    length = F.col("src_end") - F.col("src_start")
    place = F.when(F.col("strand") == "-", F.col("dst_start") + length - 1 - offset).otherwise(F.col("dst_start") + offset)
    key = df.columns
    hits = pairs.groupBy(*key).agg(F.count("*").alias("__n"), F.min(F.struct(F.col("dst"), place.alias("p"), "strand")).alias("__h"))
    out = df.join(hits, key, "left")
    single = (F.length("ref") == F.length("alt"))
    reason = F.when(F.col("__n").isNull(), "unmapped").when(F.col("__n") > 1, "ambiguous").when((F.col("__h.strand") == "-") & ~single, "minus_strand_indel")
    good = reason.isNull()

    def allele(c: str) -> Column:
        return F.when(good, F.when(F.col("__h.strand") == "-", reverse_complement(F.col(c))).otherwise(F.col(c)))

    return out.select(*key, F.when(good, F.col("__h.dst")).alias("lifted_chrom"), F.when(good, F.col("__h.p")).alias("lifted_pos"), allele("ref").alias("lifted_ref"), allele("alt").alias("lifted_alt"), reason.alias("reason"))


def reference_allele_check(df: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """For each row (contig, pos, ref; one base) whether the reference tile has that base (null behind the contig's end); other than ACGT is skipped."""
    rows = df.where(F.upper("ref").rlike("^[ACGT]$")).withColumn("tile", F.floor((F.col("pos") - 1) / size))
    base = F.expr(f"substr(seq, CAST((pos - 1) % {size} + 1 AS int), 1)")
    return rows.join(tiles, ["contig", "tile"]).select(*df.columns, F.when(base != "", F.upper(base) == F.upper("ref")).alias("agrees"))


def contig_header_check(header: DataFrame, reference: DataFrame) -> DataFrame:
    """Header contigs (contig, length) against reference ones by bare name: name, length, unmatched or ok."""
    a = header.select(F.col("contig"), F.col("length"), bare_chrom(F.col("contig")).alias("__b"))
    b = reference.select(F.col("contig").alias("reference"), F.col("length").alias("__l"), bare_chrom(F.col("contig")).alias("__b"))
    state = F.when(F.col("reference").isNull(), "unmatched").when(F.col("length") != F.col("__l"), "length").when(F.col("contig") != F.col("reference"), "name").otherwise("ok")
    return a.join(b, "__b", "left").select("contig", "reference", state.alias("state"))


def resolve_gene_names(names: DataFrame, genes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names as a gene id: exact symbol, else one by case-folding, else an id itself, else an alias of one gene; reason says how or why not."""
    exact = genes.groupBy(F.col("symbol").alias("name")).agg(F.min("gene_id").alias("exact"))
    folded = genes.groupBy(F.upper("symbol").alias("__u")).agg(F.min("gene_id").alias("folded"), F.count_distinct("gene_id").alias("__nf"))
    ids = genes.select(F.col("gene_id").alias("name"), F.col("gene_id").alias("own")).distinct()
    other = aliases.groupBy(F.col("symbol").alias("name")).agg(F.min("ensg").alias("alias"), F.count_distinct("ensg").alias("__na"))
    rows = names.withColumn("__u", F.upper("name")).join(exact, "name", "left").join(folded, "__u", "left").join(ids, "name", "left").join(other, "name", "left")
    reason = F.when(F.col("exact").isNotNull(), "exact").when(F.col("__nf") == 1, "case").when(F.col("own").isNotNull(), "id").when(F.col("__na") == 1, "alias").when(F.col("__na") > 1, "ambiguous").otherwise("not_found")
    gene = F.coalesce("exact", F.when(F.col("__nf") == 1, F.col("folded")), "own", F.when(F.col("__na") == 1, F.col("alias")))
    return rows.select("name", gene.alias("gene_id"), reason.alias("reason"))


def normalize_indel(df: DataFrame, blocks: DataFrame, tiles: DataFrame, size: int, bin_size: int = 10_000) -> DataFrame:
    """Deletions and insertions of another build (key, chrom, pos, ref, alt, description) as anchored alleles of the target build: all
    columns with norm_chrom, norm_pos, norm_ref, norm_alt, null where nothing can be read, lifted or found.

    The description (g.10_12del, g.10del, g.10_11insACG, g.10_12delinsAC) counts first, else alleles of which one is empty or -. The base
    before the change is lifted through blocks, and bases are taken from tiles (contig, tile, seq; 1-based) of size bases.
    """
    text = F.coalesce(F.trim("description"), F.lit(""))
    ref, alt = (F.when(F.trim(c) != "-", F.trim(c)).otherwise("") for c in ("ref", "alt"))
    ref, alt = F.coalesce(ref, F.lit("")), F.coalesce(alt, F.lit(""))

    def found(pattern: str, group: int) -> Column:
        value = F.regexp_extract(text, pattern, group)
        return F.when(value != "", value)

    span, one, between = r"g\.(\d+)_(\d+)del", r"g\.(\d+)del", r"g\.(\d+)_(\d+)ins([ACGTN]+)"
    first, last, single = found(span, 1).cast("long"), found(span, 2).cast("long"), found(one, 1).cast("long")
    kind = F.when(first.isNotNull() | single.isNotNull(), "del").when(found(between, 3).isNotNull(), "ins").when((alt == "") & (ref != ""), "del").when((ref == "") & (alt != ""), "ins")
    named = first.isNotNull() | single.isNotNull() | found(between, 3).isNotNull()
    start = F.coalesce(first, single, F.when(found(between, 3).isNotNull(), found(between, 1).cast("long")), F.col("pos").cast("long"))
    gone = F.when(kind == "ins", 0).otherwise(F.coalesce(last - first + 1, F.when(single.isNotNull(), 1), F.length(ref)))
    put = F.when(first.isNotNull(), F.coalesce(found(r"ins([ACGTN]+)", 1), F.lit(""))).when(single.isNotNull(), "").when(named, found(between, 3)).otherwise(F.when(kind == "ins", alt).otherwise(""))
    rows = once(df, {"__kind": kind, "__at": F.when(kind == "del", start - 1).otherwise(start), "__gone": gone.cast("long"), "__put": put})
    changes = ["chrom", "__at", "__gone"]

    def placed(rows: DataFrame) -> DataFrame:
        """__norm: place and bases in the target of each change, which is lifted once however many rows have it."""
        wanted = rows.where("__kind AND __at IS NOT NULL").select(*changes).distinct()
        lifted = liftover(wanted.select(*changes, (F.col("__at") - 1).alias("pos"), F.lit("N").alias("ref"), F.lit("N").alias("alt")), blocks, bin_size).where("reason IS NULL")
        found = lifted.select(*changes, F.col("lifted_chrom").alias("contig"), (F.col("lifted_pos") + 1).alias("lifted_pos"))
        # the preceding base and what is deleted, from as many tiles as they touch
        low, high = (F.floor((c - 1) / size) for c in (F.col("lifted_pos"), F.col("lifted_pos") + F.col("__gone")))
        pieces = found.withColumn("tile", F.explode(F.sequence(low, high))).join(tiles, ["contig", "tile"]).groupBy(*changes, "contig", "lifted_pos").agg(F.array_sort(F.collect_list(F.struct("tile", "seq"))).alias("__t"))
        joined = F.array_join(F.transform("__t", lambda x: x["seq"]), "")
        bases = F.upper(F.substr(joined, (F.col("lifted_pos") - 1 - F.col("__t")[0]["tile"] * size + 1).cast("int"), (F.col("__gone") + 1).cast("int")))
        pieces = pieces.select(*changes, F.struct(F.col("contig").alias("chrom"), F.col("lifted_pos").alias("pos"), bases.alias("ref")).alias("__norm")).where("__norm.ref <> ''")
        return rows.join(pieces, changes, "left").select(*rows.columns, F.when(F.col("__kind"), F.col("__norm")).alias("__norm"))

    rows = by_value(rows.withColumn("__kind", F.col("__kind").isNotNull()), ["__kind", *changes], placed)
    norm = F.col("__norm")
    return rows.select(*df.columns, norm["chrom"].alias("norm_chrom"), norm["pos"].alias("norm_pos"), norm["ref"].alias("norm_ref"), F.concat(F.left(norm["ref"], F.lit(1)), "__put").alias("norm_alt"))
