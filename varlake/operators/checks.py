"""Checks of a variant input before a run: its genotypes, records, contigs and reference alleles, and the verdict over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def genotype_mode(samples: Column, formats: Column) -> Column:
    """From a header's sample names and FORMAT keys."""
    return (
        F.when(F.coalesce(F.size(samples), F.lit(0)) <= 0, "no_samples").when(~F.coalesce(F.array_contains(formats, "GT"), F.lit(False)), "samples_without_GT")
        .when(F.size(samples) == 1, "single_sample").otherwise("multi_sample")
    )


def repeated_names(samples: Column) -> Column:
    """Names that occur more than once, sorted."""
    return F.array_sort(F.array_distinct(F.filter(samples, lambda x: F.size(F.filter(samples, lambda y: y == x)) > 1)))


def record_scan(df: DataFrame) -> DataFrame:
    """One row of counts over records (CHROM, POS, REF, ALT): records, duplicates, alt_is_ref, no_alt, symbolic, multiallelic and
    not_parsimonious (an allele could lose a base that both share). Equal records meet once, pre-aggregated."""
    ref, alt = F.upper("REF"), F.upper("ALT")
    kinds = {
        "alt_is_ref": ref == alt, "no_alt": F.col("ALT").isNull() | F.col("ALT").isin("", "."), "multiallelic": F.contains("ALT", F.lit(",")),
        "symbolic": ~alt.rlike("^[ACGT]+(,[ACGT]+)*$") | ~ref.rlike("^[ACGT]+$"),
        "not_parsimonious": (ref != alt) & ((F.length("REF") > 1) & (F.length("ALT") > 1)) & ((F.right(ref, F.lit(1)) == F.right(alt, F.lit(1))) | (F.left(ref, F.lit(1)) == F.left(alt, F.lit(1)))),
    }
    groups = df.groupBy("CHROM", "POS", "REF", "ALT").agg(F.count("*").alias("n"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), *(total(c).alias(k) for k, c in kinds.items()))


def input_check(records: DataFrame, contigs: DataFrame, reference: DataFrame, max_mismatch: float = 0.01, min_checked: int = 100) -> DataFrame:
    """The report (key, value) over three parts: records (CHROM, POS, REF, ALT), contigs as contig_header_check gives them (state),
    reference as reference_allele_check does (agrees). status is FAIL if a failure is found; failures and
    warnings are rows of their own. All counts come from aggregates; the report itself is one row turned into few."""
    counts = record_scan(records)
    parts = [
        counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("long").alias("n")) for c in counts.columns))).alias("x")).select("x.*"),
        contigs.groupBy("state").agg(F.count("*").alias("n")).select(F.concat(F.lit("contig_"), "state").alias("key"), "n"),
        reference.agg(F.count("*").alias("checked"), F.count_if(~F.col("agrees")).alias("differ")).select(F.explode(F.array(F.struct(F.lit("ref_checked").alias("key"), F.col("checked").alias("n")), F.struct(F.lit("ref_mismatches").alias("key"), F.col("differ").alias("n")))).alias("x")).select("x.*"),
    ]
    # some twenty rows
    found = parts[0].union(parts[1]).union(parts[2]).agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("m"))

    def n(key: str) -> Column:
        return F.coalesce(F.try_element_at("m", F.lit(key)), F.lit(0))

    share = n("ref_mismatches") / F.greatest(n("ref_checked"), F.lit(1))
    with_length = n("contig_ok") + n("contig_name") + n("contig_length")
    failures = {
        "contig lengths differ from the reference": n("contig_length") > 0,
        "no contig name resolves": (with_length == 0) & (n("contig_unmatched") > 0),
        "reference alleles differ": share > max_mismatch,
        "too few reference alleles checked": (with_length + n("contig_unmatched") == 0) & (n("ref_checked") < min_checked),
        "multiallelic records": n("multiallelic") > 0,
        "records not parsimonious": n("not_parsimonious") > 0,
    }
    warnings = {
        "contigs not in the reference": n("contig_unmatched") > 0, "reference alleles differ within the threshold": (n("ref_mismatches") > 0) & (share <= max_mismatch),
        "duplicate records": n("duplicates") > 0, "ALT identical to REF": n("alt_is_ref") > 0, "no ALT allele": n("no_alt") > 0,
    }

    def listed(kind: str, texts: dict[str, Column]) -> Column:
        return F.filter(F.array(*(F.when(c, F.struct(F.lit(kind).alias("key"), F.lit(t).alias("value"))) for t, c in texts.items())), lambda x: x.isNotNull())

    bad, odd = listed("failure", failures), listed("warning", warnings)
    keys = ["records", "duplicates", "alt_is_ref", "no_alt", "multiallelic", "symbolic", "not_parsimonious", "ref_checked", "ref_mismatches", "contig_ok", "contig_name", "contig_length", "contig_unmatched"]
    rows = F.concat(F.array(F.struct(F.lit("status").alias("key"), F.when(F.size(bad) > 0, "FAIL").otherwise("PASS").alias("value")), *(F.struct(F.lit(k).alias("key"), n(k).cast("string").alias("value")) for k in keys)), bad, odd)
    return found.select(F.explode(rows).alias("x")).select("x.key", "x.value")
