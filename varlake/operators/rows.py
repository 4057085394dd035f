"""Projections and filters of the annotated table."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.values import exact_number, fixed_text, known, true

SAMPLE_PREFIXES = ("GT_", "GQ_", "AD_", "DP_")
CALLED = ("HET", "HOMALT")


def columns_like(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def select_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, their .1 and .2 repeats, and all sample columns, in this order."""
    names = [w.replace(",", "") for w in wanted]
    names += [f"{n}{s}" for s in (".1", ".2") for n in names]
    names += [c for c in df.columns if c.startswith(SAMPLE_PREFIXES)]
    return df.select(*(F.col(f"`{n}`") for n in dict.fromkeys(names) if n in df.columns))


def fix_dup_columns(df: DataFrame) -> DataFrame:
    """Values of X.1 and X.2 fill the gaps of X; the repeats go. A repeat without its X stays, its . and empty texts null."""
    repeats = [c for c in df.columns if re.search(r"\.[12]$", c)]
    plain = {c: F.when(~F.trim(F.col(f"`{c}`").cast("string")).isin("", "."), F.col(f"`{c}`")) for c in repeats}
    out = []
    for c in df.columns:
        if c in plain:
            if c[:-2] not in df.columns:
                out.append(plain[c].alias(c))
            continue
        more = [plain[f"{c}{s}"] for s in (".1", ".2") if f"{c}{s}" in plain]
        out.append(F.coalesce(F.col(f"`{c}`"), *more).alias(c) if more else F.col(f"`{c}`"))
    return df.select(*out)


def locus() -> Column:
    return F.concat("CHROM", F.lit(":"), F.col("POS").cast("string"), F.lit("-"), "REF", F.lit("-"), "ALT")


def build_locus(df: DataFrame) -> DataFrame:
    """Locus = CHROM:POS-REF-ALT, unless there is one."""
    return df if "Locus" in df.columns else df.withColumn("Locus", locus())


def build_cdna_name(df: DataFrame) -> DataFrame:
    """CDNA_NAME: the MANE transcript and the c. part of HGVSc; null if either is missing."""
    part = F.regexp_extract("HGVSc", r"\w*(:c\..*)", 1)
    return df if "CDNA_NAME" in df.columns else df.withColumn("CDNA_NAME", F.concat("MANE_SELECT", F.when(part != "", part)))


def genotype_word(gt: Column) -> Column:
    """HET, HOMREF, HOMALT, MISSING; other texts as they are."""
    return F.when(gt.isin("./.", "."), "MISSING").when(gt.isin("0/1", "1/0", "0|1", "1|0"), "HET").when(gt.isin("0/0", "0|0"), "HOMREF").when(gt.isin("1/1", "1|1"), "HOMALT").otherwise(gt)


def recode_genotypes(df: DataFrame) -> DataFrame:
    return df.withColumns({c: genotype_word(F.col(c)) for c in columns_like(df, "GT_")})


def remove_columns(df: DataFrame, columns: list[str] | str) -> DataFrame:
    """By a list of names, or by a pattern found in the name."""
    names = [c for c in df.columns if re.search(columns, c)] if isinstance(columns, str) else columns
    return df.drop(*names)


def order_columns(df: DataFrame, front: list[str]) -> DataFrame:
    """The front columns, the sample columns by kind, then all others."""
    samples = [c for p in ("GT_", "GQ_", "AD_", "DP_") for c in columns_like(df, p)]
    head = list(dict.fromkeys(c for c in [*front, *samples] if c in df.columns))
    return df.select(*head, *(c for c in df.columns if c not in head))


def order_clinical_columns(df: DataFrame, front: list[str], evidence: list[str]) -> DataFrame:
    """Front block, the rest, evidence block, sample columns."""
    head = [c for c in front if c in df.columns]
    tail = [c for c in evidence if c in df.columns and c not in head]
    rest = [c for c in df.columns if c not in head and c not in tail]
    middle = [c for c in rest if not c.startswith(SAMPLE_PREFIXES)]
    return df.select(*head, *middle, *tail, *(c for c in rest if c not in middle))


def filter_variant_quality(df: DataFrame, least: float = 20, column: str = "QUAL") -> DataFrame:
    """Rows of at least that quality; unknown goes."""
    return df.where(F.col(column) >= least)


def filter_genotype_quality(df: DataFrame, least: float = 30, tag: bool = True) -> DataFrame:
    """Rows with a sample of at least that GQ; genotypes below it are tagged."""
    gq = columns_like(df, "GQ_")
    kept = df.where(F.exists(F.array(*gq), lambda x: true(x >= least)))
    return tag_low_gq(kept, least) if tag else kept


def tag_low_gq(df: DataFrame, least: float = 10) -> DataFrame:
    """_LOWQUAL after genotypes whose GQ is below least."""
    pairs = {f"GT_{c[3:]}": c for c in columns_like(df, "GQ_") if f"GT_{c[3:]}" in df.columns}
    return df.withColumns({gt: F.when(F.col(gq) < least, F.concat(gt, F.lit("_LOWQUAL"))).otherwise(F.col(gt)) for gt, gq in pairs.items()})


def select_samples(df: DataFrame, samples: list[str]) -> DataFrame:
    """Rows in which not all chosen genotypes are one and the same kind of nothing (0/0, ., empty, null, MISSING, HOMREF)."""
    gt = [c for c in samples if c in columns_like(df, "GT_")]
    if not gt:
        return df
    for nothing in ("0/0", ".", "", "MISSING", "HOMREF"):
        df = df.where(~F.forall(F.array(*gt), lambda x: true(x == nothing)))
    return df.where(F.exists(F.array(*gt), lambda x: x.isNotNull()))


def filter_phenotype(df: DataFrame, affected: list[str]) -> DataFrame:
    """Rows in which every affected sample carries the variant."""
    return df.where(F.forall(F.array(*(F.col(f"GT_{s}") for s in affected)), lambda x: true(x.isin(*CALLED)))) if affected else df


def filter_gene_priority(df: DataFrame, priorities: list[str]) -> DataFrame:
    return df.where(F.col("gene_priority").isin(*priorities)) if priorities else df


def sequence_resolved_only(df: DataFrame) -> DataFrame:
    """Rows whose alleles are spelled out."""
    return df.where(F.col("REF").rlike("^[ACGTNacgtn]+$") & F.col("ALT").rlike("^[ACGTNacgtn]+$"))


def long_allele(least: int = 1000) -> Column:
    return (F.length("REF") >= least) | (F.length("ALT") >= least)


def has_alt_carrier(df: DataFrame) -> DataFrame:
    """Rows with a non-reference allele in some sample."""
    return df.where(F.exists(F.array(*columns_like(df, "GT_")), lambda x: true(x.rlike("[1-9]"))))


def text_findings(df: DataFrame, columns: list[str], patterns: list[str], examples: int = 3) -> DataFrame:
    """For each column and literal pattern found in it: rows, and the first few distinct values."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    long = df.select(cells.alias("cell")).select("cell.*").withColumn("pattern", F.explode(F.array(*map(F.lit, patterns))))
    hits = long.where(F.contains("value", "pattern")).groupBy("column", "pattern", "value").agg(F.count("*").alias("n"))
    from pyspark.sql import Window as W

    # only the least few values of a pattern reach one task: a limit on the rank is applied before the shuffle, too
    least = hits.withColumn("nth", F.row_number().over(W.partitionBy("column", "pattern").orderBy("value"))).where(F.col("nth") <= examples)
    texts = least.groupBy("column", "pattern").agg(F.array_join(F.array_sort(F.collect_list("value")), "; ").alias("examples"))
    return hits.groupBy("column", "pattern").agg(F.sum("n").alias("n_rows")).join(texts, ["column", "pattern"])


def qc_status(df: DataFrame) -> DataFrame:
    """QC_STATUS and QC_DETAIL from FILTER, QUAL, QD, FS and MQ: UNSCORED without any, LOW_QUAL with reasons, or PASS."""
    cells = {c: (F.col(c) if c in df.columns else F.lit(None)) for c in ("QUAL", "FILTER", "QD", "FS", "MQ")}
    missing = ("", ".", "nan", "None")
    cells |= {f"known_{c}": cells[c] if exact_number(df, c) else known(cells[c], missing) for c in cells}
    filter_ = cells["known_FILTER"].cast("string")
    reasons = [F.when(~F.upper(filter_).isin("PASS"), F.concat(F.lit("FILTER="), filter_))]
    for name, below, limit, text in (("QUAL", True, 30, "<30"), ("QD", True, 2, "<2.0"), ("FS", False, 60, ">60"), ("MQ", True, 40, "<40")):
        value = cells[f"known_{name}"].try_cast("double")
        reasons.append(F.when(value < limit if below else value > limit, F.concat(F.lit(f"{name}="), fixed_text(value, 1), F.lit(text))))
    detail = F.concat_ws("; ", *reasons)
    scored = reduce(lambda a, b: a | b, (cells[f"known_{c}"].isNotNull() for c in ("QUAL", "FILTER", "QD", "FS", "MQ")))
    return df.withColumns({
        "QC_STATUS": F.when(~scored, "UNSCORED").when(detail != "", "LOW_QUAL").otherwise("PASS"),
        "QC_DETAIL": F.when(~scored, "No raw caller quality metrics present in VCF").when(detail != "", detail).otherwise("Passed all available caller quality metrics"),
    })


def clean_text_cells(cell: Column) -> Column:
    """Text that an INFO value may hold."""
    return F.regexp_replace(cell.cast("string"), "[\\s;=]", "_")
