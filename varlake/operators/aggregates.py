"""Counts, profiles, windows and orders over variant tables and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The order of contigs.
CONTIGS = [*map(str, range(1, 23)), "X", "Y", "MT"]


def funnel(df: DataFrame, steps: dict[str, Column], distinct: str = "Locus") -> DataFrame:
    """Rows and distinct values that pass each condition, in one pass: step, n_rows, n_loci. Each value is grouped once, with its
    counts of all steps: distinct counts would make a row for each step."""
    names = list(steps)
    by = df.groupBy(distinct).agg(*(F.count_if(steps[n]).alias(f"r{i}") for i, n in enumerate(names)))
    loci = {i: F.count_if((F.col(f"r{i}") > 0) & F.col(distinct).isNotNull()).alias(f"l{i}") for i in range(len(names))}
    one = by.agg(*(x for i in range(len(names)) for x in (F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}"), loci[i])))
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("step"), F.col(f"r{i}").alias("n_rows"), F.col(f"l{i}").alias("n_loci")) for i, n in enumerate(names))))
    return one.select(rows.alias("x")).select("x.*")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, n for each column."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(cells.alias("c")).groupBy("c.column", "c.value").agg(F.count("*").alias("n"))


def availability(df: DataFrame, tools: dict[str, list[str]]) -> DataFrame:
    """For each tool the first candidate column that the table has, rows with a value and their share."""
    lower = {c.lower(): c for c in df.columns}
    found = {t: next((lower[c.lower()] for c in cs if c.lower() in lower), None) for t, cs in tools.items()}
    one = df.agg(F.count("*").alias("n"), *(F.count(c).alias(f"c{i}") for i, c in enumerate(found.values()) if c))
    rows = [F.struct(F.lit(t).alias("tool"), F.lit(c or "None").alias("column"), (F.col(f"c{i}") if c else F.lit(0).cast("long")).alias("n_values"), F.round((F.col(f"c{i}") if c else F.lit(0)) * 100.0 / F.greatest(F.lit(1), F.col("n")), 1).alias("percent")) for i, (t, c) in enumerate(found.items())]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def dedupe_merge(df: DataFrame, key: list[str], texts: list[str], most: list[str], first: list[str], order: list[str]) -> DataFrame:
    """One row a key: sorted distinct texts joined by ;, largest counts, and of the rest the value of the row that comes first. Rows with a null in the key stay as they are."""
    whole = " AND ".join(f"{k} IS NOT NULL" for k in key)
    merged = df.where(whole).groupBy(*key).agg(*(F.array_join(F.array_sort(F.collect_set(c)), ";").alias(c) for c in texts), *(F.max(c).alias(c) for c in most), *(F.min_by(c, F.struct(*order)).alias(c) for c in first))
    return merged.unionByName(df.where(f"NOT ({whole})").select(*merged.columns))


def cache_conflicts(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys with several rows: how many, and whether their values disagree."""
    return df.groupBy(*key).agg(F.count("*").alias("n"), (F.count_distinct(F.coalesce(F.col(value).cast("string"), F.lit("null"))) > 1).alias("conflict")).where("n > 1")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest value: bin (from 1), n."""
    edges = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))  # one row
    place = F.least(F.lit(bins), F.floor((F.col(column) - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))) + 1)
    return df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(edges)).groupBy(F.coalesce(place, F.lit(1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def process_stats(tasks: DataFrame) -> DataFrame:
    """Per process: outcomes, hours (total, median, largest), peak memory, hosts. Needs ms and bytes."""
    hours = F.col("ms") / 3_600_000
    return tasks.groupBy("process").agg(F.count_if(F.col("status") == "COMPLETED").alias("ok"), F.count_if(F.col("status") == "CACHED").alias("cached"), F.count_if(F.col("status") == "FAILED").alias("failed"), F.round(F.sum(hours), 4).alias("total_h"), F.round(F.median(hours), 4).alias("median_h"), F.round(F.max(hours), 4).alias("max_h"), F.max("bytes").alias("peak_bytes"), F.array_join(F.array_sort(F.collect_set("hostname")), ",").alias("hosts"))


def top_n(df: DataFrame, group: str, by: str, n: int, ties: list[str]) -> DataFrame:
    return df.withColumn("nth", F.row_number().over(W.partitionBy(group).orderBy(F.desc(by), *ties))).where(F.col("nth") <= n)


def running_number(df: DataFrame, group: list[str], order: list[str], name: str = "attempt") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))


def contig_rank(chrom: Column) -> Column:
    bare = F.regexp_replace(chrom, "^chr", "")
    place = F.array_position(F.array(*map(F.lit, CONTIGS)), F.when(bare == "M", "MT").otherwise(bare))
    return F.when(place > 0, place).otherwise(len(CONTIGS) + 1).cast("int")


def reference_row(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """One row for each group: the first in order."""
    return df.withColumn("nth", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where("nth = 1").drop("nth")


def seeded_sample(df: DataFrame, key: list[str], n: int, seed: int) -> DataFrame:
    """n distinct keys, the same for the same seed."""
    return df.select(*key).distinct().orderBy(F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in key), F.lit(str(seed)))), *key).limit(n)


def list_alignment(df: DataFrame, key: str, columns: list[str], sep: str = "&", least: int = 20, share: float = 0.95) -> DataFrame:
    """For each list column: rows with several items, the share that has as many as the key list, and its class."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.size(F.split(F.col(c), sep)).alias("items"), F.size(F.split(F.col(key), sep)).alias("keys")) for c in columns)))
    long = df.where(F.col(key).isNotNull()).select(cells.alias("c")).select("c.*").where("items > 0")
    out = long.groupBy("column").agg(F.count_if(F.col("items") > 1).alias("multi"), F.count_if((F.col("items") > 1) & (F.col("items") == F.col("keys"))).alias("same"))
    return out.withColumn("class", F.when(F.col("multi") == 0, "single").when(F.col("multi") < least, "too_few").when(F.col("same") >= share * F.col("multi"), "aligned").otherwise("unaligned"))


def list_tokens(df: DataFrame, column: str, sep: str = "&") -> DataFrame:
    return df.select(F.explode(F.split(column, sep)).alias("token")).where("token NOT IN ('', '.')").distinct()


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null values, distinct values and bytes as text of each column."""
    one = df.agg(*(x for c in columns for x in (F.count(c).alias(f"n_{c}"), F.count_distinct(c).alias(f"d_{c}"), F.sum(F.octet_length(F.col(c).cast("string"))).alias(f"b_{c}"))))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.col(f"d_{c}").alias("n_distinct"), F.col(f"b_{c}").alias("bytes")) for c in columns))).alias("x")).select("x.*")


def reparse_diff(df: DataFrame, old: str, new: str, threshold: float) -> DataFrame:
    """Values gained, lost and changed between two columns, and flips across a threshold."""
    a, b = F.col(old), F.col(new)
    flip = F.coalesce(a >= threshold, F.lit(False)) != F.coalesce(b >= threshold, F.lit(False))
    return df.agg(F.count_if(a.isNull() & b.isNotNull()).alias("gained"), F.count_if(a.isNotNull() & b.isNull()).alias("lost"), F.count_if(a != b).alias("changed"), F.count_if(flip).alias("flips"))


def threshold_benchmark(df: DataFrame, scores: list[str], cuts: list[float]) -> DataFrame:
    """Rows at or above each cut, for each score and for both."""
    first, second = scores
    rows = [F.struct(F.lit(c).alias("cut"), F.count_if(F.col(first) >= c).alias("n_first"), F.count_if(F.col(second) >= c).alias("n_second"), F.count_if((F.col(first) >= c) & (F.col(second) >= c)).alias("n_both"), F.count_if((F.col(first) >= c) & ~F.coalesce(F.col(second) >= c, F.lit(False))).alias("n_novel")) for c in cuts]
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("x")).select("x.*")


def splice_region(offset: Column, consequence: Column) -> Column:
    """Six bins by distance from the exon's edge."""
    d = F.abs(offset)
    return F.when(consequence.rlike("splice_(donor|acceptor)_variant"), "canonical").when(d == 0, "exonic").when(d <= 8, "near").when(d <= 50, "proximal").when(d <= 500, "deep").otherwise("very_deep")
