"""Small reports and key operations over variant tables, run logs and mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varlake.functions.values import strip_version


def anonymous_rank(df: DataFrame, name: str) -> DataFrame:
    """Rows of each name under a running number instead of the name: sample_no, n. Only the names, pre-counted, are ordered."""
    counts = df.groupBy(name).agg(F.count("*").alias("n"))
    return counts.select(F.dense_rank().over(W.orderBy(name)).alias("sample_no"), "n")


def flag_repeated(df: DataFrame, key: list[str], flag: str = "repeated") -> DataFrame:
    """All rows, with whether another has the same key."""
    return df.withColumn(flag, F.count("*").over(W.partitionBy(*key)) > 1)


def top_novel(df: DataFrame, other: Column, order: list[Column | str], n: int) -> DataFrame:
    """The n first rows of those that other does not hold for (unknown: does not)."""
    return df.where(~F.coalesce(other, F.lit(False))).orderBy(*order).limit(n)


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts of row by the values of column given; a pair that is not there is 0."""
    return df.groupBy(row).pivot(column, values).count().na.fill(0)


def profile(df: DataFrame, group: str, measure: str, share: str) -> DataFrame:
    """For each group: n, mean and median of measure, least and largest share and the percentage without one."""
    name = measure.lower()
    return df.groupBy(group).agg(
        F.count("*").alias("n"), F.round(F.avg(measure), 4).alias(f"mean_{name}"), F.median(measure).alias(f"median_{name}"), F.min(share).alias("low"), F.max(share).alias("high"),
        F.round(F.count_if(F.col(share).isNull()) * 100.0 / F.count("*"), 2).alias("missing"),
    )


def run_summary(tasks: DataFrame, by: str) -> DataFrame:
    """Attempts, failures and hours of tasks (status, ms)."""
    return tasks.groupBy(by).agg(F.count("*").alias("attempts"), F.count_if(F.col("status") == "FAILED").alias("failed"), F.round(F.sum("ms") / 3_600_000, 3).alias("task_hours"))


def failed_attempts(tasks: DataFrame) -> DataFrame:
    return tasks.where("status = 'FAILED'")


def outcome_stats(tasks: DataFrame, by: str, outcomes: tuple[str, ...] = ("COMPLETED", "FAILED")) -> DataFrame:
    """Tasks of each outcome, and the median duration."""
    return tasks.groupBy(by).agg(*(F.count_if(F.col("status") == o).alias(o) for o in outcomes), F.median("ms").alias("median_ms"))


def schema_consistency(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns that not all tables have, with the number that do."""
    spark = next(iter(tables.values())).sparkSession
    rows = spark.createDataFrame([(t, c) for t, df in tables.items() for c in df.columns], "t string, name string")
    return rows.groupBy("name").agg(F.count("*").alias("n_tables")).where(F.col("n_tables") < len(tables))


def completeness(df: DataFrame, key: str) -> DataFrame:
    """One row: different keys (n_loci), rows, repeats, and whether they match."""
    one = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.count(key).alias("n_loci"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    return one.select("n_loci", "n_rows", (F.col("n_rows") - F.col("n_loci")).alias("repeats"), F.when(F.col("n_rows") == F.col("n_loci"), "match").otherwise("mismatch").alias("state"))


def intersect_keys(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    return df.join(other.select(*key), key, "left_semi")


def except_keys(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    return df.join(other.select(*key), key, "left_anti")


def with_any_name(df: DataFrame, keys: list[Column], names: DataFrame) -> DataFrame:
    """Rows of which any key (upper-cased) is a name of names (name): an equi-join for each key, none over OR."""
    upper, out = names.select(F.upper("name").alias("name")).distinct(), df
    for i, key in enumerate(keys):
        out = out.withColumn(f"__k{i}", F.upper(key)).join(upper.select(F.col("name").alias(f"__k{i}"), F.lit(True).alias(f"__in{i}")), f"__k{i}", "left")
    return out.where(F.coalesce(*(F.col(f"__in{i}") for i in range(len(keys))), F.lit(False))).select(*df.columns)


def classify_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """pairs (symbol, ensg) by what is known of the symbol (symbol, known): unresolved, alias (the same gene) or neighbour."""
    cls = F.when(F.col("known").isNull(), "unresolved").when(F.col("ensg") == F.col("known"), "alias").otherwise("neighbour")
    return pairs.join(known, "symbol", "left").withColumn("cls", cls).drop("known")


def symbol_is_row_gene(df: DataFrame, edges: DataFrame) -> DataFrame:
    """Whether a row's predictor symbol names its own gene: it is the row's symbol (own), or an edge (symbol, gene) says so."""
    found = edges.select("symbol", "gene").distinct().withColumn("__edge", F.lit(True))
    return df.join(found, ["symbol", "gene"], "left").withColumn("is_row_gene", (F.col("symbol") == F.col("own")) | F.coalesce("__edge", F.lit(False))).drop("__edge")


def mapped_or(df: DataFrame, lookup: DataFrame, key: str, value: str, fallback: Column, out: str, flag: str) -> DataFrame:
    """Coordinates from a table (key, value), else the fallback; flag says whether the table had them. A key's least value counts."""
    known = lookup.groupBy(key).agg(F.min(value).alias("__value"))
    return df.join(known, key, "left").withColumns({out: F.coalesce("__value", fallback), flag: F.col("__value").isNotNull()}).drop("__value")


def unmapped(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows without a key, of all parts, with the part's name as side."""
    out = None
    for side, df in parts.items():
        rows = df.where(F.col(key).isNull()).withColumn("side", F.lit(side))
        out = rows if out is None else out.unionByName(rows)
    return out


def map_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """External ids (with or without a version) to what ids (id, ...) has for them."""
    return df.withColumn("id", strip_version(F.col(column))).join(ids, "id", "left")


def listed_only(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a list."""
    return df.join(listed.select(key), key, "left_semi")


def row_parity(counts: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """stage, n and DONE or INCOMPLETE against the rows of expected."""
    out = None
    for stage, df in {**counts, "": expected}.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(stage).alias("stage"), "n")
        out = one if out is None else out.union(one)
    # a row for each stage
    want = F.max(F.when(F.col("stage") == "", F.col("n"))).over(W.partitionBy(F.lit(1)))
    return out.select("stage", "n", F.when(F.col("n") == want, "DONE").otherwise("INCOMPLETE").alias("state")).where("stage <> ''")


def bed_lines(df: DataFrame, names: Column, start: str, end: str, pad: int = 0) -> DataFrame:
    """Distinct BED lines (value) of intervals under each of their contig names, padded and sorted."""
    rows = df.select(F.explode(names).alias("c"), F.greatest(F.col(start) - pad, F.lit(0)).alias("s"), (F.col(end) + pad).alias("e")).distinct()
    return rows.orderBy("c", "s", "e").select(F.concat_ws("\t", "c", F.col("s").cast("string"), F.col("e").cast("string")).alias("value"))


def mapping_agreement(df: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (symbol, o) by whether the edges (o, symbol) of o hold the row's symbol: none, same or different, with counts."""
    known = edges.groupBy("o").agg(F.collect_set("symbol").alias("__g"))
    return df.join(known, "o", "left").groupBy(F.when(F.col("__g").isNull(), "none").when(F.array_contains("__g", F.col("symbol")), "same").otherwise("different").alias("class")).agg(F.count("*").alias("n"))


def mapping_audit(edges: DataFrame, source: str, target: str, odd: Column, issue: str) -> DataFrame:
    """Every edge with the number of its source's edges and its issues: repeated, and issue where odd holds."""
    several = F.count("*").over(W.partitionBy(source, target)) > 1
    return edges.select(source, target, F.count("*").over(W.partitionBy(source)).alias("n_edges"), F.concat_ws("; ", F.when(several, "repeated"), F.when(odd, issue)).alias("issues"))


def attribution_audit(df: DataFrame, raw: str = "SpliceAI", own: str = "SYMBOL") -> DataFrame:
    """One row: packed values of several entries, and first entries of the row's own gene and of another."""
    first = F.split(F.split(raw, "&")[0], "\\|")[1]
    return df.agg(F.count_if(F.size(F.split(raw, "&")) > 1).alias("multi_entry"), F.count_if(first == F.col(own)).alias("own_entry"), F.count_if(first != F.col(own)).alias("other_entry"))


def gene_counts(regions: DataFrame) -> DataFrame:
    """By contig: regions on the plus strand, all regions, and genes."""
    return regions.groupBy("chrom").agg(F.count_if(F.col("strand") == "+").alias("plus"), F.count("*").alias("n"), F.count_distinct("gene").alias("genes"))


def best_effect(df: DataFrame, effects: DataFrame, key: list[str], value: str) -> DataFrame:
    """The least value of each allele's effects, and how many there are; alleles without one are left out."""
    worst = effects.where(F.col(value).isNotNull()).groupBy(*key).agg(F.min(value).alias("d_best"), F.count("*").alias("n"))
    return df.join(worst, key)
