"""Joins of variant tables: exact alleles, intervals, the score cache, cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ALLELE = ["CHROM", "POS", "REF", "ALT"]


def annotate_exact_allele(df: DataFrame, sites: DataFrame, values: list[str], key: list[str] = ALLELE) -> DataFrame:
    """Values of a site table (one row a key) at the row's exact allele; null where it has none."""
    return df.join(sites.select(*key, *values), key, "left")


def annotate_position(df: DataFrame, track: DataFrame, value: str) -> DataFrame:
    """Value of a per-position track (CHROM, POS, value) for single-base changes."""
    snv = (F.length("REF") == 1) & (F.length("ALT") == 1)
    return df.join(track.select("CHROM", "POS", value), ["CHROM", "POS"], "left").withColumn(value, F.when(snv, F.col(value)))


def merge_predictors(base: DataFrame, others: list[tuple[DataFrame, list[str]]], key: list[str] = ALLELE) -> DataFrame:
    """Columns of several tables of one record set transferred to the base in turn."""
    for other, values in others:
        base = annotate_exact_allele(base, other, values, key)
    return base


#: Each level of bins is so many times as wide as the one below.
WIDER = 8


def _level(start: Column, end: Column, bin_size: int) -> Column:
    """The first level whose bins are at least as long as the interval, which then touches two of them at most."""
    return F.greatest(F.lit(0), F.ceil(F.log(float(WIDER), F.greatest(end - start, F.lit(1)) / bin_size))).cast("int")


def binned(df: DataFrame, other: DataFrame, span: tuple[str, str], other_span: tuple[str, str], bin_size: int, names: tuple[str, str, str] = ("__own", "__level", "__bin"), bases: bool = False) -> DataFrame:
    """df with a row for each bin in which its half-open intervals meet those of other: own level, level and number of the bin. These are the bins
    of the interval's own level and of the wider levels that other has, two of each: rows grow with the logarithm of a length. bases: other's
    are no longer than the narrowest bins, so that it need not be looked at."""
    own, level, place = names
    there = F.array(F.lit(0)) if bases else other.select(F.collect_set(_level(F.col(other_span[0]), F.col(other_span[1]), bin_size))).scalar()  # a few numbers
    start, end = F.col(span[0]), F.greatest(F.col(span[1]) - 1, F.col(span[0]))
    rows = df.withColumn(own, _level(F.col(span[0]), F.col(span[1]), bin_size))
    rows = rows.withColumn(level, F.explode(F.array_union(F.array(own), there))).where(F.col(level) >= F.col(own))
    size = F.lit(bin_size) * F.pow(F.lit(float(WIDER)), level).cast("long")
    return rows.withColumn(place, F.explode(F.sequence(F.floor(start / size), F.floor(end / size))))


def interval_join(left: DataFrame, right: DataFrame, bin_size: int, on: tuple[str, str] = ("chrom", "chrom"), left_span: tuple[str, str] = ("start", "end"), right_span: tuple[str, str] = ("start", "end"), how: str = "inner", bases: bool = False) -> DataFrame:
    """Rows whose half-open intervals overlap on the same contig, by bins: an equi-join instead of a nested loop. how: inner, or left_semi (left rows as
    they are). Two intervals meet on the level of the longer one, in the bin of the overlap's first base. bin_size is that of the narrowest bins; results
    do not depend on it. Rows with a null in contig or span overlap nothing. bases: no left interval is longer than bin_size."""
    ls, le, rs, re_ = F.col(f"l.{left_span[0]}"), F.col(f"l.{left_span[1]}"), F.col(f"r.{right_span[0]}"), F.col(f"r.{right_span[1]}")
    if how == "left_semi":
        # the span decides: those that meet any are found first
        places = [on[0], *left_span]
        bare = right.select(F.col(on[1]).alias("__on"), F.col(right_span[0]).alias("__from"), F.col(right_span[1]).alias("__to"))
        met = interval_join(left.select(*places), bare, bin_size, (on[0], "__on"), left_span, ("__from", "__to"))
        return left.join(met.select(*places).distinct(), places, "left_semi")
    a = binned(left, right, left_span, right_span, bin_size, ("__lown", "__llevel", "__lbin")).alias("l")
    b = binned(right, left, right_span, left_span, bin_size, ("__rown", "__rlevel", "__rbin"), bases).alias("r")
    size = F.lit(bin_size) * F.pow(F.lit(float(WIDER)), F.col("l.__llevel")).cast("long")
    test = (F.col(f"l.{on[0]}") == F.col(f"r.{on[1]}")) & (F.col("l.__llevel") == F.col("r.__rlevel")) & (F.col("l.__lbin") == F.col("r.__rbin")) & (ls < re_) & (rs < le)
    test = test & (F.col("l.__llevel") == F.greatest("l.__lown", "r.__rown")) & (F.floor(F.greatest(ls, rs) / size) == F.col("l.__lbin"))
    return a.join(b, test).drop("__lown", "__llevel", "__lbin", "__rown", "__rlevel", "__rbin")


def region_restrict(df: DataFrame, regions: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Variants in any region (chrom, start_pos, end_pos; 0-based half-open), each row once. The levels of the regions are looked at first (a few
    numbers): with one level a variant has one bin, and one semi-join does; with several the places that meet a region are found before the rows."""
    bare = regions.select(F.col("chrom").alias("__chrom"), F.col("start_pos").alias("__low"), F.col("end_pos").alias("__high"))
    levels = [r.level for r in bare.select(_level(F.col("__low"), F.col("__high"), bin_size).alias("level")).distinct().collect()]
    if len(levels) <= 1:
        size = bin_size * WIDER ** (levels[0] if levels else 0)
        bins = bare.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("__low") / size), F.floor(F.greatest(F.col("__high") - 1, F.col("__low")) / size))))
        place = F.col("POS") - 1
        return df.join(bins, (F.col("CHROM") == F.col("__chrom")) & (F.floor(place / size) == F.col("__bin")) & (place >= F.col("__low")) & (place < F.col("__high")), "left_semi")
    spans = df.select("CHROM", "POS", (F.col("POS") - 1).alias("__from"), F.col("POS").alias("__to"))
    met = interval_join(spans, bare, bin_size, ("CHROM", "__chrom"), ("__from", "__to"), ("__low", "__high"), bases=True)
    return df.join(met.select("CHROM", "POS").distinct(), ["CHROM", "POS"], "left_semi")


def best_overlap(genes: DataFrame, exons: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """For each symbol of genes (symbol, chrom, strand, start, end; inclusive) the gene of exons (ensg, same) that shares most bases, and the runner-up."""
    a = genes.withColumn("stop", F.col("end") + 1)
    b = exons.select("ensg", F.col("chrom").alias("chrom2"), F.col("strand").alias("strand2"), F.col("start").alias("start2"), F.col("end").alias("end2"), (F.col("end") + 1).alias("stop2"))
    pairs = interval_join(a, b, bin_size, ("chrom", "chrom2"), ("start", "stop"), ("start2", "stop2")).where("strand = strand2")
    shared = pairs.groupBy("symbol", "ensg").agg(F.sum(F.least("end", "end2") - F.greatest("start", "start2") + 1).alias("bp"))
    ranked = shared.withColumn("nth", F.row_number().over(W.partitionBy("symbol").orderBy(F.desc("bp"), "ensg"))).where("nth <= 2")
    pick = {f"{p}{c}": F.max(F.when(F.col("nth") == n, F.col(c))) for n, p in ((1, ""), (2, "runner_up_")) for c in ("ensg", "bp")}
    return ranked.groupBy("symbol").agg(*(v.alias(k) for k, v in pick.items()))


def nearby_branchpoint(df: DataFrame, points: DataFrame, bin_size: int = 1000) -> DataFrame:
    """Of branchpoints (chrom, start, end, score, strand) that hold the variant or lie 18 to 44 bases on along the strand, the best score."""
    a = df.withColumns({"__s": F.col("POS") - 45, "__e": F.col("POS") + 45})
    b = points.select(F.col("chrom").alias("__chrom"), F.col("start").alias("__start"), F.col("end").alias("__end"), "score", "strand")
    pairs = interval_join(a, b, bin_size, ("CHROM", "__chrom"), ("__s", "__e"), ("__start", "__end"))
    distance = F.when(F.col("strand") == "-", F.col("POS") - F.col("__end")).otherwise(F.col("__start") - F.col("POS"))
    inside = (F.col("__start") < F.col("POS")) & (F.col("POS") <= F.col("__end"))
    return pairs.withColumn("distance", distance).where(inside | F.col("distance").between(18, 44))


def transcript_key(exons: Column) -> Column:
    """The intron chain of an exon array (start, end), or the bounds of a single exon: equal keys, equal structure."""
    sorted_ = F.array_sort(exons)
    inner = F.transform(F.slice(sorted_, 2, F.size(sorted_)), lambda e, i: F.concat_ws("-", F.element_at(sorted_, i + 1)["end"].cast("string"), e["start"].cast("string")))
    bounds = F.concat_ws("-", sorted_[0]["start"].cast("string"), sorted_[0]["end"].cast("string"))
    return F.when(F.size(sorted_) == 1, bounds).otherwise(F.array_join(inner, ","))


def structural_classes(transcripts: DataFrame, key: list[str], id_: str) -> DataFrame:
    """Every transcript with first and n: the smallest id_ and the number of transcripts of equal key. One row stands for all
    pairs that a transcript is in; the classes are aggregated before their shuffle."""
    return transcripts.join(transcripts.groupBy(*key).agg(F.min(id_).alias("first"), F.count("*").alias("n")), key)


def cache_split(df: DataFrame, cache: DataFrame, key: list[str] = ALLELE) -> DataFrame:
    """Rows with score and hit: a cached site without a score is a hit, too. The cache has one row a key."""
    return df.join(cache.select(*key, "score", F.lit(True).alias("__hit")), key, "left").withColumn("hit", F.coalesce("__hit", F.lit(False))).drop("__hit")


def cache_lookup(segments: DataFrame, key: list[str] = ALLELE) -> DataFrame:
    """One row a key over all segments: the first segment's."""
    return segments.groupBy(*key).agg(F.min(F.struct("segment", "score")).alias("first")).select(*key, "first.segment", "first.score")


def cache_make_segment(computed: DataFrame, misses: DataFrame, key: list[str] = ALLELE) -> DataFrame:
    return computed.join(misses.select(*key), key, "left_semi")


def cache_seed(computed: DataFrame, cache: DataFrame, key: list[str] = ALLELE) -> DataFrame:
    """New sites for the cache. A shared site with another value is an error and nothing is added."""
    # local: sources come after operators
    from varlake.sources.tables import scratch

    # one join tells both; what is new, or differs, is written, so that computed is worked out once
    both = computed.join(cache.select(*key, F.col("score").alias("__old"), F.lit(True).alias("__held")), key, "left")
    path = scratch(computed.sparkSession)
    both.where(F.col("__held").isNull() | ~F.col("score").eqNullSafe(F.col("__old"))).drop("__old").write.parquet(path)
    found = computed.sparkSession.read.parquet(path)
    if not found.where("__held").isEmpty():
        raise ValueError("the cache holds other values for shared sites")
    return found.select(*computed.columns)


def cache_migrate(source: DataFrame, target: DataFrame, key: list[str] = ALLELE) -> DataFrame:
    """Scored sites of a version that the target lacks."""
    return source.where("score IS NOT NULL").join(target.select(*key), key, "left_anti")


def cohort_outer_join(cases: DataFrame, controls: DataFrame, key: list[str], shared: list[str]) -> DataFrame:
    """Both tables on the key: SOURCE_ORIGIN says which side has it, shared columns are taken from the cases first. Rows with a null
    in the key are kept apart, each by itself."""
    whole = " AND ".join(f"{k} IS NOT NULL" for k in key)
    a = cases.where(whole).withColumn("__a", F.lit(True))
    b = controls.where(whole).select(*key, *(F.col(c).alias(f"__{c}") for c in shared), F.lit(True).alias("__b"))
    both = a.join(b, key, "full_outer")
    origin = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "left").otherwise("right")
    out = both.select(*key, *(F.coalesce(c, f"__{c}").alias(c) for c in shared), origin.alias("SOURCE_ORIGIN"))
    for side, name in ((cases, "left"), (controls, "right")):
        out = out.unionByName(side.where(f"NOT ({whole})").select(*key, *shared, F.lit(name).alias("SOURCE_ORIGIN")))
    return out


def compare_runs(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows only in one table, and for each column rows that differ: one row of counts a measure."""
    a = old.select(*key, *(F.col(c).alias(f"a_{c}") for c in columns), F.lit(1).alias("__a"))
    b = new.select(*key, *(F.col(c).alias(f"b_{c}") for c in columns), F.lit(1).alias("__b"))
    both, in_both = a.join(b, key, "full_outer"), F.col("__a").isNotNull() & F.col("__b").isNotNull()
    sums = {"only_old": F.col("__b").isNull(), "only_new": F.col("__a").isNull()} | {f"differs_{c}": in_both & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in columns}
    one = both.agg(*(F.count_if(v).alias(k) for k, v in sums.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), F.col(k).alias("n")) for k in sums))).alias("x")).select("x.*")


def site_parity(a: DataFrame, b: DataFrame, key: list[str] = ALLELE) -> DataFrame:
    """Rows of each multiset that the other lacks: no rows, if they are equal. One shuffle, counted by key."""
    rows = a.select(*key, F.lit(1).alias("n")).union(b.select(*key, F.lit(-1).alias("n")))
    return rows.groupBy(*key).agg(F.sum("n").alias("surplus")).where("surplus <> 0")


def family_union(first: DataFrame, second: DataFrame, key: list[str], first_samples: list[str], second_samples: list[str]) -> DataFrame:
    """Two sample sets on exact alleles: the second is limited to rows with a carrier or sites of the first, one row a key; FILTER of each is kept; a missing source is ./."""
    carrier = F.exists(F.array(*(F.col(s) for s in second_samples)), lambda g: F.coalesce(g.rlike("[1-9]"), F.lit(False)))
    sites = first.select(*key).distinct().withColumn("__in", F.lit(True))
    b = second.join(sites, key, "left").where(carrier | F.col("__in")).drop("__in")
    a, b = (t.groupBy(*key).agg(F.min(F.struct("FILTER", *s)).alias("r")).select(*key, F.col("r.FILTER").alias(f), *(F.col(f"r.{c}").alias(c) for c in s)) for t, s, f in ((first, first_samples, "FILTER_1"), (b, second_samples, "FILTER_2")))
    return a.join(b, key, "full_outer").select(*key, "FILTER_1", "FILTER_2", *(F.coalesce(c, F.lit("./.")).alias(c) for c in [*first_samples, *second_samples]))
