"""Queries of counts, profiles, windows and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.operators import reports as P
from varlake.operators import aggregates as G
from varlake.operators import family, ordered
from varlake.operators.rows import build_locus
from varlake.plans.registry import KEY, query
from varlake.plans.views import table

_STATUS = "CASE gt_raw WHEN '0/0' THEN 'hom_ref' WHEN '0/1' THEN 'het' WHEN '1/1' THEN 'hom_alt' WHEN './.' THEN 'no_call' WHEN './1' THEN 'partial_no_call' WHEN '1|0' THEN 'het' WHEN '1/0' THEN 'alt_plus_other_allele' WHEN '1' THEN 'haploid_alt' END"
_RARE, _HM, _SPL, _TIER = "(AF_grpmax IS NULL OR AF_grpmax <= 0.0005)", "IMPACT IN ('HIGH', 'MODERATE')", "splice_score >= 0.4", "(MANE_SELECT IS NOT NULL)"
_CAND = f"({_RARE} AND ({_HM} OR {_SPL}))"
_STEPS = {"all rows": "TRUE", "tier <= 2": _TIER, "rare": _RARE, "rare and impact": f"{_RARE} AND {_HM}", "rare and splice": f"{_RARE} AND {_SPL}", "candidate": _CAND, "candidate, tier <= 2": f"{_CAND} AND {_TIER}"}
_V = "SELECT *, CHROM || ':' || CAST(POS AS STRING) || '-' || REF || '-' || ALT AS Locus FROM {v_variants}"


@query("candidate_funnel", " UNION ALL ".join(f"SELECT '{k}' AS step, count(*) AS n_rows, count(DISTINCT Locus) AS n_loci FROM ({_V}) v WHERE {c}" for k, c in _STEPS.items()))
def _(spark, d):
    return G.funnel(build_locus(table(spark, d, "v_variants")), {k: F.expr(c) for k, c in _STEPS.items()})


@query("row_funnel", f"SELECT 'all' AS step, count(*) AS n_rows, count(DISTINCT Locus) AS n_loci FROM ({_V}) v UNION ALL SELECT 'tier', count(*), count(DISTINCT Locus) FROM ({_V}) v WHERE {_TIER} UNION ALL SELECT 'rare', count(*), count(DISTINCT Locus) FROM ({_V}) v WHERE {_TIER} AND {_RARE}")
def _(spark, d):
    return G.funnel(build_locus(table(spark, d, "v_variants")), {"all": F.lit(True), "tier": F.expr(_TIER), "rare": F.expr(f"{_TIER} AND {_RARE}")})


def _sets(spark, d):
    """Carriers of each locus, and the names of the samples."""
    samples = [f"S{r.r_regionkey}" for r in table(spark, d, "region").where("r_regionkey < 3").orderBy("r_regionkey").collect()]
    return family.carrier_sets(table(spark, d, "v_genotypes"), samples), samples


@query("genotype_status_counts", f"SELECT sample_id, {_STATUS} AS gt_status, count(*) AS n FROM {{v_genotypes}} GROUP BY ALL")
def _(spark, d):
    return family.status_counts(table(spark, d, "v_genotypes"), ["sample_id"])


@query("carrier_histogram", f"SELECT n AS carrier_samples, count(*) AS n_loci FROM (SELECT Locus, count(DISTINCT sample_id) AS n FROM {{v_genotypes}} WHERE {_STATUS} IN ('het', 'hom_alt', 'alt_plus_other_allele') GROUP BY Locus) t GROUP BY ALL")
def _(spark, d):
    return family.carrier_histogram(_sets(spark, d)[0])


@query("candidate_carriers", f"SELECT sample_id, count(DISTINCT Locus) AS n_loci FROM {{v_genotypes}} WHERE {_STATUS} IN ('het', 'hom_alt', 'alt_plus_other_allele') AND Locus IN (SELECT Locus FROM ({_V}) v WHERE {_CAND}) GROUP BY ALL")
def _(spark, d):
    loci = build_locus(table(spark, d, "v_variants").where(_CAND)).select("Locus")
    sets, samples = _sets(spark, d)
    return family.loci_per_sample(sets.join(loci, "Locus", "left_semi"), samples)


@query("anonymous_rank", "SELECT dense_rank() OVER (ORDER BY sample_id) AS sample_no, n FROM (SELECT sample_id, count(*) AS n FROM {v_genotypes} GROUP BY ALL) t")
def _(spark, d):
    return P.anonymous_rank(table(spark, d, "v_genotypes"), "sample_id")


@query("status_value_counts", "SELECT 'IMPACT' AS \"column\", IMPACT AS value, count(*) AS n FROM {v_variants} GROUP BY ALL UNION ALL SELECT 'Consequence', Consequence, count(*) FROM {v_variants} GROUP BY ALL")
def _(spark, d):
    return G.value_counts(table(spark, d, "v_variants"), ["IMPACT", "Consequence"])


@query("annotation_availability", "SELECT 'splice' AS tool, 'splice_score' AS \"column\", count(splice_score) AS n_values, round(count(splice_score) * 100.0 / count(*), 1) AS percent FROM {v_variants} UNION ALL SELECT 'mane', 'MANE_SELECT', count(MANE_SELECT), round(count(MANE_SELECT) * 100.0 / count(*), 1) FROM {v_variants} UNION ALL SELECT 'none', 'None', 0, 0.0")
def _(spark, d):
    return G.availability(table(spark, d, "v_variants"), {"splice": ["SpliceX", "SPLICE_SCORE"], "mane": ["MANE_SELECT"], "none": ["nope"]})


@query("schema_consistency", "SELECT name, count(*) AS n_tables FROM (SELECT column_name AS name FROM (DESCRIBE documents) UNION ALL SELECT column_name FROM (DESCRIBE labels) UNION ALL SELECT column_name FROM (DESCRIBE benchmark)) t GROUP BY name HAVING count(*) < 3")
def _(spark, d):
    return P.schema_consistency({t: table(spark, d, t) for t in ("documents", "labels", "benchmark")})


@query("table_completeness", f"SELECT count(DISTINCT Locus) AS n_loci, count(*) AS n_rows, count(*) - count(DISTINCT Locus) AS repeats, CASE WHEN count(*) = count(DISTINCT Locus) THEN 'match' ELSE 'mismatch' END AS state FROM ({_V}) v")
def _(spark, d):
    return P.completeness(build_locus(table(spark, d, "v_variants")), "Locus")


@query("cache_conflicts", "SELECT CHROM, POS, REF, ALT, count(*) AS n, count(DISTINCT coalesce(CAST(score AS STRING), 'null')) > 1 AS conflict FROM {v_cache} GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return G.cache_conflicts(table(spark, d, "v_cache"), ["CHROM", "POS", "REF", "ALT"], "score")


@query("vcf_record_scan", "SELECT count(*) AS n, count(*) FILTER (ALT = REF) AS same, count(*) FILTER (length(ALT) > 1) AS longer, count(*) - count(DISTINCT (CHROM, POS)) AS repeats FROM {v_variants}")
def _(spark, d):
    return table(spark, d, "v_variants").agg(F.count("*").alias("n"), F.count_if(F.col("ALT") == F.col("REF")).alias("same"), F.count_if(F.length("ALT") > 1).alias("longer"), (F.count("*") - F.count_distinct("CHROM", "POS")).alias("repeats"))


@query("predictor_benchmark", "SELECT c AS cut, count(*) FILTER (splice_score >= c) AS n_first, count(*) FILTER (AF_joint * 400 >= c) AS n_second, count(*) FILTER (splice_score >= c AND AF_joint * 400 >= c) AS n_both, count(*) FILTER (splice_score >= c AND NOT coalesce(AF_joint * 400 >= c, FALSE)) AS n_novel FROM {v_variants}, (SELECT unnest([0.2::DOUBLE, 0.5, 0.8]) AS c) t GROUP BY c")
def _(spark, d):
    rows = table(spark, d, "v_variants").withColumn("second", F.col("AF_joint") * 400)
    return G.threshold_benchmark(rows, ["splice_score", "second"], [0.2, 0.5, 0.8])


@query("table_profile", "SELECT IMPACT, count(*) AS n, round(avg(QUAL), 4) AS mean_qual, median(QUAL) AS median_qual, min(AF_joint) AS low, max(AF_joint) AS high, round(count(*) FILTER (AF_joint IS NULL) * 100.0 / count(*), 2) AS missing FROM {v_variants} GROUP BY ALL")
def _(spark, d):
    return P.profile(table(spark, d, "v_variants"), "IMPACT", "QUAL", "AF_joint")


@query("histogram", "SELECT CAST(least(10, floor((l_quantity - lo) * 10 / (hi - lo)) + 1) AS INT) AS bin, count(*) AS n FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) e GROUP BY ALL")
def _(spark, d):
    return G.histogram(table(spark, d, "lineitem"), "l_quantity", 10)


@query("distinct_list_tokens", "SELECT DISTINCT token FROM (SELECT unnest(string_split(CLIN_SIG, '&')) AS token FROM {v_wide}) t WHERE token NOT IN ('', '.')")
def _(spark, d):
    return G.list_tokens(table(spark, d, "v_wide"), "CLIN_SIG")


_TASKS = "SELECT *, (CAST(split_part(realtime, 'h', 1) AS BIGINT) * 3600 + CAST(split_part(split_part(realtime, ' ', 2), 'm', 1) AS BIGINT) * 60 + CAST(split_part(split_part(realtime, ' ', 3), 's', 1) AS BIGINT)) * 1000 AS ms, CAST(split_part(peak_rss, ' ', 1) AS BIGINT) * 1073741824 AS bytes FROM {v_tasks}"


def _tasks(spark, d):
    from varlake.functions.values import duration_ms, size_bytes

    return table(spark, d, "v_tasks").withColumns({"ms": duration_ms(F.col("realtime")), "bytes": size_bytes(F.col("peak_rss"))})


@query("process_stats", f"SELECT process, count(*) FILTER (status = 'COMPLETED') AS ok, count(*) FILTER (status = 'CACHED') AS cached, count(*) FILTER (status = 'FAILED') AS failed, round(sum(ms / 3600000), 4) AS total_h, round(median(ms / 3600000), 4) AS median_h, round(max(ms / 3600000), 4) AS max_h, max(bytes) AS peak_bytes, array_to_string(list_sort(list(DISTINCT hostname)), ',') AS hosts FROM ({_TASKS}) t GROUP BY process")
def _(spark, d):
    return G.process_stats(_tasks(spark, d))


@query("run_summary", f"SELECT hostname, count(*) AS attempts, count(*) FILTER (status = 'FAILED') AS failed, round(sum(ms) / 3600000, 3) AS task_hours FROM ({_TASKS}) t GROUP BY hostname")
def _(spark, d):
    return P.run_summary(_tasks(spark, d), "hostname")


@query("failed_attempts", f"SELECT name, process, ms FROM ({_TASKS}) t WHERE status = 'FAILED'")
def _(spark, d):
    return P.failed_attempts(_tasks(spark, d)).select("name", "process", "ms")


@query("node_outcome_stats", f"SELECT hostname, count(*) FILTER (status = 'COMPLETED') AS COMPLETED, count(*) FILTER (status = 'FAILED') AS FAILED, median(ms) AS median_ms FROM ({_TASKS}) t GROUP BY hostname")
def _(spark, d):
    return P.outcome_stats(_tasks(spark, d), "hostname")


@query("spearman", "SELECT l_returnflag, round(corr(ra, rb), 6) AS rho, count(*) AS n FROM (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS ra, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS rb FROM lineitem) t GROUP BY ALL")
def _(spark, d):
    return ordered.spearman(table(spark, d, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice").withColumn("rho", F.round("rho", 6))


@query("list_alignment_class", "SELECT 'REVEL_list' AS \"column\", count(*) FILTER (len(string_split(REVEL_list, '&')) > 1) AS multi, count(*) FILTER (len(string_split(REVEL_list, '&')) = 2) AS same, 'unaligned' AS class FROM {v_wide} UNION ALL SELECT 'SYMBOL', 0, 0, 'single'")
def _(spark, d):
    return G.list_alignment(table(spark, d, "v_wide"), "Ensembl_transcriptid", ["REVEL_list", "SYMBOL"])


@query("crosstab", "SELECT IMPACT, count(*) FILTER (REF = 'A') AS A, count(*) FILTER (REF = 'C') AS C, count(*) FILTER (REF = 'G') AS G, count(*) FILTER (REF = 'T') AS T FROM {v_variants} GROUP BY IMPACT")
def _(spark, d):
    return P.crosstab(table(spark, d, "v_variants"), "IMPACT", "REF", ["A", "C", "G", "T"])


@query("reparse_diff", "SELECT count(*) FILTER (AF_grpmax IS NULL AND AF_joint IS NOT NULL) AS gained, count(*) FILTER (AF_grpmax IS NOT NULL AND AF_joint IS NULL) AS lost, count(*) FILTER (AF_grpmax <> AF_joint) AS changed, count(*) FILTER (coalesce(AF_grpmax >= 0.0005, FALSE) <> coalesce(AF_joint >= 0.0005, FALSE)) AS flips FROM {v_variants}")
def _(spark, d):
    return G.reparse_diff(table(spark, d, "v_variants"), "AF_grpmax", "AF_joint", 0.0005)


@query("pick_row_per_gene", "SELECT SYMBOL, Feature, MANE_SELECT FROM (SELECT *, row_number() OVER (PARTITION BY SYMBOL ORDER BY MANE_SELECT IS NULL, Feature, row_key) AS nth FROM {v_variants}) t WHERE nth = 1")
def _(spark, d):
    return G.reference_row(table(spark, d, "v_variants"), ["SYMBOL"], [F.col("MANE_SELECT").isNull(), "Feature", *KEY]).select("SYMBOL", "Feature", "MANE_SELECT")


@query("count_by_pair", "SELECT SYMBOL, MANE_SELECT, count(*) AS n FROM {v_variants} GROUP BY ALL")
def _(spark, d):
    return P.count_by(table(spark, d, "v_variants"), ["SYMBOL", "MANE_SELECT"])


@query("column_profile", "SELECT 'SYMBOL' AS \"column\", count(SYMBOL) AS n, count(DISTINCT SYMBOL) AS n_distinct, CAST(sum(strlen(SYMBOL)) AS BIGINT) AS bytes FROM {v_variants} UNION ALL SELECT 'MANE_SELECT', count(MANE_SELECT), count(DISTINCT MANE_SELECT), CAST(sum(strlen(MANE_SELECT)) AS BIGINT) FROM {v_variants}")
def _(spark, d):
    return G.column_profile(table(spark, d, "v_variants"), ["SYMBOL", "MANE_SELECT"])


@query("dedupe_merge", """SELECT CHROM, POS, REF, ALT, array_to_string(list_sort(list(DISTINCT cdna)), ';') AS cdna, max(n_het) AS n_het, arg_min(gene, (cdna, gene)) AS gene FROM {v_cases} WHERE CHROM IS NOT NULL GROUP BY ALL
 UNION ALL SELECT CHROM, POS, REF, ALT, cdna, n_het, gene FROM {v_cases} WHERE CHROM IS NULL""")
def _(spark, d):
    return G.dedupe_merge(table(spark, d, "v_cases"), ["CHROM", "POS", "REF", "ALT"], ["cdna"], ["n_het"], ["gene"], ["cdna", "gene"])


@query("reference_row_per_gene", f"SELECT Locus, SYMBOL, Feature, row_key FROM (SELECT *, row_number() OVER (PARTITION BY Locus, SYMBOL ORDER BY MANE_SELECT IS NULL, Feature, row_key) AS nth FROM ({_V}) v) t WHERE nth = 1")
def _(spark, d):
    return G.reference_row(build_locus(table(spark, d, "v_variants")), ["Locus", "SYMBOL"], [F.col("MANE_SELECT").isNull(), "Feature", *KEY]).select("Locus", "SYMBOL", "Feature", *KEY)


@query("duplicate_flag_keep_all", f"SELECT row_key, count(*) OVER (PARTITION BY Locus) > 1 AS repeated FROM ({_V}) v")
def _(spark, d):
    return P.flag_repeated(build_locus(table(spark, d, "v_variants")), ["Locus"]).select(*KEY, "repeated")


@query("coordinate_order_check", """SELECT SYMBOL, count(DISTINCT CHROM) AS contigs, count(*) FILTER (b IS NULL OR b <> CHROM) AS contig_blocks, count(*) FILTER (b = CHROM AND POS < a) AS position_decreases, count(DISTINCT CHROM) = count(*) FILTER (b IS NULL OR b <> CHROM) AND count(*) FILTER (b = CHROM AND POS < a) = 0 AS ordered
 FROM (SELECT *, lag(CHROM) OVER w AS b, lag(POS) OVER w AS a FROM {v_variants} WINDOW w AS (PARTITION BY SYMBOL ORDER BY row_key)) t GROUP BY SYMBOL""")
def _(spark, d):
    return ordered.coordinate_order(table(spark, d, "v_variants"), "SYMBOL", "row_key")


@query("top_n_per_group", f"SELECT process, name, ms, nth FROM (SELECT *, row_number() OVER (PARTITION BY process ORDER BY ms DESC, name, submit_ts) AS nth FROM ({_TASKS}) t) u WHERE nth <= 5")
def _(spark, d):
    return G.top_n(_tasks(spark, d), "process", "ms", 5, ["name", "submit_ts"]).select("process", "name", "ms", "nth")


@query("attempt_number", "SELECT name, submit_ts, status, row_number() OVER (PARTITION BY name ORDER BY submit_ts, realtime, status) AS attempt FROM {v_tasks}")
def _(spark, d):
    return G.running_number(table(spark, d, "v_tasks"), ["name"], ["submit_ts", "realtime", "status"]).select("name", "submit_ts", "status", "attempt")


@query("peak_concurrency", "WITH e AS (SELECT l_returnflag AS g, l_orderkey AS t, 1 AS d FROM lineitem UNION ALL SELECT l_returnflag, l_orderkey + l_linenumber * 10, -1 FROM lineitem), s AS (SELECT g, t, d, sum(d) AS d2 FROM e GROUP BY ALL) SELECT g AS l_returnflag, CAST(max(o) AS BIGINT) AS peak FROM (SELECT g, sum(d2) OVER (PARTITION BY g ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS o FROM s) x GROUP BY g")
def _(spark, d):
    return ordered.peak_concurrency(table(spark, d, "lineitem").withColumn("stop", F.col("l_orderkey") + F.col("l_linenumber") * 10), "l_returnflag", "l_orderkey", "stop")


@query("contig_order_sort", "SELECT row_key, CAST(substr(CHROM, 4) AS INT) AS rank, row_number() OVER (ORDER BY CAST(substr(CHROM, 4) AS INT), POS, row_key) AS place FROM {v_variants}")
def _(spark, d):
    rows = table(spark, d, "v_variants").select("CHROM", "POS", *KEY, G.contig_rank(F.col("CHROM")).alias("rank"))
    return ordered.row_numbers(rows, ["rank", "POS", *KEY], "place").select(*KEY, "rank", "place")


@query("region_of_ordered_table", "SELECT row_key, POS FROM {v_variants} WHERE CHROM = 'chr7' AND POS BETWEEN 1000 AND 20000")
def _(spark, d):
    from varlake.sources.tables import scratch

    rows = table(spark, d, "v_variants").select("POS", *KEY, G.contig_rank(F.col("CHROM")).alias("rank"))
    manifest = ordered.write_ordered(rows, ["rank", "POS"], scratch(spark))
    return ordered.read_between(manifest, {"rank": 7, "POS": 1000}, {"rank": 7, "POS": 20000}).select(*KEY, "POS")


@query("topk_novel", "SELECT row_key, splice_score FROM {v_variants} WHERE NOT coalesce(AF_joint * 400 >= 0.2, FALSE) ORDER BY splice_score DESC, row_key LIMIT 15")
def _(spark, d):
    return P.top_novel(table(spark, d, "v_variants"), F.col("AF_joint") * 400 >= 0.2, [F.desc("splice_score"), *KEY], 15).select(*KEY, "splice_score")


@query("seeded_sample", "SELECT CHROM, POS FROM (SELECT DISTINCT CHROM, POS FROM {v_cache}) t ORDER BY md5(CHROM || '|' || CAST(POS AS STRING) || '|' || '7'), CHROM, POS LIMIT 100")
def _(spark, d):
    return G.seeded_sample(table(spark, d, "v_cache"), ["CHROM", "POS"], 100, 7)


@query("splice_region_bin", "SELECT row_key, CASE WHEN Consequence = 'splice_donor_variant' THEN 'canonical' WHEN off = 0 THEN 'exonic' WHEN off <= 8 THEN 'near' WHEN off <= 50 THEN 'proximal' WHEN off <= 500 THEN 'deep' ELSE 'very_deep' END AS region FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN l_orderkey % 40 + 1 WHEN 2 THEN l_orderkey % 60 + 1 ELSE 2 END AS off FROM {v_wide}) t")
def _(spark, d):
    from varlake.functions.values import intron_offset

    return table(spark, d, "v_wide").select(*KEY, G.splice_region(intron_offset(F.col("HGVSc")), F.col("Consequence")).alias("region"))


@query("add_wide_genotypes", """SELECT o_orderkey, max(CASE WHEN s = 'S0' THEN w END) AS GT_S0, max(CASE WHEN s = 'S1' THEN w END) AS GT_S1, max(CASE WHEN s = 'S0' THEN q END) AS GQ_S0, max(CASE WHEN s = 'S1' THEN q END) AS GQ_S1 FROM (
 SELECT o_orderkey, s, CASE (o_orderkey + i) % 4 WHEN 0 THEN 'HOMREF' WHEN 1 THEN 'HET' WHEN 2 THEN 'HOMALT' ELSE 'MISSING' END AS w, (o_orderkey + i) % 50 AS q FROM (SELECT DISTINCT o_orderkey FROM orders) o, (SELECT 'S0' AS s, 0 AS i UNION ALL SELECT 'S1', 1) t) u GROUP BY o_orderkey""")
def _(spark, d):
    loci = table(spark, d, "orders").select("o_orderkey").distinct().withColumn("Locus", F.col("o_orderkey").cast("string"))
    long = loci.select("*", F.explode(F.array(F.struct(F.lit("S0").alias("sample_id"), F.lit(0).alias("i")), F.struct(F.lit("S1").alias("sample_id"), F.lit(1).alias("i")))).alias("x")).select("o_orderkey", "Locus", "x.*")
    long = long.selectExpr("Locus", "sample_id", "CASE (o_orderkey + i) % 4 WHEN 0 THEN 'hom_ref' WHEN 1 THEN 'het' WHEN 2 THEN 'hom_alt' ELSE 'no_call' END AS gt_status", "(o_orderkey + i) % 50 AS gq")
    return family.add_wide_genotypes(loci, long, ["S0", "S1"]).drop("Locus")
