"""Queries of joins, intervals, the score cache and cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.operators import reports as P
from varlake.operators import joins as J
from varlake.plans.registry import KEY, QUERIES, query
from varlake.plans.views import table

A = "CHROM, POS, REF, ALT"
_LOOKUP = f"SELECT {A}, min(struct_pack(segment := segment, score := score)) AS f FROM {{v_cache}} GROUP BY ALL"
_SITES = f"SELECT {A}, f.segment AS segment, f.score AS score FROM ({_LOOKUP}) l"


def _sites(spark, d):
    return J.cache_lookup(table(spark, d, "v_cache"))


@query("union_distinct_by_key", _SITES)
def _(spark, d):
    return _sites(spark, d)


@query("annotate_exact_allele", f"SELECT row_key, score FROM {{v_variants}} LEFT JOIN ({_SITES}) s USING ({A})")
def _(spark, d):
    return J.annotate_exact_allele(table(spark, d, "v_variants"), _sites(spark, d), ["score"]).select(*KEY, "score")


@query("annotate_position", "SELECT row_key, mx FROM {v_variants} LEFT JOIN (SELECT CHROM, POS, max(score) AS mx FROM {v_cache} GROUP BY ALL) t USING (CHROM, POS)")
def _(spark, d):
    track = table(spark, d, "v_cache").groupBy("CHROM", "POS").agg(F.max("score").alias("mx"))
    return J.annotate_position(table(spark, d, "v_variants"), track, "mx").select(*KEY, "mx")


@query("merge_predictors", f"SELECT row_key, score, n FROM {{v_variants}} LEFT JOIN ({_SITES}) s USING ({A}) LEFT JOIN (SELECT {A}, count(*) AS n FROM {{v_cache}} GROUP BY ALL) c USING ({A})")
def _(spark, d):
    counts = table(spark, d, "v_cache").groupBy(*J.ALLELE).agg(F.count("*").alias("n"))
    return J.merge_predictors(table(spark, d, "v_variants"), [(_sites(spark, d), ["score"]), (counts, ["n"])]).select(*KEY, "score", "n")


@query("region_restrict", "SELECT row_key FROM {v_variants} v WHERE EXISTS (SELECT 1 FROM {v_regions} r WHERE r.chrom = v.CHROM AND v.POS - 1 >= r.start_pos AND v.POS - 1 < r.end_pos)")
def _(spark, d):
    return J.region_restrict(table(spark, d, "v_variants"), table(spark, d, "v_regions"), 1000).select(*KEY)


@query("interval_join", "SELECT row_key, r.gene AS gene, start_pos FROM {v_variants} v JOIN {v_regions} r ON r.chrom = v.CHROM AND v.POS >= r.start_pos AND v.POS < r.end_pos")
def _(spark, d):
    a = table(spark, d, "v_variants").select(*KEY, "CHROM", "POS", (F.col("POS") + 1).alias("stop"))
    return J.interval_join(a, table(spark, d, "v_regions").withColumnRenamed("chrom", "rchrom"), 1000, ("CHROM", "rchrom"), ("POS", "stop"), ("start_pos", "end_pos")).select(*KEY, "gene", "start_pos")


_EX = "SELECT 'T' || CAST(p_partkey % 300 AS STRING) AS ensg, chrom, strand, start_pos + 7 AS start2, end_pos - 3 AS end2 FROM (SELECT p_partkey, 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 37 AS start_pos, p_partkey * 37 + p_size * 20 AS end_pos FROM {part}) x WHERE end_pos > start_pos + 20"
_BEST = f"""SELECT symbol, max(CASE WHEN nth = 1 THEN ensg END) AS ensg, max(CASE WHEN nth = 1 THEN bp END) AS bp, max(CASE WHEN nth = 2 THEN ensg END) AS runner_up_ensg, max(CASE WHEN nth = 2 THEN bp END) AS runner_up_bp FROM (
 SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bp DESC, ensg) AS nth FROM (SELECT gene AS symbol, ensg, CAST(sum(least(end_pos, end2) - greatest(start_pos, start2) + 1) AS BIGINT) AS bp FROM {{v_regions}} r JOIN ({_EX}) e ON r.chrom = e.chrom AND r.strand = e.strand AND r.start_pos <= e.end2 AND e.start2 <= r.end_pos GROUP BY ALL) a) b WHERE nth <= 2 GROUP BY symbol"""


@query("best_overlap_gene", _BEST)
def _(spark, d):
    genes = table(spark, d, "v_regions").selectExpr("gene AS symbol", "chrom", "strand", "start_pos AS start", "end_pos AS end")
    exons = spark.sql(_EX, part=table(spark, d, "part")).selectExpr("ensg", "chrom", "strand", "start2 AS start", "end2 AS end")
    return J.best_overlap(genes, exons, 1000)


@query("classify_alias_pairs", f"SELECT CASE WHEN p_partkey IS NULL THEN 'unresolved' WHEN b.ensg = 'T' || CAST(p_partkey % 300 AS STRING) THEN 'alias' ELSE 'neighbour' END AS cls, count(*) AS n FROM ({_BEST}) b LEFT JOIN (SELECT min(p_partkey) AS p_partkey, 'G' || CAST(p_partkey % 50 AS STRING) AS symbol FROM part WHERE p_partkey % 3 = 0 GROUP BY ALL) p USING (symbol) GROUP BY ALL")
def _(spark, d):
    known = table(spark, d, "part").where("p_partkey % 3 = 0").groupBy(F.expr("'G' || CAST(p_partkey % 50 AS STRING)").alias("symbol")).agg(F.min("p_partkey").alias("p"))
    known = known.select("symbol", F.expr("'T' || CAST(p % 300 AS STRING)").alias("known"))
    return P.classify_pairs(QUERIES["best_overlap_gene"](spark, d), known).groupBy("cls").agg(F.count("*").alias("n"))


@query("nearby_branchpoint", """SELECT row_key, max(score) AS score, count(*) AS n FROM (SELECT row_key, r.p_size AS score, CASE WHEN strand = '-' THEN v.POS - e ELSE s - v.POS END AS dist, s < v.POS AND v.POS <= e AS inside
 FROM {v_variants} v JOIN (SELECT p_size, 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom, p_partkey * 31 AS s, p_partkey * 31 + 2 AS e, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM {part}) r ON r.chrom = v.CHROM AND v.POS - 45 < e AND s < v.POS + 45) t WHERE inside OR dist BETWEEN 18 AND 44 GROUP BY row_key""")
def _(spark, d):
    points = table(spark, d, "part").selectExpr("p_size AS score", "'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom", "p_partkey * 31 AS start", "p_partkey * 31 + 2 AS end", "CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand")
    return J.nearby_branchpoint(table(spark, d, "v_variants"), points).groupBy(*KEY).agg(F.max("score").alias("score"), F.count("*").alias("n"))


@query("ism_effect", f"SELECT row_key, d_best, n FROM {{v_variants}} JOIN (SELECT {A}, min(score) AS d_best, count(*) AS n FROM {{v_cache}} WHERE score IS NOT NULL GROUP BY ALL) t USING ({A})")
def _(spark, d):
    return P.best_effect(table(spark, d, "v_variants"), table(spark, d, "v_cache"), J.ALLELE, "score").select(*KEY, "d_best", "n")


@query("structural_transcript_match", """WITH t AS (SELECT l_suppkey % 7 AS strand, o, string_agg(CASE WHEN nxt IS NOT NULL THEN CAST(e AS STRING) || '-' || CAST(nxt AS STRING) END, ',' ORDER BY s) AS chain FROM (SELECT *, lead(s) OVER (PARTITION BY o ORDER BY s, e) AS nxt, min(sk) OVER (PARTITION BY o) AS l_suppkey FROM (SELECT DISTINCT l_orderkey AS o, l_linenumber * 100 AS s, l_linenumber * 100 + 50 AS e, l_orderkey % 7 AS sk FROM lineitem) a) b GROUP BY ALL)
 SELECT first AS a, o AS b FROM t JOIN (SELECT strand, chain, min(o) AS first FROM t WHERE chain IS NOT NULL GROUP BY ALL) c USING (strand, chain) WHERE o <> first""")
def _(spark, d):
    exons = table(spark, d, "lineitem").selectExpr("l_orderkey AS o", "l_linenumber * 100 AS start", "l_linenumber * 100 + 50 AS end").distinct()
    t = exons.groupBy("o").agg(F.collect_list(F.struct("start", "end")).alias("exons")).where("size(exons) > 1").select("o", (F.col("o") % 7).alias("strand"), J.transcript_key(F.col("exons")).alias("chain"))
    return J.structural_classes(t, ["strand", "chain"], "o").where("o <> first").select(F.col("first").alias("a"), F.col("o").alias("b"))


_TRANSCRIPTS = """SELECT o, o % 7 AS strand, count(*) = 1 AS single, coalesce(string_agg(CASE WHEN nxt IS NOT NULL THEN CAST(e AS STRING) || '-' || CAST(nxt AS STRING) END, ',' ORDER BY s, e), CAST(min(s) AS STRING) || '-' || CAST(min(e) AS STRING)) AS chain
 FROM (SELECT *, lead(s) OVER (PARTITION BY o ORDER BY s, e) AS nxt FROM (SELECT DISTINCT l_orderkey AS o, l_linenumber * 100 AS s, l_linenumber * 100 + 50 AS e FROM lineitem) a) b GROUP BY o"""


@query("structural_transcript_classes", f"WITH t AS ({_TRANSCRIPTS}) SELECT o, first, n FROM t JOIN (SELECT strand, single, chain, min(o) AS first, count(*) AS n FROM t GROUP BY ALL) c USING (strand, single, chain)")
def _(spark, d):
    exons = table(spark, d, "lineitem").selectExpr("l_orderkey AS o", "l_linenumber * 100 AS start", "l_linenumber * 100 + 50 AS end").distinct()
    t = exons.groupBy("o").agg(F.collect_list(F.struct("start", "end")).alias("exons"))
    t = t.select("o", (F.col("o") % 7).alias("strand"), (F.size("exons") == 1).alias("single"), J.transcript_key(F.col("exons")).alias("chain"))
    return J.structural_classes(t, ["strand", "single", "chain"], "o").select("o", "first", "n")


@query("cache_split", f"SELECT row_key, score, s.POS IS NOT NULL AS hit FROM {{v_variants}} v LEFT JOIN ({_SITES}) s ON v.CHROM = s.CHROM AND v.POS = s.POS AND v.REF = s.REF AND v.ALT = s.ALT")
def _(spark, d):
    return J.cache_split(table(spark, d, "v_variants"), _sites(spark, d)).select(*KEY, "score", "hit")


_MISS = f"SELECT DISTINCT {A} FROM {{v_variants}} WHERE l_orderkey % 3 = 0"


@query("cache_make_segment", f"SELECT row_key FROM {{v_variants}} SEMI JOIN (SELECT DISTINCT {A} FROM {{v_variants}} WHERE l_linenumber = 2) m USING ({A})")
def _(spark, d):
    v = table(spark, d, "v_variants")
    return J.cache_make_segment(v, v.where("l_linenumber = 2")).select(*KEY)


@query("cache_seed", f"SELECT {A}, score FROM (SELECT {A}, max(splice_score) AS score FROM {{v_variants}} GROUP BY ALL) n ANTI JOIN (SELECT DISTINCT {A} FROM {{v_cache}}) c USING ({A})")
def _(spark, d):
    computed = table(spark, d, "v_variants").groupBy(*J.ALLELE).agg(F.max("splice_score").alias("score"))
    held = computed.join(table(spark, d, "v_cache").select(*J.ALLELE).distinct(), J.ALLELE, "left_semi")  # a cache that agrees
    return J.cache_seed(computed, held)


@query("cache_migrate", f"SELECT {A}, score, segment FROM {{v_cache}} c ANTI JOIN (SELECT DISTINCT {A} FROM {{v_cache}} WHERE segment = 'seg1') t USING ({A}) WHERE score IS NOT NULL")
def _(spark, d):
    cache = table(spark, d, "v_cache")
    return J.cache_migrate(cache, cache.where("segment = 'seg1'").select(*J.ALLELE).distinct()).select(*J.ALLELE, "score", "segment")


@query("except_keys", f"SELECT row_key FROM {{v_variants}} ANTI JOIN (SELECT DISTINCT {A} FROM {{v_cache}}) c USING ({A})")
def _(spark, d):
    return P.except_keys(table(spark, d, "v_variants"), table(spark, d, "v_cache"), J.ALLELE).select(*KEY)


@query("intersect_keys", f"SELECT row_key FROM {{v_variants}} SEMI JOIN (SELECT DISTINCT {A} FROM {{v_cache}}) c USING ({A})")
def _(spark, d):
    return P.intersect_keys(table(spark, d, "v_variants"), table(spark, d, "v_cache"), J.ALLELE).select(*KEY)


_CA, _CO = (f"SELECT {A}, min(cdna) AS cdna, min(gene) AS gene FROM {{{v}}} WHERE CHROM IS NOT NULL GROUP BY ALL" for v in ("v_cases", "v_controls"))


@query("cohort_outer_join", f"""SELECT {A}, coalesce(a.cdna, b.cdna) AS cdna, coalesce(a.gene, b.gene) AS gene, CASE WHEN a.cdna IS NOT NULL AND b.cdna IS NOT NULL THEN 'both' WHEN a.cdna IS NOT NULL THEN 'left' ELSE 'right' END AS SOURCE_ORIGIN FROM ({_CA}) a FULL JOIN ({_CO}) b USING ({A})
 UNION ALL SELECT {A}, cdna, gene, 'left' FROM {{v_cases}} WHERE CHROM IS NULL UNION ALL SELECT {A}, cdna, gene, 'right' FROM {{v_controls}} WHERE CHROM IS NULL""")
def _(spark, d):
    def one(name):
        t = table(spark, d, name)
        return t.where("CHROM IS NOT NULL").groupBy(*J.ALLELE).agg(F.min("cdna").alias("cdna"), F.min("gene").alias("gene")).unionByName(t.where("CHROM IS NULL").select(*J.ALLELE, "cdna", "gene"))

    return J.cohort_outer_join(one("v_cases"), one("v_controls"), J.ALLELE, ["cdna", "gene"])


@query("unmapped_report", f"SELECT {A}, cdna, 'cases' AS side FROM {{v_cases}} WHERE CHROM IS NULL UNION ALL SELECT {A}, cdna, 'controls' FROM {{v_controls}} WHERE CHROM IS NULL")
def _(spark, d):
    return P.unmapped({s: table(spark, d, v).select(*J.ALLELE, "cdna") for v, s in (("v_cases", "cases"), ("v_controls", "controls"))}, "CHROM")


@query("map_coordinates_with_fallback", "SELECT c.cdna, c.POS, coalesce(t.pos2, c.POS + 1000) AS pos38, t.pos2 IS NOT NULL AS by_table FROM {v_cases} c LEFT JOIN (SELECT cdna, min(POS) AS pos2 FROM {v_controls} GROUP BY ALL) t USING (cdna)")
def _(spark, d):
    return P.mapped_or(table(spark, d, "v_cases"), table(spark, d, "v_controls"), "cdna", "POS", F.col("POS") + 1000, "pos38", "by_table").select("cdna", "POS", "pos38", "by_table")


@query("compare_runs", "WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0) SELECT 'only_old' AS measure, count(*) AS n FROM a ANTI JOIN b USING (o_orderkey) UNION ALL SELECT 'only_new', count(*) FROM b ANTI JOIN a USING (o_orderkey) UNION ALL SELECT 'differs_o_orderstatus', count(*) FROM a JOIN b USING (o_orderkey) WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus UNION ALL SELECT 'differs_o_totalprice', 0")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 4 <> 0").withColumn("o_orderstatus", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END"))
    return J.compare_runs(o.where("o_orderkey % 5 <> 0"), new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("site_parity", f"SELECT {A}, CAST(sum(n) AS BIGINT) AS surplus FROM (SELECT {A}, 1 AS n FROM {{v_variants}} UNION ALL SELECT {A}, -1 FROM {{v_cache}}) t GROUP BY {A} HAVING sum(n) <> 0")
def _(spark, d):
    return J.site_parity(table(spark, d, "v_variants"), table(spark, d, "v_cache"))


_F1 = f"SELECT {A}, min(struct_pack(a := FILTER, b := GT_S0)) AS r FROM (SELECT * REPLACE (coalesce(FILTER, '.') AS FILTER) FROM {{v_wide}} WHERE l_orderkey % 2 = 0) x GROUP BY {A}"
_F2 = f"SELECT {A}, min(struct_pack(a := FILTER, b := GT_S1, c := GT_S2)) AS r FROM (SELECT w.* REPLACE (coalesce(FILTER, '.') AS FILTER) FROM {{v_wide}} w LEFT JOIN (SELECT DISTINCT {A}, TRUE AS hit FROM {{v_wide}} WHERE l_orderkey % 2 = 0) s USING ({A}) WHERE l_orderkey % 3 <> 1 AND (regexp_matches(GT_S1, '[1-9]') OR regexp_matches(GT_S2, '[1-9]') OR hit)) x GROUP BY {A}"


@query("family_union", f"SELECT {A}, a.r.a AS FILTER_1, b.r.a AS FILTER_2, coalesce(a.r.b, './.') AS GT_S0, coalesce(b.r.b, './.') AS GT_S1, coalesce(b.r.c, './.') AS GT_S2 FROM ({_F1}) a FULL JOIN ({_F2}) b USING ({A})")
def _(spark, d):
    w = table(spark, d, "v_wide").withColumn("FILTER", F.coalesce("FILTER", F.lit(".")))
    return J.family_union(w.where("l_orderkey % 2 = 0"), w.where("l_orderkey % 3 <> 1"), J.ALLELE, ["GT_S0"], ["GT_S1", "GT_S2"])


@query("map_external_ids", "SELECT p_partkey, n_name FROM part LEFT JOIN (SELECT CAST(n_nationkey AS STRING) AS id, n_name FROM nation) n ON split_part(CAST(p_partkey % 40 AS STRING) || '.7', '.', 1) = n.id")
def _(spark, d):
    ids = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), "n_name")
    return P.map_ids(table(spark, d, "part").withColumn("external", F.expr("CAST(p_partkey % 40 AS STRING) || '.7'")), ids, "external").select("p_partkey", "n_name")


@query("gene_set_filter", "SELECT row_key FROM {v_variants} WHERE upper(SYMBOL) IN ('G1', 'G7') OR upper(split_part(Feature, '.', 1)) IN (SELECT 'ENST' || lpad(CAST(n_nationkey AS STRING), 11, '0') FROM nation)")
def _(spark, d):
    wanted = table(spark, d, "nation").select(F.expr("'ENST' || lpad(CAST(n_nationkey AS STRING), 11, '0')").alias("name")).union(spark.createDataFrame([("g1",), ("G7",)], "name string"))
    return P.with_any_name(table(spark, d, "v_variants"), [F.col("SYMBOL"), F.substring_index("Feature", ".", 1)], wanted).select(*KEY)


@query("pad_and_dedupe_regions", "SELECT DISTINCT c AS chrom, greatest(start_pos - 1 - 500, 0) AS s, end_pos + 500 AS e FROM (SELECT unnest([chrom, substr(chrom, 4)]) AS c, start_pos, end_pos FROM {v_regions}) t")
def _(spark, d):
    rows = table(spark, d, "v_regions").select(F.explode(F.array("chrom", F.expr("substr(chrom, 4)"))).alias("chrom"), F.greatest(F.col("start_pos") - 501, F.lit(0)).alias("s"), (F.col("end_pos") + 500).alias("e"))
    return rows.distinct()
