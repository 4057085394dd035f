"""Queries of builds, names, parities and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.operators import reports as P
from varlake.operators import builds as B
from varlake.operators import family, joins
from varlake.operators.aggregates import contig_rank
from varlake.plans.registry import KEY, query
from varlake.plans.views import table
from varlake.sources import scans

_BLOCKS = "SELECT 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS src, p_partkey * 90 AS src_start, p_partkey * 90 + p_size AS src_end, 'new' || CAST(p_partkey % 22 AS STRING) AS dst, p_partkey * 77 AS dst_start, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand FROM {part}"
_LIFT = f"""SELECT v.k, n, h.dst AS dst, h.p AS p, h.strand AS strand, v.alt AS alt FROM (SELECT row_key AS k, CHROM, POS, REF, ALT || CASE WHEN l_linenumber = 2 THEN 'A' ELSE '' END AS alt FROM {{v_variants}}) v LEFT JOIN (
 SELECT k, count(*) AS n, min(struct_pack(dst := dst, p := CASE WHEN strand = '-' THEN dst_start + src_end - src_start - 1 - (POS - src_start) ELSE dst_start + POS - src_start END, strand := strand)) AS h FROM (SELECT row_key AS k, CHROM, POS FROM {{v_variants}}) w JOIN ({_BLOCKS}) b ON b.src = w.CHROM AND w.POS >= src_start AND w.POS < src_end GROUP BY k) g ON g.k = v.k"""
_WHY = "CASE WHEN n IS NULL THEN 'unmapped' WHEN n > 1 THEN 'ambiguous' WHEN strand = '-' AND length(alt) > 1 THEN 'minus_strand_indel' END"


def _lifted(spark, d):
    rows = table(spark, d, "v_variants").selectExpr("row_key AS k", "CHROM AS chrom", "POS AS pos", "REF AS ref", "ALT || CASE WHEN l_linenumber = 2 THEN 'A' ELSE '' END AS alt")
    return B.liftover(rows, spark.sql(_BLOCKS, part=table(spark, d, "part")), 1000)


@query("liftover", f"SELECT k, CASE WHEN {_WHY} IS NULL THEN dst END AS lifted_chrom, CASE WHEN {_WHY} IS NULL THEN p END AS lifted_pos, CASE WHEN {_WHY} IS NULL THEN CASE WHEN strand = '-' THEN reverse(translate(alt, 'ACGTN', 'TGCAN')) ELSE alt END END AS lifted_alt, {_WHY} AS reason FROM ({_LIFT}) t")
def _(spark, d):
    return _lifted(spark, d).select("k", "lifted_chrom", "lifted_pos", "lifted_alt", "reason")


@query("lift_site_table", f"SELECT coalesce({_WHY}, 'lifted') AS outcome, count(*) AS n FROM ({_LIFT}) t GROUP BY ALL")
def _(spark, d):
    return _lifted(spark, d).groupBy(F.coalesce("reason", F.lit("lifted")).alias("outcome")).agg(F.count("*").alias("n"))


@query("reference_allele_check", "SELECT doc_id, i AS pos, upper(substr(text, CAST(i AS INT), 1)) = 'A' AS agrees FROM documents, (SELECT unnest([1, 7, 501]) AS i) p WHERE length(text) >= i")
def _(spark, d):
    docs = table(spark, d, "documents")
    tiles = scans.sequence_tiles(docs.selectExpr("doc_id AS contig", "text AS seq"), 500)
    sites = docs.select(F.col("doc_id").alias("contig"), F.length("text").alias("n"), F.explode(F.array(*map(F.lit, (1, 7, 501)))).alias("pos"), F.lit("A").alias("ref")).where("n >= pos").drop("n")
    return B.reference_allele_check(sites, tiles, 500).select(F.col("contig").alias("doc_id"), "pos", "agrees")


@query("contig_header_check", "SELECT h.contig, r.contig AS reference, CASE WHEN r.contig IS NULL THEN 'unmatched' WHEN h.length <> r.length THEN 'length' WHEN h.contig <> r.contig THEN 'name' ELSE 'ok' END AS state FROM (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'chr' ELSE '' END || CAST(n_nationkey + 1 AS STRING) AS contig, n_nationkey * 10 AS length FROM nation) h LEFT JOIN (SELECT 'chr' || CAST(n_nationkey + 1 AS STRING) AS contig, CASE WHEN n_nationkey = 4 THEN 1 ELSE n_nationkey * 10 END AS length FROM nation WHERE n_nationkey < 22) r ON replace(h.contig, 'chr', '') = replace(r.contig, 'chr', '')")
def _(spark, d):
    n = table(spark, d, "nation")
    header = n.selectExpr("CASE WHEN n_nationkey % 2 = 0 THEN 'chr' ELSE '' END || CAST(n_nationkey + 1 AS STRING) AS contig", "n_nationkey * 10 AS length")
    reference = n.where("n_nationkey < 22").selectExpr("'chr' || CAST(n_nationkey + 1 AS STRING) AS contig", "CASE WHEN n_nationkey = 4 THEN 1 ELSE n_nationkey * 10 END AS length")
    return B.contig_header_check(header, reference)


_NAMES = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'G' || CAST(p_partkey % 60 AS STRING) WHEN 1 THEN 'g' || CAST(p_partkey % 60 AS STRING) WHEN 2 THEN 'ENSG' || lpad(CAST(p_partkey % 60 AS STRING), 11, '0') WHEN 3 THEN 'OLD' || CAST(p_partkey % 90 AS STRING) ELSE 'X' END AS name FROM part"


@query("resolve_gene_names", f"""WITH genes AS (SELECT DISTINCT symbol, ensembl_gene_id AS gid FROM {{v_alias}}), old AS (SELECT prev_symbol AS s, min(ensembl_gene_id) AS g, count(DISTINCT ensembl_gene_id) AS n FROM {{v_alias}} GROUP BY ALL)
 SELECT DISTINCT name, coalesce(e.gid, c.gid, i.gid, CASE WHEN n = 1 THEN g END) AS gene_id, CASE WHEN e.gid IS NOT NULL THEN 'exact' WHEN c.gid IS NOT NULL THEN 'case' WHEN i.gid IS NOT NULL THEN 'id' WHEN n = 1 THEN 'alias' WHEN n > 1 THEN 'ambiguous' ELSE 'not_found' END AS reason
 FROM ({_NAMES}) p LEFT JOIN genes e ON e.symbol = name LEFT JOIN genes c ON upper(c.symbol) = upper(name) LEFT JOIN genes i ON i.gid = name LEFT JOIN old ON s = name""")
def _(spark, d):
    a = table(spark, d, "v_alias")
    names = spark.sql(_NAMES.replace("FROM part", "FROM {part}"), part=table(spark, d, "part")).select("name").distinct()
    return B.resolve_gene_names(names, a.select("symbol", F.col("ensembl_gene_id").alias("gene_id")).distinct(), a.select(F.col("prev_symbol").alias("symbol"), F.col("ensembl_gene_id").alias("ensg")))


@query("locus_aligned_chunks", "SELECT row_key, count(*) OVER (PARTITION BY CHROM, POS, REF, ALT) AS n_in_chunk FROM {v_variants}")
def _(spark, d):
    from pyspark.sql import Window as W

    # rows of one allele are in one partition, so that counting within partitions counts all
    rows = table(spark, d, "v_variants").repartition(*joins.ALLELE).withColumn("chunk", F.spark_partition_id())
    return rows.select(*KEY, F.count("*").over(W.partitionBy(*joins.ALLELE)).alias("n_in_chunk"))


@query("concat_chunks", "SELECT row_key, CAST(substr(CHROM, 4) AS INT) AS rank FROM {v_variants}")
def _(spark, d):
    v = table(spark, d, "v_variants")
    whole = v.where("l_orderkey % 2 = 0").unionByName(v.where("l_orderkey % 2 = 1"))
    return whole.withColumn("rank", contig_rank(F.col("CHROM"))).orderBy("rank", "POS").select(*KEY, "rank")


@query("check_row_parity", "SELECT 'variants' AS stage, count(*) AS n, CASE WHEN count(*) = (SELECT count(*) FROM lineitem) THEN 'DONE' ELSE 'INCOMPLETE' END AS state FROM {v_variants} UNION ALL SELECT 'cache', count(*), CASE WHEN count(*) = (SELECT count(*) FROM lineitem) THEN 'DONE' ELSE 'INCOMPLETE' END FROM {v_cache}")
def _(spark, d):
    return P.row_parity({s: table(spark, d, v) for v, s in (("v_variants", "variants"), ("v_cache", "cache"))}, table(spark, d, "lineitem"))


@query("write_bed", "SELECT DISTINCT c || chr(9) || CAST(greatest(start_pos - 100, 0) AS STRING) || chr(9) || CAST(end_pos + 100 AS STRING) AS value FROM (SELECT unnest([chrom, substr(chrom, 4)]) AS c, start_pos, end_pos FROM {v_regions}) t")
def _(spark, d):
    return P.bed_lines(table(spark, d, "v_regions"), F.array("chrom", F.expr("substr(chrom, 4)")), "start_pos", "end_pos", 100)


@query("read_pedigree", "SELECT 'F' || CAST(c_nationkey AS STRING) AS FamilyID, CAST(c_custkey AS STRING) AS IndividualID, CAST(c_custkey % 3 AS INT) AS Phenotype FROM customer")
def _(spark, d):
    lines = table(spark, d, "customer").selectExpr("concat_ws('\\t', 'F' || CAST(c_nationkey AS STRING), CAST(c_custkey AS STRING), '0', '0', '1', CAST(c_custkey % 3 AS STRING)) AS value")
    return family.read_pedigree(lines).select("FamilyID", "IndividualID", "Phenotype")


@query("gtf_parity", "SELECT chrom, count(*) FILTER (strand = '+') AS plus, count(*) AS n, count(DISTINCT gene) AS genes FROM {v_regions} GROUP BY chrom")
def _(spark, d):
    return P.gene_counts(table(spark, d, "v_regions"))


@query("mapping_agreement", "SELECT CASE WHEN g IS NULL THEN 'none' WHEN list_contains(g, symbol) THEN 'same' ELSE 'different' END AS class, count(*) AS n FROM (SELECT p_partkey, 'G' || CAST(p_partkey % 50 AS STRING) AS symbol, 'OLD' || CAST(p_partkey % 90 AS STRING) AS o FROM part) p LEFT JOIN (SELECT prev_symbol, list(DISTINCT symbol) AS g FROM {v_alias} GROUP BY ALL) a ON a.prev_symbol = p.o GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "part").selectExpr("'G' || CAST(p_partkey % 50 AS STRING) AS symbol", "'OLD' || CAST(p_partkey % 90 AS STRING) AS o")
    return P.mapping_agreement(rows, table(spark, d, "v_alias").select(F.col("prev_symbol").alias("o"), "symbol"))


@query("mapping_audit", "SELECT prev_symbol, symbol, count(*) OVER (PARTITION BY prev_symbol) AS n_edges, concat_ws('; ', CASE WHEN count(*) OVER (PARTITION BY prev_symbol, symbol) > 1 THEN 'repeated' END, CASE WHEN symbol LIKE '%7' THEN 'suffix' END) AS issues FROM {v_alias}")
def _(spark, d):
    return P.mapping_audit(table(spark, d, "v_alias"), "prev_symbol", "symbol", F.col("symbol").like("%7"), "suffix")


@query("filter_by_missing_list", "SELECT row_key FROM {v_variants} WHERE SYMBOL IN (SELECT 'G' || CAST(n_nationkey AS STRING) FROM nation WHERE n_nationkey % 2 = 1)")
def _(spark, d):
    listed = table(spark, d, "nation").where("n_nationkey % 2 = 1").selectExpr("'G' || CAST(n_nationkey AS STRING) AS SYMBOL")
    return P.listed_only(table(spark, d, "v_variants"), listed, "SYMBOL").select(*KEY)


@query("attribution_audit", "SELECT count(*) FILTER (len(string_split(SpliceAI, '&')) > 1) AS multi_entry, count(*) FILTER (split_part(split_part(SpliceAI, '&', 1), '|', 2) = SYMBOL) AS own_entry, count(*) FILTER (split_part(split_part(SpliceAI, '&', 1), '|', 2) <> SYMBOL) AS other_entry FROM {v_variants}")
def _(spark, d):
    return P.attribution_audit(table(spark, d, "v_variants"))