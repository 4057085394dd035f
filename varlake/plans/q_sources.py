"""Queries of scans and sinks: lines that Spark derives from the tables, read by the parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.plans.registry import KEY, query
from varlake.plans.views import table
from varlake.sources import scans, sinks

_LINE = """concat_ws('\\t', CHROM, CAST(POS AS STRING), row_key, REF, CASE WHEN l_linenumber = 3 THEN ALT || ',N' ELSE ALT END, '.', 'PASS',
 'DB;AC=1,2;NOTE=' || IMPACT || CASE WHEN l_linenumber = 1 THEN '' ELSE ';CSQ=' || SYMBOL || '|' || Feature || '|' || Consequence || CASE WHEN l_linenumber % 2 = 0 THEN ',G1|ENST1|' ELSE '' END END, 'GT:GQ:DP', GT_S0 || ':' || CAST(GQ_S0 AS STRING) || ':.', GT_S1)"""
_FIELDS = ["SYMBOL", "Feature", "Consequence"]


def _records(spark, d):
    return scans.vcf_records(table(spark, d, "v_wide").select(F.expr(_LINE).alias("value")), ["S0", "S1"])


@query("scan_vcf", "SELECT row_key AS ID, CHROM, POS, REF, CASE WHEN l_linenumber = 3 THEN ALT || ',N' ELSE ALT END AS ALT, 'PASS' AS FILTER FROM {v_wide}")
def _(spark, d):
    return _records(spark, d).select("ID", "CHROM", "POS", "REF", "ALT", "FILTER")


@query("split_multiallelic", "SELECT row_key AS ID, ALT, 1 AS allele FROM {v_wide} UNION ALL SELECT row_key, 'N', 2 FROM {v_wide} WHERE l_linenumber = 3")
def _(spark, d):
    return scans.split_multiallelic(_records(spark, d)).select("ID", "ALT", "allele")


@query("flatten_info", "SELECT row_key AS ID, '1&2' AS AC, IMPACT AS NOTE FROM {v_wide}")
def _(spark, d):
    return scans.flatten_info(_records(spark, d), ["AC", "NOTE", "CSQ"]).select("ID", "AC", "NOTE")


_CSQ = "SELECT row_key AS ID, CASE WHEN l_linenumber <> 1 THEN SYMBOL END AS SYMBOL, CASE WHEN l_linenumber <> 1 THEN Feature END AS Feature, CASE WHEN l_linenumber <> 1 THEN Consequence END AS Consequence FROM {v_wide} UNION ALL SELECT row_key, 'G1', 'ENST1', NULL FROM {v_wide} WHERE l_linenumber % 2 = 0"


@query("explode_csq", _CSQ)
def _(spark, d):
    return scans.explode_csq(_records(spark, d), _FIELDS).select("ID", *_FIELDS)


@query("explode_csq_genes", f"SELECT * FROM ({_CSQ}) t WHERE upper(SYMBOL) IN ('G0', 'G1', 'G2', 'G3', 'G4')")
def _(spark, d):
    genes = table(spark, d, "region").select(F.expr("'g' || CAST(r_regionkey AS STRING)").alias("name"))
    return scans.explode_csq(_records(spark, d), _FIELDS, genes).select("ID", *_FIELDS)


@query("sample_format_columns", "SELECT row_key AS ID, GT_S0, CAST(GQ_S0 AS STRING) AS GQ_S0, GT_S1 FROM {v_wide} WHERE contains(GT_S0, '1') OR contains(GT_S1, '1')")
def _(spark, d):
    return scans.sample_format_columns(_records(spark, d), ["S0", "S1"]).select("ID", "GT_S0", "GQ_S0", "GT_S1")


@query("extract_genotypes", "SELECT CHROM, POS, 'S0' AS sample_id, GT_S0 AS gt_raw, GQ_S0 AS gq, CAST(NULL AS INT) AS dp FROM {v_wide} UNION ALL SELECT CHROM, POS, 'S1', GT_S1, NULL, NULL FROM {v_wide}")
def _(spark, d):
    return scans.extract_genotypes(_records(spark, d), ["S0", "S1"]).select("CHROM", "POS", "sample_id", "gt_raw", "gq", "dp")


_GTF = "concat_ws('\\t', chrom, 'src', CASE WHEN start_pos % 3 = 0 THEN 'exon' ELSE 'gene' END, CAST(start_pos AS STRING), CAST(end_pos AS STRING), '.', strand, '.', 'gene_id \"E' || gene || '.1\"; gene_name \"' || gene || '\";')"


@query("scan_gtf", "SELECT chrom, start_pos AS start, end_pos AS \"end\", strand, 'E' || gene || '.1' AS gene_id, gene AS gene_name FROM {v_regions} WHERE start_pos % 3 <> 0")
def _(spark, d):
    return scans.gtf_features(table(spark, d, "v_regions").select(F.expr(_GTF).alias("value")), "gene").drop("transcript_id")


@query("scan_bed", "SELECT chrom, start_pos AS start, end_pos AS \"end\", gene AS name FROM {v_regions}")
def _(spark, d):
    return scans.bed_regions(table(spark, d, "v_regions").select(F.concat_ws("\t", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), "gene").alias("value")))


@query("scan_alias_table", "SELECT DISTINCT symbol, ensembl_gene_id AS ensg, 0 AS tier FROM {v_alias} UNION SELECT DISTINCT prev_symbol, ensembl_gene_id, 1 FROM {v_alias} UNION SELECT DISTINCT unnest(string_split(alias_symbol, '|')), ensembl_gene_id, 1 FROM {v_alias}")
def _(spark, d):
    return scans.alias_edges(table(spark, d, "v_alias"))


@query("scan_exon_arrays", "SELECT p_partkey, 2 AS n, CAST(p_size AS BIGINT) AS first_start, CAST(p_size * 3 + 9 AS BIGINT) AS last_end FROM part")
def _(spark, d):
    rows = table(spark, d, "part").selectExpr("p_partkey", "CAST(p_size * 3 AS STRING) || ',' || CAST(p_size AS STRING) || ',' AS starts", "'9,4,' AS sizes")
    e = scans.exon_array(F.col("starts"), F.col("sizes"))
    return rows.select("p_partkey", F.size(e).alias("n"), e[0]["start"].alias("first_start"), e[1]["end"].alias("last_end"))


@query("scan_run_log", "SELECT name, status, row_number() OVER (PARTITION BY name ORDER BY ln) AS attempt, ln FROM (SELECT name, status, CAST(submit_ts AS STRING) || realtime || status AS ln FROM {v_tasks}) t")
def _(spark, d):
    lines = table(spark, d, "v_tasks").selectExpr("CAST(submit_ts AS STRING) || realtime || status AS ln", "'[ab/12] process > ' || name || ' status: ' || status AS value")
    return scans.run_log(lines, "ln").select("name", "status", "attempt", "ln")


@query("scan_fasta_tiles", "SELECT doc_id AS contig, tile, substr(text, CAST(tile * 500 + 1 AS INT), 500) AS seq FROM (SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil(length(text) / 500.0) AS BIGINT)))) AS tile FROM documents) t")
def _(spark, d):
    return scans.sequence_tiles(table(spark, d, "documents").selectExpr("doc_id AS contig", "text AS seq"), 500)


@query("infer_whole_file_schema", "SELECT unnest(['SYMBOL', 'QUAL', 'l_orderkey', 'flag', 'none']) AS \"column\", unnest(['str', 'float', 'int', 'bool', 'empty']) AS kind")
def _(spark, d):
    return scans.whole_file_kinds(table(spark, d, "v_variants").selectExpr("SYMBOL", "CAST(QUAL AS STRING) AS QUAL", "CAST(l_orderkey AS STRING) AS l_orderkey", "CASE WHEN l_orderkey % 2 = 0 THEN 'True' ELSE '.' END AS flag", "'.' AS none"))


@query("unify_parts", "SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS x, NULL AS note FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def _(spark, d):
    o = table(spark, d, "orders")
    return sinks.unify_parts([o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "o_orderkey AS x"), o.where("o_orderkey % 2 = 1").selectExpr("o_orderkey", "o_totalprice AS x", "o_orderstatus AS note")])


@query("write_vcf", "SELECT CHROM || chr(9) || CAST(POS AS STRING) || chr(9) || '.' || chr(9) || REF || chr(9) || ALT || chr(9) || '.' || chr(9) || '.' || chr(9) || 'SYMBOL=' || SYMBOL || coalesce(';MANE_SELECT=' || MANE_SELECT, '') AS value FROM {v_variants}")
def _(spark, d):
    return sinks.vcf_lines(table(spark, d, "v_variants"), ["SYMBOL", "MANE_SELECT"])


@query("write_with_rejects", "SELECT row_key, CASE WHEN REF = ALT THEN 'same allele' WHEN MANE_SELECT IS NULL THEN 'no transcript' END AS reason FROM {v_variants} WHERE REF = ALT OR MANE_SELECT IS NULL")
def _(spark, d):
    reason = F.expr("CASE WHEN REF = ALT THEN 'same allele' WHEN MANE_SELECT IS NULL THEN 'no transcript' END")
    return sinks.split_rejects(table(spark, d, "v_variants").withColumn("reason", reason))[1].select(*KEY, "reason")


@query("read_valid_segments", "SELECT CHROM, POS, REF, ALT, score, segment FROM {v_cache} WHERE segment <> 'seg2'")
def _(spark, d):
    cache = table(spark, d, "v_cache")
    manifest = cache.groupBy("segment").agg(F.count("*").alias("n_records"), F.bit_xor(F.xxhash64("CHROM", "POS", "REF", "ALT", "score")).alias("checksum"))
    damaged = manifest.withColumn("n_records", F.when(F.col("segment") == "seg2", F.col("n_records") + 1).otherwise(F.col("n_records")))
    return sinks.valid_segments(cache.select("CHROM", "POS", "REF", "ALT", "score", "segment"), damaged)
