"""Queries of projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.functions import values as V
from varlake.operators import rows as R
from varlake.plans.registry import KEY, query
from varlake.plans.views import table


_RECODED = "CASE WHEN {0} IN ('./.', '.') THEN 'MISSING' WHEN {0} IN ('0/1','1/0','0|1','1|0') THEN 'HET' WHEN {0} IN ('0/0','0|0') THEN 'HOMREF' WHEN {0} IN ('1/1','1|1') THEN 'HOMALT' ELSE {0} END"
_GT3 = ", ".join(f"{_RECODED.format(f'GT_S{i}')} AS GT_S{i}" for i in range(3))


@query("select_columns", "SELECT row_key, SYMBOL, QUAL, GT_S0, GT_S1, GT_S2, GQ_S0, GQ_S1, GQ_S2 FROM {v_wide}")
def _(spark, d):
    return R.select_columns(table(spark, d, "v_wide"), [*KEY, "SYMBOL,", "QUAL", "not_there"])


@query("fix_dup_columns", "SELECT row_key, coalesce(AF_grpmax, CASE WHEN AF_joint = 0.1 THEN NULL ELSE AF_joint END) AS AF, coalesce(note, CASE WHEN SYMBOL IN ('', '.') THEN NULL ELSE SYMBOL END) AS note FROM {v_wide}")
def _(spark, d):
    rows = table(spark, d, "v_wide").select(*KEY, F.col("AF_grpmax").alias("AF"), F.expr("CASE WHEN AF_joint = 0.1 THEN NULL ELSE AF_joint END").alias("AF.1"), "note", F.col("SYMBOL").alias("note.2"))
    return R.fix_dup_columns(rows)


@query("build_locus", "SELECT row_key, CHROM || ':' || CAST(POS AS STRING) || '-' || REF || '-' || ALT AS Locus FROM {v_variants}")
def _(spark, d):
    return R.build_locus(table(spark, d, "v_variants")).select(*KEY, "Locus")


@query("build_cdna_name", "SELECT row_key, MANE_SELECT || nullif(regexp_extract(HGVSc, '\\w*(:c\\..*)', 1), '') AS CDNA_NAME FROM {v_wide}")
def _(spark, d):
    return R.build_cdna_name(table(spark, d, "v_wide")).select(*KEY, "CDNA_NAME")


@query("recode_genotypes", f"SELECT row_key, {_GT3} FROM {{v_wide}}")
def _(spark, d):
    return R.recode_genotypes(table(spark, d, "v_wide")).select(*KEY, *(f"GT_S{i}" for i in range(3)))


@query("remove_columns", "SELECT row_key, CHROM, POS, REF, ALT FROM {v_variants}")
def _(spark, d):
    kept = R.remove_columns(table(spark, d, "v_variants"), "^(AF_|QUAL|SYMBOL|IMPACT)")
    return R.remove_columns(kept, ["Gene", "Feature", "Consequence", "splice_score", "MANE_SELECT", "SpliceAI", "l_orderkey", "l_linenumber", "not_there"])


@query("order_columns", "SELECT SYMBOL, POS, GT_S0, GT_S1, GT_S2, GQ_S0, GQ_S1, GQ_S2, row_key FROM {v_wide}")
def _(spark, d):
    rows = table(spark, d, "v_wide").select(*KEY, "GQ_S0", "GQ_S1", "GQ_S2", "GT_S0", "GT_S1", "GT_S2", "POS", "SYMBOL")
    return R.order_columns(rows, ["SYMBOL", "POS", "not_there"])


@query("order_clinical_columns", "SELECT SYMBOL, row_key, REVEL_score, GT_S0 FROM {v_wide}")
def _(spark, d):
    return R.order_clinical_columns(table(spark, d, "v_wide").select("GT_S0", "REVEL_score", *KEY, "SYMBOL"), ["SYMBOL"], ["REVEL_score"])


@query("filter_variant_quality", "SELECT row_key, QUAL_seen FROM {v_wide} WHERE QUAL_seen >= 20")
def _(spark, d):
    return R.filter_variant_quality(table(spark, d, "v_wide"), 20, "QUAL_seen").select(*KEY, "QUAL_seen")


@query("filter_genotype_quality", "SELECT row_key, GT_S0 || CASE WHEN GQ_S0 < 30 THEN '_LOWQUAL' ELSE '' END AS GT_S0, GT_S1 || CASE WHEN GQ_S1 < 30 THEN '_LOWQUAL' ELSE '' END AS GT_S1 FROM {v_wide} WHERE greatest(GQ_S0, GQ_S1, GQ_S2) >= 30")
def _(spark, d):
    return R.filter_genotype_quality(table(spark, d, "v_wide"), 30).select(*KEY, "GT_S0", "GT_S1")


@query("tag_low_gq", "SELECT row_key, GT_S2 || CASE WHEN GQ_S2 < 10 THEN '_LOWQUAL' ELSE '' END AS GT_S2 FROM {v_wide}")
def _(spark, d):
    return R.tag_low_gq(table(spark, d, "v_wide"), 10).select(*KEY, "GT_S2")


@query("select_samples", "SELECT row_key FROM {v_wide} WHERE NOT (GT_S1 = '0/0' AND GT_S2 = '0/0') AND NOT (GT_S1 = '.' AND GT_S2 = '.')")
def _(spark, d):
    return R.select_samples(table(spark, d, "v_wide"), ["GT_S1", "GT_S2", "GT_none"]).select(*KEY)


@query("filter_phenotype", f"SELECT row_key FROM (SELECT row_key, {_GT3} FROM {{v_wide}}) t WHERE GT_S0 IN ('HET','HOMALT') AND GT_S2 IN ('HET','HOMALT')")
def _(spark, d):
    return R.filter_phenotype(R.recode_genotypes(table(spark, d, "v_wide")), ["S0", "S2"]).select(*KEY)


@query("sequence_resolved_only", "SELECT p_partkey, al FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '<CNV>' WHEN 1 THEN 'A[chr1:5[' WHEN 2 THEN '*' WHEN 3 THEN 'ACN' ELSE 'g' END AS al FROM part) t WHERE regexp_matches(al, '^[ACGTNacgtn]+$')")
def _(spark, d):
    rows = table(spark, d, "part").selectExpr("p_partkey", "CASE p_partkey % 5 WHEN 0 THEN '<CNV>' WHEN 1 THEN 'A[chr1:5[' WHEN 2 THEN '*' WHEN 3 THEN 'ACN' ELSE 'g' END AS ALT", "'A' AS REF")
    return R.sequence_resolved_only(rows).select("p_partkey", F.col("ALT").alias("al"))


@query("split_by_allele_length", "SELECT doc_id, (length(text) >= 1000 OR length(lang) >= 1000) AS is_long FROM documents")
def _(spark, d):
    return table(spark, d, "documents").selectExpr("doc_id", "text AS REF", "lang AS ALT").select("doc_id", R.long_allele().alias("is_long"))


@query("has_alt_carrier", "SELECT row_key FROM {v_wide} WHERE regexp_matches(GT_S0, '[1-9]') OR regexp_matches(GT_S1, '[1-9]') OR regexp_matches(GT_S2, '[1-9]')")
def _(spark, d):
    return R.has_alt_carrier(table(spark, d, "v_wide")).select(*KEY)


@query("scan_text_corruption", """WITH c AS (SELECT 'source' AS "column", source AS value FROM documents UNION ALL SELECT 'lang', lang FROM documents),
 h AS (SELECT "column", pattern, value, count(*) AS n FROM c, (SELECT unnest(['c1', 'e', '.']) AS pattern) p WHERE contains(value, pattern) GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY "column", pattern ORDER BY value) AS nth FROM h)
 SELECT "column", pattern, CAST(sum(n) AS BIGINT) AS n_rows, string_agg(value, '; ' ORDER BY value) FILTER (nth <= 3) AS examples FROM r GROUP BY 1, 2""")
def _(spark, d):
    return R.text_findings(table(spark, d, "documents"), ["source", "lang"], ["c1", "e", "."])


@query("qc_status", """SELECT row_key, CASE WHEN NOT scored THEN 'UNSCORED' WHEN det <> '' THEN 'LOW_QUAL' ELSE 'PASS' END AS QC_STATUS,
 CASE WHEN NOT scored THEN 'No raw caller quality metrics present in VCF' WHEN det <> '' THEN det ELSE 'Passed all available caller quality metrics' END AS QC_DETAIL
 FROM (SELECT *, concat_ws('; ', CASE WHEN FILTER NOT IN ('.', 'PASS') THEN 'FILTER=' || FILTER END, CASE WHEN q < 30 THEN 'QUAL=' || printf('%.1f', q) || '<30' END, CASE WHEN QD < 2 THEN 'QD=' || printf('%.1f', QD) || '<2.0' END,
  CASE WHEN FS > 60 THEN 'FS=' || printf('%.1f', FS) || '>60' END, CASE WHEN MQ < 40 THEN 'MQ=' || printf('%.1f', MQ) || '<40' END) AS det,
  (q IS NOT NULL OR QD IS NOT NULL OR FS IS NOT NULL OR MQ IS NOT NULL OR coalesce(FILTER, '.') <> '.') AS scored FROM (SELECT *, CAST(QUAL_seen AS DOUBLE) AS q FROM {v_wide}) a) t""")
def _(spark, d):
    rows = table(spark, d, "v_wide").drop("QUAL").withColumnRenamed("QUAL_seen", "QUAL")
    return R.qc_status(rows).select(*KEY, "QC_STATUS", "QC_DETAIL")


@query("scalar_text", """SELECT row_key, split_part(Feature, '.', 1) AS base, ALT AS alt, split_part(CHROM, 'chr', 2) AS bare, reverse(translate(REF || ALT, 'ACGT', 'TGCA')) AS rc,
 CASE WHEN length(HGVSc) > 20 THEN substr(HGVSc, 1, 17) || '...' ELSE HGVSc END AS short, CAST(POS AS STRING) AS pos FROM {v_wide}""")
def _(spark, d):
    rows = R.build_locus(table(spark, d, "v_wide"))
    return rows.select(*KEY, V.strip_version(F.col("Feature")).alias("base"), V.alt_from_locus(F.col("Locus")).alias("alt"), V.bare_chrom(V.chr_chrom(F.col("CHROM"))).alias("bare"), V.reverse_complement(F.concat("REF", "ALT")).alias("rc"), V.truncate(F.col("HGVSc"), 20).alias("short"), V.locus_parts(F.col("Locus"))["pos"].alias("pos"))


@query("scalar_fold", "SELECT doc_id, regexp_replace(strip_accents(regexp_replace(text, 'ß', 'ss', 'g')), '[\\s;=,]', '_', 'g') AS folded FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", V.fold_accents(F.regexp_replace("text", "ß", "ss")).alias("folded"))


@query("intron_offset", """SELECT row_key, off AS intron_offset_signed, CASE WHEN off > 0 THEN 'donor' WHEN off < 0 THEN 'acceptor' ELSE 'exonic' END AS splice_side FROM (
 SELECT row_key, CAST(CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN l_orderkey % 40 + 1 WHEN 2 THEN -(l_orderkey % 60 + 1) ELSE 2 END AS INT) AS off FROM {v_wide}) t""")
def _(spark, d):
    from varlake.operators.splicing import intron_offsets

    return intron_offsets(table(spark, d, "v_wide")).select(*KEY, "intron_offset_signed", "splice_side")


@query("scalar_time_size", """SELECT name, realtime, h * 3600000 + m * 60000 + s * 1000 AS ms, CAST(split_part(peak_rss, ' ', 1) AS BIGINT) * 1073741824 AS bytes,
 CAST(h + m // 60 AS STRING) || 'h ' || lpad(CAST(m % 60 AS STRING), 2, '0') || 'm ' || lpad(CAST(s AS STRING), 2, '0') || 's' AS clock
 FROM (SELECT *, CAST(split_part(realtime, 'h', 1) AS BIGINT) AS h, CAST(split_part(split_part(realtime, ' ', 2), 'm', 1) AS BIGINT) AS m, CAST(split_part(split_part(realtime, ' ', 3), 's', 1) AS BIGINT) AS s FROM {v_tasks}) t""")
def _(spark, d):
    ms = V.duration_ms(F.col("realtime"))
    return table(spark, d, "v_tasks").select("name", "realtime", ms.alias("ms"), V.size_bytes(F.col("peak_rss")).alias("bytes"), V.clock(ms / 1000).alias("clock"))


@query("provenance_identity", "SELECT c_custkey, substr(sha256('nation=' || CAST(c_nationkey AS STRING) || chr(10) || 'segment=' || c_mktsegment), 1, 16) AS version_id FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", V.identity({"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey")}).alias("version_id"))


@query("provenance_difference", "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderpriority <> '1-URGENT' THEN 'priority' END, CASE WHEN o_orderstatus <> 'O' THEN 'status' END, 'who') AS changed FROM orders")
def _(spark, d):
    rows = table(spark, d, "orders")
    now = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"))
    then = F.create_map(F.lit("status"), F.lit("O"), F.lit("priority"), F.lit("1-URGENT"), F.lit("who"), F.lit("x"))
    return rows.select("o_orderkey", F.array_join(V.map_difference(now, then), ",").alias("changed"))


@query("terms_superset", "SELECT row_key, (ClinVarVCF_CLNSIG IS NOT NULL AND list_has_all(string_split(ClinVarVCF_CLNSIG || '&pathogenic', '&'), string_split(CLIN_SIG, '&'))) AS contained FROM {v_wide}")
def _(spark, d):
    new = F.split(F.concat("ClinVarVCF_CLNSIG", F.lit("&pathogenic")), "&")
    return table(spark, d, "v_wide").select(*KEY, F.coalesce(V.contains_all(new, F.split("CLIN_SIG", "&")), F.lit(False)).alias("contained"))


@query("scalar_key_values", "SELECT row_key, regexp_extract(utr5_annotation, 'KozakStrength=([^:]*)', 1) AS kozak, regexp_extract(utr5_annotation, 'alt_type=([^:]*)', 1) AS alt_type FROM {v_wide}")
def _(spark, d):
    rows_ = V.once(table(spark, d, "v_wide").select(*KEY, "utr5_annotation"), {"fields": V.key_values(F.col("utr5_annotation"))})
    return rows_.select(*KEY, F.col("fields")["KozakStrength"].alias("kozak"), F.col("fields")["alt_type"].alias("alt_type"))
