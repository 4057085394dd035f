"""Queries of status columns, predictors, scores and families."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.operators import reports as P
from varlake.operators import family, rows, scores, splicing, status
from varlake.plans.registry import KEY, query
from varlake.plans.views import table

K = "row_key"
_AF = "AF_grpmax AS gnomADv4_AF_grpmax_joint, AF_joint AS gnomADv4_AF_joint, CAST(NULL AS STRING) AS gnomADv4_AN_joint"
_AF_SQL = """SELECT *, CASE WHEN AF_grpmax BETWEEN 0 AND 1 THEN AF_grpmax WHEN AF_joint BETWEEN 0 AND 1 THEN AF_joint END AS pop_af,
 CASE WHEN AF_grpmax BETWEEN 0 AND 1 THEN 'gnomADv4_AF_grpmax_joint' WHEN AF_joint BETWEEN 0 AND 1 THEN 'gnomADv4_AF_joint' ELSE '' END AS pop_source,
 CASE WHEN AF_grpmax BETWEEN 0 AND 1 OR AF_joint BETWEEN 0 AND 1 THEN 'available_frequency' WHEN AF_grpmax IS NOT NULL OR AF_joint IS NOT NULL THEN 'invalid_frequency' WHEN AF_joint IS NULL THEN 'absent_from_gnomad' ELSE 'missing_frequency' END AS pop_status FROM {v_wide}"""


def _af(spark, d):
    return table(spark, d, "v_wide").selectExpr("*", *_AF.split(", "))


@query("resolve_population_af", f"SELECT {K}, pop_af AS POPULATION_AF, pop_source AS POPULATION_AF_SOURCE, pop_status AS POPULATION_AF_STATUS FROM ({_AF_SQL}) t")
def _(spark, d):
    return status.resolve_population_af(_af(spark, d)).select(*KEY, "POPULATION_AF", "POPULATION_AF_SOURCE", "POPULATION_AF_STATUS")


@query("filter_frequency", f"SELECT {K}, pop_af AS POPULATION_AF FROM ({_AF_SQL}) t WHERE pop_status = 'absent_from_gnomad' OR pop_af IS NULL OR pop_af < 0.0005")
def _(spark, d):
    return status.filter_frequency(_af(spark, d), 0.0005).select(*KEY, "POPULATION_AF")


_CLINVAR = """SELECT *, CASE WHEN coalesce(ClinVarVCF_CLNSIG, '.') <> '.' THEN ClinVarVCF_CLNSIG WHEN CLIN_SIG <> '' THEN CLIN_SIG ELSE '' END AS sig,
 CASE WHEN coalesce(ClinVarVCF_CLNSIG, '.') <> '.' THEN 0 WHEN CLIN_SIG <> '' THEN 2 ELSE 8 END AS rk,
 CASE WHEN coalesce(ClinVarVCF_CLNSIG, '.') <> '.' THEN 'ClinVarVCF_CLNSIG' WHEN CLIN_SIG <> '' THEN 'CLIN_SIG' ELSE '' END AS src,
 CASE WHEN coalesce(ClinVarVCF_CLNSIG, '.') <> '.' AND ClinVarVCF_CLNREVSTAT <> '.' THEN ClinVarVCF_CLNREVSTAT ELSE '' END AS rev,
 CASE WHEN coalesce(ClinVarVCF_CLNSIG, '.') <> '.' THEN CAST(CASE l_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS DOUBLE) END AS st FROM {v_wide}"""


@query("resolve_clinvar", f"SELECT {K}, sig AS CLINVAR_SELECTED_CLNSIG, src AS CLINVAR_SOURCE, rev AS CLINVAR_SELECTED_REVIEW, st AS ClinVar_Stars FROM ({_CLINVAR}) t")
def _(spark, d):
    return status.annotate_clinvar(table(spark, d, "v_wide")).select(*KEY, "CLINVAR_SELECTED_CLNSIG", "CLINVAR_SOURCE", "CLINVAR_SELECTED_REVIEW", "ClinVar_Stars")


# part keys as variants: many rows of each, with sources of different rank
@query("best_source_per_variant", f"""WITH c AS (SELECT *, SYMBOL || '-' || CHROM AS var FROM ({_CLINVAR}) a),
 b AS (SELECT var, min(struct_pack(rk := rk, a := row_key, sig := sig, src := src, rev := rev)) AS m FROM c WHERE rk < 8 GROUP BY var)
 SELECT {K}, CASE WHEN m.rk < c.rk THEN m.sig ELSE c.sig END AS CLINVAR_SELECTED_CLNSIG, CASE WHEN m.rk < c.rk THEN m.src ELSE c.src END AS CLINVAR_SOURCE, CASE WHEN m.rk < c.rk THEN m.rev ELSE c.rev END AS CLINVAR_SELECTED_REVIEW FROM c LEFT JOIN b USING (var)""")
def _(spark, d):
    rows_ = table(spark, d, "v_wide").withColumn("Locus", F.concat_ws("-", "SYMBOL", "CHROM"))
    return status.annotate_clinvar(rows_, KEY).select(*KEY, "CLINVAR_SELECTED_CLNSIG", "CLINVAR_SOURCE", "CLINVAR_SELECTED_REVIEW")


@query("clinvar_masks", f"""SELECT {K}, path AND NOT con AS pathogenic, ben AND NOT con AS benign FROM (SELECT *, (path AND ben) OR contains(low, 'conflicting') OR contains(low, 'uncertain significance') AS con FROM (
 SELECT *, list_has_any(toks, ['pathogenic', 'likely pathogenic']) AS path, list_has_any(toks, ['benign', 'likely benign']) AS ben FROM (
 SELECT *, string_split_regex(low, '[&/|;,]') AS toks FROM (SELECT {K}, replace(lower(CASE WHEN ClinVarVCF_CLNSIG = '.' OR ClinVarVCF_CLNSIG IS NULL THEN CLIN_SIG ELSE ClinVarVCF_CLNSIG END), '_', ' ') AS low FROM {{v_wide}}) a) b) c) e""")
def _(spark, d):
    rows_ = status.annotate_clinvar(table(spark, d, "v_wide"))
    pathogenic, benign = status.clinvar_masks(F.col("CLINVAR_SELECTED_CLNSIG"))
    return rows_.select(*KEY, pathogenic.alias("pathogenic"), benign.alias("benign"))


@query("nmd_status", f"""SELECT {K}, CASE WHEN sc AND NMD IS NOT NULL THEN 'escape_predicted' WHEN tr AND CDS_position <> '' AND NOT contains(CDS_position, '?') THEN 'nmd_predicted' WHEN sc THEN 'not_evaluated' ELSE 'not_applicable' END AS NMD_STATUS
 FROM (SELECT *, Consequence IN ('stop_gained', 'frameshift_variant') AS tr, Consequence IN ('stop_gained', 'frameshift_variant', 'splice_donor_variant') AS sc FROM {{v_wide}}) t""")
def _(spark, d):
    return status.nmd_status(table(spark, d, "v_wide")).select(*KEY, "NMD_STATUS")


_TRACK = "SELECT {k}, CASE WHEN snv THEN num END AS {out}, CASE WHEN NOT snv THEN 'not_applicable' WHEN ReMM = '.' THEN 'not_covered' WHEN num IS NULL THEN 'error' ELSE 'scored' END AS {st} FROM (SELECT *, VARIANT_CLASS = 'SNV' AS snv, TRY_CAST(ReMM AS DOUBLE) AS num FROM {{v_wide}}) t"


@query("remm_status", _TRACK.format(k=K, out="ReMM_score", st="ReMM_status"))
def _(spark, d):
    return status.remm_status(table(spark, d, "v_wide")).select(*KEY, "ReMM_score", "ReMM_status")


@query("avi_status", _TRACK.format(k=K, out="AVI_PHRED", st="AVI_status"))
def _(spark, d):
    return status.avi_status(table(spark, d, "v_wide").withColumn("AVI_PHRED", F.col("ReMM"))).select(*KEY, "AVI_PHRED", "AVI_status")


@query("missense_max", f"SELECT {K}, list_max(list_filter(list_transform(string_split(REVEL_list, '&'), lambda x: TRY_CAST(x AS DOUBLE)), lambda x: x IS NOT NULL)) AS REVEL_list FROM {{v_wide}}")
def _(spark, d):
    return status.missense_max(table(spark, d, "v_wide"), ["REVEL_list"]).select(*KEY, "REVEL_list")


@query("aligned_list_pick", f"""SELECT {K}, CASE WHEN n = 2 AND px > 0 AND it[px] <> '.' THEN it[px] WHEN n = 1 AND px > 0 AND it[1] <> '.' THEN it[1] END AS REVEL_list,
 list_max(list_filter(list_transform(it, lambda x: TRY_CAST(x AS DOUBLE)), lambda x: x IS NOT NULL)) AS REVEL_list_anytranscript_max,
 CASE WHEN px = 0 THEN 'no_entry_for_row_transcript' WHEN n NOT IN (1, 2) THEN 'misaligned_list' ELSE 'matched_transcript' END AS dbNSFP_match FROM (
 SELECT *, string_split(REVEL_list, '&') AS it, len(string_split(REVEL_list, '&')) AS n, coalesce(list_position(list_transform(string_split(Ensembl_transcriptid, '&'), lambda x: split_part(x, '.', 1)), split_part(Feature, '.', 1)), 0) AS px FROM {{v_wide}}) t""")
def _(spark, d):
    return status.aligned_list_pick(table(spark, d, "v_wide"), ["REVEL_list"], ["REVEL_list"]).select(*KEY, "REVEL_list", "REVEL_list_anytranscript_max", "dbNSFP_match")


_UTR = """CASE l_orderkey % 4 WHEN 0 THEN CASE WHEN l_orderkey % 2 = 0 THEN CASE WHEN l_linenumber % 3 = 1 THEN 'other' ELSE 'high_impact' END ELSE 'other' END
 WHEN 1 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'other' WHEN l_linenumber % 3 = 1 THEN 'other' ELSE 'high_impact' END
 WHEN 2 THEN CASE WHEN l_linenumber % 3 = 1 THEN 'other' ELSE 'high_impact' END ELSE CASE WHEN Consequence = '5_prime_UTR_variant' THEN 'not_evaluated' ELSE 'not_applicable' END END"""


@query("utr5_status", f"SELECT {K}, {_UTR} AS UTRAnnotator_status FROM {{v_wide}}")
def _(spark, d):
    return status.utr5_status(table(spark, d, "v_wide"), "utr5_consequence", "utr5_annotation").select(*KEY, "UTRAnnotator_status")


@query("tag_transcript_tier", f"""SELECT {K}, CASE WHEN p_partkey IS NOT NULL THEN 1 WHEN MANE_SELECT IS NOT NULL THEN 2 ELSE 3 END AS TRANSCRIPT_PRIORITY_TIER
 FROM {{v_wide}} v LEFT JOIN (SELECT p_partkey, 'ENST' || lpad(CAST(p_partkey AS STRING), 11, '0') AS enst FROM part WHERE p_partkey % 10 = 1) c ON split_part(v.Feature, '.', 1) = c.enst""")
def _(spark, d):
    curated = table(spark, d, "part").where("p_partkey % 10 = 1").selectExpr("'ENST' || lpad(CAST(p_partkey AS STRING), 11, '0') || '.9' AS ENST")
    return status.tag_transcript_tier(table(spark, d, "v_wide"), curated).select(*KEY, "TRANSCRIPT_PRIORITY_TIER")


_PANG = """SELECT *, CASE WHEN coalesce(Pangolin, '.') = '.' THEN NULL ELSE greatest(CAST('0.' || CAST(l_orderkey % 90 + 10 AS STRING) AS DOUBLE), CAST('0.' || CAST(l_linenumber % 9 + 1 AS STRING) AS DOUBLE)) END AS own FROM {v_wide}"""


@query("pangolin_unpack", f"""SELECT {K}, own AS Pangolin_max_score, CASE WHEN own IS NULL THEN 'not_covered' ELSE 'scored' END AS Pangolin_status, CASE WHEN own IS NULL THEN 'no_prediction' ELSE 'matched' END AS Pangolin_match,
 CASE WHEN own IS NOT NULL THEN greatest(own, 0.5) END AS Pangolin_anygene_max FROM ({_PANG}) t""")
def _(spark, d):
    return splicing.pangolin_unpack(table(spark, d, "v_wide")).select(*KEY, "Pangolin_max_score", "Pangolin_status", "Pangolin_match", "Pangolin_anygene_max")


def _edges(spark, d):
    """Alias edges (symbol, ensg, tier) and the coordinate route, which knows every third symbol."""
    a = table(spark, d, "v_alias")
    lists = a.select(F.explode(F.concat(F.array("prev_symbol"), F.split("alias_symbol", "\\|"))).alias("symbol"), F.col("ensembl_gene_id").alias("ensg"), F.lit(1).alias("tier"))
    edges = a.select("symbol", F.col("ensembl_gene_id").alias("ensg"), F.lit(0).alias("tier")).union(lists).distinct()
    return edges, edges.where("tier = 0 AND CAST(substr(symbol, 2) AS INT) % 3 = 0").select("symbol", "ensg")


_ALIAS = """edges AS (SELECT DISTINCT symbol, ensembl_gene_id AS ensg, 0 AS tier FROM {v_alias} UNION SELECT DISTINCT prev_symbol, ensembl_gene_id, 1 FROM {v_alias} UNION SELECT DISTINCT unnest(string_split(alias_symbol, '|')), ensembl_gene_id, 1 FROM {v_alias}),
 genes AS (SELECT symbol, CASE WHEN count(*) FILTER (tier = 0) > 0 THEN list(DISTINCT ensg) FILTER (tier = 0) ELSE list(DISTINCT ensg) FILTER (tier = 1) END AS g FROM edges GROUP BY symbol),
 places AS (SELECT symbol, max(ensg) AS pl FROM edges WHERE tier = 0 AND CAST(substr(symbol, 2) AS INT) % 3 = 0 GROUP BY symbol),
 res AS (SELECT s.symbol, CASE WHEN pl IS NOT NULL THEN CASE WHEN g IS NULL OR list_contains(g, pl) THEN pl END WHEN len(g) = 1 THEN g[1] END AS gene, pl, coalesce(len(g), 0) AS n FROM syms s LEFT JOIN genes USING (symbol) LEFT JOIN places USING (symbol)),
 resolved AS (SELECT symbol, gene, CASE WHEN gene IS NOT NULL THEN 'alias_resolved' WHEN pl IS NOT NULL OR n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS st FROM res)"""
_SYMS = "CASE p_partkey % 4 WHEN 0 THEN 'G' || CAST(p_partkey % 60 AS STRING) WHEN 1 THEN 'OLD' || CAST(p_partkey % 80 AS STRING) WHEN 2 THEN 'ALT' || CAST(p_partkey % 45 AS STRING) ELSE 'NONE' END"


@query("resolve_symbol_two_routes", f"WITH syms AS (SELECT DISTINCT {_SYMS} AS symbol FROM part), {_ALIAS} SELECT p_partkey, p.symbol, gene AS resolved_gene, st AS resolve_status FROM (SELECT p_partkey, {_SYMS} AS symbol FROM part) p JOIN resolved USING (symbol)")
def _(spark, d):
    edges, places = _edges(spark, d)
    return splicing.resolve_symbol(table(spark, d, "part").selectExpr("p_partkey", f"{_SYMS} AS symbol"), "symbol", places, edges)


@query("symbol_is_row_gene", f"WITH edges AS (SELECT DISTINCT symbol, ensembl_gene_id AS ensg FROM {{v_alias}} UNION SELECT DISTINCT prev_symbol, ensembl_gene_id FROM {{v_alias}}) SELECT p_partkey, (p.symbol = 'G' || CAST(p_partkey % 7 AS STRING) OR e.ensg IS NOT NULL) AS is_row_gene FROM (SELECT p_partkey, {_SYMS} AS symbol, 'ENSG' || lpad(CAST(p_partkey % 50 AS STRING), 11, '0') AS gene FROM part) p LEFT JOIN edges e ON e.symbol = p.symbol AND e.ensg = p.gene")
def _(spark, d):
    a = table(spark, d, "v_alias")
    edges = a.select("symbol", F.col("ensembl_gene_id").alias("gene")).union(a.select("prev_symbol", "ensembl_gene_id"))
    rows_ = table(spark, d, "part").selectExpr("p_partkey", f"{_SYMS} AS symbol", "'ENSG' || lpad(CAST(p_partkey % 50 AS STRING), 11, '0') AS gene", "'G' || CAST(p_partkey % 7 AS STRING) AS own")
    return P.symbol_is_row_gene(rows_, edges).select("p_partkey", "is_row_gene")


_ENTRIES = """ent AS (SELECT row_key, SYMBOL AS own, ALT, split_part(Gene, '.', 1) AS row_gene, unnest(string_split(SpliceAI, '&')) AS e, generate_subscripts(string_split(SpliceAI, '&'), 1) AS ord FROM {v_wide} WHERE SpliceAI IS NOT NULL),
 syms AS (SELECT DISTINCT split_part(e, '|', 2) AS symbol FROM ent)"""


@query("spliceai_unpack", f"""WITH {_ENTRIES}, {_ALIAS}, sc AS (SELECT ent.*, list_max([TRY_CAST(split_part(e, '|', 3) AS DOUBLE), TRY_CAST(split_part(e, '|', 4) AS DOUBLE), TRY_CAST(split_part(e, '|', 5) AS DOUBLE), TRY_CAST(split_part(e, '|', 6) AS DOUBLE)]) AS mx,
 CASE WHEN symbol = own THEN 'matched' WHEN gene = row_gene THEN 'alias_resolved' END AS hit, st, symbol FROM ent JOIN resolved ON symbol = split_part(e, '|', 2) WHERE split_part(e, '|', 1) = ALT),
 ag AS (SELECT row_key, min(struct_pack(ord := ord, hit := hit, mx := mx, symbol := symbol)) FILTER (hit IS NOT NULL) AS h, max(mx) AS any_mx, max(CASE st WHEN 'ambiguous' THEN 2 WHEN 'unresolved' THEN 1 ELSE 0 END) AS worst FROM sc GROUP BY 1)
 SELECT v.row_key, h.symbol AS spliceai_custom_SYMBOL, h.mx AS "spliceai_custom_MAX", CASE WHEN v.SpliceAI IS NULL THEN 'no_prediction' WHEN h IS NOT NULL THEN h.hit WHEN worst = 2 THEN 'ambiguous' WHEN worst = 1 THEN 'unresolved' ELSE 'no_entry_for_row_gene' END AS spliceai_custom_match, any_mx AS "spliceai_custom_anygene_MAX"
 FROM {{v_wide}} v LEFT JOIN ag USING (row_key)""")
def _(spark, d):
    edges, places = _edges(spark, d)
    return splicing.spliceai_unpack(table(spark, d, "v_wide"), KEY, places, edges).select(*KEY, "spliceai_custom_SYMBOL", "spliceai_custom_MAX", "spliceai_custom_match", "spliceai_custom_anygene_MAX")


@query("pick_gene_entry", f"""WITH {_ENTRIES}, {_ALIAS}, sc AS (SELECT ent.*, CASE WHEN symbol = own THEN 'matched' WHEN gene = row_gene THEN 'alias_resolved' END AS hit, st FROM ent JOIN resolved ON symbol = split_part(e, '|', 2)),
 ag AS (SELECT row_key, min(struct_pack(ord := ord, hit := hit, e := e)) FILTER (hit IS NOT NULL) AS h, max(CASE st WHEN 'ambiguous' THEN 2 WHEN 'unresolved' THEN 1 ELSE 0 END) AS worst FROM sc GROUP BY 1)
 SELECT v.row_key, h.e AS entry, CASE WHEN h IS NOT NULL THEN h.hit WHEN worst = 2 THEN 'ambiguous' WHEN worst = 1 THEN 'unresolved' ELSE 'no_entry_for_row_gene' END AS "match" FROM {{v_wide}} v LEFT JOIN ag USING (row_key)""")
def _(spark, d):
    edges, places = _edges(spark, d)
    base = table(spark, d, "v_wide")
    entries = base.select(*KEY, "SYMBOL", F.col("Gene").alias("row_gene"), F.posexplode(F.split("SpliceAI", "&")).alias("ordinal", "entry")).withColumn("sym", F.split("entry", "\\|")[1])
    entries = splicing.resolve_symbol(entries, "sym", places, edges).withColumnRenamed("resolved_gene", "gene").withColumn("is_symbol", F.col("sym") == F.col("SYMBOL"))
    return splicing.pick_gene_entry(base.select(*KEY, F.col("Gene").alias("row_gene")), entries, KEY).select(*KEY, "entry", "match")


_SPIP = "ALT || '|x|Alter|[a - b]|0.' || CAST(l_orderkey % 90 + 10 AS STRING) || '|5|6|7|8|9|10|NM_' || CAST(CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey ELSE l_orderkey % 50 END AS STRING) || '.4|' || SYMBOL"


@query("spip_unpack", f"""SELECT {K}, CASE WHEN raw IS NOT NULL AND m <> '' THEN pred END AS SPiP_prediction, CASE WHEN raw IS NULL THEN 'no_prediction' WHEN acc IS NULL AND near IS NULL THEN 'not_applicable_transcript' WHEN m = '' THEN 'no_entry_for_row_gene' ELSE m END AS SPiP_match,
 CASE WHEN raw IS NOT NULL AND m <> '' AND pred >= 0.2 THEN 'complex_splicing' ELSE 'none' END AS SPiP_mechanism, CASE WHEN raw IS NOT NULL THEN pred END AS SPiP_samegene_prediction
 FROM (SELECT *, CASE WHEN acc = nm THEN 'matched' WHEN near = nm THEN 'matched_by_exon_structure' ELSE '' END AS m FROM (
 SELECT *, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE 1 END AS raw, CAST('0.' || CAST(l_orderkey % 90 + 10 AS STRING) AS DOUBLE) AS pred, 'NM_' || CAST(CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey ELSE l_orderkey % 50 END AS STRING) AS nm,
 MANE_SELECT AS acc, CASE WHEN CAST(substr(Feature, 5, 11) AS BIGINT) % 2 = 0 THEN 'NM_' || CAST(CAST(substr(Feature, 5, 11) AS BIGINT) % 50 AS STRING) END AS near FROM {{v_wide}}) a) t""")
def _(spark, d):
    rows_ = table(spark, d, "v_wide").withColumn("SPiP", F.expr(f"CASE WHEN l_linenumber % 5 <> 0 THEN {_SPIP} END"))
    structure = table(spark, d, "part").where("p_partkey % 2 = 0").selectExpr("'ENST' || lpad(CAST(p_partkey AS STRING), 11, '0') AS enst", "'NM_' || CAST(p_partkey % 50 AS STRING) || '.1' AS spip_nm")
    edges = table(spark, d, "v_alias").selectExpr("prev_symbol AS symbol", "ensembl_gene_id AS ensg").distinct()
    return splicing.spip_unpack(rows_, structure, edges).select(*KEY, "SPiP_prediction", "SPiP_match", "SPiP_mechanism", "SPiP_samegene_prediction")


@query("splicevault_decode", f"""SELECT {K}, CASE l_orderkey % 3 WHEN 1 THEN CASE WHEN site IS NULL THEN 'Not covered' ELSE 'No aberrant events detected in RNA-seq cohort' END
 WHEN 0 THEN 'Rank 1: Cryptic Donor (Cryptic Site at 12 bp upstream of the annotated splice site' || CASE WHEN site IS NULL THEN '' ELSE ' (pos:' || CAST(CASE WHEN POS % 2 = 1 THEN site + 12 ELSE site - 12 END AS STRING) || ')' END || '), 30% support, Frameshift; Rank 2: Exon Skipping (Exon 4 skipping), 8% support'
 ELSE 'Rank 1: Cryptic Acceptor (Cryptic Site at the annotated splice site), 12% support, in frame' END AS SpliceVault_Predictions_Decoded,
 CASE WHEN l_orderkey % 3 <> 1 THEN 'aberrant_event_detected' WHEN site IS NULL THEN 'not_covered' ELSE 'no_events_found' END AS SpliceVault_status FROM (SELECT *, CAST(SpliceVault_site_pos AS BIGINT) AS site FROM {{v_wide}}) t""")
def _(spark, d):
    return splicing.splicevault_decode(table(spark, d, "v_wide")).select(*KEY, "SpliceVault_Predictions_Decoded", "SpliceVault_status")


@query("labranchor_status", f"SELECT {K}, TRY_CAST(nullif(ReMM, '.') AS DOUBLE) AS LaBranchoR_score, CASE WHEN TRY_CAST(ReMM AS DOUBLE) IS NULL THEN 'not_covered' ELSE 'scored' END AS LaBranchoR_status, CASE WHEN l_linenumber % 3 = 0 THEN 'not_covered' ELSE 'scored' END AS LaBranchoR_ISM_status FROM {{v_wide}}")
def _(spark, d):
    rows_ = table(spark, d, "v_wide").withColumns({"LaBranchoR_score": F.col("ReMM"), "LaBranchoR_ISM_d_best": F.expr("CASE WHEN l_linenumber % 3 <> 0 THEN '0.25' END")})
    return splicing.labranchor_status(rows_).select(*KEY, "LaBranchoR_score", "LaBranchoR_status", "LaBranchoR_ISM_status")


@query("maxentscan", f"""SELECT {K}, dec AS MaxEntScan_pct_decrease, CASE WHEN dec >= 0.15 THEN 'YES' ELSE 'NO' END AS MaxEntScan_disrupted, CASE WHEN dec IS NULL THEN 'not_covered' ELSE 'scored' END AS MaxEntScan_status
 FROM (SELECT *, CASE WHEN MaxEntScan_ref > 0 THEN (MaxEntScan_ref - MaxEntScan_alt) / MaxEntScan_ref END AS dec FROM {{v_wide}}) t""")
def _(spark, d):
    return splicing.maxentscan(table(spark, d, "v_wide")).select(*KEY, "MaxEntScan_pct_decrease", "MaxEntScan_disrupted", "MaxEntScan_status")


_VEP = "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE splice_score END"


@query("splice_max", f"SELECT {K}, CASE WHEN {_VEP} BETWEEN 0 AND 1 OR AF_joint BETWEEN 0 AND 1 THEN greatest(coalesce({_VEP}, 0), coalesce(AF_joint, 0)) END AS \"spliceAI_MAX\", CASE WHEN {_VEP} IS NULL AND AF_joint IS NULL THEN 'not_covered' ELSE 'scored' END AS SpliceAI_status FROM {{v_wide}}")
def _(spark, d):
    rows_ = table(spark, d, "v_wide").withColumns({"SpliceAI_DS_AL": F.expr(_VEP), "SpliceAI_pred_DS_AG": F.col("AF_joint"), "SpliceAI_DS_DG": F.lit(7.5)})
    return splicing.splice_max(rows_).select(*KEY, "spliceAI_MAX", "SpliceAI_status")


@query("splice_unified", f"""SELECT {K}, coalesce(cu, {_VEP}) AS SPLICE_MAX_UNIFIED, CASE WHEN cu IS NOT NULL THEN 'Custom Window (-D 4999 / ~10kb)' WHEN {_VEP} IS NOT NULL THEN 'VEP Standard (~50bp)' ELSE 'Not Covered' END AS SPLICEAI_METHOD,
 CASE WHEN coalesce(cu, {_VEP}) IS NULL THEN 'not_covered' ELSE 'scored' END AS SPLICEAI_STATUS FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN AF_joint END AS cu FROM {{v_wide}}) t""")
def _(spark, d):
    rows_ = table(spark, d, "v_wide").withColumns({"spliceAI_MAX": F.expr(_VEP), "spliceai_custom_MAX": F.expr("CASE WHEN l_linenumber % 2 = 0 THEN AF_joint END")})
    return splicing.splice_unified(rows_).select(*KEY, "SPLICE_MAX_UNIFIED", "SPLICEAI_METHOD", "SPLICEAI_STATUS")


# --- scores over one prepared table

def _prepared(spark, d):
    out = _af(spark, d)
    out = status.utr5_status(splicing.splicevault_decode(status.annotate_clinvar(out)), "utr5_consequence", "utr5_annotation")
    out = out.withColumns({"spliceAI_MAX": F.expr(_VEP), "pLI_gene_value": F.expr("CAST(l_orderkey % 11 AS DOUBLE) / 10"), "GENE_TIER": F.expr("CASE l_orderkey % 13 WHEN 0 THEN 'Tier_C' WHEN 1 THEN 'Tier_D' ELSE 'Tier_A' END")})
    out = rows.qc_status(out.drop("QUAL").withColumnRenamed("QUAL_seen", "QUAL"))
    return status.resolve_population_af(splicing.pangolin_unpack(splicing.splice_unified(out)))


_PREPARED = f"""SELECT t.*, {_VEP} AS sp, coalesce(p.own, 0) AS pang, coalesce(t.REVEL_score, 0) AS rv, coalesce(t.am_pathogenicity, 0) AS am, l_orderkey % 3 <> 1 AS aber, {_UTR} = 'high_impact' AS utr, CAST(l_orderkey % 11 AS DOUBLE) / 10 AS pli,
 c.sig AS csig, coalesce(c.st, -1) AS cst, CASE WHEN pop_status = 'absent_from_gnomad' THEN 0.0 ELSE pop_af END AS rar, lower(Consequence) AS cons,
 (c.sig IN ('Pathogenic', 'likely_pathogenic')) AS path, (c.sig IN ('Likely_benign', 'Benign/Likely_benign')) AS ben,
 (l_orderkey % 5 <> 1) AND (l_orderkey % 5 = 2 OR QUAL_seen < 30 OR QD < 2 OR FS > 60 OR MQ < 40) AS lowq
 FROM ({_AF_SQL}) t JOIN (SELECT row_key, own FROM ({_PANG}) x) p USING (row_key) JOIN (SELECT row_key, sig, st FROM ({_CLINVAR}) y) c USING (row_key)"""
_IMPACT = f"""SELECT *, CASE WHEN path THEN 'HIGH' ELSE i4 END AS NEW_IMPACT FROM (SELECT *, CASE WHEN i3 IN ('LOW', 'MODIFIER') AND utr THEN 'MODERATE' ELSE i3 END AS i4 FROM (SELECT *, CASE WHEN am >= 0.564 AND rv >= 0.75 THEN 'HIGH' ELSE i2b END AS i3 FROM (
 SELECT *, CASE WHEN i2 IN ('LOW', 'MODIFIER') AND (am >= 0.564 OR rv >= 0.5) THEN 'MODERATE' ELSE i2 END AS i2b FROM (SELECT *, CASE WHEN coalesce(sp > 0.5, FALSE) OR pang >= 0.5 OR (aber AND coalesce(sp >= 0.2, FALSE)) THEN 'HIGH' ELSE i1 END AS i2 FROM (
 SELECT *, CASE WHEN IMPACT <> 'HIGH' AND (coalesce(sp > 0.2, FALSE) OR pang >= 0.2 OR aber) THEN 'MODERATE' ELSE IMPACT END AS i1 FROM ({_PREPARED}) a) b) c) e) f) g"""


@query("new_impact", f"SELECT {K}, NEW_IMPACT FROM ({_IMPACT}) t")
def _(spark, d):
    return scores.new_impact(_prepared(spark, d)).select(*KEY, "NEW_IMPACT")


@query("acmg_criteria", f"""SELECT {K}, CASE WHEN c = '' THEN 'Unclassified' ELSE c END AS ACMG_CRITERIA FROM (SELECT *, concat_ws(', ', CASE WHEN rar > 0.05 THEN 'BA1' WHEN rar > 0.01 THEN 'BS1' END,
 CASE WHEN regexp_matches(cons, 'stop_gained|frameshift|splice_donor|splice_acceptor') AND pli >= 0.9 THEN 'PVS1' END, CASE WHEN path AND contains(cons, 'missense') THEN 'PS1' END, CASE WHEN rar < 0.0001 THEN 'PM2_Supporting' END,
 CASE WHEN coalesce(sp >= 0.5, FALSE) OR am >= 0.564 OR rv >= 0.75 THEN 'PP3_Strong' END, CASE WHEN sp < 0.1 AND am > 0 AND am < 0.34 AND rv < 0.25 THEN 'BP4' END, CASE WHEN contains(cons, 'synonymous') AND sp < 0.1 THEN 'BP7' END) AS c FROM ({_PREPARED}) a) t""")
def _(spark, d):
    return scores.acmg_criteria(_prepared(spark, d)).select(*KEY, "ACMG_CRITERIA")


_SCORED = f"""SELECT *, round_even(greatest(0.0, least(100.0, CASE l_orderkey % 13 WHEN 0 THEN least(total, 45.0) WHEN 1 THEN least(total, 35.0) ELSE total END)), 1) AS sc FROM (
 SELECT *, (CASE WHEN lof THEN 35.0 ELSE 0.0 END) + greatest(coalesce(sp, 0.0), pang) * 30.0 + (CASE WHEN aber THEN 5.0 ELSE 0.0 END) + insil + (CASE WHEN utr THEN 20.0 ELSE 0.0 END) + (CASE WHEN pli >= 0.9 THEN 10.0 ELSE 0.0 END)
 + (CASE WHEN path AND cst >= 3 THEN 50.0 WHEN path THEN 45.0 ELSE 0.0 END) - (CASE WHEN ben THEN 40.0 ELSE 0.0 END) + (CASE WHEN ba1 THEN -100.0 WHEN bs1 THEN -25.0 WHEN pm2 THEN 15.0 ELSE 0.0 END) - (CASE WHEN lowq THEN 25.0 ELSE 0.0 END) AS total FROM (
 SELECT *, coalesce(rar >= 0.002, FALSE) AS ba1, coalesce(rar >= 0.0001 AND rar < 0.002, FALSE) AS bs1, coalesce(rar < 0.00004, FALSE) AS pm2, coalesce(lowq0, FALSE) AS lowq,
 CAST(CASE WHEN lof THEN 0 WHEN rv > 0 THEN CASE WHEN rv >= 0.932 THEN 25 WHEN rv >= 0.773 THEN 18 WHEN rv >= 0.644 THEN 10 WHEN rv < 0.183 THEN -15 WHEN rv <= 0.289 THEN -8 ELSE 0 END WHEN am > 0 THEN CASE WHEN am >= 0.75 THEN 18 WHEN am >= 0.564 THEN 10 WHEN am < 0.34 THEN -8 ELSE 0 END ELSE 0 END AS DOUBLE) AS insil FROM (
 SELECT * EXCLUDE (lowq), lowq AS lowq0, regexp_matches(cons, 'stop_gained|frameshift|splice_donor|splice_acceptor') AS lof FROM ({_IMPACT}) a) b) c) e"""


def _ranked(spark, d):
    return scores.priority(scores.new_impact(_prepared(spark, d)))


@query("priority_score", f"SELECT {K}, sc AS VARIANT_PRIORITY_SCORE FROM ({_SCORED}) t")
def _(spark, d):
    return _ranked(spark, d).select(*KEY, "VARIANT_PRIORITY_SCORE")


_TIER = f"""SELECT *, CASE WHEN NOT capped AND pm2 AND (sc >= 75 OR (lof AND pli >= 0.9) OR path OR (coalesce(sp >= 0.8, FALSE) AND (aber OR lof OR pli >= 0.9)) OR rv >= 0.932 OR (am >= 0.75 AND rv >= 0.773)) THEN 1
 WHEN NOT capped AND sig AND (sc >= 50 OR coalesce(sp >= 0.5, FALSE) OR pang >= 0.3 OR utr OR am >= 0.75 OR rv >= 0.773 OR lof) THEN 2 WHEN NOT ba1 AND sig AND (sc >= 25 OR bent) THEN 3 ELSE 4 END AS tier FROM (
 SELECT *, bent OR aber OR utr OR rv >= 0.25 OR am >= 0.34 OR lof OR path OR NEW_IMPACT IN ('MODERATE', 'HIGH') OR regexp_matches(cons, 'missense|splice|stop|frameshift|inframe|utr|5_prime|3_prime') AS sig, lowq OR l_orderkey % 13 IN (0, 1) OR ba1 OR bs1 AS capped FROM (
 SELECT *, coalesce(sp >= 0.2, FALSE) OR pang >= 0.2 AS bent FROM ({_SCORED}) a) b) c"""


@query("priority_tier", f"SELECT {K}, CASE tier WHEN 1 THEN 'Tier 1 (Critical Pathogenic Candidate)' WHEN 2 THEN 'Tier 2 (Likely Deleterious / Strong Candidate)' WHEN 3 THEN 'Tier 3 (VUS / Moderate Potential)' ELSE 'Tier 4 (Benign / Tolerated)' END AS PRIORITY_TIER FROM ({_TIER}) t")
def _(spark, d):
    return _ranked(spark, d).select(*KEY, "PRIORITY_TIER")


@query("score_explanation", f"""SELECT {K}, concat_ws(' | ', CASE WHEN lof THEN 'LoF (+35.0)' END, CASE WHEN aber THEN 'SpliceVault (+5.0)' END, CASE WHEN utr THEN 'UTR (+20.0)' END, CASE WHEN pli >= 0.9 THEN 'LoF-Intolerant (+10.0)' END,
 CASE WHEN path AND cst >= 3 THEN 'ClinVar Expert Panel / Practice Guideline Pathogenic (+50.0)' WHEN path THEN 'ClinVar Pathogenic (+45.0)' WHEN ben THEN 'ClinVar Benign (-40.0)' END) AS parts FROM ({_SCORED}) t""")
def _(spark, d):
    # parts with numbers in their text are left out: engines write doubles differently
    kept = F.filter(F.split("SCORE_EXPLANATION", " \\| "), lambda x: x.rlike("^(LoF|SpliceVault|UTR|LoF-Intolerant|ClinVar)"))
    return _ranked(spark, d).select(*KEY, F.array_join(kept, " | ").alias("parts"))


@query("tier_rationale", f"""SELECT {K}, CASE tier WHEN 1 THEN CASE WHEN path AND cst >= 3 THEN 'ClinGen VCEP' WHEN path THEN 'ClinVar Path' WHEN lof AND pli >= 0.9 THEN 'High-Confid' WHEN sp >= 0.8 THEN 'Ultra-High ' WHEN rv >= 0.932 THEN 'Strong Path' ELSE 'High-Priori' END
 WHEN 2 THEN CASE WHEN lof THEN 'Loss-of-Fun' WHEN sp >= 0.5 THEN 'High Splici' WHEN rv >= 0.773 OR am >= 0.75 THEN 'Moderate Pa' ELSE 'Strong Prio' END WHEN 3 THEN CASE WHEN bent THEN 'Moderate Sp' ELSE 'Moderate Pr' END
 ELSE CASE WHEN ba1 THEN 'Stand-Alone' WHEN bs1 THEN 'Strong Beni' WHEN ben THEN 'ClinVar Ben' ELSE 'Low Priorit' END END AS reason, lowq AS warned FROM ({_TIER}) t""".replace("'ClinGen VCEP'", "'ClinGen VCE'").replace("'ClinVar Path'", "'ClinVar Pat'"))
def _(spark, d):
    return _ranked(spark, d).select(*KEY, F.substring("TIER_RATIONALE", 1, 11).alias("reason"), F.contains(F.col("TIER_RATIONALE"), F.lit("LOW_QUAL Caller Warning")).alias("warned"))


def _fixed(value: str, digits: int) -> str:
    """A number as both engines write it: rounded half to even, then with so many digits."""
    return f"printf('%.{digits}f', round_even({value}, {digits}))"


_METHOD = "CASE WHEN sp IS NOT NULL THEN 'VEP Standard (~50bp)' ELSE 'Not Covered' END"
_QUALITY = f"""concat_ws('; ', CASE WHEN FILTER NOT IN ('.', 'PASS') THEN 'FILTER=' || FILTER END, CASE WHEN QUAL_seen < 30 THEN 'QUAL=' || {_fixed('CAST(QUAL_seen AS DOUBLE)', 1)} || '<30' END, CASE WHEN QD < 2 THEN 'QD=' || {_fixed('QD', 1)} || '<2.0' END,
 CASE WHEN FS > 60 THEN 'FS=' || {_fixed('FS', 1)} || '>60' END, CASE WHEN MQ < 40 THEN 'MQ=' || {_fixed('MQ', 1)} || '<40' END)"""
_BOTH_SPLICE = "greatest(coalesce(sp, 0.0), pang)"


@query("score_explanation_text", f"""SELECT {K}, CASE WHEN t = '' THEN 'Neutral Rarity / Benign' ELSE t END AS SCORE_EXPLANATION FROM (SELECT row_key, concat_ws(' | ', CASE WHEN lof THEN 'LoF (+35.0)' END,
 CASE WHEN {_BOTH_SPLICE} > 0.05 THEN 'Splicing (+' || {_fixed(_BOTH_SPLICE + ' * 30', 1)} || CASE WHEN sp IS NOT NULL THEN ', SpliceAI ' || {_fixed('sp', 2)} || ' via VEP Standard ~50bp' ELSE '' END || ')' END,
 CASE WHEN aber THEN 'SpliceVault (+5.0)' END, CASE WHEN insil > 0 THEN 'InSilico PP3 (+' || {_fixed('insil', 1)} || ')' WHEN insil < 0 THEN 'InSilico BP4 (' || {_fixed('insil', 1)} || ')' END,
 CASE WHEN utr THEN 'UTR (+20.0)' END, CASE WHEN pli >= 0.9 THEN 'LoF-Intolerant (+10.0)' END,
 CASE WHEN path AND cst >= 3 THEN 'ClinVar Expert Panel / Practice Guideline Pathogenic (+50.0)' WHEN path THEN 'ClinVar Pathogenic (+45.0)' WHEN ben THEN 'ClinVar Benign (-40.0)' END,
 CASE WHEN pop_status = 'absent_from_gnomad' THEN 'PM2_Supporting absent from gnomAD v4 (+15.0)' WHEN pop_af IS NULL THEN 'Population AF unknown (no frequency evidence)' WHEN ba1 THEN 'BA1 Exceeds FAF_PopMax Threshold (Terminal Tier 4)' WHEN bs1 THEN 'BS1_Strong AF > FAF_BS1 (-25.0)' WHEN pm2 THEN 'PM2_Supporting AF < MCAF (+15.0)' END,
 CASE WHEN lowq THEN 'Low Quality Caller Metric (-25.0, ' || {_QUALITY} || ')' END) AS t FROM ({_SCORED}) s) x""")
def _(spark, d):
    return _ranked(spark, d).select(*KEY, "SCORE_EXPLANATION")


_COMPOSITE = f"Composite Score (' || {_fixed('sc', 1)} || '/100"


@query("tier_rationale_text", f"""SELECT {K}, CASE tier WHEN 1 THEN CASE WHEN path AND cst >= 3 THEN 'ClinGen VCEP Pathogenic / Likely Pathogenic Expert Entry' WHEN path THEN 'ClinVar Pathogenic / Likely Pathogenic Entry'
  WHEN lof AND pli >= 0.9 THEN 'High-Confidence Loss-of-Function in Constrained Gene (pLI = ' || {_fixed('pli', 2)} || ' >= 0.90)' WHEN sp >= 0.8 THEN 'Ultra-High Splicing Alteration (SpliceAI = ' || {_fixed('sp', 2)} || ' >= 0.80 via ' || {_METHOD} || ')'
  WHEN rv >= 0.932 THEN 'Strong Pathogenic Missense (REVEL = ' || {_fixed('rv', 3)} || ' >= 0.932, PP3_Strong)' ELSE 'High-Priority {_COMPOSITE} >= 75.0) & Ultra-Rare Population Frequency (AF < MCAF)' END
 WHEN 2 THEN CASE WHEN lof THEN 'Loss-of-Function Alteration' || CASE WHEN pop_status = 'absent_from_gnomad' THEN ' (absent from gnomAD v4)' WHEN pop_af IS NOT NULL THEN ' (AF = ' || {_fixed('pop_af', 4)} || ')' ELSE ' (population AF unknown)' END
  WHEN sp >= 0.5 THEN 'High Splicing Delta Score (SpliceAI = ' || {_fixed('sp', 2)} || ' >= 0.50 via ' || {_METHOD} || ')' WHEN rv >= 0.773 THEN 'Moderate Pathogenic Missense (REVEL = ' || {_fixed('rv', 3)} || ' >= 0.773, PP3_Moderate)'
  WHEN am >= 0.75 THEN 'Moderate Pathogenic Missense (AlphaMissense = ' || {_fixed('am', 3)} || ' >= 0.750, PP3_Moderate)' ELSE 'Strong Priority {_COMPOSITE} >= 50.0)' END
 WHEN 3 THEN CASE WHEN bent THEN 'Moderate Splicing Delta Alteration (SpliceAI = ' || coalesce({_fixed('sp', 2)}, 'nan') || ' >= 0.20 via ' || {_METHOD} || ')' ELSE 'Moderate Priority {_COMPOSITE} >= 25.0)' END
 ELSE CASE WHEN ba1 THEN 'Stand-Alone Benign: AF (' || {_fixed('pop_af', 4)} || ') Exceeds FAF_PopMax Threshold (0.0020)' WHEN bs1 THEN 'Strong Benign: AF (' || {_fixed('pop_af', 4)} || ') Exceeds FAF_BS1 Threshold (0.0001)' WHEN ben THEN 'ClinVar Benign / Likely Benign Entry'
  ELSE 'Low Priority {_COMPOSITE} < 25.0) Without Functional Evidence' END END || CASE WHEN lowq THEN ' [⚠️ LOW_QUAL Caller Warning: ' || {_QUALITY} || ']' ELSE '' END AS TIER_RATIONALE FROM ({_TIER}) t""")
def _(spark, d):
    return _ranked(spark, d).select(*KEY, "TIER_RATIONALE")


_GENES = "SELECT 'G' || CAST(n_nationkey * 2 AS STRING) AS GENE, CASE n_nationkey % 3 WHEN 0 THEN 'Cardiomyopathies' WHEN 1 THEN 'Peripheral_and_conduction;Cardiomyopathies' ELSE 'Aortic_and_vascular' END AS SOURCE, CASE n_nationkey % 4 WHEN 0 THEN 'Prioritary' WHEN 1 THEN 'Secondary' WHEN 2 THEN 'Candidate' ELSE NULL END AS EVIDENCE FROM {nation}"
_PRIO = "CASE WHEN EVIDENCE IS NULL THEN 'others' WHEN contains(SOURCE, 'Aortic_and_vascular') THEN lower(EVIDENCE) WHEN contains(SOURCE, 'Cardiomyopathies') THEN 'candidate' ELSE lower(EVIDENCE) END"


def _genes(spark, d):
    return spark.sql(_GENES, nation=table(spark, d, "nation"))


@query("prioritize_genes", f"SELECT {K}, {_PRIO} AS gene_priority FROM {{v_wide}} v LEFT JOIN ({_GENES}) g ON g.GENE = v.SYMBOL")
def _(spark, d):
    return scores.prioritize_genes(table(spark, d, "v_wide"), _genes(spark, d), "Aortic_and_vascular").select(*KEY, "gene_priority")


@query("filter_gene_priority", f"SELECT {K}, {_PRIO} AS gene_priority FROM {{v_wide}} v LEFT JOIN ({_GENES}) g ON g.GENE = v.SYMBOL WHERE {_PRIO} IN ('prioritary', 'candidate')")
def _(spark, d):
    ranked = scores.prioritize_genes(table(spark, d, "v_wide"), _genes(spark, d), "Aortic_and_vascular")
    return rows.filter_gene_priority(ranked, ["prioritary", "candidate"]).select(*KEY, "gene_priority")


@query("dominant_rank", f"""SELECT {K}, CASE WHEN rar IS NULL THEN 'Unknown frequency' WHEN rar < CASE pr || '/' || NEW_IMPACT WHEN 'prioritary/HIGH' THEN 0.01 WHEN 'prioritary/MODERATE' THEN 0.001 WHEN 'prioritary/MODIFIER' THEN 0.001 WHEN 'prioritary/LOW' THEN 0.0005
 WHEN 'secondary/HIGH' THEN 0.0001 WHEN 'secondary/MODERATE' THEN 0.0001 WHEN 'secondary/LOW' THEN 0.0005 WHEN 'candidate/HIGH' THEN 0.0001 WHEN 'candidate/MODERATE' THEN 0.0001 END THEN 'Candidate' ELSE 'Excluded' END AS Variant_rank
 FROM (SELECT v.*, {_PRIO} AS pr FROM ({_IMPACT}) v LEFT JOIN ({_GENES}) g ON g.GENE = v.SYMBOL) t""")
def _(spark, d):
    ranked = scores.prioritize_genes(scores.new_impact(_prepared(spark, d)), _genes(spark, d), "Aortic_and_vascular")
    return scores.dominant_rank(ranked).select(*KEY, "Variant_rank")


@query("hpo_match", f"SELECT {K}, SYMBOL IN ('G4', 'G8', 'G12') AS HPO_MATCH, CASE WHEN SYMBOL IN ('G4', 'G8', 'G12') THEN least(100.0, QUAL + 15) ELSE QUAL END AS VARIANT_PRIORITY_SCORE FROM {{v_wide}}")
def _(spark, d):
    panels = table(spark, d, "nation").selectExpr("'HP:000' || CAST(n_nationkey % 2 AS STRING) AS term", "'G' || CAST(n_nationkey * 4 AS STRING) AS symbol", "n_nationkey").where("n_nationkey IN (1, 2, 3)").withColumn("term", F.lit("HP:0001638"))
    return scores.hpo_match(table(spark, d, "v_wide").withColumn("VARIANT_PRIORITY_SCORE", F.col("QUAL").cast("double")), panels, ["0001638 - Cardiomyopathy"]).select(*KEY, "HPO_MATCH", "VARIANT_PRIORITY_SCORE")


_SECOND = "SELECT 'g' || CAST(n_nationkey * 3 AS STRING) AS Gen, CASE n_nationkey % 5 WHEN 0 THEN 'Prioritario,' WHEN 1 THEN 'sarcomere_genes_GO' WHEN 2 THEN 'rna_heart_tissue' WHEN 3 THEN 'HPO_heart_related_genes' ELSE 'Candidato' END AS Prioridad FROM {nation}"
_CURATED = f"""SELECT upper(coalesce(GENE, Gen)) AS symbol, coalesce(SOURCE, 'Cardiomyopathies') AS source, CASE WHEN v4 = 'Prioritary' OR v2 = 'Prioritario' OR upper(coalesce(GENE, Gen)) IN ('G2', 'G6') THEN 'Definitive / Primary Evidence' WHEN v2 = 'sarcomere_genes_GO' THEN 'Strong / Sarcomeric Evidence' WHEN v4 = 'Candidate' OR v2 = 'Candidato' THEN 'Moderate / Candidate Evidence'
 WHEN v2 = 'rna_heart_tissue' THEN 'Heart Expressed (RNA-seq)' WHEN v2 = 'HPO_heart_related_genes' OR v4 = 'Secondary' THEN 'HPO Cardiac Related' ELSE 'Moderate / Candidate Evidence' END AS evidence_tier FROM (SELECT *, CASE WHEN EVIDENCE IS NULL THEN 'Candidate' ELSE EVIDENCE END AS v4, coalesce(rtrim(Prioridad, ','), '') AS v2 FROM ({_GENES}) a FULL JOIN ({_SECOND}) b ON a.GENE = upper(b.Gen)) t"""


@query("merge_gene_curation", _CURATED)
def _(spark, d):
    return scores.merge_gene_curation(_genes(spark, d), spark.sql(_SECOND, nation=table(spark, d, "nation")), ["G2", "G6"])


@query("disease_curation", f"""SELECT {K}, CASE WHEN evidence_tier IS NULL THEN 'Uncurated / Other Genomic' WHEN core THEN 'Definitive / Primary Evidence' WHEN NOT m AND evidence_tier = 'Definitive / Primary Evidence' THEN 'Moderate / Candidate Evidence' ELSE evidence_tier END AS DISEASE_GENE_EVIDENCE,
 CASE WHEN NOT m THEN 0.0 WHEN core THEN 25.0 ELSE CASE evidence_tier WHEN 'Definitive / Primary Evidence' THEN 25.0 WHEN 'Strong / Sarcomeric Evidence' THEN 18.0 WHEN 'Moderate / Candidate Evidence' THEN 12.0 WHEN 'Heart Expressed (RNA-seq)' THEN 6.0 ELSE 3.0 END END AS DISEASE_EVIDENCE_SCORE, m AS DISEASE_PHENOTYPE_MATCH, SYMBOL = 'G6' AS HIGH_RISK_DISEASE_GENE
 FROM (SELECT *, coalesce(evidence_tier IS NOT NULL AND (core OR contains(lower(source), 'cardiomyopathies')), FALSE) AS m FROM (SELECT v.*, source, evidence_tier, v.SYMBOL IN ('G2', 'G6') AS core FROM {{v_wide}} v LEFT JOIN ({_CURATED}) c ON c.symbol = v.SYMBOL) a) t""")
def _(spark, d):
    curated = scores.merge_gene_curation(_genes(spark, d), spark.sql(_SECOND, nation=table(spark, d, "nation")), ["G2", "G6"])
    return scores.disease_curation(table(spark, d, "v_wide"), curated, ["G2", "G6"], ["G6"], "cardiomyopathies").select(*KEY, "DISEASE_GENE_EVIDENCE", "DISEASE_EVIDENCE_SCORE", "DISEASE_PHENOTYPE_MATCH", "HIGH_RISK_DISEASE_GENE")


@query("gene_constraint", f"SELECT {K}, pli AS pLI_gene_value, CASE WHEN l_orderkey % 6 = 0 THEN 'not_applicable' WHEN n_nationkey IS NULL THEN 'not_in_table' ELSE 'matched' END AS gene_constraint_status FROM {{v_wide}} v LEFT JOIN (SELECT n_nationkey, 'ENSG' || lpad(CAST(n_nationkey AS STRING), 11, '0') AS gid, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey / 25.0 END AS pli FROM nation) c ON v.l_orderkey % 6 <> 0 AND c.gid = v.Gene")
def _(spark, d):
    constraint = table(spark, d, "nation").selectExpr("'ENSG' || lpad(CAST(n_nationkey AS STRING), 11, '0') AS gene_id", "CASE WHEN n_nationkey % 5 <> 0 THEN CAST(n_nationkey / 25.0 AS DOUBLE) END AS pLI", "0.5D AS LOEUF", "1D AS mis_z")
    rows_ = table(spark, d, "v_wide").withColumn("Gene", F.expr("CASE WHEN l_orderkey % 6 <> 0 THEN Gene END"))
    return scores.gene_constraint(rows_, constraint).select(*KEY, "pLI_gene_value", "gene_constraint_status")


# --- families

_WORD = "CASE WHEN {0} IN ('0/1','1/0','0|1','1|0') THEN 'HET' WHEN {0} IN ('0/0','0|0') THEN 'HOMREF' WHEN {0} IN ('1/1','1|1') THEN 'HOMALT' WHEN {0} IN ('./.','.') THEN 'MISSING' ELSE {0} END"
_TRIO = f"SELECT *, {_WORD.format('GT_S0')} AS p, {_WORD.format('GT_S1')} AS f, {_WORD.format('GT_S2')} AS m FROM {{v_wide}}"


@query("inheritance_model", f"""SELECT {K}, CASE WHEN p IN ('HET','HOMALT') AND f = 'HOMREF' AND m = 'HOMREF' THEN 'De Novo' WHEN p = 'HOMALT' AND f = 'HET' AND m = 'HET' THEN 'Autosomal Recessive (Hom)' WHEN p = 'HET' OR f = 'HET' THEN 'Autosomal Dominant / Heterozygous' WHEN p = 'HOMALT' OR f = 'HOMALT' THEN 'Homozygous Variant' ELSE 'Unclassified' END AS INHERITANCE_MODEL,
 'S0:' || p || ' | S1:' || f || ' | S2:' || m AS SAMPLE_GENOTYPES_SUMMARY FROM ({_TRIO}) t""")
def _(spark, d):
    return family.inheritance_model(rows.recode_genotypes(table(spark, d, "v_wide")), "S0", "S1", "S2", ["S0", "S1"]).select(*KEY, "INHERITANCE_MODEL", "SAMPLE_GENOTYPES_SUMMARY")


_SIDES = f"""SELECT *, CASE WHEN p = 'HET' AND f IN ('HET','HOMALT') AND m = 'HOMREF' THEN 'Paternal' WHEN p = 'HET' AND f = 'HOMREF' AND m IN ('HET','HOMALT') THEN 'Maternal' END AS side, SYMBOL || '/' || CAST(l_orderkey % 40 AS STRING) AS gkey FROM ({_TRIO}) t"""
_PAIRS = f"""SELECT s.*, g.pa, g.ma FROM ({_SIDES}) s LEFT JOIN (SELECT gkey, coalesce(string_agg(Locus, '; ' ORDER BY row_key) FILTER (side = 'Paternal'), '') AS pa, coalesce(string_agg(Locus, '; ' ORDER BY row_key) FILTER (side = 'Maternal'), '') AS ma FROM ({_SIDES}) x GROUP BY gkey) g USING (gkey)"""


def _trio(spark, d):
    return rows.recode_genotypes(table(spark, d, "v_wide")).withColumn("SYMBOL", F.expr("SYMBOL || '/' || CAST(l_orderkey % 40 AS STRING)"))


@query("compound_het_trans", f"SELECT {K}, pa <> '' AND ma <> '' AND side IS NOT NULL AS compound_het, CASE WHEN pa = '' OR ma = '' OR side IS NULL THEN '' WHEN side = 'Paternal' THEN 'Paternal | Partner (Maternal): ' || ma ELSE 'Maternal | Partner (Paternal): ' || pa END AS COMPOUND_HET_PAIR FROM ({_PAIRS}) t")
def _(spark, d):
    return family.compound_het_trans(_trio(spark, d), "S0", "S1", "S2", KEY).select(*KEY, "compound_het", "COMPOUND_HET_PAIR")


# a trio in which many genes have variants of both sides: every second order is the father's
_BOTH = """SELECT row_key, Locus, SYMBOL || '/' || CAST(CAST(floor(l_orderkey / 2) AS BIGINT) % 40 AS STRING) AS SYMBOL, CASE WHEN l_linenumber % 3 = 0 THEN 'HOMREF' ELSE 'HET' END AS GT_S0,
 CASE WHEN l_linenumber = 5 THEN 'MISSING' WHEN l_orderkey % 2 = 0 THEN 'HET' ELSE 'HOMREF' END AS GT_S1, CASE WHEN l_orderkey % 2 = 0 THEN 'HOMREF' WHEN l_linenumber = 4 THEN 'HOMALT' ELSE 'HET' END AS GT_S2 FROM {v_wide}"""
_BOTH_SIDES = f"""SELECT b.*, CASE WHEN GT_S0 = 'HET' AND GT_S1 IN ('HET','HOMALT') AND GT_S2 = 'HOMREF' THEN 'Paternal' WHEN GT_S0 = 'HET' AND GT_S1 = 'HOMREF' AND GT_S2 IN ('HET','HOMALT') THEN 'Maternal' END AS side FROM ({_BOTH}) b"""
_BOTH_GENES = f"SELECT SYMBOL, string_agg(Locus, '; ' ORDER BY row_key) FILTER (side = 'Paternal') AS pa, string_agg(Locus, '; ' ORDER BY row_key) FILTER (side = 'Maternal') AS ma FROM ({_BOTH_SIDES}) s GROUP BY SYMBOL"


def _both(spark, d):
    return spark.sql(_BOTH, v_wide=table(spark, d, "v_wide"))


@query("compound_het_pairs", f"SELECT {K}, pa IS NOT NULL AND ma IS NOT NULL AND side IS NOT NULL AS compound_het, CASE WHEN pa IS NULL OR ma IS NULL OR side IS NULL THEN '' WHEN side = 'Paternal' THEN 'Paternal | Partner (Maternal): ' || ma ELSE 'Maternal | Partner (Paternal): ' || pa END AS COMPOUND_HET_PAIR FROM ({_BOTH_SIDES}) s JOIN ({_BOTH_GENES}) g USING (SYMBOL)")
def _(spark, d):
    return family.compound_het_trans(_both(spark, d), "S0", "S1", "S2", KEY).select(*KEY, "compound_het", "COMPOUND_HET_PAIR")


@query("compound_het_partners", f"""SELECT SYMBOL, side, (no - 1) // 3 AS part, count(*) AS n, string_agg(Locus, '; ' ORDER BY no) AS loci FROM (
 SELECT s.*, row_number() OVER (PARTITION BY SYMBOL, side ORDER BY row_key) AS no FROM ({_BOTH_SIDES}) s JOIN ({_BOTH_GENES}) g USING (SYMBOL) WHERE side IS NOT NULL AND pa IS NOT NULL AND ma IS NOT NULL) t GROUP BY ALL""")
def _(spark, d):
    return family.compound_het_partners(_both(spark, d), "S0", "S1", "S2", KEY, part_size=3)


_HETS = f"SELECT *, count(*) FILTER (p = 'HET') OVER (PARTITION BY gkey) AS n0, count(*) FILTER (f = 'HET') OVER (PARTITION BY gkey) AS n1 FROM ({_SIDES}) h"


@query("compound_het_unphased", f"""WITH h AS ({_HETS}), o AS (SELECT a.row_key, string_agg(b.Locus, '; ' ORDER BY b.row_key) FILTER (b.p = 'HET') AS o0, string_agg(b.Locus, '; ' ORDER BY b.row_key) FILTER (b.f = 'HET') AS o1 FROM h a JOIN h b ON a.gkey = b.gkey AND a.row_key <> b.row_key GROUP BY 1)
 SELECT h.row_key, (p = 'HET' AND n0 >= 2) OR (f = 'HET' AND n1 >= 2) AS compound_het_candidate, CASE WHEN f = 'HET' AND n1 >= 2 THEN 'Unphased Candidate | Partners (S1): ' || o1 WHEN p = 'HET' AND n0 >= 2 THEN 'Unphased Candidate | Partners (S0): ' || o0 ELSE '' END AS COMPOUND_HET_PAIR FROM h LEFT JOIN o USING (row_key)""")
def _(spark, d):
    return family.compound_het_unphased(_trio(spark, d), ["S0", "S1"], KEY).select(*KEY, "compound_het_candidate", "COMPOUND_HET_PAIR")


@query("compound_het_status", f"SELECT {K}, CASE WHEN pa <> '' AND ma <> '' AND side IS NOT NULL THEN 'Phased TRANS Pair' WHEN p = 'HET' AND n0 >= 2 THEN 'Unphased Candidate Pair' ELSE 'No Pair' END AS COMPOUND_HET_STATUS FROM ({_PAIRS}) t JOIN (SELECT row_key, n0 FROM ({_HETS}) y) z USING (row_key)")
def _(spark, d):
    marked = family.compound_het_trans(_trio(spark, d), "S0", "S1", "S2", KEY, pairs=False)
    marked = family.compound_het_unphased(marked, ["S0"], KEY, pairs=False)
    return marked.select(*KEY, family.compound_het_status().alias("COMPOUND_HET_STATUS"))


@query("merge_sample_cols", f"""SELECT {K}, concat_ws(', ', CASE WHEN p NOT IN ('HOMREF','MISSING') THEN '_S0:' || p END, CASE WHEN f NOT IN ('HOMREF','MISSING') THEN '_S1:' || f END, CASE WHEN m NOT IN ('HOMREF','MISSING') THEN '_S2:' || m END) AS merged_GT,
 (p NOT IN ('HOMREF','MISSING'))::INT + (f NOT IN ('HOMREF','MISSING'))::INT + (m NOT IN ('HOMREF','MISSING'))::INT AS count_GT,
 (p NOT IN ('HOMREF','MISSING') AND GQ_S0 <> 0)::INT + (f NOT IN ('HOMREF','MISSING') AND GQ_S1 <> 0)::INT + (m NOT IN ('HOMREF','MISSING') AND GQ_S2 <> 0)::INT AS count_GQ FROM ({_TRIO}) t""")
def _(spark, d):
    merged = family.merge_sample_cols(rows.recode_genotypes(table(spark, d, "v_wide")))
    return family.merge_sample_cols(merged, "GQ_").select(*KEY, "merged_GT", "count_GT", "count_GQ")


_GSTATUS = "CASE gt_raw WHEN '0/0' THEN 'hom_ref' WHEN '0/1' THEN 'het' WHEN '1/1' THEN 'hom_alt' WHEN './.' THEN 'no_call' WHEN './1' THEN 'partial_no_call' WHEN '1|0' THEN 'het' WHEN '1/0' THEN 'alt_plus_other_allele' WHEN '1' THEN 'haploid_alt' END"


@query("genotype_status", f"SELECT Locus, sample_id, {_GSTATUS} AS gt_status, contains(gt_raw, '|') AS phased, CASE WHEN gt_raw IN ('1') THEN 1 ELSE 2 END AS ploidy FROM {{v_genotypes}}")
def _(spark, d):
    return family.with_genotype(table(spark, d, "v_genotypes")).select("Locus", "sample_id", "gt_status", "phased", "ploidy")


@query("genotype_category", f"SELECT Locus, sample_id, CASE {_GSTATUS} WHEN 'het' THEN 'HET' WHEN 'alt_plus_other_allele' THEN 'HET' WHEN 'hom_alt' THEN 'HOMALT' WHEN 'haploid_alt' THEN 'HOMALT' WHEN 'hom_ref' THEN 'HOMREF' ELSE 'MISSING' END AS word FROM {{v_genotypes}}")
def _(spark, d):
    return table(spark, d, "v_genotypes").select("Locus", "sample_id", family.genotype_category(family.genotype_status(F.col("gt_raw"))).alias("word"))


@query("prioritise_pipeline", f"SELECT {K}, NEW_IMPACT, sc AS VARIANT_PRIORITY_SCORE, tier FROM ({_TIER}) t WHERE (rar IS NULL OR rar < 0.01) AND NEW_IMPACT IN ('HIGH', 'MODERATE')")
def _(spark, d):
    from varlake.plans.pipeline import prioritise

    done = prioritise(_prepared(spark, d), below=0.01, impacts=["HIGH", "MODERATE"])
    return done.select(*KEY, "NEW_IMPACT", "VARIANT_PRIORITY_SCORE", F.substring("PRIORITY_TIER", 6, 1).cast("int").alias("tier"))
