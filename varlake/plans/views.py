"""Views over the driver's tables on which the variant operators run: the same text in Spark SQL and DuckDB.

A name in braces is a table or another view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS: dict[str, str] = {}

VIEWS["v_variants"] = """
SELECT 'chr' || CAST(1 + l_suppkey % 22 AS STRING) AS CHROM,
 l_orderkey * 10 + l_linenumber AS POS,
 substr('ACGT', CAST(1 + l_partkey % 4 AS INT), 1) AS REF,
 substr('ACGT', CAST(1 + (l_partkey + 1 + l_linenumber % 3) % 4 AS INT), 1) AS ALT,
 'G' || CAST(l_partkey % 50 AS STRING) AS SYMBOL,
 'ENSG' || lpad(CAST(l_partkey % 50 AS STRING), 11, '0') AS Gene,
 'ENST' || lpad(CAST(l_partkey AS STRING), 11, '0') || '.1' AS Feature,
 CASE l_partkey % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'LOW' ELSE 'MODIFIER' END AS IMPACT,
 CASE l_partkey % 7 WHEN 0 THEN 'stop_gained' WHEN 1 THEN 'missense_variant' WHEN 2 THEN 'splice_donor_variant'
   WHEN 3 THEN 'synonymous_variant' WHEN 4 THEN '5_prime_UTR_variant' WHEN 5 THEN 'frameshift_variant' ELSE 'intron_variant' END AS Consequence,
 l_quantity AS QUAL,
 CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_discount / 100 END AS AF_grpmax,
 CASE WHEN l_linenumber % 5 = 0 AND l_orderkey % 2 = 0 THEN NULL ELSE l_discount / 50 END AS AF_joint,
 l_tax * 10 AS splice_score,
 CASE WHEN l_partkey % 3 = 0 THEN 'NM_' || CAST(l_partkey AS STRING) END AS MANE_SELECT,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE
  substr('ACGT', CAST(1 + (l_partkey + 1 + l_linenumber % 3) % 4 AS INT), 1) || '|G' || CAST(l_partkey % 50 AS STRING) || '|' || CAST(l_tax AS STRING) || '|' || CAST(l_discount AS STRING) || '|0.0|.|1|2|3|4&'
  || 'A|G' || CAST((l_partkey + 1) % 50 AS STRING) || '|0.5|0.0|0.0|.|1|2|3|4' END AS SpliceAI,
 l_orderkey, l_linenumber,
 CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_quantity AS INT) AS STRING) AS row_key
FROM {lineitem}
"""

VIEWS["v_genotypes"] = """
SELECT v.CHROM || ':' || CAST(v.POS AS STRING) || '-' || v.REF || '-' || v.ALT AS Locus, v.SYMBOL,
 'S' || CAST(s.r_regionkey AS STRING) AS sample_id,
 CASE (v.l_orderkey + v.l_linenumber * 3 + s.r_regionkey) % 9 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' WHEN 3 THEN './.' WHEN 4 THEN './1'
  WHEN 5 THEN '1|0' WHEN 6 THEN '1/0' WHEN 7 THEN '1' ELSE '0/1' END AS gt_raw,
 CAST((v.l_orderkey * 7 + s.r_regionkey) % 100 AS INT) AS gq
FROM {v_variants} v CROSS JOIN {region} s WHERE s.r_regionkey < 3
"""

VIEWS["v_regions"] = """
SELECT 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS chrom, p_partkey * 37 AS start_pos,
 p_partkey * 37 + p_size * 20 AS end_pos, 'G' || CAST(p_partkey % 50 AS STRING) AS gene,
 CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM {part}
"""

VIEWS["v_cache"] = """
SELECT CHROM, POS, REF, ALT, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE splice_score END AS score,
 'seg' || CAST(l_orderkey % 4 AS STRING) AS segment FROM {v_variants} WHERE l_orderkey % 3 <> 0
"""

VIEWS["v_alias"] = """
SELECT 'G' || CAST(p_partkey % 50 AS STRING) AS symbol, 'OLD' || CAST(p_partkey % 70 AS STRING) AS prev_symbol,
 'ALT' || CAST(p_partkey % 30 AS STRING) || '|ALT' || CAST(p_partkey % 41 AS STRING) AS alias_symbol,
 'ENSG' || lpad(CAST(p_partkey % 50 AS STRING), 11, '0') AS ensembl_gene_id FROM {part}
"""

VIEWS["v_tasks"] = """
SELECT event_type AS process, event_type || ' (' || CAST(user_id AS STRING) || ')' AS name,
 CASE WHEN event_id % 11 = 0 THEN 'FAILED' WHEN event_id % 7 = 0 THEN 'CACHED' ELSE 'COMPLETED' END AS status,
 CAST(event_id % 3 AS STRING) || 'h ' || CAST(event_id % 60 AS STRING) || 'm ' || CAST(event_id % 50 AS STRING) || 's' AS realtime,
 CAST(1 + event_id % 16 AS STRING) || ' GB' AS peak_rss, 'node' || CAST(user_id % 5 AS STRING) AS hostname, ts AS submit_ts
FROM {events}
"""

VIEWS["v_cases"] = """
SELECT CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CHROM END AS CHROM, POS, REF, ALT, Feature AS cdna,
 SYMBOL AS gene, l_linenumber AS n_het FROM {v_variants} WHERE l_orderkey % 2 = 0
"""

VIEWS["v_controls"] = """
SELECT CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CHROM END AS CHROM, POS, REF, ALT, Feature AS cdna,
 SYMBOL AS gene, l_linenumber AS n_het FROM {v_variants} WHERE l_orderkey % 3 = 0
"""

# the annotated table: what predictors, callers and samples add to a variant x transcript row
VIEWS["v_wide"] = """
SELECT v.*, CHROM || ':' || CAST(POS AS STRING) || '-' || REF || '-' || ALT AS Locus,
 Feature || ':c.' || CAST(POS % 900 + 1 AS STRING) || CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN '+' || CAST(l_orderkey % 40 + 1 AS STRING)
   WHEN 2 THEN '-' || CAST(l_orderkey % 60 + 1 AS STRING) ELSE '_' || CAST(POS % 900 + 3 AS STRING) || '+2' END || 'A>G' AS HGVSc,
 CASE l_orderkey % 5 WHEN 0 THEN 'PASS' WHEN 1 THEN '.' WHEN 2 THEN 'LowDepth' WHEN 3 THEN NULL ELSE 'PASS' END AS FILTER,
 CASE WHEN l_orderkey % 5 = 1 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS QD,
 CASE WHEN l_orderkey % 5 = 1 THEN NULL ELSE CAST(l_orderkey % 80 AS DOUBLE) END AS FS,
 CASE WHEN l_orderkey % 5 = 1 THEN NULL ELSE CAST(30 + l_orderkey % 40 AS DOUBLE) END AS MQ,
 CASE WHEN l_orderkey % 5 = 1 THEN NULL ELSE QUAL END AS QUAL_seen,
 CASE l_orderkey % 6 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN '.' WHEN 2 THEN 'Likely_benign' WHEN 3 THEN 'Uncertain_significance' WHEN 4 THEN NULL ELSE 'Benign/Likely_benign' END AS ClinVarVCF_CLNSIG,
 CASE l_orderkey % 4 WHEN 0 THEN 'reviewed_by_expert_panel' WHEN 1 THEN 'criteria_provided&_single_submitter' WHEN 2 THEN 'criteria_provided,_multiple_submitters,_no_conflicts' ELSE '.' END AS ClinVarVCF_CLNREVSTAT,
 CASE l_linenumber % 3 WHEN 0 THEN 'likely_pathogenic' WHEN 1 THEN '' ELSE 'pathogenic&benign' END AS CLIN_SIG,
 CASE WHEN l_linenumber % 6 = 0 THEN NULL WHEN l_linenumber % 6 = 1 THEN '.' ELSE Gene || '.3|12:0.' || CAST(l_orderkey % 90 + 10 AS STRING) || '|-4:-0.' || CAST(l_linenumber % 9 + 1 AS STRING) || '&ENSG00000000000.1|5:0.5|bad' END AS Pangolin,
 'ENST' || lpad(CAST(POS % 977 AS STRING), 11, '0') || '.2&' || Feature AS Ensembl_transcriptid,
 CASE WHEN l_linenumber % 7 = 0 THEN '.' WHEN l_linenumber % 7 = 1 THEN '0.5' WHEN l_linenumber % 7 = 2 THEN '0.1&0.2&0.3' ELSE '0.' || CAST(l_orderkey % 900 + 100 AS STRING) || '&' || CASE WHEN l_linenumber % 2 = 0 THEN '.' ELSE '0.' || CAST(l_linenumber AS STRING) END END AS REVEL_list,
 CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_orderkey % 1000 AS DOUBLE) / 1000 END AS am_pathogenicity,
 CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE CAST((l_orderkey * 7) % 1000 AS DOUBLE) / 1000 END AS REVEL_score,
 CASE WHEN l_orderkey % 7 = 0 THEN 'NMD_escaping_variant' END AS NMD,
 CASE WHEN l_orderkey % 5 = 0 THEN '?-12' WHEN l_orderkey % 5 = 1 THEN '' ELSE CAST(POS % 900 AS STRING) END AS CDS_position,
 CASE WHEN l_orderkey % 9 = 0 THEN 'deletion' ELSE 'SNV' END AS VARIANT_CLASS,
 CASE WHEN l_orderkey % 4 = 0 THEN '.' WHEN l_orderkey % 41 = 0 THEN 'oops' ELSE '0.' || CAST(l_orderkey % 90 + 10 AS STRING) END AS ReMM,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'S:' || CAST(l_orderkey % 9 AS STRING) END AS note,
 CASE l_orderkey % 3 WHEN 0 THEN '1:CD:-12:30:Frameshift&2:ES:4:8:' WHEN 1 THEN '.' ELSE '1:CA:0:12:in_frame' END AS SpliceVault_top_events,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(POS + 40 AS STRING) END AS SpliceVault_site_pos,
 CASE WHEN l_partkey_odd = 1 THEN '-1' ELSE '1' END AS STRAND,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(l_orderkey % 11 AS DOUBLE) - 2 END AS MaxEntScan_ref,
 CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_orderkey % 13 AS DOUBLE) - 3 END AS MaxEntScan_alt,
 CASE l_orderkey % 4 WHEN 0 THEN '5_prime_UTR_premature_start_codon_gain_variant' WHEN 1 THEN '5_prime_UTR_uORF_stop_codon_loss_variant' WHEN 2 THEN '5_prime_UTR_uORF_frameshift_variant' END AS utr5_consequence,
 'KozakStrength=' || CASE l_linenumber % 3 WHEN 0 THEN 'Strong' WHEN 1 THEN 'Weak' ELSE 'Moderate' END || ':type=' || CASE l_orderkey % 2 WHEN 0 THEN 'inFrame_oORF' ELSE 'uORF' END || ':AltStop=' || CASE l_linenumber % 2 WHEN 0 THEN 'True' ELSE 'False' END || ':Evidence=False:ref_type=uORF:alt_type=OutOfFrame_oORF' AS utr5_annotation,
 CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN '0/1' WHEN 1 THEN '1/1' WHEN 2 THEN '0|1' WHEN 3 THEN './.' WHEN 4 THEN '0/0' ELSE '1/2' END AS GT_S0,
 CASE (l_orderkey + l_linenumber * 2) % 5 WHEN 0 THEN '0/1' WHEN 1 THEN '0/0' WHEN 2 THEN '0|0' WHEN 3 THEN '1/1' ELSE './.' END AS GT_S1,
 CASE (l_orderkey * 3 + l_linenumber) % 4 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '0/0' ELSE '.' END AS GT_S2,
 CAST(l_orderkey % 60 AS INT) AS GQ_S0, CAST(l_linenumber * 9 AS INT) AS GQ_S1, CAST((l_orderkey + l_linenumber) % 45 AS INT) AS GQ_S2
FROM (SELECT *, POS % 2 AS l_partkey_odd FROM {v_variants}) v
"""


#: Views that Spark makes from an array, without a join; DuckDB has the text above.
_SAMPLES = "(SELECT *, explode((SELECT collect_list(r_regionkey) FROM {region} WHERE r_regionkey < 3)) AS r_regionkey FROM {v_variants})"
SPARK = {"v_genotypes": VIEWS["v_genotypes"].replace("{v_variants} v CROSS JOIN {region} s WHERE s.r_regionkey < 3", f"{_SAMPLES} v").replace("s.r_regionkey", "v.r_regionkey")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver, or a view over its tables. Sets the session's codegen so that chains of many columns are compiled as several
    methods: the JVM runs one of more than 8,000 bytes uncompiled."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = SPARK.get(name, VIEWS[name])
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in _names(sql)})


def _names(sql: str) -> list[str]:
    return [n for n in [*TABLES, *VIEWS] if "{" + n + "}" in sql]


def oracle(sql: str) -> str:
    """sql for DuckDB: names in braces of views become leading CTEs."""
    found: dict[str, str] = {}

    def need(text: str) -> str:
        for n in _names(text):
            if n in VIEWS and n not in found:
                found[n] = need(VIEWS[n])
            text = text.replace("{" + n + "}", n)
        return text

    body = need(sql).strip()
    if not found:
        return body
    ctes = ", ".join(f"{n} AS ({t})" for n, t in found.items())
    return f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"
