"""Queries of whole-table scans and sinks, input checks and what is filled in later."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.operators import builds as B
from varlake.operators import checks as C
from varlake.operators import splicing
from varlake.plans.registry import KEY, query
from varlake.plans.views import table
from varlake.sources import scans, sinks
from varlake.sources import tables as S


@query("scan_table", "SELECT row_key, CHROM, POS, SYMBOL, QUAL, MANE_SELECT, l_orderkey % 2 = 0 AS flag FROM {v_variants}")
def _(spark, d):
    path = f"{S.scratch(spark)}.tsv"
    rows = table(spark, d, "v_variants").selectExpr("row_key", "CHROM", "POS", "SYMBOL", "QUAL", "coalesce(MANE_SELECT, '.') AS MANE_SELECT", "l_orderkey % 2 = 0 AS flag")
    sinks.save_table(rows, path)
    return S.scan_table(spark, path)


@query("scan_table_auto_columns", "SELECT CHROM || ':' || CAST(POS AS STRING) || '-' || REF || '-' || ALT AS variant, count(*) AS n FROM {v_variants} GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "v_variants").selectExpr("CHROM AS Chromosome", "POS AS position", "REF AS Ref", "ALT AS alternate", "SYMBOL")
    chrom, pos, ref, alt = S.find_columns(rows.columns)["ids"]
    return rows.groupBy(F.concat(chrom, F.lit(":"), F.col(pos).cast("string"), F.lit("-"), ref, F.lit("-"), alt).alias("variant")).agg(F.count("*").alias("n"))


@query("save_table", "SELECT segment, count(*) AS n, count(score) AS scored, round(sum(score), 4) AS total FROM {v_cache} GROUP BY segment")
def _(spark, d):
    path = f"{S.scratch(spark)}.csv"
    sinks.save_table(table(spark, d, "v_cache"), path)
    return S.scan_table(spark, path).groupBy("segment").agg(F.count("*").alias("n"), F.count("score").alias("scored"), F.round(F.sum("score"), 4).alias("total"))


@query("append_segment", "SELECT CHROM, POS, REF, ALT, score, segment FROM {v_cache} WHERE segment IN ('seg0', 'seg1')")
def _(spark, d):
    folder, cache = S.scratch(spark), table(spark, d, "v_cache")
    for name in ("seg0", "seg1"):
        sinks.append_segment(cache.where(F.col("segment") == name).select("CHROM", "POS", "REF", "ALT", "score"), folder, "v1", name)
    found = spark.read.option("basePath", f"{folder}/version=v1").parquet(f"{folder}/version=v1")
    return sinks.valid_segments(found.select("CHROM", "POS", "REF", "ALT", "score", "segment"), spark.read.parquet(f"{folder}/manifest").drop("version"))


@query("multi_file_union_with_origin", "SELECT IMPACT AS Gene_Dataset, count(*) AS n, min(POS) AS low, max(POS) AS high FROM {v_variants} GROUP BY IMPACT")
def _(spark, d):
    folder, rows = S.scratch(spark), table(spark, d, "v_variants")
    for name in ("HIGH", "MODERATE", "LOW", "MODIFIER"):
        sinks.save_table(rows.where(F.col("IMPACT") == name).select("row_key", "POS"), f"{folder}/{name}.scored.parquet")
    return S.union_with_origin(spark, f"{folder}/*.parquet").groupBy("Gene_Dataset").agg(F.count("*").alias("n"), F.min("POS").alias("low"), F.max("POS").alias("high"))


@query("provenance_stamp", """SELECT '{"rows":' || CAST(count(*) AS STRING) || ',"run":"r1"}' AS stamp, count(*) AS n FROM {v_cache}""")
def _(spark, d):
    rows, path = table(spark, d, "v_cache"), f"{S.scratch(spark)}.parquet"
    sinks.save_table(S.with_stamp(rows, {"run": "r1", "rows": rows.count()}), path)
    back = S.scan_table(spark, path)
    stamp = S.read_stamp(back)
    return back.agg(F.count("*").alias("n")).select(F.lit(f'{{"rows":{stamp["rows"]},"run":"{stamp["run"]}"}}').alias("stamp"), "n")


_CHAIN = """SELECT 'chain 100 chr' || CAST(1 + p_partkey % 22 AS STRING) || ' 100000000 + ' || CAST(p_partkey * 90 AS STRING) || ' 0 new' || CAST(p_partkey % 22 AS STRING) || ' 100000000 ' || CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END || ' '
 || CAST(p_partkey * 77 AS STRING) || ' 0 ' || CAST(p_partkey AS STRING) || chr(10) || CAST(p_size AS STRING) || chr(9) || '10' || chr(9) || '3' || chr(10) || CAST(p_size + 5 AS STRING) || chr(10) AS value FROM {part}"""
_BLOCK = "SELECT 'chr' || CAST(1 + p_partkey % 22 AS STRING) AS src, p_partkey * 90 + {a} AS src_start, p_partkey * 90 + {a} + p_size + {n} AS src_end, 'new' || CAST(p_partkey % 22 AS STRING) AS dst, CASE WHEN p_partkey % 3 = 0 THEN 100000000 - (p_partkey * 77 + {b}) - (p_size + {n}) ELSE p_partkey * 77 + {b} END AS dst_start, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand FROM part"


@query("scan_chain_blocks", _BLOCK.format(a="0", n="0", b="0") + " UNION ALL " + _BLOCK.format(a="p_size + 10", n="5", b="p_size + 3"))
def _(spark, d):
    path = S.scratch(spark)
    spark.sql(_CHAIN, part=table(spark, d, "part")).write.text(path)
    return S.chain_blocks(S.read_chains(spark, path))


@query("scan_run_trace", """SELECT name, process, status, (event_h * 3600 + event_m * 60 + event_s) * 1000 AS duration_ms, gb * 1073741824 AS peak_rss_bytes, host, n FROM (
 SELECT name, process, status, hostname AS host, CAST(split_part(realtime, 'h', 1) AS BIGINT) AS event_h, CAST(split_part(split_part(realtime, ' ', 2), 'm', 1) AS BIGINT) AS event_m, CAST(split_part(split_part(realtime, ' ', 3), 's', 1) AS BIGINT) AS event_s,
 CAST(split_part(peak_rss, ' ', 1) AS BIGINT) AS gb, count(*) AS n FROM {v_tasks} GROUP BY ALL) t""")
def _(spark, d):
    path = f"{S.scratch(spark)}.tsv"
    sinks.save_table(table(spark, d, "v_tasks").select("name", "status", "realtime", "peak_rss", "hostname"), path)
    keys = ["name", "process", "status", "duration_ms", "peak_rss_bytes", "host"]
    return S.run_trace(S.scan_table(spark, path, kinds=False)).groupBy(*keys).agg(F.count("*").alias("n"))


@query("genotype_mode", """SELECT n_regionkey AS header, CASE WHEN n = 0 THEN 'no_samples' WHEN n_regionkey = 3 THEN 'samples_without_GT' WHEN n = 1 THEN 'single_sample' ELSE 'multi_sample' END AS mode, CASE WHEN n_regionkey = 2 THEN coalesce((SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT 'S' || CAST(n_nationkey % 10 % 9 AS STRING) AS s FROM nation WHERE n_regionkey = 2 GROUP BY ALL HAVING count(*) > 1) r), '') ELSE '' END AS repeated FROM (
 SELECT n_regionkey, CASE n_regionkey WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE count(*) END AS n FROM nation GROUP BY n_regionkey) t""")
def _(spark, d):
    names = F.array_sort(F.collect_list(F.concat(F.lit("S"), F.when(F.col("n_regionkey") == 2, F.col("n_nationkey") % 10 % 9).otherwise(F.col("n_nationkey")).cast("string"))))
    headers = table(spark, d, "nation").groupBy("n_regionkey").agg(names.alias("all"))
    samples = F.when(F.col("n_regionkey") == 0, F.slice("all", 1, 0)).when(F.col("n_regionkey") == 1, F.slice("all", 1, 1)).otherwise(F.col("all"))
    formats = F.when(F.col("n_regionkey") == 3, F.array(F.lit("DP"))).otherwise(F.array(F.lit("GT"), F.lit("DP")))
    rows = headers.select("n_regionkey", samples.alias("samples"), formats.alias("formats"))
    return rows.select(F.col("n_regionkey").alias("header"), C.genotype_mode(F.col("samples"), F.col("formats")).alias("mode"), F.array_join(C.repeated_names(F.col("samples")), ",").alias("repeated"))


_RECORDS = "SELECT CHROM, POS, REF, CASE WHEN l_linenumber = 3 THEN REF || ALT WHEN l_linenumber = 5 AND l_orderkey % 4 = 0 THEN NULL WHEN l_linenumber = 6 THEN '<DEL>' ELSE ALT END AS ALT, l_orderkey FROM {v_variants}"
_AGREES = "SELECT POS, REF = 'A' OR l_orderkey % 50 > 0 AS agrees FROM {v_variants}"
_STATES = "SELECT CASE WHEN n_nationkey < 20 THEN 'ok' WHEN n_nationkey < 22 THEN 'name' ELSE 'unmatched' END AS state FROM nation"


@query("input_check_report", f"""WITH r AS ({_RECORDS}), g AS (SELECT CHROM, POS, REF, ALT, count(*) AS n FROM r GROUP BY ALL), m AS (SELECT sum(n) AS records, sum(n - 1) AS duplicates, coalesce(sum(n) FILTER (REF = ALT), 0) AS alt_is_ref, coalesce(sum(n) FILTER (ALT IS NULL), 0) AS no_alt,
 coalesce(sum(n) FILTER (NOT regexp_full_match(ALT, '[ACGT]+')), 0) AS symbolic FROM g), a AS (SELECT count(*) AS checked, count(*) FILTER (NOT agrees) AS differ FROM ({_AGREES}) t), s AS (SELECT count(*) FILTER (state = 'ok') AS ok, count(*) FILTER (state = 'name') AS nm, count(*) FILTER (state = 'unmatched') AS un FROM ({_STATES}) t), f AS (SELECT * FROM m, a, s)
 SELECT 'status' AS "key", CASE WHEN differ > checked * 0.01 THEN 'FAIL' ELSE 'PASS' END AS value FROM f UNION ALL SELECT k, v FROM (SELECT unnest(['records', 'duplicates', 'alt_is_ref', 'no_alt', 'multiallelic', 'symbolic', 'not_parsimonious', 'ref_checked', 'ref_mismatches', 'contig_ok', 'contig_name', 'contig_length', 'contig_unmatched']) AS k,
 unnest([CAST(records AS STRING), CAST(duplicates AS STRING), CAST(alt_is_ref AS STRING), CAST(no_alt AS STRING), '0', CAST(symbolic AS STRING), '0', CAST(checked AS STRING), CAST(differ AS STRING), CAST(ok AS STRING), CAST(nm AS STRING), '0', CAST(un AS STRING)]) AS v FROM f) t
 UNION ALL SELECT 'failure', 'reference alleles differ' FROM f WHERE differ > checked * 0.01 UNION ALL SELECT 'warning', 'reference alleles differ within the threshold' FROM f WHERE differ > 0 AND differ <= checked * 0.01 UNION ALL SELECT 'warning', 'contigs not in the reference' FROM f WHERE un > 0
 UNION ALL SELECT 'warning', 'duplicate records' FROM f WHERE duplicates > 0 UNION ALL SELECT 'warning', 'ALT identical to REF' FROM f WHERE alt_is_ref > 0 UNION ALL SELECT 'warning', 'no ALT allele' FROM f WHERE no_alt > 0""")
def _(spark, d):
    v = {"v_variants": table(spark, d, "v_variants")}
    return C.input_check(spark.sql(_RECORDS, **v), spark.sql(_STATES.replace("FROM nation", "FROM {nation}"), nation=table(spark, d, "nation")), spark.sql(_AGREES, **v))


_INDELS = """SELECT row_key AS key, 'old' AS chrom, 5 + l_orderkey % 150 AS pos, CASE WHEN l_linenumber % 4 = 2 THEN 'ACG' ELSE '-' END AS ref, CASE WHEN l_linenumber % 4 = 2 THEN '' WHEN l_linenumber % 4 = 3 THEN 'TT' ELSE '-' END AS alt,
 CASE WHEN l_linenumber % 4 = 0 THEN 'NC_1:g.' || CAST(5 + l_orderkey % 150 AS STRING) || '_' || CAST(7 + l_orderkey % 150 AS STRING) || 'delinsGA' WHEN l_linenumber % 4 = 1 THEN 'NC_1:g.' || CAST(5 + l_orderkey % 150 AS STRING) || 'del' END AS description FROM {v_variants}"""
_SEQUENCE = "repeat('ACGGTCATTGCAAGTC', 40)"


@query("normalize_indel_from_hgvs", f"""SELECT key, CASE WHEN loc BETWEEN 1 AND 100 THEN 'new' END AS norm_chrom, CASE WHEN loc BETWEEN 1 AND 100 THEN loc + 30 END AS norm_pos, CASE WHEN loc BETWEEN 1 AND 100 THEN substr({_SEQUENCE}, CAST(loc + 30 AS INT), CAST(gone + 1 AS INT)) END AS norm_ref,
 CASE WHEN loc BETWEEN 1 AND 100 THEN substr({_SEQUENCE}, CAST(loc + 30 AS INT), 1) || put END AS norm_alt FROM (SELECT key, CASE WHEN k = 3 THEN pos ELSE pos - 1 END AS loc, CASE k WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 0 END AS gone, CASE k WHEN 0 THEN 'GA' WHEN 3 THEN 'TT' ELSE '' END AS put
 FROM (SELECT row_key AS key, 5 + l_orderkey % 150 AS pos, l_linenumber % 4 AS k FROM {{v_variants}}) a) b""")
def _(spark, d):
    sites = spark.sql(_INDELS, v_variants=table(spark, d, "v_variants"))
    blocks = spark.sql("SELECT 'old' AS src, 0L AS src_start, 100L AS src_end, 'new' AS dst, 30L AS dst_start, '+' AS strand")
    tiles = scans.sequence_tiles(spark.sql(f"SELECT 'new' AS contig, {_SEQUENCE} AS seq"), 16)
    return B.normalize_indel(sites, blocks, tiles, 16, 1000).select("key", "norm_chrom", "norm_pos", "norm_ref", "norm_alt")


_ENTRY = "CASE WHEN l_linenumber % 5 = 0 THEN '.' WHEN l_linenumber % 5 = 1 THEN ALT || '|G1|0.1|bad|0.2|0.3|1|2|3|4' ELSE ALT || '|' || SYMBOL || '|0.' || CAST(l_orderkey % 90 + 10 AS STRING) || '|.|0.25|0.0|1|-2|3|4,A|G2|0.9|0.9|0.9|0.9|1|1|1|1' END"


@query("backfill_columns", "SELECT row_key, IMPACT, CASE WHEN ok THEN SYMBOL END AS spliceai_custom_SYMBOL, CASE WHEN ok THEN ag END AS spliceai_custom_DS_AG, CASE WHEN ok THEN -2.0 END AS spliceai_custom_DP_AL, CASE WHEN ok THEN greatest(ag, 0.25) END AS spliceai_custom_MAX FROM (SELECT *, l_linenumber % 5 > 1 AS ok, CAST('0.' || CAST(l_orderkey % 90 + 10 AS STRING) AS DOUBLE) AS ag FROM {v_variants}) t")
def _(spark, d):
    rows = table(spark, d, "v_variants").withColumn("SpliceAI", F.expr(_ENTRY)).select(*KEY, "IMPACT", "SpliceAI")
    return splicing.backfill_columns(rows).select(*KEY, "IMPACT", *(f"spliceai_custom_{n}" for n in ("SYMBOL", "DS_AG", "DP_AL", "MAX")))
