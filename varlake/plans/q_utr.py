"""The query of upstream open reading frames: sequences come from the letters of documents, transcripts and variants from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from varlake.operators import utr
from varlake.plans.registry import KEY, query
from varlake.plans.views import table
from varlake.sources import fasta, scans
from varlake.sources.tables import scratch

_BASES = "'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'"
_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_quantity AS INT) AS STRING) AS row_key"
# substitutions, deletions, insertions and substitutions of two bases, also outside and over the borders of the pieces
_VARIANTS = f"""SELECT {_KEY}, l_partkey AS transcript, 8 + l_orderkey % 250 AS pos,
 CASE l_linenumber % 4 WHEN 0 THEN 'A' WHEN 1 THEN repeat('A', CAST(1 + l_suppkey % 4 AS INT)) WHEN 2 THEN '-' ELSE 'AC' END AS ref,
 CASE l_linenumber % 4 WHEN 0 THEN substr('ACGT', CAST(1 + l_suppkey % 4 AS INT), 1) WHEN 1 THEN '-' WHEN 2 THEN substr('ATGACTAATGA', CAST(1 + l_suppkey % 5 AS INT), CAST(1 + l_orderkey % 4 AS INT)) ELSE substr('TGATAGC', CAST(1 + l_suppkey % 6 AS INT), 2) END AS alt
FROM lineitem"""
_EVIDENCE = "SELECT DISTINCT l_partkey AS contig, 11 + l_orderkey % 240 AS pos FROM lineitem WHERE l_linenumber = 1"
_TILE = 200


def _list(seq: str, codons: str) -> str:
    return f"list_filter(range(length({seq})), lambda i: substr({seq}, (i + 1)::INT, 3) IN ({codons}))"


def _stops(seq: str) -> str:
    return _list(seq, "'TAA', 'TAG', 'TGA'")


def _first(stops: str, start: str) -> str:
    return f"list_min(list_filter({stops}, lambda m: m >= {start} AND (m - {start}) % 3 = 0))"


def _kozak(seq: str, start: str) -> str:
    a, b = f"substr({seq}, ({start} - 2)::INT, 1)", f"substr({seq}, ({start} + 4)::INT, 1)"
    has = f"{start} >= 3 AND {start} + 3 < length({seq})"
    return f"'KozakContext=' || CASE WHEN {has} THEN substr({seq}, ({start} - 2)::INT, 7) ELSE '-' END || ':KozakStrength=' || CASE WHEN NOT ({has}) THEN '' WHEN {a} IN ('A', 'G') AND {b} = 'G' THEN 'Strong' WHEN {a} IN ('A', 'G') OR {b} = 'G' THEN 'Moderate' ELSE 'Weak' END"


def _kind(stop: str, distance: str, same: str = "InFrame_oORF") -> str:
    return f"CASE WHEN {stop} IS NOT NULL THEN 'uORF' WHEN ({distance}) % 3 <> 0 THEN 'OutOfFrame_oORF' ELSE '{same}' END"


def _text(value: str) -> str:
    return f"coalesce(CAST({value} AS VARCHAR), 'NA')"


_K = _kozak("utr", "s")
_PER_START = f"""
SELECT row_key, s, CASE
  WHEN b BETWEEN s AND s + 2 AND (put = '' OR substr(mut, (s + 1)::INT, 3) <> 'ATG') THEN 'consequence={utr.LOST}:CapDistanceToStart=' || s || ':DistanceToCDS=' || (len - s) || ':DistanceToStop=' || {_text('far - s')} || ':Evidence=' || evidence || ':' || {_K} || ':type=' || {_kind('stop', 'len - s')} END AS lost,
 CASE WHEN n_ref = length(put) AND b >= s + 3 AND e <= coalesce(stop - 1, len - 1) AND mut_stop < coalesce(stop - 1, len - 1) THEN 'consequence={utr.STOP_GAINED}:Evidence=' || evidence || ':' || {_K} || ':newSTOPDistanceToCDS=' || (mut_len - mut_stop) || ':ref_StartDistanceToCDS=' || (len - s) || ':ref_type=' || {_kind('stop', 'len - s')} END AS stop_gained,
 CASE WHEN b <= stop + 2 AND b + n_ref - 1 >= stop AND (put = '' OR substr(mut, (stop + 1)::INT, 3) NOT IN ('TAA', 'TAG', 'TGA')) THEN 'consequence={utr.STOP_LOST}:AltStop=' || CASE WHEN mut_stop IS NULL THEN 'False' ELSE 'True' END || ':AltStopDistanceToCDS=' || {_text('mut_len - mut_stop')} || ':Evidence=' || evidence || ':FrameWithCDS=' || CASE WHEN (mut_len - s) % 3 <> 0 THEN 'outOfFrame' ELSE 'inFrame' END || ':' || {_K} END AS stop_lost,
 CASE WHEN b >= s + 3 AND e <= coalesce(stop - 1, len - 1) AND abs(n_ref - length(put)) % 3 <> 0 THEN 'consequence={utr.FRAMESHIFT}:Evidence=' || evidence || ':' || {_K} || ':alt_type=' || {_kind('mut_stop', 'mut_len - s')} || ':alt_type_length=' || {_text('mut_far - s + 3')} || ':ref_StartDistanceToCDS=' || (len - s) || ':ref_type=' || {_kind('stop', 'len - s')} || ':ref_type_length=' || {_text('far - s + 3')} END AS shifted
FROM (SELECT x.*, {_first(_stops('utr || cds'), 's')} AS far, {_first(_stops('mut'), 's')} AS mut_stop, {_first(_stops('mut || cds'), 's')} AS mut_far, CASE WHEN v.contig IS NULL THEN 'False' ELSE 'True' END AS evidence
  FROM (SELECT m.*, o.s, o.stop, CASE WHEN strand = 1 THEN CASE WHEN s < 100 THEN 11 + s ELSE 51 + s END ELSE CASE WHEN s < second - 150 THEN second - s ELSE 110 - (s - (second - 150)) END END AS start_pos FROM mutated m JOIN orfs o USING (transcript) WHERE mut IS NOT NULL) x
  LEFT JOIN evidence v ON v.contig = x.transcript AND v.pos = x.start_pos) y"""

_SQL = f"""WITH genome AS (
 SELECT doc_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), {_BASES}) AS seq FROM documents
), pieces AS (
 SELECT doc_id AS transcript, CASE doc_id % 2 WHEN 0 THEN 1 ELSE -1 END AS strand, 210 + doc_id % 40 AS second, substr(seq, 11, 100) || substr(seq, 151, (60 + doc_id % 40)::INT) AS fwd, substr(seq, 400, 101) AS coding FROM genome WHERE length(seq) >= 600
), tr AS (
 SELECT transcript, strand, second, CASE strand WHEN 1 THEN fwd ELSE reverse(translate(fwd, 'ACGT', 'TGCA')) END AS utr, CASE strand WHEN 1 THEN coding ELSE reverse(translate(coding, 'ACGT', 'TGCA')) END AS cds FROM pieces
), orfs AS (
 SELECT transcript, s, {_first(_stops('utr'), 's')} AS stop FROM (SELECT *, unnest({_list('utr', "'ATG'")}) AS s FROM tr) t
), counts AS (
 SELECT t.transcript, count(*) FILTER (stop IS NOT NULL) AS existing_uORFs, count(*) FILTER (s IS NOT NULL AND stop IS NULL AND (length(utr) - s) % 3 <> 0) AS existing_OutOfFrame_oORFs, count(*) FILTER (s IS NOT NULL AND stop IS NULL AND (length(utr) - s) % 3 = 0) AS existing_InFrame_oORFs FROM tr t LEFT JOIN orfs o USING (transcript) GROUP BY t.transcript
), evidence AS ({_EVIDENCE}), variants AS ({_VARIANTS}), placed AS (
 SELECT v.*, strand, second, utr, cds, CASE ref WHEN '-' THEN 0 ELSE length(ref) END AS n_ref, CASE WHEN alt = '-' THEN '' WHEN strand = 1 THEN alt ELSE reverse(translate(alt, 'ACGT', 'TGCA')) END AS put FROM variants v JOIN tr USING (transcript)
), ends AS (
 SELECT *, CASE strand WHEN 1 THEN pos ELSE pos + n_ref - 1 END AS first_pos, CASE WHEN n_ref = 0 THEN CASE strand WHEN 1 THEN pos ELSE pos + n_ref - 1 END WHEN strand = 1 THEN pos + n_ref - 1 ELSE pos END AS last_pos FROM placed
), within AS (
 SELECT *, length(utr) AS len, {', '.join(f"CASE WHEN strand = 1 THEN CASE WHEN {p} BETWEEN 11 AND 110 THEN {p} - 11 WHEN {p} BETWEEN 151 AND second THEN {p} - 51 END ELSE CASE WHEN {p} BETWEEN 151 AND second THEN second - {p} WHEN {p} BETWEEN 11 AND 110 THEN second - 150 + 110 - {p} END END AS {n}" for p, n in (('first_pos', 'b'), ('last_pos', 'e')))} FROM ends
), mutated AS (
 SELECT *, length(mut) AS mut_len FROM (SELECT *, CASE WHEN b IS NOT NULL AND e IS NOT NULL THEN substr(utr, 1, b::INT) || put || substr(utr, (b + n_ref + 1)::INT) END AS mut FROM within) t
), gains AS (
 SELECT row_key, 'consequence={utr.GAINED}:CapDistanceToStart=' || g || ':DistanceToCDS=' || (mut_len - g) || ':DistanceToStop=' || {_text(_first(_stops('mut || cds'), 'g') + ' - g')} || ':' || {_kozak('mut', 'g')} || ':type=' || {_kind(_first(_stops('mut'), 'g'), 'mut_len - g', 'inFrame_oORF')} AS gained
 FROM (SELECT *, list_min(list_filter({_list('mut', "'ATG'")}, lambda i: i >= b - 2 AND i + 2 <= b + n_ref + 1)) AS g FROM mutated WHERE mut IS NOT NULL) t WHERE g IS NOT NULL
), per AS ({_PER_START}), merged AS (
 SELECT row_key, string_agg(lost, ',' ORDER BY s) AS lost, string_agg(stop_gained, ',' ORDER BY s) AS stop_gained, string_agg(stop_lost, ',' ORDER BY s) AS stop_lost, string_agg(shifted, ',' ORDER BY s) AS shifted FROM per GROUP BY row_key
)
SELECT v.row_key, CASE WHEN c.transcript IS NOT NULL THEN coalesce(nullif(concat_ws(',', CASE WHEN gained IS NOT NULL THEN '{utr.GAINED}' END, CASE WHEN lost IS NOT NULL THEN '{utr.LOST}' END, CASE WHEN stop_gained IS NOT NULL THEN '{utr.STOP_GAINED}' END, CASE WHEN stop_lost IS NOT NULL THEN '{utr.STOP_LOST}' END, CASE WHEN shifted IS NOT NULL THEN '{utr.FRAMESHIFT}' END), ''), '-') END AS utr5_consequence,
 CASE WHEN c.transcript IS NOT NULL THEN coalesce(nullif(concat_ws(',', gained, lost, stop_gained, stop_lost, shifted), ''), '-') END AS utr5_annotation, existing_uORFs, existing_OutOfFrame_oORFs, existing_InFrame_oORFs
FROM variants v LEFT JOIN counts c USING (transcript) LEFT JOIN gains g USING (row_key) LEFT JOIN merged m USING (row_key)"""


def genome(spark, d):
    """documents as contigs (contig, seq): their letters, written as bases."""
    return table(spark, d, "documents").selectExpr("doc_id AS contig", f"translate(lower(regexp_replace(text, '[^A-Za-z]', '')), {_BASES}) AS seq")


@query("uorf_effect", _SQL)
def _(spark, d):
    contigs = genome(spark, d)
    tiles = scans.sequence_tiles(contigs, _TILE)
    places = contigs.where("length(seq) >= 600").selectExpr("contig", "contig AS transcript", "CASE contig % 2 WHEN 0 THEN 1 ELSE -1 END AS strand", "array(named_struct('start', 11L, 'end', 110L), named_struct('start', 151L, 'end', 210 + contig % 40)) AS pieces")
    utrs = utr.spliced(places.select("transcript", "contig", "strand", F.inline("pieces")), tiles, _TILE, ["transcript"]).withColumnRenamed("seq", "utr")
    coding = places.selectExpr("transcript", "contig", "strand", "400 AS start", "500 AS end")
    cds = utr.spliced(coding, tiles, _TILE, ["transcript"]).select("transcript", F.col("seq").alias("cds"))
    transcripts = utrs.join(cds, "transcript").join(places.select("transcript", "pieces"), "transcript")
    lines = table(spark, d, "lineitem")
    variants = spark.sql(_VARIANTS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=lines)
    evidence = spark.sql(_EVIDENCE.replace("FROM lineitem", "FROM {lineitem}"), lineitem=lines)
    found = utr.uorf_effect(variants, utr.reference_frames(transcripts, evidence))
    return found.select(*KEY, "utr5_consequence", "utr5_annotation", *(F.col(c).cast("long").alias(c) for c in ("existing_uORFs", "existing_OutOfFrame_oORFs", "existing_InFrame_oORFs")))


_FASTA_SQL = f"""WITH genome AS (SELECT doc_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), {_BASES}) AS seq FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS contig, tile, substr(seq, CAST(tile * 500 + 1 AS INT), 500) AS seq FROM (SELECT *, unnest(range(0, CAST(ceil(length(seq) / 500.0) AS BIGINT))) AS tile FROM genome) t"""


@query("scan_fasta_file", _FASTA_SQL)
def _(spark, d):
    path = scratch(spark)
    fasta.write_fasta(genome(spark, d), path)
    return fasta.fasta_tiles(spark, path, 500)


@query("reference_allele_check_file", f"""WITH genome AS (SELECT doc_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), {_BASES}) AS seq FROM documents), sites AS (SELECT {_KEY}, l_partkey AS contig, 1 + l_orderkey % 2000 AS pos, substr('ACGTN', CAST(1 + l_suppkey % 5 AS INT), 1) AS ref FROM lineitem)
 SELECT row_key, substr(seq, pos::INT, 1) = ref AS agrees FROM sites JOIN genome ON doc_id = contig WHERE ref <> 'N' AND pos <= length(seq)""")
def _(spark, d):
    """Sites against bases read from FASTA files."""
    from varlake.operators.builds import reference_allele_check

    path = scratch(spark)
    fasta.write_fasta(genome(spark, d), path)
    tiles = fasta.fasta_tiles(spark, path, 500)
    sites = spark.sql(f"SELECT {_KEY}, CAST(l_partkey AS STRING) AS contig, 1 + l_orderkey % 2000 AS pos, substr('ACGTN', CAST(1 + l_suppkey % 5 AS INT), 1) AS ref FROM {{lineitem}}", lineitem=table(spark, d, "lineitem"))
    found = reference_allele_check(sites, tiles, 500)
    return found.where("agrees IS NOT NULL").select(*KEY, "agrees")
