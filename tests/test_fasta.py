"""FASTA files against a plain reader; columns worked out by value."""

import random

from pyspark.sql import functions as F

from varlake.functions.values import by_value
from varlake.operators.builds import normalize_indel, reference_allele_check
from varlake.sources.fasta import fasta_lines, fasta_tiles, write_fasta
from varlake.sources.scans import sequence_tiles


def plain(texts):
    out = []
    for text in texts:
        for record in text.split(">")[1:] if ">" in text else []:
            head, _, body = record.partition("\n")
            out.append((head.split()[0], "".join(x.strip() for x in body.split("\n"))))
    return out


def test_fasta_tiles(spark, tmp_path):
    """Files in many blocks, lines of all lengths, Windows line ends, empty lines, contigs without bases, names that repeat."""
    rng = random.Random(31)
    texts = []
    for f in range(3):
        end = "\r\n" if f == 1 else "\n"
        lines = ["ACGT"] if f == 2 else []  # before any header
        for c in range(6):
            lines.append(f">chr{f}_{c} some words" if c else ">same")
            lines += ["".join(rng.choice("ACGTNacgt") for _ in range(rng.choice([1, 60, 60, 75, 300]))) for _ in range(rng.choice([0, 1, 9, 40]))] + [""] * (c == 3)
        texts.append(end.join(lines) + end * (f != 2))
        (tmp_path / f"{f}.fa").write_bytes(texts[-1].encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert fasta_lines(spark, f"{tmp_path}/*.fa").select("file", "block").distinct().count() > 6
        for size in (7, 100, 5000):
            got = sorted((r.contig, r.tile, r.seq) for r in fasta_tiles(spark, f"{tmp_path}/*.fa", size).collect())
            assert got == sorted((name, i // size, seq[i : i + size]) for name, seq in plain(texts) for i in range(0, len(seq), size))
            assert max(len(s) for _, _, s in got) <= size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fasta_written_and_checked(spark, tmp_path):
    rows = [("1", "ACGTACGTAC"), ("2", ""), ("3", "T" * 200)]
    write_fasta(spark.createDataFrame(rows, "contig string, seq string"), f"{tmp_path}/out", 8)
    tiles = fasta_tiles(spark, f"{tmp_path}/out", 64)
    assert sorted((r.contig, r.tile, len(r.seq)) for r in tiles.collect()) == [("1", 0, 10), ("3", 0, 64), ("3", 1, 64), ("3", 2, 64), ("3", 3, 8)]
    sites = spark.createDataFrame([("1", 1, "A"), ("1", 10, "G"), ("3", 200, "t"), ("3", 65, "N")], "contig string, pos long, ref string")
    assert sorted((r.contig, r.pos, r.agrees) for r in reference_allele_check(sites, tiles, 64).collect()) == [("1", 1, True), ("1", 10, False), ("3", 200, True)]


def test_fasta_without_contigs(spark, tmp_path):
    (tmp_path / "a.fa").write_text("\n\n")
    (tmp_path / "b.fa").write_text(">none\n")
    assert fasta_tiles(spark, f"{tmp_path}/*.fa", 10).count() == 0


def test_by_value(spark):
    """The same for few and for many values, with nulls, replaced columns and other columns that stay."""
    df = spark.createDataFrame([(i, [None, "a", "b"][i % 3], i % 2 if i % 5 else None, "old") for i in range(60)], "id long, x string, y int, z string")
    make = lambda rows: rows.withColumns({"z": F.coalesce(F.upper("x"), F.lit("none")), "w": F.coalesce("y", F.lit(-1))})
    plain_rows = sorted(map(tuple, make(df).collect()))
    for few in (0, 3, 100):
        got = by_value(df, ["x", "y", "not there"], make, few)
        assert sorted(map(tuple, got.select("id", "x", "y", "z", "w").collect())) == plain_rows
    assert by_value(df.limit(0), ["x"], lambda rows: rows.withColumn("z", F.upper("x"))).count() == 0


def test_fasta_lines_are_not_staged(spark, tmp_path):
    """Lines are dealt out once for their sums and once as tiles; none of it is written in between."""
    (tmp_path / "a.fa").write_text(">a b\nACGT\nAC\n>c\nG\n")
    tiles = fasta_tiles(spark, f"{tmp_path}/a.fa", 4)
    assert sorted(map(tuple, tiles.collect())) == [("a", 0, "ACGT"), ("a", 1, "AC"), ("c", 0, "G")]
    plan = tiles._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan


def test_indels_of_repeated_keys(spark):
    """A change is lifted once however many rows have it; keys may repeat. Few and many changes give the same."""
    rows = [("k", "old", 5, "ACG", "", None), ("k", "old", 5, "ACG", "-", ""), ("m", "old", 7, "-", "TT", None), ("n", "other", 7, "-", "TT", None), ("o", "old", 9, "A", "C", None), (None, "old", None, None, None, "x:g.4_5delinsGG"), ("p", None, 5, "A", "", None)]
    df = spark.createDataFrame(rows, "key string, chrom string, pos long, ref string, alt string, description string")
    blocks = spark.sql("SELECT 'old' AS src, 0L AS src_start, 100L AS src_end, 'new' AS dst, 30L AS dst_start, '+' AS strand")
    tiles = sequence_tiles(spark.sql("SELECT 'new' AS contig, repeat('ACGGTCATTGCAAGTC', 40) AS seq"), 16)
    seq = "ACGGTCATTGCAAGTC" * 40
    want = [("k", "new", 34, seq[33:37], seq[33])] * 2 + [("m", "new", 37, seq[36], seq[36] + "TT"), ("n", None, None, None, None), ("o", None, None, None, None), (None, "new", 33, seq[32:35], seq[32] + "GG"), ("p", None, None, None, None)]
    many = spark.range(20_001).selectExpr("'q' AS key", "'old' AS chrom", "id + 1000 AS pos", "'A' AS ref", "'' AS alt", "CAST(NULL AS STRING) AS description")
    for table in (df, df.union(many)):
        got = normalize_indel(table, blocks, tiles, 16, 1000).where("NOT key <=> 'q'").select("key", "norm_chrom", "norm_pos", "norm_ref", "norm_alt")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
